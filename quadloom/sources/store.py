"""Tables that change at rest: buckets of rows under a manifest.

Layout below the root:
  data/write=<id>/bucket=<n>/   rows of one bucket, as one write left them
  manifest/version=<n>/         which write each bucket is read from, one row a bucket

A change writes the buckets that it touches anew, beside those they replace,
then one manifest that names all buckets: that file is the switch. A write that
fails before it changes nothing, and readers go on with the version that they
have opened. There is one writer at a time; of two that start from one version
the later finds its manifest in place and fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quadloom.operators import state
from quadloom.operators.keyed import parts_without_keys
from quadloom.sources.tables import BUCKET, bucket_of

# Most files for a bucket, on average, before a change that leaves rows where they lie places all of them anew.
MOST_FILES = 64

Parts = tuple[DataFrame | None, DataFrame | None]

_MANIFEST = "bucket INT, write STRING, source BIGINT, version BIGINT"


class BucketStore:
    """A table of ``schema`` whose rows are hashed by ``key`` into ``buckets``.

    All rows of a bucket are rewritten when one of them changes, so there
    should be enough of them: at 100 TB some 100,000, of 1 GB each. Files of a
    bucket are sorted by key and ``order``; a hot key fills several files. Rows
    that a change keeps are written by the task that reads them, in files like
    those they were in; only rows that are new or were joined move.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: str | StructType, buckets: int, key: str = "identifier", order: Sequence[str] = ()
    ):
        self.spark, self.root, self.buckets, self.key, self.order = spark, root.rstrip("/"), buckets, key, list(order)
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.placed = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])

    def version(self) -> int:
        """The newest version, 0 before the first write."""
        try:
            seen = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException:  # there is no such folder yet
            return 0
        return seen.agg(F.max("version")).first()[0] or 0

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """The write that each bucket with rows is read from."""
        return {r[BUCKET]: r["write"] for r in self._entries(version) if r[BUCKET] >= 0}

    def source(self, version: int | None = None) -> int:
        """What a version was said to be made from (``change``), 0 if nothing was said."""
        return max((r["source"] or 0 for r in self._entries(version)), default=0)

    def _entries(self, version: int | None) -> list:
        version = self.version() if version is None else version
        if not version:
            return []
        seen = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest")
        return seen.filter(F.col("version") == version).collect()  # a row for each bucket

    def read(self, version: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The table as of a version, or its buckets ``only``; no other folder is opened."""
        manifest = self.manifest(version)
        wanted = manifest if only is None else set(only) & manifest.keys()
        paths = [f"{self.root}/data/write={manifest[b]}/bucket={b}" for b in sorted(wanted)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.placed).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*self.schema.names)

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets in which ``keys`` are: at most as many numbers as there are buckets."""
        found = keys.select(bucket_of(self.key, self.buckets).alias(BUCKET)).distinct()
        return sorted(r[BUCKET] for r in found.collect())

    def change(
        self, keys: DataFrame, make: Callable[[DataFrame], DataFrame | Parts], source: int = 0
    ) -> int:
        """Rewrite the buckets of ``keys`` as ``make`` of their rows, and switch to that; the new version.

        ``make`` must give rows of those buckets alone. It may give them in two
        parts, of which either may be None: rows that lie where they were read,
        with no shuffle since, and others. ``source`` is kept in the manifest:
        the version of another table that this one follows.
        """
        base = self.version()
        touched = self.touched(keys)
        kept = {b: w for b, w in self.manifest(base).items() if b not in touched}
        if touched:
            rows = self.read(base, touched)
            made = make(rows)
            if isinstance(made, tuple) and len(rows.inputFiles()) > MOST_FILES * len(touched):
                made = reduce(DataFrame.unionByName, [part for part in made if part is not None])
            kept |= self._write(*made[::-1]) if isinstance(made, tuple) else self._write(made)
        return self._switch(kept, base, source)

    def replace(self, df: DataFrame, source: int = 0) -> int:
        """Write the whole table anew."""
        base = self.version()
        return self._switch(self._write(df), base, source)

    def _write(self, df: DataFrame | None, lying: DataFrame | None = None) -> dict[int, str]:
        """Write ``df``, placed in ranges, and rows ``lying`` as they do; the write of each bucket that has rows."""
        write = uuid.uuid4().hex
        by = [BUCKET, self.key, *self.order]
        path = f"{self.root}/data/write={write}"
        for part, lies in ((df, False), (lying, True)):
            if part is not None:
                placed = part.select(*self.schema.names).withColumn(BUCKET, bucket_of(self.key, self.buckets))
                placed = placed if lies else placed.repartitionByRange(*by)
                placed.sortWithinPartitions(*by).write.mode("append").partitionBy(BUCKET).parquet(path)
        made = self.spark.read.schema(self.placed).parquet(path).select(BUCKET).distinct().collect()
        return {r[BUCKET]: write for r in made}

    def _switch(self, manifest: dict[int, str], base: int, source: int) -> int:
        # a row of no bucket, so that an empty table has a manifest too
        rows = [(b, w, source) for b, w in sorted(manifest.items())] + [(-1, None, source)]
        made = self.spark.createDataFrame(rows, "bucket INT, write STRING, source BIGINT").coalesce(1)
        made.write.mode("errorifexists").parquet(f"{self.root}/manifest/version={base + 1}")
        return base + 1

    def upsert(self, changes: DataFrame) -> int:
        """``state.upsert`` at rest."""
        changes = changes.filter(F.col(self.key).isNotNull())
        return self.change(changes, lambda rows: state.upsert_parts(rows, changes))

    def delete(self, ids: DataFrame) -> int:
        """Remove the rows of ``ids``: a resource, or all chunks of a binary."""
        return self.change(ids, lambda rows: parts_without_keys(rows, ids, self.key))

    def differing(self, old: int, new: int) -> list[int]:
        """Buckets that two versions read from different writes."""
        a, b = self.manifest(old), self.manifest(new)
        return sorted(n for n in a.keys() | b.keys() if a.get(n) != b.get(n))

    def expire(self, keep: int) -> int:
        """Remove all versions before ``keep`` and the writes that only they name; how many folders that were.

        Readers of those versions fail after that.
        """
        seen = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest")
        entries = seen.select("version", "write").distinct().collect()
        live = {r["write"] for r in entries if r["version"] >= keep}
        old = {f"data/write={r['write']}" for r in entries if r["write"] and r["write"] not in live}
        old |= {f"manifest/version={r['version']}" for r in entries if r["version"] < keep}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for name in sorted(old):
            folder = path(f"{self.root}/{name}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return len(old)
