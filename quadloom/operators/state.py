"""Changing the state of resources, whole tables of changes at a time.

Changes are ordered by ``ORDER``; the newest row of an identifier stands. That
choice is an aggregate of narrow rows, combined before the shuffle, so a
resource which holds a large share of the changes costs one narrow row per
task. Wide rows are fetched for what was chosen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadloom.functions.times import truncate_to
from quadloom.operators.keyed import fetch, order_key, picked, rows_with_keys
from quadloom.vocab import DEFAULTS, LDP_BASIC_CONTAINER, Settings

ORDER = ("created", "seq")

WRITE_OPS = ("create", "replace")
TOUCH_OP = "touch"
DELETE_OP = "delete"
ADD_OP = "add"


def newest(
    df: DataFrame, by: Sequence[str], order: Sequence[str], oldest: bool = False, among: DataFrame | None = None
) -> DataFrame:
    """The newest (or oldest) row of each group of columns ``by``; of rows alike in ``order`` one.

    ``among`` limits the groups to its rows, each of which it holds once.

    The choice is made on the columns ``by`` and one order key, combined before
    the shuffle; the rows chosen are fetched after that (``keyed.fetch``). A
    first job writes the choice. Where ``keyed.order_key`` has no key for the
    types of ``order``, whole rows are compared instead.
    """
    key = order_key(df, order)
    if key is None:
        whole = newest_row(df, by, order, oldest)
        return whole if among is None else whole.join(among, list(by), "left_semi")
    ordered = df.withColumn("_order", key)
    pick = F.min if oldest else F.max
    narrow = ordered.select(*by, "_order")
    narrow = narrow if among is None else narrow.join(among, list(by), "left_semi")
    chosen = narrow.groupBy(*by).agg(pick("_order").alias("_order"))
    return fetch(ordered, picked(chosen, "newest"), [*by, "_order"]).select(*df.columns)


def newest_row(df: DataFrame, by: Sequence[str], order: Sequence[str], oldest: bool = False) -> DataFrame:
    """The same in one pass over whole rows: for narrow ones, and for batches of a stream."""
    names = [c for c in df.columns if c not in by]
    pick = F.min_by if oldest else F.max_by
    row = pick(F.struct(*names), F.struct(*order)).alias("row")
    return df.groupBy(*by).agg(row).select(*by, "row.*").select(*df.columns)


def upsert(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Write full rows over the state, which has one row per identifier; nulls in a change overwrite too.

    The newest row by ``ORDER`` stands, a change before a state of its order.
    Changes without an identifier are left out. Only narrow rows of the changes
    are compared with the state: where these are few, no row of it moves.
    """
    kept, moved = upsert_parts(state, changes)
    return moved if kept is None else kept.unionByName(moved)


def upsert_parts(state: DataFrame, changes: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """``upsert`` in two parts: rows of the state that lie where they were, and rows that are new or that a shuffle has moved."""
    new, old = order_key(changes, ORDER), order_key(state, ORDER)
    ordered = changes.filter("identifier IS NOT NULL").withColumn("_order", new)
    marks = picked(ordered.groupBy("identifier").agg(F.max("_order").alias("_order")), "upsert")
    far, near = marks.apart(state, ["identifier"])
    met = near.withColumn("_old", old).join(marks.hinted(), "identifier", "left")
    newer = F.col("_old") > F.col("_order")
    kept = met.filter(F.col("_order").isNull() | newer).select(*state.columns)
    late = met.filter(newer).select("identifier")
    stands = fetch(ordered, marks, ["identifier", "_order"]).select(*state.columns)
    stands = stands.join(late, "identifier", "left_anti")
    return (kept, stands) if marks.small else (far, kept.unionByName(stands))


def delete(state: DataFrame, ids: DataFrame) -> DataFrame:
    """Remove current rows. Versions and append-only quads are other tables."""
    return rows_with_keys(state, ids, "left_anti")


def touch(state: DataFrame, touches: DataFrame) -> DataFrame:
    """Set ``modified`` to the latest ``ts`` of a touch; absent resources stay absent.

    As in ``fold_ops``, a touch before the last write or touch changes nothing.
    """
    last = touches.groupBy("identifier").agg(F.max("ts").alias("touched"))
    return (
        state.join(last, "identifier", "left")
        .withColumn("modified", F.greatest("touched", "modified"))
        .select(*state.columns)
    )


def missed_touches(state: DataFrame, touches: DataFrame) -> DataFrame:
    """How many touches named each absent resource: (identifier, touches)."""
    counts = touches.groupBy("identifier").agg(F.count("*").alias("touches"))
    return counts.join(state.select("identifier"), "identifier", "left_anti")


def append_immutable(immutable: DataFrame, additions: DataFrame) -> DataFrame:
    """Append (identifier, created, quads) rows; same instants keep both."""
    columns = ["identifier", "created", "quads"]
    return immutable.select(*columns).unionByName(additions.select(*columns))


def accumulate(ops: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """What a log of create, replace, touch and delete ops comes to, per identifier.

    ``ops`` has op, identifier, ts, seq and the columns ``attrs``; other ops
    are ignored. The result keeps the newest write (``written``, and ``wrote``,
    its order key), the order key of the newest deletion and the time of the
    newest write or touch, so that accumulated logs can be combined. These are
    chosen on narrow rows; attributes are fetched for the writes that stand.
    """
    at = order_key(ops, ("ts", "seq"))
    write = F.col("op").isin(*WRITE_OPS)
    remove = F.col("op") == DELETE_OP
    refresh = write | (F.col("op") == TOUCH_OP)
    marks = (
        ops.filter(refresh | remove)
        .groupBy("identifier")
        .agg(
            F.max(F.when(write, at)).alias("wrote"),
            F.max(F.when(remove, at)).alias("removed"),
            F.max(F.when(refresh, F.col("ts"))).alias("refreshed"),
        )
    )
    wide = ops.filter(write).select("identifier", at.alias("wrote"), F.struct("ts", "seq", *attrs).alias("written"))
    return _with_writes(marks, wide)


def _with_writes(marks: DataFrame, writes: DataFrame) -> DataFrame:
    """Marks (identifier, wrote, removed, refreshed) with ``written`` of the writes they name."""
    found = picked(marks, "marks")
    names = ["identifier", "wrote", "written", "removed", "refreshed"]
    none = F.lit(None).cast(writes.schema["written"].dataType)
    rest = found.rows.filter("wrote IS NULL").withColumn("written", none)
    return fetch(writes, found, ["identifier", "wrote"]).select(*names).unionByName(rest.select(*names))


def combine(*accumulated: DataFrame) -> DataFrame:
    """Accumulated logs as one, whatever order they come in."""
    union = accumulated[0]
    for other in accumulated[1:]:
        union = union.unionByName(other)
    marks = union.groupBy("identifier").agg(*(F.max(c).alias(c) for c in ("wrote", "removed", "refreshed")))
    return _with_writes(marks, union.filter("wrote IS NOT NULL").select("identifier", "wrote", "written"))


def live(accumulated: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Current state (identifier, attrs, modified, created, seq) of an accumulated log.

    A resource stands if it was written after its last deletion. A touch before
    that write never shows, and a touch of an absent resource does nothing.
    """
    stands = F.col("wrote").isNotNull() & (F.col("removed").isNull() | (F.col("wrote") > F.col("removed")))
    return accumulated.filter(stands).select(
        "identifier",
        *[F.col(f"written.{a}").alias(a) for a in attrs],
        F.col("refreshed").alias("modified"),
        F.col("written.ts").alias("created"),
        F.col("written.seq").alias("seq"),
    )


def fold_ops(ops: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Current state after a whole log of ops.

    Order is in the data, so late rows, repeats and partitioning do not matter.
    """
    return live(accumulate(ops, attrs), attrs)


def additions_of_ops(ops: DataFrame, text_col: str) -> DataFrame:
    """The append-only rows a log holds, ready for ``append_immutable``."""
    return ops.filter(F.col("op") == ADD_OP).select(
        "identifier", F.col("ts").alias("created"), F.col(text_col).alias("quads")
    )


def ensure_root(state: DataFrame, at: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """The state with the root container in it, created at ``at`` if absent."""
    spark = state.sparkSession
    root = settings.data_prefix
    values = {
        "identifier": F.lit(root),
        "interactionModel": F.lit(LDP_BASIC_CONTAINER),
        "modified": at,
        "created": at,
        "seq": F.lit(0).cast("bigint"),
    }
    row = spark.range(1).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in state.schema]
    )
    present = state.filter(F.col("identifier") == root).select("identifier").limit(1)
    return state.unionByName(row.join(present, "identifier", "left_anti"))


def snapshot(
    resources: DataFrame,
    at: Column | None = None,
    granularity: str = "second",
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Version rows of current resources; none when versioning is off.

    ``modified`` stays whole, ``mementomodified`` is cut to the granularity.
    ``created`` is when the version row is made: ``at``, or the row's own.
    """
    made = F.col("created") if at is None else at
    kept = resources.filter(F.lit(settings.versioning)).withColumn("created", made)
    return kept.withColumn("mementomodified", truncate_to("modified", granularity))


def versions_of_ops(ops: DataFrame, attrs: Sequence[str], settings: Settings = DEFAULTS) -> DataFrame:
    """A version row for each write in a log, as ``snapshot`` after that write makes it."""
    writes = ops.filter(F.col("op").isin(*WRITE_OPS))
    columns = ["identifier", *attrs, F.col("ts").alias("modified"), F.col("ts").alias("created"), "seq"]
    return snapshot(writes.select(*columns), settings=settings)
