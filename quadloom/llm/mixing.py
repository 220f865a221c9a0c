"""Mixing sources to target weights by iterative proportional fitting.

Tokens (words) of documents are summed by cell: source, language and topic.
Cell weights are raked in turns to the target shares of each of the three, and
the ratio of a cell's raked weight to its tokens, scaled so that a ``rate`` of
all tokens is expected, is the probability with which each document of the cell
is taken. It is one at most: each turn of the raking ends with that cap, so
that shares and caps are met together where they can be; ``margins`` reports
shares reached beside those asked for. A hash of doc_id decides, so the sample is the
same in every run and on any cluster. Only DataFrame functions are used.

Without given targets the shares are those of the tokens, flattened by an
exponent. Target values that no document has count for nothing; values without
a target get weight 0.

Cells are few rows against documents; totals are joined to them by key, and the
probabilities of cells to documents, so no cell, source or language is ever one
task's work; up to ``FEW_CELLS`` cells are raked in one task. Every fourth turn
is written to the shared folder.

Defined cases: null source or language is a value of its own; a null or empty
text has no tokens and, as its cell's, a probability of the cell, or 0 if the
cell has no tokens; documents of one doc_id share their fate; a null doc_id is
an id; rows and extra columns pass unchanged; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadloom.llm.common import checkpointed, fresh

DIMENSIONS = ("source", "lang", "topic")
WORD = r"[^\x20\x09-\x0D]+"
SIGN = r"[#*$%&|<>]"
NONE = "(none)"
FEW_CELLS = 100_000


@dataclass(frozen=True)
class Plan:
    """``targets``: shares by dimension and value; for other dimensions ``flatten`` has the exponent."""

    rate: float = 0.8
    turns: int = 16
    scalings: int = 8
    flatten: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.8, "topic": 0.9})
    targets: dict[str, dict[str, float]] = field(default_factory=dict)


def n_tokens(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic(text: Column | str, tokens: Column) -> Column:
    """The kind of a text by its form: signs, listing, short or prose."""
    own = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    lines = F.length(own) - F.length(F.replace(own, F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(F.regexp_count(own, F.lit(SIGN)) * 10 > tokens, "signs")
        .when(lines * 12 > tokens, "listing")
        .when(tokens < 200, "short")
        .otherwise("prose")
    )


def cells_of(rows: DataFrame) -> DataFrame:
    """Tokens of each cell."""
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").cast("double").alias("tokens"))


def _shares(cells: DataFrame, dimension: str, plan: Plan) -> DataFrame:
    """Target share of each value of a dimension, 1 in all."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("own"))
    if dimension in plan.targets:
        given = F.lit(0.0)
        for value, share in plan.targets[dimension].items():
            given = F.when(F.col(dimension) == value, float(share)).otherwise(given)
        sums = sums.withColumn("share", F.when(F.col("own") > 0, given).otherwise(0.0))
    else:
        sums = sums.withColumn("share", F.pow("own", F.lit(plan.flatten[dimension])))
    total = sums.agg(F.sum("share")).first()[0] or 1.0
    return checkpointed(sums.select(F.col(dimension).alias("value"), (F.col("share") / total).alias("share")))


def rake(cells: DataFrame, plan: Plan, capped: bool = False) -> DataFrame:
    """``cells`` with ``weight``, raked from their tokens to the target shares.

    ``capped``: a turn ends with the caps, so that no weight asks for more than
    all tokens of its cell at the plan's rate. Where shares and caps can be had
    together, the turns lead to both; elsewhere caps come first.
    """
    total, n = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0.0)), F.count("*")).first()

    def together(df: DataFrame) -> DataFrame:
        """Few cells, as there mostly are, in one task, which spares them a shuffle at each step."""
        return df.coalesce(1) if n <= FEW_CELLS else df

    now = cells.withColumn("weight", F.col("tokens"))
    for d in DIMENSIONS:
        shares = _shares(cells, d, plan).select(F.col("value").alias(f"of_{d}"), F.col("share").alias(f"share_{d}"))
        now = now.join(shares, F.col(d) == F.col(f"of_{d}")).drop(f"of_{d}")
    now = together(now)
    for turn in range(plan.turns):
        for d in DIMENSIONS:
            own = F.sum("weight").over(Window.partitionBy(d))
            now = now.withColumn("weight", F.when(own > 0, F.col("weight") * F.col(f"share_{d}") * total / own).otherwise(0.0))
        if capped:
            now = now.withColumn("weight", F.least("weight", F.col("tokens") / plan.rate))
        if turn % 4 == 3:
            now = together(checkpointed(now))
    return checkpointed(now.select(*DIMENSIONS, "tokens", "weight"))


def calibrated(cells: DataFrame, plan: Plan) -> DataFrame:
    """``cells`` with the probability of each of their documents."""
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    cells = cells.withColumn("ratio", ratio)
    sums = cells.agg(F.sum("tokens"), F.sum("weight")).first()
    wanted = plan.rate * (sums[0] or 0.0)
    scale = wanted / sums[1] if sums[1] else 0.0
    for _ in range(plan.scalings):
        full = F.col("ratio") * scale >= 1
        row = cells.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if row[1]:
            scale = (wanted - (row[0] or 0.0)) / row[1]
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * scale))


def margins(found: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """dimension, value, own, target and reached: shares of tokens in the input, as asked for, and as expected of a sample.

    ``found`` is what ``sampled`` gives. Where target and reached differ, the
    target can't be had at the plan's rate.
    """
    cells = checkpointed(
        found.groupBy(*DIMENSIONS).agg(
            F.sum("n_tokens").cast("double").alias("tokens"), F.sum(F.col("n_tokens") * F.col("probability")).alias("taken")
        )
    )
    tokens, taken = cells.agg(F.sum("tokens"), F.sum("taken")).first()
    parts = []
    for d in DIMENSIONS:
        sums = cells.groupBy(F.col(d).alias("value")).agg(
            (F.sum("tokens") / (tokens or 1.0)).alias("own"), (F.sum("taken") / (taken or 1.0)).alias("reached")
        )
        parts.append(sums.join(_shares(cells, d, plan), "value").select(F.lit(d).alias("dimension"), "value", "own", F.col("share").alias("target"), "reached"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def chance(doc_id: Column | str) -> Column:
    """A number in [0, 1) for each id."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def sampled(docs: DataFrame, plan: Plan = Plan(), kind: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability and selected of every document.

    ``kind`` is the topic; by default it is the form of the text.
    """
    rows = docs.select(
        "doc_id",
        *(F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(d) for d in ("source", "lang")),
        (F.coalesce(kind.cast("string"), F.lit(NONE)) if kind is not None else topic("text", n_tokens("text"))).alias("topic"),
        n_tokens("text").alias("n_tokens"),
    )
    rows = checkpointed(rows)
    cells = checkpointed(calibrated(rake(checkpointed(cells_of(rows)), plan, capped=True), plan))
    names = [F.col(d).alias(f"{d}_of") for d in DIMENSIONS]
    on = (F.col("source") == F.col("source_of")) & (F.col("lang") == F.col("lang_of")) & (F.col("topic") == F.col("topic_of"))
    found = rows.join(cells.select(*names, "probability"), on, "left")
    return found.select(
        "doc_id", *DIMENSIONS, "n_tokens", "probability", (chance("doc_id") < F.col("probability")).alias("selected")
    )


def mixed(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The documents that are taken, as they are."""
    (own,) = fresh(docs, "taken")
    ids = sampled(docs, plan).where("selected").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(own)).distinct()
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.join(ids, key == F.col(own), "left_semi")


def digests(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    return sampled(docs, plan).withColumn("probability", F.round("probability", 6))


def oracle(plan: Plan = Plan()) -> str:
    """The same in SQL, its turns written out."""
    word, sign = WORD, SIGN
    parts = [
        f"""counted AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
            coalesce(text, '') AS t, coalesce(len(regexp_extract_all(text, '{word}')), 0) AS n_tokens FROM documents)""",
        f"""typed AS (SELECT doc_id, source, lang, n_tokens, CASE
            WHEN len(regexp_extract_all(t, '{sign}')) * 10 > n_tokens THEN 'signs'
            WHEN (length(t) - length(replace(t, chr(10), '')) + 1) * 12 > n_tokens THEN 'listing'
            WHEN n_tokens < 200 THEN 'short' ELSE 'prose' END AS topic FROM counted)""",
        """cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens)::DOUBLE AS weight
            FROM typed GROUP BY ALL)""",
    ]
    for d in DIMENSIONS:
        parts.append(f"""p_{d} AS (SELECT {d}, pow(sum(tokens), {plan.flatten[d]}) AS s FROM cells GROUP BY {d})""")
        parts.append(f"""s_{d} AS (SELECT {d}, s / (SELECT sum(s) FROM p_{d}) AS share FROM p_{d})""")
    last = "cells"
    for turn in range(plan.turns):
        for d in DIMENSIONS:
            name = f"w{turn}_{d}"
            parts.append(
                f"""{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, weight * CASE
                WHEN sum(weight) OVER (PARTITION BY {d}) > 0
                THEN share * (SELECT sum(tokens) FROM cells) / sum(weight) OVER (PARTITION BY {d}) ELSE 0 END AS weight
                FROM {last} JOIN s_{d} USING ({d}))"""
            )
            last = name
        parts.append(
            f"""w{turn} AS MATERIALIZED (SELECT source, lang, topic, tokens, least(weight, tokens / {plan.rate}) AS weight FROM {last})"""
        )
        last = f"w{turn}"
    parts.append(
        f"""raked AS MATERIALIZED (SELECT *, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS ratio FROM {last})"""
    )
    parts.append(f"""c0 AS (SELECT {plan.rate} * sum(tokens) / sum(weight) AS c FROM raked)""")
    for i in range(plan.scalings):
        parts.append(
            f"""c{i + 1} AS MATERIALIZED (SELECT coalesce(({plan.rate} * sum(tokens)
            - coalesce(sum(tokens) FILTER (ratio * c >= 1), 0)) / sum(weight) FILTER (ratio * c < 1), max(c)) AS c
            FROM raked, c{i})"""
        )
    return (
        "WITH "
        + ",\n".join(parts)
        + f""" SELECT doc_id, source, lang, topic, n_tokens, round(least(1.0, ratio * c), 6) AS probability,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / 281474976710656.0
        < least(1.0, ratio * c) AS selected
        FROM typed JOIN raked USING (source, lang, topic), c{plan.scalings}"""
    )
