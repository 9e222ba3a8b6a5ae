"""Mixes sources to target weights by entropy balancing.

Every document gets a rate, how often the mix takes it. The rates are as close to 1 as they can be,
in relative entropy weighted by words, while the words taken of every source add up to its target.
The dual of that problem is convex with one multiplier per source, and a document's rate is exp of
its source's multiplier. Newton's method solves the dual: every iteration sums gradient and
curvature over the stored sizes in one aggregation. Rates are then rounded to whole copies such
that every source's words stay near its target.
"""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.shared import materialize
from basketflow.operators.lookup import lookup
from basketflow.operators.ranking import numbered

WEIGHTS = (5.0, 2.0, 1.0)
# No document is taken more often, and no target is a larger multiple of its source.
MOST_COPIES = 3
# Units that are rounded together; a source of more units is rounded in several parts.
PART_ROWS = 2000
_TOLERANCE = 1e-10
_ITERATIONS = 60


def word_count(text: str = "text"):
    """Words of a text, 0 for a null one."""
    pattern = F.lit("[^\\x20\\x09-\\x0D]+")
    return F.coalesce(F.regexp_count(text, pattern), F.lit(0)).cast("long")


def source_targets(
    units: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """(source, no_source, rows, source_size, target) of every source, the null one included.

    Sources share all words by weight, in code point order, null last, the weights repeating. A
    target stops at ``most`` times its source; what is above is shared again by weight among the
    others until none is above.
    """
    totals = (
        units.groupBy("source", "no_source")
        .agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"), F.count("*").alias("rows"))
    )
    totals = materialize(totals, "sources")
    ranked = numbered(totals, ["no_source", "source"], totals.count())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn(
        "weight", F.element_at(cycle, (F.col("pos") % len(weights) + 1).cast("int"))
    )
    ranked = materialize(ranked.withColumn("limit", most * F.col("source_size").cast("double")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        # The level only rises, so a source that has reached its limit stays there.
        full = F.col("weight") * level > F.col("limit")
        count, taken, free = ranked.agg(
            F.count_if(full),
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
        ).first()
        if count == stopped or not free:
            break
        stopped, level = count, (total - taken) / free
    target = F.when(full, F.col("limit")).otherwise(F.col("weight") * level)
    return ranked.select("source", "no_source", "rows", "source_size", target.alias("target"))


def dual_rates(units: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with the rate of every source, from the dual's Newton iterations.

    Gradient and curvature of the dual in a source's multiplier m are sum(size * exp(m)) - target
    and sum(size * exp(m)). A source without words, or with target 0, has rate 0.
    """
    sources = targets.count()
    state = materialize(
        targets.where("target > 0 and source_size > 0").withColumn("multiplier", F.lit(0.0)), "dual"
    )
    sizes = units.where("size > 0").groupBy("source", "no_source", "size").agg(
        F.sum("repeats").alias("repeats")
    )
    sizes = materialize(sizes, "sizes")
    key = ["source", "no_source"]
    for _ in range(_ITERATIONS):
        tilted = lookup(sizes, state.select(*key, "multiplier"), key, sources, "size")
        sums = tilted.groupBy(*key).agg(
            F.sum(F.col("size") * F.col("repeats") * F.exp("multiplier")).alias("words")
        )
        state = materialize(
            state.join(sums, key).withColumns(
                {
                    "multiplier": F.col("multiplier") - (F.col("words") - F.col("target")) / F.col("words"),
                    "error": F.abs(F.col("words") / F.col("target") - 1),
                }
            ).drop("words"),
            "dual",
        )
        if not (state.agg(F.max("error")).first()[0] or 0) > _TOLERANCE:
            break
    rates = state.select(*key, F.exp("multiplier").alias("rate"))
    return targets.join(rates, key, "left").withColumn("rate", F.coalesce("rate", F.lit(0.0)))


def _rounded(most: int):
    """Copies of one part: from the largest unit down, each is rounded to what the part still lacks."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["words", "doc_id", "size"], ascending=[False, True, True])
        rate = min(float(part["rate"].iloc[0]), float(most))
        low, missing, copies = int(rate), 0.0, []
        for words in part["words"].tolist():
            missing += rate * words
            more = low < most and missing - low * words > words / 2
            copies.append(low + more)
            missing -= copies[-1] * words
        return part.assign(copies=copies)[["doc_id", "source", "no_source", "size", "repeats", "source_size", "target", "copies"]]

    return run


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """A row per (doc_id, source, size): repeats, source_size, target, copies.

    ``repeats`` counts the rows of ``docs`` with these values, which are all taken ``copies`` times;
    so repeated rows are treated alike. A null text has size 0 and a null source is a source of its
    own, shown as an empty name with ``no_source``. An empty table gives no rows. Columns other than
    doc_id, source and text are not read.
    """
    units = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("source").isNull().alias("no_source"),
        word_count().alias("size"),
    )
    units = materialize(
        units.groupBy("doc_id", "source", "no_source", "size").agg(F.count("*").alias("repeats")),
        "units",
    )
    targets = materialize(dual_rates(units, source_targets(units, weights, most)), "targets")
    key = ["source", "no_source"]
    rows = lookup(units, targets, key, targets.count(), "doc_id")
    parts = F.ceil(F.col("rows") / part_rows)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "size"), parts)).withColumn(
        "words", F.col("size") * F.col("repeats")
    )
    return rows.groupBy(*key, "part").applyInPandas(
        _rounded(most),
        "doc_id long, source string, no_source boolean, size long, repeats long, "
        "source_size long, target double, copies int",
    )


def apply_mix(docs: DataFrame, taken: DataFrame) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, its columns unchanged."""
    size = word_count()
    keyed = docs.withColumn("_size", size)
    copies = taken.where("copies > 0").select(
        F.col("doc_id").alias("_id"),
        F.when(~F.col("no_source"), F.col("source")).alias("_source"),
        F.col("size").alias("_words"),
        "copies",
    )
    same = (
        keyed["doc_id"].eqNullSafe(F.col("_id"))
        & keyed["source"].eqNullSafe(F.col("_source"))
        & (keyed["_size"] == F.col("_words"))
    )
    joined = keyed.join(copies.withColumnRenamed("copies", "_copies"), same)
    repeated = joined.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
