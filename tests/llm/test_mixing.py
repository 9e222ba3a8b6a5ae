import corpus
from pyspark.sql import functions as F

from basketflow.llm import mixing


def targets_by_force(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is above the limit goes to the others until none is."""
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in ordered if s not in full]
        if not free:
            return {s: float(most * sizes[s]) for s in ordered}
        level = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in ordered}
        full |= above


def mixed(docs, **options):
    taken = mixing.mix(docs, **options)
    return taken.withColumn("source", F.when(~F.col("no_source"), F.col("source"))).toPandas()


def test_targets_and_words_taken(docs):
    rows = docs.collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(corpus.words_of(r.text))
    want = targets_by_force(sizes)
    got = mixed(docs)
    assert got["repeats"].sum() == len(rows)
    assert (got["copies"] <= 3).all() and (got["copies"] >= 0).all()
    for (source, missing), part in got.groupby([got["source"].fillna(""), got["source"].isna()]):
        target = want[None if missing else source]
        assert abs(part["target"].iloc[0] - target) < 1e-6
        words = (part["copies"] * part["size"] * part["repeats"]).sum()
        assert part["source_size"].iloc[0] == sizes[None if missing else source]
        # The last decision of a part leaves at most half of a document open.
        assert abs(words - target) <= (part["size"] * part["repeats"]).max() / 2 + 1e-6


def test_small_parts_stay_near_the_target(docs):
    got = mixed(docs, part_rows=5)
    words = (got["copies"] * got["size"] * got["repeats"]).groupby(got["source"]).sum()
    goal = got.groupby("source")["target"].first()
    assert (abs(words - goal) <= 0.25 * goal + 60).sum() >= len(goal) - 2


def test_reruns_agree_and_other_columns_do_not_matter(docs):
    order = ["doc_id", "source", "size"]
    first = mixed(docs).sort_values(order).reset_index(drop=True)
    again = mixed(corpus.clashing(docs.repartition(5))).sort_values(order).reset_index(drop=True)
    assert first.equals(again)


def test_empty_table_and_texts_without_words(spark, no_docs):
    assert mixed(no_docs).empty
    blank = spark.createDataFrame([(1, None, "en", None, 0), (2, " ", "en", "a", 0)], corpus.SCHEMA)
    got = mixed(blank)
    assert sorted(got["size"]) == [0, 0] and (got["target"] == 0).all() and (got["copies"] == 0).all()


def test_applied_mix_repeats_rows(docs):
    taken = mixing.mix(docs).cache()
    mix = mixing.apply_mix(docs, taken)
    assert mix.columns == docs.columns
    assert mix.count() == taken.agg(F.sum(F.col("copies") * F.col("repeats"))).first()[0]
