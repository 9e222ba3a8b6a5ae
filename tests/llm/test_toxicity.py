import math
import random
import re

import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketflow.llm import catalog, toxicity

RUDE = "moron scum trash idiot clown".split()
LABELS = "doc_id long, quality int, toxic int"


def made(seed, count, first=0):
    """(documents, labels): a third of the texts have rude words strewn in, some are very long."""
    rng, docs, labels = random.Random(seed), [], []
    for i in range(first, first + count):
        toxic = int(rng.random() < 0.33)
        words = corpus.text(rng, rng.choice((20, 60, 200, 2500)), rng.choice(("en", "de"))).split()
        if toxic:
            for _ in range(max(2, len(words) // 30)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(RUDE).title() + rng.choice((",", "", ".")))
        docs.append((i, " ".join(words), None, "src", 0))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def frames(spark, docs):
    texts, labels = made(5, 240)
    return spark.createDataFrame(texts, corpus.SCHEMA), spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def model(frames):
    return toxicity.fit(*frames)


def test_held_out_texts(spark, model):
    texts, labels = made(6, 150, 1000)
    found = toxicity.score(spark.createDataFrame(texts, corpus.SCHEMA), model).collect()
    truth = {i: t for i, _, t in labels}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    right = np.mean([r.predicted == truth[r.doc_id] for r in found])
    assert len(found) == 150 and right >= 0.95


def _plain(texts, truth, word, before):
    """The two differences of a word, from dictionaries of counts."""
    pairs = [[], []]
    for text, c in zip(texts, truth):
        words = [w.lower() for w in re.findall("[A-Za-z0-9\x80-\U0010ffff]+", text)]
        pairs[c] += list(zip([None] + words, words))
    bigrams = [{p: x.count(p) for p in set(x)} for x in pairs]
    singles = [{w: sum(1 for _, v in b if v == w) for w in {v for _, v in b}} for b in bigrams]

    def both(tables):
        return [*tables, {k: tables[0].get(k, 0) + tables[1].get(k, 0) for k in set(tables[0]) | set(tables[1])}]

    def discounts(table):
        n = [max(sum(v == i for v in table.values()), 1) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
        return [min(max(d, 0.5), i - 0.02) for i, d in enumerate(raw, 1)]

    def share(table, key, inside, base):
        d = discounts(table)
        rows = {k: v for k, v in table.items() if inside(k)}
        total = sum(rows.values())
        if not total:
            return base
        freed = sum(d[min(v, 3) - 1] for v in rows.values()) / total
        n = rows.get(key, 0) if isinstance(key, str) or bigrams[2].get(key, 0) > 1 else 0
        return (n - d[min(n, 3) - 1] if n else 0) / total + freed * base

    singles, bigrams = both(singles), both(bigrams)
    base = 1 / (len(singles[2]) + 1)
    result = []
    for tables, key, inside in (
        (singles, word, lambda k: True),
        (bigrams, (before, word), lambda k: k[0] == before),
    ):
        base = share(tables[2], key, inside, base)
        ordinary, toxic = (share(tables[c], key, inside, base) for c in (0, 1))
        result.append(math.log10(toxic / ordinary))
    return result


def test_shares_against_plain_counts():
    texts = ["you are a clown", "you are kind", "a clown a clown, You are!", "the kind are kind", "a a a b"]
    truth = np.array([1, 0, 1, 0, 0])
    known = toxicity._models(texts, truth)
    for text in ("you clown a kind", "are unseen a a clown"):
        words = text.split()
        alone, after = toxicity.word_differences(known, toxicity._all_words([text]))
        for at, word in enumerate(words):
            expected = _plain(texts, truth, word, words[at - 1] if at else None)
            assert np.allclose([alone[at], after[at]], expected, rtol=1e-4, atol=1e-6)


def test_words_end_with_their_text():
    column = pa.array(["One two", "", None, "TWO-three é4", "one"])
    model = toxicity._models(["one two", "two three"], np.array([0, 1]))
    together = toxicity.differences(column, model)
    apart = np.concatenate([toxicity.differences(column[i : i + 1], model) for i in range(5)])
    assert together.shape == (5, toxicity.COLUMNS) and np.allclose(together, apart)
    assert (together[1] == 0).all() and (together[2] == 0).all()


def test_whole_of_a_very_long_text(spark, model):
    rng = random.Random(4)
    plain = corpus.text(rng, 40_000, "en")
    late = plain + " " + " ".join(rng.choices(RUDE, k=2000))
    frame = spark.createDataFrame([(1, plain, None, None, 0), (2, late, None, None, 0)], corpus.SCHEMA)
    assert {r.doc_id: r.predicted for r in toxicity.score(frame, model).collect()} == {1: 0, 2: 1}


def test_odd_rows(spark, docs, no_docs, frames, model):
    found = toxicity.score(corpus.clashing(docs).withColumn("predicted", F.lit("x")), model)
    assert found.columns.count("score") == 1 and dict(found.dtypes)["score"] == "double"
    rows = found.collect()
    assert len(rows) == docs.count()
    constant = 1 / (1 + math.exp(-model.weights[-1]))
    assert all(math.isclose(r.score, constant) for r in rows if r.doc_id in (1000, 1001, 1002))
    assert len({r.score for r in rows if r.doc_id == 1004}) == 1
    assert toxicity.score(no_docs, model).count() == 0
    texts, labels = frames
    assert toxicity.fit(texts, labels.where("toxic = 0")) is None and toxicity.fit(no_docs, labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_bounds_and_labels_of_the_sample(spark, frames):
    texts, labels = frames
    again = labels.union(labels.where("doc_id < 3").withColumn("toxic", F.lit(1))).union(
        spark.createDataFrame([(4, 1, None), (None, 1, 1)], LABELS)
    )
    whole = toxicity.labelled_texts(texts, again, 10_000, 1 << 30)
    assert whole.count() == 240 and whole.where("toxic = 1").count() >= labels.where("toxic = 1").count()
    few = toxicity.labelled_texts(texts, labels, 64, 1 << 30).groupBy("toxic").count().collect()
    assert {r.toxic for r in few} == {0, 1} and all(r["count"] <= 64 for r in few)
    small = toxicity.labelled_texts(texts, labels, 10_000, 64 * 2000)
    assert small.groupBy("toxic").agg(F.sum(F.octet_length("text")).alias("b")).where("b > 128000").isEmpty()


def test_query_columns_and_held_out_accuracy(spark, tables):
    found = catalog.op12_toxicity(spark, tables)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in found.schema][:4] == [
        "doc_id bigint", "held_out boolean", "score double", "predicted int"
    ]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert found.count() == docs.count()
    part = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    assert found.where(found.held_out != part).isEmpty()
