import copy
import math
import random
import tracemalloc
import zlib
from collections import Counter

import corpus
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketflow.llm import lm_score, quality_rules, text_stats
from basketflow.llm.shared import crc_bucket


def stats_by_force(text):
    words, text = corpus.words_of(text), text or ""
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if corpus.words_of(line):
            repeated_lines += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated_lines, len(covered)


def test_statistics_as_defined(monkeypatch):
    rng = random.Random(12)
    pieces = ["a", "b", "a b a b", "é", "\U0001f600", "\n", "\n\n", " ", "\t", "#", "x|y", "a a a", "end\n"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "\n \n", "a\na\na", "a b c\r\na b c\r\n"]
    monkeypatch.setattr(text_stats, "text_slices", lambda c: _small_slices(c))
    found = [a.to_pylist() for a in text_stats.text_stats(pa.array(texts))[: len(text_stats.COUNTS)]]
    for i, text in enumerate(texts):
        assert tuple(f[i] for f in found) == stats_by_force(text)


def _small_slices(column):
    """Slices of seven texts, so that the places where slices meet are tested as well."""
    from basketflow.llm.textbytes import text_slices

    for low in range(0, len(column), 7):
        for first, end, data, offsets in text_slices(column.slice(low, 7)):
            yield first + low, end + low, data, offsets


def test_rules_are_learned_and_keep_clean_documents(spark, docs):
    rng, rows, labels = random.Random(2), [], []
    for i in range(300):
        bad = i % 4 == 0
        words = corpus.text(rng, 80).split()
        rows.append((i, " ".join(w + "###" * (bad and j % 3 == 0) for j, w in enumerate(words)), "en", "s", 0))
        labels.append((i, int(not bad), 0))
    frame = spark.createDataFrame(rows, corpus.SCHEMA)
    rules = quality_rules.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rules
    judged = {r.doc_id: r for r in quality_rules.judge(frame, rules).collect()}
    assert all(judged[i].kept == bool(quality) for i, quality, _ in labels)
    again = quality_rules.judge(corpus.clashing(docs), rules).collect()
    for r in again:
        words, _, _, _, repeated = stats_by_force(r.text)
        failed = words < 50 or 100 * repeated > 50 * words
        assert r.base_failed == failed and not (r.kept and failed)
    assert {r.kept for r in again if r.text is None} == {False}


def test_rules_without_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([(None, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    rules = quality_rules.fit(docs, labels)
    assert rules == []
    judged = quality_rules.judge(docs, rules)
    assert judged.where(F.col("kept") == F.col("base_failed")).isEmpty()
    assert quality_rules.judge(no_docs, rules).count() == 0


def test_a_rule_must_be_right_often_enough():
    rng = np.random.default_rng(0)
    table = {f: rng.random(600) for f in quality_rules.FEATURES}
    assert quality_rules.learn(table, rng.random(600) < 0.3) == []
    bad = (table["upper"] > 0.7) & (table["digits"] < 0.4)
    rules = quality_rules.learn(table, bad)
    covered = np.any([r.covers(table) for r in rules], axis=0)
    assert (covered == bad).mean() > 0.97


def scored(docs, size=lm_score.DICTIONARY):
    part = crc_bucket("doc_id", 7)
    return lm_score.score(docs, part != 2, part == 2, size)


def _tokens(text):
    return corpus.words_of(text, lower=True) + [None]


def test_base_scores_as_defined(docs):
    rows = docs.collect()
    bucket = {r.doc_id: None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 7 for r in rows}
    counts = Counter()
    for r in rows:
        if bucket[r.doc_id] not in (None, 2):
            counts.update(_tokens(r.text))
    total, types = sum(counts.values()), len(counts)
    for size in (lm_score.DICTIONARY, 40):
        want = Counter()
        for r in rows:
            tokens = _tokens(r.text)
            base = sum(math.log10((counts[t] + 1) / (total + types + 1)) for t in tokens)
            known = sum(counts[t] > 0 for t in tokens)
            want[(r.doc_id, bucket[r.doc_id] == 2, len(tokens), known, total, round(base, 6))] += 1
        got = scored(corpus.clashing(docs), size).collect()
        assert want == Counter(
            (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
        )
        assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_no_documents(docs, no_docs):
    assert scored(no_docs).count() == 0
    alone = lm_score.score(docs, F.lit(False), F.lit(True)).collect()
    assert len(alone) == docs.count()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in alone)
    assert all(math.isfinite(r.score) for r in alone)


def test_class_probabilities_are_normalised_and_learn_order():
    rng = np.random.default_rng(4)
    classes = np.tile(np.array([1, 2, 3, 4]), 4000)
    noise = rng.random(len(classes)) < 0.1
    classes = np.where(noise, rng.integers(0, 5, len(classes)), classes)
    model = lm_score.LogBilinear(np.bincount(classes, minlength=6))
    before = model.log_sums(classes, np.array([0]))[0]
    windows = np.stack([classes[2:-1], classes[1:-2], classes[:-3], classes[3:]], axis=1)
    for seed in range(3):
        model.train(windows, seed)
    assert model.log_sums(classes, np.array([0]))[0] < 0
    assert model.log_sums(classes, np.array([0]))[0] > before + 0.3 * len(classes)
    for context in ([1, 2, 3], [4, 4, 0], []):
        texts = [np.array(context + [c], np.int64) for c in range(6)]
        starts = np.cumsum([0] + [len(t) for t in texts])[:-1]
        sums = model.log_sums(np.concatenate(texts), starts)
        prefix = model.log_sums(np.array(context, np.int64), np.array([0]))[0] if context else 0
        assert abs(np.exp(sums - prefix).sum() - 1) < 1e-4


def test_word_probabilities_add_up():
    """Within its class every known word has its share, and the rarer ones the add-one share."""
    counts = [(w, 100 - w) for w in range(1, 60)]
    total = sum(c for _, c in counts) + 7
    number = np.array([7] + [c for _, c in counts])

    class Frame:
        """Stands for the counts of a table, already small."""

    hashes = np.array([0] + [w for w, _ in counts], np.uint64)
    rank = np.arange(len(number))
    classes = np.where(rank <= 10, rank, 11)
    class_counts = np.bincount(classes, number)
    book = lm_score.Dictionary(
        hashes, number, classes, np.log10(number / class_counts[classes]), class_counts
    )
    for c in range(12):
        assert abs((10 ** book.shares[book.classes == c]).sum() - 1) < 1e-9
    assert class_counts.sum() == total


def test_words_of_one_class_learn_their_own_contexts():
    """Two rare words of one frequency, each after its own word: the right order is likelier."""
    rng = np.random.default_rng(3)
    counts = np.full(61, 100)
    firsts = lm_score.first_ids(60, 4)
    assert firsts[0] == 0 and firsts[-1] == 60 and (np.diff(firsts) > 0).all() and len(firsts) < 15
    model = lm_score.LogBilinear(counts, firsts)
    assert model.class_of[50] == model.class_of[51]
    pairs = rng.permutation(np.tile([[10, 50], [11, 51], [12, 52]], (6000, 1)))
    ids = pairs.ravel().astype(np.int32)
    windows = lm_score.windows_of(ids, np.array([len(ids)]), model.words)
    assert len(windows) == len(ids) and windows[5].tolist() == ids[[4, 3, 2, 5]].tolist()
    for seed in range(2):
        model.train(windows, seed)
    for first, right, wrong in ((10, 50, 51), (11, 51, 50)):
        sums = model.log_sums(np.array([12, 52, first, right, 12, 52, first, wrong]), np.array([0, 4]))
        assert sums[0] > sums[1] + 1
    texts = [np.array([3, 11, w]) for w in range(61)]
    sums = model.log_sums(np.concatenate(texts), np.arange(0, 183, 3))
    prefix = model.log_sums(np.array([3, 11]), np.array([0]))[0]
    assert abs(np.exp(sums - prefix).sum() - 1) < 1e-4


def test_every_place_is_learned_from_once(docs, monkeypatch):
    texts = [(i, f"w{i} " * (i % 20 + 1), "en", "s", 0) for i in range(50)]
    frame = docs.sparkSession.createDataFrame(texts, corpus.SCHEMA)
    counts = lm_score.count_words(frame)
    book = lm_score.dictionary(counts, counts.agg(F.sum("count")).first()[0])
    marked = frame.select("doc_id", "text", F.lit(True).alias("learn"), F.lit(False).alias("held_out"))
    known = docs.sparkSession.sparkContext.broadcast(book)
    encoded = marked.mapInArrow(lm_score._encode(known), lm_score._ENCODED)
    by_id = np.append(book.counts[np.argsort(book.ids)], book.class_counts[-1])
    def weights_of_tokens(batches):
        """Stands for the means: the first shared number grows by the tokens of the shards."""
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] < 0:
                    change = np.zeros(len(row["changes"]) // 2, np.float32)
                    change[0] = np.frombuffer(row["weights"], np.float32)[0]
                    column = pa.array([change.tobytes()], pa.binary())
                    yield pa.RecordBatch.from_pydict({"block": pa.array([-1], pa.int32()), "mean": column})

    monkeypatch.setattr(lm_score, "_mean_changes", weights_of_tokens)
    model = lm_score.LogBilinear(by_id, lm_score.first_ids(len(book.ids)))
    dense = model.dense()
    lm_score.train(encoded, model)
    total = sum(i % 20 + 2 for i in range(50))
    assert abs((model.dense() - dense)[0] - total) < 1e-3


def test_training_changes_hold_no_copy_of_all_rows():
    """A shard's changes are taken block by block; no copy of every word's row is held."""
    n = 1 << 16
    start = lm_score.LogBilinear(np.full(n + 1, 5), lm_score.first_ids(n))
    model = copy.deepcopy(start)
    model.vectors += 1
    model.word_targets += 1
    ids = (np.arange(1 << 16) % n).astype(np.int32)
    windows = lm_score.windows_of(ids, np.full(1 << 6, 1 << 10), n)
    tracemalloc.start()
    blocks = sum(1 for _ in lm_score._changes(start, model, windows))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert blocks == -(-(n + 1) // lm_score._BLOCK) + 1
    assert peak < start.rows().nbytes
