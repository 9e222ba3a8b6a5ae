"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary labelled texts, give every word of a text a
probability, alone by continuation counts (a word counts once for every word that it follows) and
after the word before it by bigram counts. Counts are discounted by one, two and more occurrences,
and what that frees goes to the same shares of both classes together, down to an even share of
unseen words. An expression that a class has hardly shown so takes nearly its shared share in both
models and says little by itself.

A text's two log-likelihoods are compared per word (their length-normalised difference), and so is
what of a word's difference exceeds the bounds in ``STRONG``: chance differences of common words
hardly do, the words of one class do. A logistic function of these means gives the score. It is
fitted on texts that the models had not seen: one half of the sample learns and the other is
scored, and the other way round; the final models learn from the whole sample.
"""

import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm import textbytes
from basketflow.llm.shared import map_text

# Bounds of what is learned from, per class: texts, and bytes of them.
ROWS, SAMPLE_BYTES = 8_000, 8 << 20
STRONG = (0.4, 0.7, 1.0, 1.3)  # log10 differences beyond which a word is evidence by itself
COLUMNS = 1 + 2 * len(STRONG)
_SCALE = 100.0  # sums are taken per so many words
_RIDGE = 1e-2
_NEXT = np.uint64(0x9E3779B97F4A7C15)
_MARK = np.uint64(1)
_PARTS = 64

# A word is a run of ASCII letters and digits, A-Z taken as a-z, and of all characters beyond ASCII.
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[128:] = True
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    _INSIDE[_low:_high] = True
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)


class Words(NamedTuple):
    hashes: np.ndarray
    starts: np.ndarray  # first byte of every word
    lengths: np.ndarray  # its bytes
    first: np.ndarray  # first word of every text, and the number of words


class Table(NamedTuple):
    """Numbers of the ordinary, the toxic and both texts per key; ``other`` those of every other key."""

    keys: np.ndarray
    values: np.ndarray
    other: np.ndarray

    def of(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.repeat(self.other[:, None], len(wanted), axis=1)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[:, at], self.other[:, None])


class Model(NamedTuple):
    own: list[Table]  # discounted share of a word (after its context)
    freed: list[Table]  # share of a context that goes to the shared counts
    weights: np.ndarray  # of the columns of ``differences``, and the constant


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    """All words of a slice of texts."""
    inside = _INSIDE[data]
    starts = textbytes.runs(inside, offsets)
    hashes = textbytes.run_hashes(data, inside, starts, textbytes._LOWER)
    outside = np.append(np.flatnonzero(~inside), len(data))
    ends = outside[np.searchsorted(outside, starts)]
    stops = offsets[np.searchsorted(offsets, starts, side="right")] if len(starts) else starts
    return Words(hashes, starts, np.minimum(ends, stops) - starts, np.searchsorted(starts, offsets))


def _pairs(words: Words) -> tuple[list, list]:
    """Sequences of one and two words, and the contexts of both, at every word."""
    before = np.full(len(words.hashes), _MARK)
    before[1:] = words.hashes[:-1]
    begins = words.first[:-1]
    before[begins[begins < len(before)]] = _MARK
    nothing = np.zeros(len(before), np.uint64)
    return [words.hashes, textbytes.mix(before * _NEXT + words.hashes)], [nothing, before]


def _cut(counts: np.ndarray) -> np.ndarray:
    """What is taken off every count: the discounts of 1, 2 and more from the counts of counts."""
    n = [max(float((counts == i).sum()), 1.0) for i in range(1, 5)]
    ratio = n[0] / (n[0] + 2 * n[1])
    taken = [i - (i + 1) * ratio * n[i] / n[i - 1] for i in (1, 2, 3)]
    bounded = np.array([0.0] + [min(max(d, 0.5), i - 0.02) for i, d in enumerate(taken, 1)])
    return np.minimum(bounded[np.minimum(counts, 3).astype(int)], counts)


def learn(places: list[tuple[list[np.ndarray], list[np.ndarray]]]) -> Model:
    """Models of ordinary, toxic and all texts from their (sequences, contexts) at every word."""
    own, freed = [], []
    for order in (0, 1):
        keys, first = np.unique(np.concatenate([g[order] for g, _ in places]), return_index=True)
        heads, back = np.unique(
            np.concatenate([x[order] for _, x in places])[first], return_inverse=True
        )
        shares, left = np.zeros((3, len(keys))), np.ones((3, len(heads)))
        counts = np.zeros((3, len(keys)))
        for c, (grams, _) in enumerate(places):
            here = grams[order]
            if order == 0:  # a word counts once for every word that it follows
                here = here[np.unique(grams[1], return_index=True)[1]]
            some, n = np.unique(here, return_counts=True)
            counts[c, np.searchsorted(keys, some)] = n
        counts[2] = counts[0] + counts[1]
        for c in range(3):
            total = np.bincount(back, counts[c], minlength=len(heads))
            cut = _cut(counts[c])
            np.divide(np.bincount(back, cut, minlength=len(heads)), total, out=left[c], where=total > 0)
            shares[c] = (counts[c] - cut) / np.maximum(total, 1)[back]
        # A pair that both classes together have shown once leaves its share to the shorter counts.
        kept = counts[2] > order
        own.append(Table(keys[kept], shares[:, kept].astype(np.float32), np.zeros(3)))
        freed.append(Table(heads, left.astype(np.float32), np.ones(3)))
    return Model(own, freed, np.zeros(1 + COLUMNS))


def word_differences(model: Model, words: Words) -> list[np.ndarray]:
    """log10 of the toxic share against the ordinary one, of every word alone and after its context."""
    found, shared = [], 1 / (len(model.own[0].keys) + 1)
    for gram, context, own, freed in zip(*_pairs(words), model.own, model.freed):
        share, rest = own.of(gram), freed.of(context)
        shared = share[2] + rest[2] * shared
        found.append(np.log10((share[1] + rest[1] * shared) / (share[0] + rest[0] * shared)))
    return found


def _models(texts: list[str], truth: np.ndarray) -> Model:
    return learn([_pairs(_all_words([t for t, y in zip(texts, truth) if y == c])) for c in (0, 1)])


def _all_words(texts: list[str]) -> Words:
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in raw], dtype=np.int64)))
    return split(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)


def differences(column: pa.Array, model: Model) -> np.ndarray:
    """Per text the means of its words' differences and of what exceeds the bounds in STRONG."""
    found = [np.zeros((0, COLUMNS))]
    for _, _, data, offsets in textbytes.text_slices(column):
        words = split(data, offsets)
        alone, after = word_differences(model, words)
        first, count = words.first[:-1], np.diff(words.first)
        filled = np.flatnonzero(count)
        means = np.zeros((len(count), COLUMNS))
        evidence = [alone, *[np.maximum(x - bound, 0) for x in (alone, after) for bound in STRONG]]
        if len(filled):  # texts are summed one by one, so that none depends on its neighbours
            sums = [np.add.reduceat(x, first[filled]) for x in evidence]
            means[filled] = np.column_stack(sums) * (_SCALE / count[filled, None])
        found.append(means)
    return np.concatenate(found)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _calibrate(features: np.ndarray, truth: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Weights of a logistic fit of rows that count ``each`` times, by Newton's method."""
    design = np.column_stack((features, np.ones(len(truth))))
    ridge = np.diag([_RIDGE] * features.shape[1] + [1e-6])
    weights = np.zeros(design.shape[1])
    for _ in range(50):
        p = _logistic(design @ weights)
        gradient = design.T @ (each * (p - truth)) + ridge @ weights
        curve = (design * (each * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curve, gradient)
        weights -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return weights


def _known(labels: DataFrame) -> DataFrame:
    rows = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("_of"))
    return rows.agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))


def labelled_texts(docs: DataFrame, labels: DataFrame, rows: int, size: int) -> DataFrame:
    """(text, toxic, digest): at most ``rows`` texts of either class, and ``size`` bytes of them.

    They are the texts of labelled documents whose doc_id and text have the smallest hashes. The hash
    cuts either class into parts, which are ranked apart and hold equal shares of both bounds.
    A doc_id with several labels is toxic if one of them says so. The choice is made without the
    texts, which are then read again for the chosen rows only.
    """
    texts = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").alias("_of"), "text", F.xxhash64("doc_id", "text").alias("digest")
    )
    part = F.pmod("digest", F.lit(_PARTS)).alias("part")
    keyed = texts.select("_of", "digest", part, F.octet_length("text").cast("bigint").alias("wide"))
    # Equal rows count once, so that a repeated document does not fill the sample.
    keyed = keyed.dropDuplicates(["_of", "digest"]).join(_known(labels), "_of")
    order = Window.partitionBy("toxic", "part").orderBy("digest", "_of")
    ranked = keyed.withColumn("at", F.row_number().over(order)).where(F.col("at") <= -(-rows // _PARTS))
    up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = ranked.withColumn("sum", F.sum("wide").over(up_to)).where(F.col("sum") <= size // _PARTS)
    # At most 2 * (rows + _PARTS) pairs of numbers.
    chosen = F.broadcast(chosen.select("_of", "digest", "toxic"))
    return texts.join(chosen, ["_of", "digest"]).dropDuplicates(["_of", "digest"]).select("text", "toxic", "digest")


def _fitted(texts: list[str], truth: np.ndarray, digests: np.ndarray, of: np.ndarray) -> Model:
    """The models, calibrated to the classes' numbers of labelled rows, which ``of`` has."""
    half = digests >> 7 & 1
    unseen = np.zeros((len(texts), COLUMNS))
    for part in (0, 1):
        inside, apart = half == part, half != part
        if len(set(truth[apart].tolist())) < 2:  # too few to hold some out
            apart = np.ones(len(texts), bool)
        other = _models([t for t, a in zip(texts, apart) if a], truth[apart])
        some = [t for t, i in zip(texts, inside) if i]
        unseen[inside] = differences(pa.array(some, pa.string()), other)
    each = (of / of.sum() * len(truth) / np.maximum(np.bincount(truth, minlength=2), 1))[truth]
    return _models(texts, truth)._replace(weights=_calibrate(unseen, truth, each))


def _fit_in_task(of: np.ndarray):
    def run(batches):
        texts, truth, digests = [], [], []
        for batch in batches:
            columns = batch.to_pydict()
            texts += columns["text"]
            truth += columns["toxic"]
            digests += columns["digest"]
        if len(set(truth)) == 2:
            model = pickle.dumps(_fitted(texts, np.array(truth), np.array(digests), of))
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    return run


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = ROWS, size: int = SAMPLE_BYTES
) -> Model | None:
    """Models of the bounded sample of ``labelled_texts``, made in one task.

    The sample has more of the rarer class than the labels have; the score is calibrated to the labels.
    None unless both classes are in it.
    """
    known = docs.where("text is not null").select(F.col("doc_id").alias("_of")).join(_known(labels), "_of")
    counts = known.agg(*[F.count_if(F.col("toxic") == c).alias(f"n{c}") for c in (0, 1)]).first()
    sample = labelled_texts(docs, labels, rows, size).repartition(1)
    sample = sample.sortWithinPartitions("toxic", "digest", "text")
    made = sample.mapInArrow(_fit_in_task(np.array([*counts], float)), "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else None


def score(docs: DataFrame, model: Model | None, drop_text: bool = False) -> DataFrame:
    """Adds ``score``, the probability of label 1, and ``predicted``, 1 from a score of 0.5 on.

    A null or empty text, or one without a word, has no difference and the score of the constant
    alone; without a model (a class had no examples) every score is 0. Rows are judged one by one, so
    repeated rows and ties get equal scores; an empty table gives no rows. Other columns pass
    through, those with the names of the two results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(column: pa.Array) -> list[pa.Array]:
        known = shared.value
        if known is None:
            result = np.zeros(len(column))
        else:
            x = differences(column, known)
            result = _logistic(x @ known.weights[:-1] + known.weights[-1])
        return [pa.array(result, pa.float64()), pa.array((result >= 0.5).astype(np.int32))]

    return map_text(docs, compute, {"score": "double", "predicted": "int"}, drop_text=drop_text)
