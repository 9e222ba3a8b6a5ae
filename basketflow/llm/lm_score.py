"""Scores texts by a log-bilinear language model, beside an add-one unigram model.

All training words are counted. The most frequent of them (a whole number of frequency steps, at
most ``dictionary`` words) are known to every task and have vectors of their own, as context and as
target; the others meet their counts in a join and share one class. A word w after a context c has the
probability softmax(q . c + b) over classes times softmax(v . c + d) over the words of its class, where
the context's vector c is a sum of linear images of the vectors of the last CONTEXT words. The end and
the commonest words are classes of one word; the other known words are cut by rank into about
sqrt(number / 3) classes, wider for rarer words, so both softmaxes stay short. Rarer and unseen words
have the add-one share of their class, so the probabilities of all words and one unseen word add up
to 1.

The vectors are trained by noise-contrastive estimation in numpy: shards of training texts, of about
SHARD tokens each, start from the same vectors and learn in parallel, and the weighted mean of their
changes is added for the next round. Rounds take turns at the places, so that every place of every
training text is learned from once and training grows with the corpus; shards depend on the documents
alone, not on the number of tasks. Scoring normalises over all classes, and over all words of the class, by batched matrix products.

Words are known by 64-bit hashes.
"""

import copy
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.shared import materialize
from basketflow.llm.textbytes import text_slices, words

DICTIONARY = 1 << 18
SINGLE_WORDS = 190
CONTEXT = 3
DIM = 16
SHARD = 1 << 23
ROUNDS = 2
NOISE = 64
WORD_NOISE = 4
_END = 0  # hash and class of the end
_CHUNK = 1 << 16
_ROWS = 1 << 11
_BLOCK = 1 << 12


@dataclass
class Dictionary:
    """Known words, sorted by hash, with their counts, classes and log10 shares of the class."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    shares: np.ndarray
    class_counts: np.ndarray  # training tokens of every class; the last is the rare class
    ids: np.ndarray | None = None  # ranks; the end is 0, and the rare class comes after the last

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of every hash, and whether it is there."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


def count_words(docs: DataFrame) -> DataFrame:
    """(word, count) of all words and ends of ``docs``, words as hashes."""

    def run(batches):
        for batch in batches:
            parts = [words(data, off).hashes for _, _, data, off in text_slices(batch.column(0))]
            hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
            hashes, counts = np.append(hashes, np.uint64(_END)), np.append(counts, batch.num_rows)
            yield pa.RecordBatch.from_pydict(
                {"word": hashes.view(np.int64), "count": counts.astype(np.int64)}
            )

    counted = docs.select("text").mapInArrow(run, "word long, count long")
    return counted.groupBy("word").agg(F.sum("count").alias("count"))


def dictionary(
    counts: DataFrame, total: int, size: int = DICTIONARY, singles: int = SINGLE_WORDS
) -> Dictionary:
    """The commonest words in whole steps of an eighth of a doubling; at most ``size`` of them."""
    step = F.floor(8 * F.log2("count"))
    steps = counts.where(F.col("word") != _END).groupBy(step.alias("step")).count().collect()
    lowest, known = None, 0
    for row in sorted(steps, reverse=True):
        known += row["count"]
        if known > size:
            break
        lowest = row["step"]
    chosen = F.col("word") == _END
    if lowest is not None:
        chosen = chosen | (step >= lowest)
    rows = [(r[0], r[1]) for r in counts.where(chosen).collect()]
    ends = dict(rows).get(_END, 0)
    ranked = sorted(((w, c) for w, c in rows if w != _END), key=lambda r: (-r[1], r[0]))
    hashes = np.array([_END] + [w for w, _ in ranked], np.int64).view(np.uint64)
    number = np.array([ends] + [c for _, c in ranked], np.int64)
    firsts = first_ids(len(number), singles)
    classes = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(number) + 1)))[:-1]
    class_counts = np.bincount(classes, number, len(firsts)).astype(np.int64)
    class_counts[-1] = total - number.sum()
    shares = np.log10(np.maximum(number, 1) / np.maximum(class_counts[classes], 1))
    order = np.argsort(hashes)
    return Dictionary(
        hashes[order], number[order], classes[order], shares[order], class_counts, order.astype(np.int32)
    )


def first_ids(number: int, singles: int = SINGLE_WORDS) -> np.ndarray:
    """The first id of every class of ``number`` known words and ends, and of the rare class."""
    low = min(number, singles + 1)
    groups = int(np.ceil(np.sqrt((number - low) / 3)))
    roots = np.linspace(np.sqrt(low), np.sqrt(number), groups, endpoint=False)
    bounds = np.unique(np.round(roots**2).astype(np.int64))
    return np.concatenate((np.arange(low), bounds, [number]))


class LogBilinear:
    """Scores of words, by id, from the last CONTEXT words; id ``words`` stands before a text.

    ``firsts`` has the first id of every class; by default every word is a class.
    """

    def __init__(self, counts: np.ndarray, firsts: np.ndarray | None = None, seed: int = 13):
        rng = np.random.default_rng(seed)
        self.words = len(counts)
        self.firsts = np.arange(self.words) if firsts is None else firsts
        self.classes = len(self.firsts)
        self.sizes = np.diff(np.append(self.firsts, self.words))
        self.class_of = np.repeat(np.arange(self.classes), self.sizes)
        smooth = np.add.reduceat(counts, self.firsts) + 0.5
        self.noise = smooth / smooth.sum()
        self.vectors = rng.normal(0, 0.1, (self.words + 1, DIM)).astype(np.float32)
        self.targets = rng.normal(0, 0.1, (self.classes, DIM)).astype(np.float32)
        self.turns = np.stack([np.eye(DIM, dtype=np.float32) * 0.5] * CONTEXT)
        self.bias = np.log(self.noise).astype(np.float32)
        self.word_targets = rng.normal(0, 0.1, (self.words, DIM)).astype(np.float32)
        within = np.add.reduceat(counts + 0.5, self.firsts)[self.class_of]
        self.word_bias = np.log((counts + 0.5) / within).astype(np.float32)
        self._tables: np.ndarray | None = None

    def dense(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.targets, self.turns, self.bias)])

    def rows(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """What every word from ``low`` to ``high`` has of its own, in a row: its vector, target and bias."""
        high = self.words + 1 if high is None else min(high, self.words + 1)
        own = np.zeros((high - low, 2 * DIM + 1), np.float32)
        own[:, :DIM] = self.vectors[low:high]
        inner = min(high, self.words) - low
        own[:inner, DIM:-1] = self.word_targets[low : low + inner]
        own[:inner, -1] = self.word_bias[low : low + inner]
        return own

    def load(self, dense: np.ndarray, rows: np.ndarray) -> "LogBilinear":
        at = 0
        for part in (self.targets, self.turns, self.bias):
            part[...] = dense[at : at + part.size].reshape(part.shape)
            at += part.size
        self.vectors[...] = rows[:, :DIM]
        self.word_targets[...] = rows[:-1, DIM:-1]
        self.word_bias[...] = rows[:-1, -1]
        self._tables = None
        return self

    def train(self, windows: np.ndarray, seed: int, rate: float = 0.05, batch: int = 1024) -> None:
        """One pass of AdaGrad on the noise-contrastive objective over (context ..., target) rows.

        A minibatch shares NOISE noise classes, drawn from the classes' frequencies; every target in a
        class of several words has WORD_NOISE noise words, drawn evenly from its class.
        """
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(windows))
        log_noise = np.log(NOISE * self.noise).astype(np.float32)
        log_even = np.log(WORD_NOISE / self.sizes).astype(np.float32)
        shared = (self.targets, self.turns, self.bias)
        past = [np.full_like(x, 1e-2) for x in shared]
        own_past = [np.full_like(x, 1e-2) for x in (self.vectors, self.word_targets, self.word_bias)]
        draws = rng.choice(self.classes, (len(windows) // batch + 1, NOISE), p=self.noise)
        for n, low in enumerate(range(0, len(windows), batch)):
            rows, noise = windows[order[low : low + batch]].astype(np.int64), draws[n]
            context, target = rows[:, :CONTEXT], rows[:, CONTEXT]
            group = self.class_of[target]
            seen = self.vectors[context].reshape(len(rows), CONTEXT * DIM)
            turns = self.turns.reshape(CONTEXT * DIM, DIM)
            hidden = seen @ turns
            own = (hidden * self.targets[group]).sum(axis=1) + self.bias[group]
            other = hidden @ self.targets[noise].T + self.bias[noise]
            up = 1 - _sigmoid(own - log_noise[group])
            down = -_sigmoid(other - log_noise[noise])
            back = up[:, None] * self.targets[group] + down @ self.targets[noise]
            pull = np.zeros((len(rows), self.classes), np.float32)
            pull[np.arange(len(rows)), group] = up
            grads = [pull.T @ hidden, None, pull.sum(axis=0)]
            np.add.at(grads[0], noise, down.T @ hidden)
            grads[2] += np.bincount(noise, down.sum(axis=0), self.classes).astype(np.float32)
            inner = np.flatnonzero(self.sizes[group] > 1)
            if len(inner):
                kind, lead = group[inner], hidden[inner]
                some = rng.random((len(inner), WORD_NOISE), np.float32) * self.sizes[kind][:, None]
                some = np.minimum(some.astype(np.int64), self.sizes[kind][:, None] - 1)
                some += self.firsts[kind][:, None]
                tried = np.concatenate((target[inner][:, None], some), axis=1)
                aims = self.word_targets[tried]
                scores = np.matmul(aims, lead[:, :, None])[:, :, 0] + self.word_bias[tried]
                error = -_sigmoid(scores - log_even[kind][:, None])
                error[:, 0] += 1
                back[inner] += np.matmul(error[:, None, :], aims)[:, 0]
                pushed = (error[:, :, None] * lead[:, None, :]).reshape(-1, DIM)
                flat = tried.ravel()
                _step(self.word_targets, own_past[1], flat, pushed, rate)
                _step(self.word_bias, own_past[2], flat, error.ravel(), rate)
            grads[1] = (seen.T @ back).reshape(self.turns.shape)
            moved = (back @ turns.T).reshape(-1, DIM)
            for x, grad, square in zip(shared, grads, past):
                grad /= len(rows)
                square += grad * grad
                x += rate * grad / np.sqrt(square)
            _step(self.vectors, own_past[0], context.ravel(), moved, rate)
        self._tables = None

    def log_sums(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For every text the sum of natural log probabilities of its words.

        ``ids`` are those of all texts one after the other, ``starts`` their first places.
        """
        if self._tables is None:
            self._tables = np.matmul(self.vectors, self.turns)
        place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
        scores = np.zeros(len(ids), np.float64)
        weights = self.targets.T.copy()
        for low in range(0, len(ids), _CHUNK):
            at = np.arange(low, min(low + _CHUNK, len(ids)))
            hidden = np.zeros((len(at), DIM), np.float32)
            for j in range(CONTEXT):
                hidden += self._tables[j][np.where(place[at] > j, ids[np.maximum(at - j - 1, 0)], self.words)]
            group = self.class_of[ids[at]]
            for some in range(0, len(at), _ROWS):
                rows = slice(some, some + _ROWS)
                logits = hidden[rows] @ weights
                logits += self.bias
                scores[at[rows]] = _log_softmax(logits, group[rows])
            order = np.argsort(group, kind="stable")
            kinds, begins = np.unique(group[order], return_index=True)
            for kind, begin, end in zip(kinds, begins, np.append(begins[1:], len(order))):
                first, size = self.firsts[kind], self.sizes[kind]
                for some in range(begin, end if size > 1 else begin, _ROWS):
                    rows = order[some : min(some + _ROWS, end)]
                    logits = hidden[rows] @ self.word_targets[first : first + size].T
                    logits += self.word_bias[first : first + size]
                    scores[at[rows]] += _log_softmax(logits, ids[at[rows]] - first)
        return np.add.reduceat(scores, starts) if len(starts) else scores


def _log_softmax(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The log probability of the chosen column of every row; ``logits`` are overwritten."""
    own = logits[np.arange(len(chosen)), chosen]
    top = logits.max(axis=1)
    logits -= top[:, None]
    np.exp(logits, out=logits)
    return own - top - np.log(logits.sum(axis=1))


def _step(part: np.ndarray, past: np.ndarray, at: np.ndarray, grads: np.ndarray, rate: float) -> None:
    """An AdaGrad step on rows of ``part`` that may come several times."""
    bits = len(at).bit_length()
    keys = np.sort(at << bits | np.arange(len(at)))
    order, at = keys & ((1 << bits) - 1), keys >> bits
    new = np.concatenate(([True], at[1:] != at[:-1]))
    place, at = np.empty(len(at), np.int64), at[new]
    place[order] = np.cumsum(new) - 1
    total, width = np.zeros((len(at), *part.shape[1:]), np.float32), grads[0].size
    flat = (place[:, None] * width + np.arange(width)).ravel()
    np.add.at(total.reshape(-1), flat, grads.ravel())
    square = past[at] + total * total
    past[at] = square
    part[at] += rate * total / np.sqrt(square)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _encode(known):
    """Per row its ids, sums over the known words and rare words."""

    def run(batches):
        book: Dictionary = known.value
        rare_id = len(book.counts)
        end_at, _ = book.find(np.array([_END], np.uint64))
        logs = np.log10(book.counts + 1)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            parts = {n: [] for n in ("tokens", "known", "logs", "ids")}
            rare = []
            for first, end, data, offsets in text_slices(batch.column(1)):
                found = words(data, offsets)
                at, there = book.find(found.hashes)
                ids = np.where(there, book.ids[at], rare_id).astype("<i4")
                sums = [
                    np.concatenate(([0.0], np.cumsum(np.where(there, x, 0.0))))[found.first]
                    for x in (np.ones(len(at)), logs[at])
                ]
                bounds = found.first.tolist()
                for i in range(end - first):
                    low, high = bounds[i], bounds[i + 1]
                    own = np.append(ids[low:high], np.int32(_END))
                    parts["tokens"].append(len(own))
                    parts["known"].append(int(sums[0][i + 1] - sums[0][i]))
                    parts["logs"].append(sums[1][i + 1] - sums[1][i] + logs[end_at[0]])
                    parts["ids"].append(own.tobytes())
                    rare.append(found.hashes[low:high][~there[low:high]].view(np.int64))
            count = batch.num_rows
            ends = np.cumsum([0] + [len(r) for r in rare])
            flat = np.concatenate(rare) if rare else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + count)),
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    *[pa.array(parts[n], pa.int64()) for n in ("tokens", "known")],
                    pa.array(parts["logs"], pa.float64()),
                    pa.array(parts["ids"], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                names=_ENCODED_NAMES,
            )
            row += count

    return run


_ENCODED_NAMES = ["row", "doc_id", "learn", "held_out", "n_tokens", "known", "logs", "ids", "rare"]
_ENCODED = (
    "row long, doc_id long, learn boolean, held_out boolean, n_tokens long, known long, logs double, "
    "ids binary, rare array<long>"
)


def windows_of(
    ids: np.ndarray, sizes: np.ndarray, before: int, first: int = 0, step: int = 1
) -> np.ndarray:
    """Every ``step``-th id of texts of these sizes after the CONTEXT ids in front, the last one first.

    Places within their texts are found for the chosen ids alone, by the starts of the texts.
    """
    starts = np.cumsum(sizes) - sizes
    at = np.arange(first, len(ids), step)
    place = at - starts[np.searchsorted(starts, at, side="right") - 1] if len(at) else at
    windows = np.empty((len(at), CONTEXT + 1), np.int32)
    for j in range(CONTEXT):
        column = ids[np.maximum(at - j - 1, 0)]
        column[place <= j] = before
        windows[:, j] = column
    windows[:, CONTEXT] = ids[at]
    return windows


_CHANGES = "block int, at binary, weights binary, changes binary"


def _changes(start: LogBilinear, model: LogBilinear, windows: np.ndarray):
    """What training changed, by block of words: places, how much each counts, and the changes.

    A word's vector counts as often as it is in a context, its target as often as it was tried.
    The changes are taken block by block, so that no copy of all rows is held.
    """
    yield -1, np.zeros(1, np.int32), np.full((1, 1), len(windows)), (model.dense() - start.dense())[None]
    number = model.words + 1
    weights = np.zeros((number, 2))
    for j in range(CONTEXT):
        weights[:, 0] += np.bincount(windows[:, j], minlength=number)
    targets = np.bincount(windows[:, CONTEXT], minlength=number - 1)
    tried = np.add.reduceat(targets, model.firsts) * WORD_NOISE / model.sizes
    weights[:-1, 1] = targets + tried[model.class_of]
    for low in range(0, number, _BLOCK):
        delta = model.rows(low, low + _BLOCK) - start.rows(low, low + _BLOCK)
        at = np.flatnonzero(delta.any(axis=1))
        if len(at):
            yield low // _BLOCK, at.astype(np.int32), weights[low + at], delta[at]


def _mean_changes(batches):
    """Weighted means of the changes of the blocks of a task."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            at = np.frombuffer(row["at"], np.int32)
            weights = np.frombuffer(row["weights"], np.float32).reshape(len(at), -1)
            delta = np.frombuffer(row["changes"], np.float16).reshape(len(at), -1)
            if row["block"] not in sums:
                size = 1 if row["block"] < 0 else _BLOCK
                sums[row["block"]] = np.zeros((size, delta.shape[1])), np.zeros((size, weights.shape[1]))
            total, weight = sums[row["block"]]
            each = np.repeat(weights, _widths(weights), axis=1) if weights.shape[1] > 1 else weights
            total[at] += delta * each.astype(float)
            weight[at] += weights
    for block, (total, weight) in sums.items():
        each = np.repeat(weight, _widths(weight), axis=1) if weight.shape[1] > 1 else weight
        mean = (total / np.maximum(each, 1e-9)).astype(np.float32)
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array([block], pa.int32()), "mean": pa.array([mean.tobytes()], pa.binary())}
        )


def _widths(weights: np.ndarray) -> list[int]:
    return [DIM, DIM + 1]


def train(encoded: DataFrame, model: LogBilinear, rounds: int = ROUNDS) -> LogBilinear:
    """The model after one pass over every place of the stored training texts, in ``rounds`` rounds.

    A round takes every ``rounds``-th place of a shard, from its own number on.
    """
    texts = encoded.where("learn").select("ids", "doc_id", "n_tokens")
    total = texts.agg(F.sum("n_tokens")).first()[0] or 0
    shards = int(-(-total // SHARD))
    if not shards:
        return model
    shard = F.pmod(F.xxhash64("doc_id", "n_tokens", "ids"), F.lit(shards))
    sharded = texts.withColumn("shard", shard)
    blocks = -(-(model.words + 1) // _BLOCK) + 1
    for number in range(rounds):
        shared = encoded.sparkSession.sparkContext.broadcast((model, number))

        def learn(part: pd.DataFrame) -> pd.DataFrame:
            start, number = shared.value
            part = part.sort_values(["doc_id", "n_tokens", "ids"])
            ids = np.frombuffer(b"".join(part["ids"]), np.int32)
            sizes, seed = part["n_tokens"].to_numpy(), 1000 * number + int(part["shard"].iloc[0])
            del part
            windows = windows_of(ids, sizes, start.words, number, rounds)
            del ids
            model = copy.deepcopy(start)
            model.train(windows, seed=seed)
            found = [
                (b, at.tobytes(), w.astype(np.float32).tobytes(), d.astype(np.float16).tobytes())
                for b, at, w, d in _changes(start, model, windows)
            ]
            return pd.DataFrame(found, columns=["block", "at", "weights", "changes"])

        results = sharded.groupBy("shard").applyInPandas(learn, _CHANGES)
        mean = results.repartition(blocks, "block").mapInArrow(_mean_changes, "block int, mean binary")
        dense, rows = model.dense(), model.rows()
        for block, raw in mean.collect():
            change = np.frombuffer(raw, np.float32)
            if block < 0:
                dense += change
            else:
                low = block * _BLOCK
                rows[low : low + _BLOCK] += change.reshape(_BLOCK, -1)[: len(rows) - low]
        model.load(dense, rows)
        shared.destroy()
    return model


def score(docs: DataFrame, learn_from, held_out, size: int = DICTIONARY) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``learn_from`` and ``held_out`` are boolean columns; where they are null the row is neither. A
    null text is empty: its only token is the end. Repeated rows are scored alike and count each in
    training. With nothing to learn from, no word is known and the model is that of the classes'
    smoothed frequencies. Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    marked = docs.select(
        "doc_id",
        "text",
        F.coalesce(learn_from, F.lit(False)).alias("learn"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    counts = materialize(count_words(marked.where("learn")), "words")
    total, types = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    book = dictionary(counts, total, size)
    known = spark.sparkContext.broadcast(book)
    encoded = materialize(marked.mapInArrow(_encode(known), _ENCODED), "encoded")
    known.destroy()
    by_id = np.append(book.counts[np.argsort(book.ids)], book.class_counts[-1])
    model = train(encoded, LogBilinear(by_id, first_ids(len(book.ids))))
    shared = spark.sparkContext.broadcast(model)

    def word_scores(batches):
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32)
            starts = np.cumsum(sizes) - sizes
            sums = shared.value.log_sums(ids, starts) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                batch.columns[1:] + [pa.array(sums)], names=_SCORED_NAMES
            )

    scored = encoded.select("ids", *_SCORED_NAMES[:-1]).mapInArrow(word_scores, _SCORED)
    rare = (
        encoded.select("row", F.explode("rare").alias("word"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.count("*").alias("rare_tokens"),
            F.count("count").alias("rare_known"),
            F.sum(F.log10(F.coalesce("count", F.lit(0)) + 1)).alias("rare_logs"),
        )
    )
    ends_known = int(book.counts[book.find(np.array([_END], np.uint64))[0][0]] > 0)
    rare_room = float(np.log10(book.class_counts[-1] + types - int((book.counts > 0).sum()) + 1))
    room = float(np.log10(total + types + 1))
    logs, tokens = F.coalesce("rare_logs", F.lit(0.0)), F.coalesce("rare_tokens", F.lit(0))
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + ends_known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * room).alias("base_score"),
        (F.col("word_score") + logs - tokens * rare_room).alias("score"),
    )


_SCORED_NAMES = ["n_tokens", "row", "doc_id", "held_out", "known", "logs", "word_score"]
_SCORED = (
    "n_tokens long, row long, doc_id long, held_out boolean, known long, logs double, "
    "word_score double"
)
