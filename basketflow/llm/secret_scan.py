"""Finds secrets: three base patterns, and a character network over every other candidate.

A candidate is a run of at least ``SHORTEST`` characters ``[A-Za-z0-9+/_=-]`` with a letter and a
digit. The network reads it together with its surroundings. It learns from the labels of every
distinct candidate of all texts: those within base findings are secrets, all others are not; Spark
sums the gradients and the driver only takes the steps. Every candidate is also shown without its
surroundings, so that the network learns
what the value looks like and not only the name before it. On rows kept apart, its logit is
calibrated by a logistic fit, and the threshold is the highest probability at which it still finds
``recall`` of the secrets, of those with the name before them and of those with it blanked. Candidates from there on that overlap no base finding are ``learned``.
"""

import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.convnet import ConvNet, cut
from basketflow.llm.shared import map_text, materialize, trimmed
from basketflow.llm.spans import Span, byte_runs, code_points, digest, disjoint, joined, members, near, redact
from basketflow.llm.textbytes import mix, text_slices

# The base patterns and their shortest findings.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("learned",)
SHORTEST = 16
ROWS = 4000
STEPS, STEP_RATE = 60, 0.02
RECALL = 0.99
BEFORE, LENGTH = 24, 80
_PLACES = mix(np.arange(LENGTH // 8, dtype=np.uint64))
_CLASS = members(string.ascii_letters + string.digits + "+/_=-")
_HEX = members("0123456789abcdef")
_DIGIT = members(string.digits)
_LETTER = members(string.ascii_letters)


@dataclass
class SecretModel:
    net: ConvNet | None
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0
    # Candidates without and with a finding that fitting used, kept apart ones included.
    examples: tuple[int, int] = (0, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        logits = self.net.logits(windows)
        return _logistic(self.slope * (logits[:, 1] - logits[:, 0]) + self.shift)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _patterns(text: str) -> list[Span]:
    """assign and access findings of a text."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [
            Span("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST
        ]
    found += [
        Span("access", *m.span())
        for m in _ACCESS.finditer(text)
        if m.end() - m.start() >= ACCESS_LEAST
    ]
    return found


def _by_text(kind: str, data, offsets, starts, ends) -> list[tuple[int, Span]]:
    text = np.searchsorted(offsets, starts, side="right") - 1
    low = code_points(data, offsets, starts)
    high = low + (ends - starts)
    return [(t, Span(kind, a, b)) for t, a, b in zip(text.tolist(), low.tolist(), high.tolist())]


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def scan(column: pa.Array):
    """Per slice: its first row, base findings of every text, candidates and their windows.

    Candidates come as (text, span) with a window of LENGTH bytes that begins BEFORE bytes earlier.
    """
    for first, end, data, offsets in text_slices(column):
        texts = column.slice(first, end - first).to_pylist()
        base = [_patterns(text) if text else [] for text in texts]
        starts, ends = byte_runs(data, _HEX, offsets)
        long = ends - starts >= HEX_LEAST
        for text, span in _by_text("hex", data, offsets, starts[long], ends[long]):
            base[text].append(span)
        starts, ends = byte_runs(data, _CLASS, offsets)
        long = ends - starts >= SHORTEST
        starts, ends = starts[long], ends[long]
        digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
        letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
        mixed = (digits[ends] > digits[starts]) & (letters[ends] > letters[starts])
        starts, ends = starts[mixed], ends[mixed]
        found = _by_text("learned", data, offsets, starts, ends)
        low = np.maximum(starts - BEFORE, offsets[[t for t, _ in found]] if found else 0)
        stop = offsets[np.array([t for t, _ in found], np.int64) + 1] if found else ends
        windows = _windows(data, low, starts, stop)
        yield first, texts, [_ordered(b) for b in base], found, windows


def _windows(data, low, starts, stop) -> np.ndarray:
    """Surroundings and candidate; the candidate begins at the same place in every window."""
    if len(starts) == 0:
        return np.zeros((0, LENGTH), np.uint8)
    windows = np.zeros((len(starts), LENGTH), np.uint8)
    windows[:, BEFORE:] = cut(data, starts, stop, LENGTH - BEFORE)
    at = starts[:, None] - BEFORE + np.arange(BEFORE)
    windows[:, :BEFORE] = np.where(at >= low[:, None], data[np.maximum(at, 0)], 0)
    return windows


def _examples(column: pa.Array):
    """(within a base finding, digest, window) of every candidate."""
    for _, _, base, found, windows in scan(column):
        digests = mix(np.ascontiguousarray(windows).view(np.uint64) + _PLACES).sum(axis=1)
        by_text = [near(spans) for spans in base]
        for (t, s), digest, window in zip(found, mix(digests).view(np.int64).tolist(), windows):
            inside = any(b.start <= s.start and s.end <= b.end for b in by_text[t](s.start, s.end))
            yield inside, digest, (window.tobytes(), b"")


def candidates(docs: DataFrame) -> DataFrame:
    """(has, digest, window, held) of every distinct candidate window of all texts, stored.

    ``has``: within a base finding. A window is counted once per label; ``held`` (by its digest, 3
    in 10) keeps it apart for calibration.
    """

    def run(batches):
        for batch in batches:
            found = list(_examples(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([has for has, _, _ in found], pa.bool_()),
                    pa.array([d for _, d, _ in found], pa.int64()),
                    pa.array([w for _, _, (w, _) in found], pa.binary()),
                ],
                names=["has", "digest", "window"],
            )

    found = docs.select("text").where("text is not null")
    rows = found.mapInArrow(trimmed(run), "has boolean, digest long, window binary")
    rows = rows.dropDuplicates(["has", "digest"])
    return materialize(rows.withColumn("held", F.pmod(F.xxhash64("digest"), F.lit(10)) < 3), "candidates")


def fit(
    docs: DataFrame, rows: int = ROWS, recall: float = RECALL, seed: int = 5, steps: int = STEPS
) -> SecretModel:
    """A model from every candidate of all texts: those within base findings and all others.

    The network takes full-batch Adam steps on gradients that Spark sums over all candidates, each
    label weighing half; calibration and threshold come from all candidates kept apart. ``rows`` is
    how many windows a task handles at once. Without examples of both kinds the model finds nothing.
    """
    found = candidates(docs)
    counts = {(h, a): n for h, a, n in found.groupBy("held", "has").count().collect()}
    if not any(counts.get((h, True)) for h in (False, True)) or not any(
        counts.get((h, False)) for h in (False, True)
    ):
        return SecretModel(None, examples=(0, 0))
    if not all(counts.get((h, a)) for h in (False, True) for a in (False, True)):
        learn, apart = found, found
    else:
        learn, apart = found.where("not held"), found.where("held")
    by_label = {a: sum(n for (h, b), n in counts.items() if b == a and (learn is found or not h)) for a in (False, True)}
    net = ConvNet(2, LENGTH, filters=12)
    weights = np.array([0.25 / by_label[False], 0.25 / by_label[True]])
    state: dict = {}
    spark = docs.sparkSession
    for _ in range(steps):
        net.step(_summed_gradients(spark, learn, net, weights, rows), state, STEP_RATE)
    logits = _logit_rows(spark, apart, net, rows)
    slope, shift = _spread_logistic_fit(logits)
    every = tuple(sum(n for (_, b), n in counts.items() if b == a) for a in (False, True))
    model = SecretModel(net, slope, shift, examples=every)
    model.threshold = _spread_threshold(logits, model, recall)
    return model


def _window_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw = b"".join(batch.column("window").to_pylist())
    windows = np.frombuffer(raw, np.uint8).reshape(-1, LENGTH)
    return windows, np.array(batch.column("has").to_pylist(), np.int64)


def _summed_gradients(spark, learn: DataFrame, net: ConvNet, weights: np.ndarray, rows: int) -> dict:
    """Weighted gradient sums of windows and their bare copies, added up over all tasks."""
    shared = spark.sparkContext.broadcast(net)

    def run(batches):
        model, total = shared.value, None
        for batch in batches:
            windows, labels = _window_rows(batch)
            for low in range(0, len(labels), rows):
                some, truth = windows[low : low + rows], labels[low : low + rows]
                bare = some.copy()
                bare[:, :BEFORE] = 0
                both, twice = np.concatenate((some, bare)), np.tile(truth, 2)
                grads = model._gradients(both, twice, weights[twice])
                total = grads if total is None else {k: total[k] + grads[k] for k in total}
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.concatenate([total[k].ravel() for k in sorted(total)]).astype(np.float64).tobytes()])],
                names=["sums"],
            )

    summed = None
    for (part,) in learn.select("has", "window").mapInArrow(run, "sums binary").collect():
        flat = np.frombuffer(part, np.float64)
        summed = flat if summed is None else summed + flat
    grads, at = {}, 0
    for name in sorted(net.params):
        size = net.params[name].size
        grads[name] = (summed[at : at + size] if summed is not None else np.zeros(size)).reshape(
            net.params[name].shape
        ).astype(np.float32)
        at += size
    return grads


def _logit_rows(spark, apart: DataFrame, net: ConvNet, rows: int) -> DataFrame:
    """(x, y, nameless) of every candidate kept apart, shown and with its name blanked."""
    shared = spark.sparkContext.broadcast(net)

    def run(batches):
        model = shared.value
        for batch in batches:
            windows, labels = _window_rows(batch)
            for low in range(0, len(labels), rows):
                some, truth = windows[low : low + rows], labels[low : low + rows]
                bare = some.copy()
                bare[:, :BEFORE] = 0
                for nameless, shown in ((False, some), (True, bare)):
                    logits = model.logits(shown).astype(np.float64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(logits[:, 1] - logits[:, 0], pa.float64()),
                            pa.array(truth, pa.int64()),
                            pa.array([nameless] * len(truth), pa.bool_()),
                        ],
                        names=["x", "y", "nameless"],
                    )

    return materialize(apart.select("has", "window").mapInArrow(run, "x double, y long, nameless boolean"), "logits")


def _spread_logistic_fit(found: DataFrame) -> tuple[float, float]:
    """_logistic_fit over all candidates kept apart, its sums made by Spark."""
    w = np.array([1.0, 0.0])
    prior = np.diag([1.0, 0.1])
    for _ in range(25):
        z = F.col("x") * float(w[0]) + float(w[1])
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))))
        c = p * (1 - p)
        sums = found.agg(
            F.sum((p - F.col("y")) * F.col("x")), F.sum(p - F.col("y")),
            F.sum(c * F.col("x") * F.col("x")), F.sum(c * F.col("x")), F.sum(c),
        ).first()
        g0, g1, hxx, hx, h1 = [float(v or 0.0) for v in sums]
        gradient = np.array([g0, g1]) + prior @ (w - [1.0, 0.0])
        curve = np.array([[hxx, hx], [hx, h1]]) + prior
        w -= np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(w[0]), float(w[1])


def _spread_threshold(found: DataFrame, model: SecretModel, recall: float) -> float:
    """_kept of the secrets kept apart, shown and nameless, the smaller; exact order by Spark."""
    z = F.col("x") * model.slope + model.shift
    probability = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))))
    secrets = found.where("y = 1").withColumn("p", probability)
    kept = []
    for nameless in (False, True):
        some = secrets.where(F.col("nameless") == nameless)
        count = some.count()
        at = int((1 - recall) * count + 1e-9)
        kept.append(float(some.orderBy("p").offset(at).limit(1).first()["p"]))
    return min(kept)


def _calibrated(windows: np.ndarray, truth: np.ndarray, recall: float, seed: int) -> SecretModel:
    rng = np.random.default_rng(seed)
    held = rng.random(len(truth)) < 0.3
    if len(set(truth[held].tolist())) < 2 or len(set(truth[~held].tolist())) < 2:
        held = np.zeros(len(truth), bool)
    learn = ~held
    bare = windows[learn].copy()
    bare[:, :BEFORE] = 0
    net = ConvNet(2, LENGTH, filters=12).fit(
        np.concatenate((windows[learn], bare)), np.concatenate((truth[learn], truth[learn]))
    )
    apart = held if held.any() else learn
    shown = windows[apart]
    nameless = shown.copy()
    nameless[:, :BEFORE] = 0
    both, judged = np.concatenate((shown, nameless)), np.tile(truth[apart], 2)
    logits = net.logits(both)
    slope, shift = _logistic_fit(logits[:, 1] - logits[:, 0], judged)
    model = SecretModel(net, slope, shift)
    model.threshold = min(
        _kept(model.probabilities(some[truth[apart] == 1]), recall) for some in (shown, nameless)
    )
    return model


def _kept(probabilities: np.ndarray, recall: float) -> float:
    """The highest threshold that keeps ``recall`` of these; it is one of them."""
    return float(np.sort(probabilities)[int((1 - recall) * len(probabilities) + 1e-9)])


def _logistic_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit with a light pull towards slope 1, by Newton's method."""
    w = np.array([1.0, 0.0])
    design = np.stack((x.astype(float), np.ones(len(x))), axis=1)
    prior = np.diag([1.0, 0.1])
    for _ in range(25):
        p = _logistic(design @ w)
        gradient = design.T @ (p - y) + prior @ (w - [1.0, 0.0])
        curve = (design * (p * (1 - p))[:, None]).T @ design + prior
        w -= np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(w[0]), float(w[1])


def find(column: pa.Array, model: SecretModel) -> list[tuple[list[Span], list[Span]]]:
    """Base and learned findings of every text."""
    results: list[tuple[list[Span], list[Span]]] = []
    for _, texts, base, found, windows in scan(column):
        learned: list[list[Span]] = [[] for _ in texts]
        if model.net is not None and found:
            for i in np.flatnonzero(model.probabilities(windows) >= model.threshold):
                text, span = found[i]
                learned[text].append(span)
        results += [(b, disjoint(new, b)) for b, new in zip(base, learned)]
    return results


def scan_secrets(docs: DataFrame, model: SecretModel, drop_text: bool = False) -> DataFrame:
    """Adds n_assign, n_access, n_hex, base_sha256, spans, n_learned and redacted.

    A null text is empty: no findings, redacted null. Every row is handled on its own, so repeated
    rows give equal results. Columns of these names are replaced; all others are kept. With
    ``drop_text`` neither text nor redacted text comes back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def findings(column: pa.Array) -> list[pa.Array]:
        found = find(column, shared.value)
        arrays = [
            pa.array([sum(s.kind == kind for s in base) for base, _ in found], pa.int64())
            for kind in BASE_KINDS
        ]
        arrays.append(pa.array([digest(base) for base, _ in found], pa.string()))
        arrays.append(pa.array([joined(_ordered(b + new)) for b, new in found], pa.string()))
        arrays.append(pa.array([len(new) for _, new in found], pa.int64()))
        if not drop_text:
            pairs = zip(column.to_pylist(), found)
            clean = [t if not b and not n else redact(t, b + n) for t, (b, n) in pairs]
            arrays.append(pa.array(clean, pa.string()))
        return arrays

    added = {f"n_{kind}": "long" for kind in BASE_KINDS}
    added |= {"base_sha256": "string", "spans": "string", "n_learned": "long"}
    if not drop_text:
        added["redacted"] = "string"
    return map_text(docs, findings, added, drop_text=drop_text)


def redact_texts(docs: DataFrame, model: SecretModel) -> DataFrame:
    """``docs`` with every finding in the text replaced by its kind, in place of the text.

    Only the columns of ``docs`` come back, so no name can clash and no row holds two texts; n_chars,
    where it is a column, follows a changed text. A null text stays null. Rows are handled one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    text = names.index("text")
    length = names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            found = find(columns[text], shared.value)
            clean = columns[text].to_pylist()
            changed = [i for i, (base, new) in enumerate(found) if base or new]
            for i in changed:
                clean[i] = redact(clean[i], [*found[i][0], *found[i][1]])
            columns[text] = pa.array(clean, columns[text].type)
            if length is not None and changed:
                sizes = columns[length].to_pylist()
                for i in changed:
                    sizes[i] = len(clean[i])
                columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(trimmed(run), docs.schema)
