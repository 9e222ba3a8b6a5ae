"""Finds personal data: four base patterns, and a conditional random field for what they miss.

The field labels words by their shapes and those of their neighbours. It reads every word with a
digit or an @ together with ``AROUND`` words on either side, which is where its kinds can occur. It
is trained on the driver on a small labelled table, drawn by smallest hash from all texts: ``rows``
distinct sequences of words with a base finding, and ``rows`` around other words with a digit or an @. Words of one kind that
follow each other are one span. It is added if it overlaps no base finding and could be of its kind:
an address on both sides of an @, four numbers up to 255, a number with a right check digit, 8 to 15
digits in groups.
"""

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketflow.llm.crf import ChainField
from basketflow.llm.shared import map_text, sample_by_label
from basketflow.llm.spans import Span, digest, disjoint, joined, members, near, redact
from basketflow.llm.textbytes import text_slices, words

# The base patterns. Runs of digits are taken whole, so a failed one is not retried.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other",) + KINDS
ROWS = 2000
AROUND = 3
LONGEST = 128
FEATURES = 1 << 13
_BATCH = 1024
_MARKED = members("0123456789@")
_DIGITS = members("0123456789")


@dataclass
class PersonalModel:
    field: ChainField | None


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> list[Span]:
    """Every @ with an address on both sides; each character before it is looked at once."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(Span("email", start, domain.end()))
        done = domain.end() if domain else at + 1
        at = text.find("@", done)
    return found


def base_findings(text: str) -> list[Span]:
    """The base findings of a text, by kind and then by place."""
    found = _emails(text)
    for m in _IP.finditer(text):
        if all(int(part[-4:]) <= 255 and len(part.lstrip("0")) <= 3 for part in m[0].split(".")):
            found.append(Span("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits_of(m[0])
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            found.append(Span("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits_of(m[0])) <= 15:
            found.append(Span("phone", *m.span()))
    return found


def _shape(word: str) -> str:
    kinds = re.sub("[A-Z]", "A", re.sub("[0-9]", "9", re.sub("[a-z]", "a", word)))
    return re.sub(r"[^\x00-\x7f]", "u", kinds)


def _runs(shape: str, most: int) -> str:
    return re.sub(r"(.)\1+", lambda m: m[1] * min(len(m[0]), most), shape)


def _word_features(words_: list[str]) -> list[list[int]]:
    """Hashed shape features of every word of a sequence; unlike names share few numbers."""
    shapes = [_shape(w[:40]) for w in words_]
    short = ["<"] + [_runs(s, 1) for s in shapes] + [">"]
    rows = []
    for i, (word, shape) in enumerate(zip(words_, shapes)):
        digits = len(_digits_of(word[:40]))
        named = (
            f"s{_runs(shape, 4)}",
            f"r{short[i + 1]}",
            f"d{digits}",
            f"l{min(len(word), 20)}",
            f"p{shape[:2]}",
            f"e{shape[-2:]}",
            f"b{short[i]}|{short[i + 1]}",
            f"n{short[i + 1]}|{short[i + 2]}",
            "@" if "@" in word else f".{word.count('.')}",
        )
        rows.append([zlib.crc32(name.encode()) % FEATURES for name in named])
    return rows


@dataclass
class _Sequence:
    text: int
    words: list[str]
    places: list[tuple[int, int]]  # code points within the text


def _sequences(data, offsets, texts: list[str | None]) -> list[_Sequence]:
    """Words with a digit or an @ and those around them, at most LONGEST words each."""
    found = words(data, offsets, lower=False)
    if len(found.starts) == 0:
        return []
    marks = np.concatenate(([0], np.cumsum(_MARKED[data])))
    ends = np.append(found.starts[1:], len(data))
    flagged = np.flatnonzero(marks[ends] > marks[found.starts])
    near = np.unique((flagged[:, None] + np.arange(-AROUND, AROUND + 1)).ravel())
    near = near[(near >= 0) & (near < len(found.starts))]
    owner = np.searchsorted(found.first, near, side="right") - 1
    own = {}
    for f in flagged.tolist():
        own.setdefault(int(np.searchsorted(found.first, f, side="right") - 1), None)
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    sequences: list[_Sequence] = []
    last, last_text = -2, -1
    for word, text in zip(near.tolist(), owner.tolist()):
        if text not in own:
            continue
        fresh = word != last + 1 or text != last_text or len(sequences[-1].words) >= LONGEST
        if fresh:
            sequences.append(_Sequence(text, [], []))
        start = int(leads[found.starts[word]] - leads[offsets[text]])
        stop = int(leads[min(ends[word], offsets[text + 1])] - leads[offsets[text]])
        value = texts[text][start:stop].rstrip("\x20\t\n\x0b\x0c\r")
        sequences[-1].words.append(value)
        sequences[-1].places.append((start, start + len(value)))
        last, last_text = word, text
    return sequences


def _padded(sequences: list[_Sequence]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s.words) for s in sequences])
    rows = [_word_features(s.words) for s in sequences]
    width = len(rows[0][0])
    features = np.zeros((len(rows), int(sizes.max()), width), np.int64)
    for i, row in enumerate(rows):
        features[i, : len(row)] = row
    return features, sizes


def _scan(column: pa.Array):
    """Per slice: texts, base findings and word sequences."""
    for first, end, data, offsets in text_slices(column):
        texts = column.slice(first, end - first).to_pylist()
        marks = np.concatenate(([0], np.cumsum(_MARKED[data])))[offsets]
        some = (np.diff(marks) > 0).tolist()
        base = [base_findings(t) if has else [] for t, has in zip(texts, some)]
        yield texts, base, _sequences(data, offsets, texts)


def _examples(column: pa.Array):
    """(has a base finding, digest, features and labels) of every sequence."""
    for _, base, found in _scan(column):
        by_text = [near(spans) if spans else None for spans in base]
        for sequence in found:
            within = by_text[sequence.text]
            own = within(sequence.places[0][0], sequence.places[-1][1]) if within else []
            labels = [_label(place, own) for place in sequence.places]
            key = "\n".join(sequence.words).encode() + bytes(labels)
            digest = hashlib.blake2b(key, digest_size=8).digest()
            yield any(labels), int.from_bytes(digest, "little", signed=True), _Example(sequence.words, labels)


@dataclass
class _Example:
    words: list[str]
    labels: list[int]

    def __call__(self) -> tuple[bytes, bytes]:
        return np.array(_word_features(self.words), np.int32).tobytes(), bytes(self.labels)


def fit(docs: DataFrame, rows: int = ROWS) -> PersonalModel:
    """A field trained on at most ``rows`` sequences with a base finding and ``rows`` without.

    They are drawn by label, from all rows and any place in a text. Without a base finding nothing
    is learned and nothing added.
    """
    others, findings = sample_by_label(docs, _examples, rows)
    if not findings:
        return PersonalModel(None)
    sample = findings + others
    sizes = np.array([len(labels) for _, labels in sample])
    width = len(sample[0][0]) // (4 * len(sample[0][1]))
    features = np.zeros((len(sample), int(sizes.max()), width), np.int64)
    labels = np.zeros(features.shape[:2], np.int64)
    for i, (one, two) in enumerate(sample):
        features[i, : sizes[i]] = np.frombuffer(one, np.int32).reshape(-1, width)
        labels[i, : sizes[i]] = np.frombuffer(two, np.uint8)
    return PersonalModel(ChainField(len(LABELS), FEATURES).fit(features, labels, sizes))


def _label(place: tuple[int, int], base: list[Span]) -> int:
    """The kind of the base finding that covers most of a word; words half covered count."""
    for span in base:
        if 2 * (min(place[1], span.end) - max(place[0], span.start)) >= place[1] - place[0]:
            return LABELS.index(span.kind)
    return 0


def _possible(kind: str, value: str) -> bool:
    digits = _digits_of(value)
    if kind == "email":
        name, _, host = value.partition("@")
        return bool(_LOCAL.match(name)) and bool(re.fullmatch(r"[A-Za-z0-9-]{2,}", host))
    if kind == "ip":
        parts = re.split(r"[^0-9]+", value.strip("()[]"))
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and passes_luhn(digits) and not re.search("[A-Za-z]", value)
    grouped = re.search(r"[0-9][\x20().-]+[0-9]", value)
    return 8 <= len(digits) <= 15 and bool(grouped) and not re.search("[^0-9\\x20().+/-]", value)


def _added(sequence: _Sequence, path: list[int], text: str) -> list[Span]:
    found, i = [], 0
    while i < len(path):
        j = i + 1
        while j < len(path) and path[j] == path[i]:
            j += 1
        if path[i]:
            start, end = sequence.places[i][0], sequence.places[j - 1][1]
            value = text[start:end]
            start += len(value) - len(value.lstrip("\"'<[{,;:"))
            end -= len(value) - len(value.rstrip("\"'>]},;:.!?"))
            if start < end and _possible(LABELS[path[i]], text[start:end]):
                found.append(Span(LABELS[path[i]], start, end))
        i = j
    return found


def find(column: pa.Array, model: PersonalModel) -> list[tuple[list[Span], list[Span]]]:
    """Base and added findings of every text."""
    results: list[tuple[list[Span], list[Span]]] = []
    for texts, base, sequences in _scan(column):
        added: list[list[Span]] = [[] for _ in texts]
        if model.field is not None:
            sequences.sort(key=lambda s: len(s.words))
            for low in range(0, len(sequences), _BATCH):
                some = sequences[low : low + _BATCH]
                features, sizes = _padded(some)
                paths = model.field.decode(features, sizes)
                for sequence, size, path in zip(some, sizes, paths):
                    text, own = texts[sequence.text], base[sequence.text]
                    # Words of base findings are taken; they end a run of their neighbours.
                    free = [
                        0 if any(s.start < end and start < s.end for s in own) else label
                        for label, (start, end) in zip(path[:size].tolist(), sequence.places)
                    ]
                    added[sequence.text] += _added(sequence, free, text)
        results += [(b, disjoint(new, b)) for b, new in zip(base, added)]
    return results


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start, s.end))


def scan_personal_data(docs: DataFrame, model: PersonalModel, drop_text: bool = False) -> DataFrame:
    """Adds n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added and redacted.

    The counts are of base findings. A null text is empty: no findings, redacted null. Rows are
    handled one by one, so repeated rows give equal results. Columns of these names are replaced; all
    others are kept. With ``drop_text`` neither text nor redacted text comes back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def findings(column: pa.Array) -> list[pa.Array]:
        found = find(column, shared.value)
        arrays = [
            pa.array([sum(s.kind == kind for s in base) for base, _ in found], pa.int64())
            for kind in KINDS
        ]
        arrays.append(pa.array([digest(_ordered(base)) for base, _ in found], pa.string()))
        arrays.append(pa.array([joined(_ordered(b + new)) for b, new in found], pa.string()))
        arrays.append(pa.array([len(new) for _, new in found], pa.int64()))
        if not drop_text:
            pairs = zip(column.to_pylist(), found)
            clean = [t if not b and not n else redact(t, b + n) for t, (b, n) in pairs]
            arrays.append(pa.array(clean, pa.string()))
        return arrays

    added = {f"n_{kind}": "long" for kind in KINDS}
    added |= {"base_sha256": "string", "spans": "string", "n_added": "long"}
    if not drop_text:
        added["redacted"] = "string"
    return map_text(docs, findings, added, drop_text=drop_text)
