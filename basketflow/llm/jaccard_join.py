"""Joins documents whose sets of word n-grams have a Jaccard similarity above a threshold.

The search is T-occurrence search with DivideSkip. Two sets of sizes x and y link only if they
share T = ceil(p (x + y) / (100 + p)) grams, p being the threshold in percent. A set's inverted
lists are divided: its longest lists, p percent of them, are skipped and only the rest merged, for
a linked pair must meet in a list that both merge. Which lists are long is decided by a bitmap of
grams seen in many documents; any fixed order of grams gives right results, a good one short lists.
Spark's shuffle by gram merges the short lists. A pair whose merged count, and the most that the
skipped lists can add, reaches T is probed: the smaller set is looked up in the larger one by
binary search, and the pair is kept if it has T grams in common. Before that, bit signatures of about
two bits per gram are compared: bits that differ belong to grams that are not shared, so too many of
them rule a pair out without moving its sets.

A group of g near copies has g * g / 2 links, so links are not listed one by one. Equal sets are one
class from the start. Every merged list first pairs its members with its most central member only.
Verified links give components, and then a list pairs only the members outside its largest component
with all members of other components. Two members left unpaired are in one component already, so
no component is lost and no group is written out in pairs.

Grams and sets are known by 64-bit hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.shared import in_bitmap, key_bitmap, map_text, materialize, trimmed
from basketflow.llm.textbytes import mix, text_slices, words

WORDS = 5
PERCENT = 75
# So many times the grams that went behind are counted beyond them.
REACH = 3
# Grams that are merged for at least so many documents come later in the order, step by step.
LONG_LISTS = (4, 32, 256)
LONG_BITS = 26
SHARED_BITS = 27
NODE_BITS = 26


def gram_sets(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct gram hashes of every text of a slice."""
    found = words(data, offsets)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    count = len(found.hashes) - size + 1
    grams = np.zeros(max(count, 0), dtype=np.uint64)
    for i in range(size):
        if count > 0:
            grams += found.hashes[i : i + count] * factors[i]
    grams = mix(grams)
    sets = []
    for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if high - low >= size:
            part = np.sort(grams[low : high - size + 1])
            sets.append(part[np.concatenate(([True], part[1:] != part[:-1]))])
        elif high > low:
            whole = found.hashes[low:high] * factors[: high - low]
            sets.append(mix(whole.sum(keepdims=True) + factors[-1:] * np.uint64(high - low)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def _node(grams: np.ndarray) -> int:
    """One number for a whole set."""
    total = mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True)
    return int(mix(total + np.uint64(len(grams))).view(np.int64)[0])


def merged(size: int, percent: int = PERCENT) -> int:
    """How many lists of a set are merged; the others are skipped."""
    return size - -(-percent * size // 100) + 1


def _signature(grams: np.ndarray) -> bytes:
    """A bit for every gram, of a power of two of bits that is at least twice their number."""
    bits = np.zeros(1 << max(6, int(2 * len(grams) - 1).bit_length()), dtype=bool)
    bits[grams & np.uint64(len(bits) - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _apart(left: bytes, right: bytes) -> int:
    """At least so many grams are in one set only."""
    a, b = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    size = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(x.reshape(-1, size), axis=0) for x in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _sets_of(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, _, data, offsets in text_slices(column):
        yield from enumerate(gram_sets(data, offsets, size), first)


def _divided(grams: np.ndarray, long: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """The grams in the order of their lists' lengths, and the number with short lists."""
    level = np.zeros(len(grams), np.int8)
    for bitmap in long:
        level += in_bitmap(bitmap, grams)
    return grams[np.argsort(level, kind="stable")], int((level == 0).sum())


def _first_pass(size: int):
    """Per document its node and set size, and the signature where the node is new to the batch."""

    def run(batches):
        for batch in batches:
            nodes, sizes, marks, seen = [], [], [], set()
            for _, grams in _sets_of(batch.column(1), size):
                node = _node(grams) if len(grams) else None
                fresh = node is not None and node not in seen
                seen.add(node)
                nodes.append(node)
                sizes.append(len(grams))
                marks.append(_signature(grams) if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(marks, pa.binary()),
                ],
                names=["doc_id", "node", "n", "signature"],
            )

    return trimmed(run)


def _distinct_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(node, grams) of the distinct sets of a batch."""
    seen = set()
    for _, grams in _sets_of(batch.column(1), size):
        if len(grams) and (node := _node(grams)) not in seen:
            seen.add(node)
            yield node, grams


def _by_hash(size: int, percent: int):
    """(key, n): how many sets of a batch would merge a gram's list if the order were by hash."""

    def run(batches):
        for batch in batches:
            keys = [g[: merged(len(g), percent)] for _, g in _distinct_sets(batch, size)]
            if keys:
                key, count = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_pydict({"key": key.view(np.int64), "n": count})

    return trimmed(run)


def _beyond(long, size: int, percent: int):
    """(key, n) as by ``_by_hash``, of the grams that come next where grams went behind."""

    def run(batches):
        for batch in batches:
            keys = []
            for _, grams in _distinct_sets(batch, size):
                count = merged(len(grams), percent)
                ordered, _ = _divided(grams, long.value)
                gone = int((ordered[:count] > grams[count - 1]).sum())
                keys.append(grams[count : count + REACH * gone])
            if keys:
                key, count = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_pydict({"key": key.view(np.int64), "n": count})

    return trimmed(run)


def _moved_up(long, size: int, percent: int):
    """Grams that a set merges only because long lists went behind them."""

    def run(batches):
        for batch in batches:
            keys = []
            for _, grams in _distinct_sets(batch, size):
                count = merged(len(grams), percent)
                ordered, _ = _divided(grams, long.value)
                keys.append(ordered[:count][ordered[:count] > grams[count - 1]])
            if keys:
                key = np.unique(np.concatenate(keys))
                yield pa.RecordBatch.from_pydict({"key": key.view(np.int64)})

    return trimmed(run)


def _postings(long, shared, size: int, percent: int):
    """(key, node, n, pos, light) of the merged lists that may have another member."""

    def run(batches):
        for batch in batches:
            parts = {"key": [], "node": [], "n": [], "pos": [], "light": []}
            for node, grams in _distinct_sets(batch, size):
                ordered, light = _divided(grams, long.value)
                ordered = ordered[: merged(len(grams), percent)]
                pos = np.flatnonzero(in_bitmap(shared.value, ordered))
                parts["key"].append(ordered[pos].view(np.int64))
                parts["pos"].append(pos.astype(np.int32))
                parts["node"].append(np.full(len(pos), node, np.int64))
                parts["n"].append(np.full(len(pos), len(grams), np.int32))
                parts["light"].append(np.full(len(pos), light, np.int32))
            if parts["key"]:
                yield pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in parts.items()})

    return trimmed(run)


def _sets_with(nodes, size: int):
    """(node, grams) of the sets whose node is in the bitmap."""

    def run(batches):
        wanted = nodes.value
        for batch in batches:
            found = {}
            for _, grams in _sets_of(batch.column(1), size):
                if len(grams):
                    node = _node(grams)
                    if in_bitmap(wanted, np.array([node]).view(np.uint64))[0]:
                        found.setdefault(node, grams.tobytes())
            if found:
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array(found.keys(), pa.int64()), "grams": list(found.values())}
                )

    return trimmed(run)


def _only(nodes):
    """The rows whose first column is in the bitmap."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            yield batch.filter(pa.array(in_bitmap(nodes.value, keys)))

    return trimmed(run)


def _similar(percent: int):
    """Keeps the pairs that their signatures do not rule out."""

    def run(batches):
        for batch in batches:
            rows = zip(*[batch.column(i).to_pylist() for i in range(2, 6)])
            keep = [
                _apart(a, b) <= x + y - 2 * -(-percent * (x + y) // (100 + percent))
                for x, y, a, b in rows
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return trimmed(run)


def _probe(percent: int):
    """Keeps the pairs that have enough grams in common."""

    def run(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                a = np.frombuffer(left.as_buffer(), dtype=np.uint64)
                b = np.frombuffer(right.as_buffer(), dtype=np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append((100 + percent) * common >= percent * (len(a) + len(b)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return trimmed(run)


def _can_meet(percent: int):
    """Whether a pair can still reach T, given sizes and a gram at these places of both."""
    return F.expr(
        f"100 * least(n, n2) >= {percent} * greatest(n, n2) and "
        f"{100 + percent} * least(n - pos, n2 - pos2) >= {percent} * (n + n2)"
    )


def _candidates(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose merged count and skipped lists together can reach T."""
    met = (
        pairs.where(_can_meet(percent))
        .groupBy("node", "node2", "n", "n2")
        .agg(F.count("*").alias("met"), F.max("pos").alias("pos"), F.max("pos2").alias("pos2"))
    )
    most = "met + least(n - pos, n2 - pos2) - 1"
    return met.where(f"{100 + percent} * ({most}) >= {percent} * (n + n2)").select(
        "node", "node2", "n", "n2"
    )


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links reach, for every node that has a link.

    Every round takes the smallest label among neighbours and then the label of the label.
    """
    both = materialize(
        links.select("node", "node2")
        .union(links.select(F.col("node2").alias("node"), F.col("node").alias("node2")))
        .distinct(),
        "edges",
    )
    labels = both.groupBy("node").agg(F.least("node", F.min("node2")).alias("label"))
    labels = materialize(labels, "labels")
    while True:
        heard = (
            both.join(labels.withColumnRenamed("node", "node2"), "node2")
            .groupBy("node")
            .agg(F.min("label").alias("heard"))
        )
        lower = labels.join(heard, "node").select(
            "node", F.least("label", "heard").alias("label"), F.col("label").alias("old")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = materialize(
            lower.join(jump, "label", "left").select(
                "node", F.least("label", "next").alias("label"), "old"
            ),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.where("label < old").isEmpty():
            return labels


def jaccard_components(
    docs: DataFrame,
    size: int = WORDS,
    percent: int = PERCENT,
    long_lists: tuple[int, ...] = LONG_LISTS,
    keep_node: bool = False,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``, and ``node`` if it is kept.

    ``component_id`` is the smallest doc_id that links reach. A null or empty text, and one without
    a word, has no shingle and its own doc_id. Rows with one doc_id are separate documents that
    share their id; a null doc_id is kept and never the smallest. An empty table gives no rows.
    Columns other than doc_id and text are not read.
    """
    share = docs.sparkSession.sparkContext.broadcast
    texts = docs.select("doc_id", "text")
    nodes = materialize(
        texts.mapInArrow(
            _first_pass(size), "doc_id long, node long, n long, signature binary"
        ),
        "sets",
    )
    signatures = nodes.where("signature is not null").select("node", "signature")
    lists = texts.mapInArrow(_by_hash(size, percent), "key long, n long")
    lists = lists.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    lists = materialize(lists, "lists")
    long = _long(lists, long_lists)
    if long:
        more = texts.mapInArrow(_beyond(share(long), size, percent), "key long, n long")
        more = more.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= min(long_lists))
        more = _long(materialize(more, "lists"), long_lists)
        long = [a | b for a, b in zip(long, more)]
    long = share(long)
    # A list with one member by hash may have another that has moved it up, so both kinds count.
    moved = texts.mapInArrow(_moved_up(long, size, percent), "key long")
    shared = key_bitmap(lists, "key", SHARED_BITS) | key_bitmap(moved, "key", SHARED_BITS)
    postings = materialize(
        texts.mapInArrow(
            _postings(long, share(shared), size, percent),
            "key long, node long, n int, pos int, light int",
        ).distinct(),
        "postings",
    )
    central = F.struct((F.col("n") - F.col("light")) / F.col("n"), "n", "node", "pos")
    hubs = (
        postings.groupBy("key")
        .agg(F.count("*").alias("members"), F.max(central).alias("hub"))
        .where("members > 1")
        .select(
            "key",
            F.col("hub.node").alias("node2"),
            F.col("hub.n").alias("n2"),
            F.col("hub.pos").alias("pos2"),
        )
    )
    # Lists of one member, which the bitmap lets through, end here.
    listed = materialize(postings.drop("light").join(hubs, "key"), "listed")
    starred = materialize(_candidates(listed.where("node <> node2"), percent), "pairs")
    links = _linked(texts, starred, signatures, size, percent)
    labels = components(links)
    rest = materialize(_left_over(listed.select("key", "node", "n", "pos"), labels, starred, percent), "pairs")
    if not rest.isEmpty():
        labels = components(links.union(_linked(texts, rest, signatures, size, percent)))
    found = _labelled(nodes.select("doc_id", "node", "n"), labels)
    return found if keep_node else found.drop("node")


def _bitmap_of(pairs: DataFrame):
    """A broadcast bitmap of the nodes of both ends."""
    used = pairs.select(F.explode(F.array("node", "node2")).alias("node"))
    return pairs.sparkSession.sparkContext.broadcast(key_bitmap(used, "node", NODE_BITS))


def _long(lists: DataFrame, least: tuple[int, ...]) -> list[np.ndarray]:
    return [key_bitmap(lists.where(F.col("n") >= n), "key", LONG_BITS) for n in least]


def _linked(
    texts: DataFrame, pairs: DataFrame, signatures: DataFrame, size: int, percent: int
) -> DataFrame:
    """The pairs that are linked."""
    signatures = signatures.mapInArrow(
        _only(_bitmap_of(pairs)), "node long, signature binary"
    ).dropDuplicates(["node"])
    second = signatures.select(F.col("node").alias("node2"), F.col("signature").alias("signature2"))
    marked = pairs.join(second, "node2").join(signatures, "node")
    marked = marked.select("node", "node2", "n", "n2", "signature", "signature2")
    pairs = materialize(
        marked.mapInArrow(_similar(percent), "node long, node2 long"), "similar"
    )
    sets = materialize(
        texts.mapInArrow(_sets_with(_bitmap_of(pairs), size), "node long, grams binary").dropDuplicates(
            ["node"]
        ),
        "grams",
    )
    hubs = sets.select(F.col("node").alias("node2"), F.col("grams").alias("grams2"))
    probed = pairs.join(hubs, "node2").join(sets, "node").select(
        "node", "node2", "grams", "grams2"
    )
    return materialize(probed.mapInArrow(_probe(percent), "node long, node2 long"), "links")


def _left_over(
    postings: DataFrame, labels: DataFrame, done: DataFrame, percent: int
) -> DataFrame:
    """Candidate pairs of different components that the first round has not looked at."""
    marked = postings.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    marked = materialize(marked, "marked")
    sizes = marked.groupBy("key", "label").agg(
        F.count("*").alias("members"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    main = (
        sizes.groupBy("key")
        .agg(
            F.count("*").alias("labels"),
            F.max(F.struct("members", "label")).alias("main"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
        )
        .where("labels > 1")
        .select("key", F.col("main.label").alias("main"), "least", "most")
    )
    # A member can meet none of its list if even the smallest would need more grams than it has left.
    outside = marked.join(main, "key").where(
        f"label <> main and {100 + percent} * (n - pos) >= {percent} * (n + least)"
        f" and 100 * most >= {percent} * n"
    )
    outside = outside.drop("main", "least", "most")
    other = marked.select(
        "key",
        F.col("node").alias("node2"),
        F.col("label").alias("label2"),
        F.col("n").alias("n2"),
        F.col("pos").alias("pos2"),
    )
    pairs = _candidates(outside.join(other, "key").where("label <> label2"), percent)
    # Either end may have been the one outside; the sizes follow the ends.
    swap = F.col("node") > F.col("node2")
    ordered = [
        F.when(swap, F.col(b)).otherwise(F.col(a)).alias(a)
        for a, b in (("node", "node2"), ("node2", "node"), ("n", "n2"), ("n2", "n"))
    ]
    seen = done.select(*ordered[:2])
    return pairs.select(*ordered).distinct().join(seen, ["node", "node2"], "anti")


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    classes = nodes.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    known = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = materialize(known, "classes")
    smallest = known.groupBy("label").agg(F.min("first").alias("component_id"))
    by_node = known.join(smallest, "label").select("node", "component_id")
    return nodes.join(by_node, "node", "left").select(
        "doc_id",
        "node",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def with_node(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """Adds ``node``, the number of a text's set of grams; null for a text without a word."""

    def nodes(column: pa.Array) -> list[pa.Array]:
        return [pa.array([_node(g) if len(g) else None for _, g in _sets_of(column, size)], pa.int64())]

    return map_text(docs, nodes, {"node": "long"})
