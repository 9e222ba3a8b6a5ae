"""Prefix trie of rebuilt conversations, by union-find over sorted neighbours.

A turn is known by the MD5 of its role and text. A conversation's digests in order are its sequence,
cut into pieces of ``PIECE`` turns so that a conversation of any length is spread over many rows; a
piece is told apart by its block number, a fingerprint of all pieces before it, and its own digests.
Pieces that share the first two are a trie of their own, whose root is the node at which they start.

Distinct pieces are sorted by range partitioning. Within a partition, neighbours are joined by edges
whose depth is the length of their longest common prefix, and union-find takes the edges in
descending depth: a merge makes or extends the branching node at that depth, and what lies between a
component's former top and the new one becomes a chain of nodes with one child. A component that
touches either end of its partition may go on beyond it; instead of taking part in a shallower merge
it is contracted to one item. The items of neighbouring partitions are merged by the same function,
in as many rounds as it takes until all fit one task; there is one item per branching node on the
paths of a partition's first and last piece, however many conversations it holds.

A long conversation's pieces are joined by their fingerprints. What lies below a full piece is added
up without going through the blocks one after another: the sums of every piece trie are attributed
to its smallest conversation, added up along each conversation, and given to its pieces.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.shared import materialize
from basketflow.operators.ranking import dense_positions

GROUP, MOST_TAKEN = 100, 6  # conversations of one base, and the modulus of the turns taken from it
PIECE = 256
STRETCH = 4096  # pieces of a conversation that are summed up together
TASK_ROWS, TASK_BYTES = 50_000, 16 << 20  # pieces of a range partition
TOGETHER, FAN_IN = 100_000, 64  # items that one task merges at the end, and partitions merged before
_WIDTH = 16

# What an item has that takes part in a merge, and a node that is complete. ``end_one`` is the only
# conversation that ends at a node, ``end_many`` the digest of the piece that several end with.
_ITEM = {
    "seq": "binary",
    "block": "int",
    "p1": "long",
    "p2": "long",
    "lens": "array<long>",
    "depth": "int",
    "n": "long",
    "conv": "long",
    "children": "long",
    "leaves": "long",
    "below": "long",
    "full": "boolean",
    "end_one": "long",
    "end_many": "binary",
    "next_key": "binary",
}
_NODE = {
    "block": "int",
    "depth": "int",
    "n": "long",
    "conv": "long",
    "parent": "long",
    "children": "long",
    "leaves": "long",
    "saved": "long",
    "end_one": "long",
    "end_many": "binary",
    "key": "binary",
    "parent_key": "binary",
    "next_key": "binary",
}
_PARENT, _SAVED, _PARENT_KEY = (list(_NODE).index(c) for c in ("parent", "saved", "parent_key"))
_PLACE = {"is_item": "boolean", "part": "int", "at": "int"}
_ALL = {**_PLACE, **_ITEM, **_NODE}
_TYPES = {
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
}
_ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in _ALL.items()])
_DDL = ", ".join(f"{name} {kind}" for name, kind in _ALL.items())
_BATCH = 5000


def _key(block: int, p1: int, p2: int, prefix: bytes) -> bytes:
    return hashlib.md5(b"%d:%d:%d:" % (block, p1, p2) + prefix).digest()


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences have in common at their start."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // _WIDTH
    low = 0
    while a[low : low + _WIDTH] == b[low : low + _WIDTH]:
        low += _WIDTH
    return low // _WIDTH


class Forest:
    """Union-find over one stretch of sorted items; nodes that are complete, and contracted items."""

    def __init__(self, items: list[dict], open_ends: bool, named: bool):
        self.items, self.named = items, named
        self.up = list(range(len(items)))
        self.low = list(range(len(items)))  # first item of a component, by its root
        self.children: list[list[int]] = [[] for _ in items]  # rows that wait for their parent
        self.left, self.right = set(), set()
        self.rows: list[list] = []
        self.contracted: list[tuple[int, dict]] = []
        edges: dict[int, list[int]] = {}
        starts = [0] if items else []
        for i in range(1, len(items)):
            a, b = items[i - 1], items[i]
            if (a["block"], a["p1"], a["p2"]) == (b["block"], b["p1"], b["p2"]):
                edges.setdefault(_common(a["seq"], b["seq"]), []).append(i)
            else:
                starts.append(i)
        if open_ends and items:
            self.left.add(0)
            self.right.add(len(items) - 1)
        for depth in sorted(edges, reverse=True):
            for i in edges[depth]:
                self.merge(self.find(i - 1), self.find(i), depth)
        done: set[int] = set()
        gone = {at for at, _ in self.contracted}
        for i in range(len(items)):
            root = self.find(i)
            if root in done or self.low[root] in gone:
                continue
            done.add(root)
            if root in self.left or root in self.right:
                self.contract(root)
            else:
                self.lift(root, 0)
                self.row(root, 0, self.items[root]["children"], 0, True)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def merge(self, a: int, b: int, depth: int) -> None:
        """Join component ``a`` and the one to its right in a node at ``depth``."""
        live = []
        for x in (a, b):
            if self.items[x]["depth"] == depth:
                live.append(x)
            elif x in self.left or x in self.right:
                self.contract(x)
            else:
                self.lift(x, depth)
                live.append(x)
        if len(live) == 2:
            self.union(a, b)
        elif live == [b]:
            self.left.add(b)
        elif live == [a]:
            self.right.add(a)

    def union(self, a: int, b: int) -> None:
        one, other = self.items[a], self.items[b]
        if len(self.children[a]) < len(self.children[b]):
            self.children[a], self.children[b] = self.children[b], self.children[a]
        self.children[a] += self.children[b]
        self.children[b] = []
        for name in ("n", "children", "leaves", "below"):
            one[name] += other[name]
        one["conv"] = min(one["conv"], other["conv"])
        one["full"] = one["full"] or other["full"]
        for name in ("end_one", "end_many", "next_key"):
            if one[name] is None:
                one[name] = other[name]
        self.up[b] = a
        for side in (self.left, self.right):
            if b in side:
                side.add(a)

    def leaves(self, item: dict) -> int:
        return item["leaves"] + (not item["children"] and not item["full"])

    def row(self, root: int, depth: int, children: int, saved: int, top: bool) -> None:
        """A complete node; ``top`` is the component's own, others are of the chain above it."""
        item = self.items[root]
        block, prefix = item["block"], item["seq"][: depth * _WIDTH]
        own = None
        if self.named or (depth == 0 and block > 0):
            own = _key(block, item["p1"], item["p2"], prefix)
        if top:
            saved = item["below"] + (item["n"] - 1) * (item["lens"][depth - 1] if depth else 0)
            for child in self.children[root]:
                self.rows[child][_PARENT] = item["conv"]
        ends = (item["end_one"], item["end_many"]) if top else (None, None)
        self.rows.append(
            [block, depth, item["n"], item["conv"], None, children, self.leaves(item), saved, *ends]
            + [own, None, item["next_key"] if top else None]
        )
        if top:
            self.children[root] = []

    def lift(self, root: int, depth: int) -> None:
        """Make the component's top the node at ``depth``; nodes below it are complete."""
        item = self.items[root]
        start, lens = item["depth"], item["lens"]
        if start <= depth:
            return
        self.row(root, start, item["children"], 0, True)
        leaves, saved = self.leaves(item), self.rows[-1][_SAVED]
        item.update(end_one=None, end_many=None, next_key=None, full=False, leaves=leaves, children=1)
        for at in range(start - 1, depth, -1):
            self.rows[-1][_PARENT] = item["conv"]
            saved += (item["n"] - 1) * lens[at - 1]
            self.row(root, at, 1, saved, False)
        self.children[root] = [len(self.rows) - 1]
        item.update(depth=depth, below=saved)

    def contract(self, root: int) -> None:
        """Keep the component for the next round; its nodes' parents are looked up by their key."""
        item = self.items[root]
        prefix = item["seq"][: item["depth"] * _WIDTH]
        key = _key(item["block"], item["p1"], item["p2"], prefix)
        for child in self.children[root]:
            self.rows[child][_PARENT_KEY] = key
        self.children[root] = []
        kept = {**item, "seq": prefix, "lens": item["lens"][: item["depth"]]}
        self.contracted.append((self.low[root], kept))


def _results(forest: Forest, part: int) -> Iterator[pa.RecordBatch]:
    names = list(_NODE)
    found = [{"is_item": False, **dict(zip(names, row))} for row in forest.rows]
    found += [{"is_item": True, "part": part, "at": at, **item} for at, item in forest.contracted]
    for low in range(0, len(found), _BATCH):
        some = found[low : low + _BATCH]
        columns = [pa.array([r.get(f.name) for r in some], f.type) for f in _ARROW]
        yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _of_partitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of the sorted pieces of a range partition."""
    items = [item for batch in batches for item in batch.select(list(_ITEM)).to_pylist()]
    yield from _results(Forest(items, True, False), TaskContext.get().partitionId())


def _of_items(last: bool):
    """The forests of contracted items, one per ``part``, which come one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, items = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    if items:
                        yield from _results(Forest(items, not last, True), part)
                    part, items = row["part"], []
                items.append({name: row[name] for name in _ITEM})
        if items:
            yield from _results(Forest(items, not last, True), part)

    return run


def nodes_of(pieces: DataFrame, together: int = TOGETHER, fan_in: int = FAN_IN) -> DataFrame:
    """The nodes of the tries of distinct ``pieces``, with a ``parent`` (null for roots).

    ``pieces`` are stored and have the columns of an item.
    """
    size = pieces.agg(F.count("*").alias("n"), F.sum(F.octet_length("seq")).alias("b")).first()
    wanted = max(-(-size["n"] // TASK_ROWS), -(-(size["b"] or 0) // TASK_BYTES))
    default = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(wanted, min(default, -(-size["n"] // 1000)), 1)
    order = ["block", "p1", "p2", "seq"]
    placed = pieces.select(*_ITEM).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stored = materialize(placed.mapInArrow(_of_partitions, _DDL), "forest")
    complete, later = stored.where("not is_item").select(*_NODE), None
    while True:
        items = stored.where("is_item")
        last = items.count() <= together or parts <= fan_in
        group = F.lit(0) if last else F.floor(F.col("part") / fan_in).cast("int")
        merged = items.withColumn("_group", group)
        merged = merged.repartition("_group").sortWithinPartitions("_group", "part", "at")
        merged = merged.select(F.col("_group").alias("part"), *_ITEM)
        stored = materialize(merged.mapInArrow(_of_items(last), _DDL), "forest")
        found = stored.where("not is_item").select(*_NODE)
        later = found if later is None else later.unionByName(found)
        if last:
            break
        parts = -(-parts // fan_in)
    # Children of nodes that took shape in a later round find them by their key.
    parents = later.select(F.col("key").alias("parent_key"), F.col("conv").alias("_parent"))
    every = complete.unionByName(later)
    waiting = every.where("parent_key is not null").join(parents, "parent_key").withColumn("parent", F.col("_parent"))
    return every.where("parent_key is null").unionByName(waiting.select(*_NODE))


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): the turns of every conversation, numbered from 1, stored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    keyed = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct("turn", digest.alias("digest"), F.monotonically_increasing_id().alias("nth")).alias("key"),
        F.length(text).cast("bigint").alias("chars"),
    )
    keyed = materialize(keyed, "turns")
    placed = dense_positions(keyed, keyed.select("conv_id", "key"), "conv_id", "key")
    return materialize(placed.select("conv_id", "pos", F.col("key.digest").alias("digest"), "chars"), "placed")


def rebuilt_pieces(placed: DataFrame, piece: int) -> DataFrame:
    """(conv_id, block, seq, lens): the pieces of every rebuilt conversation, stored.

    A conversation whose length is a multiple of ``piece``, zero included, ends with an empty piece.
    """
    first = F.struct("pos", "digest", "chars")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = (
        placed.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < MOST_TAKEN))
        .groupBy(F.col("conv_id").alias("_base"))
        .agg(F.array_sort(F.collect_list(first)).alias("_head"))
    )
    taken = F.crc32(F.col("conv_id").cast("string")) % MOST_TAKEN
    convs = placed.select("conv_id").distinct().withColumn("_taken", taken).withColumn("_base", base)
    convs = convs.join(heads, "_base", "left").select(
        "conv_id",
        "_taken",
        F.coalesce(F.slice("_head", F.lit(1), F.col("_taken").cast("int")), F.array().cast("array<struct<pos:bigint,digest:binary,chars:bigint>>")).alias("_head"),
    )
    convs = materialize(convs, "conversations")
    shifts = convs.select("conv_id", "_taken", (F.size("_head") - F.col("_taken")).alias("_shift"))
    own = placed.join(shifts, "conv_id").where(F.col("pos") > F.col("_taken"))
    at = F.col("pos") + F.col("_shift")
    here = F.struct(
        F.floor((at - 1) / piece).cast("int").alias("block"),
        F.array(F.struct(at.alias("pos"), "digest", "chars")).alias("items"),
    )
    nothing = F.slice(here["items"], 1, 0)
    after = F.struct(F.floor(at / piece).cast("int").alias("block"), nothing.alias("items"))
    entries = F.when(at % piece == 0, F.array(here, after)).otherwise(F.array(here))
    own = own.select("conv_id", F.inline(entries))
    whole = convs.select("conv_id", F.lit(0).alias("block"), F.col("_head").alias("items"))
    items = F.array_sort(F.flatten(F.collect_list("items")))
    seq = F.unhex(F.array_join(F.transform("items", lambda x: F.hex(x["digest"])), ""))
    pieces = (
        own.unionByName(whole)
        .groupBy("conv_id", "block")
        .agg(items.alias("items"))
        .select("conv_id", "block", seq.alias("seq"), F.transform("items", lambda x: x["chars"]).alias("lens"))
    )
    return materialize(pieces, "pieces")


def _running(rows: DataFrame, merge, add, columns: list[str], descending: bool) -> DataFrame:
    """The columns replaced by what ``merge`` makes of the conversation's blocks before (or after).

    Stretches of blocks are merged apart and put together by ``add``, so that no task orders a whole
    long conversation.
    """

    def before(order: str, *group: str):
        by = F.desc(order) if descending else F.asc(order)
        return Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)

    rows = rows.withColumn("_stretch", F.floor(F.col("block") / STRETCH))
    sums = rows.groupBy("conv_id", "_stretch").agg(*[merge(c).alias(c) for c in columns])
    over = before("_stretch", "conv_id")
    sums = sums.select(
        "conv_id", "_stretch", *[F.coalesce(merge(c).over(over), F.lit(0)).alias(f"_{c}") for c in columns]
    )
    over = before("block", "conv_id", "_stretch")
    inner = rows.withColumns({c: F.coalesce(merge(c).over(over), F.lit(0)) for c in columns})
    both = inner.join(sums, ["conv_id", "_stretch"])
    return both.select("conv_id", "block", *[add(F.col(c), F.col(f"_{c}")).alias(c) for c in columns])


def _digest(block: Column, p1: Column, p2: Column, seq: Column) -> Column:
    """The key of the node that a piece ends at, as ``_key`` has it."""
    start = F.concat_ws(":", *[c.cast("string") for c in (block, p1, p2)], F.lit(""))
    return F.unhex(F.md5(F.concat(start.cast("binary"), seq)))


def _distinct(pieces: DataFrame, piece: int) -> DataFrame:
    """The distinct pieces as items, with what lies below full ones, stored."""
    full, only = F.size("lens") == piece, (F.size("lens") < piece) & (F.col("n") == 1)
    several = (F.size("lens") < piece) & (F.col("n") > 1)
    after = _digest(F.col("block") + 1, F.col("p1").bitwiseXOR(F.col("x1")), F.col("p2").bitwiseXOR(F.col("x2")), F.lit(b""))
    names = ("seq", "block", "p1", "p2", "x1", "x2", "lens")
    found = pieces.groupBy("gid").agg(
        *[F.first(c).alias(c) for c in names],
        F.count("*").alias("n"),
        F.min("conv_id").alias("conv"),
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("below"),
    )
    made = {
        "depth": F.size("lens"),
        "children": F.lit(0).cast("bigint"),
        "full": full,
        "end_one": F.when(only, F.col("conv")),
        "end_many": F.when(several, F.col("gid")),
        "next_key": F.when(full, after),
    }
    return materialize(found.withColumns(made).select(*_ITEM), "distinct-pieces")


def _with_prefixes(pieces: DataFrame, piece: int) -> tuple[DataFrame, bool]:
    """Pieces with their fingerprints, digests and zeros for what lies below; whether any is full."""
    own = {f"x{i}": F.xxhash64(F.lit(i), "block", "seq") for i in (1, 2)}
    pieces = pieces.withColumns(own)
    several = not pieces.where("block > 0").isEmpty()
    if several:
        xors = pieces.select("conv_id", "block", F.col("x1").alias("p1"), F.col("x2").alias("p2"))
        before = _running(xors, F.bit_xor, lambda a, b: a.bitwiseXOR(b), ["p1", "p2"], False)
        pieces = pieces.join(before, ["conv_id", "block"])
    else:
        pieces = pieces.withColumns({c: F.lit(0).cast("bigint") for c in ("p1", "p2")})
    gid = _digest(F.col("block"), F.col("p1"), F.col("p2"), F.col("seq"))
    zeros = {c: F.lit(0).cast("bigint") for c in ("leaves", "saved")}
    return materialize(pieces.withColumn("gid", gid).withColumns(zeros), "pieces"), several


def _with_below(pieces: DataFrame, piece: int, **merging) -> DataFrame:
    """``leaves`` and ``saved`` of the piece tries below, at the smallest conversation of each."""
    tries = nodes_of(_distinct(pieces.where("block > 0"), piece), **merging).where("depth = 0")
    tries = tries.select(F.col("conv").alias("conv_id"), "block", "leaves", "saved")
    own = pieces.select("conv_id", "block").join(tries, ["conv_id", "block"], "left").fillna(0, ["leaves", "saved"])
    below = _running(own, F.sum, lambda a, b: a + b, ["leaves", "saved"], True)
    return materialize(pieces.drop("leaves", "saved").join(below, ["conv_id", "block"]), "pieces")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined texts of the sorted conversations of every piece, cut at some size."""
    gid, first, ids = None, None, []

    def out():
        text = ",".join(map(str, ids))
        return pa.RecordBatch.from_arrays(
            [pa.array([gid], pa.binary()), pa.array([first], pa.int64()), pa.array([text])],
            names=["gid", "first", "text"],
        )

    for batch in batches:
        for one, conv in zip(batch.column("gid").to_pylist(), batch.column("conv_id").to_pylist()):
            if one != gid or len(ids) == _BATCH:
                if ids:
                    yield out()
                gid, first, ids = one, conv, []
            ids.append(conv)
    if ids:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of every piece, which come one after another."""
    gid, state = None, None

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([gid], pa.binary()), pa.array([state.hexdigest()])], names=["gid", "sha"]
        )

    for batch in batches:
        for one, text in zip(batch.column("gid").to_pylist(), batch.column("text").to_pylist()):
            if one != gid:
                if state is not None:
                    yield out()
                gid, state = one, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state is not None:
        yield out()


def end_hashes(members: DataFrame) -> DataFrame:
    """(gid, sha): SHA-256 of the ascending conv_ids of every gid.

    They are sorted over all tasks, however many share a gid, and arrive joined in long texts. The
    hash of one gid is a chain by definition, so a single task takes its texts in one by one.
    """
    size = members.count()
    default = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-size // 1_000_000), min(default, -(-size // 5000)), 1)
    ordered = members.repartitionByRange(parts, "gid", "conv_id").sortWithinPartitions("gid", "conv_id")
    texts = ordered.mapInArrow(_joined, "gid binary, first long, text string")
    together = texts.repartition("gid").sortWithinPartitions("gid", "first")
    return together.mapInArrow(_hashed, "gid binary, sha string")


def trie(
    rows: DataFrame, piece: int = PIECE, together: int = TOGETHER, fan_in: int = FAN_IN
) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations.

    ``rows`` need conv_id, turn, role and text; other columns are not read. A conversation c is rebuilt
    from the first h turns of c - c % 100, h = crc32(c as text) % 6, and its own turns after its first h.
    Turns are ordered by turn, null first, and equal ones by the MD5 of role and text; a repeated row
    is one more turn. A null role or text is empty. Rows without a conv_id take no part, and an empty
    table has no nodes, not even a root. Columns: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. ``piece``, ``together`` and ``fan_in``
    say how the work is cut and do not change the result.
    """
    if piece < MOST_TAKEN:
        raise ValueError(f"piece must be at least {MOST_TAKEN}")
    merging = {"together": together, "fan_in": fan_in}
    pieces, several = _with_prefixes(rebuilt_pieces(turns(rows), piece), piece)
    if several:
        pieces = _with_below(pieces, piece, **merging)
    distinct = _distinct(pieces, piece)
    nodes = nodes_of(distinct, **merging)
    if several:
        # The root of a piece trie is the node that the piece before it ends at.
        nodes = materialize(nodes, "nodes")
        inner_root = (F.col("block") > 0) & (F.col("depth") == 0)
        changed = ("children", "end_one", "end_many")
        roots = nodes.where(inner_root).select(
            F.col("key").alias("next_key"), *[F.col(c).alias(f"_{c}") for c in changed]
        )
        nodes = nodes.where(~inner_root)
        ends = nodes.where("next_key is not null").drop(*changed).join(roots, "next_key")
        ends = ends.withColumnsRenamed({f"_{c}": c for c in changed})
        nodes = nodes.where("next_key is null").unionByName(ends)
    shared = distinct.where("end_many is not null").select(F.col("end_many").alias("gid"))
    hashes = materialize(end_hashes(pieces.select("gid", "conv_id").join(shared, "gid")), "ends")
    nodes = nodes.withColumn("sha", F.sha2(F.coalesce(F.col("end_one").cast("string"), F.lit("")), 256))
    many = nodes.where("end_many is not null").drop("sha")
    many = many.join(hashes.withColumnRenamed("gid", "end_many"), "end_many")
    return nodes.where("end_many is null").unionByName(many).select(
        F.col("conv").alias("conv_id"),
        (F.col("block").cast("bigint") * piece + F.col("depth")).alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"),
    )
