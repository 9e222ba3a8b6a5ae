import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from basketflow.llm import catalog, prefix_trie
from basketflow.llm.shared import ship

SCHEMA = "conv_id long, turn long, role string, text string"


def _digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def by_force(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns.setdefault(conv, []).append(((turn is not None, turn or 0, _digest(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(found)] for c, found in turns.items()}
    members, ends = {}, {}
    for c, found in own.items():
        taken = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt = tuple(own.get(base, [])[:taken] + found[taken:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append(c)
        ends.setdefault(rebuilt, []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = kids.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) if below else 1
        own_part = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = own_part + sum(saved[k] for k in below)
    return sorted(
        (
            min(m),
            len(path),
            min(members[path[:-1]]) if path else -1,
            len(m),
            len(kids.get(path, [])),
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, m in members.items()
    )


def conversations(seed, count, longest=9, kinds=4):
    """Few kinds of turns, so that conversations share them; copies, nulls, ties, odd ids."""
    rng, rows = random.Random(seed), []
    kind = [(rng.choice(("user", "assistant", None)), "é" * rng.randint(0, 9) + str(i)) for i in range(kinds)]
    kind += [("user", None), (None, None), ("user", ""), ("", "x" * 5000)]
    for c in rng.sample(range(0, 4 * count), count):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t if rng.random() < 0.9 else None, *kind[min(int(rng.expovariate(0.7)), len(kind) - 1)]))
    base = [r for r in rows if r[0] == rows[0][0]]
    rows += [(c, *r[1:]) for c in range(1000, 1040) for r in base]
    rows += rows[5:9] + [(None, 1, "user", "a"), (-7, 0, "user", "b"), (-100, 0, "user", "b"), (7777, 1, "user", "c")]
    return rows


def check(spark, rows, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = prefix_trie.trie(frame, **settings).collect()
    got = sorted(tuple(-1 if v is None else v for v in r) for r in found)
    assert got == by_force(rows)


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_same_as_brute_force(spark):
    check(spark, conversations(1, 120))


@pytest.mark.parametrize("seed", [2, 3])
def test_many_partitions_merged_in_rounds(spark, monkeypatch, seed):
    monkeypatch.setattr(prefix_trie, "TASK_ROWS", 5)
    check(spark, conversations(seed, 60), together=0, fan_in=2)


def test_long_conversations_in_pieces(spark, monkeypatch):
    rng = random.Random(4)
    rows = conversations(5, 30, 40, 2)
    chain = [("user", rng.choice("ab")) for _ in range(60)]
    for c in (2000, 2001, 2002, 2003, 2100):
        rows += [(c, t, *turn) for t, turn in enumerate(chain[: rng.choice((12, 18, 60))])]
    rows += [(2200, t, "user", "z") for t in range(12)] + [(2300, t, "user", "z") for t in range(18)]
    monkeypatch.setattr(prefix_trie, "STRETCH", 2)
    check(spark, rows, piece=6)


def test_long_conversations_in_pieces_over_rounds(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TASK_ROWS", 4)
    check(spark, conversations(6, 25, 30, 2), piece=7, together=0, fan_in=3)


def test_turnless_and_tiny(spark):
    # 3 of conversation 105 are taken from an absent base, and it has no more of its own.
    short = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1][:2]
    check(spark, [(c, 0, "user", "a") for c in short])
    check(spark, [(0, 0, "user", "a")])


def test_repeated_ids_share_long_lists(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_BATCH", 3)
    check(spark, [(100 * c, t, "user", str(t)) for c in range(70) for t in range(3)])


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(empty).count() == 0
    rows = conversations(8, 20)
    names = ("pos", "digest", "chars", "block", "key", "depth", "n", "conv", "part", "_base", "gid")
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in names})
    assert sorted(tuple(-1 if v is None else v for v in r) for r in prefix_trie.trie(frame).collect()) == by_force(rows)
    with pytest.raises(ValueError):
        prefix_trie.trie(empty, piece=5)


def test_query(spark, tables):
    found = catalog.op11_prefix_trie(spark, tables)
    kinds = [f.dataType.simpleString() for f in found.schema]
    assert kinds == ["bigint"] * 7 + ["string"]
    table = spark.read.parquet(f"{tables}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert sorted(tuple(-1 if v is None else v for v in r) for r in found.collect()) == by_force(table.collect())
