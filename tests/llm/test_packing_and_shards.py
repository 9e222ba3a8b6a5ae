import random
import zlib

import corpus
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketflow.llm import packing, token_shards

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    rows = corpus.rows(5, 30)
    rows += [
        (2000, "a<|startoftext|>b <|endoftext|> <|start of", "en", "s", 0),
        (2001, "é ́x it's IT'S   a b \U0001f600!", "fr", "s", 0),
        (2002, "x" * 5000, "en", "s", 0),
    ]
    return spark.createDataFrame(rows, corpus.SCHEMA)


@pytest.fixture(scope="module")
def ids(odd):
    """Ids of whole texts, the end included, by text."""
    tokenizer = Tokenizer.from_file(PATH)
    texts = {r.text or "" for r in odd.collect()}
    return {t: tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts}


def test_lengths_are_powers_of_two():
    for n in range(1, 300):
        parts = packing.lengths(n, 64)
        assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 64 for p in parts)
        assert len(parts) == n // 64 + bin(n % 64).count("1")


def test_pieces_hold_every_id_once(odd, ids):
    pieces = packing.pack(odd, PATH, limit=64).toPandas()
    assert pieces["sequence_id"].is_unique and (pieces["offset"] == 0).all()
    for r in odd.dropDuplicates(["doc_id"]).collect():
        if r.doc_id in (None, 1003, 1004):
            continue
        own = pieces[pieces["doc_id"] == r.doc_id].sort_values("start")
        flat = np.concatenate([np.frombuffer(x, "<u4") for x in own["ids"]])
        assert flat.tolist() == ids[r.text or ""]
        assert own["start"].tolist() == (own["length"].cumsum() - own["length"]).tolist()
        assert (own["doc_tokens"] == len(flat)).all()
        assert [zlib.crc32(x) for x in own["ids"]] == own["ids_crc32"].tolist()
    twice = pieces[pieces["doc_id"] == 1004]
    assert (twice.groupby("start").size() == 2).all()
    assert pieces["doc_id"].isna().any()


def test_packing_nothing(no_docs, odd):
    assert packing.pack(no_docs, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, PATH, limit=100)


def test_permutation_is_a_bijection():
    for total in (1, 2, 3, 7, 64, 1000, 4097):
        assert sorted(token_shards.permute(np.arange(total), total)) == list(range(total))
    moved = token_shards.permute(np.arange(1000), 1000)
    assert (moved != np.arange(1000)).mean() > 0.9
    assert not np.array_equal(moved, token_shards.permute(np.arange(1000), 1000, key=7))


def texts_of(stored):
    """The ids of every document that has an id of its own, put together from all records."""
    found = {}
    for record, n, *lists in zip(*[stored[c] for c in ("record", "n_ids", "doc_ids", "starts", "lengths")]):
        flat = np.frombuffer(record, "<u2")
        assert sum(lists[2]) == n and (flat[n:] == 0).all()
        at = 0
        for doc_id, start, size in zip(*lists):
            found.setdefault(doc_id, []).append((start, flat[at : at + size]))
            at += size
    return {k: np.concatenate([x for _, x in sorted(v, key=lambda p: p[0])]) for k, v in found.items()}


def test_shards_round_trip(spark, odd, ids, tmp_path):
    options = {"length": 32, "per_shard": 16}
    token_shards.write_shards(token_shards.training_order(odd, PATH, **options), str(tmp_path / "s"))
    stored = token_shards.read_from(spark, str(tmp_path / "s"), 0, 16).toPandas()
    assert stored["slot"].tolist() == list(range(len(stored)))
    assert (stored["shard"] == stored["slot"] // 16).all()
    assert (stored["byte_offset"] == stored["slot"] % 16 * 64).all()
    assert {len(x) for x in stored["record"]} == {64}
    assert [zlib.crc32(x[: 2 * n]) for x, n in zip(stored["record"], stored["n_ids"])] == stored["ids_crc32"].tolist()
    texts = texts_of(stored)
    for r in odd.collect():
        if r.doc_id in (None, 1003, 1004):
            continue
        assert texts[r.doc_id].tolist() == ids[r.text or ""]
    # Rows with one doc_id, or none, are documents of their own: none of their ids is lost.
    for some in (None, 1003, 1004):
        own = [ids[r.text or ""] for r in odd.collect() if r.doc_id == some]
        assert sorted(texts[some].tolist()) == sorted(i for x in own for i in x)
    assert (stored["n_ids"] < 32).sum() <= odd.rdd.getNumPartitions()
    rest = token_shards.read_from(spark, str(tmp_path / "s"), 21, 16)
    assert [r.slot for r in rest.collect()] == list(range(21, len(stored)))
    again = token_shards.training_order(odd, PATH, **options).collect()
    first = token_shards.read_from(spark, str(tmp_path / "s"), 0, 16).collect()
    assert sorted(again) == sorted(first)


def test_shards_of_long_texts_and_further_columns(spark, ids, odd, tmp_path):
    long = "a long text of words " * 20_000
    docs = spark.createDataFrame([(1, long, "en", "s", 0), (2, None, "en", "s", 0)], corpus.SCHEMA)
    made = token_shards.training_order(corpus.clashing(docs).coalesce(1), PATH, length=64).toPandas()
    texts = texts_of(made)
    assert texts[1].tolist() == Tokenizer.from_file(PATH).encode(long, add_special_tokens=False).ids + [2]
    assert texts[2].tolist() == [2]
    assert sorted(made["n_ids"])[1:] == [64] * (len(made) - 1)


def test_a_dictionary_of_a_sample_changes_no_record(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, corpus.text(rng, 400), "en", "s", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, corpus.SCHEMA).coalesce(2)
    common = token_shards._common(docs, PATH, 256, "<u2")
    assert 0 < len(common) <= token_shards.DICTIONARY_BYTES
    texts = texts_of(token_shards.training_order(docs, PATH, length=256).toPandas())
    tokenizer = Tokenizer.from_file(PATH)
    for doc_id, text, *_ in rows:
        assert texts[doc_id].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2]


def test_ids_that_do_not_fit(odd):
    with pytest.raises(Exception, match="does not fit"):
        token_shards.training_order(odd, PATH, kind="<u1").collect()


def test_no_shards(no_docs):
    assert token_shards.training_order(no_docs.withColumn("slot", F.lit(1)), PATH).count() == 0


def test_a_shard_is_one_raw_file_of_records(spark, odd, tmp_path):
    path = tmp_path / "raw"
    want = token_shards.training_order(odd, PATH, length=32, per_shard=16).toPandas()
    token_shards.write_shards(token_shards.training_order(odd, PATH, length=32, per_shard=16), str(path))
    for shard, own in want.groupby("shard"):
        raw = (path / f"shard-{shard:08d}.bin").read_bytes()
        assert len(raw) == 64 * len(own)
        for offset, record in zip(own["byte_offset"], own["record"]):
            assert raw[offset : offset + 64] == bytes(record)
    assert not [f for f in path.iterdir() if f.suffix == ".part"]
    (path / "shard-00000000.bin").write_bytes(b"")
    rest = token_shards.read_from(spark, str(path), 21, 16).toPandas()
    later = want[want["slot"] >= 21].sort_values("slot")
    assert rest["record"].map(bytes).tolist() == later["record"].map(bytes).tolist()
    assert rest["ids_crc32"].tolist() == later["ids_crc32"].tolist()
    for name in ("doc_ids", "starts", "lengths"):
        assert rest[name].map(list).tolist() == later[name].map(list).tolist()
    assert any(x is None or x != x for ids in want["doc_ids"] for x in ids)
    token_shards.write_shards(token_shards.training_order(odd.limit(0), PATH), str(path))
    assert token_shards.read_from(spark, str(path), 0).count() == 0
