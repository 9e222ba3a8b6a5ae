import datetime
import os
import time

import pytest

from basketflow import catalog
from basketflow.schemas import TRANSACTIONS_SCHEMA
from basketflow.sources import incremental, sample_tables, tables

COLUMNS = TRANSACTIONS_SCHEMA.names


def _write(root, name, rows):
    os.makedirs(f"{root}/transactions", exist_ok=True)
    with open(f"{root}/transactions/{name}.csv", "w") as file:
        file.write(",".join(COLUMNS) + "\n")
        for week, basket in rows:
            values = {"SHOP_WEEK": week, "BASKET_ID": basket, "PROD_CODE": "p", "CUST_CODE": "c"}
            file.write(",".join(str(values.get(c, "")) for c in COLUMNS) + "\n")


def _found(spark, staging):
    return sorted((r.SHOP_WEEK, r.BASKET_ID) for r in incremental.staged_lines(spark, staging).collect())


@pytest.fixture
def places(tmp_path):
    root, staging = str(tmp_path / "landing"), str(tmp_path / "staging")
    os.makedirs(root)
    return root, staging


def _stamps(staging):
    return {
        f"{folder}/{f}": os.stat(f"{folder}/{f}").st_mtime_ns
        for folder, _, names in os.walk(f"{staging}/lines")
        for f in names
        if f.endswith(".parquet")
    }


def test_files_that_arrive_change_and_go(spark, places):
    root, staging = places
    assert incremental.stage_new(spark, root, staging) == {"files": 0, "weeks": 0}
    assert _found(spark, staging) == []
    a = [(200601, "1"), (200601, "2"), (200602, "3")]
    _write(root, "a", a)
    assert incremental.stage_new(spark, root, staging) == {"files": 1, "weeks": 2}
    assert _found(spark, staging) == sorted(a)
    before = _stamps(staging)
    assert incremental.stage_new(spark, root, staging) == {"files": 0, "weeks": 0}
    assert _stamps(staging) == before
    # A new file rewrites its own weeks only.
    b = [(200602, "4"), (200603, "5"), (200603, "5")]
    _write(root, "b", b)
    assert incremental.stage_new(spark, root, staging) == {"files": 1, "weeks": 2}
    assert _found(spark, staging) == sorted(a + b)
    first = {k: v for k, v in before.items() if "200601" in k}
    assert first and all(_stamps(staging).get(k) == v for k, v in first.items())
    # A changed file replaces its rows, also in weeks that it has no more lines of.
    a = [(200601, "1"), (200604, "6")]
    _write(root, "a", a)
    assert incremental.stage_new(spark, root, staging) == {"files": 1, "weeks": 3}
    assert _found(spark, staging) == sorted(a + b)
    # A file that is gone takes its rows with it.
    os.remove(f"{root}/transactions/b.csv")
    assert incremental.stage_new(spark, root, staging) == {"files": 1, "weeks": 2}
    assert _found(spark, staging) == sorted(a)
    _write(root, "c", [(200603, "7")])
    incremental.stage_new(spark, root, staging)
    assert _found(spark, staging) == sorted(a + [(200603, "7")])


def test_a_stopped_run_is_repeated(spark, places, monkeypatch):
    root, staging = places
    _write(root, "a", [(200601, "1")])
    incremental.stage_new(spark, root, staging)
    _write(root, "b", [(200601, "2"), (200602, "3")])

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "_empty_weeks", stop)  # after the lines, before the manifest
        with pytest.raises(RuntimeError):
            incremental.stage_new(spark, root, staging)
    incremental.stage_new(spark, root, staging)
    assert _found(spark, staging) == [(200601, "1"), (200601, "2"), (200602, "3")]


def test_lines_without_a_week(spark, places):
    root, staging = places
    _write(root, "a", [("", "1"), (200601, "2")])
    incremental.stage_new(spark, root, staging)
    rows = {(r.SHOP_WEEK, r.BASKET_ID) for r in incremental.staged_lines(spark, staging).collect()}
    assert rows == {(None, "1"), (200601, "2")}


def test_weeks_are_rewritten_in_turns(spark, places, monkeypatch):
    root, staging = places
    monkeypatch.setattr(incremental, "TURN_LINES", 2)
    a = [(200600 + w, f"a{w}") for w in range(1, 8)] + [("", "a")]
    _write(root, "a", a)
    assert incremental.stage_new(spark, root, staging) == {"files": 1, "weeks": 8}
    a[-1] = (None, "a")
    assert _rows(spark, staging) == set(a)
    # Weeks with lines that stay, weeks that are new, and lines that come twice.
    b = [(200600 + w, f"b{w}") for w in range(5, 12)] * 2
    _write(root, "b", b)
    assert incremental.stage_new(spark, root, staging) == {"files": 1, "weeks": 7}
    assert _rows(spark, staging) == set(a + b) and incremental.staged_lines(spark, staging).count() == len(a + b)
    _write(root, "a", a[2:6])
    assert incremental.stage_new(spark, root, staging) == {"files": 1, "weeks": 8}
    assert _rows(spark, staging) == set(a[2:6] + b)


def test_a_run_stopped_between_turns_is_repeated(spark, places, monkeypatch):
    root, staging = places
    monkeypatch.setattr(incremental, "TURN_LINES", 2)
    a = [(200600 + w, f"a{w}") for w in range(1, 8)]
    _write(root, "a", a)
    incremental.stage_new(spark, root, staging)
    b = [(200600 + w, f"b{w}") for w in range(1, 10)]
    _write(root, "b", b)
    before, table = _stamps(staging), incremental._staged

    def stop(*of):
        if _stamps(staging) != before:
            raise RuntimeError("stopped")
        return table(*of)

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "_staged", stop)
        with pytest.raises(RuntimeError):
            incremental.stage_new(spark, root, staging)
    assert set(a) < _rows(spark, staging) < set(a + b)
    assert incremental.stage_new(spark, root, staging) == {"files": 1, "weeks": 9}
    assert _found(spark, staging) == sorted(a + b)


def _rows(spark, staging):
    return {(r.SHOP_WEEK, r.BASKET_ID) for r in incremental.staged_lines(spark, staging).collect()}


# The query over tables of our own


TABLES = {
    "nation": "n_nationkey INT, n_name STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "customer": "c_custkey BIGINT, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_brand STRING, p_type STRING, p_size INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE",
}


@pytest.fixture
def folder(spark, tmp_path):
    """Tables with keys that repeat, are null or are missing; 60 orders of three years, 4 lines each."""
    days = [datetime.datetime(1995 + o % 3, 1 + o % 12, 1 + o % 28, o % 24) for o in range(60)]
    rows = {
        "nation": [(0, "PERU"), (1, None)],
        "supplier": [(0, 0), (1, 1), (2, 9), (2, 0)],
        "customer": [(c, "BUILDING") for c in range(5)] + [(4, "AUTO"), (None, "none")],
        "part": [(p, f"b{p}", "type, quoted", p) for p in range(6)] + [(5, "b", "type", None)],
        "orders": [(o, None if o % 9 == 0 else o % 7, days[o], "1-URGENT") for o in range(60)] + [(None, 1, days[0], "")],
        "lineitem": [
            (None if o == 59 else o + (o == 58) * 100, None if o % 10 == 1 else (o + n) % 8, (o * n) % 4, float(n), o + n / 7)
            for o in range(60)
            for n in range(4)
        ],
    }
    for name, schema in TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    return f"{tmp_path}/tables"


def _plain(df):
    return sorted(str(tuple(r)) for r in df.select(*COLUMNS).collect())


def test_shares_of_transactions(spark, folder, monkeypatch):
    for name in TABLES:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    joined = spark.sql("""
        SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, c_mktsegment, p_brand, n_name FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN nation ON s_nationkey = n_nationkey""").collect()
    code = lambda key, width: None if key is None else f"{key:0{width}}"
    expected = [
        (code(o, 15), code(p, 12), None if s is None else str(s), int(q), seg, brand, nation)
        for o, p, s, q, seg, brand, nation in joined
    ]
    found = ["BASKET_ID", "PROD_CODE", "STORE_CODE", "QUANTITY", "CUST_LIFESTAGE", "PROD_CODE_10", "STORE_REGION"]
    whole = sample_tables.transactions(spark, folder)
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in whole.select(*found).collect())
    assert len(sample_tables.transaction_shares(spark, folder)) == 1
    monkeypatch.setattr(sample_tables, "SHARE_LINES", 50)
    shares = sample_tables.transaction_shares(spark, folder)
    counts = [s.count() for s in shares]
    assert len(shares) == 5 and all(counts) and sum(counts) == whole.count()
    stored = tables.materialize(shares, "shares")
    assert _plain(stored) == _plain(whole)


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_staging_years_gives_its_space_back(spark, folder, monkeypatch):
    """While it runs, a row is stored as landed, as staged and once more; all else is given back."""
    scratch = spark.conf.get("spark.checkpoint.dir")
    before, shuffled, stored = set(os.listdir(scratch)), _shuffle_files(spark), []
    staged = incremental.stage_new

    def new():
        return set(os.listdir(scratch)) - before

    def stage_new(spark, root, staging):
        result = staged(spark, root, staging)
        scratch_tables = [n for n in new() if not n.startswith(("landing-", "staged-"))]
        # Lists of files and weeks are short; what has more rows has lines.
        stored.append({n.rsplit("-", 1)[0] for n in scratch_tables if spark.read.parquet(f"{scratch}/{n}").count() > 100})
        return result

    monkeypatch.setattr(incremental, "stage_new", stage_new)
    df = catalog.QUERIES["stage_incrementally"](spark, folder)
    # Removed in the background.
    patience = time.time() + 20
    while (left := _shuffle_files(spark) - shuffled) and time.time() < patience:
        time.sleep(0.2)
    assert not left
    whole = sample_tables.transactions(spark, folder)
    assert _plain(df) == _plain(whole.withColumns({c: whole[c].cast(kind) for c, kind in df.dtypes}))
    assert stored == [{"arriving"}, set(), set()]
    landing = next(n for n in new() if n.startswith("landing-"))
    files = [f for f in os.listdir(f"{scratch}/{landing}/transactions") if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
