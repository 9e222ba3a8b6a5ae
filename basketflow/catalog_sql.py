"""The registered queries as SQL for DuckDB over the same tables.

Written for checking, from the definitions of the operators: whole-table window functions and
dense matrices where the Spark side avoids them.
"""

from basketflow.catalog import (
    BATCH_SIZE,
    BEST,
    DIGEST_SIZE,
    DIGITS,
    LEAST_SIMILARITY,
    PASSES,
    POSITION_B,
    SAMPLE_RATE,
    SETTINGS,
    SUBSTITUTES,
)
from basketflow.operators.batches import SEED as BATCH_SEED
from basketflow.operators.examples import SEED as SPLIT_SEED
from basketflow.operators.examples import SHARES
from basketflow.operators.metrics import TOP_K
from basketflow.operators.position_weights import MIXED
from basketflow.operators.sampling import SEED as SAMPLE_SEED
from basketflow.operators.personal import FEATURES
from basketflow.operators.scoring import DECAY, SCORE_DIGITS
from basketflow.operators.transitions import SHRINK
from basketflow.schemas import TRANSACTIONS_SCHEMA
from basketflow.sources.sample_tables import BASKET_WIDTH, CUST_WIDTH, PROD_WIDTH

N_ITEMS = SETTINGS.num_prods - 1
WIDTH = SETTINGS.num_labels
MAX_ITEMS, MAX_SEQ = SETTINGS.max_items, SETTINGS.max_seq

# Common table expressions, each with those it reads. They are put together by ``_with``.
CTES = {
    "lines": (
        (),
        f"""
        SELECT lpad(o_custkey::VARCHAR, {CUST_WIDTH}, '0') AS "CUST_CODE",
               lpad(o_orderkey::VARCHAR, {BASKET_WIDTH}, '0') AS "BASKET_ID",
               lpad(l_partkey::VARCHAR, {PROD_WIDTH}, '0') AS "PROD_CODE"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "trans": (
        (),
        f"""
        SELECT (isoyear(o_orderdate) * 100 + week(o_orderdate))::BIGINT AS "SHOP_WEEK",
               strftime(o_orderdate, '%Y%m%d')::BIGINT AS "SHOP_DATE",
               (dayofweek(o_orderdate) + 1)::BIGINT AS "SHOP_WEEKDAY",
               hour(o_orderdate)::BIGINT AS "SHOP_HOUR",
               trunc(l_quantity)::BIGINT AS "QUANTITY",
               l_extendedprice::FLOAT::DOUBLE AS "SPEND",
               lpad(l_partkey::VARCHAR, {PROD_WIDTH}, '0') AS "PROD_CODE",
               p_brand AS "PROD_CODE_10",
               p_type AS "PROD_CODE_20",
               p_size::VARCHAR AS "PROD_CODE_30",
               NULL::VARCHAR AS "PROD_CODE_40",
               lpad(o_custkey::VARCHAR, {CUST_WIDTH}, '0') AS "CUST_CODE",
               NULL::VARCHAR AS "CUST_PRICE_SENSITIVITY",
               c_mktsegment AS "CUST_LIFESTAGE",
               lpad(o_orderkey::VARCHAR, {BASKET_WIDTH}, '0') AS "BASKET_ID",
               NULL::VARCHAR AS "BASKET_SIZE",
               NULL::VARCHAR AS "BASKET_PRICE_SENSITIVITY",
               o_orderpriority AS "BASKET_TYPE",
               NULL::VARCHAR AS "BASKET_DOMINANT_MISSION",
               l_suppkey::VARCHAR AS "STORE_CODE",
               NULL::VARCHAR AS "STORE_FORMAT",
               n_name AS "STORE_REGION"
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "calendar": (
        (),
        """
        SELECT (isoyear(o_orderdate) * 100 + week(o_orderdate))::BIGINT AS "SHOP_WEEK",
               min(strftime(o_orderdate, '%Y%m%d')::BIGINT) AS "DATE_FROM",
               max(strftime(o_orderdate, '%Y%m%d')::BIGINT) AS "DATE_TO"
        FROM orders GROUP BY 1""",
    ),
    "items": (("lines",), "SELECT DISTINCT * FROM lines"),
    "vocab": (
        ("lines",),
        f"""
        SELECT 'UNK' AS prod_code, 0::BIGINT AS idx
        UNION ALL
        SELECT "PROD_CODE", row_number() OVER (ORDER BY n DESC, "PROD_CODE") AS idx
        FROM (SELECT "PROD_CODE", count(*) AS n FROM lines GROUP BY 1)
        QUALIFY idx <= {N_ITEMS}""",
    ),
    "coded": (
        ("items", "vocab"),
        """
        SELECT i.*, coalesce(v.idx, 0) AS idx
        FROM items i LEFT JOIN vocab v ON i."PROD_CODE" = v.prod_code""",
    ),
    # Kept baskets with their place in the customer's sequence.
    "kept": (
        ("coded",),
        f"""
        SELECT "CUST_CODE", "BASKET_ID", count(*) AS size,
               string_agg(idx::VARCHAR, ',' ORDER BY "PROD_CODE") AS items,
               row_number() OVER (PARTITION BY "CUST_CODE" ORDER BY "BASKET_ID") AS basket_pos,
               count(*) OVER (PARTITION BY "CUST_CODE") AS n_baskets
        FROM coded GROUP BY 1, 2 HAVING count(*) < {MAX_ITEMS}""",
    ),
    "padded": (
        ("kept",),
        f"""
        SELECT *, items || repeat(',0', ({MAX_ITEMS} - size)::INTEGER) AS padded
        FROM kept WHERE n_baskets < {MAX_SEQ}""",
    ),
    "split": (
        ("lines",),
        f"""
        SELECT "CUST_CODE",
               CASE WHEN place <= round_even(n * {float(SHARES[0])!r}::DOUBLE, 0) THEN 'train'
                    WHEN place <= round_even(n * {SHARES[0] + SHARES[1]!r}::DOUBLE, 0) THEN 'test'
                    ELSE 'valid' END AS split
        FROM (SELECT "CUST_CODE", count(*) OVER () AS n,
                     row_number() OVER (ORDER BY md5('{SPLIT_SEED}|' || "CUST_CODE")) AS place
              FROM (SELECT DISTINCT "CUST_CODE" FROM lines))""",
    ),
    # Baskets of usable customers: the last is y, the others are x.
    "usable": (
        ("padded", "split"),
        """
        SELECT p.*, s.split FROM padded p JOIN split s USING ("CUST_CODE")
        WHERE n_baskets >= 2""",
    ),
    "labels": (
        ("usable",),
        """
        SELECT DISTINCT "CUST_CODE", unnest(string_split(padded, ','))::BIGINT AS idx
        FROM usable WHERE basket_pos = n_baskets""",
    ),
    "n": (("usable",), 'SELECT count(DISTINCT "CUST_CODE") AS n FROM usable'),
    "scores": (
        ("usable",),
        f"""
        SELECT "CUST_CODE", idx, round(sum(weight / norm), {SCORE_DIGITS}) AS p
        FROM (SELECT DISTINCT "CUST_CODE", basket_pos,
                     unnest(string_split(padded, ','))::BIGINT AS idx,
                     exp(-{DECAY} * (n_baskets - 1 - basket_pos)) AS weight
              FROM usable WHERE basket_pos < n_baskets)
        JOIN (SELECT "CUST_CODE",
                     sum(exp(-{DECAY} * (n_baskets - 1 - basket_pos))) + 1e-7 AS norm
              FROM usable WHERE basket_pos < n_baskets GROUP BY 1) USING ("CUST_CODE")
        GROUP BY 1, 2""",
    ),
    # Items of the history of train customers, and their labels.
    "train_x": (
        ("usable",),
        """
        SELECT "CUST_CODE", idx, any_value(n_baskets - 1) AS n_x,
               count(DISTINCT basket_pos) AS n_with,
               max((basket_pos = n_baskets - 1)::INTEGER) AS in_last
        FROM (SELECT "CUST_CODE", basket_pos, n_baskets,
                     unnest(string_split(padded, ','))::BIGINT AS idx
              FROM usable WHERE split = 'train' AND basket_pos < n_baskets)
        GROUP BY 1, 2""",
    ),
    "train_labels": (
        ("labels", "usable"),
        """
        SELECT * FROM labels
        WHERE "CUST_CODE" IN (SELECT "CUST_CODE" FROM usable WHERE split = 'train')""",
    ),
    "width": ((), f"SELECT range AS idx FROM range({WIDTH})"),
    "customers": (("usable",), 'SELECT DISTINCT "CUST_CODE" FROM usable'),
    "splits": (("usable",), 'SELECT DISTINCT "CUST_CODE", split FROM usable'),
    # Every customer with every label.
    "dense": (
        ("labels", "scores", "width", "splits"),
        """
        SELECT c."CUST_CODE", c.split, w.idx, (l.idx IS NOT NULL)::INTEGER AS y, coalesce(s.p, 0) AS p
        FROM splits c CROSS JOIN width w
        LEFT JOIN labels l ON l."CUST_CODE" = c."CUST_CODE" AND l.idx = w.idx
        LEFT JOIN scores s ON s."CUST_CODE" = c."CUST_CODE" AND s.idx = w.idx""",
    ),
    "weights": (
        ("train_labels", "train_x", "width"),
        """
        SELECT idx,
               CASE WHEN pos = 0 OR pos = n THEN 1.0::DOUBLE
                    ELSE n / (2 * (n - pos))::DOUBLE END AS w_neg,
               CASE WHEN pos = 0 OR pos = n THEN 1.0::DOUBLE
                    ELSE n / (2 * pos)::DOUBLE END AS w_pos
        FROM (SELECT w.idx, count(l.idx) AS pos
              FROM width w LEFT JOIN train_labels l ON w.idx = l.idx GROUP BY 1)
        CROSS JOIN (SELECT count(DISTINCT "CUST_CODE") AS n FROM train_x)""",
    ),
    "losses": (
        ("dense", "weights"),
        """
        SELECT d.idx, split, y, p, w_neg, w_pos,
               CASE WHEN y = 1 THEN -ln(least(greatest(p, 1e-7), 1 - 1e-7))
                    ELSE -ln(least(greatest(1 - p, 1e-7), 1 - 1e-7)) END AS loss
        FROM dense d JOIN weights w ON d.idx = w.idx""",
    ),
    "outcomes": (
        ("losses",),
        """
        SELECT idx,
               count(*) FILTER (y = 1 AND p > 0.5) AS tp,
               count(*) FILTER (y = 0 AND p > 0.5) AS fp,
               count(*) FILTER (y = 1 AND p <= 0.5) AS fn,
               sum(loss * CASE WHEN y = 1 THEN w_pos ELSE w_neg END) AS loss
        FROM losses GROUP BY 1""",
    ),
    "ranked_all": (
        ("dense",),
        f"""
        SELECT *, row_number() OVER (PARTITION BY "CUST_CODE" ORDER BY p DESC, idx) AS rank
        FROM dense QUALIFY rank <= {TOP_K}""",
    ),
    "split_outcomes": (
        ("losses",),
        """
        SELECT split, idx,
               count(*) FILTER (y = 1 AND p > 0.5) AS tp,
               count(*) FILTER (y = 0 AND p > 0.5) AS fp,
               count(*) FILTER (y = 1 AND p <= 0.5) AS fn
        FROM losses GROUP BY 1, 2""",
    ),
    "split_evaluation": (
        ("losses", "split_outcomes", "ranked_all", "labels", "splits"),
        f"""
        SELECT a.split, loss, accuracy, precision, recall, f1, recall_top_k, precision_top_k
        FROM (SELECT split,
                     round(avg(loss * CASE WHEN y = 1 THEN w_pos ELSE w_neg END), {DIGITS}) AS loss,
                     round(avg(((p > 0.5)::INTEGER = y)::INTEGER), {DIGITS}) AS accuracy
              FROM losses GROUP BY 1) a
        JOIN (SELECT split,
                     round(avg(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END), {DIGITS})
                         AS precision,
                     round(avg(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END), {DIGITS})
                         AS recall,
                     round(avg(CASE WHEN 2 * tp + fp + fn = 0 THEN 0
                                    ELSE 2 * tp / (2 * tp + fp + fn) END), {DIGITS}) AS f1
              FROM split_outcomes GROUP BY 1) b ON a.split = b.split
        JOIN (SELECT split, sum(y) AS hits, round(sum(y) / count(*), {DIGITS}) AS precision_top_k
              FROM ranked_all GROUP BY 1) c ON a.split = c.split
        JOIN (SELECT s.split, round(any_value(hits) / count(*), {DIGITS}) AS recall_top_k
              FROM labels l JOIN splits s ON s."CUST_CODE" = l."CUST_CODE"
              JOIN (SELECT split, sum(y) AS hits FROM ranked_all GROUP BY 1) h
                   ON h.split = s.split
              GROUP BY 1) d ON a.split = d.split""",
    ),
    "digests": (
        ("vocab",),
        f"""
        SELECT v.idx, j.range AS j,
               CASE WHEN v.idx = 0 THEN 0
                    ELSE ('0x' || substr(md5(j.range || '|' || prod_code), 1, 4))::INTEGER / 65536
                         - 0.5 END::FLOAT::DOUBLE AS v
        FROM vocab v CROSS JOIN range({DIGEST_SIZE}) j""",
    ),
    "pairs": (
        ("coded", "kept"),
        """
        SELECT DISTINCT c."BASKET_ID", c.idx
        FROM coded c JOIN kept k USING ("CUST_CODE", "BASKET_ID") WHERE c.idx <> 0""",
    ),
    # Items of every basket of the train histories, unknown ones left out.
    "x_items": (
        ("usable",),
        """
        SELECT DISTINCT "CUST_CODE", basket_pos, idx
        FROM (SELECT "CUST_CODE", basket_pos, unnest(string_split(padded, ','))::BIGINT AS idx
              FROM usable WHERE split = 'train' AND basket_pos < n_baskets) WHERE idx <> 0""",
    ),
    "x_pairs": (
        ("x_items",),
        f"""
        SELECT p.idx, p.other, n_both, round(n_both / sqrt(a.n * b.n), {SCORE_DIGITS}) AS similarity
        FROM (SELECT a.idx, b.idx AS other, count(*) AS n_both
              FROM x_items a JOIN x_items b USING ("CUST_CODE", basket_pos)
              WHERE a.idx <> b.idx GROUP BY 1, 2) p
        JOIN (SELECT idx, count(*) AS n FROM x_items GROUP BY 1) a ON a.idx = p.idx
        JOIN (SELECT idx, count(*) AS n FROM x_items GROUP BY 1) b ON b.idx = p.other""",
    ),
    "x_ranked": (
        ("x_pairs",),
        """
        SELECT *, row_number() OVER (PARTITION BY idx ORDER BY similarity DESC, other) AS rank
        FROM x_pairs""",
    ),
    "x_neighbours": (
        ("x_ranked",),
        f"""
        SELECT r.*, coalesce(c.similarity, 0) AS cut
        FROM x_ranked r LEFT JOIN x_ranked c ON c.idx = r.idx AND c.rank = {BEST + 1}
        WHERE r.rank <= {BEST}""",
    ),
    "collaborative": (
        ("scores", "x_neighbours"),
        f"""
        SELECT s."CUST_CODE", n.other AS idx, round(sum(s.p * n.similarity), {SCORE_DIGITS - 1}) AS p
        FROM scores s JOIN x_neighbours n ON n.idx = s.idx GROUP BY 1, 2""",
    ),
    "ages": (
        (),
        f"""
        SELECT generate_subscripts({POSITION_B}, 1) - 1 AS age, tanh(unnest({POSITION_B})) AS e""",
    ),
    "age_shares": (
        ("x_items",),
        f"""
        SELECT w.range AS idx, (count(x.idx) + 1) / (any_value(t.n) + {WIDTH - 1}) AS share
        FROM range(1, {WIDTH}) w LEFT JOIN x_items x ON x.idx = w.range
        CROSS JOIN (SELECT count(*) AS n FROM x_items) t GROUP BY 1""",
    ),
    # Every known item of a train y with every basket of its customer that has a known item.
    "age_parts": (
        ("train_labels", "x_items", "usable", "ages", "age_shares"),
        """
        SELECT l."CUST_CODE", l.idx, s.share AS q, b.age, b.e, exp(b.e) AS w,
               coalesce(1 / b.size, 0) * (x.idx IS NOT NULL)::INTEGER AS share
        FROM (SELECT * FROM train_labels WHERE idx <> 0) l
        JOIN age_shares s ON s.idx = l.idx
        LEFT JOIN (SELECT i."CUST_CODE", i.basket_pos, any_value(n.n_baskets) - 1 - i.basket_pos AS age,
                          any_value(a.e) AS e, count(*) AS size
                   FROM x_items i
                   JOIN (SELECT DISTINCT "CUST_CODE", n_baskets FROM usable) n USING ("CUST_CODE")
                   JOIN ages a ON a.age = n.n_baskets - 1 - i.basket_pos
                   GROUP BY 1, 2) b ON b."CUST_CODE" = l."CUST_CODE"
        LEFT JOIN x_items x ON x."CUST_CODE" = l."CUST_CODE" AND x.basket_pos = b.basket_pos
             AND x.idx = l.idx""",
    ),
    "age_draws": (
        ("age_parts",),
        f"""
        SELECT *, {1 - MIXED} * s + {MIXED} * q AS p
        FROM (SELECT *, coalesce(sum(w * share) OVER draw / sum(w) OVER draw, 0) AS s,
                     sum(w) OVER draw AS total
              FROM age_parts WINDOW draw AS (PARTITION BY "CUST_CODE", idx))""",
    ),
    "all_pairs": (
        ("pairs",),
        """
        SELECT p.a, p.b, n_both, x.n AS n_a, y.n AS n_b
        FROM (SELECT a.idx AS a, b.idx AS b, count(*) AS n_both
              FROM pairs a JOIN pairs b ON a."BASKET_ID" = b."BASKET_ID" AND a.idx <> b.idx GROUP BY 1, 2) p
        JOIN (SELECT idx, count(*) AS n FROM pairs GROUP BY 1) x ON x.idx = p.a
        JOIN (SELECT idx, count(*) AS n FROM pairs GROUP BY 1) y ON y.idx = p.b""",
    ),
    "steps": (
        ("x_items", "usable"),
        """
        SELECT u."CUST_CODE", u.basket_pos
        FROM (SELECT DISTINCT "CUST_CODE", basket_pos, n_baskets FROM usable WHERE split = 'train') u
        WHERE u.basket_pos + 1 < u.n_baskets""",
    ),
    "followed": (
        ("x_items", "steps"),
        f"""
        SELECT p.*, f.n_a, t.n_b, s.n AS n_steps, n_ab / (f.n_a + {SHRINK}) AS share,
               (n_ab + {SHRINK} * (t.n_b / s.n)) / (f.n_a + {SHRINK}) AS p
        FROM (SELECT a.idx AS idx_a, b.idx AS idx_b, count(*) AS n_ab
              FROM x_items a JOIN x_items b
                   ON a."CUST_CODE" = b."CUST_CODE" AND b.basket_pos = a.basket_pos + 1 GROUP BY 1, 2) p
        JOIN (SELECT idx, count(*) AS n_a FROM x_items JOIN steps USING ("CUST_CODE", basket_pos) GROUP BY 1) f
             ON f.idx = p.idx_a
        JOIN (SELECT idx, count(*) AS n_b FROM x_items WHERE basket_pos > 1 GROUP BY 1) t ON t.idx = p.idx_b
        CROSS JOIN (SELECT count(*) AS n FROM steps) s""",
    ),
    "last_items": (
        ("usable",),
        """
        SELECT *, count(*) OVER (PARTITION BY "CUST_CODE") AS n
        FROM (SELECT DISTINCT "CUST_CODE", split, unnest(string_split(padded, ','))::BIGINT AS idx
              FROM usable WHERE basket_pos = n_baskets - 1) WHERE idx <> 0""",
    ),
    "following": (
        ("last_items", "followed"),
        f"""
        SELECT l."CUST_CODE", f.idx_b AS idx, round(sum(f.share / l.n), {SCORE_DIGITS - 1}) AS p
        FROM last_items l JOIN followed f ON f.idx_a = l.idx GROUP BY 1, 2""",
    ),
    "appeal": (
        ("train_labels", "train_x", "width"),
        """
        SELECT w.idx, ln((count(l.idx) + 0.5) / (any_value(t.n) + 1)) AS popularity
        FROM width w LEFT JOIN train_labels l ON l.idx = w.idx
        CROSS JOIN (SELECT count(DISTINCT "CUST_CODE") AS n FROM train_x) t GROUP BY 1""",
    ),
    "personal": (
        ("scores", "train_x", "collaborative", "following", "appeal", "train_labels", "splits"),
        """
        SELECT k."CUST_CODE", k.idx, (l.idx IS NOT NULL)::BIGINT AS y,
               coalesce(s.p, 0) AS recency, coalesce(x.n_with / x.n_x, 0) AS frequency,
               coalesce(x.in_last, 0)::DOUBLE AS in_last, coalesce(c.p, 0) AS neighbours,
               coalesce(f.p, 0) AS follows, a.popularity
        FROM (SELECT "CUST_CODE", idx FROM scores UNION SELECT "CUST_CODE", idx FROM collaborative
              UNION SELECT "CUST_CODE", idx FROM following) k
        JOIN splits p ON p."CUST_CODE" = k."CUST_CODE" AND p.split = 'train'
        LEFT JOIN scores s ON s."CUST_CODE" = k."CUST_CODE" AND s.idx = k.idx
        LEFT JOIN train_x x ON x."CUST_CODE" = k."CUST_CODE" AND x.idx = k.idx
        LEFT JOIN collaborative c ON c."CUST_CODE" = k."CUST_CODE" AND c.idx = k.idx
        LEFT JOIN following f ON f."CUST_CODE" = k."CUST_CODE" AND f.idx = k.idx
        LEFT JOIN train_labels l ON l."CUST_CODE" = k."CUST_CODE" AND l.idx = k.idx
        JOIN appeal a ON a.idx = k.idx""",
    ),
    # Every train customer with every label, dense.
    "personal_dense": (
        ("personal", "train_labels", "splits", "width", "appeal"),
        """
        SELECT (l.idx IS NOT NULL)::BIGINT AS y, coalesce(p.recency, 0) AS recency,
               coalesce(p.frequency, 0) AS frequency, coalesce(p.in_last, 0) AS in_last,
               coalesce(p.neighbours, 0) AS neighbours, coalesce(p.follows, 0) AS follows, a.popularity
        FROM splits c CROSS JOIN width w
        LEFT JOIN personal p ON p."CUST_CODE" = c."CUST_CODE" AND p.idx = w.idx
        LEFT JOIN train_labels l ON l."CUST_CODE" = c."CUST_CODE" AND l.idx = w.idx
        JOIN appeal a ON a.idx = w.idx WHERE c.split = 'train'""",
    ),
}

STRING_COLUMNS = [f.name for f in TRANSACTIONS_SCHEMA if f.dataType.simpleString() == "string"]
NUMBER_COLUMNS = [f.name for f in TRANSACTIONS_SCHEMA if f.dataType.simpleString() != "string"]


def _with(needed: tuple[str, ...], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for inner in CTES[name][0]:
                add(inner)
            ordered.append(name)

    for name in needed:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body


def _schema_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT {i}::BIGINT AS position, '{f.name}' AS "column", '{f.dataType.simpleString()}' AS type,
            true AS nullable"""
        for i, f in enumerate(TRANSACTIONS_SCHEMA)
    )


def _numeric(source: str, columns: list[str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", round(avg("{c}")::DOUBLE, 3) AS mean,
            round(max("{c}")::DOUBLE, 3) AS max, round(min("{c}")::DOUBLE, 3) AS min,
            round(stddev_samp("{c}"), 3) AS stddev FROM {source}"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


def _missing() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{f.name}' AS "column",
            round(count(*) FILTER ("{f.name}" IS NULL)::DOUBLE / count(*), {DIGITS}) AS missing
            FROM trans"""
        for f in TRANSACTIONS_SCHEMA
    )


def _top_values() -> str:
    return " UNION ALL ".join(
        f"""SELECT * FROM (
            SELECT '{c}' AS "column",
                   row_number() OVER (ORDER BY count(*) DESC, "{c}" NULLS FIRST) AS rank,
                   "{c}" AS value, count(*) AS n
            FROM trans GROUP BY "{c}" QUALIFY rank <= 20)"""
        for c in STRING_COLUMNS
    )


def _batch(order: str) -> str:
    return f"""
        SELECT place // {BATCH_SIZE} AS batch_id, place % {BATCH_SIZE} AS slot, "CUST_CODE"
        FROM (SELECT "CUST_CODE", pass * n
                     + row_number() OVER (PARTITION BY pass ORDER BY {order}) - 1 AS place, n
              FROM customers CROSS JOIN n CROSS JOIN (SELECT range AS pass FROM range({PASSES})))
        WHERE (place // {BATCH_SIZE} + 1) * {BATCH_SIZE} <= n * {PASSES}"""


def oracle_sql() -> dict[str, str]:
    threshold = f"{round(SAMPLE_RATE * 2**32):08x}"
    trans = _with(("trans",), "SELECT * FROM trans")
    positions = _with(
        ("items",),
        """SELECT "CUST_CODE",
                  dense_rank() OVER (PARTITION BY "CUST_CODE" ORDER BY "BASKET_ID") AS basket_pos,
                  "BASKET_ID", "PROD_CODE" FROM items""",
    )
    names = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in ("w_neg", "w_pos"))
    history = _with(
        ("items",),
        """SELECT "CUST_CODE", n_items,
                  row_number() OVER (PARTITION BY "CUST_CODE" ORDER BY "BASKET_ID") AS basket_pos,
                  (sum(n_items) OVER (PARTITION BY "CUST_CODE" ORDER BY "BASKET_ID"))::BIGINT
                      AS n_history
           FROM (SELECT "CUST_CODE", "BASKET_ID", count("PROD_CODE") AS n_items
                 FROM items GROUP BY 1, 2)""",
    )
    shuffled = f"""md5('{BATCH_SEED}|' || pass || '|' || "CUST_CODE"), "CUST_CODE" """
    vector = ", ".join(
        f"round(coalesce(sum(v) FILTER (j = {j}), 0) / {MAX_ITEMS}, 5) AS v{j}"
        for j in range(DIGEST_SIZE)
    )
    return {
        "stage_transactions": trans,
        "scan_transactions_csv": trans,
        "stage_incrementally": trans,
        "scan_calendar_csv": _with(("calendar",), "SELECT * FROM calendar"),
        "profile_head": _with(
            ("trans",),
            """SELECT * FROM trans ORDER BY "CUST_CODE", "BASKET_ID", "PROD_CODE", "SPEND",
                      "QUANTITY", "STORE_CODE" LIMIT 10""",
        ),
        "profile_counts": _with(
            ("trans",), "SELECT count(*) AS n_rows, 22::BIGINT AS n_columns FROM trans"
        ),
        "profile_distinct_keys": _with(
            ("trans",),
            """SELECT count(DISTINCT "BASKET_ID") AS n_baskets,
                      count(DISTINCT "PROD_CODE") AS n_products,
                      count(DISTINCT "SHOP_WEEK") AS n_weeks FROM trans""",
        ),
        "profile_duplicates": _with(
            ("trans",),
            """SELECT (SELECT count(*) FROM trans) AS n_rows,
                      (SELECT count(*) FROM (SELECT DISTINCT * FROM trans)) AS n_distinct_rows""",
        ),
        "profile_duplicate_lines": _with(
            ("lines", "items"),
            """SELECT (SELECT count(*) FROM lines) AS n_rows,
                      (SELECT count(*) FROM items) AS n_distinct_rows""",
        ),
        "profile_missing": _with(("trans",), _missing()),
        "profile_numeric": _with(("trans",), _numeric("trans", NUMBER_COLUMNS)),
        "profile_top_values": _with(("trans",), _top_values()),
        "profile_heavy_values": _with(("trans",), _top_values()),
        "profile_calendar": _with(
            ("calendar",), _numeric("calendar", ["SHOP_WEEK", "DATE_FROM", "DATE_TO"])
        ),
        "customer_keys": _with(("lines",), 'SELECT DISTINCT "CUST_CODE" FROM lines'),
        "customer_sample": _with(
            ("lines",),
            f"""SELECT * FROM lines
                WHERE substr(md5('{SAMPLE_SEED}|' || "CUST_CODE"), 1, 8) < '{threshold}'""",
        ),
        "customer_sample_near_one": _with(("lines",), "SELECT * FROM lines"),
        "item_lines": _with(("lines",), 'SELECT "PROD_CODE" FROM lines'),
        "basket_rollup": _with(("items",), "SELECT * FROM items"),
        "basket_sets": _with(
            ("items",),
            f"""SELECT "CUST_CODE", "BASKET_ID",
                       string_agg("PROD_CODE", ',' ORDER BY "PROD_CODE") AS items
                FROM items GROUP BY 1, 2 HAVING count(*) < {MAX_ITEMS}""",
        ),
        "basket_sequences": positions,
        "basket_sequences_sliced": positions,
        "customer_sequences": _with(
            ("items",),
            """SELECT "CUST_CODE",
                      dense_rank() OVER (PARTITION BY "CUST_CODE" ORDER BY "BASKET_ID")
                          AS basket_pos, "PROD_CODE" FROM items""",
        ),
        "basket_history": history,
        "basket_history_in_stretches": history,
        "vocabulary": _with(("vocab",), "SELECT * FROM vocab"),
        "vocabulary_reverse": _with(("vocab",), "SELECT idx, prod_code FROM vocab"),
        "item_lines_indexed": _with(
            ("lines", "vocab"),
            """SELECT l.*, coalesce(v.idx, 0) AS idx
               FROM lines l LEFT JOIN vocab v ON l."PROD_CODE" = v.prod_code""",
        ),
        "indexed_sequences": _with(
            ("coded",),
            """SELECT "CUST_CODE",
                      dense_rank() OVER (PARTITION BY "CUST_CODE" ORDER BY "BASKET_ID")
                          AS basket_pos, "PROD_CODE", idx FROM coded""",
        ),
        "padded_baskets": _with(
            ("lines", "kept"),
            f"""SELECT c."CUST_CODE", k.basket_pos,
                       k.items || repeat(',0', ({MAX_ITEMS} - k.size)::INTEGER) AS items
                FROM (SELECT DISTINCT "CUST_CODE" FROM lines) c
                LEFT JOIN kept k ON k."CUST_CODE" = c."CUST_CODE" """,
        ),
        "split_assignment": _with(("split",), "SELECT * FROM split"),
        "split_sizes": _with(
            ("split",), "SELECT split, count(*) AS n_customers FROM split GROUP BY 1"
        ),
        "examples_x": _with(
            ("usable",),
            f"""SELECT c."CUST_CODE", c.split, r.range + 1 AS basket_pos,
                       coalesce(u.padded, '0' || repeat(',0', {MAX_ITEMS - 1})) AS items
                FROM (SELECT DISTINCT "CUST_CODE", split FROM usable) c
                CROSS JOIN range({MAX_SEQ}) r
                LEFT JOIN usable u ON u."CUST_CODE" = c."CUST_CODE"
                     AND u.basket_pos = r.range + 1 AND u.basket_pos < u.n_baskets""",
        ),
        "examples_y_labels": _with(("labels",), "SELECT * FROM labels"),
        "examples_multi_hot": _with(
            ("usable", "dense"),
            """SELECT d."CUST_CODE", any_value(u.split) AS split,
                      string_agg(d.y::VARCHAR, '' ORDER BY d.idx) AS y
               FROM dense d JOIN (SELECT DISTINCT "CUST_CODE", split FROM usable) u
                    ON u."CUST_CODE" = d."CUST_CODE"
               GROUP BY 1""",
        ),
        "example_checks": _with(
            ("usable",),
            """SELECT split, count(DISTINCT "CUST_CODE") AS n_examples, 0::BIGINT AS n_missing,
                      0::BIGINT AS n_wrong_length, 0::BIGINT AS n_wrong_width
               FROM usable GROUP BY 1""",
        ),
        "batch_assignment": _with(("customers", "n"), _batch(shuffled)),
        "batch_assignment_in_order": _with(("customers", "n"), _batch('"CUST_CODE"')),
        "batch_examples": _with(
            ("customers", "n", "usable"),
            f"""SELECT b.batch_id, b.slot, b."CUST_CODE", e.x, e.y
                FROM ({_batch(shuffled)}) b
                JOIN (SELECT "CUST_CODE",
                             string_agg(padded, ';' ORDER BY basket_pos)
                                 FILTER (basket_pos < n_baskets) AS x,
                             max(padded) FILTER (basket_pos = n_baskets) AS y
                      FROM usable GROUP BY 1) e ON e."CUST_CODE" = b."CUST_CODE" """,
        ),
        "class_weights": _with(("weights",), f"SELECT idx, {names} FROM weights"),
        "recency_scores": _with(
            ("scores",), f'SELECT "CUST_CODE", idx, round(p, {DIGITS}) AS p FROM scores'
        ),
        "top_k_items": _with(
            ("scores", "vocab"),
            f"""SELECT s."CUST_CODE", s.rank, s.idx, v.prod_code, round(s.p, {DIGITS}) AS p
                FROM (SELECT *, row_number() OVER (PARTITION BY "CUST_CODE"
                                                   ORDER BY p DESC, idx) AS rank
                      FROM scores QUALIFY rank <= {TOP_K}) s
                LEFT JOIN vocab v ON v.idx = s.idx""",
        ),
        "top_k_all_items": _with(
            ("ranked_all",),
            f'SELECT "CUST_CODE", rank, idx, round(p, {DIGITS}) AS p FROM ranked_all',
        ),
        "label_outcomes": _with(
            ("outcomes",),
            f"SELECT idx, tp, fp, fn, round(loss, {DIGITS}) AS loss FROM outcomes",
        ),
        "loss_weighted_bce": _with(
            ("losses",),
            f"""SELECT round(avg(loss * CASE WHEN y = 1 THEN w_pos ELSE w_neg END), {DIGITS})
                       AS loss FROM losses""",
        ),
        "loss_bce": _with(("losses",), f"SELECT round(avg(loss), {DIGITS}) AS loss FROM losses"),
        "metric_accuracy": _with(
            ("dense",),
            f"SELECT round(avg(((p > 0.5)::INTEGER = y)::INTEGER), {DIGITS}) AS accuracy FROM dense",
        ),
        "metric_macro_prf": _with(
            ("outcomes",),
            f"""SELECT
                  round(avg(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END), {DIGITS})
                      AS precision,
                  round(avg(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END), {DIGITS})
                      AS recall,
                  round(avg(CASE WHEN 2 * tp + fp + fn = 0 THEN 0
                                 ELSE 2 * tp / (2 * tp + fp + fn) END), {DIGITS}) AS f1
                FROM outcomes""",
        ),
        "metric_topk": _with(
            ("ranked_all", "labels"),
            f"""SELECT round(sum(y) / (SELECT count(*) FROM labels), {DIGITS}) AS recall,
                       round(sum(y) / count(*), {DIGITS}) AS precision FROM ranked_all""",
        ),
        "evaluation_recency": _with(
            ("split_evaluation",),
            "SELECT * EXCLUDE (split) FROM split_evaluation WHERE split = 'test'",
        ),
        "evaluation_by_split": _with(("split_evaluation",), "SELECT * FROM split_evaluation"),
        "next_basket_items": _with(
            ("dense",),
            f"""SELECT "CUST_CODE", idx, round(p, {DIGITS}) AS p,
                       row_number() OVER (PARTITION BY "CUST_CODE" ORDER BY p DESC, idx) AS rank
                FROM (SELECT "CUST_CODE", idx, p FROM dense WHERE idx <> 0)
                QUALIFY rank <= {TOP_K}""",
        ),
        "basket_vectors_of_digests": _with(
            ("kept", "digests"),
            f"""SELECT "CUST_CODE", basket_pos, {vector}
                FROM (SELECT "CUST_CODE", basket_pos, unnest(string_split(items, ','))::BIGINT AS idx
                      FROM kept) i
                JOIN digests d ON d.idx = i.idx GROUP BY 1, 2""",
        ),
        "item_similarity_of_digests": _with(
            ("pairs", "digests"),
            f"""SELECT p.idx_a, p.idx_b, any_value(p.n_both) AS n_both,
                       round(sum(a.v * b.v) / (sqrt(sum(a.v * a.v)) * sqrt(sum(b.v * b.v))), {DIGITS})
                           AS cosine
                FROM (SELECT a.idx AS idx_a, b.idx AS idx_b, count(*) AS n_both
                      FROM pairs a JOIN pairs b
                           ON a."BASKET_ID" = b."BASKET_ID" AND a.idx < b.idx GROUP BY 1, 2) p
                JOIN digests a ON a.idx = p.idx_a
                JOIN digests b ON b.idx = p.idx_b AND b.j = a.j
                GROUP BY 1, 2""",
        ),
        "model_cells": _with(
            ("train_x", "scores", "train_labels"),
            f"""SELECT x."CUST_CODE", x.idx, (l.idx IS NOT NULL)::BIGINT AS y,
                       round(s.p, {DIGITS}) AS recency,
                       round(x.n_with / x.n_x, {DIGITS}) AS frequency,
                       x.in_last::DOUBLE AS in_last,
                       round(ln(o.n_own / t.n + 1e-6), {DIGITS}) AS popularity
                FROM train_x x
                JOIN scores s ON s."CUST_CODE" = x."CUST_CODE" AND s.idx = x.idx
                LEFT JOIN train_labels l ON l."CUST_CODE" = x."CUST_CODE" AND l.idx = x.idx
                JOIN (SELECT idx, count(*) AS n_own FROM train_x GROUP BY 1) o ON o.idx = x.idx
                CROSS JOIN (SELECT count(DISTINCT "CUST_CODE") AS n FROM train_x) t""",
        ),
        "model_weights": _with(
            ("train_labels", "train_x", "width"),
            """SELECT y, round(sum(CASE WHEN pos = 0 OR pos = n THEN cells
                                        ELSE n / 2 END), 3) AS weight
               FROM (SELECT y, pos, n, CASE WHEN y = 1 THEN pos ELSE n - pos END AS cells
                     FROM (SELECT w.idx, count(l.idx) AS pos
                           FROM width w LEFT JOIN train_labels l ON l.idx = w.idx GROUP BY 1)
                     CROSS JOIN (SELECT count(DISTINCT "CUST_CODE") AS n FROM train_x)
                     CROSS JOIN (SELECT unnest([0, 1])::BIGINT AS y))
               WHERE cells > 0 GROUP BY 1""",
        ),
        "item_affinity": _with(
            ("pairs", "kept"),
            f"""SELECT idx_a, idx_b, n_both,
                       round(n_both / n_baskets, {DIGITS}) AS support,
                       round(n_both / n_a, {DIGITS}) AS confidence_ab,
                       round(n_both / n_b, {DIGITS}) AS confidence_ba,
                       round(n_both * n_baskets / (n_a * n_b), {DIGITS}) AS lift
                FROM (SELECT a.idx AS idx_a, b.idx AS idx_b, count(*) AS n_both
                      FROM pairs a JOIN pairs b
                           ON a."BASKET_ID" = b."BASKET_ID" AND a.idx < b.idx GROUP BY 1, 2)
                JOIN (SELECT idx AS idx_a, count(*) AS n_a FROM pairs GROUP BY 1) USING (idx_a)
                JOIN (SELECT idx AS idx_b, count(*) AS n_b FROM pairs GROUP BY 1) USING (idx_b)
                CROSS JOIN (SELECT count(*) AS n_baskets FROM kept)""",
        ),
        "nested_customer_sequences": _with(
            ("items",),
            f"""SELECT "CUST_CODE", count(items) AS n_baskets,
                       coalesce(string_agg(items, ';' ORDER BY "BASKET_ID"), '') AS baskets
                FROM (SELECT "CUST_CODE", "BASKET_ID",
                             CASE WHEN count(*) < {MAX_ITEMS}
                                  THEN string_agg("PROD_CODE", ',' ORDER BY "PROD_CODE") END AS items
                      FROM items GROUP BY 1, 2)
                GROUP BY 1 HAVING count(items) < {MAX_SEQ}""",
        ),
        "history_items_as_of": _with(
            ("items",),
            """, placed AS (
                 SELECT "CUST_CODE", "PROD_CODE",
                        dense_rank() OVER (PARTITION BY "CUST_CODE" ORDER BY "BASKET_ID") AS pos
                 FROM items),
               requests AS (
                 SELECT DISTINCT "CUST_CODE", unnest([(n + 1) // 2, n]) AS as_of
                 FROM (SELECT "CUST_CODE", max(pos) AS n FROM placed GROUP BY 1))
               SELECT p."CUST_CODE", as_of, "PROD_CODE", min(pos) AS first_pos, max(pos) AS last_pos,
                      count(*) AS times
               FROM placed p JOIN requests r ON r."CUST_CODE" = p."CUST_CODE" AND p.pos <= r.as_of
               GROUP BY 1, 2, 3""",
        ),
        "empty_landing": """SELECT * FROM (VALUES ('calendar', 0::BIGINT, 3::BIGINT),
                            ('transactions', 0::BIGINT, 22::BIGINT)) t(name, n_rows, n_columns)""",
        "profile_schema": _schema_rows(),
        "item_neighbours": _with(
            ("x_neighbours",), "SELECT idx, rank, other, n_both, similarity, cut FROM x_neighbours"
        ),
        "collaborative_scores": _with(
            ("collaborative",), 'SELECT "CUST_CODE", idx, p FROM collaborative'
        ),
        "collaborative_slack": _with(
            ("scores", "x_neighbours"),
            f"""SELECT "CUST_CODE", round(sum(p * coalesce(cut, 0)), {SCORE_DIGITS - 1}) AS slack
                FROM scores s LEFT JOIN (SELECT DISTINCT idx, cut FROM x_neighbours) n ON n.idx = s.idx
                WHERE s.idx <> 0 GROUP BY 1""",
        ),
        "item_substitutes": _with(
            ("all_pairs",),
            f""", listed AS (
                  SELECT a AS idx, b AS other, round(n_both / sqrt(n_a * n_b), {SCORE_DIGITS}) AS s,
                         row_number() OVER (
                             PARTITION BY a
                             ORDER BY round(n_both / sqrt(n_a * n_b), {SCORE_DIGITS}) DESC, b) AS rank
                  FROM all_pairs QUALIFY rank <= {BEST}),
                profile AS (
                  SELECT idx, other, s / sqrt(sum(s * s) OVER (PARTITION BY idx)) AS w FROM listed),
                alike AS (
                  SELECT x.idx, y.idx AS other, round(sum(x.w * y.w), {SCORE_DIGITS - 1}) AS similarity
                  FROM profile x JOIN profile y ON x.other = y.other AND x.idx <> y.idx GROUP BY 1, 2)
                SELECT idx, other, similarity,
                       row_number() OVER (PARTITION BY idx ORDER BY similarity DESC, other) AS rank
                FROM (SELECT * FROM alike WHERE similarity >= {LEAST_SIMILARITY}
                      AND NOT EXISTS (SELECT 1 FROM all_pairs p
                                      WHERE p.a = alike.idx AND p.b = alike.other))
                QUALIFY rank <= {SUBSTITUTES}""",
        ),
        "item_transitions": _with(
            ("followed",),
            f"""SELECT idx_a, idx_b, n_ab, n_a, n_b, round(p, {DIGITS}) AS p,
                       round(p / (n_b / n_steps), {DIGITS}) AS lift FROM followed""",
        ),
        "following_scores": _with(
            ("following",), 'SELECT "CUST_CODE", idx, p FROM following'
        ),
        "personal_cells": _with(
            ("personal",), f"""SELECT "CUST_CODE", idx, y, recency, round(frequency, {DIGITS}) AS frequency, in_last,
                       neighbours, follows, round(popularity, {DIGITS}) AS popularity FROM personal"""
        ),
        "personal_training_rows": _with(
            ("personal_dense",),
            f"""SELECT y, count(*) AS n, {", ".join(f"round(sum({c}), 3) AS {c}" for c in FEATURES)}
                FROM personal_dense GROUP BY 1""",
        ),
        "model_fit_check": _with(
            ("personal_dense",),
            " UNION ALL ".join(
                f"""SELECT '{name}' AS feature, round(sum(y * {value}), 4) AS observed,
                           round(sum(y * {value}), 4) AS fitted FROM personal_dense"""
                for name, value in {"intercept": "1.0::DOUBLE", **{c: c for c in FEATURES}}.items()
            ),
        ),
        "item_pmi": _with(
            ("all_pairs", "kept"),
            f"""SELECT a AS idx_a, b AS idx_b,
                       round(ln(n_both * n / (n_a * n_b)::DOUBLE), {DIGITS}) AS value
                FROM all_pairs CROSS JOIN (SELECT count(*) AS n FROM kept)
                WHERE ln(n_both * n / (n_a * n_b)::DOUBLE) > 0""",
        ),
        "item_vectors_check": f"""SELECT range AS component, true AS apart, true AS fits
                                  FROM range({SETTINGS.embedding_size})""",
        "position_gradient": _with(
            ("age_draws",),
            f"""SELECT age, round(sum(-{1 - MIXED} * w / total * (share - s) / p * (1 - e * e)), {DIGITS})
                       AS value FROM age_draws WHERE age IS NOT NULL GROUP BY 1
                UNION ALL
                SELECT -1, round(sum(loss), {DIGITS})
                FROM (SELECT any_value(-ln(p)) AS loss FROM age_draws GROUP BY "CUST_CODE", idx)""",
        ),
        "position_scores": _with(
            ("usable", "ages"),
            f"""SELECT "CUST_CODE", idx, round(sum(w / total), {SCORE_DIGITS}) AS p
                FROM (SELECT DISTINCT "CUST_CODE", basket_pos, w, total,
                             unnest(string_split(padded, ','))::BIGINT AS idx
                      FROM (SELECT u.*, exp(a.e) AS w,
                                   sum(exp(a.e)) OVER (PARTITION BY "CUST_CODE") AS total
                            FROM usable u JOIN ages a ON a.age = n_baskets - 1 - basket_pos
                            WHERE basket_pos < n_baskets))
                GROUP BY 1, 2""",
        ),
        "pooling_check": _with(
            ("usable", "digests"),
            """, placed AS (
                 SELECT * FROM (
                   SELECT "CUST_CODE", basket_pos, unnest(string_split(padded, ','))::BIGINT AS idx,
                          generate_subscripts(string_split(padded, ','), 1) - 1 AS place
                   FROM usable WHERE split = 'train' AND basket_pos < n_baskets) WHERE idx <> 0),
               targets AS (
                 SELECT "CUST_CODE", basket_pos - 1 AS basket_pos, j, avg(v) AS m
                 FROM placed JOIN digests USING (idx) GROUP BY 1, 2, 3)
               SELECT p.place, d.j AS component, t.j AS target, round(sum(d.v * t.m), 4) AS aimed,
                      round(sum(d.v * t.m), 4) AS reached
               FROM placed p JOIN digests d ON d.idx = p.idx
               JOIN targets t ON t."CUST_CODE" = p."CUST_CODE" AND t.basket_pos = p.basket_pos
               GROUP BY 1, 2, 3""",
        ),
    }
