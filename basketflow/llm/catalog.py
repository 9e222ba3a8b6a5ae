"""One query per corpus operator, over its whole table, with production parameters."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import (
    hard_negatives,
    jaccard_join,
    language_id,
    lm_score,
    mixing,
    packing,
    personal_data,
    prefix_trie,
    quality_rules,
    secret_scan,
    token_shards,
    toxicity,
    vector_search,
)
from basketflow.llm.shared import crc_bucket, documents, ship
from basketflow.session import scratch_path


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.mix(documents(spark, folder))
    each = taken.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
    return each.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def op2_jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, folder))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = language_id.fit(docs.where(crc_bucket("doc_id", 5) != 0))
    held_out = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    found = language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return secret_scan.scan_secrets(docs, secret_scan.fit(docs), drop_text=True)


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return personal_data.scan_personal_data(docs, personal_data.fit(docs), drop_text=True)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, labels), drop_text=True)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
    )


def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    part = crc_bucket("doc_id", 7)
    return lm_score.score(documents(spark, folder), part != 2, part == 2)


def op8_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = scratch_path(spark, "shards")
    token_shards.write_shards(token_shards.training_order(documents(spark, folder), tokenizer), path)
    return token_shards.read_from(spark, path, 0)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(documents(spark, folder), tokenizer, with_ids=False)


def op10_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    vectors = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    return vector_search.nearest(vectors, F.col("vec_id") % 20 == 0)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return prefix_trie.trie(spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet"))


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    held_out = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    model = toxicity.fit(docs.where(crc_bucket("doc_id", 5) != 0), labels)
    return toxicity.score(docs.withColumn("held_out", held_out), model, drop_text=True)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    vectors = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(
        "vec_id", hard_negatives.whole_numbers("embedding").alias("vector"), moved.alias("label")
    )
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_jaccard_components": op2_jaccard_components,
    "op3_language_id": op3_language_id,
    "op4_secret_scan": op4_secret_scan,
    "op5_personal_data": op5_personal_data,
    "op6_quality_rules": op6_quality_rules,
    "op7_lm_score": op7_lm_score,
    "op8_token_shards": op8_token_shards,
    "op9_packing": op9_packing,
    "op10_vector_search": op10_vector_search,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_toxicity": op12_toxicity,
    "op13_hard_negatives": op13_hard_negatives,
}

# What is learned has no SQL; op10's error bounds are wide enough for the exact result.
ORACLE_SQL: dict[str, str] = {
    "op10_vector_search": """
        with valid as (
            select vec_id, embedding::double[] as v from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        scored as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score
            from valid q join valid c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
            where q.vec_id % 20 = 0
        ),
        ranked as (
            select query_id, vec_id, score,
                   row_number() over (partition by query_id order by score desc, vec_id) as rank
            from scored
        )
        select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 20
    """,
    # The CRC-32 takes each byte in and then eight bits, one list entry for each bit.
    "op11_prefix_trie": """
        with turns as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   row_number() over (
                       partition by conv_id order by turn nulls first,
                       md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
                   ) as pos
            from conversations where conv_id is not null
        ),
        convs as (
            select conv_id,
                   xor(list_reduce(
                       list_prepend(4294967295::bigint, flatten(list_transform(
                           string_split(conv_id::varchar, ''),
                           lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]
                       ))),
                       lambda crc, bits: xor(xor(crc, bits) // 2, (xor(crc, bits) % 2) * 3988292384)
                   ), 4294967295) % 6 as h
            from (select distinct conv_id from turns)
        ),
        rebuilt as (
            select c.conv_id, t.pos as at, t.role, t.text
            from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 100 and t.pos <= c.h
            union all
            select c.conv_id, 10 + t.pos, t.role, t.text
            from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h
        ),
        lists as (
            select c.conv_id,
                   coalesce(list({'r': r.role, 't': r.text} order by r.at) filter (where r.at is not null), [])
                       as turns
            from convs c left join rebuilt r on r.conv_id = c.conv_id group by c.conv_id
        ),
        prefixes as (
            select conv_id, turns, d, len(turns) = d as whole, md5(list_slice(turns, 1, d)::varchar) as key
            from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from lists)
        ),
        nodes as (
            select d, key, min(conv_id) as conv_id, count(*) as n_convs, any_value(list_slice(turns, 1, d)) as path,
                   sha256(coalesce(
                       string_agg(conv_id::varchar, ',' order by conv_id) filter (where whole), ''
                   )) as ends_sha256
            from prefixes group by d, key
        ),
        steps as (
            select *, case when d > 0 then md5(list_slice(path, 1, d - 1)::varchar) end as parent from nodes
        ),
        kids as (
            select d - 1 as d, parent as key, count(*) as n_children from steps where d > 0 group by d, parent
        ),
        counted as (
            select s.*, coalesce(k.n_children, 0) as n_children
            from steps s left join kids k on k.d = s.d and k.key = s.key
        ),
        subtrees as (
            select up as d, md5(list_slice(path, 1, up)::varchar) as key,
                   sum(case when n_children = 0 then 1 else 0 end) as n_leaves,
                   sum(case when d > 0 then (n_convs - 1) * length(path[d].t) else 0 end) as saved_tokens
            from (select *, unnest(range(d + 1)) as up from counted) group by all
        )
        select c.conv_id, c.d as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children,
               s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, c.ends_sha256
        from counted c join subtrees s on s.d = c.d and s.key = c.key
        left join nodes p on p.d = c.d - 1 and p.key = c.parent
    """,
    "op13_hard_negatives": """
        with valid as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
                   list_inner_product(a.v, c.v)::bigint as score
            from valid a join valid c on a.vec_id <> c.vec_id and len(a.v) = len(c.v)
            where a.vec_id % 50 = 0
        ),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        )
        select p.anchor_id, p.positive_id,
               row_number() over (
                   partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id
               )::integer as rank,
               n.vec_id as negative_id, p.positive_score, n.score as negative_score
        from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
        where 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
        qualify rank <= 3
    """,
}
