"""A training corpus in five stages, each written and read again before the next.

Language identification drops documents without a recognisable language; the n-gram Jaccard join
keeps one document of each group of near copies; the secret scan replaces secrets in the texts; the
mix takes documents of every source as often as its weight asks; packing cuts them into sequences.
All but the last return the columns of ``documents``.
"""

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import jaccard_join, language_id, mixing, packing, secret_scan
from basketflow.llm.shared import documents, materialize, ship

# A text whose most likely language is less likely than this has none.
LEAST_SCORE = 0.35


# Names of ``documents``; columns beyond these have none that the operators could take for theirs.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_SMALL = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
}


def _small_batches(spark: SparkSession) -> None:
    """Texts for Python in smaller batches: in these stages rows are wide, and come back as wide."""
    for key, value in _SMALL.items():
        spark.conf.set(key, value)


def _apart(stage):
    """The stage with further columns of its documents under names that cannot clash."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = {c: f"document_column_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        kept = stage(spark, docs.withColumnsRenamed(others), sf_dir)
        return kept.withColumnsRenamed({hidden: c for c, hidden in others.items()})

    return run


@_apart
def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a null ``lang`` takes the one recognised.

    Null and empty texts, those without a letter, and those below LEAST_SCORE go.
    """
    ship(spark)
    found = language_id.predict(docs, language_id.fit(docs))
    kept = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


@_apart
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of every group of linked documents.

    Where a doc_id has several rows, each is judged by its own text, and those of equal text stay
    once. Rows without a doc_id stay where no row of their group has one.
    """
    ship(spark)
    _small_batches(spark)
    groups = materialize(jaccard_join.jaccard_components(docs, keep_node=True), "groups")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    counted = groups.groupBy(F.col("doc_id").alias("_id")).agg(
        F.count("*").alias("_rows"), F.count_if(first).alias("_first")
    )
    same = docs["doc_id"].eqNullSafe(F.col("_id"))
    once = docs.join(counted.where("_rows = 1 and _first = 1"), same, "left_semi")
    several = docs.join(counted.where("_rows > 1 and _first > 0"), same, "left_semi")
    several = jaccard_join.with_node(several).dropDuplicates(["doc_id", "node"])
    stay = groups.where(first).select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    own = several["doc_id"].eqNullSafe(F.col("_id")) & several["node"].eqNullSafe(F.col("_node"))
    again = several.join(stay, own, "left_semi").select(*docs.columns)
    return once.unionByName(again)


@_apart
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by its kind; n_chars follows.

    Null and empty texts stay as they are, and repeated rows and an empty table come back as such.
    """
    ship(spark)
    _small_batches(spark)
    return secret_scan.redact_texts(docs, secret_scan.fit(docs))


@_apart
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Null and empty texts have size 0 and are taken as the mix says; repeated rows are taken alike, and
    an empty table stays empty.
    """
    ship(spark)
    return mixing.apply_mix(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents with their ids; a document taken twice is packed twice."""
    ship(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, tokenizer)


STAGES = [
    ("language", keep_languages),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# Trained models decide in several stages; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
