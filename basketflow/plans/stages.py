"""Stages that read the tables of the stage before and write their own.

Each stage is one or a few lazy plans that end in a write, so a lost executor costs recomputing
its tasks only, and a failed stage is run again from stored tables.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators import embeddings as emb
from basketflow.operators import examples as ex
from basketflow.operators import model as mdl
from basketflow.operators import profiling, sampling
from basketflow.operators.metrics import class_weights, example_count
from basketflow.operators.sequences import padded_sequences
from basketflow.operators.vocabulary import vocabulary
from basketflow.sources.landing import read_landing
from basketflow.sources.tables import read_table, write_examples, write_staged, write_table


@dataclass(frozen=True)
class Settings:
    """Sizes and shares of the flow."""

    sample_rate: float = 1.0
    num_prods: int = 4900  # vocabulary entries, the unknown item included
    max_items: int = 16  # baskets need fewer items
    max_seq: int = 80  # customers need fewer baskets
    shares: tuple[float, float, float] = ex.SHARES
    embedding_size: int = 128
    use_class_weights: bool = True
    regularizations: tuple[float, ...] = (1e-4, 1e-2)

    @property
    def num_labels(self) -> int:
        return self.num_prods + 1


def profile(df: DataFrame, distinct: dict[str, str]) -> dict[str, DataFrame]:
    """All profile tables of a table, by name."""
    return {
        "head": profiling.head(df),
        "schema": profiling.schema_table(df),
        "counts": profiling.counts(df),
        "distinct": profiling.distinct_counts(df, distinct),
        "duplicates": profiling.duplicate_counts(df),
        "missing": profiling.missing_fractions(df),
        "top_values": profiling.heavy_values(df),
        "numeric": profiling.numeric_profile(df),
    }


TRANSACTION_KEYS = {"BASKET_ID": "n_baskets", "PROD_CODE": "n_products", "SHOP_WEEK": "n_weeks"}
CALENDAR_KEYS = {"SHOP_WEEK": "n_weeks"}


def stage(spark: SparkSession, landing: str, staging: str) -> None:
    """CSV files to staged Parquet, with the profile tables beside it.

    The profiles read the Parquet just written, not the text files.
    """
    calendar, transactions = read_landing(spark, landing)
    for name, df, keys in (
        ("trans-data", transactions, TRANSACTION_KEYS),
        ("time-data", calendar, CALENDAR_KEYS),
    ):
        write_staged(df, f"{staging}/{name}")
        staged = read_table(spark, f"{staging}/{name}")
        for part, table in profile(staged, keys).items():
            write_table(table, f"{staging}/profile/{name}/{part}")


def examples_of(lines: DataFrame, vocab: DataFrame, settings: Settings) -> DataFrame:
    """(customer, x, y, split): x without sequence padding, y as the items of the last basket.

    The split is drawn over all customers, before the ones without a usable sequence drop out.
    """
    s = settings
    sequences = padded_sequences(lines, vocab, s.num_prods, s.max_items, s.max_seq)
    customers = sampling.customer_keys(lines).dropna()
    cuts = ex.split_cuts(customers, s.shares)
    return ex.assign_split(ex.x_y(sequences, s.max_seq), cuts)


def preprocess(spark: SparkSession, staging: str, output: str, settings: Settings) -> None:
    """Staged transactions to a vocabulary and training examples."""
    lines = read_table(spark, f"{staging}/trans-data")
    if settings.sample_rate < 1:
        lines = sampling.sample_customers(lines, settings.sample_rate)
    write_table(vocabulary(lines, settings.num_prods), f"{output}/vocabulary")
    vocab = read_table(spark, f"{output}/vocabulary")
    write_examples(examples_of(lines, vocab, settings), f"{output}/examples")


def padded_examples(examples: DataFrame, settings: Settings) -> DataFrame:
    """Examples as a network wants them: x padded to max_seq baskets, y as a 0/1 vector."""
    padded = ex.pad_sequences(examples, settings.max_seq, settings.max_items)
    return ex.with_multi_hot(padded, settings.num_prods)


def train(spark: SparkSession, data: str, output: str, settings: Settings) -> None:
    """Fit embeddings and model on the train split and evaluate on the others.

    Of the given regularisations the one with the smallest loss on the valid split is taken; the
    first where that split is empty. The test split has no part in the choice.
    """
    s = settings
    examples = read_table(spark, f"{data}/examples")
    of_train, of_test, of_valid = (
        examples.where(F.col("split") == part) for part in ("train", "test", "valid")
    )
    baskets = of_train.select(F.explode("x").alias("items"))
    learned = emb.fit_item_embeddings(baskets, s.max_items, s.embedding_size)
    write_table(emb.item_embeddings(learned, s.num_labels), f"{output}/embeddings")
    vectors = read_table(spark, f"{output}/embeddings")
    weights = None
    if s.use_class_weights:
        weights = class_weights(ex.labels(of_train), example_count(of_train), s.num_labels)
        write_table(weights, f"{output}/class-weights")
        weights = read_table(spark, f"{output}/class-weights")

    def evaluated(model, popularity, part, name):
        """Scores of a split, stored, and their evaluation."""
        scores, background = mdl.predict(model, part, popularity, s.num_labels, vectors)
        write_table(scores, f"{output}/scores/{name}")
        write_table(background, f"{output}/background")
        scores = read_table(spark, f"{output}/scores/{name}")
        background = read_table(spark, f"{output}/background")
        result = mdl.evaluate(part, scores, s.num_labels, background, weights)
        return result.withColumn("split", F.lit(name))

    best = None
    for strength in s.regularizations:
        fitted, popularity = mdl.fit_next_basket(
            of_train, s.num_labels, vectors, s.use_class_weights, regularization=strength
        )
        valid = evaluated(fitted, popularity, of_valid, "valid")
        loss = valid.first().loss
        loss = float("inf") if loss is None else loss
        if best is None or loss < best[0]:
            best = (loss, strength, fitted, popularity)
    _, strength, model, popularity = best
    mdl.save_model(model, f"{output}/model")
    write_table(popularity, f"{output}/popularity")
    for name, part in (("valid", of_valid), ("test", of_test)):
        result = evaluated(model, popularity, part, name)
        result = result.withColumn("regularization", F.lit(strength))
        write_table(result, f"{output}/evaluation/{name}")
