"""The registered queries: every operator over the whole sample tables.

``catalog_sql`` has the same queries as plain SQL.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, FloatType, IntegerType, ShortType

from basketflow.operators import affinity, batches, embeddings, item_vectors, metrics, model
from basketflow.operators import neighbours as near
from basketflow.operators import personal, pooling, position_weights, profiling, transitions
from basketflow.operators import examples as ex
from basketflow.operators import sampling, scoring, sequences
from basketflow.operators import vocabulary as voc
from basketflow.plans.stages import TRANSACTION_KEYS, Settings, examples_of
from basketflow.schemas import BASKET, CUST, PROD, WEEK
from basketflow.session import scratch_path, shuffles_freed
from basketflow.sources import incremental, landing, sample_tables, tables
from basketflow.sources.tables import materialize

# Bounds small enough that baskets, customers and items on both sides of each occur.
SETTINGS = Settings(num_prods=500, max_items=8, max_seq=16, embedding_size=16)
BATCH_SIZE, PASSES = 32, 2
SAMPLE_RATE, NEAR_ONE = 0.5, 0.9999999999
FILE_LINES = 1_000_000
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query; numbers come out as BIGINT or DOUBLE, as in the SQL."""

    def plain(spark: SparkSession, folder: str) -> DataFrame:
        df = run(spark, folder)
        casts = []
        for f in df.schema:
            if isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
                casts.append(F.col(f.name).cast("bigint").alias(f.name))
            elif isinstance(f.dataType, FloatType):
                casts.append(F.col(f.name).cast("double").alias(f.name))
            else:
                casts.append(F.col(f.name))
        return df.select(*casts)

    plain.__name__ = run.__name__
    plain.__doc__ = run.__doc__
    QUERIES[run.__name__] = plain
    return run


def _text(items) -> F.Column:
    """An array of items as comma-separated text."""
    return F.array_join(items.cast("array<string>"), ",")


def _texts(baskets) -> F.Column:
    """An array of baskets as text."""
    return F.array_join(F.transform(baskets, _text), ";")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _vocab(lines: DataFrame) -> DataFrame:
    return voc.vocabulary(lines, SETTINGS.num_prods)


def _padded_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = sample_tables.basket_lines(spark, folder)
    return sequences.padded_rows(lines, _vocab(lines), SETTINGS.num_prods, SETTINGS.max_items)


def _examples(spark: SparkSession, folder: str) -> DataFrame:
    lines = sample_tables.basket_lines(spark, folder)
    return examples_of(lines, _vocab(lines), SETTINGS)


def _stored_examples(spark: SparkSession, folder: str) -> DataFrame:
    """Examples as the stored table that training and evaluation read more than once."""
    return materialize(_examples(spark, folder), "examples")


# Sources and sinks


@query
def stage_transactions(spark, folder):
    path = scratch_path(spark, "staged")
    tables.write_staged(sample_tables.transactions(spark, folder), path)
    return tables.read_table(spark, path)


@query
def scan_transactions_csv(spark, folder):
    """Transactions written as one CSV folder per year and read back in one scan."""
    root = scratch_path(spark, "landing")
    year = F.floor(F.col(WEEK) / 100)
    df = sample_tables.transactions(spark, folder).withColumn("YEAR", year)
    writer = df.write.partitionBy("YEAR").option("header", True)
    writer.csv(f"{root}/transactions")
    return landing.read_transactions(spark, root)


@query
def scan_calendar_csv(spark, folder):
    root = scratch_path(spark, "landing")
    tables.write_csv(sample_tables.calendar(spark, folder), f"{root}/time.csv")
    return landing.read_calendar(spark, root)


@query
def stage_incrementally(spark, folder):
    """Years of transactions that arrive one after another, each staged on its own."""
    root, staging = scratch_path(spark, "landing"), scratch_path(spark, "staged")
    year = F.floor(F.col(WEEK) / 100)
    with shuffles_freed(spark):
        shares = [s.withColumn("YEAR", year) for s in sample_tables.transaction_shares(spark, folder)]
        df = materialize(shares, "arriving", compression=tables.COMPACT)
        years = sorted(r.YEAR for r in df.select("YEAR").distinct().collect())
        halves = years[: len(years) // 2], years[len(years) // 2 :]
        for i, some in enumerate(halves):
            part = df.where(F.col("YEAR").isin(some)).drop("YEAR")
            # Compressed files cannot be divided between tasks, so none is large.
            writer = part.write.mode("append").option("header", True)
            writer.options(compression="gzip", maxRecordsPerFile=FILE_LINES).csv(f"{root}/transactions")
            if i == 1:
                tables.release(df)  # all of it has landed
            incremental.stage_new(spark, root, staging)
        incremental.stage_new(spark, root, staging)
    return incremental.staged_lines(spark, staging)


@query
def empty_landing(spark, folder):
    """Landing tables where no file has arrived: both are there, with their columns and no rows."""
    calendar, lines = landing.read_landing(spark, scratch_path(spark, "no-landing"))
    named = [("calendar", calendar), ("transactions", lines)]
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in named
    ]
    return counts[0].unionByName(counts[1])


# Profiles


@query
def profile_schema(spark, folder):
    return profiling.schema_table(sample_tables.transactions(spark, folder))


@query
def profile_head(spark, folder):
    order = (CUST, BASKET, PROD, "SPEND", "QUANTITY", "STORE_CODE")
    return profiling.head(sample_tables.transactions(spark, folder), 10, order)


@query
def profile_counts(spark, folder):
    return profiling.counts(sample_tables.transactions(spark, folder))


@query
def profile_distinct_keys(spark, folder):
    df = sample_tables.transactions(spark, folder)
    return profiling.distinct_counts(df, TRANSACTION_KEYS)


@query
def profile_duplicates(spark, folder):
    return profiling.duplicate_counts(sample_tables.transactions(spark, folder))


@query
def profile_duplicate_lines(spark, folder):
    """Duplicates among (customer, basket, item) lines."""
    return profiling.duplicate_counts(sample_tables.basket_lines(spark, folder))


@query
def profile_missing(spark, folder):
    df = profiling.missing_fractions(sample_tables.transactions(spark, folder))
    return _rounded(df, "missing")


@query
def profile_numeric(spark, folder):
    df = profiling.numeric_profile(sample_tables.transactions(spark, folder))
    return df.withColumns({c: F.round(c, 3) for c in ("mean", "max", "min", "stddev")})


@query
def profile_top_values(spark, folder):
    return profiling.top_values(sample_tables.transactions(spark, folder))


@query
def profile_heavy_values(spark, folder):
    """The same by a frequent-items summary; few tracked values, so that some columns need a full count."""
    df = materialize(sample_tables.transactions(spark, folder), "profiled")
    return profiling.heavy_values(df, tracked=500)


@query
def profile_calendar(spark, folder):
    df = profiling.numeric_profile(sample_tables.calendar(spark, folder))
    return df.withColumns({c: F.round(c, 3) for c in ("mean", "max", "min", "stddev")})


# Samples, baskets and sequences


@query
def customer_keys(spark, folder):
    return sampling.customer_keys(sample_tables.basket_lines(spark, folder))


@query
def customer_sample(spark, folder):
    lines = sample_tables.basket_lines(spark, folder)
    return sampling.sample_customers(lines, SAMPLE_RATE)


@query
def customer_sample_near_one(spark, folder):
    lines = sample_tables.basket_lines(spark, folder)
    return sampling.sample_customers(lines, NEAR_ONE)


@query
def item_lines(spark, folder):
    return voc.item_lines(sample_tables.basket_lines(spark, folder))


@query
def basket_rollup(spark, folder):
    return sequences.basket_items(sample_tables.basket_lines(spark, folder))


@query
def basket_sets(spark, folder):
    """The kept baskets as arrays."""
    items = sequences.basket_items(sample_tables.basket_lines(spark, folder))
    baskets = sequences.kept_baskets(items, SETTINGS.max_items)
    return baskets.select(CUST, BASKET, _text(F.col("items")).alias("items"))


@query
def basket_sequences(spark, folder):
    return sequences.basket_sequences(sample_tables.basket_lines(spark, folder))


@query
def basket_sequences_sliced(spark, folder):
    """The same with many customers taken for heavy, so that they are ranked in slices."""
    return sequences.basket_sequences(sample_tables.basket_lines(spark, folder), heavy_after=30)


@query
def customer_sequences(spark, folder):
    """Items of every customer's sequence by the place of their basket."""
    rows = sequences.basket_sequences(sample_tables.basket_lines(spark, folder))
    return rows.select(CUST, "basket_pos", PROD)


@query
def basket_history(spark, folder):
    return sequences.basket_history(sample_tables.basket_lines(spark, folder))


@query
def basket_history_in_stretches(spark, folder):
    """The same with sums that run over a few baskets each."""
    return sequences.basket_history(sample_tables.basket_lines(spark, folder), stretch=3)


@query
def nested_customer_sequences(spark, folder):
    """The nested form: every modelled customer with its kept baskets as one text."""
    lines = sample_tables.basket_lines(spark, folder)
    df = sequences.customer_sequences(lines, SETTINGS.max_items, SETTINGS.max_seq)
    return df.select(CUST, F.size("baskets").alias("n_baskets"), _texts(F.col("baskets")).alias("baskets"))


@query
def history_items_as_of(spark, folder):
    """The history of every customer as of the middle and the last of its baskets."""
    occurrences = materialize(
        sequences.item_occurrences(sample_tables.basket_lines(spark, folder)), "occurrences"
    )
    length = occurrences.groupBy(CUST).agg(F.max("basket_pos").alias("n"))
    wanted = F.array(F.floor((F.col("n") + 1) / 2), F.col("n"))
    requests = length.select(CUST, F.explode(F.array_distinct(wanted)).alias("as_of"))
    return sequences.history_items_as_of(occurrences, requests)


# Vocabulary


@query
def vocabulary(spark, folder):
    return _vocab(sample_tables.basket_lines(spark, folder))


@query
def vocabulary_reverse(spark, folder):
    return voc.reverse_vocabulary(_vocab(sample_tables.basket_lines(spark, folder)))


@query
def item_lines_indexed(spark, folder):
    lines = sample_tables.basket_lines(spark, folder)
    return voc.encode_items(lines, _vocab(lines), SETTINGS.num_prods)


@query
def indexed_sequences(spark, folder):
    lines = sample_tables.basket_lines(spark, folder)
    rows = sequences.indexed_rows(lines, _vocab(lines), SETTINGS.num_prods)
    return rows.select(CUST, "basket_pos", PROD, "idx")


@query
def padded_baskets(spark, folder):
    """Every kept basket; customers without one show as a row without items."""
    rows = _padded_rows(spark, folder)
    return rows.select(CUST, "basket_pos", _text(F.col("items")).alias("items"))


# Splits, examples and batches


@query
def split_assignment(spark, folder):
    customers = sampling.customer_keys(sample_tables.basket_lines(spark, folder))
    return ex.split_customers(customers)


@query
def split_sizes(spark, folder):
    customers = sampling.customer_keys(sample_tables.basket_lines(spark, folder))
    return ex.split_sizes(ex.split_customers(customers))


@query
def examples_x(spark, folder):
    df = ex.pad_sequences(_examples(spark, folder), SETTINGS.max_seq, SETTINGS.max_items)
    return df.select(CUST, "split", F.posexplode("x").alias("at", "basket")).select(
        CUST, "split", (F.col("at") + 1).alias("basket_pos"), _text(F.col("basket")).alias("items")
    )


@query
def examples_y_labels(spark, folder):
    return ex.labels(_examples(spark, folder))


@query
def examples_multi_hot(spark, folder):
    df = ex.with_multi_hot(_examples(spark, folder), SETTINGS.num_prods)
    return df.select(CUST, "split", F.array_join(F.col("y").cast("array<string>"), "").alias("y"))


@query
def example_checks(spark, folder):
    s = SETTINGS
    df = ex.pad_sequences(_examples(spark, folder), s.max_seq, s.max_items)
    return ex.check_examples(df, s.max_seq, s.max_items)


@query
def batch_assignment(spark, folder):
    examples = _stored_examples(spark, folder).select(CUST)
    return batches.batches(examples, BATCH_SIZE, PASSES)


@query
def batch_assignment_in_order(spark, folder):
    examples = _stored_examples(spark, folder).select(CUST)
    return batches.batches(examples, BATCH_SIZE, PASSES, shuffle=False)


@query
def batch_examples(spark, folder):
    """Batches with the x and y of their examples."""
    placed = batches.batches(_stored_examples(spark, folder).drop("split"), BATCH_SIZE, PASSES)
    return placed.select(
        "batch_id", "slot", CUST, _texts(F.col("x")).alias("x"), _text(F.col("y")).alias("y")
    )


# Class weights, scores and metrics


def _part(examples: DataFrame, split: str) -> DataFrame:
    return examples.where(F.col("split") == split)


def _train_weights(examples: DataFrame) -> DataFrame:
    """Class weights from the labels of the train split."""
    train = _part(examples, "train")
    return metrics.class_weights(ex.labels(train), metrics.example_count(train), SETTINGS.num_labels)


@query
def class_weights(spark, folder):
    return _rounded(_train_weights(_stored_examples(spark, folder)), "w_neg", "w_pos")


@query
def recency_scores(spark, folder):
    return _rounded(scoring.recency_scores(_examples(spark, folder)), "p")


@query
def top_k_items(spark, folder):
    """The items with the best recency scores, by name."""
    lines = sample_tables.basket_lines(spark, folder)
    best = scoring.top_scored(scoring.recency_scores(_examples(spark, folder)), metrics.TOP_K)
    named = voc.decode_items(best, _vocab(lines), SETTINGS.num_prods, spread=CUST)
    return _rounded(named, "p").select(CUST, "rank", "idx", "prod_code", "p")


@query
def top_k_all_items(spark, folder):
    """The same among all labels: unscored ones count as 0 and fill up the ranks."""
    examples = _stored_examples(spark, folder)
    scores = scoring.recency_scores(examples)
    return _rounded(
        scoring.top_items(scores, examples, metrics.TOP_K, SETTINGS.num_labels), "p"
    )


def _outcomes(examples: DataFrame, weighted: bool) -> DataFrame:
    labels, n = ex.labels(examples), metrics.example_count(examples)
    weights = _train_weights(examples) if weighted else None
    scores = scoring.recency_scores(examples)
    return metrics.label_outcomes(labels, scores, n, SETTINGS.num_labels, weights=weights)


def _summary(spark, folder, *columns: str, weighted: bool = False) -> DataFrame:
    examples = _stored_examples(spark, folder)
    df = metrics.summary(_outcomes(examples, weighted), metrics.example_count(examples))
    return _rounded(df.select(*columns), *columns)


@query
def label_outcomes(spark, folder):
    df = _outcomes(_stored_examples(spark, folder), weighted=True)
    return _rounded(df, "loss")


@query
def loss_weighted_bce(spark, folder):
    return _summary(spark, folder, "loss", weighted=True)


@query
def loss_bce(spark, folder):
    return _summary(spark, folder, "loss")


@query
def metric_accuracy(spark, folder):
    return _summary(spark, folder, "accuracy")


@query
def metric_macro_prf(spark, folder):
    return _summary(spark, folder, "precision", "recall", "f1")


@query
def metric_topk(spark, folder):
    examples = _stored_examples(spark, folder)
    scores = scoring.recency_scores(examples)
    df = metrics.top_k_metrics(ex.labels(examples), scores, examples, SETTINGS.num_labels)
    return _rounded(df, "recall", "precision")


@query
def evaluation_recency(spark, folder):
    """The whole evaluation of the recency scores, on the test split."""
    return _evaluated(_stored_examples(spark, folder), "test")


def _evaluated(examples: DataFrame, split: str) -> DataFrame:
    part, weights = _part(examples, split), _train_weights(examples)
    scores = scoring.recency_scores(part)
    df = model.evaluate(part, scores, SETTINGS.num_labels, weights=weights)
    return _rounded(df, *df.columns)


@query
def evaluation_by_split(spark, folder):
    examples = _stored_examples(spark, folder)
    parts = [
        _evaluated(examples, split).select(F.lit(split).alias("split"), "*")
        for split in ("train", "test", "valid")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def next_basket_items(spark, folder):
    """The items with the best recency scores of every customer, unknown items left out."""
    examples = _stored_examples(spark, folder)
    best = scoring.top_items(
        scoring.recency_scores(examples),
        examples,
        metrics.TOP_K,
        SETTINGS.num_labels,
        exclude_pad_label=True,
    )
    return _rounded(best, "p")


# Affinity, embeddings and the model


def _kept_baskets(spark: SparkSession, folder: str) -> DataFrame:
    lines = sample_tables.basket_lines(spark, folder)
    items = voc.encode_items(
        sequences.basket_items(lines), _vocab(lines), SETTINGS.num_prods
    )
    return sequences.basket_arrays(items, SETTINGS.max_items, "idx")


@query
def item_affinity(spark, folder):
    df = affinity.item_affinity(_kept_baskets(spark, folder))
    return _rounded(df, "support", "confidence_ab", "confidence_ba", "lift")


def _embeddings(examples: DataFrame) -> DataFrame:
    baskets = examples.where("split = 'train'").select(F.explode("x").alias("items"))
    learned = embeddings.fit_item_embeddings(
        baskets, SETTINGS.max_items, SETTINGS.embedding_size
    )
    return embeddings.item_embeddings(learned, SETTINGS.num_labels)


@query
def item_embeddings(spark, folder):
    return _embeddings(_stored_examples(spark, folder))


@query
def item_similarity(spark, folder):
    """Cosine of the vectors of items that share a basket."""
    pairs = affinity.item_affinity(_kept_baskets(spark, folder))
    vectors = _embeddings(_stored_examples(spark, folder))
    df = embeddings.pair_similarity(pairs, vectors, SETTINGS.num_labels)
    return df.select("idx_a", "idx_b", "n_both", "cosine")


@query
def basket_vectors(spark, folder):
    vectors = _embeddings(_stored_examples(spark, folder))
    return embeddings.basket_vectors(_padded_rows(spark, folder), vectors, SETTINGS.num_labels)


DIGEST_SIZE = 4


def _digest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """A vector for every vocabulary index from the md5 of its item; zero for index 0."""
    vocab = _vocab(sample_tables.basket_lines(spark, folder))

    def value(j: int):
        digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(j)), "prod_code")), 1, 4)
        return (F.conv(digits, 16, 10).cast("double") / 65536 - 0.5).cast("float")

    vector = F.array(*[value(j) for j in range(DIGEST_SIZE)])
    zero = F.array_repeat(F.lit(0.0).cast("float"), DIGEST_SIZE)
    known = vocab.select("idx", F.when(F.col("idx") == 0, zero).otherwise(vector).alias("vector"))
    return materialize(known, "digest-vectors")


@query
def basket_vectors_of_digests(spark, folder):
    """Mean vectors of the padded baskets, with vectors that do not have to be learned."""
    df = embeddings.basket_vectors(
        _padded_rows(spark, folder), _digest_vectors(spark, folder), SETTINGS.num_labels
    )
    parts = [F.round(F.col("vector")[j].cast("double"), 5).alias(f"v{j}") for j in range(DIGEST_SIZE)]
    return df.select(CUST, "basket_pos", *parts)


@query
def item_similarity_of_digests(spark, folder):
    pairs = affinity.item_affinity(_kept_baskets(spark, folder))
    df = embeddings.pair_similarity(pairs, _digest_vectors(spark, folder), SETTINGS.num_labels)
    return _rounded(df.select("idx_a", "idx_b", "n_both", "cosine"), "cosine")


def _train_cells(spark: SparkSession, folder: str):
    """Train examples, the popularity of items, and feature rows without embeddings."""
    train = _stored_examples(spark, folder).where("split = 'train'")
    popularity = model.item_popularity(train, SETTINGS.num_labels)
    features = model.own_features(train, popularity, SETTINGS.num_labels)
    return train, popularity, model.own_cells(train, features)


@query
def model_cells(spark, folder):
    """What the model is fitted on: features and label of every item of a train history."""
    _, _, cells = _train_cells(spark, folder)
    return _rounded(cells, "recency", "frequency", "popularity").drop("fit")


@query
def model_weights(spark, folder):
    """Training weight per label value; the rows stand for all customers and items."""
    train, popularity, cells = _train_cells(spark, folder)
    width = SETTINGS.num_labels
    weights = metrics.class_weights(ex.labels(train), metrics.example_count(train), width)
    rows = model.training_rows(train, cells, popularity, weights, width)
    total = F.round(F.sum("weight"), 3).alias("weight")
    return rows.groupBy(F.col("y").cast("bigint").alias("y")).agg(total)


def _predicted(spark: SparkSession, folder: str):
    """Test examples with their own and background scores, and the class weights."""
    examples = _stored_examples(spark, folder)
    train, test = examples.where("split = 'train'"), examples.where("split = 'test'")
    width = SETTINGS.num_labels
    vectors = materialize(_embeddings(examples), "embeddings")
    fitted, popularity = model.fit_next_basket(train, width, vectors)
    path = scratch_path(spark, "model")
    model.save_model(fitted, path)
    loaded = model.load_model(path)
    scores, background = model.predict(loaded, test, popularity, width, vectors)
    weights = metrics.class_weights(ex.labels(train), metrics.example_count(train), width)
    return test, scores, background, weights


@query
def next_basket_predictions(spark, folder):
    """The most probable items of the next basket of every test customer, by name."""
    test, scores, background, _ = _predicted(spark, folder)
    best = scoring.top_items(
        scores, test, metrics.TOP_K, SETTINGS.num_labels, background, exclude_pad_label=True
    )
    vocab = _vocab(sample_tables.basket_lines(spark, folder))
    return voc.decode_items(best, vocab, SETTINGS.num_prods, spread=CUST)


@query
def evaluation(spark, folder):
    test, scores, background, weights = _predicted(spark, folder)
    scores = materialize(scores, "scores")
    return model.evaluate(test, scores, SETTINGS.num_labels, background, weights)


# Neighbours, transitions and the personal model

BEST, LEAST_SIMILARITY, SUBSTITUTES = 20, 0.12, 10


def _train_baskets(examples: DataFrame) -> DataFrame:
    """Every basket of the train histories."""
    return _part(examples, "train").select(F.explode("x").alias("items"))


def _neighbours(examples: DataFrame) -> DataFrame:
    return near.item_neighbours(_train_baskets(examples), BEST)


@query
def item_neighbours(spark, folder):
    """The items that go best with every item, and the first similarity that its list leaves out."""
    return _neighbours(_stored_examples(spark, folder))


@query
def collaborative_scores(spark, folder):
    """Every customer's scores by the neighbours of its items, in and outside its history."""
    examples = _stored_examples(spark, folder)
    history = scoring.item_history(examples)
    return near.collaborative_scores(history, _neighbours(examples), SETTINGS.num_labels, BEST)


@query
def collaborative_slack(spark, folder):
    """What a score of a customer can miss because the neighbour lists are cut."""
    examples = _stored_examples(spark, folder)
    history = scoring.item_history(examples)
    return near.collaborative_slack(history, _neighbours(examples), SETTINGS.num_labels, BEST)


@query
def item_substitutes(spark, folder):
    """Items with like neighbours that never share a basket."""
    baskets = materialize(_kept_baskets(spark, folder), "baskets")
    return near.item_substitutes(
        near.item_neighbours(baskets, BEST),
        affinity.counted_pairs(baskets),
        SETTINGS.num_labels,
        LEAST_SIMILARITY,
        SUBSTITUTES,
        BEST,
    )


@query
def item_transitions(spark, folder):
    """Which items follow which in the next basket of the train customers."""
    train = _part(_stored_examples(spark, folder), "train")
    return _rounded(transitions.item_transitions(train), "p", "lift")


@query
def following_scores(spark, folder):
    """Every customer's scores by what followed the items of its last basket elsewhere."""
    examples = _stored_examples(spark, folder)
    known = transitions.item_transitions(_part(examples, "train"))
    return transitions.following_scores(examples, known, SETTINGS.num_labels)


def _personal(spark: SparkSession, folder: str):
    """Examples, and what the personal model takes from the train split."""
    examples = _stored_examples(spark, folder)
    train = _part(examples, "train")
    popularity = personal.popularity_of(train, SETTINGS.num_labels)
    known = (_neighbours(examples), transitions.item_transitions(train), popularity, SETTINGS.num_labels, BEST)
    return examples, train, popularity, known


@query
def personal_cells(spark, folder):
    """Features and label of every (customer, item) of the train split that has any."""
    _, train, _, known = _personal(spark, folder)
    return _rounded(personal.cells(train, *known), "frequency", "popularity")


def _personal_rows(spark: SparkSession, folder: str):
    examples, train, popularity, known = _personal(spark, folder)
    own = materialize(personal.cells(train, *known), "personal-cells")
    return examples, personal.training_rows(train, own, popularity, SETTINGS.num_labels), popularity, known


@query
def personal_training_rows(spark, folder):
    """Rows, customers times items they stand for, and positives, by label."""
    _, rows, _, _ = _personal_rows(spark, folder)
    totals = [F.round(F.sum(F.col("times") * F.col(c)), 3).alias(c) for c in personal.FEATURES]
    return rows.groupBy("y").agg(F.sum("times").alias("n"), *totals)


@query
def model_fit_check(spark, folder):
    """Sums of the features over the positives, and by the fitted probabilities: equal at the optimum."""
    _, rows, _, _ = _personal_rows(spark, folder)
    checked = personal.fit_check(rows, personal.fit(rows))
    return checked.select("feature", *[F.round(c, 4).alias(c) for c in ("observed", "fitted")])


@query
def personal_predictions(spark, folder):
    """The most probable items of the next basket of every test customer, unknown items left out."""
    examples, rows, popularity, known = _personal_rows(spark, folder)
    test = _part(examples, "test")
    own = personal.cells(test, *known, labelled=False)
    scores, background = personal.predict(personal.fit(rows), own, popularity)
    best = scoring.top_items(
        scores, test, metrics.TOP_K, SETTINGS.num_labels, background, exclude_pad_label=True
    )
    return _rounded(best, "p")


@query
def item_pmi(spark, folder):
    """Positive pointwise mutual information of the items that share baskets."""
    cells = item_vectors.pmi_cells(_kept_baskets(spark, folder))
    return _rounded(cells, "value")


@query
def item_vectors_pmi(spark, folder):
    """A repeatable vector for every item, by components."""
    cells = item_vectors.pmi_cells(_kept_baskets(spark, folder))
    found = item_vectors.item_vectors(cells, SETTINGS.num_labels, SETTINGS.embedding_size)
    return found.select("idx", F.posexplode("vector").alias("component", "value"))


@query
def item_vectors_check(spark, folder):
    """Whether every vector is of length 1, at right angles to the others and nearly an eigenvector."""
    cells = item_vectors.pmi_cells(_kept_baskets(spark, folder))
    checks = item_vectors.vector_checks(cells, SETTINGS.num_labels, SETTINGS.embedding_size, passes=40)
    first = F.max(F.abs("value")).over(Window.partitionBy())
    return checks.select(
        "component", (F.col("off") < 1e-9).alias("apart"), (F.col("residual") < 0.1 * first).alias("fits")
    )


# Numbers per age at which loss and gradient are compared with the SQL.
POSITION_B = [round(0.6 - 0.1 * age, 1) for age in range(SETTINGS.max_seq)]


def _draws(spark: SparkSession, folder: str):
    train = _part(_stored_examples(spark, folder), "train")
    shares = position_weights.item_shares(train, SETTINGS.num_labels)
    return train, position_weights.draws(train, shares, SETTINGS.num_labels)


@query
def position_gradient(spark, folder):
    """Loss (age -1) and its derivative by the number of every age, at stated numbers."""
    _, rows = _draws(spark, folder)
    return _rounded(position_weights.loss_and_gradient(rows, POSITION_B), "value")


@query
def learned_position_weights(spark, folder):
    """The fitted number of every age, and whether the loss fell from even weights on."""
    _, rows = _draws(spark, folder)
    found = position_weights.fit_positions(rows, SETTINGS.max_seq)
    fell = all(a > b for a, b in zip(found.losses, found.losses[1:]))
    table = [(age, float(b), fell) for age, b in enumerate(found.b)]
    return spark.createDataFrame(table, "age int, b double, fell boolean")


@query
def position_scores(spark, folder):
    """Scores of the items of a history by the weights of their baskets' ages, at stated numbers."""
    return position_weights.position_scores(_stored_examples(spark, folder), POSITION_B)


def _pooling_steps(spark: SparkSession, folder: str):
    train = _part(_stored_examples(spark, folder), "train")
    parts = pooling.basket_parts(train, _digest_vectors(spark, folder), SETTINGS.num_labels)
    return pooling.steps(parts)


@query
def pooling_check(spark, folder):
    """Both sides of the normal equations of the learned basket pooling: equal at the optimum."""
    rows = _pooling_steps(spark, folder)
    fitted = pooling.fit_pooling(rows, SETTINGS.max_items, DIGEST_SIZE)
    checked = pooling.pooling_check(rows, fitted)
    return checked.withColumns({c: F.round(c, 4) for c in ("aimed", "reached")})
