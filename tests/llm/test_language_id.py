import corpus
import numpy as np
import pytest

from basketflow.llm import convnet, language_id


@pytest.fixture(scope="module")
def model(docs):
    return language_id.fit(docs, rows=200)


def test_held_out_texts(spark, docs, model):
    others = spark.createDataFrame(corpus.rows(9, 80)[:80], corpus.SCHEMA)
    found = language_id.predict(others, model).where("n_chars > 60").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_texts_without_letters(docs, model):
    found = language_id.predict(docs, model).collect()
    odd = [r for r in found if r.doc_id in (1000, 1001, 1002, 1007)]
    assert len(odd) == 4 and all((r.lang_pred, r.score) == ("und", 0.0) for r in odd)
    assert len(found) == docs.count() and all(r.lang_pred in model.labels + ["und"] for r in found)


def test_whole_text_counts(spark, model):
    """A long text is judged by all of it, not by how it begins."""
    import random

    rng = random.Random(3)
    long = corpus.text(rng, 40, "de") + " " + corpus.text(rng, 900, "fr")
    frame = spark.createDataFrame([(1, long, None, None, 0)], corpus.SCHEMA)
    assert language_id.predict(frame, model).first().lang_pred == "fr"


def test_clashing_columns_and_empty_tables(docs, no_docs, model):
    found = language_id.predict(corpus.clashing(docs), model)
    assert found.columns.count("score") == 1 and "kept" in found.columns
    assert dict(found.dtypes)["score"] == "double" and found.count() == docs.count()
    assert language_id.predict(no_docs, model).count() == 0
    nothing = language_id.fit(no_docs)
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}


def test_gradients_match_differences():
    net = convnet.ConvNet(3, 12, widths=(2, 3), filters=4, dim=3, seed=1)
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    rng = np.random.default_rng(0)
    windows, labels = rng.integers(0, 256, (5, 12)).astype(np.uint8), rng.integers(0, 3, 5)

    def loss():
        net._tables = None
        return -np.log(net.probabilities(windows)[np.arange(5), labels]).mean()

    loss()
    grads = net._gradients(windows, labels)
    for name in ("dense", "out", "bias", "conv"):
        flat = net.params[name].reshape(-1)
        for i in rng.integers(0, flat.size, 5):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - grads[name].reshape(-1)[i]) < 1e-4
