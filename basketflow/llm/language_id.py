"""Language of texts by a byte-level convolutional network.

The network is fitted on the driver on a bounded number of labelled rows (``rows``, shared evenly by
the labels; of each a stretch of ``STRETCH`` characters at a place that its hash chooses). It is then
applied to all consecutive windows of every whole text, and the windows' class probabilities are
averaged by their bytes.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.convnet import ConvNet, cut
from basketflow.llm.shared import map_text
from basketflow.llm.textbytes import text_slices

LENGTH = 256
ROWS = 4000
STRETCH = 1024
UNKNOWN = "und"
_PARTS = 64


@dataclass
class LanguageModel:
    labels: list[str]
    net: ConvNet | None


def labelled_rows(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """(text, lang): about ``rows`` rows in all, those of smallest hash of every label.

    Each label is cut into parts by the hash before it is ranked, so that no task ranks a whole
    label; the parts have equal shares of the label's rows.
    """
    usable = docs.where("lang is not null and text is not null").select("text", "lang")
    usable = usable.where(F.col("text").rlike("\\p{L}"))
    digest = F.xxhash64("text")
    start = 1 + F.pmod(digest, F.greatest(F.length("text") - STRETCH, F.lit(1)))
    keyed = usable.select(
        F.col("text").substr(start.cast("int"), F.lit(STRETCH)).alias("text"),
        "lang",
        digest.alias("digest"),
        F.pmod(F.shiftright(digest, 8), F.lit(_PARTS)).alias("part"),
    )
    labels = docs.select("lang").distinct().where("lang is not null").count()
    each = -(-rows // max(labels, 1) // _PARTS)
    order = Window.partitionBy("lang", "part").orderBy("digest", "text")
    return keyed.withColumn("at", F.row_number().over(order)).where(F.col("at") <= each)


def fit(docs: DataFrame, rows: int = ROWS) -> LanguageModel:
    """A model of the labels in ``lang``; with fewer than one label, one that knows none."""
    sample = labelled_rows(docs, rows).orderBy("lang", "digest", "text").select("text", "lang")
    collected = sample.collect()
    texts, tags = [r[0] for r in collected], [r[1] for r in collected]
    labels = sorted(set(tags), key=lambda tag: tag.encode())
    if not labels:
        return LanguageModel([], None)
    truth = np.array([labels.index(tag) for tag in tags])
    windows, numbers = [], []
    for low, _, data, offsets in text_slices(pa.array(texts, pa.string())):
        starts, owner = window_starts(offsets, LENGTH)
        windows.append(cut(data, starts, offsets[owner + 1], LENGTH))
        numbers.append(truth[owner + low])
    net = ConvNet(len(labels), LENGTH).fit(np.concatenate(windows), np.concatenate(numbers))
    return LanguageModel(labels, net)


def window_starts(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the consecutive windows that cover every text, and the text of each."""
    count = -(-np.diff(offsets) // length)
    owner = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return offsets[owner] + nth * length, owner


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Adds lang_pred and score.

    A text that is null or has no letter is ``und`` with score 0, as is every text where the model
    knows no label. Of equal scores the label that sorts first wins. Columns of these two names are
    replaced; all others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def languages(column: pa.Array) -> list[pa.Array]:
        known = shared.value
        best, scores = np.zeros(len(column), np.int64), np.zeros(len(column))
        for low, high, data, offsets in text_slices(column):
            if known.net is None or len(data) == 0:
                continue
            starts, owner = window_starts(offsets, LENGTH)
            total = np.zeros((high - low, len(known.labels)))
            step = 4096
            for i in range(0, len(starts), step):
                some = owner[i : i + step]
                windows = cut(data, starts[i : i + step], offsets[some + 1], LENGTH)
                weight = np.minimum(offsets[some + 1] - starts[i : i + step], LENGTH)
                np.add.at(total, some, known.net.probabilities(windows) * weight[:, None])
            total /= np.maximum(np.diff(offsets), 1)[:, None]
            best[low:high] = total.argmax(axis=1)
            scores[low:high] = np.clip(total.max(axis=1), 0, 1)
        names = pa.array(known.labels or [UNKNOWN], pa.string())
        return [names.take(pa.array(best)), pa.array(scores, pa.float64())]

    found = map_text(docs, languages, {"lang_pred": "string", "score": "double"}, {"_letter": F.col("text").rlike("\\p{L}")})
    letter = F.coalesce("_letter", F.lit(False)) & F.lit(model.net is not None)
    return found.withColumns(
        {
            "lang_pred": F.when(letter, F.col("lang_pred")).otherwise(UNKNOWN),
            "score": F.when(letter, F.col("score")).otherwise(0.0),
        }
    ).drop("_letter")
