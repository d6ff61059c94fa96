"""Labelled samples for the classifiers and a small logistic solver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casequarry.llm import common as C

#: Labelled rows a model is fitted on, at most; chosen by a hash of their id.
SAMPLE_ROWS = 6000


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents.

    The ids are drawn from the narrow label table, so texts are read once and only the
    drawn ones move.  Rows without id, text or label are left out; several labels of one
    id count as their greatest, several texts as their least.
    """
    order = F.xxhash64(F.lit("sample"), "k")
    drawn = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_col).alias("k"))
        .agg(F.max(label).alias("label"))
        .orderBy(order, "k")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    # The drawn ids are bounded by ``rows``, so this side can be sent to every task.
    found = texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("k"))
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def within_bytes(sample: DataFrame, most: int, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows of a sample, in the order of a hash of their ids, while their texts take at most ``most`` bytes together.

    Rows of over a sixteenth of that are left out first.  Whole texts stay where they are until it is known which are taken: only
    ids and sizes, at most as many as the sample has rows, are put in order.
    """
    kept = C.written(sample)
    size = F.octet_length(text_col).cast("bigint")
    sizes = kept.select(F.col(id_col).alias("k"), size.alias("size")).where(F.col("size") <= most // 16)
    upto = F.sum("size").over(W.orderBy(F.xxhash64(F.lit("bytes"), "k"), "k"))
    taken = sizes.withColumn("upto", upto).where(F.col("upto") <= most).select("k")
    return kept.join(F.broadcast(taken), F.col(id_col) == F.col("k"), "left_semi")  # no more ids than the sample has rows


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    def __init__(self, parts: dict[str, np.ndarray], rate: float):
        self.parts, self.rate, self.step = parts, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in parts.items()}
        self.second = {k: np.zeros_like(v) for k, v in parts.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in grads.items():
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.001 * (g * g - self.second[k])
            up = self.first[k] / (1 - 0.9**self.step)
            self.parts[k] -= (self.rate * up / (np.sqrt(self.second[k] / (1 - 0.999**self.step)) + 1e-8)).astype(self.parts[k].dtype)

