"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, pairs of neighbours and pairs with one word between,
hashed to ``2**POWER`` numbers. Training visits documents in a fixed pseudo-random order; every
coordinate has its own learning rate, and the L1 term leaves most weights at exactly zero. The model
is a list of (number, weight) of at most ``2**POWER`` entries (12 MB), which is what is broadcast.

The model is fitted on at most ``SAMPLE`` labelled documents, those with the smallest hash of their
id; all documents are scored. Training is one task over that bounded sample; only feature numbers
reach it, and a document's share is bounded by the number of features.

Defined results: a null text is an empty one; a text without known features gets the score of the
bias; rows without id or label teach nothing; an id labelled twice counts once, with its larger
label; without labels of both classes every score is 0. Extra columns pass
through; one named like the result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import ROWS, WordHashes, few_rows, forget, mixed, release, released, utf8
from tallyspan.spread import df_col, top_k

POWER = 20
#: Labelled documents that training sees at most.
SAMPLE = 20_000
EPOCHS, ALPHA, BETA, L1, L2 = 10, 3.0, 1.0, 6.0, 0.1
_GAP = np.uint64(0x632BE59BD9B4E019)


def feature_numbers(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Distinct feature numbers of a text, 0 (the bias) excluded."""
    h = hashes.of(text.lower().split())
    near = mixed(h[:-1]) + h[1:]
    skip = mixed(h[:-2] ^ _GAP) + h[2:]
    numbers = mixed(np.concatenate([h, near, skip])) >> np.uint64(64 - POWER)
    return np.unique(np.maximum(numbers, np.uint64(1)).astype(np.int32))


class Ftrl:
    """FTRL-proximal: z and n per coordinate; the weight is read from them when it is needed."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << POWER), np.zeros(1 << POWER)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(z.shape, L1)
        l1[at == 0 if isinstance(at, np.ndarray) else 0] = 0.0  # the bias is not shrunk
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> DataFrame:
    """The model ``number, weight`` from ``labels`` joined to ``docs`` by ``id_col``."""
    known = labels.filter(df_col(id_col).isNotNull() & df_col(label_col).isNotNull())
    known = known.groupBy(df_col(id_col).cast("long").alias("doc_id")).agg(F.max(df_col(label_col).cast("int")).alias("label"))
    known = known.withColumn("turn", F.xxhash64("doc_id")).orderBy("turn", "doc_id").limit(sample)
    texts = docs.select(df_col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    chosen = texts.join(F.broadcast(known), "doc_id")  # at most ``sample`` rows of three numbers
    chosen = top_k(chosen, ["doc_id"], [F.col("text")], 1)  # a document that is there twice teaches once
    hashes = WordHashes()

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [feature_numbers(t, hashes) for t in batch.column("text").to_pylist()]
                ends = np.cumsum([0, *map(len, found)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in known_columns), lists], [*known_columns, "features"])

    known_columns = ["doc_id", "turn", "label"]
    rows = chosen.select(*known_columns, "text").mapInArrow(numbers, "doc_id long, turn long, label int, features array<int>")

    def fit(table: pa.Table) -> pa.Table:
        forget()
        # the lists stay where Arrow has them; only their order is sorted
        texts = [f.flatten().to_numpy() for f in table.column("features").chunks]
        sizes = [f.value_lengths().to_numpy() for f in table.column("features").chunks]
        place = [(c, int(e - n), int(e)) for c, ns in enumerate(sizes) for n, e in zip(ns, np.cumsum(ns))]
        y, turn, ids = (table.column(c).to_numpy() for c in ("label", "turn", "doc_id"))
        order = np.lexsort((ids, turn))
        model = Ftrl()
        if 0 < y.sum() < len(y):
            for _ in range(EPOCHS):
                for i in order.tolist():
                    c, a, b = place[i]
                    model.learn(np.concatenate([[0], texts[c][a:b]]), int(y[i]))
        w = model.weights(slice(None))
        del texts, place
        release()
        kept = np.flatnonzero(w)
        return pa.table({"number": pa.array(kept, pa.int32()), "weight": pa.array(w[kept], pa.float64())})

    return rows.groupBy(F.lit(0).alias("model")).applyInArrow(fit, "number int, weight double")


def score(docs: DataFrame, model: DataFrame, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 by ``model``."""
    learned = model.toPandas()  # at most 2**POWER rows
    w = np.zeros(1 << POWER)
    w[learned["number"].to_numpy(dtype=np.int64)] = learned["weight"].to_numpy(dtype=float)
    weights = docs.sparkSession.sparkContext.broadcast(w if len(learned) else None)
    hashes = WordHashes()

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        w = weights.value

        def of(texts: pd.Series) -> pd.Series:
            if w is None:
                return pd.Series(0.0, index=texts.index)
            total = np.array([w[feature_numbers(t, hashes)].sum() for t in texts]) + w[0]
            return pd.Series(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))

        yield from released(map(of, parts))
        hashes.clear()

    return docs.withColumn(out, probability(utf8(text_col)))


def held_out(doc_id: Column) -> Column:
    """One id in five, by the checksum of its decimal text, never teaches."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", out: str = "score"
) -> DataFrame:
    """``docs`` with ``score``, learned from the labelled rows that are not held out."""
    few_rows(docs.sparkSession)
    teaching = labels.filter(~held_out(df_col(id_col)))
    return score(docs, train(docs, teaching, id_col, text_col, label_col), text_col, out)
