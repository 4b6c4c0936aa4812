"""Line dedup by two Bloom filters.

One pass fills, per task, a filter of the line hashes seen once and one of those seen twice; filters
of different tasks are merged slice by slice (what both have seen once has been seen twice). Only
lines that the merged twice-filter suspects are shuffled: there their full keys are compared and the
smallest document id that holds a key is found. Documents without a suspected line stay where they
are; the others meet the numbers of the lines they lose.

The twice-filter is the only thing that every task gets. It has ``BITS_PER_LINE`` bits a line and
2**MAX_BITS bits at most (128 MB); beyond that it suspects more lines, and the result is the same.

Defined results: a null or empty text is one empty line; keys shorter than ``min_chars`` never count;
rows that share an id are one document; a row without id neither loses lines nor makes others lose
them. Extra columns pass through; those named like a result are replaced by it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import few_rows, forget, free_names, in_batches, released, saved, utf8
from tallyspan.spread import attach, df_col

MIN_CHARS = 10
BITS_PER_LINE, MIN_BITS, MAX_BITS = 8, 20, 30
#: Bits of a slice: the unit in which filters are merged.
SLICE = 1 << 16
#: Filters of this many tasks are merged before the last merge of a slice.
FAN_IN = 64
_STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_STRIP).lower()


def counts(key: bytes, min_chars: int) -> bool:
    """Is the key long enough, in code points?"""
    if len(key) < min_chars:
        return False
    return key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars


def document_keys(text: bytes, min_chars: int) -> set[bytes]:
    return {k for k in map(line_key, text.split(b"\n")) if counts(k, min_chars)}


class Bits:
    """A Bloom filter of 2**power bits with two probes, taken from one 64-bit hash."""

    def __init__(self, power: int, data: np.ndarray | None = None):
        self.mask = np.uint64((1 << power) - 1)
        self.data = np.zeros((1 << power) >> 3, np.uint8) if data is None else data

    def _probes(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in (hashes & self.mask, (hashes >> np.uint64(32)) & self.mask):
            yield (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for byte, bit in self._probes(hashes):
            np.bitwise_or.at(self.data, byte, bit)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for byte, bit in self._probes(hashes):
            found &= (self.data[byte] & bit) != 0
        return found


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def filter_power(lines: int) -> int:
    return min(max((max(lines, 1) * BITS_PER_LINE - 1).bit_length(), MIN_BITS), MAX_BITS)


def _packed(once: np.ndarray, twice: np.ndarray) -> tuple[bytes, bytes]:
    return zlib.compress(once, 1), zlib.compress(twice, 1)


def twice_filter(texts: DataFrame, power: int, min_chars: int) -> np.ndarray:
    """The merged filter of keys seen in two documents, over ``texts(text binary)``."""
    slices = ((1 << power) + SLICE - 1) // SLICE
    width = min(SLICE, 1 << power) >> 3
    schema = "slice int, part int, once binary, twice binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        once, twice, seen = Bits(power), Bits(power), False
        for batch in batches:
            keys: list[bytes] = []
            for text in batch.column("text").to_pylist():
                keys.extend(document_keys(text, min_chars))
            if not keys:
                continue
            seen = True
            hashes, n = np.unique(_hashes(keys), return_counts=True)
            twice.add(hashes[(n > 1) | once.has(hashes)])
            once.add(hashes)
        if seen:
            first = once.data.reshape(slices, width)
            second = twice.data.reshape(slices, width)
            filled = np.flatnonzero(first.any(axis=1))
            # which merge a task's slices join first: any number does
            part = int(xxhash.xxh64_intdigest(once.data[: 1 << 16].tobytes()) % FAN_IN)
            for at in range(0, len(filled), 256):
                some = filled[at : at + 256].tolist()
                packed = [_packed(first[s], second[s]) for s in some]
                yield pa.RecordBatch.from_pydict(
                    {
                        "slice": pa.array(some, pa.int32()),
                        "part": pa.array([part] * len(some), pa.int32()),
                        "once": pa.array([o for o, _ in packed], pa.binary()),
                        "twice": pa.array([t for _, t in packed], pa.binary()),
                    }
                )

    def merge(table: pa.Table) -> pa.Table:
        once, twice = np.zeros(width, np.uint8), np.zeros(width, np.uint8)
        for o, t in zip(table.column("once"), table.column("twice")):
            other = np.frombuffer(zlib.decompress(o.as_py()), np.uint8)
            twice |= np.frombuffer(zlib.decompress(t.as_py()), np.uint8) | (once & other)
            once |= other
        o, t = _packed(once, twice)
        one = lambda name, value, kind: pa.array([value], kind)
        return pa.table(
            {
                "slice": table.column("slice").slice(0, 1).combine_chunks(),
                "part": table.column("part").slice(0, 1).combine_chunks(),
                "once": one("once", o, pa.binary()),
                "twice": one("twice", t, pa.binary()),
            }
        )

    filters = texts.mapInArrow(lambda batches: released(build(batches)), schema).groupBy("slice", "part").applyInArrow(merge, schema)
    merged = filters.groupBy("slice").applyInArrow(merge, schema).select("slice", "twice")
    data = np.zeros((slices, width), np.uint8)
    # at most 2**MAX_BITS bits, whatever the input
    for row in merged.toLocalIterator():
        data[row["slice"]] = np.frombuffer(zlib.decompress(bytes(row["twice"])), np.uint8)
    return data.reshape(-1)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, power: int | None = None
) -> DataFrame:
    """``docs`` with ``kept_text, n_lines, n_dropped``: every line whose key another document with a
    smaller id holds too is gone. The key is the line without ASCII white space at both ends, A-Z
    lower-cased. ``power`` sets the filter's size (log2 of its bits) instead of the count of lines."""
    spark = docs.sparkSession
    few_rows(spark)
    docs = docs.select(*[df_col(c) for c in docs.columns if c.lower() not in ("kept_text", "n_lines", "n_dropped")])
    if power is None:
        text = F.coalesce(df_col(text_col), F.lit(""))
        lines = docs.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1)).first()[0]
        power = filter_power(lines or 0)
    twice = spark.sparkContext.broadcast(twice_filter(docs.select(utf8(text_col).alias("text")), power, min_chars))

    def suspects(keys: list[bytes]) -> np.ndarray:
        return Bits(power, twice.value).has(_hashes(keys))

    def find(batch: dict[str, list]) -> dict[str, list]:
        forget()
        out = {"doc_id": [], "key": [], "lines": []}
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            places: dict[bytes, list[int]] = {}
            for i, line in enumerate(text.split(b"\n")):
                key = line_key(line)
                if counts(key, min_chars):
                    places.setdefault(key, []).append(i)
            keys = list(places)
            for key, bad in zip(keys, suspects(keys).tolist()):
                if bad:
                    out["doc_id"].append(doc_id)
                    out["key"].append(key)
                    out["lines"].append(places[key])
        return out

    def touches(texts: pd.Series) -> pd.Series:
        keys, ends = [], []
        for text in texts:
            keys.extend(document_keys(text, min_chars))
            ends.append(len(keys))
        before = np.concatenate([[0], np.cumsum(suspects(keys))])
        ends = np.array(ends, dtype=np.int64)
        return pd.Series(before[ends] > before[np.concatenate([[0], ends[:-1]]).astype(np.int64)] if len(ends) else [], dtype=bool)

    @F.pandas_udf("boolean")
    def touched(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from released(map(touches, parts))

    @F.pandas_udf("string")
    def without(texts: pd.Series, dropped: pd.Series) -> pd.Series:
        kept = []
        for text, lines in zip(texts, dropped):
            gone = set(lines) if lines is not None else ()
            kept.append("\n".join([x for i, x in enumerate(text.split("\n")) if i not in gone]) if gone else text)
        return pd.Series(kept, dtype=object)

    named = docs.filter(df_col(id_col).isNotNull()).select(df_col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    found = saved(in_batches(named, find, "doc_id long, key binary, lines array<int>"))
    first = attach(found, ["key"], first=F.min("doc_id"))
    lost = first.filter(F.col("doc_id") > F.col("first")).select("doc_id", F.explode("lines").alias("line"))
    mark, key, gone = free_names(docs, "touched", "lost_id", "lost_lines")
    lost = lost.groupBy("doc_id").agg(F.collect_set("line").alias(gone)).withColumnRenamed("doc_id", key)

    marked = docs.withColumn(mark, df_col(id_col).isNotNull() & touched(utf8(text_col)))
    text = F.coalesce(df_col(text_col), F.lit(""))
    n_lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long")
    plain = marked.filter(~F.col(mark)).select(
        *[df_col(c) for c in docs.columns], text.alias("kept_text"), n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")
    )
    joined = marked.filter(F.col(mark)).join(lost, df_col(id_col).cast("long") == F.col(key), "left")
    n_gone = F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long")
    cut = joined.select(
        *[df_col(c) for c in docs.columns], without(text, F.col(gone)).alias("kept_text"), n_lines.alias("n_lines"), n_gone.alias("n_dropped")
    )
    return plain.unionByName(cut)
