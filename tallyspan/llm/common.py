"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyspan.spread import durable

#: Distinct words that a task remembers; the memory is emptied when it is full.
CACHE_WORDS = 300_000
#: Rows that are Python objects at a time.
ROWS = 2_048

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


_REMEMBERED: dict[str, object] = {}


def remembered(key: str, make: Callable[[], object]) -> object:
    """An object that a worker process keeps for its next tasks. It keeps one: a worker that turns to
    another operator lets go what the last one has gathered."""
    if key not in _REMEMBERED:
        forget()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def forget() -> None:
    """Let go what other operators have left in this worker process."""
    if _REMEMBERED:
        _REMEMBERED.clear()
        release()


def release() -> None:
    """Give free memory back to the system: a worker waits for its next task without it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(parts: Iterator) -> Iterator:
    """The parts, and ``release`` when the last one is out."""
    try:
        yield from parts
    finally:
        release()


def few_rows(spark: SparkSession) -> None:
    """Arrow batches of ROWS rows unless the session sets another number than Spark's own: texts are
    long, and a batch is in memory several times, in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(ROWS))


def utf8(name: str) -> Column:
    """The text as UTF-8 bytes; a null text counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).cast("binary")


def in_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """``mapInArrow`` with Python lists: fn gets the columns of a batch and returns those of the schema."""
    few_rows(df.sparkSession)
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield pa.RecordBatch.from_pydict(fn(batch.slice(at, ROWS).to_pydict()), schema=arrow)

    return df.mapInArrow(lambda batches: released(run(batches)), schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a local session may go without."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        durable(spark.range(0).toDF("id"))  # a local session makes a folder of its own, any other raises
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word (bytes) to its 64-bit hash, remembered up to CACHE_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    out = hashes[:n]
    for i in range(1, size):
        out = mixed(out) + hashes[i : n + i]
    return mixed(out)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names close to ``names`` that ``df`` does not use, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
