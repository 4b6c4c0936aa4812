"""Token counts by a separator scan of flat token files.

A token file is nothing but ids in little-endian order, documents ended by one separator id; there
is no index. The scan cuts every file into blocks of equal size. A task reads a block and finds all
separators in it with one array comparison; it returns the tokens between them, those before the
first and those after the last. Documents that cross blocks are put together by a prefix scan over
the blocks of a file, one row per block: the number of separators before a block numbers its
documents, and the tokens since the last separator are added to its first.

``write_tokens`` makes such files from documents, one per task, in the shared folder. Only files of
tasks that ended well are in the table it returns, so a lost executor leaves nothing that is read.

Defined results: a null text is an empty one, with no token before its separator; rows that share an
id are counted each, rows without id too; very long texts are many blocks; an empty file has no
document; tokens after the last separator are a document that is marked as not closed. Ids have the
width that the vocabulary needs, and one that does not fit is an error. Extra columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import in_batches, released, saved, shared_folder
from tallyspan.llm.swap_packing import BATCH_BYTES, text_batches, word_ids
from tallyspan.spread import df_col

#: Bytes of a block.
BLOCK = 1 << 20


def _with_host(uri: str) -> str:
    """``file:/x``, as Hadoop writes it, is ``file:///x``."""
    scheme, colon, rest = uri.partition(":")
    return f"{scheme}://{rest}" if colon and rest.startswith("/") and not rest.startswith("//") else uri


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(_with_host(uri))


def full_uri(spark: SparkSession, folder: str) -> str:
    """The folder with scheme and host as Spark's own file systems know it: one without a scheme lies in the
    cluster's default file system, not on the machine that happens to read it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return _with_host(hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(hadoop).toString())


def id_width(tokenizer: str, end_id: int) -> int:
    """Bytes that every id of the vocabulary and the end fit in: 2 or 4."""
    from tokenizers import Tokenizer

    most = max(end_id, Tokenizer.from_file(tokenizer).get_vocab_size() - 1)
    return 2 if most < 1 << 16 else 4


def packed_ids(ids: np.ndarray, width: int) -> bytes:
    """Little-endian ids of ``width`` bytes; an error where one does not fit."""
    if len(ids) and int(ids.max()) >> (8 * width):
        raise ValueError(f"id {int(ids.max())} does not fit in {width} bytes")
    return ids.astype(f"<u{width}").tobytes()


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", width: int | None = None) -> DataFrame:
    """Write flat files of ids, ``width`` bytes each (by default as many as the vocabulary needs); returns
    ``file, bytes, document, doc_id`` with the position of each document in its file."""
    spark = docs.sparkSession
    folder = full_uri(spark, f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}")
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    width = id_width(tokenizer, end_id) if width is None else width
    end = packed_ids(np.array([end_id], np.int64), width)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = f"{folder}/{uuid.uuid4().hex}.bin"  # another name in each attempt of a task
        doc_ids: list[int] = []
        size = 0
        store, path = _open(uri)
        with store.open_output_stream(path) as out:
            for batch in text_batches(batches, BATCH_BYTES):
                ids, counts = word_ids(tokenizer).encode(batch.column("text"))
                for part in np.split(ids, np.cumsum(counts)[:-1]):
                    data = packed_ids(part, width) + end
                    out.write(data)
                    size += len(data)
                doc_ids += batch.column("doc_id").to_pylist()
        if not doc_ids:
            store.delete_file(path)
            return
        n = len(doc_ids)
        yield pa.RecordBatch.from_pydict(
            {"file": pa.array([uri] * n), "bytes": pa.array([size] * n, pa.int64()), "document": pa.array(range(n), pa.int64()), "doc_id": pa.array(doc_ids, pa.int64())}
        )

    rows = docs.select(df_col(id_col).cast("long").alias("doc_id"), F.coalesce(df_col(text_col).cast("string"), F.lit("")).alias("text"))
    return saved(rows.mapInArrow(lambda batches: released(write(batches)), "file string, bytes long, document long, doc_id long"))


def scan(files: DataFrame, end_id: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """``file, document, n_tokens, closed`` of every document in ``files(file, bytes)``."""
    block -= block % width
    step = F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / block))
    blocks = files.filter(F.col("bytes") >= width).select("file", "bytes", F.explode(step).alias("block"))
    blocks = blocks.repartition("file", "block")

    def read(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"file": [], "block": [], "begin": [], "gaps": [], "last": [], "tokens": []}
        for uri, size, number in zip(batch["file"], batch["bytes"], batch["block"]):
            store, path = _open(uri)
            with store.open_input_file(path) as data:
                part = data.read_at(min(block, size - number * block), number * block)
            ids = np.frombuffer(part, f"<u{width}", len(part) // width)
            ends = np.flatnonzero(ids == end_id) + number * (block // width)
            out["file"].append(uri)
            out["block"].append(number)
            out["begin"].append(int(ends[0]) if len(ends) else None)
            out["gaps"].append((np.diff(ends) - 1).tolist())
            out["last"].append(int(ends[-1]) if len(ends) else None)
            out["tokens"].append(size // width if (number + 1) * block >= size else None)
        return out

    # begin, last: places of the block's first and last separator in the file; tokens: only in the last block
    found = in_batches(blocks, read, "file string, block long, begin long, gaps array<long>, last long, tokens long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when(F.col("begin").isNull(), 0).otherwise(F.size("gaps") + 1)
    found = found.withColumn("ends", ends.cast("long"))
    found = found.withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)).cast("long"))
    found = found.withColumn("since", F.coalesce(F.max("last").over(before), F.lit(-1)).cast("long"))
    counts = F.concat(F.array(F.col("begin") - F.col("since") - 1), F.col("gaps"))
    closed = found.filter(F.col("ends") > 0).select("file", "first", F.posexplode(counts).alias("at", "n_tokens"))
    closed = closed.select("file", (F.col("first") + F.col("at")).alias("document"), "n_tokens", F.lit(True).alias("closed"))
    rest = F.col("tokens") - F.coalesce("last", "since") - 1
    left = found.filter(rest > 0).select("file", (F.col("first") + F.col("ends")).alias("document"), rest.alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(left)


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, n_tokens``: documents written as token files, and counted from those alone."""
    width = id_width(tokenizer, end_id)
    written = write_tokens(docs, tokenizer, end_id, id_col, text_col, width)
    files = written.groupBy("file").agg(F.first("bytes").alias("bytes"))
    counted = scan(files, end_id, width, block)
    # file names shrink to little in a shuffle; a merge keeps them from being broadcast
    return counted.join(written.select("file", "document", "doc_id").hint("merge"), ["file", "document"]).select("doc_id", "n_tokens")
