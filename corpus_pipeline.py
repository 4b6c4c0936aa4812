"""The corpus pipeline: toxicity, line dedup, near-duplicates, secrets, packing.

Each stage takes the documents that its predecessor kept, written as Parquet and read again, and
returns the columns of documents; the last returns the packed pieces. A stage sees a document's id
and text; all columns travel as one struct, so none can clash with a stage's own.

Defined results: a null text counts as empty and stays null where nothing is changed; ``n_chars`` is
set anew where a stage changes the text; documents without id are scored, scanned and packed, and
neither lose lines nor count as copies; rows that share an id are one document when lines and copies
are compared, and one of them (the least text) is left after the near-duplicate stage; a document
all of whose lines are repeats stays, with an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.llm import ftrl, hyperminhash, line_bloom, secrets_scan, swap_packing
from tallyspan.llm.common import saved
from tallyspan.plans import register
from tallyspan.spread import df_col

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _wrapped(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*[df_col(c) for c in docs.columns]).alias("row"))


def _unwrapped(df: DataFrame, columns: list[str], text: Column | None = None, changed: Column | None = None) -> DataFrame:
    """The documents again; where ``changed``, with the new text and its length."""

    def column(name: str) -> Column:
        old = F.col(f"row.`{name}`")
        if text is not None and name in ("text", "n_chars"):
            return F.when(changed, text if name == "text" else F.length(text).cast("long")).otherwise(old).alias(name)
        return old.alias(name)

    return df.select(*[column(c) for c in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    scored = ftrl.toxicity(_wrapped(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _unwrapped(scored.filter(F.col("score") < 0.5), docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds too go."""
    cut = line_bloom.dedup_lines(_wrapped(docs))
    return _unwrapped(cut, docs.columns, F.col("kept_text"), F.col("n_dropped") > 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (five-word shingles, Jaccard 0.8) the smallest id stays."""
    found = hyperminhash.near_duplicates(docs.select("doc_id", "text"))
    lost = found.filter(~F.col("kept")).select(F.col("doc_id").alias("lost_id")).distinct()
    named = _wrapped(docs.filter(F.col("doc_id").isNotNull()))
    stay = named.join(lost, F.col("doc_id") == F.col("lost_id"), "left_anti")
    once = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    stay = stay.withColumn("nth", once).filter(F.col("nth") == 1)
    return _unwrapped(stay, docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets."""
    found = secrets_scan.scan_and_redact(_wrapped(docs))
    return _unwrapped(found, docs.columns, F.col("found.text"), F.size("found.spans") > 0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence."""
    parts = swap_packing.pieces(docs, TOKENIZER)
    return swap_packing.pack(parts.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

#: A learned model and packing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


@register("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs)
    return docs
