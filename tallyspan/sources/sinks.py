"""Sinks: parquet, JSON lines, rollout dumps, metric logs, cached generations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.spread import packed, ranked


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of the cluster; a local session may use a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, rows_per_file: int | None = None, group_bytes: int | None = None, by: Sequence[str] = ()) -> None:
    """zstd parquet; row groups are sized in bytes and files in rows."""
    writer = df.write.option("compression", "zstd")
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if group_bytes is not None:
        writer = writer.option("parquet.block.size", group_bytes)
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def as_json_array(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows of a key as the text of a JSON array, on pages of a bounded size."""
    cols = [c for c in df.columns if c not in keys]
    pages = packed(ranked(df, list(keys), [order], "__p"), keys, "__p", cols, "__r")
    rows = F.transform("__r", lambda r: F.struct(*[r[c].alias(c) for c in cols]))
    return pages.select(*keys, "page", F.to_json(rows).alias("json"))


def dump_rollouts(df: DataFrame, path: str, extras: Sequence[str] = (), base: Sequence[str] = ("input", "output", "gts", "score")) -> None:
    """One folder of JSON lines per step. An extra with missing values is left out."""
    if extras:
        gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in extras]).first()
        extras = [c for c in extras if gaps[c] == 0]
    df.select("step", *base, *extras).write.partitionBy("step").json(path)


def rollout_table(responses: DataFrame, tokens: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """What a dump shows per response: texts, summed token score, truth, request id and distillation fields."""
    score = tokens.groupBy("sample_id").agg(F.sum("reward").alias("score"))
    names = [c for c in ("sd_solution", "sd_feedback", "sd_full_teacher_prompt", "sd_mask", *extra) if c in responses.columns]
    joined = responses.join(score, "sample_id", "left").fillna({"score": 0.0})
    return joined.select(
        F.col("prompt").alias("input"), F.col("response").alias("output"), F.col("ground_truth").alias("gts"), "score", "step",
        F.col("sample_id").cast("string").alias("request_id"), *names,
    )


def write_metric_log(rows: DataFrame, path: str) -> None:
    """``step, name, value`` rows as ``{"step", "data"}`` lines, one per step and page of names."""
    pages = packed(ranked(rows, ["step"], ["name"], "__p"), ["step"], "__p", ["name", "value"], "__r")
    entries = F.transform("__r", lambda r: F.struct(r["name"].alias("key"), r["value"].alias("value")))
    pages.select("step", F.map_from_entries(entries).alias("data")).write.json(path)


def cached(spark: SparkSession, root: str, key: Sequence[str], make: Callable[[], DataFrame]) -> DataFrame:
    """The table under ``root/<key parts>``; made and written on first use, read afterwards."""
    path = "/".join([root.rstrip("/"), *[str(k).replace("/", "_") for k in key]])
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        make().write.parquet(path)
        return spark.read.parquet(path)


def append_generations(prompts: DataFrame, generations: DataFrame, key: str) -> DataFrame:
    """Prompts with ``responses``, their generations in order of ``n``; more than a block of them
    continue on further rows of ``page``."""
    pages = packed(ranked(generations, [key], ["n"], "__p"), [key], "__p", ["text"], "__r")
    lists = pages.select(key, "page", F.transform("__r", lambda r: r["text"]).alias("responses"))
    return prompts.join(lists, key, "left")
