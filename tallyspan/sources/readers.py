"""Scans: prompt sets, JSON lines, rollout dumps, metric logs, console lines, experiment files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.schemas import CORPUS_DOC, EXPERIMENT_POINT, METRIC_ROW


def _suffix(path: str) -> str:
    return path.rstrip("/").rpartition(".")[2].lower()


def read_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet and JSON files as one table; columns that a file lacks are null. Other suffixes are an error."""
    by_kind: dict[str, list[str]] = {}
    for path in paths:
        kind = {"parquet": "parquet", "json": "json", "jsonl": "json"}.get(_suffix(path))
        if kind is None:
            raise ValueError(f"unsupported file format: {path}")
        by_kind.setdefault(kind, []).append(path)
    result = None
    for kind, group in by_kind.items():
        reader = spark.read if schema is None else spark.read.schema(schema)
        part = reader.option("mergeSchema", True).parquet(*group) if kind == "parquet" else reader.json(group)
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    if result is None:
        raise ValueError("no files")
    return result


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line, blank lines skipped. A string field takes any JSON value as its text."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_input(spark: SparkSession, path: str, fmt: str = "auto", schema: T.StructType | None = None) -> DataFrame:
    """Reader by format, or by suffix for "auto"; a folder without suffix is read as parquet."""
    if fmt == "auto":
        fmt = {"parquet": "parquet", "jsonl": "jsonl", "json": "json"}.get(_suffix(path), "folder")
    if fmt == "jsonl" and schema is not None:
        return read_json_lines(spark, path, schema)
    if fmt in ("parquet", "folder"):
        return spark.read.parquet(path)
    if fmt == "jsonl":
        return spark.read.json(path)
    if fmt == "json":
        return read_json_array(spark, path, schema)
    raise ValueError(f"unsupported input format: {fmt}")


# fixed columns of a rollout dump; everything else is an extra
DUMP = T.StructType(
    [
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("gts", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("step", T.LongType()),
    ]
)


def read_rollout_dumps(spark: SparkSession, path: str) -> DataFrame:
    """A folder of ``<step>.jsonl`` dumps, or of ``step=<n>`` folders: the fixed columns, ``step`` from
    the path and the other entries as text in the map ``extras``."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    step = F.regexp_extract(F.col("_metadata.file_path"), r"(?:/step=(\d+)/[^/]*|/(\d+)\.jsonl?)$", 0)
    step = F.regexp_extract(step, r"^/(?:step=)?(\d+)", 1)
    step = F.when(step != "", step.cast("long"))
    parsed = lines.select(
        step.alias("__file_step"),
        F.from_json("value", DUMP).alias("r"),
        F.from_json("value", T.MapType(T.StringType(), T.StringType())).alias("m"),
    )
    fixed = [f.name for f in DUMP.fields if f.name != "step"]
    return parsed.select(
        *[F.col(f"r.{n}").alias(n) for n in fixed],
        F.coalesce("__file_step", F.col("r.step")).alias("step"),
        F.map_filter("m", lambda k, v: ~k.isin(*[f.name for f in DUMP.fields])).alias("extras"),
    )


def read_metric_log(spark: SparkSession, path: str) -> DataFrame:
    """``{"step": n, "data": {name: value}}`` lines as ``step, name, value`` rows."""
    return spark.read.schema(METRIC_ROW).json(path).select("step", F.explode("data").alias("name", "value"))


def console_metrics(line: Column) -> Column:
    """``step:N - name:value - name:value`` as a map; null for a line without a step."""
    parts = F.split(line, " - ")
    # the value is what follows the last colon of a part
    entries = F.transform(
        parts, lambda p: F.struct(F.regexp_extract(p, r"^(.*):[^:]*$", 1).alias("k"), F.regexp_extract(p, r":([^:]*)$", 1).try_cast("double").alias("v"))
    )
    good = F.filter(entries, lambda e: (e["k"] != "") & e["v"].isNotNull())
    return F.when(line.startswith("step:"), F.map_from_entries(good))


def parse_console(lines: DataFrame, line: str = "value") -> DataFrame:
    """Metric rows of console lines; lines that are none are dropped."""
    m = lines.select(console_metrics(F.col(line)).alias("m")).filter(F.col("m").isNotNull())
    m = m.select(F.try_element_at("m", F.lit("step")).cast("long").alias("step"), "m")
    return m.select("step", F.explode("m").alias("name", "value")).filter(F.col("name") != "step")


def read_experiments(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """JSON objects of experiment -> list of points as ``experiment, key, value, step, min, max`` rows,
    one object per file or per line."""
    schema = T.MapType(T.StringType(), T.ArrayType(EXPERIMENT_POINT))
    texts = spark.read.option("wholetext", whole_files).text(path)
    runs = texts.select(F.explode(F.from_json("value", schema)).alias("experiment", "points"))
    return runs.select("experiment", F.inline("points"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Retrieval corpus: ``id, contents`` JSON lines."""
    return spark.read.schema(CORPUS_DOC).json(path)
