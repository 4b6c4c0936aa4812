"""The driver's tables seen as rollout logs, with the same definitions as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.spread import ranked

TOKEN_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rollouts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per response."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sample_id"),
        F.col("o_custkey").alias("uid"),
        F.col("o_orderpriority").alias("data_source"),
        F.col("o_orderstatus").alias("pred"),
        (F.col("o_orderstatus") == "F").cast("double").alias("acc"),
        F.log(F.col("o_totalprice") / 100000.0).alias("score"),
        F.month("o_orderdate").cast("long").alias("step"),
    )


def _token_columns():
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    old = -F.log1p(q / 10.0)
    return [
        F.col("l_orderkey").alias("sample_id"),
        (F.col("l_returnflag") != "R").cast("int").alias("mask"),
        F.log1p(d).alias("reward"),
        old.alias("old_logp"),
        (old + F.log1p(t) - F.log1p(d) * 2.0).alias("rollout_logp"),
        (F.log(F.col("l_extendedprice")) / 10.0).alias("value"),
        F.col("l_linenumber").cast("long").alias("tag"),
    ]


def loose_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """One row per token without its position: enough for everything but scans."""
    return table(spark, sf, "lineitem").select(*_token_columns())


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    """One row per token with its position ``pos`` (from 1) in the response."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", *TOKEN_ORDER, "l_discount", "l_tax", "l_returnflag"
    )
    return ranked(items, ["l_orderkey"], TOKEN_ORDER, "pos").select(*_token_columns(), "pos")


def vocab_columns(k: int = 4) -> list:
    """Top-k log-probs of teacher ``t1..tk`` and student ``s1..sk`` per token, with a tail outside the top k."""
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    student = [q / 25.0, d * 20.0, t * 10.0, (q * d) / 2.0, F.lit(0.3)]
    teacher = [q / 40.0, d * 10.0, t * 30.0, (q * t) / 2.0, F.lit(0.1)]
    cols = []
    for name, logits in (("s", student), ("t", teacher)):
        total = F.log(sum((F.exp(x) for x in logits[1:]), F.exp(logits[0])))
        cols += [(x - total).alias(f"{name}{i + 1}") for i, x in enumerate(logits[:k])]
    return cols


def vocab_tokens(spark: SparkSession, sf: str, stepped: bool = False) -> DataFrame:
    """Tokens with the arrays ``student_topk`` and ``teacher_topk``; entry 1 is the sampled token.

    With ``stepped``, those of known responses with their ``step``, joined before the log-probs are made of a
    few short columns: these, not the arrays, are what is shuffled.
    """
    lines, more = table(spark, sf, "lineitem"), []
    if stepped:
        steps = rollouts(spark, sf).select("sample_id", "step")
        lines, more = lines.join(steps, F.col("l_orderkey") == F.col("sample_id")).drop("sample_id"), ["step"]
    items = lines.select(*_token_columns(), *more, *vocab_columns())
    pick = lambda p: F.array(*[F.col(f"{p}{i}") for i in range(1, 5)])
    return items.withColumn("student_topk", pick("s")).withColumn("teacher_topk", pick("t"))


def chats(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations")


def metric_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id"),
        F.col("user_id").alias("worker"),
        F.col("event_type").alias("name"),
        F.dayofmonth("ts").cast("long").alias("step"),
        "value",
        "ts",
    )


_STUDENT = ["l_quantity / 25.0", "l_discount * 20.0", "l_tax * 10.0", "(l_quantity * l_discount) / 2.0", "0.3"]
_TEACHER = ["l_quantity / 40.0", "l_discount * 10.0", "l_tax * 30.0", "(l_quantity * l_tax) / 2.0", "0.1"]


def _vocab_sql() -> str:
    cols = []
    for name, logits in (("s", _STUDENT), ("t", _TEACHER)):
        total = "ln(" + " + ".join(f"exp({x})" for x in logits) + ")"
        cols += [f"{x} - {total} AS {name}{i + 1}" for i, x in enumerate(logits[:4])]
    return ", ".join(cols)


_TOKEN_SQL = """l_orderkey AS sample_id, CAST(l_returnflag <> 'R' AS INTEGER) AS mask, ln(1 + l_discount) AS reward,
 -ln(1 + l_quantity / 10.0) AS old_logp,
 -ln(1 + l_quantity / 10.0) + ln(1 + l_tax) - ln(1 + l_discount) * 2.0 AS rollout_logp,
 ln(l_extendedprice) / 10.0 AS value, CAST(l_linenumber AS BIGINT) AS tag"""

SQL_VIEWS = {
    "rollouts": """SELECT o_orderkey AS sample_id, o_custkey AS uid, o_orderpriority AS data_source,
 o_orderstatus AS pred, CAST(o_orderstatus = 'F' AS DOUBLE) AS acc, ln(o_totalprice / 100000.0) AS score,
 CAST(month(o_orderdate) AS BIGINT) AS step FROM orders""",
    "loose_tokens": f"SELECT {_TOKEN_SQL} FROM lineitem",
    "tokens": f"SELECT {_TOKEN_SQL}, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(TOKEN_ORDER)}) AS pos FROM lineitem",
    "vocab_tokens": f"SELECT {_TOKEN_SQL}, {_vocab_sql()} FROM lineitem",
    "metric_log": """SELECT event_id, user_id AS worker, event_type AS name, CAST(day(ts) AS BIGINT) AS step,
 value, ts FROM events""",
}


def with_views(views: str, body: str) -> str:
    """``WITH`` clause over the named views, then ``body`` (which may start with more CTEs)."""
    ctes = ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in views.split())
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
