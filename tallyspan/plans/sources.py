"""Registered queries that write tables and read them back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan import schemas
from tallyspan.plans import register
from tallyspan.plans.advantage import r6
from tallyspan.plans.metrics import POINTS, points
from tallyspan.sources import readers as R
from tallyspan.sources import sinks as S
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views
from tallyspan.spread import packed, ranked

L = F.lit


@register(
    "read_mixed_files",
    "SELECT c_custkey AS k, c_name AS name, NULL::DOUBLE AS price FROM customer UNION ALL SELECT p_partkey, NULL, p_retailprice FROM part",
)
def read_mixed_files(spark, sf):
    path = S.shared_folder(spark, "mixed") + ".json"
    S.write_json_lines(V.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_retailprice").alias("price")), path)
    both = S.shared_folder(spark, "mixed") + ".parquet"
    S.write_parquet(V.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), both, rows_per_file=500, group_bytes=1 << 20)
    return R.read_files(spark, [both, path]).select("k", "name", "price")


@register(
    "read_json_lines",
    "SELECT p_name AS prompt, CASE WHEN p_size % 2 = 0 THEN '[\"' || p_brand || '\"]' ELSE p_brand END AS chosen, p_type AS rejected FROM part",
)
def read_json_lines(spark, sf):
    p = V.table(spark, sf, "part")
    cols = [F.col("p_name").alias("prompt"), F.col("p_type").alias("rejected")]
    listed = F.to_json(F.struct(*cols, F.array("p_brand").alias("chosen")))
    plain = F.to_json(F.struct(*cols, F.col("p_brand").alias("chosen")))
    path = S.shared_folder(spark, "lines") + ".jsonl"
    p.select(F.concat(F.when(F.col("p_size") % 2 == 0, listed).otherwise(plain), L("\n  "))).write.text(path)
    return R.read_input(spark, path, schema=schemas.PREFERENCE_ROW)


@register(
    "read_json_array",
    "SELECT s_nationkey AS nation, s_suppkey AS id, s_name AS name FROM supplier",
)
def read_json_array(spark, sf):
    path = S.shared_folder(spark, "arrays")
    s = V.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    S.as_json_array(s, ["nation"], "id").select("nation", "json").repartition("nation").write.option("maxRecordsPerFile", 1).partitionBy("nation").text(path)
    return R.read_json_array(spark, path, T.StructType.fromDDL("id bigint, name string")).select("nation", "id", "name")


@register(
    "read_input_formats",
    """SELECT f AS format, s_suppkey AS id, s_name AS name FROM supplier, (VALUES ('parquet'), ('jsonl'), ('json')) v(f)""",
)
def read_input_formats(spark, sf):
    """The same rows through every branch of the reader."""
    rows = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    schema = T.StructType.fromDDL("id bigint, name string")
    found = []
    for fmt in ("parquet", "jsonl", "json"):
        path = S.shared_folder(spark, "formats-" + fmt) + "." + fmt
        if fmt == "json":
            S.as_json_array(rows.withColumn("all", F.lit(0)), ["all"], "id").select("json").write.option("maxRecordsPerFile", 1).text(path)
        else:
            rows.write.format("parquet" if fmt == "parquet" else "json").save(path)
        found.append(R.read_input(spark, path, schema=None if fmt == "jsonl" else schema).select(F.lit(fmt).alias("format"), "id", "name"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@register(
    "rollout_dump_round_trip",
    with_views(
        "rollouts",
        "SELECT 'Q' || uid AS input, pred AS output, CAST(sample_id AS VARCHAR) AS gts, round(score, 6) AS score, step, CAST(acc AS VARCHAR) AS acc, 1 AS extras FROM rollouts",
    ),
)
def rollout_dump_round_trip(spark, sf):
    path = S.shared_folder(spark, "dump")
    r = V.rollouts(spark, sf).select(
        F.concat(L("Q"), F.col("uid").cast("string")).alias("input"),
        F.col("pred").alias("output"),
        F.col("sample_id").cast("string").alias("gts"),
        r6("score").alias("score"),
        "step",
        "acc",
        F.when(F.col("pred") != "P", F.col("pred")).alias("gappy"),
    )
    S.dump_rollouts(r, path, ["acc", "gappy"])
    dump = R.read_rollout_dumps(spark, path)
    return dump.select(
        "input", "output", "gts", "score", "step", F.col("extras")["acc"].alias("acc"), F.size(F.map_keys("extras")).alias("extras")
    )


@register(
    "rollout_table",
    with_views(
        "rollouts loose_tokens",
        """WITH s AS (SELECT sample_id, sum(reward) AS s FROM loose_tokens GROUP BY 1)
 SELECT 'Q' || uid AS input, pred AS output, CAST(sample_id AS VARCHAR) AS request_id, round(coalesce(s, 0), 6) AS score, step, 1 AS sd_mask FROM rollouts LEFT JOIN s USING (sample_id)""",
    ),
)
def rollout_table(spark, sf):
    r = V.rollouts(spark, sf).select(
        "sample_id", "step", F.concat(L("Q"), F.col("uid").cast("string")).alias("prompt"), F.col("pred").alias("response"), L("x").alias("ground_truth"), L(1).alias("sd_mask")
    )
    return S.rollout_table(r, V.loose_tokens(spark, sf)).select("input", "output", "request_id", r6("score").alias("score"), "step", "sd_mask")


@register(
    "metric_log_round_trip",
    with_views("metric_log", "SELECT step, name, round(sum(value), 4) AS value FROM metric_log GROUP BY 1, 2"),
)
def metric_log_round_trip(spark, sf):
    path = S.shared_folder(spark, "metrics")
    S.write_metric_log(V.metric_log(spark, sf).groupBy("step", "name").agg(F.round(F.sum("value"), 4).alias("value")), path)
    return R.read_metric_log(spark, path)


@register(
    "console_metric_lines",
    with_views(
        "metric_log",
        "SELECT event_id % 100000 AS step, 'critic/' || name || ':mean' AS name, value FROM metric_log WHERE worker % 7 <> 0 UNION ALL SELECT event_id % 100000, 'day', CAST(step AS DOUBLE) FROM metric_log WHERE worker % 7 <> 0",
    ),
)
def console_metric_lines(spark, sf):
    e = V.metric_log(spark, sf)
    good = F.concat(
        L("step:"), F.col("event_id").cast("string"), L(" - critic/"), F.col("name"), L(":mean:"), F.col("value").cast("string"), L(" - day:"), F.col("step").cast("string"), L(" - broken")
    )
    line = F.when(F.col("worker") % 7 != 0, good).otherwise(F.concat(L("INFO nothing here "), F.col("name")))
    return R.parse_console(e.select(line.alias("value")))


@register(
    "experiment_files",
    with_views("metric_log", f"WITH {POINTS} SELECT experiment, key, step, value FROM pt"),
)
def experiment_files(spark, sf):
    path = S.shared_folder(spark, "experiments")
    pages = packed(ranked(points(spark, sf), ["experiment"], ["key", "step"], "k"), ["experiment"], "k", ["key", "value", "step"], "rows")
    body = F.transform("rows", lambda r: F.struct(r["key"].alias("key"), r["value"].alias("value"), r["step"].alias("step")))
    pages.select(F.to_json(F.create_map("experiment", body))).write.text(path)
    return R.read_experiments(spark, path, whole_files=False).select("experiment", "key", "step", "value")


@register(
    "corpus_files",
    "SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS contents_md5 FROM documents",
)
def corpus_files(spark, sf):
    path = S.shared_folder(spark, "corpus")
    S.write_json_lines(V.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("contents")), path)
    return R.read_corpus(spark, path).select("id", F.md5("contents").alias("contents_md5"))


@register(
    "offline_generations",
    with_views(
        "rollouts",
        "SELECT c_custkey AS uid, c_name AS prompt, count(sample_id)::INTEGER AS n, string_agg(pred, '' ORDER BY sample_id) AS responses FROM customer LEFT JOIN rollouts ON uid = c_custkey GROUP BY 1, 2",
    ),
)
def offline_generations(spark, sf):
    prompts = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_name").alias("prompt"))
    done = S.append_generations(prompts, V.rollouts(spark, sf).select("uid", F.col("sample_id").alias("n"), F.col("pred").alias("text")), "uid")
    return done.select("uid", "prompt", F.coalesce(F.size("responses"), L(0)).alias("n"), F.array_join("responses", "").alias("responses"))


@register(
    "generation_cache",
    with_views("rollouts", "SELECT sample_id, pred FROM rollouts UNION ALL SELECT sample_id, pred FROM rollouts"),
)
def generation_cache(spark, sf):
    root = S.shared_folder(spark, "cache")
    make = lambda: V.rollouts(spark, sf).select("sample_id", "pred")
    first = S.cached(spark, root, ["exp", "project", 64, 8], make)
    # the second call must read: its maker would give another table
    again = S.cached(spark, root, ["exp", "project", 64, 8], lambda: make().limit(0))
    return first.unionByName(again)
