"""Registered queries of the metrics family."""

from pyspark.sql import functions as F

from tallyspan.operators import metrics as M
from tallyspan.operators import reports as R
from tallyspan.plans import register
from tallyspan.plans.advantage import RESPONSES_SQL, r6, responses
from tallyspan.plans.offpolicy import rounded
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views

# metric names given to the events of the log, by type and parity of the worker
NAMES = {
    ("purchase", 0): "perf/total_num_tokens",
    ("purchase", 1): "perf/time_per_step",
    ("view", 0): "timing_s/gen",
    ("view", 1): "timing_s/step",
    ("click", 0): "global_seqlen/max",
    ("click", 1): "global_seqlen/min",
    ("signup", 0): "global_seqlen/minmax_diff",
    ("signup", 1): "perf/throughput",
    ("error", 0): "weighted_avg_loss",
    ("error", 1): "training/global_step",
}


def named_log(spark, sf):
    name = None
    for (kind, parity), text in NAMES.items():
        hit = (F.col("name") == kind) & (F.col("worker") % 2 == parity)
        name = F.when(hit, text) if name is None else name.when(hit, text)
    return V.metric_log(spark, sf).withColumn("name", name).withColumn("samples", F.length(F.col("worker").cast("string")))


NAMED = (
    "l AS (SELECT event_id, worker, step, value, ts, length(CAST(worker AS VARCHAR)) AS samples, CASE "
    + " ".join(f"WHEN name = '{k}' AND worker % 2 = {p} THEN '{t}'" for (k, p), t in NAMES.items())
    + " END AS name FROM metric_log)"
)

register(
    "reduce_metrics",
    with_views(
        "metric_log",
        f"""WITH {NAMED} SELECT step, name, round(CASE WHEN contains(name, 'max') THEN max(value) WHEN contains(name, 'min') THEN min(value) ELSE avg(value) END, 6) AS value
 FROM l GROUP BY 1, 2""",
    ),
)(lambda spark, sf: M.reduce_by_name(named_log(spark, sf), ["step"]).select("step", "name", r6("value").alias("value")))
register(
    "reduce_nested_metrics",
    with_views(
        "metric_log",
        """WITH d AS (SELECT worker, step, name, value FROM metric_log UNION ALL SELECT worker, step, name, ln(1 + value) FROM metric_log)
 SELECT step, name, round(avg(value), 6) AS value FROM d GROUP BY 1, 2""",
    ),
)(
    lambda spark, sf: M.reduce_by_name(
        M.flatten_metrics(
            V.metric_log(spark, sf).select("step", F.create_map("name", F.array(F.col("value"), F.log1p("value"))).alias("metrics")),
            ["step"],
        ),
        ["step"],
    ).select("step", "name", r6("value").alias("value"))
)
KINDS = {"view": "mean", "click": "sum", "purchase": "max", "signup": "min", "error": "mean"}


def declared(spark, sf):
    kind = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    return V.metric_log(spark, sf).withColumn("kind", kind[F.col("name")])


register(
    "accumulate_metrics",
    with_views(
        "metric_log",
        """SELECT step, name, CASE name WHEN 'click' THEN 'sum' WHEN 'purchase' THEN 'max' WHEN 'signup' THEN 'min' ELSE 'mean' END AS kind,
 round(CASE name WHEN 'click' THEN sum(value) WHEN 'purchase' THEN max(value) WHEN 'signup' THEN min(value) ELSE avg(value) END, 6) AS value FROM metric_log GROUP BY 1, 2""",
    ),
)(lambda spark, sf: M.accumulate(declared(spark, sf), ["step"]).select("step", "name", "kind", r6("value").alias("value")))

ROLL = f"""{NAMED}, s AS (SELECT step, name, arg_max(value, ts) AS last, sum(value) AS sm, avg(value) AS av, min(value) AS mn, max(value) AS mx FROM l GROUP BY 1, 2),
 r AS (SELECT step, name, CASE name WHEN 'perf/time_per_step' THEN 'time_sum' WHEN 'timing_s/gen' THEN 'time_sum' WHEN 'timing_s/step' THEN 'time_sum'
 WHEN 'training/global_step' THEN 'last' WHEN 'weighted_avg_loss' THEN 'avg' WHEN 'global_seqlen/max' THEN 'max' WHEN 'global_seqlen/min' THEN 'min'
 WHEN 'global_seqlen/minmax_diff' THEN 'max' WHEN 'perf/total_num_tokens' THEN 'sum' ELSE 'avg' END AS rule, last, sm, av, mn, mx FROM s),
 v AS (SELECT step, name, rule, CASE rule WHEN 'time_sum' THEN sm WHEN 'sum' THEN sm WHEN 'last' THEN last WHEN 'max' THEN mx WHEN 'min' THEN mn ELSE av END AS value FROM r),
 x AS (SELECT step, max(value) FILTER (name = 'global_seqlen/max') - max(value) FILTER (name = 'global_seqlen/min') AS diff,
 max(value) FILTER (name = 'perf/total_num_tokens') / (max(value) FILTER (name = 'perf/time_per_step') * 8) AS rate,
 max(value) FILTER (name = 'timing_s/gen') / max(value) FILTER (name = 'timing_s/step') AS idle FROM v GROUP BY 1)"""
ROLL_OUT = """SELECT step, name, rule, round(CASE WHEN name = 'global_seqlen/minmax_diff' THEN diff WHEN name = 'perf/throughput' THEN coalesce(rate, value) ELSE value END, 6) AS value
 FROM v JOIN x USING (step) UNION ALL SELECT step, 'trainer/idle_ratio', 'derived', round(idle, 6) FROM x WHERE idle IS NOT NULL"""
register("roll_up_steps", with_views("metric_log", f"WITH {ROLL} {ROLL_OUT}"))(
    lambda spark, sf: M.roll_up_steps(named_log(spark, sf), ["step"], 8).select("step", "name", "rule", r6("value").alias("value"))
)

VARS = "vars AS (SELECT data_source, uid, sample_id, pred, 'acc' AS var, acc AS val FROM rollouts UNION ALL SELECT data_source, uid, sample_id, pred, 'score', score FROM rollouts)"


def validation_vars(spark, sf):
    return M.variables(V.rollouts(spark, sf), ["acc", "score"])


def rolled(df):
    return df.select("data_source", "var", "metric", r6("value").alias("value"))


register(
    "validation_mean",
    with_views(
        "rollouts",
        f"""WITH {VARS}, g AS (SELECT data_source, uid, var, count(*) AS n, avg(val) AS m, stddev_pop(val) AS s FROM vars GROUP BY 1, 2, 3),
 c AS (SELECT data_source, var, 'mean@' || n AS metric, m AS v FROM g UNION ALL SELECT data_source, var, 'std@' || n, s FROM g WHERE n > 1)
 SELECT data_source, var, metric, round(avg(v), 6) AS value FROM c GROUP BY 1, 2, 3""",
    ),
)(lambda spark, sf: rolled(M.over_prompts(M.mean_metrics(validation_vars(spark, sf)))))
SIZES = """r AS (SELECT *, row_number() OVER (PARTITION BY data_source, uid, var ORDER BY val, sample_id) AS i, count(*) OVER (PARTITION BY data_source, uid, var) AS n FROM vars),
 k AS (SELECT r.*, unnest(list_distinct(list_append(list_filter(list_transform(range(1, 41), lambda j: CAST(power(2, j) AS BIGINT)), lambda x: x < n), n))) AS k FROM r WHERE n > 1)"""
BEST = """b AS (SELECT data_source, uid, var, k, sum(val * (power(i / n, k) - power((i - 1) / n, k))) AS bm, sum(val * val * (power(i / n, k) - power((i - 1) / n, k))) AS bq,
 sum(val * (power((n - i + 1) / n, k) - power((n - i) / n, k))) AS wm, sum(val * val * (power((n - i + 1) / n, k) - power((n - i) / n, k))) AS wq FROM k GROUP BY 1, 2, 3, 4),
 c AS (SELECT data_source, uid, var, 'best@' || k || '/mean' AS metric, bm AS v FROM b UNION ALL SELECT data_source, uid, var, 'best@' || k || '/std', sqrt(greatest(bq - bm * bm, 0)) FROM b
 UNION ALL SELECT data_source, uid, var, 'worst@' || k || '/mean', wm FROM b UNION ALL SELECT data_source, uid, var, 'worst@' || k || '/std', sqrt(greatest(wq - wm * wm, 0)) FROM b)"""
register(
    "validation_best_of",
    with_views(
        "rollouts",
        f"WITH {VARS}, {SIZES}, {BEST} SELECT data_source, var, metric, round(avg(v), 5) AS value FROM c GROUP BY 1, 2, 3",
    ),
)(
    lambda spark, sf: M.over_prompts(M.best_of_metrics(validation_vars(spark, sf))).select(
        "data_source", "var", "metric", F.round("value", 5).alias("value")
    )
)
DRAWS = 1000
register(
    "validation_majority",
    with_views(
        "rollouts",
        f"""WITH {VARS}, r AS (SELECT *, row_number() OVER (PARTITION BY data_source, uid, var ORDER BY sample_id) - 1 AS i FROM vars),
 g AS (SELECT data_source, uid, var, count(*) AS n, avg(val) AS m, stddev_pop(val) AS s FROM vars GROUP BY 1, 2, 3),
 z AS (SELECT *, unnest(list_distinct(list_append(list_filter(list_transform(range(1, 41), lambda j: CAST(power(2, j) AS BIGINT)), lambda x: x < n), n))) AS k FROM g WHERE n > 1),
 p AS (SELECT data_source, uid, var, n, k, draw, unnest(range(1, k + 1)) AS slot FROM (SELECT *, unnest(range(1, {DRAWS} + 1)) AS draw FROM z WHERE k > 2)),
 h AS (SELECT *, CAST(floor(CAST(('0x' || substring(md5(concat_ws(':', '42', uid, k, draw, slot)), 1, 12)) AS BIGINT) / 281474976710656.0 * n) AS BIGINT) AS i FROM p),
 d AS (SELECT h.*, r.val, r.pred FROM h JOIN r USING (data_source, uid, var, i)),
 v AS (SELECT data_source, uid, var, k, draw, pred, count(*) AS c, min(slot) AS slot, arg_min(val, slot) AS val FROM d GROUP BY ALL),
 w AS (SELECT data_source, uid, var, k, draw, arg_max(val, c * (k + 1) - slot) AS val FROM v GROUP BY ALL),
 a AS (SELECT data_source, uid, var, k, avg(val) AS m, stddev_pop(val) AS s FROM w GROUP BY ALL UNION ALL SELECT data_source, uid, var, k, m, s FROM z WHERE k = 2),
 c AS (SELECT data_source, var, 'maj@' || k || '/mean' AS metric, m AS v FROM a UNION ALL SELECT data_source, var, 'maj@' || k || '/std', s FROM a)
 SELECT data_source, var, metric, round(CAST(sum(CAST(v AS DECIMAL(38, 12))) AS DOUBLE) / count(v), 6) AS value FROM c GROUP BY 1, 2, 3""",
    ),
)(lambda spark, sf: rolled(M.over_prompts(M.majority_metrics(validation_vars(spark, sf), DRAWS), digits=12)))
register(
    "majority_of_all",
    with_views(
        "rollouts",
        """WITH v AS (SELECT uid, pred, count(*) AS c, min(sample_id) AS f, arg_min(score, sample_id) AS v FROM rollouts GROUP BY 1, 2),
 w AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY c DESC, f) AS rn FROM v) SELECT uid, pred, round(v, 6) AS value FROM w WHERE rn = 1""",
    ),
)(lambda spark, sf: M.majority_of_all(V.rollouts(spark, sf), "score").select("uid", "pred", r6("value").alias("value")))
register(
    "validation_sections",
    with_views(
        "rollouts",
        f"""WITH {VARS}, g AS (SELECT data_source, uid, var, count(*) AS n, avg(val) AS m, stddev_pop(val) AS s FROM vars GROUP BY 1, 2, 3),
 c AS (SELECT data_source, var, 'mean@' || n AS metric, m AS v, n FROM g UNION ALL SELECT data_source, var, 'std@' || n, s, n FROM g WHERE n > 1),
 a AS (SELECT data_source, var, metric, any_value(n) AS n, avg(v) AS v FROM c GROUP BY 1, 2, 3), t AS (SELECT *, max(n) OVER (PARTITION BY data_source, var) AS top FROM a)
 SELECT data_source, var, metric, round(v, 6) AS value, CASE WHEN var = 'acc' AND starts_with(metric, 'mean') AND contains(metric, '@' || top) THEN 'val-core' ELSE 'val-aux' END AS section FROM t""",
    ),
)(
    lambda spark, sf: M.label_sections(M.over_prompts(M.mean_metrics(validation_vars(spark, sf)))).select(
        "data_source", "var", "metric", r6("value").alias("value"), "section"
    )
)


@register(
    "offline_evaluation",
    """WITH p AS (SELECT o_custkey, o_orderpriority AS data_source, list(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) % 7 AS VARCHAR)) AS responses FROM orders GROUP BY 1, 2)
 SELECT data_source, round(avg(len(list_filter(responses, lambda x: x = CAST(o_custkey % 7 AS VARCHAR))) / len(responses)), 6) AS test_score FROM p GROUP BY 1""",
)
def offline_evaluation(spark, sf):
    o = V.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("uid"),
        F.col("o_orderpriority").alias("data_source"),
        (F.floor(F.col("o_totalprice") / 1000) % 7).cast("string").alias("response"),
        (F.col("o_custkey") % 7).cast("string").alias("ground_truth"),
        F.col("o_orderkey").alias("sample_id"),
    )
    # the responses of a prompt arrive as pages of one array column, as a generation run writes them
    from tallyspan.spread import packed, ranked

    pages = packed(ranked(o, ["uid", "data_source", "ground_truth"], ["sample_id"], "n"), ["uid", "data_source", "ground_truth"], "n", ["response"], "rows")
    prompts = pages.withColumn("responses", F.transform("rows", lambda r: r["response"]))
    return M.offline_evaluation(prompts, lambda r, t: (r == t).cast("double")).select("data_source", r6("test_score").alias("test_score"))


def metric_tokens(spark, sf):
    t = V.loose_tokens(spark, sf)
    return t.select(
        "sample_id",
        "mask",
        (F.col("reward") * 2).alias("score"),
        "reward",
        (F.col("value") - F.col("tag") * 0.25).alias("adv"),
        (F.col("value") + F.col("old_logp")).alias("ret"),
        "value",
        (F.exp("rollout_logp") - 0.2).alias("token_reward"),
    )


def prompt_lengths(spark, sf):
    return V.rollouts(spark, sf).withColumn("prompt_length", F.length(F.col("uid").cast("string")) + F.length("data_source"))


MT = "mt AS (SELECT sample_id, mask, reward * 2 AS score, reward, value - tag * 0.25 AS adv, value + old_logp AS ret, value, exp(rollout_logp) - 0.2 AS token_reward FROM loose_tokens)"
THREE = lambda e, n: f"avg({e}) AS {n}_mean, max({e}) AS {n}_max, min({e}) AS {n}_min"
register(
    "batch_metrics",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {MT}, p AS (SELECT sample_id, CAST(sum(mask) AS BIGINT) AS len, sum(score) AS s, sum(reward * mask) / greatest(sum(mask), 1) AS w FROM mt GROUP BY 1),
 r AS (SELECT step, length(CAST(uid AS VARCHAR)) + length(data_source) AS pl, coalesce(len, 0) AS len, CASE WHEN len > 0 THEN s END AS s, CASE WHEN len > 0 THEN w END AS w FROM rollouts LEFT JOIN p USING (sample_id)),
 a AS (SELECT step, {THREE('s', 'score')}, {THREE('w', 'reward')}, stddev_samp(w) AS reward_std, {THREE('len', 'response_length')},
 avg(CASE WHEN len = 9 THEN 1.0 ELSE 0 END) AS response_length_clip_ratio, {THREE('CASE WHEN len > 0 THEN len END', 'response_length_non_aborted')},
 avg(CASE WHEN len > 0 THEN CASE WHEN len = 9 THEN 1.0 ELSE 0 END END) AS response_length_non_aborted_clip_ratio, avg(CASE WHEN len = 0 THEN 1.0 ELSE 0 END) AS aborted_ratio,
 {THREE('pl', 'prompt_length')}, avg(CASE WHEN pl = 12 THEN 1.0 ELSE 0 END) AS prompt_length_clip_ratio FROM r GROUP BY 1),
 b AS (SELECT step, {THREE('adv', 'advantage')}, {THREE('ret', 'return')}, {THREE('value', 'value')}, 1 - var_samp(ret - value) / (var_samp(ret) + 1e-5) AS explained_variance
 FROM mt JOIN rollouts USING (sample_id) WHERE mask = 1 GROUP BY 1)
 SELECT step, round(CAST(COLUMNS(* EXCLUDE (step)) AS DOUBLE), 6) FROM a JOIN b USING (step)""",
    ),
)(
    lambda spark, sf: rounded(
        (lambda d: d.select("step", *[F.col(c).cast("double").alias(c) for c in d.columns if c != "step"]))(
            M.batch_metrics(prompt_lengths(spark, sf), metric_tokens(spark, sf), ["step"], 12, 9)
        ),
        ["step"],
    )
)


@register(
    "turn_counts",
    """WITH c AS (SELECT conv_id, conv_id % 5 AS step, count(*) AS turns, count(*) FILTER (role = 'assistant') AS tool_calls FROM conversations GROUP BY 1)
 SELECT step, min(turns) AS turns_min, max(turns) AS turns_max, round(avg(turns), 6) AS turns_mean, min(tool_calls) AS tool_calls_min, max(tool_calls) AS tool_calls_max, round(avg(tool_calls), 6) AS tool_calls_mean FROM c GROUP BY 1""",
)
def turn_counts(spark, sf):
    c = V.chats(spark, sf).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), F.count_if(F.col("role") == "assistant").alias("tool_calls")
    )
    d = M.count_stats(c.withColumn("step", F.col("conv_id") % 5), ["step"], ["turns", "tool_calls"])
    return d.withColumn("turns_mean", r6("turns_mean")).withColumn("tool_calls_mean", r6("tool_calls_mean"))


STAGES = {"view": "gen", "click": "ref", "purchase": "values", "signup": "adv", "error": "step"}


def stage_times(spark, sf):
    stage = F.create_map(*[F.lit(x) for kv in STAGES.items() for x in kv])
    return V.metric_log(spark, sf).groupBy("step", stage[F.col("name")].alias("stage")).agg(F.sum("value").alias("seconds"))


def token_totals(spark, sf):
    r = responses(spark, sf).withColumn("p", F.length("data_source"))
    return r.groupBy("step").agg(F.sum("p").alias("prompt_tokens"), F.sum("n_valid").alias("response_tokens"))


TIMES = f"""{RESPONSES_SQL}, s AS (SELECT step, CASE name {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in STAGES.items())} END AS stage, sum(value) AS seconds FROM metric_log GROUP BY 1, 2),
 k AS (SELECT step, sum(length(data_source)) AS p, sum(n_valid) AS r FROM responses GROUP BY 1)"""
register(
    "timing_per_token",
    with_views(
        "rollouts loose_tokens metric_log",
        f"""WITH {TIMES} SELECT step, stage, round(seconds, 6) AS seconds, round(CASE WHEN stage = 'gen' THEN seconds * 1000 / r WHEN stage = 'step' THEN NULL ELSE seconds * 1000 / (p + r) END, 6) AS ms_per_token
 FROM s JOIN k USING (step)""",
    ),
)(lambda spark, sf: rounded(M.timing_metrics(stage_times(spark, sf), token_totals(spark, sf), ["step"]), ["step", "stage"]))
register(
    "throughput",
    with_views(
        "rollouts loose_tokens metric_log",
        f"""WITH {TIMES} SELECT step, CAST(p + r AS BIGINT) AS tokens, round(seconds, 6) AS seconds, round((p + r) / (seconds * 16), 6) AS throughput FROM s JOIN k USING (step) WHERE stage = 'step'""",
    ),
)(
    lambda spark, sf: M.throughput(
        token_totals(spark, sf).select("step", (F.col("prompt_tokens") + F.col("response_tokens")).alias("tokens")),
        stage_times(spark, sf).filter("stage = 'step'").drop("stage"),
        ["step"],
        16,
    ).select("step", "tokens", r6("seconds").alias("seconds"), r6("throughput").alias("throughput"))
)


def streamed_samples(spark, sf):
    e = V.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select(
        F.col("event_id").alias("sample_id"),
        F.dayofmonth("ts").cast("long").alias("step"),
        F.col("value").alias("processing_time"),
        (F.col("value") / 7).alias("tool_time"),
        (F.col("value") / 3).alias("gen_time"),
        k.alias("version"),
        k.alias("version_end"),
        F.floor(k * 0.97).cast("long").alias("version_start"),
        F.length("event_type").cast("long").alias("prompt_length"),
        k.alias("response_length"),
    )


SAMPLES = """s AS (SELECT event_id AS sample_id, CAST(day(ts) AS BIGINT) AS step, value AS processing_time, value / 7 AS tool_time, value / 3 AS gen_time,
 CAST(json_extract_string(props, '$.k') AS BIGINT) AS version, CAST(floor(CAST(json_extract_string(props, '$.k') AS BIGINT) * 0.97) AS BIGINT) AS version_start, CAST(length(event_type) AS BIGINT) AS prompt_length FROM events)"""
register(
    "assembled_batch_stats",
    f"""WITH {SAMPLES} SELECT step, round(avg(processing_time), 6) AS time_avg, round(max(processing_time), 6) AS time_max, round(min(processing_time), 6) AS time_min,
 round(max(tool_time), 6) AS tool_max, round(min(tool_time), 6) AS tool_min, round(avg(tool_time), 6) AS tool_mean, count(*) FILTER (version <> version_start) AS partial_num,
 round(avg(CASE WHEN version <> version_start THEN 1.0 ELSE 0 END), 6) AS partial_ratio, max(abs(version - version_start)) AS max_partial_span,
 round(quantile_cont(processing_time, 0.5), 6) AS time_tp50, round(quantile_cont(processing_time, 0.95), 6) AS time_tp95, round(quantile_cont(processing_time, 0.99), 6) AS time_tp99,
 count(DISTINCT version) AS version_diversity FROM s GROUP BY 1""",
)(
    lambda spark, sf: (
        lambda d: d.select(
            *[r6(c).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes]
        )
    )(M.assembled_batch_stats(streamed_samples(spark, sf), ["step"]))
)
register(
    "slowest_sample",
    f"""WITH {SAMPLES}, r AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY gen_time + tool_time DESC, sample_id) AS rn FROM s)
 SELECT step, sample_id, round(gen_time, 6) AS gen_time, round(tool_time, 6) AS tool_time, prompt_length, version AS response_length FROM r WHERE rn = 1""",
)(
    lambda spark, sf: M.slowest_sample(streamed_samples(spark, sf), ["step"]).select(
        "step", "sample_id", r6("gen_time").alias("gen_time"), r6("tool_time").alias("tool_time"), "prompt_length", "response_length"
    )
)
register(
    "verifier_agreement",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {MT}, p AS (SELECT sample_id, sum(adv * mask) / greatest(sum(mask), 1) AS a FROM mt GROUP BY 1),
 r AS (SELECT step, coalesce(a, 0) > 0 AS pos, acc >= 1 AS ok FROM rollouts LEFT JOIN p USING (sample_id)),
 c AS (SELECT step, avg(CASE WHEN pos AND ok THEN 1.0 ELSE 0 END) AS pos_pos, avg(CASE WHEN NOT pos AND NOT ok THEN 1.0 ELSE 0 END) AS neg_neg, avg(CASE WHEN pos AND NOT ok THEN 1.0 ELSE 0 END) AS pos_neg,
 avg(CASE WHEN NOT pos AND ok THEN 1.0 ELSE 0 END) AS neg_pos, avg(CASE WHEN pos = ok THEN 1.0 ELSE 0 END) AS agree, avg(CASE WHEN ok THEN 1.0 ELSE 0 END) AS success_rate FROM r GROUP BY 1),
 t AS (SELECT step, avg(token_reward) AS token_reward_mean, avg(CASE WHEN token_reward > 0 THEN 1.0 ELSE 0 END) AS token_reward_pos_rate, avg(token_reward) FILTER (acc >= 1) AS token_reward_mean_success,
 stddev_samp(token_reward) FILTER (acc >= 1) AS token_reward_std_success, avg(token_reward) FILTER (acc < 1) AS token_reward_mean_fail, stddev_samp(token_reward) FILTER (acc < 1) AS token_reward_std_fail
 FROM mt JOIN rollouts USING (sample_id) WHERE mask = 1 GROUP BY 1) SELECT step, round(COLUMNS(* EXCLUDE (step)), 6) FROM c JOIN t USING (step)""",
    ),
)(
    lambda spark, sf: rounded(
        M.verifier_agreement(V.rollouts(spark, sf).select("sample_id", "acc", "step"), metric_tokens(spark, sf), ["step"]), ["step"]
    )
)


def document_pairs(spark, sf):
    """Good and bad documents of a language, matched by rank."""
    from tallyspan.spread import ranked

    d = V.table(spark, sf, "documents").join(V.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    d = d.select("doc_id", "lang", "quality", F.col("text"), F.col("source"))
    r = ranked(d, ["lang", "quality"], ["doc_id"], "k")
    good = r.filter("quality = 1").select("lang", "k", F.col("doc_id").alias("pair_id"), F.col("text").alias("chosen"), F.col("source").alias("prompt"))
    bad = r.filter("quality = 0").select("lang", "k", F.col("doc_id").alias("bad_id"), F.col("text").alias("rejected"))
    return good.join(bad, ["lang", "k"])


PAIRS_SQL = """d AS (SELECT doc_id, lang, quality, text, source FROM documents JOIN labels USING (doc_id)),
 rk AS (SELECT *, row_number() OVER (PARTITION BY lang, quality ORDER BY doc_id) AS k FROM d),
 pairs AS (SELECT g.lang, g.k, g.doc_id AS pair_id, b.doc_id AS bad_id, g.text AS chosen, b.text AS rejected, g.source AS prompt
 FROM rk g JOIN rk b ON g.lang = b.lang AND g.k = b.k AND g.quality = 1 AND b.quality = 0)"""


def pair_lengths(spark, sf):
    n = lambda c: F.regexp_count(c, F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"))
    return document_pairs(spark, sf).select(
        "lang", "pair_id", n(F.col("prompt")).alias("prompt_len"), n(F.col("chosen")).alias("chosen_len"), n(F.col("rejected")).alias("rejected_len")
    )


LENGTHS = PAIRS_SQL + """, n AS (SELECT lang, pair_id, len(regexp_extract_all(prompt, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')) AS p,
 len(regexp_extract_all(chosen, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')) AS c, len(regexp_extract_all(rejected, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')) AS r FROM pairs)"""
_SERIES = {"prompt": "p", "chosen": "c", "rejected": "r", "prompt_chosen": "p + c", "prompt_rejected": "p + r", "longest": "p + greatest(c, r)", "remaining": "2000 - p"}
register(
    "pair_length_report",
    f"""WITH {LENGTHS}, l AS ({' UNION ALL '.join(f"SELECT lang, '{s}' AS series, CAST({e} AS DOUBLE) AS len FROM n" for s, e in _SERIES.items())})
 SELECT lang, series, round(avg(len), 6) AS mean, round(min(len), 6) AS min, round(max(len), 6) AS max, round(avg(CASE WHEN len > 2000 THEN 1.0 ELSE 0 END), 6) AS over_share,
 round(avg(CASE WHEN len <= 0 THEN 1.0 ELSE 0 END), 6) AS no_space_share, round(quantile_cont(len, 0.5), 6) AS median, round(quantile_cont(len, 0.25), 6) AS p25, round(quantile_cont(len, 0.75), 6) AS p75,
 round(quantile_cont(len, 0.9), 6) AS p90, round(quantile_cont(len, 0.95), 6) AS p95, round(quantile_cont(len, 0.99), 6) AS p99 FROM l GROUP BY 1, 2""",
)(lambda spark, sf: rounded(M.pair_length_report(pair_lengths(spark, sf), ["lang"], 2000), ["lang", "series"]))
register(
    "truncation_severity",
    f"""WITH {LENGTHS}, x AS (SELECT *, p + greatest(c, r) > 2000 AS cut, greatest(2000 - p, 0) AS room FROM n)
 SELECT lang, count(*) FILTER (cut) AS truncated, round(avg(CASE WHEN cut THEN 1.0 ELSE 0 END), 6) AS truncated_share, round(avg(p) FILTER (cut), 6) AS prompt_mean, round(avg(c) FILTER (cut), 6) AS chosen_mean,
 round(avg(r) FILTER (cut), 6) AS rejected_mean, round(avg(room) FILTER (cut), 6) AS surviving_mean, round(avg(room) FILTER (cut) / greatest(avg(c) FILTER (cut), 1) * 100, 6) AS chosen_surviving_pct,
 round(avg(room) FILTER (cut) / greatest(avg(r) FILTER (cut), 1) * 100, 6) AS rejected_surviving_pct, count(*) FILTER (cut AND room <= 0) AS completion_lost FROM x GROUP BY 1""",
)(
    lambda spark, sf: (lambda d: d.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes]))(
        M.truncation_severity(pair_lengths(spark, sf), ["lang"], 2000)
    )
)


@register(
    "version_staleness",
    """WITH s AS (SELECT o_orderpriority AS trainer, CAST(12 * year(o_orderdate) + month(o_orderdate) AS BIGINT) AS made, CAST(12 * year(l_shipdate) + month(l_shipdate) AS BIGINT) AS used FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
 v AS (SELECT trainer, used, count(*) AS consumed, count(*) FILTER (used - made >= 1) AS stale, max(used - made) AS oldest FROM s GROUP BY 1, 2)
 SELECT *, CAST(sum(stale) OVER (PARTITION BY trainer ORDER BY used) AS BIGINT) AS stale_total FROM v""",
)
def version_staleness(spark, sf):
    """Line items as samples: the month of the order is the version that made one, that of the shipment the one that used it."""
    month = lambda d: (12 * F.year(d) + F.month(d)).cast("long")
    lines = V.table(spark, sf, "lineitem").join(V.table(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    samples = lines.select(F.col("o_orderpriority").alias("trainer"), month("o_orderdate").alias("made"), month("l_shipdate").alias("used"))
    return M.staleness(samples, "made", "used", ["trainer"])


def points(spark, sf):
    """Workers as experiments: the daily sum of each event type is a metric value."""
    return V.metric_log(spark, sf).groupBy(
        F.concat(F.lit("run-"), F.col("worker").cast("string")).alias("experiment"), F.col("name").alias("key"), "step"
    ).agg(F.round(F.sum("value"), 2).alias("value"))


POINTS = """pt AS (SELECT 'run-' || worker AS experiment, name AS key, step, round(sum(value), 2) AS value FROM metric_log GROUP BY ALL),
 st AS (SELECT experiment, key, arg_max(value, step) AS final, max(value) AS best, min(value) AS lowest FROM pt GROUP BY 1, 2),
 bs AS (SELECT experiment, key, min(step) AS best_step FROM pt JOIN st USING (experiment, key) WHERE value = best GROUP BY 1, 2)"""
register(
    "experiment_points",
    with_views("metric_log", f"WITH {POINTS} SELECT experiment, key, final, best, best_step, lowest FROM st JOIN bs USING (experiment, key)"),
)(lambda spark, sf: M.experiment_points(points(spark, sf)))
register(
    "experiment_section",
    with_views(
        "metric_log",
        f"""WITH {POINTS} SELECT experiment, max(best) FILTER (key = 'view') AS view_best, max(final) FILTER (key = 'click') AS click_final, max(lowest) FILTER (key = 'error') AS error_lowest FROM st GROUP BY 1""",
    ),
)(
    lambda spark, sf: M.experiment_section(
        points(spark, sf), {"view_best": ("view", "best"), "click_final": ("click", "final"), "error_lowest": ("error", "lowest")}
    )
)
register(
    "experiment_consistency",
    with_views(
        "metric_log",
        f"""WITH {POINTS}, p AS (SELECT experiment, max(best) FILTER (key = 'view') AS m, max(best) FILTER (key = 'purchase') AS b FROM st GROUP BY 1)
 SELECT experiment, m AS mean_best, b AS best_best, round(b - m, 6) AS gap, round(CASE WHEN m IS NOT NULL AND b IS NOT NULL THEN CASE WHEN b > 0 THEN m / b * 100 ELSE 0 END END, 6) AS consistency_pct FROM p""",
    ),
)(
    lambda spark, sf: M.consistency_section(points(spark, sf), "view", "purchase")
    .withColumn("gap", r6("gap"))
    .withColumn("consistency_pct", r6("consistency_pct"))
)
register(
    "experiment_range",
    with_views(
        "metric_log",
        f"""WITH {POINTS} SELECT experiment, max(best) FILTER (key = 'click') AS highest, max(final) FILTER (key = 'click') AS final, max(lowest) FILTER (key = 'click') AS lowest,
 round(max(best) FILTER (key = 'click') - max(lowest) FILTER (key = 'click'), 6) AS drop FROM st GROUP BY 1""",
    ),
)(lambda spark, sf: M.range_section(points(spark, sf), "click").withColumn("drop", r6("drop")))
register(
    "experiment_ranking",
    with_views(
        "metric_log",
        f"""WITH {POINTS}, p AS (SELECT experiment, max(best) FILTER (key = 'view') AS best, max(final) FILTER (key = 'view') AS final FROM st GROUP BY 1)
 SELECT experiment, best, final, best_step, row_number() OVER (ORDER BY -best NULLS FIRST, experiment) AS rank FROM p LEFT JOIN (SELECT experiment, best_step FROM bs WHERE key = 'view') USING (experiment)""",
    ),
)(lambda spark, sf: M.experiment_ranking(points(spark, sf), "view"))


#: Event types as logged metrics, so that some cells of every kind of section have values.
REPORTED = {
    "val-core/events/acc/mean@16": "view",
    "val-core/events/acc/best@16/mean": "purchase",
    "actor/entropy": "click",
    "critic/rewards/mean": "signup",
    "global_seqlen/mean": "error",
    "rollout_corr/rollout_ppl": "view",
}


def reported(spark, sf):
    names = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(e).alias("event")) for k, e in REPORTED.items()])
    p = points(spark, sf).withColumnRenamed("key", "name").withColumn("n", F.explode(names))
    # one experiment has no entropy
    kept = (F.col("name") == F.col("n.event")) & ~((F.col("experiment") == "run-1") & (F.col("n.key") == "actor/entropy"))
    return p.filter(kept).select("experiment", F.col("n.key").alias("key"), "step", "value")


def report_sql():
    """Every section by itself, from the sections' cells."""
    stats = {"final": "final", "best": "best", "lowest": "lowest"}
    cell = lambda c: f"max({stats[c.stat]}) FILTER (event = '{REPORTED[c.key]}'" + (" AND experiment <> 'run-1')" if c.key == "actor/entropy" else ")") if c.key in REPORTED else "NULL::DOUBLE"
    made = {"gap": "best_of - mean", "consistency_pct": "CASE WHEN best_of > 0 THEN mean / best_of * 100 WHEN mean IS NOT NULL AND best_of IS NOT NULL THEN 0 END", "drop": "highest - lowest"}
    parts = []
    for number, (title, cells) in enumerate([*R.sections("events"), ("Ranking", R.ranking_cells("events"))], 1):
        base = ", ".join(f'{cell(c)} AS "{c.name}"' for c in cells if c.key)
        order = "-coalesce(mean_best, 0), experiment" if title == "Ranking" else "experiment"
        table = f"(SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS line FROM (SELECT experiment, {base} FROM ev GROUP BY 1))"
        for place, c in enumerate(cells):
            column = f'"{c.name}"'
            value = column if c.key else made[c.name]
            parts.append(f"SELECT {number} AS section, '{title}' AS title, line, experiment, {place} AS place, '{c.name}' AS name, round({value}, 6) AS value FROM {table}")
    return f"WITH {POINTS}, ev AS (SELECT experiment, key AS event, final, best, lowest FROM st) " + " UNION ALL ".join(parts)


register("experiment_report", with_views("metric_log", report_sql()))(
    lambda spark, sf: R.experiment_report(reported(spark, sf), "events").select("section", "title", "line", "experiment", "place", "name", r6("value").alias("value"))
)


def kl_steps(spark, sf):
    return V.metric_log(spark, sf).groupBy("worker", "step").agg(
        (F.avg("value") / 500.0).alias("kl"), F.count(F.lit(1)).alias("n_steps")
    )


register(
    "kl_controller_trace",
    with_views(
        "metric_log",
        """WITH s AS (SELECT worker, step, avg(value) / 500.0 AS kl, count(*) AS n FROM metric_log GROUP BY 1, 2),
 m AS (SELECT *, ln(1 + least(greatest(kl / 0.1 - 1, -0.2), 0.2) * n / 50.0) AS lm FROM s),
 c AS (SELECT *, sum(lm) OVER (PARTITION BY worker ORDER BY step) AS cum FROM m)
 SELECT worker, step, round(0.2 * exp(cum - lm), 6) AS kl_coef, round(0.2 * exp(cum), 6) AS kl_coef_after FROM c""",
    ),
)(
    lambda spark, sf: M.kl_controller_trace(kl_steps(spark, sf), ["worker"], 0.2, 0.1, 50.0).select(
        "worker", "step", r6("kl_coef").alias("kl_coef"), r6("kl_coef_after").alias("kl_coef_after")
    )
)


@register(
    "best_steps",
    with_views(
        "metric_log",
        """WITH p AS (SELECT worker, step, name, sum(value) AS value FROM metric_log GROUP BY ALL),
 c AS (SELECT worker, CASE WHEN count(*) FILTER (name = 'view') > 0 THEN 'view' ELSE 'click' END AS name FROM p WHERE name IN ('view', 'click') GROUP BY 1)
 SELECT worker, step, round(value, 6) AS value, value > coalesce(max(value) OVER (PARTITION BY worker ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS is_best FROM p JOIN c USING (worker, name)""",
    ),
)
def best_steps(spark, sf):
    names = F.create_map(*[F.lit(x) for x in ("view", "val-core/x/acc/mean@8", "click", "val-aux/x/acc/mean@8", "purchase", "loss", "signup", "time", "error", "kl")])
    order = F.create_map(*[F.lit(x) for x in ("view", 3, "click", 1, "purchase", 0, "signup", 2, "error", 4)])
    p = V.metric_log(spark, sf).groupBy("worker", "step", "name").agg(F.sum("value").alias("value"))
    p = p.withColumn("ord", order[F.col("name")]).withColumn("name", names[F.col("name")])
    return M.best_steps(p, ["worker"]).select("worker", "step", r6("value").alias("value"), "is_best")


def test_records(spark, sf):
    """Line items as logged test cases; the marker texts stand for timeouts, errors and missing code."""
    c = V.table(spark, sf, "lineitem")
    actual = (
        F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40), M.TIMEOUT)
        .when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30), M.ERROR_PREFIX + "boom")
        .when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 20), M.INCORRECT_FORMAT)
        .otherwise(F.col("l_linestatus"))
    )
    return c.select(
        F.col("l_orderkey").alias("sample_id"), F.col("l_linenumber").alias("test_idx"), (F.col("l_returnflag") != "R").alias("passed"), actual.alias("actual")
    )


register(
    "test_results",
    """WITH r AS (SELECT l_orderkey AS sample_id, l_returnflag <> 'R' AS passed, CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 'Time out' WHEN l_returnflag = 'R' AND l_quantity > 30 THEN 'Error: boom'
 WHEN l_returnflag = 'R' AND l_quantity > 20 THEN 'Incorrect format' ELSE l_linestatus END AS actual FROM lineitem),
 g AS (SELECT sample_id, round(avg(CASE WHEN passed THEN 1.0 ELSE 0 END), 6) AS acc, round(avg(CASE WHEN NOT passed AND actual = 'Time out' THEN 1.0 ELSE 0 END), 6) AS timed_out,
 max(CASE WHEN NOT passed AND contains(actual, 'Error: ') THEN 1 ELSE 0 END) AS error_in_test_cases,
 CASE WHEN count(*) = 1 THEN max(CASE WHEN NOT passed AND actual = 'Incorrect format' THEN 1 ELSE 0 END) ELSE 0 END AS incorrect_format, CAST(bool_and(passed) AS DOUBLE) AS score FROM r GROUP BY 1)
 SELECT g.*, CAST(o_orderstatus = 'P' AS INTEGER) AS truncated, incorrect_format * CAST(o_orderstatus = 'P' AS INTEGER) AS truncated_and_missing_answer FROM g JOIN orders ON o_orderkey = sample_id""",
)(
    lambda spark, sf: M.test_results(
        test_records(spark, sf), V.rollouts(spark, sf).select("sample_id", (F.col("pred") == "P").alias("truncated"))
    )
    .withColumn("acc", r6("acc"))
    .withColumn("timed_out", r6("timed_out"))
)
