"""Registered queries of the off-policy family."""

from pyspark.sql import functions as F

from tallyspan.operators import offpolicy as O
from tallyspan.plans import register
from tallyspan.plans.advantage import r6
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views

OPTIONS = O.REJECTION_OPTIONS
SPEC = "0.7_1.3,0.02,0.03,0.5_2.0,0.05,0.05,0.8_1.25,0.015,0.015,0.04,0.05"


def stepped(spark, sf):
    return V.loose_tokens(spark, sf).join(V.rollouts(spark, sf).select("sample_id", "step"), "sample_id")


STEPPED = "t AS (SELECT k.*, step, old_logp - rollout_logp AS lr FROM loose_tokens k JOIN rollouts USING (sample_id))"


def rounded(df, keys):
    return df.select(*keys, *[r6(c).alias(c) for c in df.columns if c not in keys])


for _kind, _expr in {
    "k1": "old_logp - rollout_logp",
    "abs": "abs(old_logp - rollout_logp)",
    "k2": "0.5 * (old_logp - rollout_logp) * (old_logp - rollout_logp)",
    "k3": "exp(rollout_logp - old_logp) - (rollout_logp - old_logp) - 1",
}.items():
    register(
        f"kl_estimate_{_kind}",
        with_views("loose_tokens", f"SELECT sample_id, tag, round({_expr}, 6) AS kl FROM loose_tokens"),
    )(
        lambda spark, sf, kind=_kind: V.loose_tokens(spark, sf).select(
            "sample_id", "tag", r6(O.kl_estimate(F.col("old_logp"), F.col("rollout_logp"), kind)).alias("kl")
        )
    )

register(
    "importance_weights_token",
    with_views(
        "loose_tokens rollouts",
        f"""WITH {STEPPED}, w AS (SELECT *, least(exp(lr) * mask, 1.05) AS w FROM t),
 b AS (SELECT step, sum(w * mask) / (sum(mask) + 1e-8) AS m FROM w GROUP BY 1)
 SELECT sample_id, tag, round(w / m, 6) AS weight FROM w JOIN b USING (step)""",
    ),
)(
    lambda spark, sf: O.importance_weights(stepped(spark, sf), "token", 1.05, normalise=True).select(
        "sample_id", "tag", r6("weight").alias("weight")
    )
)
register(
    "importance_weights_sequence",
    with_views(
        "loose_tokens rollouts",
        f"""WITH {STEPPED}, s AS (SELECT *, sum(lr * mask) OVER u AS slr, sum(mask) OVER u AS n FROM t WINDOW u AS (PARTITION BY sample_id)),
 w AS (SELECT *, least(exp(least(greatest(slr, -20), 20)) * mask, 1.2) AS w FROM s),
 q AS (SELECT step, sample_id, sum(w) / (sum(mask) + 1e-8) AS sw FROM w GROUP BY 1, 2 HAVING sum(mask) > 0),
 b AS (SELECT step, avg(sw) AS m FROM q GROUP BY 1)
 SELECT sample_id, tag, round(w / m, 6) AS weight FROM w JOIN b USING (step)""",
    ),
)(
    lambda spark, sf: O.importance_weights(stepped(spark, sf), "sequence", 1.2, normalise=True).select(
        "sample_id", "tag", r6("weight").alias("weight")
    )
)


def weight_metrics_sql(level, threshold):
    low = 1.0 / threshold
    if level == "token":
        per_token = "exp(lr) * mask"
        extremes = "max(hi) AS is_max, min(lo) AS is_min, sum(ab) / n AS is_fraction_high, sum(be) / n AS is_fraction_low"
    else:
        per_token = "exp(least(greatest(sum(lr * mask) OVER (PARTITION BY sample_id), -20), 20)) * mask"
        extremes = f"""exp(least(max(slr), 20)) AS is_max, exp(min(slr)) AS is_min,
 avg(CASE WHEN slr > ln({threshold}) THEN 1.0 ELSE 0 END) AS is_fraction_high, avg(CASE WHEN slr < ln({low}) THEN 1.0 ELSE 0 END) AS is_fraction_low"""
    return with_views(
        "loose_tokens rollouts",
        f"""WITH {STEPPED}, w AS (SELECT *, {per_token} AS w FROM t), c AS (SELECT *, least(greatest(w, {low}), {threshold}) AS c FROM w),
 p AS (SELECT step, sample_id, sum(mask) AS k, sum(w) AS w, sum(c * mask) AS c, sum(c * c * mask) AS cc, max(w) FILTER (mask = 1) AS hi,
 min(w) FILTER (mask = 1) AS lo, sum(CASE WHEN w > {threshold} THEN mask ELSE 0 END) AS ab, sum(CASE WHEN w < {low} THEN mask ELSE 0 END) AS be,
 sum(lr * mask) AS slr, sum(w) / (sum(mask) + 1e-8) AS sw FROM c GROUP BY 1, 2),
 g AS (SELECT step, sum(k) + 1e-8 AS n, sum(w) / n AS is_mean, {extremes}, sqrt(greatest(sum(cc) / n - (sum(c) / n) * (sum(c) / n), 0)) AS is_std,
 (sum(c) / n + 1e-8) * (sum(c) / n + 1e-8) / (sum(cc) / n) AS is_eff_sample_size, avg(sw) AS is_seq_mean, stddev_samp(sw) AS is_seq_std,
 max(sw) AS is_seq_max, min(sw) AS is_seq_min, max(abs(sw - 1)) AS is_seq_max_deviation,
 avg(CASE WHEN sw > {threshold} THEN 1.0 ELSE 0 END) AS is_seq_fraction_high, avg(CASE WHEN sw < {low} THEN 1.0 ELSE 0 END) AS is_seq_fraction_low FROM p GROUP BY 1)
 SELECT step, round(COLUMNS('is_.*'), 6) FROM g""",
    )


for _level, _threshold in (("token", 1.0537), ("sequence", 1.2)):
    register(f"weight_metrics_{_level}", weight_metrics_sql(_level, _threshold))(
        lambda spark, sf, level=_level, threshold=_threshold: rounded(
            O.weight_metrics(stepped(spark, sf), level, threshold), ["step"]
        )
    )


def rejection_sql(options, spec):
    """CTEs up to ``k``: every option's statistic and verdict per token; and the parsed bounds."""
    bounds = O.parse_thresholds(options, spec)
    k = {"k1": "-lr", "k2": "0.5 * lr * lr", "k3": "exp(lr) - 1 - lr"}
    stats, keeps = [], []
    for o in options:
        level, _, kind = o.rpartition("_")
        v = k[kind]
        stats.append(
            {
                "token": v,
                "seq_sum": f"sum(({v}) * mask) OVER u",
                "seq_mean": f"sum(({v}) * mask) OVER u / (sum(mask) OVER u + 1e-8)",
                "seq_max": f"coalesce(max(CASE WHEN mask = 1 THEN {v} END) OVER u, 0)",
            }[level]
            + f" AS stat_{o}"
        )
        low, high = bounds[o]
        keeps.append(f"(stat_{o} >= ln({low}) AND stat_{o} <= ln({high}))" if low else f"stat_{o} <= {high}")
    kept = ", ".join(f"CAST({c} AS INTEGER) AS keep_{o}" for c, o in zip(keeps, options, strict=True))
    ctes = f"""{STEPPED}, s AS (SELECT *, {', '.join(stats)} FROM t WINDOW u AS (PARTITION BY sample_id)),
 k AS (SELECT *, {kept}, mask * CAST({' AND '.join(keeps)} AS INTEGER) AS kept FROM s)"""
    return ctes, bounds


REJECTED, _ = rejection_sql(OPTIONS, SPEC)
register(
    "rejection_mask",
    with_views(
        "loose_tokens rollouts",
        f"WITH {REJECTED} SELECT sample_id, tag, {', '.join(f'keep_{o}' for o in OPTIONS)}, kept AS kept_mask FROM k",
    ),
)(
    lambda spark, sf: O.rejection_mask(V.loose_tokens(spark, sf), OPTIONS, SPEC).select(
        "sample_id", "tag", *[f"keep_{o}" for o in OPTIONS], "kept_mask"
    )
)


def rejection_metrics_sql(options, spec):
    rejected, bounds = rejection_sql(options, spec)
    per = ["sum(mask) AS n", "sum(mask - kept) AS lost"]
    cells = []
    for o in options:
        low, high = bounds[o]
        hi, lo = (f"ln({high})", f"ln({low})") if low else (str(high), "0.0")
        s = f"stat_{o}"
        c = f"least(greatest({s}, {lo}), {hi})"
        seq = o.startswith("seq")
        per += [
            f"sum({s} * mask) AS s_{o}", f"max({s}) FILTER (mask = 1) AS hi_{o}", f"min({s}) FILTER (mask = 1) AS lo_{o}",
            f"sum(CASE WHEN {s} > {hi} THEN mask ELSE 0 END) AS ab_{o}", f"sum(CASE WHEN {s} < {lo} THEN mask ELSE 0 END) AS be_{o}",
            f"sum({c} * mask) AS c_{o}", f"sum({c} * {c} * mask) AS cc_{o}", f"sum(mask * (1 - keep_{o})) AS lost_{o}",
            (f"max({s}) FILTER (mask = 1)" if seq else f"CASE WHEN sum(mask) > 0 THEN sum({s} * mask) / (sum(mask) + 1e-8) END") + f" AS q_{o}",
        ]
        n = "(sum(n) + 1e-8)"
        q = f"q_{o}"
        frac = lambda cond: f"avg(CASE WHEN n > 0 THEN CASE WHEN {cond} THEN 1.0 ELSE 0.0 END END)"
        metrics = {
            "mean": f"sum(s_{o}) / {n}",
            "max": f"max({q})" if seq else f"max(hi_{o})",
            "min": f"min({q})" if seq else f"min(lo_{o})",
            "std": f"sqrt(greatest(sum(cc_{o}) / {n} - (sum(c_{o}) / {n}) * (sum(c_{o}) / {n}), 0))",
            "fraction_high": frac(f"{q} > {hi}") if seq else f"sum(ab_{o}) / {n}",
            "fraction_low": ("0.0" if not low else frac(f"{q} < {lo}") if seq else f"sum(be_{o}) / {n}"),
            "seq_mean": f"avg({q})", "seq_std": f"stddev_samp({q})", "seq_max": f"max({q})", "seq_min": f"min({q})",
            "seq_max_deviation": f"max(abs({q}))", "seq_fraction_high": frac(f"{q} > {hi}"),
            "masked_fraction": f"sum(lost_{o}) / {n}", "seq_masked_fraction": frac(f"lost_{o} > 0"),
        }
        if low:
            metrics["seq_fraction_low"] = frac(f"{q} < {lo}")
        cells += [(o, m, e) for m, e in metrics.items()]
    cells += [("all", "masked_fraction", "sum(lost) / (sum(n) + 1e-8)"), ("all", "seq_masked_fraction", "avg(CASE WHEN lost > 0 THEN 1.0 ELSE 0.0 END)")]
    rows = " UNION ALL ".join(
        f"SELECT step, '{o}' AS option, '{m}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM p GROUP BY step" for o, m, e in cells
    )
    return with_views(
        "loose_tokens rollouts", f"WITH {rejected}, p AS MATERIALIZED (SELECT step, sample_id, {', '.join(per)} FROM k GROUP BY 1, 2) {rows}"
    )


register("rejection_metrics", rejection_metrics_sql(OPTIONS, SPEC))(
    lambda spark, sf: O.rejection_metrics(stepped(spark, sf), OPTIONS, SPEC).select(
        "step", "option", "metric", r6("value").alias("value")
    )
)
DRIFT = """p AS (SELECT step, sample_id, sum(mask) AS k, sum(old_logp * mask) / (sum(mask) + 1e-8) AS o, sum(rollout_logp * mask) / (sum(mask) + 1e-8) AS r,
 sum(lr * mask) AS lr, sum((exp(lr) - lr - 1) * mask) AS k3, sum(exp(2 * lr) * mask) AS rr FROM t GROUP BY 1, 2),
 g AS (SELECT step, avg(exp(-o)) AS training_ppl, avg(-o) AS training_log_ppl, avg(exp(-r)) AS rollout_ppl, avg(-r) AS rollout_log_ppl,
 -sum(lr) / (sum(k) + 1e-8) AS kl, sum(k3) / (sum(k) + 1e-8) AS k3_kl, avg(r - o) AS log_ppl_diff, avg(abs(r - o)) AS log_ppl_abs_diff,
 max(r - o) AS log_ppl_diff_max, min(r - o) AS log_ppl_diff_min, avg(exp(r - o)) AS ppl_ratio, sum(rr) / (sum(k) + 1e-8) - 1 AS chi2_token,
 avg(exp(2 * lr)) - 1 AS chi2_seq FROM p GROUP BY 1)"""
register(
    "drift_metrics",
    with_views("loose_tokens rollouts", f"WITH {STEPPED}, {DRIFT} SELECT step, round(COLUMNS(* EXCLUDE (step)), 6) FROM g"),
)(lambda spark, sf: rounded(O.drift_metrics(stepped(spark, sf)), ["step"]))
CORRECTED = (["seq_mean_k1"], f"0.9_{1 / 0.9}")
# many weights of these tables are 1.05 but for the last bit, so a threshold beside it is compared
register(
    "correction_metrics",
    f"""WITH d AS ({with_views("loose_tokens rollouts", f"WITH {STEPPED}, {DRIFT} SELECT * FROM g")}),
 w AS ({weight_metrics_sql("token", 1.0537)}), r AS ({rejection_metrics_sql(*CORRECTED)})
 SELECT step, 'rollout_corr/' || metric AS metric, round(value, 6) AS value FROM (UNPIVOT d ON COLUMNS(* EXCLUDE (step)) INTO NAME metric VALUE value)
 UNION ALL SELECT step, 'rollout_corr/rollout_' || metric, value FROM (UNPIVOT w ON COLUMNS(* EXCLUDE (step)) INTO NAME metric VALUE value)
 UNION ALL SELECT step, 'rollout_corr/rollout_rs_' || CASE WHEN option = 'all' THEN '' ELSE option || '_' END || metric, value FROM r""",
)(
    lambda spark, sf: O.correction_metrics(stepped(spark, sf), "token", 1.0537, *CORRECTED).select("step", "metric", r6("value").alias("value"))
)
register(
    "correct_rollouts",
    with_views(
        "loose_tokens rollouts",
        f"""WITH {STEPPED}, s AS (SELECT *, sum(0.5 * lr * lr * mask) OVER (PARTITION BY sample_id) AS k2 FROM t)
 SELECT sample_id, tag, round(least(exp(lr) * mask, 1.05), 6) AS weight, mask * CAST(k2 <= 0.05 AND -lr >= ln(0.8) AND -lr <= ln(1.25) AS INTEGER) AS kept_mask FROM s""",
    ),
)(
    lambda spark, sf: O.correct(stepped(spark, sf), "token", 1.05, ["token_k1", "seq_sum_k2"], "0.8_1.25,0.05").select(
        "sample_id", "tag", r6("weight").alias("weight"), "kept_mask"
    )
)
register(
    "correct_rollouts_bypass",
    with_views(
        "loose_tokens rollouts",
        f"WITH {STEPPED} SELECT step, count(*) AS tokens, CAST(sum(mask) AS BIGINT) AS kept, round(CAST(sum(mask) AS DOUBLE), 6) AS weight_sum FROM t GROUP BY 1",
    ),
)(
    lambda spark, sf: O.correct(stepped(spark, sf), "token", 2.0, ["token_k1"], 2.0, bypass=True)
    .groupBy("step")
    .agg(
        F.count(F.lit(1)).alias("tokens"), F.sum("kept_mask").alias("kept"), r6(F.sum("weight")).alias("weight_sum")
    )
)
register(
    "prob_drift",
    with_views(
        "loose_tokens rollouts",
        f"""WITH {STEPPED}, d AS (SELECT step, exp(old_logp) AS p, exp(rollout_logp) AS q FROM t WHERE mask = 1)
 SELECT step, round(max(abs(p - q)), 6) AS probs_diff_max, round(avg(abs(p - q)), 6) AS probs_diff_mean,
 round(stddev_samp(abs(p - q)), 6) AS probs_diff_std, round(corr(p, q), 6) AS probs_corr FROM d GROUP BY 1""",
    ),
)(lambda spark, sf: rounded(O.prob_drift(stepped(spark, sf)), ["step"]))


def adv_tokens(spark, sf):
    p = F.exp("old_logp")
    return (
        stepped(spark, sf)
        .withColumn("sum_pi2", p * p + (1 - p) * (1 - p) * 0.25)
        .withColumn("rho", F.least(F.exp(O.log_ratio()), F.lit(1.05)))
        .withColumn("adv", F.col("value") - F.col("tag") * 0.3)
    )


ADV = """a AS (SELECT *, least(exp(lr), 1.05) AS rho, value - tag * 0.3 AS adv,
 1 - 2 * exp(old_logp) + exp(old_logp) * exp(old_logp) + (1 - exp(old_logp)) * (1 - exp(old_logp)) * 0.25 AS w FROM t)"""
register(
    "variance_proxies",
    with_views(
        "loose_tokens rollouts",
        f"""WITH {STEPPED}, {ADV}, p AS (SELECT step, sample_id, sum(adv * mask) / (sum(mask) + 1e-8) AS a, sum(w * rho * rho * mask) AS w, sum(w * mask) AS w0,
 sum(rho * mask) / (sum(mask) + 1e-8) AS rho FROM a GROUP BY 1, 2),
 g AS (SELECT step, count(*) AS n, avg(rho * rho * a * a * greatest(w0, 0)) AS tp, avg(a * a) AS ea, avg(w) AS ew FROM p GROUP BY 1)
 SELECT step, CAST(0.01 AS DOUBLE) AS signal_strength, round(tp, 6) AS total_power, round(CASE WHEN n > 1 THEN greatest((tp - 0.01) / (n - 1), 0) ELSE 0 END, 6) AS pure_noise,
 round(ea, 6) AS expected_a_squared, round(ew, 6) AS expected_w FROM g""",
    ),
)(
    lambda spark, sf: rounded(O.variance_proxies(adv_tokens(spark, sf), weight="rho", grad_norm=F.lit(0.1)), ["step"])
)
register(
    "clip_audit",
    with_views(
        "loose_tokens rollouts",
        f"""WITH {STEPPED}, {ADV}, l AS (SELECT step, mask, adv, lr, -adv * exp(lr) AS p, -adv * least(greatest(exp(lr), 0.95), 1.04) AS c FROM a)
 SELECT step, round(-sum(lr * mask) / (sum(mask) + 1e-8), 6) AS mean_kl, round(sum(CASE WHEN c > p THEN mask ELSE 0 END) / (sum(mask) + 1e-8), 6) AS clip_fraction,
 round(sum(CASE WHEN greatest(p, c) > -adv * 1.03 AND adv < 0 THEN mask ELSE 0 END) / (sum(mask) + 1e-8), 6) AS clip_fraction_lower FROM l GROUP BY 1""",
    ),
)(lambda spark, sf: rounded(O.clip_audit(adv_tokens(spark, sf), 0.05, 0.04, 1.03), ["step"]))
