"""Registered queries of the advantage family."""

from pyspark.sql import functions as F

from tallyspan.operators import advantage as A
from tallyspan.operators import masked as M
from tallyspan.plans import register
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views
from tallyspan.spread import attach, packed, ranked


def r6(c):
    return F.round(c, 6)


def responses(spark, sf):
    """Responses with their token counts; a response without tokens counts as aborted."""
    per = V.loose_tokens(spark, sf).groupBy("sample_id").agg(
        F.sum("mask").alias("n_valid"), F.count(F.lit(1)).alias("n_tokens")
    )
    return V.rollouts(spark, sf).join(per, "sample_id", "left").fillna({"n_valid": 0, "n_tokens": 0})


RESPONSES_SQL = """responses AS (SELECT r.*, coalesce(t.n_valid, 0) AS n_valid, coalesce(t.n_tokens, 0) AS n_tokens
 FROM rollouts r LEFT JOIN (SELECT sample_id, CAST(sum(mask) AS BIGINT) AS n_valid, count(*) AS n_tokens
 FROM loose_tokens GROUP BY 1) t USING (sample_id))"""


def group_sql(expr, having=""):
    return with_views(
        "rollouts loose_tokens",
        f"""WITH {RESPONSES_SQL}, g AS (SELECT *, count(*) OVER u AS n, avg(score) OVER u AS mean,
 stddev_samp(score) OVER u AS std, sum(score) OVER u AS total, sum(score * n_valid) OVER u AS ws, sum(n_valid) OVER u AS wn
 FROM responses WINDOW u AS (PARTITION BY uid))
 SELECT sample_id, uid, round({expr}, 6) AS adv FROM g {having}""",
    )


def out(df):
    return df.select("sample_id", "uid", r6("adv").alias("adv"))


@register(
    "advantage_report",
    with_views(
        "rollouts",
        """WITH g AS (SELECT *, count(*) OVER u AS n, avg(score) OVER u AS mean, stddev_samp(score) OVER u AS std,
 max(acc) OVER u AS hi, min(acc) OVER u AS lo FROM rollouts WINDOW u AS (PARTITION BY uid)),
 a AS (SELECT *, CASE WHEN n = 1 THEN score / (1 + 1e-6) ELSE (score - mean) / (std + 1e-6) END AS adv FROM g)
 SELECT data_source, count(*) AS responses, round(avg(score), 6) AS mean_score, round(avg(abs(adv)), 6) AS mean_abs_adv,
 round(avg(CASE WHEN hi = lo THEN 1.0 ELSE 0.0 END), 6) AS flat_share FROM a GROUP BY 1""",
    ),
)
def advantage_report(spark, sf):
    a = A.grpo(V.rollouts(spark, sf))
    a = attach(a, ["uid"], hi=F.max("acc"), lo=F.min("acc"))
    return a.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("responses"),
        r6(F.avg("score")).alias("mean_score"),
        r6(F.avg(F.abs("adv"))).alias("mean_abs_adv"),
        r6(F.avg((F.col("hi") == F.col("lo")).cast("double"))).alias("flat_share"),
    )


register("adv_grpo", group_sql("CASE WHEN n = 1 THEN score / (1 + 1e-6) ELSE (score - mean) / (std + 1e-6) END"))(
    lambda spark, sf: out(A.grpo(responses(spark, sf)))
)
register(
    "adv_grpo_std_floor",
    group_sql("CASE WHEN n = 1 THEN score / (1 + 1e-6) ELSE (score - mean) / (greatest(std, 1 / sqrt(n)) + 1e-6) END"),
)(lambda spark, sf: out(A.grpo(responses(spark, sf), std_floor="auto")))
register(
    "adv_grpo_vectorised",
    group_sql("CASE WHEN n = 1 THEN score / (1 + 1e-6) ELSE (score - mean) / (sqrt(greatest(std * std, 1e-6)) + 1e-6) END"),
)(lambda spark, sf: out(A.grpo_vectorised(responses(spark, sf))))
register(
    "adv_grpo_passk",
    with_views(
        "rollouts",
        """WITH g AS (SELECT *, count(*) OVER (PARTITION BY uid) AS n, stddev_samp(score) OVER (PARTITION BY uid) AS std,
 row_number() OVER o AS rn, lead(score) OVER o AS second FROM rollouts
 WINDOW o AS (PARTITION BY uid ORDER BY score DESC, sample_id))
 SELECT sample_id, uid, round(CASE WHEN n < 2 THEN NULL WHEN rn = 1 THEN (score - second) / (std + 1e-6) ELSE 0 END, 6) AS adv FROM g""",
    ),
)(lambda spark, sf: out(A.grpo_passk(V.rollouts(spark, sf), singleton="null")))
register("adv_rloo", group_sql("CASE WHEN n = 1 THEN score ELSE (score - mean) * n / (n - 1) END"))(
    lambda spark, sf: out(A.rloo(responses(spark, sf)))
)
register("adv_rloo_vectorised", group_sql("CASE WHEN n = 1 THEN 0 ELSE (n * score - total) / (n - 1) END"))(
    lambda spark, sf: out(A.rloo_vectorised(responses(spark, sf)))
)
register("adv_opo", group_sql("CASE WHEN n = 1 THEN score ELSE score - ws / nullif(wn, 0) END"))(
    lambda spark, sf: out(A.opo(responses(spark, sf)))
)
register(
    "adv_gpg",
    with_views(
        "rollouts",
        """WITH z AS (SELECT *, greatest(score, 0.0) AS sc FROM rollouts), g AS (SELECT *, count(*) OVER (PARTITION BY uid) AS n,
 avg(sc) OVER (PARTITION BY uid) AS mean, count(*) OVER (PARTITION BY step) * 1.0 / greatest(1, count(*) FILTER (sc <> 0) OVER (PARTITION BY step)) AS alpha FROM z)
 SELECT sample_id, uid, round(alpha * (sc - CASE WHEN n = 1 THEN 0 ELSE mean END) / 2.0, 6) AS adv FROM g""",
    ),
)(lambda spark, sf: out(A.gpg(V.rollouts(spark, sf).withColumn("score", F.greatest("score", F.lit(0.0))), f_norm=2.0)))
register(
    "adv_reinforce_baseline",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {RESPONSES_SQL}, g AS (SELECT *, score - CASE WHEN count(*) OVER u = 1 THEN 0 ELSE avg(score) OVER u END AS d
 FROM responses WINDOW u AS (PARTITION BY uid)),
 w AS (SELECT step, sum(n_valid) AS k, sum(d * n_valid) / (sum(n_valid) + 1e-8) AS m FROM g GROUP BY 1),
 v AS (SELECT g.step, any_value(k) AS k, any_value(m) AS m, sum((d - m) * (d - m) * n_valid) / (any_value(k) + 1e-8) * any_value(k) / (any_value(k) - 1) AS var
 FROM g JOIN w USING (step) GROUP BY 1)
 SELECT sample_id, uid, round(CASE WHEN n_valid > 0 THEN (d - m) / sqrt(var + 1e-8) ELSE 0 END, 6) AS adv FROM g JOIN v USING (step)""",
    ),
)(lambda spark, sf: out(A.reinforce_baseline(responses(spark, sf))))


def step_tokens(spark, sf):
    """Tokens with the step and group of their response."""
    return V.tokens(spark, sf).join(V.rollouts(spark, sf).select("sample_id", "uid", "step", "score"), "sample_id")


STEP_TOKENS = "step_tokens AS (SELECT t.*, r.uid, r.step, r.score FROM tokens t JOIN rollouts r USING (sample_id))"


register(
    "adv_tokens",
    with_views(
        "rollouts loose_tokens",
        """WITH g AS (SELECT sample_id, CASE WHEN count(*) OVER u = 1 THEN score / (1 + 1e-6)
 ELSE (score - avg(score) OVER u) / (stddev_samp(score) OVER u + 1e-6) END AS adv FROM rollouts WINDOW u AS (PARTITION BY uid))
 SELECT sample_id, count(*) AS tokens, round(sum(adv * mask), 6) AS adv_sum, round(max(adv * mask), 6) AS adv_max
 FROM loose_tokens JOIN g USING (sample_id) GROUP BY 1""",
    ),
)(
    lambda spark, sf: A.spread_to_tokens(V.loose_tokens(spark, sf), A.grpo(V.rollouts(spark, sf)))
    .groupBy("sample_id")
    .agg(F.count(F.lit(1)).alias("tokens"), r6(F.sum("adv")).alias("adv_sum"), r6(F.max("adv")).alias("adv_max"))
)


@register(
    "adv_remax",
    with_views(
        "rollouts tokens",
        """WITH greedy AS (SELECT uid, arg_min(score, sample_id) AS baseline FROM rollouts GROUP BY 1)
 SELECT sample_id, pos, round(sum(reward * mask) OVER (PARTITION BY sample_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
 - baseline * mask, 6) AS adv FROM tokens JOIN rollouts USING (sample_id) JOIN greedy USING (uid)""",
    ),
)
def adv_remax(spark, sf):
    # the response with the lowest id of a group stands for its greedy response
    r = V.rollouts(spark, sf)
    base = attach(r, ["uid"], baseline=F.min_by("score", "sample_id")).select("sample_id", "baseline")
    return A.remax(V.tokens(spark, sf).join(base, "sample_id")).select("sample_id", "pos", r6("adv").alias("adv"))


register(
    "adv_reinforce_plus_plus",
    with_views(
        "rollouts tokens",
        f"""WITH {STEP_TOKENS}, c AS (SELECT *, sum(1 - mask) OVER (PARTITION BY sample_id ORDER BY pos) AS gone FROM step_tokens),
 ret AS (SELECT a.sample_id, a.pos, a.step, a.mask, sum(b.reward * power(0.9, b.pos - a.pos)) AS ret
 FROM c a JOIN c b ON a.sample_id = b.sample_id AND b.pos >= a.pos AND (b.pos = a.pos OR b.gone - b.gone0 = 0 OR b.gone = a.gone) GROUP BY ALL),
 w AS (SELECT step, sum(ret * mask) / (sum(mask) + 1e-8) AS m, var_samp(ret) FILTER (mask = 1) AS v FROM ret GROUP BY 1)
 SELECT sample_id, pos, round(ret, 6) AS ret, round((ret - m) / sqrt(v + 1e-8) * mask, 6) AS adv FROM ret JOIN w USING (step)""".replace(
            "b.gone - b.gone0 = 0 OR ", ""
        ),
    ),
)(
    lambda spark, sf: A.reinforce_plus_plus(step_tokens(spark, sf), gamma=0.9).select(
        "sample_id", "pos", r6("ret").alias("ret"), r6("adv").alias("adv")
    )
)
register(
    "adv_gae",
    with_views(
        "rollouts tokens",
        f"""WITH {STEP_TOKENS}, c AS (SELECT *, sum(mask) OVER (PARTITION BY sample_id ORDER BY pos) AS k FROM step_tokens),
 valid AS (SELECT *, reward + 0.95 * coalesce(lead(value) OVER (PARTITION BY sample_id ORDER BY pos), 0) - value AS delta FROM c WHERE mask = 1),
 a AS (SELECT x.sample_id, x.k, sum(power(0.95 * 0.9, y.k - x.k) * y.delta) AS raw FROM valid x JOIN valid y
 ON x.sample_id = y.sample_id AND y.k >= x.k GROUP BY ALL),
 f AS (SELECT c.sample_id, c.pos, c.step, c.mask, c.value, coalesce(a.raw, 0) AS raw FROM c LEFT JOIN a
 ON a.sample_id = c.sample_id AND a.k = c.k + 1 - c.mask),
 w AS (SELECT step, sum(raw * mask) / (sum(mask) + 1e-8) AS m, var_samp(raw) FILTER (mask = 1) AS v FROM f GROUP BY 1)
 SELECT sample_id, pos, round(raw + value, 6) AS ret, round((raw - m) / sqrt(v + 1e-8), 6) AS adv FROM f JOIN w USING (step)""",
    ),
)(
    lambda spark, sf: A.gae(step_tokens(spark, sf), gamma=0.95, lam=0.9).select(
        "sample_id", "pos", r6("ret").alias("ret"), r6("adv").alias("adv")
    )
)


def energy_tokens(spark, sf):
    p = F.exp("old_logp")
    return V.tokens(spark, sf).withColumn("sum_pi2", p * p + (1 - p) * (1 - p) * 0.25).withColumn("rho", F.least(F.exp(F.col("old_logp") - F.col("rollout_logp")), F.lit(1.05)))


ENERGY = """e AS (SELECT t.*, r.uid, (1 - 2 * exp(old_logp) + exp(old_logp) * exp(old_logp) + (1 - exp(old_logp)) * (1 - exp(old_logp)) * 0.25) AS w0,
 least(exp(old_logp - rollout_logp), 1.05) AS rho FROM tokens t JOIN rollouts r USING (sample_id)),
 s AS (SELECT *, sum(reward * mask) OVER (PARTITION BY sample_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ret,
 sum({w} * mask) OVER (PARTITION BY sample_id ORDER BY pos) AS w, sum(mask) OVER (PARTITION BY sample_id ORDER BY pos) AS v FROM e)"""

register(
    "adv_optimal_token_baseline",
    with_views(
        "rollouts tokens",
        f"""WITH {ENERGY.format(w='w0')}, n AS (SELECT uid, count(*) AS n FROM rollouts GROUP BY 1),
 b AS (SELECT uid, pos, sum(ret * w * mask) / (sum(w * mask) + 1e-8) AS base FROM s GROUP BY 1, 2)
 SELECT sample_id, pos, round((ret - CASE WHEN n = 1 THEN 0 ELSE base END) * mask, 6) AS adv FROM s JOIN b USING (uid, pos) JOIN n USING (uid)""",
    ),
)(
    lambda spark, sf: A.optimal_token_baseline(energy_tokens(spark, sf), V.rollouts(spark, sf)).select(
        "sample_id", "pos", r6("adv").alias("adv")
    )
)
register(
    "adv_optimal_token_baseline_tail",
    with_views(
        "rollouts tokens",
        f"""WITH {ENERGY.format(w='w0 * rho * rho')}, l AS (SELECT r.sample_id, r.uid, coalesce(sum(mask), 0) AS len FROM rollouts r LEFT JOIN tokens t USING (sample_id) GROUP BY 1, 2),
 n AS (SELECT uid, count(*) AS n, max(len) AS longest FROM l GROUP BY 1),
 tail AS (SELECT l.sample_id, l2.second FROM l JOIN n USING (uid) JOIN (SELECT uid, list_sort(list(len), 'DESC')[2] AS second FROM l GROUP BY 1) l2 USING (uid)
 WHERE n.n > 1 AND l.len = longest AND longest > second),
 b AS (SELECT uid, pos, sum(ret * w * mask) / (sum(w * mask) + 1e-8) AS base FROM s GROUP BY 1, 2)
 SELECT s.sample_id, pos, round((ret - CASE WHEN n = 1 OR pos > coalesce(second, 1000000) THEN 0 ELSE base END) * mask, 6) AS adv
 FROM s JOIN b USING (uid, pos) JOIN n USING (uid) LEFT JOIN tail ON tail.sample_id = s.sample_id""",
    ),
)(
    lambda spark, sf: A.optimal_token_baseline(
        energy_tokens(spark, sf), V.rollouts(spark, sf), weight="rho", zero_tail=True
    ).select("sample_id", "pos", r6("adv").alias("adv"))
)
register(
    "adv_optimal_token_baseline_multi_turn",
    with_views(
        "rollouts tokens",
        f"""WITH {ENERGY.format(w='w0')}, l AS (SELECT sample_id, uid, sum(mask) AS len FROM s GROUP BY 1, 2 HAVING sum(mask) > 0),
 n AS (SELECT uid, count(*) AS n, max(len) AS longest, list_sort(list(len), 'DESC')[2] AS second FROM l GROUP BY 1),
 b AS (SELECT uid, v, sum(ret * w) / (sum(w) + 1e-8) AS base FROM s WHERE mask = 1 GROUP BY 1, 2)
 SELECT s.sample_id, s.pos, round(CASE WHEN mask = 0 THEN 0 ELSE ret - CASE WHEN n = 1 OR (l.len = longest AND longest > second AND s.v > second) THEN 0 ELSE base END END, 6) AS adv
 FROM s LEFT JOIN b USING (uid, v) LEFT JOIN n USING (uid) LEFT JOIN l ON l.sample_id = s.sample_id""",
    ),
)(
    lambda spark, sf: A.optimal_token_baseline_multi_turn(energy_tokens(spark, sf), V.rollouts(spark, sf)).select(
        "sample_id", "pos", r6("adv").alias("adv")
    )
)


def guided_tokens(spark, sf):
    """Token rewards relative to the teacher; responses of open orders are outside the distillation set."""
    r = V.rollouts(spark, sf).select("sample_id", "uid", "step", (F.col("pred") != "O").cast("int").alias("sd_mask"))
    return V.tokens(spark, sf).withColumn("reward", F.exp("old_logp")).join(r, "sample_id")


GUIDED = "g AS (SELECT t.* EXCLUDE (reward), exp(old_logp) AS reward, r.uid, r.step, mask * CAST(pred <> 'O' AS INTEGER) AS e FROM tokens t JOIN rollouts r USING (sample_id))"
GUIDED_TAIL = """st AS (SELECT uid, avg(reward) AS m, stddev_pop(reward) AS sd, count(DISTINCT sample_id) AS k FROM g WHERE e = 1 GROUP BY 1),
 lv AS (SELECT step, avg(reward) AS lv FROM g WHERE e = 1 GROUP BY 1),
 a AS (SELECT sample_id, pos, reward, e, lv, CASE WHEN e = 1 THEN greatest(least(({src} - m) / greatest(sd, {floor}), 5.0), -5.0) ELSE 0 END AS a
 FROM {tab} LEFT JOIN st USING (uid) LEFT JOIN lv USING (step))
 SELECT sample_id, pos, round(CASE WHEN e = 1 AND reward < CASE WHEN lv < 0 THEN -1.0 ELSE 0.1 END * 4 AND a < 0 THEN greatest(a, -0.5) ELSE a END, 6) AS adv FROM a"""
register(
    "adv_teacher_guided",
    with_views("rollouts tokens", f"WITH {GUIDED}, {GUIDED_TAIL.format(src='reward', floor='CASE WHEN k > 1 THEN 1 / sqrt(k) ELSE 1 END', tab='g')}"),
)(
    lambda spark, sf: A.teacher_guided(guided_tokens(spark, sf), std_floor="auto", safety_thresh=0.4).select(
        "sample_id", "pos", r6("adv").alias("adv")
    )
)
register(
    "adv_teacher_guided_gae",
    with_views(
        "rollouts tokens",
        f"""WITH {GUIDED}, d AS (SELECT *, reward + coalesce(lead(value) OVER (PARTITION BY sample_id ORDER BY pos), 0) * e - value * e AS delta,
 sum(1 - e) OVER (PARTITION BY sample_id ORDER BY pos) AS gone FROM g),
 q AS (SELECT x.sample_id, x.pos, x.reward, x.e, x.uid, x.step, sum(power(0.95, y.pos - x.pos) * y.delta) AS gae
 FROM d x JOIN d y ON x.sample_id = y.sample_id AND y.pos >= x.pos AND y.gone = x.gone GROUP BY ALL),
 {GUIDED_TAIL.format(src='gae', floor='0.05', tab='q')}""",
    ),
)(
    lambda spark, sf: A.teacher_guided(
        guided_tokens(spark, sf), std_floor=0.05, safety_thresh=0.4, gae_value="value"
    ).select("sample_id", "pos", r6("adv").alias("adv"))
)

SIGNAL_SQL = {
    "teacher_student_kl": "rollout_logp - old_logp",
    "teacher_prob": "exp(rollout_logp)",
    "policy_change": "old_logp - (old_logp - reward)",
    "teacher_student_diff": "greatest(exp(rollout_logp) - exp(old_logp), 0)",
}
for _signal, _expr in SIGNAL_SQL.items():
    register(
        f"adv_future_kl_{_signal}",
        with_views(
            "tokens",
            f"""WITH f AS (SELECT x.sample_id, x.pos, any_value(x.value) AS value, sum(power(power(2.0, -1.0 / 16), y.pos - x.pos) * ({_expr.replace('rollout_logp', 'y.rollout_logp').replace('old_logp', 'y.old_logp').replace('rollout_y.old', 'rollout').replace('y.y.', 'y.').replace('reward', 'y.reward')}) * y.mask) AS f
 FROM tokens x JOIN tokens y ON x.sample_id = y.sample_id AND y.pos >= x.pos GROUP BY 1, 2)
 SELECT sample_id, pos, round(f, 6) AS future_kl, round(value * greatest(least(exp(f), 1.3), 0.7), 6) AS adv_mod FROM f""",
        ),
    )(
        lambda spark, sf, signal=_signal: A.future_kl_modulation(
            V.tokens(spark, sf).select(
                "sample_id",
                "pos",
                "mask",
                "value",
                F.col("rollout_logp").alias("teacher_logp"),
                F.col("old_logp").alias("student_logp"),
                (F.col("old_logp") - F.col("reward")).alias("old_logp"),
            ),
            signal,
            adv="value",
            decay=16.0,
            ratio=0.3,
        ).select("sample_id", "pos", r6("future_kl").alias("future_kl"), r6("adv_mod").alias("adv_mod"))
    )

HYBRID = """p AS (SELECT r.sample_id, r.uid, r.step, avg(rollout_logp) FILTER (mask = 1) AS lp, avg(exp(rollout_logp)) FILTER (mask = 1) AS mp
 FROM rollouts r LEFT JOIN loose_tokens t USING (sample_id) GROUP BY 1, 2, 3),
 sc AS (SELECT *, coalesce(exp(lp), 0) AS s FROM p),
 g AS (SELECT *, CASE WHEN count(*) OVER u = 1 THEN s / (1 + 1e-6) ELSE (s - avg(s) OVER u) / (stddev_samp(s) OVER u + 1e-6) END AS sa FROM sc WINDOW u AS (PARTITION BY uid)),
 d AS MATERIALIZED (SELECT t.sample_id, tag, mask, g.step, sa, CASE WHEN mask = 1 THEN exp(rollout_logp) - mp ELSE 0 END AS delta FROM loose_tokens t JOIN g USING (sample_id))"""
register(
    "adv_hybrid",
    with_views(
        "rollouts loose_tokens",
        f"WITH {HYBRID} SELECT sample_id, tag, round((0.4 * sa + 0.6 * delta) * mask, 6) AS adv FROM d",
    ),
)(
    lambda spark, sf: A.hybrid_sentence_token(
        V.loose_tokens(spark, sf).withColumnRenamed("rollout_logp", "teacher_logp"),
        V.rollouts(spark, sf).select("sample_id", "uid", "step"),
        alpha=0.4,
    ).select("sample_id", "tag", r6("adv").alias("adv"))
)
register(
    "adv_hybrid_normalised",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {HYBRID.replace(" MATERIALIZED", "")}, f AS (SELECT step, 1 / sqrt(count(*)) AS f FROM rollouts GROUP BY 1),
 v AS (SELECT sample_id, tag, mask, sa, delta, f, CASE WHEN mask = 1 THEN delta END AS live, step FROM d JOIN f USING (step)),
 w AS (SELECT *, avg(live) OVER (PARTITION BY step) AS m, greatest(stddev_pop(live) OVER (PARTITION BY step), f) AS sd FROM v)
 SELECT sample_id, tag, round((0.4 * sa + 0.6 * (delta - m) / sd) * mask, 6) AS adv FROM w""",
    ),
)(
    lambda spark, sf: A.hybrid_sentence_token(
        V.loose_tokens(spark, sf).withColumnRenamed("rollout_logp", "teacher_logp"),
        V.rollouts(spark, sf).select("sample_id", "uid", "step"),
        alpha=0.4,
        normalise_delta=True,
        std_floor="auto",
    ).select("sample_id", "tag", r6("adv").alias("adv"))
)
register(
    "kl_penalised_reward",
    with_views(
        "rollouts loose_tokens",
        """WITH t AS (SELECT t.*, step, (old_logp - rollout_logp) * mask AS kl FROM loose_tokens t JOIN rollouts USING (sample_id)),
 p AS (SELECT step, sample_id, sum(kl) / (sum(mask) + 1e-8) AS mk FROM t GROUP BY 1, 2), b AS (SELECT step, avg(mk) AS bk FROM p GROUP BY 1)
 SELECT sample_id, tag, round(reward - 0.1 * kl, 6) AS reward_kl, round(bk, 6) AS batch_kl FROM t JOIN b USING (step)""",
    ),
)(
    lambda spark, sf: A.kl_penalised_reward(
        V.loose_tokens(spark, sf).join(V.rollouts(spark, sf).select("sample_id", "step"), "sample_id"),
        F.col("old_logp") - F.col("rollout_logp"),
        0.1,
    ).select("sample_id", "tag", r6("reward_kl").alias("reward_kl"), r6("batch_kl").alias("batch_kl"))
)
register(
    "last_token_score",
    with_views(
        "rollouts tokens",
        """WITH n AS (SELECT sample_id, sum(mask) AS n FROM tokens GROUP BY 1)
 SELECT sample_id, pos, round(CASE WHEN pos = n THEN score ELSE 0 END, 6) AS token_score FROM tokens JOIN n USING (sample_id) JOIN rollouts USING (sample_id)""",
    ),
)(
    lambda spark, sf: A.place_on_last_valid(V.tokens(spark, sf), V.rollouts(spark, sf)).select(
        "sample_id", "pos", r6("token_score").alias("token_score")
    )
)
register(
    "sequence_log_prob",
    with_views(
        "loose_tokens",
        """SELECT sample_id, round(sum(old_logp * mask) / greatest(sum(mask), 1), 6) AS seq_logp,
 round(exp(sum(old_logp * mask) / greatest(sum(mask), 1)), 6) AS sentence_prob FROM loose_tokens GROUP BY 1""",
    ),
)(
    lambda spark, sf: A.sequence_log_prob(V.loose_tokens(spark, sf), "old_logp").select(
        "sample_id", r6("seq_logp").alias("seq_logp"), r6("sentence_prob").alias("sentence_prob")
    )
)
register(
    "response_mask_from_end",
    with_views(
        "tokens",
        """SELECT sample_id, pos, CAST(pos <= coalesce(min(CASE WHEN tag IN (3, 5) THEN pos END) OVER (PARTITION BY sample_id), 1000000) AS INTEGER) AS resp_mask,
 CAST(greatest(sum(mask) OVER (PARTITION BY sample_id ORDER BY pos) - 1, 0) AS BIGINT) AS position_id FROM tokens""",
    ),
)(
    lambda spark, sf: A.position_ids(A.eos_mask(V.tokens(spark, sf), [3, 5])).select(
        "sample_id", "pos", "resp_mask", "position_id"
    )
)


@register(
    "turn_token_mask",
    """WITH s AS (SELECT conv_id, turn, length(text) - length(replace(text, ' ', '')) + 1 AS n, role = 'assistant' AS g FROM conversations)
 SELECT conv_id, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(CASE WHEN g THEN n ELSE 0 END) AS BIGINT) AS generated,
 md5(string_agg(repeat(CASE WHEN g THEN '1' ELSE '0' END, n), '' ORDER BY turn)) AS mask_md5 FROM s GROUP BY 1""",
)
def turn_token_mask(spark, sf):
    t = F.col("text")
    turns = V.chats(spark, sf).select(
        "conv_id", "turn", (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).alias("n"), (F.col("role") == "assistant").alias("generated")
    )
    pages = packed(ranked(turns, ["conv_id"], ["turn"], "k"), ["conv_id"], "k", ["n", "generated"], "spans")
    mask = pages.withColumn("mask", A.span_mask(F.col("spans")))
    return mask.select(
        "conv_id",
        F.size("mask").cast("long").alias("tokens"),
        F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("generated"),
        F.md5(F.array_join(F.transform("mask", lambda x: x.cast("string")), "")).alias("mask_md5"),
    )


register(
    "masked_stats",
    with_views(
        "rollouts loose_tokens",
        """SELECT step, round(sum(value * mask), 6) AS total, round(sum(value * mask) / (sum(mask) + 1e-8), 6) AS mean,
 round(var_samp(value) FILTER (mask = 1) * sum(mask) / (sum(mask) + 1e-8), 6) AS var FROM loose_tokens JOIN rollouts USING (sample_id) GROUP BY 1""",
    ),
)(
    lambda spark, sf: M.masked_stats(
        V.loose_tokens(spark, sf).join(V.rollouts(spark, sf).select("sample_id", "step"), "sample_id"), ["step"], "value", "mask"
    ).select("step", r6("total").alias("total"), r6("mean").alias("mean"), r6("var").alias("var"))
)
register(
    "masked_whiten",
    with_views(
        "rollouts loose_tokens",
        """WITH t AS (SELECT t.*, step FROM loose_tokens t JOIN rollouts USING (sample_id)),
 w AS (SELECT step, sum(value * mask) / (sum(mask) + 1e-8) AS m, var_samp(value) FILTER (mask = 1) AS v FROM t GROUP BY 1)
 SELECT sample_id, tag, round((value - m) / sqrt(v + 1e-8), 6) AS white FROM t JOIN w USING (step)""",
    ),
)(
    lambda spark, sf: M.whiten(
        V.loose_tokens(spark, sf).join(V.rollouts(spark, sf).select("sample_id", "step"), "sample_id"), ["step"], "value", "mask", "white"
    ).select("sample_id", "tag", r6("white").alias("white"))
)
register(
    "token_reductions",
    with_views(
        "rollouts loose_tokens",
        """WITH p AS (SELECT step, sample_id, sum(reward * mask) AS s, sum(mask) AS n FROM loose_tokens JOIN rollouts USING (sample_id) GROUP BY 1, 2)
 SELECT step, round(sum(s) / sum(n), 6) AS token_mean, round(avg(s) FILTER (n > 0), 6) AS seq_mean_token_sum,
 round(avg(s / (n + 1e-8)) FILTER (n > 0), 6) AS seq_mean_token_mean, round(sum(s) / 16.0, 6) AS seq_mean_token_sum_norm FROM p GROUP BY 1""",
    ),
)(
    lambda spark, sf: M.reduce_tokens(
        V.loose_tokens(spark, sf).join(V.rollouts(spark, sf).select("sample_id", "step"), "sample_id"),
        ["step"], "sample_id", "reward", "mask", 16,
    ).select("step", *[r6(c).alias(c) for c in ("token_mean", "seq_mean_token_sum", "seq_mean_token_mean", "seq_mean_token_sum_norm")])
)
