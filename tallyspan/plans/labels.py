"""Registered queries of the token labelling family."""

from pyspark.sql import functions as F

from tallyspan.operators import labels as L
from tallyspan.plans import register
from tallyspan.plans.advantage import r6
from tallyspan.plans.offpolicy import rounded
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views

K = range(1, 5)


def vocab(spark, sf, stepped=False):
    return V.vocab_tokens(spark, sf, stepped).withColumn("teacher_logp", F.col("t1")).withColumn("student_logp", F.col("s1"))


def plus(form):
    """The form for each of the four entries, summed: ``{t}`` and ``{s}`` are its log-probs."""
    return "(" + " + ".join(form.format(t=f"t{i}", s=f"s{i}", i=i) for i in K) + ")"


def divergence_sql(alpha, pairs):
    out = []
    for t, s in pairs:
        if alpha == 0.0:
            out.append(f"exp({s}) * ({s} - {t})")
        elif alpha == 1.0:
            out.append(f"exp({t}) * ({t} - {s})")
        else:
            mix = f"ln({1 - alpha} * exp({s}) + {alpha} * exp({t}))"
            out.append(f"{1 - alpha} * exp({s}) * ({s} - {mix}) + {alpha} * exp({t}) * ({t} - {mix})")
    return "(" + " + ".join(out) + ")"


BEST = "(CASE WHEN t1 >= t2 AND t1 >= t3 AND t1 >= t4 THEN 0 WHEN t2 >= t3 AND t2 >= t4 THEN 1 WHEN t3 >= t4 THEN 2 ELSE 3 END)"
MIX = "ln(0.5 * (exp({t}) + exp({s})))"
FORMS = {
    "log_ratio": "t1 - s1",
    "prob_diff": "exp(t1) - exp(s1)",
    "vocab_log_ratio": plus("{t} - {s}") + " / 4",
    "teacher_prob": "exp(t1)",
    "teacher_log_prob": "t1",
    "teacher_logit": "ln(exp(t1) / (1 - exp(t1)))",
    "teacher_prob_plus_verified": "exp(t1) + sum(reward) OVER (PARTITION BY sample_id)",
    "teacher_prob_binary": """CASE WHEN CASE WHEN mask = 1 THEN exp(t1) ELSE 1 END > (sum(mask * exp(t1)) OVER u + 16 - sum(mask) OVER u) / 16 THEN 1.0 ELSE 0.0 END""",
    "teacher_prob_plus_sentence": "exp(t1)",
    "teacher_prob_relative": f"t1 - ln({plus('exp({t})')} / 4 + 1e-9)",
    "teacher_prob_certainty": f"exp(t1) * least(greatest(1 + {plus('exp({t}) * {t}')} / ln(4), 0), 1)",
    "top1_match": f"CAST({BEST} = 0 AS DOUBLE)",
    "topk_match": f"1 - {BEST} / 4.0",
    "student_topk_teacher_prob": f"{plus('exp({t})')} / 4",
    "student_topk_teacher_prob_weighted": plus("exp({t}) * exp({s})"),
    "teacher_prob_kl_weighted": f"exp(t1) * greatest({plus('exp({t}) * ({t} - {s})')}, 0)",
    "teacher_prob_jsd_weighted": f"exp(t1) * greatest(0.5 * {plus('exp({t}) * ({t} - ' + MIX + ')')} + 0.5 * {plus('exp({s}) * ({s} - ' + MIX + ')')}, 0)",
    "teacher_prob_diff_weighted": "exp(t1) * greatest(exp(t1) - exp(s1), 0)",
}
for _kind, _form in FORMS.items():
    _window = " WINDOW u AS (PARTITION BY sample_id)" if " u " in _form else ""
    register(
        f"token_reward_{_kind}",
        with_views(
            "vocab_tokens",
            f"SELECT sample_id, tag, round(CAST(({_form}) * mask AS DOUBLE), 6) + 0.0 AS token_reward FROM vocab_tokens{_window}",
        ),
    )(
        lambda spark, sf, kind=_kind: L.label_token_reward(vocab(spark, sf), kind, width=16).select(
            "sample_id", "tag", (r6("token_reward") + 0.0).alias("token_reward")
        )
    )
PAIRS = [(f"t{i}", f"s{i}") for i in K]
TAILED = f"""v AS (SELECT *, ln(greatest(1 - {plus('exp({t})')}, 1e-9)) AS tt, ln(greatest(1 - {plus('exp({s})')}, 1e-9)) AS st FROM vocab_tokens)"""
for _name, _alpha in (("student_teacher", 0.0), ("teacher_student", 1.0), ("generalised", 0.3)):
    register(
        f"token_reward_divergence_{_name}",
        with_views(
            "vocab_tokens",
            f"WITH {TAILED} SELECT sample_id, tag, round(-({divergence_sql(_alpha, PAIRS)} + {divergence_sql(_alpha, [('tt', 'st')])}) * mask, 6) + 0.0 AS token_reward FROM v",
        ),
    )(
        lambda spark, sf, alpha=_alpha: L.label_token_reward(
            vocab(spark, sf), "divergence", alpha=alpha, tail=True
        ).select("sample_id", "tag", (r6("token_reward") + 0.0).alias("token_reward"))
    )
TRANSFORM_SQL = {
    "tanh": "tanh(x / 0.7)",
    "tanh01": "(tanh(x / 0.7) + 1) / 2",
    "sigmoid": "1 / (1 + exp(-x / 0.7))",
    "clip": "least(greatest(x, -0.7), 0.7)",
}
for _name, _form in TRANSFORM_SQL.items():
    register(
        f"token_reward_transform_{_name}",
        with_views(
            "vocab_tokens",
            f"WITH x AS (SELECT *, t1 - s1 AS x FROM vocab_tokens) SELECT sample_id, tag, round({_form} * mask, 6) + 0.0 AS token_reward FROM x",
        ),
    )(
        lambda spark, sf, name=_name: L.label_token_reward(vocab(spark, sf), "log_ratio", name, 0.7).select(
            "sample_id", "tag", (r6("token_reward") + 0.0).alias("token_reward")
        )
    )
for _name, _form in (("teacher_seq_log_prob", "x"), ("teacher_sentence_prob", "exp(x)")):
    register(
        f"token_reward_{_name}",
        with_views(
            "vocab_tokens",
            f"""WITH x AS (SELECT sample_id, sum(t1 * mask) / greatest(sum(mask), 1) AS x FROM vocab_tokens GROUP BY 1)
 SELECT sample_id, round({_form}, 6) + 0.0 AS score FROM x""",
        ),
    )(
        lambda spark, sf, name=_name: L.sequence_reward(vocab(spark, sf), name).select(
            "sample_id", (r6("score") + 0.0).alias("score")
        )
    )


def stepped(spark, sf):
    return vocab(spark, sf, stepped=True)


ENTROPY = f"""h AS (SELECT v.*, step, -{plus('exp({t}) * {t}')} AS h, -{plus('exp({s}) * {s}')} AS hs FROM vocab_tokens v JOIN rollouts USING (sample_id))"""
SCORES = {
    "v1": "-h",
    "v1_norm": "-h / max(CASE WHEN mask = 1 THEN h ELSE 0 END) OVER (PARTITION BY step)",
    "v2": "(1 - h / ln(4)) * (1 - exp(t1))",
    "v2sqrt": "sqrt((1 - h / ln(4)) * (1 - exp(t1)) + 1e-8)",
    "v4": "greatest(hs - h, 0)",
}
for _version, _form in SCORES.items():
    register(
        f"confidence_weights_{_version}",
        with_views(
            "vocab_tokens rollouts",
            f"""WITH {ENTROPY}, s AS (SELECT sample_id, tag, mask, {_form} AS s FROM h),
 e AS (SELECT *, exp(s) * mask AS e FROM s), z AS (SELECT *, sum(e) OVER u AS z, sum(mask) OVER u AS n FROM e WINDOW u AS (PARTITION BY sample_id))
 SELECT sample_id, tag, round(CASE WHEN mask = 1 THEN least(e / z * n, 10) ELSE 0 END, 6) AS weight FROM z""",
        ),
    )(
        lambda spark, sf, version=_version: L.confidence_weights(stepped(spark, sf), version).select(
            "sample_id", "tag", r6("weight").alias("weight")
        )
    )
register(
    "confidence_weights_v5",
    with_views(
        "vocab_tokens rollouts",
        f"""WITH {ENTROPY} SELECT sample_id, tag, round(mask * CASE WHEN hs > h THEN 1 - 0.8 / (1 + exp(-least((hs - h) / (hs + 1e-8), 1) / 0.5)) ELSE 1 END, 6) AS weight FROM h""",
    ),
)(lambda spark, sf: L.confidence_weights(stepped(spark, sf), "v5").select("sample_id", "tag", r6("weight").alias("weight")))
register(
    "entropy_metrics",
    with_views(
        "vocab_tokens rollouts",
        f"""WITH {ENTROPY} SELECT step, round(avg(h), 6) AS teacher_entropy_mean, round(stddev_samp(h), 6) AS teacher_entropy_std,
 round(avg(exp(t1)), 6) AS teacher_prob_on_student_mean, round(avg(hs), 6) AS student_entropy_mean, round(avg(hs - h), 6) AS info_gain_mean,
 round(avg(CASE WHEN hs > h THEN 1.0 ELSE 0 END), 6) AS info_gain_positive_ratio, round(avg(greatest(hs - h, 0)), 6) AS collapse_risk_mean,
 round(avg(least(greatest(hs - h, 0) / (hs + 1e-8), 1)), 6) AS normalised_collapse_mean FROM h WHERE mask = 1 GROUP BY 1""",
    ),
)(lambda spark, sf: rounded(L.entropy_metrics(stepped(spark, sf)), ["step"]))


def leak_tokens(spark, sf):
    """Teacher with the demonstration, student as the bare prompt, their blend as the answer-only teacher."""
    blend = F.zip_with("teacher_topk", "student_topk", lambda t, s: t * 0.7 + s * 0.3 - 0.05)
    return stepped(spark, sf).select(
        "sample_id",
        "tag",
        "mask",
        "step",
        F.col("student_topk").alias("base_topk"),
        F.col("teacher_topk").alias("full_topk"),
        blend.alias("answer_topk"),
    )


def _lse(p):
    return "ln(" + " + ".join(f"exp({p}{i})" for i in K) + ")"


LEAK = f"""r AS (SELECT v.sample_id, tag, mask, step, {', '.join(f's{i} AS b{i}, t{i} AS f{i}, t{i} * 0.7 + s{i} * 0.3 - 0.05 AS a{i}' for i in K)} FROM vocab_tokens v JOIN rollouts USING (sample_id)),
 n AS (SELECT *, {', '.join(f'{p}{i} - {_lse(p)} AS n{p}{i}' for p in 'bfa' for i in K)} FROM r),
 w AS (SELECT *, {' + '.join(f'exp(nb{i}) * (nf{i} - nb{i}) * (na{i} - nb{i})' for i in K)} AS fa, {' + '.join(f'exp(nb{i}) * (na{i} - nb{i}) ** 2' for i in K)} AS aa,
 {' + '.join(f'exp(nb{i}) * (nf{i} - nb{i}) ** 2' for i in K)} AS ff FROM n),
 c AS (SELECT *, least(greatest(fa / (aa + 1e-8), 0), 1) AS beta FROM w),
 x AS (SELECT *, {', '.join(f'b{i} + 0.5 * ((f{i} - b{i}) - beta * (a{i} - b{i})) AS c{i}' for i in K)} FROM c),
 z AS (SELECT *, {_lse('c')} AS lse, {' + '.join(f'exp(nb{i}) * (nf{i} - nb{i} - beta * (na{i} - nb{i})) * (na{i} - nb{i})' for i in K)} AS ca,
 {' + '.join(f'exp(nb{i}) * (nf{i} - nb{i} - beta * (na{i} - nb{i})) ** 2' for i in K)} AS cc FROM x)"""
register(
    "clean_teacher",
    with_views(
        "vocab_tokens rollouts",
        f"""WITH {LEAK}, o AS (SELECT *, greatest(lse + 1e-7, 0) AS over FROM z)
 SELECT sample_id, tag, round(beta, 6) AS beta, round(c1 - over, 6) AS first_logp, round(ln(1 - exp(least(lse - over, -1e-7))), 5) AS tail_logp FROM o""",
    ),
)(
    lambda spark, sf: L.clean_teacher(leak_tokens(spark, sf)).select(
        "sample_id",
        "tag",
        r6("beta").alias("beta"),
        r6(F.col("clean_topk")[0]).alias("first_logp"),
        F.round(F.element_at("clean_topk", -1), 5).alias("tail_logp"),
    )
)
register(
    "clean_teacher_metrics",
    with_views(
        "vocab_tokens rollouts",
        f"""WITH {LEAK} SELECT step, round(avg(fa / (sqrt(ff + 1e-8) * sqrt(aa + 1e-8) + 1e-8)), 6) AS cos_full_answer,
 round(avg(ca / (sqrt(cc + 1e-8) * sqrt(aa + 1e-8) + 1e-8)), 6) AS cos_clean_answer, round(avg(beta), 6) AS beta,
 {', '.join(f"round(avg(-({' + '.join(f'exp(n{p}{i}) * n{p}{i}' for i in K)})), 6) AS h_{n}" for p, n in (('b', 'base'), ('f', 'full'), ('a', 'answer')))},
 round(avg(-({' + '.join(f'exp(c{i} - lse) * (c{i} - lse)' for i in K)})), 6) AS h_clean FROM z WHERE mask = 1 GROUP BY 1""",
    ),
)(lambda spark, sf: rounded(L.clean_teacher_metrics(L.clean_teacher(leak_tokens(spark, sf), tail=False)), ["step"]))
register(
    "top_k_renormalised",
    with_views(
        "vocab_tokens",
        f"""SELECT sample_id, tag, round(t1 - {_lse('t')}, 6) AS first_logp, round(ln(1 - exp(least({_lse('t')}, -1e-7))), 6) AS tail_logp FROM vocab_tokens""",
    ),
)(
    lambda spark, sf: V.vocab_tokens(spark, sf).select(
        "sample_id",
        "tag",
        r6(L.renormalise(F.col("teacher_topk"))[0]).alias("first_logp"),
        r6(F.element_at(L.with_tail(F.col("teacher_topk")), -1)).alias("tail_logp"),
    )
)
register(
    "token_group_mass",
    with_views(
        "vocab_tokens rollouts",
        "SELECT step, round(sum((exp(t2) + exp(t4)) * mask) / greatest(sum(mask), 1), 6) AS mass FROM vocab_tokens JOIN rollouts USING (sample_id) GROUP BY 1",
    ),
)(lambda spark, sf: rounded(L.token_group_mass(stepped(spark, sf), ["t2", "t4"], ["step"]), ["step"]))
register(
    "word_mass",
    f"""WITH w AS (SELECT lang, unnest(list_filter(regexp_split_to_array(text, '[^A-Za-z]+'), lambda x: x <> '')) AS w FROM documents)
 SELECT lang, round(sum(CASE WHEN w IN ('The', 'She', 'Die', 'Les', 'Let') THEN 1.0 ELSE 0 END) / count(*), 6) AS search_mass,
 round(sum(CASE WHEN w IN ({', '.join(repr(x) for x in L.SHORTCUT_WORDS)}, 'the') THEN 1.0 ELSE 0 END) / count(*), 6) AS shortcut_mass FROM w GROUP BY 1""",
)(
    lambda spark, sf: rounded(
        L.word_mass(
            V.table(spark, sf, "documents"), "text", ["lang"], ["The", "She", "Die", "Les", "Let"], [*L.SHORTCUT_WORDS, "the"]
        ),
        ["lang"],
    )
)
