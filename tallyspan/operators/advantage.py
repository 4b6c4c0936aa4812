"""Group-relative and token-level advantages.

Response-level estimators take one row per response (``uid``, ``score`` = sum of its token
rewards) and add ``adv``, which holds for every valid token of the response. Token-level
estimators take the long layout, one row per token.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.masked import masked, masked_average, whiten
from tallyspan.spread import affine_scan, attach, attach_table, durable, ranked, stored, top_k

EPS = 1e-6
ESTIMATORS: dict[str, Callable] = {}


def estimator(name: str):
    """Register an estimator; the names are the lookup keys of ``advantage(name, ...)``."""

    def add(fn):
        if name in ESTIMATORS and ESTIMATORS[name] is not fn:
            raise ValueError(f"estimator {name} is already registered")
        ESTIMATORS[name] = fn
        return fn

    return add


def advantage(name: str, df: DataFrame, **options) -> DataFrame:
    if name not in ESTIMATORS:
        raise ValueError(f"unknown estimator {name}; known: {', '.join(sorted(ESTIMATORS))}")
    return ESTIMATORS[name](df, **options)


def _floor(std_floor, size: Column) -> Column | None:
    if std_floor is None:
        return None
    text = str(std_floor).lower()
    if text == "auto":
        return F.lit(1.0) / F.sqrt(size)
    try:
        return F.lit(0.0 if text == "none" else float(text))
    except ValueError:
        return F.lit(0.0)


def _done(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def _with_group(df: DataFrame) -> DataFrame:
    s = F.col("score")
    return attach(df, ["uid"], __n=F.count(s), __mean=F.avg(s), __std=F.stddev_samp(s))


def _centre() -> Column:
    """Group mean, except that a group of one is compared with 0."""
    return F.when(F.col("__n") == 1, F.lit(0.0)).otherwise(F.col("__mean"))


@estimator("grpo")
def grpo(df: DataFrame, normalise: bool = True, std_floor=None, eps: float = EPS) -> DataFrame:
    """(score - mean) / (sample std + eps); a group of one gives score / (1 + eps)."""
    g = _with_group(df)
    diff = F.col("score") - _centre()
    std = F.col("__std")
    floor = _floor(std_floor, F.col("__n"))
    if floor is not None:
        std = F.greatest(std, floor)
    std = F.when(F.col("__n") == 1, F.lit(1.0)).otherwise(std)
    return _done(g.withColumn("adv", diff / (std + eps) if normalise else diff))


@estimator("grpo_vectorised")
def grpo_vectorised(df: DataFrame, normalise: bool = True, eps: float = EPS) -> DataFrame:
    """As ``grpo`` with std = sqrt(max(variance, eps))."""
    g = _with_group(df)
    diff = F.col("score") - _centre()
    std = F.when(F.col("__n") == 1, F.lit(1.0)).otherwise(
        F.sqrt(F.greatest(F.col("__std") * F.col("__std"), F.lit(eps)))
    )
    return _done(g.withColumn("adv", diff / (std + eps) if normalise else diff))


@estimator("grpo_passk")
def grpo_passk(df: DataFrame, normalise: bool = True, eps: float = EPS, singleton: str = "error") -> DataFrame:
    """Only the best response of a group gets an advantage: its lead over the second best.

    Ties go to the lowest sample id. A group of one is an error, or null with ``singleton="null"``.
    """
    two = top_k(df.select("uid", "sample_id", "score"), ["uid"], [F.desc("score"), F.asc("sample_id")], 2, "__rank")
    gaps = two.groupBy("uid").agg(
        F.max(F.when(F.col("__rank") == 1, F.col("sample_id"))).alias("__best"),
        (F.max("score") - F.min("score")).alias("__gap"),
    )
    sizes = df.groupBy("uid").agg(F.count("score").alias("__n"), F.stddev_samp("score").alias("__std"))
    joined = attach_table(df, ["uid"], sizes.join(gaps, "uid"), ["__n", "__std", "__best", "__gap"])
    lead = F.col("__gap") / (F.col("__std") + eps) if normalise else F.col("__gap")
    alone = F.lit(None).cast("double")
    if singleton == "error":
        alone = F.raise_error(F.concat(F.lit("pass@k needs two responses in group "), F.col("uid").cast("string"))).cast("double")
    adv = F.when(F.col("__n") < 2, alone).when(F.col("sample_id") == F.col("__best"), lead).otherwise(F.lit(0.0))
    return _done(joined.withColumn("adv", adv))


@estimator("reinforce_plus_plus_baseline")
def reinforce_baseline(df: DataFrame, batch: Sequence[str] = ("step",), weight: str = "n_valid") -> DataFrame:
    """score - group mean, whitened over the valid tokens of the batch (``weight`` tokens per response)."""
    d = durable(_with_group(df).withColumn("__d", F.col("score") - _centre()))
    w = F.col(weight)
    d = attach(d, list(batch), __w=F.sum(w), __wm=F.sum(F.col("__d") * w) / (F.sum(w) + 1e-8))
    off = F.col("__d") - F.col("__wm")
    d = attach(d, list(batch), __ss=F.sum(off * off * w))
    total = F.col("__w")
    var = F.when(total > 1, F.col("__ss") / (total + 1e-8) * total / (total - 1))
    adv = F.when(w > 0, off / F.sqrt(var + 1e-8)).otherwise(F.lit(0.0))
    return _done(d.withColumn("adv", adv))


@estimator("rloo")
def rloo(df: DataFrame) -> DataFrame:
    """Leave-one-out: (score - mean) * n / (n - 1); a group of one keeps its score."""
    n, s = F.col("__n"), F.col("score")
    adv = F.when(n == 1, s).otherwise((s - F.col("__mean")) * n / (n - 1))
    return _done(_with_group(df).withColumn("adv", adv))


@estimator("rloo_vectorised")
def rloo_vectorised(df: DataFrame) -> DataFrame:
    """As ``rloo`` but a group of one gives 0."""
    n, s = F.col("__n"), F.col("score")
    g = attach(df, ["uid"], __n=F.count(s), __sum=F.sum(s))
    adv = F.when(n > 1, (n * s - F.col("__sum")) / F.greatest(n - 1, F.lit(1))).otherwise(F.lit(0.0))
    return _done(g.withColumn("adv", adv))


@estimator("opo")
def opo(df: DataFrame, weight: str = "n_valid") -> DataFrame:
    """score minus the length-weighted group mean; a group of one keeps its score, one without any token has no value."""
    s, w = F.col("score"), F.col(weight)
    g = attach(df, ["uid"], __n=F.count(s), __base=F.try_divide(F.sum(s * w), F.sum(w)))
    adv = F.when(F.col("__n") == 1, s).otherwise(s - F.col("__base"))
    return _done(g.withColumn("adv", adv))


@estimator("gpg")
def gpg(df: DataFrame, f_norm: float = 1.0, batch: Sequence[str] = ("step",)) -> DataFrame:
    """alpha * (score - mean) / f_norm with alpha = batch size / number of non-zero scores."""
    g = attach(
        _with_group(df),
        list(batch),
        __alpha=F.count(F.lit(1)) / F.greatest(F.count(F.when(F.col("score") != 0, 1)), F.lit(1)),
    )
    return _done(g.withColumn("adv", F.col("__alpha") * (F.col("score") - _centre()) / f_norm))


def spread_to_tokens(tokens: DataFrame, responses: DataFrame) -> DataFrame:
    """Response advantages on tokens: ``adv * mask``."""
    return tokens.join(responses.select("sample_id", "adv"), "sample_id").withColumn("adv", F.col("adv") * F.col("mask"))


# ---- token-level estimators -------------------------------------------------------------


def returns_to_go(tokens: DataFrame, out: str = "ret", extra: dict | None = None) -> DataFrame:
    """Sum of the masked rewards from each token to the end of its response."""
    scans = {out: (F.lit(1.0), F.col("reward") * F.col("mask"), True), **(extra or {})}
    done = affine_scan(tokens, ["sample_id"], "pos", scans)
    return done.drop(*[n + "__x" for n in scans])


@estimator("remax")
def remax(tokens: DataFrame, baseline: str = "baseline") -> DataFrame:
    """Masked return to go minus the greedy response's reward."""
    return returns_to_go(tokens).withColumn("adv", F.col("ret") - F.col(baseline) * F.col("mask"))


@estimator("reinforce_plus_plus")
def reinforce_plus_plus(tokens: DataFrame, gamma: float = 1.0, batch: Sequence[str] = ("step",)) -> DataFrame:
    """Discounted return whose carry is dropped after a masked token, whitened over the batch."""
    r, m = F.col("reward"), F.col("mask")
    done = affine_scan(tokens, ["sample_id"], "pos", {"__z": (m * gamma, m * r, True)})
    done = durable(done.withColumn("ret", r + F.col("__z__x") * gamma).drop("__z", "__z__x"))
    done = whiten(done, list(batch), "ret", "mask", "adv")
    return done.withColumn("adv", F.col("adv") * m)


@estimator("gae")
def gae(tokens: DataFrame, gamma: float = 1.0, lam: float = 1.0, batch: Sequence[str] = ("step",)) -> DataFrame:
    """Generalised advantage that steps over masked tokens, which hold the carried value.

    ``ret`` = advantage + value before whitening; ``adv`` is whitened by the masked statistics.
    """
    m, v = F.col("mask"), F.col("value")
    # the advantage adds up reward + gamma * value of the next valid token - value
    scans = {
        "__v": (1 - m, m * v, True),
        "__adv": (m * (gamma * lam) + (1 - m), m * (F.col("reward") - v), True, (m * gamma, "__v")),
    }
    raw = affine_scan(tokens, ["sample_id"], "pos", scans).drop("__v", "__v__x")
    raw = durable(raw.withColumn("ret", F.col("__adv") + v))
    return _done(whiten(raw, list(batch), "__adv", "mask", "adv"))


def _longest_alone(lengths: DataFrame) -> DataFrame:
    """Per group: the one longest response and the second longest length, if the longest is unique."""
    two = top_k(lengths, ["uid"], [F.desc("n_valid"), F.asc("sample_id")], 2, "__rank")
    pair = two.groupBy("uid").agg(
        F.max(F.when(F.col("__rank") == 1, F.col("sample_id"))).alias("sample_id"),
        F.max("n_valid").alias("__longest"),
        F.min("n_valid").alias("__second"),
        F.count(F.lit(1)).alias("__k"),
    )
    return pair.filter((F.col("__k") == 2) & (F.col("__longest") > F.col("__second"))).select("sample_id", "__second")


def _energy(weight: str | None) -> Column:
    """Gradient energy of a token: 1 - 2 p + sum of squared probabilities, scaled by the squared weight."""
    w = 1 - 2 * F.exp("old_logp") + F.col("sum_pi2")
    return w * F.col(weight) * F.col(weight) if weight else w


@estimator("optimal_token_baseline")
def optimal_token_baseline(
    tokens: DataFrame, responses: DataFrame, weight: str | None = None, zero_tail: bool = False, eps: float = 1e-8
) -> DataFrame:
    """Return to go minus a baseline per group and position, weighted by accumulated energy.

    ``responses`` (``sample_id``, ``uid``) lists every response, with or without tokens.
    """
    m = F.col("mask")
    t = returns_to_go(tokens, extra={"__w": (F.lit(1.0), _energy(weight) * m, False)})
    groups = attach(responses.select("sample_id", "uid"), ["uid"], __n=F.count(F.lit(1)))
    t = durable(t.join(groups, "sample_id"))
    weighted = F.col("__w") * m
    t = attach(t, ["uid", "pos"], __base=F.sum(F.col("ret") * weighted) / (F.sum(weighted) + eps))
    base = F.when(F.col("__n") == 1, F.lit(0.0)).otherwise(F.col("__base"))
    if zero_tail:
        lengths = responses.select("sample_id", "uid").join(
            t.groupBy("sample_id").agg(F.sum("mask").alias("n_valid")), "sample_id", "left"
        ).fillna({"n_valid": 0})
        t = t.join(_longest_alone(lengths), "sample_id", "left")
        base = F.when(F.col("pos") > F.col("__second"), F.lit(0.0)).otherwise(base)
    return _done(t.withColumn("adv", (F.col("ret") - base) * m))


@estimator("optimal_token_baseline_multi_turn")
def optimal_token_baseline_multi_turn(
    tokens: DataFrame, uids: DataFrame, weight: str | None = None, zero_tail: bool = True, eps: float = 1e-8
) -> DataFrame:
    """As above on the index among valid tokens; responses without a valid token are left out."""
    m = F.col("mask")
    t = stored(returns_to_go(tokens, extra={"__w": (F.lit(1.0), _energy(weight) * m, False)}))
    valid = ranked(t.filter(m != 0), ["sample_id"], ["pos"], "__v")
    lengths = stored(t.filter(m != 0).groupBy("sample_id").agg(F.count(F.lit(1)).alias("__k")).join(uids.select("sample_id", "uid"), "sample_id"))
    lengths = lengths.groupBy("sample_id", "uid").agg(F.sum("__k").alias("n_valid"), F.count(F.lit(1)).alias("__times"))
    sizes = lengths.groupBy("uid").agg(F.count(F.lit(1)).alias("__n"))
    # what a response knows of its group meets its tokens with the response's group itself, in one join
    known = attach_table(lengths, ["uid"], sizes, ["__n"])
    if zero_tail:
        known = known.join(_longest_alone(lengths), "sample_id", "left")
    # a response that is listed more than once has its tokens as often
    known = known.withColumn("__times", F.explode(F.sequence(F.lit(1).cast("long"), "__times"))).drop("n_valid")
    valid = stored(valid.join(known, "sample_id"))
    valid = attach(valid, ["uid", "__v"], __base=F.sum(F.col("ret") * F.col("__w")) / (F.sum("__w") + eps))
    base = F.when(F.col("__n") == 1, F.lit(0.0)).otherwise(F.col("__base"))
    if zero_tail:
        base = F.when(F.col("__v") > F.col("__second"), F.lit(0.0)).otherwise(base)
    valid = _done(valid.withColumn("adv", F.col("ret") - base))
    rest = t.filter(m == 0).join(uids.select("sample_id", "uid"), "sample_id").withColumn("adv", F.lit(0.0))
    return valid.unionByName(_done(rest))


@estimator("teacher_guided")
def teacher_guided(
    tokens: DataFrame,
    normalise: bool = True,
    std_floor="none",
    clip: float | None = 5.0,
    safety_thresh: float = 0.1,
    safety_clip: float = 0.5,
    gae_value: str | None = None,
    gamma: float = 1.0,
    lam: float = 0.95,
    batch: Sequence[str] = ("step",),
    eps: float = EPS,
) -> DataFrame:
    """Token reward minus the mean token reward of the group.

    ``tokens`` carries ``uid`` and ``sd_mask`` (1 when the response belongs to the distillation
    set); tokens outside either mask get 0. ``std_floor`` "auto" is 1 / sqrt(responses with a
    valid token). Strongly negative advantages of tokens with a low reward are limited. When the
    batch mean reward is negative the threshold moves to the log-probability range.
    """
    eff = F.col("mask") * F.col("sd_mask")
    t = tokens.withColumn("__e", eff)
    r, e = F.col("reward"), F.col("__e")
    inside = masked(r, e)
    saved = t = durable(t)
    live = F.countDistinct(F.when(F.col("__e") > 0, F.col("sample_id")))
    t = attach(t, ["uid"], __mean=F.avg(inside), __std=F.stddev_pop(inside), __resp=live)
    source = r
    if gae_value is not None:
        scans = {
            "__v": (F.lit(0.0), F.col(gae_value), True),
            "__g": (e * (gamma * lam), e * (r - F.col(gae_value) * e), True, (e * e * gamma, "__v")),
        }
        t = affine_scan(t, ["sample_id"], "pos", scans)
        source = F.col("__g")
    adv = source - F.col("__mean")
    if normalise:
        if str(std_floor).lower() == "auto":
            floor = F.when(F.col("__resp") > 1, 1.0 / F.sqrt("__resp")).otherwise(F.lit(1.0))
        else:
            text = str(std_floor).lower()
            try:
                fixed = 0.0 if text == "none" else float(text)
            except ValueError:
                fixed = 0.0
            floor = F.lit(max(eps, fixed))
        adv = adv / F.greatest(F.col("__std"), floor)
    adv = F.when(e != 0, adv).otherwise(F.lit(0.0))
    if clip is not None:
        adv = F.greatest(F.least(adv, F.lit(clip)), F.lit(-clip))
    t = t.withColumn("adv", adv)
    if safety_thresh:
        t = attach(t, list(batch), of=saved, __level=F.avg(inside))
        limit = F.lit(float(safety_thresh))
        if safety_thresh > 0:
            limit = F.when(F.col("__level") < 0, F.lit(-10.0 * safety_thresh)).otherwise(limit)
        low = (e != 0) & (r < limit) & (F.col("adv") < 0)
        t = t.withColumn("adv", F.when(low, F.greatest(F.col("adv"), F.lit(-safety_clip))).otherwise(F.col("adv")))
    return _done(t)


SIGNALS = {
    "teacher_student_kl": lambda t, s, o: t - s,
    "teacher_prob": lambda t, s, o: F.exp(t),
    "policy_change": lambda t, s, o: s - o,
    "teacher_student_diff": lambda t, s, o: F.greatest(F.exp(t) - F.exp(s), F.lit(0.0)),
}


def future_kl_modulation(
    tokens: DataFrame, signal: str, adv: str = "adv", decay: float = 128.0, ratio: float = 0.5
) -> DataFrame:
    """Scale advantages by clip(exp(discounted sum of the signal from here on), 1 - ratio, 1 + ratio)."""
    if signal not in SIGNALS:
        raise ValueError(f"unknown signal {signal}")
    s = SIGNALS[signal](F.col("teacher_logp"), F.col("student_logp"), F.col("old_logp"))
    gamma = 2.0 ** (-1.0 / decay)
    done = affine_scan(tokens, ["sample_id"], "pos", {"future_kl": (F.lit(gamma), s * F.col("mask"), True)})
    weight = F.greatest(F.least(F.exp("future_kl"), F.lit(1.0 + ratio)), F.lit(1.0 - ratio))
    return done.drop("future_kl__x").withColumn("adv_mod", F.col(adv) * weight)


def hybrid_sentence_token(
    tokens: DataFrame,
    responses: DataFrame,
    alpha: float = 0.5,
    normalise_delta: bool = False,
    std_floor="none",
    batch: Sequence[str] = ("step",),
) -> DataFrame:
    """alpha * sentence advantage + (1 - alpha) * deviation of the token probability from its response mean.

    ``responses`` lists ``sample_id, uid`` and the batch columns; ``tokens`` has ``teacher_logp``.
    """
    m, lp = F.col("mask"), F.col("teacher_logp")
    per = tokens.groupBy("sample_id").agg(
        F.sum("mask").alias("n_valid"),
        F.avg(masked(lp, m)).alias("__lp"),
        F.avg(masked(F.exp(lp), m)).alias("__p"),
    )
    sent = responses.join(per, "sample_id", "left").withColumn("score", F.coalesce(F.exp("__lp"), F.lit(0.0)))
    sent = grpo(sent.withColumnRenamed("__p", "mean_p"))
    t = tokens.join(sent.select("sample_id", "mean_p", *batch, F.col("adv").alias("sent_adv")), "sample_id")
    t = t.withColumn("delta", F.when(m != 0, F.exp(lp) - F.col("mean_p")).otherwise(F.lit(0.0)))
    if normalise_delta:
        n = responses.groupBy(*batch).agg(F.count(F.lit(1)).alias("__n"))
        text = str(std_floor).lower()
        t = durable(t)
        t = attach(
            t, list(batch), __k=F.sum("mask"), __dm=F.avg(masked(F.col("delta"), m)), __ds=F.stddev_pop(masked(F.col("delta"), m))
        )
        t = attach_table(t, list(batch), n, ["__n"])
        if text == "auto":
            floor = 1.0 / F.sqrt("__n")
        else:
            floor = F.lit(1e-6 if text == "none" else max(1e-6, float(text)))
        scaled = (F.col("delta") - F.col("__dm")) / F.greatest(F.col("__ds"), floor) * m
        t = t.withColumn("delta", F.when(F.col("__k") > 1, scaled).otherwise(F.col("delta")))
    return _done(t.withColumn("adv", (F.col("sent_adv") * alpha + F.col("delta") * (1 - alpha)) * m))


def kl_penalised_reward(tokens: DataFrame, kl: Column, beta: float, batch: Sequence[str] = ("step",)) -> DataFrame:
    """``reward_kl`` = reward - beta * kl * mask and ``batch_kl``, the mean over responses of their mean kl."""
    t = tokens.withColumn("__kl", kl * F.col("mask"))
    per = t.groupBy(*batch, "sample_id").agg(masked_average(F.col("__kl"), F.col("mask")).alias("__mk"))
    level = per.groupBy(*batch).agg(F.avg("__mk").alias("batch_kl"))
    t = attach_table(t, list(batch), level, ["batch_kl"])
    return _done(t.withColumn("reward_kl", F.col("reward") - F.col("__kl") * beta))


def place_on_last_valid(tokens: DataFrame, scores: DataFrame, score: str = "score", out: str = "token_score") -> DataFrame:
    """The response score on its last valid token (position = mask sum), 0 elsewhere."""
    n = tokens.groupBy("sample_id").agg(F.sum("mask").alias("__n"))
    ends = n.join(scores.select("sample_id", F.col(score).alias("__s")), "sample_id")
    t = attach_table(tokens, ["sample_id"], ends, ["__n", "__s"])
    return _done(t.withColumn(out, F.when(F.col("pos") == F.col("__n"), F.col("__s")).otherwise(F.lit(0.0))))


def sequence_log_prob(tokens: DataFrame, logp: str) -> DataFrame:
    """Mean log-probability and geometric mean probability of the valid tokens of each response."""
    m = F.col("mask")
    mean = F.coalesce(F.sum(masked(F.col(logp), m)), F.lit(0.0)) / F.greatest(F.sum(m), F.lit(1))
    return tokens.groupBy("sample_id").agg(mean.alias("seq_logp"), F.exp(mean).alias("sentence_prob"))


def eos_mask(tokens: DataFrame, end_tags: Sequence[int], tag: str = "tag") -> DataFrame:
    """``resp_mask`` = 1 up to and including the first end token."""
    t = attach(tokens, ["sample_id"], __end=F.min(F.when(F.col(tag).isin(*end_tags), F.col("pos"))))
    return _done(t.withColumn("resp_mask", F.when(F.col("pos") > F.col("__end"), 0).otherwise(1)))


def position_ids(tokens: DataFrame, mask: str = "mask") -> DataFrame:
    """Number of unmasked tokens before this one, never below 0."""
    t = affine_scan(tokens, ["sample_id"], "pos", {"__c": (F.lit(1.0), F.col(mask), False)})
    return _done(t.withColumn("position_id", F.greatest(F.col("__c") - 1, F.lit(0.0)).cast("long")).drop("__c__x"))


def span_mask(spans: Column) -> Column:
    """Array of struct(n, generated) -> token mask: 1 for generated tokens, 0 for tool or padding tokens."""
    return F.flatten(F.transform(spans, lambda s: F.array_repeat(s["generated"].cast("int"), s["n"].cast("int"))))
