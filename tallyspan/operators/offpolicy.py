"""Off-policy correction of logged rollouts: importance weights, rejection masks, drift metrics.

Input is the long layout: one row per token with ``old_logp`` (training policy), ``rollout_logp``
and ``mask``, plus the batch columns. Metrics come out as one row per batch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.masked import TINY, masked, masked_average
from tallyspan.spread import attach, attach_table

BOUND = 20.0

# fixed values: the rejection options
REJECTION_OPTIONS = [
    "token_k1", "token_k2", "token_k3",
    "seq_sum_k1", "seq_sum_k2", "seq_sum_k3",
    "seq_mean_k1", "seq_mean_k2", "seq_mean_k3",
    "seq_max_k2", "seq_max_k3",
]


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def log_ratio() -> Column:
    return F.col("old_logp") - F.col("rollout_logp")


KL_FORMS = {
    "k1": lambda p, q: p - q,
    "abs": lambda p, q: F.abs(p - q),
    "k2": lambda p, q: (p - q) * (p - q) * 0.5,
    "k3": lambda p, q: clamp(F.exp(clamp(q - p, -20, 20)) - clamp(q - p, -20, 20) - 1, -10, 10),
}
KL_NAMES = {"kl": "k1", "mse": "k2", "low_var_kl": "k3"}


def kl_estimate(logp: Column, ref_logp: Column, kind: str) -> Column:
    """Per-token KL estimate. A trailing ``+`` only changes gradients, so the value is the plain one."""
    kind = kind.rstrip("+")
    kind = KL_NAMES.get(kind, kind)
    if kind not in KL_FORMS:
        raise ValueError(f"unknown KL estimate {kind}")
    return KL_FORMS[kind](logp, ref_logp)


def importance_weights(
    tokens: DataFrame,
    level: str = "token",
    threshold: float = 2.0,
    normalise: bool = False,
    batch: Sequence[str] = ("step",),
    out: str = "weight",
) -> DataFrame:
    """``<out>`` truncated at ``threshold`` and ``raw_<out>`` before truncation, both 0 outside the mask.

    ``level`` "sequence" gives all tokens of a response the ratio of the whole response.
    ``normalise`` divides by the batch mean (over tokens, or over responses with a valid token).
    """
    m, batch = F.col("mask"), list(batch)
    raw = "raw_" + out
    if level == "token":
        t = tokens.withColumn(raw, F.exp(clamp(log_ratio(), -BOUND, BOUND)) * m)
        t = t.withColumn(out, F.least(F.col(raw), F.lit(float(threshold))))
        if normalise:
            t = attach(t, batch, __wm=masked_average(F.col(out), m))
            t = t.withColumn(out, F.when(F.col("__wm") > 1e-8, F.col(out) / F.col("__wm")).otherwise(F.col(out)))
        return t.drop("__wm")
    if level != "sequence":
        raise ValueError(f"unknown level {level}")
    keys = [*batch, "sample_id"] if normalise else ["sample_id"]
    per = tokens.groupBy(*keys).agg(
        F.coalesce(F.sum(masked(log_ratio(), m)), F.lit(0.0)).alias("__lr"), F.sum(m).alias("__n")
    )
    per = per.withColumn("__raw", F.exp(clamp(F.col("__lr"), -BOUND, BOUND)))
    per = per.withColumn("__w", F.least(F.col("__raw"), F.lit(float(threshold))))
    if normalise:
        # one value per response with a valid token
        share = F.when(F.col("__n") > 0, F.col("__w") * F.col("__n") / (F.col("__n") + TINY))
        per = attach(per, batch, __wm=F.avg(share))
        per = per.withColumn("__w", F.when(F.col("__wm") > 1e-8, F.col("__w") / F.col("__wm")).otherwise(F.col("__w")))
    t = attach_table(tokens, keys, per, ["__raw", "__w"])
    return t.withColumn(raw, F.col("__raw") * m).withColumn(out, F.col("__w") * m).drop("__raw", "__w")


def weight_metrics(
    tokens: DataFrame, level: str = "token", threshold: float = 2.0, batch: Sequence[str] = ("step",)
) -> DataFrame:
    """Statistics of the weights before truncation, per batch."""
    batch, m = list(batch), F.col("mask")
    low = 1.0 / threshold
    t = importance_weights(tokens, level, threshold, batch=batch)
    w = F.col("raw_weight")
    c = clamp(w, low, threshold)
    per = t.groupBy(*batch, "sample_id").agg(
        F.sum(m).alias("n"),
        F.sum(w * m).alias("w"),
        F.sum(c * m).alias("c"),
        F.sum(c * c * m).alias("cc"),
        F.max(masked(w, m)).alias("hi"),
        F.min(masked(w, m)).alias("lo"),
        F.sum((w > threshold).cast("int") * m).alias("above"),
        F.sum((w < low).cast("int") * m).alias("below"),
        F.coalesce(F.sum(masked(log_ratio(), m)), F.lit(0.0)).alias("lr"),
    )
    per = per.withColumn("sw", F.col("w") / (F.col("n") + TINY))
    n = F.sum("n") + TINY
    mean_c, lr, sw = F.sum("c") / n, F.col("lr"), F.col("sw")
    if level == "sequence":
        top, bottom = F.exp(F.least(F.max(lr), F.lit(BOUND))), F.exp(F.min(lr))
        high = F.avg((lr > math.log(threshold)).cast("double"))
        under = F.avg((lr < math.log(low)).cast("double"))
    else:
        top, bottom, high, under = F.max("hi"), F.min("lo"), F.sum("above") / n, F.sum("below") / n
    spread = F.sqrt(F.greatest(F.sum("cc") / n - mean_c * mean_c, F.lit(0.0)))
    return per.groupBy(*batch).agg(
        (F.sum("w") / n).alias("is_mean"),
        top.alias("is_max"),
        bottom.alias("is_min"),
        F.when(F.sum("n") > 1, spread).otherwise(F.lit(0.0)).alias("is_std"),
        high.alias("is_fraction_high"),
        under.alias("is_fraction_low"),
        ((mean_c + TINY) * (mean_c + TINY) / (F.sum("cc") / n)).alias("is_eff_sample_size"),
        F.avg(sw).alias("is_seq_mean"),
        F.coalesce(F.stddev_samp(sw), F.lit(0.0)).alias("is_seq_std"),
        F.max(sw).alias("is_seq_max"),
        F.min(sw).alias("is_seq_min"),
        F.max(F.abs(sw - 1.0)).alias("is_seq_max_deviation"),
        F.avg((sw > threshold).cast("double")).alias("is_seq_fraction_high"),
        F.avg((sw < low).cast("double")).alias("is_seq_fraction_low"),
    )


def parse_thresholds(options: Sequence[str], spec: str | float) -> dict[str, tuple[float | None, float]]:
    """One threshold for all options or one per option. ``low_high`` is allowed for k1 only; a
    single k1 value means a reciprocal lower bound."""
    parts = [str(spec)] if isinstance(spec, int | float) else [p.strip() for p in spec.split(",") if p.strip()]
    if len(parts) not in (1, len(options)):
        raise ValueError(f"expected 1 or {len(options)} thresholds, got {len(parts)}")
    if len(parts) == 1:
        parts = parts * len(options)
    bounds: dict[str, tuple[float | None, float]] = {}
    for option, part in zip(options, parts, strict=True):
        if option not in REJECTION_OPTIONS:
            raise ValueError(f"unknown rejection option {option}")
        k1 = option.endswith("k1")
        if "_" in part and not k1:
            raise ValueError(f"{option} takes a single upper bound, got {part}")
        low_text, _, high_text = part.rpartition("_")
        high = float(high_text)
        low = (float(low_text) if low_text else 1.0 / high) if k1 else None
        if high <= 0 or (low is not None and low <= 0):
            raise ValueError(f"thresholds of {option} must be positive, got {part}")
        bounds[option] = (low, high)
    return bounds


def _token_stats() -> dict[str, Column]:
    r = clamp(log_ratio(), -BOUND, BOUND)
    return {"k1": -r, "k2": r * r * 0.5, "k3": F.exp(r) - 1.0 - r}


def rejection_mask(
    tokens: DataFrame, options: Sequence[str], spec: str | float, out: str = "kept_mask"
) -> DataFrame:
    """``out`` = mask and every option's keep rule; ``keep_<option>`` per option, ``stat_<option>`` its statistic."""
    options = list(dict.fromkeys(options))
    bounds = parse_thresholds(options, spec)
    m, stats = F.col("mask"), _token_stats()
    aggs = {}
    for option in options:
        level, _, k = option.rpartition("_")
        v = stats[k]
        if level == "seq_sum":
            aggs["stat_" + option] = F.coalesce(F.sum(masked(v, m)), F.lit(0.0))
        elif level == "seq_mean":
            aggs["stat_" + option] = masked_average(v, m)
        elif level == "seq_max":
            aggs["stat_" + option] = F.coalesce(F.max(masked(v, m)), F.lit(0.0))
    t = attach(tokens, ["sample_id"], **aggs) if aggs else tokens
    keep = F.lit(True)
    for option in options:
        level, _, k = option.rpartition("_")
        if level == "token":
            t = t.withColumn("stat_" + option, stats[k])
        low, high = bounds[option]
        s = F.col("stat_" + option)
        ok = (s >= math.log(low)) & (s <= math.log(high)) if low is not None else s <= high
        t = t.withColumn("keep_" + option, ok.cast("int"))
        keep = keep & ok
    return t.withColumn(out, m * keep.cast("int"))


def rejection_metrics(
    tokens: DataFrame, options: Sequence[str], spec: str | float, batch: Sequence[str] = ("step",)
) -> DataFrame:
    """Per batch and option, on the mask before rejection: ``option, mean, max, min, std, ...``
    in long form (``option, metric, value``); option ``all`` holds the combined masked shares."""
    batch, m = list(batch), F.col("mask")
    options = list(dict.fromkeys(options))
    bounds = parse_thresholds(options, spec)
    k = _token_stats()
    limits = {o: (math.log(high), math.log(low)) if low is not None else (high, 0.0) for o, (low, high) in bounds.items()}

    def holds(o: str, stat: Column) -> Column:
        hi, lo = limits[o]
        return (stat >= lo) & (stat <= hi) if bounds[o][0] is not None else stat <= hi

    # everything comes from one aggregation per response: token options need sums over the tokens,
    # sequence options only the totals and maxima of the three statistics
    by_token = [o for o in options if o.startswith("token")]
    fine = F.lit(True)
    for o in by_token:
        fine = fine & holds(o, k[o[-2:]])
    sums = [F.sum(m).alias("n"), F.sum(m * fine.cast("int")).alias("fine")]
    for name, stat in k.items():
        sums += [F.coalesce(F.sum(masked(stat, m)), F.lit(0.0)).alias("t_" + name), F.coalesce(F.max(masked(stat, m)), F.lit(0.0)).alias("x_" + name)]
    for o in by_token:
        (hi, lo), v = limits[o], k[o[-2:]]
        c = clamp(v, lo, hi)
        sums += [
            F.sum(v * m).alias("s_" + o),
            F.max(masked(v, m)).alias("hi_" + o),
            F.min(masked(v, m)).alias("lo_" + o),
            F.sum((v > hi).cast("int") * m).alias("above_" + o),
            F.sum((v < lo).cast("int") * m).alias("below_" + o),
            F.sum(c * m).alias("c_" + o),
            F.sum(c * c * m).alias("cc_" + o),
            F.sum(m * (~holds(o, v)).cast("int")).alias("lost_" + o),
        ]
    per = tokens.groupBy(*batch, "sample_id").agg(*sums)
    count, whole = F.col("n"), F.lit(True)
    more = []
    for o in options:
        if o in by_token:
            continue
        hi, lo = limits[o]
        level, _, name = o.rpartition("_")
        stat = {"seq_sum": F.col("t_" + name), "seq_mean": F.col("t_" + name) / (count + TINY), "seq_max": F.col("x_" + name)}[level]
        whole = whole & holds(o, stat)
        c = clamp(stat, lo, hi)
        more += [
            (stat * count).alias("s_" + o),
            F.when(count > 0, stat).alias("hi_" + o),
            (c * count).alias("c_" + o),
            (c * c * count).alias("cc_" + o),
            (count * (~holds(o, stat)).cast("int")).alias("lost_" + o),
        ]
    per = per.select("*", *more, (count - F.col("fine") * whole.cast("int")).alias("lost"))
    n, valid = F.sum("n") + TINY, F.col("n") > 0
    found: list[Column] = []
    names: list[tuple[str, str]] = []

    def add(option: str, metric: str, value: Column) -> None:
        names.append((option, metric))
        found.append(value.cast("double").alias(f"v{len(names) - 1}"))

    share = lambda c: F.avg(F.when(valid, c.cast("double")))
    for o in options:
        low, high = bounds[o]
        two_sided = low is not None
        hi, lo = (math.log(high), math.log(low)) if two_sided else (high, 0.0)
        seq = F.when(valid, F.col("hi_" + o) if o.startswith("seq") else F.col("s_" + o) / (F.col("n") + TINY))
        mean_c = F.sum("c_" + o) / n
        add(o, "mean", F.sum("s_" + o) / n)
        add(o, "max", F.max(seq) if o.startswith("seq") else F.max("hi_" + o))
        add(o, "min", F.min(seq) if o.startswith("seq") else F.min("lo_" + o))
        add(o, "std", F.when(F.sum("n") > 1, F.sqrt(F.greatest(F.sum("cc_" + o) / n - mean_c * mean_c, F.lit(0.0)))).otherwise(0.0))
        if o.startswith("seq"):
            above, below = share(seq > hi), share(seq < lo)
        else:
            above, below = F.sum("above_" + o) / n, F.sum("below_" + o) / n
        add(o, "fraction_high", above)
        add(o, "fraction_low", below if two_sided else F.lit(0.0))
        add(o, "seq_mean", F.avg(seq))
        add(o, "seq_std", F.coalesce(F.stddev_samp(seq), F.lit(0.0)))
        add(o, "seq_max", F.max(seq))
        add(o, "seq_min", F.min(seq))
        add(o, "seq_max_deviation", F.max(F.abs(seq)))
        add(o, "seq_fraction_high", share(seq > hi))
        if two_sided:
            add(o, "seq_fraction_low", share(seq < lo))
        add(o, "masked_fraction", F.sum("lost_" + o) / n)
        add(o, "seq_masked_fraction", share(F.col("lost_" + o) > 0))
    add("all", "masked_fraction", F.sum("lost") / n)
    add("all", "seq_masked_fraction", F.avg((F.col("lost") > 0).cast("double")))
    wide = per.groupBy(*batch).agg(*found)
    entry = [
        F.struct(F.lit(o).alias("option"), F.lit(k).alias("metric"), F.col(f"v{i}").alias("value"))
        for i, (o, k) in enumerate(names)
    ]
    return wide.select(*batch, F.inline(F.array(*entry)))


def drift_metrics(tokens: DataFrame, batch: Sequence[str] = ("step",)) -> DataFrame:
    """Perplexities of both policies, KL estimates, log-perplexity gaps and chi-square terms per batch."""
    batch, m = list(batch), F.col("mask")
    r = log_ratio()
    rho = F.exp(clamp(r, -BOUND, BOUND))
    per = tokens.groupBy(*batch, "sample_id").agg(
        F.sum(m).alias("n"),
        F.coalesce(F.sum(masked(F.col("old_logp"), m)), F.lit(0.0)).alias("a"),
        F.coalesce(F.sum(masked(F.col("rollout_logp"), m)), F.lit(0.0)).alias("b"),
        F.coalesce(F.sum(masked(r, m)), F.lit(0.0)).alias("r"),
        F.coalesce(F.sum(masked(F.exp(r) - r - 1, m)), F.lit(0.0)).alias("k3"),
        F.coalesce(F.sum(masked(rho * rho, m)), F.lit(0.0)).alias("rr"),
    )
    per = per.withColumn("old", F.col("a") / (F.col("n") + TINY)).withColumn("new", F.col("b") / (F.col("n") + TINY))
    gap, n = F.col("new") - F.col("old"), F.sum("n") + TINY
    return per.groupBy(*batch).agg(
        F.avg(F.exp(-F.col("old"))).alias("training_ppl"),
        F.avg(-F.col("old")).alias("training_log_ppl"),
        F.avg(F.exp(-F.col("new"))).alias("rollout_ppl"),
        F.avg(-F.col("new")).alias("rollout_log_ppl"),
        (F.sum(-F.col("r")) / n).alias("kl"),
        (F.sum("k3") / n).alias("k3_kl"),
        F.avg(gap).alias("log_ppl_diff"),
        F.avg(F.abs(gap)).alias("log_ppl_abs_diff"),
        F.max(gap).alias("log_ppl_diff_max"),
        F.min(gap).alias("log_ppl_diff_min"),
        F.avg(F.exp(gap)).alias("ppl_ratio"),
        (F.sum("rr") / n - 1.0).alias("chi2_token"),
        (F.avg(F.exp(clamp(F.col("r"), -BOUND, BOUND) * 2.0)) - 1.0).alias("chi2_seq"),
    )


def correct(
    tokens: DataFrame,
    level: str | None = "token",
    threshold: float = 2.0,
    options: Sequence[str] = (),
    spec: str | float | None = None,
    batch: Sequence[str] = ("step",),
    normalise: bool = False,
    bypass: bool = False,
) -> DataFrame:
    """Weights and rejection mask together. ``bypass`` uses the rollout log-probs as the old ones."""
    t = tokens.withColumn("old_logp", F.col("rollout_logp")) if bypass else tokens
    if level is not None:
        t = importance_weights(t, level, threshold, normalise, batch)
    if options:
        if spec is None:
            raise ValueError("rejection needs thresholds")
        t = rejection_mask(t, options, spec)
    else:
        t = t.withColumn("kept_mask", F.col("mask"))
    return t


def correction_metrics(
    tokens: DataFrame,
    level: str | None = "token",
    threshold: float = 2.0,
    options: Sequence[str] = (),
    spec: str | float | None = None,
    batch: Sequence[str] = ("step",),
    prefix: str = "rollout_corr/",
) -> DataFrame:
    """All correction metrics as ``batch..., metric, value`` rows with prefixed names."""
    batch = list(batch)

    def long(df: DataFrame, names: Sequence[str], rename=lambda c: c) -> DataFrame:
        cells = [F.struct(F.lit(prefix + rename(c)).alias("metric"), F.col(c).cast("double").alias("value")) for c in names]
        return df.select(*batch, F.inline(F.array(*cells)))

    drift = drift_metrics(tokens, batch)
    parts = [long(drift, [c for c in drift.columns if c not in batch])]
    if level is not None:
        w = weight_metrics(tokens, level, threshold, batch)
        parts.append(long(w, [c for c in w.columns if c not in batch], lambda c: "rollout_" + c))
    if options:
        r = rejection_metrics(tokens, options, spec, batch)
        name = F.when(F.col("option") == "all", F.concat(F.lit(prefix + "rollout_rs_"), "metric")).otherwise(
            F.concat(F.lit(prefix + "rollout_rs_"), F.col("option"), F.lit("_"), F.col("metric"))
        )
        parts.append(r.select(*batch, name.alias("metric"), "value"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def prob_drift(tokens: DataFrame, batch: Sequence[str] = ("step",)) -> DataFrame:
    """Difference of token probabilities between the two policies and their correlation."""
    t = tokens.filter(F.col("mask") != 0).select(
        *batch, F.exp("old_logp").alias("p"), F.exp("rollout_logp").alias("q")
    )
    d = F.abs(F.col("p") - F.col("q"))
    return t.groupBy(*batch).agg(
        F.max(d).alias("probs_diff_max"),
        F.avg(d).alias("probs_diff_mean"),
        F.stddev_samp(d).alias("probs_diff_std"),
        F.corr("p", "q").alias("probs_corr"),
    )


def variance_proxies(
    tokens: DataFrame, batch: Sequence[str] = ("step",), weight: str | None = None, grad_norm: Column | None = None
) -> DataFrame:
    """Gradient variance proxies from token probabilities, their squared sums and the advantages.

    ``grad_norm`` is an expression over the batch columns; proxy 3 needs two responses.
    """
    batch, m = list(batch), F.col("mask")
    w = 1 - 2 * F.exp("old_logp") + F.col("sum_pi2")
    rho = F.col(weight) if weight else F.lit(1.0)
    scaled = w * rho * rho
    per = tokens.groupBy(*batch, "sample_id").agg(
        masked_average(F.col("adv"), m).alias("a"),
        F.coalesce(F.sum(masked(scaled, m)), F.lit(0.0)).alias("w"),
        masked_average(rho, m).alias("rho"),
        F.coalesce(F.sum(masked(scaled / F.greatest(rho * rho, F.lit(1e-10)), m)), F.lit(0.0)).alias("w0"),
    )
    a2, base = F.col("a") * F.col("a"), F.greatest(F.col("w0"), F.lit(0.0))
    power = F.col("rho") * F.col("rho") * a2 * base if weight else a2 * F.greatest(F.col("w"), F.lit(0.0))
    done = per.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("__n"),
        F.avg(power).alias("total_power"),
        F.avg(a2).alias("expected_a_squared"),
        F.avg("w").alias("expected_w"),
    )
    signal = grad_norm * grad_norm if grad_norm is not None else F.lit(0.0)
    noise = F.lit(0.0)
    if grad_norm is not None:
        noise = F.when(
            F.col("__n") > 1, F.greatest((F.col("total_power") - signal) / (F.col("__n") - 1), F.lit(0.0))
        ).otherwise(0.0)
    return done.select(
        *batch, signal.alias("signal_strength"), "total_power", noise.alias("pure_noise"), "expected_a_squared", "expected_w"
    )


def clip_audit(
    tokens: DataFrame, low: float = 0.2, high: float = 0.2, dual: float = 3.0, batch: Sequence[str] = ("step",)
) -> DataFrame:
    """Mean KL and the shares of tokens that a clipped policy ratio would touch."""
    if dual <= 1.0:
        raise ValueError("the dual clip bound must be above 1")
    m, a = F.col("mask"), F.col("adv")
    d = clamp(log_ratio(), -BOUND, BOUND)
    ratio = F.exp(d)
    plain, cut = -a * ratio, -a * clamp(ratio, 1 - low, 1 + high)
    worst = F.greatest(plain, cut)
    return tokens.groupBy(*batch).agg(
        masked_average(-d, m).alias("mean_kl"),
        masked_average((cut > plain).cast("double"), m).alias("clip_fraction"),
        masked_average(((worst > -a * dual) & (a < 0)).cast("double"), m).alias("clip_fraction_lower"),
    )
