"""Token rewards from logged teacher and student log-probs, confidence weights and leakage-cleaned targets.

``teacher_topk`` / ``student_topk`` are arrays of log-probs on the student's top-k positions,
position 1 being the student's first choice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.operators.masked import masked
from tallyspan.operators.offpolicy import clamp
from tallyspan.spread import attach


def total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def mean(arr: Column) -> Column:
    return total(arr) / F.size(arr)


def exp_all(arr: Column) -> Column:
    return F.transform(arr, lambda x: F.exp(x))


def logsumexp(arr: Column) -> Column:
    top = F.array_max(arr)
    return top + F.log(total(F.transform(arr, lambda x: F.exp(x - top))))


def renormalise(arr: Column) -> Column:
    """Log-probs conditional on the top k."""
    z = logsumexp(arr)
    return F.transform(arr, lambda x: x - z)


def with_tail(arr: Column) -> Column:
    """Append the log-prob of everything outside the top k."""
    s = F.least(logsumexp(arr), F.lit(-1e-7))
    return F.concat(arr, F.array(F.log(-F.expm1(s))))


def entropy(arr: Column) -> Column:
    """Entropy of a log-prob array of any length; a log-prob below -100 counts as that."""
    return -total(F.transform(arr, lambda x: F.exp(x) * F.greatest(x, F.lit(-100.0))))


def kl(p: Column, q: Column) -> Column:
    """Sum of exp(p) * (p - q) over two log-prob arrays."""
    return total(F.zip_with(p, q, lambda a, b: F.exp(a) * (a - b)))


def _mixture(a: Column, b: Column, alpha: float) -> Column:
    """log((1 - alpha) exp(a) + alpha exp(b)) element-wise."""
    return F.zip_with(a, b, lambda x, y: F.log(F.exp(x) * (1 - alpha) + F.exp(y) * alpha))


def divergence(teacher: Column, student: Column, alpha: float) -> Column:
    """KL(student || teacher) for alpha 0, KL(teacher || student) for alpha 1, generalised
    Jensen-Shannon in between with weights 1 - alpha (student) and alpha (teacher)."""
    if alpha == 0.0:
        return kl(student, teacher)
    if alpha == 1.0:
        return kl(teacher, student)
    mix = _mixture(student, teacher, alpha)
    return kl(student, mix) * (1 - alpha) + kl(teacher, mix) * alpha


def _best(arr: Column) -> Column:
    """0-based index of the largest entry, first on ties."""
    return F.array_position(arr, F.array_max(arr)) - 1


def _tail(arr: Column) -> Column:
    p = clamp(1.0 - total(exp_all(arr)), 1e-9, 1.0)
    return F.array(F.log(p))


def _jsd(t: Column, s: Column) -> Column:
    mix = F.zip_with(t, s, lambda x, y: F.log(F.greatest((F.exp(x) + F.exp(y)) * 0.5, F.lit(1e-10))))
    return F.greatest(kl(t, mix) * 0.5 + kl(s, mix) * 0.5, F.lit(0.0))


POINTWISE = {
    "log_ratio": lambda t, s, T, S: t - s,
    "prob_diff": lambda t, s, T, S: F.exp(t) - F.exp(s),
    "vocab_log_ratio": lambda t, s, T, S: mean(F.zip_with(T, S, lambda x, y: F.greatest(x, F.lit(-20.0)) - y)),
    "teacher_prob": lambda t, s, T, S: F.exp(F.greatest(t, F.lit(-20.0))),
    "teacher_log_prob": lambda t, s, T, S: clamp(t, -20.0, 0.0),
    "teacher_logit": lambda t, s, T, S: F.log(clamp(F.exp(t), 1e-6, 1 - 1e-6) / (1 - clamp(F.exp(t), 1e-6, 1 - 1e-6))),
    # the sequence forms start from the token log-prob; see sequence_reward
    "teacher_seq_log_prob": lambda t, s, T, S: t,
    "teacher_sentence_prob": lambda t, s, T, S: t,
    "teacher_prob_plus_sentence": lambda t, s, T, S: F.exp(t),
    "teacher_prob_relative": lambda t, s, T, S: t - F.log(mean(exp_all(T)) + 1e-9),
    "teacher_prob_certainty": lambda t, s, T, S: F.exp(t)
    * clamp(1.0 + total(F.transform(T, lambda x: F.exp(x) * x)) / F.log(F.size(T)), 0.0, 1.0),
    "top1_match": lambda t, s, T, S: (_best(T) == 0).cast("double"),
    "topk_match": lambda t, s, T, S: F.greatest(1.0 - _best(T) / F.size(T), F.lit(0.0)),
    "student_topk_teacher_prob": lambda t, s, T, S: mean(exp_all(T)),
    "student_topk_teacher_prob_weighted": lambda t, s, T, S: total(F.zip_with(T, S, lambda x, y: F.exp(x + y))),
    "teacher_prob_kl_weighted": lambda t, s, T, S: F.exp(t) * F.greatest(kl(T, S), F.lit(0.0)),
    "teacher_prob_jsd_weighted": lambda t, s, T, S: F.exp(t) * _jsd(T, S),
    "teacher_prob_diff_weighted": lambda t, s, T, S: F.exp(t) * F.greatest(F.exp(t) - F.exp(s), F.lit(0.0)),
}
WHOLE_RESPONSE = ("teacher_prob_plus_verified", "teacher_prob_binary")
TRANSFORMS = {
    "tanh": lambda x, c: F.tanh(x / c),
    "tanh01": lambda x, c: (F.tanh(x / c) + 1.0) / 2.0,
    "sigmoid": lambda x, c: 1.0 / (1.0 + F.exp(-x / c)),
    "clip": lambda x, c: clamp(x, -c, c),
    "none": lambda x, c: x,
}


def label_token_reward(
    tokens: DataFrame,
    kind: str,
    transform: str = "none",
    scale: float = 1.0,
    alpha: float = 0.5,
    tail: bool = False,
    verified: str = "reward",
    width: int | None = None,
    out: str = "token_reward",
) -> DataFrame:
    """Add the token reward of type ``kind``, transformed, times the mask.

    ``kind`` "divergence" is the negative generalised divergence over the top k, with ``tail`` the
    mass outside it included. "teacher_prob_binary" compares with the mean over a row padded to
    ``width`` tokens, where padding counts as probability 1.
    """
    t, s, m = F.col("teacher_logp"), F.col("student_logp"), F.col("mask")
    top_t, top_s = F.col("teacher_topk"), F.col("student_topk")
    df = tokens
    if kind == "teacher_prob_plus_verified":
        df = attach(df, ["sample_id"], __sum=F.sum(verified))
        reward = F.exp(t) + F.col("__sum")
    elif kind == "teacher_prob_binary":
        if width is None:
            raise ValueError("teacher_prob_binary needs the padded row width")
        df = attach(df, ["sample_id"], __n=F.sum(m), __p=F.sum(masked(F.exp(t), m)))
        p = F.when(m != 0, F.exp(t)).otherwise(F.lit(1.0))
        padded = F.greatest(F.lit(width), F.col("__n"))
        row_mean = (F.coalesce(F.col("__p"), F.lit(0.0)) + padded - F.col("__n")) / padded
        reward = (p > row_mean).cast("double")
    elif kind == "divergence":
        reward = -divergence(top_t, top_s, alpha)
        if tail:
            reward = reward - divergence(_tail(top_t), _tail(top_s), alpha)
    elif kind in POINTWISE:
        reward = POINTWISE[kind](t, s, top_t, top_s)
    else:
        raise ValueError(f"unknown token reward {kind}")
    if transform not in TRANSFORMS:
        raise ValueError(f"unknown transform {transform}")
    return df.withColumn(out, TRANSFORMS[transform](reward, float(scale)) * m).drop("__sum", "__n", "__p")


def sequence_reward(tokens: DataFrame, kind: str) -> DataFrame:
    """One score per response for the sequence forms: mean log-prob or geometric mean probability.

    ``advantage.place_on_last_valid`` puts it on the last valid token.
    """
    m = F.col("mask")
    level = F.coalesce(F.sum(masked(F.col("teacher_logp"), m)), F.lit(0.0)) / F.greatest(F.sum(m), F.lit(1))
    if kind == "teacher_seq_log_prob":
        value = level
    elif kind == "teacher_sentence_prob":
        value = F.exp(level)
    else:
        raise ValueError(f"{kind} is not a sequence form")
    return tokens.groupBy("sample_id").agg(value.alias("score"))


def confidence_weights(
    tokens: DataFrame,
    version: str = "v2sqrt",
    temperature: float = 1.0,
    strength: float = 0.8,
    tau: float = 0.5,
    batch: Sequence[str] = ("step",),
    out: str = "weight",
) -> DataFrame:
    """Weight of each token: a softmax over its response times its length, at most 10; or, for
    "v5", an independent weight that is 1 where the teacher is not more certain than the student.

    v1: -H; v1_norm: -H / max H of the batch; v2: certainty * wrongness; v2sqrt: its root;
    v4: positive information gain. Tokens outside the mask get 0; a NaN score gives weight 1.
    """
    m = F.col("mask")
    teacher, student = F.col("teacher_topk"), F.col("student_topk")
    t = tokens.withColumn("__h", entropy(teacher)).withColumn("__hs", entropy(student))
    h, hs = F.col("__h"), F.col("__hs")
    if version == "v5":
        risk = F.greatest(hs - h, F.lit(0.0))
        share = F.least(risk / (hs + 1e-8), F.lit(1.0))
        w = F.when(risk > 0, 1.0 - strength / (1.0 + F.exp(-share / tau))).otherwise(F.lit(1.0))
        return t.withColumn(out, F.when(m != 0, w).otherwise(F.lit(0.0))).drop("__h", "__hs")
    wrong = (1.0 - h / F.log(F.size(teacher))) * (1.0 - F.exp("teacher_logp"))
    if version == "v1_norm":
        t = attach(t, list(batch), __top=F.greatest(F.max(F.when(m != 0, h).otherwise(F.lit(0.0))), F.lit(1e-6)))
    scores = {
        "v1": -h,
        "v1_norm": -h / F.col("__top"),
        "v2": wrong,
        "v2sqrt": F.sqrt(wrong + 1e-8),
        "v4": F.greatest(hs - h, F.lit(0.0)),
    }
    if version not in scores:
        raise ValueError(f"unknown weighting {version}")
    t = t.withColumn("__s", scores[version] / temperature)
    top = F.lit(0.0)
    if temperature < 0.05:
        # the scores lie within ln K of 0: only a small temperature makes them too large for exp
        t = attach(t, ["sample_id"], __max=F.max(masked(F.col("__s"), m)))
        top = F.col("__max")
    t = t.withColumn("__e", F.when(m != 0, F.exp(F.col("__s") - top)).otherwise(F.lit(0.0)))
    t = attach(t, ["sample_id"], __z=F.sum("__e"), __n=F.sum(m))
    w = F.least(F.try_divide(F.col("__e"), F.col("__z")) * F.greatest(F.col("__n"), F.lit(1)), F.lit(10.0))
    w = F.when(m == 0, F.lit(0.0)).when(F.isnan(w), F.lit(1.0)).otherwise(w)
    return t.withColumn(out, w).drop(*[c for c in t.columns if c.startswith("__")])


def entropy_metrics(tokens: DataFrame, batch: Sequence[str] = ("step",)) -> DataFrame:
    """Teacher and student entropy, information gain and collapse risk over the valid tokens."""
    t = tokens.filter(F.col("mask") != 0).select(
        *batch, "teacher_logp", entropy(F.col("teacher_topk")).alias("h"), entropy(F.col("student_topk")).alias("hs")
    )
    gain = F.col("hs") - F.col("h")
    risk = F.greatest(gain, F.lit(0.0))
    return t.groupBy(*batch).agg(
        F.avg("h").alias("teacher_entropy_mean"),
        F.coalesce(F.stddev_samp("h"), F.lit(0.0)).alias("teacher_entropy_std"),
        F.avg(F.exp("teacher_logp")).alias("teacher_prob_on_student_mean"),
        F.avg("hs").alias("student_entropy_mean"),
        F.avg(gain).alias("info_gain_mean"),
        F.avg((gain > 0).cast("double")).alias("info_gain_positive_ratio"),
        F.avg(risk).alias("collapse_risk_mean"),
        F.avg(F.least(risk / (F.col("hs") + 1e-8), F.lit(1.0))).alias("normalised_collapse_mean"),
    )


_CLEAN = T.StructType(
    [
        T.StructField(n, T.DoubleType())
        for n in ("beta", "cos_full_answer", "cos_clean_answer", "h_base", "h_full", "h_answer", "h_clean")
    ]
    + [T.StructField("clean_topk", T.ArrayType(T.DoubleType()))]
)


def _matrix(arr: pd.Series) -> np.ndarray:
    """Arrays of equal length as one matrix."""
    return np.stack(arr.to_numpy()).astype(float)


def _common_size(*arrays: np.ndarray | None) -> int:
    """Length of the arrays, 0 if one is missing or they differ."""
    sizes = {0 if a is None else len(a) for a in arrays}
    return sizes.pop() if len(sizes) == 1 else 0


def _norm(logp: np.ndarray) -> np.ndarray:
    return logp - np.logaddexp.reduce(logp, axis=1, keepdims=True)


def clean_teacher(
    tokens: DataFrame,
    gamma: float = 0.5,
    beta_fixed: float | None = None,
    beta_max: float = 1.0,
    tail: bool = True,
    eps: float = 1e-8,
) -> DataFrame:
    """Teacher target with the part explained by the bare answer removed.

    ``base_topk``, ``full_topk`` and ``answer_topk`` are raw log-probs of the prompt alone, with the
    demonstration and with the answer only. Adds ``beta``, ``clean_topk`` (tail appended, or
    renormalised), ``cos_full_answer``, ``cos_clean_answer`` and the four entropies ``h_*``. Rows may
    differ in their number of entries; a row whose arrays are null, empty or differ in length gets nulls.
    """

    @F.pandas_udf(_CLEAN)
    def run(base: pd.Series, full: pd.Series, answer: pd.Series) -> pd.DataFrame:
        sizes = pd.Series([_common_size(*row) for row in zip(base, full, answer)], index=base.index, dtype=int)
        none = sizes.index[sizes == 0]
        parts = [pd.DataFrame({n: [None] * len(none) for n in _CLEAN.names}, index=none, dtype=object)]
        for size in sorted(set(sizes) - {0}):
            at = sizes == size
            parts.append(block(base[at], full[at], answer[at]).set_index(sizes.index[at]).astype(object))
        return pd.concat(parts).loc[base.index, _CLEAN.names]

    def block(base: pd.Series, full: pd.Series, answer: pd.Series) -> pd.DataFrame:
        raw = [_matrix(x) for x in (base, full, answer)]
        cond = [_norm(x) for x in raw]
        weight = np.exp(cond[0])
        inner = lambda x, y: (weight * x * y).sum(axis=1)
        to_full, to_answer = cond[1] - cond[0], cond[2] - cond[0]
        if beta_fixed is None:
            beta = np.clip(inner(to_full, to_answer) / (inner(to_answer, to_answer) + eps), 0.0, beta_max)
        else:
            beta = np.full(len(base), float(beta_fixed))
        pull = beta[:, None]
        target = raw[0] + gamma * ((raw[1] - raw[0]) - pull * (raw[2] - raw[0]))
        kept = to_full - pull * to_answer
        size = lambda x: np.sqrt(inner(x, x) + eps)
        cosine = lambda x: inner(x, to_answer) / (size(x) * size(to_answer) + eps)
        spread = lambda x: -(np.exp(x) * x).sum(axis=1)
        clean = _norm(target)
        out = {
            "beta": beta,
            "cos_full_answer": cosine(to_full),
            "cos_clean_answer": cosine(kept),
            "h_base": spread(cond[0]),
            "h_full": spread(cond[1]),
            "h_answer": spread(cond[2]),
            "h_clean": spread(clean),
        }
        if tail:
            mass = np.logaddexp.reduce(target, axis=1, keepdims=True)
            target = target - np.maximum(mass + 1e-7, 0.0)
            mass = np.minimum(np.logaddexp.reduce(target, axis=1, keepdims=True), -1e-7)
            clean = np.hstack([target, np.log(-np.expm1(mass))])
        return pd.DataFrame({**out, "clean_topk": list(clean)})

    d = tokens.withColumn("__c", run("base_topk", "full_topk", "answer_topk"))
    return d.select(*tokens.columns, "__c.*")


def clean_teacher_metrics(cleaned: DataFrame, batch: Sequence[str] = ("step",)) -> DataFrame:
    """Batch means over the valid tokens of the columns that ``clean_teacher`` adds."""
    names = ["cos_full_answer", "cos_clean_answer", "beta", "h_base", "h_full", "h_answer", "h_clean"]
    return cleaned.filter(F.col("mask") != 0).groupBy(*batch).agg(*[F.avg(n).alias(n) for n in names])


# fixed values: the words of the two word lists
SEARCH_WORDS = ["Wait", "Maybe", "Alternatively", "Consider", "Check", "Suppose", "Let"]
SHORTCUT_WORDS = ["Therefore", "Thus", "Hence", "answer", "option", "boxed", "final"]


def word_mass(responses: DataFrame, text: str, batch: Sequence[str], search=SEARCH_WORDS, shortcut=SHORTCUT_WORDS) -> DataFrame:
    """Share of the words of the responses that belong to the search and the shortcut list, per batch."""
    words = F.filter(F.split(F.col(text), r"[^A-Za-z]+"), lambda w: w != "")
    hits = lambda names: F.size(F.filter(words, lambda w: w.isin(*names)))
    t = responses.select(*batch, F.size(words).alias("n"), hits(search).alias("a"), hits(shortcut).alias("b"))
    n = F.greatest(F.sum("n"), F.lit(1))
    return t.groupBy(*batch).agg((F.sum("a") / n).alias("search_mass"), (F.sum("b") / n).alias("shortcut_mass"))


def token_group_mass(tokens: DataFrame, logps: Sequence[str], batch: Sequence[str]) -> DataFrame:
    """Mean probability mass of a group of vocabulary entries, given their logged log-prob columns."""
    mass = F.lit(0.0)
    for c in logps:
        mass = mass + F.exp(c)
    m = F.col("mask")
    return tokens.groupBy(*batch).agg(
        (F.coalesce(F.sum(masked(mass, m)), F.lit(0.0)) / F.greatest(F.sum(m), F.lit(1))).alias("mass")
    )
