"""Masked statistics of a batch of tokens: sum, mean, variance, whitening and the reduction modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.spread import attach

TINY = 1e-8


def masked(value: Column, mask: Column) -> Column:
    """Value inside the mask, null outside: a NaN outside the mask cannot reach an aggregate."""
    return F.when(mask != 0, value)


def masked_total(value: Column, mask: Column) -> Column:
    return F.coalesce(F.sum(masked(value, mask) * mask), F.lit(0.0))


def masked_average(value: Column, mask: Column) -> Column:
    """Divides by the mask sum + 1e-8: an empty mask gives 0, not null."""
    return masked_total(value, mask) / (F.coalesce(F.sum(mask), F.lit(0)) + TINY)


def masked_variance(value: Column, mask: Column) -> Column:
    """Sample variance inside the mask; null for fewer than two elements, where no variance exists."""
    n = F.sum(mask)
    return F.var_samp(masked(value, mask)) * n / (n + TINY)


def masked_stats(df: DataFrame, batch: Sequence[str], value: str, mask: str) -> DataFrame:
    v, m = F.col(value), F.col(mask)
    return df.groupBy(*batch).agg(
        masked_total(v, m).alias("total"), masked_average(v, m).alias("mean"), masked_variance(v, m).alias("var")
    )


def whiten(df: DataFrame, batch: Sequence[str], value: str, mask: str, out: str, keep_mean: bool = False) -> DataFrame:
    """Zero mean and unit variance by the masked statistics of the whole batch, applied to every token."""
    v, m = F.col(value), F.col(mask)
    wide = attach(df, batch, __mean=masked_average(v, m), __var=masked_variance(v, m))
    scaled = (v - F.col("__mean")) / F.sqrt(F.col("__var") + TINY)
    return wide.withColumn(out, scaled + F.col("__mean") if keep_mean else scaled).drop("__mean", "__var")


def reduce_tokens(tokens: DataFrame, batch: Sequence[str], sample: str, value: str, mask: str, width: float) -> DataFrame:
    """The four ways to reduce a token matrix to one number per batch."""
    v, m = F.col(value), F.col(mask)
    rows = tokens.groupBy(*batch, sample).agg(masked_total(v, m).alias("s"), F.sum(m).alias("n"))
    valid = F.col("n") > 0
    return rows.groupBy(*batch).agg(
        (F.sum("s") / F.sum("n")).alias("token_mean"),
        F.avg(F.when(valid, F.col("s"))).alias("seq_mean_token_sum"),
        F.avg(F.when(valid, F.col("s") / (F.col("n") + TINY))).alias("seq_mean_token_mean"),
        (F.sum("s") / F.lit(float(width))).alias("seq_mean_token_sum_norm"),
    )
