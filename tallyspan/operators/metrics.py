"""Metric roll-ups: reduction by name, validation metrics, batch statistics, run comparison."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.draws import Ballots, classes, moments
from tallyspan.operators.masked import masked
from tallyspan.spread import SCAN_BLOCK, affine_scan, attach, hash_uniform, hot_groups, quantiles, ranked

# ---- reduction of logged metrics ---------------------------------------------------------


def reduce_by_name(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """max for names containing "max", else min for names containing "min", else the mean.

    The rule is a substring rule: "timing_per_token_ms/x" contains "min" and is min-reduced.
    """
    name = F.col("name")
    value = (
        F.when(name.contains("max"), F.col("__max")).when(name.contains("min"), F.col("__min")).otherwise(F.col("__avg"))
    )
    stats = log.groupBy(*keys, "name").agg(
        F.max("value").alias("__max"), F.min("value").alias("__min"), F.avg("value").alias("__avg")
    )
    return stats.select(*keys, "name", value.alias("value"))


def flatten_metrics(rows: DataFrame, keys: Sequence[str], values: str = "metrics") -> DataFrame:
    """``map<name, array<double>>`` rows to one row per value."""
    named = rows.select(*keys, F.explode(values).alias("name", "list"))
    return named.select(*keys, "name", F.explode("list").alias("value"))


def accumulate(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reduce with the declared ``kind`` (mean, sum, min, max) of each metric; two kinds under one name are an error."""
    kind = F.col("__kind")
    stats = log.groupBy(*keys, "name").agg(
        F.min("kind").alias("__kind"),
        F.max("kind").alias("__other"),
        F.avg("value").alias("__mean"),
        F.sum("value").alias("__sum"),
        F.min("value").alias("__min"),
        F.max("value").alias("__max"),
    )
    clash = F.raise_error(F.concat(F.lit("metric "), F.col("name"), F.lit(" has two reductions"))).cast("double")
    unknown = F.raise_error(F.concat(F.lit("unknown reduction "), kind)).cast("double")
    value = F.when(kind != F.col("__other"), clash)
    for k in ("mean", "sum", "min", "max"):
        value = value.when(kind == k, F.col("__" + k))
    return stats.select(*keys, "name", kind.alias("kind"), value.otherwise(unknown).alias("value"))


# fixed values: metrics with a declared rule across steps
LISTED_RULES = {
    "time_sum": ["perf/time_per_step"],
    "min": ["timing_s/agent_loop/tool_calls/min"],
    "avg": ["timing_s/agent_loop/tool_calls/mean"],
    "max": ["timing_s/agent_loop/tool_calls/max"],
    "last": [
        "fully_async/count/total_generated_samples",
        "fully_async/count/stale_samples_processed",
        "fully_async/count/stale_trajectory_processed",
        "fully_async/count/current_param_version",
        "fully_async/count/dropped_stale_samples",
        "training/global_step",
    ],
}
# fixed values: rules by part of the lower-case name, first hit wins
NAME_RULES = [
    ("time_sum", ["timing_s/"]),
    ("avg", ["mean", "avg", "average"]),
    ("max", ["max", "maximum"]),
    ("min", ["min", "minimum"]),
    ("sum", ["sum", "total"]),
    ("weighted_avg", ["weighted_avg"]),
]


def step_rule(name: Column) -> Column:
    """How a metric is combined across the steps of a window."""
    rule = None
    for kind, names in LISTED_RULES.items():
        hit = name.isin(*names)
        rule = F.when(hit, kind) if rule is None else rule.when(hit, kind)
    low = F.lower(name)
    for kind, parts in NAME_RULES:
        hit = F.lit(False)
        for part in parts:
            hit = hit | low.contains(part)
        rule = rule.when(hit, kind)
    return rule.otherwise(F.lit("avg"))


def roll_up_steps(log: DataFrame, keys: Sequence[str], gpus: int, derived: bool = True) -> DataFrame:
    """Combine ``name, value, ts, samples`` rows per window ``keys`` by ``step_rule``, then the derived
    metrics: length spread, throughput and idle ratio."""
    keys = list(keys)
    v, c = F.col("value"), F.col("samples")
    stats = log.groupBy(*keys, "name").agg(
        F.max_by("value", "ts").alias("last"),
        F.sum(v).alias("sum"),
        F.avg(v).alias("avg"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.when(F.sum(c) != 0, F.sum(v * c) / F.sum(c)).otherwise(F.avg(v)).alias("weighted_avg"),
    )
    stats = stats.withColumn("rule", step_rule(F.col("name")))
    value = F.when(F.col("rule").isin("sum", "time_sum"), F.col("sum"))
    for kind in ("last", "avg", "min", "max", "weighted_avg"):
        value = value.when(F.col("rule") == kind, F.col(kind))
    rolled = stats.select(*keys, "name", "rule", value.alias("value"))
    if not derived:
        return rolled
    pick = lambda n: F.max(F.when(F.col("name") == n, F.col("value")))
    # one row per window: a fixed number of named metrics
    extra = rolled.groupBy(*keys).agg(
        (pick("global_seqlen/max") - pick("global_seqlen/min")).alias("__diff"),
        (pick("perf/total_num_tokens") / (pick("perf/time_per_step") * gpus)).alias("__rate"),
        (pick("timing_s/gen") / pick("timing_s/step")).alias("__idle"),
    )
    joined = rolled.join(extra, keys)
    changed = (
        F.when(F.col("name") == "global_seqlen/minmax_diff", F.col("__diff"))
        .when((F.col("name") == "perf/throughput") & F.col("__rate").isNotNull(), F.col("__rate"))
        .otherwise(F.col("value"))
    )
    idle = extra.filter(F.col("__idle").isNotNull()).select(
        *keys, F.lit("trainer/idle_ratio").alias("name"), F.lit("derived").alias("rule"), F.col("__idle").alias("value")
    )
    return joined.filter(F.col("name") != "trainer/idle_ratio").select(*keys, "name", "rule", changed.alias("value")).unionByName(idle)


# ---- validation metrics ------------------------------------------------------------------


def variables(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per (response, numeric variable): ``var, val``; text variables are not listed."""
    cells = [F.struct(F.lit(n).alias("var"), F.col(n).cast("double").alias("val")) for n in names]
    keep = [c for c in ("data_source", "uid", "sample_id", "pred") if c in rows.columns]
    return rows.select(*keep, F.inline(F.array(*cells)))


def subset_sizes(n: Column) -> Column:
    """2, 4, 8, ... below n, then n; nothing for one response."""
    powers = F.transform(F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(n)), F.lit(1)).cast("int")), lambda j: F.pow(F.lit(2.0), j).cast("long"))
    below = F.filter(powers, lambda v: v < n)
    return F.when(n > 1, F.concat(below, F.array(n.cast("long"))))


def mean_metrics(vars_df: DataFrame) -> DataFrame:
    """``mean@N`` and the population ``std@N`` of each prompt group."""
    groups = vars_df.groupBy("data_source", "uid", "var").agg(
        F.count("val").alias("n"), F.avg("val").alias("m"), F.stddev_pop("val").alias("s")
    )
    n = F.col("n").cast("string")
    cells = F.array(
        F.struct(F.concat(F.lit("mean@"), n).alias("metric"), F.col("m").alias("value")),
        F.struct(F.concat(F.lit("std@"), n).alias("metric"), F.when(F.col("n") > 1, F.col("s")).alias("value")),
    )
    return groups.select("data_source", "uid", "var", "n", F.inline(cells)).filter(F.col("value").isNotNull())


def best_of_metrics(vars_df: DataFrame) -> DataFrame:
    """Mean and population std of the best and the worst of k responses drawn with replacement.

    Exact: the i-th smallest of N values is the maximum of k draws with probability
    (i/N)^k - ((i-1)/N)^k, so no draws are made.
    """
    keys = ["data_source", "uid", "var"]
    r = ranked(vars_df, keys, ["val", "sample_id"], "__i")
    r = attach(r, keys, __n=F.count(F.lit(1)))
    r = r.select(*keys, "val", "__i", "__n", F.explode(subset_sizes(F.col("__n"))).alias("k"))
    i, n, k, v = F.col("__i"), F.col("__n"), F.col("k"), F.col("val")
    up = F.pow(i / n, k) - F.pow((i - 1) / n, k)
    down = F.pow((n - i + 1) / n, k) - F.pow((n - i) / n, k)
    g = r.groupBy(*keys, "k").agg(
        F.max("__n").alias("n"),
        F.sum(v * up).alias("bm"),
        F.sum(v * v * up).alias("bq"),
        F.sum(v * down).alias("wm"),
        F.sum(v * v * down).alias("wq"),
    )
    dev = lambda q, m: F.sqrt(F.greatest(F.col(q) - F.col(m) * F.col(m), F.lit(0.0)))
    label = lambda what, stat: F.concat(F.lit(what + "@"), F.col("k").cast("string"), F.lit("/" + stat))
    cells = F.array(
        *[
            F.struct(label(w, s).alias("metric"), c.alias("value"))
            for w, s, c in (
                ("best", "mean", F.col("bm")),
                ("best", "std", dev("bq", "bm")),
                ("worst", "mean", F.col("wm")),
                ("worst", "std", dev("wq", "wm")),
            )
        ]
    )
    return g.select(*keys, "n", F.inline(cells))


def majority_metrics(vars_df: DataFrame, draws: int = 1000, seed: int = 42, array_rows: int = SCAN_BLOCK) -> DataFrame:
    """Mean and population std of the majority-vote value over ``draws`` subsets of each size k.

    A subset takes k responses with replacement by seeded md5 numbers. The vote goes to the most
    frequent ``pred``, among equals to the one drawn first; its value is that of its first draw.
    For k = 2 the first draw always wins, so the exact mean and std of the group are used.

    A prompt of at most ``array_rows`` rows votes inside one array, so that its draws and slots
    never become rows; the draws of a larger one are dealt over the cluster, slot by slot.
    """
    keys = ["data_source", "uid", "var"]
    sizes = vars_df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("val").alias("m"), F.stddev_pop("val").alias("s")
    )
    exact = sizes.select(*keys, "n", F.explode(subset_sizes(F.col("n"))).alias("k"), "m", "s").filter(F.col("k") == 2)
    voters = vars_df.dropna(subset=keys)
    large = hot_groups(voters, keys, array_rows)
    if large.isEmpty():
        drawn = _votes_in_arrays(voters, draws, seed)
    else:
        rest = voters.join(F.broadcast(large), keys, "left_anti")
        many = voters.join(F.broadcast(large), keys, "left_semi")
        drawn = _votes_in_arrays(rest, draws, seed).unionByName(_votes_by_slot(many, draws, seed))
    name = F.concat(F.lit("maj@"), F.col("k").cast("string"))
    cells = F.array(
        F.struct(F.concat(name, F.lit("/mean")).alias("metric"), F.col("m").alias("value")),
        F.struct(F.concat(name, F.lit("/std")).alias("metric"), F.col("s").alias("value")),
    )
    return exact.unionByName(drawn).select(*keys, "n", F.inline(cells))


def _votes_in_arrays(voters: DataFrame, draws: int, seed: int) -> DataFrame:
    """``n, k, m, s`` of the drawn votes of prompts that fit in one array. The rows of a ``uid`` lie side by
    side, as its numbers serve all its sources and variables."""
    keys = ["data_source", "uid", "var"]
    # little data but much work: as many tasks as a shuffle has, whatever their size in bytes
    parts = int(voters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = voters.repartition(parts, "uid").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("sample_id", "pred", "val"))).alias("rows"))
    lists = [F.col(f"rows.{c}").alias(c) for c in ("pred", "val")]
    rows = rows.filter(F.size("rows") > 2).select(*keys, F.col("uid").cast("string").alias("text"), *lists).sortWithinPartitions("uid", "data_source")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ballots = Ballots(seed, draws)
        for batch in batches:
            pred, val = batch.column("pred"), batch.column("val")
            lengths = pc.list_value_length(pred).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            codes = pred.flatten().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            val = val.flatten()
            known, value = val.is_valid().to_numpy(zero_copy_only=False), val.fill_null(0.0).to_numpy(zero_copy_only=False)
            texts = batch.column("text").to_pylist()
            # prompts vote together, until they have so many rows
            cuts = [*np.flatnonzero(np.diff(ends // (4 * SCAN_BLOCK), prepend=-1)).tolist(), len(ends)]
            for x, y in zip(cuts, cuts[1:]):
                grouped = classes(codes[ends[x] - lengths[x] : ends[y - 1]], lengths[x:y])
                at, k, won = zip(*ballots.of(texts[x:y], grouped))
                at = np.array(at) + x
                m, s, some = moments(won, ends[at] - lengths[at], value, known)
                columns = [batch.column(c).take(pa.array(at)) for c in keys]
                columns += [pa.array(lengths[at], pa.int64()), pa.array(k, pa.int64()), pa.array(m, mask=~some), pa.array(s, mask=~some)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "n", "k", "m", "s"])

    fields = ", ".join(f"{c} {t}" for c, t in rows.select(*keys).dtypes)
    return rows.mapInArrow(vote, f"{fields}, n long, k long, m double, s double")


def _votes_by_slot(voters: DataFrame, draws: int, seed: int) -> DataFrame:
    """The same for prompts of any size; every slot of a draw becomes a row."""
    keys = ["data_source", "uid", "var"]
    r = ranked(voters, keys, ["sample_id"], "__i").withColumn("__i", F.col("__i") - 1)
    plan = voters.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    plan = plan.select(*keys, "n", F.explode(subset_sizes(F.col("n"))).alias("k")).filter(F.col("k") > 2)
    # draws first, slots second: a large group is dealt over its draws before its slots are made
    plan = plan.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    parts = int(voters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan = plan.repartition(parts, *keys, "k", "draw").withColumn("slot", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k"))))
    u = hash_uniform(seed, "uid", "k", "draw", "slot")
    plan = plan.withColumn("__i", F.floor(u * F.col("n")).cast("long"))
    drawn = plan.join(r.select(*keys, "__i", "val", "pred"), [*keys, "__i"])
    votes = drawn.groupBy(*keys, "n", "k", "draw", "pred").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("slot", "val")).alias("first")
    )
    won = votes.groupBy(*keys, "n", "k", "draw").agg(
        F.max(F.struct("c", (-F.col("first.slot")).alias("early"), F.col("first.val").alias("val"))).alias("w")
    )
    return won.groupBy(*keys, "n", "k").agg(F.avg("w.val").alias("m"), F.stddev_pop("w.val").alias("s"))


def majority_of_all(rows: DataFrame, val: str) -> DataFrame:
    """The vote over all responses of a prompt: most frequent ``pred``, ties to the lowest sample id."""
    votes = rows.groupBy("uid", "pred").agg(
        F.count(F.lit(1)).alias("c"), F.min("sample_id").alias("first"), F.min_by(val, "sample_id").alias("v")
    )
    best = F.max(F.struct("c", (-F.col("first")).alias("early"), "pred", "v"))
    return votes.groupBy("uid").agg(best.alias("w")).select("uid", F.col("w.pred").alias("pred"), F.col("w.v").alias("value"))


def over_prompts(per_prompt: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean of each metric over the prompts of a data source. With ``digits`` the values are summed as
    decimals of so many digits, so that the mean does not depend on the order of summing."""
    value = F.avg("value") if digits is None else F.sum(F.col("value").cast(f"decimal(38,{digits})")).cast("double") / F.count("value")
    return per_prompt.groupBy("data_source", "var", "metric").agg(value.alias("value"))


def label_sections(rolled: DataFrame) -> DataFrame:
    """Add ``section``: "val-core" for mean/maj/best at the largest N of the core variable, else "val-aux".

    The core variable is acc if the source has it, else reward.
    """
    n = F.regexp_extract("metric", r"@(\d+)(?:/[^@]*)?$", 1).cast("long")
    r = rolled.withColumn("__k", n)
    # one row per source and variable, and per source: a handful of metric rows each
    tops = r.groupBy("data_source", "var").agg(F.max("__k").alias("__top"))
    cores = r.groupBy("data_source").agg(F.max((F.col("var") == "acc").cast("int")).alias("__acc"))
    r = r.join(tops, ["data_source", "var"]).join(cores, "data_source")
    core = F.col("var") == F.when(F.col("__acc") == 1, "acc").otherwise("reward")
    named = F.col("metric").rlike("^(mean|maj|best)")
    at_top = F.col("metric").contains(F.concat(F.lit("@"), F.col("__top").cast("string")))
    section = F.when(core & named & at_top, "val-core").otherwise("val-aux")
    return r.select("data_source", "var", "metric", "value", section.alias("section"))


def offline_evaluation(prompts: DataFrame, score) -> DataFrame:
    """Mean score of the responses of each prompt, then the mean per data source.

    ``prompts``: ``data_source, responses array<string>, ground_truth``; ``score(response, truth)``
    is a column function.
    """
    each = prompts.select(
        "data_source",
        "ground_truth",
        F.aggregate(
            F.transform("responses", lambda r: score(r, F.col("ground_truth"))), F.lit(0.0), lambda a, x: a + x
        ).alias("__s"),
        F.size("responses").alias("__n"),
    )
    return each.groupBy("data_source").agg(F.avg(F.col("__s") / F.col("__n")).alias("test_score"))


# ---- batch statistics --------------------------------------------------------------------


def batch_metrics(responses: DataFrame, tokens: DataFrame, batch: Sequence[str], max_prompt: int, max_response: int) -> DataFrame:
    """Statistics of scores, rewards, advantages, returns, values and lengths per batch.

    ``responses``: every response with ``prompt_length`` (aborted responses have no tokens).
    ``tokens``: ``sample_id, mask, score, reward, adv, ret, value``. The score of a response is a
    sum, its reward a masked mean. A batch of aborted responses only is an error.
    """
    batch, m = list(batch), F.col("mask")
    inside = lambda c: masked(F.col(c), m)
    gap = masked(F.col("ret") - F.col("value"), m)
    per = tokens.groupBy("sample_id").agg(
        F.sum(m).alias("response_length"),
        F.sum("score").alias("seq_score"),
        (F.coalesce(F.sum(inside("reward")), F.lit(0.0)) / F.greatest(F.sum(m), F.lit(1))).alias("seq_reward"),
    )
    r = responses.select("sample_id", "prompt_length", *batch).join(per, "sample_id", "left").fillna({"response_length": 0})
    live = F.col("response_length") > 0
    length, plen = F.col("response_length"), F.col("prompt_length")
    s, w = F.when(live, F.col("seq_score")), F.when(live, F.col("seq_reward"))
    three = lambda c, n: [F.avg(c).alias(n + "_mean"), F.max(c).alias(n + "_max"), F.min(c).alias(n + "_min")]
    clip = lambda c, top: F.avg((c == top).cast("double"))
    none_left = F.raise_error(F.lit("all responses of a batch are aborted")).cast("double")
    by_response = r.groupBy(*batch).agg(
        F.when(F.max(live.cast("int")) == 1, F.avg(s)).otherwise(none_left).alias("score_mean"),
        F.max(s).alias("score_max"),
        F.min(s).alias("score_min"),
        *three(w, "reward"),
        F.stddev_samp(w).alias("reward_std"),
        *three(length, "response_length"),
        clip(length, max_response).alias("response_length_clip_ratio"),
        *three(F.when(live, length), "response_length_non_aborted"),
        F.avg(F.when(live, (length == max_response).cast("double"))).alias("response_length_non_aborted_clip_ratio"),
        F.avg((~live).cast("double")).alias("aborted_ratio"),
        *three(plen, "prompt_length"),
        clip(plen, max_prompt).alias("prompt_length_clip_ratio"),
    )
    t = tokens.join(responses.select("sample_id", *batch), "sample_id")
    by_token = t.groupBy(*batch).agg(
        *three(inside("adv"), "advantage"),
        *three(inside("ret"), "return"),
        *three(inside("value"), "value"),
        (1.0 - F.var_samp(gap) / (F.var_samp(inside("ret")) + 1e-5)).alias("explained_variance"),
    )
    return by_response.join(by_token, batch)


def count_stats(rows: DataFrame, batch: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """min, max and mean of per-response counters such as turns and tool calls."""
    aggs = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    return rows.groupBy(*batch).agg(*aggs)


# fixed values: stages whose time is divided by all tokens; "gen" is divided by response tokens
ALL_TOKEN_STAGES = ["ref", "values", "adv", "update_critic", "update_actor"]


def timing_metrics(timing: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``stage, seconds`` rows with ``ms_per_token`` by the stage's token count.

    ``totals``: one row per batch with ``prompt_tokens`` and ``response_tokens``.
    """
    n = F.when(F.col("stage") == "gen", F.col("response_tokens")).when(
        F.col("stage").isin(*ALL_TOKEN_STAGES), F.col("prompt_tokens") + F.col("response_tokens")
    )
    return timing.join(totals, list(keys)).select(*keys, "stage", "seconds", (F.col("seconds") * 1000 / n).alias("ms_per_token"))


def throughput(totals: DataFrame, step_seconds: DataFrame, keys: Sequence[str], gpus: int) -> DataFrame:
    """Tokens per second and device: ``tokens / (seconds * gpus)``."""
    joined = totals.join(step_seconds, list(keys))
    return joined.select(*keys, "tokens", "seconds", (F.col("tokens") / (F.col("seconds") * gpus)).alias("throughput"))


def assembled_batch_stats(samples: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Processing-time statistics, tool-call times and partial rollouts of assembled batches.

    ``samples``: ``sample_id, processing_time, tool_time, version, version_start, version_end``.
    """
    batch = list(batch)
    span = F.abs(F.col("version_end") - F.col("version_start"))
    versions = samples.groupBy(*batch, "version").agg(F.count(F.lit(1)).alias("__c"))
    diversity = versions.groupBy(*batch).agg(F.count(F.lit(1)).alias("version_diversity"))
    stats = samples.groupBy(*batch).agg(
        F.avg("processing_time").alias("time_avg"),
        F.max("processing_time").alias("time_max"),
        F.min("processing_time").alias("time_min"),
        F.max("tool_time").alias("tool_max"),
        F.min("tool_time").alias("tool_min"),
        F.avg("tool_time").alias("tool_mean"),
        F.count_if(span != 0).alias("partial_num"),
        F.avg((span != 0).cast("double")).alias("partial_ratio"),
        F.max(span).alias("max_partial_span"),
    )
    q = quantiles(samples, batch, "processing_time", "sample_id", {"time_tp50": 0.5, "time_tp95": 0.95, "time_tp99": 0.99})
    return stats.join(q, batch).join(diversity, batch)


def slowest_sample(samples: DataFrame, batch: Sequence[str]) -> DataFrame:
    """The sample with the largest generation + tool time of each batch (ties: lowest id)."""
    top = F.max(
        F.struct(
            (F.col("gen_time") + F.col("tool_time")).alias("t"),
            (-F.col("sample_id")).alias("o"),
            "gen_time",
            "tool_time",
            "prompt_length",
            "response_length",
        )
    )
    s = samples.groupBy(*batch).agg(top.alias("s"))
    return s.select(
        *batch, (-F.col("s.o")).alias("sample_id"), "s.gen_time", "s.tool_time", "s.prompt_length", "s.response_length"
    )


def verifier_agreement(responses: DataFrame, tokens: DataFrame, batch: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """How the sign of a response's mean advantage agrees with its verifier score.

    ``tokens``: ``sample_id, mask, adv, token_reward``; ``responses``: ``sample_id, acc`` and the
    batch. An advantage of 0 counts as negative.
    """
    batch, m = list(batch), F.col("mask")
    per = tokens.groupBy("sample_id").agg(
        (F.coalesce(F.sum(masked(F.col("adv"), m)), F.lit(0.0)) / F.greatest(F.sum(m), F.lit(1))).alias("a")
    )
    r = responses.join(per, "sample_id", "left").fillna({"a": 0.0})
    pos, ok = F.col("a") > 0, F.col("acc") >= threshold
    rate = lambda c: F.avg(c.cast("double"))
    cells = r.groupBy(*batch).agg(
        rate(pos & ok).alias("pos_pos"),
        rate(~pos & ~ok).alias("neg_neg"),
        rate(pos & ~ok).alias("pos_neg"),
        rate(~pos & ok).alias("neg_pos"),
        rate(pos == ok).alias("agree"),
        rate(ok).alias("success_rate"),
    )
    t = tokens.filter(m != 0).join(responses.select("sample_id", "acc", *batch), "sample_id")
    w = F.col("token_reward")
    good, bad = F.when(ok, w), F.when(~ok, w)
    rewards = t.groupBy(*batch).agg(
        F.avg(w).alias("token_reward_mean"),
        rate(w > 0).alias("token_reward_pos_rate"),
        F.avg(good).alias("token_reward_mean_success"),
        F.stddev_samp(good).alias("token_reward_std_success"),
        F.avg(bad).alias("token_reward_mean_fail"),
        F.stddev_samp(bad).alias("token_reward_std_fail"),
    )
    return cells.join(rewards, batch)


def pair_length_report(pairs: DataFrame, keys: Sequence[str], max_length: int) -> DataFrame:
    """Length statistics of preference pairs, ``pair_id, prompt_len, chosen_len, rejected_len``, in long
    form: ``series, stat, value``."""
    keys = list(keys)
    p, c, r = F.col("prompt_len"), F.col("chosen_len"), F.col("rejected_len")
    series = {
        "prompt": p,
        "chosen": c,
        "rejected": r,
        "prompt_chosen": p + c,
        "prompt_rejected": p + r,
        "longest": p + F.greatest(c, r),
        "remaining": F.lit(max_length) - p,
    }
    cells = [F.struct(F.lit(n).alias("series"), e.cast("double").alias("len")) for n, e in series.items()]
    long = pairs.select(*keys, "pair_id", F.inline(F.array(*cells)))
    g = [*keys, "series"]
    stats = long.groupBy(*g).agg(
        F.avg("len").alias("mean"),
        F.min("len").alias("min"),
        F.max("len").alias("max"),
        F.avg((F.col("len") > max_length).cast("double")).alias("over_share"),
        F.avg((F.col("len") <= 0).cast("double")).alias("no_space_share"),
    )
    q = quantiles(long, g, "len", "pair_id", {"median": 0.5, "p25": 0.25, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99})
    return stats.join(q, g)


def truncation_severity(pairs: DataFrame, keys: Sequence[str], max_length: int) -> DataFrame:
    """How much of the completions of over-long pairs survives a cut at ``max_length``."""
    p, c, r = F.col("prompt_len"), F.col("chosen_len"), F.col("rejected_len")
    cut = (p + F.greatest(c, r)) > max_length
    room = F.greatest(F.lit(max_length) - p, F.lit(0))
    share = lambda n: F.avg(F.when(cut, room)) / F.greatest(F.avg(F.when(cut, n)), F.lit(1.0)) * 100
    return pairs.groupBy(*keys).agg(
        F.count_if(cut).alias("truncated"),
        F.avg(cut.cast("double")).alias("truncated_share"),
        F.avg(F.when(cut, p)).alias("prompt_mean"),
        F.avg(F.when(cut, c)).alias("chosen_mean"),
        F.avg(F.when(cut, r)).alias("rejected_mean"),
        F.avg(F.when(cut, room)).alias("surviving_mean"),
        share(c).alias("chosen_surviving_pct"),
        share(r).alias("rejected_surviving_pct"),
        F.count_if(cut & (room <= 0)).alias("completion_lost"),
    )


# ---- staleness ---------------------------------------------------------------------------


def staleness(samples: DataFrame, made: str, used: str, keys: Sequence[str] = ()) -> DataFrame:
    """Of logged samples with the parameter version that made them and the one that trained on them: per ``used``
    version how many were consumed, how many of them were stale (at least one version old), the oldest one's
    age, and the stale ones up to there. Samples that were not used are not counted."""
    keys, age = list(keys), F.col(used) - F.col(made)
    consumed = samples.filter(F.col(used).isNotNull() & F.col(made).isNotNull())
    per = consumed.groupBy(*keys, used).agg(
        F.count(F.lit(1)).alias("consumed"), F.count_if(age >= 1).alias("stale"), F.max(age).cast("long").alias("oldest")
    )
    # one row a version
    placed = affine_scan(ranked(per, keys, [used], "__p"), keys, "__p", {"__sum": (F.lit(1.0), F.col("stale"), False)})
    return placed.select(*keys, used, "consumed", "stale", "oldest", F.col("__sum").cast("long").alias("stale_total"))


# ---- runs --------------------------------------------------------------------------------


def experiment_points(points: DataFrame) -> DataFrame:
    """Final, best and lowest value of every metric of every experiment, with the step of the best.

    Ties of the best go to the earliest step.
    """
    best = F.max(F.struct("value", (-F.col("step")).alias("early")))
    g = points.groupBy("experiment", "key").agg(
        F.max_by("value", "step").alias("final"),
        best.alias("__b"),
        F.min("value").alias("lowest"),
    )
    return g.select("experiment", "key", "final", F.col("__b.value").alias("best"), (-F.col("__b.early")).alias("best_step"), "lowest")


def experiment_section(points: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """One report section: ``alias: (metric key, final | best | lowest | best_step)`` per experiment."""
    stats = experiment_points(points)
    aggs = [F.max(F.when(F.col("key") == key, F.col(stat))).alias(alias) for alias, (key, stat) in columns.items()]
    return stats.groupBy("experiment").agg(*aggs)


def consistency_section(points: DataFrame, mean_key: str, best_key: str) -> DataFrame:
    """Gap between the best-of-n and the mean accuracy: a small gap is a stable model."""
    s = experiment_section(points, {"mean_best": (mean_key, "best"), "best_best": (best_key, "best")})
    pct = F.when(F.col("best_best") > 0, F.col("mean_best") / F.col("best_best") * 100).otherwise(F.lit(0.0))
    both = F.col("mean_best").isNotNull() & F.col("best_best").isNotNull()
    return s.withColumn("gap", F.col("best_best") - F.col("mean_best")).withColumn("consistency_pct", F.when(both, pct))


def range_section(points: DataFrame, key: str) -> DataFrame:
    """Highest, final and lowest value of one metric and the drop between the extremes."""
    s = experiment_section(points, {"highest": (key, "best"), "final": (key, "final"), "lowest": (key, "lowest")})
    return s.withColumn("drop", F.col("highest") - F.col("lowest"))


def experiment_ranking(points: DataFrame, key: str) -> DataFrame:
    """Experiments by their best value of a metric, best first (ties by name)."""
    s = experiment_section(points, {"best": (key, "best"), "final": (key, "final"), "best_step": (key, "best_step")})
    return ranked(s.withColumn("__o", -F.col("best")), [], ["__o", "experiment"], "rank").drop("__o")


def kl_controller_trace(steps: DataFrame, run: Sequence[str], init: float, target: float, horizon: float) -> DataFrame:
    """Adaptive KL coefficient before and after each step: times 1 + clip(kl/target - 1, +-0.2) * n / horizon."""
    error = F.greatest(F.least(F.col("kl") / target - 1, F.lit(0.2)), F.lit(-0.2))
    s = ranked(steps, list(run), ["step"], "__pos").withColumn("__m", 1 + error * F.col("n_steps") / horizon)
    start = F.when(F.col("__pos") == 1, F.col("__m") * init).otherwise(F.lit(0.0))
    s = affine_scan(s, list(run), "__pos", {"kl_coef_after": (F.col("__m"), start, False)})
    before = F.when(F.col("__pos") == 1, F.lit(float(init))).otherwise(F.col("kl_coef_after__x"))
    return s.withColumn("kl_coef", before).drop("__pos", "__m", "kl_coef_after__x")


def best_steps(log: DataFrame, run: Sequence[str], explicit: str | None = None) -> DataFrame:
    """Steps of a run whose monitored metric beats everything before.

    The metric is ``explicit``, else the first (by ``ord``) val-core name with "mean@", else the
    first name with "mean@". ``log``: ``step, name, value, ord``, one row per step and metric.
    """
    run, name = list(run), F.col("name")
    if explicit is not None:
        chosen = log.filter(name == explicit)
    else:
        rank = F.when(name.contains("val-core"), 0).otherwise(1)
        first = log.filter(name.contains("mean@")).groupBy(*run).agg(F.min(F.struct(rank.alias("r"), "ord", "name")).alias("c"))
        chosen = log.join(first.select(*run, F.col("c.name").alias("name")), [*run, "name"])
    # one row per step of a run
    before = Window.partitionBy(*run).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    top = F.max("value").over(before)
    return chosen.select(*run, "step", "name", "value", (top.isNull() | (F.col("value") > top)).alias("is_best"))


# fixed values: markers of a logged test result
ERROR_PREFIX = "Error: "
TIMEOUT = "Time out"
INCORRECT_FORMAT = "Incorrect format"


def test_results(records: DataFrame, extra: DataFrame | None = None, sparse: bool = True) -> DataFrame:
    """Logged test records (``sample_id, test_idx, passed, actual``) to one score row per response.

    ``extra``: ``sample_id, truncated``. With ``sparse`` the score is 1 only if all tests pass.
    """
    ok, actual = F.col("passed"), F.col("actual")
    g = records.groupBy("sample_id").agg(
        F.avg(ok.cast("double")).alias("acc"),
        F.bool_and(ok).alias("__all"),
        F.avg((~ok & (actual == TIMEOUT)).cast("double")).alias("timed_out"),
        F.max((~ok & actual.contains(ERROR_PREFIX)).cast("int")).alias("error_in_test_cases"),
        F.count(F.lit(1)).alias("__n"),
        F.max((~ok & (actual == INCORRECT_FORMAT)).cast("int")).alias("__f"),
    )
    g = g.withColumn("incorrect_format", F.when(F.col("__n") == 1, F.col("__f")).otherwise(0))
    g = g.withColumn("score", F.col("__all").cast("double") if sparse else F.col("acc"))
    if extra is None:
        g = g.withColumn("truncated", F.lit(0))
    else:
        g = g.join(extra.select("sample_id", F.col("truncated").cast("int").alias("truncated")), "sample_id", "left").fillna({"truncated": 0})
    missing = F.col("incorrect_format") * F.col("truncated")
    return g.withColumn("truncated_and_missing_answer", missing).drop("__all", "__n", "__f")
