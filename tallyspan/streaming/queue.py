"""Replay of a bounded sample queue from its event log: sizes, drops, fates, staleness, stalls.

The log has one row per event: a unique ``seq``, ``op`` (1 put, -1 get, 0 other) and, where versions
matter, ``bump`` (1 when the parameter version goes up). A put into a full queue drops the oldest
sample. The log holds completed gets, so a get from an empty queue is counted and changes nothing.

One event maps the size x to min(max(x + a, lo), hi). Such maps stay of that form when composed, so
blocks of a queue are summed up on their own, their summaries are chained, and the blocks are
replayed side by side: a single queue with most of the log does not run in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.spread import SCAN_BLOCK, affine_scan, attach_table, durable, has_long_groups, packed, ranked

_MAP = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "lo", "hi")])


def _summary(capacity: int):
    @F.pandas_udf(_MAP)
    def run(ops: pd.Series) -> pd.DataFrame:
        out = []
        for block in ops:
            a, lo, hi = 0, 0, capacity
            for op in block:
                a, lo, hi = a + op, min(max(lo + op, 0), capacity), min(max(hi + op, 0), capacity)
            out.append((a, lo, hi))
        return pd.DataFrame(out, columns=["a", "lo", "hi"])

    return run


@F.pandas_udf(T.ArrayType(T.LongType()))
def _starts(a: pd.Series, lo: pd.Series, hi: pd.Series, held: pd.Series) -> pd.Series:
    def one(a_s, lo_s, hi_s, size):
        found = []
        for x, low, high in zip(a_s, lo_s, hi_s, strict=True):
            found.append(size)
            size = min(max(size + x, low), high)
        return found

    return pd.Series([one(*row) for row in zip(a, lo, hi, held.astype(int), strict=True)])


def _replay(capacity: int):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def run(ops: pd.Series, start: pd.Series) -> pd.Series:
        def one(block, size):
            before = np.empty(len(block), dtype=np.int64)
            for i, op in enumerate(block):
                before[i] = size
                size = min(max(size + op, 0), capacity)
            return before

        return pd.Series([one(b, int(s)) for b, s in zip(ops, start, strict=True)])

    return run


def replay(log: DataFrame, queue: Sequence[str], capacity: int, block: int = SCAN_BLOCK, held: DataFrame | None = None) -> DataFrame:
    """Add ``pos`` and the queue size before and after each event, and whether it dropped or took a sample.

    Queues begin empty, or with the size in ``held`` (``queue_size``, at most one row a queue).
    """
    queue = list(queue)
    r = ranked(log, queue, ["seq"], "pos")
    carried = [c for c in r.columns if c not in queue and c != "pos"]
    blocks = packed(r, queue, "pos", carried, "__rows", block)
    blocks = blocks.withColumn("__ops", F.transform("__rows", lambda x: x["op"].cast("long")))
    if has_long_groups(log, queue, block):
        blocks = durable(blocks)  # read twice below
        heads = blocks.select(*queue, "page", _summary(capacity)("__ops").alias("m"))
        chain = _with_held(heads.groupBy(*queue).agg(F.array_sort(F.collect_list(F.struct("page", "m"))).alias("l")), queue, held)
        parts = [_pick(n) for n in ("a", "lo", "hi")]
        chain = chain.select(*queue, F.transform("l", lambda x: x["page"]).alias("__page"), _starts(*parts, "__held").alias("start"))
        starts = chain.select(*[F.col(k).alias("__k_" + k) for k in queue], F.inline(F.arrays_zip("__page", "start")))
        same = [blocks[k].eqNullSafe(starts["__k_" + k]) for k in queue]
        blocks = blocks.join(starts, [*same, blocks["page"] == starts["__page"]])
    else:
        blocks = _with_held(blocks, queue, held).withColumnRenamed("__held", "start")
    blocks = blocks.withColumn("__before", _replay(capacity)("__ops", "start"))
    z = blocks.select(*queue, F.explode(F.arrays_zip("__rows", "__before")).alias("z"))
    d = z.select(
        *queue, F.col("z.__rows.pos").alias("pos"), *[F.col(f"z.__rows.{c}").alias(c) for c in carried], F.col("z.__before").alias("size_before")
    )
    put, got = F.col("op") > 0, F.col("op") < 0
    return (
        d.withColumn("dropped", put & (F.col("size_before") >= capacity))
        .withColumn("took", got & (F.col("size_before") > 0))
        .withColumn("size_after", F.least(F.greatest(F.col("size_before") + F.col("op"), F.lit(0)), F.lit(capacity)).cast("long"))
    )


def _with_held(df: DataFrame, queue: list[str], held: DataFrame | None) -> DataFrame:
    """Add ``__held``, the size at which a queue begins."""
    if held is None:
        return df.withColumn("__held", F.lit(0).cast("long"))
    d = attach_table(df, queue, held, ["queue_size"])
    return d.withColumn("__held", F.coalesce("queue_size", F.lit(0)).cast("long")).drop("queue_size")


def _pick(name: str):
    return F.transform("l", lambda x: x["m"][name])


def statistics(replayed: DataFrame, queue: Sequence[str]) -> DataFrame:
    """Counters of each queue at the end of its log."""
    return replayed.groupBy(*queue).agg(
        F.count_if(F.col("op") > 0).alias("produced"),
        F.count_if("took").alias("consumed"),
        F.count_if("dropped").alias("dropped"),
        F.count_if((F.col("op") < 0) & ~F.col("took")).alias("empty_gets"),
        F.max_by("size_after", "pos").alias("queue_size"),
    )


def fates(replayed: DataFrame, queue: Sequence[str]) -> DataFrame:
    """What became of each put: ``put_seq, out_seq, fate`` (consumed, dropped or queued).

    Samples leave in the order they came, so the n-th put leaves with the n-th removal.
    """
    queue = list(queue)
    gone = F.col("dropped") | F.col("took")
    one = F.lit(1.0)
    counted = affine_scan(
        replayed, queue, "pos", {"__in": (one, (F.col("op") > 0).cast("int"), False), "__out": (one, gone.cast("int"), False)}
    )
    puts = counted.filter("op > 0").select(*queue, F.col("__in").cast("long").alias("__n"), F.col("seq").alias("put_seq"))
    outs = counted.filter(gone).select(
        *queue, F.col("__out").cast("long").alias("__n"), F.col("seq").alias("out_seq"), F.col("took").alias("__took")
    )
    d = puts.join(outs, [*queue, "__n"], "left")
    fate = F.when(F.col("__took"), "consumed").when(F.col("out_seq").isNotNull(), "dropped").otherwise("queued")
    return d.select(*queue, "put_seq", "out_seq", fate.alias("fate"))


def with_version(log: DataFrame, queue: Sequence[str]) -> DataFrame:
    """Add ``version``: the number of bumps up to and including each event."""
    queue = list(queue)
    r = ranked(log, queue, ["seq"], "__vp")
    d = affine_scan(r, queue, "__vp", {"__v": (F.lit(1.0), F.col("bump"), False)})
    return d.withColumn("version", F.col("__v").cast("long")).drop("__vp", "__v", "__v__x")


def staleness(replayed: DataFrame, queue: Sequence[str]) -> DataFrame:
    """Consumed and stale samples per version, and the stale ones up to it.

    A sample is stale when it is consumed at least one version after it was put. ``replayed`` has ``version``.
    """
    queue = list(queue)
    done = fates(replayed, queue).filter("fate = 'consumed'")
    made = replayed.select(*queue, F.col("seq").alias("put_seq"), F.col("version").alias("__made"))
    used = replayed.select(*queue, F.col("seq").alias("out_seq"), "version")
    d = done.join(made, [*queue, "put_seq"]).join(used, [*queue, "out_seq"])
    per = d.groupBy(*queue, "version").agg(
        F.count(F.lit(1)).alias("consumed"), F.count_if(F.col("version") - F.col("__made") >= 1).alias("stale")
    )
    # one row per version
    return _running(per, queue, "version", "stale", "stale_total")


def _running(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    r = ranked(df, keys, [order], "__rp")
    d = affine_scan(r, keys, "__rp", {"__c": (F.lit(1.0), F.col(value), False)})
    return d.withColumn(out, F.col("__c").cast("long")).drop("__rp", "__c", "__c__x")


def stalls(
    replayed: DataFrame, queue: Sequence[str], capacity: int, required: int, threshold: float, sync_steps: int, in_flight: int = 0
) -> DataFrame:
    """Producer stalls: add ``stale_samples``, ``paused`` and the reason.

    The producer pauses while the queue is full or while the samples made since the last version,
    counted from those in flight or queued at the bump, reach required * (threshold + 1) * sync_steps.
    """
    queue = list(queue)
    limit = int(required * (threshold + 1) * sync_steps)
    keys = [*queue, "version"]
    bumps = replayed.filter("bump = 1").select(*keys, (F.col("size_after") + in_flight).alias("__base"))
    r = ranked(replayed, keys, ["pos"], "__vp")
    r = affine_scan(r, keys, "__vp", {"__puts": (F.lit(1.0), (F.col("op") > 0).cast("int"), False)})
    # one row per version: as many as bumps
    r = r.join(bumps, keys, "left")
    stale = (F.coalesce("__base", F.lit(0)) + F.col("__puts")).cast("long")
    full = F.col("size_after") >= capacity
    r = r.withColumn("stale_samples", stale)
    r = r.withColumn("reason", F.when(full, "queue full").when(F.col("stale_samples") >= limit, "stale samples"))
    return r.withColumn("paused", F.col("reason").isNotNull()).drop("__vp", "__puts", "__puts__x", "__base")


def idle_ratios(stalled: DataFrame, queue: Sequence[str], seconds: str = "seconds") -> DataFrame:
    """Per version that paused: ``active`` time up to the first pause, ``total`` time to the next version, idle ratio.

    The last version has no end and is left out. A version that ends in the second it began has the ratio of
    floating point numbers: NaN, or an infinity where its first pause bears another second.
    """
    queue = list(queue)
    per = stalled.groupBy(*queue, "version").agg(
        F.min_by(seconds, "pos").alias("start"), F.min(F.when(F.col("paused"), F.struct("pos", F.col(seconds).alias("s")))).alias("p")
    )
    ends = per.select(*queue, (F.col("version") - 1).alias("version"), F.col("start").alias("end"))
    d = per.join(ends, [*queue, "version"]).filter("p IS NOT NULL")
    active, total = F.col("p.s") - F.col("start"), F.col("end") - F.col("start")
    endless = F.when(active == 0, F.lit(float("nan"))).when(active > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    share = F.when((total == 0) & active.isNotNull(), endless).otherwise(F.try_divide(active, total))
    return d.select(*queue, "version", active.alias("active"), total.alias("total"), (1 - share).alias("idle_ratio"))


def assemble(samples: DataFrame, queue: Sequence[str], order: str, require_batches: int, mini_batch: int) -> DataFrame:
    """Training batches of ``require_batches * mini_batch`` samples in order; the incomplete last one waits."""
    from tallyspan.spread import attach

    size = require_batches * mini_batch
    r = attach(ranked(samples, list(queue), [order], "__k"), list(queue), __n=F.count(F.lit(1)))
    r = r.withColumn("train_batch", F.floor((F.col("__k") - 1) / size)).withColumn("slot", (F.col("__k") - 1) % size)
    return r.filter(F.col("train_batch") < F.floor(F.col("__n") / size)).drop("__k", "__n")


def readiness(arrivals: DataFrame, sample: str, tasks: dict[str, Sequence[str]], order: str = "seq") -> DataFrame:
    """``task, ready_seq`` per sample: when the last of the fields that the task needs arrived."""
    first = arrivals.groupBy(sample, "field").agg(F.min(order).alias("__at"))
    needs = F.array(*[F.struct(F.lit(t).alias("task"), F.array(*[F.lit(f) for f in fs]).alias("fields")) for t, fs in tasks.items()])
    per = first.withColumn("__t", F.explode(F.filter(needs, lambda n: F.array_contains(n["fields"], F.col("field")))))
    done = per.groupBy(sample, F.col("__t.task").alias("task"), F.size("__t.fields").alias("__need")).agg(
        F.count(F.lit(1)).alias("__have"), F.max("__at").alias("ready_seq")
    )
    return done.filter(F.col("__have") == F.col("__need")).select(sample, "task", "ready_seq")
