"""The group primitives give the same answers on hot groups and long groups as on ordinary ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan import spread as S


def skewed(spark, n=400):
    """Half of the rows under one key, some under a null key."""
    rng = random.Random(1)
    rows = []
    for i in range(n):
        key = 0 if i % 2 else rng.choice([1, 2, 3, None])
        rows.append((i, key, rng.choice([0.5, 1.0, 2.0]), rng.random()))
    return spark.createDataFrame(rows, "id long, k long, tie double, v double")


def test_attach_gives_every_row_its_group(spark):
    df = skewed(spark)
    aggs = dict(n=F.count("v"), total=F.sum("v"), top=F.max_by("id", "v"))
    own = sorted(S.attach(df, ["k"], **aggs).collect())
    early = sorted(S.attach(df.withColumn("later", F.col("v") * 2), ["k"], of=df, **aggs).drop("later").collect())
    assert len(own) == 400 and own == early
    rows = {}
    for r in own:
        rows.setdefault(r["k"], []).append(r)
    for group in rows.values():  # the null key too
        assert {r["n"] for r in group} == {len(group)}
        assert {r["top"] for r in group} == {max(group, key=lambda r: r["v"])["id"]}


def test_attach_splits_the_partition_of_a_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 40_000, numPartitions=8).select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"))
        got = S.attach(rows, ["k"], n=F.count("id"))
        assert got.filter("k = 0").select("n").distinct().collect()[0][0] == 26_667
        got.write.format("noop").mode("overwrite").save()
        kept = S.attach(rows, ["k"], n=F.count("id"))
        kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_ranked_hot_group(spark):
    df = skewed(spark)
    a = {r["id"]: r["p"] for r in S.ranked(df, ["k"], ["tie", "id"], "p").collect()}
    b = {r["id"]: r["p"] for r in S.ranked(df, ["k"], ["tie", "id"], "p", hot_rows=20).collect()}
    assert a == b and len(a) == 400


def test_dense_index(spark):
    rows = S.dense_index(skewed(spark), ["tie", "id"], "i").orderBy("i").collect()
    assert [r["i"] for r in rows] == list(range(400))
    assert [(r["tie"], r["id"]) for r in rows] == sorted((r["tie"], r["id"]) for r in rows)


def naive_scan(a, b, reverse):
    n, y, nxt = len(a), [0.0] * len(a), [0.0] * len(a)
    carry = 0.0
    for i in reversed(range(n)) if reverse else range(n):
        nxt[i] = carry
        y[i] = carry = b[i] + a[i] * carry
    return y, nxt


def test_affine_scan_blocks_match_a_loop(spark):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for key, n in ((1, 37), (2, 5), (3, 1), (4, 12)):
        a, b = rng.uniform(0, 1, n), rng.normal(size=n)
        a[rng.integers(0, n)] = 0.0
        rows += [(key, i + 1, float(a[i]), float(b[i]), f"x{i}") for i in range(n)]
        want[key] = naive_scan(a, b, True), naive_scan(a, b, False)
    df = spark.createDataFrame(rows, "k long, pos long, a double, b double, tag string")
    scans = {"up": (F.col("a"), F.col("b"), True), "down": (F.col("a"), F.col("b"), False)}
    for block in (5, 4, 100):  # one page, or pages of pages
        got = S.affine_scan(df, ["k"], "pos", scans, block=block).collect()
        assert len(got) == len(rows)
        for r in got:
            i = r["pos"] - 1
            up, down = want[r["k"]]
            assert r["tag"] == f"x{i}"
            np.testing.assert_allclose([r["up"], r["up__x"]], [up[0][i], up[1][i]], atol=1e-12)
            np.testing.assert_allclose([r["down"], r["down__x"]], [down[0][i], down[1][i]], atol=1e-12)


def test_dependent_scans_carry_each_other_through_blocks(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for key, n in ((1, 30), (None, 61), (3, 4)):
        a, b, c, d = (rng.uniform(-1, 1, n) for _ in range(4))
        rows += [(key, i + 1, float(a[i]), float(b[i]), float(c[i]), float(d[i])) for i in range(n)]
        for reverse in (True, False):
            first, beside = naive_scan(a, b, reverse)
            want[key, reverse] = first, naive_scan(c, a + d * np.array(beside), reverse)
    df = spark.createDataFrame(rows, "k long, pos long, a double, b double, c double, d double")
    for reverse in (True, False):
        scans = {"one": (F.col("a"), F.col("b"), reverse), "two": (F.col("c"), F.col("a"), reverse, (F.col("d"), "one"))}
        for block in (4, 1000):
            for r in S.affine_scan(df, ["k"], "pos", scans, block=block).collect():
                one, (two, beside) = want[r["k"], reverse]
                i = r["pos"] - 1
                np.testing.assert_allclose([r["one"], r["two"], r["two__x"]], [one[i], two[i], beside[i]], atol=1e-12)


def test_scan_of_more_blocks_than_its_levels_hold_is_told(spark):
    df = spark.range(1, 30).select(F.lit(1).alias("k"), F.col("id").alias("pos"))
    with pytest.raises(Exception, match="too many rows to scan"):
        S.affine_scan(df, ["k"], "pos", {"y": (F.lit(1.0), F.lit(1.0), True)}, block=3).collect()


def test_packed_pages_hold_every_row(spark):
    df = S.ranked(skewed(spark), ["k"], ["id"], "p")
    pages = S.packed(df, ["k"], "p", ["id"], "rows", block=16)
    assert pages.select(F.max(F.size("rows"))).first()[0] == 16
    assert pages.select(F.explode("rows.id").alias("id")).distinct().count() == 400


def test_quantiles_interpolate(spark):
    df = skewed(spark)
    got = {r["k"]: r for r in S.quantiles(df, ["k"], "v", "id", {"q1": 0.25, "q9": 0.9}).collect()}
    for key in (0, 1, 2, 3):
        v = [r["v"] for r in df.filter(f"k = {key}").collect()]
        np.testing.assert_allclose([got[key]["q1"], got[key]["q9"]], np.percentile(v, [25, 90]))


def test_top_k_limits_before_the_shuffle(spark):
    plan = S.top_k(skewed(spark), ["k"], [F.desc("v")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
