"""Row selection by thresholds, exact splits and resampling, at their edges."""

import datetime as dt
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import filters as X


def number_rows():
    rng = random.Random(4)
    values = [rng.choice([None, 0.0, 1.5, -2.0, 1e300, -1e300, float("inf"), float("-inf"), 7.25]) for _ in range(60)]
    return [(i, v) for i, v in enumerate(values)]


@pytest.mark.parametrize("count", [0, 1, 7, 59, 60, 500])
def test_first_rows_of_ties_nulls_and_infinities(spark, count):
    rows = number_rows()
    df = spark.createDataFrame(rows, "id long, v double")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0]))[:count]
    assert sorted(r["id"] for r in X.first_rows(df, ["v", "id"], count).collect()) == sorted(i for i, _ in want)


def test_first_rows_by_columns_of_other_types(spark):
    rng = random.Random(1)
    words = ["", "a", "ab", "abcdefgh1", "abcdefgh0", "é", "zz", "\U0001f600"]
    rows = [(i, rng.choice(words), rng.randrange(10**15), dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(900)), dt.datetime(2020, 1, 1) + dt.timedelta(seconds=rng.randrange(10**6))) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, s string, n long, d date, t timestamp")
    for at, c in ((1, "s"), (2, "n"), (3, "d"), (4, "t")):
        key = (lambda r: (r[1].encode(), r[0])) if c == "s" else (lambda r: (r[at], r[0]))
        for count in (1, 30, 199):
            assert sorted(r["id"] for r in X.first_rows(df, [c, "id"], count).collect()) == sorted(r[0] for r in sorted(rows, key=key)[:count])
    assert X.first_rows(df.limit(0), ["s"], 5).count() == 0


def test_random_rows_and_exact_split_take_the_least_hashes(spark):
    df = spark.range(300).select(F.col("id").alias("k"))
    by_hash = sorted(range(300), key=lambda i: (hashlib.md5(f"9:{i}".encode()).hexdigest(), i))
    for count in (0, 1, 37, 300, 400):
        assert sorted(r["k"] for r in X.random_rows(df, "k", count, 9).collect()) == sorted(by_hash[:count])
    test = X.exact_split(df, "k", 0.11, 9).filter("split = 'test'").collect()
    assert sorted(r["k"] for r in test) == sorted(by_hash[:33])
    # rows of one key are taken one by one
    same = spark.createDataFrame([(1,)] * 50, "k long")
    assert X.random_rows(same, "k", 20, 9).count() == 20


def test_no_whole_table_sort_for_a_few_rows(spark):
    df = spark.range(10_000).select(F.col("id").alias("k"))
    plan = X.random_rows(df, "k", 5, 1)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("parts", ["1", "7"])
def test_a_row_of_half_the_weight_is_drawn_half_the_time(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        n = 2_000
        rows = [(b, i, (n - 1.0) ** 0.5 if i == 700 else 1.0, f"t{i}") for b in (1, 2) for i in range(n)]
        df = spark.createDataFrame(rows, "b int, id long, s double, text string")
        got = X.resample(df, ["b"], "id", "s").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted((r["b"], r["draw"]) for r in got) == [(b, d) for b in (1, 2) for d in range(1, n + 1)]
    assert all(r["text"] == f"t{r['id']}" for r in got)
    # every draw by hand
    def taken(b):
        total = 2 * (n - 1.0) + n * 1e-8
        out = []
        for d in range(1, n + 1):
            u = int(hashlib.md5(f"0:{b}:{d}".encode()).hexdigest()[:12], 16) / 16.0**12 * total
            low = min(int(u / (1 + 1e-8)), 700)
            at = low if u < 700 * (1 + 1e-8) else 700 if u < 700 * (1 + 1e-8) + n - 1 + 1e-8 else 701 + int((u - 700 * (1 + 1e-8) - (n - 1 + 1e-8)) / (1 + 1e-8))
            out.append(at)
        return out

    for b in (1, 2):
        mine = {r["draw"]: r["id"] for r in got if r["b"] == b}
        assert [mine[d] for d in range(1, n + 1)] == taken(b)
        assert abs(Counter(mine.values())[700] - n / 2) < 150


def test_resampling_edges(spark):
    schema = "b int, id long, s double"
    assert X.resample(spark.createDataFrame([], schema), ["b"], "id", "s").count() == 0
    alone = X.resample(spark.createDataFrame([(1, 5, 0.0)], schema), ["b"], "id", "s").collect()
    assert [(r["id"], r["draw"]) for r in alone] == [(5, 1)]
    flat = X.resample(spark.createDataFrame([(1, i, 0.0) for i in range(30)], schema), ["b"], "id", "s", "max_min").collect()
    assert len(flat) == 30 and len({r["id"] for r in flat}) > 10
