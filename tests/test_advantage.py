"""Edge rules of the estimators: singletons, constant groups, masks, long responses."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.operators import advantage as A
from tallyspan.operators import masked as M


def responses(spark, scores):
    rows = [(i, uid, 1, float(s), 2) for i, (uid, s) in enumerate(scores)]
    return spark.createDataFrame(rows, "sample_id long, uid long, step int, score double, n_valid long")


def adv(df):
    return [r["adv"] for r in df.orderBy("sample_id").collect()]


def test_singletons_differ_per_estimator(spark):
    one = responses(spark, [(1, 3.0)])
    assert adv(A.grpo(one)) == [pytest.approx(3.0 / (1 + 1e-6))]
    assert adv(A.rloo(one)) == [3.0]
    assert adv(A.rloo_vectorised(one)) == [0.0]
    assert adv(A.opo(one)) == [3.0]
    assert adv(A.grpo_passk(one, singleton="null")) == [None]
    with pytest.raises(Exception, match="two responses"):
        A.grpo_passk(one).collect()


def test_constant_and_tied_groups(spark):
    same = responses(spark, [(1, 2.0), (1, 2.0), (2, 1.0), (2, 1.0), (2, 0.0)])
    assert adv(A.grpo(same))[:2] == [0.0, 0.0]
    got = adv(A.grpo_passk(same, normalise=False))
    assert got == [0.0, 0.0, 0.0, 0.0, 0.0]


def test_loop_and_vectorised_forms_agree_for_groups_of_two_or_more(spark):
    rng = random.Random(0)
    df = responses(spark, [(i % 5, rng.gauss(0, 1)) for i in range(64)])
    np.testing.assert_allclose(adv(A.rloo(df)), adv(A.rloo_vectorised(df)), rtol=1e-9)
    np.testing.assert_allclose(adv(A.grpo(df)), adv(A.grpo_vectorised(df)), rtol=1e-5)


def test_registry(spark):
    assert {"grpo", "rloo", "gae", "remax", "optimal_token_baseline"} <= set(A.ESTIMATORS)
    with pytest.raises(ValueError, match="unknown estimator"):
        A.advantage("none", None)


REWARDS = [0, 0, 0.1, 0.1, 0.1, 0, 0, 0.1, 1, 0, 0]
MASK = [0, 0, 1, 1, 1, 0, 0, 1, 1, 0, 0]


def token_rows(spark, values):
    rows = [(1, 1, i + 1, float(r), float(v), m) for i, (r, v, m) in enumerate(zip(REWARDS, values, MASK))]
    return spark.createDataFrame(rows, "sample_id long, step int, pos long, reward double, value double, mask int")


def test_gae_ignores_values_of_masked_tokens(spark):
    rng = random.Random(3)
    first = [rng.random() for _ in MASK]
    second = [v if m else rng.random() * 9 for v, m in zip(first, MASK)]
    out = []
    for values in (first, second):
        rows = A.gae(token_rows(spark, values), gamma=0.9, lam=0.8).orderBy("pos").collect()
        out.append([r["adv"] for r in rows])
    np.testing.assert_allclose(out[0], out[1], atol=1e-9)
    # masked tokens hold the carried value of the next valid token
    assert out[0][0] == pytest.approx(out[0][2]) and out[0][5] == pytest.approx(out[0][7])


def test_gae_against_a_loop(spark):
    values = [0.3, 0.1, 0.5, 0.2, 0.4, 0.9, 0.6, 0.7, 0.8, 0.2, 0.1]
    nxt = carry = 0.0
    want = []
    for r, v, m in list(zip(REWARDS, values, MASK))[::-1]:
        delta = r + 0.9 * nxt - v
        carry = delta + 0.72 * carry if m else carry
        nxt = v if m else nxt
        want.insert(0, carry)
    rows = A.gae(token_rows(spark, values), gamma=0.9, lam=0.8).orderBy("pos").collect()
    np.testing.assert_allclose([r["ret"] for r in rows], np.array(want) + values, atol=1e-9)
    w = np.array(want)[np.array(MASK) == 1]
    np.testing.assert_allclose([r["adv"] for r in rows], (np.array(want) - w.mean()) / math.sqrt(w.var(ddof=1) + 1e-8), atol=1e-6)


def test_masked_average_of_nothing_is_zero_and_variance_is_null(spark):
    df = spark.createDataFrame([(1, float("nan"), 0), (1, 2.0, 0), (2, 3.0, 1), (2, float("nan"), 0)], "b int, v double, m int")
    got = {r["b"]: r for r in M.masked_stats(df, ["b"], "v", "m").collect()}
    assert got[1]["mean"] == 0.0 and got[1]["var"] is None
    assert got[2]["mean"] == pytest.approx(3.0) and got[2]["var"] is None


def test_zero_tail_beyond_the_second_longest(spark):
    rows = [(1, p, 1.0, -0.5, 0.2, 1) for p in (1, 2, 3)] + [(2, 1, 0.5, -0.4, 0.2, 1)]
    t = spark.createDataFrame(rows, "sample_id long, pos long, reward double, old_logp double, sum_pi2 double, mask int")
    r = spark.createDataFrame([(1, 7), (2, 7)], "sample_id long, uid long")
    got = {(x["sample_id"], x["pos"]): x["adv"] for x in A.optimal_token_baseline(t, r, zero_tail=True).collect()}
    assert got[(1, 2)] == pytest.approx(2.0) and got[(1, 3)] == pytest.approx(1.0)
    plain = {(x["sample_id"], x["pos"]): x["adv"] for x in A.optimal_token_baseline(t, r).collect()}
    assert plain[(1, 2)] == pytest.approx(0.0, abs=1e-6)


def test_span_mask(spark):
    df = spark.sql("SELECT array(named_struct('n', 2, 'generated', true), named_struct('n', 3, 'generated', false)) AS s")
    assert df.select(A.span_mask(F.col("s"))).first()[0] == [1, 1, 0, 0, 0]
