"""Metric rules by name, votes, closed forms, off-policy edges."""

import hashlib
import itertools
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyspan.functions import digests, draws
from tallyspan.operators import metrics as M
from tallyspan.operators import offpolicy as O
from tallyspan.operators import reports as R
from tallyspan.plans import metrics


def test_reduction_is_a_substring_rule(spark):
    rows = [("loss", 1.0), ("loss", 3.0), ("max_reward", 5.0), ("max_reward", 8.0), ("timing_per_token_ms/x", 2.0), ("timing_per_token_ms/x", 4.0)]
    got = {r["name"]: r["value"] for r in M.reduce_by_name(spark.createDataFrame(rows, "name string, value double"), []).collect()}
    assert got == {"loss": 2.0, "max_reward": 8.0, "timing_per_token_ms/x": 2.0}


def test_step_rules(spark):
    names = ["weighted_avg_x", "timing_s/max", "perf/time_per_step", "training/global_step", "a/min", "total_x", "timing_per_token_ms/x"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", M.step_rule(F.col("n")).alias("r"))
    got = {r["n"]: r["r"] for r in df.collect()}
    assert got == {
        "weighted_avg_x": "avg", "timing_s/max": "time_sum", "perf/time_per_step": "time_sum", "training/global_step": "last",
        "a/min": "min", "total_x": "sum", "timing_per_token_ms/x": "min",
    }


def test_mixed_kinds_are_an_error(spark):
    df = spark.createDataFrame([("a", "sum", 1.0), ("a", "max", 2.0)], "name string, kind string, value double")
    with pytest.raises(Exception, match="two reductions"):
        M.accumulate(df, []).collect()


def test_best_of_matches_draws(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0]
    df = spark.createDataFrame([("s", 1, i, "p", "acc", v) for i, v in enumerate(vals)], "data_source string, uid long, sample_id long, pred string, var string, val double")
    got = {r["metric"]: r["value"] for r in M.best_of_metrics(df).collect()}
    draws = np.random.default_rng(0).choice(vals, size=(200_000, 4))
    assert got["best@4/mean"] == pytest.approx(draws.max(axis=1).mean(), abs=0.01)
    assert got["worst@4/std"] == pytest.approx(draws.min(axis=1).std(), abs=0.01)
    assert set(got) == {f"{w}@{k}/{s}" for w in ("best", "worst") for k in (2, 4, 5) for s in ("mean", "std")}


def test_majority_vote(spark):
    rows = [(1, 1, "A", 0.9), (1, 2, "B", 0.8), (1, 3, "A", 0.7), (2, 1, "B", 0.1), (2, 2, "A", 0.2)]
    got = {r["uid"]: (r["pred"], r["value"]) for r in M.majority_of_all(spark.createDataFrame(rows, "uid int, sample_id long, pred string, s double"), "s").collect()}
    assert got == {1: ("A", 0.9), 2: ("B", 0.1)}


def vote_law(members, k):
    """Mean and std of the value of a vote, over all ways to draw k of the members in order."""
    values = []
    for drawn in itertools.product(members, repeat=k):
        count = Counter(p for p, _ in drawn)
        values.append(next(v for p, v in drawn if count[p] == max(count.values())))
    return np.mean(values), np.std(values)


def test_majority_draws_follow_the_law_of_votes(spark):
    groups = {"a": [("x", 1.0), ("y", 2.0), ("x", 4.0), (None, 8.0), ("z", 16.0)], "b" * 60: [("x", 1.0), ("y", 5.0), ("z", 7.0)], "c": [("x", 3.0), ("x", 4.0), ("x", 8.0)]}
    rows = [("s", u, i, p, var, v * f) for u, g in groups.items() for i, (p, v) in enumerate(g) for var, f in (("acc", 1), ("score", -3))]
    df = spark.createDataFrame(rows, "data_source string, uid string, sample_id long, pred string, var string, val double")
    got = {(r["uid"], r["var"], r["metric"]): r["value"] for r in M.majority_metrics(df, draws=20_000).collect()}
    for uid, sizes in (("a", (4, 5)), ("b" * 60, (3,)), ("c", (3,))):
        for k in sizes:
            mean, std = vote_law(groups[uid], k)
            assert got[uid, "acc", f"maj@{k}/mean"] == pytest.approx(mean, abs=5 * std / 20_000**0.5 + 1e-9)
            assert got[uid, "acc", f"maj@{k}/std"] == pytest.approx(std, rel=0.05, abs=1e-9)
            # the variables of a prompt are drawn together
            assert got[uid, "score", f"maj@{k}/mean"] == pytest.approx(-3 * got[uid, "acc", f"maj@{k}/mean"])
    assert len(got) == 2 * 2 * (3 + 2 + 2)


def test_votes_of_a_large_prompt_cost_its_classes():
    """A million responses in four classes: the counts of a draw are binomial, whatever k is."""
    counts, k = [400_000, 300_000, 299_000, 1_000], 1_000_000
    winner, member = draws.votes("x", counts, k, 1, 2_001)
    assert (winner == 0).all() and 0 <= member.min() and member.max() < 400_000 and member.std() > 100_000
    close, _ = draws.votes("y", [500_000, 500_000], k, 1, 2_001)
    assert abs(close.mean() - 0.5) < 0.06
    x = draws.binomials(np.full(4_000, k), 300_000, k, (np.arange(4_000) + 0.5) / 4_000)
    assert abs(x.mean() - 300_000) < 5 and abs(x.std() - (k * 0.3 * 0.7) ** 0.5) < 5
    small = draws.binomials(np.full(8, 3), 1, 2, (np.arange(8) + 0.5) / 8)
    assert small.tolist() == [0, 1, 1, 1, 2, 2, 2, 3]


@pytest.mark.parametrize("array_rows", [0, 100])
def test_every_vote_draws_its_responses(spark, array_rows):
    """Slot by slot by the md5 numbers of the SQL, with four classes and one of them null; small and large prompts."""
    import hashlib

    groups = {"a": [("x", 1.0), ("y", 2.0), ("x", 4.0), (None, 8.0), ("z", 16.0), ("w", 32.0)], "b": [("x", 3.0), ("y", None), ("x", 7.0)]}
    rows = [(s, u, i, p, "acc", v) for s in ("s", "t") for u, g in groups.items() for i, (p, v) in enumerate(g)]
    df = spark.createDataFrame(rows, "data_source string, uid string, sample_id long, pred string, var string, val double")
    got = {(r["data_source"], r["uid"], r["metric"]): r["value"] for r in M.majority_metrics(df, draws=200, array_rows=array_rows).collect()}
    for (uid, g), k in [(x, k) for x in groups.items() for k in ((4, 6) if len(x[1]) == 6 else (3,))]:
        values = []
        for draw in range(1, 201):
            heads = [hashlib.md5(f"42:{uid}:{k}:{draw}:{slot}".encode()).hexdigest()[:12] for slot in range(1, k + 1)]
            drawn = [g[int(int(h, 16) / 16**12 * len(g))] for h in heads]
            count = Counter(p for p, _ in drawn)
            values.append(next(v for p, v in drawn if count[p] == max(count.values())))
        values = [v for v in values if v is not None]
        for source in "st":
            assert got[source, uid, f"maj@{k}/mean"] == pytest.approx(np.mean(values))
            assert got[source, uid, f"maj@{k}/std"] == pytest.approx(np.std(values))
    assert len(got) == 2 * (3 * 2 + 2 * 2)


def test_digests_of_many_texts_are_md5():
    """Starts of any length: endings that begin within a word, fill a block to the last byte or reach into the next."""
    for length in (*range(70), *range(110, 134), 200):
        starts = [bytes((7 * i + 31 * j + length) % 256 for i in range(length)) for j in range(3)]
        for k, first, last in ((11, 1, 12), (2, 98, 102), (1, 999, 1_001)):
            want = [[[int(hashlib.md5(s + b"%d:%d" % (d, slot)).hexdigest()[:12], 16) for d in range(first, last)] for slot in range(1, k + 1)] for s in starts]
            assert digests.heads(starts, k, first, last).tolist() == want


@pytest.mark.parametrize("together", [1 << 14, 60])
def test_ballots_of_a_batch_are_those_of_each_prompt(monkeypatch, together):
    monkeypatch.setattr(draws.Ballots, "TOGETHER", together)
    rng = np.random.default_rng(1)
    texts = [t for t in ("7", "8", "12", "\u00e9" * 30, "x" * 70) for _ in range(4)] + ["", "5"]
    codes = draws.classes(rng.integers(0, 5, sum(ns := [*rng.integers(1, 20, 20).tolist(), 3, 40])), np.array(ns))
    assert [len(c) for c in codes] == ns and all(set(c.tolist()) == set(range(c.max() + 1)) for c in codes)
    got = {(at, k): won.tolist() for at, k, won in draws.Ballots(42, 15).of(texts, codes)}
    assert set(got) == {(at, k) for at, n in enumerate(ns) for k in draws.sizes(n)}
    for (at, k), won in got.items():
        want, c = [0] * ns[at], codes[at].tolist()
        for draw in range(1, 16):
            heads = [hashlib.md5(f"42:{texts[at]}:{k}:{draw}:{slot}".encode()).hexdigest()[:12] for slot in range(1, k + 1)]
            drawn = [int(int(h, 16) / 16**12 * ns[at]) for h in heads]
            count = Counter(c[i] for i in drawn)
            want[next(i for i in drawn if count[c[i]] == max(count.values()))] += 1
        assert won == want


def test_votes_take_less_time_than_a_call_for_each_digest():
    """80 prompts of four responses: 320,000 drawn responses; one call each is most of the time of a vote."""
    ends = [b"%d:%d" % (draw, slot) for draw in range(1, 1_001) for slot in range(1, 5)]
    texts, codes = [str(100 + i) for i in range(80)], [np.array([0, 1, 1, 2])] * 80

    def calls():
        for text in texts:
            start = hashlib.md5(f"42:{text}:4:".encode())
            for end in ends:
                h = start.copy()
                h.update(end)
                h.digest()

    def seconds(f):
        start = time.process_time()
        f()
        return time.process_time() - start

    votes = min(seconds(lambda: list(draws.Ballots(42, 1_000).of(texts, codes))) for _ in range(3))
    assert votes < 0.75 * min(seconds(calls) for _ in range(3))


def test_majority_query_makes_all_draws(spark, sf):
    whole = M.over_prompts(M.majority_metrics(metrics.validation_vars(spark, sf))).collect()
    got = {tuple(r)[:3]: r["value"] for r in entry.queries()["validation_majority"](spark, sf).collect()}
    assert got == {tuple(r)[:3]: pytest.approx(r["value"], abs=2e-6) for r in whole}


def test_singleton_has_no_spread(spark):
    df = spark.createDataFrame([("s", 1, 1, "p", "acc", 0.5)], "data_source string, uid long, sample_id long, pred string, var string, val double")
    assert [r["metric"] for r in M.mean_metrics(df).collect()] == ["mean@1"]
    assert M.best_of_metrics(df).isEmpty()


def test_all_aborted_is_an_error(spark):
    r = spark.createDataFrame([(1, 5, 1)], "sample_id long, prompt_length long, step int")
    t = spark.createDataFrame([], "sample_id long, mask int, score double, reward double, adv double, ret double, value double")
    with pytest.raises(Exception, match="aborted"):
        M.batch_metrics(r, t.unionByName(spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0, 0.0, 0.0)], t.schema)), ["step"], 9, 9).collect()


def token_table(spark):
    rows = [(1, s, p, 1, -0.5 - 0.1 * p, -0.4 - 0.13 * p * s) for s in (1, 2, 3) for p in range(1, 8)]
    rows += [(1, 4, 1, 0, -1.0, -2.0), (1, 5, 1, 1, -60.0, -1.0)]
    return spark.createDataFrame(rows, "step int, sample_id long, pos int, mask int, old_logp double, rollout_logp double")


def test_every_rejection_option_runs(spark):
    t = token_table(spark)
    for option in O.REJECTION_OPTIONS:
        spec = "0.5_1.5" if option.endswith("k1") else 2.0
        out = O.rejection_mask(t, [option], spec).collect()
        assert len(out) == 23 and all(r["kept_mask"] <= r["mask"] for r in out)


def test_threshold_parsing():
    assert O.parse_thresholds(["token_k1"], 2.0) == {"token_k1": (0.5, 2.0)}
    assert O.parse_thresholds(["token_k1", "seq_max_k2"], "0.5_1.5, 3") == {"token_k1": (0.5, 1.5), "seq_max_k2": (None, 3.0)}
    for options, spec in ((["token_k2"], "1_2"), (["token_k1"], "0_2"), (["a"], 1.0), (["token_k1", "token_k2"], "1,2,3")):
        with pytest.raises(ValueError):
            O.parse_thresholds(options, spec)


def test_weights_are_bounded(spark):
    for level in ("token", "sequence"):
        rows = O.importance_weights(token_table(spark), level, 2.0).collect()
        assert max(r["weight"] for r in rows) <= 2.0
        assert all(r["weight"] == 0.0 for r in rows if r["mask"] == 0)
        # a log-ratio beyond the bound is clamped before exp
        assert min(r["raw_weight"] for r in rows if r["mask"]) == pytest.approx(np.exp(-20.0))


def test_kl_names(spark):
    df = spark.createDataFrame([(-1.0, -2.0)], "p double, q double")
    k = lambda n: df.select(O.kl_estimate(F.col("p"), F.col("q"), n)).first()[0]
    assert k("kl") == k("k1+") == 1.0 and k("mse") == 0.5 and k("low_var_kl") == pytest.approx(np.exp(-1) + 1 - 1)
    with pytest.raises(ValueError):
        k("full")


def test_best_steps_need_strict_improvement(spark):
    rows = [("r", s, "val-aux/x/mean@4", v, 1) for s, v in ((1, 0.1), (2, 0.1), (3, 0.3))]
    rows += [("r", s, "val-core/x/mean@4", v, 2) for s, v in ((1, 0.5), (2, 0.4), (3, 0.5))]
    df = spark.createDataFrame(rows, "run string, step int, name string, value double, ord int")
    assert [r["is_best"] for r in M.best_steps(df, ["run"]).orderBy("step").collect()] == [True, False, False]
    aux = M.best_steps(df, ["run"], explicit="val-aux/x/mean@4").orderBy("step").collect()
    assert [r["is_best"] for r in aux] == [True, False, True]


def test_report_has_all_sections_and_says_what_is_missing(spark):
    mean, best = "val-core/x/acc/mean@16", "val-core/x/acc/best@16/mean"
    rows = [("b", mean, 1, 0.25), ("b", mean, 2, 0.2), ("b", best, 1, 0.5), ("a", "actor/entropy", 1, 2.0), ("a", "actor/entropy", 2, 0.5), ("a", "global_seqlen/mean", 1, 99.6)]
    points = spark.createDataFrame(rows, "experiment string, key string, step long, value double")
    report = R.experiment_report(points, "x")
    got = {(r["title"], r["experiment"], r["name"]): (r["value"], r["text"]) for r in report.collect()}
    assert len({r[0] for r in got}) == 16
    assert got["Accuracy", "b", "mean_best"] == (0.25, "0.2500") and got["Accuracy", "b", "mean_final"] == (0.2, "0.2000")
    assert got["Consistency", "b", "gap"] == (0.25, "0.2500") and got["Consistency", "b", "consistency_pct"] == (50.0, "50.0")
    assert got["Consistency", "a", "gap"] == (None, "N/A") and got["Entropy", "a", "drop"] == (1.5, "1.5000")
    assert got["Response length", "a", "best"] == (99.6, "100")
    assert [(r["line"], r["experiment"]) for r in report.filter("title = 'Ranking' AND place = 0").orderBy("line").collect()] == [(1, "b"), (2, "a")]
    lines = [r["text"] for r in R.report_lines(report).filter("section = 2").orderBy("line").collect()]
    assert lines == ["## 2. Consistency", "| experiment | mean | best_of | gap | consistency_pct |", "| a | N/A | N/A | N/A | N/A |", "| b | 0.2500 | 0.5000 | 0.2500 | 50.0 |"]


def test_staleness_counts_versions_of_logged_samples(spark):
    rows = [("a", 1, 1), ("a", 1, 2), ("a", 0, 2), ("a", 2, 2), ("a", 3, 5), ("b", 7, 7), ("a", None, 2), ("a", 4, None)]
    df = spark.createDataFrame(rows, "q string, made long, used long")
    got = sorted(map(tuple, M.staleness(df, "made", "used", ["q"]).collect()))
    assert got == [("a", 1, 1, 0, 0, 0), ("a", 2, 3, 2, 2, 2), ("a", 5, 1, 1, 2, 3), ("b", 7, 1, 0, 0, 0)]
    assert M.staleness(df.limit(0), "made", "used").count() == 0
