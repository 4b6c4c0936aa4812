"""Batch algebra, filters, balancing and chats on small fixtures."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import algebra as G
from tallyspan.operators import balance as B
from tallyspan.operators import chat as H
from tallyspan.operators import corpus as C
from tallyspan.operators import filters as X
from tallyspan.operators import joins as J


def batch(spark, n=3):
    return spark.createDataFrame([(i, [2 * i + 1, 2 * i + 2], chr(97 + i)) for i in range(n)], "idx long, obs array<int>, labels string")


def labels(df, col="labels"):
    return [r[col] for r in df.orderBy("idx").collect()]


def test_repeat(spark):
    assert labels(G.repeat(batch(spark), 2)) == list("aabbcc")
    assert labels(G.repeat(batch(spark), 2, interleave=False)) == list("abcabc")
    counts = batch(spark).withColumn("times", F.element_at(F.array(F.lit(3), F.lit(0), F.lit(2)), (F.col("idx") + 1).cast("int")))
    assert sorted(r["labels"] for r in G.repeat_rows(counts, "times").collect()) == list("aaacc")


def test_chunks(spark):
    wide = spark.createDataFrame([([1, 2, 3, 4], [5, 6], "a")], "o1 array<int>, o2 array<int>, l string")
    got = [(r["o1"], r["o2"], r["l"]) for r in G.unfold_chunks(wide, 2, ["o1"]).orderBy("chunk").collect()]
    assert got == [([1, 2], [5, 6], "a"), ([3, 4], [5, 6], "a")]
    with pytest.raises(Exception, match="equal chunks"):
        G.chunk(batch(spark), 2).collect()
    assert [r["chunk"] for r in G.chunk(batch(spark), 2, allow_uneven=True).orderBy("idx").collect()] == [0, 0, 1]


def test_pad_runs_several_laps(spark):
    padded = G.pad_to_divisor(batch(spark), 8)
    assert labels(padded) == list("abcabcab")
    assert labels(G.unpad(padded)) == list("abc")
    assert labels(G.pad_with_edge(batch(spark), 2, "last")) == list("abccc")


def test_union_conflicts(spark):
    left = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k long, v double")
    same = spark.createDataFrame([(1, float("nan"), "x"), (2, 1.0, "y")], "k long, v double, w string")
    assert G.union_columns(left, same, "k").count() == 2
    other = spark.createDataFrame([(1, 5.0), (2, 1.0)], "k long, v double")
    with pytest.raises(Exception, match="differs"):
        G.union_columns(left, other, "k").collect()
    with pytest.raises(Exception, match="same rows"):
        G.union_columns(left, other.filter("k = 1").drop("v"), "k").collect()


def test_meta_conflict(spark):
    meta = spark.createDataFrame([(0, "t", "1"), (1, "t", "2")], "part int, key string, value string")
    with pytest.raises(Exception, match="conflicting"):
        G.merge_meta(meta).collect()


def test_fit_array(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],)], "a array<int>")
    fit = lambda **k: df.select(G.fit_array(F.col("a"), k.pop("n"), F.lit(0), **k)).first()[0]
    assert fit(n=3, truncation="middle") == [1, 4, 5]
    assert fit(n=3, truncation="left") == [3, 4, 5]
    assert fit(n=7, left_pad=True) == [0, 0, 1, 2, 3, 4, 5]
    with pytest.raises(Exception, match="exceed"):
        fit(n=3)


def test_mini_batches_need_a_divisible_count(spark):
    with pytest.raises(Exception, match="does not divide"):
        G.mini_batch_plan(batch(spark), "idx", 2, 1, 0).collect()


def test_resample_keeps_the_batch_size(spark):
    df = spark.createDataFrame([(1, i, float(i == 3) * 100) for i in range(10)], "b int, id long, s double")
    got = X.resample(df, ["b"], "id", "s").collect()
    assert len(got) == 10 and {r["id"] for r in got} == {3}


def test_varied_groups(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 1.0), (2, 1.0), (2, 1.0), (3, 1.0)], "u int, m double")
    assert X.varied_groups(df, "u", "m").select("u").distinct().count() == 1
    assert X.varied_groups(df, "u", "m", keep_singletons=True).select("u").distinct().count() == 2


def test_unrenderable_prompt_is_dropped(spark):
    df = spark.createDataFrame([([("user", "hi")],), ([("user", None)],)], "m array<struct<role:string,content:string>>")
    assert X.drop_overlong(df, X.words(X.render_chat(F.col("m"))), 50).count() == 1


@pytest.mark.parametrize("n", [4, 13, 64, 300])
def test_parts_are_level_at_every_size(spark, n):
    df = spark.createDataFrame([(0, i, (i * 37) % 101 + 1) for i in range(n)], "b int, id long, w long")
    got = B.partition_batches(df, ["b"], "w", "id", 4)
    rows = got.groupBy("part").agg(F.count("*").alias("n"), F.sum("w").alias("s")).collect()
    assert sorted(r["part"] for r in rows) == [0, 1, 2, 3] and sum(r["n"] for r in rows) == n
    assert max(r["n"] for r in rows) - min(r["n"] for r in rows) <= 1
    assert max(r["s"] for r in rows) - min(r["s"] for r in rows) <= 101


@pytest.mark.parametrize("n", [3, 40, 4000])
def test_partition_errors_at_every_size(spark, n):
    df = spark.range(n).select(F.lit(0).alias("b"), F.col("id"), (F.col("id") + 1).alias("w"))
    with pytest.raises(Exception, match="cannot fill"):
        B.partition_batches(df, ["b"], "w", "id", n + 1).collect()
    with pytest.raises(Exception, match="equal parts"):
        B.partition_batches(df, ["b"], "w", "id", n - 1, equal_size=True).collect()
    sizes = B.partition_batches(df, [], "w", "id", n, equal_size=True).groupBy("part").count().collect()
    assert len(sizes) == n


def differencing_spread(works, k):
    """Largest differencing on lists, state by state."""
    works = sorted(works, reverse=True)
    works += [0] * (-len(works) % k)
    states = [works[i : i + k] for i in range(0, len(works), k)]
    while len(states) > 1:
        states.sort(key=lambda s: (s[-1] - s[0], -s[0]))
        a, b, *rest = states
        states = [*rest, sorted((x + y for x, y in zip(a, reversed(b))), reverse=True)]
    return states[0]


@pytest.mark.parametrize(("n", "k"), [(8, 8), (13, 4), (300, 7), (1000, 2)])
def test_differencing_merges_the_least_level_states(spark, n, k):
    works = [(i * i * 37) % 1009 + i for i in range(n)]  # no equal spreads
    df = spark.createDataFrame([(0, i, w) for i, w in enumerate(works)], "b int, id long, w long")
    rows = B.partition_by_merging(df, ["b"], "w", "id", k).groupBy("part").agg(F.count("*").alias("n"), F.sum("w").alias("s")).collect()
    sums = [r["s"] for r in sorted(rows)]
    assert sums == differencing_spread(works, k) and [r["part"] for r in sorted(rows)] == list(range(k))
    assert max(r["n"] for r in rows) - min(r["n"] for r in rows) <= 1


@pytest.mark.parametrize("rule", ["differencing", "least_sum"])
def test_merging_blocks_in_levels_keeps_parts_level(spark, monkeypatch, rule):
    monkeypatch.setattr(B, "BLOCK_STATES", 2)
    rows = [(b, (b or 0) * 10_000 + i, (i * 7919) % 501 + 1) for b, n in ((None, 3), (1, 900), (2, 64), (3, 5)) for i in range(n)]
    df = spark.createDataFrame([r for r in rows], "b int, id long, w long")
    got = B.partition_by_merging(df, ["b"], "w", "id", 3, rule=rule)
    assert got.columns == ["b", "id", "w", "part"]
    kept = got.collect()
    assert sorted((r["id"], r["w"]) for r in kept) == sorted((i, w) for _, i, w in rows)
    for b in (None, 1, 2, 3):
        sums = [sum(r["w"] for r in kept if r["b"] == b and r["part"] == p) for p in range(3)]
        assert all(sums) and max(sums) - min(sums) <= 501
        if rule == "differencing" and b == 1:
            dealt = B.partition_batches(df.filter("b = 1"), ["b"], "w", "id", 3).groupBy("part").agg(F.sum("w").alias("s")).collect()
            assert max(sums) - min(sums) <= max(r["s"] for r in dealt) - min(r["s"] for r in dealt)


def test_merging_checks_its_parts(spark):
    df = spark.range(10).select(F.lit(0).alias("b"), F.col("id"), (F.col("id") + 1).alias("w"))
    with pytest.raises(Exception, match="cannot fill"):
        B.partition_by_merging(df, ["b"], "w", "id", 11).collect()
    with pytest.raises(Exception, match="equal parts"):
        B.partition_by_merging(df, [], "w", "id", 4, equal_size=True).collect()
    assert B.partition_by_merging(df.limit(0), ["b"], "w", "id", 2).count() == 0
    assert {r["count"] for r in B.partition_by_merging(df, [], "w", "id", 5, equal_size=True).groupBy("part").count().collect()} == {2}


def test_unsorted_rows_are_dealt_in_input_order(spark):
    df = spark.createDataFrame([(0, i, 9 - i) for i in range(5)], "b int, id long, w long")
    got = B.partition_batches(df, ["b"], "w", "id", 2, sort=False).orderBy("id").collect()
    assert [r["part"] for r in got] == [0, 1, 1, 0, 0]


def test_groups_need_not_divide_evenly(spark):
    df = spark.createDataFrame([(u, 10 * u + j, 5) for u in range(7) for j in range(3)], "uid long, id long, w long")
    got = B.partition_groups(df, [], "uid", "w", 3)
    assert got.count() == 21 and got.groupBy("uid").agg(F.countDistinct("part").alias("c")).filter("c > 1").isEmpty()
    with pytest.raises(Exception, match="cannot fill"):
        B.partition_groups(df, [], "uid", "w", 8).collect()


def test_groups_stay_together(spark):
    rows = [(0, u, u * 10 + j, length) for u, length in enumerate((100, 200, 150, 50)) for j in range(4)]
    df = spark.createDataFrame(rows, "b int, uid long, id long, len long").withColumn("w", B.workload(F.col("len")))
    got = B.partition_groups(df, ["b"], "uid", "w", 2)
    assert got.count() == 16
    assert got.groupBy("uid").agg(F.countDistinct("part").alias("c")).filter("c > 1").isEmpty()
    assert {r["n"] for r in got.select("part", "uid").distinct().groupBy("part").agg(F.count("*").alias("n")).collect()} == {2}


def test_micro_batches(spark):
    df = spark.createDataFrame([(0, i, 100) for i in range(20)], "b int, id long, len long")
    got = B.micro_batches(df, ["b"], "len", "id", 300).groupBy("micro").agg(F.count("*").alias("n")).collect()
    assert sorted(r["micro"] for r in got) == list(range(7)) and sum(r["n"] for r in got) == 20
    with pytest.raises(Exception, match="exceeds the token budget"):
        B.micro_batch_counts(df, ["b"], "len", 50).collect()


def test_sft_loss_mask(spark):
    df = spark.createDataFrame([("a b c", "d e")], "p string, r string")
    r = H.sft_rows(df, "p", "r", 8).first()
    assert r["attention_mask"] == [1, 1, 1, 1, 1, 1, 0, 0]
    # the last prompt token predicts the first response token; the last response token predicts nothing
    assert r["loss_mask"] == [0, 0, 1, 1, 1, 0, 0, 0]
    assert r["position_ids"] == [0, 1, 2, 3, 4, 5, 5, 5]


def test_every_option_is_lettered(spark):
    df = spark.createDataFrame([("q", [f"o{i}" for i in range(20)], "s")], "q string, o array<string>, s string")
    prompt = lambda d: d.select(C.lettered_choice_prompt(F.col("q"), F.col("o"), F.col("s"))).first()[0]
    assert "T. o19\n" in prompt(df) and "Q. o16\n" in prompt(df)
    with pytest.raises(Exception, match="only 26 letters"):
        prompt(df.withColumn("o", F.array_repeat(F.lit("x"), 27)))


def test_retry_prompts_keep_blank_feedback_and_drop_the_oldest(spark):
    rows = [("p", t, "why", f"r{t}", "" if t in (2, 3, 4) else f"f{t} is wrong") for t in range(1, 8)]
    df = spark.createDataFrame(rows, "question_id string, turn int, question string, response string, feedback string")
    got = {r["turn"]: r for r in J.retry_prompts(df, "feedback_only", 23, X.words).collect()}
    tokens = lambda t: len(re.findall(r"\w+|[^\w\s]", t))
    # the limit leaves room for few words of feedback; blank entries cost nothing and stay
    for turn, row in got.items():
        notes = [r[4] for r in rows if r[1] < turn]
        room = 23 - tokens("why") - tokens(J.RETRY_PREFIX + J.RETRY_SUFFIX)
        kept = []
        for note in reversed(notes):
            room -= tokens(note)
            if room < 0:
                break
            kept.insert(0, note)
        assert row["trimmed"] == len(notes) - len(kept), turn
        if kept:
            assert row["messages"][0]["content"] == "why\n\n" + J.RETRY_PREFIX + "\n\n".join(kept) + J.RETRY_SUFFIX


def test_chat_errors(spark):
    df = spark.createDataFrame([([("robot", "hi")],)], "conversations array<struct<from:string,value:string>>")
    with pytest.raises(Exception, match="Unknown role"):
        C.shared_chat_rows(df).collect()
    media = spark.createDataFrame([("<image> x",)], "t string")
    with pytest.raises(Exception, match="differ in number"):
        media.select(H.media_parts(F.col("t"), F.lit(2), F.lit(0))).collect()
    with pytest.raises(ValueError, match="missing columns"):
        C.unpaired_rows(media)


@pytest.mark.parametrize("block", [3, 16_384])
def test_jagged_columns_go_there_and_back(spark, block):
    rows = [(k, i, [None, [], [i], list(range(i % 7))][i % 4]) for k, n in ((1, 20), (None, 9), (2, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, i long, v array<long>")
    pages = G.jagged(df, ["k"], "i", "v", block)
    got = pages.collect()
    assert max(len(r["i"]) for r in got) <= block
    for r in got:
        assert len(r["offsets"]) == len(r["i"]) + 1 and r["offsets"][0] == 0 and r["offsets"][-1] == len(r["values"])
        assert [r["values"][a:b] if known else None for a, b, known in zip(r["offsets"], r["offsets"][1:], r["known"])] == [
            next(v for k, i, v in rows if (k, i) == (r["k"], x)) for x in r["i"]
        ]
    back = G.from_jagged(pages, ["k"], "i", "v").collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)
    assert G.jagged(df.limit(0), ["k"], "i", "v").count() == 0


@pytest.mark.parametrize(
    ("values", "mask", "want"),
    [([5, 6], [0, 1, 1, 0], [9, 5, 6, 9]), ([], [0, 0], [9, 9]), ([], [], []), ([7], [1], [7]), (None, [1], None), ([7], None, None), (list(range(500)), [1, 0] * 500, [x for i in range(500) for x in (i, 9)])],
)
def test_padding_comes_back(spark, values, mask, want):
    df = spark.createDataFrame([(values, mask)], "v array<long>, m array<int>")
    assert df.select(G.restore_padding(F.col("v"), F.col("m"), 9)).first()[0] == want


def kept_turns(turns, limit, fixed):
    """Past turns of each turn by popping the oldest until the prompt fits."""
    out = []
    for t in range(len(turns)):
        past = list(range(t))
        while past and fixed + sum(turns[s] for s in past) > limit:
            past.pop(0)
        out.append(past)
    return out


@pytest.mark.parametrize("limit", [0, 12, 40])
def test_retry_prompts_keep_the_latest_turns_that_fit(spark, limit):
    rng = random.Random(limit)
    sizes = {q: [rng.choice([0, 1, 2, 5, 30]) for _ in range(n)] for q, n in ((1, 60), (2, 1), (3, 7))}
    rows = [(q, t, "what is it", f"r{t}", " ".join([f"f{t}"] * n)) for q, ns in sizes.items() for t, n in enumerate(ns)]
    history = spark.createDataFrame(rows, "question_id int, turn int, question string, response string, feedback string")
    count = lambda c: F.size(F.filter(F.split(c, " "), lambda w: w.rlike("^f[0-9]+$")))  # noqa: E731  feedback words alone count
    got = {(r["question_id"], r["turn"]): r for r in J.retry_prompts(history, "attempt_and_feedback", limit, count).collect()}
    assert len(got) == len(rows)
    for q, ns in sizes.items():
        for t, past in enumerate(kept_turns(ns, limit, 0)):
            r = got[q, t]
            assert [m["content"] for m in r["messages"] if m["role"] == "assistant"] == [f"r{s}" for s in past]
            assert r["trimmed"] == t - len(past) and r["messages"][0]["content"] == "what is it"
