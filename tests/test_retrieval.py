"""Dense and lexical retrieval against brute force, with blocks and probes of any size."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.operators import retrieval as R
from tallyspan.spread import hash_order, ranked


def vectors(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>")


def hits(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["doc_id"], r["score"]))
    return out


@pytest.mark.parametrize(("query_block", "vector_block", "k"), [(512, 8192, 5), (3, 7, 5), (1, 100, 1), (4, 1, 200)])
def test_dense_blocks_find_the_largest_products(spark, query_block, vector_block, k):
    rng = np.random.default_rng(k)
    held = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(90)]  # many ties
    asked = [(100 + i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(10)]
    got = hits(R.dense_top_k(vectors(spark, [*held, (999, None)], "doc_id"), vectors(spark, [*asked, (998, None)], "query_id"), k, query_block, vector_block))
    want = {q: [(i, -s) for s, i in sorted((-float(np.dot(u, v)), i) for i, v in held)[:k]] for q, u in asked}
    assert got == want


def test_dense_search_of_nothing(spark):
    none, one = vectors(spark, [], "doc_id"), vectors(spark, [(1, [1.0])], "query_id")
    assert R.dense_top_k(none, one, 3).count() == 0
    assert R.dense_top_k(vectors(spark, [(1, [1.0])], "doc_id"), vectors(spark, [], "query_id"), 3).count() == 0


def brute_bm25(docs, queries, k, k1=0.9, b=0.4):
    words = {i: re.findall("[a-z0-9]+", t.lower()) for i, t in docs if t is not None}
    n, average = len(docs), sum(map(len, words.values())) / len(docs)
    df = Counter(w for ws in words.values() for w in set(ws))
    out = {}
    for q, text in queries:
        scores = []
        for i, ws in words.items():
            tf, s = Counter(ws), 0.0
            for w, times in Counter(re.findall("[a-z0-9]+", (text or "").lower())).items():
                if tf[w]:
                    idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    s += times * idf * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(ws) / average))
            if s > 0:
                scores.append((-round(s, 9), i))
        if scores:
            out[q] = [i for _, i in sorted(scores)[:k]], [-s for s, _ in sorted(scores)[:k]]
    return out


def corpus():
    """Every document has the words that say nothing; the others are rare."""
    rng = random.Random(3)
    rare = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(150):
        ws = ["the"] * rng.randint(1, 9) + ["of"] * rng.randint(0, 4) + rng.choices(rare, k=rng.randint(0, 12), weights=range(1, 61))
        rng.shuffle(ws)
        docs.append((i, " ".join(ws)))
    docs += [(200, None), (201, ""), (202, "The, the OF!"), (203, docs[5][1]), (204, docs[5][1])]
    queries = [(i, " ".join(["the", "of", *rng.choices(rare, k=rng.randint(0, 5))])) for i in range(12)]
    return docs, [*queries, (50, ""), (51, None), (52, "unknown words"), (53, "the the the")]


@pytest.mark.parametrize(("k", "probe"), [(5, R.PROBE), (5, 1), (1, 30), (300, 1)])
def test_bm25_equals_scoring_everything(spark, k, probe):
    docs, queries = corpus()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = hits(R.bm25_top_k(table, spark.createDataFrame(queries, "query_id long, text string"), k, probe=probe))
    want = brute_bm25(docs, queries, k)
    assert got.keys() == want.keys()
    for q, (ids, scores) in want.items():
        assert [s for _, s in got[q]] == pytest.approx(scores, abs=2e-9)
        # documents whose scores differ by rounding alone may change places
        assert Counter(round(s, 6) for _, s in got[q]) == Counter(round(s, 6) for s in scores)
        assert len(set(i for i, _ in got[q])) == len(ids)


def test_bm25_joins_by_word_alone(spark):
    docs, _ = corpus()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    query = spark.createDataFrame([(1, "the w59 w58 w57")], "query_id long, text string")
    found = R.bm25_top_k(table, query, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert len(found.collect()) == 3


def test_index_counts_words_in_place(spark):
    table = spark.createDataFrame([(1, "b a B, a-b c"), (2, ""), (3, None), (4, "z" * 20_000)], "doc_id long, text string")
    got = sorted(map(tuple, R.inverted_index(table).collect()), key=str)
    assert got == sorted([("a", 1, 2, 6), ("b", 1, 3, 6), ("c", 1, 1, 6), ("z" * 20_000, 4, 1, 1)], key=str)
    totals = R.collection_totals(table).first()
    assert (totals["n"], totals["average"]) == (4, 7 / 4)
    assert "Exchange" not in R.inverted_index(table)._jdf.queryExecution().executedPlan().toString()
    assert R.bm25_top_k(table.limit(0), table.select(F.col("doc_id").alias("query_id"), "text"), 3).count() == 0


def test_postings_are_not_shuffled_for_few_words(spark, monkeypatch):
    docs, queries = corpus()
    table, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "query_id long, text string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    few = R.bm25_top_k(table, asked, 5, probe=1)
    assert "SortMergeJoin" not in plan(few)
    monkeypatch.setattr(R, "FEW_WORDS", 0)
    many = R.bm25_top_k(table, asked, 5, probe=1)
    assert "SortMergeJoin" in plan(many)
    assert hits(few) == hits(many)


def covariance_rows():
    rng = random.Random(9)
    rows = [(step, i, 1, rng.choice([0, 1, 1]), rng.gauss(0, 1), rng.gauss(0, 1)) for step in (1, 2, None) for i in range(400)]
    rows += [(1, 500, 1, 1, 1e9, 1e9), (1, 500, 1, 1, 1e9, 1e9), (2, 501, 1, None, 0.0, 0.0), (2, 502, 1, 1, None, 0.0), (3, 7, 1, 1, 0.1, 0.2), (4, 8, 1, 0, 0.1, 0.2)]
    return rows


@pytest.mark.parametrize("twice", [False, True])
def test_chosen_tokens_are_the_first_of_a_sort(spark, twice):
    rows = covariance_rows() * (2 if twice else 1)
    tokens = spark.createDataFrame(rows, "step int, sample_id long, pos long, mask int, adv double, old_logp double")
    order = ["sample_id", "pos"]
    for got, by in (
        (R.top_covariance_tokens(tokens, ["step"], 0.05, order), "__o"),
        (R.random_covariance_tokens(tokens, ["step"], 0.05, -0.5, 0.5, order, 4), "__h"),
    ):
        if not twice and by == "__o":
            assert got.columns == [*tokens.columns, "cov", "selected"]
        d = R.covariance(tokens, ["step"]).withColumn("__o", -F.col("cov"))
        inside = (F.col("cov") > -0.5) & (F.col("cov") < 0.5)
        d = d.withColumn("__h", F.concat(F.when(inside, "0").otherwise("1"), hash_order(4, *order)))
        live = ranked(d.filter("mask != 0"), ["step"], [by, *order], "__r")
        first = F.col("__r") <= F.greatest(F.floor(F.col("__valid") * 0.05), F.lit(1))
        want = live.filter(first if by == "__o" else first & inside)
        key = lambda r: (r["step"] or 0, r["sample_id"])
        assert sorted(map(key, got.filter("selected").collect())) == sorted(map(key, want.collect()))
        assert got.count() == tokens.filter("mask IS NOT NULL").count()


def test_chosen_tokens_need_no_shuffle_of_tokens(spark):
    rows = [(1, i, 1, 1, float(i), float(i % 7)) for i in range(50)]
    tokens = spark.createDataFrame(rows, "step int, sample_id long, pos long, mask int, adv double, old_logp double")
    found = R.top_covariance_tokens(tokens, ["step"], 0.1, ["sample_id", "pos"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Exchange range" not in plan and "SortMergeJoin" not in plan
    assert found.filter("selected").count() == 5
