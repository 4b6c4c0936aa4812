"""Top-k log-probs of unequal length."""

import math

from pyspark.sql import functions as F

from tallyspan.operators import labels as L

ROWS = [
    (0, [-0.1, -2.5], [-0.2, -2.0], [-0.3, -1.5]),
    (1, [-0.1, -2.5, -6.0], [-0.2, -2.0, -5.0], [-0.3, -1.5, -4.0]),
    (2, None, [-0.2], [-0.2]),
    (3, [], [], []),
    (4, [-0.1, -2.5], [-0.2], [-0.3, -1.5]),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "i long, base_topk array<double>, full_topk array<double>, answer_topk array<double>")


def test_entropy_of_any_length(spark):
    got = [r[0] for r in frame(spark).orderBy("i").select(L.entropy(F.col("base_topk"))).collect()]
    want = [None if r[1] is None else -sum(math.exp(x) * x for x in r[1]) for r in ROWS]
    assert got[2] is None and all(abs(a - b) < 1e-12 for a, b in zip(got, want) if b is not None)
    certain = spark.createDataFrame([([0.0, float("-inf")],)], "a array<double>")
    assert certain.select(L.entropy(F.col("a"))).first()[0] == 0.0


def test_clean_teacher_of_any_length(spark):
    got = {r["i"]: r for r in L.clean_teacher(frame(spark), tail=False).collect()}
    assert [got[i]["beta"] is None for i in range(5)] == [False, False, True, True, True]
    for i in (0, 1):
        alone = L.clean_teacher(frame(spark).filter(F.col("i") == i), tail=False).first()
        assert got[i]["clean_topk"] == alone["clean_topk"] and len(got[i]["clean_topk"]) == i + 2
        assert got[i]["h_clean"] == alone["h_clean"]
    assert L.clean_teacher(frame(spark).limit(0)).count() == 0


def test_tokens_meet_their_step_before_they_have_log_probs(spark, sf):
    """What is shuffled by the join are a token's few numbers, not its arrays of log-probs."""
    from tallyspan.operators import labels
    from tallyspan.plans.labels import stepped

    for version in ("v4", "v5"):
        plan = labels.confidence_weights(stepped(spark, sf), version).select("sample_id", "tag", "weight")._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.rindex("Join Inner") :].lower()
        assert "topk" not in below and "ln(" not in below and "array(" not in below
