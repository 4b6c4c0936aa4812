"""Answer texts at the edges."""

import gc
import time

import pytest
from pyspark.sql import functions as F

from tallyspan.functions import answers as A
from tallyspan.functions import latex, timed
from tallyspan.functions import maths as M
from tallyspan.operators import scoring as S


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("text", "strict", "flexible"),
    [
        ("a #### 1,200 b #### -3.5", "-3.5", "-3.5"),
        ("no mark 7 .", None, "7"),
        ("dots . .", None, "."),
        ("nothing", None, None),
        ("#### 5" + " x" * 200, None, None),
    ],
)
def test_hash_answers(spark, text, strict, flexible):
    assert one(spark, text, A.hash_answer) == strict
    assert one(spark, text, lambda c: A.hash_answer(c, "flexible")) == flexible


def test_boxes():
    assert latex.last_box(r"\boxed{1} \boxed{\frac{a}{b}}") == r"\frac{a}{b}"
    assert latex.last_box(r"\boxed{open") is None
    assert latex.last_box_lenient(r"\boxed 42$ rest") == "42"
    assert latex.last_box_lenient(r"\fbox{3}") is None


def pairs(spark, rows, fn):
    """fn over pairs of texts, in the order of ``rows``"""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("a"), F.col("b"))).collect())]


SAME_MATH = [
    (r"\tfrac12", r"\frac{1}{2}", True),
    ("1/2", r"\dfrac{1}{2}", True),
    ("0.5", r"\frac{1}{2}", True),
    (r"k=5\text{ cm}", "5", True),
    ("kk=5", "5", True),
    ("kkk=5", "5", False),
    ("a=b=5", "5", False),
    (r"\sqrt3", r"\sqrt{3}", True),
    (r"\sqrt\sqrt3", r"\sqrt\sqrt{3}", False),
    (r"2\sqrt", r"2\sqrt", True),
    (".5\\%", "0.5", True),
    ("{.25} .5", "{0.25}0.5", True),
    ("1.5", "10.5", False),
    ("1/02", r"\frac{1}{2}", False),
    ("-3/4", r"\frac{-3}{4}", True),
    (r"\frac", r"\frac", True),
    (r"\frac\frac12 3", r"\frac\frac123", False),
    (r"\frac1", r"\frac 1", True),
    (r"\frac1{23}", r"\frac{1}{23}", True),
    (r"\frac123", r"\frac{1}{2}3", True),
    (r"\left(3,\! 4\right)", "(3,4)", True),
    (r"90^\circ", "90^{\\circ}", True),
    (r"\\frac12\$", r"\frac{1}{2}", True),
    (r"5\text{ m}\text{ s}", "5", False),
    ("", "", True),
    (None, None, True),
    (None, "1", False),
    ("1", None, False),
]


def test_same_math(spark):
    got = pairs(spark, [(a, b) for a, b, _ in SAME_MATH], A.same_math)
    assert dict(zip(SAME_MATH, got)) == {case: case[2] for case in SAME_MATH}


GRADED = [
    ("3,000 cm", "3000", True),
    ("2.0", "2", True),
    ("2.5", "2", False),
    ("2.50", "2.5", True),
    ("1/2", "2/4", False),
    ("1/2", "1/2", True),
    ("(1, 2)", "(1,2)", True),
    ("[1,2]", "(1,2)", False),
    ("(1, 2]", "(1,2)", False),
    ("(1,2,3)", "(1,2)", False),
    ("(1,000, 2)", "(1000,2)", True),
    ("(5,300, 5)", "(53,5)", False),
    ("(0, 11)", "(0,11)", True),
    ("( 100 , 11 )", "(100,11)", True),
    ("x", "2", False),
    ("X", "x", True),
    ("", "2", False),
    ("2", "", False),
    ("", "", True),
    (r"\text{yes}", "Yes", True),
    (r" \text{ 5 } ", "5", True),
    ("5million", "5*10^6", True),
    ("5 feet^2", "5", True),
    ("60 degrees", r"60^\circ", True),
    ("{7}", "7", True),
    (r"50\%", "50", True),
    ("3 or 4", "3 , 4", True),
    (r"2\pi", "2pi", True),
    (r"7\frac{3}{4}", "7 3/4", True),
    ("- 3", "-3", True),
    (r"\sqrt{2}", "sqrt(2)", True),
    ("2.0000000001", "2", True),
    ("1e3", "1000", True),
    ("99999999999999999999", "100000000000000000000", True),
    (None, "1", False),
    ("1", None, False),
]


def test_grade_answer(spark):
    got = pairs(spark, [(a, b) for a, b, _ in GRADED], A.grade_answer)
    assert dict(zip(GRADED, got)) == {case: case[2] for case in GRADED}


FINAL = [
    ("x = 5", "5"),
    ("$5$ dollars", "5"),
    ("so $3$ or $4$", "3"),
    (r"\frac12", r"\frac{1}{2}"),
    (r"\frac{1}{2}", r"\frac{1}{2}"),
    (r"\sqrt2", r"\sqrt{2}"),
    (r"\textbf{(\text{B})}", "(B)"),
    (r"\boxed{\frac{a}{b}}", r"\frac{a}{b}"),
    ("1,234", "1234"),
    ("1,2,x", "1,2,x"),
    (",", ","),
    ("an apple", "apple"),
    (r"12\text{m}", "12"),
]


def test_final_answers(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(FINAL)], "i int, t string")
    got = [r[1] for r in sorted(df.select("i", A.normalise_final(F.col("t"))).collect())]
    assert dict(zip((t for t, _ in FINAL), got)) == dict(FINAL)


@pytest.mark.parametrize(
    ("given", "truth", "ok"),
    [
        ("50", "0.5", True),
        ("1.00005", "1", True),
        ("1.1", "1", False),
        ("12_8", "12", True),
        ("2\\pi", "6.28319", True),
        ("Interval.open(1, 2)", "(1,2)", True),
        ("(1, 2)", "[1, 2]", False),
        ("1, 2", "1,3", False),
        ("$5", "5", True),
        ("__import__('os')", "1", False),
    ],
)
def test_numbers_equal(spark, given, truth, ok):
    df = spark.createDataFrame([(given, truth)], "a string, b string")
    assert df.select(A.numbers_equal(F.col("a"), F.col("b"))).first()[0] is ok


def test_long_answers_are_compared_to_the_end(spark):
    head = "x" * 1000
    df = spark.createDataFrame([(head + "1", head + "2"), (head + "1", head + "1"), (None, "1")], "a string, b string")
    assert [r[0] for r in df.select(A.numbers_equal(F.col("a"), F.col("b"))).collect()] == [False, True, None]


@pytest.mark.parametrize(
    ("text", "matched", "answer"),
    [
        ("The answer is 12", True, "12"),
        ("nothing here", False, "nothing here"),
        ("answer: first, but the answer is x = 7. Done now", True, "7"),
        ("so 15 is the answer", True, "so 15"),
        (r"we get \boxed{\frac{1}{2}} here", True, r"\frac{1}{2}"),
        ("the answer is unknown", False, "unknown"),
    ],
)
def test_free_text(spark, text, matched, answer):
    assert tuple(one(spark, text, A.free_text_answer)) == (matched, answer)


def used(spark, solution, truth):
    df = spark.createDataFrame([(solution, truth)], "a string, b string")
    return df.select(A.tool_use(F.col("a"), F.col("b")).alias("s")).select("s.*").first()


def test_tool_use_cuts_nested_objects(spark):
    text = 'Action: a\nAction Input: {"x": {"y": 1}}'
    got = used(spark, text, '[{"Action": "a", "Action_Input": "{}"}]')
    assert got["score"] == 1.0 and got["nested_cut"]
    assert used(spark, text, "not json")["feedback"] == "Failed to parse ground truth JSON"
    assert used(spark, None, "[]")["score"] is None


def test_tool_use_compares_bags_and_merged_inputs(spark):
    text = 'Action: b\nAction Input: {"x": 1, "y": "q"}\nAction: a\nAction Input: {"x": 2, "z": [1, {"k": null}]}\nAction: b\nAction Input: bad {'
    right = '[{"Action": "a", "Action_Input": {"z": [1, {"k": null}], "x": 2}}, {"Action": "b", "Action_Input": "{\\"y\\": \\"q\\"}"}, {"Action": "b", "Action_Input": "{"}]'
    # an inner object ends the block early, so the second block is not read
    got = used(spark, text, right)
    assert (got["score"], got["nested_cut"], got["incorrect_format"]) == (0.0, True, 0)
    assert got["feedback"] == """Action inputs mismatch: predicted {'x': 1, 'y': 'q'}, expected {'x': 2, 'z': [1,{"k":null}], 'y': 'q'}"""
    flat = text.replace('[1, {"k": null}]', "true")
    got = used(spark, flat, right.replace('[1, {"k": null}]', "true"))
    assert (got["score"], got["feedback"], got["pred"]) == (1.0, "", "Actions: ['b', 'a', 'b'], Inputs: {'x': 2, 'y': 'q', 'z': True}")
    got = used(spark, "no action", '[{"Action": "a", "Action_Input": "{}"}]')
    assert (got["score"], got["incorrect_format"], got["feedback"]) == (0.0, 1, "Actions mismatch: predicted [], expected ['a']")


def test_letters(spark):
    assert one(spark, "answer is (b)", A.cascade_letter) == "b"
    assert one(spark, "none", A.cascade_letter) == ""
    assert one(spark, "It is A or d.", A.last_letter) == "D"
    assert one(spark, " 42. ", A.last_letter) == "42"
    assert one(spark, "say C", A.answer_letter) == "C"
    assert one(spark, "no", A.answer_letter) is None


def test_qa_tag_penalty(spark):
    df = spark.createDataFrame([("<answer>The Cat!</answer>" + "</answer>" * 11,), ("none",)], "t string")
    got = [r[0] for r in df.select(A.qa_score(F.col("t"), F.array(F.lit("a cat")))).collect()]
    assert got == [0.25, 0.0]


def test_metric_keys_and_run_names(spark):
    assert one(spark, "val//acc@8#x", A.metric_key) == "val/acc_at_8_x"
    got = one(spark, "G-sciknoweval-bio-lr1-m-20260101_1", A.run_group_and_tags)
    assert got["group"] == "G-sciknoweval-bio" and got["tags"] == ["lr1", "m"]
    assert one(spark, "plain", A.run_group_and_tags)["group"] is None


@pytest.mark.parametrize(
    ("problem", "description"),
    [
        ("Do the thing well.\n## Examples 2:\nx\n", "Do the thing well."),
        ("Tiny\nInput\n1\n", ""),
        ("No section at all here", "No section at all here"),
        ("Read the input and sum it.\n**Input Format**\nn\n", "Read the input and sum it."),
        ("Add two numbers.\n---\n-----Examples-----\n1", "Add two numbers."),
        ("Add two numbers. For example: 1 2\nmore", ""),
        ("Add two numbers.\nInput - one line\n1", "Add two numbers."),
    ],
)
def test_description(spark, problem, description):
    assert one(spark, problem, A.description_of) == description


def test_feedback_rendering(spark):
    rows = [
        ("s", 0, "1\n" * 9, "2", "3", False, " dbg "),
        ("s", 1, "1", None, "x" * 300, False, ""),
        ("p", 0, "1", "2", "2", True, ""),
        ("e", 0, "1", "2", "2", True, ""),
        ("e", 1, "5", "2", "Error: bad", False, ""),
    ]
    df = spark.createDataFrame(rows, "sample_id string, test_idx int, input string, expected string, actual string, passed boolean, debug string")
    got = {r["sample_id"]: r["feedback"] for r in S.render_feedback(df).collect()}
    assert got["p"] == ""
    assert got["e"] == "Runtime Error\nbad\n\nLast Executed Input\n5"
    assert "... (1 more lines)" in got["s"] and "Debug Output\ndbg" in got["s"] and "x" * 250 + "..." in got["s"]


def test_unknown_source_is_told(spark):
    df = spark.createDataFrame([("nowhere", "r", "t"), ("aime_x", "Answer: 5", "5")], "data_source string, response string, ground_truth string")
    got = {r["data_source"]: r for r in S.score_by_source(df).collect()}
    assert got["nowhere"]["score"] is None and "nowhere" in got["nowhere"]["feedback"]
    assert got["aime_x"]["score"] == 1.0


def moody_scorer():
    """A scorer that answers, raises, hangs or dies by what it is given."""

    def moody(source, text, truth, extra):
        import os
        import time

        if text == "hang":
            time.sleep(600)
        if text == "die":
            os._exit(1)
        if text == "raise":
            raise KeyError(truth)
        return {"score": len(truth), "seen": source}

    return moody


def responses(spark, texts):
    rows = [(i, "s", t, "x" * (i % 5)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, source string, text string, truth string").coalesce(1)


def test_a_scorer_has_its_time(spark):
    texts = ["fine", "hang", "raise", "die", "fine"] + ["fine"] * 100 + ["hang", "fine"]
    score = S.user_scores(moody_scorer(), timeout=1)(F.col("source"), F.col("text"), F.col("truth"), F.lit(None).cast("string"))
    got = sorted(responses(spark, texts).select("id", score.alias("s")).select("id", "s.*").collect())
    reason = {"hang": "timeout after 1 s", "raise": "KeyError: 'xx'", "die": "the scorer's process ended", "fine": None}
    assert [r["error"] for r in got] == [reason[t] for t in texts]
    assert [r["score"] for r in got] == [len("x" * (i % 5)) if t == "fine" else 0.0 for i, t in enumerate(texts)]
    assert all(r["extras"] == ({"seen": "s"} if t == "fine" else {}) for r, t in zip(got, texts))


@pytest.mark.parametrize("timeout", [None, 1])
def test_a_bad_row_does_not_fail_its_batch(spark, timeout):
    moody = moody_scorer()

    def scorer(sources, texts, truths):
        return [moody(s, x, t, None)["score"] for s, x, t in zip(sources, texts, truths)]

    texts = ["fine"] * 70 + ["raise"] + ["fine"] * 30 + (["die", "hang"] if timeout else []) + ["fine"]
    score = S.batch_scores(scorer, timeout)(F.col("source"), F.col("text"), F.col("truth"))
    got = sorted(responses(spark, texts).select("id", score.alias("s")).select("id", "s.*").collect())
    reason = {"hang": "timeout after 1 s", "raise": "KeyError: ''", "die": "the scorer's process ended", "fine": None}
    assert [r["error"] for r in got] == [reason[t] for t in texts]
    assert [r["score"] for r in got] == [len("x" * (i % 5)) if t == "fine" else 0.0 for i, t in enumerate(texts)]


def test_a_batch_scorer_that_miscounts_is_told(spark):
    score = S.batch_scores(lambda sources, texts, truths: [1.0] * 3)(F.col("source"), F.col("text"), F.col("truth"))
    got = responses(spark, ["a"]).select(score.alias("s")).select("s.*").first()
    assert (got["score"], got["error"]) == (0.0, "ValueError: 3 scores for 1 rows")
    assert responses(spark, []).select(score.alias("s")).count() == 0


def test_batches_that_hang_are_waited_for_together(spark):
    def scorer(sources, texts, truths):
        if "hang" in texts:
            time.sleep(60)
        return [1.0] * len(texts)

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        texts = (["fine"] * 9 + ["hang"]) * 4
        score = S.batch_scores(scorer, 2)(F.col("source"), F.col("text"), F.col("truth"))
        begun = time.monotonic()
        got = responses(spark, texts).coalesce(1).select("id", score.alias("s")).select("id", "s.*").collect()
        # two waits of 2 s each, not two for each of the four batches
        assert time.monotonic() - begun < 12
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert [r["error"] for r in sorted(got)] == [None if t == "fine" else "timeout after 2 s" for t in texts]


def test_helpers_do_not_visit_what_the_task_has_loaded():
    with timed.helpers(gc.get_freeze_count, str, 20, most=1) as pool:
        assert pool.run([()])[0] > 0


def test_texts_without_markup_are_not_rewritten(spark):
    texts = ["0", "7", "12345", "012", "1234567890123456", "(12,5)", "[1,234)", "(1,234)", "3/4", "-3/4", "1,234", "x=3", "0.5", ".5", "a/b", "tfrac12", "3 cm", "1\n2", "(", "", None, "\\frac12", "^2", "2^\\circ"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    s = M.spelled(F.col("t"))
    both = d.select("t", M.plain(F.col("t")).alias("a"), M._made_plain(F.col("t")).alias("b"), M.normalised(F.col("t")).alias("c"), F.when(s["readable"], s["text"]).otherwise(F.col("t")).alias("d"))
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in both.collect())
