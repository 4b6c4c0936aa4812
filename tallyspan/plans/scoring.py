"""Registered queries of the scoring family, on texts built from orders and parts."""

from pyspark.sql import functions as F

from tallyspan.functions import answers as A
from tallyspan.operators import scoring as S
from tallyspan.plans import register
from tallyspan.plans.advantage import r6
from tallyspan.sources import views as V
from tallyspan.spread import ranked

L = F.lit


def answers(spark, sf):
    """Answer numbers per order: ``n`` the right one, ``comma`` the same with a separator, ``truth`` the gold one."""
    n = F.floor("o_totalprice").cast("long")
    comma = F.concat(F.floor(n / 1000).cast("string"), L(","), F.lpad((n % 1000).cast("string"), 3, "0"))
    truth = F.when(F.col("o_orderstatus") == "F", n).otherwise(F.col("o_custkey")).cast("string")
    letter = F.substring(L("ABCD"), (F.col("o_custkey") % 4 + 1).cast("int"), L(1))
    guess = F.substring(L("ABCD"), (n % 4 + 1).cast("int"), L(1))
    return V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sample_id"),
        F.col("o_custkey").cast("string").alias("c"),
        n.cast("string").alias("n"),
        comma.alias("comma"),
        truth.alias("truth"),
        letter.alias("letter"),
        guess.alias("guess"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


ANSWERS = """a AS (SELECT o_orderkey AS sample_id, CAST(o_custkey AS VARCHAR) AS c, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS n,
 CAST(CAST(floor(floor(o_totalprice) / 1000) AS BIGINT) AS VARCHAR) || ',' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS comma,
 CAST(CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE o_custkey END AS VARCHAR) AS truth,
 substring('ABCD', CAST(o_custkey % 4 + 1 AS INTEGER), 1) AS letter, substring('ABCD', CAST(CAST(floor(o_totalprice) AS BIGINT) % 4 + 1 AS INTEGER), 1) AS guess,
 o_orderpriority AS priority, o_orderstatus AS status FROM orders)"""


def text(*parts):
    return F.concat(*[L(p[1:]) if p.startswith("=") else F.col(p) for p in parts])


def text_sql(*parts):
    return " || ".join("'" + p[1:].replace("'", "''") + "'" if p.startswith("=") else p for p in parts)


HASH = ("=The customer ", "c", "= pays. #### 12 and then #### ", "comma", "= dollars.")
register(
    "score_hash_strict",
    f"""WITH {ANSWERS}, t AS (SELECT *, right({text_sql(*HASH)}, 300) AS t FROM a),
 p AS (SELECT *, replace(regexp_extract_all(t, '#### (-?[0-9.,]+)', 1)[-1], ',', '') AS pred FROM t)
 SELECT sample_id, pred, CASE WHEN pred = truth THEN 1.0::DOUBLE ELSE 0.1 END AS score FROM p""",
)(
    lambda spark, sf: answers(spark, sf).withColumn("t", text(*HASH)).select(
        "sample_id", A.hash_answer(F.col("t")).alias("pred"), A.hash_score(F.col("t"), F.col("truth"), format_score=0.1).alias("score")
    )
)
FLEX = ("=We get ", "n", "= in total .")
register(
    "score_hash_flexible",
    f"""WITH {ANSWERS} SELECT sample_id, n AS pred, CASE WHEN n = truth THEN 1.0::DOUBLE ELSE 0.0 END AS score FROM a""",
)(
    lambda spark, sf: answers(spark, sf).withColumn("t", text(*FLEX)).select(
        "sample_id",
        A.hash_answer(F.col("t"), "flexible").alias("pred"),
        A.hash_score(F.col("t"), F.col("truth"), "flexible").alias("score"),
    )
)
BOX = ("=First \\boxed{1}, then \\boxed{\\frac{", "n", "=}{2}} and {", "c", "=}.")
register(
    "last_boxed_answer",
    f"""WITH {ANSWERS} SELECT sample_id, '\\frac{{' || n || '}}{{2}}' AS box FROM a""",
)(lambda spark, sf: answers(spark, sf).select("sample_id", A.last_box(text(*BOX)).alias("box")))
register(
    "normalise_maths",
    f"""WITH {ANSWERS} SELECT sample_id, '\\frac{{' || c || '}}{{' || n || '}}' AS ratio, '\\frac{{1}}{{2}}\\sqrt{{3}}' || n AS fixed, '0.' || n AS decimal FROM a""",
)(
    lambda spark, sf: answers(spark, sf)
    .select(
        "sample_id",
        A.normalise_math(text("=x = ", "c", "=/", "n")).alias("ratio"),
        A.normalise_math(text("=\\left\\dfrac12\\sqrt3 ", "n", "=^\\circ")).alias("fixed"),
        A.normalise_math(text("=.", "n", "=\\%\\text{ cm}")).alias("decimal"),
    )
)
MATH = ("=So \\boxed{", "c", "=/2} or \\boxed{\\tfrac ", "n", "=2}")
register(
    "score_maths",
    f"""WITH {ANSWERS} SELECT sample_id, CASE WHEN length(n) = 1 THEN NULL ELSE status = 'F' END AS same FROM a""",
)(
    lambda spark, sf: answers(spark, sf).select(
        "sample_id",
        A.same_math(
            A.last_box_lenient(text("=So \\boxed{", "c", "=/2} and \\boxed{\\dfrac{", "n", "=}{7} \\text{ m}}")),
            F.concat(L("k=\\frac{"), F.col("truth"), L("}{7}")),
        ).alias("same"),
    )
)
LINE = ("=Some work.\nAnswer: 3\nAnswer: x = $", "comma", "= dollars$\ndone")
register(
    "score_answer_line",
    f"""WITH {ANSWERS} SELECT sample_id, CASE WHEN n = truth THEN 1.0::DOUBLE ELSE -1.0 END AS score, CASE WHEN n = truth THEN 1.0::DOUBLE ELSE 0.0 END AS acc, n AS pred FROM a""",
)(
    lambda spark, sf: answers(spark, sf)
    .withColumn("s", A.line_score(text(*LINE), F.col("truth")))
    .select("sample_id", "s.score", "s.acc", "s.pred")
)
register(
    "score_strict_box",
    f"""WITH {ANSWERS} SELECT sample_id, CASE WHEN n = truth THEN 1.0::DOUBLE ELSE -1.0 END AS score, n AS pred FROM a""",
)(
    lambda spark, sf: answers(spark, sf)
    .withColumn("s", A.strict_box_score(text("=Long text \\boxed{9} and finally \\boxed{", "n", "=}."), F.col("truth")))
    .select("sample_id", "s.score", "s.pred")
)
CHOICE = ("=<answer>B</answer> no\n<answer>\n", "guess", "=\n</answer>")
register(
    "score_tagged_choice",
    f"""WITH {ANSWERS} SELECT sample_id, CAST(guess = letter AS DOUBLE) AS score, guess AS pred, CAST(status = 'P' AS INTEGER) AS incorrect_format FROM a""",
)(
    lambda spark, sf: answers(spark, sf)
    .withColumn("t", F.concat(text(*CHOICE), F.when(F.col("status") == "P", L(" so")).otherwise(L(""))))
    .withColumn("s", A.tagged_choice_score(F.col("t"), F.col("letter")))
    .select("sample_id", "s.score", "s.pred", "s.incorrect_format")
)
register(
    "score_last_letter",
    f"""WITH {ANSWERS}, t AS (SELECT *, 'the options are b or ' || lower(guess) || ', not ax ' || status AS t FROM a), p AS (SELECT *, regexp_extract_all(upper(t), '\\b([ABCD])\\b', 1)[-1] AS pred FROM t)
 SELECT sample_id, CAST(pred = letter AS DOUBLE) AS score, pred, 0 AS incorrect_format FROM p""",
)(
    lambda spark, sf: answers(spark, sf)
    .withColumn("s", A.last_letter_score(F.concat(L("the options are b or "), F.lower("guess"), L(", not ax "), F.col("status")), F.col("letter")))
    .select("sample_id", "s.score", "s.pred", "s.incorrect_format")
)
register(
    "score_letter_cascade",
    f"""WITH {ANSWERS} SELECT sample_id, CAST(CASE WHEN status = 'O' THEN 'J' ELSE guess END = letter AS DOUBLE) AS score, CASE WHEN status = 'O' THEN 'J' ELSE guess END AS pred FROM a""",
)(
    lambda spark, sf: answers(spark, sf)
    .withColumn(
        "t",
        F.when(F.col("status") == "F", text("=C then the Answer is (", "guess", "=) or J"))
        .when(F.col("status") == "P", text("=C then answer: ", "guess", "= or J"))
        .otherwise(text("=between ", "guess", "= and J.")),
    )
    .withColumn("s", A.cascade_letter_score(F.col("t"), F.col("letter")))
    .select("sample_id", "s.score", "s.pred")
)
register(
    "answer_letter",
    f"""WITH {ANSWERS} SELECT sample_id, CASE status WHEN 'F' THEN guess WHEN 'P' THEN letter END AS found FROM a""",
)(
    lambda spark, sf: answers(spark, sf).select(
        "sample_id",
        A.answer_letter(
            A.without_thinking(
                F.when(F.col("status") == "F", text("=<think>maybe D\nD</think> <answer> ", "guess", "= </answer> B"))
                .when(F.col("status") == "P", text("=<think>A</think>B or ", "letter", "=."))
                .otherwise(text("=<think>", "guess", "=</think>none"))
            )
        ).alias("found"),
    )
)


def tool_rows(spark, sf):
    call = lambda name, key, value: F.concat(
        L("Action: "), name, L("\nAction Input: {\""), key, L("\": "), value, L("}\n")
    )
    a = answers(spark, sf)
    nested = F.when(F.col("status") == "P", L('Action Input: {"deep": {"x": 1}}\n')).otherwise(L(""))
    truth = F.concat(L('[{"Action": "search", "Action_Input": "{\\"q\\": '), F.col("truth"), L('}"}, {"Action": "read", "Action_Input": {"r": 1}}]'))
    return a.withColumn(
        "response", F.concat(L("Thought\n"), call(L("read"), L("r"), L("1")), call(L("search"), L("q"), F.col("n")), nested)
    ).withColumn("gold", truth)


register(
    "score_tool_use",
    f"""WITH {ANSWERS} SELECT sample_id, CAST(n = truth AS DOUBLE) AS score, 0 AS incorrect_format, status = 'P' AS nested_cut,
 CASE WHEN n = truth THEN '' ELSE 'Action inputs mismatch: predicted {{''r'': 1, ''q'': ' || n || '}}, expected {{''q'': ' || truth || ', ''r'': 1}}' END AS feedback FROM a""",
)(
    lambda spark, sf: tool_rows(spark, sf)
    .withColumn("s", A.tool_use(F.col("response"), F.col("gold")))
    .select("sample_id", "s.score", "s.incorrect_format", "s.nested_cut", "s.feedback")
)
PARTS = "p AS (SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part)"


def part_answers(spark, sf, tags=False):
    p = V.table(spark, sf, "part")
    said = F.concat(L("<answer>x</answer> so <answer> The "), F.upper("p_name"), L("! </answer>"))
    many = F.when(F.col("p_size") > 25, F.repeat(L("</answer>"), 11)).otherwise(L(""))
    golds = F.array(F.concat(L("a "), F.split("p_name", " ")[0], L(" widget")), F.concat(L("an  "), F.col("p_name"), L(".")).cast("string"))
    golds = F.when(F.col("p_type") == "ECONOMY", F.slice(golds, 1, 1)).otherwise(golds)
    return p.select("p_partkey", "p_size", F.concat(said, many).alias("response"), golds.alias("golds"), "p_name", "p_type")


QA = """WITH p AS (SELECT *, regexp_replace(lower(p_name), '[^a-z ]', '', 'g') AS nm, split_part(p_name, ' ', 1) || ' widget' AS g1 FROM part),
 h AS (SELECT *, nm = g1 OR p_type <> 'ECONOMY' AS em, contains(nm, g1) OR p_type <> 'ECONOMY' AS sub FROM p)"""
register(
    "score_qa_exact",
    f"{QA} SELECT p_partkey, CAST(CASE WHEN em THEN CASE WHEN p_size > 25 THEN 0.25 ELSE 1 END ELSE 0.05 END AS DOUBLE) AS score FROM h",
)(
    lambda spark, sf: part_answers(spark, sf).select(
        "p_partkey", A.qa_score(F.col("response"), F.col("golds"), format_score=0.05).alias("score")
    )
)
register(
    "score_qa_substring",
    f"{QA} SELECT p_partkey, CAST(sub AS DOUBLE) AS score FROM h",
)(lambda spark, sf: part_answers(spark, sf).select("p_partkey", A.qa_score(F.col("response"), F.col("golds"), True).alias("score")))
register(
    "normalise_qa",
    """SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(translate(regexp_replace(lower(text), '[!-/:-@\\[-`{-~]', '', 'g'), chr(160), ' '), '[\\s\\x0B\\x1C-\\x1F\\x85]+', '  ', 'g') || ' ',
 '(^| )(a|an|the) ', ' ', 'g'), ' +', ' ', 'g'))) AS norm_md5 FROM (SELECT doc_id, ' ' || text AS text FROM documents)""",
)(lambda spark, sf: V.table(spark, sf, "documents").select("doc_id", F.md5(A.normalise_qa(F.col("text"))).alias("norm_md5")))
register(
    "score_geometry",
    f"""WITH {ANSWERS} SELECT sample_id, round(CAST(CASE WHEN n = truth THEN 0.9 ELSE 0 END + CASE WHEN status <> 'P' THEN 0.1 ELSE 0 END AS DOUBLE), 6) AS score FROM a""",
)(
    lambda spark, sf: answers(spark, sf)
    .withColumn("t", F.concat(F.when(F.col("status") == "P", L("")).otherwise(L("<think>a\nb</think>")), text("= so \\boxed{", "comma", "=} ok")))
    .select("sample_id", r6(A.geometry_score(F.col("t"), F.col("truth"))).alias("score"))
)
register(
    "grade_answer",
    f"""WITH {ANSWERS} SELECT sample_id, n = truth AS units, n = truth AS tuple, n = truth AND status <> 'P' AS bracket,
 truth = c OR c = n AS ratio, status <> 'O' AS words, CAST(c AS BIGINT) = CAST(letter = guess AS BIGINT) + CAST(truth AS BIGINT) AS decimal FROM a""",
)(
    lambda spark, sf: answers(spark, sf).select(
        "sample_id",
        A.grade_answer(text("n", "=.0 hours"), F.col("truth")).alias("units"),
        A.grade_answer(text("=(", "comma", "=, 5)"), F.concat(L("("), F.col("truth"), L(",5)"))).alias("tuple"),
        A.grade_answer(
            F.concat(F.when(F.col("status") == "P", "[").otherwise("("), F.col("n"), L(", 5)")), F.concat(L("("), F.col("truth"), L(",5)"))
        ).alias("bracket"),
        # ratios count as written
        A.grade_answer(text("=\\frac{", "c", "=}{3}"), F.concat(F.col("truth"), L("/3"))).alias("ratio"),
        A.grade_answer(F.concat(L("\\text{"), F.when(F.col("status") == "O", "no").otherwise("The Answer"), L("}")), L("the answer")).alias("words"),
        A.grade_answer(F.col("c").cast("double").cast("string"), (F.col("truth").cast("long") + (F.col("letter") == F.col("guess")).cast("long")).cast("string")).alias("decimal"),
    )
)
register(
    "numbers_equal",
    f"""WITH {ANSWERS}, x AS (SELECT *, CAST(n AS DOUBLE) AS x, CAST(truth AS DOUBLE) AS y FROM a),
 e AS (SELECT *, list_reduce([y / 100, y, y * 100].list_transform(lambda t: abs(t - x) <= 1e-4 * greatest(abs(t), abs(x))), lambda p, q: p OR q) AS num FROM x)
 SELECT sample_id, num, status = 'F' OR n = c AS percent, num AND status <> 'P' AS interval, n = truth AS based, letter = guess AS pi FROM e""",
)(
    lambda spark, sf: answers(spark, sf).select(
        "sample_id",
        A.numbers_equal(F.col("comma"), F.col("truth")).alias("num"),
        A.numbers_equal(text("n", "=%"), F.concat(F.when(F.col("status") == "F", F.col("n")).when(F.col("n") == F.col("c"), F.col("n")).otherwise("x"), L(".0"))).alias("percent"),
        A.numbers_equal(text("=Interval.open(", "n", "=, 3)"), F.concat(F.when(F.col("status") == "P", "[").otherwise("("), F.col("truth"), L(",3)"))).alias("interval"),
        A.numbers_equal(text("n", "=_8"), F.col("truth"), percent=False, tolerance=0.0).alias("based"),
        A.numbers_equal(L("2\\pi"), F.when(F.col("letter") == F.col("guess"), "6.28319").otherwise("6.2")).alias("pi"),
    )
)
register(
    "free_text_answer",
    f"""WITH {ANSWERS} SELECT sample_id, status <> 'P' AS matched, CASE status WHEN 'F' THEN n || '.' WHEN 'O' THEN c ELSE 'unknown' END AS answer FROM a""",
)(
    lambda spark, sf: answers(spark, sf)
    .withColumn(
        "t",
        F.when(F.col("status") == "F", text("=We know it. So the answer is x = ", "n", "=. "))
        .when(F.col("status") == "O", text("=Then \\boxed{", "c", "=} is the answer"))
        .otherwise(text("=the result is unknown")),
    )
    .withColumn("s", A.free_text_answer(F.col("t")))
    .select("sample_id", "s.matched", "s.answer")
)
register(
    "longest_code_block",
    f"""WITH {ANSWERS} SELECT sample_id, 'print(' || n || ')' || chr(10) || 'x' || chr(10) AS code FROM a""",
)(
    lambda spark, sf: answers(spark, sf).select(
        "sample_id",
        A.longest_code_block(text("=Try ```py\nx=1\n``` or ```python\nprint(", "n", "=)\nx\n``` end ```\ny\n```")).alias("code"),
    )
)
register(
    "score_maths_feedback",
    f"""WITH {ANSWERS} SELECT sample_id, CAST(status <> 'O' AND n = truth AS DOUBLE) AS score, CASE WHEN status = 'O' THEN '' ELSE n END AS pred,
 CASE WHEN status = 'P' THEN 'Your response was truncated because it exceeded the maximum length.' WHEN status = 'O' THEN 'Your answer had the wrong format. The solution must be given in the format: \\boxed{{your_answer}}.'
 WHEN n <> truth THEN 'Your answer is incorrect. The correct answer is ' || truth || '.' ELSE '' END AS feedback FROM a""",
)(
    lambda spark, sf: answers(spark, sf)
    .withColumn("t", F.when(F.col("status") == "O", text("=so {", "n", "=}")).otherwise(text("=so \\boxed{", "n", "=}")))
    .withColumn("s", A.maths_feedback_score(F.col("t"), F.col("truth"), F.col("status") == "P", say_answer=True))
    .select("sample_id", "s.score", "s.pred", "s.feedback")
)
register(
    "tool_calls",
    f"""WITH {ANSWERS} SELECT sample_id, CASE WHEN status = 'P' THEN 1 ELSE 2 END AS calls, 'add' AS name, '{{"a":' || n || '}}' AS arguments, 'Hi  there ' || c AS content FROM a""",
)(
    lambda spark, sf: S.parse_tools(
        answers(spark, sf).withColumn(
            "t",
            F.concat(
                text('=Hi <tool_call>\n{"name": "add", "arguments": {"a": ', "n", "=}}\n</tool_call> there "),
                F.when(F.col("status") == "P", L("<tool_call>{bad</tool_call>")).otherwise(L('<tool_call>{"name": "b", "arguments": {}}</tool_call>')),
                F.col("c"),
            ),
        ),
        "t",
    ).select("sample_id", F.size("calls").alias("calls"), F.col("calls")[0]["name"].alias("name"), F.col("calls")[0]["arguments"].alias("arguments"), "content")
)
CHANNEL = "<|start|>assistant<|channel|>commentary to=functions.add <|constrain|>json<|message|>"
register(
    "tool_calls_channel",
    f"""WITH {ANSWERS} SELECT sample_id, 1 AS calls, 'add' AS name, '{{"a": ' || n || '}}' AS arguments, 'X' || c AS content FROM a""",
)(
    lambda spark, sf: S.parse_tools(
        answers(spark, sf).withColumn(
            "t",
            text(f"=<|channel|>analysis<|message|>{CHANNEL}{{}}<|call|><|end|>X{CHANNEL}{{\"a\": ", "n", "=}<|call|>", "c"),
        ),
        "t",
        "channel",
    ).select("sample_id", F.size("calls").alias("calls"), F.col("calls")[0]["name"].alias("name"), F.col("calls")[0]["arguments"].alias("arguments"), "content")
)
register(
    "problem_description",
    f"""WITH {ANSWERS} SELECT sample_id, CASE status WHEN 'F' THEN 'Sum the ' || n || ' numbers.' WHEN 'O' THEN 'Order ' || c || ' of goods' ELSE '' END AS description FROM a""",
)(
    lambda spark, sf: answers(spark, sf).select(
        "sample_id",
        A.description_of(
            F.when(F.col("status") == "F", text("=Sum the ", "n", "= numbers.\n\n### Input Format:\nline\n"))
            .when(F.col("status") == "O", text("=Order ", "c", "= of goods\n---\n-----Examples-----\n1"))
            .otherwise(L("Short\nInput\n1\n"))
        ).alias("description"),
    )
)
register(
    "tolerant_float",
    f"""WITH {ANSWERS} SELECT sample_id, CASE status WHEN 'F' THEN CAST(n AS DOUBLE) + 0.5 ELSE 2.5 END AS seconds FROM a""",
)(
    lambda spark, sf: answers(spark, sf).select(
        "sample_id",
        A.float_or(F.when(F.col("status") == "F", text("= ", "n", "=.5 seconds")).when(F.col("status") == "O", L("  ")), 2.5).alias("seconds"),
    )
)
register(
    "clean_ending",
    """SELECT p_partkey, 'Make a ' || p_name || '. now , then' AS cleaned FROM part""",
)(
    lambda spark, sf: V.table(spark, sf, "part").select(
        "p_partkey", A.clean_ending(F.concat(L(" Make a "), F.col("p_name"), L(" [title]now [step], then\n"))).alias("cleaned")
    )
)
register(
    "metric_keys",
    """SELECT p_partkey, 'val-core/' || replace(p_name, ' ', ' ') || '/acc/mean_at_' || p_size || '_' || replace(p_brand, '#', '_') AS key FROM part""",
)(
    lambda spark, sf: V.table(spark, sf, "part").select(
        "p_partkey",
        A.metric_key(F.concat(L("val-core//"), F.col("p_name"), L("///acc/mean@"), F.col("p_size").cast("string"), L("#"), F.col("p_brand"))).alias("key"),
    )
)
register(
    "run_names",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'GUIDED-sciknoweval-' || p_type WHEN p_size % 3 = 1 THEN 'GUIDED-lcb' END AS grp,
 CASE WHEN p_size % 3 = 0 THEN 'lr1e-Qwen3-8B' WHEN p_size % 3 = 1 THEN 'lr-' || p_size END AS tags,
 CASE WHEN p_size % 3 = 0 THEN 'GUIDED-sciknoweval-' || p_type || '-lr1e' WHEN p_size % 3 = 1 THEN 'GUIDED-lcb-lr-' || p_size ELSE 'plain-' || p_size END AS short FROM part""",
)(
    lambda spark, sf: V.table(spark, sf, "part")
    .withColumn(
        "name",
        F.when(F.col("p_size") % 3 == 0, F.concat(L("GUIDED-sciknoweval-"), F.col("p_type"), L("-lr1e-Qwen3-8B-20260101_120000")))
        .when(F.col("p_size") % 3 == 1, F.concat(L("GUIDED-lcb-lr-"), F.col("p_size").cast("string"), L("-20260101_120000")))
        .otherwise(F.concat(L("plain-"), F.col("p_size").cast("string"))),
    )
    .withColumn("g", A.run_group_and_tags(F.col("name")))
    .select("p_partkey", F.col("g.group").alias("grp"), F.array_join("g.tags", "-").alias("tags"), A.short_run_name(F.col("name")).alias("short"))
)
register(
    "overlong_penalty",
    """SELECT l_orderkey, round(least(-(count(*) - 3) / 2.0 * 0.5, 0), 6) + 0.0 AS penalty FROM lineitem GROUP BY 1""",
)(
    lambda spark, sf: V.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).select(
        "l_orderkey", (r6(A.overlong_penalty(F.col("n"), 5, 2, 0.5)) + 0.0).alias("penalty")
    )
)
SOURCES = {
    "1-URGENT": "openai/gsm8k",
    "2-HIGH": "searchR1_nq",
    "3-MEDIUM": "math_dapo",
    "4-NOT SPECIFIED": "hiyouga/geometry3k",
    "5-LOW": "somewhere/else",
}


def mixed(spark, sf):
    p = F.col("priority")
    response = (
        F.when(p == "1-URGENT", text(*HASH))
        .when(p == "2-HIGH", text("=<answer>The ", "n", "=</answer>"))
        .when(p == "3-MEDIUM", text(*LINE))
        .otherwise(text("=<think>x</think>\\boxed{", "n", "=}"))
    )
    source = F.create_map(*[L(x) for kv in SOURCES.items() for x in kv])[p]
    return answers(spark, sf).select("sample_id", source.alias("data_source"), response.alias("response"), F.col("truth").alias("ground_truth"), "status")


SOURCE_SQL = "CASE priority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SOURCES.items()) + " END"
register(
    "score_by_source",
    f"""WITH {ANSWERS} SELECT sample_id, {SOURCE_SQL} AS data_source, round(CAST(CASE priority WHEN '3-MEDIUM' THEN CASE WHEN n = truth THEN 1 ELSE -1 END WHEN '4-NOT SPECIFIED' THEN 0.1 + CASE WHEN n = truth THEN 0.9 ELSE 0 END
 WHEN '5-LOW' THEN NULL ELSE CASE WHEN n = truth THEN 1 ELSE 0 END END AS DOUBLE), 6) AS score, CASE priority WHEN '2-HIGH' THEN 'The ' || n WHEN '5-LOW' THEN NULL ELSE n END AS pred,
 CASE WHEN priority = '5-LOW' THEN 'no scoring rule for data source somewhere/else' ELSE '' END AS feedback FROM a""",
)(lambda spark, sf: S.score_by_source(mixed(spark, sf)).select("sample_id", "data_source", r6("score").alias("score"), "pred", "feedback"))


def _user(data_source, solution, truth, extra):
    if data_source == "somewhere/else":
        raise ValueError("no rule")
    return {"score": float(len(truth)), "size": len(solution)}


register(
    "score_user_function",
    f"""WITH {ANSWERS} SELECT sample_id, CAST(CASE WHEN priority = '5-LOW' THEN 0 ELSE length(truth) END AS DOUBLE) AS score,
 CASE WHEN priority = '5-LOW' THEN 'ValueError: no rule' END AS error FROM a""",
)(
    lambda spark, sf: mixed(spark, sf)
    .withColumn("s", S.user_scores(_user)(F.col("data_source"), F.col("response"), F.col("ground_truth"), F.col("status")))
    .select("sample_id", "s.score", "s.error")
)
def _batch(sources, texts, truths):
    if any(t.endswith("77") for t in truths):
        raise ValueError("no rule for 77")
    return [2 * len(t) for t in truths]


register(
    "score_batch_function",
    f"""WITH {ANSWERS} SELECT sample_id, CAST(CASE WHEN truth LIKE '%77' THEN 0 ELSE length(truth) * 2 END AS DOUBLE) AS score,
 CASE WHEN truth LIKE '%77' THEN 'ValueError: no rule for 77' END AS error FROM a""",
)(
    lambda spark, sf: mixed(spark, sf)
    .withColumn("s", S.batch_scores(_batch)(F.col("data_source"), F.col("response"), F.col("ground_truth")))
    .select("sample_id", "s.score", "s.error")
)


def _patient(source, text, truth, extra):
    """A good score; a few answers make the scorer hang, die or raise."""
    import os
    import time

    if truth.endswith("1234"):
        time.sleep(3600)
    if truth.endswith("4321"):
        os._exit(3)
    if extra == "P":
        raise ValueError("no rule")
    return {"score": len(truth), "kind": extra}


def _patient_batch(sources, texts, truths):
    return [_patient(s, x, t, "F")["score"] for s, x, t in zip(sources, texts, truths)]


register(
    "score_with_timeout",
    f"""WITH {ANSWERS} SELECT sample_id, CASE WHEN truth LIKE '%1234' THEN 'timeout after 2 s' WHEN truth LIKE '%4321' THEN 'the scorer''s process ended'
 WHEN status = 'P' THEN 'ValueError: no rule' END AS error, CAST(CASE WHEN truth LIKE '%1234' OR truth LIKE '%4321' OR status = 'P' THEN 0 ELSE length(truth) END AS DOUBLE) AS score,
 CASE WHEN truth NOT LIKE '%1234' AND truth NOT LIKE '%4321' AND status <> 'P' THEN status END AS kind FROM a""",
)(
    lambda spark, sf: mixed(spark, sf)
    .withColumn("s", S.user_scores(_patient, timeout=2)(F.col("data_source"), F.col("response"), F.col("ground_truth"), F.col("status")))
    .select("sample_id", "s.score", "s.error", F.col("s.extras")["kind"].alias("kind"))
)
register(
    "score_batch_with_timeout",
    f"""WITH {ANSWERS} SELECT sample_id, CASE WHEN truth LIKE '%1234' THEN 'timeout after 2 s' WHEN truth LIKE '%4321' THEN 'the scorer''s process ended' END AS error,
 CAST(CASE WHEN truth LIKE '%1234' OR truth LIKE '%4321' THEN 0 ELSE length(truth) END AS DOUBLE) AS score FROM a""",
)(
    lambda spark, sf: mixed(spark, sf)
    .withColumn("s", S.batch_scores(_patient_batch, timeout=2)(F.col("data_source"), F.col("response"), F.col("ground_truth")))
    .select("sample_id", "s.score", "s.error")
)
register(
    "reward_managers",
    """WITH n AS (SELECT o_orderkey AS sample_id, CAST(o_orderstatus = 'F' AS DOUBLE) AS acc, CASE WHEN o_orderstatus = 'P' THEN 0.5 END AS rm, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
 SELECT sample_id, round(CAST(coalesce(rm, acc) AS DOUBLE), 6) AS naive, round(CAST(coalesce(rm, acc + least(-(n - 3) / 2.0, 0)) AS DOUBLE), 6) AS penalised, n > 3 AS overlong FROM n""",
)(
    lambda spark, sf: (
        lambda d: S.MANAGERS["length_penalised"](
            S.MANAGERS["naive"](d, "rm").withColumnRenamed("reward", "naive"), 5, 2, 1.0, "rm"
        ).select("sample_id", r6("naive").alias("naive"), r6("reward").alias("penalised"), "overlong")
    )(
        V.rollouts(spark, sf)
        .select("sample_id", F.col("acc").alias("score"), F.when(F.col("pred") == "P", 0.5).alias("rm"))
        .join(V.loose_tokens(spark, sf).groupBy("sample_id").agg(F.count(F.lit(1)).alias("length")), "sample_id", "left")
        .fillna({"length": 0})
    )
)


def logged_tests(spark, sf):
    ids = ranked(V.table(spark, sf, "lineitem"), ["l_orderkey"], V.TOKEN_ORDER, "pos")
    q = F.col("l_quantity")
    bad = F.col("l_returnflag") == "R"
    out = (
        F.when(bad & (q > 48), L("Time out"))
        .when(bad & (q > 45), L("Error: boom"))
        .when(bad & (q > 42), L("Incorrect format"))
        .otherwise(F.concat(F.col("l_linestatus"), F.col("l_partkey").cast("string")))
    )
    return ids.select(
        F.col("l_orderkey").alias("sample_id"),
        (F.col("pos") - 1).alias("test_idx"),
        F.concat(L("in "), F.col("l_suppkey").cast("string")).alias("input"),
        F.col("l_linestatus").alias("expected"),
        out.alias("actual"),
        (~bad).alias("passed"),
        L("").alias("debug"),
    )


TESTS = """t AS (SELECT l_orderkey AS sample_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) - 1 AS test_idx,
 'in ' || l_suppkey AS input, l_linestatus AS expected, CASE WHEN l_returnflag = 'R' AND l_quantity > 48 THEN 'Time out' WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 'Error: boom'
 WHEN l_returnflag = 'R' AND l_quantity > 42 THEN 'Incorrect format' ELSE l_linestatus || l_partkey END AS actual, l_returnflag <> 'R' AS passed FROM lineitem),
 q AS (SELECT *, CASE WHEN starts_with(actual, 'Error: ') THEN 0 WHEN actual = 'Time out' THEN 1 WHEN actual = 'Incorrect format' THEN 2 ELSE 3 END AS priority FROM t WHERE NOT passed),
 r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY priority, CASE WHEN priority = 3 THEN length(input) + length(actual) ELSE 0 END, test_idx) AS rank, min(priority) OVER (PARTITION BY sample_id) AS lead FROM q),
 k AS (SELECT * FROM r WHERE rank = 1 OR (rank = 2 AND lead = 3))"""
register(
    "select_feedback_tests",
    f"WITH {TESTS} SELECT sample_id, test_idx, priority, CAST(rank AS INTEGER) AS rank FROM k",
)(lambda spark, sf: S.select_feedback_tests(logged_tests(spark, sf)).select("sample_id", "test_idx", "priority", "rank"))
register(
    "render_test_feedback",
    f"""WITH {TESTS}, b AS (SELECT sample_id, rank, CASE priority WHEN 0 THEN 'Runtime Error' || chr(10) || 'boom' || chr(10) || chr(10) || 'Last Executed Input' || chr(10) || input
 WHEN 1 THEN 'Time Limit Exceeded' || chr(10) || chr(10) || 'Last Executed Input' || chr(10) || input WHEN 2 THEN 'Incorrect Format: Put your code inside a ```python ... ``` block.'
 ELSE 'Test Case ' || (test_idx + 1) || ': Wrong Answer' || chr(10) || chr(10) || 'Input' || chr(10) || input || chr(10) || chr(10) || 'Output' || chr(10) || actual || chr(10) || chr(10) || 'Expected' || chr(10) || expected END AS block FROM k),
 f AS (SELECT sample_id, string_agg(block, chr(10) || chr(10) ORDER BY rank) AS feedback FROM b GROUP BY 1)
 SELECT DISTINCT t.sample_id, coalesce(feedback, '') AS feedback FROM t LEFT JOIN f ON f.sample_id = t.sample_id""",
)(lambda spark, sf: S.render_feedback(logged_tests(spark, sf)))
register(
    "attempt_rewards",
    """WITH a AS (SELECT o_custkey AS sample_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS s FROM orders)
 SELECT sample_id, k, CAST(s AS DOUBLE) AS score, CASE WHEN s > coalesce(lag(s) OVER (PARTITION BY sample_id ORDER BY k), 0) THEN 0.0::DOUBLE ELSE -0.05 END AS tool_reward FROM a""",
)(
    lambda spark, sf: (
        lambda r: S.attempt_rewards(r).select("sample_id", "k", "score", "tool_reward")
    )(
        ranked(
            V.table(spark, sf, "orders").select(
                F.col("o_custkey").alias("sample_id"),
                F.col("o_orderkey").alias("attempt"),
                F.when(F.col("o_orderstatus") == "F", L("#### 42")).when(F.col("o_orderstatus") == "O", L("41")).otherwise(L("no idea")).alias("answer"),
                L("42").alias("ground_truth"),
            ),
            ["sample_id"],
            ["attempt"],
            "k",
        )
    )
)
register(
    "turn_verdicts",
    """WITH t AS (SELECT conv_id, arg_max(CASE WHEN turn % 2 = 1 THEN 'so #### ' || turn ELSE 'no' END, turn) FILTER (role = 'assistant') AS t FROM conversations GROUP BY 1)
 SELECT conv_id, CAST(coalesce(t = 'so #### 3', false) AS DOUBLE) AS reward, coalesce(t = 'so #### 3', false) AS finished,
 CASE WHEN t = 'so #### 3' THEN 'Your response is correct!' ELSE 'Your response is incorrect! You need to reflect on your answer and try again.' END AS reply FROM t""",
)(
    lambda spark, sf: S.turn_verdicts(
        V.chats(spark, sf).select(
            "conv_id",
            "turn",
            "role",
            F.when(F.col("turn") % 2 == 1, F.concat(L("so #### "), F.col("turn").cast("string"))).otherwise(L("no")).alias("text"),
        ),
        V.chats(spark, sf).select("conv_id").distinct().withColumn("ground_truth", L("3")),
    )
)
