"""Registered queries of the corpus, chat and join families, on parts, documents and conversations."""

import re

from pyspark.sql import functions as F

from tallyspan.operators import algebra as G
from tallyspan.operators import chat as H
from tallyspan.operators import corpus as C
from tallyspan.operators import filters as X
from tallyspan.operators import joins as J
from tallyspan.plans import register
from tallyspan.plans.advantage import r6
from tallyspan.plans.metrics import PAIRS_SQL, document_pairs
from tallyspan.plans.offpolicy import rounded
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views
from tallyspan.spread import ranked

L = F.lit


def q(text):
    """A fixed text as a SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def raw_corpus(spark, sf):
    """Parts as a question set; brands stand for kinds and sources."""
    size = F.col("p_size")
    return V.table(spark, sf, "part").select(
        "p_partkey",
        F.when(size % 3 == 0, "code").otherwise("math").alias("kind"),
        F.when(size % 5 == 0, "livecodebench").when(size % 5 != 1, F.col("p_brand")).alias("dataset"),
        F.when(size % 4 != 0, F.col("p_retailprice").cast("int").cast("string")).alias("answer"),
        F.concat(L("def f(self, x): "), F.col("p_name")).alias("prompt"),
        F.concat(L("Use f(self, "), F.col("p_name"), L(")")).alias("description"),
        F.when(size % 3 == 0, F.concat(L('{"n": '), size.cast("string"), L("}"))).alias("tests"),
        F.when(size % 2 == 0, F.concat(L("You are "), F.col("p_type"))).alias("system"),
        size.alias("achievement_prior"),
    )


RAW = """raw AS (SELECT p_partkey, p_size, CASE WHEN p_size % 3 = 0 THEN 'code' ELSE 'math' END AS kind, CASE WHEN p_size % 5 = 0 THEN 'livecodebench' WHEN p_size % 5 <> 1 THEN p_brand END AS dataset,
 CASE WHEN p_size % 4 <> 0 THEN CAST(CAST(floor(p_retailprice) AS INTEGER) AS VARCHAR) END AS answer, 'def f(self, x): ' || p_name AS prompt, 'Use f(self, ' || p_name || ')' AS description,
 CASE WHEN p_size % 3 = 0 THEN '{"n": ' || p_size || '}' END AS tests, CASE WHEN p_size % 2 = 0 THEN 'You are ' || p_type END AS system FROM part),
 norm AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS idx, kind, coalesce(dataset, '-') AS dataset, coalesce(answer, '-') AS answer, '-' AS elo, prompt,
 description || ' The solution will be evaluated in a ' || kind || ' environment.' AS description, coalesce(tests, '-') AS tests, system FROM raw)"""
register("corpus_normalise", f"WITH {RAW} SELECT * FROM norm WHERE idx >= 10 AND idx < 1510")(
    lambda spark, sf: C.normalise_corpus(raw_corpus(spark, sf), "parts", ["p_partkey"], 10, 1500)
)


def rl(spark, sf, split="train"):
    return C.rl_rows(C.normalise_corpus(raw_corpus(spark, sf), "parts", ["p_partkey"]), split)


register(
    "corpus_to_rl",
    f"""WITH {RAW}, r AS (SELECT *, CASE WHEN dataset = 'livecodebench' THEN replace(prompt, '(self, ', '(') ELSE prompt END AS p, CASE WHEN dataset = 'livecodebench' THEN replace(description, '(self, ', '(') ELSE description END AS d FROM norm)
 SELECT dataset AS data_source, CASE WHEN system IS NULL THEN 1 ELSE 2 END AS messages, system, p AS question, kind AS ability, CASE WHEN kind = 'code' THEN tests ELSE answer END AS ground_truth, CAST(idx AS VARCHAR) AS index, d AS description FROM r""",
)(
    lambda spark, sf: rl(spark, sf).select(
        "data_source",
        F.size("prompt").alias("messages"),
        F.when(F.size("prompt") == 2, F.col("prompt")[0]["content"]).alias("system"),
        F.element_at("prompt", -1)["content"].alias("question"),
        "ability",
        F.col("reward_model.ground_truth").alias("ground_truth"),
        F.col("extra_info.index").alias("index"),
        F.col("extra_info.description").alias("description"),
    )
)
register(
    "corpus_embeddings",
    "SELECT doc_id AS idx, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM documents LEFT JOIN embeddings ON vec_id = doc_id",
)(
    lambda spark, sf: C.with_embeddings(
        V.table(spark, sf, "documents").select(F.col("doc_id").alias("idx")), V.table(spark, sf, "embeddings").withColumnRenamed("vec_id", "idx")
    ).select("idx", r6(F.col("embedding")[0].cast("double")).alias("first"))
)
OPTS = ["p_name", "p_brand", "p_type", "CAST(p_size AS VARCHAR)"]


def choices(spark, sf):
    p = V.table(spark, sf, "part")
    texts = F.array("p_name", "p_brand", "p_type", F.col("p_size").cast("string"))
    return p.select(
        "p_partkey",
        F.concat(L("Pick "), F.col("p_name")).alias("question"),
        F.array(*[L(x) for x in "ABCD"]).alias("labels"),
        texts.alias("texts"),
        L("B").alias("answer_key"),
        F.col("p_name").alias("right"),
        F.array("p_brand", "p_type", F.col("p_size").cast("string")).alias("wrong"),
        F.col("p_type").alias("category"),
    )


register(
    "choice_rows_labelled",
    f"""SELECT p_partkey, md5({q(C.MCQ_SYSTEM)}) AS system_md5, 'Pick ' || p_name || chr(10) || chr(10) || 'A: ' || p_name || chr(10) || 'B: ' || p_brand || chr(10) || 'C: ' || p_type || chr(10) || 'D: ' || p_size || chr(10) || 'Please reason step by step.' AS prompt, 'B' AS answer, 1500 AS elo FROM part""",
)(lambda spark, sf: labelled(spark, sf))


def labelled(spark, sf):
    c = choices(spark, sf)
    rows = C.labelled_choice_rows(c.withColumn("question", F.concat(F.col("p_partkey").cast("string"), L("#"), F.col("question"))))
    key = F.substring_index("prompt", "#", 1).cast("long")
    return rows.select(
        key.alias("p_partkey"),
        F.md5("system").alias("system_md5"),
        F.substring(F.col("prompt"), F.length(key.cast("string")) + 2, F.length("prompt")).alias("prompt"),
        "answer",
        "elo",
    )


_H = [f"md5(concat_ws(':', '5', p_partkey, {i}))" for i in range(4)]
register(
    "choice_rows_shuffled",
    f"""WITH o AS (SELECT p_partkey, p_name, unnest([{', '.join(f'{{h: {h}, i: {i}, o: {o}}}' for i, (h, o) in enumerate(zip(_H, OPTS, strict=True)))}]) AS x FROM part),
 r AS (SELECT p_partkey, p_name, x.i AS i, x.o AS o, row_number() OVER (PARTITION BY p_partkey ORDER BY x.h, x.i) AS k FROM o)
 SELECT p_partkey, chr(CAST(64 + max(CASE WHEN i = 0 THEN k END) AS INTEGER)) AS answer, {q(C.GPQA_PROMPT.split('{problem}')[0])} || 'Pick ' || any_value(p_name) || chr(10) || 'Options: ' || string_agg(chr(CAST(64 + k AS INTEGER)) || ') ' || o, ', ' ORDER BY k) || chr(10) || 'Answer:' AS prompt FROM r GROUP BY 1""",
)(lambda spark, sf: C.shuffled_choice_rows(choices(spark, sf), "p_partkey", 5).select("p_partkey", "answer", "prompt"))
_LIST = lambda m: " || ".join(f"'{x}{m}' || {o} || chr(10)" for x, o in zip("ABCD", OPTS, strict=True))
register(
    "choice_prompts_lettered",
    f"""SELECT p_partkey, replace({q(C.SUBJECT_INTRO)}, '{{subject}}', p_type) || chr(10) || 'Question:' || chr(10) || 'Pick ' || p_name || chr(10) || 'Options:' || chr(10) || {_LIST('. ')} || 'Answer: Let''s think step by step.' AS subject_prompt,
 'Pick ' || p_name || chr(10) || 'Options are:' || chr(10) || {_LIST(': ')} || {q(C.BOX_LETTER)} AS boxed_prompt FROM part""",
)(
    lambda spark, sf: choices(spark, sf).select(
        "p_partkey",
        C.lettered_choice_prompt(F.col("question"), F.col("texts"), F.col("category")).alias("subject_prompt"),
        C.lettered_choice_prompt(F.col("question"), F.col("texts"), F.col("category"), "boxed").alias("boxed_prompt"),
    )
)
MP = C.MATH_PROMPT.split("{problem}")[1]


def maths(spark, sf):
    p = V.table(spark, sf, "part")
    n = F.col("p_size").cast("string")
    text = F.concat(F.col("p_partkey").cast("string"), L(" "), F.col("p_name"))
    parts = [
        C.maths_rows(p.select(text.alias("problem"), F.concat(L("\\boxed{"), n, L("}")).alias("solution")), "aime24"),
        C.maths_rows(p.select(text.alias("question"), F.concat(L("so 3 #### "), n, L(".5 end")).alias("answer")), "gsm8k"),
        C.maths_rows(p.select(text.alias("problem"), F.col("p_size").alias("answer")), "math500"),
    ]
    return G.concat(parts)


register(
    "maths_rows",
    f"""WITH s AS (SELECT unnest(['aime24', 'gsm8k', 'math500']) AS dataset, * FROM part)
 SELECT dataset, p_partkey || ' ' || p_name AS description, p_partkey || ' ' || p_name || {q(MP)} AS prompt, p_size || CASE WHEN dataset = 'gsm8k' THEN '.5' ELSE '' END AS answer FROM s""",
)(lambda spark, sf: maths(spark, sf).select("dataset", "description", "prompt", "answer"))
register(
    "training_prompts",
    f"""WITH {RAW} SELECT p_partkey, md5(CASE WHEN kind = 'code' THEN replace({q(C.CODE_PROMPT)}, '{{problem}}', prompt) ELSE prompt || {q(MP)} END) AS prompt_md5 FROM raw""",
)(
    lambda spark, sf: C.training_prompts(raw_corpus(spark, sf).withColumn("problem", F.col("prompt"))).select("p_partkey", F.md5("prompt").alias("prompt_md5"))
)


def code_source(spark, sf):
    p = V.table(spark, sf, "part")
    n = F.col("p_size").cast("string")
    test = F.struct(F.col("p_name").alias("input"), n.alias("output"))
    return p.select(
        F.col("p_partkey").alias("row_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") % 2 == 0, F.concat(n, L(" seconds"))).alias("time_limit"),
        F.concat(L("About "), F.col("p_name")).alias("description"),
        L("one line").alias("input_format"),
        L("a number").alias("output_format"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise(L("")).alias("note"),
        F.array(test, test).alias("tests"),
        F.col("p_size").alias("elo"),
        F.concat(F.col("p_name"), L(" problem text.\nInput\n1\n")).alias("question"),
        F.when(F.col("p_size") % 2 == 0, F.concat(L("class S:\n    def solve"), n, L("(x):\n Input\nmore"))).otherwise(L("")).alias("starter_code"),
        F.array("p_name").alias("inputs"),
        F.array(n).alias("outputs"),
        F.when(F.col("p_size") % 2 == 0, F.concat(L("solve"), n)).alias("fn_name"),
        F.concat(L('def go(x):\n    """Return '), F.col("p_name"), L('.\n    >>> go(1)\n    """\n')).alias("prompt"),
        L("go").alias("entry_point"),
        L("assert go(1)").alias("test"),
        F.concat(L("import re\ndef  run"), n, L("(a, b):\n  pass")).alias("code"),
        F.array(L("import math"), L("import re")).alias("test_imports"),
    )


register(
    "code_rows_stdin",
    """SELECT p_partkey AS row_id, 'codeforces' AS dataset, p_size AS elo, '<html><body><h1>' || p_name || '</h1>' || coalesce('<div>Time limit per test: ' || CASE WHEN p_size % 2 = 0 THEN p_size || ' seconds' END || ' s</div>', '<div>Time limit per test: - s</div>') || '<h2>Description</h2><div>About ' || p_name || '</div><h2>Input Format</h2><div>one line</div><h2>Output Format</h2><div>a number</div>'
 || CASE WHEN p_size % 3 = 0 THEN '<h2>Note</h2><div>' || p_type || '</div>' ELSE '' END || '</body></html>' AS problem,
 '{"inputs":["' || p_name || '","' || p_name || '"],"outputs":["' || p_size || '","' || p_size || '"],"testtype":"stdin","fn_name":"","time_limit":' || CASE WHEN p_size % 2 = 0 THEN p_size || '.0' ELSE '1.0' END || '}' AS tests FROM part""",
)(
    lambda spark, sf: C.stdin_code_rows(code_source(spark, sf), "codeforces").select("row_id", "dataset", "elo", "problem", "tests")
)
register(
    "code_rows_starter",
    """SELECT p_partkey AS row_id, p_name || ' problem text.' AS description, p_name || ' problem text.' || chr(10) || 'Input' || chr(10) || '1' || chr(10) || CASE WHEN p_size % 2 = 0 THEN chr(10) || chr(10) || 'Your solution should have the following signature: ```python' || chr(10) || 'def solve' || p_size || '(x):' || chr(10) || '```' ELSE '' END AS problem,
 '{"inputs":["' || p_name || '"],"outputs":["' || p_size || '"],"testtype":"' || CASE WHEN p_size % 2 = 0 THEN 'functional","fn_name":"solve' || p_size ELSE 'stdin","fn_name":"' END || '","time_limit":1.0}' AS tests FROM part""",
)(lambda spark, sf: C.starter_code_rows(code_source(spark, sf), "taco").select("row_id", "description", "problem", "tests"))
register(
    "code_rows_completion",
    f"""SELECT p_partkey AS row_id, 'Return ' || p_name || '.' AS description, md5(replace({q(C.CODE_PROMPT)}, '{{problem}}', replace({q(C.COMPLETE_FUNCTION)}, '{{prefix}}', 'def go(x):' || chr(10) || '    \"\"\"Return ' || p_name || '.' || chr(10) || '    >>> go(1)' || chr(10) || '    \"\"\"' || chr(10)))) AS prompt_md5,
 '{{"inputs":["assert go(1)\\ncheck(go)"],"outputs":[""],"testtype":"code","fn_name":"","time_limit":1.0}}' AS tests FROM part""",
)(lambda spark, sf: C.completion_code_rows(code_source(spark, sf)).select("row_id", "description", F.md5("prompt").alias("prompt_md5"), "tests"))
register(
    "code_rows_named",
    f"""SELECT p_partkey AS row_id, md5(replace({q(C.CODE_PROMPT)}, '{{problem}}', p_name || ' The function should be called `run' || p_size || '`.')) AS prompt_md5,
 '{{"inputs":["import math\\nimport re\\nassert go(1)"],"outputs":[""],"testtype":"code","fn_name":"","time_limit":1.0}}' AS tests FROM part""",
)(
    lambda spark, sf: C.named_function_rows(code_source(spark, sf).withColumn("prompt", F.col("title"))).select(
        "row_id", F.md5("prompt").alias("prompt_md5"), "tests"
    )
)


def word_problems(spark, sf):
    p = V.table(spark, sf, "part")
    n = F.col("p_size").cast("string")
    return p.select(
        "p_partkey",
        F.concat(L("How many "), F.col("p_name"), L("s?")).alias("question"),
        F.concat(L("count them. #### 1,"), n).alias("answer"),
        F.concat(L("Solve "), F.col("p_name")).alias("problem"),
        F.concat(L("thus \\boxed{\\frac{"), n, L("}{3}}")).alias("solution"),
        F.array(F.col("p_brand")).alias("images"),
        F.col("p_type").alias("activity"),
        F.col("p_name").alias("ctx_a"),
        F.concat(L("it [title]IS "), F.col("p_name")).alias("ctx_b"),
        F.array(F.col("p_brand"), F.concat(F.col("p_brand"), L(" [x]  y"))).alias("endings"),
        F.when(F.col("p_size") % 2 == 0, L("1")).otherwise(L("")).alias("label"),
    )


def flat_rl(d, *more):
    return d.select(
        F.col("extra_info.index").alias("index"),
        "data_source",
        F.element_at("prompt", -1)["content"].alias("question"),
        F.size("prompt").alias("messages"),
        F.col("reward_model.ground_truth").alias("ground_truth"),
        *more,
    )


register(
    "rl_rows_grade_school",
    f"""SELECT p_partkey AS index, 'openai/gsm8k' AS data_source, 'How many ' || p_name || 's? ' || {q(C.HASH_HINT)} AS question, 1 AS messages, '1' || p_size AS ground_truth, 'How many ' || p_name || 's?' AS raw FROM part""",
)(lambda spark, sf: flat_rl(C.grade_school_rows(word_problems(spark, sf).drop("images"), "train", "p_partkey"), F.col("extra_info.question").alias("raw")))
register(
    "rl_rows_competition",
    f"""SELECT p_partkey AS index, 'DigitalLearningGmbH/MATH-lighteval' AS data_source, 'Solve ' || p_name || ' ' || {q(C.BOX_HINT)} AS question, 1 AS messages, '\\frac{{' || p_size || '}}{{3}}' AS ground_truth FROM part""",
)(lambda spark, sf: flat_rl(C.competition_rows(word_problems(spark, sf).drop("images"), "train", "p_partkey")))
register(
    "rl_rows_geometry",
    f"""SELECT p_partkey AS index, 'hiyouga/geometry3k' AS data_source, 'Solve ' || p_name || ' ' || {q(C.THINK_HINT)} AS question, 1 AS messages, 'count them. #### 1,' || p_size AS ground_truth, p_brand AS image FROM part""",
)(lambda spark, sf: flat_rl(C.geometry_rows(word_problems(spark, sf), "train", "p_partkey"), F.col("images")[0].alias("image")))
register(
    "rl_rows_endings",
    """SELECT p_partkey AS index, 'Rowan/hellaswag' AS data_source, p_type || ': ' || p_name || ' It. is ' || lower(p_name) AS question, 1 AS messages, 1 AS ground_truth, p_brand || '  y' AS second FROM part WHERE p_size % 2 = 0""",
)(
    lambda spark, sf: flat_rl(
        C.ending_rows(word_problems(spark, sf).withColumn("ctx_b", F.concat(L("it [title] IS "), F.col("ctx_a"))), "train", "p_partkey"),
        F.col("reward_model.choices")[1].alias("second"),
    )
)


register(
    "rl_rows_with_tool",
    f"""SELECT p_partkey AS index, 'openai/gsm8k' AS data_source, 'How many ' || p_name || 's? ' || {q(C.TICK_HINT)} AS question, 2 AS messages, '1' || p_size AS ground_truth, true AS needs, '1' || p_size AS tool_truth, '1' || p_size AS asked_truth, 'gsm8k' AS name FROM part""",
)(
    lambda spark, sf: flat_rl(
        C.with_interaction(
            C.with_tool(
                C.grade_school_rows(word_problems(spark, sf).drop("images"), "train", "p_partkey", C.MATH_EXPERT, C.TICK_HINT), "calc_gsm8k_reward"
            ),
            "gsm8k",
        ),
        F.col("extra_info.need_tools_kwargs").alias("needs"),
        F.col("extra_info.tools_kwargs.calc_gsm8k_reward.create_kwargs.ground_truth").alias("tool_truth"),
        F.col("extra_info.interaction_kwargs.ground_truth").alias("asked_truth"),
        F.col("extra_info.interaction_kwargs.name").alias("name"),
    )
)
register(
    "rl_rows_search",
    """SELECT p_partkey AS index, 'searchR1_' || p_type AS data_source, 'Find it: who has ' || p_name || '?' AS question, 2 AS messages, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_name END AS ground_truth FROM part""",
)(
    lambda spark, sf: C.search_rows(
        V.table(spark, sf, "part").select(
            "p_partkey",
            F.concat(L("who has "), F.col("p_name"), L("?")).alias("question"),
            F.col("p_type").alias("data_source"),
            L("qa").alias("ability"),
            F.when(F.col("p_size") % 2 == 0, F.struct(F.array("p_brand").alias("ground_truth"))).alias("reward_model"),
            F.array("p_name").alias("golden_answers"),
        ),
        "train",
        "p_partkey",
        "You search.",
        "Find it: \n",
    ).select(
        F.col("extra_info.index").alias("index"),
        "data_source",
        F.element_at("prompt", -1)["content"].alias("question"),
        F.size("prompt").alias("messages"),
        F.col("extra_info.tools_kwargs.search.create_kwargs.ground_truth")[0].alias("ground_truth"),
    )
)


def pairs(spark, sf):
    return document_pairs(spark, sf).select("pair_id", "bad_id", "lang", "prompt", "chosen", "rejected")


register(
    "sft_rows_from_pairs",
    f"WITH {PAIRS_SQL} SELECT prompt, md5(chosen) AS response_md5 FROM pairs UNION ALL SELECT prompt, md5(rejected) FROM pairs",
)(lambda spark, sf: C.response_rows(pairs(spark, sf)).select("prompt", F.md5("response").alias("response_md5")))
register(
    "reward_model_rows",
    f"""WITH {PAIRS_SQL}, x AS (SELECT pair_id, row_number() OVER (ORDER BY pair_id) - 1 AS idx, count(*) OVER () AS n FROM pairs)
 SELECT idx, 'train' AS split FROM x WHERE idx < round(n * 0.75) UNION ALL SELECT idx, 'test' FROM x WHERE idx >= n - round(n * 0.25)""",
)(lambda spark, sf: C.reward_model_rows(G.with_index(pairs(spark, sf), ["pair_id"])).select("idx", "split"))
register(
    "alignment_rows",
    """SELECT doc_id AS index, md5(text) AS prompt_md5, lang AS ground_truth FROM documents""",
)(
    lambda spark, sf: C.alignment_rows(
        V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("prompt"), F.col("lang").alias("response")), "train", "doc_id"
    ).select(F.col("extra_info.index").alias("index"), F.md5(F.col("prompt")[0]["content"]).alias("prompt_md5"), F.col("reward_model.ground_truth").alias("ground_truth"))
)
CHAT_SQL = "string_agg({role} || '=' || text, '|' ORDER BY turn)"
register(
    "shared_chat_rows",
    f"""SELECT conv_id, md5({CHAT_SQL.format(role="CASE role WHEN 'assistant' THEN 'assistant' ELSE 'user' END")}) AS chat_md5 FROM conversations GROUP BY 1""",
)(
    lambda spark, sf: C.shared_chat_rows(shared(spark, sf)
    ).select("conv_id", F.md5(F.array_join(F.transform("messages", lambda m: F.concat(m["role"], L("="), m["content"])), "|")).alias("chat_md5"))
)


def shared(spark, sf):
    lists = G.to_lists(V.chats(spark, sf), ["conv_id"], "turn", ["role", "text"])
    said = F.zip_with("role", "text", lambda r, t: F.struct(F.when(r == "assistant", "gpt").otherwise("human").alias("from"), t.alias("value")))
    return lists.select("conv_id", said.alias("conversations"))


register(
    "chat_rows",
    f"SELECT conv_id, count(*)::INTEGER AS turns, md5({CHAT_SQL.format(role='role')}) AS chat_md5 FROM conversations GROUP BY 1",
)(
    lambda spark, sf: G.to_lists(V.chats(spark, sf), ["conv_id"], "turn", ["role", "text"]).select(
        "conv_id", F.size("role").alias("turns"), F.md5(F.array_join(F.zip_with("role", "text", lambda r, t: F.concat(r, L("="), t)), "|")).alias("chat_md5")
    )
)
register(
    "single_turn_rows",
    f"SELECT p_partkey, 'How many ' || p_name || 's? ' || {q(C.HASH_HINT)} AS asked, 'count them. #### 1,' || p_size AS said FROM part",
)(
    lambda spark, sf: C.single_turn_rows(word_problems(spark, sf).select("p_partkey", "question", "answer")).select(
        "p_partkey", F.col("messages")[0]["content"].alias("asked"), F.col("messages")[1]["content"].alias("said")
    )
)


def loose_pairs(spark, sf):
    d = V.table(spark, sf, "documents")
    n = V.table(spark, sf, "labels")
    d = d.join(n, "doc_id", "left")
    return d.select(
        "doc_id",
        F.col("source").alias("prompt"),
        F.array("lang", "source").alias("chosen"),
        F.when(F.col("quality") == 1, F.col("lang")).alias("rejected"),
    )


register(
    "preference_rows",
    """SELECT doc_id, mode, source || ':' || mode AS prompt, '["' || lang || '","' || source || '"]' AS chosen, lang AS rejected FROM documents JOIN labels USING (doc_id), (SELECT unnest(['think', 'nothink']) AS mode) WHERE quality = 1""",
)(
    lambda spark, sf: C.preference_rows(loose_pairs(spark, sf), ["think", "nothink"], lambda p, m: F.concat(p, L(":"), m)).select(
        "doc_id", "mode", "prompt", "chosen", "rejected"
    )
)


def cross_pairs(spark, sf):
    return pairs(spark, sf).select(
        "pair_id",
        "lang",
        F.concat(F.col("prompt"), L("+")).alias("chosen_prompt"),
        F.concat(F.col("prompt"), L("-")).alias("rejected_prompt"),
        F.col("chosen").alias("chosen_response"),
        F.when(F.col("bad_id") % 3 != 0, F.col("rejected")).alias("rejected_response"),
    )


register(
    "unpaired_rows",
    f"""WITH {PAIRS_SQL}, k AS (SELECT * FROM pairs WHERE bad_id % 3 <> 0)
 SELECT pair_id, prompt || '+' AS prompt, md5(chosen) AS completion_md5, true AS label FROM k UNION ALL SELECT pair_id, prompt || '-', md5(rejected), false FROM k""",
)(
    lambda spark, sf: C.unpaired_rows(cross_pairs(spark, sf)).select("pair_id", "prompt", F.md5("completion").alias("completion_md5"), "label")
)
register(
    "label_balance",
    f"""WITH {PAIRS_SQL} SELECT lang, count(*) FILTER (bad_id % 3 <> 0) AS positive, count(*) FILTER (bad_id % 3 <> 0) AS negative, 0.5::DOUBLE AS positive_share FROM pairs WHERE bad_id % 3 <> 0 GROUP BY 1""",
)(lambda spark, sf: C.label_balance(C.unpaired_rows(cross_pairs(spark, sf)), ["lang"]))

# ---- token rows --------------------------------------------------------------------------

WORDS = "'[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]'"


def lengths_as_ids(text):
    return F.transform(F.regexp_extract_all(text, L(r"([A-Za-z0-9_]+|[^A-Za-z0-9_\s])"), L(1)), lambda w: F.length(w))


register(
    "sft_token_rows",
    f"""WITH w AS (SELECT p_partkey, len(regexp_extract_all('Pick ' || p_name || ' of ' || p_brand, {WORDS})) AS np, len(regexp_extract_all(p_type || ' size ' || p_size, {WORDS})) + 1 AS nr,
 list_concat(list_transform(regexp_extract_all('Pick ' || p_name || ' of ' || p_brand || ' ' || p_type || ' size ' || p_size, {WORDS}), lambda x: length(x)), [1]) AS ids FROM part),
 c AS (SELECT *, least(np + nr, 9) AS n FROM w)
 SELECT p_partkey, array_to_string(list_concat(ids[:9], list_transform(range(9 - n), lambda x: 0)), ',') AS input_ids, n::BIGINT AS attended,
 array_to_string(list_transform(range(9), lambda i: CASE WHEN i < least(np, 9) - 1 OR i >= n - 1 THEN 0 ELSE 1 END), '') AS loss_mask FROM c""",
)(
    lambda spark, sf: H.sft_rows(
        V.table(spark, sf, "part").select(
            "p_partkey",
            F.concat(L("Pick "), F.col("p_name"), L(" of "), F.col("p_brand")).alias("p"),
            F.concat(F.col("p_type"), L(" size "), F.col("p_size").cast("string")).alias("r"),
        ),
        "p",
        "r",
        9,
        lengths_as_ids,
        truncation="right",
    ).select(
        "p_partkey",
        F.array_join(F.col("input_ids").cast("array<string>"), ",").alias("input_ids"),
        F.aggregate("attention_mask", L(0).cast("long"), lambda a, x: a + x).alias("attended"),
        F.array_join(F.col("loss_mask").cast("array<string>"), "").alias("loss_mask"),
    )
)
register(
    "chat_loss_mask",
    f"""WITH t AS (SELECT conv_id, role, 3 + 1 AS head, len(regexp_extract_all(text, {WORDS})) AS n FROM conversations)
 SELECT conv_id, CAST(sum(head + n) AS BIGINT) AS tokens, CAST(sum(CASE WHEN role = 'assistant' THEN n ELSE 0 END) AS BIGINT) AS trained FROM t GROUP BY 1""",
)(
    lambda spark, sf: G.to_lists(V.chats(spark, sf), ["conv_id"], "turn", ["role", "text"])
    .withColumn("messages", F.zip_with("role", "text", lambda r, t: F.struct(r.alias("role"), t.alias("content"))))
    .withColumn("mask", H.chat_loss_mask(F.col("messages")))
    .select("conv_id", F.size("mask").cast("long").alias("tokens"), F.aggregate("mask", L(0).cast("long"), lambda a, x: a + x).alias("trained"))
)
register(
    "pair_token_rows",
    f"""WITH i AS (SELECT p_partkey, list_concat(list_transform(regexp_extract_all(p_name || ' ' || p_brand, {WORDS}), lambda x: length(x)), [1]) AS c, list_concat(list_transform(regexp_extract_all(p_name || ' ' || p_type || ' size ' || p_size, {WORDS}), lambda x: length(x)), [1]) AS r FROM part)
 SELECT p_partkey, array_to_string(list_concat(c[:5], list_transform(range(5 - len(c)), lambda x: 0)), ',') AS chosen_ids, array_to_string(list_concat(r[:5], list_transform(range(5 - len(r)), lambda x: 0)), ',') AS rejected_ids, least(len(c), 5)::BIGINT AS attended FROM i""",
)(
    lambda spark, sf: H.pair_rows(
        V.table(spark, sf, "part").select(
            "p_partkey",
            F.col("p_name").alias("prompt"),
            F.col("p_brand").alias("chosen"),
            F.concat(F.col("p_type"), L(" size "), F.col("p_size").cast("string")).alias("rejected"),
        ),
        "prompt",
        5,
        lengths_as_ids,
    ).select(
        "p_partkey",
        F.array_join(F.col("chosen_ids").cast("array<string>"), ",").alias("chosen_ids"),
        F.array_join(F.col("rejected_ids").cast("array<string>"), ",").alias("rejected_ids"),
        F.aggregate("chosen_mask", L(0).cast("long"), lambda a, x: a + x).alias("attended"),
    )
)
register(
    "media_parts",
    "SELECT p_partkey, 'image,text' || CASE WHEN p_size % 2 = 0 THEN ',video,text' ELSE '' END AS kinds, ' see ' || p_name AS first_text FROM part",
)(
    lambda spark, sf: V.table(spark, sf, "part")
    .withColumn("t", F.concat(L("<image> see "), F.col("p_name"), F.when(F.col("p_size") % 2 == 0, "<video> now").otherwise("")))
    .withColumn("m", H.media_parts(F.col("t"), L(1), F.when(F.col("p_size") % 2 == 0, 1).otherwise(0)))
    .select("p_partkey", F.array_join(F.transform("m", lambda x: x["type"]), ",").alias("kinds"), F.col("m")[1]["text"].alias("first_text"))
)

# ---- joins -------------------------------------------------------------------------------


def answered(spark, sf):
    r = V.rollouts(spark, sf)
    letter = F.substring(L("ABCD"), (F.col("sample_id") % 4 + 1).cast("int"), L(1))
    text = F.concat(L("<think>hm</think>try <answer>"), letter, L("</answer> "), F.col("sample_id").cast("string"))
    return r.select(
        "sample_id",
        "uid",
        "step",
        F.col("acc").alias("score"),
        text.alias("response"),
        F.concat(L("Q"), F.col("uid").cast("string")).alias("prompt"),
        F.when(F.col("pred") == "P", L("too slow")).when(F.col("pred") == "O", L(" ")).alias("feedback"),
    )


DEMO = """an AS (SELECT sample_id, uid, step, acc AS score, pred, 'try <answer>' || substring('ABCD', CAST(sample_id % 4 + 1 AS INTEGER), 1) || '</answer> ' || sample_id AS response FROM rollouts),
 w AS (SELECT uid, sample_id, response, row_number() OVER (PARTITION BY uid ORDER BY md5(concat_ws(':', '1', uid, sample_id)), sample_id) AS k FROM an WHERE score >= 1),
 dm AS (SELECT an.*, CASE WHEN a.sample_id = an.sample_id THEN b.sample_id ELSE a.sample_id END AS demo_id, CASE WHEN a.sample_id = an.sample_id THEN b.response ELSE a.response END AS demo
 FROM an LEFT JOIN w a ON a.uid = an.uid AND a.k = 1 LEFT JOIN w b ON b.uid = an.uid AND b.k = 2)"""


def demos(spark, sf, **options):
    return J.demonstrations(answered(spark, sf), 1.0, seed=1, strip_thinking=True, **options)


register("demonstrations", with_views("rollouts", f"WITH {DEMO} SELECT sample_id, uid, demo_id, demo FROM dm"))(
    lambda spark, sf: demos(spark, sf).select("sample_id", "uid", "demo_id", "demo")
)
register(
    "demonstrations_prefer_self",
    with_views("rollouts", f"WITH {DEMO} SELECT sample_id, uid, CASE WHEN score >= 1 THEN sample_id ELSE demo_id END AS demo_id FROM dm"),
)(lambda spark, sf: demos(spark, sf, prefer_self=True).select("sample_id", "uid", "demo_id"))
register(
    "demonstrations_fallback_to_self",
    with_views("rollouts", f"WITH {DEMO} SELECT sample_id, uid, CASE WHEN score >= 1 THEN coalesce(demo_id, sample_id) ELSE demo_id END AS demo_id FROM dm"),
)(lambda spark, sf: demos(spark, sf, fallback_to_self=True).select("sample_id", "uid", "demo_id"))
register(
    "greedy_baseline",
    with_views(
        "rollouts", "WITH g AS (SELECT uid, arg_min(score, sample_id) AS b FROM rollouts GROUP BY 1) SELECT sample_id, round(score - b, 6) AS gain FROM rollouts JOIN g USING (uid)"
    ),
)(
    lambda spark, sf: J.greedy_baseline(
        V.rollouts(spark, sf), V.rollouts(spark, sf).groupBy("uid").agg(F.min_by("score", "sample_id").alias("reward"))
    ).select("sample_id", r6(F.col("score") - F.col("baseline")).alias("gain"))
)
register(
    "mine_pairs",
    with_views(
        "rollouts",
        """WITH r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, sample_id) AS b, row_number() OVER (PARTITION BY uid ORDER BY score, sample_id) AS w FROM rollouts)
 SELECT x.uid, x.sample_id AS chosen_id, y.sample_id AS rejected_id, round(x.score - y.score, 6) AS margin FROM r x JOIN r y ON x.uid = y.uid AND x.b = 1 AND y.w = 1 WHERE x.score > y.score""",
    ),
)(
    lambda spark, sf: J.mine_pairs(V.rollouts(spark, sf).withColumn("response", F.col("pred"))).select(
        "uid", "chosen_id", "rejected_id", r6(F.col("chosen_score") - F.col("rejected_score")).alias("margin")
    )
)
register(
    "merge_validation_results",
    with_views(
        "rollouts",
        "SELECT data_source, uid, count(acc) AS accs, count(score) AS scores FROM (SELECT data_source, uid, acc, NULL::DOUBLE AS score FROM rollouts WHERE pred <> 'P' UNION ALL SELECT data_source, uid, NULL, score FROM rollouts WHERE pred = 'P') GROUP BY 1, 2",
    ),
)(
    lambda spark, sf: J.merge_results(
        V.rollouts(spark, sf).filter("pred <> 'P'").select("data_source", "uid", "acc"),
        V.rollouts(spark, sf).filter("pred = 'P'").select("data_source", "uid", "score"),
        ["data_source", "uid"],
    )
    .groupBy("data_source", "uid")
    .agg(F.count("acc").alias("accs"), F.count("score").alias("scores"))
)
register(
    "groups_with_success",
    with_views("rollouts", "SELECT sample_id FROM rollouts WHERE uid IN (SELECT uid FROM rollouts WHERE acc >= 1)"),
)(lambda spark, sf: J.with_success(answered(spark, sf), 1.0).select("sample_id"))
TEACH = f"""{DEMO}, t AS (SELECT *, 'Q' || uid AS prompt, pred = 'P' AS told, pred = 'P' AND demo IS NULL AS used FROM dm),
 p AS (SELECT *, CASE WHEN demo IS NOT NULL OR used THEN prompt || coalesce({q(J.SOLUTION_TEXT.replace('{}', ''))} || demo, '') || CASE WHEN used THEN {q(J.FEEDBACK_TEXT.replace('{}', ''))} || 'too slow' ELSE '' END || {q(J.CLOSING_TEXT)} ELSE prompt END AS teacher_prompt,
 regexp_extract(demo, '<answer>([A-D])</answer>', 1) AS letter FROM t)"""
register(
    "teacher_prompts",
    with_views("rollouts", f"WITH {TEACH} SELECT sample_id, told AS feedback_available, used AS feedback_used, CAST(demo IS NOT NULL OR used AS INTEGER) AS sd_mask, teacher_prompt FROM p"),
)(
    lambda spark, sf: J.teacher_prompts(demos(spark, sf)).select("sample_id", "feedback_available", "feedback_used", "sd_mask", "teacher_prompt")
)
register(
    "leakage_prompts",
    with_views(
        "rollouts",
        f"""WITH {TEACH} SELECT sample_id, nullif(letter, '') AS answer_letter, prompt AS base_prompt, CASE WHEN coalesce(letter, '') <> '' THEN prompt || chr(10) || 'The answer is ' || letter || '.' || chr(10) || 'Correctly solve the original question.' || chr(10) ELSE prompt END AS answer_prompt FROM p""",
    ),
)(lambda spark, sf: J.leakage_prompts(demos(spark, sf)).select("sample_id", "answer_letter", "base_prompt", "answer_prompt"))
register(
    "distillation_coverage",
    with_views(
        "rollouts",
        f"""WITH {TEACH}, g AS (SELECT step, avg(w) AS gw FROM (SELECT step, uid, max(CASE WHEN score >= 1 THEN 1.0 ELSE 0 END) AS w FROM p GROUP BY 1, 2) GROUP BY 1),
 s AS (SELECT step, avg(CASE WHEN demo IS NOT NULL THEN 1.0 ELSE 0 END) AS a, avg(CASE WHEN told THEN 1.0 ELSE 0 END) AS b, avg(CASE WHEN used THEN 1.0 ELSE 0 END) AS c, avg(CASE WHEN used OR demo IS NOT NULL THEN 1.0 ELSE 0 END) AS d FROM p GROUP BY 1)
 SELECT step, round(gw, 6) AS success_group_fraction, round(a, 6) AS success_sample_fraction, round(b, 6) AS feedback_available_fraction, round(c, 6) AS feedback_used_fraction, round(d, 6) AS reprompt_sample_fraction, round(a, 6) AS answer_extracted_fraction FROM g JOIN s USING (step)""",
    ),
)(lambda spark, sf: rounded(J.distillation_coverage(J.leakage_prompts(J.teacher_prompts(demos(spark, sf))), ["step"], 1.0), ["step"]))


def histories(spark, sf):
    """The turns of a conversation as attempts, with the next text as feedback."""
    c = ranked(V.chats(spark, sf), ["conv_id"], ["turn"], "k")
    return c.select(
        F.col("conv_id").alias("question_id"),
        F.col("turn"),
        F.concat(L("Question "), F.col("conv_id").cast("string")).alias("question"),
        F.concat(L("try "), F.col("turn").cast("string")).alias("response"),
        F.col("text").alias("feedback"),
    )


WC = "len(regexp_extract_all({}, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]'))"
for _form, _extra, _fixed in (("feedback_only", 0, True), ("attempt_and_feedback", 2, False)):
    _wrap = len(re.findall(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]", J.RETRY_PREFIX + J.RETRY_SUFFIX))
    _size = f"{WC.format('text')}" + ("" if _fixed else f" + {_extra} + {_wrap}")
    _base = 2 + (_wrap if _fixed else 0)
    _body = (
        f"'user=Question ' || question_id || coalesce(chr(10) || chr(10) || {q(J.RETRY_PREFIX)} || notes || {q(J.RETRY_SUFFIX)}, '')"
        if _fixed
        else "'user=Question ' || question_id || coalesce('|' || notes, '')"
    )
    _note = (
        "string_agg(b.text, chr(10) || chr(10) ORDER BY b.turn)"
        if _fixed
        else f"string_agg('assistant=try ' || b.turn || '|user=' || {q(J.RETRY_PREFIX)} || b.text || {q(J.RETRY_SUFFIX)}, '|' ORDER BY b.turn)"
    )
    register(
        f"retry_prompts_{_form}",
        f"""WITH h AS (SELECT conv_id AS question_id, turn, text, {_size} AS n FROM conversations), c AS (SELECT *, sum(n) OVER (PARTITION BY question_id ORDER BY turn) AS cum FROM h),
 p AS (SELECT a.question_id, a.turn, {_note} AS notes, count(b.turn) AS kept FROM c a LEFT JOIN c b ON a.question_id = b.question_id AND b.turn < a.turn AND (a.cum - a.n) - (b.cum - b.n) + {_base} <= 300 GROUP BY 1, 2)
 SELECT question_id, turn, CAST(turn - kept AS INTEGER) AS trimmed, md5({_body}) AS prompt_md5 FROM p""",
    )(
        lambda spark, sf, form=_form: J.retry_prompts(histories(spark, sf), form, 300, X.words).select(
            "question_id",
            "turn",
            "trimmed",
            F.md5(F.array_join(F.transform("messages", lambda m: F.concat(m["role"], L("="), m["content"])), "|")).alias("prompt_md5"),
        )
    )
