"""Question sets, chats and preference data to training rows. All builders are narrow projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.answers import clean_ending, description_of, float_or, hash_answer, last_box
from tallyspan.spread import dense_index, hash_order

L = F.lit
MESSAGES = "array<struct<role:string,content:string>>"


def message(role: str, content: Column) -> Column:
    return F.struct(L(role).alias("role"), content.alias("content"))


def chat(*messages: Column) -> Column:
    return F.array(*messages)


def _filled(template: str, **values: Column) -> Column:
    """Template text with ``{name}`` replaced; any other brace is literal."""
    parts: list[Column] = []
    rest = template
    while True:
        spots = [(rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest]
        if not spots:
            break
        at, name = min(spots)
        parts += [L(rest[:at]), values[name]]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts, L(rest))


# fixed values: prompt templates
MATH_PROMPT = "{problem}\n\nPlease reason step by step, and put your final answer within \\boxed{}."
CODE_PROMPT = (
    "You are a coding expert. You will be given a coding problem, and you need to write a correct Python program "
    "that matches the specification and passes all tests. The time limit is 1 second. You may start by outlining "
    "your thought process. In the end, please provide the complete code in a code block enclosed with ``` ```.\n\n{problem}"
)
MCQ_SYSTEM = """
Given a question and four options, please select the right answer. Respond in the following format:
<reasoning>
...
</reasoning>
<answer>
...
</answer>

For the answer, only output the letter corresponding to the correct option (A, B, C, or D), and nothing else. Do not restate the answer text. For example, if the answer is "A", just output:
<answer>
A
</answer>
"""
GPQA_PROMPT = """Return your final response within \\boxed{} and only include the letter choice (A, B, C, or D) as your final response.
Problem: {problem}
Options: {options}
Answer:"""
SUBJECT_INTRO = (
    "The following are multiple choice questions (with answers) about {subject}. Think step by step and then finish "
    'your answer with "the answer is (X)" where X is the correct letter choice.'
)
BOX_LETTER = (
    "\nPlease reason step by step, and put your final answer option within \\boxed{}. Only put the option letter in "
    "the box, e.g. \\boxed{A}. There is only one correct answer."
)
SIGNATURE = "\n\nYour solution should have the following signature: ```python\n{signature}\n```"
COMPLETE_FUNCTION = (
    "Your task is to complete the following function. You are not allowed to modify the given code and should do the "
    "completion only. Here is the given code to complete: ```python\n{prefix}\n```"
)
HASH_HINT = 'Let\'s think step by step and output the final answer after "####".'
TICK_HINT = "Let's think step by step and output the final answer after `####`."
BOX_HINT = "Let's think step by step and output the final answer within \\boxed{}."
THINK_HINT = (
    "You FIRST think about the reasoning process as an internal monologue and then provide the final answer. "
    "The reasoning process MUST BE enclosed within <think> </think> tags. The final answer MUST BE put in \\boxed{}."
)
MATH_EXPERT = (
    "You are a math expert. You are given a question and you need to solve it step by step. "
    "You should rethinking carefully if user point out your answer is wrong. "
    "Put your final answer in the format of `#### <answer>`."
)


# ---- corpus rows -------------------------------------------------------------------------


def normalise_corpus(df: DataFrame, source: str, order: Sequence[str], start: int = 0, count: int | None = None) -> DataFrame:
    """Corpus rows with index, "-" for what is missing, and the evaluation note on the description."""
    for name in ("tests", "answer", "dataset", "elo"):
        given = F.col(name).cast("string") if name in df.columns else L(source if name == "dataset" else "-")
        df = df.withColumn(name, F.coalesce(given, L("-")))
    note = F.concat(F.col("description"), L(" The solution will be evaluated in a "), F.col("kind"), L(" environment."))
    df = dense_index(df.withColumn("description", note), list(order), "idx")
    names = ["idx", "kind", "dataset", "answer", "elo", "prompt", "description", "tests", "embedding", "system"]
    df = df.select(*[n for n in names if n in df.columns])
    df = df.filter(F.col("idx") >= start)
    return df if count is None else df.filter(F.col("idx") < start + count)


def with_embeddings(corpus: DataFrame, embeddings: DataFrame, key: str = "idx") -> DataFrame:
    """Embeddings joined by id."""
    return corpus.join(embeddings.select(key, "embedding"), key, "left")


def rl_rows(corpus: DataFrame, split: str) -> DataFrame:
    """Corpus rows to RL rows: a system message only where there is one, tests as truth for code."""
    code = F.col("kind") == "code"
    live = F.col("dataset") == "livecodebench"
    plain = lambda c: F.when(live, F.replace(F.col(c), L("(self, "), L("("))).otherwise(F.col(c))
    prior = F.col("achievement_prior") if split == "train" and "achievement_prior" in corpus.columns else L(0)
    system = F.col("system") if "system" in corpus.columns else L(None).cast("string")
    ask = message("user", plain("prompt"))
    prompt = F.when(system.isNotNull(), F.array(message("system", system), ask)).otherwise(F.array(ask))
    truth = F.when(code, F.col("tests")).otherwise(F.col("answer"))
    return corpus.select(
        F.col("dataset").alias("data_source"),
        prompt.alias("prompt"),
        F.col("kind").alias("ability"),
        F.struct(F.col("kind").alias("style"), truth.alias("ground_truth")).alias("reward_model"),
        F.struct(
            L(split).alias("split"),
            F.col("idx").cast("string").alias("index"),
            plain("description").alias("description"),
            plain("prompt").alias("problem"),
            F.col("elo").alias("elo"),
            prior.alias("achievement_prior"),
        ).alias("extra_info"),
    )


def training_prompts(df: DataFrame) -> DataFrame:
    """Prompt by kind: the code template for code, the maths template for the rest."""
    code = _filled(CODE_PROMPT, problem=F.col("problem"))
    return df.withColumn("prompt", F.when(F.col("kind") == "code", code).otherwise(_filled(MATH_PROMPT, problem=F.col("problem"))))


def _letter(i: Column) -> Column:
    return F.char(i + 65)


def labelled_choice_rows(df: DataFrame) -> DataFrame:
    """``question, labels, texts, answer_key`` to multiple-choice rows with one ``label: text`` line per option."""
    lines = F.zip_with("labels", "texts", lambda a, b: F.concat(a, L(": "), b))
    return df.select(
        L("sciknoweval").alias("dataset"),
        L(MCQ_SYSTEM).alias("system"),
        F.concat(F.col("question"), L("\n\n"), F.array_join(lines, "\n"), L("\nPlease reason step by step.")).alias("prompt"),
        F.col("answer_key").alias("answer"),
        L(None).cast("string").alias("tests"),
        F.col("question").alias("description"),
        L("mcq").alias("kind"),
        L(1500).alias("elo"),
    )


def shuffled_choice_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """``question, right, wrong array`` to rows with four options in seeded md5 order and the right letter."""
    options = F.concat(F.array(F.col("right")), F.col("wrong"))
    coded = F.transform(
        options, lambda o, i: F.struct(hash_order(seed, F.col(key).cast("string"), i.cast("string")).alias("h"), i.alias("i"), o.alias("o"))
    )
    d = df.withColumn("__o", F.array_sort(coded))
    spots = F.transform("__o", lambda x: x["i"])
    d = d.withColumn("answer", _letter(F.array_position(spots, 0).cast("int") - 1))
    shown = F.array_join(F.transform("__o", lambda x, i: F.concat(_letter(i), L(") "), x["o"])), ", ")
    return d.select(
        key,
        L("gpqa").alias("kind"),
        L("gpqa").alias("dataset"),
        F.col("question").alias("description"),
        _filled(GPQA_PROMPT, problem=F.col("question"), options=shown).alias("prompt"),
        "answer",
    )


def lettered_choice_prompt(question: Column, options: Column, subject: Column, style: str = "subject") -> Column:
    """Question with options lettered from A, in one of two styles; more options than letters are an error."""
    many = F.raise_error(F.concat(F.size(options).cast("string"), L(" options, but only 26 letters"))).cast("string")
    listed = lambda mark: F.when(F.size(options) > 26, many).otherwise(
        F.array_join(F.transform(options, lambda o, i: F.concat(_letter(i), L(mark), o, L("\n"))), "")
    )
    if style == "subject":
        head = _filled(SUBJECT_INTRO, subject=subject)
        return F.concat(head, L("\nQuestion:\n"), question, L("\nOptions:\n"), listed(". "), L("Answer: Let's think step by step."))
    if style == "boxed":
        return F.concat(question, L("\nOptions are:\n"), listed(": "), L(BOX_LETTER))
    raise ValueError(f"unknown style {style}")


# fixed values: question and answer columns of the maths sets
MATH_COLUMNS = {
    "aime25": ("problem", "answer"),
    "aime24": ("problem", "solution"),
    "amc23": ("question", "answer"),
    "math500": ("problem", "answer"),
    "gsm8k": ("question", "answer"),
}


def maths_rows(df: DataFrame, dataset: str) -> DataFrame:
    """Maths question sets: the box is cut off for aime24, gsm8k keeps the number after ``####``."""
    question, answer = MATH_COLUMNS[dataset]
    truth = F.col(answer).cast("string")
    if dataset == "aime24":
        truth = F.substring(truth, L(8), F.greatest(F.length(truth) - 8, L(0)))
    if dataset == "gsm8k":
        truth = F.regexp_extract(truth, r"####\s*([0-9]+(?:\.[0-9]+)?)", 1)
    q = F.col(question)
    return df.select(
        L("math").alias("kind"),
        L(dataset).alias("dataset"),
        q.alias("description"),
        q.alias("problem"),
        _filled(MATH_PROMPT, problem=q).alias("prompt"),
        truth.alias("answer"),
    )


# ---- code sets ---------------------------------------------------------------------------


def tests_json(inputs: Column, outputs: Column, kind: Column, fn_name: Column, time_limit: Column) -> Column:
    return F.to_json(
        F.struct(
            inputs.alias("inputs"), outputs.alias("outputs"), kind.alias("testtype"), fn_name.alias("fn_name"), time_limit.alias("time_limit")
        )
    )


def signature_of(starter: Column) -> Column:
    """First function head of the starter code, up to an ``Input`` line."""
    tail = F.split(starter, "def ", -1)[1]
    return F.concat(L("def "), F.regexp_replace(F.substring_index(tail, "Input\n", 1), r"^\s+|\s+$", ""))


def with_signature(problem: Column, starter: Column) -> Column:
    shown = F.concat(problem, _filled(SIGNATURE, signature=signature_of(starter)))
    return F.when(F.coalesce(starter.contains("def "), L(False)), shown).otherwise(problem)


def html_problem(title: Column, limit: Column, description: Column, inputs: Column, outputs: Column, **extra: Column) -> Column:
    """Problem page without its public examples. Extra sections (interaction, note, editorial) only where filled."""
    section = lambda name, body: F.concat(L(f"<h2>{name}</h2><div>"), body, L("</div>"))
    parts = [
        F.concat(L("<html><body><h1>"), title, L("</h1>")),
        F.concat(L("<div>Time limit per test: "), limit, L(" s</div>")),
        section("Description", description),
        section("Input Format", inputs),
        section("Output Format", outputs),
    ]
    for name in ("interaction", "note", "editorial"):
        if name in extra:
            body = extra[name]
            parts.append(F.when(F.coalesce(body, L("")) != "", section(name.capitalize(), body)).otherwise(L("")))
    return F.concat(*parts, L("</body></html>"))


def stdin_code_rows(df: DataFrame, dataset: str, time_limit: float = 1.0) -> DataFrame:
    """``title, description, input_format, output_format, tests array<struct<input,output>>, elo`` to corpus rows.

    ``time_limit`` holds where the row's own (text) limit is missing.
    """
    limit = float_or(F.col("time_limit").cast("string"), time_limit)
    extra = {n: F.col(c) for n, c in (("interaction", "interaction_format"), ("note", "note"), ("editorial", "editorial")) if c in df.columns}
    page = html_problem(F.col("title"), F.coalesce(F.col("time_limit").cast("string"), L("-")), F.col("description"), F.col("input_format"), F.col("output_format"), **extra)
    pick = lambda n: F.transform("tests", lambda t: t[n])
    keys = [c for c in ("row_id",) if c in df.columns]
    return df.select(
        *keys,
        L("code").alias("kind"),
        L(dataset).alias("dataset"),
        "description",
        "elo",
        page.alias("problem"),
        tests_json(pick("input"), pick("output"), L("stdin"), L(""), limit).alias("tests"),
    )


def starter_code_rows(df: DataFrame, dataset: str, time_limit: float = 1.0) -> DataFrame:
    """``question, starter_code, inputs, outputs, fn_name`` to corpus rows with a described problem.

    A function name makes the tests functional, none makes them stdin tests.
    """
    problem = with_signature(F.col("question"), F.col("starter_code"))
    fn = F.coalesce(F.col("fn_name"), L(""))
    kind = F.when(fn != "", "functional").otherwise("stdin")
    keys = [c for c in ("row_id",) if c in df.columns]
    return df.select(
        *keys,
        L("code").alias("kind"),
        L(dataset).alias("dataset"),
        description_of(problem).alias("description"),
        problem.alias("problem"),
        tests_json(F.col("inputs"), F.col("outputs"), kind, fn, L(float(time_limit))).alias("tests"),
    )


def completion_code_rows(df: DataFrame, time_limit: float = 1.0) -> DataFrame:
    """``prompt, test, entry_point`` to function-completion rows; the description is the doc string up to its examples."""
    body = F.element_at(F.split(F.col("prompt"), F.concat(L("def "), F.col("entry_point"))), 2)
    doc = F.when(body.contains('"""'), F.split(body, '"""')[1]).otherwise(F.split(body, "'''")[1])
    description = F.regexp_replace(F.substring_index(doc, ">>>", 1), r"^\s+|\s+$", "")
    test = F.concat(F.col("test"), L("\ncheck("), F.col("entry_point"), L(")"))
    keys = [c for c in ("row_id",) if c in df.columns]
    return df.select(
        *keys,
        L("code").alias("kind"),
        L("humanevalplus").alias("dataset"),
        description.alias("description"),
        _filled(CODE_PROMPT, problem=_filled(COMPLETE_FUNCTION, prefix=F.col("prompt"))).alias("prompt"),
        tests_json(F.array(test), F.array(L("")), L("code"), L(""), L(float(time_limit))).alias("tests"),
    )


def named_function_rows(df: DataFrame, time_limit: float = 1.0) -> DataFrame:
    """``prompt, code, test_imports array, test`` to rows that name the function of the reference code."""
    fn = F.trim(F.substring_index(F.split(F.col("code"), "def ")[1], "(", 1))
    imports = F.array_join(F.transform("test_imports", lambda i: F.concat(i, L("\n"))), "")
    ask = F.concat(F.col("prompt"), L(" The function should be called `"), fn, L("`."))
    keys = [c for c in ("row_id",) if c in df.columns]
    return df.select(
        *keys,
        L("code").alias("kind"),
        L("mbppplus").alias("dataset"),
        F.col("prompt").alias("description"),
        _filled(CODE_PROMPT, problem=ask).alias("prompt"),
        tests_json(F.array(F.concat(imports, F.col("test"))), F.array(L("")), L("code"), L(""), L(float(time_limit))).alias("tests"),
    )


# ---- RL rows of single sets --------------------------------------------------------------


def rule_rows(
    df: DataFrame, source: str, question: str, answer: str, truth: Column, hint: str, split: str, index: str, system: str | None = None
) -> DataFrame:
    """Question and hint as the prompt, the extracted truth as the rule."""
    ask = F.concat(F.col(question), L(" " + hint))
    prompt = chat(message("system", L(system)), message("user", ask)) if system else chat(message("user", ask))
    return df.select(
        *[c for c in ("images",) if c in df.columns],
        L(source).alias("data_source"),
        prompt.alias("prompt"),
        L("math").alias("ability"),
        F.struct(L("rule").alias("style"), truth.alias("ground_truth")).alias("reward_model"),
        F.struct(
            L(split).alias("split"), F.col(index).cast("long").alias("index"), F.col(answer).alias("answer"), F.col(question).alias("question")
        ).alias("extra_info"),
    )


def grade_school_rows(df: DataFrame, split: str, index: str, system: str | None = None, hint: str = HASH_HINT) -> DataFrame:
    return rule_rows(df, "openai/gsm8k", "question", "answer", hash_answer(F.col("answer")), hint, split, index, system)


def competition_rows(df: DataFrame, split: str, index: str) -> DataFrame:
    return rule_rows(df, "DigitalLearningGmbH/MATH-lighteval", "problem", "solution", last_box(F.col("solution")), BOX_HINT, split, index)


def geometry_rows(df: DataFrame, split: str, index: str) -> DataFrame:
    return rule_rows(df, "hiyouga/geometry3k", "problem", "answer", F.col("answer"), THINK_HINT, split, index)


def ending_rows(df: DataFrame, split: str, index: str) -> DataFrame:
    """Sentence completion: ``activity, ctx_a, ctx_b, endings, label``; rows without a label are left out."""
    second = F.concat(F.upper(F.left("ctx_b", L(1))), F.lower(F.substring(F.col("ctx_b"), L(2), F.length("ctx_b"))))
    ask = clean_ending(F.concat(F.col("activity"), L(": "), F.col("ctx_a"), L(" "), second))
    return df.filter(F.length("label") > 0).select(
        L("Rowan/hellaswag").alias("data_source"),
        chat(message("user", ask)).alias("prompt"),
        L("nlp").alias("ability"),
        F.struct(
            L("model").alias("style"),
            L("multiple_choice").alias("eval"),
            F.col("label").cast("int").alias("ground_truth"),
            F.transform("endings", lambda e: clean_ending(e)).alias("choices"),
        ).alias("reward_model"),
        F.struct(L(split).alias("split"), F.col(index).cast("long").alias("index")).alias("extra_info"),
    )


def with_tool(rows: DataFrame, tool: str) -> DataFrame:
    """Say that the row needs the tool, which gets the truth when it is created."""
    kwargs = F.struct(F.struct(F.struct(F.col("reward_model.ground_truth").alias("ground_truth")).alias("create_kwargs")).alias(tool))
    info = F.col("extra_info").withField("need_tools_kwargs", L(True)).withField("tools_kwargs", kwargs)
    return rows.withColumn("extra_info", info)


def with_interaction(rows: DataFrame, name: str | None = None) -> DataFrame:
    """Give the interaction the last user message and the truth, and its name if it has one."""
    fields = [F.element_at("prompt", -1)["content"].alias("query"), F.col("reward_model.ground_truth").alias("ground_truth")]
    if name is not None:
        fields.insert(0, L(name).alias("name"))
    return rows.withColumn("extra_info", F.col("extra_info").withField("interaction_kwargs", F.struct(*fields)))


def search_rows(df: DataFrame, split: str, index: str, system: str, prefix: str) -> DataFrame:
    """Search questions: truth from the reward model, else the golden answers; the source gets a prefix."""
    source = F.concat(L("searchR1_"), F.coalesce(F.col("data_source"), L("")))
    truth = F.coalesce(F.col("reward_model.ground_truth"), F.col("golden_answers"))
    create = F.struct(truth.alias("ground_truth"), F.col("question").alias("question"), source.alias("data_source"))
    return df.select(
        source.alias("data_source"),
        chat(message("system", L(system)), message("user", F.concat(L(prefix.rstrip("\n")), F.col("question")))).alias("prompt"),
        "ability",
        "reward_model",
        F.struct(
            F.col(index).cast("long").alias("index"),
            L(True).alias("need_tools_kwargs"),
            F.col("question").alias("question"),
            L(split).alias("split"),
            F.struct(F.struct(create.alias("create_kwargs")).alias("search")).alias("tools_kwargs"),
        ).alias("extra_info"),
    )


# ---- preference data ---------------------------------------------------------------------


def response_rows(pairs: DataFrame) -> DataFrame:
    """Both responses of a pair as SFT rows."""
    return pairs.select("prompt", F.explode(F.array("chosen", "rejected")).alias("response"))


def reward_model_rows(indexed: DataFrame, train_share: float = 0.75) -> DataFrame:
    """Pairs with ``split`` by index: the first part for training, the last part for testing.

    The shares may overlap when the count does not divide; such a row is in both.
    """
    from tallyspan.spread import attach

    d = attach(indexed, [], __n=F.count(L(1)))
    train = F.col("idx") < F.round(F.col("__n") * train_share)
    test = F.col("idx") >= F.col("__n") - F.round(F.col("__n") * (1 - train_share))
    sides = F.array_compact(F.array(F.when(train, "train"), F.when(test, "test")))
    return d.select("idx", "prompt", "chosen", "rejected", F.explode(sides).alias("split"))


def alignment_rows(df: DataFrame, split: str, index: str) -> DataFrame:
    return df.select(
        L("Dahoas/full-hh-rlhf").alias("data_source"),
        chat(message("user", F.col("prompt"))).alias("prompt"),
        L("alignment").alias("ability"),
        F.struct(L("model").alias("style"), F.col("response").alias("ground_truth")).alias("reward_model"),
        F.struct(L(split).alias("split"), F.col(index).cast("long").alias("index")).alias("extra_info"),
    )


def shared_chat_rows(df: DataFrame, conversations: str = "conversations") -> DataFrame:
    """``array<struct<from, value>>`` to messages; a speaker other than gpt and human is an error."""

    def role(m: Column) -> Column:
        wrong = F.raise_error(F.concat(L("Unknown role: "), m["from"])).cast("string")
        return F.when(m["from"] == "gpt", "assistant").when(m["from"] == "human", "user").otherwise(wrong)

    return df.withColumn(
        "messages", F.transform(conversations, lambda m: F.struct(role(m).alias("role"), m["value"].alias("content")))
    ).drop(conversations)


def single_turn_rows(df: DataFrame, hint: str = HASH_HINT) -> DataFrame:
    """Question and answer as a chat of two messages."""
    ask = F.concat(F.col("question"), L(" " + hint))
    return df.select(*[c for c in df.columns if c not in ("question", "answer")], chat(message("user", ask), message("assistant", F.col("answer"))).alias("messages"))


def _as_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.col(name)) if kind.startswith(("array", "struct")) else F.col(name).cast("string")


def preference_rows(df: DataFrame, modes: Sequence[str] = ("nothink",), template=None) -> DataFrame:
    """Complete pairs, lists as JSON text, one variant per thinking ``mode``.

    ``template(prompt, mode)`` renders a prompt of messages.
    """
    d = df.dropna(subset=["prompt", "chosen", "rejected"]).withColumn("mode", F.explode(F.array(*[L(m) for m in modes])))
    prompt = template(F.col("prompt"), F.col("mode")) if template is not None else _as_text(df, "prompt")
    keys = [c for c in df.columns if c not in ("prompt", "chosen", "rejected")]
    return d.select(*keys, "mode", prompt.alias("prompt"), _as_text(df, "chosen").alias("chosen"), _as_text(df, "rejected").alias("rejected"))


def unpaired_rows(df: DataFrame) -> DataFrame:
    """Pairs whose two prompts may differ to two labelled rows; incomplete pairs are left out."""
    names = ["chosen_prompt", "rejected_prompt", "chosen_response", "rejected_response"]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    side = lambda p, c, good: F.struct(
        _as_text(df, p).alias("prompt"), _as_text(df, c).alias("completion"), L(good).alias("label")
    )
    both = F.array(side("chosen_prompt", "chosen_response", True), side("rejected_prompt", "rejected_response", False))
    keys = [c for c in df.columns if c not in names]
    return df.dropna(subset=names).select(*keys, F.inline(both))


def label_balance(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("label")).alias("positive"), F.count_if(~F.col("label")).alias("negative"), F.avg(F.col("label").cast("double")).alias("positive_share")
    )
