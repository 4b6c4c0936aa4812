"""Scoring of response tables: dispatch by data source, user functions, logged tests and turns."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.functions import answers as A
from tallyspan.functions import timed
from tallyspan.operators.metrics import ERROR_PREFIX, INCORRECT_FORMAT, TIMEOUT
from tallyspan.spread import ranked, top_k

# ---- dispatch ----------------------------------------------------------------------------

# fixed values: data sources and the rule that scores them
SOURCE_RULES = {
    "hash": ["openai/gsm8k"],
    "math": ["lighteval/MATH", "DigitalLearningGmbH/MATH-lighteval", "HuggingFaceH4/MATH-500"],
    "line": ["math_dapo", "math", "math_dapo_reasoning"],
    "general": [
        "numina_aops_forum", "numina_synthetic_math", "numina_amc_aime", "numina_synthetic_amc",
        "numina_cn_k12", "numina_olympiads",
    ],
    "geometry": ["hiyouga/geometry3k"],
    "qa": [
        "searchR1_nq", "searchR1_triviaqa", "searchR1_popqa", "searchR1_hotpotqa",
        "searchR1_2wikimultihopqa", "searchR1_musique", "searchR1_bamboogle",
    ],
}
FEEDBACK_RULES = {
    "maths_feedback": ["math", "math500", "dapo_math", "gsm8k"],
    "last_letter": ["gpqa"],
    "tagged_choice": ["sciknoweval"],
    "tool_use": ["tooluse"],
}


def _rule_scores(rule: str, text: Column, truth: Column) -> Column:
    if rule == "hash":
        return A.scored(A.hash_score(text, truth), A.hash_answer(text))
    if rule == "math":
        pred = A.last_box_lenient(text)
        ok = F.when(pred.isNull(), F.lit(False)).otherwise(A.same_math(pred, truth))
        return A.scored(ok.cast("double"), pred)
    if rule == "line":
        return A.line_score(text, truth)
    if rule == "general":
        pred = A.free_text_answer(text)["answer"]
        return A.scored(A.grade_answer(pred, truth).cast("double"), pred)
    if rule == "geometry":
        return A.scored(A.geometry_score(text, truth), A.last_box(text))
    if rule == "qa":
        golds = F.split(truth, r"\|")
        return A.scored(A.qa_score(text, golds), A.tagged_answer(text))
    if rule == "maths_feedback":
        return A.maths_feedback_score(text, truth, F.lit(False))
    if rule == "last_letter":
        return A.last_letter_score(text, truth)
    if rule == "tagged_choice":
        return A.tagged_choice_score(text, truth)
    if rule == "tool_use":
        r = A.tool_use(text, truth)
        return A.scored(r["score"], r["pred"], r["incorrect_format"], r["feedback"])
    raise ValueError(f"unknown rule {rule}")


def score_by_source(
    responses: DataFrame, rules: dict[str, Sequence[str]] = SOURCE_RULES, prefixes: dict[str, str] | None = None
) -> DataFrame:
    """Add ``score, acc, pred, incorrect_format, feedback`` by the rule of each row's ``data_source``.

    ``prefixes`` maps a source prefix to a rule ("aime": "line"). Gold answers of the qa rule are
    separated by ``|``. A source without a rule gets a null score and says so in ``feedback``.
    Python rules see null instead of the rows of other sources.
    """
    source = F.col("data_source")
    prefixes = {"aime": "line"} if prefixes is None and rules is SOURCE_RULES else (prefixes or {})
    chosen = F.lit(None).cast("string")
    for rule, names in rules.items():
        chosen = F.when(source.isin(*names), rule).otherwise(chosen)
    for prefix, rule in prefixes.items():
        chosen = F.when(chosen.isNull() & source.startswith(prefix), rule).otherwise(chosen)
    df = responses.withColumn("__rule", chosen)
    unknown = A.scored(
        F.lit(None).cast("double"),
        F.lit(None).cast("string"),
        F.lit(0),
        F.concat(F.lit("no scoring rule for data source "), F.coalesce(source, F.lit("null"))),
    )
    picked = None
    for rule in dict.fromkeys([*rules, *prefixes.values()]):
        mine = F.col("__rule") == rule
        score = _rule_scores(rule, F.when(mine, F.col("response")), F.when(mine, F.col("ground_truth")))
        picked = F.when(mine, score) if picked is None else picked.when(mine, score)
    df = df.withColumn("__s", picked.otherwise(unknown))
    return df.select(*responses.columns, "__s.*")


# ---- user functions ----------------------------------------------------------------------

USER_SCORE = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("extras", T.MapType(T.StringType(), T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)


def load_score_function(path: str, name: str, **fixed) -> Callable:
    """Function ``name`` of a Python file, with fixed extra arguments."""
    spec = importlib.util.spec_from_file_location("user_score", path)
    if spec is None or spec.loader is None:
        raise FileNotFoundError(path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    if not hasattr(module, name):
        raise AttributeError(f"{path} has no function {name}")
    fn = getattr(module, name)
    return lambda *args, **kwargs: fn(*args, **{**kwargs, **fixed})


def _scored(got) -> tuple:
    """``score, extras, error`` of what a user function returns: a number or a dict with ``score``."""
    if isinstance(got, dict):
        return float(got["score"]), {str(k): str(v) for k, v in got.items() if k != "score"}, None
    return float(got), {}, None


def _lost(reason: str) -> tuple:
    return 0.0, {}, reason


def _caught(e: Exception) -> tuple:
    return _lost(f"{type(e).__name__}: {e}")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["score", "extras", "error"])


def user_scores(fn: Callable, timeout: float | None = None, helpers: int = 4):
    """Column function of ``fn(data_source, solution, truth, extra)``, which returns a number or a
    dict with ``score``. An exception gives score 0 and its text in ``error``.

    With ``timeout``, in seconds, the calls run in helper processes of the task; one that takes longer,
    or ends its process, is ended and gives score 0 and the reason.
    """

    def one(source, text, truth, extra) -> tuple:
        try:
            return _scored(fn(source, text, truth, extra))
        except Exception as e:  # noqa: BLE001
            return _caught(e)

    @F.pandas_udf(USER_SCORE)
    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if timeout is None:
            for part in parts:
                yield _frame([one(*r) for r in zip(*part, strict=True)])
            return
        with timed.helpers(one, _lost, timeout, helpers) as pool:
            for part in parts:
                yield _frame(pool.run(list(zip(*part, strict=True))))

    return run


#: Parts that a batch is cut into when it fails: an Arrow batch of Spark's own size is down to its rows in two steps.
BATCH_PARTS = 100
#: Arrow batches of a task that are tried side by side, so that a helper that waits does not hold up the others.
BATCHES_AHEAD = 8


def batch_scores(fn: Callable, timeout: float | None = None, helpers: int = 4):
    """Column function of ``fn(sources, solutions, truths)`` over whole Arrow batches of columns, which
    returns a number or a dict with ``score`` for each row.

    A batch that fails, takes longer than ``timeout`` seconds, or ends its process is cut into parts that are
    tried on their own, down to the rows that are to blame: these get score 0 and the reason.
    """

    def call(*columns) -> list[tuple] | str:
        try:
            got = [_scored(x) for x in fn(*map(list, columns))]
        except Exception as e:  # noqa: BLE001
            return f"{type(e).__name__}: {e}"
        if len(got) != len(columns[0]):
            return f"ValueError: {len(got)} scores for {len(columns[0])} rows"
        return got

    def tried(ask: Callable[[list], list], parts: list[tuple[pd.Series, ...]]) -> list[pd.DataFrame]:
        tables = [[list(c) for c in part] for part in parts]
        results: list[list] = [[None] * len(columns[0]) for columns in tables]
        todo = [(i, range(len(found))) for i, found in enumerate(results) if found]
        while todo:
            late = []
            for (i, rows), got in zip(todo, ask([tuple(c[rows.start : rows.stop] for c in tables[i]) for i, rows in todo])):
                if not isinstance(got, str):
                    results[i][rows.start : rows.stop] = got
                elif len(rows) == 1:
                    results[i][rows.start] = _lost(got)
                else:
                    step = -(-len(rows) // BATCH_PARTS)
                    late += [(i, rows[at : at + step]) for at in range(0, len(rows), step)]
            todo = late
        return [_frame(found) for found in results]

    @F.pandas_udf(USER_SCORE)
    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if timeout is None:
            for part in parts:
                yield from tried(lambda batches: [call(*b) for b in batches], [part])
            return
        with timed.helpers(call, str, timeout, helpers, portion=1) as pool:
            while some := list(islice(parts, BATCHES_AHEAD)):
                yield from tried(pool.run, some)

    return run


MANAGERS: dict[str, Callable] = {}


def manager(name: str):
    """Register a reward manager: ``DataFrame -> DataFrame`` with a ``reward`` column."""

    def add(fn):
        if MANAGERS.setdefault(name, fn) is not fn:
            raise ValueError(f"manager {name} is already registered")
        return fn

    return add


@manager("naive")
def naive_manager(scored: DataFrame, model_score: str | None = None) -> DataFrame:
    """Reward = the score, or the model score where one is present."""
    s = F.col("score")
    return scored.withColumn("reward", F.coalesce(F.col(model_score), s) if model_score else s)


@manager("length_penalised")
def length_penalised_manager(
    scored: DataFrame, longest: int, buffer: int, factor: float = 1.0, model_score: str | None = None
) -> DataFrame:
    """As ``naive`` plus a penalty for responses that reach into the buffer before the maximum length."""
    penalty = A.overlong_penalty(F.col("length"), longest, buffer, factor)
    own = F.col("score") + penalty
    reward = F.coalesce(F.col(model_score), own) if model_score else own
    return scored.withColumn("overlong_reward", penalty).withColumn("overlong", penalty < 0).withColumn("reward", reward)


TOOL_PARSERS: dict[str, tuple[Callable, Callable]] = {
    "tagged": (A.tool_calls, A.without_tool_calls),
    "channel": (A.channel_calls, A.without_channel_calls),
}


def parse_tools(df: DataFrame, text: str, parser: str = "tagged") -> DataFrame:
    """Add ``calls`` and ``content`` (the text without the calls)."""
    if parser not in TOOL_PARSERS:
        raise ValueError(f"unknown tool parser {parser}")
    calls, rest = TOOL_PARSERS[parser]
    return df.withColumn("calls", calls(F.col(text))).withColumn("content", rest(F.col(text)))


# ---- logged tests ------------------------------------------------------------------------


def select_feedback_tests(records: DataFrame, show: int = 2) -> DataFrame:
    """The tests worth reporting per response: the first runtime error, else the first timeout, else
    the first format error, else the ``show`` failing tests with the shortest input and output.

    Adds ``priority`` (0 error, 1 timeout, 2 format, 3 wrong answer) and ``rank``.
    """
    actual = F.col("actual")
    priority = (
        F.when(actual.startswith(ERROR_PREFIX), 0)
        .when(actual == TIMEOUT, 1)
        .when(actual == INCORRECT_FORMAT, 2)
        .when(~F.col("passed"), 3)
    )
    size = F.when(priority == 3, F.length("input") + F.length(actual)).otherwise(0)
    r = records.withColumn("priority", priority).filter(F.col("priority").isNotNull()).withColumn("__len", size)
    best = top_k(r, ["sample_id"], [F.col("priority"), F.col("__len"), F.col("test_idx")], show, "rank")
    # after an error, timeout or format error only the first record counts; wrong answers follow a wrong answer
    lead = best.groupBy("sample_id").agg(F.min("priority").alias("__lead"))
    kept = best.join(lead, "sample_id").filter((F.col("rank") == 1) | (F.col("__lead") == 3))
    return kept.drop("__len", "__lead")


def _cut(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def _lines(text: Column, limit: int, width: int) -> Column:
    """First lines of a text, each cut, and a note on the rest."""
    lines = F.split(F.regexp_replace(text, r"\r?\n$", ""), r"\r?\n")
    more = F.array(F.format_string("... (%d more lines)", F.size(lines) - limit))
    shown = F.transform(F.slice(lines, F.lit(1), F.lit(limit)), lambda x: _cut(x, width))
    return F.when(F.size(lines) > limit, F.concat(shown, more)).otherwise(shown)


def render_feedback(
    records: DataFrame,
    truncated: DataFrame | None = None,
    show: int = 2,
    max_length: int = 2000,
    max_chars: int = 250,
    max_input_lines: int = 8,
    max_debug_lines: int = 10,
    max_debug_chars: int = 300,
) -> DataFrame:
    """Feedback text per response from its logged tests; empty if all pass.

    ``records``: ``sample_id, test_idx, input, expected, actual, passed, debug``.
    """
    r = select_feedback_tests(records, show)
    if truncated is None:
        r = r.withColumn("truncated", F.lit(False))
    else:
        r = r.join(truncated.select("sample_id", "truncated"), "sample_id", "left").fillna({"truncated": False})
    text = lambda *words: F.array(*[F.lit(w) for w in words])
    none = F.array().cast("array<string>")
    body = F.when(F.coalesce(F.col("input"), F.lit("")) == "", none).otherwise(_lines(F.col("input"), max_input_lines, max_chars))
    dbg = F.regexp_replace(F.coalesce(F.col("debug"), F.lit("")), r"^\s+|\s+$", "")
    debug = F.when(dbg == "", none).otherwise(F.concat(text("", "Debug Output"), _lines(dbg, max_debug_lines, max_debug_chars)))
    expected = F.when(F.col("expected").isNull(), none).otherwise(
        F.concat(text("", "Expected"), F.array(_cut(F.col("expected"), max_chars)))
    )
    error = F.expr(f"substring(actual, {len(ERROR_PREFIX) + 1})")
    # fixed values: the notes of a truncated and of an unreadable attempt
    cut_note = (
        "Truncated Attempt: Your previous response was too long and truncated because it reached the maximum "
        "response length. Try again with a shorter response."
    )
    format_note = "Incorrect Format: Put your code inside a ```python ... ``` block."
    p = F.col("priority")
    block = (
        F.when(p == 0, F.concat(text("Runtime Error"), F.array(error), text("", "Last Executed Input"), body, debug))
        .when(p == 1, F.concat(text("Time Limit Exceeded", "", "Last Executed Input"), body, debug))
        .when(p == 2, F.array(F.when(F.col("truncated"), F.lit(cut_note)).otherwise(F.lit(format_note))))
        .otherwise(
            F.concat(
                F.array(F.format_string("Test Case %d: Wrong Answer", F.col("test_idx") + 1)),
                text("", "Input"),
                body,
                text("", "Output"),
                F.array(_cut(F.col("actual"), max_chars)),
                expected,
                debug,
            )
        )
    )
    # at most ``show`` blocks per response
    blocks = r.select("sample_id", "rank", F.concat(block, text("")).alias("b"))
    joined = blocks.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("rank", "b"))).alias("l"))
    note = F.array_join(F.flatten(F.transform("l", lambda x: x["b"])), "\n")
    told = joined.select("sample_id", F.left(F.regexp_replace(note, r"\s+$", ""), F.lit(max_length)).alias("feedback"))
    everyone = records.select("sample_id").distinct()
    return everyone.join(told, "sample_id", "left").fillna({"feedback": ""})


# ---- turns -------------------------------------------------------------------------------


def attempt_rewards(attempts: DataFrame, penalty: float = -0.05) -> DataFrame:
    """Tool reward of each logged answer of a sample: 0 if its score beats the previous one, else a penalty.

    ``attempts``: ``sample_id, attempt, answer, ground_truth``; an answer is read with or without
    its ``#### `` mark.
    """
    answer = F.col("answer")
    marked = F.when(answer.startswith("#### "), answer).otherwise(F.concat(F.lit("#### "), answer))
    a = attempts.withColumn("score", A.hash_score(marked, F.col("ground_truth"), "flexible"))
    a = ranked(a, ["sample_id"], ["attempt"], "__k")
    before = a.select("sample_id", (F.col("__k") + 1).alias("__k"), F.col("score").alias("__before"))
    a = a.join(before, ["sample_id", "__k"], "left")
    better = F.col("score") > F.coalesce(F.col("__before"), F.lit(0.0))
    return a.withColumn("tool_reward", F.when(better, 0.0).otherwise(penalty)).drop("__k", "__before")


def turn_verdicts(turns: DataFrame, truths: DataFrame) -> DataFrame:
    """Score the last assistant turn of each conversation: ``reward, finished, reply``.

    ``turns``: ``conv_id, turn, role, text``; ``truths``: ``conv_id, ground_truth``.
    """
    said = turns.filter(F.col("role") == "assistant").groupBy("conv_id").agg(F.max_by("text", "turn").alias("__t"))
    t = truths.join(said, "conv_id", "left")
    reward = A.hash_score(F.coalesce(F.col("__t"), F.lit("")), F.col("ground_truth"))
    done = reward == 1.0
    # fixed values: the replies
    right = "Your response is correct!"
    wrong = "Your response is incorrect! You need to reflect on your answer and try again."
    return t.select("conv_id", reward.alias("reward"), done.alias("finished"), F.when(done, right).otherwise(wrong).alias("reply"))
