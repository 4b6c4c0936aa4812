"""Joins inside a rollout table: demonstrations, baselines, preference pairs, re-prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.answers import answer_letter, without_thinking
from tallyspan.spread import affine_scan, attach, attach_table, hash_order, ranked, top_k


def demonstrations(
    responses: DataFrame,
    threshold: float,
    seed: int = 0,
    exclude_self: bool = True,
    prefer_self: bool = False,
    fallback_to_self: bool = False,
    strip_thinking: bool = False,
) -> DataFrame:
    """Add ``demo_id`` and ``demo``: the text of one successful response (score >= threshold) of the same group.

    Every group offers its first two successes in seeded md5 order, so that each member finds one
    that is not itself and no pairs are formed. No success gives null.
    """
    ok = F.col("score") >= threshold
    wins = responses.filter(ok).select("uid", "sample_id", "response").withColumn("__h", hash_order(seed, "uid", "sample_id"))
    two = top_k(wins, ["uid"], [F.col("__h"), F.col("sample_id")], 2, "__k")
    pick = lambda k, c: F.max(F.when(F.col("__k") == k, F.col(c)))
    offers = two.groupBy("uid").agg(
        pick(1, "sample_id").alias("__id1"), pick(1, "response").alias("__t1"), pick(2, "sample_id").alias("__id2"), pick(2, "response").alias("__t2")
    )
    names = ["__id1", "__t1", "__id2", "__t2"]
    r = attach_table(responses, ["uid"], offers, names)
    me = F.col("sample_id")
    other = (F.col("__id1") == me) if exclude_self else F.lit(False)
    demo_id = F.when(other, F.col("__id2")).otherwise(F.col("__id1"))
    demo = F.when(other, F.col("__t2")).otherwise(F.col("__t1"))
    if fallback_to_self:
        lonely = demo_id.isNull() & ok
        demo_id, demo = F.when(lonely, me).otherwise(demo_id), F.when(lonely, F.col("response")).otherwise(demo)
    if prefer_self:
        demo_id, demo = F.when(ok, me).otherwise(demo_id), F.when(ok, F.col("response")).otherwise(demo)
    r = r.withColumn("demo_id", demo_id).withColumn("demo", without_thinking(demo) if strip_thinking else demo)
    return r.drop(*names)


def greedy_baseline(responses: DataFrame, greedy: DataFrame) -> DataFrame:
    """Attach the reward of the greedy response of each prompt (``uid, reward``) as ``baseline``."""
    base = greedy.groupBy("uid").agg(F.sum("reward").alias("baseline"))
    return attach_table(responses, ["uid"], base, ["baseline"])


def mine_pairs(responses: DataFrame) -> DataFrame:
    """Best against worst response of each group with different scores (ties to the lowest id)."""
    best = top_k(responses, ["uid"], [F.desc("score"), F.asc("sample_id")], 1, "__k")
    worst = top_k(responses, ["uid"], [F.asc("score"), F.asc("sample_id")], 1, "__k")
    b = best.select("uid", F.col("sample_id").alias("chosen_id"), F.col("response").alias("chosen"), F.col("score").alias("chosen_score"))
    w = worst.select("uid", F.col("sample_id").alias("rejected_id"), F.col("response").alias("rejected"), F.col("score").alias("rejected_score"))
    return b.join(w, "uid").filter(F.col("chosen_score") > F.col("rejected_score"))


def merge_results(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Validation results of two runs as one set; what one side lacks stays empty."""
    return left.unionByName(right, allowMissingColumns=True).select(*keys, *[c for c in {**dict.fromkeys(left.columns), **dict.fromkeys(right.columns)} if c not in keys])


def with_success(responses: DataFrame, threshold: float) -> DataFrame:
    """Responses of groups that have a success."""
    wins = responses.filter(F.col("score") >= threshold).select("uid").distinct()
    return responses.join(wins, "uid", "left_semi")


# fixed values: the default texts of a re-prompt
SOLUTION_TEXT = "\nCorrect solution:\n\n{}"
FEEDBACK_TEXT = "\nThe following is feedback from your unsuccessful earlier attempt:\n\n{}"
CLOSING_TEXT = "\n\nCorrectly solve the original question."
ANSWER_ONLY_TEXT = "{prompt}\nThe answer is {letter}.\nCorrectly solve the original question.\n"


def _filled(template: str, value: Column) -> Column:
    before, _, after = template.partition("{}")
    return F.concat(F.lit(before), value, F.lit(after))


def has_text(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def teacher_prompts(
    rows: DataFrame, feedback_only_without_solution: bool = True, include_feedback: bool = True
) -> DataFrame:
    """Add ``teacher_prompt``, ``feedback_used`` and ``sd_mask``.

    ``rows``: ``prompt``, ``demo`` (may be null) and ``feedback`` (may be null or blank). Without
    solution and feedback the prompt stays as it is and the row leaves the distillation set.
    """
    solved = F.col("demo").isNotNull()
    told = has_text(F.col("feedback")) if include_feedback else F.lit(False)
    use = told & ~solved if feedback_only_without_solution else told
    solution = F.when(solved, _filled(SOLUTION_TEXT, F.col("demo"))).otherwise(F.lit(""))
    feedback = F.when(use, _filled(FEEDBACK_TEXT, F.col("feedback"))).otherwise(F.lit(""))
    full = F.concat(F.col("prompt"), solution, feedback, F.lit(CLOSING_TEXT))
    return (
        rows.withColumn("feedback_available", told)
        .withColumn("feedback_used", use)
        .withColumn("sd_mask", (solved | use).cast("int"))
        .withColumn("teacher_prompt", F.when(solved | use, full).otherwise(F.col("prompt")))
    )


def leakage_prompts(rows: DataFrame) -> DataFrame:
    """Add ``base_prompt`` and ``answer_prompt``: the bare prompt, and the prompt that only names the
    answer letter of the demonstration (no letter: the bare prompt)."""
    before, middle = ANSWER_ONLY_TEXT.split("{prompt}")
    lead, tail = middle.split("{letter}")
    letter = answer_letter(F.col("demo"))
    told = F.concat(F.lit(before), F.col("prompt"), F.lit(lead), letter, F.lit(tail))
    return (
        rows.withColumn("answer_letter", letter)
        .withColumn("base_prompt", F.col("prompt"))
        .withColumn("answer_prompt", F.when(letter.isNotNull(), told).otherwise(F.col("prompt")))
    )


def distillation_coverage(rows: DataFrame, batch: Sequence[str], threshold: float) -> DataFrame:
    """Shares of groups with a success and of samples with a demonstration, feedback, re-prompt and letter."""
    batch = list(batch)
    groups = rows.groupBy(*batch, "uid").agg(F.max((F.col("score") >= threshold).cast("int")).alias("w"))
    g = groups.groupBy(*batch).agg(F.avg("w").alias("success_group_fraction"))
    share = lambda c: F.avg(c.cast("double"))
    aggs = [
        share(F.col("demo").isNotNull()).alias("success_sample_fraction"),
        share(F.col("feedback_available")).alias("feedback_available_fraction"),
        share(F.col("feedback_used")).alias("feedback_used_fraction"),
        F.avg("sd_mask").alias("reprompt_sample_fraction"),
    ]
    if "answer_letter" in rows.columns:
        aggs.append(share(F.col("answer_letter").isNotNull()).alias("answer_extracted_fraction"))
    return g.join(rows.groupBy(*batch).agg(*aggs), batch)


# fixed values: the texts of a retry prompt
RETRY_PREFIX = "The following is feedback from your unsuccessful earlier attempt:\n\n"
RETRY_SUFFIX = "\n\nCorrectly solve the original question."


def retry_prompts(history: DataFrame, form: str, limit: int, count) -> DataFrame:
    """Prompt of each turn from the logged turns before it: ``question_id, turn, question, response, feedback``.

    ``feedback_only`` joins all feedback; ``attempt_and_feedback`` alternates attempts and feedback
    as chat messages. The oldest entries go until the prompt has at most ``limit`` tokens by
    ``count`` (a column function that is additive over joined texts).

    Token sums run along a question in blocks. A turn keeps the past turns that begin at most its room
    before it on that scale; both sides carry the number of their stretch of ``limit`` tokens, so that a
    turn meets two stretches in an equi-join, however many turns the question has. Texts are fetched for
    kept turns alone.
    """
    if form not in ("feedback_only", "attempt_and_feedback"):
        raise ValueError(f"unknown form {form}")
    wrap = count(F.lit(RETRY_PREFIX + RETRY_SUFFIX))
    size = count(F.col("feedback"))
    fixed = count(F.col("question"))
    if form == "feedback_only":
        fixed = fixed + wrap
    else:
        size = size + wrap + count(F.col("response"))
    sized = history.select("question_id", "turn", size.cast("long").alias("__n"), (F.lit(limit) - fixed).cast("long").alias("__room"))
    placed = affine_scan(ranked(sized, ["question_id"], ["turn"], "__pos"), ["question_id"], "__pos", {"__sum": (F.lit(1.0), F.col("__n"), False)})
    begin = F.coalesce(F.col("__sum__x"), F.lit(0.0)).cast("long")
    placed = placed.select("question_id", "turn", "__room", (F.col("__pos") - 1).alias("__turns"), begin.alias("__begin"))
    stretch = F.floor(F.col("__begin") / max(limit, 1))
    past = placed.select("question_id", F.col("turn").alias("__past"), F.col("__begin").alias("__past_begin"), stretch.alias("__stretch"))
    now = placed.select("question_id", "turn", "__room", "__begin", F.explode(F.array(stretch - 1, stretch)).alias("__stretch"))
    near = now.join(past, ["question_id", "__stretch"]).filter((F.col("__past") < F.col("turn")) & (F.col("__begin") - F.col("__past_begin") <= F.col("__room")))
    texts = history.select("question_id", F.col("turn").alias("__past"), "response", "feedback")
    kept = near.select("question_id", "turn", "__past").join(texts, ["question_id", "__past"])
    kept = kept.groupBy("question_id", "turn").agg(F.array_sort(F.collect_list(F.struct("__past", "response", "feedback"))).alias("__kept"))
    h = history.join(kept, ["question_id", "turn"], "left").join(placed.select("question_id", "turn", "__turns"), ["question_id", "turn"])
    none = F.col("__kept").isNull()
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    ask = F.array(said("user", F.col("question")))
    told = lambda text: F.concat(F.lit(RETRY_PREFIX), text, F.lit(RETRY_SUFFIX))
    if form == "feedback_only":
        notes = F.array_join(F.transform("__kept", lambda e: e["feedback"]), "\n\n")
        many = F.array(said("user", F.concat(F.col("question"), F.lit("\n\n"), told(notes))))
    else:
        turns = F.transform("__kept", lambda e: F.array(said("assistant", e["response"]), said("user", told(e["feedback"]))))
        many = F.concat(ask, F.flatten(turns))
    trimmed = F.col("__turns") - F.when(none, 0).otherwise(F.size("__kept"))
    out = h.withColumn("messages", F.when(none, ask).otherwise(many)).withColumn("trimmed", trimmed.cast("int"))
    return out.select(*history.columns, "messages", "trimmed")
