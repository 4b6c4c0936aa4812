"""Every registered query has a clean name, and a cross-section equals its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SAMPLE = [
    "advantage_report",
    "adv_gae",
    "adv_optimal_token_baseline_tail",
    "rejection_metrics",
    "confidence_weights_v2sqrt",
    "clean_teacher",
    "validation_best_of",
    "validation_majority",
    "score_by_source",
    "render_test_feedback",
    "demonstrations",
    "resample_pow",
    "corpus_to_rl",
    "bm25_top_k",
    "rollout_dump_round_trip",
    "queue_staleness",
    "sample_readiness_stream",
    # one or two of every operator family that was rewritten
    "adv_remax",
    "adv_optimal_token_baseline_multi_turn",
    "adv_teacher_guided_gae",
    "adv_hybrid_normalised",
    "adv_reinforce_baseline",
    "kl_controller_trace",
    "importance_weights_sequence",
    "experiment_report",
    "experiment_ranking",
    "grade_answer",
    "numbers_equal",
    "normalise_maths",
    "score_maths",
    "score_answer_line",
    "score_tool_use",
    "score_batch_function",
    "first_rows",
    "random_rows",
    "exact_split",
    "padding_round_trip",
    "collate_jagged",
    "jagged_round_trip",
    "partition_spread",
    "partition_serpentine_equal",
    "micro_batches",
    "dataset_hook",
    "sampler_hook",
    "retry_prompts_feedback_only",
    "retry_prompts_attempt_and_feedback",
    "dense_top_k",
    "passages_text",
    "assembled_batches_stream",
    "version_roll_up_stream",
    "metric_windows_sliding_stream",
    "metric_windows_session_stream",
]


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SAMPLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_sql(spark, duck, sf, name):
    df = entry.queries()[name](spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == rows(cols, rel.fetchall())
