"""Hooks: user code that makes, orders and extends a training set."""

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import hooks as K


def prompts(spark, n=12):
    return spark.createDataFrame([(i, i % 3, "p" * i) for i in range(n)], "id long, g int, prompt string")


def drawn(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["batch"], r["id"])):
        out.setdefault(r["batch"], []).append(r["id"])
    return out


def answered(batch):
    """Group 2 always fails, group 1 always succeeds, group 0 sometimes."""
    return batch.withColumn("score", F.when(F.col("g") == 2, 0.0).when(F.col("g") == 1, 1.0).otherwise((F.col("id") % 2).cast("double")))


def test_registry_and_files(spark, tmp_path):
    path = tmp_path / "mine.py"
    path.write_text("def rows(spark, n):\n    return spark.range(n).toDF('id')\n\ndef wrong(spark):\n    return [1]\n")
    assert K.build_dataset(spark, "rows", str(path), needs=("id",), n=5).count() == 5
    with pytest.raises(ValueError, match="lacks prompt"):
        K.build_dataset(spark, "rows", str(path), needs=("prompt",), n=5)
    with pytest.raises(TypeError, match="not a DataFrame"):
        K.build_dataset(spark, "wrong", str(path))
    with pytest.raises(AttributeError):
        K.find("dataset", "none", str(path))
    with pytest.raises(KeyError):
        K.find("sampler", "none")
    with pytest.raises(ValueError, match="already registered"):
        K.hook("sampler", "random")(object)
    with pytest.raises(ValueError, match="unknown kind"):
        K.hook("thing", "x")(object)
    prompts(spark).write.parquet(str(tmp_path / "t"))
    assert K.find("dataset", "parquet")(spark, str(tmp_path / "t")).count() == 12


def test_samplers_without_state(spark):
    df = prompts(spark)
    assert drawn(K.epoch(df, "id", K.find("sampler", "sequential")(), answered, 5, 3)) == {0: [0, 1, 2, 3, 4], 1: [5, 6, 7, 8, 9], 2: [10, 11]}
    first, second = (drawn(K.epoch(df, "id", K.find("sampler", "random")(seed), answered, 6, 2)) for seed in (1, 1))
    assert first == second and sorted(first[0] + first[1]) == list(range(12)) and first[0] != [0, 1, 2, 3, 4, 5]


def test_state_goes_from_batch_to_batch(spark):
    got = drawn(K.epoch(prompts(spark, 18), "id", K.HardestGroup("g"), answered, 3, 5))
    # one of each group; then the two that failed, the one that always fails, and what is left by its mean
    assert got == {0: [0, 1, 2], 1: [3, 5, 6], 2: [8, 11, 14], 3: [9, 12, 17], 4: [4, 7, 15]}


def test_generated_rows_come_in_through_the_filter(spark):
    df = prompts(spark, 4)
    again = K.find("generator", "first_again")
    got = drawn(K.epoch(df, "id", K.Sequential(), answered, 2, 4, again))
    assert got == {0: [0, 1], 1: [2, 3], 2: [1_000_000_000, 2_000_000_000], 3: [3_000_000_000]}
    none = K.epoch(df, "id", K.Sequential(), answered, 2, 3, again, keep=lambda new: new.filter("length(prompt) > 0"))
    assert drawn(none) == {0: [0, 1], 1: [2, 3]}
    assert K.epoch(df.limit(0), "id", K.HardestGroup("g"), answered, 2, 2).count() == 0
