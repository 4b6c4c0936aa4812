"""Dataset, sampler and generator hooks: user code that makes a training set, orders it, and adds to it.

A hook is a function or an object with DataFrames in and out, registered under a name or loaded from a
Python file. ``epoch`` draws batch after batch from a table of prompts: the sampler orders what is left by
a state that it updates from the results of each batch, and a generator may add rows after each batch.
State, prompts and batches are written at every round, so that a round starts from tables.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators.filters import first_rows
from tallyspan.spread import durable, hash_uniform

KINDS = ("dataset", "sampler", "generator")
HOOKS: dict[str, dict[str, Callable]] = {kind: {} for kind in KINDS}


def hook(kind: str, name: str):
    """Register a dataset function, a sampler class or a generator function."""

    def add(fn: Callable) -> Callable:
        if kind not in HOOKS:
            raise ValueError(f"unknown kind of hook {kind}")
        if HOOKS[kind].setdefault(name, fn) is not fn:
            raise ValueError(f"{kind} {name} is already registered")
        return fn

    return add


def find(kind: str, name: str, path: str | None = None) -> Callable:
    """A registered hook, or the object ``name`` of the Python file at ``path``."""
    if path is None:
        if name not in HOOKS.get(kind, {}):
            raise KeyError(f"no {kind} {name}")
        return HOOKS[kind][name]
    spec = importlib.util.spec_from_file_location("user_hook", path)
    if spec is None or spec.loader is None:
        raise FileNotFoundError(path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    if not hasattr(module, name):
        raise AttributeError(f"{path} has no {name}")
    return getattr(module, name)


def build_dataset(spark: SparkSession, name: str, path: str | None = None, needs: tuple[str, ...] = (), **options) -> DataFrame:
    """The table that a dataset hook makes of ``options``; it has to be a DataFrame with the columns ``needs``."""
    made = find("dataset", name, path)(spark, **options)
    if not isinstance(made, DataFrame):
        raise TypeError(f"dataset {name} gives {type(made).__name__}, not a DataFrame")
    if missing := [c for c in needs if c not in made.columns]:
        raise ValueError(f"dataset {name} lacks {', '.join(missing)}")
    return made


@hook("dataset", "parquet")
def parquet_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class Sampler:
    """The order in which prompts are drawn. ``state`` is a DataFrame, or None for a sampler without one."""

    def start(self, rows: DataFrame) -> DataFrame | None:
        return None

    def prioritised(self, rows: DataFrame, key: str, state: DataFrame | None) -> DataFrame:
        """``rows`` with ``priority``, the smallest first; ties go by key."""
        return rows.withColumn("priority", F.lit(0.0))

    def update(self, state: DataFrame | None, results: DataFrame) -> DataFrame | None:
        return state


@hook("sampler", "sequential")
class Sequential(Sampler):
    pass


@hook("sampler", "random")
@dataclass
class Random(Sampler):
    seed: int = 0

    def prioritised(self, rows: DataFrame, key: str, state: DataFrame | None) -> DataFrame:
        return rows.withColumn("priority", hash_uniform(self.seed, key))


@hook("sampler", "hardest_group")
@dataclass
class HardestGroup(Sampler):
    """Groups with the lowest mean score so far come first; a group without results counts as ``unseen``."""

    group: str
    score: str = "score"
    unseen: float = 0.5

    def start(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.group).limit(0).select(self.group, F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("n"))

    def prioritised(self, rows: DataFrame, key: str, state: DataFrame | None) -> DataFrame:
        level = state.select(F.col(self.group).alias("__g"), F.try_divide("total", "n").alias("__level"))
        seen = rows.join(level, F.col(self.group).eqNullSafe(F.col("__g")), "left")
        return seen.withColumn("priority", F.coalesce("__level", F.lit(float(self.unseen)))).drop("__g", "__level")

    def update(self, state: DataFrame, results: DataFrame) -> DataFrame:
        new = results.groupBy(self.group).agg(F.sum(F.col(self.score).cast("double")).alias("total"), F.count(self.score).alias("n"))
        return state.unionByName(new).groupBy(self.group).agg(F.sum("total").alias("total"), F.sum("n").alias("n")).filter("n > 0")


@hook("generator", "first_again")
def first_again(rows: DataFrame, batch: DataFrame, key: str, number: int) -> DataFrame:
    """The first row of the table once more, under a new key."""
    return rows.orderBy(key).limit(1).withColumn(key, F.col(key) + F.lit(number * 1_000_000_000).cast("long"))


def epoch(
    rows: DataFrame,
    key: str,
    sampler: Sampler,
    results: Callable[[DataFrame], DataFrame],
    size: int,
    batches: int,
    generator: Callable[[DataFrame, DataFrame, str, int], DataFrame] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``batch`` (from 0) and the columns of ``rows`` for every row that is drawn, each at most once.

    ``results`` gives the scored responses of a batch, with its columns; the sampler's state is updated
    from them before the next batch is drawn. ``generator(rows, batch, key, number)`` makes rows that are
    added, as far as ``keep`` (the length filter of the dataset, say) lets them. A last batch may be smaller.
    """
    columns, left, state, drawn = rows.columns, durable(rows), sampler.start(rows), []
    for number in range(batches):
        ordered = sampler.prioritised(left, key, state)
        batch = durable(first_rows(ordered, ["priority", key], size).select(*columns))
        drawn.append(batch.withColumn("batch", F.lit(number)))
        scored = results(batch)
        state = sampler.update(state, scored)
        state = state if state is None else durable(state)
        taken = batch.select(F.col(key).alias("__taken"))
        left = left.join(taken, F.col(key) == F.col("__taken"), "left_anti")
        if generator is not None:
            new = generator(rows, scored, key, number + 1).select(*columns)
            left = left.unionByName(new if keep is None else keep(new))
        left = durable(left)
    out = drawn[0]
    for batch in drawn[1:]:
        out = out.unionByName(batch)
    return out.select("batch", *columns)
