"""The comparison report of training runs: sixteen sections, one job.

A section is a table with one line per experiment. Its cells are a metric's final, best or lowest value,
or are made of other cells. All cells come from one aggregation per experiment; a cell without values is
null, and ``N/A`` in the text form.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.metrics import experiment_points
from tallyspan.spread import ranked


@dataclass(frozen=True)
class Cell:
    """A column of a section: a metric and its statistic, or a rule over the section's cells before it."""

    name: str
    key: str | None = None
    stat: str = "final"
    rule: Callable[[dict[str, Column]], Column] | None = None
    decimals: int = 4


def final(key: str, names: Sequence[str], decimals: int = 4) -> list[Cell]:
    """Final values of ``key`` with each of ``names`` behind it."""
    return [Cell(n, f"{key}{n}", decimals=decimals) for n in names]


def sections(source: str = "all", n: int = 16) -> list[tuple[str, list[Cell]]]:
    """The sections but the ranking, for the validation metrics of a data source at ``n`` responses."""
    # fixed values: names of logged metrics
    mean, best = f"val-core/{source}/acc/mean@{n}", f"val-core/{source}/acc/best@{n}/mean"
    spread = ("mean", "max", "min")
    verdicts = ("adv_ver_agree_rate", "adv_neg_ver_neg_rate", "adv_neg_ver_pos_rate", "adv_pos_ver_neg_rate", "adv_pos_ver_pos_rate")
    share = lambda c: F.when(c["best_of"] > 0, c["mean"] / c["best_of"] * 100).when(c["mean"].isNotNull() & c["best_of"].isNotNull(), 0.0)
    return [
        ("Accuracy", [Cell("mean_best", mean, "best"), Cell("mean_final", mean), Cell("best_of_best", best, "best"), Cell("best_of_final", best)]),
        (
            "Consistency",
            [
                Cell("mean", mean, "best"),
                Cell("best_of", best, "best"),
                Cell("gap", rule=lambda c: c["best_of"] - c["mean"]),
                Cell("consistency_pct", rule=share, decimals=1),
            ],
        ),
        ("Stability", final("actor/", ("entropy", "grad_norm", "pg_clipfrac", "ppo_kl"))),
        (
            "Entropy",
            [
                Cell("highest", "actor/entropy", "best"),
                Cell("final", "actor/entropy"),
                Cell("lowest", "actor/entropy", "lowest"),
                Cell("drop", rule=lambda c: c["highest"] - c["lowest"]),
            ],
        ),
        ("Advantages", final("critic/advantages/", spread)),
        ("Rewards", final("critic/rewards/", spread)),
        ("Response length", [Cell(s, "global_seqlen/mean", s, decimals=0) for s in ("final", "lowest", "best")]),
        ("Format errors", final(f"val-aux/{source}/incorrect_format/", (f"mean@{n}",))),
        (
            "Rollout drift",
            [Cell(f"{name}_{s}", key, s) for name, key in (("ppl", "rollout_corr/rollout_ppl"), ("probs_diff", "training/rollout_probs_diff_mean")) for s in ("final", "best")],
        ),
        ("Returns", final("critic/returns/", spread)),
        ("Scores", final("critic/score/", spread)),
        ("Verifier agreement", final("tasd/", verdicts)),
        ("Token advantages", final("tasd/", ("advantage_mean", "advantage_std", "advantage_pos_rate"))),
        ("Token rewards", final("tasd/", ("success_rate", "token_reward_mean"))),
        ("Sequence lengths", final("global_seqlen/", ("mean", "max", "min", "balanced_max", "balanced_min", "minmax_diff"), 0)),
    ]


def ranking_cells(source: str = "all", n: int = 16) -> list[Cell]:
    return [Cell("mean_best", f"val-core/{source}/acc/mean@{n}", "best"), Cell("best_of_best", f"val-core/{source}/acc/best@{n}/mean", "best")]


def experiment_report(points: DataFrame, source: str = "all", n: int = 16) -> DataFrame:
    """``section`` (from 1), ``title, line, experiment, place, name, value, text`` of every cell. ``points``:
    ``experiment, key, step, value``. Lines are in the order of names, in the ranking by the best mean accuracy."""
    parts = [*sections(source, n), ("Ranking", ranking_cells(source, n))]
    wanted = sorted({(c.key, c.stat) for _, cells in parts for c in cells if c.key})
    names = {w: f"__m{i}" for i, w in enumerate(wanted)}
    stats = experiment_points(points)
    wide = stats.groupBy("experiment").agg(*[F.max(F.when(F.col("key") == key, F.col(stat))).alias(names[key, stat]) for key, stat in wanted])
    top = F.coalesce(F.col(names[parts[-1][1][0].key, "best"]), F.lit(0.0))
    wide = ranked(ranked(wide.withColumn("__o", -top), [], ["__o", "experiment"], "__rank"), [], ["experiment"], "__line")

    rows = []
    for number, (title, cells) in enumerate(parts, 1):
        found: dict[str, Column] = {}
        line = F.col("__rank") if number == len(parts) else F.col("__line")
        for place, cell in enumerate(cells):
            value = found[cell.name] = (cell.rule(found) if cell.rule else F.col(names[cell.key, cell.stat])).cast("double")
            text = F.coalesce(F.format_string(f"%.{cell.decimals}f", value), F.lit("N/A"))
            rows.append(
                F.struct(
                    F.lit(number).alias("section"),
                    F.lit(title).alias("title"),
                    line.cast("int").alias("line"),
                    F.lit(place).alias("place"),
                    F.lit(cell.name).alias("name"),
                    value.alias("value"),
                    F.when(value.isNull(), "N/A").otherwise(text).alias("text"),
                )
            )
    return wide.select("experiment", F.inline(F.array(*rows))).select("section", "title", "line", "experiment", "place", "name", "value", "text")


def report_lines(report: DataFrame) -> DataFrame:
    """``section, line, text``: the report as lines of Markdown tables; line -1 is the title, 0 the heads."""
    bar = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    cells = F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda c: c["text"])
    lines = report.groupBy("section", "line", "experiment").agg(cells.alias("c"))  # the columns of a section
    body = lines.select("section", "line", bar(F.concat(F.array("experiment"), "c")).alias("text"))
    heads = report.select("section", "title", "place", "name").distinct().groupBy("section", "title").agg(F.array_sort(F.collect_list(F.struct("place", "name"))).alias("h"))
    names = F.concat(F.array(F.lit("experiment")), F.transform("h", lambda c: c["name"]))
    title = heads.select("section", F.lit(-1).alias("line"), F.concat(F.lit("## "), F.col("section").cast("string"), F.lit(". "), "title").alias("text"))
    return title.unionByName(heads.select("section", F.lit(0).alias("line"), bar(names).alias("text"))).unionByName(body)
