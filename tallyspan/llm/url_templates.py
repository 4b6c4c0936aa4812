"""URL filter: host rules, and a tree of path templates per host, in column expressions only.

A host's paths form a tree that is built level by level until no node can have a branch any more. At a
node, a segment with at least ``SUPPORT`` pages is a branch of its own; where the node's pages are spread
over its segments so thinly that a segment has fewer than that on average, a branch needs ``SPREAD``
times as many. All other segments are variable and become ``*``. A node with fewer than ``SUPPORT`` pages
has no branch: what lies below is ``**``.

Branches of a node are merged when they are statistically alike. Pages that a rule judges are the
labels. A branch with ``LABELS`` of them or more is mostly blocked, mostly allowed or mixed, if its
blocked share lies ``DEVIATION`` standard deviations above or below a half, or neither; branches of one
kind that fan out alike are merged. Branches without labels are merged with each other only, and one
with fewer than ``LABELS`` stays alone: no branch is judged by labels of another one without labels of
its own. A merged branch is named by its first segment and how many follow.

A template is rejected when the smoothed share of blocked pages among its labelled ones,
``(blocked + PRIOR / 2) / (labelled + PRIOR)``, reaches ``REJECT``. Templates without labels are allowed.

Segments meet their branches in joins; no list of names is collected. Each level is written to the
shared folder, so that the next does not read the table again. Joins on a host with a third of the
pages are skew joins, whose large side Spark splits.

Defined results: a null url, or one without ``://``, has an empty host and path; no rule fits an empty
host; the same row twice gives the same result twice, and counts as two pages; of a long path every
segment counts, and a shared beginning takes a level for each of its segments; ``%``, ``*`` and braces
of a segment are escaped in the name of a template. Extra columns pass through, unless they have the
name of a result: then the result's column replaces them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import saved
from tallyspan.spread import df_col

SUPPORT, SPREAD, LABELS = 3, 3, 3
DEVIATION, PRIOR, REJECT = 2.0, 2.0, 0.8
#: Characters of a segment that mean something in the name of a template.
ESCAPES = (("%", "%25"), ("*", "%2A"), ("{", "%7B"), ("}", "%7D"))
#: Levels that the SQL form builds; deeper than the tables at hand.
SQL_LEVELS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Blocked and allowed sites; the longest that fits wins.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rule(host: Column, path: Column, rules: tuple[Rule, ...], what: str) -> Column:
    """The name or action of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(getattr(rule, what))).otherwise(out)
    return out


def _branches(rows: DataFrame, level: int) -> DataFrame:
    """``host, template, segment, label`` of the level's branches; ``rows`` are those of nodes with ``SUPPORT`` pages."""
    node = ["host", "template"]
    at = rows.select(*node, F.get("segments", F.lit(level)).alias("segment"), F.get("segments", F.lit(level + 1)).alias("below"), "labelled", "blocked")
    child = at.groupBy(*node, "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), F.countDistinct("below").alias("fan")
    )
    total = child.groupBy(*node).agg((F.sum("n") < F.count(F.lit(1)) * SUPPORT).alias("thin"))
    branch = child.filter(F.col("n") >= SUPPORT).join(total, node).filter(~F.col("thin") | (F.col("n") >= SUPPORT * SPREAD))
    score = (F.col("blocked") - F.col("labelled") * 0.5) / F.sqrt(F.greatest(F.col("labelled"), F.lit(1)) * 0.25)
    kind = (
        F.when(F.col("labelled") == 0, "none")
        .when(F.col("labelled") < LABELS, F.concat(F.lit("few "), "segment"))
        .when(score > DEVIATION, "blocked")
        .when(score < -DEVIATION, "allowed")
        .otherwise("mixed")
    )
    branch = branch.select(*node, "segment", kind.alias("kind"), (F.col("fan") * 2 >= F.col("n")).alias("wide"))
    merged = branch.groupBy(*node, "kind", "wide").agg(F.min("segment").alias("first"), F.count(F.lit(1)).alias("many"))
    named = F.col("first")
    for old, new in ESCAPES:
        named = F.replace(named, F.lit(old), F.lit(new))
    label = F.when(F.col("many") > 1, F.concat(F.lit("{"), named, F.lit("+"), (F.col("many") - 1).cast("string"), F.lit("}"))).otherwise(named)
    return branch.join(merged.withColumn("label", label), [*node, "kind", "wide"]).select(*node, "segment", "label")


def _generalised(rows: DataFrame, level: int) -> DataFrame:
    """The level's step appended to ``template`` of the rows that are ``open``: a branch, ``*``, or ``**`` for the
    rest of a path in a node too small to branch. Rows without a further segment are done."""
    node = ["host", "template"]
    sizes = rows.filter("open").groupBy(*node).agg((F.count(F.lit(1)) >= SUPPORT).alias("large"))
    sized = rows.join(sizes, node, "left")
    large = F.col("open") & F.col("large")
    branches = _branches(sized.filter(large), level)
    found = sized.withColumn("segment", F.get("segments", F.lit(level))).join(branches, [*node, "segment"], "left")
    step = F.when(~F.col("open"), "").when(~F.col("large"), "/**").otherwise(F.concat(F.lit("/"), F.coalesce("label", F.lit("*"))))
    more = large & (F.size("segments") > level + 1)
    return found.withColumn("template", F.concat("template", step)).withColumn("open", more).drop("segment", "label", "large")


def judge(pages: DataFrame, url_col: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, template, purity``."""
    results = ["host", "path", "rule", "verdict", "template", "purity"]
    extra = [c for c in pages.columns if c.lower() not in results]
    host, path = host_and_path(df_col(url_col))
    rows = pages.select(F.struct(*[df_col(c) for c in extra]).alias("row"), host.alias("host"), path.alias("path"))
    action = by_rule(F.col("host"), F.col("path"), rules, "action")
    rows = rows.select(
        "row",
        "host",
        "path",
        by_rule(F.col("host"), F.col("path"), rules, "name").alias("rule"),
        action.alias("action"),
        F.filter(F.split("path", "/"), lambda s: s != "").alias("segments"),
        F.when(action.isNotNull(), 1).otherwise(0).alias("labelled"),
        F.when(action == "block", 1).otherwise(0).alias("blocked"),
        F.lit("").alias("template"),
    )
    rows = saved(rows.withColumn("open", F.size("segments") > 0))
    level = 0
    while not rows.filter("open").isEmpty():
        rows = saved(_generalised(rows, level))
        level += 1
    purity = (F.sum("blocked") + PRIOR / 2) / (F.sum("labelled") + PRIOR)
    known = rows.groupBy("host", "template").agg(purity.alias("purity"))
    judged = rows.join(known, ["host", "template"])
    verdict = F.coalesce(F.col("action"), F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return judged.select(*[F.col(f"row.`{c}`").alias(c) for c in extra], "host", "path", "rule", verdict.alias("verdict"), "template", "purity")


def oracle() -> str:
    """The same over ``pages`` in DuckDB's SQL."""
    ordered = sorted(RULES, key=lambda r: (-len(r.name), r.name))

    def case(what: str) -> str:
        whens = (
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, what)}'" for r in ordered
        )
        return f"CASE {' '.join(whens)} END"

    steps = [
        f"""WITH u AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r AS (
    SELECT page_id, host, path, {case("name")} AS rule, {case("action")} AS action FROM h
), p0 AS (
    SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, (action IS NOT NULL)::INT AS labelled,
        coalesce(action = 'block', false)::INT AS blocked, '' AS template,
        len(list_filter(string_split(path, '/'), lambda s: s <> '')) > 0 AS open FROM r
)"""
    ]
    escaped = "first"
    for old, new in ESCAPES:
        escaped = f"replace({escaped}, '{old}', '{new}')"
    for d in range(SQL_LEVELS):
        steps.append(
            f"""z{d} AS (
    SELECT *, open AND count(*) FILTER (open) OVER (PARTITION BY host, template) >= {SUPPORT} AS large FROM p{d}
), c{d} AS (
    SELECT host, template, segments[{d + 1}] AS segment, count(*) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked,
        count(DISTINCT segments[{d + 2}]) AS fan FROM z{d} WHERE large GROUP BY ALL
), t{d} AS (
    SELECT *, sum(n) OVER w < count(*) OVER w * {SUPPORT} AS thin,
        (blocked - labelled * 0.5::DOUBLE) / sqrt(greatest(labelled, 1) * 0.25::DOUBLE) AS score FROM c{d} WINDOW w AS (PARTITION BY host, template)
), s{d} AS (
    SELECT host, template, segment, fan * 2 >= n AS wide, CASE WHEN labelled = 0 THEN 'none' WHEN labelled < {LABELS} THEN 'few ' || segment
        WHEN score > {DEVIATION} THEN 'blocked' WHEN score < -{DEVIATION} THEN 'allowed' ELSE 'mixed' END AS kind
    FROM t{d} WHERE n >= {SUPPORT} AND (NOT thin OR n >= {SUPPORT * SPREAD})
), m{d} AS (
    SELECT host, template, segment, min(segment) OVER w AS first, count(*) OVER w AS many FROM s{d} WINDOW w AS (PARTITION BY host, template, kind, wide)
), l{d} AS (
    SELECT host, template, segment, CASE WHEN many > 1 THEN '{{' || {escaped} || '+' || (many - 1) || '}}' ELSE {escaped} END AS label FROM m{d}
), p{d + 1} AS (
    SELECT p.* EXCLUDE (large) REPLACE (p.template || CASE WHEN NOT open THEN '' WHEN NOT large THEN '/**' ELSE '/' || coalesce(l.label, '*') END AS template,
        large AND len(segments) > {d + 1} AS open)
    FROM z{d} p LEFT JOIN l{d} l ON large AND l.host = p.host AND l.template = p.template AND l.segment = p.segments[{d + 1}]
)"""
        )
    steps.append(
        f"""k AS (
    SELECT host, template, (sum(blocked) + {PRIOR / 2}::DOUBLE) / (sum(labelled) + {PRIOR}::DOUBLE) AS purity FROM p{SQL_LEVELS} GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN purity >= {REJECT}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM p{SQL_LEVELS} JOIN k USING (host, template)"""
    )
    return ",\n".join(steps)
