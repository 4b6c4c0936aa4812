"""Registered queries of the batch algebra, filters and balancing."""

from pyspark.sql import functions as F

from tallyspan.operators import algebra as G
from tallyspan.operators import balance as B
from tallyspan.operators import filters as X
from tallyspan.operators import hooks as K
from tallyspan.plans import register
from tallyspan.plans.advantage import RESPONSES_SQL, r6, responses
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views
from tallyspan.spread import attach, packed, ranked


def indexed(spark, sf):
    return G.with_index(V.rollouts(spark, sf).select("sample_id", "uid", "pred", "step"), ["sample_id"])


IDX = "ix AS (SELECT sample_id, uid, pred, step, row_number() OVER (ORDER BY sample_id) - 1 AS idx, count(*) OVER () AS n FROM rollouts)"


def ix(body):
    return with_views("rollouts", f"WITH {IDX} {body}" if body.upper().startswith("SELECT") else f"WITH {IDX}, {body}")


register("dense_index", ix("SELECT sample_id, idx FROM ix"))(lambda spark, sf: indexed(spark, sf).select("sample_id", "idx"))
register("batch_select", with_views("rollouts", "SELECT sample_id, uid, score FROM rollouts"))(
    lambda spark, sf: G.select(V.rollouts(spark, sf), ["sample_id", "uid", "score"])
)


@register("batch_pop", with_views("rollouts", "SELECT sample_id, score, pred, uid, data_source, acc, step FROM rollouts"))
def batch_pop(spark, sf):
    popped, rest = G.pop(V.rollouts(spark, sf), "sample_id", ["score", "pred"])
    return G.union_columns(popped, rest, "sample_id")


register("batch_rename", with_views("rollouts", "SELECT sample_id AS row_id, uid AS val_uid, score AS val_score FROM rollouts"))(
    lambda spark, sf: G.rename(
        G.rename_prefix(V.rollouts(spark, sf).select("sample_id", "uid", "score"), "val_", ["sample_id"]), {"sample_id": "row_id"}
    )
)
register(
    "batch_union",
    with_views("rollouts loose_tokens", f"WITH {RESPONSES_SQL} SELECT sample_id, uid, pred, n_valid, n_tokens FROM responses"),
)(
    lambda spark, sf: G.union_columns(
        V.rollouts(spark, sf).select("sample_id", "uid", "pred"),
        responses(spark, sf).select("sample_id", "uid", "n_valid", "n_tokens"),
        "sample_id",
    )
)
register(
    "union_conflicts",
    with_views(
        "rollouts",
        """SELECT 'score' AS "column", count(*) FILTER (score < 0) AS conflicts FROM rollouts UNION ALL SELECT 'pred', count(*) FILTER (pred = 'P') FROM rollouts""",
    ),
)(
    lambda spark, sf: G.conflicts(
        V.rollouts(spark, sf).select("sample_id", "score", "pred"),
        V.rollouts(spark, sf).select(
            "sample_id", F.abs("score").alias("score"), F.when(F.col("pred") != "P", F.col("pred")).alias("pred")
        ),
        "sample_id",
    )
)
register(
    "rows_to_lists",
    with_views(
        "rollouts",
        "SELECT uid, CAST(0 AS BIGINT) AS page, string_agg(sample_id, ',' ORDER BY sample_id) AS ids, string_agg(pred, '' ORDER BY sample_id) AS preds FROM rollouts GROUP BY 1",
    ),
)(
    lambda spark, sf: G.to_lists(V.rollouts(spark, sf), ["uid"], "sample_id", ["sample_id", "pred"]).select(
        "uid", "page", F.array_join(F.col("sample_id").cast("array<string>"), ",").alias("ids"), F.array_join("pred", "").alias("preds")
    )
)
register("fold_rows", ix("SELECT idx // 8 AS fold, string_agg(pred, '' ORDER BY idx) AS preds FROM ix GROUP BY 1"))(
    lambda spark, sf: G.fold(indexed(spark, sf), 8, ["pred"]).select("fold", F.array_join("pred", "").alias("preds"))
)
register("unfold_rows", ix("SELECT idx, sample_id, pred FROM ix"))(
    lambda spark, sf: G.unfold(G.fold(indexed(spark, sf), 8, ["sample_id", "pred"]), 8, ["sample_id", "pred"])
)
register(
    "schema_report",
    """SELECT 'vec_id' AS "column", 'bigint' AS type, count(vec_id) AS "values", count(vec_id) AS elements FROM embeddings
 UNION ALL SELECT 'embedding', 'array<float>', count(embedding), CAST(sum(len(embedding)) AS BIGINT) FROM embeddings UNION ALL SELECT 'label', 'int', count(label), count(label) FROM embeddings""",
)(lambda spark, sf: G.schema_report(V.table(spark, sf, "embeddings")))
register("repeat_interleaved", ix("SELECT sample_id, rep, idx * 3 + rep AS idx FROM (SELECT *, unnest(range(3)::INTEGER[]) AS rep FROM ix)"))(
    lambda spark, sf: G.repeat(indexed(spark, sf), 3).select("sample_id", "rep", "idx")
)
register("repeat_tiled", ix("SELECT sample_id, rep, rep * n + idx AS idx FROM (SELECT *, unnest(range(3)::INTEGER[]) AS rep FROM ix)"))(
    lambda spark, sf: G.repeat(indexed(spark, sf), 3, interleave=False).select("sample_id", "rep", "idx")
)
register(
    "repeat_by_count",
    with_views(
        "rollouts loose_tokens",
        f"WITH {RESPONSES_SQL} SELECT sample_id, CAST(unnest(range(n_valid)) AS INTEGER) AS rep FROM responses",
    ),
)(lambda spark, sf: G.repeat_rows(responses(spark, sf), "n_valid").select("sample_id", "rep"))
register(
    "unfold_column_chunks",
    "SELECT vec_id, chunk, round(CAST(embedding[chunk * 16 + 1] AS DOUBLE), 6) AS first, round(CAST(embedding[chunk * 16 + 16] AS DOUBLE), 6) AS last, label FROM (SELECT *, unnest(range(4)::INTEGER[]) AS chunk FROM embeddings)",
)(
    lambda spark, sf: G.unfold_chunks(V.table(spark, sf, "embeddings"), 4, ["embedding"]).select(
        "vec_id",
        "chunk",
        r6(F.col("embedding")[0].cast("double")).alias("first"),
        r6(F.element_at("embedding", -1).cast("double")).alias("last"),
        "label",
    )
)
register("slice_rows", ix("SELECT sample_id, idx FROM ix WHERE idx >= 100 AND idx < 9000 AND (idx - 100) % 3 = 0"))(
    lambda spark, sf: G.take_slice(indexed(spark, sf), 100, 9000, 3).select("sample_id", "idx")
)
register("reorder_rows", ix("SELECT sample_id, n - 1 - idx AS idx FROM ix"))(
    lambda spark, sf: (
        lambda d: G.reorder(d, attach(d.select("idx"), [], n=F.count(F.lit(1))).select("idx", (F.col("n") - 1 - F.col("idx")).alias("new_idx")))
    )(indexed(spark, sf)).select("sample_id", "idx")
)
register("take_rows", ix("SELECT sample_id, 2 * idx + d AS idx FROM ix, (VALUES (0), (1)) v(d)"))(
    lambda spark, sf: (
        lambda d: G.take_rows(d, d.select("idx", F.explode(F.array(2 * F.col("idx"), 2 * F.col("idx") + 1)).alias("new_idx")))
    )(indexed(spark, sf)).select("sample_id", "idx")
)
register("rows_of_request", with_views("rollouts", "SELECT sample_id, uid, score FROM rollouts WHERE uid = 7"))(
    lambda spark, sf: X.by_request(V.rollouts(spark, sf), 7, "uid").select("sample_id", "uid", "score")
)
register("split_rows", ix("SELECT idx // 700 AS chunk, count(*) AS rows, min(sample_id) AS first FROM ix GROUP BY 1"))(
    lambda spark, sf: G.split_rows(indexed(spark, sf), 700).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"), F.min("sample_id").alias("first"))
)
register("chunk_rows", ix("SELECT idx // CAST(ceil(n / 5.0) AS BIGINT) AS chunk, count(*) AS rows, max(sample_id) AS last FROM ix GROUP BY idx // CAST(ceil(n / 5.0) AS BIGINT)"))(
    lambda spark, sf: G.chunk(indexed(spark, sf), 5).groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"), F.max("sample_id").alias("last"))
)
register(
    "concat_batches",
    with_views("rollouts", "SELECT sample_id, uid, NULL::VARCHAR AS pred FROM rollouts UNION ALL SELECT sample_id, NULL, pred FROM rollouts"),
)(
    lambda spark, sf: G.concat([V.rollouts(spark, sf).select("sample_id", "uid"), V.rollouts(spark, sf).select("sample_id", "pred")])
)
register(
    "merge_batch_meta",
    with_views(
        "rollouts",
        "SELECT 'sources' AS key, 0 AS pos, '5' AS value UNION ALL SELECT 'metrics', CAST(step AS INTEGER), CAST(count(*) AS VARCHAR) FROM rollouts GROUP BY step",
    ),
)(
    lambda spark, sf: G.merge_meta(
        V.rollouts(spark, sf)
        .groupBy(F.col("step").alias("part"))
        .agg(F.count(F.lit(1)).cast("string").alias("m"), F.countDistinct("data_source").cast("string").alias("s"))
        .select("part", F.inline(F.array(F.struct(F.lit("metrics").alias("key"), F.col("m").alias("value")), F.struct(F.lit("sources").alias("key"), F.col("s").alias("value")))))
    )
)
register(
    "pad_to_divisor",
    ix("SELECT sample_id, idx, false AS is_pad FROM ix UNION ALL SELECT sample_id, n + idx, true FROM ix WHERE idx < (4096 - n % 4096) % 4096"),
)(lambda spark, sf: G.pad_to_divisor(indexed(spark, sf), 4096).select("sample_id", "idx", "is_pad"))
register(
    "unpad_rows",
    ix("SELECT sample_id, idx FROM ix"),
)(lambda spark, sf: G.unpad(G.pad_to_divisor(indexed(spark, sf), 4096)).select("sample_id", "idx"))
register(
    "pad_with_last_row",
    ix("SELECT sample_id, idx, false AS is_pad FROM ix UNION ALL SELECT sample_id, n + unnest(range(7)), true FROM ix WHERE idx = n - 1"),
)(lambda spark, sf: G.pad_with_edge(indexed(spark, sf), 7, "last").select("sample_id", "idx", "is_pad"))
register(
    "mini_batches",
    with_views(
        "rollouts",
        """WITH e AS (SELECT sample_id, epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5(concat_ws(':', '7', epoch, sample_id)), sample_id) - 1 AS r FROM (SELECT sample_id, unnest(range(2)::INTEGER[]) AS epoch FROM rollouts))
 SELECT sample_id, epoch, r // 500 AS batch_id, r % 500 AS slot FROM e""",
    ),
)(
    lambda spark, sf: G.mini_batch_plan(V.rollouts(spark, sf).select("sample_id"), "sample_id", 500, 2, 7).select(
        "sample_id", "epoch", "batch_id", "slot"
    )
)


def token_lists(spark, sf):
    pages = packed(V.tokens(spark, sf), ["sample_id"], "pos", ["tag", "mask"], "rows")
    return pages.select("sample_id", F.transform("rows", lambda r: r["tag"]).alias("tags"), F.transform("rows", lambda r: r["mask"]).alias("mask"))


LISTS = "l AS (SELECT sample_id, list(tag ORDER BY pos) AS tags, list(mask ORDER BY pos) AS mask FROM tokens GROUP BY 1)"
joined_tags = lambda c: F.array_join(c.cast("array<string>"), ",")
register(
    "fit_arrays",
    with_views(
        "tokens",
        f"""WITH {LISTS} SELECT sample_id, array_to_string(CASE WHEN len(tags) > 5 THEN tags[len(tags) - 4:] ELSE list_concat(list_transform(range(5 - len(tags)), lambda x: 0::BIGINT), tags) END, ',') AS left_cut,
 array_to_string(CASE WHEN len(tags) > 5 THEN tags[:5] ELSE list_concat(tags, list_transform(range(5 - len(tags)), lambda x: 0::BIGINT)) END, ',') AS right_cut,
 array_to_string(CASE WHEN len(tags) > 5 THEN list_concat(tags[:2], tags[len(tags) - 2:]) ELSE list_concat(tags, list_transform(range(5 - len(tags)), lambda x: 0::BIGINT)) END, ',') AS middle_cut FROM l""",
    ),
)(
    lambda spark, sf: token_lists(spark, sf).select(
        "sample_id",
        joined_tags(G.fit_array(F.col("tags"), 5, F.lit(0).cast("long"), True, "left")).alias("left_cut"),
        joined_tags(G.fit_array(F.col("tags"), 5, F.lit(0).cast("long"), False, "right")).alias("right_cut"),
        joined_tags(G.fit_array(F.col("tags"), 5, F.lit(0).cast("long"), False, "middle")).alias("middle_cut"),
    )
)
register(
    "padding_round_trip",
    with_views(
        "tokens",
        """SELECT sample_id, coalesce(string_agg(CASE WHEN mask = 1 THEN CAST(tag AS VARCHAR) END, ',' ORDER BY pos), '') AS kept, string_agg(CASE WHEN mask = 1 THEN tag ELSE 0 END, ',' ORDER BY pos) AS padded FROM tokens GROUP BY 1""",
    ),
)(
    lambda spark, sf: token_lists(spark, sf)
    .withColumn("vals", G.drop_padding(F.col("tags"), F.col("mask")))
    .select(
        "sample_id",
        joined_tags(F.col("vals")).alias("kept"),
        joined_tags(G.restore_padding(F.col("vals"), F.col("mask"), 0)).alias("padded"),
    )
)


def ragged(spark, sf):
    """Token lists of a batch; some are missing, some empty."""
    gone = F.col("sample_id") % 7 == 0
    tags = F.when(~gone, F.when(F.col("sample_id") % 5 == 0, F.slice("tags", 1, 0)).otherwise(F.col("tags")))
    return token_lists(spark, sf).select((F.col("sample_id") % 16).alias("batch"), "sample_id", tags.alias("tags"))


RAGGED = f"{LISTS}, rg AS (SELECT sample_id % 16 AS batch, sample_id, CASE WHEN sample_id % 7 = 0 THEN NULL WHEN sample_id % 5 = 0 THEN [] ELSE tags END AS tags FROM l)"
register(
    "collate_jagged",
    with_views(
        "tokens",
        f"""WITH {RAGGED}, o AS (SELECT *, CAST(sum(len(coalesce(tags, []))) OVER (PARTITION BY batch ORDER BY sample_id) AS BIGINT) AS e FROM rg)
 SELECT batch, 0::BIGINT AS page, count(*) AS row_count, md5(string_agg(array_to_string(tags, ','), ',' ORDER BY sample_id) FILTER (len(tags) > 0)) AS values_md5,
 md5('0,' || string_agg(e, ',' ORDER BY sample_id)) AS offsets_md5, count(tags) AS known FROM o GROUP BY 1""",
    ),
)(
    lambda spark, sf: G.jagged(ragged(spark, sf), ["batch"], "sample_id", "tags").select(
        "batch",
        "page",
        F.size("sample_id").cast("long").alias("row_count"),
        F.md5(joined_tags(F.col("values"))).alias("values_md5"),
        F.md5(joined_tags(F.col("offsets"))).alias("offsets_md5"),
        F.size(F.filter("known", lambda k: k)).cast("long").alias("known"),
    )
)
register(
    "jagged_round_trip",
    with_views("tokens", f"WITH {RAGGED} SELECT batch, sample_id, tags IS NULL AS missing, array_to_string(tags, ',') AS tags FROM rg"),
)(
    lambda spark, sf: G.from_jagged(G.jagged(ragged(spark, sf), ["batch"], "sample_id", "tags"), ["batch"], "sample_id", "tags").select(
        "batch", "sample_id", F.col("tags").isNull().alias("missing"), F.when(F.col("tags").isNotNull(), joined_tags(F.col("tags"))).alias("tags")
    )
)
register(
    "response_window",
    with_views("tokens", f"WITH {LISTS} SELECT sample_id, array_to_string(tags[len(tags) - 2:len(tags) - 1], ',') AS response FROM l WHERE len(tags) > 2"),
)(
    lambda spark, sf: token_lists(spark, sf)
    .filter(F.size("tags") > 2)
    .select("sample_id", joined_tags(G.response_window(F.col("tags"), F.lit(2))).alias("response"))
)
register(
    "flatten_records",
    """SELECT vec_id, 'embedding/list_len' AS path, CAST(len(embedding) AS VARCHAR) AS value FROM embeddings
 UNION ALL SELECT vec_id, 'embedding/' || (i - 1), CAST(embedding[i] > 0 AS VARCHAR) FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings)""",
)(
    lambda spark, sf: G.flatten_lists(
        V.table(spark, sf, "embeddings").withColumn("embedding", F.transform("embedding", lambda x: x > 0)), ["vec_id"], "embedding"
    )
)


@register(
    "flatten_config",
    with_views("rollouts", """SELECT sample_id AS "id", uid AS "reward_model/group", data_source AS "reward_model/info/source", step AS "reward_model/info/step" FROM rollouts"""),
)
def flatten_config(spark, sf):
    info = F.struct(F.col("data_source").alias("source"), "step")
    d = V.rollouts(spark, sf).select(F.col("sample_id").alias("id"), F.struct(F.col("uid").alias("group"), info.alias("info")).alias("reward_model"))
    return d.select(*G.flatten_struct(d.schema))


# ---- filters -----------------------------------------------------------------------------


def chat_rows(spark, sf):
    turns = ranked(V.chats(spark, sf), ["conv_id"], ["turn"], "k")
    content = F.when(~((F.col("role") == "system") & (F.length("text") < 40)), F.col("text"))
    pages = packed(turns.withColumn("content", content), ["conv_id"], "k", ["role", "content"], "rows")
    return pages.withColumn("messages", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["content"].alias("content"))))


CHATS = """ch AS (SELECT conv_id, bool_and(NOT (role = 'system' AND length(text) < 40)) AS ok, string_agg('<' || role || '>: ' || text, chr(10) ORDER BY turn) || chr(10) || '<assistant>: ' AS t FROM conversations GROUP BY 1),
 n AS (SELECT conv_id, CASE WHEN ok THEN len(regexp_extract_all(t, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')) END AS n FROM ch)"""
register(
    "drop_overlong_prompts",
    f"WITH {CHATS} SELECT conv_id, CAST(n AS INTEGER) AS n FROM n WHERE n <= 400",
)(
    lambda spark, sf: X.drop_overlong(
        chat_rows(spark, sf).withColumn("n", X.words(X.render_chat(F.col("messages")))), F.col("n"), 400
    ).select("conv_id", "n")
)
register(
    "overlong_report",
    f"WITH {CHATS} SELECT conv_id % 3 AS part, count(*) AS before, count(*) FILTER (n <= 400) AS after FROM n GROUP BY 1",
)(
    lambda spark, sf: X.overlong_report(
        chat_rows(spark, sf).withColumn("part", F.col("conv_id") % 3), ["part"], X.words(X.render_chat(F.col("messages"))), 400
    )
)
register(
    "members_filter",
    with_views("rollouts", "SELECT sample_id, data_source, pred FROM rollouts WHERE data_source IN ('1-URGENT', '5-LOW') AND pred = 'O'"),
)(
    lambda spark, sf: X.members(
        V.rollouts(spark, sf).withColumn("details", F.struct(F.col("pred").alias("level"))), data_source=["1-URGENT", "5-LOW"], details__level=["O"]
    ).select("sample_id", "data_source", "pred")
)
register(
    "date_range_filter",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-02-01' AND o_orderdate < TIMESTAMP '1997-08-15'",
)(
    lambda spark, sf: X.dated(V.table(spark, sf, "orders"), "o_orderdate", start="1995-02-01", before="1998-01-01", until="1997-08-15").select("o_orderkey")
)
register(
    "usable_solution_filter",
    "SELECT p_partkey FROM part WHERE p_type IN ('ECONOMY', 'STANDARD') AND p_size <= 40",
)(
    lambda spark, sf: V.table(spark, sf, "part")
    .withColumn(
        "solution",
        F.when(F.col("p_size") <= 40, F.concat(F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), "```python\n").otherwise("```\n"), F.col("p_name"), F.lit("\n```"))),
    )
    .filter(X.usable_solution(F.col("solution")))
    .select("p_partkey")
)
register(
    "required_fields",
    "SELECT lang, count(*) AS rows, count(*) FILTER (quality IS NULL) AS skipped FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
)(
    lambda spark, sf: X.required_report(
        V.table(spark, sf, "documents").join(V.table(spark, sf, "labels"), "doc_id", "left"), ["lang"], ["text", "quality"]
    )
)
register(
    "varied_groups",
    with_views("rollouts", "SELECT sample_id, uid FROM rollouts QUALIFY max(acc) OVER (PARTITION BY uid) > min(acc) OVER (PARTITION BY uid)"),
)(lambda spark, sf: X.varied_groups(V.rollouts(spark, sf), "uid", "acc").select("sample_id", "uid"))
register("first_rows", with_views("rollouts", "SELECT sample_id FROM rollouts ORDER BY sample_id LIMIT 1234"))(
    lambda spark, sf: X.first_rows(V.rollouts(spark, sf).select("sample_id"), ["sample_id"], 1234)
)
register(
    "random_rows",
    with_views("rollouts", "SELECT sample_id FROM rollouts ORDER BY md5(concat_ws(':', '3', sample_id)), sample_id LIMIT 1234"),
)(lambda spark, sf: X.random_rows(V.rollouts(spark, sf).select("sample_id"), "sample_id", 1234, 3))
U = "CAST(('0x' || substring(md5({}), 1, 12)) AS BIGINT) / 281474976710656.0"
register(
    "hash_split",
    with_views(
        "rollouts", f"SELECT sample_id, CASE WHEN {U.format("concat_ws(':', '5', sample_id)")} < 0.1 THEN 'test' ELSE 'train' END AS split FROM rollouts"
    ),
)(lambda spark, sf: X.hash_split(V.rollouts(spark, sf).select("sample_id"), "sample_id", 0.1, 5))
register(
    "exact_split",
    with_views(
        "rollouts",
        "SELECT sample_id, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws(':', '5', sample_id)), sample_id) <= ceil(count(*) OVER () * 0.13) THEN 'test' ELSE 'train' END AS split FROM rollouts",
    ),
)(lambda spark, sf: X.exact_split(V.rollouts(spark, sf).select("sample_id"), "sample_id", 0.13, 5))
register(
    "halve_tests",
    with_views(
        "tokens",
        """WITH h AS (SELECT sample_id, tag, pos - 1 AS i, count(*) OVER w AS n, row_number() OVER (PARTITION BY sample_id ORDER BY md5(concat_ws(':', '9', sample_id, pos - 1)), pos) AS r FROM tokens WINDOW w AS (PARTITION BY sample_id))
 SELECT sample_id, string_agg(tag, ',' ORDER BY i) AS inputs, string_agg(i, ',' ORDER BY i) AS outputs FROM h WHERE r <= greatest(1, n // 2) GROUP BY 1""",
    ),
)(
    lambda spark, sf: X.halve_tests(
        token_lists(spark, sf).withColumn("outputs", F.sequence(F.lit(0), F.size("tags") - 1)), "sample_id", "tags", "outputs", 9
    ).select("sample_id", joined_tags(F.col("tags")).alias("inputs"), joined_tags(F.col("outputs")).alias("outputs"))
)
register(
    "tests_report",
    with_views("tokens", "WITH n AS (SELECT count(*) AS n FROM tokens GROUP BY sample_id) SELECT round(avg(n), 6) AS tests_before, round(avg(greatest(1, n // 2)), 6) AS tests_after FROM n"),
)(
    lambda spark, sf: X.tests_report(
        X.halve_tests(token_lists(spark, sf).withColumn("kept", F.col("tags")).withColumn("outputs", F.col("tags")), "sample_id", "kept", "outputs", 9),
        "tags",
        "kept",
    ).select(r6("tests_before").alias("tests_before"), r6("tests_after").alias("tests_after"))
)
register(
    "sample_generations",
    "SELECT o_orderkey FROM orders ORDER BY md5(concat_ws(':', '42', o_orderkey, o_orderstatus)) LIMIT 50",
)(
    lambda spark, sf: X.sample_generations(V.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 50, 42, ["o_orderkey", "o_orderstatus"]).select("o_orderkey")
)
for _method, _weight in {
    "pow": "power(abs(score), 2.0)",
    "max_min": "CASE WHEN score = hi OR score = lo THEN 1.0 ELSE 0.0 END",
    "max_random": "CASE WHEN score = hi THEN 0.4 ELSE 0.1 END",
}.items():
    register(
        f"resample_{_method}",
        with_views(
            "rollouts",
            f"""WITH b AS (SELECT *, max(score) OVER s AS hi, min(score) OVER s AS lo, row_number() OVER (PARTITION BY step ORDER BY sample_id) AS r, count(*) OVER s AS n FROM rollouts WINDOW s AS (PARTITION BY step)),
 w AS (SELECT *, {_weight} + 1e-8 AS w FROM b), c AS (SELECT *, sum(w) OVER (PARTITION BY step ORDER BY r) / sum(w) OVER (PARTITION BY step) AS hi_c, (sum(w) OVER (PARTITION BY step ORDER BY r) - w) / sum(w) OVER (PARTITION BY step) AS lo_c FROM w),
 d AS (SELECT step, r AS draw, {U.format("concat_ws(':', '11', step, r)")} AS u FROM c)
 SELECT d.step, draw, sample_id FROM d ASOF JOIN (SELECT step, lo_c, sample_id FROM c) x ON d.step = x.step AND d.u >= x.lo_c""",
        ),
    )(
        lambda spark, sf, method=_method: X.resample(V.rollouts(spark, sf), ["step"], "sample_id", "score", method, seed=11).select("step", "draw", "sample_id")
    )
register("whole_batches", ix("SELECT sample_id, idx // 1024 AS batch_id FROM ix WHERE idx // 1024 < n // 1024"))(
    lambda spark, sf: X.whole_batches(indexed(spark, sf), 1024).select("sample_id", "batch_id")
)
register(
    "curriculum_order",
    """WITH h AS (SELECT o_custkey, -avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END) AS d FROM orders GROUP BY 1)
 SELECT c_custkey, row_number() OVER (ORDER BY coalesce(d, '-inf'::DOUBLE), c_custkey) - 1 AS turn FROM customer LEFT JOIN h ON o_custkey = c_custkey""",
)(
    lambda spark, sf: X.curriculum(
        V.table(spark, sf, "customer").select("c_custkey"),
        V.rollouts(spark, sf).withColumnRenamed("uid", "c_custkey"),
        "c_custkey",
        F.avg("acc"),
        ascending=False,
    ).select("c_custkey", "turn")
)
register(
    "redact_text",
    "SELECT doc_id, md5(regexp_replace(text, '[0-9]+', '*', 'g')) AS text_md5 FROM documents",
)(lambda spark, sf: X.redact(V.table(spark, sf, "documents").select("doc_id", "text"), ["text"], "[0-9]+").select("doc_id", F.md5("text").alias("text_md5")))
register(
    "keyword_hits",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content, unnest(range(len(string_split(text, chr(10))))) AS line FROM documents)
 SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(instr(content, 'the') - 1 AS INTEGER) AS "column" FROM l WHERE contains(content, 'the')""",
)(lambda spark, sf: X.keyword_hits(V.table(spark, sf, "documents"), ["doc_id"], "text", "the").select("doc_id", "line", "column"))

# ---- balancing ---------------------------------------------------------------------------


def sized(spark, sf):
    return responses(spark, sf).select("sample_id", "uid", "step", F.col("n_tokens").alias("length")).withColumn("work", B.workload(F.col("length")))


SIZED = f"{RESPONSES_SQL}, sz AS (SELECT sample_id, uid, step, n_tokens AS length, 24576 * n_tokens + n_tokens * n_tokens AS work FROM responses)"
register("workload", with_views("rollouts loose_tokens", f"WITH {SIZED} SELECT sample_id, length, work FROM sz"))(
    lambda spark, sf: sized(spark, sf).select("sample_id", "length", "work")
)
# rows dealt by descending work over 8 parts per step, in SQL
DEALT = f"""{SIZED}, dr AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY -work, sample_id) - 1 AS z FROM sz),
 dealt AS (SELECT *, CAST(CASE WHEN (z // 8) % 2 = 0 THEN z % 8 ELSE 7 - z % 8 END AS INTEGER) AS part FROM dr)"""
register("partition_by_differencing")(
    lambda spark, sf: B.partition_by_merging(sized(spark, sf), ["step"], "work", "sample_id", 8).select("step", "sample_id", "part", "work")
)
register("partition_equal_size")(
    lambda spark, sf: B.partition_by_merging(sized(spark, sf), [], "work", "sample_id", 4, equal_size=True).select("sample_id", "part", "work")
)
register("partition_greedy")(
    lambda spark, sf: B.partition_by_merging(sized(spark, sf), ["step"], "work", "sample_id", 8, rule="least_sum").select("step", "sample_id", "part", "work")
)


def part_spread(df):
    sums = df.groupBy("step", "part").agg(F.sum("work").alias("s"), F.count(F.lit(1)).alias("n"))
    return sums.groupBy("step").agg((F.max("s") - F.min("s")).alias("spread"), (F.max("n") - F.min("n")).alias("uneven"), F.count(F.lit(1)).alias("parts"))


@register(
    "partition_spread",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {DEALT}, p AS (SELECT step, part, sum(work) AS s, count(*) AS n FROM dealt GROUP BY 1, 2)
 SELECT step, CAST(max(s) - min(s) AS BIGINT) AS serpentine, true AS no_larger, CAST(max(n) - min(n) AS BIGINT) AS uneven, 8::BIGINT AS parts, CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(s) AS BIGINT) AS work FROM p GROUP BY 1""",
    ),
)
def partition_spread(spark, sf):
    """Largest differencing against the serpentine: spreads of the sums, and what no partition may change."""
    rows = sized(spark, sf)
    dealt = part_spread(B.partition_batches(rows, ["step"], "work", "sample_id", 8)).select("step", F.col("spread").alias("serpentine"))
    merged = B.partition_by_merging(rows, ["step"], "work", "sample_id", 8)
    whole = merged.groupBy("step").agg(F.count(F.lit(1)).alias("row_count"), F.sum("work").alias("work"))
    found = part_spread(merged).join(dealt, "step").join(whole, "step")
    return found.select("step", "serpentine", (F.col("spread") <= F.col("serpentine")).alias("no_larger"), "uneven", "parts", "row_count", "work")


register(
    "partition_serpentine_equal",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {SIZED}, r AS (SELECT *, row_number() OVER (ORDER BY -work, sample_id) - 1 AS z FROM sz)
 SELECT sample_id, CAST(CASE WHEN (z // 4) % 2 = 0 THEN z % 4 ELSE 3 - z % 4 END AS INTEGER) AS part, work FROM r""",
    ),
)(lambda spark, sf: B.partition_batches(sized(spark, sf), [], "work", "sample_id", 4, equal_size=True).select("sample_id", "part", "work"))
register(
    "partition_serpentine_input_order",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {SIZED}, r AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY sample_id) - 1 AS z FROM sz)
 SELECT step, sample_id, CAST(CASE WHEN (z // 8) % 2 = 0 THEN z % 8 ELSE 7 - z % 8 END AS INTEGER) AS part, work FROM r""",
    ),
)(lambda spark, sf: B.partition_batches(sized(spark, sf), ["step"], "work", "sample_id", 8, sort=False).select("step", "sample_id", "part", "work"))
register(
    "partition_serpentine",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {SIZED}, r AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY -work, sample_id) - 1 AS z FROM sz)
 SELECT step, sample_id, CAST(CASE WHEN (z // 8) % 2 = 0 THEN z % 8 ELSE 7 - z % 8 END AS INTEGER) AS part FROM r""",
    ),
)(lambda spark, sf: B.serpentine(sized(spark, sf), ["step"], "work", "sample_id", F.lit(8)).select("step", "sample_id", "part"))


@register(
    "partition_groups_together",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {SIZED}, g AS (SELECT uid, sum(work) AS w FROM sz GROUP BY 1), r AS (SELECT uid, row_number() OVER (ORDER BY -w, uid) - 1 AS z FROM g)
 SELECT uid, sample_id, CAST(CASE WHEN (z // 8) % 2 = 0 THEN z % 8 ELSE 7 - z % 8 END AS INTEGER) AS part, work FROM sz JOIN r USING (uid)""",
    ),
)
def partition_groups_together(spark, sf):
    return B.partition_groups(sized(spark, sf), [], "uid", "work", 8).select("uid", "sample_id", "part", "work")


@register(
    "batch_balance_order",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {DEALT}, r AS (SELECT *, row_number() OVER (PARTITION BY step, part ORDER BY work, sample_id) - 1 AS y, count(*) OVER (PARTITION BY step, part) AS n FROM dealt)
 SELECT step, part, CAST(CASE WHEN y % 2 = 0 THEN y // 2 ELSE n - 1 - (y - 1) // 2 END AS BIGINT) AS slot, sample_id FROM r""",
    ),
)
def batch_balance_order(spark, sf):
    placed = B.partition_batches(sized(spark, sf), ["step"], "work", "sample_id", 8)
    return B.order_inside_parts(placed, ["step"], "work", "sample_id").select("step", "part", "slot", "sample_id")


IMBALANCE = f"""WITH {SIZED}, r AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY -work, sample_id) - 1 AS z, row_number() OVER (PARTITION BY step ORDER BY sample_id) - 1 AS i, count(*) OVER (PARTITION BY step) AS n FROM sz),
 p AS (SELECT step, length, CASE WHEN (z // 8) % 2 = 0 THEN z % 8 ELSE 7 - z % 8 END AS part, i // (n // 8) AS sl FROM r),
 b AS (SELECT step, CAST(sum(length) AS BIGINT) AS s FROM p GROUP BY step, sl), a AS (SELECT step, CAST(sum(length) AS BIGINT) AS s FROM p GROUP BY step, part)
 SELECT step, min, max, minmax_diff, balanced_min, balanced_max, mean FROM (SELECT step, min(s) AS min, max(s) AS max, max(s) - min(s) AS minmax_diff, CAST(sum(s) AS BIGINT) / 8 AS mean FROM b GROUP BY 1) JOIN (SELECT step, min(s) AS balanced_min, max(s) AS balanced_max FROM a GROUP BY 1) USING (step)"""


@register("partition_imbalance", with_views("rollouts loose_tokens", IMBALANCE))
def partition_imbalance(spark, sf):
    placed = B.partition_batches(sized(spark, sf), ["step"], "work", "sample_id", 8)
    return B.imbalance(placed, ["step"], "length", "sample_id", 8)


register("partition_imbalance_serpentine", with_views("rollouts loose_tokens", IMBALANCE))(
    lambda spark, sf: B.imbalance(
        B.serpentine(sized(spark, sf), ["step"], "work", "sample_id", F.lit(8)), ["step"], "length", "sample_id", 8
    )
)
register(
    "micro_batch_counts",
    with_views(
        "rollouts loose_tokens",
        f"WITH {SIZED} SELECT step, CAST(sum(length) AS BIGINT) AS tokens, CAST(ceil(greatest(least(count(*), ceil(sum(length) / 300.0)), 4) / 4.0) * 4 AS INTEGER) AS micro_batches FROM sz GROUP BY 1",
    ),
)(lambda spark, sf: B.micro_batch_counts(sized(spark, sf), ["step"], "length", 300, 4, 4))
register(
    "micro_batches",
    with_views(
        "rollouts loose_tokens",
        f"""WITH {SIZED}, k AS (SELECT step, CAST(ceil(greatest(least(count(*), ceil(sum(length) / 300.0)), 4) / 4.0) * 4 AS BIGINT) AS k FROM sz GROUP BY 1),
 r AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY -work, sample_id) - 1 AS z FROM sz JOIN k USING (step)),
 p AS (SELECT *, CAST(CASE WHEN (z // k) % 2 = 0 THEN z % k ELSE k - 1 - z % k END AS INTEGER) AS part FROM r),
 g AS (SELECT step, part, any_value(k) AS k, row_number() OVER (PARTITION BY step ORDER BY -sum(work), -min(sample_id)) - 1 AS y FROM p GROUP BY step, part)
 SELECT step, sample_id, part, CAST(CASE WHEN y % 2 = 0 THEN (g.k + 1) // 2 - 1 - y // 2 ELSE (g.k + 1) // 2 + (y - 1) // 2 END AS BIGINT) AS micro, length
 FROM p JOIN g USING (step, part)""",
    ),
)(
    lambda spark, sf: B.micro_batches(sized(spark, sf), ["step"], "length", "sample_id", 300, 4, 4).select("step", "sample_id", "part", "micro", "length")
)


@register(
    "restore_order",
    ix("SELECT sample_id, idx FROM ix"),
)
def restore_order(spark, sf):
    d = B.serpentine(indexed(spark, sf).withColumn("work", F.col("uid")), ["step"], "work", "sample_id", F.lit(8))
    return B.restore(d, "idx").select("sample_id", "idx")


# ---- hooks -------------------------------------------------------------------------------


@K.hook("dataset", "customers")
def customers(spark, sf_dir):
    """Prompts made by user code: customers with their nation as the group."""
    return V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("prompt_id"), F.col("c_nationkey").alias("nation"), F.col("c_name").alias("prompt"))


def prompts(spark, sf):
    return K.build_dataset(spark, "customers", needs=("prompt_id", "prompt"), sf_dir=sf)


def scored(spark, sf):
    """Results of a batch: the logged responses of its prompts."""
    log = V.rollouts(spark, sf).select("uid", F.col("acc").alias("score"))
    return lambda batch: batch.join(log, batch["prompt_id"] == log["uid"]).drop("uid")


register("dataset_hook", "SELECT c_nationkey AS nation, count(*) AS prompts, md5(string_agg(c_name, ',' ORDER BY c_custkey)) AS names FROM customer GROUP BY 1")(
    lambda spark, sf: prompts(spark, sf)
    .groupBy("nation")
    .agg(F.count(F.lit(1)).alias("prompts"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("prompt_id", "prompt"))), lambda x: x["prompt"]), ",")).alias("names"))
)


def curriculum_sql(batches, size, generated):
    """Batch by batch, as a reader would do it by hand."""
    steps = ["r0 AS (SELECT c_custkey AS prompt_id, c_nationkey AS nation FROM customer)", "s0 AS (SELECT NULL::INTEGER AS nation, 0.0::DOUBLE AS total, 0 AS n WHERE false)"]
    for b in range(batches):
        steps += [
            f"""o{b} AS (SELECT r.prompt_id, r.nation, row_number() OVER (ORDER BY coalesce(s.total / s.n, 0.5), r.prompt_id) AS nth FROM r{b} r LEFT JOIN s{b} s ON r.nation = s.nation)""",
            f"b{b} AS (SELECT prompt_id, nation FROM o{b} WHERE nth <= {size})",
            f"g{b} AS (SELECT b.nation, r.prompt_id, r.acc FROM b{b} b JOIN (SELECT uid AS prompt_id, acc FROM rollouts) r USING (prompt_id))",
            f"""s{b + 1} AS (SELECT nation, sum(total) AS total, sum(n) AS n FROM (SELECT * FROM s{b} UNION ALL SELECT nation, CAST(sum(acc) AS DOUBLE), count(*) FROM g{b} GROUP BY 1) GROUP BY 1)""",
            f"r{b + 1} AS (SELECT prompt_id, nation FROM r{b} WHERE prompt_id NOT IN (SELECT prompt_id FROM b{b})"
            + (f" UNION ALL SELECT DISTINCT prompt_id + {b + 1}000000000, nation FROM g{b} WHERE acc = 0)" if generated else ")"),
        ]
    drawn = " UNION ALL ".join(f"SELECT {b} AS batch, prompt_id, nation FROM b{b}" for b in range(batches))
    return f"WITH {', '.join(steps)} {drawn}"


register("sampler_hook", with_views("rollouts", curriculum_sql(4, 40, False)))(
    lambda spark, sf: K.epoch(prompts(spark, sf), "prompt_id", K.find("sampler", "hardest_group")("nation"), scored(spark, sf), 40, 4).select("batch", "prompt_id", "nation")
)


@K.hook("generator", "failed_again")
def failed_again(rows, results, key, number):
    """A new prompt for each that a response has failed."""
    return results.filter("score = 0").select(*rows.columns).distinct().withColumn(key, F.col(key) + F.lit(number * 1_000_000_000).cast("long"))


register("generator_hook", with_views("rollouts", curriculum_sql(4, 40, True)))(
    lambda spark, sf: K.epoch(
        prompts(spark, sf),
        "prompt_id",
        K.find("sampler", "hardest_group")("nation"),
        scored(spark, sf),
        40,
        4,
        K.find("generator", "failed_again"),
        keep=lambda new: X.drop_overlong(new, F.length("prompt"), 1000),
    ).select("batch", "prompt_id", "nation")
)
