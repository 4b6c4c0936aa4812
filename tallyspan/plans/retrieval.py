"""Registered queries of the retrieval family."""

from pyspark.sql import functions as F

from tallyspan.operators import retrieval as R
from tallyspan.plans import register
from tallyspan.plans.advantage import r6
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views
from tallyspan.spread import ranked


def vectors(spark, sf):
    return V.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")


def centroids(spark, sf):
    """The mean vector of each label as a query."""
    mean = R.pooled(vectors(spark, sf), ["label"], "embedding")
    return R.vectors_of(mean, ["label"]).select(F.col("label").cast("long").alias("query_id"), "embedding")


CENTROIDS = """d AS (SELECT label, vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(64)) AS dim FROM embeddings),
 c AS (SELECT label, dim, avg(v) AS v FROM d GROUP BY 1, 2)"""
register("pooled_embeddings", f"WITH {CENTROIDS} SELECT label, CAST(dim AS INTEGER) AS dim, round(v, 6) AS value FROM c")(
    lambda spark, sf: R.pooled(vectors(spark, sf), ["label"], "embedding").select("label", "dim", r6("value").alias("value"))
)
register(
    "first_token_embeddings",
    """WITH f AS (SELECT label, arg_min(embedding, vec_id) AS e FROM embeddings GROUP BY 1), d AS (SELECT label, unnest(e) AS v, unnest(range(64)) AS dim FROM f)
 SELECT label, CAST(dim AS INTEGER) AS dim, round(CAST(v AS DOUBLE), 6) AS value FROM d""",
)(
    lambda spark, sf: R.pooled(
        ranked(vectors(spark, sf), ["label"], ["doc_id"], "pos"), ["label"], "embedding", how="first"
    ).select("label", "dim", r6("value").alias("value"))
)
register(
    "dense_top_k",
    f"""WITH {CENTROIDS}, s AS (SELECT c.label AS query_id, d.vec_id AS doc_id, round(sum(c.v * d.v), 9) AS score FROM c JOIN d USING (dim) GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
 SELECT CAST(query_id AS BIGINT) AS query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
)(
    lambda spark, sf: R.dense_top_k(vectors(spark, sf), centroids(spark, sf), 10).select("query_id", "doc_id", r6("score").alias("score"), "rank")
)
BM = """q AS (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM benchmark), qt AS (SELECT query_id, w, count(*) AS qtf FROM q GROUP BY 1, 2),
 t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents), tf AS (SELECT doc_id, w, count(*) AS tf FROM t GROUP BY 1, 2),
 dl AS (SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY 1), df AS (SELECT w, count(*) AS df FROM tf GROUP BY 1), n AS (SELECT count(*) AS n FROM documents), a AS (SELECT sum(dl) / any_value(n) AS avgdl FROM dl, n),
 s AS (SELECT query_id, doc_id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 1.9 / (tf + 0.9 * (1 - 0.4 + 0.4 * dl / avgdl))), 9) AS score
 FROM qt JOIN tf USING (w) JOIN df USING (w) JOIN dl USING (doc_id), n, a GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)"""


def bench_queries(spark, sf):
    return V.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def bm25(spark, sf, k):
    return R.bm25_top_k(V.table(spark, sf, "documents").select("doc_id", "text"), bench_queries(spark, sf), k)


register(
    "bm25_top_k",
    f"WITH {BM} SELECT query_id, doc_id, round(score, 5) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5",
)(lambda spark, sf: bm25(spark, sf, 5).select("query_id", "doc_id", F.round("score", 5).alias("score"), "rank"))
register(
    "fetch_documents",
    f"WITH {BM} SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, lang, n_chars FROM r JOIN documents USING (doc_id) WHERE rank <= 2",
)(
    lambda spark, sf: R.fetch(bm25(spark, sf, 2), V.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")).select(
        "query_id", "rank", "doc_id", "lang", "n_chars"
    )
)
register(
    "passages_text",
    f"""WITH {BM}, p AS (SELECT query_id, rank, 'Doc ' || rank || ' (Title: ' || split_part(text, chr(10), 1) || ')' || chr(10) || CASE WHEN contains(text, chr(10)) THEN substr(text, length(split_part(text, chr(10), 1)) + 2) ELSE '' END || chr(10) || chr(10) AS b FROM r JOIN documents USING (doc_id) WHERE rank <= 3)
 SELECT item_id AS query_id, md5(coalesce(regexp_replace(string_agg(b, '' ORDER BY rank), '^\\s+|\\s+$', '', 'g'), 'No search results found.')) AS result_md5 FROM benchmark LEFT JOIN p ON query_id = item_id GROUP BY 1""",
)(
    lambda spark, sf: R.passages_text(
        R.fetch(bm25(spark, sf, 3), V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("contents"))), bench_queries(spark, sf)
    ).select("query_id", F.md5("result").alias("result_md5"))
)
register(
    "joined_results",
    """SELECT o_custkey AS request, CAST(0 AS BIGINT) AS page, string_agg('r' || o_orderkey, chr(10) || '---' || chr(10) ORDER BY o_orderkey) AS result FROM orders GROUP BY 1""",
)(
    lambda spark, sf: R.joined_results(
        V.table(spark, sf, "orders").select(
            F.col("o_custkey").alias("request"), "o_orderkey", F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("result")
        ),
        ["request"],
        "o_orderkey",
    )
)
register(
    "samples_by_score",
    with_views(
        "rollouts",
        "SELECT step, sample_id, row_number() OVER (PARTITION BY step ORDER BY -coalesce(CASE WHEN pred <> 'P' THEN score END, acc, 0), sample_id) AS place FROM rollouts",
    ),
)(
    lambda spark, sf: R.sorted_steps(
        V.rollouts(spark, sf).withColumn("score_1", F.col("acc")).withColumn("score", F.when(F.col("pred") != "P", F.col("score")))
    ).select("step", "sample_id", "place")
)


def cov_tokens(spark, sf):
    t = V.tokens(spark, sf).join(V.rollouts(spark, sf).select("sample_id", "step"), "sample_id")
    return t.withColumn("adv", F.col("value") - F.col("reward"))


COV = """t AS (SELECT k.*, step, value - reward AS adv FROM tokens k JOIN rollouts USING (sample_id)),
 m AS (SELECT step, sum(adv * mask) / (sum(mask) + 1e-8) AS a, sum(old_logp * mask) / (sum(mask) + 1e-8) AS l, sum(mask) AS n FROM t GROUP BY 1),
 c AS (SELECT sample_id, pos, step, mask, n, (adv - a) * (old_logp - l) AS cov FROM t JOIN m USING (step))"""
register(
    "top_covariance_tokens",
    with_views(
        "rollouts tokens",
        f"""WITH {COV}, r AS (SELECT *, row_number() OVER (PARTITION BY step, mask ORDER BY -cov, sample_id, pos) AS r FROM c)
 SELECT sample_id, pos, mask = 1 AND r <= greatest(floor(n * 0.02), 1) AS selected FROM r""",
    ),
)(lambda spark, sf: R.top_covariance_tokens(cov_tokens(spark, sf), ["step"], 0.02, ["sample_id", "pos"]).select("sample_id", "pos", "selected"))
register(
    "random_covariance_tokens",
    with_views(
        "rollouts tokens",
        f"""WITH {COV}, i AS (SELECT *, mask = 1 AND cov > 0.001 AND cov < 0.03 AS ok FROM c),
 r AS (SELECT *, row_number() OVER (PARTITION BY step, ok ORDER BY md5(concat_ws(':', '4', sample_id, pos)), sample_id, pos) AS r FROM i)
 SELECT sample_id, pos, ok AND r <= greatest(floor(n * 0.02), 1) AS selected FROM r""",
    ),
)(
    lambda spark, sf: R.random_covariance_tokens(cov_tokens(spark, sf), ["step"], 0.02, 0.001, 0.03, ["sample_id", "pos"], 4).select(
        "sample_id", "pos", "selected"
    )
)
