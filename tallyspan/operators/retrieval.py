"""Exact top-k retrieval: dense by inner product, lexical by BM25, and the text given to a model.

Dense: queries and vectors are dealt into blocks, every block of queries meets every block of vectors
by the pair of block numbers, and a pair hands on k hits per query. Lexical: queries meet an inverted
index word by word; documents that cannot reach a query's k-th score are never paired with it. Nothing
passes through the driver but the words of few queries, at most FEW_WORDS; the index and the queries' words,
which are read several times, are written first.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.values import bound
from tallyspan.spread import attach_table, packed, ranked, stored, top_k

#: Rows of a block: a pair of blocks is one task's product of two matrices.
QUERY_BLOCK, VECTOR_BLOCK = 512, 8_192


def _blocks(df: DataFrame, size: int) -> Column:
    """The number of blocks that ``df`` fills, at least one; counted when the query runs."""
    return df.agg(F.greatest(F.ceil(F.count(F.lit(1)) / size), F.lit(1)).alias("n")).scalar()


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(values), -1)


def _best_of_block(k: int):
    """The k largest inner products of every query of one block with the vectors of another."""

    def best(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        names = queries.column("query_id").to_numpy()
        vectors = vectors.sort_by("doc_id")  # of equal scores the lower id comes first
        ids, n = vectors.column("doc_id").to_numpy(), vectors.num_rows
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if n and len(names):
            scores = np.round(_matrix(queries, "embedding") @ _matrix(vectors, "embedding").T, 9)
            least = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(names), -np.inf)
            query, at = np.nonzero(scores >= least[:, None])
            order = np.lexsort((at, -scores[query, at], query))
            query, at = query[order], at[order]
            starts = np.searchsorted(query, np.arange(len(names)))
            keep = np.arange(len(query)) - starts[query] < k
            query, at = query[keep], at[keep]
            found = [names[query], ids[at], scores[query, at]]
        return pa.table([pa.array(c) for c in found], names=["query_id", "doc_id", "score"])

    return best


def dense_top_k(vectors: DataFrame, queries: DataFrame, k: int, query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """``query_id, doc_id, score, rank`` of the k largest inner products.

    ``vectors``: ``doc_id long, embedding``; ``queries``: ``query_id long, embedding``. Scores are
    rounded to 9 digits so that copies tie. A row without vector has no hits.
    """
    asked, held = queries.filter(F.col("embedding").isNotNull()), vectors.filter(F.col("embedding").isNotNull())
    many, parts = _blocks(asked, query_block), _blocks(held, vector_block)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = asked.select("query_id", "embedding", F.pmod(F.xxhash64("query_id"), many).alias("qb"), every(parts).alias("vb"))
    right = held.select("doc_id", "embedding", F.pmod(F.xxhash64("doc_id"), parts).alias("vb"), every(many).alias("qb"))
    pairs = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb"))
    hits = pairs.applyInArrow(_best_of_block(k), "query_id long, doc_id long, score double")
    return top_k(hits, ["query_id"], [F.desc("score"), F.asc("doc_id")], k, "rank")


WORD = r"[a-z0-9]+"
#: Postings of a query's strongest words that are scored first, for a lower bound of its k-th score.
PROBE = 2_000
#: Parts that the documents of a word are dealt over.
SALTS = 16
#: Rows of words that are broadcast to the postings; more meet them by a shuffle.
FEW_WORDS = 100_000
#: Share of a query's floor that the bounds of its weak words may sum to.
WEAK_SHARE = 0.25
#: Score differences below this are rounding.
_SLACK = 1e-6


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def _sent(words: DataFrame) -> DataFrame:
    """Words of queries on their way to the postings; ``words`` is stored, so that it is counted by its footers."""
    return F.broadcast(words) if words.count() <= FEW_WORDS else words.hint("merge")


def _salt() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")


def inverted_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, doc_id, tf, length``: every word of every document once. Words are counted inside the
    document's row, so nothing is shuffled. Write it as a table to search it often."""

    def counted(words: Column) -> Column:
        n = F.size(words)
        first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))

        def runs(at: Column) -> Column:
            ends = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(n))
            return F.zip_with(at, ends, lambda a, e: F.struct(F.get(words, a).alias("word"), (e - a).alias("tf"), n.alias("length")))

        return bound(first, runs)

    rows = docs.select("doc_id", F.sort_array(words_of(F.col(text))).alias("w")).filter(F.size("w") > 0)
    return rows.select("doc_id", F.explode(bound(F.col("w"), counted)).alias("p")).select("p.word", "doc_id", "p.tf", "p.length")


def collection_totals(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row: ``n`` documents, ``average`` words of one, ``copies`` rows of one id at most."""
    words = F.sum(F.size(words_of(F.coalesce(F.col(text), F.lit("")))))
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"), words.alias("words"))
    n = F.coalesce(F.sum("copies"), F.lit(0).cast("long"))
    average = F.coalesce(F.sum("words"), F.lit(0)) / F.greatest(n, F.lit(1))
    copies = F.coalesce(F.max(F.when(F.col("doc_id").isNotNull(), F.col("copies"))), F.lit(1).cast("long"))
    return ids.agg(n.alias("n"), average.alias("average"), copies.alias("copies"))


def bm25_search(
    index: DataFrame, totals: DataFrame, queries: DataFrame, k: int, k1: float = 0.9, b: float = 0.4, text: str = "text", probe: int = PROBE
) -> DataFrame:
    """``query_id, doc_id, score, rank`` of the k best BM25 scores above 0 in an ``inverted_index`` with its
    ``collection_totals``; a query may have fewer hits.

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); the term part is tf (k1 + 1) / (tf + k1 (1 - b + b dl / avgdl)).

    A word's largest term part times its weight bounds what it can add to a score. The strongest words of a
    query, about ``probe`` postings, give scores whose k-th is a floor. Weak words whose bounds sum to
    less than a share of the floor cannot carry a document: only documents with another word of the query are
    paired with it, and of those only the few that can still reach the floor look up their weak words. The
    words of few queries are broadcast, so that postings are not shuffled; else the documents of a word are
    dealt over ``SALTS`` parts, and a query's words go to each of them.
    """
    # an id that comes several times has the sum of its rows
    copies = F.max("copies") if "copies" in totals.columns else F.lit(1)
    whole = totals.agg(F.struct(F.max("n").alias("n"), F.max("average").alias("average"), copies.alias("copies")).alias("t")).scalar()
    n, average = whole["n"], whole["average"]
    terms = queries.select("query_id", F.explode(words_of(F.col(text))).alias("word")).groupBy("query_id", "word").agg(F.count(F.lit(1)).alias("times"))
    terms = stored(terms)
    asked_words = _sent(stored(terms.select("word").distinct()))
    part = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / average))
    postings = index.join(asked_words, "word", "left_semi").select("word", "doc_id", part.alias("part"), _salt().alias("salt"))
    words = postings.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.max("part").alias("most"))
    weight = F.col("times") * F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = terms.join(words, "word").select("query_id", "word", "df", weight.alias("weight"), (weight * F.col("most")).alias("most"))
    own = Window.partitionBy("query_id")  # a query's words
    before = own.orderBy(F.desc("most"), "word").rowsBetween(Window.unboundedPreceding, -1)
    up_to = own.orderBy("most", F.desc("word")).rowsBetween(Window.unboundedPreceding, 0)
    # the queries' words, with what the index knows of them, are used five times below
    terms = stored(terms.withColumn("seen", F.coalesce(F.sum("df").over(before), F.lit(0))).withColumn("weak", F.sum("most").over(up_to)))
    few = terms.count() <= FEW_WORDS

    def scores(of: DataFrame) -> DataFrame:
        asked = of.select("query_id", "word", "weight")
        if few:
            met = postings.join(F.broadcast(asked), "word")
        else:
            dealt = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            met = dealt.hint("merge").join(postings, ["word", "salt"])
        return met.groupBy("query_id", "doc_id").agg(F.sum(F.col("weight") * F.col("part")).alias("score"))

    first = scores(terms.filter(F.col("seen") < max(probe, k)))
    floor = top_k(first, ["query_id"], [F.desc("score"), F.asc("doc_id")], k, "rank").filter(F.col("rank") == k)
    terms = terms.join(floor.select("query_id", (F.col("score") - _SLACK).alias("floor")), "query_id", "left").fillna({"floor": 0.0})
    # the bounds are those of one row: where ids repeat, weak words are as many as the floor allows
    strong = F.col("weak") >= F.col("floor") * F.when(whole["copies"] == 1, WEAK_SHARE).otherwise(1.0)
    rest = F.max(F.when(~strong, F.col("weak")).otherwise(0.0)).over(own)
    terms = stored(terms.withColumn("strong", strong).withColumn("rest", rest))
    reach = terms.filter("strong").groupBy("query_id").agg(F.max("rest").alias("rest"), F.max("floor").alias("floor"))
    able = scores(terms.filter("strong")).join(stored(reach), "query_id").filter(F.col("score") + F.col("rest") >= F.col("floor"))
    able = stored(able.select("query_id", "doc_id", "score", "rest"))
    # the k-th of these scores, which may still grow, is a better floor, and leaves few documents
    best = top_k(able, ["query_id"], [F.desc("score"), F.asc("doc_id")], k, "rank").filter(F.col("rank") == k)
    best = stored(best.select("query_id", F.col("score").alias("best")))
    near = F.col("score") + F.col("rest") * whole["copies"] >= F.coalesce(F.col("best") - _SLACK, F.lit(0.0))
    paired = stored(able.join(best, "query_id", "left").filter(near).select("query_id", "doc_id", "score"))
    asked = stored(paired.select("query_id", "doc_id").join(terms.filter("NOT strong").select("query_id", "word", "weight"), "query_id"))
    added = postings.drop("salt").join(_sent(asked), ["word", "doc_id"]).select("query_id", "doc_id", (F.col("weight") * F.col("part")).alias("score"))
    summed = paired.unionByName(added).groupBy("query_id", "doc_id").agg(F.round(F.sum("score"), 9).alias("score"))
    return top_k(summed.filter(F.col("score") > 0), ["query_id"], [F.desc("score"), F.asc("doc_id")], k, "rank")


def bm25_top_k(docs: DataFrame, queries: DataFrame, k: int, k1: float = 0.9, b: float = 0.4, text: str = "text", probe: int = PROBE) -> DataFrame:
    """``bm25_search`` over an index that is written first, as any index is."""
    index, totals = stored(inverted_index(docs, text)), stored(collection_totals(docs, text))
    return bm25_search(index, totals, queries, k, k1, b, text, probe)


def pooled(tokens: DataFrame, keys: Sequence[str], vector: str, mask: str | None = None, how: str = "mean") -> DataFrame:
    """One value per key and dimension ``pos``: masked mean over the token vectors, or the first token's vector.

    For "first", ``tokens`` has ``pos`` numbering the tokens from 1.
    """
    if how == "first":
        d = tokens.filter(F.col("pos") == 1).select(*keys, F.posexplode(vector).alias("dim", "value"))
        return d.withColumn("value", F.col("value").cast("double"))
    live = tokens if mask is None else tokens.filter(F.col(mask) != 0)
    d = live.select(*keys, F.posexplode(vector).alias("dim", "value"))
    return d.groupBy(*keys, "dim").agg(F.avg(F.col("value").cast("double")).alias("value"))


def vectors_of(pooled_values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pooled values back to one array per key: as long as the vector dimension."""
    rows = pooled_values.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("__v"))
    return rows.select(*keys, F.transform("__v", lambda x: x["value"]).alias("embedding"))


def fetch(hits: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents of the hits."""
    return hits.join(docs, key)


def title_of(contents: Column) -> Column:
    return F.substring_index(contents, "\n", 1)


def passages_text(hits: DataFrame, queries: DataFrame, contents: str = "contents") -> DataFrame:
    """``result`` per query: its passages as ``Doc i (Title: ..)`` blocks; a fixed text without any.

    ``hits``: ``query_id, rank`` and the contents, k per query.
    """
    c = F.col(contents)
    body = F.when(c.contains("\n"), F.substring(c, F.length(title_of(c)) + 2, F.length(c))).otherwise(F.lit(""))
    block = F.concat(F.lit("Doc "), F.col("rank").cast("string"), F.lit(" (Title: "), title_of(c), F.lit(")\n"), body, F.lit("\n\n"))
    rows = hits.select("query_id", "rank", block.alias("b"))
    lists = rows.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "b"))).alias("l"))  # k entries
    text = F.array_join(F.transform("l", lambda x: x["b"]), "")
    done = lists.select("query_id", F.regexp_replace(text, r"^\s+|\s+$", "").alias("result"))
    return queries.select("query_id").join(done, "query_id", "left").fillna({"result": "No search results found."})


def joined_results(results: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The results of several queries of one request, joined by a rule, on pages of a bounded size."""
    pages = packed(ranked(results, list(keys), [order], "__p"), keys, "__p", ["result"], "__r")
    return pages.select(*keys, "page", F.array_join(F.transform("__r", lambda x: x["result"]), "\n---\n").alias("result"))


def sorted_steps(dump: DataFrame) -> DataFrame:
    """Samples of each step by ``score``, else ``score_1``, else 0: ``place`` counts from the best."""
    names = [F.col(c) for c in ("score", "score_1") if c in dump.columns]
    d = dump.withColumn("sort_score", F.coalesce(*names, F.lit(0.0))).withColumn("__o", -F.col("sort_score"))
    return ranked(d, ["step"], ["__o", "sample_id"], "place").drop("__o")


def covariance(tokens: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Add ``cov`` = (advantage - mean) * (log-prob - mean) with the masked means of the batch; null outside the mask."""
    from tallyspan.operators.masked import masked, masked_average

    m, batch = F.col("mask"), list(batch)
    means = {"__a": masked_average(F.col("adv"), m), "__l": masked_average(F.col("old_logp"), m), "__valid": F.sum(m)}
    # a row per batch, stored: tokens are not shuffled to meet it
    stats = stored(tokens.groupBy(*batch).agg(*[c.alias(n) for n, c in means.items()]))
    d = attach_table(tokens, batch, stats, list(means))
    cov = masked((F.col("adv") - F.col("__a")) * (F.col("old_logp") - F.col("__l")), m)
    return d.withColumn("cov", cov).drop("__a", "__l")


#: Levels of the search for the last token chosen, and buckets of a level.
CUT_LEVELS, CUT_BUCKETS = 3, 4_096


def _place(number: Column, low: Column, high: Column) -> Column:
    """The bucket of a number between ends; a column of one value has one bucket."""
    share = (number / 2 - low / 2) / F.greatest(high / 2 - low / 2, F.lit(1e-300))
    return F.floor(F.least(share, F.lit(1.0)) * (CUT_BUCKETS - 1)).cast("long")


def _first_of_batch(
    d: DataFrame, batch: Sequence[str], number: Column, order: Sequence[str], many: Column, between: tuple[float, float] | None = None
) -> DataFrame:
    """Add ``selected`` to the tokens whose mask is known: is it among the first ``many`` of the batch inside the
    mask, by ``order``? ``number`` never falls where ``order`` rises, and lies ``between`` two known ends or any.

    Histograms, level by level, find the bucket that holds the last chosen token of a batch; only that bucket is
    kept, at last ranked, and every token compares itself with that last one.
    """
    batch, order = list(batch), list(order)
    # nulls come first, not-a-numbers last
    number = F.when(F.isnan(number), 8e307).otherwise(F.greatest(F.least(F.coalesce(number, F.lit(-8e307)), F.lit(8e307)), F.lit(-8e307)))
    live = d.filter(F.col("mask") != 0).select(*batch, *order, number.alias("__x"), many.cast("long").alias("__rest"))
    place = None
    for _ in range(CUT_LEVELS):
        if place is None and between:
            placed = live.withColumn("__b", _place(F.col("__x"), *map(F.lit, between)))
        else:
            ends = stored(live.groupBy(*batch).agg(F.min("__x").alias("__low"), F.max("__x").alias("__high")))
            placed = attach_table(live, batch, ends, ["__low", "__high"])
            placed = placed.withColumn("__b", _place(F.col("__x"), F.col("__low"), F.col("__high"))).drop("__low", "__high")
        place = placed.groupBy(*batch, "__b").agg(F.count(F.lit(1)).alias("__n"), F.first("__rest").alias("__left"))
        # at most CUT_BUCKETS rows of a batch
        up_to = F.sum("__n").over(Window.partitionBy(*batch).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0))
        place = place.withColumn("__to", up_to).filter(F.col("__to").between(F.col("__left"), F.col("__left") + F.col("__n") - 1))
        # a batch that has fewer tokens than are asked for has no such bucket, and all of them are chosen
        place = stored(place.select(*batch, F.col("__b").alias("__at"), (F.col("__left") - F.col("__to") + F.col("__n")).alias("__left")))
        inside = attach_table(placed, batch, place, ["__at", "__left"]).filter(F.col("__b") == F.col("__at"))
        live = edge = stored(inside.select(*batch, *order, "__x", F.col("__left").alias("__rest")))
    key = F.struct(*[F.col(c) for c in order])
    last = ranked(edge, batch, order, "__r").filter(F.col("__r") == F.col("__rest")).select(*batch, key.alias("__cut"), "__rest")
    last = stored(last)
    near = attach_table(edge.drop("__x", "__rest"), batch, last, ["__cut", "__rest"])
    at = near.groupBy(*batch).agg(F.count(F.when(key < F.col("__cut"), 1)).alias("__under"), F.count(F.when(key == F.col("__cut"), 1)).alias("__same"))
    cuts = stored(attach_table(last, batch, at, ["__under", "__same"]).withColumn("__room", F.col("__rest") - F.col("__under")))
    d = attach_table(d, batch, cuts, ["__cut", "__room", "__same"])
    masked_out, first = F.col("mask") == 0, F.coalesce(key <= F.col("__cut"), F.lit(True))
    known = d.filter(F.col("mask").isNotNull())
    if cuts.filter(F.col("__same") > F.col("__room")).isEmpty():
        found = known.withColumn("selected", ~masked_out & first)
    else:
        # tokens that are alike in all of the order share the last places
        tied = ~masked_out & F.coalesce((key == F.col("__cut")) & (F.col("__same") > F.col("__room")), F.lit(False))
        some = ranked(known.filter(tied), batch, order, "__r")
        some = some.withColumn("selected", F.col("__r") <= F.col("__room")).drop("__r")
        found = known.filter(~tied).withColumn("selected", ~masked_out & first).unionByName(some)
    return found.drop("__cut", "__room", "__same")


def top_covariance_tokens(tokens: DataFrame, batch: Sequence[str], ratio: float, tie: Sequence[str]) -> DataFrame:
    """Add ``selected`` for the tokens with the largest covariance: a share ``ratio`` of the valid ones, one at least."""
    d = covariance(tokens, batch).withColumn("__o", -F.col("cov"))
    many = F.greatest(F.floor(F.col("__valid") * ratio), F.lit(1))
    return _first_of_batch(d, batch, F.col("__o"), ["__o", *tie], many).drop("__o", "__valid")


def random_covariance_tokens(
    tokens: DataFrame, batch: Sequence[str], ratio: float, low: float, high: float, tie: Sequence[str], seed: int = 0
) -> DataFrame:
    """Add ``selected`` for random tokens with a covariance inside (low, high), as many as ``ratio`` of the valid ones."""
    from tallyspan.spread import hash_order

    d = covariance(tokens, batch)
    inside = (F.col("cov") > low) & (F.col("cov") < high)
    d = d.withColumn("__o", F.concat(F.when(inside, F.lit("0")).otherwise(F.lit("1")), hash_order(seed, *tie)))
    many = F.greatest(F.floor(F.col("__valid") * ratio), F.lit(1))
    # the mark and twelve digits of the hash, without the loss of a digit in a double
    number = F.conv(F.left("__o", F.lit(13)), 16, 10).cast("double")
    found = _first_of_batch(d, batch, number, ["__o", *tie], many, (0.0, 2.0 * 16**12))
    return found.withColumn("selected", F.col("selected") & F.coalesce(inside, F.lit(False))).drop("__o", "__valid")
