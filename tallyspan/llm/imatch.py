"""Document fingerprints by I-Match, in column expressions only.

A text's terms are its runs of letters and digits in lower case, as md5 digests. Document frequencies
are counted over all texts in ``2**BUCKET_BITS`` hash buckets; buckets whose share of the documents lies
in the chosen band are the lexicon, a bit set of fixed size (128 KB) which every task gets.

The lexicon is thinned at random into a fixed set of subsets, the same for every text: the whole lexicon,
and for each of ``FAMILIES`` independent draws those that keep 7/8, 1/2, 1/4, 1/8 ... 1/1024 of it. In
each subset all terms that a text has are sorted and hashed; a subset without a term of the text has no
hash. The large subsets are I-Match's own, which agree for texts that hardly differ; the small ones still
agree when more has changed.

Likeness of two fingerprints: the subsets of a draw mostly lie in each other, so that a further one with
equal hashes stands for half the difference; with k equal and not empty ones a draw's likeness is
1 - 1 / 2**k, and the draws are averaged. Equal fingerprints are alike by 1, texts without a common term by 0.

Texts are shuffled once, by blocks of ids, where the next document is the next row; the last row of a
block takes the first document of the next block, one row a block, from a small table.

Defined results: a null text is an empty one; a text with fewer than ``MIN_TERMS`` lexicon terms uses
all its terms, one without terms is a term as a whole; of very long texts all terms count; rows without
id have no next document and stay unedited; rows that share an id follow one another by their texts'
checksums; a single document is its own next. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.values import bound
from tallyspan.llm.common import free_names
from tallyspan.spread import dense_index, df_col

BUCKET_BITS = 20
#: Band of document frequency: at least this share and two documents, at most that share.
LEAST_SHARE, MOST_SHARE = 3e-6, 0.05
FAMILIES, MIN_TERMS = 3, 4
#: Subsets of a family: what they keep, as bounds of three hexadecimal digits.
LARGE = [">= '200'", "< '800'", "< '400'"]
SMALL = [f"< '{4096 >> level:03x}'" for level in range(3, 11)]
#: Digits of a term: three for each family, then those of its bucket.
DIGITS = 3 * FAMILIES
#: First digits of the md5 digest of nothing.
NOTHING = "d41d8cd9"
#: Ids of a block, in which documents look for their next one.
ID_BLOCK = 1_024
#: Blocks of which the first documents' ids are broadcast (24 MB).
SENT_BLOCKS = 1_000_000
SPLIT = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Distinct terms of a text, as digests."""
    words = F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")
    return F.transform(F.array_distinct(words), lambda w: F.left(F.md5(w), F.lit(DIGITS + 5)))


def _bucket(term: Column) -> Column:
    return F.conv(F.right(term, F.lit(5)), 16, 10).cast("long")


def lexicon(texts: DataFrame) -> DataFrame:
    """One row ``lexicon``: the bit set of the buckets in the band, 64 bits a number, over ``texts(text)``."""
    spread = texts.select(F.explode(terms(F.col("text"))).alias("term")).select(_bucket(F.col("term")).alias("bucket"))
    counted = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    total = texts.agg(F.count(F.lit(1))).scalar()
    banded = counted.filter((F.col("n") >= F.greatest(F.lit(2), total * LEAST_SHARE)) & (F.col("n") <= F.greatest(F.lit(2), total * MOST_SHARE)))
    bit = F.expr("shiftleft(1L, cast(bucket & 63 as int))")
    words = banded.select(F.shiftright("bucket", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    # at most 2**(BUCKET_BITS - 6) rows, whatever the input; absent words are filled in
    every = texts.sparkSession.range(1 << (BUCKET_BITS - 6)).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    filled = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(listed, lambda x: x["bits"]).alias("lexicon"))


def _in_band(term: Column, band: Column) -> Column:
    def bit(bucket: Column) -> Column:
        word = F.get(band, F.shiftright(bucket, 6).cast("int"))
        return F.call_function("shiftright", word, bucket.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return bound(_bucket(term), bit)


def _hash(some: Column) -> Column:
    """Eight digits, or nothing for no term."""
    return F.replace(F.left(F.md5(F.array_join(some, "")), F.lit(8)), F.lit(NOTHING), F.lit(""))


def _kept(some: Column, family: int, rule: str) -> Column:
    compare, limit = rule.split(" ")
    limit = F.lit(limit.strip("'"))
    # the first digits decide how terms compare as a whole
    digits = lambda t: F.substring(t, 3 * family + 1, 3) if family else t
    return F.filter(some, (lambda t: digits(t) < limit) if compare == "<" else (lambda t: digits(t) >= limit))


def _subset_hashes(sorted_terms: Column) -> Column:
    def of_family(family: int) -> Column:
        large = F.array(*[_hash(_kept(sorted_terms, family, rule)) for rule in LARGE])
        # the small subsets lie in each other: they are cut from the largest of them
        small = lambda some: F.array(_hash(some), *[_hash(_kept(some, family, rule)) for rule in SMALL[1:]])
        return F.concat(large, bound(_kept(sorted_terms, family, SMALL[0]), small))

    return F.concat(F.array(_hash(sorted_terms)), *[of_family(f) for f in range(FAMILIES)])


def fingerprint(text: Column, band: Column) -> Column:
    """The hashes of all subsets, with dots between them."""

    def chosen(every: Column) -> Column:
        return bound(
            F.filter(every, lambda t: _in_band(t, band)),
            lambda some: F.when(F.size(some) >= MIN_TERMS, some).when(F.size(every) > 0, every).otherwise(F.array(F.left(F.md5(text), F.lit(DIGITS + 5)))),
        )

    return F.array_join(bound(F.sort_array(bound(terms(text), chosen)), _subset_hashes), ".")


def with_fingerprint(df: DataFrame, band: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of a text column; the lexicon, one row of fixed size, is broadcast."""
    key, bits = free_names(df, "lexicon_key", "lexicon")
    zero = F.least(F.length(df_col(text_col)), F.lit(0))  # an equal key for every row, so that this is a hash join
    joined = df.withColumn(key, zero).join(F.broadcast(band.select(F.lit(0).alias(key), F.col("lexicon").alias(bits))), key)
    return joined.select(*[df_col(c) for c in df.columns], fingerprint(df_col(text_col), F.col(bits)).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """How far the families agree: with k equal subsets that are not empty, a family's distance is 1 / 2**k."""
    alike = F.zip_with(F.split(a, r"\."), F.split(b, r"\."), lambda x, y: (x == y) & (x != ""))
    size = len(LARGE + SMALL)

    def agreed(alike: Column) -> Column:
        equal = [F.size(F.filter(F.slice(alike, 2 + size * f, size), lambda x: x)) for f in range(FAMILIES)]
        return sum(1.0 - F.pow(F.lit(0.5), k) for k in equal) / FAMILIES

    return F.when(a == b, 1.0).otherwise(bound(alike, agreed))


def _first_of_next(named: DataFrame) -> DataFrame:
    """``block, text``: the text of the first document of the next block that has any, for each block."""
    firsts = named.select("block", "doc_id", "key").groupBy("block").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    firsts = dense_index(firsts.select("block", "first.doc_id", "first.key"), ["block"], "at")
    many = firsts.count()
    before = firsts.select(F.col("doc_id").alias("next_id"), F.col("key").alias("next_key"), F.pmod(F.col("at") - 1, F.lit(max(many, 1))).alias("at"))
    edge = firsts.select("block", "at").join(before, "at").drop("at")
    # one row of three numbers for each block with documents: sent to all tasks up to a number, else joined
    edge = F.broadcast(edge) if many <= SENT_BLOCKS else edge
    same = (F.col("doc_id") == F.col("next_id")) & (F.col("key") == F.col("next_key"))
    found = named.select("doc_id", "key", "text").join(edge, same)
    return found.groupBy("block").agg(F.any_value("text").alias("text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_chars, fingerprint, edited, edited_fingerprint, near_edited, near_next``:
    every text, and the text whose last quarter is replaced by the beginning of the next document."""
    texts = docs.select(df_col(id_col).cast("long").alias("doc_id"), F.coalesce(df_col(text_col), F.lit("")).alias("text"))
    band = lexicon(texts.select("text"))
    named = texts.filter(F.col("doc_id").isNotNull())
    named = named.withColumn("key", F.xxhash64("text")).withColumn("block", F.floor(F.col("doc_id") / ID_BLOCK))
    edge = _first_of_next(named).withColumnRenamed("text", "next_text")
    edge = with_fingerprint(edge, band, "next_text", "next_fingerprint")
    edge = edge.select("block", F.struct(F.col("next_text").alias("text"), F.col("next_fingerprint").alias("fingerprint")).alias("first"))
    # texts meet by block before they are fingerprinted, and stay where they are for the window
    marked = with_fingerprint(named.repartition("block").sortWithinPartitions("block", "doc_id", "key"), band, "text", "fingerprint")
    follow = F.lead(F.struct("text", "fingerprint")).over(Window.partitionBy("block").orderBy("doc_id", "key"))
    seen = marked.withColumn("next", follow).join(edge, "block", "left")
    seen = seen.select("doc_id", "text", "fingerprint", F.coalesce("next", "first").alias("next"))
    alone = with_fingerprint(texts.filter(F.col("doc_id").isNull()), band, "text", "fingerprint")
    both = seen.unionByName(alone.withColumn("next", F.lit(None).cast(dict(seen.dtypes)["next"])))
    both = both.withColumn("n_chars", F.length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - quarter), F.left(F.col("next.text"), quarter))
    both = both.select("doc_id", "text", "n_chars", "fingerprint", F.coalesce(edited, F.col("text")).alias("edited"), F.col("next.fingerprint").alias("next"))
    both = with_fingerprint(both, band, "edited", "edited_fingerprint")
    return both.select(
        "doc_id",
        "text",
        "n_chars",
        "fingerprint",
        "edited",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        F.coalesce(likeness(F.col("fingerprint"), F.col("next")), F.lit(0.0)).alias("near_next"),
    )


def oracle() -> str:
    """The digest columns over ``documents`` in DuckDB's SQL."""

    def hashed(some: str) -> str:
        return f"replace(left(md5(array_to_string({some}, '')), 8), '{NOTHING}', '')"

    rules = [(f, rule) for f in range(FAMILIES) for rule in LARGE + SMALL]
    hashes = [hashed("ts")] + [hashed(f"list_filter(ts, lambda t: substr(t, {3 * f + 1}, 3) {rule})") for f, rule in rules]
    size = len(LARGE + SMALL)

    def share(a: str, b: str) -> str:
        pairs = f"list_zip(string_split({a}, '.'), string_split({b}, '.'))"
        equal = [f"len(list_filter(list_slice({pairs}, {2 + size * f}, {1 + size * (f + 1)}), lambda p: p[1] = p[2] AND p[1] <> ''))" for f in range(FAMILIES)]
        return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE ({' + '.join(f'1.0::DOUBLE - power(0.5::DOUBLE, {k})' for k in equal)}) / {FAMILIES} END"

    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
 n AS (SELECT doc_id, text, length(text) AS n_chars, coalesce(lead(text) OVER w, first_value(text) OVER w) AS nt FROM d WINDOW w AS (ORDER BY doc_id)),
 x AS (SELECT doc_id, 'own' AS kind, text AS body FROM n UNION ALL
  SELECT doc_id, 'edited', left(text, n_chars - n_chars // 4) || left(nt, n_chars // 4) FROM n),
 w AS (SELECT doc_id, kind, body, list_transform(list_distinct(list_filter(regexp_split_to_array(lower(body), '{SPLIT}'), lambda v: v <> '')),
  lambda v: left(md5(v), {DIGITS + 5})) AS every FROM x),
 b AS (SELECT bucket FROM (SELECT right(t, 5) AS bucket, count(*) AS n FROM (SELECT unnest(every) AS t FROM w WHERE kind = 'own') GROUP BY 1),
  (SELECT count(*) AS total FROM d) WHERE n >= greatest(2, total * {LEAST_SHARE}::DOUBLE) AND n <= greatest(2, total * {MOST_SHARE}::DOUBLE)),
 u AS (SELECT doc_id, kind, unnest(every) AS t FROM w),
 s AS (SELECT doc_id, kind, list(t) AS inside FROM u WHERE right(t, 5) IN (SELECT bucket FROM b) GROUP BY ALL),
 c AS (SELECT w.doc_id, w.kind, w.body, list_sort(CASE WHEN len(coalesce(inside, [])) >= {MIN_TERMS} THEN inside WHEN len(every) > 0 THEN every
  ELSE [left(md5(body), {DIGITS + 5})] END) AS ts FROM w LEFT JOIN s USING (doc_id, kind)),
 f AS (SELECT doc_id, kind, body, array_to_string([{", ".join(hashes)}], '.') AS fp FROM c),
 g AS (SELECT o.doc_id, o.fp AS fingerprint, e.fp AS edited_fingerprint, sha256(e.body) AS edited_sha256, length(o.body) AS n_chars
  FROM f o JOIN f e USING (doc_id) WHERE o.kind = 'own' AND e.kind = 'edited'),
 h AS (SELECT *, coalesce(lead(fingerprint) OVER w, first_value(fingerprint) OVER w) AS nf FROM g WINDOW w AS (ORDER BY doc_id))
 SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, {share("fingerprint", "edited_fingerprint")} AS near_edited, {share("fingerprint", "nf")} AS near_next FROM h"""
