"""The registered queries of the corpus operators: thin selections over each operator's own output."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm import (
    block_mixing,
    bpe_queue,
    ftrl,
    hyperminhash,
    imatch,
    line_bloom,
    periodic_runs,
    projected_search,
    secrets_scan,
    separator_scan,
    spelling_groups,
    swap_packing,
    url_templates,
)
from tallyspan.plans import register


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


WORDS = public_tokenizers.path("word_bpe_49k.json")
#: <|endoftext|> of that vocabulary.
WORDS_END = 49_407


# CRC-32 in SQL: the table of its 256 steps, and the checksum of a text's bytes by that table
CRC_TABLE = """tab AS (SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
    ORDER BY i) AS steps FROM range(256) r(i))"""


def crc_sql(text: str) -> str:
    code = f"hex({text})"
    read = f"list_transform(range(1, length({code}) // 2 + 1), lambda i: ('0x' || substr({code}, 2 * i - 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {read}), lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295)"


@register("op1_url_templates", url_templates.oracle())
def op1_url_templates(spark: SparkSession, sf: str) -> DataFrame:
    out = url_templates.judge(_read(spark, sf, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@register("op2_imatch", imatch.oracle())
def op2_imatch(spark: SparkSession, sf: str) -> DataFrame:
    out = imatch.edited_fingerprints(_read(spark, sf, "documents"))
    digest = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    return out.select("doc_id", "n_chars", digest, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@register("op3_projected_search")
def op3_projected_search(spark: SparkSession, sf: str) -> DataFrame:
    rows = _read(spark, sf, "embeddings")
    out = projected_search.nearest(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)
    return out.select("query_id", "rank", "vec_id", "score")


@register("op4_separator_scan")
def op4_separator_scan(spark: SparkSession, sf: str) -> DataFrame:
    return separator_scan.token_counts(_read(spark, sf, "documents"), WORDS, WORDS_END).select("doc_id", "n_tokens")


@register(
    "op5_line_bloom",
    r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
n AS (SELECT doc_id, parts, generate_subscripts(parts, 1) AS i FROM d),
l AS (
    SELECT doc_id, i, parts[i] AS line,
        translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM n
),
f AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key),
k AS (SELECT l.doc_id, l.i, l.line, f.first IS NULL OR l.doc_id = f.first AS stays FROM l LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM k GROUP BY doc_id
""",
)
def op5_line_bloom(spark: SparkSession, sf: str) -> DataFrame:
    out = line_bloom.dedup_lines(_read(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register("op6_ftrl")
def op6_ftrl(spark: SparkSession, sf: str) -> DataFrame:
    out = ftrl.toxicity(_read(spark, sf, "documents"), _read(spark, sf, "labels"))
    return out.select("doc_id", ftrl.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op7_swap_packing")
def op7_swap_packing(spark: SparkSession, sf: str) -> DataFrame:
    parts = swap_packing.pieces(_read(spark, sf, "documents"), WORDS)
    return swap_packing.pack(parts.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@register(
    "op8_hyperminhash",
    r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS shingles FROM d
), u AS (SELECT doc_id, unnest(shingles) AS x FROM s),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n o ON o.doc_id = a JOIN n t ON t.doc_id = b WHERE 100 * c >= 85 * (o.n + t.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.id, e.b FROM r JOIN e ON r.other = e.a)
SELECT id AS doc_id, any_value(n)::BIGINT AS n_shingles, min(other) AS component_id, id = min(other) AS kept FROM r JOIN n ON n.doc_id = id GROUP BY id
""",
)
def op8_hyperminhash(spark: SparkSession, sf: str) -> DataFrame:
    out = hyperminhash.near_duplicates(_read(spark, sf, "documents"), shingle=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def spans_sql(kind: str, order: int, pattern: str, keep: str) -> str:
    """The spans of one kind of secret: matches, placed by the lengths of what lies between them."""
    pattern = pattern.replace("'", "''")
    return f"""{kind}_l AS (
    SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM d WHERE regexp_matches(t, '{pattern}')
), {kind}_m AS (
    SELECT doc_id, unnest(ms) AS m, unnest(range(len(ms))) AS i, unnest(list_transform(gaps[:len(ms)], lambda g: length(g))) AS before,
        unnest(list_transform(gaps[2:len(ms) + 1], lambda g: left(g, 1))) AS after FROM {kind}_l
), {kind}_p AS (
    SELECT doc_id, m, after, sum(before + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS start FROM {kind}_m
), {kind} AS (SELECT doc_id, '{kind}' AS kind, {order} AS o, start, start + length(m) AS stop FROM {kind}_p, tab WHERE {keep})"""


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
CHECKED = "length(m) = {n} AND NOT regexp_matches(after, '[0-9A-Za-z]') AND " + crc_sql("substr(m, {at}, 30)") + (
    " = list_reduce(list_prepend(0::BIGINT, list_transform(range(30, 36), lambda j: instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', substr(m, {at} + j, 1)) - 1)),"
    " lambda a, b: a * 62 + b)"
)
LUHN = """length(m) = 16 AND substr(m, 1, 1) IN ('3', '4', '5', '6') AND list_sum(list_transform(range(16), lambda j:
    CASE WHEN j % 2 = 0 THEN substr(m, 16 - j, 1)::INT ELSE 2 * substr(m, 16 - j, 1)::INT - CASE WHEN substr(m, 16 - j, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""


@register(
    "op9_secrets_scan",
    f"""
WITH {CRC_TABLE}, d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{spans_sql("assign", 0, ASSIGN, f"length(regexp_extract(m, '{ASSIGN.replace(chr(39), chr(39) * 2)}', 1)) >= 6")},
{spans_sql("access", 1, "AKIA[A-Z0-9]{16,}", "true")},
{spans_sql("hex", 2, "[0-9a-f]{24,}", "true")},
{spans_sql("github", 3, "gh[pousr]_[0-9A-Za-z]{36}", CHECKED.format(n=40, at=5))},
{spans_sql("npm", 4, "npm_[0-9A-Za-z]{36}", CHECKED.format(n=40, at=5))},
{spans_sql("card", 5, "[0-9]{16,}", LUHN)},
s AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex UNION ALL SELECT * FROM github UNION ALL SELECT * FROM npm UNION ALL SELECT * FROM card),
w AS (SELECT doc_id, o, start, kind || ':' || start::BIGINT || ':' || stop::BIGINT AS span FROM s)
SELECT d.doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
    sha256(coalesce(string_agg(span, ',' ORDER BY start, o) FILTER (o < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, o), '') AS spans
FROM d LEFT JOIN w ON w.doc_id = d.doc_id GROUP BY d.doc_id
""",
)
def op9_secrets_scan(spark: SparkSession, sf: str) -> DataFrame:
    out = secrets_scan.scan_secrets(_read(spark, sf, "documents"))
    base = secrets_scan.of_kinds(F.col("spans"), "assign", "access", "hex")
    counts = [F.size(secrets_scan.of_kinds(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    digest = F.sha2(secrets_scan.rendered(base).cast("binary"), 256).alias("base_sha256")
    return out.select("doc_id", *counts, digest, secrets_scan.rendered(F.col("spans")).alias("spans"))


@register("op10_bpe_queue")
def op10_bpe_queue(spark: SparkSession, sf: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe_queue.encode(_read(spark, sf, "documents"), ranks, pattern, columns=["doc_id"])
    out = bpe_queue.decode(coded, ranks)
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op11_block_mixing")
def op11_block_mixing(spark: SparkSession, sf: str) -> DataFrame:
    out = block_mixing.taken_words(block_mixing.mix(_read(spark, sf, "documents")))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def _with_planted_period(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in every tenth document, by hash, the words from a on repeat the p words there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\x09-\\x0D]+"), lambda w: w != "")
    planted = F.when(h % 10 == 0, words)
    rows = docs.select("doc_id", "text", planted.alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    a = F.when(n > 0, F.col("g") % n).cast("int")
    rows = rows.select("*", n.alias("n"), a.alias("a"))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.withColumn("p", p)
    # a slice's length stays within the list
    period = F.slice("words", F.col("a") + 1, F.least(F.col("p"), F.col("n") - F.col("a")))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), F.col("n") - F.col("a"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@register(
    "op12_periodic_runs",
    rf"""
WITH {CRC_TABLE}, d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {crc_sql("doc_id::VARCHAR")} AS h FROM documents, tab
), a AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) ELSE w END AS w FROM a
), u AS (SELECT doc_id, n, unnest(w) AS x, unnest(range(n)) AS i FROM p),
-- words that equal the one q words before them; stretches of such words, q more words long, are runs
e AS (SELECT r.doc_id, r.i, r.i - l.i AS q FROM u r JOIN u l ON r.doc_id = l.doc_id AND r.x = l.x AND l.i < r.i AND 4 * (r.i - l.i) <= r.n),
g AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM e),
s AS (SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY 1, 2, 3),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS nth FROM r),
t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS written FROM r GROUP BY 1),
o AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT u.doc_id, string_agg(x, ' ' ORDER BY u.i) AS collapsed FROM u LEFT JOIN o ON o.doc_id = u.doc_id AND o.i = u.i WHERE o.i IS NULL GROUP BY 1)
SELECT p.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.period::BIGINT AS period,
    (1000 * b.length // b.period)::BIGINT AS exponent_milli, sha256(coalesce(written, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM p LEFT JOIN t USING (doc_id) LEFT JOIN (SELECT * FROM b WHERE nth = 1) b USING (doc_id) LEFT JOIN c USING (doc_id)
""",
)
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    out = periodic_runs.periodic_runs(_with_planted_period(_read(spark, sf, "documents")))
    long_first = lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    best = F.array_min(F.transform("runs", long_first))
    written = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = out.withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.less") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(written, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _one_code_point_less(doc_id: int | None, words: list[str]) -> list[str]:
    """Each word as it counts in a document: 1 in 97, by hash, loses a code point."""
    out, before = [], zlib.crc32(f"{doc_id}:".encode())
    for word in words:
        h = zlib.crc32(word.encode(), before)
        if h % 97 == 0 and doc_id is not None:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out.append(word)
    return out


@register(
    "op13_spelling_groups",
    f"""
WITH RECURSIVE {CRC_TABLE}, f AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2
), h AS (SELECT w, n, {crc_sql("doc_id || ':' || w")} AS h FROM f, tab),
m AS (SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM m GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
-- what is left of a word without its i-th code point
x AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (
    SELECT a.word, b.word AS near FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.rest
    UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.rest
), k AS (SELECT e.word, e.near, v.n AS near_n, row_number() OVER (PARTITION BY e.word ORDER BY v.n DESC, e.near) AS nth, count(*) OVER (PARTITION BY e.word) AS n_near FROM e JOIN v ON v.word = e.near),
w AS (
    SELECT v.word, v.n, coalesce(k.n_near, 0)::BIGINT AS n_near, CASE WHEN k.near_n >= 2 * v.n THEN k.near END AS form, CASE WHEN k.near_n >= 2 * v.n THEN k.near_n END AS form_n
    FROM v LEFT JOIN k ON k.word = v.word AND k.nth = 1
), t(word, goal) AS (SELECT word, form FROM w WHERE form IS NOT NULL UNION ALL SELECT t.word, w.form FROM t JOIN w ON w.word = t.goal WHERE w.form IS NOT NULL),
-- counts double from form to form: the last one is the most frequent
z AS (SELECT t.word, arg_max(t.goal, w.n) AS root FROM t JOIN w ON w.word = t.goal GROUP BY 1)
SELECT w.word, w.form, coalesce(z.root, w.word) AS root, w.n, w.n_near, w.form_n FROM w LEFT JOIN z ON z.word = w.word
""",
)
def op13_spelling_groups(spark: SparkSession, sf: str) -> DataFrame:
    counts = spelling_groups.word_counts(_read(spark, sf, "documents"), alter=_one_code_point_less)
    return spelling_groups.spelling_groups(counts).select("word", "form", "root", "n", "n_near", "form_n")
