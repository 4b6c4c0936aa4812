"""URL filters, vector search and the pipeline."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tallyspan.llm import projected_search, url_templates
from tests.llm.test_documents import check_packing, kept_lines, library_ids, near_components

# URL filters


def judged(spark, urls, **extra):
    pages = spark.createDataFrame([(i, u, "old", "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string, html string")
    return url_templates.judge(pages)


def test_rules_and_parts(spark):
    cases = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://A.Example.NET/en/x?q=/de/": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/en/": ("example.net", "/en/", "example.net/en/", "allow"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
        "http://net": ("net", "", None, "allow"),
        "x://www.example.com/de/a#b": ("www.example.com", "/de/a", "example.com/de/", "block"),
        "http://a.org/fr/://b.net/": ("a.org", "/fr/://b.net/", "org/fr/", "allow"),
        "http://ÄÖ.ORG?/fr/": ("ÄÖ.org", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    got = judged(spark, list(cases)).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == list(cases.values())
    assert got[0].asDict().keys() == {"page_id", "url", "html", "host", "path", "rule", "verdict", "template", "purity"}
    assert judged(spark, []).count() == 0


def templates(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_templates.judge(pages, rules=rules).collect()
    assert sorted(r["page_id"] for r in got) == list(range(len(urls)))
    return {r["url"]: r for r in got}


def test_templates_generalise_merge_and_reject(spark):
    rules = (url_templates.Rule("block", "s.com", "/ads/"), url_templates.Rule("allow", "s.com", "/news/"))
    urls = [f"http://s.com/ads/{i}" for i in range(40)] + [f"http://s.com/news/{i}" for i in range(40)]
    urls += [f"http://s.com/blog/{i}" for i in range(40)] + [f"http://s.com/docs/{i}/a/b/c" for i in range(40)] + ["http://s.com/one-off"] * 2
    # a mirror whose first path segment has no slash behind it: no rule, but the template of the rejected branch
    urls += ["http://s.com/ads"] * 3
    got = templates(spark, urls, rules)
    # what differs only below a variable segment is told apart, as deep as there are pages
    assert got["http://s.com/docs/4/a/b/c"]["template"] == "/{blog+1}/*/a/b/c"
    assert got["http://s.com/blog/3"]["template"] == "/{blog+1}/*"
    assert got["http://s.com/ads/1"]["template"] == "/ads/*" and got["http://s.com/news/1"]["template"] == "/news/*"
    assert got["http://s.com/one-off"]["template"] == "/*" and got["http://s.com/one-off"]["verdict"] == "allow"
    assert got["http://s.com/ads/1"]["purity"] == 41 / 42 and got["http://s.com/news/1"]["purity"] == 1 / 42
    assert got["http://s.com/blog/3"]["verdict"] == "allow"


def test_branches_without_labels_are_not_judged_by_others(spark):
    """A host whose only labels are blocked pages: its other sections stay allowed."""
    rules = (url_templates.Rule("block", "s.com", "/de/"),)
    got = templates(spark, [f"http://s.com/{lang}/{lang}{i}" for lang in ("de", "en", "fr", "es") for i in range(25)], rules)
    assert {r["verdict"] for u, r in got.items() if "/de/" in u} == {"block"}
    assert {r["verdict"] for u, r in got.items() if "/de/" not in u} == {"allow"}
    assert got["http://s.com/en/en1"]["template"] == "/{en+2}/*"
    few = (*rules, url_templates.Rule("block", "s.com", "/en/1"), url_templates.Rule("block", "s.com", "/en/20"))
    got = templates(spark, [f"http://s.com/{lang}/{i}" for lang in ("de", "en", "fr") for i in (1, 20, 30, 40)], few)
    assert got["http://s.com/en/30"]["template"] == "/en/*" and got["http://s.com/en/30"]["verdict"] == "allow"


def test_even_sections_are_branches_however_many(spark):
    rules = tuple(url_templates.Rule("block" if k == 7 else "allow", "s.com", f"/s{k}/") for k in range(10))
    urls = [f"http://s.com/s{k}/p{k}-{i}" for k in range(30) for i in range(30)]
    got = templates(spark, urls, rules)
    assert {r["template"] for u, r in got.items() if "/s7/" in u} == {"/s7/*"}
    assert {r["template"] for u, r in got.items() if "/s3/" in u} == {"/{s0+8}/*"}
    assert {r["template"] for u, r in got.items() if "/s23/" in u} == {"/{s10+19}/*"}
    assert sum(r["verdict"] == "block" for r in got.values()) == 30


def test_thin_nodes_escapes_and_deep_paths(spark):
    rules = (url_templates.Rule("block", "s.com", "/deep/a/b/c/d/e/x/"),)
    urls = [f"http://s.com/{i // 2 if i < 60 else i}" for i in range(200)] + ["http://s.com/7"] * 2  # one id with four pages
    urls += [f"http://t.com/{name}/{i}" for name in ("*", "{a}", "%2A") for i in range(4)]
    urls += [f"http://s.com/deep/a/b/c/d/e/{kind}/{i}" for kind in "xy" for i in range(9)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["url"]: r for r in url_templates.judge(pages, rules=rules).collect()}
    assert got["http://s.com/7"]["template"] == "/*" and got["http://s.com/150"]["template"] == "/*"
    assert {got[f"http://t.com/{name}/1"]["template"] for name in ("*", "{a}", "%2A")} == {"/{%252A+2}/{0+3}"}
    assert got["http://s.com/deep/a/b/c/d/e/x/1"]["template"] == "/deep/a/b/c/d/e/x/*"
    assert got["http://s.com/deep/a/b/c/d/e/y/1"]["verdict"] == "allow" and got["http://s.com/deep/a/b/c/d/e/x/1"]["verdict"] == "block"
    # repeated rows have one result
    assert len({(r["template"], r["purity"]) for r in url_templates.judge(pages).filter("url = 'http://s.com/7'").collect()}) == 1


def test_few_pages_without_labels_are_blocked_on_the_table(spark):
    got = entry.queries()["op1_url_templates"](spark, "/root/testdata/sf0.01").filter("rule IS NULL AND (host = 'example.com' OR host LIKE '%.example.com')").collect()
    assert len(got) > 20 and sum(r["verdict"] == "block" for r in got) < 0.1 * len(got)


def test_a_template_of_blocked_pages_rejects_pages_without_rule(spark):
    rules = (url_templates.Rule("block", "s.com", "/x/1"),)
    pages = spark.createDataFrame([(i, f"http://s.com/x/{i}") for i in range(1000, 2000)] + [(0, "http://s.com/x/2")], "page_id long, url string")
    got = {r["page_id"]: r for r in url_templates.judge(pages, rules=rules).collect()}
    assert got[0]["rule"] is None and got[0]["template"] == "/x/*" and got[0]["verdict"] == "block"


# vector search


def brute_nearest(rows, queries, k):
    usable = {}
    for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[i] = min(usable.get(i, v), v)
    width = len(usable[min(usable)]) if usable else 0
    ids = [i for i in sorted(usable) if len(usable[i]) == width]
    m = np.array([usable[i] for i in ids], dtype=np.float32).astype(float).reshape(len(ids), -1)
    out = {}
    for q in queries:
        if q not in ids:
            continue
        v = m[ids.index(q)]
        score = (m * v).sum(axis=1) / (np.sqrt((m * m).sum(axis=1)) * math.sqrt(float((v * v).sum())))
        out[q] = sorted(((-s, i) for s, i in zip(score.tolist(), ids) if i != q))[:k]
    return out


def search(spark, rows, k=5):
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, point string")
    got = projected_search.nearest(table, table.filter(F.col("vec_id") % 50 == 0), k).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((-r["score"], r["vec_id"]))
    return out


def test_search_query_recall(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_nearest(rows, [i for i, _ in rows if i % 50 == 0], 5)
    found = {}
    for r in entry.queries()["op3_projected_search"](spark, sf).collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert found.keys() == want.keys()
    exact = {q: {i: -s for s, i in best} for q, best in want.items()}
    hits = sum(len(exact[q].keys() & found[q].keys()) for q in want)
    assert hits >= 0.9 * sum(map(len, exact.values()))
    assert all(abs(found[q][i] - s) < 1e-12 for q in want for i, s in exact[q].items() if i in found[q])


def test_search_of_large_and_tiny_doubles(spark):
    base = [[1.0, 1.0], [1.0, 0.5], [0.0, 1.0], [-1.0, 3.0]]
    powers = [1e200, 1e-200, 1e307, 5e-324, 1.0]
    rows = [(i + 1, [x * p for x in v]) for i, (v, p) in enumerate((v, p) for v in base for p in powers[:3] + powers[4:])]
    rows += [(50, [1e200, 1e200]), (100, [1e-200, 1e-200]), (60, [5e-324, 5e-324])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = projected_search.nearest(table, table.filter(F.col("vec_id") % 50 == 0), 20).collect()

    def cosine(u, v):
        u, v = ([x / max(map(abs, w)) for x in w] for w in (u, v))
        return sum(x * y for x, y in zip(u, v)) / math.sqrt(sum(x * x for x in u) * sum(y * y for y in v))

    for q in (50, 100):
        mine = {r["vec_id"]: r["score"] for r in got if r["query_id"] == q}
        assert len(mine) == len(rows) - 1
        assert mine == {i: pytest.approx(cosine(dict(rows)[q], v), abs=1e-12) for i, v in rows if i != q}


def test_scaling_does_not_change_a_bit_of_a_score():
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((50, 16)) * np.exp(rng.uniform(-20, 20, (50, 1)))
    plain = projected_search.cosines(vectors, np.sqrt((vectors * vectors).sum(axis=1)), vectors[0])
    cell = projected_search.Cell(vectors, [[i] for i in range(50)], np.zeros((16, 8)), 50, 1e9)
    assert {i: s for s, i in cell.search(vectors[0], 4.0)} == dict(enumerate(plain.tolist()))


def test_search_of_clusters_with_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(projected_search, "CELL", 64)
    monkeypatch.setattr(projected_search, "POINTS", 40)
    monkeypatch.setattr(projected_search, "QUERIES", 3)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 24))
    rows = [(i, (centres[i % 12] + 0.3 * rng.standard_normal(24)).tolist()) for i in range(1500)]
    want, got = brute_nearest(rows, range(0, 1500, 50), 5), search(spark, rows)
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_search_edge_rows(spark):
    one, other = [1.0, 0.0, 0.0], [0.0, 1.0, 1.0]
    rows = [(i, one) for i in range(0, 120)] + [(200, other), (201, [0.0, 2.0, 2.0]), (202, None), (203, []), (204, [0.0] * 3)]
    rows += [(250, [1.0, None, 0.0]), (300, [1.0, float("nan"), 0.0]), (350, [float("inf"), 0.0, 0.0]), (400, [1.0, 2.0]), (None, one), (200, other), (450, [3.0, 0.0, 0.0])]
    got = search(spark, rows)
    assert {q: [i for _, i in best] for q, best in got.items()} == {
        0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4], 200: [201, 0, 1, 2, 3], 450: [0, 1, 2, 3, 4],
    }
    assert search(spark, []) == {} and search(spark, [(0, one)]) == {}
    assert search(spark, [(0, one), (7, other)]) == {0: [(-0.0, 7)]}


def test_chi_square_quantile():
    assert abs(projected_search.chi_square_quantile(0.99, 8) - 20.0902) < 1e-3
    draws = (np.random.default_rng(2).standard_normal((200_000, 8)) ** 2).sum(axis=1)
    assert abs((draws <= projected_search.chi_square_quantile(0.9, 8)).mean() - 0.9) < 0.005


# queries against their SQL


@pytest.mark.parametrize("name", ["op1_url_templates", "op5_line_bloom"])
def test_queries_equal_their_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    want = con.execute(entry.oracle_sql()[name])
    columns = sorted(d[0] for d in want.description)
    names = [d[0] for d in want.description]
    want = Counter(tuple(dict(zip(names, r))[c] for c in columns) for r in want.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in entry.queries()[name](spark, sf).collect()) == want


# the pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept_text string, nth int, row string"


def pipeline_tables(spark, folder):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    texts, labels = {}, []
    for i in range(400):
        text = [rng.choice(words) for _ in range(60)]
        if i % 8 == 0:
            for k in (5, 20, 40):
                text[k] = rng.choice(["vilest", "rotter", "swine"])
        texts[i] = " ".join(text[:30]) + "\n" + " ".join(text[30:])
        labels.append((i, 1, int(i % 8 == 0)))
    texts |= {400: None, 401: "", 402: texts[1], 403: texts[2].replace("a", "a", 1) + " more", 404: "a shared line of text\n" + texts[3][::-1], 405: "a shared line of text\nx y z"}
    texts |= {406: 'password = "hunter2hunter2" for all', 407: "w " * 9000}
    rows = [(i, t, None, "s", -1, "a", "b", 1, "c") for i, t in texts.items()] + [(None, "no id\na shared line of text", None, None, None, "a", "b", 1, "c")]
    rows.append(rows[10])
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return texts


def test_pipeline_stage_by_stage(spark, tmp_path):
    pipeline_tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_duplicates", "secrets", "packing"]
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        path = f"{tmp_path}/out-{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = [r.asDict() for r in docs.collect()]
    # toxic documents go (some teach nothing, as they are held out), all others stay
    kept = Counter(r["doc_id"] for r in seen["toxicity"])
    toxic = {i for i in range(400) if i % 8 == 0}
    assert len(toxic - kept.keys()) >= 0.9 * len(toxic)
    assert Counter({i: n for i, n in kept.items() if i not in toxic}) == Counter([i for i in range(408) if i not in toxic] + [None, 10])
    # lines
    before = {r["doc_id"]: r["text"] for r in seen["toxicity"] if r["doc_id"] is not None}
    want = kept_lines(before)
    for r in seen["line_dedup"]:
        if r["doc_id"] is not None:
            assert (r["text"] or "") == want[r["doc_id"]][0]
            assert r["n_chars"] == (len(r["text"]) if want[r["doc_id"]][2] else -1)
    assert {r["doc_id"]: r["text"] for r in seen["line_dedup"]}[402] == "" and {r["doc_id"]: r["text"] for r in seen["line_dedup"]}[405] == "x y z"
    # near copies: the smallest id of each group
    cut = {r["doc_id"]: r["text"] for r in seen["line_dedup"] if r["doc_id"] is not None}
    stay = [i for i, (_, _, first) in near_components(cut, 5, 80).items() if first]
    assert sorted((r["doc_id"] for r in seen["near_duplicates"]), key=str) == sorted([*stay, None], key=str)
    # secrets
    text = {r["doc_id"]: r["text"] for r in seen["secrets"]}
    assert text[406] == '[assign]" for all' and text[400] is None
    assert {i: t for i, t in text.items() if i != 406} == {r["doc_id"]: r["text"] for r in seen["near_duplicates"] if r["doc_id"] != 406}
    # packing
    lengths = [(i, len(x) + 1) for i, x in zip(text, library_ids(text.values()))]
    check_packing(seen["packing"], lengths, 2048)
    ids = dict(zip(text, library_ids(text.values())))
    for r in seen["packing"]:
        part = [*ids[r["doc_id"]], 0][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    # run() is the stages one after the other
    whole = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert Counter(map(tuple, whole)) == Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in seen["packing"])


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
