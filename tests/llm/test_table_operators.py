"""Sharding, vector search and the URL filter against brute force; the pipeline."""

import math
import os
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from coppice.llm import histsort, normsearch, templates
from coppice.llm.queries import QUERIES, URL_RULES
from coppice.llm.sql import path_templates_sql
from coppice.llm.tables import Stored, stored_until_here, table
from tests.conftest import DATA
from tests.llm.conftest import AWKWARD

# sharding


def placed(df, size="size", n_shards=4, **options):
    return histsort.histogram_sort(df, F.col(size), F.col("k"), F.col("i"), n_shards, **options).collect()


@pytest.mark.parametrize("least_ranges", [1, 8])
def test_shards_hold_equal_bytes(spark, least_ranges):
    rows = [(i, i % 3 * (i % 50), 5 if i % 3 else i) for i in range(3000)] + [(1, 7, None)] * 900 + [(None, None, 4)] * 100
    got = placed(spark.createDataFrame(rows, "i long, size long, k long"), least_ranges=least_ranges)
    assert Counter((r.i, r.size, r.k) for r in got) == Counter(rows)
    total, by_shard = sum(r.size or 0 for r in got), defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    for some in by_shard.values():
        assert sorted(r.slot for r in some) == list(range(len(some)))
        assert abs(sum(r.size or 0 for r in some) - total / 4) <= 0.004 * total / 4 + 2 * 98
    # The order: shards one after the other hold ascending keys, so equal keys are together.
    keys = [r.k for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert sum(a != b for a, b in zip(keys, keys[1:], strict=False)) == len(set(keys)) - 1


def test_shards_of_awkward_rows(awkward, nothing, spark):
    got = histsort.histogram_sort(awkward, F.octet_length("text"), F.col("text"), F.col("doc_id"), 3)
    assert got.columns == [*awkward.columns, "_shard", "_slot"] and got.count() == len(AWKWARD)
    assert histsort.histogram_sort(nothing, F.octet_length("text"), F.col("text"), F.col("doc_id"), 3).count() == 0
    one = spark.createDataFrame([(1, 5, 1)], "i long, size long, k long")
    assert [(r.shard, r.slot) for r in placed(one)] == [(0, 0)]
    none = spark.createDataFrame([(i, 0, i) for i in range(50)], "i long, size long, k long")
    assert len(placed(none)) == 50


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, 10, i) for i in range(400)], "i long, size long, k long")
    histsort.write_shards(histsort.histogram_sort(df, F.col("size"), F.col("k"), F.col("i"), 4), str(tmp_path / "out"))
    assert Counter(r.shard for r in spark.read.parquet(str(tmp_path / "out")).collect()) == Counter({s: 100 for s in range(4)})


def test_histogram_sort_query_is_even(spark):
    rows = QUERIES["op10_histogram_sort"](spark, DATA).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert set(sizes) <= set(range(40)) and len(rows) == table(spark, DATA, "documents").count()
    assert max(sizes.values()) - sum(sizes.values()) / 40 <= max(r.size for r in rows)
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)


# vectors


def best(rows, k):
    """rows: (id, integer vector); those of no vector or id take no part."""
    rows = [(i, v) for i, v in rows if v is not None and i is not None]
    out = []
    for n, (i, q) in enumerate(rows):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, x, strict=True)), j) for m, (j, x) in enumerate(rows) if m != n and len(x) == len(q))
            out.extend((i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k]))
    return sorted(out)


def integers(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * x) for x in vector]


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_search_against_brute_force(spark, monkeypatch, scale):
    for name, value in (("BLOCK", 40), ("QUERY_BLOCK", 3), ("SEEDS", 7)):
        monkeypatch.setattr(normsearch, name, value)
    rows = []
    for i in range(400):
        v = [math.sin(i * (j + 1)) * (1 + i % 7) * (scale if j == 0 and i % 2 else 1) for j in range(6)]
        rows.append((i, v))
    rows += [(50, [1.0] * 6)] * 2 + [(100, [0.0] * 6), (401, None), (402, [None] * 6), (403, [float("nan")] * 6)]
    rows += [(404, [float("inf")] * 6), (None, [1.0] * 6), (450, [2.0, 1.0]), (451, [1.0, 1.0]), (500, []), (550, [3.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = normsearch.top_k_products(df, "vec_id", normsearch.integer_vectors(F.col("embedding")), F.col("vec_id") % 50 == 0)
    limit = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    expected = [(q, r, j, limit(s)) for q, r, j, s in best([(i, integers(v)) for i, v in rows], 5)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == expected
    assert normsearch.top_k_products(df.filter("false"), "vec_id", F.col("embedding"), F.lit(True)).count() == 0


# URLs


def test_rules():
    cases = {
        "https://a.example.com/en/x": ("example.com/en/", "block"),
        "https://WWW.example.com/en/x?q#f": ("www.example.com/en/", "allow"),
        "https://x.www.example.com/en/": ("www.example.com/en/", "allow"),
        "https://example.com/enx": ("com/", "allow"),
        "https://notexample.com": (None, None),
        "http://b.net/es/1": ("net/es/", "block"),
        "http://b.net/en/1": (None, None),
        "http://com/": ("com/", "allow"),
        "http://xcom/": (None, None),
    }
    for url, (rule, verdict) in cases.items():
        rest = url.split("://")[1].split("?")[0]
        host, slash, path = rest.partition("/")
        host, path = host.lower(), slash + path
        fitting = [r for r in URL_RULES if (host == r[1].split("/")[0] or host.endswith("." + r[1].split("/")[0])) and path.startswith(r[1][r[1].index("/") :])]
        longest = max(fitting, key=lambda r: len(r[1]), default=(None, None))
        assert (longest[1], longest[0]) == (rule, verdict)


URLS = [None, "", "no scheme", "http://", "HTTP://A.Com?x", "http://A.b.COM/En/x y?z", "https://h.net/fr/1#a://b", "ftp://h.org/a//b/", "://x/y", "http://www.example.com/en/p"]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(None, "http://q.org/1", "h")], "page_id long, url string, host string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (77, 1)], "doc_id long, quality int")
    rows = {r.page_id: r for r in templates.judge_urls(pages, labels, URL_RULES).collect()}
    assert len(rows) == len(URLS) + 1
    parts = [(rows[i].host, rows[i].path) for i in range(len(URLS))]
    assert parts == [("", ""), ("", ""), ("", ""), ("", ""), ("a.com", ""), ("a.b.com", "/En/x y"), ("h.net", "/fr/1"), ("h.org", "/a//b/"), ("x", "/y"), ("www.example.com", "/en/p")]
    assert [rows[i].rule for i in range(len(URLS))] == [None] * 5 + ["com/", "net/fr/", None, None, "www.example.com/en/"]
    assert rows[6].verdict == "block" and rows[9].verdict == "allow" and rows[4].verdict in ("allow", "block")
    assert templates.judge_urls(pages.filter("false"), labels, URL_RULES).count() == 0
    assert templates.judge_urls(pages, labels.filter("false"), URL_RULES).filter("purity = 1").count() == len(URLS) + 1


def test_templates_generalise_merge_and_reject(spark):
    urls = [(i, f"http://s.org/{('good', 'fine', 'spam')[i % 3]}/{i}.html") for i in range(900)]
    urls += [(1000 + i, "http://s.org/" + "/".join("abcdefghijkl")) for i in range(40)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 3 != 2)) for i in range(900)], "doc_id long, quality int")
    rows = templates.judge_urls(pages, labels, []).collect()
    assert {r.template for r in rows} == {"/good/*", "/fine/*", "/spam/*", "/a/b/c/d/e/f/g/h/**"}
    verdicts = defaultdict(set)
    branches = defaultdict(set)
    for r in rows:
        verdicts[r.template].add(r.verdict)
        branches[r.template].add(r.branch)
    assert verdicts["/spam/*"] == {"block"} and verdicts["/good/*"] == verdicts["/fine/*"] == {"allow"}
    assert branches["/good/*"] == branches["/fine/*"] != branches["/spam/*"]


def test_templates_of_many_sections_and_deep_paths(spark):
    """A section is judged by its own labels, however small its share and deep its place."""
    urls = [(i, f"http://s.org/section{i % 80}/{i}.html") for i in range(3200)]
    deep = "/".join("abcdefghijk")
    urls += [(10000 + i, f"http://d.org/{deep}/{('good', 'spam')[i % 2]}/{i}") for i in range(80)]
    # A rare path has no rounds of its own.
    urls += [(20000, "http://d.org/" + "/".join(str(i) for i in range(300)))]
    bad = {i for i, u in urls if "/section7/" in u or "/spam/" in u}
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i not in bad)) for i, _ in urls if i != 20000], "doc_id long, quality int")
    rows = templates.judge_urls(pages, labels, []).collect()
    assert {r.page_id for r in rows if r.verdict == "block"} == bad and len(rows) == len(urls)
    assert len({r.branch for r in rows if r.host == "s.org"}) == 2


def test_templates_equal_sql_on_many_sections_and_levels(spark):
    rng = np.random.default_rng(9)
    urls = [f"http://s.org/section{i % 80}/{i}.html" for i in range(1600)]
    for i in range(900):
        parts = rng.choice(["a", "b", "c", "d"], rng.integers(0, 8), p=[0.6, 0.25, 0.1, 0.05]).tolist()
        urls.append(f"https://h{i % 3}.net/" + "/".join([*parts, str(i)] if i % 4 else parts))
    urls += [f"http://few{i // 3}.org/x/{i}/" + "y/" * 20 for i in range(9)] + [None, "no host"]
    pages = pd.DataFrame({"page_id": range(len(urls)), "url": urls})
    bad = [("section7/" in (u or "") or "/b/a" in (u or "")) != (rng.random() < 0.1) for u in urls]
    labels = pd.DataFrame({"doc_id": range(len(urls)), "quality": [1 - int(b) for b in bad]})[: len(urls) - 300]
    with duckdb.connect() as db:
        db.register("pages", pages)
        db.register("labels", labels)
        query = path_templates_sql(URL_RULES, depth=10, least_pages=5, apart=1.96, weight=20.0, least_purity=0.8)
        expected = db.sql(f"SELECT page_id, rule, verdict FROM ({query}) ORDER BY page_id").fetchall()
    made = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    known = spark.createDataFrame([(int(d), int(q)) for d, q in labels.values.tolist()], "doc_id long, quality int")
    rows = templates.judge_urls(made, known, URL_RULES).select("page_id", "rule", "verdict").orderBy("page_id").collect()
    assert [tuple(r) for r in rows] == expected
    assert len({v for _, r, v in expected if r is None}) == 2


# pipeline


def test_pipeline_stages_on_awkward_rows(awkward, nothing, spark):
    for rows in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, DATA)
            assert out.columns == rows.columns and out.dtypes == rows.dtypes
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, DATA).count() == rows.count()


def test_pipeline_keeps_clean_documents(spark):
    docs = table(spark, DATA, "documents")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, DATA).select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, DATA, "labels").collect()}
    scored = {r.doc_id: r.predicted for r in QUERIES["op8_additive_quality"](spark, DATA).collect()}
    passed = docs.filter(F.col("doc_id").isin([d for d, p in scored.items() if p]))
    from coppice.llm.minhash import near_duplicates

    first = {r.doc_id for r in near_duplicates(passed, percent=corpus_pipeline.NEAR_PERCENT).filter("kept").collect()}
    assert kept <= first
    from coppice.llm.chunks import dedup_chunks
    from coppice.llm.decontaminate import find_leaks

    cut = dedup_chunks(docs.filter(F.col("doc_id").isin(list(first))))
    leaks = {r.doc_id for r in find_leaks(cut, table(spark, DATA, "benchmark")).collect()}
    assert kept == first - leaks
    held = [d for d in labels if labels[d] == 1 and d in first and d not in leaks]
    assert set(held) <= kept


def test_stored_tables_of_a_block_are_deleted(spark):
    def there(stored):
        return os.path.isdir(stored.path)

    rows = spark.range(3)
    with stored_until_here():
        a, b = Stored(rows, "a"), Stored(rows, "b").keep()
        with stored_until_here():
            c, d = Stored(rows, "c"), Stored(rows, "d").keep()
        assert there(a) and there(b) and there(d) and not there(c)
    assert there(b) and not there(a) and not there(d)
    with pytest.raises(ZeroDivisionError), stored_until_here():
        e = Stored(rows, "e")
        1 / 0  # noqa: B018
    assert not there(e) and there(Stored(rows, "f"))


def test_pipeline_leaves_the_input_of_its_last_stage(spark):
    folder = os.path.dirname(Stored(spark.range(1), "place").path)
    before = set(os.listdir(folder))
    rows = corpus_pipeline.run(spark, DATA)
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and left.pop().startswith("pipeline-decontamination")
    assert rows.count() > 0
