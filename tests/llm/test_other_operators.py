"""License scans, URL filters, vectors, components, queries and the pipeline."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmesh.llm import components, embeddings, licenses, queries, urls

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_license_places_are_the_brute_force_ones(spark):
    texts = [
        None, "", "mit license", "MIT-License, mit license; general public", "the GNU General\nPublic LICENSE of general public license", "é mit licenseé apache_license", "Mit license " * 300,
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", "This Source Code Form is subject to all of the terms of the Mozilla Public License, v. 2.0",
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(k, name) for k in range(len(w)) for name, p in licenses.PHRASES if w[k : k + len(p.split())] == p.split()]
        assert (got[i].n_words, got[i].n_base) == (len(w), len(at))
        assert (got[i].first_word, got[i].last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert got[i].base_labels == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, got[i].base_labels.split(","))) <= set(got[i].labels.split(",")) | {""}
        assert 0 <= got[i].score <= 1
    assert got[7].labels == "gpl,gpl-3.0" and got[8].labels == "cc-by-nc" and got[9].labels == "cc-by" and got[10].labels == "mpl-2.0"


def test_license_edges(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    twice = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (None, "x")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_base) for r in licenses.scan(twice).collect()) == [(0, 0), (1, 1), (1, 1)]
    mixed = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (2, "mit license " * 20_000, "c")], "doc_id long, text string, labels string")
    assert sorted((r.doc_id, r.n_words, r.n_base) for r in licenses.scan(mixed).collect()) == [(1, 0, 0), (1, 0, 0), (2, 40_000, 20_000)]


def test_license_texts_match_with_changes_and_not_out_of_order(spark):
    text = dict(licenses.TEXTS)["mit"].split()
    changed = [w if i % 40 else "other" for i, w in enumerate(text)]
    inserted = [x for i, w in enumerate(text) for x in ([w, "new"] if i % 50 == 7 else [w])]
    mixed = [w for i in range(0, len(text), 6) for w in reversed(text[i : i + 6])]
    part = text[: len(text) // 2]
    half = [text[: len(text) // 2], ["filler"] * 400, text[len(text) // 2 :]]
    rows = [" ".join(x) for x in (text, changed, inserted, mixed, part[30:], sum(half, []))]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: [s for s in r.spans if s.high - s.low > 100] for r in licenses.scan(df).collect()}
    assert [len(got[i]) for i in range(6)] == [1, 1, 1, 0, 0, 0]
    own = licenses.scan(spark.createDataFrame([(1, "x one two three four y")], "doc_id long, text string"), more=[("own", "one two three four")]).first()
    assert (own.labels, own.score) == ("own", 1.0)


URLS = [
    ("https://A.com/x?y", "a.com", "/x", "com/", "allow"),
    ("http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://m.example.com/en/1#t", "m.example.com", "/en/1", "example.com/en/", "block"),
    ("http://example.com/de/1", "example.com", "/de/1", "com/", "allow"),
    ("ftp://s.example.net/fr/", "s.example.net", "/fr/", "net/fr/", "block"),
    ("http://s.example.net/en/", "s.example.net", "/en/", None, "block"),
    ("http://quiet.org/en/", "quiet.org", "/en/", None, "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("http://xcom/", "xcom", "/", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_urls(spark):
    df = spark.createDataFrame([(i, u[0], None, "v") for i, u in enumerate(URLS)], "page_id long, url string, html string, verdict string")
    got = {r.page_id: tuple(r)[1:5] for r in urls.judge(df).collect()}
    assert [got[i] for i in range(len(URLS))] == [u[1:] for u in URLS]
    assert urls.judge(df.limit(0)).collect() == []


def test_distrust_flows_against_links_and_trust_along_them(spark):
    link = lambda *hosts: "".join(f'<a href="//{h}/x">x</a>' for h in hosts)
    rows = [(1, "http://good.com/", link("friend.org")), (2, "http://bad.net/es/1", ""), (3, "http://fan.org/", link("bad.net")), (4, "http://friend.org/", ""), (5, "http://lone.org/", None)]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow"}


def test_distrust_reaches_the_start_of_a_long_chain(spark):
    hosts = [f"h{i}.org" for i in range(12)] + ["bad.net"]
    rows = [(i, f"http://{a}/", f'<a href="//{b}/x">x</a>') for i, (a, b) in enumerate(zip(hosts, hosts[1:], strict=False))] + [(99, "http://bad.net/es/1", "")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.verdict for r in got} == {"block"}


def test_mass_is_personalised_pagerank(spark):
    e = [("t", "a", "b", 1.0, False), ("t", "b", "a", 0.5, True), ("t", "b", "c", 0.5, True)]
    got = {r.host: r.mass for r in urls.propagate(spark.createDataFrame(e, "kind string, src string, dst string, share double, hub boolean"), spark.createDataFrame([("t", "a", 1.0)], "kind string, host string, mass double"), rounds=6).collect()}
    m = {"a": 1.0, "b": 0.0, "c": 0.0}
    for _ in range(6):
        m = {"a": 0.15 + 0.85 * 0.5 * m["b"], "b": 0.85 * m["a"], "c": 0.85 * 0.5 * m["b"]}
    assert got == pytest.approx({k: v for k, v in m.items()})


def vectors(n=260, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    near = base[:60] + rng.normal(size=(60, dim)) * 0.12
    return np.concatenate([base, near, base[:20], base[:10] * 3]).astype(np.float32)


def test_vectors_against_brute_force(spark):
    x = vectors()
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    odd = [(1000, None, "x"), (1001, [0.0] * 16, "x"), (1002, [float("nan")] * 16, "x"), (1003, [None] + [1.0] * 15, "x"), (1004, [float("inf")] + [1.0] * 15, "x")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, kept string").repartition(3)
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, block=64).collect()}
    u = x.astype(float)
    u /= np.sqrt((u * u).sum(1))[:, None]
    hit = u @ u.T >= 0.9
    np.fill_diagonal(hit, False)
    root = np.arange(len(x))
    for _ in range(50):
        root = np.array([min(root[i], root[hit[i]].min(initial=root[i])) for i in range(len(x))])
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.99 * hit.sum() <= found <= hit.sum()
    assert all(got[i].n_links <= hit[i].sum() for i in range(len(x)))
    assert np.mean([got[i].component_id == root[i] for i in range(len(x))]) > 0.98
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(1000, 1005))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_vector_edges(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    same = spark.createDataFrame([(5, [1.0, 0.0]), (3, [1.0, 0.0]), (9, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in embeddings.near_duplicates(same).collect()} == {(5, 1, 3, False), (3, 1, 3, True), (9, 0, 9, True)}


def test_vector_recall_with_a_tight_group_split_cells_and_mixed_lengths(spark):
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.sqrt((x * x).sum(1))[:, None]
    x = unit(rng.normal(size=(2500, 32)))
    side = rng.normal(size=x.shape)
    side = unit(side - (side * x).sum(1)[:, None] * x)
    group = unit(unit(rng.normal(size=(1, 32))) + 0.03 * rng.normal(size=(2500, 32)))
    far = unit(rng.normal(size=(600, 8)))
    every = [*x, *(0.902 * x + np.sqrt(1 - 0.902**2) * side), *group, *far]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<double>").repartition(5)
    want = np.zeros(len(every), np.int64)
    for a, b in ((0, 7500), (7500, len(every))):
        u = np.stack(every[a:b])
        hit = u @ u.T >= 0.9
        want[a:b] = hit.sum(1) - 1
    for split in (32_768, 1500):
        got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, split=split).collect()}
        found = np.array([got[i] for i in range(len(every))])
        assert (found <= want).all() and found.sum() >= 0.99 * want.sum()
        assert found[:5000].sum() >= 0.97 * want[:5000].sum()


def test_vectors_of_other_lengths_null_ids_and_repeats(spark):
    rows = [(i, [float(i == j) for j in range(3)]) for i in range(3)] + [(10, [1.0, 2.0]), (11, [1.0, 2.001]), (11, [1.0, 2.001]), (None, [1.0, 2.0]), (None, None), (12, []), (13, [5.0])]
    got = sorted(map(tuple, embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)).collect()), key=str)
    assert got == sorted([(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (10, 1, 10, True), (11, 1, 10, False), (12, 0, 12, True), (13, 0, 13, True), (None, 0, None, True), (None, 0, None, True)], key=str)


def test_components(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(64)] + [(5000, i) for i in range(2000, 2100)] + [(None, 1)]
    root = {v: v for p in pairs for v in p if v is not None}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in pairs:
        if a is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.v: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {v: find(v) for p in pairs if p[0] is not None for v in p}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_a_row_per_document(spark, name):
    got = queries.QUERIES[name](spark, SF)
    source = {"op8_urls": "pages", "op9_embeddings": "embeddings"}.get(name, "documents")
    n = spark.read.parquet(f"{SF}/{source}.parquet").count()
    assert got.select(got.columns[0]).distinct().count() == n
    if name != "op3_packing":
        assert got.count() == n


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs.count(), docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "ngram_jaccard_join", "suffix_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == before
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = docs.join(labels, "doc_id").agg(F.sum("toxic").alias("t")).first().t or 0
    assert left < labels.agg(F.sum("toxic").alias("t")).first().t


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    ran = con.execute(queries.ORACLES[name])
    at = [[d[0] for d in ran.description].index(c) for c in cols]
    plain = lambda x: round(x, 6) if isinstance(x, float) else x
    want = sorted(repr([plain(r[i]) for i in at]) for r in ran.fetchall())
    assert sorted(repr([plain(r[c]) for c in cols]) for r in got.collect()) == want
