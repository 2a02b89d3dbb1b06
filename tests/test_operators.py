"""Operators on small hand-made inputs with exact expectations."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T
from lexmesh.operators import corpus, graph, match, records, style
from lexmesh.sources import readers, writers
from lexmesh.streaming import ingest


def one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(col.alias("x")).first().x


def test_scalars(spark):
    assert one(spark, T.node_id(F.col("a")), a="  Secretaría DE Gobernación ") == "secretaria de gobernacion"
    assert one(spark, T.slug(F.col("a")), a="  Ley Orgánica: 2ª parte ") == "ley-organica-2-parte"
    assert one(spark, T.count_literal(F.col("a"), "a.a"), a="a.aa.a") == 2
    assert one(spark, T.n_words(F.col("a")), a=" \n ") == 0
    assert one(spark, T.id_of("NOR-", F.col("a"), 12), a="x").startswith("NOR-")
    assert T.similarity_ratio("abcd", "abcd") == 1.0


def test_keyword_argmax_ties_and_default(spark):
    best = T.best_by_keywords(F.col("a"), rules.STAGE_KEYWORDS, "Integración")
    assert one(spark, best, a="supervisión y control del reparto") == "Supervisión"
    assert one(spark, best, a="reparto, control") == "Distribución"
    assert one(spark, best, a="nada") == "Integración"
    # a keyword inside another word counts too
    assert one(spark, best, a="administración") == "Administración"


def test_markdown_sections(spark):
    docs = spark.createDataFrame([("d", "intro\n# Uno\na\nb\n## Dos\n# Tres\nc")], "k string, t string")
    got = {(r.heading, r.body) for r in corpus.markdown_sections(docs, "k", "t").collect()}
    assert got == {("(inicio)", "intro"), ("Uno", "a\nb"), ("Tres", "c")}


def test_entities_and_layers(spark):
    s = spark.createDataFrame([("j", "El Director General y la Ley General de Transparencia; Oficio No. 12/A.")], "k string, body string")
    got = {(r.type, r.entity, r.layer) for r in corpus.pattern_entities(s, ("k",)).collect()}
    assert ("CARGO", "Director General", "informal") in got
    assert ("NORMA", "Ley General de Transparencia", "normativo") in got
    assert any(t == "DOCUMENTO" and layer == "operativo" for t, _, layer in got)


def test_patterns_are_tried_only_where_a_literal_of_theirs_is(spark):
    patterns = [*rules.RELEVANCE_PATTERNS, r"\d+", r"\p{Lu}x"]
    assert T.needles(r"Ce?rcar|(?:Uno|dos) x") == ["rcar", "uno", "dos"] and T.needles(r"a?\d+") == [] and T.needles(r"\p{Lu}x") == []
    texts = ["El FASP y la SEGURIDAD PUBLICA, plazo de 30 dias", "Gobernador que celebre acuerdos; cercar", "nada", "", None, "Coordinacion con las entidades 15", "REINSENCIN"]
    d = spark.createDataFrame([(x,) for x in texts], "t string").select(T.pattern_score(F.col("t"), patterns).alias("n"), sum((F.col("t").rlike(f"(?i){p}").cast("int") for p in patterns), F.lit(0)).cast("long").alias("want"))
    got = d.collect()
    assert [r.n for r in got] == [r.want for r in got] and got[0].n >= 4 and got[4].n is None
    units = spark.createDataFrame([(1, i, x) for i, x in enumerate(texts)], "norm long, number int, body string")
    plan = corpus.relevant(units, "norm", "number", "body")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("sesnsp") <= 2  # the score stands there once: its literal and its pattern


def test_dictionary_entities(spark):
    s = spark.createDataFrame([("j", 1, "La Guardia Nacional y guardia nacional."), ("j", 2, "guardias nacionales")], "k string, n int, body string")
    d = spark.createDataFrame([("GUARDIA NACIONAL",), ("Nacional",)], "entry string")
    assert {(r.n, r.entry) for r in corpus.dictionary_entities(s, d, ("k", "n")).collect()} == {(1, "GUARDIA NACIONAL"), (1, "Nacional")}


def test_pages_and_segments(spark):
    d = spark.createDataFrame([("a", "x\n--- Página 1 ---\nuno\n--- Página 2 ---\ndos")], "k string, t string")
    assert [(r.page, r.body) for r in corpus.pages_of(d, "k", "t").orderBy("page").collect()] == [(0, "x"), (1, "uno"), (2, "dos")]


def test_legal_units(spark):
    text = "LEY X\nArtículo 1. Integración del convenio.\nArtículo 2 bis. Lista:\nI) primero\nII) segundo"
    d = spark.createDataFrame([("a", text), ("b", "sin nada")], "k string, t string")
    got = [(r.k, r.article, r.fraction) for r in corpus.legal_units(d, "k", "t").orderBy("k", "article", "fraction").collect()]
    assert got == [("a", "1", None), ("a", "2 bis", "I"), ("a", "2 bis", "II"), ("b", "Único", None)]


def test_level_hierarchy_name(spark):
    t = F.col("a")
    assert one(spark, corpus.level(t), a="Gobierno del Estado") == "Estatal"
    assert one(spark, corpus.level(t), a="x") == "Federal"
    assert one(spark, corpus.hierarchy(t), a="Reglamento de la Ley") == "Reglamento"
    assert one(spark, corpus.norm_name(t), a="\nuno\nLEY DE X\n") == "LEY DE X"


def test_relevance(spark):
    u = spark.createDataFrame([("n", i, "Seguridad Pública y transparencia" if i % 2 else "nada") for i in range(20)], "norm string, num int, body string")
    got = corpus.relevant(u, "norm", "num", "body").orderBy("rank").collect()
    assert [r.num for r in got] == [1, 3, 5, 7, 9, 11, 13, 15]
    assert {r.score for r in got} == {2}


CORPUS = [("d1", "s", "A", "INSTITUCION", "normativo"), ("d1", "s", "B", "CARGO", "normativo"), ("d1", "s", "C", "CARGO", "operativo"), ("d2", "s", "a", "NORMA", "informal"), ("d2", "s", "B", "CARGO", "informal")]


@pytest.fixture(scope="module")
def entities(spark):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(CORPUS)], "job string, section string, entity string, type string, layer string, pos int")


def test_nodes_and_edges(entities):
    n = {r.nid: r for r in graph.nodes(entities).collect()}
    assert (n["a"].label, n["a"].type, n["a"].layer, n["a"].layers, n["a"].frequency) == ("a", "INSTITUCION", "normativo", ["informal", "normativo"], 2)
    e = {(r.src, r.dst): r for r in graph.edges(entities, "job", "section").collect()}
    assert (e["a", "b"].weight, e["a", "b"].n_documents, e["a", "b"].transversal) == (2, 2, True)
    assert set(e) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert e["a", "c"].layers == ["normativo", "operativo"]


PATH = [(1, 2, 3.0), (2, 3, 1.0), (3, 4, 1.0)]


def test_metrics_of_a_path(spark):
    links = spark.createDataFrame(PATH, "src int, dst int, weight double")
    v = spark.createDataFrame([(i,) for i in range(1, 5)], "node int")
    assert graph.density(links, v).first().density == 0.5
    found = graph.distances(links)
    assert tuple(graph.path_summary(found, v).first()) == (3, 1.6667)
    b = {r.node: r.betweenness for r in graph.betweenness(links).collect()}
    assert b == {1: 0.0, 2: 0.666667, 3: 0.666667, 4: 0.0}
    w = {r.node: r.betweenness for r in graph.betweenness(links, directed=True, weight="weight").collect()}
    assert w[2] == pytest.approx(2 / 6, abs=1e-6)
    assert {r.component for r in graph.weak_components(links).collect()} == {1}
    assert {(r.node, r.degree) for r in graph.degree_centrality(links).collect()} == {(1, 1), (2, 2), (3, 2), (4, 1)}


def test_communities_are_a_partition_with_good_modularity(spark):
    tri = [(0, 1), (1, 2), (0, 2), (3, 4), (4, 5), (3, 5), (2, 3)]
    links = spark.createDataFrame([(a, b, 1.0) for a, b in tri], "src int, dst int, weight double")
    parts = graph.communities(links)
    got = {r.node: r.community for r in parts.collect()}
    assert got[0] == got[1] == got[2] != got[3] == got[4] == got[5]
    assert graph.modularity(links, parts).first().modularity == pytest.approx(0.3571, abs=1e-4)


def test_matrices(spark):
    links = spark.createDataFrame([("a", "b", 2, 1), ("a", "b", 9, 2), ("b", "a", 3, 3)], "src string, dst string, weight int, id int")
    assert {tuple(r) for r in graph.adjacency(links, ["a", "b"]).collect()} == {("a", 0, 2), ("b", 3, 0)}
    assert {r.weight for r in graph.last_edges(links).collect()} == {9, 3}
    stages = spark.createDataFrame([("a", "b", "S1")], "src string, dst string, stage string")
    actors = spark.createDataFrame([("a",), ("c",)], "actor string")
    more = spark.createDataFrame([("c", "S2")], "actor string, stage string")
    assert {tuple(r) for r in graph.incidence(stages, more, actors, ["S1", "S2"]).collect()} == {("a", "X", "", 1), ("c", "", "X", 1)}


def test_matching(spark):
    a = spark.createDataFrame([(1, "Ley General de Seguridad Pública"), (2, "Otra cosa distinta")], "i int, t string")
    b = spark.createDataFrame([(7, "ley general del sistema de seguridad"), (8, "seguridad publica general")], "j int, t string")
    p = match.shared_words(a, b, "i", "j", "t", "t")
    assert {(r.left, r.right, r.common) for r in p.collect()} == {(1, 7, 2), (1, 8, 3)}
    assert [(r.left, r.right, r.jaccard) for r in match.best_jaccard(p).collect()] == [(1, 8, 1.0)]


GOOD = {"Tag": "Doe1999x", "SourceType": "Book", "AuthorType": "person", "Authors": [{"Last": "Doe", "First": "J"}], "CorporateAuthor": {"Name": ""}, "Title": "t", "Year": "1999", "City": "", "Publisher": "", "Institution": "", "URL": "", "Notes": ""}


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({}, []),
        ({"Year": "99"}, ["Year"]),
        ({"Extra": 1}, ["extra key Extra"]),
        ({"Authors": []}, ["person without authors"]),
        ({"Authors": [{"Last": "x"}]}, ["Authors entry"]),
        ({"Tag": "Doe"}, ["Tag without a year"]),
        ({"AuthorType": "corporate"}, ["corporate with authors", "corporate without a name"]),
        ({"Notes": None, "drop": "Notes"}, ["missing key Notes"]),
    ],
)
def test_biblio(spark, change, expected):
    record = GOOD | change
    if drop := record.pop("drop", None):
        del record[drop]
    got = one(spark, records.biblio_issues(F.col("a")), a=json.dumps(record))
    assert [x.message for x in got] == expected


def test_records(spark):
    assert one(spark, records.date_of(F.col("a")), a="a 5 de Marzo de 2021") == "2021-03-05"
    assert one(spark, records.date_of(F.col("a")), a="el 5/3/2021") == "2021-03-05"
    assert one(spark, records.date_of(F.col("a")), a="de 1999") == "1999-01-01"
    for none in ("nada https://doi.org/10.1234/d1903.", "en https://a.mx/2019/x", "doi 10.2014/x", "lote 119035", "d1903"):
        assert one(spark, records.date_of(F.col("a")), a=none) is None
    assert one(spark, records.date_of(F.col("a")), a="https://a.mx/2019/x, México,2014.") == "2014-01-01"
    assert one(spark, records.document_type(F.col("a")), a="convenio de coordinación") == "Convenio"
    assert one(spark, records.parse_name(F.col("a")), a="FASP_2026_P1_MEX_INFORME_V1.0.docx").ok
    assert not one(spark, records.parse_name(F.col("a")), a="FASP_2026_P9_MEX_INFORME_V1.0.docx").ok
    assert one(spark, records.heading_level(F.col("a"), F.lit(10.0)), a="TITULO CORTO") == 1
    assert one(spark, records.heading_level(F.col("a"), F.lit(15.0)), a="texto normal") == 2
    assert one(spark, records.conversion_issues(F.col("m"), F.col("s")), m="a b", s="a b c d") == ["no_heading_at_start", "no_inner_heading", "low_coverage"]
    assert one(spark, records.missing_caps(F.col("m"), F.col("s")), m="LEYES", s="LEYES ARTÍCULO NORMA") == ["ARTÍCULO", "NORMA"]


def test_gates_and_ids(spark):
    gates = list(dict.fromkeys((s, p) for s, p, _ in rules.GATES))
    expected = spark.createDataFrame(gates, "stage string, profile string")
    d = spark.createDataFrame([(1, *gates[0], "aprobado"), (2, *gates[1], "aprobado"), (3, *gates[1], "rechazado")], "id int, stage string, profile string, decision string")
    got = {(r.stage, r.profile): r.state for r in records.pending(expected, d, ("stage", "profile")).collect()}
    assert len(rules.GATES) == 15 and len(got) == 7 and got[gates[1]] == "rechazado" and got[gates[2]] == "nunca_registrado"
    a = spark.createDataFrame([(1, "X"), (2, "X"), (3, " ")], "i int, n string")
    assert [(r.i, r.aliases) for r in records.actor_ids(a, "n", "i").collect()] == [(1, ["X"])]
    t = spark.createDataFrame([(1, "Doe", "1999", "law"), (2, "Doe", "1999", "law")], "i int, a string, y string, w string")
    assert [r.tag for r in records.tags(t, "a", "y", "w", "i").orderBy("i").collect()] == ["Doe1999Law", "Doe1999Lawb"]


def test_vocabulary_skips_nulls(spark):
    d = spark.createDataFrame([(1, "Formal"), (2, "X"), (3, None)], "i int, kind string")
    assert [(r.i, r.value) for r in records.vocabulary_violations(d, "i", {"kind": rules.VOCABULARIES["tipos_vinculo"]}).collect()] == [(2, "X")]


def test_style(spark):
    p = spark.createDataFrame([("d", 1, "Cabe destacar que considero la pág. 12 y Art. 28.5 siempre"), ("d", 2, "TODO EN MAYÚSCULAS AQUÍ"), ("d", 3, "La ASF revisa. El OIC (Organo) también; SHCP (Secretaría)")], "doc string, par int, text string")
    assert {r.rule for r in style.findings(p).collect()} == {"filler", "first_person", "page", "bis", "absolute", "capitals"}
    assert [r.acronym for r in style.undefined_acronyms(p).collect()] == ["ASF"]
    assert one(spark, style.fixed(F.col("a")), a="Cabe destacar que la pag. 3 del Art. 28.5") == "la p. 3 del Art. 28 Bis"


def test_files(spark, tmp_path):
    (tmp_path / "in/j1").mkdir(parents=True)
    (tmp_path / "in/j1/entities.jsonl").write_text('{"entity":"A","type":"CARGO","layer":"informal","section":"s"}\n')
    (tmp_path / "in/dict.txt").write_text("# c\nUno\n\nDos tres\nUno\n")
    (tmp_path / "in/j1/x.md").write_text("# t\n| a | b |\n|---|---|\n| 1 |  |\n")
    (tmp_path / "in/j1/x.pdf").write_bytes(b"%PDF")
    folder = str(tmp_path / "in")
    assert [(r.job, r.entity) for r in readers.entity_lines(spark, folder).collect()] == [("j1", "A")]
    assert [r.entry for r in readers.dictionary(spark, folder + "/dict.txt").collect()] == ["Dos tres", "Uno"]
    md = readers.whole_texts(spark, folder)
    assert [r.cells for r in readers.table_rows(md, "name", "text").orderBy("line").collect()] == [["a", "b"], ["1", ""]]
    assert readers.manifest(spark, folder).first().name == "x.pdf"
    nodes = spark.createDataFrame([("a", ["x", "y"])], "nid string, layers array<string>")
    edges = spark.createDataFrame([("a", "b", 1)], "src string, dst string, weight int")
    writers.graphml(nodes, edges, str(tmp_path / "g"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "g")).collect()]
    assert any("x|y" in x for x in lines) and lines[0].startswith("<?xml")
    assert writers.export_all({"n": nodes, "none": nodes.limit(0)}, str(tmp_path / "csv")) == ["n"]
    assert "<td>1</td>" in writers.html_table(edges, "t").first().html
    new = spark.createDataFrame([("a", "b", 5)], "src string, dst string, weight int")
    assert [r.weight for r in writers.upsert(edges, new, ["src", "dst"]).collect()] == [5]


def test_stream_equals_batch(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    rows = spark.createDataFrame([(i % 3, f"s{i % 4}") for i in range(12)], "file_id int, sha string")
    rows.repartition(3).write.parquet(src)
    s = ingest.changed(ingest.file_stream(spark, src, rows.schema, 1))
    ingest.drain(s, out, ck)
    assert spark.read.parquet(out).count() == 12
    ingest.drain(s, out, ck)  # a second run finds nothing new
    assert spark.read.parquet(out).count() == 12


def test_tumbling_stream(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    e = spark.range(100).select((F.timestamp_seconds(F.col("id") * 60)).alias("ts"), F.lit("a").alias("k"), F.col("id").cast("double").alias("value"))
    e.write.parquet(src)
    ingest.drain(ingest.tumbling(ingest.file_stream(spark, src, e.schema), "ts", "10 minutes", ["k"], "0 seconds"), out, ck)
    batch = {tuple(r) for r in ingest.tumbling(e, "ts", "10 minutes", ["k"]).collect()}
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    assert got <= batch and len(got) >= 9  # the last window is open


def test_global_articles(spark):
    from lexmesh.operators import articles

    long = "texto de un articulo que es lo bastante largo para quedar"
    pages = spark.createDataFrame(
        [("a", 1, "INDICE\nARTÍCULO 1 x"), ("a", 2, f"inicio\nARTÍCULO 1. {long}\nReformado P.O. 1999, y más letras aquí"), ("a", 3, f"{long} sigue\nARTÍCULO 2 bis {long}\nCAPÍTULO II\notra cosa {long}"), ("a", 4, f"\nARTÍCULO 1 {long}")],
        "k string, page int, body string",
    )
    got = {(r.number, r.suffix): (r.page, r.body) for r in articles.global_articles(pages, "k").collect()}
    assert set(got) == {(1, None), (2, "bis")}
    assert got[1, None][0] == 2 and "Reformado" not in got[1, None][1]
    assert got[2, "bis"][0] == 3 and "otra cosa" not in got[2, "bis"][1]
    assert one(spark, articles.number_label(F.lit(28), F.lit("bis")), a=1) == "28 Bis"
    listed = spark.createDataFrame([("a", 2, "bis")], "k string, number int, suffix string")
    kept = articles.listed_or_relevant(articles.global_articles(pages, "k"), listed, "k")
    assert [(r.number, r.suffix) for r in kept.collect()] == [(2, "bis")]


def test_titles_tables_and_responses(spark):
    from lexmesh.operators import articles

    assert one(spark, articles.title(F.split("a", "\n")), a="Página 3\nuna linea 1 2 3 4, y\nREGLAMENTO INTERIOR DE X\n") == "REGLAMENTO INTERIOR DE X"
    lines = spark.createDataFrame([("d", i, t) for i, t in enumerate(["| a |", "| b |", "x", "| c |"])], "k string, i int, t string")
    assert {(r.first, r.last, r.rows) for r in articles.table_runs(lines, "k", "i", "t").collect()} == {(0, 1, 2), (3, 3, 1)}
    assert one(spark, articles.cleaned_response(F.col("a")), a="<think>x</think>\n```md\n# t\n```\n") == "# t"


def test_schema_issues(spark):
    schema = {"required": ["id", "n"], "additionalProperties": False, "properties": {"id": {"type": "string", "pattern": "^[a-f0-9]{3}$"}, "n": {"type": "integer", "minimum": 1, "maximum": 5}, "k": {"enum": ["x", "y"]}}}
    issues = lambda s: one(spark, records.schema_issues(F.col("a"), schema), a=s)
    assert issues('{"id":"abc","n":3,"k":"x"}') == []
    assert issues('{"id":"q","n":9,"z":1}') == ["extra z", "id has another form", "n above 5"]
    assert issues('{"n":1.5,"k":"w"}') == ["missing id", "n is no integer", "k not in its list"]


def test_entity_issues(spark):
    e = spark.createDataFrame([("j", "s", "A", "CARGO", "informal"), ("j", "t", "B", "X", "informal")], "job string, section string, entity string, type string, layer string")
    s = spark.createDataFrame([("j", "s")], "job string, section string")
    assert {(r.entity, r.issue) for r in records.entity_issues(e, s).collect()} == {("B", "type"), ("B", "section")}


def test_layout_blocks(spark, tmp_path):
    from lexmesh.sources import documents

    (tmp_path / "a.jsonl").write_text('{"page":1,"text":"TITULO","max_font_size":20}\n{"page":1,"text":"1) uno","max_font_size":10}\n{"page":2,"text":"texto","max_font_size":10}\n')
    blocks = documents.blocks(spark, str(tmp_path), "*.jsonl", documents.json_blocks)
    md = records.blocks_to_markdown(blocks, "path", "pos", "text", "max_font_size").first().md
    assert md == "\n# TITULO\n\n1. uno\ntexto\n"


def test_whole_texts_of_odd_documents(spark, tmp_path):
    import hashlib

    from lexmesh.plans import catalog, outputs  # noqa: F401

    texts = [(1, "a\r\nb\n"), (1, "a\r\nb\n"), (1, "otro"), (-2, "ñ\u2028 "), (None, "x"), (3, ""), (4, None), (5, "y" * 100_000)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["whole_texts"](spark, str(tmp_path)).collect()
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, got)) == order((i, hashlib.md5(t.encode()).hexdigest()) for i, t in texts if t)


def test_documents_come_back(spark, tmp_path):
    from lexmesh.sources import documents

    lines = [("Ley (uno) \\ dos", 20.0), ("artículo 1º", 9.0)]
    assert [(p, t, s) for p, t, s, _ in documents.pdf_blocks(writers.pdf([lines, lines[:1]]))] == [(1, *lines[0]), (1, *lines[1]), (2, *lines[0])]
    data = writers.docx([("Título & más", 1), ("texto", 0)], [["a", "<b>"], ["", "c"]])
    assert [(t, s) for _, t, s, _ in documents.docx_blocks(data)] == [("Título & más", 18.0), ("texto", 11.0)]
    assert [c for _, c in documents.docx_rows(data)] == [["a", "<b>"], ["", "c"]]
    assert [c for _, c in documents.xlsx_rows(writers.xlsx([["a", ""], ["ñ", "<"]]))] == [["a", ""], ["ñ", "<"]]
    writers.save_bytes(spark, f"{tmp_path}/x.docx", data)
    found = documents.blocks(spark, str(tmp_path), "*.docx", documents.docx_blocks, lambda _: [(1, "otro", 0.0, [])], force=True)
    assert [r.text for r in found.collect()] == ["otro"]
    assert readers.json_text(spark, '{"a": 1, "b": ["x"]}', "a int, b array<string>").first().b == ["x"]
    with pytest.raises(ValueError):
        writers.report(spark.range(writers.OFFICE_ROWS + 1), f"{tmp_path}/y.xlsx", "t")


def test_paths_longer_than_any_bound(spark):
    n = 90
    links = spark.createDataFrame([(i, i + 1) for i in range(n)], "src int, dst int")
    found = graph.distances(links.where("src < 70"))
    assert found.agg(F.max("distance")).first()[0] == 70
    assert {r.component for r in graph.weak_components(links).collect()} == {0}
    v = spark.createDataFrame([(i,) for i in range(n + 1)], "node int")
    far = {r.node: r.closeness for r in graph.closeness_centrality(links, v, directed=True).collect()}
    assert far[0] == 0 and far[n] == pytest.approx(n / (n * (n + 1) / 2), abs=1e-6)


@pytest.mark.parametrize("directed", [False, True])
def test_distances_and_their_sums_are_those_of_joins(spark, monkeypatch, directed):
    links = spark.createDataFrame([(f"v{i}", f"v{j}") for i in range(150) for j in ((i * 7 + 1) % 150, (i * i) % 150) if i % 50 and i < j], "src string, dst string")
    v = links.selectExpr("explode(array(src, dst)) AS node").distinct()
    rows = lambda d: sorted(map(tuple, d.collect()))
    made = lambda: (graph.distances(links, directed=directed), graph.path_sums(links, directed))
    pairs, sums = made()
    assert "Join" not in pairs._jdf.queryExecution().toString() and "Exchange" not in sums._jdf.queryExecution().toString()
    got = rows(pairs), rows(sums), rows(graph.closeness(pairs, v))
    assert got[2] == rows(graph.closeness_centrality(links, v, directed))
    assert rows(graph.sums_summary(sums, v)) == rows(graph.path_summary(pairs, v))
    monkeypatch.setattr(graph, "MOST_EDGES", 3)
    assert [rows(d) for d in made()] == [*got[:2]]


def test_weighted_dependencies_are_made_of_arrays():
    import time

    rng = np.random.default_rng(5)  # as many vertices and edges as the ties of 256,410 documents have: 0.9 s a source vertex by vertex
    n, m = 30_000, 130_000
    a, b = rng.integers(0, n, (2, m))
    cost = np.minimum(rng.zipf(2.0, m), 2000) + 2.0
    src, dst, cost = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([cost, cost])
    order = np.lexsort((cost, dst, src))
    src, dst, cost = src[order], dst[order], cost[order]
    first = np.concatenate([[True], (src[1:] != src[:-1]) | (dst[1:] != dst[:-1])]) & (src != dst)
    g = graph._Packed(np.arange(n), np.searchsorted(src[first], np.arange(n + 1)), dst[first], cost[first])
    took = []
    for s in range(3):
        start = time.process_time()
        at, value = graph._weighted_dependencies(g, s)
        took.append(time.process_time() - start)
        assert s not in at and (value > 0).all()
    assert min(took) < 0.35


def test_betweenness_is_the_brute_force_one(spark):
    import itertools
    import random
    from collections import defaultdict

    rng = random.Random(3)
    pairs = {(a, b): rng.choice([1.0, 2.0, 3.0]) for a, b in itertools.combinations(range(9), 2) if rng.random() < 0.4}
    near = defaultdict(dict)
    for (a, b), w in pairs.items():
        near[a][b] = near[b][a] = w

    def best(s, t, cost):
        found, low = [], float("inf")
        def walk(path, total):
            nonlocal found, low
            if path[-1] == t:
                if total < low:
                    found, low = [path], total
                elif total == low:
                    found.append(path)
                return
            for v, w in near[path[-1]].items():
                if v not in path:
                    walk([*path, v], total + (w if cost else 1))
        walk([s], 0)
        return found

    links = spark.createDataFrame([(a, b, w) for (a, b), w in pairs.items()], "src int, dst int, w double")
    n = len(near)
    for weight in (None, "w"):
        want = defaultdict(float)
        for s, t in itertools.permutations(near, 2):
            paths = best(s, t, weight)
            for p in paths:
                for v in p[1:-1]:
                    want[v] += 1 / len(paths)
        got = {r.node: r.betweenness for r in graph.betweenness(links, weight=weight).collect()}
        assert got == pytest.approx({v: want[v] / ((n - 1) * (n - 2)) for v in near}, abs=2e-6)


def test_contexts_are_those_of_the_match(spark):
    s = spark.createDataFrame([("j", "Titular uno " + "x " * 60 + "Titular dos")], "k string, body string")
    got = [r.context for r in corpus.pattern_entities(s, ("k",)).where("type = 'CARGO'").collect()]
    assert got[0].startswith("Titular uno") and got[1].endswith("Titular dos") and "uno" not in got[1]
