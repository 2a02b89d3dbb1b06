"""Norm and bibliographic operators on nulls, empty texts, ties and repeats."""

import pytest
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.operators import biblio, corpus, graph, match, norms, reports, style
from lexmesh.sources import readers, writers
from lexmesh.streaming import ingest


def test_bibliographic_fields_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "i int, text string")
    for r in biblio.extracted(df, ("i",)).collect():
        assert {k: v for k, v in r.asDict().items() if v is not None} == {"i": r.i}
    one = lambda c, t: spark.createDataFrame([(t,)], "t string").select(c.alias("x")).first().x
    assert one(biblio.paper(F.col("t")), "Key words: a\nSolo Autor*") is None
    assert one(biblio.title(F.col("t")), "una\ndos") is None
    assert one(biblio.title(F.col("t"), F.lit("FASP_2026_MEX_Evaluación_de_resultados_2025.pdf")), "una") == "Evaluación de resultados 2025"
    assert one(biblio.document_type(F.col("t"), F.lit("TDR_x.pdf")), "Reglamento") == "Otro"
    assert one(biblio.issuing_body(F.col("t")), "uno\nEl Consejo de Evaluación Local\ndos") == "El Consejo de Evaluación Local"
    assert one(biblio.issuing_body(F.col("t")), "CÁMARA DE DIPUTADOS") == "Cámara de Diputados"
    assert one(biblio.doi(F.col("t")), "véase https://dx.doi.org/10.1/x.") == "10.1/x"


def test_lookup_repeats_and_unknown_keys(spark):
    found = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "b", "z")], "i int, doi string, lugar string")
    known = spark.createDataFrame([("a", "q", 2), ("a", "p", 1), (None, "n", 3)], "doi string, lugar string, volumen int")
    assert sorted((r.i, r.lugar, r.volumen) for r in biblio.enriched(found, known).collect()) == [(1, "p", 1), (2, "y", None), (3, "z", None)]


def test_interpretations_follow_their_order(spark):
    rows = [("El FASP y su convenio", 1), ("convenio de coordinación", 1), ("nada", 19), ("nada", None), (None, 3)]
    got = [r.x for r in spark.createDataFrame(rows, "t string, n int").select(norms.interpretation(F.col("t"), F.col("n"), F.lit("GASTO")).alias("x")).collect()]
    assert got[0] == rules.INTERPRETATIONS[1][2] and got[1] == rules.INTERPRETATIONS[7][2] and got[2] == rules.INTERPRETATIONS[21][2]
    assert got[3].endswith("en el proceso de gasto") and got[4].endswith("en el proceso de gasto")


def test_files_and_jobs(spark):
    laws = spark.createDataFrame([("a", "x1"), ("b", "zz"), ("c", "^x")], "law string, pattern string")
    files = spark.createDataFrame([("X1.txt",), ("x10.txt",)], "name string")
    assert {(r.law, r.file) for r in norms.files_of_laws(laws, files, "law", "pattern", "name").collect()} == {("a", "X1.txt"), ("b", None), ("c", "X1.txt")}
    n = spark.createDataFrame([("n1", "d1", "s1.md"), ("n2", None, None)], "id_norma string, id_documento string, fuente string")
    jobs = spark.createDataFrame([("s1", True), ("d1", False)], "job string, near boolean")
    assert {(r.id_norma, r.job, r.tier, r.rating) for r in norms.jobs_of_norms(n, jobs).collect()} == {("n1", "s1", 1, None), ("n2", None, None, "Sin MD")}
    rows = spark.createDataFrame([("a", None), ("b", "x"), ("c", "y"), ("d", "")], "i string, layer string")
    assert {r.i for r in norms.in_layer(rows, "x").collect()} == {"a", "b", "d"} and norms.in_layer(rows, None).count() == 4


def test_declared_constraints_and_annexes(spark):
    assert set(rules.TABLES) == {"documentos", "normas", "norma_unidades", "actores", "actor_etapas", "aristas", "metricas_ars", "fichas", "checkpoints", "audit_log"}
    links = spark.createDataFrame([(1, "a", "b", 11.0, "Formal"), (1, "a", None, None, "X")], "id int, origen string, destino string, peso double, tipo_vinculo string")
    for c, v in (("direccionalidad", "unidireccional"), ("frecuencia", "diaria"), ("canal", "oficial"), ("etapa_ciclo", "Supervisión"), ("evidencia_doc_id", None), ("fuente_doc_id", None)):
        links = links.withColumn(c, F.lit(v).cast("string"))
    actors = spark.createDataFrame([("a", "A", "Federal", "Formal", "[]", None)], "id_actor string, nombre_oficial string, nivel_gobierno string, naturaleza string, funciones_json string, fuente_documento string")
    got = {(r.table_name, r.rule): r.violations for r in norms.table_report({"aristas": links, "actores": actors}).collect()}
    assert got["aristas", "check:peso"] == 1 and got["aristas", "check:tipo_vinculo"] == 1 and got["aristas", "unique:id"] == 1
    assert got["aristas", "not_null:destino"] == 1 and got["aristas", "fk:destino"] == 1 and got["aristas", "fk:origen"] == 0
    for name in rules.ANNEXES:
        assert spark.range(1).select(norms.annex_issues(F.lit("[]"), name).alias("x")).first().x[0] == "no JSON object"
    for name in rules.VALIDATORS:
        assert rules.VALIDATORS[name]["rows"]


def test_reports_of_small_graphs(spark):
    v = spark.createDataFrame([("a",), ("b",)], "nid string")
    none = spark.createDataFrame([], "src string, dst string, weight double, kind string")
    assert tuple(norms.graph_check(v, none).first()) == (2, 0, 0, 2, 0.0)
    assert norms.sociogram_issues(v, none).first().issues == ["sin centralidad", "sin comunidades", "corpus pequeño"]
    nodes = spark.createDataFrame([("a", "A & B", None, None)], "id string, label string, level string, betweenness double")
    page = reports.sociogram_page(nodes, none).first().html
    assert "#888888" in page and "const edges=[]" in page
    assert reports.sociogram_png(nodes.limit(0), none)[:4] == b"\x89PNG"


def test_page_articles_and_styles_of_nothing(spark):
    pages = spark.createDataFrame([("d", 1, None), ("d", 2, "texto"), ("d", 3, "Artículo 3o. uno\nARTICULO 4.- dos")], "k string, page int, body string")
    assert [(r.page, r.number, r.body) for r in corpus.page_articles(pages, "k").orderBy("number").collect()] == [(3, 3, "uno"), (3, 4, "- dos")]
    cells = spark.createDataFrame([("d", 1, 1, ["", "", "x"]), ("d", 1, 2, ["y" * 501]), ("e", 1, 1, [])], "doc string, tab int, row int, cells array<string>")
    assert {(r.rule, len(r.match)) for r in style.table_findings(cells).collect()} == {("table_header", 0), ("long_cell", 100)}
    p = spark.createDataFrame([("a", None), ("a", "REFERENCIAS"), ("b", None)], "doc string, text string")
    assert [r.doc for r in style.missing_references(p).collect()] == ["b"]
    units = spark.createDataFrame([(1, "A b"), (2, "a  B."), (3, None), (4, None)], "i int, t string")
    assert (1, 2) in {(r.a, r.b) for r in match.duplicates(units, "i", "t").collect()}


def test_graph_tables_restore_kinds(spark, tmp_path):
    nodes = spark.createDataFrame([("a", ["x", "y"], True), ("b", [], False)], "nid string, layers array<string>, transversal boolean")
    edges = spark.createDataFrame([("a", "b", 2)], "src string, dst string, weight int")
    writers.graphml(nodes, edges, str(tmp_path / "g"))
    n, e = readers.graph_tables(spark, str(tmp_path / "g"))
    assert {(r.nid, tuple(r.layers), r.transversal) for r in n.collect()} == {("a", ("x", "y"), True), ("b", (), False)}
    assert tuple(e.first()) == ("a", "b", 2.0)


def test_sync_state(spark, tmp_path):
    f = spark.createDataFrame([("a",), ("b",), ("b",)], "file_id string")
    state = str(tmp_path / "s")
    assert ingest.sync(f, state, dry_run=True).count() == 3
    assert ingest.sync(f, state).count() == 3
    assert ingest.sync(f, state, forced=["a"]).count() == 1
    assert spark.read.parquet(state).count() == 2
    assert ingest.sync(f, state, reset=True).count() == 3


def test_paths_refuse_large_graphs(spark, monkeypatch):
    monkeypatch.setattr(graph, "MOST_EDGES", 1)
    links = spark.createDataFrame([(1, 2), (2, 3)], "src int, dst int")
    with pytest.raises(ValueError):
        graph.betweenness(links)
