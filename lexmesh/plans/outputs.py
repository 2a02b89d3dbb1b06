"""Registered queries that write and read back, report, check and stream, with DuckDB SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T
from lexmesh.operators import articles, graph, match, norms, records, reports
from lexmesh.plans.catalog import EDGES, ENTS, FLOW, SETS, entity_edges, flows, line_entities, query, table
from lexmesh.session import scratch_folder
from lexmesh.sources import documents, readers, writers
from lexmesh.streaming import ingest

NODES = f"{ENTS}, p AS (SELECT lower(entity) AS nid, lang, doc_id * 1000000 + section * 1000 + length(entity) AS pos FROM ents), n AS (SELECT nid, count(*) AS frequency, array_to_string(list_sort(list(DISTINCT lang)), '|') AS layers FROM p GROUP BY 1)"


def simple_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = line_entities(spark, sf_dir)
    return e.groupBy(T.node_id(F.col("entity")).alias("nid")).agg(F.count("*").alias("frequency"), F.array_sort(F.collect_set("lang")).alias("layers"))


# ------------------------------------------------------------------ files written and read again


@query(f"WITH {NODES} SELECT nid, frequency, layers FROM n")
def nodes_csv(spark, sf_dir):
    """Nodes as CSV, lists joined by a bar."""
    path = scratch_folder(spark, "nodes")
    writers.csv(simple_nodes(spark, sf_dir), path)
    return spark.read.option("header", True).schema("nid string, frequency long, layers string").csv(path)


@query("SELECT n_nationkey AS origen, n_regionkey AS destino, 1.5 AS peso, 'Formal' AS tipo_vinculo, n_name AS canal FROM nation")
def edge_list_csv(spark, sf_dir):
    """The nine-column edge list by origin and destination."""
    path = scratch_folder(spark, "edges")
    links = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("origen"), F.col("n_regionkey").alias("destino"), F.lit(1.5).alias("peso"), F.lit("Formal").alias("tipo_vinculo"), F.col("n_name").alias("canal"))
    writers.edge_list(links, path)
    schema = "origen long, destino long, peso double, tipo_vinculo string, direccionalidad string, frecuencia string, canal string, etapa_ciclo string, evidencia_doc_id string"
    return spark.read.option("header", True).schema(schema).csv(path).select("origen", "destino", "peso", "tipo_vinculo", "canal")


@query(f"WITH {FLOW} SELECT src, dst, weight, row_number() OVER (ORDER BY src, dst) AS pos FROM links")
def edges_in_order(spark, sf_dir):
    """Edges by origin and destination, with their place in a file of sorted ranges."""
    path = scratch_folder(spark, "sorted")
    writers.sorted_csv(flows(spark, sf_dir).select("src", "dst", "weight"), path, "src", "dst")
    rows = spark.read.option("header", True).schema("src long, dst long, weight long").csv(path).select("*", F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("m"))
    by_file = rows.groupBy("f").agg(F.array_sort(F.collect_list(F.struct("m", "src", "dst", "weight"))).alias("l"))
    listed = by_file.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("f", "l"))), lambda x: x["l"])).alias("l"))  # 625 edges between nations at most
    return listed.select(F.posexplode("l").alias("p", "e")).select("e.src", "e.dst", "e.weight", (F.col("p") + 1).cast("long").alias("pos"))


@query(f"WITH {FLOW}, o AS (SELECT src AS node, count(*) AS out_degree FROM links GROUP BY 1) SELECT n_nationkey AS node, n_name AS name, out_degree FROM nation LEFT JOIN o ON node = n_nationkey")
def attributes_csv(spark, sf_dir):
    """Actors with their metrics as CSV."""
    path = scratch_folder(spark, "attributes")
    d = flows(spark, sf_dir).groupBy(F.col("src").alias("node")).agg(F.count("*").alias("out_degree"))
    writers.csv(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("node"), F.col("n_name").alias("name")).join(d, "node", "left"), path)
    return spark.read.option("header", True).schema("node long, name string, out_degree long").csv(path)


@query("SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'benchmark', count(*) FROM benchmark")
def database_export(spark, sf_dir):
    """All tables that have rows, each as CSV."""
    path = scratch_folder(spark, "export")
    every = {n: table(spark, sf_dir, n) for n in ("nation", "region", "benchmark")}
    names = writers.export_all(every | {"none": table(spark, sf_dir, "region").limit(0)}, path)
    out = None
    for n in names:
        one = spark.read.option("header", True).option("multiLine", True).option("escape", "\\").csv(f"{path}/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {ENTS} SELECT doc_id % 10 AS job, lower(entity) AS entity, lang AS type, 'informal' AS layer, count(*) AS n FROM ents GROUP BY ALL")
def entity_jsonl(spark, sf_dir):
    """Entity lines of jobs, a folder for each, with the job read from the path."""
    path = scratch_folder(spark, "entities")
    e = line_entities(spark, sf_dir).select((F.col("doc_id") % 10).alias("job"), F.lower("entity").alias("entity"), F.col("lang").alias("type"), F.lit("informal").alias("layer"), F.col("section").cast("string").alias("section"))
    e.write.partitionBy("job").option("compression", "none").json(path, mode="overwrite")
    read = readers.entity_lines(spark, path, "*.json")
    return read.groupBy(F.regexp_extract("job", r"job=(\d+)", 1).cast("long").alias("job"), "entity", "type", "layer").agg(F.count("*").alias("n"))


@query("SELECT doc_id, md5(text) AS digest FROM documents WHERE text <> ''")
def whole_texts(spark, sf_dir):
    """Whole texts of files, a row each: documents written as text files and listed by name."""
    path = scratch_folder(spark, "texts")
    d = table(spark, sf_dir, "documents").where("text <> ''").select(F.concat(F.lit("d"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("name"), F.base64(F.encode("text", "utf-8")).alias("text"))
    writers.save_texts(d, path)
    t = readers.whole_texts(spark, path, "*.txt")
    return t.select(F.regexp_extract("path", r"[/=]d(-?\d*)\.\d+(?:/[^/]*|\.txt)$", 1).try_cast("long").alias("doc_id"), F.md5(F.unbase64(F.regexp_replace("text", r"\s", ""))).alias("digest"))


@query("SELECT entry, row_number() OVER (ORDER BY length(entry) DESC, entry) AS pos FROM (SELECT DISTINCT n_name AS entry FROM nation UNION SELECT r_name FROM region)")
def dictionary_order(spark, sf_dir):
    """A catalogue's lines without comments and repeats, longest first."""
    path = scratch_folder(spark, "dictionary")
    names = table(spark, sf_dir, "nation").select("n_name").union(table(spark, sf_dir, "region").select("r_name"))
    lines = names.union(names.limit(3)).select(F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("value")).union(spark.createDataFrame([("# catálogo",), ("",), ("   ",)], "value string"))
    lines.write.text(path)
    # a person has written the catalogue, so it is small: its rows are numbered in the order they come in
    return readers.dictionary(spark, path).coalesce(1).select("entry", (F.monotonically_increasing_id() + 1).alias("pos"))


@query("SELECT 'd' || n_nationkey || '.pdf' AS name, octet_length(encode(n_name))::BIGINT AS size, substr(sha256(n_name), 1, 16) AS sha FROM nation")
def file_manifest(spark, sf_dir):
    """Names, sizes and hashes of the files below a folder: one for each nation."""
    path = scratch_folder(spark, "manifest")
    for r in table(spark, sf_dir, "nation").collect():  # 25 nations
        writers.save_bytes(spark, f"{path}/{r.n_regionkey}/d{r.n_nationkey}.pdf", r.n_name.encode())
    return readers.manifest(spark, path).select("name", "size", "sha")


@query("SELECT 'j' || n_regionkey AS job, count(*) AS n, max(n_nationkey) AS top FROM nation GROUP BY 1")
def job_sidecars(spark, sf_dir):
    """JSON side files of jobs."""
    path = scratch_folder(spark, "sidecars")
    by = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count("*").alias("n"), F.max("n_nationkey").alias("top"))
    for r in by.collect():  # five regions
        writers.save_bytes(spark, f"{path}/j{r.n_regionkey}/x.meta.json", f'{{\n "n": {r.n},\n "top": {r.top}\n}}'.encode())
    return readers.sidecars(spark, path, "*.meta.json", "n long, top long").select("job", "n", "top")


@query("SELECT n_regionkey AS doc, n_nationkey AS id, n_name AS name FROM nation")
def markdown_tables(spark, sf_dir):
    """Pipe tables of Markdown texts, read back as rows."""
    rows = table(spark, sf_dir, "nation").select("n_regionkey", F.concat_ws(" | ", F.lit(""), F.col("n_nationkey").cast("string"), "n_name", F.lit("")).alias("l"))
    docs = rows.groupBy(F.col("n_regionkey").alias("doc")).agg(F.concat(F.lit("texto\n| id | name |\n|---|:--|\n"), F.array_join(F.transform(F.collect_list("l"), F.trim), "\n")).alias("t"))
    cells = readers.table_rows(docs, "doc", "t").where("cells[0] <> 'id'")
    return cells.select("doc", F.get("cells", F.lit(0)).cast("long").alias("id"), F.get("cells", F.lit(1)).alias("name"))


@query("SELECT page_id, 'Título ' || page_id AS title, CASE WHEN page_id % 2 = 0 THEN 'Pérez' ELSE '' END AS author FROM pages")
def html_metadata(spark, sf_dir):
    """Meta tags of pages, with citation tags put in front of each page's own."""
    head = F.concat(F.lit('<meta name="citation_title" content="Título '), F.col("page_id").cast("string"), F.lit('">'), F.when(F.col("page_id") % 2 == 0, '<meta name="citation_author" content="Pérez">').otherwise(""))
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(head, "html").alias("h"))
    return p.select("page_id", readers.html_meta(F.col("h"), "citation_title").alias("title"), readers.html_meta(F.col("h"), "citation_author").alias("author"))


@query(f"WITH {EDGES}, n AS (SELECT count(DISTINCT nid) AS n FROM sets), m AS (SELECT count(*) AS m FROM edges) SELECT n AS nodos, m AS aristas, round(2 * m / (n * (n - 1)), 4) AS densidad, (SELECT count(*) FROM documents) AS corpus_size, NULL AS advertencia FROM n, m")
def metrics_json(spark, sf_dir):
    """The metrics document, written as one JSON file and read back."""
    path = scratch_folder(spark, "metrics")
    e, links = line_entities(spark, sf_dir), entity_edges(spark, sf_dir)
    ids = e.select(F.lower("entity").alias("nid"), F.col("lang").alias("layer")).distinct()
    top = graph.degree_centrality(links).orderBy(F.desc("degree"), "node").limit(10).select(F.col("node").alias("nodo"), F.col("centrality").alias("valor"))
    writers.json_document(reports.metrics_document(table(spark, sf_dir, "documents"), graph.density(links, ids.select("nid").distinct()), top, graph.density_by_layer(links, ids)), path)
    read = readers.json_file(spark, path, "nodos_totales long, aristas_totales long, densidad double, corpus_size long, advertencia_corpus_pequeno string")
    return read.select(F.col("nodos_totales").alias("nodos"), F.col("aristas_totales").alias("aristas"), "densidad", "corpus_size", F.col("advertencia_corpus_pequeno").alias("advertencia"))


@query(f"WITH {NODES}, x AS ({'WITH ' + EDGES + ' SELECT src, dst, weight FROM edges'}) SELECT 'node' AS kind, nid AS a, layers AS b, frequency::DOUBLE AS x, contains(layers, '|') AS flag FROM n UNION ALL SELECT 'edge', src, dst, weight::DOUBLE, weight > 1 FROM x")
def graphml_roundtrip(spark, sf_dir):
    """A graph written as GraphML and read back, with lists, flags and numbers restored."""
    path = scratch_folder(spark, "graphml")
    nodes = simple_nodes(spark, sf_dir).withColumn("transversal", F.size("layers") > 1)
    writers.graphml(nodes, entity_edges(spark, sf_dir).withColumn("transversal", F.col("weight") > 1), path)
    n, e = readers.graph_tables(spark, path)
    n = n.select(F.lit("node").alias("kind"), F.col("nid").alias("a"), F.array_join("layers", "|").alias("b"), F.col("frequency").alias("x"), F.col("transversal").alias("flag"))
    return n.unionByName(e.select(F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), F.col("weight").alias("x"), F.col("transversal").alias("flag")))


@query("SELECT n_nationkey AS id, n_name AS name, kind FROM nation, (VALUES ('docx'), ('xlsx')) v(kind)")
def office_reports(spark, sf_dir):
    """A table as DOCX and as XLSX, read back."""
    path = scratch_folder(spark, "office")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    for kind in ("docx", "xlsx"):
        writers.report(nation, f"{path}/r.{kind}", "Países")
    both = documents.cells(spark, path, "*.docx", documents.docx_rows).unionByName(documents.cells(spark, path, "*.xlsx"))
    return both.where("row > 0").select(F.get("cells", F.lit(0)).cast("long").alias("id"), F.get("cells", F.lit(1)).alias("name"), F.element_at(F.split("path", r"\."), -1).alias("kind"))


@query("SELECT 'r' || n_regionkey || '.pdf' AS file, n_nationkey % 2 + 1 AS page, n_name AS text, CASE WHEN n_nationkey % 3 = 0 THEN 20.0 ELSE 10.0 END AS size FROM nation UNION ALL SELECT 'vacio.pdf', 1, 'respaldo', 0.0")
def pdf_blocks(spark, sf_dir):
    """Text blocks of PDF files; a file without text goes to the fallback."""
    path = scratch_folder(spark, "pdf")
    lines: dict[int, list[list[tuple[str, float]]]] = {}
    for r in table(spark, sf_dir, "nation").collect():  # 25 nations
        lines.setdefault(r.n_regionkey, [[], []])[r.n_nationkey % 2].append((r.n_name, 20.0 if r.n_nationkey % 3 == 0 else 10.0))
    for region, pages in lines.items():
        writers.save_bytes(spark, f"{path}/r{region}.pdf", writers.pdf(pages))
    writers.save_bytes(spark, f"{path}/vacio.pdf", writers.pdf([[]]))
    found = documents.blocks(spark, path, fallback=_scanned)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "page", "text", F.col("max_font_size").alias("size"))


def _scanned(_: bytes) -> Iterator[documents.Block]:
    """Stands for character recognition."""
    yield 1, "respaldo", 0.0, []


def numbered_pages(folder: str, token: str | None) -> tuple[list[dict], str | None]:
    """Stands for a remote folder: 12 files by fives, and in the first page a subfolder with two files."""
    if folder.endswith("/sub"):
        return [{"id": f"{folder}/{i}", "name": f"{i}.pdf", "size": i} for i in range(2)], None
    first = int(token or 0)
    entries = [{"id": f"{folder}/{i}", "name": f"{i}.pdf", "mime": "application/pdf", "size": i} for i in range(first, min(first + 5, 12))]
    if not first:
        entries.append({"id": f"{folder}/sub", "name": "sub", "folder": True})
    return entries, str(first + 5) if first + 5 < 12 else None


@query("SELECT r_regionkey::VARCHAR || s AS folder, r_regionkey::VARCHAR || s || '/' || i AS id, i AS size FROM region, (SELECT '' AS s, unnest(range(12)) AS i UNION ALL SELECT '/sub', unnest(range(2)))")
def paged_listing(spark, sf_dir):
    """Files of remote folders, page by page."""
    folders = ",".join(str(r.r_regionkey) for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect())
    spark.dataSource.register(documents.PagedListing)
    listed = spark.read.format("paged_listing").option("client", "lexmesh.plans.outputs:numbered_pages").option("folders", folders).load()
    return listed.select("folder", "id", "size")


# ------------------------------------------------------------------ reports


@query("SELECT pos, line FROM (SELECT 29 AS pos, '- Documentos ingestados: **' || count(*) || '**' AS line FROM documents UNION ALL SELECT 30, '- Normas procesadas: **' || count(*) || '**' FROM pages UNION ALL SELECT 31, '- Unidades normativas extraídas: **' || count(*) || '**' FROM conversations UNION ALL SELECT 32, '- Actores en directorio preliminar: **' || count(*) || '**' FROM supplier) UNION ALL SELECT 0, '# Anexo 1 — Ficha Técnica del FASP' UNION ALL SELECT 2, '**ID de ficha:** FASP-2026-EV1  '")
def annex_1(spark, sf_dir):
    """Head and counts of annex 1, in which tables stand for those of a pipeline."""
    n = lambda t, c: table(spark, sf_dir, t).agg(F.count("*").alias(c))
    counts = n("documents", "documentos").crossJoin(n("pages", "normas")).crossJoin(n("conversations", "norma_unidades")).crossJoin(n("supplier", "actores"))
    return reports.annex_1(counts, "EV1", 2026, "2026-01-31", "Coordinadora").where("pos in (0, 2) or pos >= 29")


@query("SELECT '- `' || t || '`: ' || n || ' filas' AS line FROM (SELECT 'documents' AS t, count(*) AS n FROM documents UNION ALL SELECT 'events', count(*) FROM events) UNION ALL SELECT '### Tablas exportadas (formato CSV)'")
def annex_8(spark, sf_dir):
    """The tables of annex 8 with their counts."""
    counts = table(spark, sf_dir, "documents").agg(F.lit("documents").alias("table_name"), F.count("*").alias("n")).unionByName(table(spark, sf_dir, "events").agg(F.lit("events").alias("table_name"), F.count("*").alias("n")))
    return reports.annex_8(counts, "1.0", "2026-01-31").where("pos = 7 or pos > 8").select("line")


@query(f"WITH {EDGES}, n AS (SELECT count(DISTINCT nid) AS n FROM sets), m AS (SELECT count(*) AS m FROM edges) SELECT '- **n_nodes:** ' || n AS line FROM n UNION ALL SELECT '- **n_edges:** ' || m FROM m UNION ALL SELECT '### grado (v1)'")
def annex_5(spark, sf_dir):
    """Algorithms and metrics of annex 5."""
    e = line_entities(spark, sf_dir)
    d = graph.density(entity_edges(spark, sf_dir), e.select(F.lower("entity")).distinct()).select("n_nodes", "n_edges")
    return reports.annex_5(d, [("grado", "1", "centralidad", {"normalizado": True})], "1.0", "2026-01-31").where("line like '- **n!_%' escape '!' or line like '###%'").select("line")


OUTCOME = "CASE item_id % 3 WHEN 0 THEN 'MANTENER' WHEN 1 THEN 'FALTANTE' ELSE 'REVISAR' END"
CATEGORY = "CASE conv_id % 3 WHEN 0 THEN 'EN_GUARDARRIEL' WHEN 1 THEN 'FASP_FUERA_GUARDARRIEL' ELSE 'EXCLUIR' END"


@query(f"WITH g AS (SELECT item_id, text, {OUTCOME} AS o FROM benchmark), e AS (SELECT DISTINCT conv_id, {CATEGORY} AS c FROM conversations) SELECT 0 AS part, '  - MANTENER: ' || count(*) FILTER (o = 'MANTENER') AS line FROM g UNION ALL SELECT 0, '  - FALTANTE (no en corpus): ' || count(*) FILTER (o = 'FALTANTE') FROM g UNION ALL SELECT 0, '  - EXCLUIR: ' || count(*) FILTER (c = 'EXCLUIR') FROM e UNION ALL SELECT 1, '| Apartado | Núm | Norma | Categoría |' UNION ALL SELECT 1, '| A | ' || item_id || ' | ' || substr(text, 1, 60) || ' | ' || o || ' |' FROM g UNION ALL SELECT 2, '| Ley | Categoria |' UNION ALL SELECT 2, '| Ley ' || lpad(conv_id::VARCHAR, 9, '0') || ' | ' || c || ' |' FROM (SELECT * FROM e WHERE c <> 'EN_GUARDARRIEL' ORDER BY conv_id LIMIT 30)")
def delimitation_report(spark, sf_dir):
    """Summary, guarded norms and other laws (30, a report's limit) of a delimitation."""
    g = table(spark, sf_dir, "benchmark").select(F.lit("A").alias("section"), F.col("item_id").alias("num"), F.col("text").alias("norm"), F.expr(OUTCOME).alias("outcome"))
    e = table(spark, sf_dir, "conversations").select("conv_id").distinct().select(F.concat(F.lit("Ley "), F.lpad(F.col("conv_id").cast("string"), 9, "0")).alias("name"), F.expr(CATEGORY).alias("category"))
    r = reports.delimitation_report(g, e, 0, "MEX")
    return r.where("part > 0 or line like '  - MANTENER%' or line like '  - FALTANTE%' or line like '  - EXCLUIR%'").select("part", "line")


@query(f"WITH {EDGES}, ends AS (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges), deg AS (SELECT node, count(*) AS degree FROM ends GROUP BY 1), top AS (SELECT node, degree, row_number() OVER (ORDER BY round(degree / greatest((SELECT count(*) FROM deg) - 1, 1), 4) DESC, node) AS n FROM deg) SELECT n, node, degree::VARCHAR AS degree FROM top WHERE n <= 30")
def html_top_nodes(spark, sf_dir):
    """The page of a graph with its 30 most central nodes (a report's limit), read back from the page."""
    links = entity_edges(spark, sf_dir)
    nodes = graph.degree_centrality(links)
    page = reports.graph_page(nodes, graph.density(links, nodes.select("node")))
    rows = page.select(F.posexplode(F.regexp_extract_all("html", F.lit("<tr><td>(.*?)</tr>"), F.lit(1))).alias("i", "r"))
    cells = F.split("r", "</td>(?:<td>)?")
    return rows.select((F.col("i") + 1).cast("long").alias("n"), F.get(cells, F.lit(0)).alias("node"), F.get(cells, F.lit(1)).alias("degree"))


LEVEL = "CASE n_regionkey WHEN 0 THEN 'Federal' WHEN 1 THEN 'Estatal' WHEN 2 THEN 'Municipal' END"


@query("SELECT n_name AS label, CASE n_regionkey WHEN 0 THEN '#1a4480' WHEN 1 THEN '#7a3e9d' WHEN 2 THEN '#b5651d' ELSE '#888888' END AS colour, round(200 + 3000 * n_nationkey / 100, 2)::DOUBLE AS size FROM nation")
def sociogram_nodes(spark, sf_dir):
    """Nodes of a sociogram, read back from its page: size by betweenness, colour by level."""
    nodes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("label"), F.expr(LEVEL).alias("level"), (F.col("n_nationkey") / 100).alias("betweenness"))
    links = flows(spark, sf_dir).select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"), "weight", F.lit("Formal").alias("kind"))
    page = reports.sociogram_page(nodes, links)
    found = page.select(F.explode(F.from_json(F.concat(F.lit("["), F.regexp_extract("html", r"const nodes=\[(.*?)\];", 1), F.lit("]")), "array<struct<label: string, color: string, size: double>>")).alias("n"))
    return found.select("n.label", F.col("n.color").alias("colour"), "n.size")


@query("SELECT 800 AS width, 800 AS height, 3 AS n_channels, true AS drawn")
def sociogram_picture(spark, sf_dir):
    """The sociogram as a picture, read back: its size, and that the colours of the levels are in it."""
    path = scratch_folder(spark, "picture")
    nodes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.expr(LEVEL).alias("level"), (F.col("n_nationkey") / 100).alias("betweenness"))
    links = flows(spark, sf_dir).select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"), "weight")
    writers.save_bytes(spark, f"{path}/s.png", reports.sociogram_png(nodes, links))
    image = spark.read.format("image").load(path).select("image.*")
    has = lambda r, g, b: F.instr(F.hex("data"), f"{b:02X}{g:02X}{r:02X}" * 3) > 0
    return image.select("width", "height", F.col("nChannels").alias("n_channels"), (has(0x1A, 0x44, 0x80) & has(0x99, 0x99, 0x99)).alias("drawn"))


@query(f"WITH {FLOW} SELECT src, dst, weight, round(0.5 + 2.5 * weight / 10, 2)::DOUBLE AS width FROM links")
def edge_widths(spark, sf_dir):
    return norms.styled_edges(flows(spark, sf_dir)).select("src", "dst", "weight", "width")


@query("SELECT 3 AS n_tables, count(*) + 2 + least(20, (SELECT count(*) FROM events)) AS n_rows FROM nation")
def dashboard(spark, sf_dir):
    """Tables and rows of the dashboard's page."""
    counts = table(spark, sf_dir, "region").agg(F.lit("region").alias("table_name"), F.count("*").alias("n")).unionByName(table(spark, sf_dir, "nation").agg(F.lit("nation").alias("table_name"), F.count("*").alias("n")))
    quality = table(spark, sf_dir, "nation").select(F.col("n_name").alias("norm"), F.col("n_nationkey").cast("double").alias("score"), records.rating(F.col("n_nationkey")).alias("rating"))
    page = reports.dashboard_page(counts, quality, table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type"))
    return page.select(F.regexp_count("html", F.lit("<table>")).alias("n_tables"), F.regexp_count("html", F.lit("<tr><td>")).cast("long").alias("n_rows"))


# ------------------------------------------------------------------ blocks, tables and totals


BLOCK = "CASE turn % 4 WHEN 0 THEN upper('titulo corto') WHEN 1 THEN 'Titulo Corto' WHEN 2 THEN '1) ' || role ELSE text END"
SIZE = "CASE WHEN turn % 4 = 0 THEN 10.0 WHEN turn % 8 = 1 THEN 12.0 WHEN turn % 8 = 5 THEN 15.0 ELSE 9.0 END"
MARKED = "CASE WHEN turn % 4 = 0 THEN chr(10) || '# TITULO CORTO' || chr(10) WHEN turn % 8 = 1 THEN chr(10) || '### Titulo Corto' || chr(10) WHEN turn % 8 = 5 THEN chr(10) || '## Titulo Corto' || chr(10) WHEN turn % 4 = 2 THEN '1. ' || role ELSE regexp_replace(text, '^\\s+|\\s+$', '', 'g') || chr(10) END"


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(BLOCK).alias("text"), F.expr(SIZE).cast("double").alias("size"), (F.floor(F.col("turn") / 3) + 1).alias("page"))


@query("SELECT conv_id, turn, CASE WHEN turn % 4 = 0 THEN 1 WHEN turn % 8 = 1 THEN 3 WHEN turn % 8 = 5 THEN 2 WHEN turn % 4 = 3 AND text = upper(text) AND text <> lower(text) AND n < 20 THEN CASE WHEN n < 12 THEN 1 ELSE 2 END ELSE 0 END AS level FROM (SELECT *, len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) AS n FROM conversations)")
def heading_levels(spark, sf_dir):
    """Heading levels by size, capitals and words, of blocks of known kinds and of the turns' texts."""
    return blocks(spark, sf_dir).select("conv_id", "turn", records.heading_level(F.col("text"), F.col("size")).alias("level"))


@query(f"SELECT conv_id, md5(string_agg({MARKED}, chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY 1")
def blocks_markdown(spark, sf_dir):
    """Blocks as Markdown: headings, items, paragraphs."""
    b = blocks(spark, sf_dir).withColumn("size", F.when(F.col("turn") % 4 == 3, 0.0).otherwise(F.col("size")))
    return records.blocks_to_markdown(b, "conv_id", "turn").select("conv_id", F.md5(F.col("md").cast("binary")).alias("digest"))


@query("SELECT conv_id, max(turn // 3 + 1) AS pages, count(*) AS blocks FROM conversations GROUP BY 1")
def page_extent(spark, sf_dir):
    return norms.extent(blocks(spark, sf_dir), "conv_id")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'no_heading_at_start' END AS a, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'no_inner_heading' END AS b, CASE WHEN doc_id % 5 = 0 THEN 'PRESUPUESTO' ELSE '' END AS missing FROM documents")
def conversion_report(spark, sf_dir):
    """What is wrong with a conversion, and the longest capital words that it lost."""
    source = F.concat(F.lit("ARTÍCULO PRESUPUESTO uno "), F.lower("text"))
    md = F.concat(F.when(F.col("doc_id") % 3 == 0, "# T ").otherwise("T "), F.regexp_replace(F.lower("text"), "\n#", "\n"), F.when(F.col("doc_id") % 2 == 0, "\n# x").otherwise(""), F.lit(" uno ARTÍCULO "), F.when(F.col("doc_id") % 5 != 0, "PRESUPUESTO").otherwise("p"))
    d = table(spark, sf_dir, "documents").select("doc_id", source.alias("s"), md.alias("m")).select("doc_id", records.conversion_issues(F.col("m"), F.col("s")).alias("i"), records.missing_caps(F.col("m"), F.col("s")).alias("c"))
    pick = lambda k: F.when(F.array_contains("i", k), k).otherwise("")
    return d.select("doc_id", pick("no_heading_at_start").alias("a"), pick("no_inner_heading").alias("b"), F.array_join("c", ",").alias("missing"))


@query("SELECT conv_id, turn, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS digest FROM conversations")
def clean_responses(spark, sf_dir):
    """Responses without their reasoning and fences."""
    c = table(spark, sf_dir, "conversations")
    wrapped = F.concat(F.lit("<think>no\nesto</think>\n```md\n"), "text", F.lit("\n```\n"))
    return c.select("conv_id", "turn", F.md5(articles.cleaned_response(wrapped).cast("binary")).alias("digest"))


@query("WITH l AS (SELECT conv_id, turn, turn % 4 < 2 AS p FROM conversations), r AS (SELECT *, sum((p AND NOT coalesce(b, false))::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(p) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM l)) SELECT conv_id, run::BIGINT AS run, min(turn) AS first, max(turn) AS last, count(*) AS rows FROM r WHERE p GROUP BY 1, 2")
def table_runs(spark, sf_dir):
    """Runs of consecutive table lines, numbered."""
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 4 < 2, "| a |").otherwise(F.concat(F.lit("x"), "text")).alias("line"))
    r = articles.table_runs(lines, "conv_id", "turn", "line")
    return r.select("conv_id", F.col("run").cast("long").alias("run"), "first", "last", "rows")


@query("SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events")
def sequence_numbers(spark, sf_dir):
    return records.sequence(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), ("user_id", "event_type"), "event_id")


@query("WITH f AS (SELECT user_id AS src, event_type AS dst, event_id AS id, value AS weight FROM events) SELECT src, dst, arg_max(weight, id) AS weight FROM f GROUP BY 1, 2")
def last_edges(spark, sf_dir):
    """Of repeated edges the last."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("src"), F.col("event_type").alias("dst"), F.col("event_id").alias("id"), F.col("value").alias("weight"))
    return graph.last_edges(e).select("src", "dst", "weight")


@query("SELECT coalesce(CASE WHEN n_regionkey < 3 THEN ['Federal', 'Estatal', 'Municipal'][n_regionkey + 1] END, 'Desconocido') AS level, count(*) AS n FROM nation GROUP BY 1")
def nodes_by_level(spark, sf_dir):
    return norms.counts_by(table(spark, sf_dir, "nation").select(F.expr(LEVEL).alias("level")), "level")


@query(f"SELECT outcome, count(*) AS n FROM (SELECT {OUTCOME} AS outcome FROM benchmark) GROUP BY 1")
def class_counts(spark, sf_dir):
    return norms.counts_by(table(spark, sf_dir, "benchmark").select(F.expr(OUTCOME).alias("outcome")), "outcome")


@query("SELECT event_type AS kind, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 4) AS share FROM events GROUP BY 1")
def link_types(spark, sf_dir):
    return norms.link_types(table(spark, sf_dir, "events").select(F.col("event_type").alias("kind")), "kind")


@query("SELECT lang AS state, count(*) FILTER (doc_id % 4 = 0) AS nuevos, count(*) FILTER (doc_id % 4 = 1) AS ya_vistos, count(*) FILTER (doc_id % 4 = 2) AS errores, count(*) FILTER (doc_id % 4 = 3) AS omitidos FROM documents GROUP BY ROLLUP (lang)")
def sync_totals(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("state"), *((F.col("doc_id") % 4 == i).cast("int").alias(c) for i, c in enumerate(("nuevos", "ya_vistos", "errores", "omitidos"))))
    return norms.sync_totals(d)


@query("WITH j AS (SELECT source, CASE WHEN bool_or(n_chars < 100) THEN 'fail' WHEN bool_or(n_chars < 500) THEN 'warn' ELSE 'OK' END AS s FROM documents GROUP BY 1) SELECT count(*) FILTER (s = 'OK') AS ok, count(*) FILTER (s = 'warn') AS warn, count(*) FILTER (s = 'fail') AS fail FROM j")
def status_totals(spark, sf_dir):
    """Jobs that are fine, that warn, and that fail."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("job"), F.when(F.col("n_chars") < 100, True).when(F.col("n_chars") < 500, False).alias("severe"))
    return norms.status_totals(records.job_status(d))


@query("SELECT a.item_id AS a, b.item_id AS b FROM benchmark a JOIN benchmark b ON a.text = b.text AND a.item_id < b.item_id UNION SELECT item_id, item_id + 1000000 FROM benchmark WHERE item_id % 2 = 0")
def duplicate_units(spark, sf_dir):
    """Units with the same words, in pairs with the first of them."""
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    again = b.where("item_id % 2 = 0").select((F.col("item_id") + 1000000).alias("item_id"), F.upper("text").alias("text"))
    return match.duplicates(b.unionByName(again), "item_id", "text")


# ------------------------------------------------------------------ checks


@query("SELECT 'actores' AS table_name, 'check:naturaleza' AS rule, count(*) FILTER (n_nationkey % 4 = 0) AS violations FROM nation UNION ALL SELECT 'actores', 'check:nivel_gobierno', 0 UNION ALL SELECT 'actores', 'not_null:' || c, CASE WHEN c = 'funciones_json' THEN (SELECT count(*) FROM nation WHERE n_nationkey % 5 = 0) ELSE 0 END FROM (VALUES ('id_actor'), ('nombre_oficial'), ('nivel_gobierno'), ('naturaleza'), ('funciones_json')) v(c) UNION ALL SELECT 'actores', 'unique:id_actor', 0 UNION ALL SELECT 'actor_etapas', r, n FROM (VALUES ('not_null:id_actor', 0), ('not_null:etapa_ciclo', 0), ('unique:id_actor,etapa_ciclo', 0), ('check:etapa_ciclo', (SELECT count(*) FROM region WHERE r_regionkey % 2 = 1)), ('fk:id_actor', 0)) v(r, n)")
def table_constraints(spark, sf_dir):
    """Declared constraints of two tables, references included."""
    actors = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id_actor"), F.col("n_name").alias("nombre_oficial"), F.lit("Federal").alias("nivel_gobierno"), F.when(F.col("n_nationkey") % 4 == 0, "Mixta").otherwise("Formal").alias("naturaleza"), F.when(F.col("n_nationkey") % 5 != 0, "[]").alias("funciones_json"))
    stages = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("id_actor"), F.when(F.col("r_regionkey") % 2 == 0, "Supervisión").otherwise("Otra").alias("etapa_ciclo"))
    return norms.table_report({"actores": actors, "actor_etapas": stages})


@query("SELECT page_id, field, value FROM (SELECT page_id, 'categoria_tematica' AS field, 'Otra' AS value FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT page_id, 'viabilidad_claridad', '9' FROM pages WHERE page_id % 4 = 0)")
def taxonomy_validators(spark, sf_dir):
    """A validator's lists and ranges over rows."""
    p = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, "Otra").otherwise("Normativo").alias("categoria_tematica"), F.when(F.col("page_id") % 2 == 0, "Alta").alias("prioridad"), F.when(F.col("page_id") % 4 == 0, 9).otherwise(3).alias("viabilidad_claridad"), *(F.lit(5).alias(f"viabilidad_{k}") for k in ("relevancia", "justificacion", "factibilidad")))
    return norms.validator_issues(p, "page_id", "fichas_hallazgos")


@query("SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'stage Otra' ELSE '' END AS issues FROM pages")
def stage_lists(spark, sf_dir):
    """A validator's list fields."""
    p = table(spark, sf_dir, "pages").select("page_id", F.lit("Federal").alias("nivel_gobierno"), F.lit(None).cast("string").alias("naturaleza"), F.when(F.col("page_id") % 5 == 0, F.array(F.lit("Otra"), F.lit("Supervisión"))).when(F.col("page_id") % 5 == 1, F.array(F.lit("Integración"))).alias("etapas_ciclo_participa"))
    found = norms.validator_issues(p, "page_id", "directorio_actores").select("page_id", F.concat(F.lit("stage "), "value").alias("i"))
    return p.select("page_id").join(found, "page_id", "left").select("page_id", F.coalesce("i", F.lit("")).alias("issues"))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'fichas 0: missing verbo' WHEN 2 THEN 'fichas 0: prioridad not in its list;fichas 1: id_ficha has another form' ELSE 'missing fichas' END AS issues FROM pages")
def annex_schemas(spark, sf_dir):
    """Issues of an annex and of its rows."""
    row = lambda i, p, verb: '{"id_ficha":"' + i + '",' + ('"verbo":"Crear",' if verb else "") + '"producto_proceso":"x","area_oportunidad":"x","justificacion":"x","efecto_esperado":"x","prioridad":"' + p + '"}'
    texts = ['{"fichas":[' + row("FCH-1", "Alta", True) + "]}", '{"fichas":[' + row("FCH-1", "Alta", False) + "]}", '{"fichas":[' + row("FCH-1", "Otra", True) + "," + row("X", "Baja", True) + "]}", '{"otra":1}']
    p = table(spark, sf_dir, "pages").select("page_id", F.element_at(F.array(*map(F.lit, texts)), (F.col("page_id") % 4 + 1).cast("int")).alias("j"))
    return p.select("page_id", F.array_join(norms.annex_issues(F.col("j"), "anexo10"), ";").alias("issues"))


@query("SELECT event_id AS id, 'etapa_1_documental' AS etapa, 'analista_senior_redes' AS perfil FROM events WHERE event_id % 6 = 0")
def gate_profiles(spark, sf_dir):
    """Checkpoints of profiles that their stage doesn't have."""
    c = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 2 == 0, "etapa_1_documental").otherwise("etapa_2_campo_ars").alias("etapa"), F.when(F.col("event_id") % 3 == 0, "analista_senior_redes").otherwise("coordinadora").alias("perfil"))
    return norms.profile_issues(c)


GATE_VALUES = ", ".join(f"({i}, '{s}', '{p}', '{t}')" for i, (s, p, t) in enumerate(rules.GATES))


@query(f"WITH g(i, etapa, perfil, texto) AS (VALUES {GATE_VALUES}), e AS (SELECT event_id % 12 AS i, arg_max(CASE WHEN value > 50 THEN 'aprobado' ELSE 'rechazado' END, event_id) AS d FROM events GROUP BY 1) SELECT etapa, perfil, texto, coalesce(d, 'nunca_registrado') AS state FROM g LEFT JOIN e USING (i) WHERE d IS NULL OR d <> 'aprobado'")
def expected_gates(spark, sf_dir):
    """All expected gates whose last decision is missing or no approval."""
    gates = spark.createDataFrame([(i, *g) for i, g in enumerate(rules.GATES)], "i long, etapa string, perfil string, texto string")
    e = table(spark, sf_dir, "events").select((F.col("event_id") % 12).alias("i"), F.col("event_id").alias("id"), F.when(F.col("value") > 50, "aprobado").otherwise("rechazado").alias("decision"))
    found = records.pending(gates.select("i"), e, ("i",))
    return gates.join(found, "i").select("etapa", "perfil", "texto", "state")


@query(f"WITH g(i, etapa, perfil, texto) AS (VALUES {GATE_VALUES}) SELECT etapa, count(*) AS n FROM g GROUP BY ROLLUP (etapa)")
def gates_by_stage(spark, sf_dir):
    return spark.createDataFrame(rules.GATES, "etapa string, perfil string, texto string").rollup("etapa").agg(F.count("*").alias("n"))


@query("SELECT source AS etapa, CASE WHEN bool_or(doc_id % 7 = 0) THEN 'fuera de taxonomía,' ELSE '' END || CASE WHEN bool_or(n_chars < 200) THEN 'cobertura baja' ELSE '' END AS blockers FROM documents GROUP BY 1")
def closing_blockers(spark, sf_dir):
    """Which conditions keep a stage open."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("etapa"), (F.col("doc_id") % 7 == 0).cast("int").alias("violations"), F.when(F.col("n_chars") < 200, 0.5).otherwise(0.9).alias("coverage"), F.lit(0).alias("annex_issues"), F.lit(9).alias("n_nodes"), F.lit(0).alias("open_gates"))
    b = norms.closing_blockers(d)
    has = lambda k: F.array_contains("blockers", k)
    return b.select("etapa", F.concat(F.when(has("fuera de taxonomía"), "fuera de taxonomía,").otherwise(""), F.when(has("cobertura baja"), "cobertura baja").otherwise("")).alias("blockers"))


@query(f"WITH {SETS}, {FLOW} SELECT n, m, issues FROM (SELECT (SELECT count(DISTINCT nid) FROM sets) AS n, (SELECT count(*) FROM links) AS m, '' AS issues) UNION ALL SELECT count(*), 0, 'corpus pequeño' FROM region")
def sociogram_minimums(spark, sf_dir):
    """Whether graphs are large enough for their metrics: the entities, and five regions without links."""
    ids = line_entities(spark, sf_dir).select(F.lower("entity").alias("nid")).distinct()
    f = flows(spark, sf_dir)
    both = norms.sociogram_issues(ids, f).unionByName(norms.sociogram_issues(table(spark, sf_dir, "region"), f.limit(0)))
    return both.select(F.col("n_nodes").alias("n"), F.col("n_edges").alias("m"), F.array_join("issues", ",").alias("issues"))


@query("SELECT count(*) AS corpus_size, NULL AS warning FROM documents UNION ALL SELECT 3, 'Corpus tiene 3 docs; análisis de redes no es robusto con < 5.'")
def small_corpus(spark, sf_dir):
    """The warning of a small corpus: none for the documents, one for three."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return norms.small_corpus(d).unionByName(norms.small_corpus(spark.range(3)))


@query(f"WITH {FLOW}, v AS (SELECT n_nationkey AS i FROM nation WHERE n_regionkey > 0) SELECT (SELECT count(*) FROM v) AS n_nodes, count(*) AS n_edges, count(*) FILTER (src NOT IN (SELECT i FROM v) OR dst NOT IN (SELECT i FROM v)) AS n_lost, (SELECT count(*) FROM v WHERE i NOT IN (SELECT src FROM links UNION SELECT dst FROM links)) AS n_isolated, round(2 * count(*) / ((SELECT count(*) FROM v) * ((SELECT count(*) FROM v) - 1)), 6) AS density FROM links")
def graph_file_check(spark, sf_dir):
    """What a graph of four regions holds, edges to nodes that it lacks, and nodes without edges."""
    v = table(spark, sf_dir, "nation").where("n_regionkey > 0").select(F.col("n_nationkey").alias("nid"))
    return norms.graph_check(v, flows(spark, sf_dir))


@query("SELECT event_id, user_id, row_number() OVER (ORDER BY event_id DESC) AS pos FROM events ORDER BY event_id DESC LIMIT 30")
def checkpoints_listed(spark, sf_dir):
    """Checkpoints from the last on, the 30 that a report shows."""
    last = table(spark, sf_dir, "events").select("event_id", "user_id").orderBy(F.desc("event_id")).limit(30)
    return last.agg(F.sort_array(F.collect_list(F.struct("event_id", "user_id")), False).alias("l")).select(F.posexplode("l").alias("p", "e")).select("e.event_id", "e.user_id", (F.col("p") + 1).cast("long").alias("pos"))


# ------------------------------------------------------------------ streams


def _replayed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, str]:
    """(stream, target, checkpoint): the events as a stream of files in the order of time."""
    folder = scratch_folder(spark, "stream")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartitionByRange(4, "event_id").write.parquet(f"{folder}/in")
    return ingest.file_stream(spark, f"{folder}/in", events.schema, 2), f"{folder}/out", f"{folder}/state"


def _complete(stream: DataFrame, target: str, state: str) -> DataFrame:
    """The stream's whole result, as it stands when all files have been read."""
    ingest.drain(stream, target, state, "complete", lambda df, _: df.write.mode("overwrite").parquet(target))
    return stream.sparkSession.read.schema(stream.schema).parquet(target).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark, sf_dir):
    stream, target, state = _replayed(spark, sf_dir)
    return _complete(ingest.tumbling(stream, "ts", "1 hour", ["event_type"]), target, state)


@query("SELECT s AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS s FROM events) GROUP BY 1, 2")
def stream_sliding(spark, sf_dir):
    stream, target, state = _replayed(spark, sf_dir)
    return _complete(ingest.sliding(stream, "ts", "1 hour", "30 minutes", ["event_type"]), target, state)


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL '10 minutes' THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k")
def stream_sessions(spark, sf_dir):
    stream, target, state = _replayed(spark, sf_dir)
    return _complete(ingest.sessions(stream, "ts", "10 minutes", ["user_id"]), target, state)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """The first row of each key of a stream."""
    stream, target, state = _replayed(spark, sf_dir)
    first = ingest.once(stream, ["user_id", "event_type"]).select("user_id", "event_type")
    ingest.drain(first, target, state)
    return spark.read.schema(first.schema).parquet(target)


@query("SELECT DISTINCT user_id, value > 50 AS high FROM events")
def stream_changes(spark, sf_dir):
    """A row for each new content of a key, in two runs of which the second finds nothing."""
    stream, target, state = _replayed(spark, sf_dir)
    new = ingest.changed(stream.select("user_id", (F.col("value") > 50).alias("high")), "user_id", "high")
    for _ in range(2):
        ingest.drain(new, target, state)
    return spark.read.schema(new.schema).parquet(target)


@query("SELECT event_id, user_id, event_type FROM events")
def stream_audit(spark, sf_dir):
    """The append-only timeline of a stream."""
    stream, target, state = _replayed(spark, sf_dir)
    rows = stream.select("event_id", "user_id", "event_type")
    ingest.drain(rows, target, state)
    return spark.read.schema(rows.schema).parquet(target)


@query("SELECT count(*) AS n, sum(value::DECIMAL(18, 4))::DOUBLE AS total FROM events")
def stream_rebuild(spark, sf_dir):
    """A summary that is rebuilt whenever files arrive, as it stands at the end."""
    folder = scratch_folder(spark, "watch")
    events = table(spark, sf_dir, "events")
    events.repartitionByRange(3, "event_id").write.parquet(f"{folder}/in")
    built = f"{folder}/out"

    def rebuild(_: DataFrame, __: int) -> None:
        spark.read.parquet(f"{folder}/in").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total")).write.mode("overwrite").parquet(built)

    ingest.watch(spark, f"{folder}/in", events.schema, f"{folder}/state", rebuild)
    return spark.read.schema("n long, total double").parquet(built)


@query("SELECT 'first' AS run, count(*) AS n FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'dry', count(*) FROM documents WHERE doc_id % 2 = 1 UNION ALL SELECT 'second', count(*) FROM documents WHERE doc_id % 2 = 1 OR doc_id IN (2, 4) UNION ALL SELECT 'third', 0 UNION ALL SELECT 'reset', count(*) FROM documents")
def sync_runs(spark, sf_dir):
    """Files that each run of an incremental ingest processes: new ones, a dry run, forced ones, none, and all after a reset."""
    state = scratch_folder(spark, "seen")
    every = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"))
    runs = [("first", every.where("file_id % 2 = 0"), {}), ("dry", every, {"dry_run": True}), ("second", every, {"forced": [2, 4]}), ("third", every, {}), ("reset", every, {"reset": True})]
    done = [(name, ingest.sync(files, state, **how).count()) for name, files, how in runs]
    return spark.createDataFrame(done, "run string, n long")


@query("SELECT doc_id AS path FROM documents WHERE doc_id % 3 <> 1")
def altered_files(spark, sf_dir):
    """Files that are new, or whose time or size has changed."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.lit(5).alias("modified"), F.col("n_chars").alias("size"))
    old = d.where("path % 3 > 0").withColumn("size", F.col("size") + (F.col("path") % 3 == 2).cast("int"))
    return ingest.altered(d, old.unionByName(old.withColumn("modified", F.lit(4)))).select("path")
