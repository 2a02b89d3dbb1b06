"""Reports: annexes as Markdown lines, the metrics document, pages with graphs and dashboards."""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.operators import norms
from lexmesh.sources.writers import _escape

#: Rows and nodes that a page shows at most; a page is one row.
SHOWN = 1000

# fixed values: what the annexes say
PROGRAMME = "Fondo de Aportaciones para la Seguridad Pública"
FRAMEWORK = ["Ley de Coordinación Fiscal (art. 25 fracción III y 44)", "Ley General del Sistema Nacional de Seguridad Pública", "Presupuesto de Egresos de la Federación"]
AIMS = ["Diagnosticar el marco normativo, funcional y de actores del FASP", "Identificar hallazgos de coordinación entre los tres niveles de gobierno", "Proponer recomendaciones y áreas de mejora"]
COUNTED = [("Documentos ingestados", "documentos"), ("Normas procesadas", "normas"), ("Unidades normativas extraídas", "norma_unidades"), ("Actores en directorio preliminar", "actores")]


def numbered(lines: list[Column], one: DataFrame) -> DataFrame:
    """(pos, line): lines made from the columns of a one-row table."""
    return one.select(F.posexplode(F.array(*lines)).alias("pos", "line"))


def annex_1(counts: DataFrame, evaluation: str, year: int, date: str, responsible: str, coordinator: str = "SESNSP") -> DataFrame:
    """(pos, line) of annex 1; counts has one row with a column per table."""
    fixed = [
        "# Anexo 1 — Ficha Técnica del FASP", "", f"**ID de ficha:** FASP-{year}-{evaluation}  ", f"**ID de evaluación:** {evaluation}  ", f"**Programa:** {PROGRAMME}  ", f"**Año fiscal:** {year}  ", "**Rama:** Seguridad Pública  ",
        f"**Dependencia coordinadora:** {coordinator}  ", f"**Fecha de elaboración:** {date}  ", f"**Responsable:** {responsible}  ", "", "## Marco normativo general", "", *(f"- {x}" for x in FRAMEWORK), "",
        "## Objetivos de la evaluación", "", *(f"- {x}" for x in AIMS), "", "## Alcance: Federal+Estatal+Municipal", "", "## Metodología: Análisis normativo+ARS+triangulación", "", "## Estado del pipeline al cierre de la Ficha", "",
    ]
    return numbered([*map(F.lit, fixed), *(F.concat(F.lit(f"- {text}: **"), F.col(c).cast("string"), F.lit("**")) for text, c in COUNTED)], counts)


def annex_5(metrics: DataFrame, algorithms: list[tuple[str, str, str, dict]], version: str, date: str) -> DataFrame:
    """(pos, line) of annex 5: algorithms (name, version, purpose, parameters) and the graph's metrics, one row."""
    fixed = ["# Anexo 5 — Memoria algorítmica", "", f"**Versión del pipeline:** {version}  ", f"**Fecha de cálculo:** {date}  ", "", "## Algoritmos utilizados", ""]
    for name, number, purpose, parameters in algorithms:
        fixed += [f"### {name} (v{number})", f"- **Propósito:** {purpose}", f"- **Parámetros:** `{json.dumps(parameters)}`", ""]
    fixed += ["## Métricas globales del grafo actual", ""]
    return numbered([*map(F.lit, fixed), *(F.concat(F.lit(f"- **{c}:** "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in metrics.columns)], metrics)


def annex_8(counts: DataFrame, version: str, date: str) -> DataFrame:
    """(pos, line) of annex 8; counts has (table_name, n)."""
    fixed = ["# Anexo 8 — Metodología para la replicabilidad", "", f"**Versión del pipeline:** {version}  ", f"**Fecha de exportación:** {date}  ", "", "## Composición del paquete exportable", "", "### Tablas exportadas (formato CSV)", ""]
    head = counts.sparkSession.createDataFrame(list(enumerate(fixed)), "pos int, line string")
    rows = counts.agg(F.array_sort(F.collect_list(F.concat(F.lit("- `"), "table_name", F.lit("`: "), F.col("n").cast("string"), F.lit(" filas")))).alias("l"))  # a row per table
    return head.unionByName(rows.select(F.posexplode("l").alias("pos", "line")).withColumn("pos", F.col("pos") + len(fixed)))


def delimitation_report(guarded: DataFrame, extras: DataFrame, corpus_files: int, state: str, most: int = 30) -> DataFrame:
    """(part, pos, line): the summary, the table of guarded norms, and that of other laws (the first `most`: a report's limit).

    guarded has (section, num, norm, outcome), extras (name, category).
    """
    spark = guarded.sparkSession
    g = guarded.agg(F.count("*").alias("g"), *(F.count_if(F.col("outcome") == x).alias(x) for x in ("MANTENER", "FALTANTE", "REVISAR")))
    e = extras.agg(F.count("*").alias("e"), *(F.count_if(F.col("category") == x).alias(x) for x in ("EN_GUARDARRIEL", "FASP_FUERA_GUARDARRIEL", "EXCLUIR")))
    n = lambda text, c: F.concat(F.lit(text), F.col(c).cast("string"))
    lines = [
        F.lit(f"# Delimitacion de normas FASP - {state}"), n("- **Normas en el guardarriel**: ", "g"), n("  - MANTENER: ", "MANTENER"), n("  - FALTANTE (no en corpus): ", "FALTANTE"), n("  - REVISAR (en corpus pero no en MD): ", "REVISAR"),
        F.lit(f"- **Archivos en el corpus**: {corpus_files}"), n("- **Leyes identificadas**: ", "e"), n("  - En el guardarriel: ", "EN_GUARDARRIEL"), n("  - FASP relevantes (fuera del guardarriel): ", "FASP_FUERA_GUARDARRIEL"), n("  - EXCLUIR: ", "EXCLUIR"),
    ]
    summary = numbered(lines, g.crossJoin(e)).select(F.lit(0).alias("part"), F.col("pos").cast("long").alias("pos"), "line")
    cell = lambda c, k: F.substring(F.col(c).cast("string"), 1, k)
    rows = guarded.select(F.lit(1).alias("part"), F.col("num").cast("long").alias("pos"), F.concat(F.lit("| "), F.concat_ws(" | ", cell("section", 30), F.col("num").cast("string"), cell("norm", 60), "outcome"), F.lit(" |")).alias("line"))
    others = extras.where("category <> 'EN_GUARDARRIEL'").orderBy("name").limit(most).select(F.lit(2).alias("part"), F.lit(0).cast("long").alias("pos"), F.concat(F.lit("| "), F.concat_ws(" | ", cell("name", 60), "category"), F.lit(" |")).alias("line"))
    heads = spark.createDataFrame([(1, -1, "| Apartado | Núm | Norma | Categoría |"), (2, -1, "| Ley | Categoria |")], "part int, pos long, line string")
    return summary.unionByName(heads).unionByName(rows).unionByName(others)


def metrics_document(corpus: DataFrame, density: DataFrame, top: DataFrame, layers: DataFrame) -> DataFrame:
    """One row: the metrics of a corpus graph, with its top nodes (nodo, valor), densities by layer, and the warning of a small corpus."""
    listed = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("valor")).alias("_o"), "nodo", "valor"))).alias("t")).select(F.transform("t", lambda x: F.struct(x["nodo"].alias("nodo"), x["valor"].alias("valor"))).alias("top_centralidad_grado"))
    by_layer = layers.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("layer", "density")))).alias("densidad_por_capa"))
    small = norms.small_corpus(corpus).select("corpus_size", F.col("warning").alias("advertencia_corpus_pequeno"))
    one = density.select(F.col("n_nodes").alias("nodos_totales"), F.col("n_edges").alias("aristas_totales"), F.round("density", 4).alias("densidad"))
    return small.crossJoin(one).crossJoin(listed).crossJoin(by_layer)


def _page(title: str, body: Column) -> Column:
    head = f'<!DOCTYPE html><html lang="es"><head><meta charset="utf-8"><title>{title}</title></head><body><h1>{title}</h1>'
    return F.concat(F.lit(head), body, F.lit("</body></html>"))


def _table(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    """(t), one row: the first rows as an HTML table."""
    cells = F.concat_ws("", *(F.concat(F.lit("<td>"), _escape(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>")) for c in df.columns))
    rows = df.orderBy(*order).limit(most).select(cells.alias("r"), *(o.alias(f"_o{i}") for i, o in enumerate(order)))
    listed = rows.agg(F.sort_array(F.collect_list(F.struct(*(f"_o{i}" for i in range(len(order))), "r"))).alias("l"))
    head = "".join(f"<th>{c}</th>" for c in df.columns)
    return listed.select(F.concat(F.lit(f"<table><tr>{head}</tr>"), F.array_join(F.transform("l", lambda x: F.concat(F.lit("<tr>"), x["r"], F.lit("</tr>"))), ""), F.lit("</table>")).alias("t"))


def graph_page(nodes: DataFrame, density: DataFrame, most: int = 30) -> DataFrame:
    """(html), one row: sizes, density and the `most` nodes of highest centrality (node, centrality, ...)."""
    table = _table(nodes, [-F.col("centrality"), F.col("node")], most)
    lead = F.concat(F.lit("<p><b>"), F.col("n_nodes").cast("string"), F.lit("</b> nodos · <b>"), F.col("n_edges").cast("string"), F.lit("</b> aristas · densidad <b>"), F.format_number("density", 4), F.lit("</b></p>"))
    return density.crossJoin(table).select(_page("Grafo de gobernanza", F.concat(lead, "t")).alias("html"))


def sociogram_page(nodes: DataFrame, links: DataFrame, most: int = SHOWN) -> DataFrame:
    """(html), one row: nodes (id, label, level, betweenness) and links (src, dst, weight, kind) as data for a drawing, with the legend.

    Nodes have the size of their betweenness and the colour of their level, links
    the width of their weight. A page shows the `most` largest nodes, and the links between them.
    """
    top = norms.styled_nodes(nodes).orderBy(F.desc("size"), "id").limit(most)
    drawn = top.select(F.to_json(F.struct("id", "label", F.col("colour").alias("color"), "size", F.concat("label", F.lit(" ("), F.coalesce("level", F.lit("Desconocido")), F.lit(")")).alias("title"))).alias("j"), "id")
    names = F.broadcast(top.select("id"))
    between = norms.styled_edges(links).join(names.withColumnRenamed("id", "src"), "src").join(names.withColumnRenamed("id", "dst"), "dst")
    lines = between.select(F.to_json(F.struct(F.col("src").alias("from"), F.col("dst").alias("to"), "width", F.concat(F.coalesce("kind", F.lit("N/D")), F.lit(" (peso="), F.col("weight").cast("string"), F.lit(")")).alias("title"))).alias("j"))
    data = lambda df: df.agg(F.array_join(F.sort_array(F.collect_list("j")), ",").alias("d"))
    legend = "".join(f'<span style="background:{c}">{k}</span>' for k, c in rules.LEVEL_COLOURS.items())
    one = data(drawn).withColumnRenamed("d", "nodes").crossJoin(data(lines).withColumnRenamed("d", "edges"))
    body = F.concat(F.lit(f'<div class="legend">{legend}</div><div id="network"></div><script>const nodes=['), "nodes", F.lit("];const edges=["), "edges", F.lit("];</script>"))
    return one.select(_page("Sociograma FASP", body).alias("html"))


def dashboard_page(counts: DataFrame, quality: DataFrame, audit: DataFrame) -> DataFrame:
    """(html), one row: table counts (table_name, n), the quality of norms (norm, score, rating), and the last audit rows (id, ...)."""
    parts = [_table(counts, [F.col("table_name")], SHOWN), _table(quality, [-F.col("score"), F.col("norm")], SHOWN), _table(audit, [-F.col("id")], 20)]
    one = parts[0].withColumnRenamed("t", "a").crossJoin(parts[1].withColumnRenamed("t", "b")).crossJoin(parts[2].withColumnRenamed("t", "c"))
    body = F.concat(F.lit("<h2>Tablas</h2>"), "a", F.lit("<h2>Normas</h2>"), "b", F.lit("<h2>Bitácora</h2>"), "c")
    return one.select(_page("Tablero FASP", body).alias("html"))


def sociogram_png(nodes: DataFrame, links: DataFrame, side: int = 800, most: int = 200) -> bytes:
    """A picture of the `most` largest nodes (id, level, betweenness) on a circle, in size order, and the links (src, dst, weight) between them."""
    top = norms.styled_nodes(nodes).orderBy(F.desc("size"), "id").limit(most).select("id", "size", "colour").collect()
    place = {r.id: i for i, r in enumerate(top)}
    names = F.broadcast(nodes.sparkSession.createDataFrame([(k,) for k in place], "id string"))
    inside = links.join(names.withColumnRenamed("id", "src"), "src", "left_semi").join(names.withColumnRenamed("id", "dst"), "dst", "left_semi")
    drawn = norms.styled_edges(inside).select("src", "dst", "width").collect() if place else []  # most squared at most
    angle = 2 * np.pi * np.arange(max(1, len(top))) / max(1, len(top))
    x, y = side / 2 + 0.42 * side * np.cos(angle), side / 2 + 0.42 * side * np.sin(angle)
    image = np.full((side, side, 3), 255, np.uint8)
    for e in drawn:
        a, b = place[e.src], place[e.dst]
        t = np.linspace(0, 1, 2 * side)
        for shift in range(-int(min(e.width, 6) / 2), int(min(e.width, 6) / 2) + 1):
            row, col = (y[a] + t * (y[b] - y[a]) + shift).astype(int), (x[a] + t * (x[b] - x[a])).astype(int)
            image[row.clip(0, side - 1), col.clip(0, side - 1)] = (153, 153, 153)
    rows, cols = np.mgrid[:side, :side]
    for i, r in enumerate(top):
        radius = 4 + 16 * min(1.0, (r["size"] - 200) / 3000)
        image[(rows - y[i]) ** 2 + (cols - x[i]) ** 2 <= radius**2] = [int(r.colour[k : k + 2], 16) for k in (1, 3, 5)]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = np.concatenate([np.zeros((side, 1), np.uint8), image.reshape(side, -1)], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", side, side, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
