"""Norms and their files: matching, routing, interpretation, totals, checks of graphs and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T
from lexmesh.operators import records

# ------------------------------------------------------------------ files


def is_pdf(name: Column, mime: Column) -> Column:
    return F.coalesce(mime == "application/pdf", F.lit(False)) | F.lower(name).endswith(".pdf")


def candidates(files: DataFrame, name: str = "name", mime: str = "mime") -> DataFrame:
    """The files to ingest: PDFs, but for the registry itself."""
    return files.where(is_pdf(F.col(name), F.col(mime)) & ~F.col(name).contains(rules.REGISTRY_TITLE))


def in_layer(rows: DataFrame, layer: str | None, column: str = "layer") -> DataFrame:
    """The rows of a layer, with those that name none; all rows if none is asked for."""
    return rows if layer is None else rows.where(F.col(column).isNull() | (F.col(column) == "") | (F.col(column) == layer))


def route(path: Column, folders: dict[str, str]) -> Column:
    """Struct (state, folder) of the corpus that a registry's path belongs to; null where the path doesn't tell.

    folders maps a state's folder name to its key. A registry under a state's
    folder is that state's; one of the federal norms goes by its own subfolder.
    """
    state = reduce(lambda out, kv: out.when(F.contains(path, F.lit(f"/{kv[0]}/")) & F.contains(path, F.lit("01 Normatividad")), kv[1]), list(folders.items())[1:], F.when(F.contains(path, F.lit(f"/{next(iter(folders))}/")) & F.contains(path, F.lit("01 Normatividad")), next(iter(folders.values()))))
    federal = F.contains(F.lower(path), F.lit("normatividad federal"))
    books = path.rlike(r"(?iu)01\s+bibliograf[íi]a") | (path.rlike(r"(?iu)bibliograf[íi]a") & ~F.contains(path, F.lit("NormatividadFederal")))
    norms = path.rlike(r"(?iu)02\s+normatividad\s+federal") | F.contains(path, F.lit("NormatividadFederal"))
    folder = F.when(path.rlike(r"(?iu)01\s+bibliograf[íi]a"), "Bibliografia").when(path.rlike(r"(?iu)02\s+normatividad\s+federal"), "NormatividadFederal").when(books, "Bibliografia").when(norms, "NormatividadFederal")
    none = F.lit(None).cast("string")
    return F.when(state.isNotNull(), F.struct(state.alias("state"), none.alias("folder"))).when(federal & folder.isNotNull(), F.struct(F.lit("NAL").alias("state"), folder.alias("folder")))


def files_of_laws(laws: DataFrame, files: DataFrame, law: str, pattern: str, name: str) -> DataFrame:
    """(law, file): the first file by name that each law's pattern finds, null if none does.

    The laws are a list of patterns, so they are broadcast, at most MOST_LAWS of them.
    """
    if (n := laws.limit(MOST_LAWS + 1).count()) > MOST_LAWS:
        raise ValueError(f"{n} laws; at most {MOST_LAWS} are matched by pattern")
    few = laws.select(F.col(law).alias("_l"), F.concat(F.lit("(?iu)"), F.col(pattern)).alias("_p"))
    found = files.select(F.col(name).alias("_f")).join(F.broadcast(few), F.expr("_f rlike _p")).groupBy("_l").agg(F.min("_f").alias("file"))
    return laws.select(law).join(found, F.col(law) == F.col("_l"), "left").select(law, "file")


#: Patterns that files_of_laws broadcasts at most.
MOST_LAWS = 10_000


def jobs_of_norms(norms: DataFrame, jobs: DataFrame, norm: str = "id_norma", document: str = "id_documento", source: str = "fuente", job: str = "job") -> DataFrame:
    """(norm, job, tier, rating): the job whose name is the norm's document, itself, or its source without .md.

    jobs has (job, near): jobs in the usual place (near) come before others, which
    are tier 2; among equals the smallest name counts. Without one, the rating is "Sin MD".
    """
    keys = F.array(F.col(document), F.col(norm), F.regexp_replace(source, r"\.md$", ""))
    long = norms.select(F.col(norm).alias("_n"), F.explode(F.array_distinct(F.array_compact(keys))).alias("_k")).where("_k <> ''")
    found = long.join(jobs.select(F.col(job).alias("_k"), F.when(F.col("near"), 1).otherwise(2).alias("_t")), "_k").groupBy("_n").agg(F.min(F.struct("_t", "_k")).alias("b"))
    return norms.select(norm).join(found, F.col(norm) == F.col("_n"), "left").select(norm, F.col("b._k").alias("job"), F.col("b._t").cast("long").alias("tier"), F.when(F.col("b").isNull(), "Sin MD").alias("rating"))


def sources_of_jobs(jobs: DataFrame, files: DataFrame, filename: str = "filename", path: str = "path") -> DataFrame:
    """jobs with the first path by name of the PDF file that each names, null if there is none."""
    name = F.element_at(F.split(path, "/"), -1)
    pdfs = files.where(F.lower(F.col(path)).endswith(".pdf")).groupBy(name.alias("_f")).agg(F.min(path).alias("source"))
    return jobs.join(pdfs, F.col(filename) == F.col("_f"), "left").drop("_f")


# ------------------------------------------------------------------ articles


def interpretation(text: Column, number: Column, process: Column) -> Column:
    """What an article means for the fund: the outcome of the first rule that holds, else the general one."""
    low = F.lower(text)
    out = None
    for groups, enough, outcome in rules.INTERPRETATIONS:
        holds = reduce(lambda a, b: a & b, (T.contains_any(low, g) for g in groups))
        if enough is not None:
            holds = holds | F.coalesce(number == enough, F.lit(False))
        out = F.when(holds, outcome) if out is None else out.when(holds, outcome)
    first, last = rules.NO_INTERPRETATION
    return out.otherwise(F.concat(F.lit(first), F.lower(process), F.lit(last)))


def clean_name(name: Column) -> Column:
    """A norm's file name for display."""
    return F.trim(F.replace(F.regexp_replace(F.regexp_replace(name, r"^FASP_\d{4}_P[123]_[A-Z]+_(NOR|DOC)-", ""), r"_V\d+\.txt$", ""), F.lit("-"), F.lit(" ")))


def norm_totals(articles: DataFrame, norm: str, score: str = "score") -> DataFrame:
    """(norm, total, relevant): all articles and those with a score."""
    return articles.groupBy(norm).agg(F.count("*").alias("total"), F.count_if(F.col(score) >= 1).alias("relevant"))


def first_relevant(totals: DataFrame, norm: str, most: int = 15) -> DataFrame:
    """The first norms by name that have a relevant article (a report's limit)."""
    return totals.where("relevant > 0").orderBy(norm).limit(most)


def number_sets(mentions: DataFrame, section: str, number: str) -> DataFrame:
    """(section, numbers): the distinct article numbers of a section, ascending."""
    return mentions.where(F.col(number).isNotNull()).groupBy(section).agg(F.array_sort(F.collect_set(number)).alias("numbers"))


# ------------------------------------------------------------------ totals


def counts_by(rows: DataFrame, column: str, missing: str = "Desconocido") -> DataFrame:
    """(column, n): rows per value, those without one under `missing`."""
    return rows.groupBy(F.coalesce(column, F.lit(missing)).alias(column)).agg(F.count("*").alias("n"))


def sync_totals(stats: DataFrame, key: str = "state") -> DataFrame:
    """(key, nuevos, ya_vistos, errores, omitidos) per key, and in all (null key)."""
    return stats.rollup(key).agg(*(F.sum(c).cast("long").alias(c) for c in ("nuevos", "ya_vistos", "errores", "omitidos")))


def status_totals(status: DataFrame) -> DataFrame:
    """(ok, warn, fail), one row."""
    return status.agg(*(F.count_if(F.col("status") == s).alias(s.lower()) for s in ("OK", "warn", "fail")))


def extent(blocks: DataFrame, key: str, page: str = "page") -> DataFrame:
    """(key, pages, blocks): the last page and the number of blocks of a document."""
    return blocks.groupBy(key).agg(F.max(page).cast("long").alias("pages"), F.count("*").alias("blocks"))


def link_types(links: DataFrame, kind: str = "tipo_vinculo") -> DataFrame:
    """(kind, n, share) of a network's links."""
    n = links.agg(F.count("*").alias("_n"))
    return links.groupBy(kind).agg(F.count("*").alias("n")).crossJoin(F.broadcast(n)).select(kind, "n", F.round(F.col("n") / F.col("_n"), 4).alias("share"))


# ------------------------------------------------------------------ checks


def small_corpus(docs: DataFrame, least: int = 5) -> DataFrame:
    """(corpus_size, warning), one row: null from `least` documents on."""
    n = F.count("*")
    return docs.agg(n.alias("corpus_size"), F.when(n < least, F.concat(F.lit("Corpus tiene "), n.cast("string"), F.lit(f" docs; análisis de redes no es robusto con < {least}."))).alias("warning"))


def sociogram_issues(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """(n_nodes, n_edges, issues), one row: below 3 nodes centralities say nothing, below 5 communities, below 5 or 10 edges the graph is small."""
    one = vertices.agg(F.count("*").alias("n_nodes")).crossJoin(links.agg(F.count("*").alias("n_edges")))
    n, m = F.col("n_nodes"), F.col("n_edges")
    issues = F.array_compact(F.array(F.when(n < 3, "sin centralidad"), F.when(n < 5, "sin comunidades"), F.when((n < 5) | (m < 10), "corpus pequeño")))
    return one.select("n_nodes", "n_edges", issues.alias("issues"))


def graph_check(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """(n_nodes, n_edges, n_lost, n_isolated, density), one row: what a graph file holds, and edges whose ends it lacks."""
    ids = vertices.select(F.col("nid").alias("_v")).distinct()
    ends = links.select(F.explode(F.array("src", "dst")).alias("_v"))
    lost = links.join(ids.withColumnRenamed("_v", "src"), "src", "left_semi").join(ids.withColumnRenamed("_v", "dst"), "dst", "left_semi").agg(F.count("*").alias("whole"))
    alone = ids.join(ends, "_v", "left_anti").agg(F.count("*").alias("n_isolated"))
    one = ids.agg(F.count("*").alias("n_nodes")).crossJoin(links.agg(F.count("*").alias("n_edges"))).crossJoin(lost).crossJoin(alone)
    n = F.col("n_nodes")
    density = F.when(n > 1, 2 * F.col("n_edges") / (n * (n - 1))).otherwise(F.lit(0.0))
    return one.select("n_nodes", "n_edges", (F.col("n_edges") - F.col("whole")).alias("n_lost"), "n_isolated", F.round(density.cast("double"), 6).alias("density"))


def profile_issues(checkpoints: DataFrame, key: str = "id") -> DataFrame:
    """(key, etapa, perfil): checkpoints of a profile that their stage doesn't have."""
    known = checkpoints.sparkSession.createDataFrame(sorted({(s, p) for s, p, _ in rules.GATES}), "etapa string, perfil string")
    return checkpoints.select(key, "etapa", "perfil").join(F.broadcast(known), ["etapa", "perfil"], "left_anti").select(key, "etapa", "perfil")


def table_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, violations): every declared constraint of the given tables; references to tables that aren't given are left out."""
    out = []
    for name, df in tables.items():
        spec = rules.TABLES[name]
        quoted = lambda values: ", ".join("'" + v.replace("'", "''") + "'" for v in values)
        checks = {c: f"`{c}` in ({quoted(v)})" for c, v in spec.get("allowed", {}).items()} | {c: f"`{c}` between {a} and {b}" for c, (a, b) in spec.get("ranges", {}).items()}
        out.append(records.check_report(df, name, spec["not_null"], spec.get("unique", []), checks))
        out += [records.orphans(df, tables[t], c, k, name) for c, t, k in spec.get("refers", []) if t in tables]
    return reduce(DataFrame.unionByName, out)


def validator_issues(rows: DataFrame, key: str, validator: str) -> DataFrame:
    """(key, field, value): rows of an object that break a validator's lists and ranges; nulls are skipped."""
    spec = rules.VALIDATORS[validator]
    one = lambda f, ok, v: F.when(F.col(f).isNotNull() & ~ok, F.struct(F.lit(f).alias("field"), v.cast("string").alias("value")))
    found = [one(f, F.col(f).isin(values), F.col(f)) for f, values in spec["allowed"].items()]
    found += [one(f, F.col(f).between(1, 5), F.col(f)) for f in spec.get("scores", [])]
    listed = [F.transform(F.array_except(F.col(f), F.array(*map(F.lit, values))), lambda v, f=f: F.struct(F.lit(f).alias("field"), v.cast("string").alias("value"))) for f, values in spec.get("lists", {}).items()]
    none = F.array().cast("array<struct<field:string,value:string>>")
    every = F.concat(F.array_compact(F.array(*found)), *(F.coalesce(x, none) for x in listed))
    return rows.select(key, F.explode(every).alias("i")).select(key, "i.*")


def annex_issues(json: Column, annex: str) -> Column:
    """Array of messages for an annex: those of its own keys, and of each of its rows, with the row's number."""
    spec = rules.ANNEXES[annex]
    flat = {"required": spec["required"], "properties": {**spec.get("properties", {}), **({spec["rows"][0]: {"type": "array"}} if "rows" in spec else {})}}
    own = records.schema_issues(json, flat)
    if "rows" not in spec:
        return own
    name, inner = spec["rows"]
    rows = F.from_json(F.get_json_object(json, f"$.{name}"), "array<string>")
    each = F.flatten(F.transform(F.coalesce(rows, F.array().cast("array<string>")), lambda r, i: F.transform(records.schema_issues(r, inner), lambda m: F.concat(F.lit(f"{name} "), i.cast("string"), F.lit(": "), m))))
    return F.concat(own, each)


#: What must hold of a stage before it may be closed.
CLOSING = {
    "fuera de taxonomía": "violations = 0",
    "cobertura baja": "coverage >= 0.85",
    "anexo inválido": "annex_issues = 0",
    "grafo pequeño": "n_nodes >= 5",
    "gate sin registrar": "open_gates = 0",
}


def closing_blockers(state: DataFrame, stage: str = "etapa") -> DataFrame:
    """(stage, blockers): which of the five conditions of closing keep a stage open.

    state has (stage, violations, coverage, annex_issues, n_nodes, open_gates).
    """
    return records.stage_blockers(state, stage, CLOSING)


def styled_nodes(nodes: DataFrame, level: str = "level", value: str = "betweenness") -> DataFrame:
    """nodes with size (200 + 3000 value) and colour (by level of government)."""
    known = F.create_map(*(F.lit(x) for kv in rules.LEVEL_COLOURS.items() for x in kv))
    colour = F.coalesce(F.element_at(known, F.coalesce(level, F.lit("Desconocido"))), F.lit(rules.LEVEL_COLOURS["Desconocido"]))
    return nodes.withColumn("size", F.round(200 + 3000 * F.coalesce(value, F.lit(0.0)), 2)).withColumn("colour", colour)


def styled_edges(links: DataFrame, weight: str = "weight") -> DataFrame:
    """links with width (0.5 + 2.5 weight / 10)."""
    return links.withColumn("width", F.round(0.5 + 2.5 * F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) / 10, 2))
