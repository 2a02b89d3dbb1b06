"""Registered queries over a corpus of norms, with DuckDB SQL.

The driver's documents are invented prose without the vocabulary of the rule
tables, so each line with text becomes an article that ends in a phrase which the
tables know. The whole text of every document goes in; the SQL takes the lines
as they were and doesn't cut the text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T
from lexmesh.operators import articles, biblio, corpus, graph, norms, records
from lexmesh.plans.catalog import query, table

PHRASES = [
    "El FASP se debe administrar y ejercer con control interno", "celebrar el Convenio de Coordinación del FASP", "informar cada trimestral del Fondo de Aportaciones", "las aportaciones federales se deben presupuestar",
    "destinar los recursos federales a la seguridad pública", "según el Ramo 33", "reintegrar lo no devengado", "la transferencia de recursos", "adherirse al sistema", "celebrar acuerdos con municipios",
    "la representación legal del Estado", "refrendar los decretos", "designar a las dependencias", "las siguientes dependencias", "el modelo nacional de policía", "la profesionalización y capacitación",
    "integrar el sistema de seguridad", "prevención del delito", "Presupuesto de Egresos", "verificación y auditoría con supervisión", "control interno y vigilancia", "transparencia y rendición de cuentas",
    "publicación en el periódico oficial", "expedir el reglamento en treinta días", "sistema nacional", "nada que declarar",
]
AUTHORITIES = ["GOBIERNO DEL ESTADO", "AYUNTAMIENTO", "CONGRESO FEDERAL"]
NAMES = ["LEY GENERAL DE PRUEBA", "REGLAMENTO INTERIOR", "LINEAMIENTOS DE GASTO", "MANUAL DE USO", "CONVENIO MARCO"]
ACTORS = ["el Director General", "la Ley General de Transparencia Pública", "el Oficio No. 12/A", "en Toluca, Mexico", "el Reglamento de Tránsito", "nada"]

_sql_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_pick = lambda xs, at: f"{_sql_list(xs)}[({at}) % {len(xs)} + 1]"
STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
LINES = "norms AS (SELECT doc_id, lang, source, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\s]')) AS l FROM documents)"
ARTS = f"{LINES}, arts AS (SELECT doc_id, lang, source, i, {STRIP.format('l[i]')} AS raw, {_pick(PHRASES, 'doc_id * 7 + i')} AS ph FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM norms))"
ASCII_FOLD = "strip_accents({})"


def _one_of(xs: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, xs)), (F.pmod(at, F.lit(len(xs))) + 1).cast("int"))


def norm_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, l): the lines with text of each document that has one."""
    lines = F.transform(F.filter(F.split("text", "\n"), lambda x: T.strip(x) != ""), T.strip)
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", lines.alias("l"), "text").where(F.col("text").rlike(r"\S")).drop("text")


def _head() -> Column:
    return F.concat(_one_of(AUTHORITIES, F.col("doc_id")), F.lit("\n"), _one_of(NAMES, F.col("doc_id")), F.lit(" "), F.col("doc_id").cast("string"))


def _phrase(i: Column) -> Column:
    """The phrase of article i (from 0)."""
    return _one_of(PHRASES, F.col("doc_id") * 7 + i + 1)


def norm_texts(spark: SparkSession, sf_dir: str, paged: bool = False) -> DataFrame:
    """(doc_id, lang, source, t): a norm per document; with page marks, or with fractions in every third article."""
    number = lambda i: (i + 1).cast("string")
    plain = lambda x, i: F.concat(F.lit("Artículo "), number(i), F.lit(". "), x, F.lit(" "), _phrase(i))
    listed = lambda x, i: F.concat(F.lit("Artículo "), number(i), F.lit(". \nI) "), x, F.lit("\nII) "), _phrase(i))
    if paged:
        article = lambda x, i: F.concat(F.when(i % 4 == 0, F.concat(F.lit("--- Página "), (1 + F.floor(i / 4)).cast("string"), F.lit(" ---\n"))).otherwise(""), plain(x, i))
    else:
        article = lambda x, i: F.when((i + 1) % 3 == 0, listed(x, i)).otherwise(plain(x, i))
    text = F.concat(_head(), F.lit("\n"), F.array_join(F.transform("l", article), "\n"))
    return norm_lines(spark, sf_dir).select("doc_id", "lang", "source", text.alias("t"))


def norm_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, number, suffix, body): a row per article."""
    rows = norm_lines(spark, sf_dir).select("doc_id", "source", F.posexplode_outer("l").alias("i", "x"))  # no list is empty; for an inner one Spark would test that by making it twice
    return rows.select("doc_id", "source", (F.col("i") + 1).alias("number"), F.lit(None).cast("string").alias("suffix"), F.concat("x", F.lit(" "), _phrase(F.col("i"))).alias("body"))


def _counts(text: str, words: list[str]) -> str:
    return " + ".join(f"(length({text}) - length(replace({text}, '{w}', ''))) // {len(w)}" for w in words)


def _best_sql(text: str, named: dict[str, list[str]], default: str) -> str:
    scores = [_counts(text, ws) for ws in named.values()]
    most = f"greatest({', '.join(scores)})"
    return f"CASE WHEN {most} = 0 THEN '{default}' " + " ".join(f"WHEN {s} = {most} THEN '{v}'" for v, s in zip(named, scores, strict=True)) + " END"


def _has(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _digest(x: Column) -> Column:
    return F.md5(x.cast("binary")).alias("digest")


# ------------------------------------------------------------------ segmentation


@query(f"WITH {ARTS} SELECT doc_id, 1 + (i - 1) // 4 AS page, md5(string_agg('Artículo ' || i || '. ' || raw || ' ' || ph, chr(10) ORDER BY i)) AS digest FROM arts GROUP BY 1, 2 UNION ALL SELECT doc_id, 0, md5({_pick(AUTHORITIES, 'doc_id')} || chr(10) || {_pick(NAMES, 'doc_id')} || ' ' || doc_id) FROM norms WHERE len(l) > 0")
def norm_pages(spark, sf_dir):
    """Marked text cut into pages."""
    return corpus.pages_of(norm_texts(spark, sf_dir, True), "doc_id", "t").select("doc_id", F.col("page").cast("long").alias("page"), _digest(F.col("body")))


UNITS = f"{ARTS}, units AS (SELECT doc_id, i::VARCHAR AS article, NULL AS fraction, raw || ' ' || ph AS body FROM arts WHERE i % 3 <> 0 UNION ALL SELECT doc_id, i::VARCHAR, 'I', raw FROM arts WHERE i % 3 = 0 UNION ALL SELECT doc_id, i::VARCHAR, 'II', ph FROM arts WHERE i % 3 = 0)"


@query(f"WITH {UNITS}, u AS (SELECT *, lower(substr(body, 1, 2000)) AS t FROM units) SELECT doc_id, article, fraction, {_best_sql('t', rules.STAGE_KEYWORDS, 'Integración')} AS stage, {_best_sql('t', rules.DIMENSION_KEYWORDS, 'Ejecución')} AS dimension, md5(substr(body, 1, 2000)) AS digest FROM u")
def norm_units(spark, sf_dir):
    """Articles and their fractions, classified by the cycle's keywords."""
    u = corpus.legal_units(norm_texts(spark, sf_dir), "doc_id", "t")
    return u.select("doc_id", "article", "fraction", "stage", "dimension", _digest(F.col("body")))


@query(f"WITH {ARTS} SELECT doc_id, 1 + (i - 1) // 4 AS page, i AS number, md5(substr(raw || ' ' || ph, 1, 2000)) AS digest FROM arts")
def page_articles(spark, sf_dir):
    """Articles page by page."""
    a = corpus.page_articles(corpus.pages_of(norm_texts(spark, sf_dir, True), "doc_id", "t"), "doc_id")
    return a.select("doc_id", F.col("page").cast("long").alias("page"), F.col("number").cast("long").alias("number"), _digest(F.col("body")))


@query(f"WITH {ARTS} SELECT doc_id, i AS number, 1 + (i - 1) // 4 AS page, md5(substr('. ' || raw || ' ' || ph, 1, 1800)) AS digest FROM arts WHERE length(raw || ' ' || ph) + 2 >= 50")
def global_articles(spark, sf_dir):
    """Articles over page borders, with the page of their head; short ones are dropped."""
    a = articles.global_articles(corpus.pages_of(norm_texts(spark, sf_dir, True), "doc_id", "t"), "doc_id")
    return a.select("doc_id", F.col("number").cast("long").alias("number"), F.col("page").cast("long").alias("page"), _digest(F.col("body")))


@query(f"WITH {ARTS} SELECT doc_id, i AS number, CASE WHEN doc_id % 2 = 0 THEN 'listed' ELSE 'relevant' END AS why FROM arts WHERE (doc_id % 2 = 0 AND i <= 2) OR (doc_id % 2 = 1 AND {_has("lower(raw || ' ' || ph)", rules.RELEVANCE_LITERALS)})")
def listed_articles(spark, sf_dir):
    """Articles that an analysis lists; of norms without any, those with a relevant word."""
    a = norm_articles(spark, sf_dir)
    listed = a.where("doc_id % 2 = 0 and number <= 2").select("doc_id", "number", "suffix")
    kept = articles.listed_or_relevant(a, listed, "doc_id")
    return kept.select("doc_id", F.col("number").cast("long").alias("number"), F.when(F.col("doc_id") % 2 == 0, "listed").otherwise("relevant").alias("why"))


@query(f"WITH {ARTS} SELECT source, array_to_string(list_sort(list(DISTINCT i)), ',') AS numbers FROM arts GROUP BY 1")
def article_numbers(spark, sf_dir):
    """The distinct article numbers of each source."""
    return norms.number_sets(norm_articles(spark, sf_dir), "source", "number").select("source", F.array_join(F.col("numbers").cast("array<string>"), ",").alias("numbers"))


# ------------------------------------------------------------------ classification


def _hierarchy_sql() -> str:
    flag = lambda w: f"bool_or(contains(upper(raw || ' ' || ph), '{w}')) OR contains(any_value({_pick(NAMES, 'doc_id')}), '{w}')"
    return "CASE " + " ".join(f"WHEN {flag(w)} THEN '{v}'" for w, v in rules.HIERARCHY) + " ELSE 'Otro' END"


@query(f"WITH {ARTS} SELECT doc_id, any_value(['Estatal', 'Municipal', 'Federal'][doc_id % 3 + 1]) AS level, {_hierarchy_sql()} AS hierarchy, any_value({_pick(NAMES, 'doc_id')} || ' ' || doc_id) AS name FROM arts GROUP BY 1")
def norm_levels(spark, sf_dir):
    """Level, hierarchy and name of each norm."""
    t = F.col("t")
    return norm_texts(spark, sf_dir).select("doc_id", corpus.level(t).alias("level"), corpus.hierarchy(t).alias("hierarchy"), corpus.norm_name(t).alias("name"))


def _score_sql(text: str) -> str:
    return " + ".join(f"regexp_matches({text}, '(?i){p}')::INT" for p in rules.RELEVANCE_PATTERNS)


SCORED = f"{ARTS}, scored AS (SELECT doc_id, i, {_score_sql(ASCII_FOLD.format('raw || chr(32) || ph'))} AS score FROM arts)"


@query(f"WITH {SCORED} SELECT doc_id, i AS number, score::BIGINT AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS rank FROM scored WHERE score >= 1) WHERE rank <= 8")
def relevant_articles(spark, sf_dir):
    """The eight most relevant articles of each norm (a top-k operator)."""
    r = corpus.relevant(norm_articles(spark, sf_dir), "doc_id", "number", "body")
    return r.select("doc_id", F.col("number").cast("long").alias("number"), "score", F.col("rank").cast("long").alias("rank"))


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = T.pattern_score(T.strip_accents(F.col("body")), rules.RELEVANCE_PATTERNS).alias("score")
    return norms.norm_totals(norm_articles(spark, sf_dir).select("doc_id", score), "doc_id")


@query(f"WITH {SCORED} SELECT doc_id, count(*) AS total, count(*) FILTER (score >= 1) AS relevant FROM scored GROUP BY 1")
def norm_totals(spark, sf_dir):
    """All and relevant articles of each norm."""
    return _totals(spark, sf_dir)


@query(f"WITH {SCORED} SELECT doc_id, count(*) AS total, count(*) FILTER (score >= 1) AS relevant FROM scored GROUP BY 1 HAVING count(*) FILTER (score >= 1) > 0 ORDER BY doc_id LIMIT 15")
def first_relevant_norms(spark, sf_dir):
    """The first 15 norms with a relevant article (a report's limit)."""
    return norms.first_relevant(_totals(spark, sf_dir), "doc_id")


def _interpretation_sql() -> str:
    out = "CASE "
    for groups, enough, outcome in rules.INTERPRETATIONS:
        test = " AND ".join(_has("t", g) for g in groups)
        out += f"WHEN {test}{f' OR i = {enough}' if enough else ''} THEN '{outcome}' "
    first, last = rules.NO_INTERPRETATION
    return out + f"ELSE '{first}' || lower(source) || '{last}' END"


@query(f"WITH {ARTS}, x AS (SELECT doc_id, source, i, lower(raw || ' ' || ph) AS t FROM arts) SELECT doc_id, i AS number, md5({_interpretation_sql()}) AS digest FROM x")
def article_interpretations(spark, sf_dir):
    """What each article means for the fund: the first of the ordered rules that holds."""
    a = norm_articles(spark, sf_dir)
    return a.select("doc_id", F.col("number").cast("long").alias("number"), _digest(norms.interpretation(F.col("body"), F.col("number"), F.col("source"))))


@query(f"WITH {ARTS} SELECT doc_id, count(*) FILTER ({_has('lower(ph)', rules.RELEVANCE_LITERALS)} OR {_has('lower(raw)', rules.RELEVANCE_LITERALS)}) AS n FROM arts GROUP BY 1")
def keyword_articles(spark, sf_dir):
    """Articles with any of the relevant literals, per norm."""
    return norm_articles(spark, sf_dir).groupBy("doc_id").agg(F.count_if(T.contains_any(F.lower("body"), rules.RELEVANCE_LITERALS)).alias("n"))


# ------------------------------------------------------------------ entities by pattern


def _entity_sql() -> str:
    line = "line"
    one = lambda kind, pattern: f"SELECT doc_id, i, '{kind}' AS type, unnest(regexp_extract_all({line}, '{pattern}', 1)) AS entity FROM e"
    plain = [(k, p) for k, p in rules.ENTITY_PATTERNS if "(?=" not in p]
    return " UNION ALL ".join(one(k, p) for k, p in plain)


ENTITIES = f"{ARTS}, e AS (SELECT doc_id, lang, i, raw || ' ' || {_pick(ACTORS, 'doc_id + i')} AS line FROM arts), hits AS ({_entity_sql()})"


def actor_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = norm_lines(spark, sf_dir).select("doc_id", "lang", F.posexplode("l").alias("p", "x"))
    return rows.select("doc_id", "lang", (F.col("p") + 1).cast("long").alias("section"), F.concat("x", F.lit(" "), _one_of(ACTORS, F.col("doc_id") + F.col("p") + 1)).alias("body"))


def pattern_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = [(k, p) for k, p in rules.ENTITY_PATTERNS if "(?=" not in p]
    return corpus.pattern_entities(actor_sections(spark, sf_dir), ("doc_id", "section"), patterns=patterns)


@query(f"WITH {ENTITIES} SELECT doc_id, i AS section, entity, type, CASE type WHEN 'NORMA' THEN 'normativo' WHEN 'DOCUMENTO' THEN 'operativo' ELSE 'informal' END AS layer, count(*) AS n FROM hits GROUP BY ALL")
def entity_patterns(spark, sf_dir):
    """Roles, norms and documents by pattern, with their layer."""
    return pattern_hits(spark, sf_dir).groupBy("doc_id", "section", "entity", "type", "layer").agg(F.count("*").alias("n"))


@query(f"WITH {ARTS} SELECT doc_id, count(*) FILTER (line) AS n FROM (SELECT doc_id, (doc_id + i) % 6 = 3 AS line FROM arts) GROUP BY 1 HAVING count(*) FILTER (line) > 0")
def entity_places(spark, sf_dir):
    """Toluca, a place before a comma and a name, in the articles that end in it."""
    hits = corpus.pattern_entities(actor_sections(spark, sf_dir), ("doc_id", "section"), patterns=[p for p in rules.ENTITY_PATTERNS if p[0] == "LUGAR"])
    return hits.where("entity like '%Toluca'").groupBy("doc_id").agg(F.count("*").alias("n"))


@query(f"WITH {ARTS} SELECT doc_id, i AS section, md5(trim(regexp_replace(substr(line, greatest(1, length(line) - 65), 66), '\\s+', ' ', 'g'))) AS digest FROM (SELECT doc_id, i, raw || ' el Director General' AS line FROM arts WHERE (doc_id + i) % 6 = 0 AND NOT regexp_matches(raw, '\\b(Director|Titular|Jefe|Regidor)'))")
def entity_contexts(spark, sf_dir):
    """The text around each role, at the place of the match."""
    h = pattern_hits(spark, sf_dir).where("type = 'CARGO' and entity = 'Director General'")
    return h.select("doc_id", "section", _digest(F.col("context")))


SEEN = f"{ENTITIES}, m AS (SELECT strip_accents(lower(h.entity)) AS nid, h.entity, h.type, h.doc_id, h.i, e.lang, h.doc_id * 100000 + h.i AS pos FROM hits h JOIN e ON e.doc_id = h.doc_id AND e.i = h.i)"


@query(f"WITH {SEEN} SELECT nid, arg_max(entity, pos) AS label, arg_min(lang, pos) AS layer, count(*) AS frequency FROM m GROUP BY 1 HAVING count(*) = count(DISTINCT pos)")
def node_first_last(spark, sf_dir):
    """Nodes with the label seen last and the layer seen first, of those that a section names once."""
    s = actor_sections(spark, sf_dir).select("doc_id", "section", "lang")
    e = pattern_hits(spark, sf_dir).drop("layer").join(s, ["doc_id", "section"]).withColumn("pos", F.col("doc_id") * 100000 + F.col("section"))
    once = e.groupBy(T.node_id(F.col("entity")).alias("nid")).agg(F.count("*").alias("a"), F.count_distinct("pos").alias("b")).where("a = b").select("nid")
    return graph.nodes(e, "entity", "type", "lang", "pos").join(once, "nid").select("nid", "label", "layer", "frequency")


@query(f"WITH {ARTS} SELECT doc_id, i AS section, 'SIN TIPO' AS entity, issue FROM (SELECT doc_id, i, unnest(CASE WHEN i % 5 = 0 THEN ['type', 'section'] ELSE ['type'] END) AS issue FROM arts) WHERE issue = 'type' AND i % 7 = 0 OR issue = 'section'")
def entity_file_issues(spark, sf_dir):
    """Entities of unknown types, and those of sections that don't exist."""
    a = norm_articles(spark, sf_dir).select(F.col("doc_id").alias("job"), F.col("number").cast("long").alias("section"))
    e = a.withColumn("entity", F.lit("SIN TIPO")).withColumn("type", F.expr("CASE WHEN section % 7 = 0 THEN 'OTRO' ELSE 'CARGO' END")).withColumn("layer", F.lit("informal"))
    return records.entity_issues(e, a.where("section % 5 <> 0")).withColumnRenamed("job", "doc_id")


# ------------------------------------------------------------------ files of norms


FILE = "'FASP_2026_P1_MEX_NOR-Ley-' || doc_id || '_V' || doc_id % 10 || CASE WHEN doc_id % 4 = 0 THEN '.txt' ELSE '.pdf' END"


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, name, path, mime): a file name per document; every 50th is the registry."""
    name = F.expr(f"CASE WHEN doc_id % 50 = 7 THEN 'FASP Registro Normatividad ' || doc_id || '.pdf' ELSE {FILE} END")
    mime = F.expr("CASE WHEN doc_id % 8 = 0 THEN 'application/pdf' WHEN doc_id % 8 = 4 THEN 'text/plain' END")
    return table(spark, sf_dir, "documents").select("doc_id", name.alias("name"), F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/"), name).alias("path"), mime.alias("mime"), "source", "lang")


@query("SELECT doc_id FROM documents WHERE doc_id % 50 <> 7 AND (doc_id % 4 <> 0 OR doc_id % 8 = 0)")
def ingest_candidates(spark, sf_dir):
    """PDFs by type or name, but for the registry itself."""
    return norms.candidates(files(spark, sf_dir)).select("doc_id")


@query("SELECT doc_id FROM documents WHERE lang IS NULL OR lang = 'es' OR doc_id % 9 = 0")
def layer_filter(spark, sf_dir):
    """Rows of one layer, and those that name none."""
    rows = files(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("lang")).alias("layer"))
    return norms.in_layer(rows, "es").select("doc_id")


@query("SELECT doc_id, 'Ley ' || doc_id AS display FROM documents WHERE doc_id % 50 <> 7 AND doc_id % 4 = 0")
def display_names(spark, sf_dir):
    """Names of norms for display."""
    return files(spark, sf_dir).where("name like '%.txt'").select("doc_id", norms.clean_name(F.col("name")).alias("display"))


PATHS = ["/r/09 FASP/01 EdoMex/01 Normatividad estatal/r.xlsx", "/r/09 FASP/02 Chiapas/01 Normatividad estatal/r.xlsx", "/r/Normatividad federal/01 Bibliografía/r.xlsx", "/r/Normatividad federal/02 Normatividad federal/r.xlsx", "/r/otra/r.xlsx"]


@query("SELECT doc_id, ['MEX', 'CHI', 'NAL', 'NAL', NULL][doc_id % 5 + 1] AS state, [NULL, NULL, 'Bibliografia', 'NormatividadFederal', NULL][doc_id % 5 + 1] AS folder FROM documents")
def path_routes(spark, sf_dir):
    """The corpus that a registry's path belongs to."""
    to = norms.route(F.col("p"), {"01 EdoMex": "MEX", "02 Chiapas": "CHI"})
    d = table(spark, sf_dir, "documents").select("doc_id", _one_of(PATHS, F.col("doc_id")).alias("p"))
    return d.select("doc_id", to["state"].alias("state"), to["folder"].alias("folder"))


@query("WITH f AS (SELECT CASE WHEN doc_id % 50 = 7 THEN 'FASP Registro Normatividad ' || doc_id || '.pdf' ELSE " + FILE + " END AS name FROM documents) SELECT n_nationkey AS law, (SELECT min(name) FROM f WHERE regexp_matches(name, '(?i)ley-' || n_nationkey || '_v')) AS file FROM nation")
def law_files(spark, sf_dir):
    """The first file whose name each law's pattern finds."""
    laws = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("law"), F.concat(F.lit("LEY-"), F.col("n_nationkey").cast("string"), F.lit("_V")).alias("pattern"))
    return norms.files_of_laws(laws, files(spark, sf_dir), "law", "pattern", "name")


@query("SELECT 'NOR-' || doc_id AS id_norma, CASE WHEN doc_id % 3 = 0 THEN 'DOC-' || doc_id WHEN doc_id % 3 = 1 AND doc_id % 2 = 0 THEN 'NOR-' || doc_id WHEN doc_id % 3 = 1 THEN 'src-' || doc_id END AS job, CASE WHEN doc_id % 3 = 0 THEN 1 WHEN doc_id % 3 = 1 AND doc_id % 2 = 0 THEN 1 WHEN doc_id % 3 = 1 THEN 2 END::BIGINT AS tier, CASE WHEN doc_id % 3 = 2 THEN 'Sin MD' END AS rating FROM documents")
def norm_jobs(spark, sf_dir):
    """The job of each norm by document, own id or source, near ones first."""
    n = table(spark, sf_dir, "documents").select("doc_id", F.expr("'NOR-' || doc_id").alias("id_norma"), F.expr("'DOC-' || doc_id").alias("id_documento"), F.expr("'src-' || doc_id || '.md'").alias("fuente"))
    jobs = n.where("doc_id % 3 = 0").select(F.col("id_documento").alias("job"), F.lit(True).alias("near")).union(n.where("doc_id % 3 = 1 and doc_id % 2 = 0").select("id_norma", F.lit(True))).union(n.where("doc_id % 3 = 1").select(F.expr("'src-' || doc_id"), F.lit(False)))
    return norms.jobs_of_norms(n, jobs)


@query("SELECT doc_id, CASE WHEN doc_id % 50 <> 7 AND doc_id % 4 <> 0 THEN '/corpus/' || source || '/' || " + FILE + " END AS source_path FROM documents")
def job_sources(spark, sf_dir):
    """The source file of each job, by name."""
    f = files(spark, sf_dir)
    jobs = table(spark, sf_dir, "documents").select("doc_id", F.expr(FILE).alias("filename"))
    return norms.sources_of_jobs(jobs, f).select("doc_id", F.col("source").alias("source_path"))


# ------------------------------------------------------------------ bibliographic records


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Revista de Pruebas\nPalabras clave: uno, dos\nEL TÍTULO DEL ARTÍCULO "), F.col("doc_id").cast("string"), F.lit("\ny su segunda parte\nAna Pérez "), _one_of(["Gil", "Ruiz", "Sol"], F.col("doc_id")), F.lit("*\n"), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("t"))


@query("SELECT doc_id, 'Palabras clave: uno, dos EL TÍTULO DEL ARTÍCULO ' || doc_id || ' y su segunda parte' AS title, 'Ana Pérez ' || ['Gil', 'Ruiz', 'Sol'][doc_id % 3 + 1] AS author FROM documents")
def paper_titles(spark, sf_dir):
    """Title and author of scientific papers: the lines above the author's, down to the text's second."""
    p = biblio.paper(F.col("t"))
    return papers(spark, sf_dir).select("doc_id", p["title"].alias("title"), p["author"].alias("author"))


TITLES = [
    ("CONSIDERANDO QUE ES NECESARIO LO SIGUIENTE\nLINEAMIENTOS GENERALES DE OPERACIÓN DEL PROGRAMA\nPARA EL EJERCICIO FISCAL 2025 Y SIGUIENTES\nCAPÍTULO PRIMERO", "LINEAMIENTOS GENERALES DE OPERACIÓN DEL PROGRAMA PARA EL EJERCICIO FISCAL 2025 Y SIGUIENTES"),
    ("Página 3\nel artículo 5, fracción II, del reglamento citado, inciso a\nREGLAMENTO INTERIOR DE LA SECRETARÍA\nCAPÍTULO I", "REGLAMENTO INTERIOR DE LA SECRETARÍA"),
    ("Reglamento de la Ley de Coordinación\nCAPÍTULO UNO", "Reglamento de la Ley de Coordinación"),
    ("ACUERDO POR EL QUE SE EXPIDE EL MANUAL\nde operación de la comisión estatal\nTRANSITORIO ÚNICO", "ACUERDO POR EL QUE SE EXPIDE EL MANUAL de operación de la comisión estatal"),
]


@query("SELECT doc_id, " + _pick([t for _, t in TITLES], "doc_id") + " AS title FROM documents")
def document_titles(spark, sf_dir):
    """Titles by their words, with the lines that go on with them; references to norms only where nothing else is found."""
    text = F.concat(_one_of([t for t, _ in TITLES], F.col("doc_id")), F.lit("\n"), F.when(F.col("doc_id") % 4 != 2, F.col("text")).otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", biblio.title(text).alias("title"))


BIBLIO_HEADS = ["Diario Oficial de la Federación, Ciudad de México, 5 de marzo de 2021. ACUERDO 03/LII/2025", "Periódico Oficial. Chiapas. LINEAMIENTOS 4/2020 de 7/11/2020", "Gaceta de Zacatecas, 2019-02-03: DECRETO POR EL QUE SE REFORMA", "nada"]
BIBLIO_OUT = {
    "fecha_publicacion": ["2021-03-05", "2020-11-07", "2019-02-03", None], "lugar": ["Ciudad de México", "Chiapas", "Zacatecas", None], "medio_publicacion": ["Diario Oficial de la Federación", "Periódico Oficial del Estado", "Gaceta de Gobierno", None],
    "tipo_documento": ["Acuerdo", "Lineamiento", "Decreto", None], "numero_norma": ["ACUERDO 03/LII/2025", "LINEAMIENTOS 4/2020", "DECRETO POR EL QUE SE REFORMA", None],
}
_nulls = lambda xs: "[" + ", ".join("NULL" if x is None else f"'{x}'" for x in xs) + "]"


@query("SELECT doc_id, " + ", ".join(f"{_nulls(v)}[doc_id % 4 + 1] AS {k}" for k, v in BIBLIO_OUT.items()) + ", 'https://doi.org/10.1234/d' || doc_id AS url, '10.1234/d' || doc_id AS doi, CASE WHEN doc_id % 3 = 0 THEN 'FED' ELSE 'EST' END AS ambito FROM documents")
def bibliographic_fields(spark, sf_dir):
    """Date, place, medium, type, number, link and scope of each record."""
    text = F.concat(_one_of(BIBLIO_HEADS, F.col("doc_id")), F.lit(" https://doi.org/10.1234/d"), F.col("doc_id").cast("string"), F.lit("."))
    d = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), F.when(F.col("doc_id") % 3 == 0, "nal").otherwise("mex").alias("state"))
    return biblio.extracted(d, ("doc_id",), state="state").select("doc_id", *BIBLIO_OUT, "url", "doi", "ambito")


@query("SELECT doc_id, ['Sobre la ley', NULL, NULL, 'Otro texto'][doc_id % 4 + 1] AS title, CASE WHEN doc_id % 2 = 0 THEN 'Ana Gil' END AS author, CASE WHEN doc_id % 4 = 2 THEN 1 ELSE 2 END + (doc_id % 2 = 0)::INT AS n_kept FROM documents")
def file_metadata(spark, sf_dir):
    """Titles and authors of files' metadata: portals' and empty ones don't count."""
    titles = ["Redalyc. Sobre la ley", "Portal de transparencia", "", "Otro texto"]
    meta = F.create_map(F.lit("title"), _one_of(titles, F.col("doc_id")), F.lit("author"), F.when(F.col("doc_id") % 2 == 0, "Ana  Gil").otherwise(" "), F.lit("producer"), F.lit("x"))
    d = table(spark, sf_dir, "documents").select("doc_id", meta.alias("m"))
    return d.select("doc_id", biblio.file_title(F.col("m")).alias("title"), biblio.file_author(F.col("m")).alias("author"), F.size(biblio.kept_metadata(F.col("m"))).alias("n_kept"))


@query("SELECT doc_id, source AS titulo, CASE WHEN doc_id % 2 = 0 THEN 'Revista ' || doc_id ELSE lang END AS lugar, CASE WHEN doc_id % 2 = 0 THEN doc_id % 7 END AS volumen FROM documents")
def doi_enrichment(spark, sf_dir):
    """Records with what a lookup by identifier knows in place of their own."""
    d = table(spark, sf_dir, "documents")
    found = d.select("doc_id", F.col("source").alias("titulo"), F.col("lang").alias("lugar"), F.expr("'10.1/' || doc_id").alias("doi"))
    known = d.where("doc_id % 2 = 0").select(F.expr("'10.1/' || doc_id").alias("doi"), F.expr("'Revista ' || doc_id").alias("lugar"), (F.col("doc_id") % 7).alias("volumen"))
    return biblio.enriched(found, known).select("doc_id", "titulo", "lugar", "volumen")


@query('SELECT doc_id::VARCHAR AS "Código de archivo", lang AS "Clave EDO", source AS "Título oficial completo", NULL AS "Abreviatura oficial", n_chars::VARCHAR AS "Año" FROM documents')
def registry_rows(spark, sf_dir):
    """The registry's columns from the fields that fill them."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("codigo_archivo"), F.col("lang").alias("clave_edo"), F.col("source").alias("titulo"), F.col("n_chars").alias("anio"))
    return biblio.registry(d).select("Código de archivo", "Clave EDO", "Título oficial completo", "Abreviatura oficial", "Año")
