"""Record-level checks and texts: conversion quality, bibliographic records, file names, gates, constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T

# ------------------------------------------------------------------ conversion quality


def coverage(md: Column, source: Column) -> Column:
    return F.round(T.n_words(md) / F.greatest(T.n_words(source), F.lit(1)), 3)


def missing_caps(md: Column, source: Column, take: int = 20, show: int = 5) -> Column:
    """Of the longest distinct all-caps words of the source, the first that the Markdown lacks."""
    caps = F.array_distinct(F.regexp_extract_all(source, F.lit("([A-ZÁÉÍÓÚÑ]{4,})"), F.lit(1)))
    ordered = F.transform(F.array_sort(F.transform(caps, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda s: s["w"])
    return F.slice(F.filter(F.slice(ordered, 1, take), lambda w: ~F.contains(md, w)), 1, show)


def conversion_issues(md: Column, source: Column) -> Column:
    """Array of what is wrong with a conversion."""
    return F.array_compact(F.array(F.when(~md.startswith("#"), "no_heading_at_start"), F.when(~F.contains(md, F.lit("\n#")), "no_inner_heading"), F.when(coverage(md, source) < 0.85, "low_coverage")))


def keyword_preservation(pairs: DataFrame, key: str, source: str, target: str, top: int = 20) -> DataFrame:
    """(key, n_keywords, kept, rate): of the source's most frequent words of 4 letters or more, the share the target has."""
    words = pairs.select(key, F.explode(F.filter(T.letter_tokens(F.col(source)), lambda w: F.length(w) >= 4)).alias("w")).groupBy(key, "w").agg(F.count("*").alias("n"))
    best = words.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "w"))).where(F.col("r") <= top)
    has = pairs.select(key, F.lower(F.coalesce(F.col(target), F.lit(""))).alias("_t"))
    return best.join(has, key).groupBy(key).agg(F.count("*").alias("n_keywords"), F.count_if(F.expr("contains(_t, w)")).alias("kept")).withColumn("rate", F.round(F.col("kept") / F.col("n_keywords"), 4))


def markdown_structure(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_headings, n_lists, n_table_rows, n_code_blocks): lines inside code fences don't count."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    fence = T.strip(F.col("line")).startswith("```")
    state = lines.withColumn("fence", fence).withColumn("open", F.sum(fence.cast("int")).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)) % 2)
    out = ~F.col("fence") & (F.col("open") == 0)
    t = T.strip(F.col("line"))
    return state.groupBy(key).agg(
        F.count_if(out & F.col("line").rlike("^#{1,6}(?!#)")).alias("n_headings"),
        F.count_if(out & t.rlike(r"^(- |\* |1\. |1\) )")).alias("n_lists"),
        F.count_if(out & (T.count_literal(F.col("line"), "|") >= 2)).alias("n_table_rows"),
        F.ceil(F.count_if(F.col("fence")) / 2).alias("n_code_blocks"),
    )


def quality_score(cover: Column, keywords: Column, similarity: Column, issues: Column) -> Column:
    return F.round(cover * 40 + keywords * 30 + similarity * 20 + F.greatest(F.lit(0), 10 - 2 * issues), 2)


def rating(score: Column) -> Column:
    return F.when(score >= 85, "EXCELENTE").when(score >= 70, "BUENO").when(score >= 50, "ACEPTABLE").otherwise("BAJA")


def heading_level(text: Column, size: Column) -> Column:
    """0 to 3, from the font size, capitals and the number of words."""
    n = T.n_words(text)
    caps = T.is_caps(text) & (n < 20)
    title = text.rlike(r"^(?:[^\p{L}]*\p{Lu}\p{Ll}*)+[^\p{L}]*$") & (n < 10) & ~text.endswith(".")
    return F.when((size >= 18) | (caps & (n < 12)), 1).when((size >= 14) | caps, 2).when((size >= 12) & (title | caps) & (n < 15), 3).otherwise(0)


def blocks_to_markdown(blocks: DataFrame, key: str, order: str, text: str = "text", size: str = "size") -> DataFrame:
    """(key, md): blocks in order, headings marked, list items one line, paragraphs apart."""
    t, level = T.strip(F.col(text)), heading_level(T.strip(F.col(text)), F.col(size))
    item = t.rlike(r"^([•·-]|\d+[.)])\s")
    line = F.when(level > 0, F.concat(F.lit("\n"), F.repeat(F.lit("#"), level), F.lit(" "), t, F.lit("\n"))).when(item, F.regexp_replace(t, r"^(\d+)\)\s*", "$1. ")).otherwise(F.concat(t, F.lit("\n")))
    return blocks.select(key, F.col(order).alias("_o"), line.alias("_l")).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_l"))), lambda s: s["_l"]), "\n").alias("md"))


# ------------------------------------------------------------------ bibliographic records


def biblio_issues(json: Column) -> Column:
    """Array of structs (level, message) for one record; a missing key ends the checks."""
    top = F.coalesce(F.from_json(json, "map<string,string>"), F.create_map().cast("map<string,string>"))
    keys = F.json_object_keys(json)
    need = F.array(*map(F.lit, rules.BIBLIO_KEYS))
    error = lambda m: F.struct(F.lit("error").alias("level"), m.alias("message"))
    missing = F.transform(F.array_sort(F.array_except(need, keys)), lambda k: error(F.concat(F.lit("missing key "), k)))
    extra = F.transform(F.array_sort(F.array_except(keys, need)), lambda k: error(F.concat(F.lit("extra key "), k)))
    v = lambda k: F.coalesce(F.element_at(top, F.lit(k)), F.lit(""))
    authors = F.from_json(v("Authors"), "array<map<string,string>>")
    body = F.from_json(v("CorporateAuthor"), "map<string,string>")
    name = F.coalesce(F.element_at(body, F.lit("Name")), F.lit(""))
    wrong_author = F.exists(authors, lambda a: F.size(F.array_except(F.map_keys(a), F.array(F.lit("Last"), F.lit("First")))) + F.size(F.array_except(F.array(F.lit("Last"), F.lit("First")), F.map_keys(a))) > 0)
    when = lambda c, m: F.when(c, error(F.lit(m)))
    warn = lambda c, m: F.when(c, F.struct(F.lit("warning").alias("level"), F.lit(m).alias("message")))
    rest = F.array_compact(
        F.array(
            when(~v("SourceType").isin(rules.SOURCE_TYPES), "SourceType"),
            when(~v("AuthorType").isin(rules.AUTHOR_TYPES), "AuthorType"),
            when(authors.isNull(), "Authors is no array"),
            when(F.coalesce(wrong_author, F.lit(False)), "Authors entry"),
            when(body.isNull(), "CorporateAuthor is no object"),
            when(body.isNotNull() & ~F.coalesce(F.map_keys(body) == F.array(F.lit("Name")), F.lit(False)), "CorporateAuthor keys"),
            when((v("AuthorType") == "person") & (F.size(authors) == 0), "person without authors"),
            when((v("AuthorType") == "person") & (name != ""), "person with a corporate name"),
            when((v("AuthorType") == "corporate") & (F.size(authors) > 0), "corporate with authors"),
            when((v("AuthorType") == "corporate") & (name == ""), "corporate without a name"),
            when(~v("Year").rlike(r"^(\d{4})?$"), "Year"),
            when(~v("Tag").rlike("^[A-Za-z0-9_-]+$"), "Tag"),
            warn((v("Tag") != "") & ~v("Tag").rlike(r"\d{4}"), "Tag without a year"),
            warn(F.size(authors) > 10, "many authors"),
        )
    )
    none = F.array().cast("array<struct<level:string,message:string>>")
    return F.when(keys.isNull(), F.array(error(F.lit("no JSON object")))).otherwise(F.concat(missing, extra, F.when(F.size(missing) == 0, rest).otherwise(none)))


def citation(author: Column, year: Column, title: Column, container: Column, volume: Column, issue: Column, pages: Column, publisher: Column, place: Column, url: Column) -> Column:
    """One reference line; absent parts are left out."""
    some = lambda x: F.nullif(T.strip(x), F.lit(""))
    dotted = F.when(author.endswith("."), author).otherwise(F.concat(author, F.lit(".")))
    vol = F.concat(some(volume), F.coalesce(F.concat(F.lit("("), some(issue), F.lit(")")), F.lit("")))
    journal = F.concat(F.concat_ws(", ", F.concat(F.lit("*"), some(container), F.lit("*")), vol, some(pages)), F.lit("."))
    return F.concat_ws(" ", F.when(some(author).isNotNull(), dotted), F.concat(F.lit("("), some(year), F.lit(").")), F.concat(F.lit("*"), some(title), F.lit("*.")), F.when(some(container).isNotNull(), journal).otherwise(F.coalesce(F.concat(some(publisher), F.lit(".")), F.concat(some(place), F.lit(".")))), some(url))


def date_of(text: Column) -> Column:
    """yyyy-MM-dd of the first date: d de mes de yyyy, dd/mm/yyyy, yyyy-mm-dd, or a year alone as January 1.

    Digits within a word or a longer number, a link or a DOI are no year.
    """
    low = F.lower(text)
    months = F.create_map(*(F.lit(x) for kv in rules.MONTHS.items() for x in kv))
    long = r"(\d{1,2})\s+de\s+([a-z]+)\s+(?:de|del)\s+(\d{4})"
    month = F.element_at(months, F.nullif(F.regexp_extract(low, long, 2), F.lit("")))
    spelled = F.when(month.isNotNull(), F.format_string("%s-%02d-%02d", F.regexp_extract(low, long, 3), month, F.regexp_extract(low, long, 1).try_cast("int")))
    slashed = F.when(low.rlike(r"\d{1,2}/\d{1,2}/\d{4}"), F.format_string("%s-%02d-%02d", F.regexp_extract(low, r"(\d{1,2})/(\d{1,2})/(\d{4})", 3), F.regexp_extract(low, r"(\d{1,2})/(\d{1,2})/(\d{4})", 2).try_cast("int"), F.regexp_extract(low, r"(\d{1,2})/(\d{1,2})/(\d{4})", 1).try_cast("int")))
    iso = F.nullif(F.regexp_extract(low, r"\d{4}-\d{2}-\d{2}", 0), F.lit(""))
    plain = F.regexp_replace(low, r"https?://\S+|(?<![\p{L}\p{N}])10\.\d{4,9}/\S+", " ")
    year = F.nullif(F.regexp_extract(plain, r"(?<![\p{L}\p{N}])(?:19|20)\d{2}(?![\p{L}\p{N}])", 0), F.lit(""))
    return F.coalesce(spelled, slashed, iso, F.concat(year, F.lit("-01-01")))


def document_type(text: Column) -> Column:
    return T.cascade(F.upper(text), rules.DOCUMENT_TYPES, "Otro")


def issuer(text: Column) -> Column:
    return T.cascade(F.upper(text), [(x, x) for x in rules.ISSUERS], "")


def file_code(doi: Column, number: Column, title: Column, stem: Column) -> Column:
    """DOI, else a long number, else a title of some length, else the stem, else DOC."""
    some = lambda x: F.nullif(x, F.lit(""))
    return F.coalesce(F.regexp_replace(some(doi), r"[/.\-]", "_"), F.when(F.length(number) >= 10, number), F.when(F.length(title) > 15, some(T.slug(title))), some(stem), F.lit("DOC"))


def tags(records: DataFrame, author: str, year: str, word: str, order: str) -> DataFrame:
    """Adds tag: author, year and keyword; repeats get b, c ... in order."""
    base = F.concat(F.initcap(T.match_key(F.col(author))), F.col(year), F.initcap(T.match_key(F.col(word))))
    n = F.row_number().over(Window.partitionBy("_b").orderBy(order))
    return records.withColumn("_b", F.regexp_replace(base, " ", "")).withColumn("_n", n).withColumn("tag", F.concat("_b", F.when(F.col("_n") > 1, F.chr(F.lit(96) + F.col("_n"))).otherwise(""))).drop("_b", "_n")


# ------------------------------------------------------------------ names of files

NAME = rf"^{rules.PROGRAM}_({'|'.join(rules.PRODUCTS)})_({'|'.join(rules.STATES)})_({'|'.join(rules.FILE_TYPES)})_V(\d+\.\d+)(\.[a-z]+)$"


def parse_name(name: Column) -> Column:
    """Struct (ok, product, state, kind, version, extension) of a file name."""
    part = lambda k: F.nullif(F.regexp_extract(name, NAME, k), F.lit(""))
    return F.struct(name.rlike(NAME).alias("ok"), part(1).alias("product"), part(2).alias("state"), part(3).alias("kind"), F.concat(F.lit("V"), part(4)).alias("version"), part(5).alias("extension"))


def build_name(product: Column, state: Column, kind: Column, version: Column, extension: Column) -> Column:
    """The file name, or null where a part isn't allowed."""
    ok = product.isin(rules.PRODUCTS) & state.isin(rules.STATES) & kind.isin(rules.FILE_TYPES) & version.rlike(r"^V\d+\.\d+$") & extension.isin(rules.EXTENSIONS)
    return F.when(ok, F.concat(F.concat_ws("_", F.lit(rules.PROGRAM), product, state, kind, version), extension))


# ------------------------------------------------------------------ gates and ids


def latest(rows: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("_n = 1").drop("_n")


def sequence(rows: DataFrame, keys: tuple[str, ...], order: str, name: str = "n") -> DataFrame:
    """rows with their number, from 1, among those of their keys."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("long"))


def pending(expected: DataFrame, decisions: DataFrame, keys: tuple[str, ...], order: str = "id", decision: str = "decision", approved: str = "aprobado") -> DataFrame:
    """(keys, state): expected gates whose last decision is missing or no approval."""
    last = latest(decisions, keys, order).select(*keys, F.col(decision).alias("_d"))
    return expected.distinct().join(last, list(keys), "left").where(f"_d is null or _d <> '{approved}'").select(*keys, F.coalesce("_d", F.lit("nunca_registrado")).alias("state"))


def actor_ids(actors: DataFrame, name: str, order: str, prefix: str = "ACT-") -> DataFrame:
    """(order, name, actor_id, aliases): an id for the first row of each name; its later rows become aliases."""
    w = Window.partitionBy(name)
    rows = actors.where(T.strip(F.col(name)) != "").withColumn("_n", F.row_number().over(w.orderBy(order))).withColumn("_all", F.count("*").over(w))
    alias = F.when(F.col("_all") > 1, F.array_repeat(F.col(name), (F.col("_all") - 1).cast("int"))).otherwise(F.array().cast("array<string>"))
    return rows.where("_n = 1").select(order, name, T.id_of(prefix, F.col(name), 10).alias("actor_id"), alias.alias("aliases"))


# ------------------------------------------------------------------ constraints


def vocabulary_violations(rows: DataFrame, key: str, allowed: dict[str, list[str]]) -> DataFrame:
    """(key, field, value): values outside their closed lists; nulls are skipped."""
    long = rows.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in allowed))).alias("v")).select(key, "v.*").where("value is not null")
    known = rows.sparkSession.createDataFrame([(f, x) for f, xs in allowed.items() for x in xs], "field string, value string")
    return long.join(F.broadcast(known), ["field", "value"], "left_anti").select(key, "field", "value")


def check_report(table: DataFrame, name: str, not_null: list[str] = (), unique: list[str] = (), checks: dict[str, str] | None = None) -> DataFrame:
    """(table, rule, violations): one scan for all NOT NULL and CHECK rules, one sum by key for the unique ones."""
    rules_ = {**{f"not_null:{c}": f"`{c}` is null" for c in not_null}, **{f"check:{k}": f"not coalesce({v}, true)" for k, v in (checks or {}).items()}}
    counts = table.agg(*(F.count_if(F.expr(v)).alias(k) for k, v in rules_.items())) if rules_ else None
    out = None
    if counts is not None:
        out = counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), F.col(f"`{k}`").alias("violations")) for k in rules_))).alias("r")).select(F.lit(name).alias("table_name"), "r.rule", "r.violations")
    for cols in unique:
        one = table.groupBy(*cols.split(",")).count().where("count > 1").agg(F.count("*").alias("violations")).select(F.lit(name).alias("table_name"), F.lit(f"unique:{cols}").alias("rule"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str, name: str) -> DataFrame:
    """(table, rule, violations) of a foreign key."""
    return child.where(f"{fk} is not null").join(parent.select(F.col(pk).alias(fk)), fk, "left_anti").agg(F.count("*").alias("violations")).select(F.lit(name).alias("table_name"), F.lit(f"fk:{fk}").alias("rule"), "violations")


def stage_blockers(flags: DataFrame, stage: str, conditions: dict[str, str]) -> DataFrame:
    """(stage, blockers): names of the conditions that some row of a stage fails."""
    worst = flags.groupBy(stage).agg(*(F.bool_and(F.expr(c)).alias(k) for k, c in conditions.items()))
    return worst.select(stage, F.array_compact(F.array(*(F.when(~F.col(k), k) for k in conditions))).alias("blockers"))


# ------------------------------------------------------------------ JSON schemas and entity files

_KINDS = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean", "array": "array<string>", "object": "map<string,string>"}


def schema_issues(json: Column, schema: dict) -> Column:
    """Array of messages for one JSON object under a flat JSON schema.

    Understands required, additionalProperties false, and for properties type,
    enum, pattern, minimum, maximum and minLength. Nulls are skipped, except
    where a key is required.
    """
    top = F.coalesce(F.from_json(json, "map<string,string>"), F.create_map().cast("map<string,string>"))
    keys = F.json_object_keys(json)
    out = [F.when(keys.isNull(), "no JSON object")]
    for k in schema.get("required", []):
        out.append(F.when(~F.coalesce(F.array_contains(keys, k), F.lit(False)), f"missing {k}"))
    props = schema.get("properties", {})
    if schema.get("additionalProperties") is False:
        extra = F.array_except(keys, F.array(*map(F.lit, props)))
        out.append(F.when(F.size(extra) > 0, F.concat(F.lit("extra "), F.array_join(F.array_sort(extra), ","))))
    for k, p in props.items():
        v = F.element_at(top, F.lit(k))
        kind = p.get("type", "string")
        number = v.try_cast("double")
        if kind in ("integer", "number"):
            out.append(F.when(v.isNotNull() & (number.isNull() | ((number != F.floor(number)) if kind == "integer" else F.lit(False))), f"{k} is no {kind}"))
        elif kind in ("array", "object"):
            out.append(F.when(v.isNotNull() & F.from_json(v, _KINDS[kind]).isNull(), f"{k} is no {kind}"))
        if "enum" in p:
            out.append(F.when(v.isNotNull() & ~v.isin([str(x) for x in p["enum"] if x is not None]), f"{k} not in its list"))
        if "pattern" in p:
            out.append(F.when(v.isNotNull() & ~v.rlike(p["pattern"]), f"{k} has another form"))
        if "minimum" in p:
            out.append(F.when(number < p["minimum"], f"{k} below {p['minimum']}"))
        if "maximum" in p:
            out.append(F.when(number > p["maximum"], f"{k} above {p['maximum']}"))
        if "minLength" in p:
            out.append(F.when(F.length(v) < p["minLength"], f"{k} too short"))
    return F.array_compact(F.array(*out))


def entity_issues(entities: DataFrame, sections: DataFrame, job: str = "job", section: str = "section") -> DataFrame:
    """(job, section, entity, issue): types and layers outside their lists, sections that don't exist."""
    base = entities.select(job, section, "entity", "type", "layer")
    listed = base.select(job, section, "entity", F.explode(F.array_compact(F.array(F.when(~F.col("type").isin(rules.ENTITY_TYPES), "type"), F.when(~F.col("layer").isin(rules.LAYERS), "layer")))).alias("issue"))
    lost = base.join(sections.select(job, section).distinct(), [job, section], "left_anti").select(job, section, "entity", F.lit("section").alias("issue"))
    return listed.unionByName(lost)


def job_status(issues: DataFrame, job: str = "job", severe: str = "severe") -> DataFrame:
    """(job, status): fail with a severe issue, warn with any, else OK."""
    return issues.groupBy(job).agg(F.when(F.bool_or(severe), "fail").when(F.bool_or(F.col(severe).isNotNull()), "warn").otherwise("OK").alias("status"))
