"""Sections, entities, legal units: what documents are cut into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T


def line_sections(docs: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, keep, section, body): every line with text is a section."""
    return docs.select(key, *keep, F.posexplode(F.split(text, "\n")).alias("section", "body")).where(T.strip(F.col("body")) != "")


def markdown_sections(docs: DataFrame, key: str, text: str, intro: str = "(inicio)") -> DataFrame:
    """(key, section_no, heading, body): Markdown cut at its headings.

    Text before the first heading is under `intro`; a heading without lines has no
    section. The heading is carried forward by a window over the lines of one
    document, so a document must fit in a task; documents are spread by key.
    """
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line")).withColumn("heading", F.nullif(F.regexp_extract("line", rules.HEADING_LINE, 1), F.lit("")))
    upto = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumn("section_no", F.count("heading").over(upto)).withColumn("title", F.coalesce(F.last("heading", ignorenulls=True).over(upto), F.lit(intro)))
    body = placed.where("heading is null").groupBy(key, "section_no").agg(F.first("title").alias("heading"), F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    return body.select(key, "section_no", "heading", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("body"))


def capital_entities(sections: DataFrame, body: str = "body", pattern: str = "[A-Z][a-z]{4,}") -> DataFrame:
    """sections with `entity`: each capitalised token."""
    return sections.withColumn("entity", F.explode(F.regexp_extract_all(F.col(body), F.lit(pattern), F.lit(0))))


def pattern_entities(sections: DataFrame, keep: tuple[str, ...], body: str = "body", default_layer: Column | None = None, patterns: list[tuple[str, str]] = rules.ENTITY_PATTERNS) -> DataFrame:
    """(keep, entity, type, layer, context) of every pattern match; all patterns in one pass over the rows.

    The context is the text around each match itself: matches of a pattern don't
    overlap and come in order, so each is looked for after the one before it.
    """

    def matches(kind: str, pattern: str) -> Column:
        none = F.array().cast("array<struct<type:string,entity:string,at:int>>")
        start = F.struct(F.lit(1).alias("next"), none.alias("hits"))

        def step(s: Column, e: Column) -> Column:
            at = F.call_function("locate", e, F.col("_body"), s["next"])
            hit = F.struct(F.lit(kind).alias("type"), e.alias("entity"), at.alias("at"))
            return F.struct((at + F.length(e)).alias("next"), F.concat(s["hits"], F.array(hit)).alias("hits"))

        return F.aggregate(F.regexp_extract_all(F.col("_body"), F.lit(pattern), F.lit(1)), start, step, lambda s: s["hits"])

    found = [matches(t, p) for t, p in patterns]
    hits = sections.select(*keep, F.col(body).alias("_body")).select(*keep, "_body", F.explode(F.flatten(F.array(*found))).alias("hit"))
    layer = layer_of(F.col("hit.type"), default_layer if default_layer is not None else F.lit("informal"))
    return hits.select(*keep, "hit.entity", "hit.type", layer.alias("layer"), T.snippet(F.col("_body"), F.col("hit.at"), F.length("hit.entity")).alias("context"))


def layer_of(kind: Column, default: Column) -> Column:
    return F.when(kind == "NORMA", "normativo").when(kind == "DOCUMENTO", "operativo").otherwise(F.coalesce(default, F.lit("informal")))


def dictionary_entities(sections: DataFrame, dictionary: DataFrame, keep: tuple[str, ...], body: str = "body", entry: str = "entry") -> DataFrame:
    """(keep, entry): each dictionary entry once per section that has it, whole words, any case.

    Tokens are joined with the entries' tokens (an equi-join of any size), and an
    entry is there if all its tokens meet at one place: hits are summed by
    (section, entry, place of the first token).
    """
    tokens = F.posexplode(T.letter_tokens(F.col(entry))).alias("_k", "_token")
    entries = dictionary.select(entry, F.size(T.letter_tokens(F.col(entry))).alias("_size"), tokens)
    rows = sections.select(*keep, F.posexplode(T.letter_tokens(F.col(body))).alias("_pos", "_token"))
    hits = rows.join(entries, "_token").groupBy(*keep, entry, "_size", (F.col("_pos") - F.col("_k")).alias("_at")).agg(F.count("*").alias("_n"))
    return hits.where("_n = _size").select(*keep, entry).distinct()


def pages_of(docs: DataFrame, key: str, text: str, mark: str = rules.PAGE_MARK) -> DataFrame:
    """(key, page, body): text cut at page marks; what stands before the first is page 0."""
    bodies = F.split(F.col(text), mark)
    numbers = F.concat(F.array(F.lit("0")), F.regexp_extract_all(F.col(text), F.lit(mark), F.lit(1)))
    return docs.select(key, F.explode(F.arrays_zip(numbers.alias("page"), bodies.alias("body"))).alias("p")).select(key, F.col("p.page").cast("int").alias("page"), T.strip(F.col("p.body")).alias("body")).where("body <> ''")


def page_articles(pages: DataFrame, key: str, page: str = "page", body: str = "body", cap: int = 2000) -> DataFrame:
    """(key, page, number, body): articles of each page by itself, up to the next article or the page's end."""
    text = F.concat(F.lit("\n"), F.col(body))
    bodies, numbers = F.split(text, rules.PAGE_ARTICLE), F.regexp_extract_all(text, F.lit(rules.PAGE_ARTICLE), F.lit(1))
    zipped = F.arrays_zip(numbers.alias("number"), F.slice(bodies, F.lit(2), F.greatest(F.size(bodies), F.lit(1))).alias("body"))
    rows = pages.select(key, page, F.explode(zipped).alias("a"))
    return rows.select(key, page, F.col("a.number").cast("int").alias("number"), F.substring(T.strip(F.col("a.body")), 1, cap).alias("body"))


def segments(docs: DataFrame, key: str, text: str, mark: str, cap: int = 2000) -> DataFrame:
    """(key, unit, label, body): text from each match of `mark` (group 1 is the label) to the next.

    What stands before the first match is dropped; bodies are cut at `cap`
    characters. The cut is made with arrays of one row: nothing is shuffled.
    """
    bodies = F.slice(F.split(F.col(text), mark), F.lit(2), F.greatest(F.size(F.split(F.col(text), mark)), F.lit(1)))
    labels = F.regexp_extract_all(F.col(text), F.lit(mark), F.lit(1))
    rows = docs.select(key, F.posexplode(F.arrays_zip(labels.alias("label"), bodies.alias("body"))).alias("unit", "s"))
    return rows.select(key, (F.col("unit") + 1).alias("unit"), T.strip(F.col("s.label")).alias("label"), F.substring(T.strip(F.col("s.body")), 1, cap).alias("body"))


def legal_units(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, article, fraction, body, stage, dimension): articles, and the fractions in them.

    A text without articles is one unit "Único" with its first 1,000 characters;
    an article without fractions is a unit with a null fraction; empty fractions
    are dropped.
    """
    has = F.col(text).rlike(rules.ARTICLE_LINE)
    alone = docs.where(~has).select(key, F.lit("Único").alias("article"), F.lit(None).cast("string").alias("fraction"), F.substring(text, 1, 1000).alias("body"))
    articles = segments(docs.where(has), key, text, rules.ARTICLE_LINE, 1 << 30).withColumnRenamed("label", "article")
    split = F.col("body").rlike(rules.FRACTION_LINE)
    plain = articles.where(~split).select(key, "article", F.lit(None).cast("string").alias("fraction"), F.substring("body", 1, 2000).alias("body"))
    parts = F.arrays_zip(F.regexp_extract_all("body", F.lit(rules.FRACTION_LINE), F.lit(1)).alias("fraction"), F.slice(F.split("body", rules.FRACTION_LINE), F.lit(2), F.size(F.split("body", rules.FRACTION_LINE))).alias("body"))
    inner = articles.where(split).select(key, "article", F.explode(parts).alias("p")).select(key, "article", "p.fraction", F.substring(T.strip(F.col("p.body")), 1, 2000).alias("body")).where("body <> ''")
    units = alone.unionByName(plain).unionByName(inner)
    low = F.lower("body")
    return units.withColumn("stage", T.best_by_keywords(low, rules.STAGE_KEYWORDS, "Integración")).withColumn("dimension", T.best_by_keywords(low, rules.DIMENSION_KEYWORDS, "Ejecución"))


def level(text: Column) -> Column:
    return T.cascade_patterns(text, rules.LEVELS, "Federal")


def hierarchy(text: Column) -> Column:
    return T.cascade(F.upper(text), rules.HIERARCHY, "Otro")


def norm_name(text: Column) -> Column:
    """The first of 30 lines that begins like a norm, else the first line; 200 characters."""
    lines = F.slice(F.filter(F.transform(F.split(text, "\n"), T.strip), lambda x: x != ""), 1, 30)
    named = F.filter(lines, lambda x: F.upper(x).rlike("^(LEY|CÓDIGO|CONSTITUCIÓN|REGLAMENTO|DECRETO|LINEAMIENTO|MANUAL|CONVENIO|ACUERDO|NOM)"))
    return F.substring(F.coalesce(F.get(named, F.lit(0)), F.get(lines, F.lit(0))), 1, 200)


def relevant(units: DataFrame, norm: str, number: str, body: str, top: int = 8, least: int = 1) -> DataFrame:
    """The `top` units of each norm by relevance, then number."""
    # a generator's column: the filter can't be moved below it, where it would compute the score again
    scored = units.select("*", F.explode(F.array(T.pattern_score(T.strip_accents(F.col(body)), rules.RELEVANCE_PATTERNS))).alias("score")).where(F.col("score") >= least)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(norm).orderBy(F.desc("score"), number))).where(F.col("rank") <= top)
