"""Long-text scans: articles over page borders, reform notes, titles, table runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T

ARTICLE = r"(?iu)\n\s*ART[IÍ]CULO\s+(\d+)\s*([°º.]*\s*(?:bis|ter|quater))?"
STOP = r"(?iu)\n\s*(?:CAP[IÍ]TULO|T[IÍ]TULO|SECCI[OÓ]N|TRANSITORIOS)\b"
REFORM = r"(?iu)\b(reformad|adicionad|derogad|p\.\s*o\.|d\.\s*o\.\s*f\.)"


def is_index_page(body: Column) -> Column:
    """Tables of contents, by words near the top."""
    low = T.strip_accents(F.lower(F.substring(body, 1, 500)))
    return low.contains("indice") | (F.substring(low, 1, 300).contains("articulos") & low.contains("pagina"))


def kept_lines(body: Column, least: int = 30) -> Column:
    """The first run of lines that are long enough and no reform notes; all lines if there is none.

    A fold over the lines: state 0 before the run, 1 in it, 2 after it.
    """
    lines = F.filter(F.transform(F.split(body, "\n"), T.strip), lambda x: x != "")
    good = lambda x: (F.length(x) >= least) & ~x.rlike(REFORM)
    start = F.struct(F.lit(0).alias("state"), F.array().cast("array<string>").alias("kept"))

    def step(s: Column, x: Column) -> Column:
        take = good(x) & (s["state"] < 2)
        state = F.when(s["state"] == 2, 2).when(good(x), 1).when(s["state"] == 1, 2).otherwise(0)
        return F.struct(state.alias("state"), F.when(take, F.concat(s["kept"], F.array(x))).otherwise(s["kept"]).alias("kept"))

    kept = F.aggregate(lines, start, step, lambda s: s["kept"])
    return F.array_join(F.when(F.size(kept) > 0, kept).otherwise(lines), " ")


def global_articles(pages: DataFrame, key: str, page: str = "page", body: str = "body", cap: int = 1800, least: int = 50) -> DataFrame:
    """(key, number, suffix, page, body) of articles that may run over pages.

    Index pages are left out; an article ends at the next article or structural
    line; its page is that of its head, carried over the pages' marks; the first
    of a number counts.
    """
    usable = pages.where(~is_index_page(F.col(body)))
    whole = usable.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(body).alias("b")))).alias("ps"))
    text = F.array_join(F.transform("ps", lambda x: F.concat(F.lit("\n\u0001"), x["p"].cast("string"), F.lit("\u0002\n"), x["b"])), "\n")
    cut = whole.select(key, text.alias("t"))
    heads = F.regexp_extract_all("t", F.lit(ARTICLE), F.lit(1))
    marks = F.regexp_extract_all("t", F.lit(ARTICLE), F.lit(2))
    parts = F.split("t", ARTICLE)
    rows = cut.select(key, F.get(parts, F.lit(0)).alias("lead"), F.posexplode(F.arrays_zip(heads.alias("n"), marks.alias("s"), F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))).alias("b"))).alias("_at", "a"))
    at = lambda x: F.element_at(F.regexp_extract_all(x, F.lit("\u0001(\\d+)\u0002"), F.lit(1)), F.lit(-1))
    rows = rows.select(key, "_at", F.col("a.n").cast("int").alias("number"), F.nullif(T.strip(F.regexp_replace(F.lower(F.col("a.s")), r"[°º.]", "")), F.lit("")).alias("suffix"), F.col("a.b").alias("raw"), F.col("lead"))
    last_mark = F.when(F.col("raw").contains("\u0001"), at(F.col("raw")).cast("int"))
    w = Window.partitionBy(key).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    first_mark = F.when(F.col("lead").contains("\u0001"), at(F.col("lead")).cast("int"))
    placed = rows.withColumn("page", F.coalesce(F.last(last_mark, ignorenulls=True).over(w), first_mark))
    clean = F.regexp_replace(F.get(F.split("raw", STOP), F.lit(0)), "\n?\u0001\\d+\u0002\n?", "\n")
    found = placed.withColumn("body", F.substring(kept_lines(clean), 1, cap)).where(F.length("body") >= least)
    first = Window.partitionBy(key, "number", "suffix").orderBy("_at")
    return found.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(key, "number", "suffix", "page", "body")


def number_label(number: Column, suffix: Column) -> Column:
    """28 with bis is "28 Bis"."""
    return F.concat_ws(" ", number.cast("string"), F.initcap(suffix))


def listed_or_relevant(articles: DataFrame, listed: DataFrame, key: str, number: str = "number", suffix: str = "suffix", body: str = "body") -> DataFrame:
    """Articles that a list names; where it names none of a law, those with a relevant word."""
    listed = listed.select(F.col(key).alias("_k"), F.col(number).alias("_n"), F.col(suffix).alias("_s")).distinct()
    named = articles.join(listed, (F.col(key) == F.col("_k")) & (F.col(number) == F.col("_n")) & F.col(suffix).eqNullSafe(F.col("_s")), "left_semi")
    has = named.select(key).distinct()
    rest = articles.join(has, key, "left_anti").where(T.contains_any(F.lower(F.col(body)), rules.RELEVANCE_LITERALS))
    return named.unionByName(rest)


def title(lines: Column, most: int = 350) -> Column:
    """The most title-like of the first 50 lines: no boilerplate, few numbers and commas, a type word in front if any."""
    some = F.slice(F.filter(F.transform(lines, T.strip), lambda x: (F.length(x) > 8) & ~x.rlike(r"(?iu)^(p[aá]gina|www\.|http|diario oficial|tomo|n[uú]mero|fecha|\d+$)")), 1, 50)
    fit = F.filter(some, lambda x: (F.regexp_count(x, F.lit(r"\d+")) < 3) & (F.regexp_count(x, F.lit("[,;]")) < 4))
    named = F.filter(fit, lambda x: F.upper(x).rlike("^(" + "|".join(w for w, _ in rules.DOCUMENT_TYPES) + "|LEY)"))
    return F.substring(F.coalesce(F.get(named, F.lit(0)), F.get(fit, F.lit(0)), F.get(some, F.lit(0))), 1, most)


def table_runs(lines: DataFrame, key: str, order: str, line: str) -> DataFrame:
    """(key, run, first, last, rows): consecutive pipe lines as tables (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(order)
    piped = T.strip(F.col(line)).startswith("|")
    flagged = lines.withColumn("_p", piped).withColumn("_new", (F.col("_p") & ~F.coalesce(F.lag("_p").over(w), F.lit(False))).cast("int"))
    runs = flagged.withColumn("run", F.sum("_new").over(w)).where("_p")
    return runs.groupBy(key, "run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("rows"))


def interpretation(text: Column, ordered: list[tuple[str, str]], default: str) -> Column:
    """The text of the first rule (pattern, outcome) that holds, of any number of rules."""
    out = None
    for pattern, outcome in ordered:
        out = F.when(text.rlike(pattern), outcome) if out is None else out.when(text.rlike(pattern), outcome)
    return F.lit(default) if out is None else out.otherwise(default)


def cleaned_response(text: Column) -> Column:
    """Reasoning blocks and code fences removed, white space trimmed."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?is)<think(?:ing)?>.*?</think(?:ing)?>", ""), r"(?m)^```\w*\s*$", "")
    return T.strip(bare)
