"""Style rules over paragraphs (doc, par, text): findings, examples, automatic fixes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T

U = r"(?<![\p{L}\p{N}_])"
V = r"(?![\p{L}\p{N}_])"
PAGE = r"(?iu)\bp[aá]g\.?\s+(\d+)"
BIS = r"(?i)\bArt\.?\s*(\d+)\.(\d+)\b(?!.*\bBis\b)"
QUOTE = r'"([^"]{20,})"'
#: Words of quoted law, in this case.
LEGAL = ["artículo", "articulo", "ley", "LEY", "se establece", "dispone"]


def _any(literals: list[str], whole: bool) -> str:
    body = "|".join(map(re.escape, literals))
    return f"(?iu){U}({body}){V}" if whole else f"(?iu)({body})"


#: rule: (severity, automatic, pattern whose group 1 or whole match is the finding)
DETECTORS = {
    "filler": ("WARNING", True, _any(rules.FILLER, False)),
    "first_person": ("ERROR", False, _any(rules.FIRST_PERSON, True)),
    "absolute": ("WARNING", False, f"(?iu){U}({'|'.join(map(re.escape, rules.ABSOLUTES))}){V}"),
    "page": ("ERROR", True, PAGE),
    "bis": ("ERROR", True, BIS),
}


def findings(paragraphs: DataFrame, keys: tuple[str, ...] = ("doc", "par"), text: str = "text") -> DataFrame:
    """(keys, rule, severity, automatic, match) of all pattern rules, long sentences, capitals and straight quotes."""
    x = F.col(text)
    row = lambda r, sev, auto, m: F.struct(F.lit(r).alias("rule"), F.lit(sev).alias("severity"), F.lit(auto).alias("automatic"), m.alias("match"))
    def hits(rule: str, severity: str, automatic: bool, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), lambda m: row(rule, severity, automatic, m))

    found = [hits(r, *d) for r, d in DETECTORS.items()]
    long = F.filter(F.split(x, "[.!?]+"), lambda s: T.n_words(s) > rules.LONG_SENTENCE)
    found.append(F.transform(long, lambda s: row("long_sentence", "WARNING", False, F.substring(T.strip(s), 1, 80))))
    found.append(F.when(T.is_caps(x) & (T.n_words(x) > 3), F.array(row("capitals", "WARNING", False, F.substring(x, 1, 80)))).otherwise(F.array().cast("array<struct<rule:string,severity:string,automatic:boolean,match:string>>")))
    quotes = F.filter(F.regexp_extract_all(x, F.lit(QUOTE), F.lit(1)), lambda q: ~T.contains_any(q, ["http", "www."]) & T.contains_any(q, LEGAL))
    found.append(F.transform(quotes, lambda q: row("quotes", "WARNING", True, q)))
    return paragraphs.select(*keys, F.explode(F.flatten(F.array(*found))).alias("f")).select(*keys, "f.*")


def table_findings(cells: DataFrame, doc: str = "doc", table: str = "tab", row: str = "row", text: str = "cells", longest: int = 500) -> DataFrame:
    """(doc, table, row, rule, severity, match) of tables given as rows of cells, the first of which is the header.

    A header of which more than half the cells are blank; cells of the body of
    more than `longest` characters, with their first 100.
    """
    first = F.min(row).over(Window.partitionBy(doc, table))
    rows = cells.select(doc, table, row, F.transform(text, T.strip).alias("_c"), first.alias("_first"))
    blank = F.size(F.filter("_c", lambda x: x == ""))
    found = lambda rule, severity, m: F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), m.alias("match"))
    none = F.array().cast("array<struct<rule:string,severity:string,match:string>>")
    head = F.when((F.col(row) == F.col("_first")) & (blank > F.size("_c") * 0.5), F.array(found("table_header", "WARNING", F.lit("")))).otherwise(none)
    body = F.when(F.col(row) > F.col("_first"), F.transform(F.filter("_c", lambda x: F.length(x) > longest), lambda x: found("long_cell", "INFO", F.substring(x, 1, 100)))).otherwise(none)
    return rows.select(doc, table, row, F.explode(F.concat(head, body)).alias("f")).select(doc, table, row, "f.*")


def missing_references(paragraphs: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, rule, severity) of documents that never name a section of references."""
    by = paragraphs.groupBy(doc).agg(F.bool_or(F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit(rules.REFERENCES_WORD))).alias("_has"))
    return by.where("not _has").select(doc, F.lit("no_references").alias("rule"), F.lit("WARNING").alias("severity"))


def undefined_acronyms(paragraphs: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, acronym): used somewhere without a definition beside it, and defined nowhere in the document."""
    used = F.array(*(F.struct(F.lit(a).alias("acronym"), F.col(text).rlike(rf"(?i)\b{a}\b(?!\s+\([A-Z])").alias("used"), F.col(text).rlike(rf"(?i)\b{a}\s*\([A-Z]").alias("defined")) for a in rules.ACRONYMS))
    by = paragraphs.select(doc, F.explode(used).alias("u")).groupBy(doc, "u.acronym").agg(F.bool_or("u.used").alias("used"), F.bool_or("u.defined").alias("defined"))
    return by.where("used and not defined").select(doc, "acronym")


def examples(found: DataFrame, most: int = 5, order: tuple[str, ...] = ("doc", "par")) -> DataFrame:
    """The first findings of each rule."""
    return found.withColumn("n", F.row_number().over(Window.partitionBy("rule").orderBy(*order, "match"))).where(F.col("n") <= most)


def fixed(text: Column) -> Column:
    """Pages, bis numbers, quotes, filler, in this order."""
    x = F.regexp_replace(text, PAGE, "p. $1")
    x = F.regexp_replace(x, r"(?i)\b(Art\.?\s*\d+)\.(\d+)\b(?!.*\bBis\b)", "$1 Bis")
    x = F.regexp_replace(x, QUOTE, "«$1»")
    return T.strip(F.regexp_replace(F.regexp_replace(x, r"(?iu)(" + "|".join(map(re.escape, rules.FILLER)) + r"),?\s*", ""), " {2,}", " "))


def text_mode(text: Column) -> Column:
    return F.when((T.n_words(text) < 500) & ~text.rlike(r"(?m)^#{1,6}\s"), "fragmento").otherwise("documento")
