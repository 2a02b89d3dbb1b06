"""Bibliographic records from texts: titles, authors, places, media, numbers, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import text as T
from lexmesh.operators import records


def squeeze(x: Column) -> Column:
    return T.strip(F.regexp_replace(x, r"\s+", " "))


def lines_of(text: Column) -> Column:
    """Trimmed lines that aren't blank."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), T.strip), lambda x: x != "")


def _some(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def _any(x: Column, patterns: list[str]) -> Column:
    return x.rlike("(?iu)" + "|".join(f"(?:{p})" for p in patterns))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def paper(text: Column) -> Column:
    """Struct (title, author) of a scientific paper, or null.

    A paper has a line of keywords among its first ten. Its author's line ends
    in an asterisk; the title is made of the lines right above that look like one.
    """

    def found(lines: Column) -> Column:
        keyed = F.exists(F.slice(lines, 1, 10), lambda x: x.rlike("(?iu)" + rules.PAPER_WORDS))
        is_author = lambda x: x.rlike(r"[A-Za-zÀ-ÿ]\s*\*\s*$") & F.length(x).between(5, 80) & ~x.endswith("**") & ~x.startswith("Cómo") & ~x.startswith("Como")
        at = F.array_position(F.transform(F.slice(lines, 1, 50), is_author), True).cast("int")  # from 1; 0 if none
        low = F.greatest(F.lit(2), at - 5)  # the first line of a text is never taken
        above = F.when(at > low, F.reverse(F.slice(lines, low, F.greatest(at - low, F.lit(0))))).otherwise(F.array().cast("array<string>"))
        fits = lambda x: ~x.rlike("(?iu)" + rules.PAPER_PARTS) & F.length(x).between(5, 150) & ~x.rlike(r"@|\.mx|\.com|\.unam") & ~x.rlike("(?iu)" + rules.PAPER_NOTE)
        start = F.struct(F.lit(True).alias("go"), F.array().cast("array<string>").alias("kept"))
        kept = F.aggregate(above, start, lambda s, x: F.struct((s["go"] & fits(x)).alias("go"), F.when(s["go"] & fits(x), F.concat(s["kept"], F.array(x))).otherwise(s["kept"]).alias("kept")), lambda s: s["kept"])
        title = squeeze(F.array_join(F.reverse(kept), " "))
        author = T.strip(F.regexp_replace(F.get(lines, at - 1), r"\*+$", ""))
        return F.when(keyed & (at > 0) & F.length(title).between(15, 300), F.struct(title.alias("title"), author.alias("author")))

    return _let(lines_of(text), found)


def _uppers(x: Column, digits: bool = False) -> Column:
    return F.regexp_count(x, F.lit(r"[\p{Lu}\p{Nd}]" if digits else r"\p{Lu}"))


def _line_kind(x: Column) -> Column:
    """0 a break, 1 of no interest, 2 a juridical paragraph, 3 a reference to another norm, 4 title words, 5 the same, but it may go on a paragraph."""
    text = F.upper(x)
    dull = (F.length(x) < 20) | _any(x, rules.TITLE_SKIP) | x.rlike("(?iu)" + rules.TITLE_OPENINGS)
    law = (F.regexp_count(x, F.lit("(?iu)" + rules.JURIDICAL)) >= 2) | (F.regexp_count(x, F.lit(r"\b\d+\b|\b[IVX]+\b")) >= 3) | (F.regexp_count(x, F.lit("[,;]")) >= 4)
    law = law | text.rlike(rules.TITLE_HEADINGS) | x.rlike("(?iu)" + rules.TITLE_GAZETTE)
    goes_on = x.rlike(r"^\s*[IVX]+\s*,\s+\d") | x.rlike(r"^\p{Ll}")
    return F.when(dull, 0).when(~T.contains_any(text, rules.TITLE_WORDS), 1).when(law, 2).when(x.rlike("(?iu)" + rules.TITLE_REFERENCE), 3).when(goes_on, 5).otherwise(4)


def _continued(lines: Column, at: Column, most: int = 350) -> Column:
    """The title at line `at` (from 0) with the lines that go on with it."""

    def takes(so_far: Column, x: Column) -> Column:
        stop = x.rlike("(?iu)" + rules.TITLE_STOP)
        short = F.length(x) < 30
        return (F.length(so_far) + F.length(x) <= most) & F.when(short, ~stop & (_uppers(x, True) >= F.length(x) * 0.7)).when(x.rlike(r"^\p{Ll}"), F.lit(True)).otherwise((_uppers(x) >= F.length(x) * 0.5) & ~stop)

    start = F.struct(F.lit(True).alias("go"), F.get(lines, at).alias("t"))
    # no line is empty, so `most` lines are more than a title can take
    rest = F.slice(lines, at + 2, F.lit(most))
    return F.aggregate(rest, start, lambda s, x: F.struct((s["go"] & takes(s["t"], x)).alias("go"), F.when(s["go"] & takes(s["t"], x), F.concat(s["t"], F.lit(" "), x)).otherwise(s["t"]).alias("t")), lambda s: s["t"])


def title_from_name(name: Column) -> Column:
    """A file's name as a title, or null if it says too little."""
    base = F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), r"^[Ff][Aa][Ss][Pp]_[\d_]+(?:[A-Z_]+)_", "")
    base = T.strip(F.replace(F.when(F.upper(base).isin("TDR_V1_0", "V1_0", "V1"), "").otherwise(base), F.lit("_"), F.lit(" ")))
    return F.when(F.length(base).between(15, 200) & ~base.rlike(r"^\d+$"), base)


def title(text: Column, name: Column | None = None) -> Column:
    """The title of a document, by the first way that finds one.

    A paper's; the first line with title words that is no juridical paragraph,
    with the lines that go on with it; the first reference to a norm; the file's
    name; the first long line that is mostly capitals. Null if none does.
    """

    def found(lines: Column) -> Column:
        kinds = F.transform(lines, lambda x, i: F.struct(i.alias("i"), _line_kind(x).alias("k")))
        start = F.struct(F.lit(False).alias("law"), F.lit(-1).alias("hit"), F.lit(-1).alias("ref"))

        def step(s: Column, x: Column) -> Column:
            k = x["k"]
            hit = (s["hit"] < 0) & ((k == 4) | ((k == 5) & ~s["law"]))
            law = F.when((k == 0) | hit, F.lit(False)).when(k.isin(2, 3), F.lit(True)).otherwise(s["law"])
            return F.struct(law.alias("law"), F.when(hit, x["i"]).otherwise(s["hit"]).alias("hit"), F.when((k == 3) & (s["ref"] < 0), x["i"]).otherwise(s["ref"]).alias("ref"))

        def chosen(s: Column) -> Column:
            loud = F.filter(lines, lambda x: (F.length(x) >= 30) & ~_any(x, rules.TITLE_SKIP) & (_uppers(x) > F.length(x) * 0.4))
            by_name = title_from_name(name) if name is not None else F.lit(None).cast("string")
            return F.when(s["hit"] >= 0, _continued(lines, s["hit"])).when(s["ref"] >= 0, F.get(lines, s["ref"])).otherwise(F.coalesce(by_name, F.get(loud, F.lit(0))))

        return squeeze(_let(F.aggregate(kinds, start, step), chosen))

    return F.coalesce(paper(text)["title"], _let(lines_of(text), found))


def place(text: Column) -> Column:
    """The capital, else the first known state by the order of the list; null if none is named."""
    named = [*rules.CAPITAL, *((n.upper(), n) for n in rules.STATE_NAMES.values())]
    return T.cascade(F.upper(text), named, None)


def medium(text: Column) -> Column:
    return T.cascade(F.upper(text), rules.MEDIA, None)


def document_type(text: Column, name: Column | None = None) -> Column:
    """By the file's name, else by the first 30 lines; null if neither says."""
    head = F.upper(F.array_join(F.slice(lines_of(text), 1, 30), "\n"))
    by_text = T.cascade(head, rules.DOCUMENT_TYPES, None)
    if name is None:
        return by_text
    reference = F.when(F.upper(name).contains("TDR") | F.upper(name).contains("TÉRMINOS DE REFERENCIA"), "Otro")
    return F.coalesce(T.cascade(F.upper(name), rules.DOCUMENT_TYPES, None), reference, by_text)


def norm_number(text: Column) -> Column:
    return F.coalesce(*(_some(F.regexp_extract(text, f"(?iu){p}", 0)) for p in rules.NORM_NUMBERS))


def issuing_body(text: Column) -> Column:
    """A known body that the text names, else the first of 50 lines that sounds like one."""
    known = T.cascade(F.upper(text), [(x, x) for x in rules.ISSUERS], None)
    known = F.replace(F.replace(F.initcap(F.lower(known)), F.lit(" Del "), F.lit(" del ")), F.lit(" De "), F.lit(" de "))
    lines = F.transform(F.slice(F.split(text, "\n"), 1, 50), squeeze)
    like = F.filter(lines, lambda x: T.contains_any(F.upper(x), rules.ISSUER_WORDS) & F.length(x).between(10, 150))
    return F.coalesce(known, F.get(like, F.lit(0)))


def url(text: Column) -> Column:
    return _some(F.regexp_replace(F.regexp_extract(text, r"""https?://[^\s)\]<>"']+""", 0), "[.,;]+$", ""))


def doi(text: Column) -> Column:
    """A DOI in the text, or in the link to it that the text gives."""
    plain = _some(F.regexp_replace(F.regexp_extract(text, r"""\b10\.\d{4,9}/[^\s)\]<>"']+""", 0), "[.,;]+$", ""))
    return F.coalesce(plain, _some(F.regexp_replace(F.regexp_extract(url(text), r"(?:dx\.)?doi\.org/(.*)$", 1), "[.,;]+$", "")))


def file_title(meta: Column) -> Column:
    """The title in a file's metadata (a map), unless it is a browser's, a portal's or too short."""
    x = T.strip(F.coalesce(F.element_at(meta, F.lit("title")), F.lit("")))
    good = (F.length(x) > 5) & ~x.startswith("Microsoft") & ~_any(x, rules.PORTAL_TITLES)
    return F.when(good, F.regexp_replace(x, "(?iu)" + rules.LIBRARY_PREFIX, ""))


def file_author(meta: Column) -> Column:
    x = T.strip(F.coalesce(F.element_at(meta, F.lit("author")), F.lit("")))
    return F.when((F.length(x) > 3) & ~x.startswith("Microsoft"), squeeze(x))


def kept_metadata(meta: Column) -> Column:
    """The entries of a file's metadata that say something."""
    return F.map_filter(meta, lambda _, v: F.coalesce(T.strip(v) != "", F.lit(False)))


def extracted(docs: DataFrame, keep: tuple[str, ...], text: str = "text", name: str | None = None, meta: str | None = None, state: str | None = None) -> DataFrame:
    """keep, titulo, autor, fecha_publicacion, anio, lugar, medio_publicacion, tipo_documento, numero_norma, url, doi, ambito, clave_edo.

    What the file's metadata say comes first, then what the text says.
    """
    t, file = F.col(text), F.col(name) if name else None
    none = F.lit(None).cast("string")
    date = records.date_of(t)
    key = F.upper(F.col(state)) if state else none
    return docs.select(
        *keep,
        F.coalesce(file_title(F.col(meta)) if meta else none, title(t, file)).alias("titulo"),
        F.coalesce(file_author(F.col(meta)) if meta else none, paper(t)["author"], issuing_body(t)).alias("autor"),
        date.alias("fecha_publicacion"),
        F.substring(date, 1, 4).try_cast("int").alias("anio"),
        place(t).alias("lugar"),
        medium(t).alias("medio_publicacion"),
        document_type(t, file).alias("tipo_documento"),
        norm_number(t).alias("numero_norma"),
        url(t).alias("url"),
        doi(t).alias("doi"),
        F.when(key == "NAL", "FED").when(key.isNotNull(), "EST").alias("ambito"),
        key.alias("clave_edo"),
    )


def enriched(found: DataFrame, lookup: DataFrame, key: str = "doi") -> DataFrame:
    """found with the columns of a table of known records in place of its own where these aren't null.

    The lookup stands for a service that resolves identifiers; its repeats of a
    key count once, by their smallest row.
    """
    extra = [c for c in lookup.columns if c != key]
    one = lookup.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*extra)).alias("_known"))
    met = found.join(one, key, "left")
    cols = [F.coalesce(F.col("_known")[c], F.col(c)).alias(c) if c in extra else F.col(c) for c in found.columns]
    return met.select(*cols, *(F.col("_known")[c].alias(c) for c in extra if c not in found.columns))


def registry(found: DataFrame) -> DataFrame:
    """The registry's columns, in its order: those that a field fills, and nulls for the others."""
    fields = {i: f for f, i in rules.REGISTRY_FIELDS.items()}
    at = lambda i: F.col(fields[i]) if fields.get(i) in found.columns else F.lit(None).cast("string")
    return found.select(*(at(i).cast("string").alias(c) for i, c in enumerate(rules.REGISTRY_COLUMNS)))
