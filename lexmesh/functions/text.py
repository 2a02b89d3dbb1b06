"""Scalar text helpers as column expressions."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCENTED = "ÁÀÂÄÃÅáàâäãåÉÈÊËéèêëÍÌÎÏíìîïÓÒÔÖÕóòôöõÚÙÛÜúùûüÑñÇçÝýÿ"
PLAIN = "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuNnCcYyy"


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def strip_accents(x: Column) -> Column:
    return F.translate(x, ACCENTED, PLAIN)


def node_id(x: Column) -> Column:
    """Key of an entity: trimmed, lower-case, without accents."""
    return strip_accents(F.lower(strip(x)))


def match_key(x: Column) -> Column:
    """Only a-z, 0-9 and single spaces are left."""
    return F.trim(F.regexp_replace(F.regexp_replace(strip_accents(F.lower(x)), "[^a-z0-9 ]", " "), " +", " "))


def words(x: Column) -> Column:
    """White-space tokens; an empty text has none."""
    t = strip(F.coalesce(x, F.lit("")))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"\s+"))


def n_words(x: Column) -> Column:
    return F.size(words(x)).cast("long")


def letter_tokens(x: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(x), r"[^\p{L}\p{N}]+"), "")


def keywords(x: Column, least: int = 5) -> Column:
    """Distinct words of at least `least` characters of the matching key."""
    return F.array_distinct(F.filter(F.split(match_key(x), " "), lambda w: F.length(w) >= least))


def count_literal(x: Column, literal: str) -> Column:
    """Occurrences that don't overlap, by what a text loses without them."""
    return ((F.octet_length(x) - F.octet_length(F.replace(x, F.lit(literal), F.lit("")))) / len(literal.encode())).cast("long")


def contains_any(x: Column, literals: list[str]) -> Column:
    """One alternation, so the text is read once."""
    return x.rlike("|".join(map(re.escape, literals)))


def slug(x: Column, most: int = 50) -> Column:
    return F.regexp_replace(F.substring(F.regexp_replace(match_key(x), " +", "-"), 1, most), "^-+|-+$", "")


def id_of(prefix: str, x: Column, digits: int) -> Column:
    """prefix and the first digits of the SHA-256, upper-case."""
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(x.cast("binary"), 256), 1, digits)))


def snippet(text: Column, position: Column, length: Column, window: int = 50) -> Column:
    """The text around a match (position from 1), white space collapsed."""
    start = F.greatest(F.lit(1), position - window)
    stop = position + length + window
    return strip(F.regexp_replace(F.substring(text, start, stop - start), r"\s+", " "))


def cascade(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The value of the first rule whose literal the text contains."""
    out = None
    for literal, value in rules:
        out = F.when(text.contains(literal), value) if out is None else out.when(text.contains(literal), value)
    return out if default is None else out.otherwise(default)


def cascade_patterns(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The value of the first (value, pattern) whose pattern is found."""
    out = None
    for value, pattern in rules:
        out = F.when(text.rlike(pattern), value) if out is None else out.when(text.rlike(pattern), value)
    return out if default is None else out.otherwise(default)


def best_by_keywords(text: Column, table: dict[str, list[str]], default: str) -> Column:
    """argmax over values of the summed keyword counts; the first declared wins ties; no hit: default."""
    scores = [(sum((count_literal(text, k) for k in ks), F.lit(0)), v) for v, ks in table.items()]
    best = F.array_max(F.array(*(F.struct(s.cast("long").alias("score"), F.lit(-i).alias("order"), F.lit(v).alias("value")) for i, (s, v) in enumerate(scores))))
    return F.when(best["score"] > 0, best["value"]).otherwise(default)


def needles(pattern: str) -> list[str]:
    """Lower-case literals one of which every match of the pattern has, case aside; none if it has no such literals."""

    def of(parts) -> list[str]:
        found, run = [], ""
        for op, arg in [*parts, (None, None)]:
            if op is _parser.LITERAL and arg < 128:
                run += chr(arg).lower()
                continue
            if run:
                found.append([run])
            run = ""
            if op is _parser.SUBPATTERN:
                found.append(of(arg[-1]))
            elif op is _parser.BRANCH:
                each = [of(x) for x in arg[1]]
                found.append(sum(each, []) if all(each) else [])
        return max(found, key=lambda x: min(map(len, x), default=0), default=[])

    try:
        return of(_parser.parse(pattern))
    except re.error:  # a construct that only Java knows
        return []


def pattern_score(text: Column, patterns: list[str]) -> Column:
    """How many of the patterns occur (each counts once); a pattern is only tried where a text has a literal that its matches need."""

    def tried(t: Column, low: Column, p: str) -> Column:
        some = [low.contains(x) for x in needles(p)]
        hit = t.rlike(f"(?i){p}")
        return F.when(reduce(or_, some), hit).otherwise(F.lit(False)) if some else hit

    once = lambda x, body: F.get(F.transform(F.array(x), body), F.lit(0))
    return once(text, lambda t: once(F.lower(t), lambda low: F.when(t.isNotNull(), sum((tried(t, low, p).cast("int") for p in patterns), F.lit(0)))).cast("long"))


def is_caps(x: Column) -> Column:
    return (x == F.upper(x)) & (x != F.lower(x))


def similarity_ratio(a: str, b: str, most: int = 5000) -> float:
    """Sequence-matching ratio of the first characters (for use in an Arrow function)."""
    from difflib import SequenceMatcher

    return SequenceMatcher(None, (a or "")[:most], (b or "")[:most]).ratio()
