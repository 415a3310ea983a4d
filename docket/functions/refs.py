"""Paragraph references and sections of minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS

#: Codes of bodies and their committees, as references have them.
CODES = ["KF", "KS", "KSAU", "VON", "VONAU", "TEN", "TENAU", "KUN", "KUNAU", "SN", "SNAU", "BUN", "BUNAU", "BMN", "BMNAU", "ÖFN"]

_REF = rf"§{WS}*\d+(?:/\d{{4}})?{WS}+(?:{'|'.join(sorted(CODES, key=len, reverse=True))})(?![A-Za-z0-9_])"


def paragraph_refs(text: Column) -> Column:
    """Array of (paragraf, instans): every reference to a known body, each once, the year dropped."""
    found = F.regexp_extract_all(text, F.lit(_REF), F.lit(0))
    return F.array_distinct(F.transform(found, lambda r: F.struct(F.regexp_extract(r, r"(\d+)", 1).alias("paragraf"), F.regexp_extract(r, r"(\p{Lu}+)$", 1).alias("instans"))))


def ref_keys(text: Column, years: bool = False) -> Column:
    """Array of number|BODY; with years, number|BODY|year for references that name a year (each once)."""
    if not years:
        return F.transform(paragraph_refs(text), lambda r: F.concat_ws("|", r["paragraf"], r["instans"]))

    def key(r: Column) -> Column:
        year = F.regexp_extract(r, r"/(\d{4})", 1)
        return F.concat_ws("|", F.regexp_extract(r, r"(\d+)", 1), F.regexp_extract(r, r"(\p{Lu}+)$", 1), F.when(year != "", year))

    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_REF), F.lit(0)), key))


def paragraph_key(protocol_ref: Column) -> Column:
    """number|BODY of a step's own reference; null if it has none."""
    pattern = rf"§{WS}*(\d+){WS}+([A-ZÅÄÖ]+)"
    number = F.regexp_extract(protocol_ref, pattern, 1)
    return F.when(number != "", F.concat_ws("|", number, F.regexp_extract(protocol_ref, pattern, 2)))


def sections(text: Column) -> Column:
    """The text cut before each line that begins with a paragraph's number; what is before the first is left out."""
    return F.filter(F.split(text, r"(?m)(?=^§\s*\d+\b)"), lambda s: s.rlike(r"^§\s*\d+\b"))


def own_section(text: Column, protocol_refs: Column) -> Column:
    """The section that the last possible one of the references names; the whole text if it has no sections, else ''.

    protocol_refs: array of the steps' references, in order.
    """
    def within(x: Column) -> Column:
        parts = F.transform(x["parts"], lambda s: F.struct(F.regexp_extract(s, r"^§\s*(\d+)", 1).alias("n"), s.alias("s")))
        numbers = F.filter(F.transform(F.reverse(F.coalesce(x["refs"], F.array())), lambda r: F.regexp_extract(F.coalesce(r, F.lit("")), rf"§{WS}*(\d+)", 1)), lambda n: n != "")
        hits = F.filter(F.transform(numbers, lambda n: F.get(F.filter(parts, lambda p: p["n"] == n), F.lit(0))["s"]), lambda s: s.isNotNull())
        return F.when(F.size(x["parts"]) == 0, x["text"]).otherwise(F.coalesce(F.get(hits, F.lit(0)), F.lit("")))

    bound = F.array(F.struct(text.alias("text"), sections(text).alias("parts"), protocol_refs.alias("refs")))
    return F.get(F.transform(bound, within), F.lit(0))
