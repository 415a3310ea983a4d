"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .unicode import nfkd

#: Fixed value: white space as the sources' language has it (with no-break space and byte order mark, without U+0085).
_OTHER = r"\t\n\x0B\f\r\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
WS = f"[{_OTHER} ]"
#: Words that say nothing about a title.
STOPWORDS = ["motion", "gällande", "om", "till", "av", "i", "på", "för", "och", "med", "flera", "svar", "en", "ett", "att"]


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (trimmed(c) == "")


def normal_space(c: Column) -> Column:
    """Each run of white space as one space, none at the ends. Single spaces, which most are, aren't touched.

    Printable ASCII, which most characters are, is told by one range before the many of WS are looked at.
    """
    return F.trim(F.regexp_replace(c, f"[^!-~](?:(?<= )(?![!-~]){WS}++|(?<! )(?<=[{_OTHER}]){WS}*+)", " "))


def word_count(normal: Column) -> Column:
    """Words of a text with normal space; the empty text counts as one, as splitting it gives one part."""
    return F.size(F.split(normal, " "))


def normal_title(c: Column, keep_marks_apart: bool = True) -> Column:
    """Lower case, compatibility decomposition, only letters, digits and single spaces.

    Decomposed marks become spaces (keep_marks_apart) or are dropped, so that accents
    don't cut words.
    """
    t = nfkd(F.lower(c))
    if not keep_marks_apart:
        t = F.regexp_replace(t, r"\p{Mn}+", "")
    return normal_space(F.regexp_replace(t, r"[^\p{L}\p{N}\s]", " "))


def ascii_title(c: Column) -> Column:
    """normal_title for texts that need no decomposition; stays in the JVM."""
    return normal_space(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\s]", " "))


def title_tokens(normal: Column) -> Column:
    """The distinct words of a normalised title that aren't stopwords."""
    return F.array_distinct(F.filter(F.split(normal, " "), lambda w: (w != "") & ~w.isin(STOPWORDS)))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two token sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def without_fences(c: Column) -> Column:
    """A model's answer without a code fence around it."""
    return F.regexp_replace(F.regexp_replace(trimmed(c), f"(?i)^```json{WS}*", ""), f"```{WS}*$", "")


def strict_json(c: Column) -> Column:
    """A variant of the whole text; null unless all of it is one JSON value.

    The parser stops after the first value, so that the text is read as the first
    element of a list that ends in a mark of our own.
    """
    mark = "\x01end"
    whole = F.try_parse_json(F.concat(F.lit("["), F.regexp_replace(c, "\x01", "\x02"), F.lit(',"\\u0001end"]')))
    ends = F.try_variant_get(whole, "$[1]", "string") == mark
    return F.when(ends, F.try_variant_get(whole, "$[0]", "variant"))


def safe_filename(slug: Column) -> Column:
    """Without the final pdf (a number after it stays), cut at a query or fragment, 150 characters at most."""
    number = F.regexp_extract(slug, "-[0-9]+$", 0)
    stem = F.left(slug, F.length(slug) - F.length(number))
    named = F.concat(F.when(stem.endswith("pdf"), F.left(stem, F.length(stem) - 3)).otherwise(stem), number)
    return F.left(F.substring_index(F.substring_index(named, "?", 1), "#", 1), F.lit(150))


def inline_script(json: Column) -> Column:
    """JSON that can stand inside a script element."""
    t = F.regexp_replace(json, r"(?i)</(script)", r"<\\/$1")
    for mark in ("\u2028", "\u2029"):
        t = F.replace(t, F.lit(mark), F.lit(f"\\u{ord(mark):04x}"))
    return t
