"""Compatibility decomposition (NFKD) as column expressions.

The tables follow from Python's Unicode data when they are first needed; a plan holds them as constants, and a character is found by
two look-ups: its page, then its place in the page. Hangul syllables are computed. What isn't ASCII is looked at character by character, the rest
of a text in whole pieces; runs of combining marks are then put in canonical order.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE = 64
_SYLLABLES, _COUNTS = 0xAC00, (19, 21, 28)
_SEPARATOR = "\x1f"


#: Beyond the third plane no character decomposes and none is a combining mark; a test looks at all of them.
_LAST = 0x30000


def _characters() -> list[str]:
    return [chr(c) for c in range(_LAST) if not 0xD800 <= c < 0xE000]


@cache
def decompositions() -> dict[str, str]:
    """Characters and what they decompose to, but for Hangul syllables."""
    last = _SYLLABLES + 19 * 21 * 28
    found = ((c, unicodedata.normalize("NFKD", c)) for c in _characters() if not _SYLLABLES <= ord(c) < last)
    return {c: d for c, d in found if d != c}


@cache
def _classes() -> dict[str, str]:
    """Combining marks and their canonical classes."""
    return {c: str(k) for c in _characters() if (k := unicodedata.combining(c))}


def _paged(table: dict[str, str]) -> tuple[str, str]:
    """(page of each PAGE code points, 0 for none; entries of all pages), as separated text."""
    pages = sorted({ord(c) // PAGE for c in table})
    number = {p: i + 1 for i, p in enumerate(pages)}
    index = ",".join(str(number.get(p, 0)) for p in range(_LAST // PAGE))
    entries = [""] * PAGE + [table.get(chr(c), "") for p in pages for c in range(p * PAGE, (p + 1) * PAGE)]
    return index, _SEPARATOR.join(entries)


@cache
def _texts(name: str) -> tuple[str, str]:
    return _paged(decompositions() if name == "decompositions" else _classes())


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once and not copied into each of its uses."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _found(name: str, c: Column) -> Column:
    """The table's entry for a character; '' if it has none. The tables are constants of the plan."""
    index, entries = _texts(name)
    page = lambda at: F.coalesce(F.get(F.split(F.lit(index), ","), F.floor(at / PAGE).cast("int")).cast("int"), F.lit(0)) * PAGE + at % PAGE
    return F.get(F.split(F.lit(entries), _SEPARATOR), _let(F.ascii(c), page))


def _decomposed(c: Column) -> Column:
    """One character that isn't ASCII."""
    s = F.ascii(c) - _SYLLABLES
    first, middle, end = (F.split(F.lit(_SEPARATOR.join(chr(at + i) if i or at != 0x11A7 else "" for i in range(n))), _SEPARATOR) for at, n in zip((0x1100, 0x1161, 0x11A7), _COUNTS, strict=True))
    parts = F.concat(F.get(first, F.floor(s / 588).cast("int")), F.get(middle, F.floor(s % 588 / 28).cast("int")), F.get(end, s % 28))
    return F.when(s.between(0, 19 * 21 * 28 - 1), parts).otherwise(_let(_found("decompositions", c), lambda e: F.when(e != "", e).otherwise(c)))


@cache
def _marks() -> str:
    """A class of all combining marks, for patterns."""
    codes, ranges = sorted(map(ord, _classes())), []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


def nfkd(t: Column) -> Column:
    """The text's compatibility decomposition, marks in canonical order."""
    pieces = F.regexp_extract_all(t, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]"), F.lit(0))
    whole = F.when(t.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(pieces, lambda p: F.when(F.ascii(p) < 128, p).otherwise(_decomposed(p))), "")).otherwise(t)
    m = _marks()

    def ordered(run: Column) -> Column:
        marks = F.transform(F.split(run, ""), lambda c, i: F.struct(F.coalesce(_found("classes", c).try_cast("int"), F.lit(0)).alias("k"), i.alias("i"), c.alias("c")))
        return F.array_join(F.transform(F.array_sort(marks), lambda x: x["c"]), "")

    def sorted_marks(x: Column) -> Column:
        runs = F.regexp_extract_all(x, F.lit(f"[{m}]+|[^{m}]+"), F.lit(0))
        return F.array_join(F.transform(runs, lambda r: F.when((F.length(r) > 1) & r.rlike(f"^[{m}]"), ordered(r)).otherwise(r)), "")

    return _let(whole, lambda x: F.when(x.rlike(f"[{m}]{{2}}"), sorted_marks(x)).otherwise(x))
