"""Links on landed pages. The site's address is a parameter; its paths may be relative."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import safe_filename

#: The portal's paths to meetings and to attachments, and what it puts after a file's name.
MEETINGS, MEETING, MINUTES = "committees", "mote-", "protocol"
BODIES, AGENDA = ["welcome-sv", "namnder-styrelser"], "agenda"
DOWNLOAD = "downloadMode=open"


def absolute(base: str, link: Column) -> Column:
    return F.when(link.startswith("http"), link).otherwise(F.concat(F.lit(base), link))


def first_occurrences(df: DataFrame, keys: list[str], found: Column, name: str) -> DataFrame:
    """Explode an array of matches; of equal ones within the same keys the first stays, with its position."""
    return df.select(*keys, F.posexplode(found).alias("pos", name)).groupBy(*keys, name).agg(F.min("pos").alias("pos"))


def links_in(base: str, html: Column) -> Column:
    """What may be an address on a page: pieces between quotes, brackets, parentheses and white space, from the portal's name or else the first slash on.

    Fragments are left out, and of a query all but the parameter that asks for a download, wherever it stands.
    """

    def address(piece: Column) -> Column:
        u = F.replace(piece, F.lit("&amp;"), F.lit("&"))
        at = F.instr(u, base + "/")
        u = F.substring_index(F.substring(u, F.when(at > 0, at).otherwise(F.instr(u, "/")), F.lit(2**31 - 1)), "#", 1)
        path = F.substring_index(u, "?", 1)
        asked = F.split(F.substring(u, F.length(path) + 2, F.lit(2**31 - 1)), "&")
        return F.when(F.array_contains(asked, DOWNLOAD), F.concat(path, F.lit("?" + DOWNLOAD))).otherwise(path)

    pieces = F.filter(F.split(html, r"[\"'\s<>()]+"), lambda u: u.contains("/"))
    return F.transform(pieces, address)


def _parts(base: str, link: Column) -> Column:
    """The parts of a link's path on the portal, without query; null for other hosts."""
    path = F.when(link.startswith(base + "/"), F.substring(link, len(base) + 1, 2**31 - 1)).when(link.startswith("/"), link)
    return F.split(F.substring_index(path, "?", 1), "/")


def _is_file(name: Column) -> Column:
    """Whether a path's last part names one of the portal's files: pdf at its end, perhaps with a number."""
    return name.rlike(r"(?i).pdf(-[0-9]+)?$")


def meeting_dates(slug: Column, base: str, html: Column) -> Column:
    """Dates of the body's meetings that a page links to, in order; links to pages below a meeting don't count."""
    parts = F.transform(links_in(base, html), lambda u: _parts(base, u))
    own = F.filter(parts, lambda p: (F.size(p) == 4) & (F.get(p, F.lit(1)) == MEETINGS) & (F.get(p, F.lit(2)) == slug) & F.get(p, F.lit(3)).rlike(f"^{MEETING}[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?![A-Za-z0-9_-])"))
    return F.transform(own, lambda p: F.substring(F.get(p, F.lit(3)), len(MEETING) + 1, 10))


def meeting_url(base: str, slug: Column, date: Column) -> Column:
    return F.concat(F.lit(f"{base}/{MEETINGS}/"), slug, F.lit(f"/{MEETING}"), date)


def refs(pages: DataFrame, base: str) -> DataFrame:
    """(committee_slug, date, meeting_url, pos) of (committee_slug, html), all bodies at once."""
    found = first_occurrences(pages, ["committee_slug"], meeting_dates(F.col("committee_slug"), base, F.col("html")), "date")
    return found.select("committee_slug", "date", meeting_url(base, F.col("committee_slug"), F.col("date")).alias("meeting_url"), "pos")


def meeting_refs(pages: DataFrame, slug: str, base: str) -> DataFrame:
    """(committee_slug, date, meeting_url, pos): the meetings that the body's pages link to, each once, in order.

    pages: (html). Links of other bodies and to pages below a meeting don't count.
    """
    return refs(pages.select(F.lit(slug).alias("committee_slug"), "html"), base)


def protocol_url(base: str, slug: Column, date: Column, html: Column) -> Column:
    """The first link to the meeting's approved minutes, absolute; null if there is none."""
    folder = F.lower(F.concat_ws("/", F.lit(MEETINGS), slug, F.concat(F.lit(MEETING), date), F.lit(MINUTES)))

    def minutes(u: Column) -> Column:
        p = _parts(base, u)
        return (F.size(p) >= 6) & (F.lower(F.array_join(F.slice(p, 2, 4), "/")) == folder) & _is_file(F.element_at(p, -1))

    return absolute(base, F.get(F.filter(links_in(base, html), minutes), F.lit(0)))


def attachments(pages: DataFrame, base: str, keys: list[str]) -> DataFrame:
    """(keys, url, filename, pos): attachments of agendas, each address once, in order."""

    def attached(u: Column) -> Column:
        p = _parts(base, u)
        return (F.size(p) >= 6) & (F.slice(p, 2, 2) == F.array(*map(F.lit, BODIES))) & (F.element_at(p, -2) == AGENDA) & _is_file(F.element_at(p, -1))

    found = F.transform(F.filter(links_in(base, F.col("html")), attached), lambda u: absolute(base, u))
    out = first_occurrences(pages, keys, found, "url")
    return out.select(*keys, "url", F.concat(safe_filename(F.element_at(_parts(base, F.col("url")), -1)), F.lit(".pdf")).alias("filename"), "pos")


def local_paths(base_dir: Column, slug: Column, date: Column) -> Column:
    folder = F.concat_ws("/", base_dir, slug, date)
    return F.struct(folder.alias("dir"), F.concat(folder, F.lit("/protokoll.pdf")).alias("protocol_path"), F.concat(folder, F.lit("/bilagor")).alias("attachment_dir"))


def seed_url(cases: DataFrame, base: str, slug: str) -> DataFrame:
    """(meeting_url): from the first step whose file lies under the body's path, in case and step order; no row if none does."""
    prefix = f"/{MEETINGS}/{slug}/{MEETING}"
    steps = cases.select(F.col("pos").alias("c"), F.posexplode("steps").alias("s", "step")).select("c", "s", F.col("step.source.pdf_url").alias("u"))
    date = F.left(F.substring_index("u", prefix, -1), F.lit(10))
    found = steps.where(F.col("u").contains(prefix) & date.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")).orderBy("c", "s").limit(1)
    return found.select(F.concat(F.lit(base + prefix), date).alias("meeting_url"))
