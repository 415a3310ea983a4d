"""Archive markers, permanent links, and the archive service's messages, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strict_json

#: Fixed value: what a link that waits for its commit begins with.
PENDING = "git-pending:"


def pending_marker(path: Column, repo: Column) -> Column:
    return F.concat(F.lit(PENDING), repo, F.lit(":"), path)


def is_pending(marker: Column) -> Column:
    return F.coalesce(marker.startswith(PENDING), F.lit(False))


def parse_marker(marker: Column, main_repo: Column | None = None) -> Column:
    """(repo, relative_path) of a marker; null if it is none.

    Without main_repo a marker must name its repository. With it, one whose first part
    has no slash is of the older form and belongs to main_repo.
    """
    rest = F.substring(marker, len(PENDING) + 1, 1 << 30)
    cut = F.instr(rest, ":")
    repo, path = F.when(cut > 0, F.substring_index(rest, ":", 1)), F.expr("1").cast("int")
    path = F.when(cut > 0, rest.substr(cut + 1, F.length(rest)))
    named = F.struct(repo.alias("repo"), path.alias("relative_path"))
    if main_repo is None:
        return F.when(is_pending(marker) & (cut > 0), named)
    old = F.struct(main_repo.alias("repo"), rest.alias("relative_path"))
    return F.when(is_pending(marker), F.when((cut > 0) & repo.contains("/"), named).otherwise(old))


def permalink(host: str, repo: Column, sha: Column, path: Column) -> Column:
    return F.concat(F.lit(host + "/"), repo, F.lit("/blob/"), sha, F.lit("/"), path)


def filled(marker: Column, host: str, main_repo: str, main_sha: str, archive_repo: str, archive_sha: str | None) -> Column:
    """The permanent link of a marker. Of the archive's repository it stays pending without a commit; of others always."""
    m = parse_marker(marker, F.lit(main_repo))
    out = F.when(m["repo"] == main_repo, permalink(host, F.lit(main_repo), F.lit(main_sha), m["relative_path"]))
    if archive_sha:
        out = out.when(m["repo"] == archive_repo, permalink(host, F.lit(archive_repo), F.lit(archive_sha), m["relative_path"]))
    return out.otherwise(marker)


def auth_header(access: Column, secret: Column) -> Column:
    return F.concat(F.lit("LOW "), access, F.lit(":"), secret)


def submit_body(url: Column) -> Column:
    return F.concat(F.lit("url="), F.url_encode(url), F.lit("&capture_all=1"))


def _text(v: Column, name: str) -> Column:
    """A member that is a string, else null."""
    member = F.try_variant_get(v, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(v, f"$.{name}", "string"))


def submit_response(raw: Column) -> Column:
    """(job_id, error) of the answer to a submission."""
    v = strict_json(raw)
    job, message = _text(v, "job_id"), _text(v, "message")
    unknown = F.when(v.isNull(), F.lit("invalid JSON")).otherwise(F.coalesce(message, F.lit("neither job_id nor message")))
    good = F.length(job) > 0
    return F.struct(F.when(good, job).alias("job_id"), F.when(~F.coalesce(good, F.lit(False)), unknown).alias("error"))


def status_response(raw: Column, archive_host: str) -> Column:
    """(status, archived_url, error): success needs a time stamp and an address; anything unknown is an error."""
    v = strict_json(raw)
    status, at, url, message = (_text(v, k) for k in ("status", "timestamp", "original_url", "message"))
    done = (status == "success") & at.isNotNull() & url.isNotNull()
    state = F.when(status == "pending", status).when(done, status).otherwise(F.lit("error"))
    error = F.when(v.isNull(), F.lit("invalid JSON")).when(status == "success", F.lit("success without timestamp or original_url"))
    error = error.otherwise(F.coalesce(message, F.concat(F.lit("unknown status: "), F.coalesce(F.try_variant_get(v, "$.status", "string"), F.lit("none")))))
    link = F.when(done, F.concat(F.lit(archive_host + "/web/"), at, F.lit("/"), url))
    return F.struct(state.alias("status"), link.alias("archived_url"), F.when(state == "error", error).alias("error"))
