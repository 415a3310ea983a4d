"""python -m docket COMMAND ...: the steps as commands over landed files.

  refs SLUG BASE PAGES OUT            meetings that landed list pages link to
  fetch BASE LISTS PAGES SEEN OUT     unseen meetings with approved minutes
  attachments BASE PAGES OUT          attachments of landed meeting pages
  download FILES BASE_URI AGENT OUT   files (url, relative_path) fetched into a shared folder
  extract MINUTES OUT ENDPOINT AGENT  minutes (pdf_url, protocol_ref, date, text) sent to a model (key in DOCKET_MODEL_KEY): answers, cases and errors
  validate ANSWERS OUT                models' answers (pdf_url, raw) to cases and errors
  gates CASES SOURCE OUT              ready and needs_review, by the verbatim gate
  verify READY VERDICTS OUT           verified and review, by the verdicts (case_pos, raw)
  archive VERIFIED RAW MANIFEST OUT   archived, hashes and missing
  link ARCHIVED SOURCE DATABASE ERRORS    the database with the cases folded in
  publish DATABASE OUT RUN TIME       published, last-published, hash and changelog; 1 if there is no case
  hash CASES                          the hash of a published file
  permalinks CASES HOST MAIN SHA COLD [COLDSHA]   fill pending links, print the file
  build TEMPLATE CASES [OUT]          the page with the cases; with OUT, written beside the cases as they are served
  weekly WORLD STATE BASE RUN TIME [CAP]          a weekly run over what has landed
  backfill WORLD STATE BASE RUN TIME SLUG FIRST LAST [CAP]    a backfill of one body
"""

from __future__ import annotations

import os
import sys

COUNTS = {"refs": (4,), "fetch": (5,), "attachments": (3,), "download": (4,), "extract": (4,), "validate": (2,), "gates": (3,), "verify": (3,), "archive": (4,), "link": (4,), "publish": (4,), "hash": (1,), "permalinks": (5, 6), "build": (2, 3), "weekly": (5, 6), "backfill": (8, 9)}


def main(args: list[str]) -> int:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from docket import schemas
    from docket.functions import links
    from docket.operators import archive, publish, validate
    from docket.plans import steps
    from docket.sources import fetch, landed, state

    if not args or len(args) - 1 not in COUNTS.get(args[0], ()):
        print(__doc__, file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("docket").getOrCreate()
    command, rest = args[0], args[1:]
    if command == "refs":
        links.meeting_refs(landed.pages(spark, rest[2]), rest[0], rest[1]).write.json(rest[3])
    elif command == "fetch":
        steps.fetch_step(spark, landed.pages(spark, rest[1]), landed.pages(spark, rest[2]), steps.rows(spark, rest[3], schemas.SEEN), rest[0], rest[4])
    elif command == "attachments":
        links.attachments(landed.pages(spark, rest[1]), rest[0], ["committee_slug", "date"]).write.json(rest[2])
    elif command == "download":
        files = steps.rows(spark, rest[0], "url string, relative_path string")
        steps.left(fetch.downloaded(files, fetch.http_bytes(rest[2]), rest[1]), rest[3])
    elif command == "extract":
        steps.extract_step(spark, rest[0], rest[1], fetch.http_answer(rest[2], rest[3], os.environ.get("DOCKET_MODEL_KEY", "")))
    elif command == "validate":
        cases, errors = validate.parse_cases(spark.read.schema("pdf_url string, raw string").json(rest[0]), ["pdf_url"])
        validate.with_slugs(validate.stamped(cases, F.col("pdf_url"))).write.json(f"{rest[1]}/cases")
        errors.write.json(f"{rest[1]}/errors")
    elif command in ("gates", "verify", "archive", "link"):
        getattr(steps, f"{command}_step")(spark, *rest)
    elif command == "publish":
        return 0 if steps.publish_step(spark, *rest) else 1
    elif command == "build" and len(rest) == 3:
        steps.build_step(spark, *rest)
    elif command == "weekly":
        steps.weekly(spark, *rest[:5], *map(int, rest[5:]))
    elif command == "backfill":
        steps.backfill(spark, *rest[:8], *map(int, rest[8:]))
    else:
        cases = state.load_cases(spark, rest[1] if command == "build" else rest[0])
        if command == "hash":
            print(publish.database_json(cases).select(F.sha2("json", 256)).first()[0])
        elif command == "permalinks":
            filled = archive.with_permalinks(cases, rest[1], rest[2], rest[3], rest[4], rest[5] if len(rest) > 5 else None)
            print(publish.database_json(filled).first().json)
        else:
            with open(rest[0], encoding="utf-8") as f:
                print(publish.render(f.read(), cases))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
