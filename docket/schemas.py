"""Schemas, stated once; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed values of the case model.
INITIATIVE_TYPES = ["motion", "interpellation", "enkel_fraga", "medborgarforslag", "styrelseforslag", "initiativarende"]
CATEGORIES = ["demokrati", "miljö-klimat", "barn-utbildning", "vård-omsorg", "ekonomi", "infrastruktur", "övrigt"]
OTHER_CATEGORY, CLOSED, OPEN = "övrigt", "avgjort", "pågående"
VOTES_NOT_RECORDED = "Röstfördelning ej redovisad i protokollet"
VERDICTS = ["publish", "review", "reject"]

STEP = """struct<step_id:string,instance:string,type:string,date:string,quote:string,decision:string,
voting:struct<recorded:boolean,note:string,question:string,result:struct<ja:int,nej:int,avstar:int>>,
reservations:array<struct<parties:array<string>,quote:string>>,
protocol_anteckning:array<struct<parties:array<string>,quote:string>>,
source:struct<protocol_ref:string,pdf_url:string,archive_url:string,wayback_url:string>>""".replace("\n", "")

CASE = f"""id string, title string, initiativ_typ string, category string, status string, diarienummer string,
initiators array<struct<name:string,party:string>>, steps array<{STEP}>, _link_flag string"""

MEETING = "committee_slug string, date string, meeting_url string"
PAGE = "committee_slug string, date string, html string"
SEEN = "committee_slug string, date string"
BODY = "slug string, name string, confirmed boolean, seed_url string, note string"
RAW_FILE = "pdf_url string, relative_path string, repo string, pos long, content binary"
VERDICT = "struct<decision:string,reasoning:string,flagged_issues:array<string>>"
CHANGELOG = """run_id string, timestamp string, data_hash string, arende_count long, new_arenden array<string>,
updated_arenden array<struct<id:string,new_step_ids:array<string>>>"""
ERROR = "run_id string, stage string, committee_slug string, date string, error string"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl.replace("\n", " "))
