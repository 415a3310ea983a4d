"""Validation of models' answers: semi-structured JSON to typed cases, errors as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket import schemas
from docket.functions.text import is_blank, strict_json, without_fences


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, BIGINT, VOID and so on; null if the member isn't there."""
    return F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)


def _string(v: Column, path: str) -> Column:
    member = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(v, path, "string"))


def _list(v: Column, path: str) -> Column:
    """The elements of an array member; null if it is none, as only arrays can be cast to one."""
    return F.try_variant_get(v, path, "array<variant>")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once: the optimizer would copy them into each of their uses, but not across a generator."""
    one = F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("_once")
    return df.select(*df.columns, one).select(*df.columns, *(F.col(f"_once.{n}").alias(n) for n in columns))


def parse_cases(answers: DataFrame, keys: list[str], raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(cases, errors) of models' answers.

    cases: (keys, case_pos, the columns of schemas.CASE); errors: (keys, case_pos, step_pos,
    error). An answer with errors still gives its good cases. A case with one bad step
    is left out whole. Members that are missing have their defaults.
    """
    top = _once(answers.select(*keys, raw), v=strict_json(without_fences(F.col(raw))))
    top = _once(top, list=_list(F.col("v"), "$.arenden"))
    # kinds are looked at only where something is missing: they cost a schema of all that is below
    whole = F.when(
        F.col("list").isNull(),
        F.when(F.col("v").isNull(), F.lit("invalid JSON"))
        .when(F.coalesce(_kind(F.col("v")), F.lit("")) != "OBJECT", F.lit("no cases in the answer"))
        .when(_kind(F.try_variant_get("v", "$.arenden", "variant")).isNull(), F.lit("no cases in the answer"))
        .otherwise(F.lit("cases are not a list")),
    )
    none = F.lit(None).cast("int")
    top = _once(top, top_error=whole)
    # an answer that has no list stands as one item without a case, so that errors and cases come from one pass
    listed = F.transform("list", lambda c, i: F.struct(i.alias("case_pos"), c.alias("c")))
    lost = F.array(F.struct(none.alias("case_pos"), F.lit(None).cast("variant").alias("c")))
    case = top.select(*keys, "top_error", F.explode(F.when(F.col("top_error").isNull(), listed).otherwise(lost)).alias("i")).select(*keys, "top_error", "i.*")
    case = _once(case, title=_string(F.col("c"), "$.title"), initiativ_typ=_string(F.col("c"), "$.initiativ_typ"), step_list=_list(F.col("c"), "$.steps"))
    bad_case = (
        F.when(F.col("top_error").isNotNull(), F.col("top_error"))
        .when(F.col("title").isNull() & (F.coalesce(_kind(F.col("c")), F.lit("")) != "OBJECT"), F.lit("not an object"))
        .when(is_blank(F.col("title")), F.lit("no title"))
        .when(~F.coalesce(F.col("initiativ_typ").isin(schemas.INITIATIVE_TYPES), F.lit(False)), F.lit("unknown initiativ_typ"))
        .when(F.coalesce(F.size("step_list"), F.lit(0)) < 1, F.lit("no steps"))
    )

    def bad_step(s: Column) -> Column:
        quote = _string(s, "$.quote")
        return (
            F.when(quote.isNull() & (F.coalesce(_kind(s), F.lit("")) != "OBJECT"), F.lit("not an object"))
            .when(is_blank(quote), F.lit("no quote"))
            .when(~F.coalesce(_string(s, "$.date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False)), F.lit("bad date"))
        )

    case = _once(case, case_error=bad_case)
    case = _once(case, step_errors=F.when(F.col("case_error").isNull(), F.transform("step_list", bad_step)))
    error = lambda pos, e: F.struct(pos.cast("int").alias("step_pos"), e.alias("error"))
    spoilt = F.exists("step_errors", lambda e: e.isNotNull())
    steps = F.filter(F.transform("step_errors", lambda e, i: error(i, e)), lambda r: r["error"].isNotNull())
    outcome = F.when(F.col("case_error").isNotNull(), F.array(error(none, F.col("case_error")))).when(spoilt, F.concat(steps, F.array(error(none, F.lit("case left out: bad steps")))))
    case = case.withColumn("outcome", outcome)
    errors = case.select(*keys, "case_pos", F.explode("outcome").alias("o")).select(*keys, "case_pos", "o.*")

    good = case.where("outcome is null")
    typed = F.transform("step_list", lambda s: F.try_variant_get(s, "$", schemas.STEP))
    fixed = F.transform(typed, lambda s: F.when(s["voting"]["recorded"] == F.lit(False), s.withField("voting.note", F.lit(schemas.VOTES_NOT_RECORDED))).otherwise(s))
    category, status = _string(F.col("c"), "$.category"), _string(F.col("c"), "$.status")
    cases = good.select(
        *keys,
        "case_pos",
        F.lit(None).cast("string").alias("id"),
        "title",
        "initiativ_typ",
        coerced_category(category).alias("category"),
        coerced_status(status).alias("status"),
        _string(F.col("c"), "$.diarienummer").alias("diarienummer"),
        F.coalesce(F.try_variant_get("c", "$.initiators", "array<struct<name:string,party:string>>"), F.array().cast("array<struct<name:string,party:string>>")).alias("initiators"),
        fixed.alias("steps"),
        F.lit(None).cast("string").alias("_link_flag"),
    )
    return cases, errors


def coerced_category(c: Column) -> Column:
    return F.when(c.isin(schemas.CATEGORIES), c).otherwise(F.lit(schemas.OTHER_CATEGORY))


def coerced_status(c: Column) -> Column:
    return F.when(c == schemas.CLOSED, c).otherwise(F.lit(schemas.OPEN))


def parsed_verdict(raw: Column) -> Column:
    """(decision, reasoning, flagged_issues); whatever can't be read is a review, never a publication."""
    v = strict_json(without_fences(raw))
    decision = _string(v, "$.decision")
    issues = F.when(_kind(F.try_variant_get(v, "$.flagged_issues", "variant")) == "ARRAY", F.try_variant_get(v, "$.flagged_issues", "array<string>"))
    read = F.struct(decision.alias("decision"), F.coalesce(_string(v, "$.reasoning"), F.lit("")).alias("reasoning"), F.coalesce(issues, F.array().cast("array<string>")).alias("flagged_issues"))
    fallback = F.struct(F.lit("review").alias("decision"), F.lit("the verdict could not be read").alias("reasoning"), F.array(F.lit("unreadable verdict")).alias("flagged_issues"))
    return F.when(decision.isin(schemas.VERDICTS), read.cast(schemas.VERDICT)).otherwise(fallback.cast(schemas.VERDICT))


def reconciled(passed: Column, decision: Column) -> Column:
    """publish only if the gate passed and the verdict says so."""
    return F.when(F.coalesce(passed, F.lit(False)) & (F.coalesce(decision, F.lit("")) == "publish"), F.lit("publish")).otherwise(F.lit("needs_review"))


def stamped(cases: DataFrame, url: Column) -> DataFrame:
    """The source's address on every step; it never comes from a model."""
    empty = F.struct(*(F.lit(None).cast("string").alias(n) for n in ("protocol_ref", "pdf_url", "archive_url", "wayback_url")))
    return cases.withColumn("steps", F.transform("steps", lambda s: s.withField("source", F.coalesce(s["source"], empty).withField("pdf_url", url))))


def with_slugs(cases: DataFrame) -> DataFrame:
    """Bodies' names with dashes."""
    return cases.withColumn("steps", F.transform("steps", lambda s: s.withField("instance", dashed(s["instance"]))))


def dashed(c: Column) -> Column:
    return F.replace(c, F.lit("_"), F.lit("-"))
