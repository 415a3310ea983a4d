"""Outside services behind one interface: pages, texts of files, models.

A provider answers a column of requests in Arrow batches; tests and offline runs
replay recorded answers. A failed request is an error in its row, not a failed task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Provider = Callable[[str], str]


def asked(df: DataFrame, request: str, provider: Provider, answer: str = "raw") -> DataFrame:
    """df with the provider's answer and error (one of the two null)."""
    schema = df.schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got, wrong = [], []
            for r in b[request]:
                try:
                    got.append(provider(r))
                    wrong.append(None)
                except Exception as e:  # noqa: BLE001 - whatever the service raises belongs to this row
                    got.append(None)
                    wrong.append(f"{type(e).__name__}: {e}")
            yield b.assign(**{answer: got, "error": wrong})

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) or schema
    return df.mapInPandas(run, f"{columns}, `{answer}` string, error string")


def replayed(df: DataFrame, recorded: DataFrame, on: list[str], answer: str = "raw") -> DataFrame:
    """df with recorded answers; requests that were never recorded have an error."""
    out = df.join(recorded.select(*on, answer), on, "left")
    return out.withColumn("error", F.when(F.col(answer).isNull(), F.lit("no recorded answer")))


def texts(files: DataFrame, extract: Callable[[bytes], str]) -> DataFrame:
    """(pdf_url, text) of files, by an extractor that is given by the caller; '' for what it can't read."""

    @F.pandas_udf("string")
    def text(content: pd.Series) -> pd.Series:
        def one(b: bytes) -> str:
            try:
                return extract(bytes(b))
            except Exception:  # noqa: BLE001 - an unreadable file has no text
                return ""

        return content.map(one)

    return files.select("pdf_url", text("content").alias("text"))


def extraction_prompt(text: Column, reference: Column, date: Column, initiative_types: list[str], categories: list[str]) -> Column:
    return F.concat(
        F.lit("Read the minutes below and list every case as JSON: {\"arenden\": [...]}. Quote decisions word for word. "),
        F.lit(f"initiativ_typ is one of {', '.join(initiative_types)}; category one of {', '.join(categories)}. Reference: "),
        reference,
        F.lit(". Meeting date: "),
        date,
        F.lit(".\n\n"),
        text,
    )


def verification_prompt(case_json: Column, text: Column) -> Column:
    return F.concat(F.lit('Compare the case with its source. Answer {"decision": "publish" | "review" | "reject", "reasoning": "", "flagged_issues": []}.\n\nCase:\n'), case_json, F.lit("\n\nSource:\n"), text)
