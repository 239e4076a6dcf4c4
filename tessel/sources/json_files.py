"""Records in JSON files, read by schema and written byte for byte alike."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.functions.review import redact


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file of one JSON array (or objects), or no rows if there is none."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


class SecretFound(ValueError):
    """Something that looks like a key would have been written."""


def refuse_secrets(df: DataFrame, known: dict[str, str] | None = None) -> None:
    row = F.to_json(F.struct(*df.columns))
    if df.select(row.alias("row")).where(redact(F.col("row"), known) != F.col("row")).limit(1).count():
        raise SecretFound("a record holds what looks like a key; nothing was written")


def stable_lines(df: DataFrame, order: list[str | Column], sort_keys: bool = False) -> Iterator[str]:
    """One JSON object a row, in order; nulls absent, keys in the schema's order or sorted."""
    row = F.to_json(F.struct(*df.columns))
    row = F.to_json(F.parse_json(row)) if sort_keys else row
    for r in df.orderBy(*order).select(row.alias("row")).toLocalIterator():
        yield r.row


def write_stable(df: DataFrame, path: str, order: list[str | Column], sort_keys: bool = False, known: dict[str, str] | None = None) -> None:
    """A pretty-printed array in one file, for small published tables; row by row through the driver."""
    refuse_secrets(df, known)
    with open(path, "w", encoding="utf-8") as out:
        out.write("[")
        for k, line in enumerate(stable_lines(df, order, sort_keys)):
            body = json.dumps(json.loads(line), ensure_ascii=False, indent=2)
            out.write((",\n" if k else "\n") + re.sub("^", "  ", body, flags=re.M))
        out.write("\n]\n")
