"""The queries of this subpackage and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessel.llm import chat_quotes, decontaminate, line_dedup, mixing, neighbours, pii, quality, secrets, simhash, token_output

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_simhash": simhash.op2_simhash,
    "op3_secrets": secrets.op3_secrets,
    "op4_chat_quotes": chat_quotes.op4_chat_quotes,
    "op5_mixing": mixing.op5_mixing,
    "op6_quality": quality.op6_quality,
    "op7_token_output": token_output.op7_token_output,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_neighbours": neighbours.op9_neighbours,
    "op10_line_dedup": line_dedup.op10_line_dedup,
}

SQL: dict[str, str] = {
    "op3_secrets": secrets.SQL,
    "op4_chat_quotes": chat_quotes.SQL,
    "op8_decontamination": decontaminate.SQL,
    "op9_neighbours": neighbours.SQL,
    "op10_line_dedup": line_dedup.SQL,
}
