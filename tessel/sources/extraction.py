"""Documents to raw records by a pluggable extractor, chunk by chunk, with the check of copied text.

The engine calls no model: an extractor is any function from a request to records, run in
Arrow batches on the executors. Recorded answers are one such function.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel import schema as S
from tessel.functions.text import chunks
from tessel.operators.normalise import first_shared_span

#: Characters of a chunk; calls in a run.
CHUNK, MOST_CALLS = 40_000, 250


@dataclass(frozen=True)
class Request:
    """What an extractor gets: one chunk of a document under its header."""

    url: str
    source: str
    model: str
    document: str


#: Records (as JSON texts) and tokens in and out; an exception is a failure of this document only.
Extractor = Callable[[Request], tuple[list[str], int, int]]


def recorded(answers: dict[str, list[dict]]) -> Extractor:
    """An extractor that gives back known answers by URL."""

    def run(request: Request) -> tuple[list[str], int, int]:
        return [json.dumps(r) for r in answers[request.url]], len(request.document), 0

    return run


def prompt_version(prompt: Column) -> Column:
    """Twelve hexadecimal digits of the fenced block after the heading of the system prompt."""
    return F.substr(F.sha2(F.regexp_extract(prompt, r"(?s)## System prompt\s+```[a-z]*\n(.*?)\n```", 1), 256), F.lit(1), F.lit(12))


def model_for(kind: Column, wanted: Column, fast: str, strong: str) -> Column:
    """The strong model for PDFs and where a source wants it."""
    return F.when((kind == "pdf") | F.coalesce(wanted == "strong", F.lit(False)), strong).otherwise(fast)


def requests(docs: DataFrame, most: int = CHUNK, hint: str = "hint") -> DataFrame:
    """docs (url, source, kind, fetched_at, text, model, hint) by chunk, each under a header that says what it is."""
    parts = docs.select("url", "source", "kind", "fetched_at", "model", hint, F.posexplode(chunks(F.col("text"), most)).alias("n", "chunk"), F.size(chunks(F.col("text"), most)).alias("of"))
    line = lambda label, value: F.concat(F.lit(label + ": "), value)
    number = F.when(F.col("of") > 1, F.concat(F.lit("CHUNK: "), (F.col("n") + 1).cast("string"), F.lit(" of "), F.col("of").cast("string")))
    note = F.when(F.coalesce(F.col(hint), F.lit("")) != "", line("SOURCE_NOTE", F.col(hint)))
    header = F.concat_ws("\n", line("SOURCE", F.col("source")), line("URL", F.col("url")), line("FETCHED_AT", F.col("fetched_at")), line("DOCUMENT_TYPE", F.col("kind")), number, note, F.lit("---"), F.col("chunk"))
    return parts.select("url", "source", "model", "n", "of", header.alias("document"))


def within_calls(requests_: DataFrame, refreshes: DataFrame, most: int = MOST_CALLS) -> DataFrame:
    """Requests of whole documents while calls last: changed documents first, then refreshes (url).

    One row per document is ordered in one task; a run's calls are bounded by `most`.
    """
    by_doc = requests_.groupBy("url").agg(F.count("*").alias("calls")).join(refreshes.select("url", F.lit(1).alias("late")), "url", "left").withColumn("late", F.coalesce("late", F.lit(0)))
    first = by_doc.orderBy("late", "url").limit(most)
    so_far = F.sum("calls").over(Window.orderBy("late", "url").rowsBetween(Window.unboundedPreceding, 0))
    return requests_.join(first.withColumn("n_calls", so_far).where(F.col("n_calls") <= most).select("url"), "url", "left_semi")


def extracted(requests_: DataFrame, extractor: Extractor) -> DataFrame:
    """url, n, record (JSON), tokens_in, tokens_out and error of each chunk's records; a failed chunk is one row with an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                try:
                    records, tokens_in, tokens_out = extractor(Request(r.url, r.source, r.model, r.document))
                    rows += [(r.url, r.n, x, 0, 0, None) for x in records]
                    rows.append((r.url, r.n, None, tokens_in, tokens_out, None))
                except Exception as e:  # noqa: BLE001  a bad document must not fail the run
                    rows.append((r.url, r.n, None, 0, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["url", "n", "record", "tokens_in", "tokens_out", "error"])

    return requests_.select("url", "source", "model", "n", "document").mapInPandas(run, "url string, n int, record string, tokens_in bigint, tokens_out bigint, error string")


def guarded(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """rec, doc_url, the record's columns and guard, for normalise(): descriptions that copy their document are dropped at once.

    Documents of which a chunk failed give nothing.
    """
    failed = rows.where("error is not null").select("url").distinct()
    good = rows.where("record is not null").join(failed, "url", "left_anti")
    order = Window.partitionBy("url").orderBy("n", "record")
    parsed = good.withColumn("rec", F.concat_ws("#", "url", F.row_number().over(order).cast("string"))).select("rec", F.col("url").alias("doc_url"), F.from_json("record", S.RAW).alias("r")).select("rec", "doc_url", "r.*")
    text = docs.select(F.col("url").alias("_url"), F.col("text").alias("_text"))
    span = F.when(F.col("description").isNotNull(), first_shared_span(F.col("description"), F.col("_text")))
    out = parsed.join(text, F.col("doc_url") == F.col("_url")).withColumn("_span", span)
    reason = F.concat(F.lit(f'description shares a {S.SPAN_WORDS}-word span with the source ("'), F.left("_span", F.lit(40)), F.lit('…")'))
    return out.withColumn("guard", F.when(F.col("_span").isNotNull(), reason)).withColumn("description", F.when(F.col("_span").isNull(), F.col("description"))).drop("_url", "_text", "_span")
