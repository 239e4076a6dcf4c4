"""What a run did, by source, and what is to be done about it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel import schema as S
from tessel.functions.review import inert

#: Longest issue body, and the room kept for its last lines.
BODY_MAX, BODY_RESERVE = 60_000, 400


def by_source(sources: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per source with each (stage, metric) as a column stage_metric, 0 where there was none. stats: stage, source, metric, value."""
    wide = stats.withColumn("_name", F.concat_ws("_", "stage", "metric")).groupBy("source").pivot("_name").agg(F.sum("value"))
    return sources.select("source").join(wide, "source", "left").na.fill(0)


def cell(text):
    """Safe in a Markdown table."""
    return F.replace(F.regexp_replace(text, r"\|", r"\\|"), F.lit("\n"), F.lit(" "))


def costs(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """calls (model, tokens_in, tokens_out) with cost, by prices per million; an unknown model costs nothing."""
    rows = calls.join(prices, "model", "left")
    price = lambda t, p: F.col(t) * F.coalesce(F.col(p), F.lit(0.0)) / 1e6
    return rows.withColumn("cost", price("tokens_in", "price_in") + price("tokens_out", "price_out")).select(*calls.columns, "cost")


def review_blocks(queue: DataFrame) -> DataFrame:
    """id, ord and the Markdown block that asks for a decision on each queued event."""
    when = F.concat_ws(" ", F.substr("start", F.lit(1), F.lit(10)), F.substr("start", F.lit(12), F.lit(5)))
    place = inert(F.concat_ws(", ", "venue.name", "venue.city"))
    link = F.format_string("[%s](%s)", inert(F.col("source.publisher")), F.regexp_replace("source.url", r"[()\s<>`]", "_"))
    fields = F.array_join(F.transform("needs_review", lambda p: F.concat(F.lit("`"), inert(p), F.lit("`"))), ", ")
    box = lambda kind: F.concat(F.lit(f"- [ ] {kind} `"), F.col("id"), F.lit("`"))
    lines = F.concat_ws("\n", F.concat(F.lit("#### "), when, F.lit(" · "), inert(F.col("title"))), place, link, F.concat(F.lit("confidence "), F.format_string("%.2f", F.col("confidence"))), fields, box("approve"), box("reject"))
    order = Window.orderBy("start", "id")
    return queue.select("id", F.row_number().over(order).alias("ord"), lines.alias("block"))


def that_fit(blocks: DataFrame, head: int, most: int = BODY_MAX, reserve: int = BODY_RESERVE) -> DataFrame:
    """The first blocks that fit an issue body after a head of so many characters."""
    so_far = F.sum(F.length("block") + 2).over(Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    return blocks.where("block is not null").withColumn("_n", so_far).where(F.col("_n") + head + reserve <= most).drop("_n")


def alerts(status: DataFrame, open_issues: DataFrame) -> DataFrame:
    """source and action: open, update or close an issue, by failures in a row. status: source, consecutive_failures."""
    rows = status.join(open_issues.select("source", F.lit(True).alias("has")), "source", "left")
    has, failing = F.coalesce(F.col("has"), F.lit(False)), F.col("consecutive_failures") >= S.FAILURES_BEFORE_ALERT
    action = F.when(failing & ~has, "open").when(failing & has, "update").when((F.col("consecutive_failures") == 0) & has, "close")
    return rows.select("source", action.alias("action")).where("action is not null")
