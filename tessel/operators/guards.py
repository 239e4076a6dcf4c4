"""What a fetch came to, source by source: failures are soft, and an empty result is not believed at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel import schema as S

EMPTY = "no documents were found; the listing or its selector may have changed"
VANISHED = "no link was found, but pages with upcoming events were live before; they are kept"


def outcomes(sources: DataFrame, fetched: DataFrame, kept: DataFrame, errors: DataFrame, status: DataFrame, upcoming: DataFrame, at: str) -> DataFrame:
    """source, ok, error, consecutive_failures, last_success of each source that was tried.

    sources: source, allow_empty, follows (whether documents come by links); fetched, kept:
    source, url, and for fetched followed (whether a link led there); errors: source, error;
    status: source, consecutive_failures, last_success; upcoming: source, url of live
    documents with events to come.

    A source fails by its own error, if nothing was found or kept (unless it may be empty),
    or if it found no link while documents with events to come are live; the last is
    believed after as many failures as raise an alert.
    """
    count = lambda rows, name: rows.groupBy("source").agg(F.count("*").alias(name))
    links = fetched.where("followed").select("source", "url")
    rows = sources.select("source", "allow_empty", "follows").join(errors.groupBy("source").agg(F.min("error").alias("_own")), "source", "left")
    for part, name in ((fetched, "_fetched"), (kept, "_kept"), (links, "_links"), (upcoming.join(fetched.where("not followed").select("source", "url"), ["source", "url"], "left_anti"), "_due")):
        rows = rows.join(count(part, name), "source", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    rows = rows.join(status.select("source", F.col("consecutive_failures").alias("_before"), F.col("last_success").alias("_last")), "source", "left").withColumn("_before", F.coalesce("_before", F.lit(0)))
    empty = (F.col("_fetched") + F.col("_kept") == 0) & ~F.coalesce("allow_empty", F.lit(False))
    gone = F.coalesce("follows", F.lit(False)) & (F.col("_links") == 0) & (F.col("_due") > 0) & (F.col("_before") < S.FAILURES_BEFORE_ALERT)
    error = F.coalesce("_own", F.when(gone, VANISHED), F.when(empty, EMPTY))
    rows = rows.withColumn("error", error).withColumn("ok", F.col("error").isNull())
    return rows.select("source", "ok", "error", F.when(F.col("ok"), 0).otherwise(F.col("_before") + 1).alias("consecutive_failures"), F.when(F.col("ok"), F.lit(at)).otherwise(F.col("_last")).alias("last_success"))


def live_after(found: DataFrame, fetched: DataFrame, kept: DataFrame, previous: DataFrame) -> DataFrame:
    """source, url of live documents: what a source has fetched or kept, or its previous set if it failed or wasn't tried."""
    good, tried = found.where("ok").select("source"), found.select("source")
    failed = found.where("not ok").select("source")
    fresh = fetched.select("source", "url").unionByName(kept.select("source", "url")).join(good, "source", "left_semi")
    before = previous.select("source", "url")
    stale = before.join(failed, "source", "left_semi").unionByName(before.join(tried, "source", "left_anti"))
    return fresh.unionByName(stale).distinct()
