"""Only what changed: live documents, change detection, extraction plans, failures kept beside the last good result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel import schema as S

MANIFEST = "url string, source string, doc_id string, kind string, etag string, last_modified string, content_hash string, raw_hash string, content_changed_at string, last_fetched string"


def last_per_url(docs: DataFrame) -> DataFrame:
    """Of documents with one URL, the last by ord, in the first one's place."""
    return docs.groupBy("url").agg(F.max_by(F.struct(*[c for c in docs.columns if c != "ord"]), "ord").alias("d"), F.min("ord").alias("ord")).select("d.*", "ord")


def recorded(fetched: DataFrame, manifest: DataFrame, at: str) -> DataFrame:
    """Manifest rows of fetched documents (url, source, kind, text), with changed."""
    old = manifest.select("url", F.col("content_hash").alias("_hash"), F.col("content_changed_at").alias("_since"))
    new = fetched.withColumn("content_hash", F.sha2("text", 256)).join(old, "url", "left")
    changed = ~F.coalesce(F.col("_hash") == F.col("content_hash"), F.lit(False))
    return new.select("url", "source", "kind", "content_hash", changed.alias("changed"), F.when(changed, F.lit(at)).otherwise(F.col("_since")).alias("content_changed_at"), F.lit(at).alias("last_fetched"))


def live_set(fetched: DataFrame, kept: DataFrame) -> DataFrame:
    return fetched.select("source", "url").union(kept.select("source", "url")).distinct()


def kept_previous(previous: DataFrame, manifest: DataFrame) -> DataFrame:
    """Documents of the previous set that the manifest still has under their source."""
    return previous.join(manifest.select("url", "source"), ["url", "source"], "left_semi")


def live_documents(live: DataFrame, manifest: DataFrame, extracted: DataFrame, texts: DataFrame) -> DataFrame:
    """Live documents with a good extraction; the text only if it is of the extracted content."""
    rows = live.join(manifest.select("url", "source", "doc_id", F.col("content_hash").alias("current_hash")), ["url", "source"])
    rows = rows.join(extracted.where("status = 'ok'"), ["source", "doc_id"])
    text = texts.select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), "text")
    of_it = (F.col("source") == F.col("_s")) & (F.col("doc_id") == F.col("_d")) & (F.col("content_hash") == F.col("current_hash"))
    return rows.join(text, of_it, "left").drop("_s", "_d")


def plan(status: Column, hash_: Column, retry_hash: Column, attempts: Column, prompt: Column, current_hash: Column, current_prompt: Column, force: bool = False) -> Column:
    """extract, refresh (same content, older prompt), current, or parked (failed too often at this content)."""
    good = F.coalesce((status == "ok") & (hash_ == current_hash) & retry_hash.isNull(), F.lit(False))
    failures = F.when(retry_hash == current_hash, attempts).otherwise(F.lit(0))
    if force:
        return F.lit("extract")
    refresh = good & current_prompt.isNotNull() & ~prompt.eqNullSafe(current_prompt)
    return F.when(refresh, "refresh").when(good, "current").when(failures >= S.MAX_ATTEMPTS, "parked").otherwise("extract")


def failed(existing: DataFrame, failures: DataFrame, at: str) -> DataFrame:
    """Extraction rows after failures (source, doc_id, content_hash, error): a good one stays, with the failure noted beside it."""
    new = failures.select("source", "doc_id", F.col("content_hash").alias("_hash"), "error")
    rows = existing.join(new, ["source", "doc_id"], "right")
    tried = F.when(F.col("retry.content_hash") == F.col("_hash"), F.col("retry.attempts")).otherwise(F.lit(0)) + 1
    good = F.coalesce(F.col("status") == "ok", F.lit(False))
    retry = F.struct(F.col("_hash").alias("content_hash"), tried.cast("int").alias("attempts"), F.col("error").alias("error"), F.lit(at).alias("at"))
    return rows.select("source", "doc_id", F.when(good, F.col("content_hash")).otherwise(F.col("_hash")).alias("content_hash"), F.when(good, "ok").otherwise("error").alias("status"), F.when(good, F.col("events")).alias("events"), retry.alias("retry"))


def orphans(extracted: DataFrame, live: DataFrame) -> DataFrame:
    """Extractions of documents that are not live."""
    return extracted.join(live.select("source", "doc_id"), ["source", "doc_id"], "left_anti")


def upcoming(extracted: DataFrame, now: Column) -> DataFrame:
    """Extractions with an event to come."""
    return extracted.where(F.exists("events", lambda e: F.try_to_timestamp(e["start"], F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")) > now))


def within_budget(rows: DataFrame, cost: str, budget: float, order: list[Column], per: str) -> DataFrame:
    """Of each `per`, the first rows in order whose running cost stays within the budget."""
    so_far = Window.partitionBy(per).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_cost", F.sum(cost).over(so_far)).where(F.col("_cost") <= budget).drop("_cost")


def failure_streaks(runs: DataFrame, key: str, order: str, failed: str) -> DataFrame:
    """key and streak: failures in a row up to the last run (gaps and islands)."""
    last_good = F.max(F.when(~F.col(failed), F.col(order))).over(Window.partitionBy(key))
    rows = runs.withColumn("_good", last_good)
    since = F.col("_good").isNull() | (F.col(order) > F.col("_good"))
    return rows.groupBy(key).agg(F.count_if(since & F.col(failed)).alias("streak"))
