"""Review decisions: ticks joined to the queue, kept for a time, and carried while unrecorded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Days after which a decision is dropped: its event is long past.
KEPT_DAYS = 400


def recorded(ticks: DataFrame, queue: DataFrame, at: str) -> DataFrame:
    """id, decision, decided_at, fingerprint, title of ticks (id, decision, ord) whose event is still queued (id, fingerprint, title); of several ticks the last."""
    last = ticks.groupBy("id").agg(F.max_by("decision", "ord").alias("decision"))
    return last.join(queue.select("id", "fingerprint", "title"), "id").select("id", "decision", F.lit(at).alias("decided_at"), "fingerprint", "title")


def retained(decisions: DataFrame, new: DataFrame, now: str, days: int = KEPT_DAYS) -> DataFrame:
    """decisions with the new ones in the place of older ones of the same id; those made over `days` ago go."""
    old = decisions.join(new.select("id"), "id", "left_anti").select(*new.columns)
    cutoff = F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return old.unionByName(new).where(F.col("decided_at").cast("timestamp") >= cutoff)


def pending(ticks: DataFrame, done: DataFrame) -> DataFrame:
    """Ticks that this run has not recorded: they are carried into the next body."""
    return ticks.join(done.select("id"), "id", "left_anti")
