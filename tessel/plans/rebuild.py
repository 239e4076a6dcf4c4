"""From extracted records to what is published: normalise, deduplicate, reconcile, as one job graph."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from tessel.operators import cluster, normalise, reconcile


@dataclass
class Rebuilt:
    tagged: DataFrame
    rejects: DataFrame
    merges: DataFrame
    actions: DataFrame

    @property
    def published(self) -> DataFrame:
        return self.actions.where("list = 'published'").drop("list", "action").orderBy("start", "id")

    @property
    def queue(self) -> DataFrame:
        return self.actions.where("list = 'queue'").drop("list", "action").orderBy("start", "id")


def numbered(events: DataFrame) -> DataFrame:
    """events with ord, their order by start, id and content: counted within days, on top of the days before.

    It depends on the rows alone, so a recomputed partition gives the same numbers.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window

    day = events.withColumn("_day", F.coalesce(F.substr("start", F.lit(1), F.lit(10)), F.lit("")))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = day.groupBy("_day").agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_day").orderBy("start", "id", F.to_json(F.struct(*events.columns)))
    return day.withColumn("_k", F.row_number().over(inside)).join(days, "_day").withColumn("ord", F.col("_base") + F.col("_k")).select(*events.columns, "ord")


def rebuild(raw: DataFrame, docs: DataFrame, venues: DataFrame, composers: DataFrame, roles: dict[str, str], published: DataFrame, queue: DataFrame, decisions: DataFrame, now: datetime) -> Rebuilt:
    """raw, docs: as normalise.normalise() takes them; the tagged table is read twice and so is kept."""
    from pyspark.sql import functions as F

    tagged = normalise.normalise(raw, docs, venues, composers, now).persist()
    good = tagged.where("outcome = 'ok'").drop("rec", "outcome", "reasons")
    events, merges = cluster.deduplicate(good, venues, roles)
    batch = numbered(events).persist()
    actions = reconcile.reconcile(batch, published, queue, decisions, venues, now)
    return Rebuilt(tagged, normalise.rejects(tagged), merges, actions)
