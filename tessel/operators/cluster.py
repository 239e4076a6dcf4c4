"""Duplicate records of one performance: exact keys, then similar titles, then one survivor.

Keys begin with the local date and similar titles are sought within it, so a date is a
block without loss. Re-keying is done by windows over the whole table; what depends on
the order of merges runs on one block at a time in Arrow batches.
"""

from __future__ import annotations

import json
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel import schema as S
from tessel.functions import keys, time
from tessel.functions.similarity import normalise, title_similarity
from tessel.functions.text import normalise as normalised

Record = dict
#: Fields of a survivor that a later record fills where they are null.
FILLED = ("subtitle", "description", "end", "doors", "duration_minutes", "presenter", "series")
FILLED_TICKETS = ("price_min", "price_max", "is_free", "concessions_note", "booking_required")
LOG = "struct<date:string,kept:struct<id:string,source:string,title:string>,merged:struct<id:string,source:string,title:string>,score:double>"


def rekeyed(events: DataFrame) -> DataFrame:
    """Keys with the clock time, where one key covers performances at different times."""
    by_key, by_page = Window.partitionBy("dedupe_key"), Window.partitionBy("dedupe_key", "source.url")
    at = F.unix_seconds(time.instant(F.col("start")))
    rows = events.withColumn("_starts", F.size(F.collect_set("start").over(by_page)))
    times = F.size(F.collect_set(time.clock(F.col("start"))).over(by_key))
    spread = F.max(at).over(by_key) - F.min(at).over(by_key)
    rows = rows.withColumns({"_base": F.col("dedupe_key"), "_apart": (times > 1) & ((spread > S.SAME_PERFORMANCE_S) | (F.max("_starts").over(by_key) > 1))})
    own = keys.dedupe_key(F.col("start"), F.col("venue.venue_id"), F.col("venue.name"), F.col("title"))
    key = F.when(F.col("_apart"), F.concat_ws("|", own, time.clock(F.col("start")))).otherwise(F.col("dedupe_key"))
    return rows.withColumn("dedupe_key", key).withColumn("id", F.when(F.col("_apart"), keys.short_hash(F.col("dedupe_key"))).otherwise(F.col("id"))).drop("_starts", "_apart")


def seconds(start: str) -> float:
    return datetime.fromisoformat(start).timestamp()


def same_venue(a: Record, b: Record) -> bool:
    """Ids decide if both have one; one id: the other's name must be an alias; none: similar names in one city."""
    x, y = a["venue"], b["venue"]
    if x["venue_id"] and y["venue_id"]:
        return x["venue_id"] == y["venue_id"]
    if x["venue_id"] or y["venue_id"]:
        known, other = (a, y) if x["venue_id"] else (b, x)
        return normalise(other["name"]) in (known.get("aliases") or [normalise(known["venue"]["name"])])
    return title_similarity(x["name"], y["name"]) >= 0.8 and normalise(x["city"]) == normalise(y["city"])


def close(a: Record, b: Record) -> bool:
    return abs(seconds(a["start"]) - seconds(b["start"])) <= S.SAME_PERFORMANCE_S


def _lean(value):
    """Without nulls, whole numbers as such: as compact JSON writes a record."""
    if isinstance(value, dict):
        return {k: _lean(v) for k, v in value.items() if v is not None and not k.startswith("_") and k != "aliases"}
    if isinstance(value, list):
        return [_lean(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() else value


def rank(record: Record, roles: dict[str, str]) -> tuple:
    """Least first: role, confidence, how much it says, publisher, page."""
    publisher, page = record["source"]["publisher"], record["source"]["url"]
    says = len(json.dumps(_lean(record), ensure_ascii=False, separators=(",", ":")))
    return (S.ROLE_RANK[roles.get(publisher, "aggregator")], -record["confidence"], -says, publisher.casefold(), publisher, page.casefold(), page)


class Survivor:
    """The first of a cluster by rank, filled from the others in their order."""

    def __init__(self, first: Record, roles: dict[str, str]):
        self.record, self.roles = json.loads(json.dumps(first)), roles
        self.review = set(first["needs_review"] or [])
        self.pages = set(first["source"]["secondary_urls"] or [])

    def taken(self, field: str, other: Record) -> None:
        """A field from a doubtful record is doubtful here: by confidence, its path, a child's or a parent's."""
        if other["confidence"] < S.PUBLISH_CONFIDENCE:
            self.review.add(field)
        for path in other["needs_review"] or []:
            if path == field or path.startswith(field + "."):
                self.review.add(path)
            elif field.startswith(path + "."):
                self.review.add(field)

    def fill(self, other: Record) -> None:
        mine, page = self.record, self.record["source"]["url"]
        self.pages |= {u for u in [other["source"]["url"], *(other["source"]["secondary_urls"] or [])] if u != page}
        for field in FILLED:
            if mine[field] is None and other[field] is not None:
                mine[field] = other[field]
                self.taken(field, other)
        for field, along in (("performers", ()), ("programme", ("sa_content",)), ("genre_tags", ())):
            if not mine[field] and other[field]:
                for f in (field, *along):
                    mine[f] = other[f]
                    self.taken(f, other)
        if not mine["venue"]["venue_id"] and other["venue"]["venue_id"]:
            mine["venue"] = other["venue"]
            self.taken("venue", other)
        if other["tickets"]:
            self.fill_tickets(other)
        if S.STATUS_RANK[other["status"]] > S.STATUS_RANK[mine["status"]]:
            mine["status"] = other["status"]
            self.review.add("status")

    def fill_tickets(self, other: Record) -> None:
        theirs, sells = other["tickets"], self.roles.get(other["source"]["publisher"]) == "vendor"
        mine = self.record["tickets"] = self.record["tickets"] or dict.fromkeys(theirs) | {"currency": "ZAR"}
        if theirs["url"] and theirs["url"] != mine["url"] and (sells or not mine["url"]):
            mine["url"] = theirs["url"]
            first, second = (theirs, mine) if sells else (mine, theirs)
            mine["vendor"] = first["vendor"] if first["vendor"] is not None else second["vendor"]
            self.taken("tickets.url", other)
        for field in FILLED_TICKETS:
            if mine[field] is None and theirs[field] is not None:
                mine[field] = theirs[field]
                self.taken(f"tickets.{field}", other)

    def finished(self) -> Record:
        self.record["needs_review"] = sorted(self.review)
        self.record["source"]["secondary_urls"] = sorted(self.pages)
        return self.record


def survivor(cluster: list[Record], roles: dict[str, str]) -> Record:
    if len(cluster) == 1:
        return cluster[0]
    first = min(cluster, key=lambda r: rank(r, roles))
    out = Survivor(first, roles)
    for other in cluster:
        if other is not first:
            out.fill(other)
    return out.finished()


def joinable(cluster: list[Record]) -> bool:
    """Within one performance's window, and no page with two starts."""
    at = [seconds(r["start"]) for r in cluster]
    pages: dict[str, float] = {}
    return max(at) - min(at) <= S.SAME_PERFORMANCE_S and all(pages.setdefault(r["source"]["url"], t) == t for r, t in zip(cluster, at, strict=True))


def deduplicated_block(records: list[Record], roles: dict[str, str], threshold: float = S.TITLE_THRESHOLD) -> tuple[list[Record], list[dict]]:
    """Survivors and the log of fuzzy merges of one date. Records come re-keyed, with `_base`, their key before."""
    records = sorted(records, key=lambda r: (r["start"], r["id"]))
    first_seen = {k: i for i, k in reversed(list(enumerate(r["_base"] for r in records)))}
    records.sort(key=lambda r: first_seen[r["_base"]])
    home = list(range(len(records)))
    members = [[i] for i in home]

    def join(i: int, j: int) -> bool:
        a, b = home[i], home[j]
        both = members[a] + members[b]
        if a == b or not joinable([records[k] for k in both]):
            return a == b
        members[b] = sorted(both)
        members[a] = []
        for k in members[b]:
            home[k] = b
        return True

    by_key: dict[str, int] = {}
    for i, r in enumerate(records):
        join(by_key.setdefault(r["dedupe_key"], i), i)
    log = []
    for i, a in enumerate(records):
        for j in range(i + 1, len(records)):
            b = records[j]
            if home[i] == home[j] or a["source"]["url"] == b["source"]["url"] or not close(a, b) or not same_venue(a, b):
                continue
            score = title_similarity(a["title"], b["title"])
            if score >= threshold and join(i, j):
                short = lambda r: {"id": r["id"], "source": r["source"]["publisher"], "title": r["title"]}
                log.append({"date": a["start"][:10], "kept": short(a), "merged": short(b), "score": int(score * 1000 + 0.5) / 1000})
    clusters = [[records[k] for k in m] for m in sorted((m for m in members if m), key=lambda m: m[0])]
    kept = {r["id"]: min(c, key=lambda x: rank(x, roles))["id"] for c in clusters if len(c) > 1 for r in c}
    for entry in log:
        entry["kept"]["id"] = kept.get(entry["kept"]["id"], entry["kept"]["id"])
    return [survivor(c, roles) for c in clusters], sorted(log, key=lambda e: (e["date"], e["kept"]["id"], e["merged"]["id"]))


def with_aliases(events: DataFrame, venues: DataFrame) -> DataFrame:
    """events with aliases: all normalised names of a resolved venue."""
    names = venues.select("venue_id", F.transform(F.concat(F.array("name"), "aliases"), lambda n: normalised(n)).alias("aliases"))
    return events.join(names, events.venue["venue_id"] == names.venue_id, "left").drop("venue_id")


def deduplicate(events: DataFrame, venues: DataFrame, roles: dict[str, str], threshold: float = S.TITLE_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Survivors (schema.EVENT) and the log of fuzzy merges, of events in any order."""
    rows = with_aliases(rekeyed(events), venues).withColumn("_date", time.local_date(F.col("start")))
    spec = f"{S.EVENT}, log {LOG}"
    out = events.sparkSession.createDataFrame([], spec).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = to_arrow_schema(out)

    def block(table: pa.Table) -> pa.Table:
        kept, log = deduplicated_block(table.to_pylist(), roles, threshold)
        rows = [{c: r.get(c) for c in S.EVENT_COLUMNS} | {"log": None} for r in kept]
        return pa.Table.from_pylist(rows + [dict.fromkeys(S.EVENT_COLUMNS) | {"log": e} for e in log], schema=shape)

    both = rows.groupBy("_date").applyInArrow(block, out)
    return both.where("log is null").drop("log"), both.where("log is not null").select("log.*")
