"""A batch of events folded into what is published: stable ids, review gate, tombstones."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel import schema as S
from tessel.functions import keys, time
from tessel.functions.similarity import title_similarity
from tessel.operators.cluster import Record, close, same_venue, seconds, with_aliases

#: Largest group of competing events whose assignment is searched exhaustively.
EXHAUSTIVE = 7

Candidate = tuple[str, float, float]  # prior id, score, gap in seconds


def best_assignment(options: Sequence[Sequence[Candidate]]) -> list[str | None]:
    """For each event a prior id or None: most matches, then greatest total score, then least total gap, then the first.

    Dynamic programming over the set of used ids; beyond EXHAUSTIVE events, best pair first.
    """
    if len(options) > EXHAUSTIVE:
        pairs = sorted(((-s, g, i, p) for i, o in enumerate(options) for p, s, g in o), key=lambda x: x[:2])
        out: list[str | None] = [None] * len(options)
        used = set()
        for _, _, i, p in pairs:
            if out[i] is None and p not in used:
                out[i] = p
                used.add(p)
        return out
    states: dict[frozenset, tuple] = {frozenset(): ((0, 0.0, 0.0), ())}
    for choices in options:
        after: dict[frozenset, tuple] = {}
        for used, (total, picks) in states.items():
            for order, (p, score, gap) in enumerate([*choices, (None, 0.0, 0.0)]):
                if p in used:
                    continue
                worth = (total[0] + (p is not None), total[1] + score, total[2] - gap)
                state = (worth, (*picks, -order))
                now = used | {p} if p is not None else used
                if now not in after or state > after[now]:
                    after[now] = state
        states = after
    _, picks = max(states.values())
    return [[*(p for p, _, _ in o), None][-k] for o, k in zip(options, picks, strict=True)]


def groups(options: dict[int, list[Candidate]]) -> list[list[int]]:
    """Events that compete, directly or through each other, for the same priors."""
    by_prior = defaultdict(list)
    for e, list_ in options.items():
        for p, _, _ in list_:
            by_prior[p].append(e)
    left, out = dict.fromkeys(options), []
    while left:
        group, todo = [], [next(iter(left))]
        while todo:
            e = todo.pop()
            if e in left:
                del left[e]
                group.append(e)
                todo += [o for p, _, _ in options[e] for o in by_prior[p]]
        out.append(sorted(group))
    return out


def assigned_block(incoming: list[Record], prior: list[Record], threshold: float = S.TITLE_THRESHOLD) -> dict[int, str]:
    """ord of an incoming event -> id of the prior one that it continues, within a date."""
    options: dict[int, list[Candidate]] = {}
    for e in sorted(incoming, key=lambda r: r["ord"]):
        found = []
        for p in sorted(prior, key=lambda r: r["ord"]):
            if close(e, p) and same_venue(p, e):
                score = title_similarity(p["title"], e["title"])
                if score >= threshold:
                    found.append((p["id"], score, abs(seconds(p["start"]) - seconds(e["start"]))))
        if found:
            options[e["ord"]] = sorted(found, key=lambda c: (-c[1], c[2]))
    out = {}
    for group in groups(options):
        picks = best_assignment([options[e] for e in group])
        out |= {e: p for e, p in zip(group, picks, strict=True) if p is not None}
    return out


def content(prefix: str = "") -> Column:
    """What makes an event different: all but when it was seen and fetched."""
    fields = [F.col(prefix + c).alias(c) for c in S.EVENT_COLUMNS if c not in ("first_seen", "last_updated", "source")]
    return F.struct(*fields, F.col(prefix + "source").dropFields("fetched_at", "content_hash").alias("source"))


def reconcile(incoming: DataFrame, published: DataFrame, queue: DataFrame, decisions: DataFrame, venues: DataFrame, now: datetime) -> DataFrame:
    """schema.EVENT rows with list (published or queue) and action.

    action: added, updated, unchanged, queued, kept (published while its new version
    waits), carried, unconfirmed. Rejected events have action rejected and list null.
    incoming has ord, its order; ties between events of one id go to the first.
    """
    columns = S.EVENT_COLUMNS
    prior = queue.select(*columns, F.lit(False).alias("live")).unionByName(published.select(*columns, F.lit(True).alias("live")))
    # of a record in both, the published one counts
    one = Window.partitionBy("id").orderBy(F.desc("live"))
    prior = prior.withColumn("_k", F.row_number().over(one)).where("_k = 1").drop("_k")
    prior = prior.withColumn("ord", F.struct("live", "id"))
    first = Window.partitionBy("id").orderBy("ord")
    rows = incoming.withColumn("_k", F.row_number().over(first))
    exact = rows.where("_k = 1").join(prior.select("id"), "id", "left_semi").select("ord", F.col("id").alias("prior_id"))
    rest, free = rows.join(exact, "ord", "left_anti"), prior.join(exact.select(F.col("prior_id").alias("id")), "id", "left_anti")
    seen = ["id", "title", "start", "venue", "ord"]
    left = with_aliases(rest.select(*seen), venues).withColumn("_date", time.local_date(F.col("start")))
    right = with_aliases(free.select("id", "title", "start", "venue", F.to_json("ord").alias("ord")), venues).withColumn("_date", time.local_date(F.col("start")))

    def block(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        got = assigned_block(mine.to_pylist(), theirs.to_pylist())
        return pa.table({"ord": pa.array(got, pa.int64()), "prior_id": pa.array(got.values(), pa.string())})

    fuzzy = left.groupBy("_date").cogroup(right.groupBy("_date")).applyInArrow(block, "ord bigint, prior_id string")
    links = exact.unionByName(fuzzy)
    before = prior.select(F.struct(*columns).alias("was"), F.col("live").alias("was_live"), F.col("id").alias("prior_id"), keys.fingerprint(content()).alias("was_print"))
    both = incoming.join(links, "ord", "left").join(before, "prior_id", "left").withColumn("id", F.coalesce("prior_id", "id"))
    claim = Window.partitionBy("id").orderBy("ord")
    both = both.withColumn("_k", F.row_number().over(claim)).where("_k = 1").drop("_k")
    at = F.lit(now.isoformat()).cast("timestamp")
    seen_at = time.rendered(at)
    known, same = F.col("was").isNotNull(), F.col("was_print") == keys.fingerprint(content())
    changed = ~F.coalesce(same, F.lit(False))
    both = both.withColumns({"changed": changed, "print": keys.fingerprint(content())})
    both = both.withColumns(
        {
            "first_seen": F.coalesce(F.col("was.first_seen"), seen_at),
            "last_updated": F.when(F.col("changed"), seen_at).otherwise(F.coalesce(F.col("was.last_updated"), seen_at)),
        }
    )
    said = decisions.select(F.col("id").alias("_d"), F.col("fingerprint").alias("_f"), "decision")
    both = both.join(said, (F.col("id") == F.col("_d")) & (F.col("print") == F.col("_f")), "left").drop("_d", "_f")
    doubtful = (F.col("confidence") < S.PUBLISH_CONFIDENCE) | (F.coalesce(F.size("needs_review"), F.lit(0)) > 0)
    decided = F.coalesce(F.col("decision"), F.lit(""))
    live = F.coalesce(F.col("was_live"), F.lit(False))
    action = F.when(decided == "reject", "rejected").when(doubtful & (decided != "approve"), "queued").when(~live, "added").when(F.col("changed"), "updated").otherwise("unchanged")
    both = both.withColumn("action", action).withColumn("list", F.when(action == "queued", "queue").when(action != "rejected", "published"))
    kept = both.where((F.col("action") == "queued") & live).select("was.*", F.lit("published").alias("list"), F.lit("kept").alias("action"))
    gone = prior.where("live").join(both.where(known).select(F.col("was.id").alias("id")), "id", "left_anti")
    waits = (time.instant(F.col("start")) > at) & ~F.col("status").isin("unconfirmed", "cancelled")
    gone = gone.withColumn("action", F.when(waits, "unconfirmed").otherwise("carried"))
    gone = gone.withColumns({"status": F.when(waits, "unconfirmed").otherwise(F.col("status")), "last_updated": F.when(waits, seen_at).otherwise(F.col("last_updated"))})
    out = both.select(*columns, "list", "action").unionByName(kept.select(*columns, "list", "action"))
    return out.unionByName(gone.select(*columns, F.lit("published").alias("list"), "action"))


def counts(actions: DataFrame) -> DataFrame:
    """publisher (null: all) and the number of each action."""
    kinds = ("added", "updated", "queued", "unconfirmed", "rejected")
    return actions.rollup(F.col("source.publisher").alias("publisher")).agg(*(F.count_if(F.col("action") == k).alias(k) for k in kinds))


def newly_queued(actions: DataFrame, queue: DataFrame) -> DataFrame:
    """Ids that wait now and did not wait with this content."""
    now = actions.where("action = 'queued'").select("id", keys.fingerprint(content()).alias("print"))
    return now.join(queue.select("id", keys.fingerprint(content()).alias("print")), ["id", "print"], "left_anti").select("id")
