"""Extracted events scored against labelled ones, field by field."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.functions.similarity import normalise, title_similarity

#: The fields that are compared as they are, after what kind of value they hold.
SCALARS = {
    "title": "text", "subtitle": "text", "series": "text", "presenter": "text", "start": "instant", "end": "instant", "doors": "instant",
    "venue.venue_id": "", "venue.name": "text", "venue.city": "text", "venue.province": "", "tickets.url": "url", "tickets.vendor": "",
    "tickets.price_min": "", "tickets.price_max": "", "tickets.is_free": "", "status": "", "sa_content.has_sa_work": "",
}
PAIR_FLOOR, WORK_FLOOR = 0.3, 0.6
#: What may be lost before a run counts as worse: overall, and at all.
TOLERANCE, STRICT = 0.05, ("title", "start")


def at(record: dict, path: str):
    for key in path.split("."):
        record = (record or {}).get(key)
    return record


def empty(value) -> bool:
    return value is None or value == []


def comparable(value, kind: str):
    if not isinstance(value, str):
        return value
    if kind == "text":
        return normalise(value)
    if kind == "instant":
        return datetime.fromisoformat(value)
    return value.removesuffix("/") if kind == "url" else value


def f1(a: list, b: list) -> float:
    if not a and not b:
        return 1.0
    return 2 * (Counter(a) & Counter(b)).total() / (len(a) + len(b))


def pair_scores(label: dict, found: dict) -> Iterator[tuple[str, float]]:
    """(field, credit) of every field that either side has."""
    for path, kind in SCALARS.items():
        a, b = at(label, path), at(found, path)
        if not (empty(a) and empty(b)):
            yield path, float(comparable(a, kind) == comparable(b, kind))
    mine, theirs = label.get("performers") or [], found.get("performers") or []
    if mine or theirs:
        named = lambda ps: [(normalise(p["name"]), p["role"]) for p in ps]
        yield "performers", f1(named(mine), named(theirs))
        for p in mine:
            other = next((q for q in theirs if normalise(q["name"]) == normalise(p["name"])), None)
            if other and not (empty(p.get("instrument")) and empty(other.get("instrument"))):
                yield "performers.instrument", float(comparable(p.get("instrument"), "text") == comparable(other.get("instrument"), "text"))
    mine, theirs = label.get("programme") or [], list(found.get("programme") or [])
    if mine or theirs:
        composers = lambda ws: [normalise(w["composer"]) for w in ws]
        yield "programme.composer", f1(composers(mine), composers(theirs))
        for work in mine:
            same = [w for w in theirs if normalise(w["composer"]) == normalise(work["composer"]) and title_similarity(w["work"], work["work"]) >= WORK_FLOOR]
            yield "programme.work", float(bool(same))
            if same:
                theirs.remove(same[0])
                a, b = work.get("catalogue"), same[0].get("catalogue")
                if not (empty(a) and empty(b)):
                    yield "programme.catalogue", float(comparable(a, "text") == comparable(b, "text"))
    for path in ("genre_tags", "sa_content.sa_composers"):
        a, b = at(label, path) or [], at(found, path) or []
        if a or b:
            yield path, f1([normalise(x) for x in a], [normalise(x) for x in b])
    if "description" in label:
        yield "description.present", float(empty(label["description"]) == empty(found.get("description")))


def case_scores(labels: list[dict], found: list[dict]) -> tuple[dict[str, tuple[float, int]], int]:
    """Credit and count by field, and how many labels were matched: by date, greedily by title or series."""
    left, fields, matched = list(found), {}, 0
    for label in labels:
        best, top = None, PAIR_FLOOR
        for f in left:
            if f["start"][:10] != (label.get("start") or "")[:10]:
                continue
            score = max(title_similarity(f["title"], label.get("title") or ""), title_similarity(f["title"], label["series"]) if label.get("series") else 0.0)
            if score > top or (best is None and score >= top):
                best, top = f, score
        if best is None:
            continue
        matched += 1
        left = [f for f in left if f is not best]
        for field, credit in pair_scores(label, best):
            correct, total = fields.get(field, (0.0, 0))
            fields[field] = correct + credit, total + 1
    return fields, matched


def score(labels: DataFrame, found: DataFrame, case: str = "case") -> DataFrame:
    """case, field, correct, total; field 'events' has matched and labelled, 'found' has matched and found."""

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        rows, found_rows = mine.to_pylist(), theirs.to_pylist()
        fields, matched = case_scores(rows, found_rows)
        fields |= {"events": (float(matched), len(rows)), "found": (float(matched), len(found_rows))}
        name = str((rows or found_rows)[0][case])
        return pa.table({"case": pa.array([name] * len(fields), pa.string()), "field": pa.array(fields, pa.string()), "correct": pa.array([c for c, _ in fields.values()], pa.float64()), "total": pa.array([t for _, t in fields.values()], pa.int64())})

    return labels.groupBy(case).cogroup(found.groupBy(case)).applyInArrow(run, "case string, field string, correct double, total bigint")


def combined(scores: DataFrame) -> DataFrame:
    """field, correct, total, accuracy over all cases (1 where nothing was to be found)."""
    rows = scores.groupBy("field").agg(F.sum("correct").alias("correct"), F.sum("total").alias("total"))
    return rows.withColumn("accuracy", F.when(F.col("total") == 0, F.lit(1.0)).otherwise(F.col("correct") / F.col("total")))


def regressions(now: DataFrame, before: DataFrame) -> DataFrame:
    """What is worse than before beyond its tolerance: field, was, is."""
    fields = ~F.col("field").isin("events", "found")
    total = lambda d: d.where(fields).agg(F.lit("overall").alias("field"), (F.sum("correct") / F.sum("total")).alias("accuracy"))
    strict = F.col("field").isin(*STRICT, "events", "found")
    every = lambda d: d.where(strict).select("field", "accuracy").unionByName(total(d))
    both = every(now).withColumnRenamed("accuracy", "is").join(every(before).withColumnRenamed("accuracy", "was"), "field")
    lost = F.col("was") - F.col("is")
    return both.where(F.when(F.col("field") == "overall", lost > TOLERANCE).otherwise(lost > 0)).select("field", "was", "is")
