"""Raw records to publishable ones, or to the reasons why not, as one tagged table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel import schema as S
from tessel.functions import keys, time, url
from tessel.functions.text import shingles, words
from tessel.operators.lookup import match_composers, resolve_venues

_NO_TEXTS = "cast(array() as array<string>)"
_PATH = r"(?i)^[a-z_]+(\.[a-z0-9_]+){0,4}$"


def first_shared_span(a: Column, b: Column, n: int = S.SPAN_WORDS) -> Column:
    """The first n-word span of text a that text b has too; null if there is none."""
    # text b is normalised once: the only element of an array is bound for all spans
    other = F.array(F.concat(F.lit(" "), F.array_join(words(b), " "), F.lit(" ")))
    found = F.transform(other, lambda hay: F.get(F.filter(shingles(words(a), n), lambda s: F.contains(hay, F.concat(F.lit(" "), s, F.lit(" ")))), F.lit(0)))
    return F.get(found, F.lit(0))


def rules() -> list[tuple[str, str]]:
    """Schema rules, in order of the keys: (message, condition that breaks it)."""

    def listed(values: list[str]) -> str:
        return ", ".join(f"'{v}'" for v in values)

    return [
        ("title: too short", "title is null or length(title) < 3"),
        ("start: missing", "start is null"),
        ("duration_minutes: out of range", "duration_minutes <> floor(duration_minutes) or duration_minutes not between 10 and 600"),
        ("venue: missing", "venue is null"),
        ("venue.name: missing", "venue is not null and venue.name is null"),
        ("venue.city: missing", "venue is not null and venue.city is null"),
        ("venue.province: unknown", f"venue is not null and coalesce(venue.province not in ({listed(S.PROVINCES)}), true)"),
        ("performers: unknown role", f"exists(performers, p -> p.name is null or coalesce(p.role not in ({listed(S.PERFORMER_ROLES)}), true))"),
        ("programme: incomplete or unknown premiere", f"exists(programme, w -> w.composer is null or w.work is null or coalesce(w.is_premiere not in ({listed(S.PREMIERES)}), false))"),
        ("genre_tags: unknown", f"exists(genre_tags, g -> coalesce(g not in ({listed(S.GENRE_TAGS)}), true))"),
        ("tickets.vendor: unknown", f"tickets.vendor not in ({listed(S.VENDORS)})"),
        ("tickets.price_min: negative", "tickets.price_min < 0"),
        ("tickets.price_max: negative", "tickets.price_max < 0"),
        ("status: unknown", f"status not in ({listed(S.STATUSES)})"),
        ("confidence: out of range", "confidence is null or confidence not between 0 and 1"),
    ]


def normalise(raw: DataFrame, docs: DataFrame, venues: DataFrame, composers: DataFrame, now: datetime) -> DataFrame:
    """outcome (ok, past or rejected), reasons, and the event's columns, for each raw record.

    raw: the extractor's columns, with rec (names the record), doc_url and guard (why the
    extractor's own text check failed, or null). docs: schema.DOCUMENT; a null text leaves
    the check of copied text to the extractor's.
    """
    d = docs.select(F.col("url").alias("doc_url"), F.col("source").alias("doc_source"), F.col("fetched_at").alias("doc_fetched"), F.col("content_hash").alias("doc_hash"), F.col("text").alias("doc_text"), F.col("default_presenter").alias("doc_presenter"))
    rows = raw.join(d, "doc_url")
    for c in ("start", "end", "doors"):
        rows = rows.withColumn(f"_{c}", time.normalised(F.col(c)))
    rows = resolve_venues(rows, venues, "rec")
    rows = match_composers(rows, composers, "rec")
    v, m, t = F.col("venue"), F.col("match"), F.col("tickets")
    own = F.struct(
        m["venue_id"].alias("venue_id"), m["name"].alias("name"), F.coalesce(m["address"], v["address"]).alias("address"), m["city"].alias("city"),
        m["province"].alias("province"), F.coalesce(m["lat"], v["lat"]).alias("lat"), F.coalesce(m["lng"], v["lng"]).alias("lng"),
    )
    bad_link = t["url"].isNotNull() & ~url.is_http(t["url"])
    link = F.when(bad_link, F.lit(None)).otherwise(url.canonical(t["url"]))
    said = [link, *(t[c] for c in ("vendor", "price_min", "price_max", "is_free", "concessions_note", "booking_required"))]
    known = F.greatest(*(F.when(c.isNotNull(), 1).otherwise(0) for c in said)) == 1
    tickets = F.when(known, t.withField("url", link).withField("currency", F.lit("ZAR")))
    span = F.when(F.col("doc_text").isNotNull() & F.col("description").isNotNull(), first_shared_span(F.col("description"), F.col("doc_text")))
    long = span.isNull() & (F.length("description") > S.DESCRIPTION_MAX)
    flags = F.array(
        F.when(F.col("end").isNotNull() & F.col("_end").isNull(), "end"),
        F.when(F.col("doors").isNotNull() & F.col("_doors").isNull(), "doors"),
        F.when(F.col("flag"), "venue.venue_id"),
        F.when(bad_link, "tickets.url"),
        F.when(long, "description"),
    )
    review = F.concat(F.filter(F.coalesce("needs_review", F.expr(_NO_TEXTS)), lambda p: p.rlike(_PATH)), F.col("unsure"), F.filter(flags, lambda p: p.isNotNull()))
    price = (t["price_min"] > t["price_max"]) & known
    early = F.array(
        F.when(F.col("start").isNotNull() & F.col("_start").isNull(), F.concat(F.lit('start is not a valid timestamp: "'), F.col("start"), F.lit('"'))),
        F.when(price, F.concat(F.lit("price_min "), t["price_min"].cast("string"), F.lit(" > price_max "), t["price_max"].cast("string"))),
        F.when(F.col("guard").isNotNull(), F.concat(F.lit("copyright guard: "), F.col("guard"))),
        F.when(span.isNotNull(), F.concat(F.lit(f'copyright guard: description shares a {S.SPAN_WORDS}-word span with the source ("'), span, F.lit('")'))),
    )
    model = F.col("source.url")
    page = F.when(url.is_http(model) & url.same_host(model, F.col("doc_url")), url.canonical(model)).otherwise(F.col("doc_url"))
    source = F.struct(page.alias("url"), F.col("doc_source").alias("publisher"), F.col("doc_fetched").alias("fetched_at"), F.col("doc_hash").alias("content_hash"), F.expr(_NO_TEXTS).alias("secondary_urls"))
    content = F.struct(F.col("sa_composers"), (F.size("sa_composers") > 0).alias("has_sa_work"), F.coalesce(F.col("sa_content.languages"), F.expr(_NO_TEXTS)).alias("languages"))
    presenter = F.coalesce(F.when(F.col("presenter") != "", F.col("presenter")), F.col("doc_presenter"), F.col("presenter"))
    rows = rows.withColumns(
        {
            "early": early,
            "needs_review": F.array_sort(F.array_distinct(review)),
            "description": F.when(long, F.lit(None)).otherwise(F.col("description")),
            "tickets": tickets,
            "venue": F.when(m.isNotNull(), own).when(v.isNotNull(), v.withField("venue_id", F.lit(None).cast("string"))),
            "source": source,
            "sa_content": content,
            "presenter": presenter,
            "status": F.coalesce("status", F.lit("scheduled")),
        }
    ).withColumns({"start": F.col("_start"), "end": F.col("_end"), "doors": F.col("_doors")})
    key = F.when(F.col("start").isNotNull() & (F.col("title") != "") & (F.col("venue.name") != ""), keys.dedupe_key(F.col("start"), F.col("venue.venue_id"), F.col("venue.name"), F.col("title")))
    rows = rows.withColumn("dedupe_key", key).withColumn("id", keys.short_hash(F.col("dedupe_key")))
    broken = F.array(*(F.when(F.expr(c), F.lit(text)) for text, c in rules()))
    rows = rows.withColumn("reasons", F.filter(F.concat("early", broken), lambda r: r.isNotNull()))
    at, until, fetched = time.instant(F.col("start")), time.instant(F.col("end")), time.instant(F.col("doc_fetched"))
    late = F.array(
        F.when(at > time.plus_months(fetched, S.HORIZON_MONTHS), F.concat(F.lit("start "), F.col("start"), F.lit(f" is more than {S.HORIZON_MONTHS} months after the fetch date"))),
        F.when(until < at, F.concat(F.lit("end "), F.col("end"), F.lit(" is before start"))),
    )
    fine = F.size("reasons") == 0
    past = fine & (at <= F.lit(now.isoformat()).cast("timestamp"))
    rows = rows.withColumn("past", past).withColumn("reasons", F.when(fine & ~F.col("past"), F.filter(late, lambda r: r.isNotNull())).otherwise(F.col("reasons")))
    outcome = F.when(F.col("past"), "past").when(F.size("reasons") > 0, "rejected").otherwise("ok")
    return rows.select(
        "rec", outcome.alias("outcome"), "reasons", "id", "dedupe_key", "title", "subtitle", "description", "start", "end", "doors", F.col("duration_minutes").cast("int").alias("duration_minutes"),
        "venue", "presenter", "series", "performers", "programme", "sa_content", "genre_tags", "tickets", "source", "status", "confidence", "needs_review", "extraction_notes",
        F.lit(None).cast("string").alias("first_seen"), F.lit(None).cast("string").alias("last_updated"),
    )


def rejects(tagged: DataFrame) -> DataFrame:
    """source, url, title, start and reasons of rejected records, in that order; never a description."""
    rows = tagged.where("outcome = 'rejected'").select(F.col("source.publisher").alias("source"), F.col("source.url").alias("url"), "title", "start", "reasons")
    return rows.orderBy("source", "url", F.coalesce("start", F.lit("")))
