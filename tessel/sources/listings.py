"""Structured listings: ticket vendors' events and calendars embedded in pages, as text documents."""

from __future__ import annotations

import html
import json
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.functions import time, url
from tessel.functions.text import has_keyword, slug

VENDOR_EVENT = (
    "struct<id:bigint,name:string,description:string,url:string,startDate:string,endDate:string,lastModified:string,"
    "venue:struct<name:string,addressLine1:string,addressLine2:string,latitude:double,longitude:double>,"
    "locality:struct<levelOne:string,levelTwo:string,levelThree:string>,organiser:struct<id:bigint,name:string,organiserPageUrl:string>,"
    "categories:array<struct<id:bigint,name:string>>,tickets:array<struct<name:string,soldOut:boolean,provisionallySoldOut:boolean,price:double,donation:boolean>>,"
    "schedules:array<struct<name:string,startDate:string,endDate:string>>>"
)
CALENDAR = "array<struct<title:string,description:string,start:string,end:string,allDay:string,url:string>>"


def _filled(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), ", ")


def vendor_events(pages: DataFrame, body: str = "body") -> DataFrame:
    """event, one row per result of each response body of a paged listing."""
    return pages.select(F.explode(F.from_json(body, f"struct<results:array<{VENDOR_EVENT}>,pages:int,records:int>")["results"]).alias("event"))


def organiser_id(e: Column) -> Column:
    """The organiser's id, or the one in its page's address."""
    in_page = F.regexp_extract(F.coalesce(e["organiser"]["organiserPageUrl"], F.lit("")), r"/organisers/(\d+)", 1)
    own = e["organiser"]["id"]
    return F.when(own.isNotNull() & (own != 0), own).when(in_page != "", in_page.cast("bigint"))


def last_date(e: Column) -> Column:
    """The latest date that a listing covers, its performances' included; null if none can be read."""
    dates = F.concat(F.array(e["endDate"], e["startDate"]), F.flatten(F.transform(F.coalesce(e["schedules"], F.array().cast("array<struct<name:string,startDate:string,endDate:string>>")), lambda s: F.array(s["endDate"], s["startDate"]))))
    return F.array_max(F.transform(dates, lambda d: time.instant(time.normalised(d))))


def vendor_match(e: Column, organisers: list[int]) -> Column:
    """By a listed organiser, or a keyword anywhere that matters."""
    hay = F.concat_ws(" ", e["name"], e["description"], e["organiser"]["name"], F.array_join(F.transform(e["categories"], lambda c: c["name"]), " "), e["venue"]["name"])
    return F.coalesce(organiser_id(e).isin(organisers), F.lit(False)) | has_keyword(hay)


def not_over(latest: Column, now: Column) -> Column:
    """Not over for a day; what can't be read is kept."""
    return F.coalesce(latest >= now - F.expr("interval 24 hours"), F.lit(True))


def number(n: Column) -> Column:
    """Without needless decimals."""
    return F.regexp_replace(n.cast("string"), r"\.0$", "")


def vendor_text(e: Column, details: Column) -> Column:
    """A small document that only changes when the event does."""
    line = lambda label, value: F.when(value.isNotNull() & (value != ""), F.concat(F.lit(label), value))
    v, where, org = e["venue"], e["locality"], e["organiser"]
    page = F.when(org["organiserPageUrl"] != "", F.concat(F.lit(" <"), org["organiserPageUrl"], F.lit(">")))
    organiser = F.when(org["name"] != "", F.concat(F.lit("Organiser: "), org["name"], F.coalesce(page, F.lit("")))).when(page.isNotNull(), F.concat(F.lit("Organiser page:"), page))

    def ticket(t: Column) -> Column:
        flags = _filled(F.when(t["soldOut"], "sold out"), F.when(t["donation"], "donation"))
        return F.concat(F.lit("- "), F.coalesce(t["name"], F.lit("Ticket")), F.lit(": R"), F.coalesce(number(t["price"]), F.lit("?")), F.when(flags != "", F.concat(F.lit(" ("), flags, F.lit(")"))).otherwise(""))

    def show(s: Column) -> Column:
        until = F.when(s["endDate"] != "", F.concat(F.lit(" to "), s["endDate"])).otherwise("")
        return F.trim(F.concat(F.lit("- "), F.coalesce(s["name"], F.lit("")), F.lit(" "), F.coalesce(s["startDate"], F.lit("")), until))

    block = lambda label, xs, f, least: F.when(F.size(xs) >= least, F.concat(F.lit(label + "\n"), F.array_join(F.transform(xs, f), "\n")))
    named = v["name"] != ""
    return F.concat(
        F.concat_ws(
            "\n",
            F.lit("VENDOR EVENT (fields from the vendor's listing; times are as it reports them)"),
            F.concat(F.lit("Name: "), e["name"]),
            line("Event page: ", url.canonical(e["url"])),
            line("Start: ", e["startDate"]),
            line("End: ", e["endDate"]),
            F.when(named, line("Venue: ", _filled(v["name"], v["addressLine1"], v["addressLine2"]))),
            F.when((v["latitude"] != 0) & (v["longitude"] != 0), F.concat(F.lit("Venue coordinates: "), number(v["latitude"]), F.lit(", "), number(v["longitude"]))),
            F.when(where.isNotNull(), F.concat(F.lit("Locality: "), _filled(where["levelThree"], where["levelTwo"], where["levelOne"]))),
            organiser,
            line("Categories: ", F.array_join(F.transform(e["categories"], lambda c: c["name"]), ", ")),
            block("Tickets:", e["tickets"], ticket, 1),
            block("Performances:", e["schedules"], show, 2),
            F.when(e["description"] != "", F.concat(F.lit("\nDescription:\n"), F.regexp_replace(details, r"\s+$", ""))),
        ),
        F.lit("\n"),
    )


class _Attribute(HTMLParser):
    def __init__(self, name: str):
        super().__init__()
        self.name, self.found = name, None

    def handle_starttag(self, tag, attrs):
        if self.found is None:
            self.found = dict(attrs).get(self.name)


def attribute(page: Column, name: str) -> Column:
    """The first value of an attribute anywhere in a page."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        def one(p):
            parser = _Attribute(name)
            parser.feed(p or "")
            return parser.found

        return pages.map(one)

    return run(page)


def calendar_entries(pages: DataFrame, now: Column, name: str = "data-events") -> DataFrame:
    """url, key and entry of calendars that pages (url, html) embed as JSON in an attribute; entries over for a day are left out."""
    rows = pages.select("url", F.explode(F.from_json(attribute(F.col("html"), name), CALENDAR)).alias("entry"))
    when = lambda c: time.instant(time.normalised(F.substr(c, F.lit(1), F.lit(19))))
    latest = F.greatest(when(F.col("entry.start")), when(F.col("entry.end")))
    key = F.concat_ws("-", F.regexp_replace("entry.start", "[^0-9]", ""), F.substr(slug(F.col("entry.title")), F.lit(1), F.lit(60)))
    return rows.where(not_over(latest, now)).select("url", key.alias("key"), "entry")


#: Categories that are about music.
MUSIC = "(?i)opera|orchestral|classic|choral|a-cappella|concert|music"


def relevant(title: Column, categories: Column, text: Column) -> Column:
    """Uncategorised, in a music category, or with a keyword."""
    return (F.size(categories) == 0) | F.exists(categories, lambda c: c.rlike(MUSIC)) | has_keyword(F.concat_ws(" ", title, text))


def decoded(text: Column) -> Column:
    """Escaped HTML as one line of plain text."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        spaced = s.str.replace(r"(?i)<br\s*/?>", " ", regex=True).str.replace(r"<[^>]*>", "", regex=True)
        return spaced.map(lambda x: x if x is None else " ".join(html.unescape(x).split()))

    return run(text)


def next_page(body: str) -> str | None:
    return json.loads(body).get("next_rest_url")
