"""The sources of a run, and how pages are got from them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.functions import markup, url
from tessel.functions.text import has_keyword


@dataclass(frozen=True)
class Source:
    slug: str
    name: str
    role: str = "aggregator"
    homepage: str = ""
    default_presenter: str | None = None
    hint: str = ""
    start_urls: tuple[str, ...] = ()
    include: str | None = None
    exclude: str | None = None
    remove: tuple[str, ...] = ()
    content: str | None = None
    most_documents: int = 60
    allow_empty: bool = False
    enabled: bool = True
    split: Callable[[str, str], Iterable[dict]] | None = field(default=None, compare=False)

    def __post_init__(self):
        if not re.fullmatch("[a-z0-9]+(-[a-z0-9]+)*", self.slug):
            raise ValueError(f"{self.slug!r} is not a slug")


def enabled(sources: Iterable[Source], only: set[str] | None = None) -> list[Source]:
    found = [s for s in sources if s.enabled and (only is None or s.slug in only)]
    if len({s.slug for s in found}) < len(found):
        raise ValueError("two sources have one slug")
    return found


def table(spark: SparkSession, sources: Iterable[Source]) -> DataFrame:
    rows = [(s.slug, s.name, s.role, s.homepage, s.default_presenter, s.allow_empty) for s in sources]
    return spark.createDataFrame(rows, "source string, name string, role string, homepage string, default_presenter string, allow_empty boolean")


def followed(listings: DataFrame, source: Source, keyword: bool = False) -> DataFrame:
    """url and ord of the pages that listings (url, html) link to, each once, in order, up to the source's limit.

    Links stay on the listing's site, reach public hosts only, and pass the source's patterns.
    """
    links = listings.select(F.col("url").alias("page"), F.posexplode(markup.as_links(F.col("html"), F.col("url"))).alias("n", "link"))
    target = url.canonical(F.col("link.url"))
    rows = links.select("page", "n", target.alias("url"), F.col("link.text").alias("text"))
    name = url.host(F.col("url"))
    rows = rows.where(url.is_public(name) & url.same_site(name, url.host(F.col("page"))))
    if source.include:
        rows = rows.where(F.col("url").rlike(source.include))
    if source.exclude:
        rows = rows.where(~F.col("url").rlike(source.exclude))
    if keyword:
        rows = rows.where(has_keyword(F.col("text")))
    once = rows.groupBy("url").agg(F.min(F.struct("page", "n")).alias("ord"))
    return once.join(listings.select("url"), "url", "left_anti").orderBy("ord").limit(source.most_documents)


def documents(pages: DataFrame, source: Source) -> DataFrame:
    """url, source and text of pages (url, html)."""
    text = markup.as_text(F.col("html"), F.col("url"), source.content, source.remove)
    return pages.select(url.canonical(F.col("url")).alias("url"), F.lit(source.slug).alias("source"), text.alias("text"))
