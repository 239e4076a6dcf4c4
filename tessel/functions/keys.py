"""Identity: keys, ids and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessel.functions.text import first_words, slug


def short_hash(text: Column) -> Column:
    """The first 16 hexadecimal digits of SHA-256."""
    return F.substr(F.sha2(text, 256), F.lit(1), F.lit(16))


def dedupe_key(start: Column, venue_id: Column, venue_name: Column, title: Column) -> Column:
    """Local date, venue and the title's first six words."""
    venue = F.coalesce(F.when(venue_id != "", venue_id), slug(venue_name))
    return F.concat_ws("|", F.substr(start, F.lit(1), F.lit(10)), venue, first_words(title))


def fingerprint(record: Column) -> Column:
    """Of a struct's content; fields in key order, nulls absent."""
    return short_hash(F.to_json(F.parse_json(F.to_json(record))))
