"""Names resolved against reference tables: venues by alias, composers by name or surname.

Reference tables are dimensions; each join leaves their size to the planner, which
broadcasts them below its threshold and shuffles them otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel.functions.text import normalise

#: Shortest alias that counts inside a longer text.
ALIAS_LENGTH = 5
#: Particles that begin a surname, but not a name.
PARTICLES = ["van", "von", "de", "du", "le", "la"]


def cities_agree(a: Column, b: Column) -> Column:
    """Unknown, equal, or one within the other."""
    x, y = normalise(F.coalesce(a, F.lit(""))), normalise(F.coalesce(b, F.lit("")))
    unknown = F.coalesce(a, F.lit("")).eqNullSafe("") | F.coalesce(b, F.lit("")).eqNullSafe("")
    return unknown | (x == y) | x.contains(y) | y.contains(x)


def in_order(table: DataFrame) -> DataFrame:
    """A lookup table with _n, its order: by the column `ord` if it has one, else by its rows' content, the same in every run."""
    return table.withColumn("_n", F.struct("ord" if "ord" in table.columns else F.lit(0).alias("ord"), F.to_json(F.struct(*table.columns)).alias("content")))


def aliases(venues: DataFrame) -> DataFrame:
    """alias_key, ord (table order), and the venue, one row per name it goes by."""
    names = in_order(venues).select("_n", F.struct(*venues.columns).alias("match"), F.posexplode(F.concat(F.array("name"), "aliases")).alias("_p", "_name"))
    return names.select(normalise(F.col("_name")).alias("alias_key"), F.struct("_n", "_p").alias("ord"), "match").where("alias_key <> ''")


def resolve_venues(rows: DataFrame, venues: DataFrame, key: str, venue: str = "venue") -> DataFrame:
    """rows with match (the table's venue, or null) and flag (to be reviewed), for the struct column `venue`.

    An exact alias goes first, then the longest alias inside name and address; both only if
    the cities agree. A claimed id is a fallback, if its city agrees with a stated one, and
    is flagged unless the text backs it. `key` names a row.
    """
    v = F.col(venue)
    known = aliases(venues)
    stated = rows.select(key, normalise(v["name"]).alias("_exact"), v["city"].alias("_city"), F.concat(F.lit(" "), normalise(F.concat_ws(" ", v["name"], v["address"])), F.lit(" ")).alias("_hay"))
    # of equal aliases the last in the table counts
    last = known.groupBy("alias_key").agg(F.max_by("match", "ord").alias("match"))
    exact = stated.join(last, stated._exact == last.alias_key).where(cities_agree(F.col("match.city"), F.col("_city"))).select(key, F.col("match").alias("_by_name"))
    # whole-word containment through the words that aliases begin with, not by trying all of them
    head = known.where(F.length("alias_key") >= ALIAS_LENGTH).withColumn("_w", F.split_part("alias_key", F.lit(" "), F.lit(1)))
    inside = stated.withColumn("_w", F.explode(F.array_distinct(F.split(F.trim("_hay"), " ")))).join(head, "_w")
    inside = inside.where(F.contains("_hay", F.concat(F.lit(" "), F.col("alias_key"), F.lit(" "))) & cities_agree(F.col("match.city"), F.col("_city")))
    inside = inside.groupBy(key).agg(F.min_by("match", F.struct(-F.length("alias_key"), "ord")).alias("_inside"))
    ids = in_order(venues).groupBy("venue_id").agg(F.max_by(F.struct(*venues.columns), "_n").alias("_claimed")).withColumnRenamed("venue_id", "_id")
    out = rows.join(exact, key, "left").join(inside, key, "left").join(ids, v["venue_id"] == F.col("_id"), "left")
    text = F.coalesce("_by_name", "_inside")
    claims = F.coalesce(v["venue_id"], F.lit("")) != ""
    backed = F.col("_claimed").isNotNull() & (F.coalesce(v["city"], F.lit("")) != "") & cities_agree(F.col("_claimed.city"), v["city"])
    match = F.when(text.isNotNull(), text).when(backed, F.col("_claimed"))
    flag = claims & ~F.coalesce(text["venue_id"] == v["venue_id"], F.lit(False))
    return out.withColumn("match", match).withColumn("flag", flag).drop("_by_name", "_inside", "_id", "_claimed")


def surname(name: Column) -> Column:
    """From the first particle after a first name on, else the last word, of a normalised name."""
    parts = F.split(name, " ")
    at = F.array_min(F.filter(F.transform(parts, lambda p, i: F.when((i > 0) & p.isin(PARTICLES), i)), lambda i: i.isNotNull()))
    return F.when(at.isNotNull(), F.array_join(F.slice(parts, at + 1, F.size(parts)), " ")).otherwise(F.element_at(parts, -1))


def composer_keys(composers: DataFrame) -> DataFrame:
    """composer_key, name, certain: full names, and surnames that only one composer has."""
    rows = in_order(composers).select("_n", "name", normalise(F.col("name")).alias("full"))
    full = rows.groupBy(F.col("full").alias("composer_key")).agg(F.max_by("name", "_n").alias("name")).withColumn("certain", F.lit(True))
    only = rows.groupBy(surname(F.col("full")).alias("composer_key")).agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n = 1")
    only = only.join(full, "composer_key", "left_anti").select("composer_key", "name", F.lit(False).alias("certain"))
    return full.unionByName(only)


def match_composers(rows: DataFrame, composers: DataFrame, key: str, programme: str = "programme") -> DataFrame:
    """rows with sa_composers (sorted) and unsure (review paths of matches by surname alone)."""
    each = rows.select(key, F.posexplode(programme).alias("_i", "_w")).select(key, "_i", normalise(F.col("_w.composer")).alias("composer_key"))
    found = each.join(composer_keys(composers), "composer_key").groupBy(key).agg(
        F.sort_array(F.collect_set("name")).alias("sa_composers"),
        F.collect_set(F.when(~F.col("certain"), F.concat(F.lit("programme."), F.col("_i"), F.lit(".composer")))).alias("unsure"),
    )
    none = F.array().cast("array<string>")
    return rows.join(found, key, "left").withColumn("sa_composers", F.coalesce("sa_composers", none)).withColumn("unsure", F.coalesce("unsure", none))


def latest_by_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with equal keys, the last in order."""
    last = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")
