"""Benchmark decontamination by winnowing, in DataFrame operations alone.

Both sides hash each k-gram of words and keep the minimum hash of every sliding window
of grams. A window of `span` words has span - k + 1 grams, so any shared span of that
many words shares a kept gram. Kept grams meet in an equi-join; a hit is extended to the
whole window and its words are compared, so hash collisions never count.

Items have few words against the corpus, so most document grams meet none: their
presence is tested first, where the text is, against a bitmap that is sized by the
benchmark's grams (1 MB at most: beyond a million grams more pass, and nothing else
changes). Only grams that pass carry their surrounding words into the join.

Items shorter than `span` words are one window each and a class of their own: they are
found by their first k-gram, whatever its window's minimum (those shorter than k words
by the gram of their own length), so they don't keep the winnowing of the others from
thinning out grams.

Of a document only its place and its hits are written; texts stay where they are.

Defined cases: a null or empty text has no words; repeated rows stay rows; items that
share an item_id count once; an item whose id is null marks words but is not listed; an
empty table gives an empty result (an empty benchmark: no hits); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel.llm.common import PLACE, Presence, Shared, placed, read, text_of, unmoved

SPAN = 10
GRAM = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits and of all that is not ASCII."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _grams(words: str, k: int) -> Column:
    """Hashes of all k-grams of an array column; none if it has fewer words. Words are read in place: slices would copy."""
    gram = ", ".join(f"{words}[i + {j}]" for j in range(k))
    return F.expr(f"if(size({words}) >= {k}, transform(sequence(0, size({words}) - {k}), i -> xxhash64({gram})), cast(array() as array<bigint>))")


def windows(items: DataFrame, k: int, span: int = SPAN, short: bool = False) -> DataFrame:
    """Windows of the items: item_id, size, window (its words, joined), hash (of its minimum k-gram), gap (words before that).

    Of items of `span` words and more, every window of as many. short: of items of fewer
    words (of exactly k words, where k is under GRAM) the whole item, with its first gram.
    """
    rows = items.select("item_id", words_of(text_of()).alias("words")).withColumn("n", F.size("words"))
    if short:
        rows = rows.where((F.col("n") == k) if k < GRAM else (F.col("n") >= k) & (F.col("n") < span))
        return rows.select("item_id", F.col("n").alias("size"), F.array_join("words", " ").alias("window"), F.get(_grams("words", k), F.lit(0)).alias("hash"), F.lit(0).alias("gap"))
    rows = rows.where(F.col("n") >= span).select("item_id", "words", F.explode(F.sequence(F.lit(1), F.col("n") - span + 1)).alias("at"))
    rows = rows.select("item_id", F.slice("words", F.col("at"), F.lit(span)).alias("words")).withColumn("grams", _grams("words", k)).withColumn("hash", F.array_min("grams"))
    return rows.select("item_id", F.lit(span).alias("size"), F.array_join("words", " ").alias("window"), "hash", (F.array_position("grams", F.col("hash")) - 1).cast("int").alias("gap"))


def _hits(docs: DataFrame, long: DataFrame | None, short: DataFrame, shared: Shared, k: int, span: int) -> DataFrame:
    """docs (words, ...) with hits_k: array of (at, hash, base, near) of grams by which some window may be found."""
    g, size, w = F.col("g"), F.size("g"), span - k + 1  # grams in a window

    def least(i: Column) -> Column:
        starts = F.sequence(F.greatest(F.lit(0), i - (w - 1)), F.least(i, size - w))
        return (size >= w) & F.exists(starts, lambda s: F.forall(F.sequence(s, s + (w - 1)), lambda j: F.get(g, j) >= F.get(g, i)))

    there = [Presence(found.select("hash"), shared) if found is not None else None for found in (long, short)]

    def may(i: Column) -> Column:
        tests = [there[0].test(F.get(g, i), F.col("bits_0")) & least(i)] if there[0] and there[0].n else []
        tests += [there[1].test(F.get(g, i), F.col("bits_1"))] if there[1].n else []
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]

    if not any(t and t.n for t in there):
        return docs.withColumn(f"hits_{k}", F.array().cast("array<struct<at:int,hash:bigint,base:int,near:array<string>>>"))
    places = F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), may)).otherwise(F.array().cast("array<int>"))
    rows = docs.withColumn("g", _grams("words", k)).withColumns({f"bits_{n}": t.bits.scalar() for n, t in enumerate(there) if t and t.n}).withColumn("places", places)
    base = f"greatest(0, i - {span - k})"
    near = f"transform(sequence({base}, least(size(words) - 1, i + {span - 1})), j -> words[j])"
    return rows.withColumn(f"hits_{k}", F.expr(f"transform(places, i -> struct(i as at, g[i] as hash, {base} as base, {near} as near))")).drop("g", "places", "bits_0", "bits_1")


def matches(docs: DataFrame, items: DataFrame, shared: Shared, keep: list[str], span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (the columns `keep`, place, n_words) of docs (text, place); spans (place, start, size, window); owners (window, item_id).

    Spans are the verified windows of the items in the rows.
    """
    items = items.select("item_id", "text")
    tiny = [r[0] for r in items.select(F.size(words_of(text_of())).alias("n")).where(f"n > 0 and n < {gram}").distinct().collect()]
    now = docs.select(*keep, *PLACE, words_of(text_of()).alias("words"))
    found = []
    for k in [gram, *sorted(tiny)]:
        long = shared.table(windows(items, k, span)) if k == gram else None
        short = shared.table(windows(items, k, span, short=True))
        found += [x for x in (long, short) if x is not None]
        now = _hits(now, long, short, shared, k, span)
    kinds = [c for c in now.columns if c.startswith("hits_")]
    rows = shared.table(now.select(*keep, *PLACE, F.size("words").cast("long").alias("n_words"), F.flatten(F.array(*kinds)).alias("hits")))
    near = rows.where(F.size("hits") > 0).select(*PLACE, F.explode("hits").alias("h")).select(*PLACE, "h.*")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    every = shared.table(every)
    start = F.col("at") - F.col("gap")
    there = F.array_join(F.slice("near", F.greatest(F.lit(0), start - F.col("base")) + 1, F.col("size")), " ")
    spans = near.join(every.select("size", "window", "hash", "gap").distinct(), "hash").where((start >= F.col("base")) & (there == F.col("window")))
    spans = shared.table(spans.select(*PLACE, start.alias("start"), "size", "window").distinct())
    return rows.drop("hits"), spans, every.where("item_id is not null").select("window", "item_id").distinct()


def contamination(docs: DataFrame, items: DataFrame, shared: Shared, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, place, n_words, n_hit, n_items, items (sorted as strings, comma-joined) of each row of docs."""
    rows, spans, owners = matches(docs, items, shared, ["doc_id"], span, gram)
    # words inside any span: each adds what lies beyond the farthest end so far
    before = Window.partitionBy(*PLACE).orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    parts = spans.withColumn("far", F.coalesce(F.max(end).over(before), F.lit(0)))
    hit = parts.groupBy(*PLACE).agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "far"))).alias("n_hit"))
    named = spans.select(*PLACE, "window").distinct().join(owners, "window").select(*PLACE, F.col("item_id").cast("string").alias("item")).distinct()
    listed = named.groupBy(*PLACE).agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    out = rows.join(hit.join(listed, PLACE, "left"), PLACE, "left")
    return out.select("doc_id", *PLACE, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.lit("")).alias("items"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    shared = Shared(spark, "decontaminate")
    found = contamination(placed(read(spark, sf_dir, "documents"), shared), read(spark, sf_dir, "benchmark"), shared)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item stay.

    Rows whose place isn't in the bitmap of places with a window are clean and don't
    move; only the others meet the list of places in a join.
    """
    shared = Shared(spark, "decontaminate")
    docs = placed(docs, shared)
    _, spans, _ = matches(docs, read(spark, sf_dir, "benchmark"), shared, [])
    return unmoved(docs, shared.table(spans.select(*PLACE).distinct()), shared, "left_anti").drop(*PLACE)


#: Whole windows found as substrings of the space-joined words, word by word.
SQL = r"""
with doc as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents),
item as (
  select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from benchmark),
win as (
  select distinct item_id, size, array_to_string(array_slice(w, pos, pos + size - 1), ' ') as piece
  from (select item_id, w, least(len(w), 10) as size, unnest(range(1, len(w) - least(len(w), 10) + 2)) as pos from item where len(w) > 0)),
sizes as (select distinct size from win),
gram as (
  select doc_id, pos, size, array_to_string(array_slice(w, pos, pos + size - 1), ' ') as piece
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as pos from doc, sizes where len(w) >= size)),
hit as (select g.doc_id, g.pos, g.size, item_id from gram g join win using (size, piece)),
covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + size)) as p from hit) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by doc_id)
select doc.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join covered using (doc_id) left join named using (doc_id)
"""
