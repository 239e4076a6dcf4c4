"""Line dedup by a suffix array over line ids, in DataFrame operations alone.

A document is the sequence of its lines that have words; a line's id is a 128-bit hash.
Lines that occur once end any repeated run, so only stretches of repeated lines are
ranked. Prefix doubling ranks the suffixes of these stretches by their first 1, 2, 4, ...
lines: the pairs (rank here, rank 2^k further on) that occur more than once are sorted by
range over the cluster and numbered in that order. A prefix of n lines is then known by
two overlapping ranks of the largest power of two.

A run counts as repeated from `min_words` words on; without a least length every single
repeated line is a run, and the result that of dropping each line seen before (as with
min_words=1). Suffixes that share so many words
form one interval of the suffix array (a longest common prefix of that many words); all
its members but the first, by doc_id, are later copies. Intervals are taken from each
line forwards and from each line backwards to the least number of lines with so many
words; their union is exactly every line of every maximal repeated run. As each line has
a word, MIN_WORDS lines are the most that need ranks, and six rounds do at any size.

A rank's hot pair is counted before the shuffle, and joins on it may be split; rows are
otherwise dealt by document.

Defined cases: a null text is empty; wordless lines are neither counted nor removed; a
run that overlaps its own repetition collapses to what precedes the first copy; null
doc_ids come after all others; repeated rows are documents of their own; an empty table
gives an empty result; other columns are ignored (and kept by `deduplicated`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel.llm.common import PLACE, Shared, placed, read, text_of

MIN_WORDS = 50

_SPACE = r"[\x20\x09-\x0D]+"


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, place, line (number), h1, h2, words of each line with words."""
    rows = docs.select("doc_id", *PLACE, F.posexplode(F.split(text_of(), "\n")).alias("line", "text"))
    rows = rows.withColumn("words", F.size(F.array_remove(F.split("text", _SPACE), "")))
    return rows.where("words > 0").select("doc_id", *PLACE, "line", "words", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2"))


def _ranked(keys: DataFrame, a: str, b: str, rank: str, shared: Shared) -> DataFrame:
    """Pairs that occur more than once, numbered in their order over the whole cluster."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    twice = shared.table(keys.groupBy(a, b).agg(F.count("*").alias("n")).where("n > 1").select(a, b))
    return shared.table(twice.repartitionByRange(n, a, b).sortWithinPartitions(a, b).withColumn(rank, F.monotonically_increasing_id()))


def _stretches(rows: DataFrame, min_words: int) -> DataFrame:
    """Repeated lines by stretch, with ahead and back: lines from here, and up to here, that have min_words words."""
    by_doc = Window.partitionBy(*PLACE).orderBy("at")
    rows = rows.withColumn("stretch", F.col("at") - F.row_number().over(by_doc))
    part = Window.partitionBy(*PLACE, "stretch")
    rows = rows.withColumn("end", F.sum("words").over(part.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("words").over(part))
    rows = rows.withColumn("start", F.col("end") - F.col("words"))
    ahead = F.count("*").over(part.orderBy("start").rangeBetween(0, min_words - 1))
    back = F.count("*").over(part.orderBy("end").rangeBetween(1 - min_words, 0))
    return rows.withColumn("ahead", F.when(F.col("total") - F.col("start") >= min_words, ahead)).withColumn("back", F.when(F.col("end") >= min_words, back)).drop("total", "start", "end", "words")


def removed_lines(docs: DataFrame, shared: Shared, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """All lines (doc_id, place, line), and those of later copies (place, line)."""
    every = shared.table(lines(docs))
    order = Window.partitionBy(*PLACE).orderBy("line")
    ids = _ranked(every, "h1", "h2", "r0", shared)
    numbered = every.withColumn("at", F.row_number().over(order).cast("long"))
    rows = shared.table(_stretches(numbered.join(ids, ["h1", "h2"]).drop("h1", "h2"), min_words))
    # stretches with too few words hold no run
    rows = rows.withColumn("most", F.max(F.coalesce("ahead", F.lit(0))).over(Window.partitionBy(*PLACE, "stretch"))).where("most > 0").drop("most")
    rows = shared.table(rows)
    longest = rows.agg(F.max(F.greatest("ahead", "back"))).first()[0] or 0
    # prefix doubling
    top = max(0, longest.bit_length() - 1)
    for k in range(top):
        ahead = F.lead(f"r{k}", 1 << k).over(Window.partitionBy(*PLACE, "stretch").orderBy("at"))
        pairs = shared.table(rows.withColumn("next", ahead))
        known = _ranked(pairs.where(f"r{k} is not null and next is not null"), f"r{k}", "next", f"r{k + 1}", shared)
        nxt = shared.table(pairs.join(known, [f"r{k}", "next"], "left").drop("next"))
        shared.drop(pairs, rows)
        rows = nxt
    ranks = rows.select("doc_id", *PLACE, "at", F.array(*(f"r{k}" for k in range(top + 1))).alias("ranks"))
    runs = rows.where("ahead is not null").select(*PLACE, "at", F.col("ahead").alias("size")).unionByName(
        rows.where("back is not null").select(*PLACE, (F.col("at") - F.col("back") + 1).alias("at"), F.col("back").alias("size"))
    )
    runs = runs.distinct().withColumn("k", F.floor(F.log2("size")).cast("int")).withColumn("far", F.col("at") + F.col("size") - F.expr("1L << k"))
    head = runs.join(ranks, [*PLACE, "at"]).select("doc_id", *PLACE, "at", "size", "far", "k", F.get("ranks", F.col("k")).alias("a")).where("a is not null")
    tail = ranks.select(*PLACE, F.col("at").alias("far"), F.col("ranks").alias("then"))
    known = head.join(tail, [*PLACE, "far"]).withColumn("b", F.get("then", F.col("k"))).where("b is not null").select("doc_id", *PLACE, "at", "size", "a", "b")
    known = shared.table(known)
    where = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), *PLACE, F.col("at"))
    first = known.groupBy("size", "a", "b").agg(F.min(where).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # written first: a join on its own exchange may be split where one run has many copies
    first = shared.table(first)
    later = known.join(first, ["size", "a", "b"]).where(where != F.col("first"))
    gone = later.select(*PLACE, F.explode(F.sequence("at", F.col("at") + F.col("size") - 1)).alias("at")).distinct()
    return every.select("doc_id", *PLACE, "line"), gone.join(rows.select(*PLACE, "at", "line"), [*PLACE, "at"]).select(*PLACE, "line")


def removals(docs: DataFrame, shared: Shared, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, place, n_lines and removed (numbers of removed lines, in order) of each row of docs."""
    every, gone = removed_lines(docs, shared, min_words)
    count = every.groupBy(*PLACE).agg(F.count("*").alias("n_lines"))
    out = gone.groupBy(*PLACE).agg(F.sort_array(F.collect_list("line")).alias("removed"))
    rows = docs.select("doc_id", *PLACE).join(count, PLACE, "left").join(out, PLACE, "left")
    return rows.select("doc_id", *PLACE, F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def deduplicated(docs: DataFrame, shared: Shared, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the later copies of repeated runs cut from their texts."""
    docs = placed(docs, shared)
    out = removals(docs, shared, min_words).where(F.size("removed") > 0).select(*PLACE, F.col("removed").alias("__removed"))
    left = F.expr("array_join(transform(filter(transform(split(text, '\\n'), (t, i) -> struct(i as i, t as t)), x -> not array_contains(__removed, x.i)), x -> x.t), '\\n')")
    return docs.join(out, PLACE, "left").withColumn("text", F.when(F.col("__removed").isNull(), F.col("text")).otherwise(left)).drop("__removed", *PLACE)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed and removed (line numbers from 0, comma-joined) of every document."""
    shared = Shared(spark, "lines")
    found = removals(placed(read(spark, sf_dir, "documents"), shared), shared)
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


#: Runs are found by their whole text: from and to each line, the least lines with 50 words, if all occur twice.
SQL = r"""
with line as (
  select doc_id, i - 1 as line, l[i] as t, len(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+')) as words
  from (select doc_id, l, unnest(range(1, len(l) + 1)) as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents))),
worded as (select *, row_number() over (partition by doc_id order by line) as pos, count(*) over (partition by t) as n from line where words > 0),
repeated as (select *, pos - row_number() over (partition by doc_id order by line) as stretch from worded where n > 1),
summed as (
  select *, sum(words) over (partition by doc_id, stretch order by pos) as e, sum(words) over (partition by doc_id, stretch order by pos) - words as s from repeated),
run as (
  select a.doc_id, a.pos as lo, min(b.pos) as hi from summed a join summed b using (doc_id, stretch) where b.pos >= a.pos and b.e - a.s >= 50 group by all
  union
  select b.doc_id, max(a.pos) as lo, b.pos as hi from summed a join summed b using (doc_id, stretch) where b.pos >= a.pos and b.e - a.s >= 50 group by b.doc_id, b.pos),
body as (select r.doc_id, lo, hi, string_agg(t, chr(10) order by pos) as body from run r join summed s on s.doc_id = r.doc_id and pos between lo and hi group by all),
later as (select doc_id, lo, hi from (select *, row_number() over (partition by body order by doc_id, lo) as k from body) where k > 1),
gone as (select distinct s.doc_id, line from later l join summed s on s.doc_id = l.doc_id and pos between lo and hi),
listed as (select doc_id, count(*) as n_removed, string_agg(cast(line as varchar), ',' order by line) as removed from gone group by doc_id),
counted as (select doc_id, count(*) as n_lines from worded group by doc_id)
select d.doc_id, cast(coalesce(counted.n_lines, 0) as bigint) as n_lines, cast(coalesce(listed.n_removed, 0) as bigint) as n_removed, coalesce(listed.removed, '') as removed
from documents d left join counted using (doc_id) left join listed using (doc_id)
"""
