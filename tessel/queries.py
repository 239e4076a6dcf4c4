"""Queries over the driver's tables, one for each operator, and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel.functions import keys, review, text, time, url
from tessel.operators import incremental, lookup
from tessel.operators.normalise import first_shared_span

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The SQL counterpart of functions.text.normalise, for the letters in the driver's texts.
NORM = r"trim(regexp_replace(regexp_replace(lower(strip_accents({})), '[’''`]', '', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
#: A fixed clock, so that results don't depend on when a query runs.
NOW = "1998-01-01 00:00:00"


def norm(column: str) -> str:
    return NORM.format(column)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def c(name: str) -> Column:
    return F.col(name)


# Copied spans


def _spans(df: DataFrame, key: str, n: int = 12) -> DataFrame:
    """key, pos and hash of every n-word span."""
    words = df.select(key, text.words(c("text")).alias("w"))
    gram = ", ".join(f"w[i + {j}]" for j in range(n))
    spans = F.expr(f"if(size(w) >= {n}, transform(sequence(0, size(w) - {n}), i -> xxhash64({gram})), cast(array() as array<bigint>))")
    return words.select(key, F.posexplode(spans).alias("pos", "h"))


_SPAN_SQL = f"""
doc as (select doc_id, string_split({norm("text")}, ' ') as w from documents),
ds as (select doc_id, i as pos, array_to_string(array_slice(w, i, i + 11), ' ') as span from (select doc_id, w, unnest(range(1, len(w) - 10)) as i from doc)),
item as (select string_split({norm("text")}, ' ') as w from benchmark),
bs as (select distinct array_to_string(array_slice(w, i, i + 11), ' ') as span from (select w, unnest(range(1, len(w) - 10)) as i from item))
"""


@query(f"with {_SPAN_SQL} select distinct doc_id from ds semi join bs using (span)")
def copied_span_docs(spark, sf_dir):
    """Documents that share a 12-word span with a benchmark item."""
    items = _spans(t(spark, sf_dir, "benchmark").select("item_id", "text"), "item_id").select("h").distinct()
    return _spans(t(spark, sf_dir, "documents"), "doc_id").join(items, "h", "left_semi").select("doc_id").distinct()


@query(f"with {_SPAN_SQL} select doc_id, cast(min(pos) - 1 as integer) as pos, arg_min(span, pos) as span from ds semi join bs using (span) group by doc_id")
def first_shared_spans(spark, sf_dir):
    """The first shared span of each such document."""
    items = _spans(t(spark, sf_dir, "benchmark").select("item_id", "text"), "item_id").select("h").distinct()
    docs = t(spark, sf_dir, "documents")
    first = _spans(docs, "doc_id").join(items, "h", "left_semi").groupBy("doc_id").agg(F.min("pos").alias("pos"))
    return docs.join(first, "doc_id").select("doc_id", "pos", F.array_join(F.slice(text.words(c("text")), c("pos") + 1, 12), " ").alias("span"))


@query(f"select doc_id, cast(greatest(0, len(list_filter(string_split({norm('text')}, ' '), lambda x: x <> '')) - 11) as integer) as n_spans from documents")
def shingle_counts(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").select("doc_id", F.size(text.words(c("text"))).alias("n"))
    return docs.select("doc_id", F.greatest(F.lit(0), c("n") - 11).cast("int").alias("n_spans"))


@query(
    f"""with lab as (select d.doc_id, d.text, l.quality from documents d join labels l using (doc_id)),
    w as (select doc_id, quality, string_split({norm("text")}, ' ') as w from lab)
    select doc_id, array_to_string(array_slice(w, 1, 12), ' ') as span from w where len(w) >= 12 and quality = 1"""
)
def guard_first_span(spark, sf_dir):
    """A record checked against its own document: the first span is copied."""
    rows = t(spark, sf_dir, "documents").join(t(spark, sf_dir, "labels").where("quality = 1"), "doc_id")
    words = text.words(c("text"))
    return rows.where(F.size(words) >= 12).select("doc_id", first_shared_span(F.array_join(F.slice(words, 1, 14), " "), c("text")).alias("span"))


# Keys and names


@query(
    f"""with k as (select array_to_string(array_slice(list_filter(string_split({norm("text")}, ' '), lambda x: x <> ''), 1, 6), ' ') as key from documents)
    select key, count(*) as n from k group by key having count(*) > 1"""
)
def norm_text_key(spark, sf_dir):
    """Groups of documents with the same first six words."""
    rows = t(spark, sf_dir, "documents").select(text.first_words(c("text")).alias("key"))
    return rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")


@query(f"select p_partkey, replace({norm('p_name')}, ' ', '-') as slug from part union all select c_custkey, replace({norm('c_name')}, ' ', '-') from customer")
def slug_names(spark, sf_dir):
    part = t(spark, sf_dir, "part").select("p_partkey", text.slug(c("p_name")).alias("slug"))
    return part.union(t(spark, sf_dir, "customer").select("c_custkey", text.slug(c("c_name"))))


@query("select page_id, left(sha256(url), 16) as doc_id, sha256(html) as content_hash from pages")
def event_ids(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", keys.short_hash(c("url")).alias("doc_id"), F.sha2("html", 256).alias("content_hash"))


@query(
    f"""select event_id, k as dedupe_key, left(sha256(k), 16) as id from (
    select event_id, strftime(ts, '%Y-%m-%d') || '|' || replace({norm("'User ' || user_id")}, ' ', '-') || '|' || {norm("event_type")} as k from events)"""
)
def dedupe_keys(spark, sf_dir):
    rows = t(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.concat(F.lit("User "), "user_id").alias("place"), "event_type")
    return rows.select("event_id", keys.dedupe_key(c("day"), F.lit(None).cast("string"), c("place"), c("event_type")).alias("dedupe_key")).withColumn("id", keys.short_hash(c("dedupe_key")))


@query(f"select name, {norm('name')} as plain from (select distinct text as name from documents)")
def normalised_text(spark, sf_dir):
    rows = t(spark, sf_dir, "documents").select(c("text").alias("name")).distinct()
    return rows.select("name", text.normalise(c("name")).alias("plain"))


_TOKENS = f"list_filter(string_split({norm('n')}, ' '), lambda x: x <> '' and x not in ({', '.join(repr(w) for w in text.TITLE_STOPWORDS)}))"


@query(
    f"""with p as (select distinct p_name as n from part), q as (select n, {_TOKENS} as tk, array_to_string({_TOKENS}, '') as sq from p),
    g as (select n, g, count(*) as k from (select n, substr(sq, i, 2) as g from (select n, sq, unnest(range(1, length(sq))) as i from q)) group by all),
    tot as (select n, sum(k) as k from g group by n),
    inter as (select a.n as a, b.n as b, sum(least(a.k, b.k)) as k from g a join g b using (g) where a.n < b.n group by all),
    pair as (select a.n as a, b.n as b, case when len(a.tk) <= len(b.tk) then a.tk else b.tk end as small, case when len(a.tk) <= len(b.tk) then b.tk else a.tk end as other, a.sq = b.sq as same
      from q a join q b on a.n < b.n)
    select p.a, p.b, round(greatest(case when same then 1.0 else 2.0 * coalesce(i.k, 0) / (ta.k + tb.k) end,
      len(list_filter(small, lambda x: list_contains(other, x))) / len(small) * case when len(small) >= 2 then 0.95 else 0.7 end), 6) as score
    from pair p left join inter i using (a, b) join tot ta on ta.n = p.a join tot tb on tb.n = p.b"""
)
def title_similarity_pairs(spark, sf_dir):
    """All pairs of the few distinct part names."""
    names = t(spark, sf_dir, "part").select("p_name").distinct()
    rows = names.select(c("p_name").alias("a")).join(names.select(c("p_name").alias("b")), c("a") < c("b"))
    return rows.select("a", "b", F.round(text.title_similarity(c("a"), c("b")), 6).alias("score"))


_LETTER_SQL = "(^|[^\\p{L}])"


@query(
    f"""select doc_id, regexp_matches(text, '(?i){_LETTER_SQL}({"|".join(text.KEYWORD_STEMS)})') or regexp_matches(text, '(?i){_LETTER_SQL}({"|".join([*text.KEYWORDS, "keit", "der", "que", "the"])})($|[^\\p{{L}}])') as relevant
    from documents"""
)
def keyword_prefilter(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.has_keyword(c("text"), whole=[*text.KEYWORDS, "keit", "der", "que", "the"]).alias("relevant"))


# URLs


@query(
    r"""with u as (select page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$', ['s', 'h', 'p', 'q', 'f']) as r from pages),
    k as (select page_id, url, r, array_to_string(list_filter(string_split(ltrim(r.q, '?'), '&'), lambda x: not regexp_matches(lower(string_split(x, '=')[1]), '^(utm_|fbclid|gclid|gad_|ref$|preview$|affiliateid$)')), '&') as q from u)
    select page_id, lower(r.s) || '://' || lower(r.h) || case when r.p = '' then '/' else r.p end || case when q = '' then '' else '?' || q end as url from k"""
)
def canonical_urls(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", url.canonical(c("url")).alias("url"))


@query(
    r"""with h as (select page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) as host from pages), n as (select regexp_replace(host, '^www\.', '') as site, count(*) as n, min(page_id) as first from h group by 1)
    select page_id, host, n as pages_of_site, page_id = first as is_first from h join n on regexp_replace(host, '^www\.', '') = site"""
)
def host_same_site(spark, sf_dir):
    rows = t(spark, sf_dir, "pages").select("page_id", url.host(c("url")).alias("host")).withColumn("site", F.regexp_replace("host", r"^www\.", ""))
    sites = rows.groupBy("site").agg(F.count("*").alias("pages_of_site"), F.min("page_id").alias("first"))
    both = rows.join(sites, "site").where(url.same_site(c("host"), c("site")))
    return both.select("page_id", "host", "pages_of_site", (c("page_id") == c("first")).alias("is_first"))


_HOSTS = ["localhost", "a.local", "10.0.0.1", "172.16.9.9", "172.32.0.1", "192.168.1.1", "192.169.1.1", "100.64.0.1", "169.254.1.1", "8.8.8.8", "224.0.0.1", "example.org", "[::1]", "intranet", "x.corp", "0.1.2.3", "127.1.1.1"]
_PUBLIC = {"172.32.0.1", "192.169.1.1", "8.8.8.8", "example.org", "intranet"}


@query("select * from (values " + ", ".join(f"('{h}', {h in _PUBLIC})" for h in _HOSTS) + ") v(host, is_public)")
def public_hosts(spark, sf_dir):
    return spark.createDataFrame([(h,) for h in _HOSTS], "host string").select("host", url.is_public(c("host")).alias("is_public"))


# Time


@query("select o_orderkey, strftime(o_orderdate + interval 2 hours, '%Y-%m-%dT%H:%M:%S+02:00') as start from orders")
def sast_render(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey", time.rendered(c("o_orderdate").cast("timestamp")).alias("start"))


_STAMPS = {
    "2026-10-15T19:30:00+02:00": "2026-10-15T19:30:00+02:00", "2026-10-15 19:30": "2026-10-15T19:30:00+02:00", "2026-10-15T17:30:00.123Z": "2026-10-15T19:30:00+02:00",
    "2026-10-15T19:30+0200": "2026-10-15T19:30:00+02:00", "2026-10-15": "2026-10-15T00:00:00+02:00", "next Friday": None, "2026-02-30T19:00": None, "2026-04-31": None,
    "2026-10-15T24:30": None, "2028-02-29T19:00": "2028-02-29T19:00:00+02:00", " 2026-10-15T23:59:59-01:00 ": "2026-10-16T02:59:59+02:00", "": None, "2026-13-01": None,
}


@query(
    "select ts_text, normal from (values "
    + ", ".join(f"('{k}', {'null' if v is None else repr(v)})" for k, v in _STAMPS.items())
    + ") v(ts_text, normal) union all select strftime(ts, '%Y-%m-%d %H:%M:%S'), strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00') from events"
)
def normalise_timestamps(spark, sf_dir):
    rows = spark.createDataFrame([(k,) for k in _STAMPS], "ts_text string").union(t(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return rows.select("ts_text", time.normalised(c("ts_text")).alias("normal"))


@query(f"select o_orderkey, case when o_orderdate <= timestamp '{NOW}' then 'past' when o_orderdate > timestamp '{NOW}' + interval 1 month then 'too far' else 'ok' end as outcome from orders")
def horizon_filter(spark, sf_dir):
    now = F.lit(NOW).cast("timestamp")
    far = c("o_orderdate") > time.plus_months(now, 1)
    return t(spark, sf_dir, "orders").select("o_orderkey", F.when(c("o_orderdate") <= now, "past").when(far, "too far").otherwise("ok").alias("outcome"))


@query(
    """select o_orderkey, date_trunc('month', o_orderdate) + interval 6 months + cast(day(o_orderdate) - 1 as integer) * interval 1 day as later from (select o_orderkey, cast(o_orderdate as date) as o_orderdate from orders)"""
)
def rolled_months(spark, sf_dir):
    """Six months later; a day that the month lacks rolls over."""
    return t(spark, sf_dir, "orders").select("o_orderkey", time.plus_months(F.date_trunc("day", "o_orderdate").cast("timestamp"), 6).cast("timestamp_ntz").alias("later"))


# Validation


@query(
    """select l_orderkey, l_linenumber, array_to_string(list_filter([case when l_discount > 0.09 then 'discount too high' end, case when l_quantity > 45 then 'quantity too large' end,
    case when l_extendedprice < l_quantity * 905 then 'price too low' end], lambda x: x is not null), '; ') as reasons from lineitem where l_discount > 0.09 or l_quantity > 45 or l_extendedprice < l_quantity * 905"""
)
def price_range_reject(spark, sf_dir):
    rules = [("discount too high", c("l_discount") > 0.09), ("quantity too large", c("l_quantity") > 45), ("price too low", c("l_extendedprice") < c("l_quantity") * 905)]
    reasons = F.filter(F.array(*(F.when(broken, F.lit(why)) for why, broken in rules)), lambda r: r.isNotNull())
    rows = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", reasons.alias("reasons"))
    return rows.where(F.size("reasons") > 0).select("l_orderkey", "l_linenumber", F.array_join("reasons", "; ").alias("reasons"))


@query(
    """with r as (select case when l_discount > 0.09 then 'discount too high' end as a, case when l_quantity > 45 then 'quantity too large' end as b from lineitem)
    select a as rule, count(*) as n from r where a is not null group by 1 union all select b, count(*) from r where b is not null group by 1"""
)
def rule_counts(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").agg(F.count_if(c("l_discount") > 0.09).alias("discount too high"), F.count_if(c("l_quantity") > 45).alias("quantity too large"))
    return rows.unpivot([], ["discount too high", "quantity too large"], "rule", "n")


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, coalesce(cast(json_extract_string(props, '$.k') as bigint) > 50, false) as large from events")
def json_props_parse(spark, sf_dir):
    rows = t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
    return rows.select("event_id", "k", F.coalesce(c("k") > 50, F.lit(False)).alias("large"))


# Lookups


@query(f"select s_suppkey, n_name, r_name from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def alias_lookup_exact(spark, sf_dir):
    """Exact keys of normalised names, one hop after the other."""
    nation, region = t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    named = nation.join(region, c("n_regionkey") == c("r_regionkey")).select("n_nationkey", "n_name", "r_name", text.normalise(c("n_name")).alias("alias_key"))
    known = lookup.latest_by_key(named, ["alias_key"], "n_nationkey")
    return t(spark, sf_dir, "supplier").join(known, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", "n_name", "r_name")


@query(
    f"""with a as (select distinct {norm("p_brand")} as alias from part union select distinct {norm("string_split(p_type, ' ')[1]")} from part union select distinct {norm("p_type")} from part),
    h as (select p_partkey, ' ' || {norm("p_name || ' ' || p_type || ' ' || p_brand")} || ' ' as hay from part),
    m as (select p_partkey, alias, row_number() over (partition by p_partkey order by length(alias) desc, alias) as k from h join a on contains(hay, ' ' || alias || ' ') where length(alias) >= 5)
    select p_partkey, alias from m where k = 1"""
)
def contains_longest(spark, sf_dir):
    """The longest alias that a text holds as whole words; aliases are met by their first word.

    The parts are dealt out by key first: then the planner knows their measured size, each task has a share of them, and
    what a part has in common with aliases is sorted there.
    """
    part = t(spark, sf_dir, "part")
    raw = [part.select(x.alias("name")).distinct() for x in (c("p_brand"), F.split_part("p_type", F.lit(" "), F.lit(1)), c("p_type"))]
    # exploded, since the planner would move filters on a plain alias below distinct(), where every part's names would be normalised
    names = raw[0].union(raw[1]).union(raw[2]).select(F.explode(F.array(text.normalise(c("name")))).alias("alias"))
    known = names.distinct().where(F.length("alias") >= lookup.ALIAS_LENGTH).withColumn("w", F.split_part("alias", F.lit(" "), F.lit(1)))
    hay = part.repartition("p_partkey").select("p_partkey", text.normalise(F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("hay"))
    near = hay.withColumn("w", F.explode(F.array_distinct(F.split("hay", " ")))).join(known, "w")
    near = near.where(F.contains(F.concat(F.lit(" "), c("hay"), F.lit(" ")), F.concat(F.lit(" "), c("alias"), F.lit(" "))))
    return near.groupBy("p_partkey").agg(F.min_by("alias", F.struct(-F.length("alias"), c("alias"))).alias("alias"))


@query(
    f"""with s as (select distinct p_name from part), k as (select p_name, string_split({norm("p_name")}, ' ')[-1] as surname from s), o as (select surname, min(p_name) as p_name from k group by 1 having count(*) = 1),
    q as (select p_partkey, {norm("p_name")} as full_name, string_split({norm("p_name")}, ' ')[-1] as surname from part)
    select p_partkey, q.surname, o.p_name is not null as only_one from q left join o using (surname)"""
)
def surname_unique_match(spark, sf_dir):
    part = t(spark, sf_dir, "part")
    known = part.select("p_name").distinct().select("p_name", lookup.surname(text.normalise(c("p_name"))).alias("surname"))
    only = known.groupBy("surname").agg(F.count("*").alias("n")).where("n = 1")
    rows = part.select("p_partkey", lookup.surname(text.normalise(c("p_name"))).alias("surname"))
    return rows.join(only, "surname", "left").select("p_partkey", "surname", c("n").isNotNull().alias("only_one"))


@query("select s_suppkey, s_name, case when s_acctbal > 5000 then 'claimed' when n_name is not null then 'matched' end as how from supplier left join nation on s_nationkey = n_nationkey and n_regionkey = 1")
def claimed_fallback(spark, sf_dir):
    some = t(spark, sf_dir, "nation").where("n_regionkey = 1")
    rows = t(spark, sf_dir, "supplier").join(some, c("s_nationkey") == c("n_nationkey"), "left")
    return rows.select("s_suppkey", "s_name", F.when(c("s_acctbal") > 5000, "claimed").when(c("n_name").isNotNull(), "matched").alias("how"))


# Joins


@query("select d.doc_id, l.quality, b.item_id from documents d join labels l on d.doc_id = l.doc_id left join benchmark b on b.item_id = d.doc_id and l.quality = 1")
def live_docs_join(spark, sf_dir):
    rows = t(spark, sf_dir, "documents").select("doc_id").join(t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    items = t(spark, sf_dir, "benchmark").select("item_id")
    return rows.join(items, (c("item_id") == c("doc_id")) & (c("quality") == 1), "left").select("doc_id", "quality", "item_id")


@query("select a.conv_id, a.turn, a.role, b.role as before from conversations a left join conversations b on a.conv_id = b.conv_id and b.turn = a.turn - 1")
def guard_index_join(spark, sf_dir):
    turns = t(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    before = turns.select("conv_id", (c("turn") + 1).alias("turn"), c("role").alias("before"))
    return turns.join(before, ["conv_id", "turn"], "left")


@query(
    """with e as (select event_id, user_id, ts, cast(ts as date) as day from events) select a.event_id as a, b.event_id as b, cast(floor(epoch(b.ts)) - floor(epoch(a.ts)) as bigint) as gap
    from e a join e b on a.user_id = b.user_id and a.day = b.day and a.event_id < b.event_id and abs(epoch(a.ts) - epoch(b.ts)) <= 3600"""
)
def band_self_join(spark, sf_dir):
    """Pairs of a user's events of one day within an hour: an equi-join on hour-wide bins, each pair once."""
    rows = t(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), F.unix_micros(c("ts").cast("timestamp")).alias("at")).withColumn("bin", F.floor(c("at") / 3_600_000_000))
    near = rows.withColumn("bin", F.explode(F.array(c("bin") - 1, c("bin"), c("bin") + 1)))
    b = rows.select(c("event_id").alias("b"), "user_id", "day", "bin", c("at").alias("b_at"))
    both = near.join(b, ["user_id", "day", "bin"]).where((c("event_id") < c("b")) & (F.abs(c("at") - c("b_at")) <= 3_600_000_000))
    return both.select(c("event_id").alias("a"), "b", (F.floor(c("b_at") / 1_000_000) - F.floor(c("at") / 1_000_000)).cast("bigint").alias("gap"))


@query("select o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_quantity > 40)")
def vanished_anti(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey").join(t(spark, sf_dir, "lineitem").where("l_quantity > 40").select(c("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("select doc_id, source from documents where doc_id not in (select doc_id from labels)")
def orphan_anti(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").select("source", "doc_id")
    live = docs.join(t(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select("source", "doc_id")
    return incremental.orphans(docs, live)


@query("select page_id, url from pages p where exists (select 1 from documents d where d.doc_id = p.page_id and d.lang = 'en')")
def kept_previous_semi(spark, sf_dir):
    english = t(spark, sf_dir, "documents").where("lang = 'en'").select(c("doc_id").alias("page_id"))
    return t(spark, sf_dir, "pages").join(english, "page_id", "left_semi").select("page_id", "url")


# Groups


@query(
    """with e as (select event_id, user_id, cast(ts as date) as day, event_type, ts from events),
    k as (select user_id, day, event_type, epoch(max(ts)) - epoch(min(ts)) as spread, count(distinct strftime(ts, '%H:%M')) as times from e group by all)
    select event_id, e.user_id || '|' || strftime(e.day, '%Y-%m-%d') || '|' || event_type || case when times > 1 and spread > 3600 then '|' || strftime(ts, '%H:%M') else '' end as key
    from e join k using (user_id, day, event_type)"""
)
def rekey_by_time(spark, sf_dir):
    """A key that covers times more than an hour apart gets the time as well."""
    rows = t(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    by = Window.partitionBy("user_id", "day", "event_type")
    at = F.unix_micros(c("ts").cast("timestamp"))
    spread = F.max(at).over(by) - F.min(at).over(by)
    times = F.size(F.collect_set(F.date_format("ts", "HH:mm")).over(by))
    apart = (times > 1) & (spread > 3_600_000_000)
    base = F.concat_ws("|", "user_id", "day", "event_type")
    return rows.select("event_id", F.when(apart, F.concat_ws("|", base, F.date_format("ts", "HH:mm"))).otherwise(base).alias("key"))


@query(
    """with r as (select *, row_number() over (partition by o_custkey order by case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end, o_totalprice desc, o_orderkey) as k from orders)
    select o_custkey, o_orderkey from r where k = 1"""
)
def pick_canonical(spark, sf_dir):
    """Of each customer's orders the first by rank, price and key: a minimum, combined before the shuffle."""
    rank = F.when(c("o_orderstatus") == "F", 0).when(c("o_orderstatus") == "O", 1).otherwise(2)
    return t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct(rank, -c("o_totalprice"), c("o_orderkey"))).alias("o_orderkey"))


@query(
    """with o as (select user_id, event_id, case when event_type = 'click' then null else event_type end as kind, case when value < 20 then null else value end as value from events)
    select user_id, arg_min(kind, event_id) filter (kind is not null) as kind, arg_min(value, event_id) filter (value is not null) as value, count(*) as n from o group by 1"""
)
def survivorship_fill(spark, sf_dir):
    """Each field from the first record that has it."""
    rows = t(spark, sf_dir, "events").withColumns({"kind": F.when(c("event_type") != "click", c("event_type")), "value": F.when(c("value") >= 20, c("value"))})
    first = lambda f: F.min_by(f, F.when(c(f).isNotNull(), c("event_id"))).alias(f)
    return rows.groupBy("user_id").agg(first("kind"), first("value"), F.count("*").alias("n"))


@query("select min(doc_id) as doc_id, count(*) as n from documents group by text")
def dedupe_exact_docs(spark, sf_dir):
    return t(spark, sf_dir, "documents").groupBy(F.sha2("text", 256)).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).select("doc_id", "n")


@query(
    """with p as (select * from orders where o_orderkey % 3 <> 0), i as (select o_orderkey, o_custkey, case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice from orders where o_orderkey % 4 <> 0)
    select case when p.o_orderkey is null then 'added' when i.o_orderkey is null then 'unconfirmed' when p.o_totalprice <> i.o_totalprice then 'updated' else 'unchanged' end as action, count(*) as n
    from p full join i using (o_orderkey) group by 1"""
)
def reconcile_full(spark, sf_dir):
    """What a batch does to what was there: by key, and by a fingerprint of the content."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    mark = lambda d, name: d.select("o_orderkey", keys.short_hash(F.to_json(F.struct("o_custkey", "o_totalprice"))).alias(name))
    prior = mark(orders.where("o_orderkey % 3 <> 0"), "was")
    batch = mark(orders.where("o_orderkey % 4 <> 0").withColumn("o_totalprice", F.when(c("o_orderkey") % 5 == 0, c("o_totalprice") + 1).otherwise(c("o_totalprice"))), "now")
    action = F.when(c("was").isNull(), "added").when(c("now").isNull(), "unconfirmed").when(c("was") != c("now"), "updated").otherwise("unchanged")
    return prior.join(batch, "o_orderkey", "full").groupBy(action.alias("action")).agg(F.count("*").alias("n"))


@query("select o_orderkey, o_orderkey % 5 = 0 as changed from orders")
def fingerprint_changed(spark, sf_dir):
    """Fingerprints differ where the content does, and only there."""
    orders = t(spark, sf_dir, "orders")
    edited = F.when(c("o_orderkey") % 5 == 0, c("o_totalprice") + 1).otherwise(c("o_totalprice"))
    was = keys.fingerprint(F.struct("o_orderkey", "o_custkey", "o_totalprice"))
    now = keys.fingerprint(F.struct(edited.alias("o_totalprice"), c("o_custkey"), c("o_orderkey")))
    return orders.select("o_orderkey", (was != now).alias("changed"))


@query(
    """select d.doc_id, case when l.toxic = 1 then 'reject' when l.doc_id is null then 'queue' when l.quality = 1 then 'publish' else 'queue' end as outcome from documents d left join labels l using (doc_id)"""
)
def decision_gate(spark, sf_dir):
    rows = t(spark, sf_dir, "documents").select("doc_id").join(t(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.when(c("toxic") == 1, "reject").when(c("quality") == 1, "publish").otherwise("queue").alias("outcome"))


@query(
    """select d.doc_id, case when l.quality = 1 and d.doc_id % 7 = 0 then 'refresh' when l.quality = 1 then 'current' when d.doc_id % 5 >= 3 then 'parked' else 'extract' end as action from documents d left join labels l using (doc_id)"""
)
def extraction_plan(spark, sf_dir):
    """Good extractions are current or refreshed; others are tried until they have failed three times."""
    rows = t(spark, sf_dir, "documents").select("doc_id").join(t(spark, sf_dir, "labels"), "doc_id", "left")
    good, tried = F.coalesce(c("quality") == 1, F.lit(False)), (c("doc_id") % 5).cast("int")
    hash_ = F.lit("h")
    action = incremental.plan(F.when(good, "ok").otherwise("error"), hash_, F.when(~good, hash_), tried, F.when(c("doc_id") % 7 == 0, "v1").otherwise("v2"), hash_, F.lit("v2"))
    return rows.select("doc_id", action.alias("action"))


@query("select event_type, count(*) as n, round(sum(value), 2) as total from events group by rollup (event_type)")
def totals_rollup(spark, sf_dir):
    return t(spark, sf_dir, "events").rollup("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("select source, count(*) filter (lang = 'en') as n_en, count(*) filter (n_chars > 2000) as n_long, count(*) as n from documents group by source")
def run_counters(spark, sf_dir):
    return t(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(c("lang") == "en").alias("n_en"), F.count_if(c("n_chars") > 2000).alias("n_long"), F.count("*").alias("n"))


@query(
    """with r as (select user_id, event_id, event_type = 'error' or value < 30 as bad from events), g as (select user_id, max(event_id) filter (not bad) as good from r group by 1)
    select user_id, count(*) filter (bad and (good is null or event_id > good)) as streak from r join g using (user_id) group by 1"""
)
def failing_sources(spark, sf_dir):
    """Failures in a row, to the last event of each user."""
    rows = t(spark, sf_dir, "events").select("user_id", "event_id", ((c("event_type") == "error") | (c("value") < 30)).alias("bad"))
    return incremental.failure_streaks(rows, "user_id", "event_id", "bad")


# Lists and scores


@query(
    f"""with w as (select doc_id, list_filter(string_split({norm("text")}, ' '), lambda x: x <> '') as a, list_filter(string_split({norm("substr(text, 50)")}, ' '), lambda x: x <> '') as b from documents),
    x as (select doc_id, t, count(*) as k from (select doc_id, unnest(a) as t from w) group by all), y as (select doc_id, t, count(*) as k from (select doc_id, unnest(b) as t from w) group by all),
    i as (select doc_id, sum(least(x.k, y.k)) as k from x join y using (doc_id, t) group by 1)
    select doc_id, round(case when len(a) + len(b) = 0 then 1.0 else 2.0 * coalesce(i.k, 0) / (len(a) + len(b)) end, 6) as f1 from w left join i using (doc_id)"""
)
def multiset_f1(spark, sf_dir):
    """Whole texts against the same from character 50 to the end."""
    rows = t(spark, sf_dir, "documents").select("doc_id", text.words(c("text")).alias("a"), text.words(F.expr("substr(text, 50)")).alias("b"))
    return rows.select("doc_id", F.round(text.multiset_f1(c("a"), c("b")), 6).alias("f1"))


@query(
    """with s as (select 'quality' as field, cast((n_chars > 200) = (quality = 1) as integer) as ok from documents join labels using (doc_id) union all
    select 'toxic', cast((n_chars < 100) = (toxic = 1) as integer) from documents join labels using (doc_id))
    select field, cast(sum(ok) as bigint) as correct, count(*) as total, round(sum(ok) / count(*), 6) as accuracy from s group by 1"""
)
def score_combine(spark, sf_dir):
    rows = t(spark, sf_dir, "documents").join(t(spark, sf_dir, "labels"), "doc_id")
    checks = rows.select(((c("n_chars") > 200) == (c("quality") == 1)).cast("int").alias("quality"), ((c("n_chars") < 100) == (c("toxic") == 1)).cast("int").alias("toxic"))
    long = checks.unpivot([], ["quality", "toxic"], "field", "ok").groupBy("field").agg(F.sum("ok").alias("correct"), F.count("*").alias("total"))
    return long.withColumn("accuracy", F.round(c("correct") / c("total"), 6))


@query("select lang, count(*) filter (quality = 1 and n_chars > 500) / count(*) filter (n_chars > 500) as precise, count(*) filter (quality = 1 and n_chars > 500) / count(*) filter (quality = 1) as recall from documents join labels using (doc_id) group by lang")
def precision_recall(spark, sf_dir):
    rows = t(spark, sf_dir, "documents").join(t(spark, sf_dir, "labels"), "doc_id")
    hit = F.count_if((c("quality") == 1) & (c("n_chars") > 500))
    return rows.groupBy("lang").agg((hit / F.count_if(c("n_chars") > 500)).alias("precise"), (hit / F.count_if(c("quality") == 1)).alias("recall"))


_BODIES = {
    1: "- [x] approve `0123456789abcdef`\r\n- [ ] reject `0123456789abcdef`",
    2: "- [X] approve `aaaaaaaaaaaaaaaa`\n- [x] reject `aaaaaaaaaaaaaaaa`",
    3: "> - [x] approve `bbbbbbbbbbbbbbbb`\n- [x] approve `cccccccccccccccc` please",
    4: "- [x] reject `dddddddddddddddd`  \n- [x] approve `eeeeeeeeeeeeeeee`",
}


@query(
    "select * from (values (1, '0123456789abcdef', 'approve'), (2, 'aaaaaaaaaaaaaaaa', 'reject'), (4, 'dddddddddddddddd', 'reject'), (4, 'eeeeeeeeeeeeeeee', 'approve')) v(issue, id, decision)"
)
def parse_decisions(spark, sf_dir):
    rows = spark.createDataFrame(list(_BODIES.items()), "issue int, body string")
    return rows.select("issue", F.explode(review.ticks(c("body"))).alias("d")).select("issue", "d.id", "d.decision")


@query(
    r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(t, 'sk-ant-[A-Za-z0-9_-]{8,}', 'sk-ant-[REDACTED]', 'g'), '([?&](?:api_key|apikey|key|token|usertoken)=)[^&\s"'']+', '\1[REDACTED]', 'gi'),
    '(x-api-key|authorization|usertoken)(["'']?\s*[:=]\s*["'']?)[^"''\s,}]+', '\1\2[REDACTED]', 'gi') as safe
    from (select doc_id, 'https://h/?token=' || doc_id || '&q=1 authorization: ' || lang || ' ' || text as t from documents)"""
)
def redact_text(spark, sf_dir):
    made = F.concat(F.lit("https://h/?token="), "doc_id", F.lit("&q=1 authorization: "), "lang", F.lit(" "), "text")
    return t(spark, sf_dir, "documents").select("doc_id", review.redact(made).alias("safe"))


@query(
    r"""with a as (select doc_id, trim(regexp_replace(regexp_replace(translate(regexp_replace('<b>`[x]` ' || text, '[\r\n\t\v\f]+', ' ', 'g'), '<>`', '‹›'''), '\[( |x|X)\]', '(\1)', 'g'), '\s+', ' ', 'g')) as s from documents)
    select doc_id, case when length(s) > 300 then left(s, 299) || '…' else s end as line from a"""
)
def inert_text(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", review.inert(F.concat(F.lit("<b>`[x]` "), "text")).alias("line"))


@query("select source, doc_id, n_chars from (select *, row_number() over (partition by source order by n_chars desc, doc_id) as k from documents) where k <= 5")
def topk_caps(spark, sf_dir):
    """The five longest of each source; the rank's bound is applied before the shuffle too."""
    top = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    return t(spark, sf_dir, "documents").withColumn("k", F.row_number().over(top)).where("k <= 5").select("source", "doc_id", "n_chars")


@query("select source, doc_id from (select *, sum(n_chars) over (partition by source order by doc_id rows unbounded preceding) as s from documents) where s <= 20000")
def budget_prefix(spark, sf_dir):
    """Of each source, documents in order while a budget of characters lasts."""
    return incremental.within_budget(t(spark, sf_dir, "documents"), "n_chars", 20_000, [F.col("doc_id")], "source").select("source", "doc_id")


@query(
    """select lang, array_to_string(list_sort(list(distinct source)), ',') as sources, count(distinct source) as n from documents group by lang"""
)
def array_sets(spark, sf_dir):
    return t(spark, sf_dir, "documents").groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.count_distinct("source").alias("n"))


@query("select doc_id, 'document' as kind from documents where n_chars < 500 union all select item_id, 'item' from benchmark union all select page_id, 'page' from pages")
def union_append(spark, sf_dir):
    docs = t(spark, sf_dir, "documents").where("n_chars < 500").select("doc_id", F.lit("document").alias("kind"))
    items = t(spark, sf_dir, "benchmark").select(c("item_id").alias("doc_id"), F.lit("item").alias("kind"))
    return docs.unionByName(items).unionByName(t(spark, sf_dir, "pages").select(c("page_id").alias("doc_id"), F.lit("page").alias("kind")))


@query("select doc_id from documents except select doc_id from labels")
def except_pending(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id").subtract(t(spark, sf_dir, "labels").select("doc_id"))


@query("select doc_id, cast(length(text) as integer) as chars from documents where length(text) <= 2000")
def chunk_text_whole(spark, sf_dir):
    """Short texts are one chunk."""
    rows = t(spark, sf_dir, "documents").select("doc_id", text.chunks(c("text"), 2000).alias("chunks"))
    return rows.where((F.size("chunks") == 1)).select("doc_id", F.length(c("chunks")[0]).alias("chars"))


@query(None)
def chunk_text(spark, sf_dir):
    """All chunks; packing is a fold over pieces, which the tests hold against brute force."""
    rows = t(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.chunks(c("text"), 2000)).alias("n", "chunk"))
    return rows.select("doc_id", "n", F.length("chunk").alias("chars"), keys.short_hash(c("chunk")).alias("hash"))


@query(None)
def html_to_text(spark, sf_dir):
    from tessel.functions import markup

    rows = t(spark, sf_dir, "pages").select("page_id", markup.as_text(c("html"), c("url")).alias("text"))
    return rows.select("page_id", F.length("text").alias("chars"), keys.short_hash(c("text")).alias("hash"))


@query(
    """select user_id, cast(ts as date) as day, count(*) as n, min(ts) as first, max(ts) as last from events group by all having count(*) > 1"""
)
def daily_blocks(spark, sf_dir):
    rows = t(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.min("ts").cast("timestamp_ntz").alias("first"), F.max("ts").cast("timestamp_ntz").alias("last"))
    return rows.where("n > 1")


@query("select n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name")
def stats_by_slug(spark, sf_dir):
    """A report's totals by name: facts joined to their dimensions, summed before the shuffle."""
    lines = t(spark, sf_dir, "lineitem").select("l_orderkey", (c("l_extendedprice") * (1 - c("l_discount"))).alias("price"))
    rows = lines.join(t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey"))
    rows = rows.join(t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), c("o_custkey") == c("c_custkey")).join(t(spark, sf_dir, "nation").select("n_nationkey", "n_name"), c("c_nationkey") == c("n_nationkey"))
    return rows.groupBy("n_name").agg(F.round(F.sum("price"), 2).alias("revenue"))


@query(None)
def constrained_clusters(spark, sf_dir):
    """Greedy clusters of a user's day that span at most an hour; order-dependent, so the tests check invariants."""
    import pyarrow as pa

    from tessel.operators.cluster import joinable

    rows = t(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss+00:00").alias("start"))

    def block(table: pa.Table) -> pa.Table:
        clusters: list[list[dict]] = []
        for r in sorted(table.to_pylist(), key=lambda r: (r["start"], r["event_id"])):
            r["source"] = {"url": str(r["event_id"])}
            if clusters and joinable([*clusters[-1], r]):
                clusters[-1].append(r)
            else:
                clusters.append([r])
        pairs = [(r["event_id"], x[0]["event_id"], len(x)) for x in clusters for r in x]
        return pa.table([pa.array(col, pa.int64()) for col in zip(*pairs, strict=True)], names=["event_id", "cluster", "n"])

    return rows.groupBy("user_id", "day").applyInArrow(block, "event_id bigint, cluster bigint, n bigint")


# Streams


@query("select date_trunc('day', ts) as start, event_type, count(*) as n, round(sum(value), 2) as total from events group by all")
def incremental_stream(spark, sf_dir):
    """Daily counts of a stream of event files, run over all that is there."""
    import uuid

    from tessel.streaming import incremental as stream

    events = stream.files(spark, sf_dir, "events.parquet", t(spark, sf_dir, "events").schema)
    return stream.result(stream.windowed_counts(events), f"counts_{uuid.uuid4().hex}")
