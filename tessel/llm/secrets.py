"""Secrets, and multipart credentials linked by interval joins, in DataFrame operations alone.

Three kinds count on their own (the base): assign, a name such as token or password with
a value; access, an access key's identifier; hex, a long hexadecimal run. Their places
come without any Python: a text split at a pattern's matches gives the lengths between
them, and the matches their own.

Weaker candidates (a long mixed run of base-64 characters) are reported only if a
credential's complementary parts are near: an identifier (access key, user or client
name) and an endpoint (a URL or a host setting), both within `SCOPE` code points of the
candidate. Parts are joined to candidates by interval, through bins as wide as the
scope: of each bin, row and role only the least start and the greatest end are kept
before the join, which decides the nearest part exactly and keeps the join linear even
for a row full of parts.

Defined cases: a null text is empty; an empty text has no spans; repeated rows stay rows
(they are linked by place, not by id); an empty table gives an empty result; other
columns are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm.common import PLACE, Shared, placed, read, text_of

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "linked")
#: Code points between a candidate and the parts that complete it.
SCOPE = 400

_NAME = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_ASSIGN = _NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of all hexadecimal or key characters is as long as can be, so its least length can stand in the pattern.
_PATTERNS = {"assign": _ASSIGN, "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}
#: What complements a weak candidate, by role.
_PARTS = {
    "identifier": r"""AKIA[A-Z0-9]{14,}|(?:[Uu]ser(?:name)?|[Cc]lient_?[Ii]d|[Aa]ccess_?[Kk]ey_?[Ii]d|[Aa]ccount)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    "endpoint": r"""[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9\[][^\s"'<>]*|(?:[Hh]ost|[Ee]ndpoint|[Uu]rl|[Ss]erver)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:/-]{3,}""",
}
_WEAK = r"[A-Za-z0-9+/_-]{20,}={0,2}"

_SPAN = "array<struct<start:int,end:int,text:string>>"


def _running(a: str, level: int = 3) -> str:
    """SQL for the running sums of the lambda variable `a`, an array of ints that isn't empty.

    An array grown one by one is copied each time; so sums run within blocks of 64, and
    the blocks' totals are summed alike, which keeps the work in proportion to the array.
    """
    v = f"{a}_{level}"
    if level == 0:
        return f"aggregate({a}, struct(0 as t, cast(array() as array<int>) as o), (s, x) -> struct(s.t + x as t, array_append(s.o, s.t + x) as o), s -> s.o)"
    parts = f"transform(sequence(0, (size({a}) - 1) div 64), b -> transform(array(slice({a}, b * 64 + 1, 64)), {v}p -> {_running(f'{v}p', 0)})[0])"
    shifted = f"flatten(transform({v}q, (p, k) -> transform(p, x -> x + if(k = 0, 0, {v}r[k - 1]))))"
    totals = f"transform(array(transform({v}q, p -> element_at(p, -1))), {v}t -> {_running(f'{v}t', level - 1)})[0]"
    return f"transform(array({parts}), {v}q -> transform(array({totals}), {v}r -> {shifted})[0])[0]"


def _spans(text: str, pattern: str) -> Column:
    """All matches, leftmost and not overlapping: array of (start, end, text)."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    hits, gaps = f"regexp_extract_all({text}, '{quoted}', 0)", f"split({text}, '{quoted}', -1)"
    # ends of matches, by running sums of the lengths of gaps and matches; the only element of an array is bound once
    lengths = "transform(z.h, (h, i) -> length(z.g[i]) + length(h))"
    ends = f"transform(array({lengths}), l -> {_running('l')})[0]"
    spans = f"transform(array({ends}), e -> transform(z.h, (h, i) -> struct(e[i] - length(h) as start, e[i] as end, h as text)))[0]"
    return F.expr(f"if({text} rlike '{quoted}', transform(array(struct({hits} as h, {gaps} as g)), z -> {spans})[0], cast(array() as {_SPAN}))")


def base_spans(docs: DataFrame) -> DataFrame:
    """docs with one array of (start, end, text) for each base kind, weak candidate and part."""
    out = docs.select("doc_id", *PLACE, text_of().alias("text"))
    for kind, pattern in {**_PATTERNS, **_PARTS, "weak": _WEAK}.items():
        out = out.withColumn(kind, _spans("text", pattern))
    value = _ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    out = out.withColumn("assign", F.expr(f"filter(assign, s -> length(regexp_extract(s.text, '{value}', 2)) >= 12)"))
    # a weak candidate mixes cases and digits
    mixed = "s.text rlike '[0-9]' and s.text rlike '[a-z]' and s.text rlike '[A-Z]'"
    return out.withColumn("weak", F.expr(f"filter(weak, s -> {mixed})")).drop("text")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """place, start, end of the weak candidates with an identifier and an endpoint in scope that overlap none of the base."""
    weak = found.where(F.size("weak") > 0).select(*PLACE, F.explode("weak").alias("s")).select(*PLACE, "s.start", "s.end")
    roles = [found.where(F.size("weak") > 0).select(*PLACE, F.lit(r).alias("role"), F.explode(r).alias("s")) for r in _PARTS]
    parts = roles[0].unionByName(roles[1])
    lo, hi = F.floor(F.col("s.start") / scope), F.floor((F.col("s.end") - 1) / scope)
    binned = parts.select(*PLACE, "role", F.explode(F.sequence(lo, hi)).alias("bin"), F.greatest(F.col("s.start"), F.lit(0)).alias("a"), F.col("s.end").alias("b"))
    binned = binned.groupBy(*PLACE, "role", "bin").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    reach = weak.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))))
    # in one bin the extremes of its parts decide whether any is near
    near = (F.col("a") <= F.col("end") + scope) & (F.col("b") >= F.col("start") - scope)
    both = reach.join(binned, [*PLACE, "bin"]).where(near).groupBy(*PLACE, "start", "end").agg(F.countDistinct("role").alias("n"))
    both = both.where(F.col("n") == len(_PARTS)).select(*PLACE, "start", "end")
    base = found.where(F.size("weak") > 0).select(*PLACE, F.explode(F.concat(*BASE)).alias("s"))
    taken = base.select(*PLACE, F.explode(F.sequence(lo, hi)).alias("bin"), F.col("s.start").alias("a"), F.col("s.end").alias("b"))
    over = both.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))))
    over = over.join(taken, [*PLACE, "bin"]).where((F.col("a") < F.col("end")) & (F.col("start") < F.col("b")))
    return both.join(over.select(*PLACE, "start").distinct(), [*PLACE, "start"], "left_anti")


def secrets(docs: DataFrame, shared: Shared, scope: int = SCOPE) -> DataFrame:
    """doc_id, place and spans, an array of (start, rank of kind, kind, end) in order, for each row of docs."""
    found = shared.table(base_spans(placed(docs, shared)))
    extra = linked(found, scope).groupBy(*PLACE).agg(F.collect_list(F.struct("start", "end")).alias("linked"))
    out = found.join(extra, PLACE, "left")
    each = [F.expr(f"transform(coalesce({k}, array()), s -> struct(s.start as start, {i} as rank, '{k}' as kind, s.end as end))") for i, k in enumerate(KINDS)]
    return out.select("doc_id", *PLACE, F.sort_array(F.concat(*each)).alias("spans"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = secrets(read(spark, sf_dir, "documents"), Shared(spark, "secrets"))
    written = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    base = F.expr(written.format(f"filter(spans, s -> s.rank < {len(BASE)})"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), F.expr(written.format("spans")).alias("spans"))


def _sql() -> str:
    """The same spans in SQL: places by the lengths of matches and of what lies between."""
    select = (
        "select doc_id, '{k}' as kind, i, list_sum(list_transform(array_slice(g, 1, i), lambda x: length(x))) + coalesce(list_sum(list_transform(array_slice(h, 1, i - 1), lambda x: length(x))), 0) as lo, h[i] as body "
        "from (select doc_id, h, g, unnest(range(1, len(h) + 1)) as i from (select doc_id, regexp_extract_all(text, '{p}') as h, string_split_regex(text, '{p}') as g from doc))"
    )
    kinds = " union all ".join(select.format(k=k, p=p.replace("'", "''")) for k, p in {**_PATTERNS, **_PARTS, "weak": _WEAK}.items())
    value = _ASSIGN.replace("'", "''")
    ranks = " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS))
    near = f"exists (select 1 from place p where p.doc_id = w.doc_id and p.kind = '{{}}' and p.lo <= w.hi + {SCOPE} and p.hi >= w.lo - {SCOPE})"
    both = " and ".join(near.format(r) for r in _PARTS)
    written = "kind || ':' || lo || ':' || hi"
    return f"""
with doc as (select doc_id, coalesce(text, '') as text from documents),
place as (select doc_id, kind, lo, lo + length(body) as hi, body from ({kinds})),
base as (select * from place where kind in ('access', 'hex') or kind = 'assign' and length(regexp_extract(body, '{value}', 2)) >= 12),
weak as (select * from place w where kind = 'weak' and regexp_matches(body, '[0-9]') and regexp_matches(body, '[a-z]') and regexp_matches(body, '[A-Z]')
  and not exists (select 1 from base b where b.doc_id = w.doc_id and b.lo < w.hi and w.lo < b.hi)),
span as (select doc_id, kind, lo, hi from base union all select doc_id, 'linked', lo, hi from weak w where {both}),
ranked as (select *, case kind {ranks} end as rank from span),
listed as (
  select doc_id, {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in BASE)}, string_agg({written}, ',' order by lo, rank) as spans,
    string_agg({written}, ',' order by lo, rank) filter (rank < {len(BASE)}) as base from ranked group by doc_id)
select doc_id, {", ".join(f"cast(coalesce(n_{k}, 0) as bigint) as n_{k}" for k in BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from doc left join listed using (doc_id)
"""


SQL = _sql()
