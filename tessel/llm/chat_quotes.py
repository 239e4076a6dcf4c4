"""Quotation linking for conversations, in DataFrame operations alone.

A line's quote level is the number of '>' marks in its leading run of marks and blanks.
Successive quoted lines of one level, up to a blank one, are a passage. Passages, and the
paragraphs and lines that a message adds itself, are normalised (lower case, single
spaces, so rewrapping doesn't matter) and hashed. A passage is linked to the latest
earlier message of its conversation with an equal hash, else (line by line) to that of
its first line that has one, else to the first message anywhere that has it. What a
message replies to is the source of its first passage of the lowest level, else the
message before it.

Messages are returned in reply order, without their quotes: each after what it replies
to, answers by turn, an answer's own answers before the next answer (a source is always
earlier, so this is a tree). Only conversations in which a message answers another than
the one before it need more than their turns for that: their trees are numbered by
pointer doubling, in as many rounds as the tree is deep to the power of two.

The latest earlier source is an as-of join by hash, over distinct turns and in stretches
of turns, then over stretches: nothing is paired, and no task holds a very long
conversation or a passage that it quotes over and over. Order, predecessor and next
answer are counted in the same way. Sources elsewhere are one row per hash, taken before
the join.

Defined cases: a null text is empty; a message of quotes alone has an empty text; null
conversations count as one; a null turn comes first; of messages with equal turns none
is earlier, their order is by role, then text, and an answer to such a turn is one to the
first of them; repeated rows stay rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel.llm.common import PLACE, Shared, placed, read, text_of

#: Turns in a stretch.
STRETCH = 4096

_BLANK = " \t\n\x0b\f\r"


def _by_turn():
    return F.col("turn").asc_nulls_first()


def _stretch(column: str = "turn"):
    return F.coalesce(F.floor(F.col(column) / STRETCH), F.lit(-(1 << 62)))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, place, lines: array of (level, body, plain) and own (the text without quotes).

    Every step is linear in the line, however many marks or blanks it has.
    """
    lead = r"regexp_extract(l, '^[\\x20\\x09>]*', 0)"
    cut = f"transform(transform(split(text, '\\n'), l -> struct(l, trim(TRAILING ' \t' FROM {lead}) as marks)), x -> struct(length(x.marks) - length(replace(x.marks, '>', '')) as level, x.l as l, length(x.marks) as n))"
    body = f"transform({cut}, x -> struct(x.level as level, if(x.level = 0, x.l, substring(x.l, x.n + 1 + if(substring(x.l, x.n + 1, 1) in (' ', '\t'), 1, 0))) as body))"
    lines = f"transform({body}, x -> struct(x.level as level, x.body as body, trim(lower(regexp_replace(x.body, '[\\\\x20\\\\x09-\\\\x0D]+', ' '))) as plain))"
    rows = messages.select("conv_id", "turn", "role", *PLACE, text_of().alias("text")).withColumn("lines", F.expr(lines)).drop("text")
    # white space at either end goes, blank lines that quotes leave behind too
    own = f"trim(BOTH '{_BLANK}' FROM array_join(transform(filter(lines, x -> x.level = 0), x -> x.body), '\\n'))"
    return rows.withColumn("own", F.expr(own))


def units(rows: DataFrame) -> DataFrame:
    """conv_id, turn, place, passage (its first line's number), level, hash and whole (a passage or paragraph, else a line)."""
    line = rows.select("conv_id", "turn", *PLACE, F.posexplode("lines").alias("at", "x")).select("conv_id", "turn", *PLACE, "at", "x.level", "x.plain").where("plain <> ''")
    # a passage goes on while lines follow each other on one level
    by = Window.partitionBy(*PLACE).orderBy("at")
    new = (F.lag("at").over(by) != F.col("at") - 1) | (F.lag("level").over(by) != F.col("level"))
    line = line.withColumn("passage", F.max(F.when(F.coalesce(new, F.lit(True)), F.col("at"))).over(by))
    whole = line.groupBy("conv_id", "turn", *PLACE, "passage", "level").agg(F.expr("array_join(transform(array_sort(collect_list(struct(at, plain))), x -> x.plain), ' ')").alias("plain"))
    each = line.select("conv_id", "turn", *PLACE, "passage", "level", "plain", F.col("at").alias("order"))
    both = whole.select("conv_id", "turn", *PLACE, "passage", "level", "plain", F.lit(-1).alias("order")).unionByName(each)
    return both.select("conv_id", "turn", *PLACE, "passage", "level", "order", F.xxhash64("plain").alias("h1"), F.xxhash64(F.lit(1), F.col("plain")).alias("h2"))


def _asof(asked: DataFrame, source: DataFrame) -> DataFrame:
    """asked (conv_id, turn, h1, h2; distinct) with near: the latest earlier turn of source that has the hash in the conversation, as a struct; no such turn: null."""
    both = asked.withColumn("is_source", F.lit(0)).unionByName(source.withColumn("is_source", F.lit(1))).withColumn("part", _stretch())
    key = ["conv_id", "h1", "h2"]
    turn = F.when(F.col("is_source") == 1, F.struct(F.lit(1).alias("is"), "turn"))
    before = Window.partitionBy(*key, "part").orderBy(_by_turn(), "is_source").rowsBetween(Window.unboundedPreceding, -1)
    parts = both.groupBy(*key, "part").agg(F.max(turn).alias("last"))
    over = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("conv_id").alias("c"), "h1", "h2", "part", F.max("last").over(over).alias("far_back"))
    here = both.withColumn("here", F.max(turn).over(before)).where("is_source = 0").join(parts.where("far_back is not null").withColumnsRenamed({"h1": "p1", "h2": "p2", "part": "p"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("p1")) & (F.col("h2") == F.col("p2")) & (F.col("part") == F.col("p")), "left")
    return here.select(*key, "turn", F.coalesce("here", "far_back").alias("near"))


def links(rows: DataFrame, shared: Shared) -> DataFrame:
    """place, passage, level, linked, inside, source_conv, source_turn of every quoted passage; no source: null."""
    every = shared.table(units(rows))
    quoted = every.where("level > 0")
    wanted = quoted.select("h1", "h2").distinct()
    source = shared.table(every.where("level = 0").join(wanted, ["h1", "h2"], "left_semi").select("conv_id", "turn", "h1", "h2").distinct())
    near = shared.table(_asof(quoted.select("conv_id", "turn", "h1", "h2").distinct(), source))
    near = near.where("near is not null").toDF("c", "n1", "n2", "t", "near")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2"))
    far = source.groupBy("h1", "h2").agg(F.min(F.struct(F.col("conv_id").isNull().alias("no"), "conv_id", F.col("turn").isNotNull().alias("has"), "turn")).alias("far"))
    found = quoted.join(near, same, "left").drop("c", "t", "n1", "n2").join(far, ["h1", "h2"], "left")
    # the conversation's own sources go first; of each, the whole passage, then its lines in order
    best = F.min(F.when(F.col("near").isNotNull(), F.struct(F.lit(0).alias("k"), "order", F.col("conv_id"), F.col("near.turn").alias("turn"))))
    else_ = F.min(F.when(F.col("far").isNotNull(), F.struct(F.lit(1).alias("k"), "order", F.col("far.conv_id").alias("conv_id"), F.col("far.turn").alias("turn"))))
    linked = found.groupBy(*PLACE, "passage", "level").agg(best.alias("near"), else_.alias("far")).withColumn("s", F.coalesce("near", "far"))
    return linked.select(*PLACE, "passage", "level", F.col("s").isNotNull().alias("linked"), F.col("near").isNotNull().alias("inside"), F.col("s.conv_id").alias("source_conv"), F.col("s.turn").alias("source_turn"))


def _placed_in_conversation(rows: DataFrame) -> DataFrame:
    """place, k (from 1, by turn) and previous (the turn before) within the conversation."""
    slim = rows.select("conv_id", "turn", "role", "own", *PLACE).withColumn("part", _stretch())
    inside = Window.partitionBy("conv_id", "part").orderBy(_by_turn(), "role", "own", *PLACE)
    parts = slim.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.max("turn").alias("last"))
    over = Window.partitionBy("conv_id").orderBy("part")
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.lag("last").over(over).alias("before"))
    parts = parts.withColumnsRenamed({"conv_id": "c", "part": "p"})
    # a turn's predecessor is the greatest smaller turn, so messages with equal turns share it
    smaller = F.max("turn").over(Window.partitionBy("conv_id", "part").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1))
    slim = slim.withColumn("k", F.row_number().over(inside)).withColumn("smaller", smaller)
    out = slim.join(parts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return out.select(*PLACE, (F.col("base") + F.col("k")).alias("k"), F.coalesce("smaller", "before").alias("previous"))


def tree_order(nodes: DataFrame, shared: Shared) -> DataFrame:
    """c, k, position of nodes (c, k, parent): depth first from 1, children by k; parent: the k of another node, less than k; none: null.

    A node is followed by its first child, else by the next sibling of the nearest node
    up its branch that has one. Both that node and the places in the list so made are
    found by doubling: every pointer is replaced by its target's until nothing changes.
    """
    nodes = shared.table(nodes.withColumn("up", F.coalesce("parent", F.lit(-1).cast("bigint"))).withColumn("part", _stretch("k")))
    key = ["c", "up"]
    first = nodes.groupBy(*key, "part").agg(F.min("k").alias("least"))
    after = first.select(*key, "part", F.lead("least").over(Window.partitionBy(*key).orderBy("part")).alias("next_part"))
    sibling = nodes.withColumn("near", F.lead("k").over(Window.partitionBy(*key, "part").orderBy("k"))).join(after, [*key, "part"])
    child = first.groupBy(*key).agg(F.min("least").alias("child")).withColumnRenamed("up", "k")
    now = sibling.select("c", "k", "parent", F.coalesce("near", "next_part").alias("sibling")).join(child, ["c", "k"], "left")
    now = shared.table(now.withColumn("at", F.when(F.col("sibling").isNotNull() | F.col("parent").isNull(), F.col("k")).otherwise(F.col("parent"))))

    def targets(table: DataFrame, pointer: str, *columns: str) -> DataFrame:
        return table.select(F.col("c").alias("tc"), F.col("k").alias("tk"), *(F.col(x).alias(f"t_{x}") for x in columns)), (F.col("c") == F.col("tc")) & (F.col(pointer) == F.col("tk"))

    while True:
        there, met = targets(now, "at", "at")
        step = shared.table(now.join(there, met, "left").withColumn("moved", F.col("at") != F.col("t_at")).withColumn("at", F.col("t_at")).drop("tc", "tk", "t_at"))
        shared.drop(now)
        now = step
        if now.where("moved").isEmpty():
            break
    there, met = targets(now, "at", "sibling")
    listed = now.join(there, met, "left").select("c", "k", F.coalesce("child", "t_sibling").alias("next"))
    now = shared.table(listed.withColumn("left", F.when(F.col("next").isNull(), 0).otherwise(1).cast("bigint")))
    while not now.where("next is not null").isEmpty():
        there, met = targets(now, "next", "next", "left")
        step = shared.table(now.join(there, met, "left").select("c", "k", F.col("t_next").alias("next"), (F.col("left") + F.coalesce("t_left", F.lit(0))).alias("left")))
        shared.drop(now)
        now = step
    size = now.groupBy("c").agg(F.count("*").alias("n"))
    return now.join(size, "c").select("c", "k", (F.col("n") - F.col("left")).alias("position"))


def replies(messages: DataFrame, shared: Shared) -> DataFrame:
    """conv_id, position, turn, role, text (without quotes), reply_turn, n_quoted, n_linked, links, place of each message.

    links: of each linked passage, in order, passage (its first line's number), source_conv and source_turn.
    """
    rows = shared.table(parsed(placed(messages, shared)))
    found = links(rows.select("conv_id", "turn", *PLACE, "lines"), shared)
    first = F.min(F.when(F.col("inside"), F.struct("level", "passage", F.col("source_turn").alias("turn"))))
    each = F.sort_array(F.collect_list(F.when(F.col("linked"), F.struct("passage", "source_conv", "source_turn")))).alias("links")
    by = found.groupBy(*PLACE).agg(F.count("*").alias("n_quoted"), F.count_if("linked").alias("n_linked"), first.alias("reply"), each)
    out = rows.drop("lines").join(_placed_in_conversation(rows), PLACE).join(by, PLACE, "left")
    out = out.withColumn("reply_turn", F.when(F.col("reply").isNotNull(), F.col("reply.turn")).otherwise(F.col("previous")))
    out = shared.table(out.withColumn("c", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("none"))))
    odd = shared.table(out.where("not (reply_turn <=> previous)").select("c").distinct())
    if odd.isEmpty():
        out = out.withColumn("position", F.col("k"))
    else:
        some = out.select("c", "k", "turn", "reply_turn").join(odd, "c", "left_semi")
        heads = some.where("turn is not null").groupBy("c", "turn").agg(F.min("k").alias("parent")).withColumnsRenamed({"c": "hc", "turn": "head"})
        nodes = some.join(heads, (F.col("c") == F.col("hc")) & (F.col("reply_turn") == F.col("head")), "left").select("c", "k", "parent")
        out = out.join(tree_order(nodes, shared), ["c", "k"], "left").withColumn("position", F.coalesce("position", "k"))
    zero = F.lit(0)
    return out.select("conv_id", "position", "turn", "role", F.col("own").alias("text"), "reply_turn", F.coalesce("n_quoted", zero).alias("n_quoted"), F.coalesce("n_linked", zero).alias("n_linked"), "links", *PLACE)


def op4_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, position, turn, role, text, reply_turn, n_quoted, n_linked, links (passage:conv:turn, comma-joined) of every message."""
    found = replies(read(spark, sf_dir, "conversations"), Shared(spark, "quotes")).drop(*PLACE)
    written = "array_join(transform(coalesce(links, array()), x -> concat(x.passage, ':', coalesce(cast(x.source_conv as string), ''), ':', coalesce(cast(x.source_turn as string), ''))), ',')"
    return found.withColumn("links", F.expr(written))


SQL = r"""
with recursive line as (
  select conv_id, turn, role, i as pos, len(regexp_replace(regexp_extract(l[i], '^(?:[\x20\x09]*>)+'), '[^>]', '', 'g')) as level,
    regexp_replace(l[i], '^(?:[\x20\x09]*>)+[\x20\x09]?', '') as body
  from (select *, unnest(range(1, len(l) + 1)) as i from (select conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) as l from conversations))),
own as (
  select conv_id, turn, role, regexp_replace(coalesce(string_agg(body, chr(10) order by pos) filter (level = 0), ''), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as text
  from line group by all),
plain as (select conv_id, turn, pos, level, trim(lower(regexp_replace(body, '[\x20\x09-\x0D]+', ' ', 'g'))) as plain from line),
step as (
  select *, coalesce(lag(pos) over w = pos - 1 and lag(level) over w = level, false) as goes_on from plain where plain <> '' window w as (partition by conv_id, turn order by pos)),
member as (select *, max(case when not goes_on then pos end) over (partition by conv_id, turn order by pos) as passage from step),
unit as (
  select conv_id, turn, passage, level, -1 as ord, string_agg(plain, ' ' order by pos) as plain from member group by all
  union all select conv_id, turn, passage, level, pos as ord, plain from member),
source as (select distinct conv_id, turn, plain from unit where level = 0),
inside as (
  select q.conv_id, q.turn, q.passage, q.level, q.ord, max(s.turn) as s_turn from unit q join source s on s.conv_id = q.conv_id and s.plain = q.plain and s.turn < q.turn where q.level > 0 group by all),
first_of as (select plain, min(struct_pack(c := conv_id, t := turn)) as f from source group by plain),
anywhere as (select q.conv_id, q.turn, q.passage, arg_min(f, q.ord) as f from unit q join first_of using (plain) where q.level > 0 group by all),
best as (select conv_id, turn, passage, level, arg_min(s_turn, ord) as s_turn from inside group by all),
quoted as (select conv_id, turn, count(*) as n_quoted from (select distinct conv_id, turn, passage from unit where level > 0) group by all),
linked as (
  select conv_id, turn, count(*) as n_linked, string_agg((passage - 1) || ':' || c || ':' || t, ',' order by passage) as links
  from (select conv_id, turn, passage, case when s_turn is null then f['c'] else conv_id end as c, coalesce(s_turn, f['t']) as t from anywhere full join best using (conv_id, turn, passage)) group by all),
reply as (select conv_id, turn, arg_min(s_turn, level * 1000000000 + passage) as reply_turn from best group by all),
message as (
  select o.*, row_number() over (partition by o.conv_id order by o.turn, o.role, o.text) as k, coalesce(r.reply_turn, lag(o.turn) over (partition by o.conv_id order by o.turn)) as reply_turn
  from own o left join reply r using (conv_id, turn)),
branch as (
  select conv_id, turn, k, [k] as path from message where reply_turn is null
  union all select m.conv_id, m.turn, m.k, list_append(b.path, m.k) from message m join branch b on m.conv_id = b.conv_id and m.reply_turn = b.turn),
placed as (select conv_id, k, row_number() over (partition by conv_id order by path) as position from branch)
select conv_id, cast(position as bigint) as position, turn, role, text, reply_turn,
  cast(coalesce(n_quoted, 0) as bigint) as n_quoted, cast(coalesce(n_linked, 0) as bigint) as n_linked, coalesce(links, '') as links
from message join placed using (conv_id, k) left join quoted using (conv_id, turn) left join linked using (conv_id, turn)
"""
