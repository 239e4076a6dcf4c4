"""Mixing sources to target weights by cube-method balanced sampling.

A source's target is a share of all words by its weight, at most `most` times its own
words; the excess goes to the others by weight until no target is above. As target =
min(most * size, level * weight), the level is found from one pass over the sources in
order of size by weight.

A source that is to give r times its words gives floor(r) copies of every document and
one more of a balanced sample, whose inclusion probability is the fractional part for
each document. The sample is drawn by the cube method: three undecided documents at a
time are moved along the null space of the two constraints (words and documents taken),
so both totals stay exact, until one of them is decided. That runs on blocks of a source,
dealt by hash, which leaves at most two documents of each undecided; those flow together
in blocks again, and the last ones of a source are landed on the choice nearest to its
totals, with a few swaps inside the last block where a long document leaves a gap. No task holds more than a block, however large the source.

Defined cases: a null text has size 0; a null source is one source, after all others;
a null doc_id is mixed like any other row; repeated rows are separate units; sources
without words have target 0; an empty table gives an empty result; other columns are
ignored. Draws depend on ids, sizes and the seed alone, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel.llm.common import PLACE, Shared, placed, read, spread, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 8192
SEED = 7

_UNSURE = 1e-9


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Splitting bytes parts words at the same white space as the pattern [^\\x20\\x09-\\x0D]+."""
    for batch in batches:
        size = pa.array([len(x.as_py().encode("utf-8", "replace").split()) for x in batch.column(0)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], size], names=[*batch.schema.names[1:], "size"])


def sized(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep`, and size (words of the text)."""
    rows = docs.select(text_of().alias("text"), *keep)
    return rows.mapInArrow(_sizes, rows.select(*keep).schema.add("size", "long"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sources (source, size): with rank and target. One row per source is gathered in one task."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = Window.orderBy(F.col("size") / F.col("weight"), "rank")
    table = F.array(*(F.lit(float(w)) for w in weights))
    rows = sources.withColumn("rank", F.row_number().over(order)).withColumn("weight", F.element_at(table, (F.col("rank") - 1) % len(weights) + 1))
    whole = Window.partitionBy()
    rows = rows.select(
        "*",
        (share * F.sum("size").over(whole)).alias("wanted"),
        F.coalesce(F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"),
        F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)).alias("left"),
    ).withColumn("level", (F.col("wanted") - most * F.col("below")) / F.col("left"))
    # the first source, by size over weight, that its level doesn't lift above its bound
    free = F.when(F.col("level") * F.col("weight") <= most * F.col("size"), F.struct((F.col("size") / F.col("weight")).alias("r"), "rank", "level"))
    rows = rows.withColumn("first", F.min(free).over(whole))
    bound = most * F.col("size")
    return rows.select(
        "source", "rank", F.col("size").alias("source_size"), F.when(F.col("first").isNull(), bound).otherwise(F.least(bound, F.col("first.level") * F.col("weight"))).alias("target")
    )


def flight(p: list[float], x: list[float], rng: np.random.Generator) -> list[int]:
    """Moves p in place until at most two are undecided; these are returned. Sums of p and p*x stay."""
    draws = iter(())
    active: list[int] = []
    for i in range(len(p)):
        if not _UNSURE < p[i] < 1 - _UNSURE:
            p[i] = float(round(p[i]))
            continue
        active.append(i)
        if len(active) < 3:
            continue
        a, b, c = active
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = down = math.inf
        for k, v in zip(active, u, strict=True):
            if v > 0:
                up, down = min(up, (1 - p[k]) / v), min(down, p[k] / v)
            elif v < 0:
                up, down = min(up, p[k] / -v), min(down, (1 - p[k]) / -v)
        draw = next(draws, None)
        if draw is None:
            draws = iter(rng.random(4096).tolist())
            draw = next(draws)
        step = up if draw * (up + down) < down else -down
        for k, v in zip(active, u, strict=True):
            p[k] += step * v
        rest = []
        for k in active:
            if _UNSURE < p[k] < 1 - _UNSURE:
                rest.append(k)
            else:
                p[k] = float(round(p[k]))
        active = rest
    return active


def land(p: list[float], x: list[float], open_: list[int]) -> None:
    """Decides the last units by the choice whose totals of words, then of units, are nearest."""
    words, units = sum(p[k] * x[k] for k in open_), sum(p[k] for k in open_)

    def gap(choice: int) -> tuple[float, float, int]:
        taken = [k for j, k in enumerate(open_) if choice >> j & 1]
        return abs(sum(x[k] for k in taken) - words), abs(len(taken) - units), choice

    best = min(range(1 << len(open_)), key=gap)
    for j, k in enumerate(open_):
        p[k] = float(best >> j & 1)


def settle(p: list[float], x: list[float], free: list[int], wanted: float) -> None:
    """Swaps a taken unit for one that is not, while that brings the words nearer to the wanted sum (by half a word at least, so it ends)."""
    while True:
        over = sum(p[k] * x[k] for k in free) - wanted
        out = np.array([k for k in free if p[k] == 1], dtype=np.int64)
        in_ = np.array(sorted((k for k in free if p[k] == 0), key=lambda k: x[k]), dtype=np.int64)
        if not len(out) or not len(in_):
            return
        size = np.array([x[k] for k in in_])
        aim = np.array([x[k] for k in out]) - over
        right = np.minimum(np.searchsorted(size, aim), len(size) - 1)
        left = np.maximum(right - 1, 0)
        at = np.where(np.abs(size[left] - aim) <= np.abs(size[right] - aim), left, right)
        gap = np.abs(size[at] - aim)
        j = int(np.argmin(gap))
        if gap[j] >= abs(over) - 0.5:
            return
        p[int(out[j])], p[int(in_[at[j]])] = 0.0, 1.0


def _fly(last: bool, seed: int):
    """Runs of equal (rank, block) in sorted rows, with p moved; the last level lands."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        p, x = rows["p"].to_pylist(), [float(v) for v in rows["size"].to_pylist()]
        rng = np.random.default_rng([seed, rows["rank"][0].as_py(), rows["block"][0].as_py(), rows["u"][0].as_py() & (1 << 63) - 1])
        free = [k for k, v in enumerate(p) if _UNSURE < v < 1 - _UNSURE]
        wanted = sum(p[k] * x[k] for k in free)
        left = flight(p, x, rng)
        if last:
            land(p, x, left)
            settle(p, x, free, wanted)
        rows = rows.set_column(rows.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))
        return rows.combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            rank, number = batch["rank"].to_numpy(), batch["block"].to_numpy()
            cut = np.flatnonzero((np.diff(rank) != 0) | (np.diff(number) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if held and (held[-1]["rank"][0].as_py(), held[-1]["block"][0].as_py()) != (rank[a], number[a]):
                    yield block(pa.Table.from_batches(held))
                    held = []
                held.append(part)
        if held:
            yield block(pa.Table.from_batches(held))

    return run


def mix(units: DataFrame, shared: Shared, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """units (doc_id, source, size, ...) with source_size, target and copies."""
    sources = shared.table(units.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    aims = targets(sources, weights, share, most).join(sources.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    aims = shared.table(aims.withColumnRenamed("source", "aim").withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))))
    most_blocks = -(-(aims.agg(F.max("n")).first()[0] or 0) // block)
    now = units.join(aims, F.col("source").eqNullSafe(F.col("aim"))).select(
        *units.columns,
        "source_size",
        "target",
        "rank",
        F.floor("ratio").cast("int").alias("whole"),
        (F.col("ratio") - F.floor("ratio")).alias("p"),
        F.xxhash64("doc_id", "size", F.lit(seed)).alias("u"),
        F.expr(f"cast(ceil(n / {block}) as bigint)").alias("n_blocks"),
    )
    now = now.withColumn("block", F.expr("pmod(u, n_blocks)"))
    done = []
    while True:
        last = most_blocks <= 1
        flown = shared.table(spread(now, "rank", "block").sortWithinPartitions("rank", "block", "u", *units.columns).mapInArrow(_fly(last, seed), now.schema))
        if last:
            done.append(flown)
            break
        sure = (F.col("p") == 0) | (F.col("p") == 1)
        done.append(flown.where(sure))
        # at most two of each block are left; so many blocks flow together that a block is full again
        join = block // 2
        now = flown.where(~sure).withColumn("block", F.expr(f"block div {join}"))
        most_blocks = -(-most_blocks // join)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*units.columns, "source_size", "target", (F.col("whole") + F.col("p").cast("int")).alias("copies"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    shared = Shared(spark, "mixing")
    units = shared.table(sized(read(spark, sf_dir, "documents"), ["doc_id", "source"]))
    return mix(units, shared).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    shared = Shared(spark, "mixing")
    docs = placed(docs, shared)
    units = shared.table(sized(docs, ["doc_id", "source", *PLACE]))
    taken = mix(units, shared).where("copies > 0").select(F.col("copies").alias("__copies"), *PLACE)
    # about as many rows as documents: never worth a broadcast
    rows = docs.join(taken.hint("merge"), PLACE)
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).drop("__copies", "__copy", *PLACE)
