"""Approximate nearest neighbours by inner product, by collision counting on sorted projections.

Each vector gets one further component, which makes all lengths equal (so the largest
inner product is the least distance), and is projected on `LINES` orthonormal lines. A
block of the index is one sorted array for each line. A query opens a window around its
own projection on every line and widens all windows together (virtual rehashing: the
same arrays at any radius), counting for each vector the lines on which it lies inside.
A vector within the radius lies in a window of `REACH` mean deviations with known
probability; those whose count reaches that expectation less `SLACK` deviations are
verified by the exact inner product. A query stops at the radius within which as many
verified vectors as asked for lie, or when its windows hold everything. While windows are
narrow, their new entries are counted one by one; once they hold an eighth of the block,
each vector's rank on a line is held against the window's two ends instead (ranks fit 16
bits), which counts the same collisions by a few operations on whole arrays.

Every row is indexed; nothing is fitted but the greatest length. Equal vectors are one
class with its k + 1 least ids (no more can be among k neighbours, ties going to the
smaller id), cut before the shuffle, so a third of all rows being one vector costs one
row. Index and queries are met block by block; a unit's memory is two blocks, and an
index block is sorted once for every 4096 queries. Scores are sums of products in order of
the components, in double precision, so they are the same wherever they are computed.

Defined cases: vectors that are null, zero or hold null or non-finite components take no
part, nor do rows without an id; vectors of another dimension are searched among
themselves; rows repeated with the same id count once; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel.llm.common import Shared, read

K = 20
LINES = 64
REACH = 1.5
SLACK = 1.6
#: First radius, as a share of the greatest length, and the factor between radii.
FIRST, STEP = 0.05, math.sqrt(2)
INDEX_BLOCK, QUERY_BLOCK = 32_768, 4096
SEED = 5


def lines(dim: int, n: int = LINES, seed: int = SEED) -> np.ndarray:
    """n unit vectors of dim components, orthonormal in runs of dim."""
    rng, out = np.random.default_rng(seed), []
    while sum(len(q) for q in out) < n:
        out.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0].T)
    return np.concatenate(out)[:n]


def lengthen(x: np.ndarray, longest: float) -> np.ndarray:
    """One component more, so that all rows are `longest` long."""
    rest = np.sqrt(np.maximum(longest * longest - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


class Index:
    """Sorted projections of a block of vectors."""

    def __init__(self, vectors: np.ndarray, longest: float, n_lines: int = LINES):
        self.vectors, self.longest = vectors, longest
        self.dim = vectors.shape[1] + 1
        self.lines = lines(self.dim, n_lines)
        projected = (lengthen(vectors, longest) @ self.lines.T).T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self.narrow = len(vectors) < 1 << 16  # blocks of that many rows are never made, but may be asked for
        self.rank = np.empty(self.order.shape, dtype=np.uint16 if self.narrow else np.uint32)
        np.put_along_axis(self.rank, self.order, np.arange(len(vectors), dtype=self.rank.dtype)[None, :], axis=1)
        inside = math.erf(REACH / math.sqrt(2))
        self.least = math.floor(n_lines * inside - SLACK * math.sqrt(n_lines * inside * (1 - inside)))
        # beyond the last radius every window holds everything
        count = math.ceil(math.log(2.5 * math.sqrt(self.dim) / (FIRST * REACH), STEP)) + 1
        self.radii = FIRST * longest * STEP ** np.arange(count) if longest else np.zeros(1)

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, rows that were verified and their inner products, the k best and all ties of the last."""
        at = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1) @ self.lines.T
        n_lines, n = self.order.shape
        half = REACH * self.radii / math.sqrt(self.dim)
        low = np.empty((len(queries), n_lines, len(half)), dtype=np.int64)
        high = np.empty_like(low)
        for j in range(n_lines):
            low[:, j] = np.searchsorted(self.sorted[j], at[:, j, None] - half, side="left")
            high[:, j] = np.searchsorted(self.sorted[j], at[:, j, None] + half, side="right")
        norms = (queries * queries).sum(axis=1)
        return [self._one(q, low[i], high[i], norms[i], k) for i, q in enumerate(queries)]

    def _one(self, q: np.ndarray, low: np.ndarray, high: np.ndarray, norm: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        n_lines, n = self.order.shape
        kind = self.rank.dtype.type
        count = np.zeros(n, dtype=np.int64)
        fresh = np.ones(n, dtype=bool)
        rows, scores = np.empty(0, dtype=np.int64), np.empty(0)
        a = b = (low[:, 0] + high[:, 0]) // 2
        wide = False
        for level, radius in enumerate(self.radii.tolist()):
            c, d = np.minimum(low[:, level], a), np.maximum(high[:, level], b)
            wide = wide or (d - c).sum() * 8 > n_lines * n
            if wide:
                # inside from rank c to d - 1: by one comparison of the unsigned difference
                width = (d - c).astype(np.int64)
                inside = (self.rank - c.astype(kind)[:, None]) < np.minimum(width, np.iinfo(kind).max).astype(kind)[:, None]
                count = inside.sum(axis=0, dtype=np.uint8 if n_lines < 256 else np.int64)
            else:
                parts = []
                for line, a_, b_, c_, d_ in zip(self.order, a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True):
                    if c_ < a_:
                        parts.append(line[c_:a_])
                    if b_ < d_:
                        parts.append(line[b_:d_])
                if parts:
                    count += np.bincount(np.concatenate(parts), minlength=n)
            a, b = c, d
            found = np.flatnonzero((count >= self.least) & fresh)
            if len(found):
                fresh[found] = False
                rows = np.concatenate([rows, found])
                scores = np.concatenate([scores, self.vectors[found] @ q])
            # distance² = |q|² + longest² - 2 q·x
            if (scores >= (norm + self.longest**2 - radius * radius) / 2).sum() >= k:
                break
        if len(rows) > k:
            last = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = scores >= last - 1e-9 * max(1.0, abs(last))  # a product's rounding may part equal scores
            rows = rows[keep]
        return rows, np.cumsum(self.vectors[rows] * q, axis=1)[:, -1] if len(rows) else np.empty(0)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of double), h1 and h2 (its class) of the rows that take part."""
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = "not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)"
    return rows.where(fine).select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64("v", F.lit(1)).alias("h2"))


def _search(k: int):
    def run(key: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        none = {"q1": pa.int64(), "q2": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        if not index.num_rows or not queries.num_rows:
            return pa.table({c: pa.array([], t) for c, t in none.items()})
        matrix = lambda t: t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        ids = index["ids"].to_pylist()
        block = Index(matrix(index), index["longest"][0].as_py())
        out: tuple[list, list, list, list] = ([], [], [], [])
        for q1, q2, (rows, scores) in zip(queries["h1"].to_pylist(), queries["h2"].to_pylist(), block.search(matrix(queries), k + 1), strict=True):
            # by score, then id; equal scores of different classes interleave their ids
            best = sorted((-s, i) for r, s in zip(rows.tolist(), scores.tolist(), strict=True) for i in ids[r])[: k + 1]
            out[0].extend([q1] * len(best))
            out[1].extend([q2] * len(best))
            out[2].extend(i for _, i in best)
            out[3].extend(-s for s, _ in best)
        return pa.table([pa.array(c, t) for c, t in zip(out, none.values(), strict=True)], names=list(none))

    return run


def nearest(vectors: DataFrame, queries: DataFrame, shared: Shared, k: int = K, index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of `vectors` (vec_id, embedding) to each of `queries`, its own id aside."""
    rows = usable(vectors)
    first = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    members = rows.distinct().withColumn("n", first).where(F.col("n") <= k + 1)
    classes = shared.table(members.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = shared.table(usable(queries).select("vec_id", "v", "h1", "h2").distinct())
    kinds = shared.table(asked.groupBy("h1", "h2").agg(F.first("v").alias("v")))
    longest, n = classes.agg(F.max(F.expr("sqrt(aggregate(v, 0D, (s, x) -> s + x * x))")), F.count("*")).first()
    n_index, n_query = max(1, -(-n // index_block)), max(1, -(-kinds.count() // query_block))
    left = classes.select("v", "ids", F.lit(longest or 0.0).alias("longest"), F.size("v").alias("dim"), F.pmod("h2", F.lit(n_index)).alias("i"), F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))).alias("j"))
    right = kinds.select("v", "h1", "h2", F.size("v").alias("dim"), F.pmod("h2", F.lit(n_query)).cast("int").alias("j"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_index - 1).cast("bigint"))).alias("i"))
    unit = ["dim", "i", "j"]
    met = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(_search(k), "q1 bigint, q2 bigint, vec_id bigint, score double")
    met = shared.table(met)
    order = F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id"))
    best = met.withColumn("n", order).where(F.col("n") <= k + 1).groupBy("q1", "q2").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best"))
    found = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2").join(best, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")))
    others = F.expr(f"slice(filter(best, b -> b.vec_id <> query_id), 1, {k})")
    return found.select("query_id", F.posexplode(others).alias("p", "b")).select("query_id", (F.col("p") + 1).alias("rank"), "b.vec_id", "b.score")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score of the 20 nearest to every vector whose id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), Shared(spark, "neighbours"))


#: Every candidate of every query, by the same sums in order.
SQL = """
with usable as (
  select distinct cast(vec_id as bigint) as vec_id, cast(embedding as double[]) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score from usable q join usable c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= 20
"""
