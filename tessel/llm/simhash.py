"""SimHash near-duplicates by deletion-variant signatures.

Each whole text gets a 64-bit fingerprint of its word shingles. Two fingerprints that
differ by at most three bits agree, in one of their two 32-bit segments, but for at most
one bit; so each segment is indexed under 32 variants, each with one bit blanked, and
fingerprints that meet under an equal variant are verified by their whole distance.

Only distinct fingerprints are indexed (exact copies cost one row before the shuffle).
Under a variant a spanning forest of the verified links is kept, never all pairs. A
variant shared by more than `most` fingerprints is not swept at once: its members are
dealt anew by one-wildcard variants of the halves of the other segment, then of the
quarters, after which a bucket can't exceed 2048 members, as its members differ in 11
bits at most. The same pigeonhole holds at each level, so no link is lost.

Defined cases: a null or empty text has fingerprint zero and links like any other; a
text of fewer words than a shingle has its whole sequence as the one shingle; repeated
rows stay rows; a null doc_id takes part in links but is never a component's id unless
its component has no other (then null); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm import jaccard
from tessel.llm.common import PLACE, Shared, placed, read, spread, text_of, unmoved
from tessel.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Distinct fingerprints under one variant that are swept in one go.
MOST = 2048

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, 255 rows at a time in byte lanes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(hashes), 255), axis=0)
    return lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: str, shingle: int = SHINGLE, chunk: int = 1 << 15) -> int:
    """The fingerprint as an unsigned number."""
    import xxhash

    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(min(shingle, len(words)))), strict=False))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, dtype=np.int64), 0
    while got := [digest(x, SEED) for x in islice(shingles, chunk)]:
        counts += _bit_counts(np.array(got, dtype="<u8"))
        n += len(got)
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist()))


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(0)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(got.view(np.int64))], names=[*batch.schema.names[1:], "fp"])

    return run


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns `keep`, and fp (the fingerprint as a signed long)."""
    rows = docs.select(text_of().alias("text"), *keep)
    return rows.mapInArrow(_fingerprints(shingle), rows.select(*keep).schema.add("fp", "long"))


def tree(values: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of distinct values within `distance` bits of each other."""
    left = np.arange(len(values))
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= distance
            found = left[near]
            left = left[~near]
            for k in found.tolist():
                yield at, k
            todo += found.tolist()


def _sweep(distance: int, most: int):
    """Runs of equal keys, in sorted rows (key, fp): links within a run, or the run's rows if it is too long."""

    def links(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
        size = np.diff(np.append(start, len(keys)))
        two = start[size == 2]
        near = two[np.bitwise_count((fps[two] ^ fps[two + 1]).view(np.uint64)) <= distance]
        a, b = [fps[near]], [fps[near + 1]]
        more = size > 2
        for s, m in zip(start[more].tolist(), size[more].tolist(), strict=True):
            run = fps[s : s + m]
            if pairs := list(tree(run.view(np.uint64), distance)):
                x, y = np.array(pairs).T
                a.append(run[x])
                b.append(run[y])
        return np.concatenate(a), np.concatenate(b)

    def out(key, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()) if key is None else pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        put_off: int | None = None  # the key whose rows go to the next level
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            while len(keys):
                if keys[0] == put_off:
                    n = int(np.searchsorted(keys, put_off, side="right"))
                    yield out(keys[:n], fps[:n], fps[:n])
                    keys, fps = keys[n:], fps[n:]
                    continue
                first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
                size = np.diff(np.append(first, len(keys)))
                long = np.flatnonzero(size > most)
                if len(long):
                    put_off = int(keys[first[long[0]]])
                    n = int(first[long[0]])
                else:
                    n = int(first[-1])  # the last run may go on
                if n:
                    yield out(None, *links(keys[:n], fps[:n]))
                    keys, fps = keys[n:], fps[n:]
                elif not len(long):
                    break
        if len(keys):
            yield out(None, *links(keys, fps))

    return run


def _swept(variants: DataFrame, distance: int, most: int) -> DataFrame:
    return spread(variants, "key").sortWithinPartitions("key").mapInArrow(_sweep(distance, most), "key bigint, a bigint, b bigint")


def links(distinct: DataFrame, shared: Shared, distance: int = DISTANCE, most: int = MOST) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) within `distance`, which is 3 at most."""
    if distance > 3:
        raise ValueError("two segments of which one differs by at most one bit allow a distance of 3")
    one = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i")).select(
        F.expr("(cast(i as bigint) << 32) | ((if(i < 32, shiftrightunsigned(fp, 32), fp & 4294967295L)) & ~(1L << (i % 32)))").alias("key"), "fp"
    )
    first = shared.table(_swept(one, distance, most))
    # the other segment: two halves, 16 wildcards each
    late = first.where("key is not null").select("key", F.col("a").alias("fp"))
    two = late.select("key", "fp", F.expr("if(shiftrightunsigned(key, 32) < 32, fp & 4294967295L, shiftrightunsigned(fp, 32))").alias("rest"), F.explode(F.sequence(F.lit(0), F.lit(31))).alias("i"))
    two = two.select(F.expr("(key << 21) | (cast(i as bigint) << 16) | ((if(i < 16, shiftrightunsigned(rest, 16), rest & 65535L)) & ~(1L << (i % 16)))").alias("key"), "fp")
    second = shared.table(_swept(two, distance, most))
    # the other half: two quarters, 8 wildcards each; such buckets are bounded
    late = second.where("key is not null").select("key", F.col("a").alias("fp"))
    segment, half = "shiftrightunsigned(key, 53)", "(shiftrightunsigned(key, 16) & 31)"
    rest = f"if({segment} < 32, fp & 4294967295L, shiftrightunsigned(fp, 32))"
    three = late.select("key", "fp", F.expr(f"if({half} < 16, ({rest}) & 65535L, shiftrightunsigned(({rest}), 16))").alias("rest"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("i"))
    three = three.select(F.expr("xxhash64(key, i, (if(i < 8, shiftrightunsigned(rest, 8), rest & 255L)) & ~(1L << (i % 8)))").alias("key"), "fp")
    third = _swept(three, distance, 1 << 30)
    found = [t.where("key is null").select("a", "b") for t in (first, second, third)]
    return found[0].unionByName(found[1]).unionByName(found[2]).distinct()


def classes(prints: DataFrame, shared: Shared, distance: int = DISTANCE, most: int = MOST) -> DataFrame:
    """(fp, component_id) of each distinct fingerprint in `prints` (doc_id, fp)."""
    least = shared.table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    nodes = components(links(least.select("fp"), shared, distance, most), shared)
    rooted = least.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    # written first: a join on its own exchange may be split where one component is large
    ids = shared.table(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    return rooted.join(ids, "root").select("fp", "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every document."""
    shared = Shared(spark, "simhash")
    prints = shared.table(fingerprints(read(spark, sf_dir, "documents"), ["doc_id"]))
    found = classes(prints, shared)
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (see jaccard) stays: the one of the least doc_id, then place."""
    shared = Shared(spark, "simhash")
    docs = placed(docs, shared)
    prints, found = jaccard.classes(docs, shared)
    grouped = prints.join(found, "node")
    # a null doc_id comes after all others
    place = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id"), *PLACE)
    first = shared.table(grouped.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("root", "first"))
    later = grouped.join(first, "root").where(place != F.col("first")).select(*PLACE)
    return unmoved(docs, shared.table(later), shared, "left_anti").drop(*PLACE)
