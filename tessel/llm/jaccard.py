"""Near copies by word shingles: SimHash candidates by deletion-variant signatures, verified by exact Jaccard similarity.

A text's set holds the hashes of its 5-word shingles; two texts are near copies if the
similarity of their sets is 0.8 at least. Texts of equal sets are one node. The steps are
those of simhash, at a wider reach: a set has `PRINTS` fingerprints of 64 bits in place of
one, each of two 32-bit segments, and two sets meet where some segment of theirs agrees
but for at most one bit. A segment is dealt by its exact half and swept under the 16
variants of the other half, each with one bit blanked; whoever meets under a variant, and
differs in at most `FAR` of the first 128 bits, is linked. Each task keeps a spanning
forest of its links, and alternating stars make groups of them. Two sets of similarity 0.8
differ in 15 % of the bits, agree so in a segment with a probability of 0.037, and in none
of the 256 with 7e-5; at 0.85 that is 2e-8. Sets of at most `SMALL` shingles, whose few
signs make it likelier, also meet by the exact variants: the set, and it without one member.

A group then holds its near copies and others, so its sets are compared: with a drawn hub
first, twice, then those outside the largest component with all of the group, in blocks of
bounded rows and bytes. What is linked is verified on whole sets, so no wrong link is made,
and near copies in one group are found whether or not they met themselves.

A node of whose shingles more than a fifth occur in no other node can't reach 0.8. That is
tested before any fingerprint is made, on its `SAMPLE` least hashes, about: those below a
bound that falls with the size of a set, of which only hashes below the bound of the
largest possible partner are judged, so that the partner shows all that it shares. A set
that isn't wholly judged may exceed the fifth by six standard deviations (lost: 1e-7).

Defined cases as in simhash: null and empty texts are near copies of each other only; a
text of fewer words than a shingle has its whole sequence as the one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tessel.llm.common import PLACE, Shared, spread, text_of, unmoved
from tessel.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
#: Fingerprints of a set, and how many of them are swept in each round. A round knows what those before it have
#: connected: few fingerprints connect a large group, so that it doesn't give links anew in each task of the rest.
PRINTS = 128
SWEEPS = (2, 14, 112)
#: Bits of the first two fingerprints in which a pair may differ: at similarity 0.8 more have a probability of 1e-7.
FAR = 42
SMALL = 5
#: Shingles by which a set is tested for what it shares, about.
SAMPLE = 64
ROUNDS = 2
#: Rows and bytes of shingles (eight for each) of a block of a large group.
BLOCK_ROWS, BLOCK_BYTES = 512, 4 << 20
#: Rows that are swept in one go, up to the next key.
CHUNK = 1 << 16

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_DRAWN = np.random.default_rng(42)
_SEEDS = _DRAWN.integers(0, 1 << 63, PRINTS, dtype=np.uint64)
_ODD = _DRAWN.integers(0, 1 << 62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Each 64-bit number's bits spread over all of it."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str) -> np.ndarray:
    """Hashes of the text's 5-word shingles, sorted, each once."""
    import xxhash

    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(SHINGLE, len(hashes))
    n = len(hashes) - k + 1
    total = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * _ODD[i]
    return np.unique(_mixed(total))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Exact Jaccard similarity of two sets; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def _set_bits(words: np.ndarray) -> np.ndarray:
    """How many rows have each bit of each column set: rows of equal weight are added by threes into a sum and a carry."""
    counts = np.zeros((words.shape[1], 64), dtype=np.int64)
    weight = 0
    while len(words):
        carries = [words[:0]]
        while len(words) > 2:
            m = len(words) // 3
            a, b, c = words[:m], words[m : 2 * m], words[2 * m : 3 * m]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            words = np.concatenate([odd ^ c, words[3 * m :]])
        for row in words:
            counts += np.unpackbits(row.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64) << weight
        words = np.concatenate(carries)
        weight += 1
    return counts


def fingerprints(found: np.ndarray, chunk: int = 512) -> np.ndarray:
    """The set's fingerprints: a bit is set if it is in over half of the shingles' hashes under that fingerprint's seed."""
    counts = np.zeros((PRINTS, 64), dtype=np.int64)
    for s in range(0, len(found), chunk):
        counts += _set_bits(_mixed(found[s : s + chunk, None] ^ _SEEDS[None, :]))
    return np.packbits(2 * counts > len(found), axis=1, bitorder="little").view("<u8")[:, 0]


def _below(n: float) -> int:
    """The bound of hashes that a set of n shingles shows."""
    return min((1 << 64) - 1, int((1 << 64) * (SAMPLE / max(n, SAMPLE))))


def shown(found: np.ndarray) -> tuple[np.ndarray, int]:
    """The least hashes of a set, and how many of them its largest possible partner shows too."""
    n = len(found)
    least = found[: n if n <= SAMPLE else int(np.searchsorted(found, np.uint64(_below(n))))]
    most = n / SIMILARITY
    return least, len(least) if most <= SAMPLE else int(np.searchsorted(least, np.uint64(_below(most))))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        nodes, sizes, samples, judged = [], [], [], []
        for x in batch.column(0):
            found = shingle_set(x.as_py())
            nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
            sizes.append(len(found))
            least, m = shown(found)
            samples.append(least.view(np.int64))
            judged.append(m)
        made = [pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(samples, pa.list_(pa.int64())), pa.array(judged, pa.int32())]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*batch.schema.names[1:], "node", "n", "sample", "judged"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's set, its fingerprints, and the exact variants of a small set."""
    import xxhash

    for batch in batches:
        found = [shingle_set(x.as_py()) for x in batch.column(0)]
        prints = [fingerprints(x).tobytes() for x in found]
        kept = [[x, *(np.delete(x, i) for i in range(len(x)))] if 0 < len(x) <= SMALL else [] for x in found]
        small = [np.array([xxhash.xxh64_intdigest(v.tobytes()) for v in x], dtype=np.uint64).view(np.int64) for x in kept]
        made = [pa.array([x.tobytes() for x in found], pa.binary()), pa.array(prints, pa.binary()), pa.array(small, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(1), *made], names=["node", "found", "prints", "small"])


def _dealt(first: int, end: int):
    """Rows (prints, root) by half segment: at (fingerprint, segment, half, its 16 bits, those of the other half), root, and the first 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        which = (np.arange(first, end)[:, None] * 4 + np.arange(4)).reshape(1, -1)
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                prints = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<u8").reshape(-1, PRINTS)
                part = np.ascontiguousarray(prints[:, first:end]).view("<u2").astype(np.int64).reshape(batch.num_rows, -1, 2, 2)
                at = (which << 32) | (part.reshape(batch.num_rows, -1) << 16) | part[:, :, :, ::-1].reshape(batch.num_rows, -1)
                m = at.shape[1]
                columns = [at.reshape(-1), np.repeat(batch.column(1).to_numpy(), m), np.repeat(prints[:, 0].view(np.int64), m), np.repeat(prints[:, 1].view(np.int64), m)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["at", "root", "c0", "c1"])

    return run


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64) <= FAR


def spanning(check: np.ndarray, step: int = 1024) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of rows that are near each other."""
    left = np.arange(len(check))
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            some, front = front[:step], front[step:]
            new = []
            for k in some.tolist():
                near = _near(check[left], check[k])
                yield from ((k, x) for x in left[near].tolist())
                new.append(left[near])
                left = left[~near]
                if not len(left):
                    break
            front = np.concatenate([front, *new])


def met(at: np.ndarray, root: np.ndarray, check: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (of roots) that connect rows of one key (at >> 16) whose last 16 bits differ in one at most and that are near; at is sorted."""
    same = np.diff(at >> 16) == 0
    met = np.append(False, same) | np.append(same, False)
    at, root, check = at[met], root[met], check[met]
    for i in range(16 if len(at) else 0):
        variant = at & ~np.int64(1 << i)
        order = np.argsort(variant, kind="stable")
        start = np.flatnonzero(np.diff(variant[order], prepend=-1))
        size = np.diff(np.append(start, len(order)))
        hub = np.repeat(order[start], size)
        run = np.repeat(np.arange(len(start)), size)
        other = root[order] != root[hub]
        near = other & _near(check[order], check[hub])
        yield root[hub[near]], root[order[near]]
        # in a run of more, who isn't near its first member may be near another
        for k in np.unique(run[other & ~near & (size[run] > 2)]).tolist():
            rows = order[start[k] : start[k] + size[k]]
            if pairs := list(spanning(check[rows])):
                a, b = rows[np.array(pairs)].T
                yield root[a], root[b]


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of a spanning forest of what meets in this task's sorted rows (at, root, c0, c1)."""
    parent: dict[int, int] = {}

    def top(k: int) -> int:
        while (up := parent.get(k, k)) != k:
            parent[k] = k = parent.get(up, up)
        return k

    def links(rows: np.ndarray) -> pa.RecordBatch:
        out = []
        for a, b in met(rows[0], rows[1], rows[2:].T.view(np.uint64)):
            order = np.lexsort((a, b))
            a, b = a[order], b[order]
            new = np.append(True, (np.diff(a) != 0) | (np.diff(b) != 0))[: len(a)] & (a != b)
            for x, y in zip(a[new].tolist(), b[new].tolist(), strict=True):
                rx, ry = top(x), top(y)
                if rx != ry:
                    parent[rx] = ry
                    out.append((x, y))
        x, y = np.array(out, dtype=np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    held, n, most = [], 0, CHUNK
    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy() for i in range(4)]))
        n += batch.num_rows
        if n >= most:
            rows = np.concatenate(held, axis=1)
            end = int(np.searchsorted(rows[0], rows[0, -1] >> 16 << 16))  # the last key may go on
            if end:
                yield links(rows[:, :end])
            held, n = [rows[:, end:]], n - end
            most = max(CHUNK, 2 * n)
    if held:
        yield links(np.concatenate(held, axis=1))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, x, y) whose sets x and y are near copies."""
    for batch in batches:
        near = [similarity(np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64)) >= SIMILARITY for x, y in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(near, pa.bool_()))


def forest(roots: np.ndarray, sets: list[np.ndarray], rows: int = 256, columns: int = 2048) -> list[tuple[int, int]]:
    """Pairs of members of different roots that are near copies, as many as connect the roots of all such pairs.

    Members of the commonest root are not compared with each other, only with the rest:
    `rows` of these at a time, by what lists of each shingle's members say of `columns` of their shingles at a time.
    """
    n = np.array([len(x) for x in sets])
    kinds, code = np.unique(roots, return_inverse=True)
    if len(kinds) < 2:
        return []
    outer = np.flatnonzero(code != np.argmax(np.bincount(code)))
    member = np.repeat(np.arange(len(sets)), n)
    _, shingle, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    listed = member[np.argsort(shingle, kind="stable")]
    begin = np.cumsum(times) - times
    first = np.cumsum(n) - n
    parent = list(range(len(kinds)))

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for at in range(0, len(outer), rows):
        some = outer[at : at + rows]
        both = np.zeros(len(some) * len(sets), dtype=np.int64)
        own = np.repeat(np.arange(len(some)), n[some])
        its = np.concatenate([shingle[first[k] : first[k] + n[k]] for k in some.tolist()])
        shared = times[its] > 1
        own, its = own[shared], its[shared]
        for k in range(0, len(its), columns):
            m = times[its[k : k + columns]]
            place = np.arange(int(m.sum())) + np.repeat(begin[its[k : k + columns]] - (np.cumsum(m) - m), m)
            both += np.bincount(np.repeat(own[k : k + columns] * len(sets), m) + listed[place], minlength=len(both))
        both = both.reshape(len(some), len(sets))
        near = both >= SIMILARITY * (n[some][:, None] + n[None, :] - both)
        near &= code[some][:, None] != code[None, :]
        x, y = np.nonzero(near)
        _, one = np.unique(code[some[x]] * len(kinds) + code[y], return_index=True)
        for k in one.tolist():
            a, b = int(some[x[k]]), int(y[k])
            ra, rb = top(int(code[a])), top(int(code[b]))
            if ra != rb:
                parent[ra] = rb
                out.append((a, b))
    return out


def _crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal units in sorted rows (unit, node, root, found): links (a, b) of their forests."""

    def linked(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        node = rows["node"].to_numpy()
        _, first = np.unique(node, return_index=True)  # a collision of units may bring one twice
        sets = [np.frombuffer(rows["found"][k].as_py(), dtype=np.uint64) for k in first.tolist()]
        found = np.array(forest(rows["root"].to_numpy()[first], sets), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(node[first][found[:, 0]]), pa.array(node[first][found[:, 1]])], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        unit = batch["unit"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and held[-1]["unit"][0].as_py() != unit[a]:
                yield linked(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield linked(held)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, place, and node (one for each set), n (its size), sample (its least hashes), judged (how many of them are)."""
    rows = docs.select(text_of().alias("text"), "doc_id", *PLACE)
    schema = rows.select("doc_id", *PLACE).schema.add("node", "long").add("n", "integer").add("sample", ArrayType(LongType())).add("judged", "integer")
    return rows.mapInArrow(_signatures, schema)


def _with(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """a, b and the column's values of both."""
    x = table.select(F.col("node").alias("a"), F.col(column).alias("x"))
    y = table.select(F.col("node").alias("b"), F.col(column).alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")


def sharing(nodes: DataFrame) -> DataFrame:
    """The nodes of which a fifth of the judged shingles, about, is in no other node at most; nodes: node, n, sample, judged."""
    seen = nodes.select("node", "judged", F.posexplode("sample").alias("i", "h")).select("h", "node", (F.col("i") < F.col("judged")).alias("counts"))
    alone = seen.groupBy("h").agg(F.count("*").alias("m"), F.min("node").alias("node"), F.min("counts").alias("counts")).where("m = 1 and counts")
    owned = nodes.drop("sample").join(alone.groupBy("node").agg(F.count("*").alias("own")), "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    spare = F.when(F.col("judged") < F.col("n"), 6 * F.sqrt(SIMILARITY * (1 - SIMILARITY) * F.col("judged")) + 1).otherwise(F.lit(0.0))
    return owned.where((F.col("n") > 0) & (F.col("judged") - F.col("own") >= SIMILARITY * F.col("judged") - spare)).drop("own", "judged")


def groups(prints: DataFrame, shared: Shared) -> DataFrame:
    """(node, component) of nodes that links between fingerprints connect, whoever meets under a variant; prints: node, prints, small."""
    kept = prints.select("node", F.explode("small").alias("key"))
    hubs = kept.groupBy("key").agg(F.min("node").alias("a"))
    found = shared.table(kept.join(hubs, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct())
    first, rooted = 0, prints.select("prints", F.col("node").alias("root"))
    for n in SWEEPS:
        if first:
            rooted = prints.join(components(found, shared), "node", "left").select("prints", F.coalesce("component", "node").alias("root"))
        rows = rooted.mapInArrow(_dealt(first, first + n), "at bigint, root bigint, c0 bigint, c1 bigint")
        dealt = spread(rows, F.shiftright("at", 16)).sortWithinPartitions("at")
        found = shared.table(found.unionByName(dealt.mapInArrow(_swept, "a bigint, b bigint")).distinct())
        first += n
    return components(found, shared)


def links(docs: DataFrame, nodes: DataFrame, shared: Shared) -> DataFrame:
    """Links (a, b) that connect all nodes that are near copies; nodes: node, at (the place of one of its texts), n, sample, judged."""
    some = shared.table(sharing(nodes).select("node", "n", "at.*"))
    places = some.select("node", *PLACE)
    texts = unmoved(docs.select(text_of().alias("text"), *PLACE), shared.table(places.select(*PLACE)), shared, "left_semi").join(places.hint("merge"), PLACE).select("text", "node")
    sets = shared.table(texts.mapInArrow(_sets, "node bigint, found binary, prints binary, small array<bigint>"))
    met = shared.table(groups(sets.drop("found"), shared).withColumnRenamed("component", "key").join(some.select("node", "n"), "node"))
    pair = "a bigint, b bigint"

    def rooted(found: DataFrame | None) -> DataFrame:
        """key, node, root and size of each group's members, where a group holds several components."""
        if found is None:
            return met.withColumn("root", F.col("node"))
        now = shared.table(met.join(components(found, shared), "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("root")))
        mixed = shared.table(now.groupBy("key").agg((F.min("root") != F.max("root")).alias("mixed")).where("mixed").select("key"))
        return shared.table(now.join(mixed, "key"))

    found = None
    for k in range(ROUNDS):
        now = rooted(found)
        drawn = now.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), F.col("node").alias("hub"), F.col("root").alias("hub_root"), F.col("n").alias("hub_n"))).alias("d")).select("key", "d.*")
        offers = now.join(shared.table(drawn), "key").where((F.col("root") != F.col("hub_root")) & (F.least("n", "hub_n") >= SIMILARITY * F.greatest("n", "hub_n")))
        pairs = offers.select(F.col("node").alias("a"), F.col("hub").alias("b"))
        new = shared.table(spread(_with(pairs, sets, "found"), "a", "b").mapInArrow(_verified, pair))
        if new.isEmpty():
            break
        found = new if found is None else found.unionByName(new)
    else:
        now = rooted(found)
    last = _crowds(now, sets, shared)
    return last if found is None else found.unionByName(last)


def _crowds(members: DataFrame, sets: DataFrame, shared: Shared) -> DataFrame:
    """Links (a, b) between the components within each group; members: key, node, root, n."""
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") * 8 / BLOCK_BYTES)).cast("int")
    many = members.join(shared.table(members.groupBy("key").agg(blocks.alias("blocks"))), "key").select("key", "node", "root", "blocks")
    # a block meets every block of its group in one unit
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    units = many.withColumn("i", block).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("unit"), "node", "root").join(sets.select("node", "found"), "node")
    dealt = spread(units.select("unit", "node", "root", "found"), "unit").sortWithinPartitions("unit")
    return shared.table(dealt.mapInArrow(_crowded, "a bigint, b bigint")).distinct()


def classes(docs: DataFrame, shared: Shared) -> tuple[DataFrame, DataFrame]:
    """(doc_id, place, node) of each document, and (node, root) of each node; docs are placed."""
    prints = shared.table(signatures(docs))
    nodes = shared.table(prints.groupBy("node").agg(F.min(F.struct(*PLACE)).alias("at"), F.first("n").alias("n"), F.first("sample").alias("sample"), F.first("judged").alias("judged")))
    found = components(links(docs, nodes, shared), shared)
    rooted = nodes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("root"))
    return prints.select("doc_id", *PLACE, "node"), rooted
