"""Quality by importance resampling.

Two generative models over hashed n-grams of whole words, one of target text (documents
labelled good and not toxic) and one of the raw text (all documents), give each document
a log importance weight: the sum, over its n-grams, of the log ratio of their
probabilities in target and raw text. Documents are then drawn without replacement by
Gumbel top-k: the k greatest sums of SHARPNESS times the log weight and Gumbel noise, which
draws in proportion to the weights to that power.

n-grams are words (letters, digits and all that is not ASCII) and runs of marks, in lower case (unigrams), pairs of them that follow
each other (bigrams), and runs of 2, 4 and 8 equal words, each kind hashed to buckets of
its own. A model counts the documents that hold an n-gram, so a copied or repetitive text
counts once. A ratio other than one needs evidence: the target count must differ from its
expectation e (its share of the raw count) by more than EVIDENCE[kind] * sqrt(e); then it
is (target + 1) / (e + 1), for or against the document alike. Bigrams need more, as their
buckets hold more n-grams and copies repeat them together.

k is stated by the data: the number of documents whose weight reaches the bound that all
but `LOSS` of held-out good documents reach. Noise is a hash of the document's id and the
seed: reruns agree. It decides among documents of nearby weights; one that lies five nats
below the others is drawn once in some 20,000 times.

Bounded, documented sample: at most `MAX_LABELS` labelled ids (least by hash) serve as
target and for the bound; a quarter of them is held out. All counts cover all documents.

Defined cases: a null or empty text has weight 0; several labels of one id count as
their worst; without any good held-out label all documents are kept; rows that share an
id share their noise, so equal rows stay or go together; ties at the cut stay together;
an empty table gives an empty result; other columns are ignored (and kept by the stage).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm.common import Shared, read, text_of

MAX_LABELS = 20_000
LOSS = 0.002
SHARPNESS = 2.0
SEED = 11
#: Hash buckets of unigrams and bigrams; runs of equal words follow them.
WORDS, PAIRS = 1 << 19, 1 << 17
RUNS = (2, 4, 8)
SIZE = WORDS + PAIRS + len(RUNS)
#: Standard deviations from its expectation at which a count becomes evidence: unigrams and runs, bigrams.
EVIDENCE = (3.0, 6.0)
#: Bytes of a text that are hashed at once, up to the next space.
CHUNK = 1 << 20

#: By byte: 0 white space, 1 letters, digits and all that is not ASCII, 2 marks.
_KIND = np.array([0 if b in b" \t\n\r\x0b\x0c" else 1 if b >= 128 or chr(b).isalnum() or b == 95 else 2 for b in range(256)], dtype=np.uint8)
_DRAWN = np.random.default_rng(SEED)
#: A word's hash is the sum of its bytes' numbers, each times that of its place in the word (places repeat after 4096).
_BYTES = np.where(_KIND > 0, _DRAWN.integers(1, 1 << 62, 256, dtype=np.uint64), np.uint64(0))
_PLACES = _DRAWN.integers(0, 1 << 62, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(raw: bytes) -> np.ndarray:
    """One hash for each word or run of marks, in order."""
    b = np.frombuffer(raw, dtype=np.uint8)
    kind = _KIND[b]
    edge = np.empty(len(b), dtype=bool)
    edge[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    new = np.flatnonzero(edge & (kind > 0))
    if not len(new):
        return np.empty(0, dtype=np.uint64)
    place = np.arange(new[0], len(b)) - np.repeat(new, np.diff(np.append(new, len(b))))
    h = np.add.reduceat(_BYTES[b[new[0] :]] * _PLACES[place & 4095], new - new[0])
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _chunks(raw: bytes) -> Iterator[bytes]:
    at = 0
    while len(raw) - at > CHUNK:
        space = raw.find(b" ", at + CHUNK)
        end = len(raw) if space < 0 else space + 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def features(text: str) -> np.ndarray:
    """Distinct n-gram buckets of a text, in order."""
    parts = [_hashes(part) for part in _chunks(text.lower().encode("utf-8", "replace"))]
    h = np.concatenate(parts)
    if not len(h):
        return np.empty(0, dtype=np.int32)
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(29)
    longest = int(np.diff(np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))).max())
    runs = [WORDS + PAIRS + k for k, n in enumerate(RUNS) if longest >= n]
    found = np.concatenate([h & np.uint64(WORDS - 1), (pair & np.uint64(PAIRS - 1)) + np.uint64(WORDS), np.array(runs, dtype=np.uint64)]).astype(np.int32)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By feature, the documents of all text and of target text that hold it; by -1, the documents."""
    counts = np.zeros((2, SIZE), dtype=np.int64)
    docs = np.zeros(2, dtype=np.int64)
    for batch in batches:
        for text, role in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            found = features(text.as_py())
            counts[0, found] += 1
            docs[0] += 1
            if role == "target":
                counts[1, found] += 1
                docs[1] += 1
    used = np.flatnonzero(counts[0])
    table = pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(counts[0, used], docs[0])), pa.array(np.append(counts[1, used], docs[1]))], names=["feature", "raw", "target"]
    )
    for at in range(0, table.num_rows, 1 << 16):
        yield table.slice(at, 1 << 16)


def log_ratio(counted: pa.Table) -> np.ndarray:
    """By feature, the log ratio of its probabilities in target and raw text; 0 where there is no evidence."""
    feature, raw, target = (counted[c].to_numpy() for c in ("feature", "raw", "target"))
    docs = feature == -1
    share = target[docs].sum() / max(1, raw[docs].sum())
    feature, raw, target = feature[~docs], raw[~docs], target[~docs]
    expected = raw * share
    least = np.where((feature >= WORDS) & (feature < WORDS + PAIRS), EVIDENCE[1], EVIDENCE[0]) * np.sqrt(expected)
    out = np.zeros(SIZE, dtype=np.float32)
    out[feature] = np.where(np.abs(target - expected) > least, np.log((target + 1) / (expected + 1)), 0)
    return out


def _score(ratios: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(ratios, dtype=np.float32)
        for batch in batches:
            got = pa.array([float(table[features(x.as_py())].sum(dtype=np.float64)) for x in batch.column(0)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], got], names=[*batch.schema.names[1:], "log_weight"])

    return run


def roles(labels: DataFrame, most: int = MAX_LABELS) -> DataFrame:
    """doc_id and role (target or held) of good documents in a bounded sample of labels."""
    by_id = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    some = by_id.withColumn("h", F.xxhash64("doc_id", F.lit(SEED))).orderBy("h", "doc_id").limit(most)
    return some.where("quality = 1 and toxic = 0").select("doc_id", F.when(F.pmod("h", F.lit(4)) == 0, "held").otherwise("target").alias("role"))


def cut(keys: DataFrame, k: int, fan: int = 4096) -> int | None:
    """The k-th largest of a long column `key`, by counts of ever narrower ranges (at most `fan` rows come to the driver)."""
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if not n or k >= n:
        return low
    if k <= 0:
        return high + 1
    while low < high:
        width = -(-(high - low + 1) // fan)
        inside = keys.where(F.col("key").between(low, high)).groupBy(F.expr(f"(key - ({low})) div {width}").alias("b")).count()
        for b, m in sorted(inside.collect(), reverse=True):
            if k <= m:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            k -= m
    return low


def weighed(docs: DataFrame, labels: DataFrame, shared: Shared, keep: list[str]) -> DataFrame:
    """The columns `keep` of each row of docs, as the struct `row`, with role and log_weight."""
    sample = shared.table(roles(labels))
    # at most MAX_LABELS ids, whatever the size of the corpus
    told = docs.select(text_of().alias("text"), "doc_id", F.struct(*keep).alias("row")).join(F.broadcast(sample), "doc_id", "left").select("text", "role", "doc_id", "row")
    counted = told.select("text", "role").mapInArrow(_count, "feature int, raw bigint, target bigint")
    counted = counted.groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    ratios = log_ratio(counted.toArrow())
    return told.mapInArrow(_score(ratios.tobytes()), told.drop("text").schema.add("log_weight", "double"))


def gumbel_key(log_weight: Column, *ids, seed: int | Column = SEED) -> Column:
    """Log weight and Gumbel noise, as a long in units of 2^-24; the noise depends on the ids and the seed alone."""
    u = (F.pmod(F.xxhash64(*ids, F.lit(seed) + 1), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return F.floor((log_weight - F.log(-F.log(u))) * float(1 << 24)).cast("long")


def resampled(docs: DataFrame, labels: DataFrame, shared: Shared, keep: list[str], loss: float = LOSS, sharpness: float = SHARPNESS, seed: int = SEED) -> DataFrame:
    """The drawn rows: the columns `keep`, and log_weight."""
    # the rows themselves are kept beside their keys, so that the draw is a filter and moves no text
    rows = shared.table(weighed(docs, labels, shared, keep).withColumn("key", gumbel_key(F.col("log_weight") * sharpness, "doc_id", seed=seed)))
    bound = rows.where("role = 'held'").agg(F.expr(f"percentile(log_weight, {loss})")).first()[0]
    if bound is None:
        return rows.select("row.*", "log_weight")
    k = rows.where(F.col("log_weight") >= bound).count()
    return rows.where(F.col("key") >= cut(rows.select("key"), k)).select("row.*", "log_weight")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and log_weight of the documents that are kept."""
    return resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), Shared(spark, "quality"), ["doc_id"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are drawn stay."""
    kept = resampled(docs, read(spark, sf_dir, "labels"), Shared(spark, "quality"), docs.columns)
    return kept.select(*docs.columns) if "log_weight" not in docs.columns else kept.toDF(*docs.columns, "__log_weight").drop("__log_weight")
