"""Token ids as canonical, length-limited Huffman codes in independent blocks.

Documents are range-partitioned by doc_id; each shard is tokenised in ascending order
into rows of consecutive documents (blocks). The ids' global counts give one canonical
code (the lengths alone are kept, in the header table), each block is packed on its own
with the bit offset of every `every`-th id as a checkpoint, and any block can be decoded
without its neighbours, all its stretches side by side through one lookup table.

The container is a Spark table, so the commit protocol of Spark's writers applies to it
and a lost executor costs its own blocks only:

* ``blocks``: shard, block (order of both: ascending doc_id), doc_ids, n_tokens (by
  document), n_ids, marks (bit offsets), payload
* ``header``: one row: tokenizer, end_id, every, and lengths (code lengths by id, 0 for
  ids that don't occur; codes are canonical: by length, then id)

Both lie in one folder, and `TokenFile.open` reads them back in any session. What is
collected on the driver is one count per vocabulary entry.

Nulls and edge cases: a null or empty text has the end id alone; a null doc_id sorts
first; rows with equal doc_ids are ordered by text and stay separate rows; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessel.llm.common import Shared, read, shared_dir, text_of
from tessel.llm.huffman import Coder, code_lengths

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Ids of a block, about; a document is never cut.
BLOCK_IDS = 262_144
#: Ids between two checkpoints.
EVERY = 256
#: Pieces whose ids a worker keeps in each of two generations.
MEMO_SIZE = 256_000

_TOKENS = "shard int, block int, doc_ids array<bigint>, n_tokens array<int>, n_ids bigint, width int, ids binary, used array<int>, times array<bigint>"
_HEADER = "tokenizer string, end_id int, every int, lengths binary"
_BLOCKS = "shard int, block int, doc_ids array<bigint>, n_tokens array<int>, n_ids bigint, marks array<bigint>, payload binary"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder(dict):
    """Encodes texts by the tokenizers library, asking it once for each piece; the dict holds the pieces' ids.

    A byte-level pre-tokenizer attaches one space to what follows it, keeps a line feed
    apart and parts letters from marks, so a text in which no two white-space characters
    touch falls into pieces that are encoded independently. Any other text is given to
    the library whole. Pieces are keyed by what follows their space, by a leading line
    feed, or (first of a text, or after a line feed or letters) by line feed and space.

    When the dict is full it becomes the older generation and a new one begins; a piece
    met again is taken over from the older. So memory is bounded, and frequent pieces
    stay, however many rare ones pass.
    """

    def __init__(self, path: str, size: int = MEMO_SIZE):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # texts that hold an added token's literal are given to the library whole
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.size, self.older = size, {}
        # Only where the pieces are known to be independent; any other tokenizer encodes whole texts.
        self.by_piece = "ByteLevel(add_prefix_space=False" in str(self.tokenizer.pre_tokenizer) and self.tokenizer.normalizer is None

    def packed(self, ids: list[int]) -> bytes:
        got = array(self.code, ids)
        if sys.byteorder == "big":
            got.byteswap()
        return got.tobytes()

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        return self.encode_utf8(text.encode())

    def encode_utf8(self, raw: bytes) -> bytes:
        if not self.by_piece or not parts_alone(raw) or any(x in raw for x in self.added):
            return self.whole(raw.decode())
        pieces = raw.replace(b"\n", b" \n").split(b" ")
        pieces[0] = b"\n " + pieces[0]
        return b"".join(map(self.__getitem__, pieces))

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.fresh(piece)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def fresh(self, piece: bytes) -> bytes:
        if piece[:2] == b"\n ":
            return self.word("", piece[2:])
        if piece[:1] == b"\n":
            return self.whole("\n") + (self[b"\n " + piece[1:]] if len(piece) > 1 else b"")
        return self.word(" ", piece)

    def word(self, lead: str, raw: bytes) -> bytes:
        """A piece without a line feed, after a space or nothing."""
        bare = raw.rstrip(_MARKS)
        if bare.isascii():
            if not bare.isalpha():
                return self.whole(lead + raw.decode())
            text = bare.decode()
        else:
            if not bare.decode().isalpha():
                return self.whole(lead + raw.decode())
            text = "".join(map(_ALPHABET.__getitem__, bare))
        if len(bare) < len(raw):
            return self[bare if lead else b"\n " + bare] + self[b"\n " + raw[len(bare) :]]
        return self.packed([t.id for t in self.model.tokenize("\u0120" + text if lead else text)])


#: Marks that part from the letters before them; no apostrophe, which may begin a contraction.
_MARKS = b".,!?;:$%&#*|)"
#: A byte-level vocabulary writes bytes that are no visible Latin-1 character as U+0100 and on, in order.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_UNSEEN = {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - _VISIBLE))}
_ALPHABET = [_UNSEEN.get(b, chr(b)) for b in range(256)]

_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each tokenizer in a worker, so that its pieces serve all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


#: Bytes of characters up to U+00FF but for white space other than space and line feed.
_NARROW = bytes(sorted({*range(0xC0), 0xC2, 0xC3} - {*b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"}))


def parts_alone(raw: bytes) -> bool:
    """Whether white space is only single spaces and line feeds, none of which touch, inside Latin letters' range."""
    if raw[:1] in (b" ", b"\n") or raw[-1:] in (b" ", b"\n"):
        return False
    if b"  " in raw or b"\n\n" in raw or b"\n " in raw or b" \n" in raw:
        return False
    return not raw.translate(None, _NARROW) and b"\xc2\x85" not in raw and b"\xc2\xa0" not in raw


def _tokenise(path: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        shard, block = TaskContext.get().partitionId(), 0
        tail = coder.packed([end_id])
        total = np.zeros(0, dtype=np.int64)
        ids: list[int | None] = []
        sizes: list[int] = []
        parts: list[bytes] = []
        held = 0

        def row(*values) -> pa.RecordBatch:
            number, docs, n_tokens, n_ids, body, used, times = values
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            cells = [shard, number, docs, n_tokens, n_ids, coder.width, body, used, times]
            names = ["shard", "block", "doc_ids", "n_tokens", "n_ids", "width", "ids", "used", "times"]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=names)

        def flush() -> pa.RecordBatch:
            nonlocal block, held, ids, sizes, parts, total
            body = b"".join(parts)
            got = np.bincount(np.frombuffer(body, dtype=f"<u{coder.width}"), minlength=len(total))
            got[: len(total)] += total
            total = got
            out = row(block, ids, sizes, held, body, None, None)
            block, held, ids, sizes, parts = block + 1, 0, [], [], []
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                got = coder.encode_utf8(text.as_buffer().to_pybytes()) + tail
                n = len(got) // coder.width
                if held and held + n > block_ids:
                    yield flush()
                ids.append(doc_id.as_py())
                sizes.append(n)
                parts.append(got)
                held += n
        if held:
            yield flush()
        if len(total):  # the shard's counts, in a row without a block
            used = np.flatnonzero(total)
            yield row(None, None, None, None, None, used, total[used])

    return run


def _pack(lengths: bytes, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(np.frombuffer(lengths, dtype=np.uint8))
        for batch in batches:
            for k in range(batch.num_rows):
                width, ids = batch.column(5)[k].as_py(), batch.column(6)[k]
                payload, marks = coder.pack(np.frombuffer(ids.as_buffer(), dtype=f"<u{width}"), every)
                row = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(i) for i in range(5)), pa.array([marks.tolist()], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                    names=["shard", "block", "doc_ids", "n_tokens", "n_ids", "marks", "payload"],
                )

    return run


def _unpack(lengths: bytes, every: int, digest: bool):
    """Rows by document: its place, and its ids or their crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(np.frombuffer(lengths, dtype=np.uint8))
        for batch in batches:
            for k in range(batch.num_rows):
                shard, block, docs, sizes, n, marks, payload = (batch.column(i)[k] for i in range(7))
                ids = coder.unpack(payload.as_py(), n.as_py(), marks.values.to_numpy(), every).astype("<u4", copy=False)
                size = sizes.values.to_numpy().astype(np.int64)
                end = np.cumsum(size)
                start = end - size
                view = memoryview(ids).cast("B")
                if digest:
                    last = pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.append(start, end[-1:]), pa.int32()), pa.array(ids.astype(np.int32), pa.int32()))
                m = len(size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.as_py()] * m, pa.int32()),
                        pa.array([block.as_py()] * m, pa.int32()),
                        docs.values,
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        last,
                    ],
                    names=["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return run


class TokenFile:
    """A written token file: the folder of its blocks and its header."""

    def __init__(self, spark: SparkSession, path: str):
        head = spark.read.schema(_HEADER).parquet(f"{path}/header").first()
        self.path, self.tokenizer, self.end_id, self.every = path, head.tokenizer, head.end_id, head.every
        self.lengths = bytes(head.lengths)
        self.blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> TokenFile:
        return cls(spark, path)

    def decoded(self, digest: bool = False) -> DataFrame:
        """One row per document, with the ids (or their crc32) and the ids before it in the whole file."""
        spec = "shard int, block int, doc_id bigint, inside bigint, n_tokens bigint, " + ("ids_crc32 bigint" if digest else "ids array<int>")
        rows = self.blocks.mapInArrow(_unpack(self.lengths, self.every, digest), spec)
        return rows.join(self.offsets(), ["shard", "block"]).withColumn("start", F.col("before") + F.col("inside")).drop("before", "inside")

    def offsets(self) -> DataFrame:
        """Ids before each block: sums within shards, on top of sums over shards (one row per shard)."""
        within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        size = self.blocks.select("shard", "block", "n_ids")
        shards = size.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
        return (
            size.withColumn("here", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
            .join(shards, "shard")
            .select("shard", "block", (F.col("base") + F.col("here")).alias("before"))
        )


def write_tokens(
    spark: SparkSession,
    docs: DataFrame,
    shared: Shared,
    path: str | None = None,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    every: int = EVERY,
    limit: int = 16,
) -> TokenFile:
    """Encodes `docs` (doc_id, text) and writes the token file to `path`, a new folder.

    Without a path it is a folder of its own below the shared one, which outlasts `shared`.
    """
    path = path or f"{shared_dir(spark)}/token-file-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    tokens = shared.table(dealt.mapInArrow(_tokenise(tokenizer or tokenizer_path(), end_id, block_ids), _TOKENS), "snappy")
    counted = tokens.where("block is null").select(F.explode(F.arrays_zip("used", "times")).alias("c")).select(F.col("c.used").alias("id"), F.col("c.times").alias("n")).groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(int(max(counted["id"].to_pylist(), default=-1)) + 1, dtype=np.int64)
    counts[counted["id"].to_numpy()] = counted["n"].to_numpy()
    lengths = code_lengths(counts, max(limit, int(np.count_nonzero(counts)).bit_length() + 1)).tobytes()
    tokens.where("block is not null").drop("used", "times").mapInArrow(_pack(lengths, every), _BLOCKS).write.option("compression", "snappy").parquet(f"{path}/blocks")
    spark.createDataFrame([(os.path.basename(tokenizer or TOKENIZER), end_id, every, bytearray(lengths))], _HEADER).coalesce(1).write.parquet(f"{path}/header")
    shared.drop(tokens)
    return TokenFile.open(spark, path)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of every document through the file: doc_id, start, n_tokens, ids_crc32."""
    return stage(spark, read(spark, sf_dir, "documents"), sf_dir).drop("file")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token file, reads it back, and returns its contents by document; `file` of each row is its folder."""
    file = write_tokens(spark, docs, Shared(spark, "tokens"))
    return file.decoded(digest=True).select("doc_id", "start", "n_tokens", "ids_crc32", F.lit(file.path).alias("file"))
