"""What the operators share: tables, shared storage between steps, rows by place."""

from __future__ import annotations

import tempfile
import uuid
from typing import ClassVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Where it is unset, local mode (tests) gets a temporary folder; a cluster gets an error,
    as tables in its machines' own folders would be scattered.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessel-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Long texts come to Python in batches of so many bytes, unless the session sets a size of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, size)


class Shared:
    """Tables written to the shared folder, which cut lineage: a lost executor costs a reread, not a recomputation.

    They stay for the plans that read them; clear() removes them once those have run (Shared.live lists what is left).
    """

    live: ClassVar[list[Shared]] = []

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}", 0
        small_batches(spark)
        Shared.live.append(self)

    def table(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._shared_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables that no later plan reads."""
        for t in tables:
            self._delete(t._shared_path)

    def clear(self) -> None:
        """Removes all tables."""
        self._delete(self.root)
        Shared.live.remove(self)

    def _delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def spread(df: DataFrame, *keys: str | Column, per: int = 1) -> DataFrame:
    """Deals rows over the session's shuffle partitions by keys."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, n * per), *keys)


#: Names of a row's place in its file; see placed().
PLACE = ["__place_file", "__place_row"]


def placed(docs: DataFrame, shared: Shared) -> DataFrame:
    """`docs` with two columns that name each row for good: a hash of its file's path and its index there.

    Rows with equal or null ids stay apart by them. A table that is not read straight
    from Parquet is written to the shared folder first.
    """
    docs = docs.drop(*PLACE)
    
    def numbered(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        return df.select("*", F.xxhash64(meta["file_path"]).alias(PLACE[0]), meta["row_index"].alias(PLACE[1]))

    try:
        return numbered(docs)
    except AnalysisException:
        return numbered(shared.table(docs))


#: Most 64-bit words of a bitmap (1 MB, as it is copied with each row); it has one or two for each hash, up to that.
BITMAP = 1 << 17


def _probes(h: Column, longs: int) -> list[tuple[Column, Column]]:
    """Word and bit of both places that a hash has in the bitmap, from parts of it that don't overlap."""
    down = lambda n: F.shiftrightunsigned(h, n)
    return [(F.pmod(h, F.lit(longs)).cast("int"), down(58).cast("int")), (F.pmod(down(20), F.lit(longs)).cast("int"), down(52).bitwiseAND(63).cast("int"))]


def _bitmap(hashes: DataFrame, longs: int) -> DataFrame:
    """One row: bits, an array of so many longs."""
    places = F.explode(F.array(*(F.struct(i.cast("bigint").alias("i"), F.call_function("shiftleft", F.lit(1).cast("bigint"), b).alias("bit")) for i, b in _probes(F.col("hash"), longs))))
    bit = hashes.select(places.alias("p")).select("p.i", "p.bit")
    none = hashes.sparkSession.range(longs).select(F.col("id").alias("i"), F.lit(0).cast("bigint").alias("bit"))
    words = bit.unionByName(none).groupBy("i").agg(F.bit_or("bit").alias("bits"))
    return words.agg(F.sort_array(F.collect_list(F.struct("i", "bits"))).alias("all")).select(F.col("all.bits").alias("bits"))


class Presence:
    """A bitmap of the hashes in a column, as one row of longs: whether a hash may be among them."""

    def __init__(self, hashes: DataFrame, shared: Shared):
        keys = shared.table(hashes.toDF("hash").distinct())
        self.n = keys.count()
        self.longs = 1 << min(BITMAP.bit_length() - 1, max(8, self.n.bit_length()))
        self.bits = shared.table(_bitmap(keys, self.longs)) if self.n else None

    def test(self, h: Column, bits: Column) -> Column:
        """Whether the hash h may be there, by the column `bits` (a subquery can't stand in a lambda)."""
        first, second = (F.call_function("shiftrightunsigned", F.get(bits, i), b).bitwiseAND(F.lit(1)) == 1 for i, b in _probes(h, self.longs))
        return first & second


def unmoved(docs: DataFrame, places: DataFrame, shared: Shared, how: str) -> DataFrame:
    """docs joined with `places` (written, distinct) by place, left_semi or left_anti; only rows in a bitmap of the places move."""
    place = F.xxhash64(*PLACE)
    there = Presence(places.select(place), shared)
    if not there.n:
        return docs if how == "left_anti" else docs.where("false")
    may = there.test(place, there.bits.scalar())
    met = docs.where(may).join(places.hint("merge"), PLACE, how)
    return docs.where(~may).unionByName(met) if how == "left_anti" else met
