"""An index of the keys that a table has, so that telling new keys from
known ones costs what the batch costs, not what the table holds.

Two tables below ``KeyIndex.path``:

* ``keys``  [shard], bucketed by key: every key of the table, and nothing else. A key's
  shard is a hash of it. A join on the key needs no shuffle of this side.
* ``bits``  [shard]: a Bloom filter for each shard, as pages of 4 KB, appended by every
  batch and joined with "or" when they are read. All bits of a key are in one page.

A batch first looks up its keys' bits. Keys without all their bits are new. The
others, known ones and a few that only look like it, are joined with the shards they
are in; the other shards' files are not read. A full filter sends more keys to the
join, which stays right. A batch with very many such keys is joined by a shuffle of both
sides, as there are but a few buckets.

The index may have keys twice (a batch that was repeated after a failure), never too
few: ``add`` writes the bits before the keys, and ``jobs.land`` repeats an unfinished
batch before it takes the next.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
import hashlib
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paymart.operators.changes import read_table
from paymart.session import list_folder, stored_once

SHARDS = 16
BUCKETS = 4
#: Bits of a shard's filter (128 KB). About one new key in 100 is taken for a known one
#: at a tenth as many keys; for a landing of N keys, choose shards * bits near 10 * N.
BITS = 1 << 20
HASHES = 4
_PAGE = 32_768  # bits of a row's bitmap
_WORD = 64      # bits of a number that stands for a part of it
#: Up to so many keys for each bucket are joined with the index by bucket.
TASK_KEYS = 250_000
_BITS_SCHEMA = "shard int, page int, bits binary"


def _is_set(words: str, bit: Column) -> Column:
    """Whether a page, as ``_words`` makes it, has a bit. A word's bytes go up as the
    page's do, and a byte's bits begin with the lowest."""
    place = F.lit(_WORD - 8) - bit.bitwiseAND(F.lit(_WORD - 8)) + bit.bitwiseAND(F.lit(7))
    word = F.get(words, F.shiftright(bit, 6).cast("int"))
    return F.call_function("shiftright", word, place.cast("int")).bitwiseAND(F.lit(1)) == 1


def _words(bits: str) -> Column:
    """A page's bitmap as an array of numbers: once a page, so that a look at a bit of
    it is no more than arithmetic."""
    return F.transform(F.sequence(F.lit(0), F.lit(_PAGE // _WORD - 1)), lambda i: F.conv(
        F.hex(F.substring(bits, i * (_WORD // 8) + 1, F.lit(_WORD // 8))), 16, -10).cast("long"))


@dataclass(frozen=True)
class KeyIndex:
    path: str
    key: str = "object_id"
    shards: int = SHARDS
    buckets: int = BUCKETS
    bits: int = BITS

    # ------------------------------------------------------------- storage

    @property
    def _name(self) -> str:
        digest = hashlib.sha256(f"{self.path}|{self.shards}|{self.buckets}".encode()).hexdigest()[:16]
        return f"paymart_keys_{digest}"

    def table(self, spark: SparkSession) -> DataFrame:
        """The keys. A catalog entry tells Spark how they are bucketed; a session
        that does not have it makes it anew from the files."""
        if not spark.catalog.tableExists(self._name):
            spark.sql(f"CREATE TABLE {self._name} (`{self.key}` STRING, shard INT) USING parquet PARTITIONED BY (shard) "
                      f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
                      f"LOCATION '{self.path}/keys'")
            if list_folder(spark, f"{self.path}/keys"):
                spark.sql(f"ALTER TABLE {self._name} RECOVER PARTITIONS")
        return spark.table(self._name)

    def exists(self, spark: SparkSession) -> bool:
        return bool(list_folder(spark, f"{self.path}/bits"))

    def _filters(self, spark: SparkSession) -> DataFrame:
        schema = spark.createDataFrame([], _BITS_SCHEMA).schema
        return read_table(spark, f"{self.path}/bits", schema)

    # ------------------------------------------------------------- hashing

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.shards)).cast("int")

    def _placed(self, keys: DataFrame) -> DataFrame:
        """(key, shard, page, bits): where each key's bits are."""
        page = F.pmod(F.xxhash64(self.key, F.lit(0)), F.lit(-(-self.bits // _PAGE))).cast("int")
        bits = F.array(*[F.pmod(F.xxhash64(self.key, F.lit(i)), F.lit(_PAGE)) for i in range(1, HASHES + 1)])
        return keys.select(self.key, self._shard().alias("shard"), page.alias("page"), bits.alias("at"))

    # ------------------------------------------------------------- use

    def maybe_known(self, keys: DataFrame) -> DataFrame:
        """Those of the (distinct) keys that the filters can't tell to be new, with
        their shard."""
        filters = (self._filters(keys.sparkSession).groupBy("shard", "page")
                   .agg(F.bitmap_or_agg("bits").alias("bits")).select("shard", "page", _words("bits").alias("words")))
        return (self._placed(keys).join(filters, ["shard", "page"])
                .where(reduce(and_, [_is_set("words", F.get("at", F.lit(i))) for i in range(HASHES)]))
                .select(self.key, "shard"))

    def known(self, keys: DataFrame) -> DataFrame:
        """Those of the (distinct) keys that the index has."""
        spark = keys.sparkSession
        seen = Observation()
        maybe = self.maybe_known(keys).observe(
            seen, F.collect_set("shard").alias("shards"), F.count(F.lit(1)).alias("keys"))  # ``shards`` at most
        maybe = stored_once(maybe, "keys-maybe")
        shards = sorted(seen.get["shards"] or [])
        have = self.table(spark).where(F.col("shard").isin(shards))
        if (seen.get["keys"] or 0) > TASK_KEYS * self.buckets:
            have = have.repartition(self.key)  # else a task a bucket, whatever the batch's size
        return have.join(maybe.select(self.key), self.key).select(self.key).distinct()

    def add(self, keys: DataFrame) -> None:
        """Put (distinct) keys into the index."""
        pages = (self._placed(keys).select("shard", "page", F.explode("at").alias("bit"))
                 .groupBy("shard", "page").agg(F.bitmap_construct_agg("bit").alias("bits")))
        pages.write.mode("append").partitionBy("shard").parquet(f"{self.path}/bits")
        self.table(keys.sparkSession)
        # a shard's bucket in one task, so a batch adds a file per shard and bucket at most
        (keys.select(F.col(self.key).cast("string").alias(self.key), self._shard().alias("shard"))
         .repartition("shard", F.pmod(F.hash(self.key), F.lit(self.buckets))).write.insertInto(self._name))

    def insert_ignore(self, fresh: DataFrame) -> DataFrame:
        """The rows of ``fresh`` (one per key) whose key the index lacks."""
        if not self.exists(fresh.sparkSession):
            return fresh
        return fresh.join(self.known(fresh.select(self.key)), self.key, "left_anti")
