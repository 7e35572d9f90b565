"""Sharding by a permutation-filled lookup table (DataFrame functions on the main path).

Every shard has a preference order over the slots of a table of prime size: it starts at an offset and walks by a skip,
both derived from the md5 of its name. Shards take turns; in its turn a shard claims the first slot of its order that is
still free, until all slots are taken. Shards then own slot counts that differ by at most one, and dropping a shard moves
few of the other shards' slots. The table's size is a parameter (65,537 rows by default, whatever the data), so it is
broadcast, and placing a row is one hash and one lookup without a shuffle.

A row whose key is null is placed by the hash of all its columns, so null keys spread. Equal keys share a shard. A text's
length, extra columns and an empty table change nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """(offset, skip) of a shard's walk over the slots."""
    d = hashlib.md5(name.encode()).digest()
    return int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Owner (index into ``shards``) of each slot."""
    if not _is_prime(slots):
        raise ValueError(f"table size {slots} is not a prime")
    if not shards or len(shards) > slots or len(set(shards)) < len(shards):
        raise ValueError("between 1 and `slots` shards with different names are needed")
    at, skip = map(list, zip(*(preference(s, slots) for s in shards), strict=True))
    owner, left = [-1] * slots, slots
    while True:
        for s in range(len(shards)):
            while owner[at[s]] >= 0:
                at[s] = (at[s] + skip[s]) % slots
            owner[at[s]] = s
            left -= 1
            if not left:
                return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``(_slot, _shard)``, one row per slot."""
    owners = F.split(F.lit(",".join(map(str, fill_table(shards, slots)))), ",")
    return spark.range(1).select(F.posexplode(owners).alias("_slot", "_own")).select(
        "_slot", F.element_at(F.array(*map(F.lit, shards)), F.col("_own").cast("int") + 1).alias("_shard"))


def assign_shards(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard``; columns of those names in ``df`` are replaced."""
    df = df.drop(slot, shard)
    h = F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(*df.columns))
    # Slot and shard of the table are named after the output, so no column of the data can clash with them.
    table = F.broadcast(lookup_table(df.sparkSession, shards, slots).toDF(slot, shard))
    return df.withColumn(slot, F.pmod(h, F.lit(slots)).cast("int")).join(table, slot).select(*df.columns, slot, shard)


def write_sharded(df: DataFrame, path: str, key: str, shards: list[str], slots: int = SLOTS, tasks_per_shard: int = 8) -> None:
    """Write ``df`` partitioned by shard; a shard's rows are dealt over ``tasks_per_shard`` tasks, so a hot shard is
    several files and no single task."""
    out = assign_shards(df, key, shards, slots)
    salt = F.pmod(F.xxhash64(*out.columns), F.lit(tasks_per_shard))
    out.repartition(len(shards) * tasks_per_shard, "shard", salt).write.partitionBy("shard").parquet(path)
