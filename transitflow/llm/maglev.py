"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size (an offset and a stride taken from its name).  The shards take turns, each
claiming its next free slot, until the table is full; so slots are even to
within one turn, and a shard that joins or leaves moves few of the others'
slots.  A row goes to the shard of the slot its key hashes to: one broadcast
lookup, no shuffle.  The table has ``slots`` rows whatever the data, which
bounds the broadcast.

Defined results: rows with equal keys share a shard, null keys too; an empty
table gives an empty result; other columns are kept as they are, whatever their
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[int]:
    """Index into ``shards`` for every slot.  With ``weights`` (whole numbers,
    default 1) a shard claims that many slots a turn."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    if slots < 3 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be a prime above 2")
    turns = [(weights or {}).get(s, 1) for s in shards]
    if any(t < 1 for t in turns):
        raise ValueError("a weight must be 1 or more")
    at = [_number(s, "offset") % slots for s in shards]
    stride = [_number(s, "stride") % (slots - 1) + 1 for s in shards]
    table, left = [-1] * slots, slots
    while True:
        for i, t in enumerate(turns):
            for _ in range(t):
                while table[at[i]] >= 0:
                    at[i] = (at[i] + stride[i]) % slots
                table[at[i]] = i
                left -= 1
                if not left:
                    return table


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS,
                weights: dict[str, int] | None = None) -> DataFrame:
    """The table as rows (slot, shard)."""
    names = [shards[i] for i in lookup_table(shards, slots, weights)]
    return spark.createDataFrame(list(enumerate(names)), "slot long, shard string")


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str] = SHARDS, slots: int = SLOTS,
          weights: dict[str, int] | None = None, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with each row's slot and shard.  Where ``df`` has a column of
    one of those two names, the new one gets underscores before its name."""
    slot_col, shard_col = _free(slot_col, df.columns), _free(shard_col, df.columns)
    names = F.broadcast(table_frame(df.sparkSession, shards, slots, weights).toDF("_slot", "_shard"))
    # the row travels as one column, so none of its names can clash
    keyed = df.select(F.struct(*df.columns).alias("_row"), F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("long").alias("_at"))
    placed = keyed.join(names, F.col("_at") == F.col("_slot"))
    return placed.select("_row.*", F.col("_at").alias(slot_col), F.col("_shard").alias(shard_col))


def _free(name: str, columns: Sequence[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


def write_shards(df: DataFrame, path: str, keys: Sequence[str], shards: Sequence[str] = SHARDS,
                 slots: int = SLOTS, files_per_shard: int = 1) -> None:
    """One folder per shard, ``shard=<name>`` (underscores before it if the data
    has such a column).  The shuffle is by slot group, so a large shard is
    written by ``files_per_shard`` tasks."""
    slot, shard = _free("slot", df.columns), _free("shard", df.columns)
    placed = place(df, keys, shards, slots)
    part = F.pmod(F.col(slot), F.lit(files_per_shard))
    (placed.repartition(len(shards) * files_per_shard, shard, part).drop(slot)
     .write.partitionBy(shard).parquet(path))


def op9_maglev(docs: DataFrame) -> DataFrame:
    return place(docs.select("doc_id"), ["doc_id"])
