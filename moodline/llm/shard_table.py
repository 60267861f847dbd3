"""Placement by a permutation-filled lookup table (operator 3).

Every shard has a preference order over the slots of a table of prime size: it
starts at one hash of its name and steps by another, which visits every slot
once. Shards take turns; each claims its next preferred slot that is free. The
filled table is even (shards differ by at most one slot) and changes little
when a shard joins or leaves. Rows find their shard by one hash and one look-up
in the broadcast table, whose size is the prime, not the data's.

Cases: a null key is placed like the empty key, so equal keys always meet.
Ties cannot occur. Extra columns pass through (slot and shard are replaced); an
empty table stays empty. A
key that holds a third of the rows holds one shard's place, as placement must
be a function of the key; ``spread`` adds a salt where that is not wanted.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def filled(shards: tuple[str, ...], prime: int = PRIME) -> list[int]:
    """Slot -> number of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > prime:
        raise ValueError("shards must be distinct names, at least one and at most as many as slots")
    if prime < 2 or any(prime % d == 0 for d in range(2, int(prime ** 0.5) + 1)):
        raise ValueError("the table size must be prime")
    at = [_hash(s, "start") % prime for s in shards]
    step = [_hash(s, "step") % (prime - 1) + 1 if prime > 2 else 1 for s in shards]
    table = [-1] * prime
    left = prime
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % prime
            table[at[i]] = i
            left -= 1
            if not left:
                return table


def slot(key: Column, prime: int = PRIME) -> Column:
    """Slot of a key: the first 15 hex digits of its MD5 modulo the table size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(prime))


def place(rows: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, prime: int = PRIME,
          spread: int = 1) -> DataFrame:
    """``rows`` with slot and shard. ``spread`` > 1 deals a key's rows over that many slots by row hash."""
    by = F.col(key)
    if spread > 1:
        salt = F.pmod(F.xxhash64(*rows.columns), F.lit(spread))
        by = F.concat_ws("#", F.coalesce(by.cast("string"), F.lit("")), salt.cast("string"))
    table = rows.sparkSession.createDataFrame(
        [(i, shards[s]) for i, s in enumerate(filled(shards, prime))], "__slot long, shard string")
    placed = rows.withColumn("__slot", slot(by, prime)).drop("slot", "shard")
    return placed.join(F.broadcast(table), "__slot").withColumnRenamed("__slot", "slot")  # prime rows


def write_shards(rows: DataFrame, path: str, key: str, files_per_shard: int = 1, **parameters) -> None:
    """Write one folder per shard; a large shard may be dealt to several tasks by row hash."""
    placed = place(rows, key, **parameters)
    if files_per_shard > 1:
        salt = F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_shard))
        placed = placed.repartition(F.col("shard"), salt)
    else:
        placed = placed.repartition("shard")
    placed.drop("slot").write.partitionBy("shard").parquet(path)
