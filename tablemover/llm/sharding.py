"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: it starts at a
hashed offset and advances by a hashed step, which visits every slot once as the size is prime. The
shards take turns; each claims the first slot of its order that is still free, until the table is full.
So shards own equal shares of the slots to within one, and when a shard leaves, the slots of the others
hardly change. Placing a document is one hash and one look-up in the broadcast table.

The table's size is a parameter, never the data's: at least 100 slots per shard, which keeps the shares
of hashed keys within about a hundredth of each other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from .common import col, fresh

#: Largest lookup table that is broadcast: 8 million slots (16 bytes each, 128 MB), enough for
#: 80,000 shards at 100 slots per shard.
MAX_SLOTS = 1 << 23


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def next_prime(n: int) -> int:
    while not _is_prime(n):
        n += 1
    return n


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:15], 16)


def fill_table(shards: list[str], slots: int) -> list[int]:
    """Owner (position in ``shards``) of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not _is_prime(slots) or slots < len(shards) or slots > MAX_SLOTS:
        raise ValueError(f"slots must be a prime of at least the number of shards, at most {MAX_SLOTS}")
    place = [_number(s + "/offset") % slots for s in shards]
    step = [_number(s + "/step") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    for turn in range(slots):
        s = turn % len(shards)
        while owner[place[s]] >= 0:
            place[s] = (place[s] + step[s]) % slots
        owner[place[s]] = s
    return owner


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def assign_shards(docs: DataFrame, shards: list[str] | int = 32, key_col: str = "doc_id",
                  slots: int | None = None) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``. Built-in functions only.

    The slot is the first 60 bits of md5 of the key as text, modulo the table's size. A null key is
    placed as the empty text; equal keys (repeated rows) share a shard; an empty table stays empty. If
    ``docs`` already has columns of these names, the new ones get a trailing underscore.
    """
    names = shard_names(shards) if isinstance(shards, int) else list(shards)
    slots = slots or next_prime(100 * len(names))
    owner = fill_table(names, slots)
    slot, shard = fresh(docs.columns, "slot"), fresh(docs.columns, "shard")
    spark = docs.sparkSession
    table = spark.createDataFrame([(i, names[s]) for i, s in enumerate(owner)], f"`{slot}` bigint, `{shard}` string")
    digest = F.md5(F.coalesce(col(key_col).cast("string"), F.lit("")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    placed = docs.withColumn(slot, F.pmod(number, F.lit(slots).cast("bigint")))
    # The table has `slots` rows, a parameter bounded by MAX_SLOTS: safe to broadcast at any data size.
    return placed.join(F.broadcast(table), slot, "left").select(
        *[col(c) for c in docs.columns], col(slot), col(shard))


def oracle(shards: int, key: str = "doc_id", table: str = "documents") -> str:
    """DuckDB SQL that fills the table turn by turn and places every row of ``table``."""
    slots = next_prime(100 * shards)
    num = "CAST(('0x' || substr(md5({}), 1, 15)) AS BIGINT)"
    return f"""
WITH RECURSIVE shards AS (
    SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 5, '0') AS shard FROM range({shards}) r(i)),
prefs AS (
    SELECT i, shard, {num.format("shard || '/offset'")} % {slots} AS off,
           {num.format("shard || '/step'")} % ({slots} - 1) + 1 AS step FROM shards),
orders AS (
    SELECT i, list((off + j * step) % {slots} ORDER BY j) AS pref FROM prefs, range({slots}) r(j) GROUP BY i),
allprefs AS (SELECT list(pref ORDER BY i) AS prefs FROM orders),
fill(turn, taken, owner, claimed) AS (
    SELECT 0, list_transform(range({slots}), lambda x: false), CAST(-1 AS BIGINT), CAST(-1 AS BIGINT)
    UNION ALL
    SELECT turn + 1,
           list_transform(taken, lambda x, k: x OR k - 1 = c), turn % {shards}, c
    FROM (SELECT turn, taken,
                 list_extract(list_filter(prefs[turn % {shards} + 1], lambda s: NOT taken[s + 1]), 1) AS c
          FROM fill, allprefs WHERE turn < {slots}) claims)
SELECT d.{key}, {num.format(f"coalesce(CAST(d.{key} AS VARCHAR), '')")} % {slots} AS slot, s.shard AS shard
FROM {table} d
JOIN fill f ON f.claimed = {num.format(f"coalesce(CAST(d.{key} AS VARCHAR), '')")} % {slots}
JOIN shards s ON s.i = f.owner"""
