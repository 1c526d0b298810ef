"""Sharding by a keyed permutation of global row numbers.

A Feistel network permutes the row numbers 0..n-1; values that leave this range are
walked on along their cycle until they return. Row r then lies in shard p(r) mod s at
slot p(r) div s: counts differ by one at most, slots have no gaps, and both can be
computed for any row number without data (``locate``), or backwards (``row_at``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Prime and multipliers of the round function (Lehmer generators).
PRIME, MULTIPLY, AGAIN = 2147483647, 48271, 69621
ROUND_KEYS = (374761393, 668265263, 2246822519 % PRIME, 1274126177)
#: Row numbers are counted within so many groups of ids, then offset by the groups before.
GROUPS = 4096


def half_bits(n: int) -> int:
    """Bits of each half of the smallest even-width domain that holds 0..n-1."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _rounds(x: np.ndarray, bits: int, keys: tuple[int, ...]) -> np.ndarray:
    mask = np.int64((1 << bits) - 1)
    left, right = x >> bits, x & mask
    for key in keys:
        mixed = (right + key) % PRIME * MULTIPLY % PRIME * AGAIN % PRIME
        left, right = right, left ^ (mixed & mask)
    return left << bits | right


def permute(rows: np.ndarray, n: int, keys: tuple[int, ...] = ROUND_KEYS) -> np.ndarray:
    """Where rows 0..n-1 go under the permutation of 0..n-1 (n below 2**62)."""
    bits = half_bits(n)
    out = _rounds(np.asarray(rows, np.int64), bits, keys)
    while len(beyond := np.flatnonzero(out >= n)):
        out[beyond] = _rounds(out[beyond], bits, keys)
    return out


def unpermute(places: np.ndarray, n: int, keys: tuple[int, ...] = ROUND_KEYS) -> np.ndarray:
    """The inverse of ``permute``."""
    bits = half_bits(n)
    swap = lambda x: (x & ((1 << bits) - 1)) << bits | x >> bits
    back = lambda x: swap(_rounds(swap(x), bits, keys[::-1]))
    out = back(np.asarray(places, np.int64))
    while len(beyond := np.flatnonzero(out >= n)):
        out[beyond] = back(out[beyond])
    return out


def locate(row: int, n: int, shards: int) -> tuple[int, int]:
    """Shard and slot of row number ``row`` of ``n``."""
    place = int(permute(np.array([row]), n)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, n: int, shards: int) -> int:
    """The row number at a shard's slot."""
    return int(unpermute(np.array([slot * shards + shard]), n)[0])


def shard_rows(df: DataFrame, shards: int, number: str = "row_number", total: int | None = None) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long) to rows that have a global ``number``."""
    n = df.count() if total is None else total

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n))

    return (df.withColumn("_place", place(number))
            .withColumn("shard", (F.col("_place") % shards).cast("int"))
            .withColumn("slot", F.expr(f"_place div {shards}"))
            .drop("_place"))


def numbered(df: DataFrame, id_column: str, order: list[str]) -> tuple[DataFrame, int]:
    """Add ``row_number``: 0, 1, 2, … over all rows in a fixed order, and give their count.

    The order is that of a group made from the id (and the first column of ``order``),
    then id, then ``order``, so that no task sorts more than its groups and the driver
    sees one count for each of ``GROUPS`` groups. Rows equal in all of these columns are
    interchangeable; a null id counts as 0 for the group and comes first.
    """
    spark = df.sparkSession
    spread = f"(pmod(coalesce({id_column}, 0), {PRIME}) * {MULTIPLY}) % {PRIME} * {AGAIN} % {PRIME}"
    df = df.withColumn("_group", F.expr(f"cast(({spread} + coalesce({order[0]}, 0)) % {GROUPS} as int)"))
    counts = dict(df.groupBy("_group").count().collect())  # at most GROUPS rows
    before, offsets = 0, []
    for group in range(GROUPS):
        offsets.append((group, before))
        before += counts.get(group, 0)
    offset = spark.createDataFrame(offsets, "_group int, _offset long")
    inside = Window.partitionBy("_group").orderBy(F.asc_nulls_first(id_column), *order)
    ranked = df.withColumn("_rank", F.row_number().over(inside))
    out = ranked.join(F.broadcast(offset), "_group").withColumn("row_number", F.col("_offset") + F.col("_rank") - 1)
    return out.drop("_group", "_offset", "_rank"), before


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Shard and slot of each document under the ``rows`` law.

    Returns doc_id, size (UTF-8 bytes plus 16), text_crc32, law, shard, slot,
    grown_shard (always null: this law moves rows when a shard is added). Counts of the
    shards differ by one at most. Texts never leave their scan task. A null text has
    no bytes; repeated ids and rows are kept; an empty table gives no rows.
    """
    small = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    rows, n = numbered(small, "doc_id", ["text_crc32", "size"])
    return shard_rows(rows, shards, total=n).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{folder}/documents.parquet"))


# CRC-32 of the UTF-8 bytes by its bitwise table; the walk along a cycle is a recursion.
SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
      lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) t(i))),
sized AS (
  SELECT doc_id, (len(octets) + 16)::BIGINT AS size,
    xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, octets),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda b: ('0x' || b)::BIGINT) AS octets FROM documents), crc_table),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY
    ((((coalesce(doc_id, 0) % {PRIME} + {PRIME}) % {PRIME}) * {MULTIPLY}) % {PRIME} * {AGAIN} % {PRIME} + text_crc32) % {GROUPS},
    doc_id NULLS FIRST, text_crc32, size) - 1 AS r, count(*) OVER () AS n FROM sized),
shaped AS (SELECT *, greatest(1, (length(bin(greatest(n - 1, 1))) + 1) // 2)::INTEGER AS h FROM numbered),
walk AS (
  SELECT doc_id, size, text_crc32, n, h, r, r AS x, 0 AS k, 0::BIGINT AS first FROM shaped
  UNION ALL
  SELECT doc_id, size, text_crc32, n, h, r,
    ((x & ((1::BIGINT << h) - 1)) << h) | xor(x >> h,
      ((((x & ((1::BIGINT << h) - 1)) + [{', '.join(map(str, ROUND_KEYS))}][k % 4 + 1]) % {PRIME} * {MULTIPLY} % {PRIME} * {AGAIN} % {PRIME}) & ((1::BIGINT << h) - 1))),
    k + 1, first
  FROM walk WHERE k = 0 OR k % 4 <> 0 OR x >= n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % 40)::INTEGER AS shard, (x // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM walk WHERE k > 0 AND k % 4 = 0 AND x < n
"""
