"""Run-time membership filter: drops, in the scan, most rows whose key cannot meet a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20  # 128 KB in every task, whatever the number of keys


def may_hold(keys: DataFrame, key: str, bits: int = BITS) -> Column:
    """Condition on column ``key`` of another table: false only for values that ``keys`` does not hold.

    The hashes of the keys set bits of a fixed number of longs (one scalar subquery, combined
    per task before its shuffle), so the filter's size is bounded and proven: with many more keys
    than ``bits`` it lets everything pass, and results never change, as the join that follows
    stays. Both columns must have one type. A NULL is treated like any value.
    """
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits must be a power of two, 64 at least")
    place = F.xxhash64(key).bitwiseAND(F.lit(bits - 1))
    word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    # One row without a bit for every word, so that the array holds them all in order.
    blank = keys.sparkSession.range(0, bits // 64, 1, 1).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    words = (keys.select(word.alias("_word"), one.alias("_bits")).unionByName(blank)
             .groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
             .agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_words"))
             .select(F.col("_words").getField("_bits").alias("_words")))
    return F.getbit(F.get(words.scalar(), word.cast("int")), bit) == 1
