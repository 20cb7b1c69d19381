"""A Bloom filter in column functions: rows that cannot have a partner go before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Words of 64 bits: the bound of what is broadcast. Each key sets ``BITS`` bits of one word.
WORDS = 1 << 19
BITS = 3


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: str) -> Column:
    again = F.xxhash64(F.lit(1), key)
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.pmod(F.shiftright(again, 6 * i), F.lit(64)).cast("int")) for i in range(BITS)]
    found = bits[0]
    for bit in bits[1:]:
        found = found.bitwiseOR(bit)
    return found


def bloom_filter(keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """``(_word, _bits)`` over all values of ``key``: at most ``words`` rows, whatever the number of keys."""
    return keys.groupBy(_word(key, words).alias("_word")).agg(F.bit_or(_mask(key)).alias("_bits"))


def maybe_in(rows: DataFrame, key: str, bloom: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows whose ``key`` may be one of the filter's: all that are, and few others while keys are fewer than words.

    The filter is broadcast, so rows are dropped where they are read. With many more keys
    than words it lets most rows pass, and does no harm.
    """
    found = rows.withColumn("_word", _word(key, words)).join(F.broadcast(bloom), "_word")
    return found.filter(F.col("_bits").bitwiseAND(_mask(key)) == _mask(key)).select(*rows.columns)
