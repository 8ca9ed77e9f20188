"""Which keys of a small new table a large old one holds, without moving the old one.

A *key filter* is a Bloom filter in table form: one row per 64-bit word, with the bits that the keys
of a table have set in it. Every key belongs to one word and sets a few bits there, so a filter is
built by one aggregation with partial sums of bits, its size is about two bytes a key, and looking
keys up is an equi-join on the word number: no filter ever has to fit into one task or the driver.
Most new keys meet a word without their bits and are known to be new; the few others are checked
against the old table itself, which is read once and filtered where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.operators.cleaning import dedupe
from millwright.sources.staging import stage

# Keys a word is made for on average, and bits a key sets: about one wrong hit in 300 keys.
KEYS_PER_WORD = 4
BITS_PER_KEY = 6
# Hits that are sent to all tasks; more are joined by a shuffle.
BROADCAST_HITS = 200_000


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _bits(h: Column) -> Column:
    """The bits of a key within its word, from a second hash of the first."""
    second = F.xxhash64(h)
    places = [F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_PER_KEY)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places])


def words_for(rows: int) -> int:
    """Words of a filter for so many keys."""
    return max(1, -(-rows // KEYS_PER_WORD))


def key_filter(table: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """``(word, bits, words)`` of the table's keys; null parts of a key are values like any other."""
    h = _hash(keys)
    marked = table.select(F.pmod(h, F.lit(words)).alias("word"), _bits(h).alias("_bits"))
    filled = marked.groupBy("word").agg(F.bit_or("_bits").alias("bits"))
    return filled.withColumn("words", F.lit(words).cast("bigint"))


def maybe_known(rows: DataFrame, keys: Sequence[str], filled: DataFrame, words: int) -> DataFrame:
    """The rows whose key the filter's table may hold; all others it does not hold."""
    h = _hash(keys)
    asked = rows.withColumns({"_word": F.pmod(h, F.lit(words)), "_bits": _bits(h)})
    held = filled.select("word", "bits")
    hit = (F.col("_word") == F.col("word")) & (F.col("bits").bitwiseAND(F.col("_bits")) == F.col("_bits"))
    return asked.join(held, hit, "left_semi").drop("_word", "_bits")


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    )


def known_keys(
    old: DataFrame, asked: DataFrame, keys: Sequence[str], filled: DataFrame, words: int
) -> DataFrame:
    """The keys of ``asked`` that ``old`` holds, one row each, staged.

    ``filled`` is the filter of ``old``. Hits of the filter are few; up to ``BROADCAST_HITS`` of them
    are sent to the tasks that read ``old``, so ``old`` is not shuffled.
    """
    keys = list(keys)
    hits = stage(maybe_known(asked.select(*keys).distinct(), keys, filled, words))
    few = hits.count() <= BROADCAST_HITS
    new = (F.broadcast(hits) if few else hits).alias("new")
    found = old.select(*keys).alias("old").join(new, _same_key(keys))
    return stage(found.select(*[F.col(f"new.{k}").alias(k) for k in keys]).distinct())


def dedupe_load(
    kept: DataFrame,
    load: DataFrame,
    keys: Sequence[str],
    filled: DataFrame,
    words: int,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The rows of a load that are new: first of their key in it, and no key of ``kept``.

    ``kept`` together with the result is what deduplicating all loads at once would keep, with
    earlier loads first. Only the load is shuffled.
    """
    keys = list(keys)
    first = stage(dedupe(load, keys, order_by))
    known = known_keys(kept, first, keys, filled, words)
    small = known.count() <= BROADCAST_HITS
    old = (F.broadcast(known) if small else known).alias("old")
    return first.alias("new").join(old, _same_key(keys), "left_anti")
