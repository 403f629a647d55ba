"""Which stored days may hold given keys, without reading those days.

Every stored day keeps the smallest and largest value of its key's first column and a Bloom filter of
its keys, as rows: (broad_dt, word, bits), 64 bits a word, made by one grouped ``bit_or``. New keys
meet the words of their bits by an equi-join; a day that has all bits of a key may hold it, and only
such days are read for the exact answer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
HASHES = 6
_LEAST_BITS = 1 << 10


def filter_bits(n_keys: int) -> int:
    """Size of a day's filter: a power of two, at least ``BITS_PER_KEY`` bits a key."""
    bits = _LEAST_BITS
    while bits < n_keys * BITS_PER_KEY:
        bits *= 2
    return bits


def _bits(key: tuple[str, ...], n_bits: Column) -> Column:
    """The positions of a key's bits in a filter of ``n_bits``."""
    first = F.pmod(F.xxhash64(*key), n_bits)
    step = F.pmod(F.xxhash64(*key, F.lit("step")), n_bits)
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda k: F.pmod(first + k * step, n_bits))


def day_filters(rows: DataFrame, key: tuple[str, ...], bits: dict[str, int]) -> DataFrame:
    """Rows (broad_dt, word, bits): the filter of every day of ``rows``; ``bits``: size by day, a few
    numbers (the days of one load)."""
    sizes = F.create_map(*[x for day, n in sorted(bits.items()) for x in (F.lit(day), F.lit(n).cast("long"))])
    return (rows.select("broad_dt", F.explode(_bits(key, sizes[F.col("broad_dt")])).alias("at"))
            .groupBy("broad_dt", F.expr("at div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")))


@dataclass(frozen=True)
class StoredDay:
    """A stored day as the manifest knows it: its smallest and largest first key value, filter size."""

    low: int
    high: int
    n_bits: int


def overlapping_days(stored: dict[str, StoredDay], low: int, high: int) -> list[str]:
    """Stored days whose first key column spans some value from ``low`` to ``high``."""
    return sorted(day for day, d in stored.items() if d.low <= high and low <= d.high)


def days_that_may_hold(rows: DataFrame, key: tuple[str, ...], filters: DataFrame, stored: dict[str, StoredDay]) -> list[str]:
    """Days of ``filters`` (broad_dt, word, bits) that may hold a key of ``rows``."""
    sizes = sorted({d.n_bits for d in stored.values()})
    if not sizes:
        return []
    of_day = F.create_map(*[x for day, d in sorted(stored.items()) for x in (F.lit(day), F.lit(d.n_bits).cast("long"))])
    keys = rows.select(*key).distinct()
    asked = (keys.withColumn("n_bits", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
             .withColumn("at", F.explode(F.array_distinct(_bits(key, F.col("n_bits")))))
             .select(*key, "n_bits", F.expr("at div 64").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit")))
    wanted = asked.groupBy(*key, "n_bits").agg(F.count("*").alias("n_asked"))
    met = (asked.join(filters.withColumn("n_bits", of_day[F.col("broad_dt")]), ["n_bits", "word"])
           .where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
           .groupBy(*key, "n_bits", "broad_dt").agg(F.count("*").alias("n_met")))
    hit = met.join(wanted, [*key, "n_bits"]).where(F.col("n_met") == F.col("n_asked")).select("broad_dt").distinct()
    return sorted(r["broad_dt"] for r in hit.collect())  # few strings: stored days
