"""The 64-bit trait field: bits 0-9 are framework flags, bits 10-63 belong to the application."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow import schema as S

# Names of the framework flags by bit.
FRAMEWORK_FLAGS = {
    "has_process_error": 0,
    "has_process_panic": 1,
    "has_dead_letter": 2,
    "has_commit_buffered": 3,
    "has_duplicate": 4,
    "has_used_overflow": 5,
    "has_orphaned": 6,
    "has_first_after_rebalance": 7,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bit_value(n: int) -> int:
    """Bit ``n`` as a signed 64-bit integer."""
    value = 1 << n
    return value - (1 << 64) if n == 63 else value


def is_application_bit(n: int) -> bool:
    return S.FIRST_APPLICATION_BIT <= n <= S.LAST_APPLICATION_BIT


def trait_bits(*bits: int) -> Column:
    """Literal with the given application bits set; positions outside 10-63 are ignored."""
    wanted = [bit_value(n) for n in bits if is_application_bit(n)]
    return F.lit(reduce(lambda a, b: a | b, wanted, 0)).cast("bigint")


def trait_when(condition: Column, n: int) -> Column:
    """Application bit ``n`` where the condition holds, else no bit."""
    return F.when(condition, trait_bits(n)).otherwise(F.lit(0).cast("bigint"))


def trait_or(*traits: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), traits, F.lit(0).cast("bigint"))


def has_bit(traits: Column | str, n: int) -> Column:
    return F.bit_get(_col(traits), F.lit(n)) == 1


def application_bits(traits: Column | str) -> Column:
    return _col(traits).bitwiseAND(F.lit(~((1 << S.FIRST_APPLICATION_BIT) - 1)).cast("bigint"))


def decode_traits(df: DataFrame, traits: str = "traits") -> DataFrame:
    """Adds one boolean per framework flag and ``app_bits``."""
    flags = {name: has_bit(traits, n) for name, n in FRAMEWORK_FLAGS.items()}
    return df.withColumns({**flags, "app_bits": application_bits(traits)})


def explode_traits(df: DataFrame, names: Mapping[int, str] | None = None, traits: str = "traits") -> DataFrame:
    """One row per set bit with ``bit`` and ``trait`` (its name; ``bit_<n>`` when it has none)."""
    all_names = {n: name.removeprefix("has_") for name, n in FRAMEWORK_FLAGS.items()} | dict(names or {})
    lookup = F.create_map(*[F.lit(x) for n, name in sorted(all_names.items()) for x in (n, name)])
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda n: F.bit_get(_col(traits), n) == 1)
    exploded = df.withColumn("bit", F.explode(set_bits))
    return exploded.withColumn(
        "trait", F.coalesce(F.try_element_at(lookup, F.col("bit")), F.concat(F.lit("bit_"), F.col("bit").cast("string")))
    )


def trait_counts(df: DataFrame, names: Mapping[int, str] | None = None, traits: str = "traits") -> DataFrame:
    """Rows per set bit. Bits are counted before the shuffle, so at most 64 rows per task move."""
    return explode_traits(df.select(traits), names, traits).groupBy("bit", "trait").agg(F.count("*").alias("n"))
