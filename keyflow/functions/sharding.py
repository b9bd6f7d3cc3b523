"""Key sharding: the 32-bit FNV-1a hash of the key's UTF-8 bytes, cut to a power-of-two number of shards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters of the public 32-bit FNV-1a hash.
FNV_OFFSET_BASIS = 2166136261
FNV_PRIME = 16777619
FNV_MASK = 0xFFFFFFFF

# Allowed shard counts.
DEFAULT_SHARDS = 16
MIN_SHARDS = 2
MAX_SHARDS = 64


def check_shards(shards: int) -> int:
    """0 selects the default; otherwise a power of two from 2 to 64."""
    if shards == 0:
        return DEFAULT_SHARDS
    if shards < MIN_SHARDS or shards > MAX_SHARDS or shards & (shards - 1):
        raise ValueError(f"shards must be a power of two from {MIN_SHARDS} to {MAX_SHARDS}, got {shards}")
    return shards


def fnv1a_32(text: Column | str) -> Column:
    """Hash over the bytes of the text, not its characters."""
    s = F.col(text) if isinstance(text, str) else text
    raw = s.cast("binary")
    # One character per byte, so that its code point is the byte.
    by_byte = F.split(F.decode(raw, "ISO-8859-1"), "")
    hashed = F.aggregate(
        by_byte,
        F.lit(FNV_OFFSET_BASIS).cast("bigint"),
        lambda h, c: (h.bitwiseXOR(F.ascii(c).cast("bigint")) * FNV_PRIME).bitwiseAND(F.lit(FNV_MASK).cast("bigint")),
    )
    return F.when(F.octet_length(raw) == 0, F.lit(FNV_OFFSET_BASIS).cast("bigint")).otherwise(hashed)


def key_shard(key_str: Column | str, shards: int = DEFAULT_SHARDS) -> Column:
    n = check_shards(shards)
    return fnv1a_32(key_str).bitwiseAND(F.lit(n - 1).cast("bigint")).cast("int")
