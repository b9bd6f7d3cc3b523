"""Text helpers: lossy decode, byte-bounded truncation, duration and timestamp text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Duration units and their length in nanoseconds.
DURATION_UNITS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "μs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}
_NUMBER = r"(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)"
_UNIT = r"(?:ns|us|µs|μs|ms|s|m|h)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, n: int) -> Column:
    """Exact integer division (plain ``/`` goes through a double)."""
    return F.call_function("div", a, F.lit(n))


def lossy_text(binary: Column | str) -> Column:
    """Bytes as text, with the replacement character where they are not UTF-8."""
    return F.make_valid_utf8(_col(binary).cast("string"))


def truncate_utf8(text: Column | str, limit: int = 1024) -> Column:
    """Longest prefix of at most ``limit`` bytes that ends on a character boundary.

    A character has at most four bytes, so the answer is one of four byte lengths: linear in ``limit``, whatever the text.
    """
    s = _col(text)
    raw = s.cast("binary")
    prefixes = [F.try_validate_utf8(F.substring(raw, 1, max(limit - back, 0)).cast("string")) for back in range(4)]
    return F.when(F.octet_length(s) <= limit, s).otherwise(F.coalesce(*prefixes))


def cut_text(text: str, limit: int = 1024) -> str:
    """:func:`truncate_utf8` of a constant."""
    return text.encode()[:limit].decode(errors="ignore")


def utc_millis_text(ts: Column | str) -> Column:
    """Instant as ``yyyy-MM-ddTHH:mm:ss.SSSZ`` (the session time zone must be UTC)."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def utc_millis_text_of_micros(us: Column | str) -> Column:
    return utc_millis_text(F.timestamp_micros(_col(us)))


def decimal_text(value: Column, digits: int) -> Column:
    """``value / 10**digits`` of a non-negative integer as plain decimal text without trailing zeros."""
    whole = int_div(value, 10**digits).cast("string")
    fraction = value % 10**digits
    tail = F.rtrim(F.lpad(fraction.cast("string"), digits, "0"), F.lit("0"))
    return F.when(fraction == 0, whole).otherwise(F.concat(whole, F.lit("."), tail))


def format_duration(us: Column | str) -> Column:
    """Microseconds as duration text such as ``0s``, ``517µs``, ``1.517ms``, ``2m30s``, ``1h0m0.5s``."""
    value = _col(us).cast("bigint")
    size = F.abs(value)
    minute, hour = 60_000_000, 3_600_000_000
    seconds = F.concat(decimal_text(size % minute, 6), F.lit("s"))
    minutes = F.concat(int_div(size % hour, minute).cast("string"), F.lit("m"), seconds)
    text = (
        F.when(size == 0, "0s")
        .when(size < 1_000, F.concat(size.cast("string"), F.lit("µs")))
        .when(size < 1_000_000, F.concat(decimal_text(size, 3), F.lit("ms")))
        .when(size < minute, seconds)
        .when(size < hour, minutes)
        .otherwise(F.concat(int_div(size, hour).cast("string"), F.lit("h"), minutes))
    )
    return F.when(value < 0, F.concat(F.lit("-"), text)).otherwise(text)


def parse_duration(text: Column | str) -> Column:
    """Duration text to whole microseconds (finer parts are cut off); null when the text is not a duration."""
    s = _col(text)
    body = F.when(s.startswith("-") | s.startswith("+"), F.substring(s, 2, 1 << 30)).otherwise(s)
    part = F.lit(f"({_NUMBER})({_UNIT})")
    numbers, units = (F.regexp_extract_all(body, part, F.lit(group)) for group in (1, 2))
    unit_ns = F.create_map(*[F.lit(x) for pair in DURATION_UNITS.items() for x in pair])
    nanos = F.zip_with(
        numbers, units, lambda n, u: (n.try_cast("decimal(24,9)") * F.element_at(unit_ns, u).cast("decimal(13,0)")).cast("decimal(38,0)")
    )
    total = F.aggregate(nanos, F.lit(0).cast("decimal(38,0)"), lambda acc, n: (acc + n).cast("decimal(38,0)"))
    # Beyond 64 bits, or with longer numbers than any duration has, the text is not a duration.
    most = F.lit(str((2**63 - 1) * 1000)).cast("decimal(38,0)")
    micros = F.when(total <= most, F.call_function("div", total, F.lit(1000)).cast("bigint"))
    signed = F.when(s.startswith("-"), -micros).otherwise(micros)
    return F.when(body == "0", F.lit(0).cast("bigint")).when(body.rlike(f"^({_NUMBER}{_UNIT})+$"), signed)
