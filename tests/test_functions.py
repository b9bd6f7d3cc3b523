import pytest
from pyspark.sql import functions as F

from keyflow.functions import envelope as E
from keyflow.functions import sharding, text, traits
from keyflow.sources.tables import records_from_table


def one(spark, *columns, row=None, schema=None):
    df = spark.range(1) if row is None else spark.createDataFrame([row], schema)
    return df.select(*columns).first()


@pytest.mark.parametrize(("wire", "kind"), [(-1, 0), (0, 1), (1, 2), (99, 0), (None, 0)])
def test_timestamp_kind(spark, wire, kind):
    ts = E.decode_timestamp("t", "ms")
    got = one(spark, ts.alias("ts"), row=(wire, 1234), schema="t int, ms bigint").ts
    assert got.ts_kind == kind
    assert got.ts_millis == (1234 if kind else None)
    assert (got.event_ts is None) == (kind == 0)


KEYS = [(b"plain", "plain", "raw"), (b"", "", "raw"), (None, "3", "partition"), (b"\xff\xfe", "//4=", "base64"), (b"3", "3", "raw")]


@pytest.mark.parametrize(("key", "expected", "source"), KEYS)
def test_key(spark, key, expected, source):
    columns = E.normalise_key("k", "p")
    got = one(spark, *[c.alias(n) for n, c in columns.items()], row=(key, 3), schema="k binary, p int")
    assert (got.key_str, got.key_source) == (expected, source)


@pytest.mark.parametrize(
    ("value", "kind", "shown"),
    [(None, "tombstone", None), (b"", "empty", ""), (b"ab", "present", "ab"), (b"\xff", "present", None)],
)
def test_value(spark, value, kind, shown):
    got = one(spark, E.payload_kind("v").alias("k"), E.value_text("v").alias("t"), row=(value,), schema="v binary")
    assert (got.k, got.t) == (kind, shown)


def test_lossy_text(spark):
    got = one(spark, text.lossy_text("v").alias("t"), row=(b"a\xffb",), schema="v binary")
    assert got.t == "a�b"


@pytest.mark.parametrize(
    ("s", "limit", "expected"),
    [
        ("abc", 8, "abc"), ("abc", 3, "abc"), ("abcdef", 4, "abcd"), ("aébc", 3, "aé"), ("aébc", 2, "a"), ("é", 1, ""),
        ("", 4, ""), ("a😀b", 5, "a😀"), ("a😀b", 4, "a"), ("😀", 3, ""), ("abc", 0, ""),
    ],
)
def test_truncate(spark, s, limit, expected):
    assert one(spark, text.truncate_utf8("s", limit).alias("t"), row=(s,), schema="s string").t == expected


def test_truncate_long_text(spark):
    s = "é" * 100_000
    assert one(spark, text.truncate_utf8("s", 1025).alias("t"), row=(s,), schema="s string").t == "é" * 512


HEADERS = [("a", b"1"), ("b", None), ("a", b"2"), ("c", b"")]
HEADER_SCHEMA = "h array<struct<key:string,value:binary>>"


def test_headers(spark):
    got = one(
        spark,
        E.header_count("h").alias("n"),
        E.header_at("h", 2).alias("third"),
        E.header_at("h", 4).alias("outside"),
        E.header_find("h", "a").alias("a"),
        E.header_find("h", "b").alias("b"),
        E.header_find("h", "zz").alias("none"),
        E.header_find("h", "c").alias("c"),
        row=(HEADERS,),
        schema=HEADER_SCHEMA,
    )
    assert got.n == 4
    assert (got.third.key, got.third.value, got.outside) == ("a", b"2", None)
    assert got.a.value == b"1"
    assert got.b is not None and got.b.value is None
    assert got.none is None
    assert got.c.value == b""


def test_no_headers(spark):
    df = spark.createDataFrame([(1, None), (2, [])], f"id int, {HEADER_SCHEMA}")
    assert [r.n for r in df.select(E.header_count("h").alias("n")).collect()] == [0, 0]
    assert [tuple(r) for r in E.explode_headers(df, "h").collect()] == [(1, None, None, None), (2, None, None, None)]


def test_explode_headers_keeps_order_and_duplicates(spark):
    df = spark.createDataFrame([(1, HEADERS)], f"id int, {HEADER_SCHEMA}")
    rows = E.explode_headers(df, "h").collect()
    assert [(r.header_pos, r.header_key, r.header_value) for r in rows] == [
        (0, "a", b"1"), (1, "b", None), (2, "a", b"2"), (3, "c", b"")
    ]


def test_bad_header_key_becomes_empty(spark):
    df = spark.sql("select array(named_struct('key', cast(X'FF' as string), 'value', X'01')) as h")
    got = df.select(E.clean_header_keys("h").alias("h")).first().h
    assert (got[0].key, got[0].value) == ("", b"\x01")


def test_trait_bits(spark):
    got = one(
        spark,
        traits.trait_bits().alias("none"),
        traits.trait_bits(5, 9, 64, -1).alias("ignored"),
        traits.trait_bits(10, 63).alias("both"),
        traits.trait_or(traits.trait_bits(10), traits.trait_when(F.lit(True), 11), traits.trait_when(F.lit(False), 12)).alias("o"),
    )
    assert got.none == 0 and got.ignored == 0
    assert got.both & ((1 << 64) - 1) == 1 << 10 | 1 << 63
    assert got.o == 1 << 10 | 1 << 11


def test_decode_traits(spark):
    df = spark.createDataFrame([(1 << 45 | 0b1011,)], "traits bigint")
    got = traits.decode_traits(df).first()
    assert (got.has_process_error, got.has_process_panic, got.has_dead_letter, got.has_commit_buffered) == (True, True, False, True)
    assert got.app_bits == 1 << 45
    named = {r.bit: r.trait for r in traits.explode_traits(df, {45: "vip"}).collect()}
    assert named == {0: "process_error", 1: "process_panic", 3: "commit_buffered", 45: "vip"}


DURATIONS = [
    (0, "0s"), (517, "517µs"), (1_517, "1.517ms"), (92_000, "92ms"), (3_000, "3ms"), (150_000_000, "2m30s"), (1_000_000, "1s"),
    (600_000_000, "10m0s"), (3_600_500_000, "1h0m0.5s"), (-1_500, "-1.5ms"), (86_399_999_999, "23h59m59.999999s"),
]


@pytest.mark.parametrize(("us", "shown"), DURATIONS)
def test_duration_text(spark, us, shown):
    got = one(spark, text.format_duration("us").alias("t"), row=(us,), schema="us bigint")
    assert got.t == shown
    assert one(spark, text.parse_duration("t").alias("us"), row=(shown,), schema="t string").us == us


@pytest.mark.parametrize(
    ("s", "us"),
    [("1.5h", 5_400_000_000), ("0", 0), ("2us", 2), ("2µs", 2), ("1500ns", 1), (".5s", 500_000), ("+1s", 1_000_000),
     ("", None), ("5", None), ("fast", None), ("1s2", None), (None, None), ("1h-2m", None)],
)
def test_parse_duration(spark, s, us):
    assert one(spark, text.parse_duration("t").alias("us"), row=(s,), schema="t string").us == us


def fnv(data: bytes) -> int:
    h = sharding.FNV_OFFSET_BASIS
    for b in data:
        h = (h ^ b) * sharding.FNV_PRIME & sharding.FNV_MASK
    return h


@pytest.mark.parametrize("key", ["foobar", "", "é", "😀x", "a\0b", "//4="])
def test_shard(spark, key):
    got = one(spark, sharding.fnv1a_32("k").alias("h"), sharding.key_shard("k", 8).alias("s"), row=(key,), schema="k string")
    assert got.h == fnv(key.encode()) and got.s == got.h % 8


def test_known_hash():
    assert fnv(b"foobar") == 3214735720


@pytest.mark.parametrize("bad", [1, 3, 65, 128, -2])
def test_bad_shard_count(bad):
    with pytest.raises(ValueError):
        sharding.check_shards(bad)


def test_default_shard_count():
    assert sharding.check_shards(0) == 16 and sharding.check_shards(64) == 64


def test_envelope_from_table(spark):
    df = spark.createDataFrame([("t", 1, 5, None, b"")], "topic string, p int, o bigint, k binary, v binary")
    out = records_from_table(df, {"topic": "topic", "partition": "p", "offset": "o", "key": "k", "value": "v"})
    row = out.first()
    assert (row.key, row.value, row.key_str, row.ts_kind, row.ts_millis, row.headers) == (None, b"", "1", 0, None, None)
    with pytest.raises(ValueError):
        records_from_table(df, {"topic": "topic"})


def test_durations_out_of_range_are_none(spark):
    df = spark.createDataFrame([("123456789012ms",), ("9" * 40 + "s",), ("999999999999999h",)], "s string")
    assert [r[0] for r in df.select(text.parse_duration("s")).collect()] == [123456789012000, None, None]
