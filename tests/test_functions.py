from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from telemorph.functions import hashing as H
from telemorph.functions import maps as M
from telemorph.functions import scalars as S


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def smap(*pairs):
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def python_fnv(data: bytes, h: int) -> int:
    for b in data:
        h = ((h ^ b) * 1099511628211) % 2**64
    return h


def test_fingerprint_known_values(spark):
    m = smap(("key1", "value1"), ("key2", "value2"))
    assert one(spark, H.fingerprint(m, 0)) == Decimal(4672270062576455370)
    assert one(spark, H.fingerprint(m, 0, {"key3": F.lit("value3")})) == Decimal(5425952980149109402)


def test_fingerprint_ignores_order_and_matches_plain_arithmetic(spark):
    a = smap(("é", "ü"), ("b", ""), ("a.b", "x"))
    b = smap(("a.b", "x"), ("é", "ü"), ("b", ""))
    plain = H.FNV_OFFSET
    for k, v in sorted({"é": "ü", "b": "", "a.b": "x"}.items(), key=lambda kv: kv[0].encode()):
        plain = python_fnv(k.encode() + b"\xff" + v.encode() + b"\xff", plain)
    assert one(spark, H.fingerprint(a)) == one(spark, H.fingerprint(b)) == Decimal(plain)


def test_empty_map_hashes_to_the_offset(spark):
    assert one(spark, H.fingerprint(M.empty_map())) == Decimal(H.FNV_OFFSET)
    assert one(spark, H.resource_json(M.empty_map())) == "{}"


def test_series_fingerprint_is_chained(spark):
    h = H.FNV_OFFSET
    for k, v in (("service.name", "s"), ("scope.ver", "1"), ("__temporality__", "Delta"), ("x", "y")):
        h = python_fnv(k.encode() + b"\xff" + v.encode() + b"\xff", h)
    h = python_fnv(b"__name__\xffm", h)
    got = H.series_fingerprint(
        smap(("service.name", "s")), smap(("scope.ver", "1")), smap(("x", "y"), ("__temporality__", "Delta")), F.lit("m")
    )
    assert one(spark, got) == Decimal(h)


def test_labels_json(spark):
    got = one(spark, H.labels_json(F.lit("m"), smap(("b", "1"), ("a", 'q"\\\n\r\t/<é>')), smap(("b", "2"))))
    assert got == '{"__name__":"m","a":"q\\"\\\\\\n\\r\\t/<é>","b":"2"}'


@pytest.mark.parametrize("value,bits,want", [(300, 8, 44), (-129, 8, 127), (127, 8, 127), (70000, 16, 4464), (2**63 - 1, 8, -1)])
def test_narrow_int(spark, value, bits, want):
    assert one(spark, S.narrow_int(F.lit(value).cast("bigint"), bits)) == want


def test_narrow_int_safe(spark):
    assert one(spark, S.narrow_int(F.lit(300), 8, wrap=False)) is None


def test_nanoseconds_keep_their_microseconds(spark):
    assert one(spark, F.unix_micros(S.ns_to_ts(F.lit(1704067200123456789).cast("bigint")))) == 1704067200123456


def test_bucket_and_hour_edges(spark):
    assert [one(spark, S.ts_bucket(F.lit(s).cast("bigint"))) for s in (1799, 1800, 3599)] == [0, 1800, 1800]
    lower, upper = S.align_to_hour(F.lit(3_600_000).cast("bigint"), F.lit(7_200_001).cast("bigint"))
    assert (one(spark, lower), one(spark, upper)) == (3_600_000, 10_800_000)


def test_last_duplicate_wins_and_floats_beat_integers(spark):
    m = M.arrays_to_map(F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.array(F.lit("1"), F.lit("2"), F.lit("3")))
    assert one(spark, m) == {"a": "3", "b": "2"}
    merged = M.merge_number_attrs(F.array(F.lit("k")), F.array(F.lit(1).cast("bigint")), F.array(F.lit("k")), F.array(F.lit(1.5)))
    assert one(spark, merged) == {"k": 1.5}


def test_missing_keys_read_as_defaults(spark):
    m = smap(("a", "1"))
    assert one(spark, M.map_lookup(m, "b", F.lit(""))) == "" and one(spark, M.has_key(m, "b")) is False
    keys, values = F.array(F.lit("a")), F.array(F.lit("1"))
    assert one(spark, M.array_lookup(keys, values, F.lit("b"), F.lit("-"))) == "-"
    assert one(spark, M.array_lookup(keys, values, F.lit("a"), F.lit("-"))) == "1"


def test_names(spark):
    assert one(spark, S.promoted_name(F.lit("Resource"), F.lit("String"), F.lit("telemetry.sdk.language"))) == "resource_string_telemetry$$sdk$$language"
    assert one(spark, S.sanitize_name(F.lit("a_b.c-é1"))) == "abc1"
    assert [one(spark, S.datatype_class(F.lit(d))) for d in ("Int64", "float64", "Bool", "String")] == ["number", "number", "bool", "string"]
    assert [one(spark, S.temporality(F.lit(d))) for d in ("Delta", "Cumulative", "delta")] == ["Delta", "Cumulative", "Unspecified"]
