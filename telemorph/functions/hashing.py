"""64-bit label fingerprints and canonical label text.

The hash is FNV-1a over the UTF-8 bytes of ``key 0xFF value 0xFF`` for the keys
in byte order. Spark has no unsigned 64-bit integer and checks overflow, so the
running state is held as two 32-bit halves in BIGINTs. With the prime written as
2^40 + 435, one byte moves the state like this::

    x   = lo xor byte
    lo' = (x * 435) mod 2^32
    hi' = (hi * 435 + (x * 435) / 2^32 + x * 2^8) mod 2^32
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemorph.functions.maps import map_json

# Fixed values of the hash.
FNV_OFFSET = 14695981039346656037
PRIME_LOW = 435
SEPARATOR = "FF"

_MASK = 0xFFFFFFFF


def _hex(text: Column) -> Column:
    return F.hex(F.encode(text, "UTF-8"))


def map_bytes(attrs: Column) -> Column:
    """Hex text of the bytes a label map contributes to the hash."""
    entries = F.array_sort(F.map_entries(attrs))
    parts = F.transform(
        entries,
        lambda e: F.concat(_hex(e["key"]), F.lit(SEPARATOR), _hex(e["value"]), F.lit(SEPARATOR)),
    )
    return F.coalesce(F.array_join(parts, ""), F.lit(""))


def name_bytes(name: Column) -> Column:
    """The metric name closes a series hash without a trailing separator."""
    return F.concat(_hex(F.lit("__name__")), F.lit(SEPARATOR), _hex(name))


def fnv64(hex_text: Column, offset: int = FNV_OFFSET) -> Column:
    """Hash of hex-encoded bytes as DECIMAL(20,0)."""
    start = F.struct(
        F.lit(offset >> 32).cast("bigint").alias("hi"),
        F.lit(offset & _MASK).cast("bigint").alias("lo"),
    )

    def step(state: Column, byte: Column) -> Column:
        x = state["lo"].bitwiseXOR(F.conv(byte, 16, 10).cast("bigint"))
        product = x * F.lit(PRIME_LOW)
        hi = state["hi"] * F.lit(PRIME_LOW) + F.shiftright(product, 32) + F.shiftleft(x, 8)
        return F.struct(
            hi.bitwiseAND(F.lit(_MASK)).alias("hi"),
            product.bitwiseAND(F.lit(_MASK)).alias("lo"),
        )

    def as_decimal(state: Column) -> Column:
        high = state["hi"].cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)")
        return (high + state["lo"].cast("decimal(20,0)")).cast("decimal(20,0)")

    return F.aggregate(F.regexp_extract_all(hex_text, F.lit(".."), F.lit(0)), start, step, as_decimal)


def fingerprint(attrs: Column, offset: int = FNV_OFFSET, extras: dict[str, Column] | None = None) -> Column:
    """Hash of one label map, optionally with extra entries."""
    return fnv64(map_bytes(with_extras(attrs, extras)), offset)


def with_extras(attrs: Column, extras: dict[str, Column] | None) -> Column:
    if not extras:
        return attrs
    pairs = [part for key, value in extras.items() for part in (F.lit(key), value)]
    return F.map_concat(attrs, F.create_map(*pairs))


def series_fingerprint(resource: Column, scope: Column, point: Column, name: Column) -> Column:
    """Series id. Every map starts from the hash of the one before, which is
    the hash of the joined bytes, so one pass over all bytes is enough.
    ``point`` must already hold the ``__temporality__`` entry."""
    return fnv64(F.concat(map_bytes(resource), map_bytes(scope), map_bytes(point), name_bytes(name)))


def resource_fingerprint(resource: Column) -> Column:
    """Text id of a log or span resource map."""
    return fnv64(map_bytes(resource)).cast("string")


def resource_json(resource: Column) -> Column:
    return map_json(resource)


def _escape(value: Column) -> Column:
    # Only these five characters are escaped; everything else is kept as is.
    for raw, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        value = F.replace(value, F.lit(raw), F.lit(written))
    return value


def labels_json(name: Column, *maps: Column) -> Column:
    """Labels of a series as JSON text with sorted keys; later maps win."""
    merged = F.map_concat(*maps, F.create_map(F.lit("__name__"), name))
    parts = F.transform(
        F.array_sort(F.map_entries(merged)),
        lambda e: F.concat(F.lit('"'), e["key"], F.lit('":"'), _escape(e["value"]), F.lit('"')),
    )
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
