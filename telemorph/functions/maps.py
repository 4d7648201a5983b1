"""Typed attribute maps: building, merging, lookups with defaults.

Repeated keys keep the last value, which needs the session setting in
``telemorph.session``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULTS = {"string": "", "number": 0.0, "bool": False}


def arrays_to_map(keys: Column, values: Column) -> Column:
    return F.map_from_arrays(keys, values)


def merge_number_attrs(int_keys: Column, int_values: Column, float_keys: Column, float_values: Column) -> Column:
    """One number map out of integer and float lists; the float value wins."""
    return F.map_from_arrays(
        F.concat(int_keys, float_keys),
        F.concat(int_values.cast("array<double>"), float_values),
    )


def array_lookup(keys: Column, values: Column, key: Column, default: Column) -> Column:
    """Value stored beside ``key``; the type default when the key is missing."""
    return F.coalesce(F.get(values, F.array_position(keys, key).cast("int") - F.lit(1)), default)


def map_lookup(attrs: Column, key: Column | str, default: Column) -> Column:
    key = key if isinstance(key, Column) else F.lit(key)
    return F.coalesce(F.try_element_at(attrs, key), default)


def has_key(attrs: Column, key: Column | str) -> Column:
    key = key if isinstance(key, Column) else F.lit(key)
    return F.coalesce(F.map_contains_key(attrs, key), F.lit(False))


def empty_map(value_type: str = "string") -> Column:
    return F.create_map().cast(f"map<string,{value_type}>")


def sorted_map(attrs: Column) -> Column:
    """The same map with its entries in byte order of the keys."""
    return F.map_from_entries(F.array_sort(F.map_entries(attrs)))


def map_json(attrs: Column) -> Column:
    """Canonical JSON text of a map: sorted keys, ``{}`` for none."""
    return F.coalesce(F.to_json(sorted_map(attrs)), F.lit("{}"))


def drop_reserved_keys(attrs: Column) -> Column:
    return F.map_filter(attrs, lambda k, _: ~F.startswith(k, F.lit("__")))
