"""Location functions, all Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf16_units(x: Column) -> Column:
    """The UTF-16 code units of a string as longs."""
    points = F.transform(F.filter(F.split(x, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    return F.flatten(
        F.transform(points, lambda p: F.when(p > 0xFFFF, F.array(F.lit(0xD800).cast("long") + F.shiftright(p - 0x10000, 10), F.lit(0xDC00).cast("long") + (p - 0x10000).bitwiseAND(F.lit(0x3FF).cast("long")))).otherwise(F.array(p)))
    )


def fnv1a(x: Column) -> Column:
    """FNV-1a over UTF-16 units, 32 bits in a long."""
    return F.aggregate(utf16_units(x), F.lit(2166136261).cast("long"), lambda h, c: F.pmod(h.bitwiseXOR(c) * F.lit(16777619).cast("long"), F.lit(4294967296).cast("long")))


def jitter(seed: Column, salt: str) -> Column:
    """Deterministic, within 0.05 degrees."""
    return (F.pmod(fnv1a(F.concat(seed, F.lit(salt))), F.lit(10000).cast("long")).cast("double") / F.lit(10000.0) - F.lit(0.5)) * F.lit(0.1)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def squared_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return (lat1 - lat2) * (lat1 - lat2) + (lon1 - lon2) * (lon1 - lon2)


def bbox_center(b: Column) -> Column:
    """Centre of [west, south, east, north]; null without a box."""
    return F.when(b.isNotNull(), F.struct(((F.get(b, F.lit(1)) + F.get(b, F.lit(3))) / 2).alias("lat"), ((F.get(b, F.lit(0)) + F.get(b, F.lit(2))) / 2).alias("lon")))


def point(c: Column) -> Column:
    """[longitude, latitude] as a struct; null without one."""
    return F.when(c.isNotNull(), F.struct(F.get(c, F.lit(1)).alias("lat"), F.get(c, F.lit(0)).alias("lon")))
