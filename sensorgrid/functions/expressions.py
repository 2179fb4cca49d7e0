"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------------------------
EARTH_RADIUS_M = 6_371_008.8
DEGREE_SCALE = 100_000  # fixed-point coordinates are degrees times this
FACTOR_MAX = 5.0
FACTOR_MIN = 0.1
VOLUME_ZERO = 0.001  # volumes up to this count as zero
FEATURE_GROUPS = {  # text found in the feature name: group; the first hit counts
    "land_": "land_use",
    "str_": "street_class",
    "building": "buildings",
    "holiday": "holidays",
}
COORDINATES = ("x", "y")
# ----------------------------------------------------------------------------------------------

_HASH_RANGE = 2**32


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_number(key: Sequence[str], seed: int) -> Column:
    """First 32 bits of md5 over the key columns and the seed, as a bigint. It depends on the
    row alone, so it is the same after a retry and in any other engine."""
    text = F.concat_ws("|", *[_col(k).cast("string") for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def md5_fraction(key: Sequence[str], seed: int) -> Column:
    """Uniform number in [0, 1)."""
    return md5_number(key, seed) / F.lit(float(_HASH_RANGE))


def md5_bucket(key: Sequence[str], seed: int, buckets: int) -> Column:
    """Bucket 1 to ``buckets``."""
    return (md5_number(key, seed) % buckets + 1).cast("int")


def round_half_even(value: Column | str) -> Column:
    return F.rint(_col(value))


def non_negative(value: Column | str) -> Column:
    """Lower bound 0 that keeps NULL (``greatest`` would turn NULL into 0)."""
    v = _col(value)
    return F.when(v < 0, F.lit(0.0)).otherwise(v)


def scaling_factor(volume: Column | str, predicted: Column | str) -> Column:
    """Observed over predicted, held between bounds; the order of the branches matters.

    A prediction of zero acts as an infinite ratio for a positive volume. A zero volume over a
    zero prediction gives factor 0.
    """
    vol, pred = _col(volume), _col(predicted)
    ratio = vol / F.nullif(pred, F.lit(0.0))
    return (
        F.when((vol > 0) & ((pred == 0) | (ratio > FACTOR_MAX)), F.lit(FACTOR_MAX))
        .when(vol <= VOLUME_ZERO, F.lit(0.0))
        .when(ratio < FACTOR_MIN, F.lit(FACTOR_MIN))
        .otherwise(ratio)
    )


def degrees(fixed_point: Column | str) -> Column:
    return _col(fixed_point) / F.lit(float(DEGREE_SCALE))


def _half_angle_sine_squared(degrees_apart: Column) -> Column:
    s = F.sin(F.radians(degrees_apart) / 2)
    return s * s


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine of the central angle. It grows with the distance, so it can stand in for it
    wherever distances are only compared."""
    return _half_angle_sine_squared(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * _half_angle_sine_squared(lon2 - lon1)


def metres(hav: Column) -> Column:
    return F.asin(F.sqrt(F.least(hav, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def contains_name(text: Column | str, name: Column | str) -> Column:
    """Does ``text`` contain ``name``? An empty name matches nothing."""
    return F.contains(_col(text), _col(name)) & (_col(name) != "")


def feature_group(feature: Column | str) -> Column:
    """Group of a feature by its name; a feature outside all groups is its own."""
    name = _col(feature)
    group = F.when(F.lit(False), F.lit(None))
    for text, label in FEATURE_GROUPS.items():
        group = group.when(F.contains(name, F.lit(text)), F.lit(label))
    return group.when(name.isin(*COORDINATES), F.lit("coordinates")).otherwise(name)
