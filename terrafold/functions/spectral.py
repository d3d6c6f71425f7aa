"""Digital numbers to reflectance, and reflectance to normalized indices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the Collection 2 surface-reflectance product.
REFLECTANCE_SCALE = 0.0000275
REFLECTANCE_OFFSET = -0.2
FILL_DN = 0

# Fixed value: stored in place of a missing index.
INDEX_NODATA = -9999.0

# Index name -> (first band, second band) of (first - second) / (first + second).
INDEX_BANDS = {
    "ndvi": ("B5", "B4"),
    "nbr": ("B5", "B7"),
    "ndwi": ("B3", "B5"),
}
# Fixed value: the bands that the three indices are made of.
REQUIRED_INDEX_BANDS = ("B3", "B4", "B5", "B7")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reflectance(dn: Column | str) -> Column:
    """Scale a digital number; the fill value becomes NULL."""
    dn = _col(dn).cast("double")
    return F.when(dn != FILL_DN, dn * F.lit(REFLECTANCE_SCALE) + F.lit(REFLECTANCE_OFFSET))


def normalized_difference(a: Column | str, b: Column | str) -> Column:
    """(a - b) / (a + b), NULL where the sum is zero or an input is missing."""
    a, b = _col(a), _col(b)
    return F.try_divide(a - b, a + b)


def spectral_index(name: str, band_columns: dict[str, Column | str]) -> Column:
    """One named index from reflectance columns keyed by band label."""
    first, second = INDEX_BANDS[name]
    return normalized_difference(band_columns[first], band_columns[second]).alias(name)


def spectral_indices(band_columns: dict[str, Column | str]) -> list[Column]:
    """All indices, in the order of ``INDEX_BANDS``."""
    missing = sorted(set(REQUIRED_INDEX_BANDS) - set(band_columns))
    if missing:
        raise ValueError(f"Missing required bands for spectral indices: {missing}")
    return [spectral_index(name, band_columns) for name in INDEX_BANDS]


def finite(value: Column | str) -> Column:
    """NULL for NaN and the infinities, the value otherwise."""
    v = _col(value)
    bad = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.when(~bad, v)


def encode_index(value: Column | str) -> Column:
    """Stored form of an index: single precision, missing written as the nodata value."""
    v = finite(_col(value).cast("float"))
    return F.coalesce(v, F.lit(INDEX_NODATA).cast("float"))


def decode_index(value: Column | str) -> Column:
    """Inverse of :func:`encode_index`, widened back to double."""
    v = _col(value).cast("double")
    return F.when(v != F.lit(INDEX_NODATA), v)
