"""Spectral indices, masks and reflectance as Column expressions. Missing is null throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from greensward import config


def ratio(num: Column, den: Column) -> Column:
    """Null where the denominator is 0."""
    return F.try_divide(num, den)


def ndvi(nir: Column, red: Column) -> Column:
    return ratio(nir - red, nir + red)


def evi2(nir: Column, red: Column) -> Column:
    return ratio(2.5 * (nir - red), nir + 2.4 * red + 1.0)


def ndmi(nir08: Column, swir16: Column) -> Column:
    return ratio(nir08 - swir16, nir08 + swir16)


def nbr(nir08: Column, swir22: Column) -> Column:
    return ratio(nir08 - swir22, nir08 + swir22)


def savi(nir: Column, red: Column, soil: float = 0.5) -> Column:
    """The factor is 1.5 whatever ``soil`` is."""
    return ratio(1.5 * (nir - red), nir + red + soil)


def bsi(blue: Column, nir: Column, red: Column, swir16: Column) -> Column:
    return ratio((swir16 + red) - (nir + blue), (swir16 + red) + (nir + blue))


def dnbr(pre: Column, post: Column) -> Column:
    return pre - post


INDICES: dict[str, Callable[..., Column]] = {"ndvi": ndvi, "evi2": evi2, "ndmi": ndmi, "nbr": nbr, "savi": savi, "bsi": bsi}


def index_column(name: str, sensor: str = "s2") -> Column:
    """An index by name over columns named like the bands."""
    if name not in INDICES:
        raise ValueError(f"unknown index {name!r}; known: {sorted(INDICES)}")
    bands = config.INDEX_BANDS[name]
    if sensor in ("landsat", "hls"):
        bands = tuple("nir08" if b == "nir" else b for b in bands)
    return INDICES[name](*map(F.col, bands))


def usable_indices(columns: list[str], sensor: str = "s2") -> list[str]:
    """Indices all of whose bands are there."""
    swap = {"nir": "nir08"} if sensor in ("landsat", "hls") else {}
    return [n for n, bands in config.INDEX_BANDS.items() if all(swap.get(b, b) in columns for b in bands)]


def clear_scl(scl: Column) -> Column:
    return scl.isin(*config.CLEAR_SCL)


def clear_landsat(qa: Column) -> Column:
    return qa.bitwiseAND(config.LANDSAT_QA_BITS) == 0


def clear_hls(qa: Column) -> Column:
    return qa.bitwiseAND(config.HLS_QA_BITS) == 0


def masked(value: Column, clear: Column) -> Column:
    return F.when(clear, value)


def scale_offset(sensor: Column, date: Column, processing: Column | None = None, cutoff: str = "2022-01-25", own: tuple[Column, Column] | None = None) -> tuple[Column, Column]:
    """Reflectance scale and offset by sensor; for s2 by processing baseline, else by date.

    Where a scene brings its own scale (``own``: scale, offset), both are its own; its offset is 0 if it has none.
    """
    new = date >= F.lit(cutoff).cast("date")
    if processing is not None:
        new = F.coalesce(processing >= 4.0, new)
    scale = F.when(sensor == "landsat", 2.75e-5).otherwise(1e-4)
    offset = F.when(sensor == "landsat", -0.2).when((sensor != "hls") & new, -0.1).otherwise(0.0)
    if own is not None:
        scale, offset = F.coalesce(own[0].cast("double"), scale), F.when(own[0].isNotNull(), F.coalesce(own[1].cast("double"), F.lit(0.0))).otherwise(offset)
    return scale, offset


def reflectance(raw: Column, scale: Column, offset: Column, floor_zero: bool = True) -> Column:
    """0 is fill; others are scaled and, unless told otherwise, floored at 0."""
    v = F.nullif(raw.cast("double"), F.lit(0.0)) * scale + offset
    return F.when(v.isNotNull(), F.greatest(v, F.lit(0.0))) if floor_zero else v


def sentinel_to_null(v: Column, sentinel: float = -9990.0) -> Column:
    return F.when(v > sentinel, v)
