"""Anomaly, confidence, clearing type and tiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from greensward import config


def zscore(current: Column, mean: Column, std: Column, min_std: float = config.MIN_STD) -> Column:
    """A null or small spread counts as ``min_std``."""
    return (current - mean) / F.when(std > min_std, std).otherwise(F.lit(min_std))


def confidence(z: dict[str, Column], delta: dict[str, Column], spi: float = 0.0) -> Column:
    """0 to 3 by z-score and change of the indices that have a baseline; drought widens the z thresholds."""
    widen = config.DROUGHT_WIDENING if spi < config.DROUGHT_SPI else 0.0
    below = lambda n, zt, dt: F.coalesce((z[n] < zt - widen) & (delta[n] < dt), F.lit(False))
    some = lambda names, zt, dt: F.greatest(*[below(n, zt, dt) for n in names], F.lit(False), F.lit(False))
    moist = [n for n in ("ndmi", "nbr") if n in z]
    high = below("ndmi", config.Z_HIGH, config.DELTA_HIGH) & below("nbr", config.Z_HIGH, config.DELTA_HIGH) if len(moist) == 2 else F.lit(False)
    out = F.when(high, 3).when(some(moist, config.Z_MEDIUM, config.DELTA_MEDIUM), 2)
    return out.when(some(list(z), config.Z_LOW, config.DELTA_LOW), 1).otherwise(0).cast("tinyint")


def clearing(dnbr: Column, post_nbr: Column, bsi: Column) -> Column:
    """1 fire, 2 mechanical, 3 uncertain, 0 none."""
    return (
        F.when((dnbr > config.FIRE_DNBR) & (post_nbr < config.FIRE_POST_NBR), 1)
        .when((bsi > config.MECHANICAL_BSI) & (dnbr > config.MECHANICAL_DNBR), 2)
        .when(dnbr > config.UNCERTAIN_DNBR, 3)
        .otherwise(0)
    )


def persistence_tier(sightings: Column) -> Column:
    return F.when(sightings >= config.CONFIRMED, "confirmed").when(sightings >= config.CANDIDATE, "candidate").otherwise("first_observation")


def confidence_label(level: Column) -> Column:
    return F.when(level == 1, "low").when(level == 2, "medium").when(level == 3, "high").otherwise("unknown")


def landcover_group(code: Column, collection: str = "10m") -> Column:
    """Group of a class code; a when-chain, so there is nothing to join."""
    if collection not in config.LANDCOVER_GROUPS:
        raise ValueError(f"unknown land-cover collection {collection!r}; known: {sorted(config.LANDCOVER_GROUPS)}")
    out = None
    for group, codes in config.LANDCOVER_GROUPS[collection].items():
        out = F.when(code.isin(*codes), group) if out is None else out.when(code.isin(*codes), group)
    return out.otherwise("other")


def legend_label(code: Column) -> Column:
    """The name of a land-cover class; ``class N`` if it has none."""
    out = None
    for c, name in config.LEGEND.items():
        out = F.when(code == c, name) if out is None else out.when(code == c, name)
    return out.otherwise(F.concat(F.lit("class "), code.cast("string")))


def enso_state(anomaly: Column) -> Column:
    return F.when(anomaly >= 0.5, "el_nino").when(anomaly <= -0.5, "la_nina").otherwise("neutral")


def severity_band(severity: Column) -> Column:
    return F.when(severity >= 2.0, "very strong").when(severity >= 1.5, "strong").when(severity >= 1.0, "moderate").when(severity >= 0.5, "weak").otherwise("neutral")
