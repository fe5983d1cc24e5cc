"""Thresholds and tables of the engine. Fixed values, in natural order."""

Z_HIGH, Z_MEDIUM, Z_LOW = -3.0, -2.5, -2.0
DELTA_HIGH, DELTA_MEDIUM, DELTA_LOW = -0.20, -0.15, -0.15
MIN_STD = 0.01
DROUGHT_SPI, DROUGHT_WIDENING = -1.0, 0.5
MAX_ALERT_FRACTION = 0.30
MIN_AREA_HA, MAX_AREA_HA = 1.0, 1000.0
FIRE_DNBR, FIRE_POST_NBR, MECHANICAL_BSI, MECHANICAL_DNBR, UNCERTAIN_DNBR = 0.27, 0.1, 0.1, 0.05, 0.1
MIN_OVERLAP, GRACE_DAYS, CONFIRMED, CANDIDATE = 0.05, 180, 15, 2
MIN_CLEAR = {"streaming": 50.0, "composite": 20.0, "baseline": 10.0}
MAX_CLOUD, DAYS_BACK, MAX_SCENES = 20, 16, 20
NATURAL_FRACTION = 0.5
SPI_MIN_REFERENCE, SPI_CLIP = 10, 0.001
BIN_DAYS, MAX_GAP_DAYS, STL_PERIOD = 5, 30, 73
BREAK_RMSE, BREAK_RUN, HARMONICS = 3.0, 3, 2

#: Scene-classification codes that count as clear, and QA bits that count as cloud or shadow.
CLEAR_SCL = (2, 4, 5, 6, 7, 11)
LANDSAT_QA_BITS, HLS_QA_BITS = 0b11000, 0b1110

#: Bands that each index needs; Landsat and HLS read nir08 in place of nir.
INDEX_BANDS = {
    "ndvi": ("nir", "red"),
    "evi2": ("nir", "red"),
    "ndmi": ("nir08", "swir16"),
    "nbr": ("nir08", "swir22"),
    "savi": ("nir", "red"),
    "bsi": ("blue", "nir", "red", "swir16"),
}

#: Asset keys by sensor and band; ``scl`` and ``qa`` are class bands. Fixed values.
ASSETS = {
    "s2": {"blue": "blue", "green": "green", "red": "red", "rededge1": "rededge1", "rededge2": "rededge2", "rededge3": "rededge3", "nir": "nir", "nir08": "nir08", "swir16": "swir16", "swir22": "swir22", "scl": "scl"},
    "landsat": {"blue": "blue", "green": "green", "red": "red", "nir08": "nir08", "swir16": "swir16", "swir22": "swir22", "qa": "qa_pixel"},
    "hls": {"blue": "B02", "green": "B03", "red": "B04", "nir": "B8A", "nir08": "B8A", "swir16": "B11", "swir22": "B12", "qa": "Fmask"},
}
CLASS_BANDS = {"s2": "scl", "landsat": "qa", "hls": "qa"}
BASELINE_YEARS, BASELINE_CLOUD = (2017, 2019, 2021, 2022, 2025), 40

#: Names of land-cover classes. Fixed values.
LEGEND = {
    0: "No data / not observed",
    3: "Forest formation",
    4: "Savanna formation",
    5: "Mangrove",
    6: "Flooded forest",
    9: "Forest plantation",
    11: "Wetland",
    12: "Grassland formation",
    15: "Pasture",
    18: "Agriculture",
    19: "Temporary crop",
    20: "Sugar cane",
    21: "Mosaic of uses (ag/pasture)",
    23: "Beach, dune and sand spot",
    24: "Urban area",
    25: "Other non-vegetated area",
    29: "Rocky outcrop",
    30: "Mining",
    31: "Aquaculture",
    32: "Hypersaline tidal flat",
    33: "River, lake and ocean",
    35: "Palm oil",
    39: "Soybean",
    40: "Rice",
    41: "Other temporary crops",
    46: "Coffee",
    47: "Citrus",
    48: "Other perennial crops",
    49: "Wooded sandbank vegetation",
    50: "Herbaceous sandbank vegetation",
}

#: Land-cover groups by collection; codes not listed are "other".
LANDCOVER_GROUPS = {
    "10m": {
        "natural": (3, 4, 5, 6, 11, 12, 49, 50),
        "farming": (9, 15, 18, 19, 21, 36),
        "urban": (24, 30),
        "other": (23, 25, 29, 32),
        "water": (26, 31, 33),
        "nodata": (0, 27),
    },
    "30m": {
        "natural": (3, 4, 5, 6, 11, 12, 49, 50),
        "farming": (9, 15, 18, 19, 20, 21, 35, 36, 39, 40, 41, 46, 47, 48, 62),
        "urban": (24, 30, 75),
        "other": (23, 25, 29, 32),
        "water": (26, 31, 33),
        "nodata": (0, 27),
    },
}
