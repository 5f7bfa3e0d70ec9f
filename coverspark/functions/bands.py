"""Vegetation indices over named bands. Division by zero and roots of negative numbers give null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Names of the bands of a scene.
BAND_NAMES = {"B2": "blue", "B3": "green", "B4": "red", "B5": "redEdge1", "B6": "redEdge2", "B7": "redEdge3", "B8A": "redEdge4", "B8": "nir", "B11": "swir1", "B12": "swir2"}


def root(c: Column) -> Column:
    return F.when(c >= 0, F.sqrt(c))


def indices(nir: Column, red: Column, green: Column, blue: Column, swir1: Column, swir2: Column, edge: Column) -> dict[str, Column]:
    """19 indices and tasselled-cap terms, by name. Coefficients are fixed values."""
    over, two = F.try_divide, 2 * nir + 1
    return {
        "ndwi1": over(nir - swir1, nir + swir2),
        "ndwi2": over(nir - swir2, nir + swir2),
        "msavi": 0.5 * (two - root(two * two - 8 * (nir - red))),
        "vari": over(green - red, green + red - blue),
        "rvi": over(nir, red),
        "osavi": over(1.16 * (nir - red), nir + red + 0.16),
        "tgi": 0.5 * (120 * (red - blue) - 190 * (red - green)),
        "gli": over(2 * green - red - blue, 2 * green + red + blue),
        "ngrdi": over(green - red, green + red),
        "ci_g": over(nir, green) - 1,
        "gndvi": over(nir - green, nir + green),
        "cvi": over(nir * red, green * green),
        "mtvi2": over(1.5 * (1.2 * (nir - green) - 2.5 * (red - green)), root(two * two - (6 * nir - 5 * root(red)) - 0.5)),
        "brightness": 0.3037 * blue + 0.2793 * green + 0.4743 * red + 0.5585 * nir + 0.5082 * swir1 + 0.1863 * swir2,
        "greenness": -0.2848 * blue - 0.2435 * green - 0.5436 * red + 0.7243 * nir + 0.0840 * swir1 - 0.1800 * swir2,
        "wetness": 0.1509 * blue + 0.1973 * green + 0.3279 * red + 0.3406 * nir - 0.7112 * swir1 - 0.4572 * swir2,
        "tcari": 3 * ((edge - red) - 0.2 * (edge - green) * over(edge, red)),
        "tci": 1.2 * (edge - green) - 1.5 * (red - green) * root(over(edge, red)),
        "nari": over(over(F.lit(1.0), green) - over(F.lit(1.0), edge), over(F.lit(1.0), green) + over(F.lit(1.0), edge)),
    }


def with_indices(df: DataFrame) -> DataFrame:
    """All indices in one projection."""
    return df.withColumns(indices(*(F.col(c) for c in ("nir", "red", "green", "blue", "swir1", "swir2", "red_edge"))))


def season_index(name: str, nir: Column, red: Column, blue: Column, swir1: Column) -> Column:
    return {"ndvi": F.try_divide(nir - red, nir + red), "evi": F.try_divide(2.5 * (nir - red), nir + 6 * red - 7.5 * blue + 1), "mavi": F.try_divide(nir - red, nir + red + swir1)}[name]


def normalized(a: Column, b: Column) -> Column:
    """(a - b) / (a + b)."""
    return F.try_divide(a - b, a + b)


def water_terms(nir: Column, red: Column, green: Column, wetness: Column) -> dict[str, Column]:
    """NDWI of green and near infrared, NDVI, and their products with wetness."""
    ndwi, ndvi = normalized(green, nir), normalized(nir, red)
    return {"ndwi": ndwi, "ndvi": ndvi, "ndwi_wetness": ndwi * wetness, "ndvi_wetness": ndvi * wetness}


def band_difference(a: Column, b: Column) -> dict[str, Column]:
    """Difference and ratio of two polarisations."""
    return {"difference": a - b, "ratio": F.try_divide(a, b)}


def water(ndwi: Column, ndvi: Column) -> Column:
    """1 for water: NDWI above 0 and NDVI below 0.3."""
    return F.when((ndwi > 0) & (ndvi < 0.3), 1).otherwise(0)
