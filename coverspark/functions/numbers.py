"""Codes and numbers: null tokens, cover codes, dimensions, masks and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tokens for "no value", percent per cover code and scale, and whole-cell repairs of dirty codes.
NULL_TOKENS = ["-9", "-9.0", "-1", "None", "NONE", "", " ", "*"]
COVER_CODES = {
    "braun_blanquet": {"r": 0.05, "+": 0.55, "1": 3.0, "2": 15.0, "3": 37.5, "4": 62.5, "5": 87.5, "-9": None},
    "westhoff_maarel": {"1": 0.05, "2": 1.0, "3": 2.5, "4": 4.5, "5": 9.0, "6": 18.5, "7": 37.0, "8": 62.0, "9": 87.5},
    "hult_sernander": {"+": 0.5, "1": 4.0, "2": 9.0, "3": 18.0, "4": 38.0, "5": 63.0, "6": 87.0},
    "modified_braun_blanquet": {"r": 0.05, "+": 0.55, "1": 3.0, "2": 15.0, "3": 37.5, "4": 62.5, "5": 85.0, "6": 97.5, "-9": None},
    "drude": {"un-rr": 0.5, "sol": 3.0, "sp-cop1": 15.0, "cd (cop2)": 38.0, "d (cop3)": 63.0},
    "percent": {"r": 0.05, "+": 0.55},
}
DIRTY_CODES = [
    (r"^\-+\+$", "+"),
    (r"^\s*\+\s*on\s*slope\s*$", "+"),
    (r"^\s*\+\s*$", "+"),
    (r"^0,.5$", "0.5"),
    (r"^0\.\,5$", "0.5"),
    (r"^\s*$", None),
    (r"^4\s*\(\s*5\s*\)$", "5"),
    (r"^5\s*\(\s*6\s*\)$", "6"),
    (r"^2\s*\(\s*3\s*\)$", "3"),
    (r"^3\s*\(\s*4\s*\)$", "4"),
    (r"^1\s*\(\s*2\s*\)$", "2"),
    (r"^4\s*\?\?$", "4"),
    (r"^›6$", "6"),
    (r"^›3$", "3"),
    (r"^2[a-bA-B]$", "2"),
    (r"^\?$", None),
    (r"^2\s*\?$", "2"),
    (r"^10\s*crust$", "10"),
    (r"^0\.0$", "0"),
    (r"^1\.0$", "1"),
    (r"^2\.0$", "2"),
    (r"^3\.0$", "3"),
    (r"^4\.0$", "4"),
    (r"^5\.0$", "5"),
    (r"^6\.0$", "6"),
    (r"^¨\+$", "+"),
    (r"\+Â\xa0", "+"),
    (r"^-10$", None),
    (r"^\?1$", "1"),
    (r"^I$", "1"),
]
# Cover scale per code of a file's metadata, and files whose scale is known otherwise.
SCALE_CODES = {"0": "percent", "BB": "braun_blanquet", "2": "braun_blanquet"}
SCALE_FILES = {
    "braun_blanquet": [
        "AVARU_Bolshezemelskaya_tundra_Lavrinenko_O_I_2015_2016",
        "AVARU_Kola_peninsula_Floodplains_NKoroleva_1930-2016",
        "AVARU_Kola_peninsula_tundra_meadows_NKoroleva_1930-2016",
        "AVARU_Malozemelskaya_tundra_Lavrinenko_O_I_2001_2007",
        "AVARU_Oxycocco_Sphagnetea_Lavrinenko_O_I_2015",
        "AVARU_Scheuchzerio_Caricetea_Lavrinenko_1998_2016",
        "AVARU_Scandinavia_historical",
        "AVARU_Svalbard_Koroleva_et_al",
        "AVARU_Wrangel_Kholod",
        "AVA_RU_Bolshevik_Matveyeva_2006",
    ],
    "modified_braun_blanquet": ["AVARU_AnDedov_1928_1939"],
    "percent": [
        "AVARU_Polar_Ural_1_mtelyatnikov_2018",
        "AVARU_Polar_Ural_2_mtelyatnikov_2018",
        "AVARU_G2_Northern_Gydan_mtelyatnikov_2017",
        "AVARU_G2_Northern_Gydan_eltroeva_2017",
        "AVARU_Ya1_Northern_Yamal_mtelyatnikov_2017",
        "AVARU_Ya1_Northern_Yamal_eltroeva_2017",
    ],
    "drude": ["AVARU_Taymyr_Pospelovs"],
}
# Bioclimate subzones and categories of map units.
ZONES = {1: "A", 2: "B", 3: "C", 4: "D", 5: "E", 6: "Non-Arctic"}
UNIT_CATEGORIES = {
    "B1": "B", "B2a": "B", "B3": "B", "B4": "B", "B2b": "B", "G1": "G", "G2": "G", "G3": "G", "G4": "G", "P1": "P", "P2": "P",
    "S1": "S", "S2": "S", "W1": "W", "W2": "W", "W3": "W", "FW": "W", "SW": "W", "GL": "W", "NA": "W",
}
# Scene classes of valid observations, and the one of snow.
VALID_CLASSES, SNOW_CLASS = (1, 4, 5, 11), 11


def null_tokens(c: Column) -> Column:
    return F.when(~F.trim(c).isin([t.strip() for t in NULL_TOKENS]), c)


def number(c: Column) -> Column:
    """Double, or null for what is no number."""
    return c.try_cast("double")


def repair_code(c: Column) -> Column:
    """The value of the first repair whose pattern is found; a pattern that isn't bound to both ends replaces only its part."""
    out = F.when(F.lit(False), c)
    for pattern, value in DIRTY_CODES:
        whole = pattern.startswith("^") and pattern.endswith("$")
        out = out.when(c.rlike(pattern), F.lit(value).cast("string") if whole or value is None else F.regexp_replace(c, pattern, value))
    return out.otherwise(c)


def assign_scale(files: DataFrame, name: str = "name", code: str = "code") -> DataFrame:
    """Add `scale`: what is known of the file, else by the code of its metadata (an unknown code stays as it is)."""
    known = F.lit(None).cast("string")
    for scale, names in SCALE_FILES.items():
        known = F.when(F.col(name).isin(*names), scale).otherwise(known)
    by_code = F.col(code)
    for k, scale in SCALE_CODES.items():
        by_code = F.when(F.col(code) == k, scale).otherwise(by_code)
    return files.withColumn("scale", F.coalesce(known, by_code))


def code_table(spark: SparkSession) -> DataFrame:
    """(scale, code, pct), a few dozen fixed rows."""
    return spark.createDataFrame([(s, k, v) for s, m in COVER_CODES.items() for k, v in m.items()], "scale string, code string, pct double")


def codes_to_percent(cover: DataFrame, scale: str = "scale", code: str = "code") -> DataFrame:
    """Add `pct`: the code's percent by its scale, else the code as a number. The code table is fixed, so it is broadcast."""
    table = code_table(cover.sparkSession).withColumns({"_hit": F.lit(True)}).withColumnsRenamed({"scale": "_scale", "code": "_code"})
    on = (F.col(scale) == F.col("_scale")) & (F.col(code) == F.col("_code"))
    joined = cover.join(F.broadcast(table), on, "left")
    return joined.withColumn("pct", F.when(F.col("_hit"), F.col("pct")).otherwise(number(F.col(code)))).drop("_scale", "_code", "_hit")


def trace(c: Column, value: float = 0.05) -> Column:
    return F.when(c == 0, value).otherwise(c)


def range_midpoint(c: Column) -> Column:
    """`50-60` gives 55, `+` gives 0.55, numbers themselves, else null."""
    lo, hi = (F.regexp_extract(c, r"^\s*([0-9.]+)\s*-\s*([0-9.]+)\s*$", k).try_cast("double") for k in (1, 2))
    return F.when(F.trim(c) == "+", 0.55).otherwise(F.coalesce((lo + hi) / 2, number(c)))


def sum_skipping_nulls(*cols: Column) -> Column:
    """Nulls count as 0, so all null gives 0."""
    return sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))


def sum_or_null(*cols: Column) -> Column:
    """Nulls count as 0, but all null gives null."""
    return F.when(F.coalesce(*cols).isNotNull(), sum_skipping_nulls(*cols))


def coordinate(c: Column) -> Column:
    return F.rtrim(F.trim(c), F.lit(",")).try_cast("double")


def plot_dimensions(c: Column) -> Column:
    """struct(shape, area) from `5 radius`, `2 x 3` or other text (unknown, null)."""
    r = F.regexp_extract(c, r"^\s*([0-9.]+)\s*(?:m\s*)?radius", 1).try_cast("double")
    a, b = (F.regexp_extract(c, r"^\s*([0-9.]+)\s*[x×]\s*([0-9.]+)", k).try_cast("double") for k in (1, 2))
    shape = F.when(r.isNotNull(), "circle").when(a == b, "square").when(a.isNotNull() & b.isNotNull(), "rectangle").otherwise("unknown")
    return F.struct(shape.alias("shape"), F.coalesce(circle_area(r), a * b).alias("area"))


def circle_area(radius: Column) -> Column:
    return F.pi() * radius * radius


def area_or_text(area: Column, shape: Column) -> Column:
    """struct(area, shape, kept): area as a number where the text is one, shape in lower case; kept is the text that is none."""
    n = number(area)
    return F.struct(n.alias("area"), F.lower(F.trim(shape)).alias("shape"), F.when(n.isNull(), area).alias("kept"))


def reflectance(c: Column, scale: float = 0.0001) -> Column:
    """Scaled reflectance; 0 is no value."""
    return F.when(c != 0, c * scale)


def above(c: Column, threshold: float) -> Column:
    """1 above the threshold, else 0."""
    return F.when(c > threshold, 1).when(c.isNotNull(), 0)


def without_edge(c: Column, least: float = -30.0) -> Column:
    """Null below the noise of a scene's edge."""
    return F.when(c >= least, c)


def season_value(c: Column, scene_class: Column, floor: float) -> Column:
    """The value where the scene's class is valid, `floor` on snow and for values below it, else null."""
    return F.when(scene_class.isin(*VALID_CLASSES), F.when(scene_class == SNOW_CLASS, floor).otherwise(F.greatest(c, F.lit(floor))))


def label_of(c: Column, names: dict) -> Column:
    """The name of a code; null for others."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.try_element_at(table, c)


def covering_grid(boxes: DataFrame, x0: float, y0: float, size: float) -> DataFrame:
    """(cell, gx, gy) of the cells of that edge length that touch one of the boxes (min_x, max_x, min_y, max_y)."""
    span = lambda lo, hi, at: F.sequence(F.floor((F.col(lo) - at) / size), F.floor((F.col(hi) - at) / size))
    cells = boxes.select(F.explode(span("min_x", "max_x", x0)).alias("gx"), "min_y", "max_y").select("gx", F.explode(span("min_y", "max_y", y0)).alias("gy")).distinct()
    return cells.select(F.concat_ws("_", F.col("gx").cast("string"), F.col("gy").cast("string")).alias("cell"), "gx", "gy")


def bits_clear(qa: Column, *bits: int) -> Column:
    out = F.lit(True)
    for b in bits:
        out = out & (qa.bitwiseAND(F.lit(1 << b)) == 0)
    return out


def grid_cell(x: Column, y: Column, x0: float, y0: float, size: float) -> Column:
    return F.concat_ws("_", F.floor((x - x0) / size).cast("string"), F.floor((y - y0) / size).cast("string"))


def utm_zone(lon: Column) -> Column:
    return F.floor((lon + 180) / 6) + 1


def utm(lon: Column, lat: Column, zone: int | Column) -> tuple[Column, Column]:
    """Easting and northing in metres (WGS84, northern zone; a number or one per row) by the transverse Mercator series of sixth order."""
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, dl = F.radians(lat), F.radians(lon - (6 * zone - 183))
    n = a / F.sqrt(1 - e2 * F.pow(F.sin(phi), 2))
    t, c, q = F.pow(F.tan(phi), 2), ep2 * F.pow(F.cos(phi), 2), dl * F.cos(phi)
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi) - (35 * e2**3 / 3072) * F.sin(6 * phi))
    east = 0.9996 * n * (q + (1 - t + c) * F.pow(q, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(q, 5) / 120) + 500000
    north = 0.9996 * (m + n * F.tan(phi) * (F.pow(q, 2) / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(q, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(q, 6) / 720))
    return east, north


def product_rows(pixels: DataFrame, value: str, mask: DataFrame | None, begin: str, end: str) -> DataFrame:
    """Pixels (x, y, value) as a product: scaled, 255 also where the mask (x, y, mask) is 1, with its time bounds."""
    if mask is not None:
        pixels = pixels.join(mask.select("x", "y", "mask"), ["x", "y"], "left").withColumn(value, F.when(F.coalesce("mask", F.lit(0)) != 1, F.col(value)))
    bounds = {"time_begin": F.lit(begin).cast("date"), "time_end": F.lit(end).cast("date")}
    return pixels.withColumns(bounds | {value: scaled_product(F.col(value))})


def scaled_product(v: Column) -> Column:
    """Percent of a share as a small integer, truncated; no value is 255."""
    return F.when(v.isNull(), F.lit(255)).otherwise((v * 100).cast("int"))


def height(wetness: Column) -> Column:
    """Exponential height model of wetness, with fixed coefficients."""
    return F.lit(276.53) * F.exp(F.lit(31.2436) * wetness)
