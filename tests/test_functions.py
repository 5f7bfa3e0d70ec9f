"""Quirks of names, codes, dates and cover sums on literal rows."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from coverspark.functions import bands, dates, numbers, text
from coverspark.operators import cover, lists, match, model, series, spatial, stats, validate
from coverspark.sources import files


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in df.orderBy("k").select(f(F.col("v"))).collect()]


@pytest.mark.parametrize("f, values, want", [
    (text.genus_species, ["Salix alba L.", "Salix", "Salix species", "unknown moss", " ", None], ["Salix alba", "Salix", "Salix", "moss", None, None]),
    (text.first_word, [" Salix  alba", "", None], ["Salix", None, None]),
    (text.clean_name, ["Salix (Sm.) alba-X  L.", None], ["salix albax l", None]),
    (text.infer_rank, ["Salix", "Salix alba", "Salix alba var. x", "Salix sp.", "Salix alba ssp. x", "a b c", "Carex alba s.l."], ["genus", "species", "variety", "genus", "subspecies", "subspecies", "subspecies"]),
    (text.camel_to_snake, ["surveyYear", "plotIDName", None], ["survey_year", "plot_id_name", None]),
    (text.int_text, ["12.0", "12.5", "abc", "inf", None], ["12", "12.5", "abc", "inf", None]),
    (text.clean_shrub, ["Dwarf Shrub", "tree", None], ["shrub", "tree", None]),
    (text.tidy_subsource, ["a_b (x) ", None], ["a b", None]),
    (text.hash_id, ["x", None, "inf"], ["u11f6ad8ec", "umissing", "umissing"]),
    (text.list_text, ["['a', 'b']", "a, b", "(x)", None, "[]"], [["a", "b"], ["a", "b"], ["x"], [], []]),
    (text.name_before_digits, ["moss_cover_20m_x", "none"], ["moss_cover", ""]),
    (numbers.null_tokens, ["-9", " ", "*", "3", None], [None, None, None, "3", None]),
    (numbers.repair_code, ["4 (5)", "2B", "0.,5", "?", "--+", "+ on slope", "10 crust", "6.0", "7.0", "I", "-10", None], ["5", "2", "0.5", None, "+", "+", "10", "6", "7.0", "1", None, None]),
    (numbers.range_midpoint, ["50-60", "+", "7", "x", None], [55.0, 0.55, 7.0, None, None]),
    (numbers.coordinate, [" 61.5, ", "north", None], [61.5, None, None]),
    (lambda c: text.author_by_rank(c, F.lit("species")), ["Salix alba L. f.", "Salix alba"], ["L. f.", None]),
    (lambda c: dates.mixed_date(c, ["yyyy-MM-dd", "dd.MM.yyyy"]), ["2020-02-30", "2020-02-29", "01.03.2021", None], [None, datetime.date(2020, 2, 29), datetime.date(2021, 3, 1), None]),
    (dates.range_midpoint_date, ["2000-2003", "1992-1996", "3-6.7.1999", "x"], [datetime.date(2001, 12, 31), datetime.date(1994, 7, 2), datetime.date(1999, 7, 4), None]),
])
def test_text(spark, f, values, want):
    assert column(spark, values, f) == want


def test_author_dates_and_plots(spark):
    assert [tuple(r) for r in column(spark, ["Carex alba (Piper) M. Peck", "Carex alba s.l. L.", "Carex DC. x", "Carex Mot. x", "Carex alba L.", "Carex alba"], text.split_author)] == [
        ("Carex alba", "(Piper) M. Peck"), ("Carex alba", "s.l. L."), ("Carex", "DC. x"), ("Carex", "Mot. x"), ("Carex alba", "L."), ("Carex alba", "")]
    assert [tuple(r) for r in column(spark, ["20200131", "202001", "2020", "20", None], dates.packed_date)] == [(2020, 1, 31), (2020, 1, None), (2020, None, None), (None,) * 3, (None,) * 3]
    plots = column(spark, ["5 m radius", "2 x 2", "2 x 3", "odd", None], numbers.plot_dimensions)
    assert [p.shape for p in plots] == ["circle", "square", "rectangle", "unknown", "unknown"] and abs(plots[0].area - 78.539816) < 1e-6


def test_habits(spark):
    df = spark.createDataFrame([("Soil crust", None), ("shrub moss", None), ("Dwarf Shrub", "evergreen"), ("shrub", None), ("Tree", "deciduous"), ("Forb", None), (None, "x")], "h string, l string")
    assert [r[0] for r in df.select(text.habit_to_pft(F.col("h"), F.col("l"))).collect()] == ["other", "bryophyte", "evergreen shrub", None, "deciduous tree", "forb", None]


def test_null_rules(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, None), (3, 1.0, 4.0)], "k int, a double, b double")
    got = df.select(numbers.sum_skipping_nulls(F.col("a"), F.col("b")), numbers.sum_or_null(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(2.0, 2.0), (0.0, None), (5.0, 5.0)]
    assert {r.k: r.cover for r in cover.sum_cover(df, ["k"], "a").collect()} == {1: 2.0, 2: None, 3: 1.0}
    assert {r.k: r.cover for r in cover.sum_cover(df, ["k"], "a", zero_filled=True).collect()} == {1: 2.0, 2: 0.0, 3: 1.0}
    assert cover.with_columns_of(df, ["z", "a"]).columns == ["z", "a", "k", "b"]


def test_habit_cascade_keeps_rows(spark):
    checklist = spark.createDataFrame([("Salix alba", "Salix nova", "shrub"), ("Salix nova", "Salix nova", "tree"), ("Carex x", "Carex y", ""), ("Carex z", "Carex w", "grass")], "name string, accepted_name string, habit string")
    species = spark.createDataFrame([("Salix nova",), ("Salix alba",), ("Carex y",), ("Salix q",), ("Poa",), (None,), ("Salix nova",)], "species string")
    got = [(r.species, r.habit) for r in match.habit_cascade(species, checklist).collect()]
    assert sorted(got, key=str) == sorted([("Salix nova", "shrub,tree"), ("Salix nova", "shrub,tree"), ("Salix alba", "shrub"), ("Carex y", "grass"), ("Salix q", "shrub,tree"), ("Poa", None), (None, None)], key=str)


def test_fuzzy(spark):
    n = spark.createDataFrame([("salix alb", "salix")], "name string, block string")
    c = spark.createDataFrame([("salix alba", "salix"), ("salix nova", "salix"), ("carex alb", "carex")], "candidate string, block string")
    assert [(r.candidate, r.place) for r in match.fuzzy_candidates(n, c, "block").orderBy("place").collect()] == [("salix alba", 1), ("salix nova", 2)]
    assert match.partial_ratio(n.crossJoin(c).select("name", "candidate")).where("candidate = 'salix alba'").first().score == 100.0


def test_lists(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c")], "k int, v string")
    assert {r.k: r.same for r in lists.same_key_rows(df, ["k"], "v").dropDuplicates(["k"]).collect()} == {1: "a,b", 2: "", 3: ""}
    assert [r.k for r in lists.missing_numbers(spark.createDataFrame([(1,), (4,)], "k long"), "k").orderBy("k").collect()] == [2, 3]


def test_distance_clusters_follow_input_order(spark):
    rng = np.random.default_rng(0)
    xy = rng.uniform(0, 400, (150, 2))
    df = spark.createDataFrame([(k, k, float(x), float(y)) for k, (x, y) in enumerate(xy)], "id long, ord long, x double, y double")
    number, first = [], []
    for k, p in enumerate(xy):
        near = [number[j] for j in range(k) if np.hypot(*(xy[j] - p)) <= 30]
        number.append(min(near) if near else len(first))
        if not near:
            first.append(k)
    got = {r.id: r.cluster for r in spatial.distance_clusters(df.repartition(5), 30.0).collect()}
    assert got == {k: first[n] for k, n in enumerate(number)}


def test_rings_and_projection(spark):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]))
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (5.0, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(spatial.in_ring(F.col("x"), F.col("y"), ring)).collect()] == [True, False, False]
    e, n = spark.range(1).select(*numbers.utm(F.lit(-147.0), F.lit(65.0), 6)).first()
    e2 = 2 / 298.257223563 - 298.257223563**-2
    lat = np.radians(np.linspace(0, 65, 200_001))
    arc = np.trapezoid(6378137 * (1 - e2) / (1 - e2 * np.sin(lat) ** 2) ** 1.5, lat)
    assert abs(e - 500000) < 1e-3 and abs(n - 0.9996 * arc) < 0.01


def test_spline_passes_through_its_points(spark):
    d = [datetime.date(2020, m, 1) for m in range(1, 7)]
    df = spark.createDataFrame([(1, x, float(k * k)) for k, x in enumerate(d)], "id int, day date, v double")
    got = {r.day: r.value for r in series.spline_daily(df, "id", "day", "v").collect()}
    assert got[d[1]] == 1.0 and got[d[2]] == 4.0 and min(got) == d[1] and max(got) == datetime.date(2020, 4, 29)
    assert datetime.date(2020, 2, 29) not in got


def test_season_of_one_peak(spark):
    v = [1, 2, 4, 8, 9, 7, 3, 1]
    df = spark.createDataFrame([(1, 10 * k, float(x)) for k, x in enumerate(v)] + [(2, 0, None)], "id int, t int, v double")
    r, empty = series.season(df, "id", "t", "v").orderBy("id").collect()
    assert empty.id == 2 and set(empty[1:]) == {None}
    assert (r.peak, r.peak_t, r.valley_t, r.base, r.amplitude) == (9.0, 40.0, 0.0, 1.0, 8.0)
    assert (r.sos_amplitude_t, r.eos_amplitude_t, r.length) == (20.0, 50.0, 30.0)
    assert abs(r.liot - np.trapezoid(v)) < 1e-9 and abs(r.siot - np.trapezoid(np.array(v) - 1)) < 1e-9


def test_cooks_distance_is_the_textbook_one(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 3)), rng.normal(size=60)
    df = spark.createDataFrame([(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))], "k int, a double, b double, c double, y double")
    h = np.einsum("ij,jk,ik->i", x, np.linalg.inv(x.T @ x), x)
    e = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    want = e**2 * h / (3 * (e @ e / 57) * (1 - h) ** 2)
    got = [r.cooks for r in model.cooks_distance(df, ["a", "b", "c"], "y").orderBy("k").collect()]
    assert np.allclose(got, want)


def test_stats(spark):
    df = spark.createDataFrame([(1, v) for v in (0.0, 1.0, 8.0, 15.0)], "g int, v double")
    assert {r.bin: r.n for r in stats.histogram(df, "v", 7).collect()} == {0: 1, 1: 2}
    assert stats.seeded_half(spark.range(101), "id", "s").count() == 50


def test_validation(spark):
    df = spark.createDataFrame([("u1", 10.0), ("u1", 120.0), ("x", None)], "k string, c double")
    assert [r.key for r in validate.not_unique(df, "k").collect()] == ["u1"]
    assert sorted(r.key for r in validate.bad_key(df, "k").collect()) == ["u1", "u1", "x"]
    assert sorted(r.rule for r in validate.cover_warnings(df, "k", ["c"], ["c"]).collect()) == ["c above 100", "total below 100", "total below 100"]
    assert validate.schema_differences(spark, df.schema, spark.createDataFrame([], "k int, z string").schema).count() == 2


def test_files(spark, tmp_path):
    (tmp_path / "site_moss_2020.csv").write_text("a,b\n-9,x\n3,\n")
    (tmp_path / "old.txt").write_bytes("a,b\n1,é\n".encode("latin-1"))
    df = files.read_delimited(spark, str(tmp_path / "site_moss_2020.csv"))
    assert [(r.a, r.b) for r in df.collect()] == [(None, "x"), ("3", None)]
    assert df.select(files.name_part(F.col("file_name"), -2)).first()[0] == "moss"
    assert files.read_by_encoding(spark, {"ISO-8859-1": [str(tmp_path / "old.txt")]}).first().b == "é"
    assert files.unreadable(spark, str(tmp_path / "*.txt"), b"PAR1").count() == 1
    out = str(tmp_path / "out")
    files.write_quoted(spark.createDataFrame([(1, ["x", "y"])], "k int, l array<string>"), out)
    assert '"1","x; y"' in "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    tiles = str(tmp_path / "tiles")
    px = spark.createDataFrame([("red", 1, 0, 5.0), ("red", 2, 0, 6.0), ("nir", 1, 0, 7.0)], "band string, cell_id int, x int, value double")
    files.write_units(px, tiles, ["band", "cell_id"])
    files.write_units(px.where("cell_id = 2").withColumn("value", F.lit(9.0)), tiles, ["band", "cell_id"])
    assert sorted(r.value for r in files.read_tiles(spark, tiles).collect()) == [5.0, 7.0, 9.0]
    assert files.read_tiles(spark, tiles, ["red"], [1]).first().value == 5.0
    with pytest.raises(ValueError):
        files.write_valid(px, px, str(tmp_path / "no"))


def test_indices_guard_zero_and_roots(spark):
    df = spark.createDataFrame([(0.0,) * 7], "nir double, red double, green double, blue double, swir1 double, swir2 double, red_edge double")
    r = bands.with_indices(df).first()
    assert r.ndwi1 is None and r.rvi is None and r.nari is None and r.msavi == 0.0
