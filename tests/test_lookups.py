"""Places by cells and completions by prefixes against the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from sieveline import KEY, FieldError, STANDARD_WORDS, suggest, with_flags
from sieveline.functions.geo import haversine_km
from sieveline.operators.completions import complete, completion_pairs, completions, merge_completions
from sieveline.operators.nearby import BITS, cell_number, circle_ranges, nearest, with_cells, within
from test_functions import distance

LAT, LON = "lat", "lon"


@pytest.fixture(scope="module")
def places():
    r = random.Random(4)
    edge = [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (89.9, -179.9), (12.0, 179.99), (12.0, -179.99), (0.0, 0.0)]
    return edge + [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(1500)] + [(48 + r.gauss(0, 0.2), 11 + r.gauss(0, 0.2)) for _ in range(500)]


@pytest.fixture(scope="module")
def table(spark, places, tmp_path_factory):
    rows = [(i, *p) for i, p in enumerate(places)] + [(-1, None, 3.0), (-2, 1.0, None), (-3, 10.0, 190.0)]
    path = str(tmp_path_factory.mktemp("cells") / "t")
    with_cells(spark.createDataFrame(rows, "i int, lat double, lon double").repartition(4), LAT, LON).write.parquet(path)
    return spark.read.parquet(path)


SPOTS = [(48.0, 11.0), (0.0, 180.0), (0.0, -179.5), (89.5, 30.0), (-90.0, 0.0), (12.0, 179.0), (-33.3, -70.7)]


def test_cells_interleave_the_coordinates(spark):
    rows = [(-90.0, -180.0), (90.0, 180.0), (0.0, -180.0), (-90.0, 0.0), (None, 1.0), (91.0, 0.0), (float("nan"), 0.0)]
    got = [r[0] for r in spark.createDataFrame(rows, "lat double, lon double").select(cell_number(LAT, LON)).collect()]
    top = 1 << 2 * BITS
    assert got == [0, top - 1, top // 2, top // 4, None, None, None]


@pytest.mark.parametrize("spot", SPOTS)
def test_circles(table, places, spot):
    every = [*places, (10.0, 190.0)]
    for km in (0.5, 30.0, 700.0, 5000.0, 12_000.0, 30_000.0):
        found = {r.i if r.i >= 0 else len(places) for r in within(table, LAT, LON, *spot, km).collect()}
        assert found == {i for i, p in enumerate(every) if distance(*p, *spot) <= km}, km


def test_circles_are_few_ranges_close_around(table):
    for lat, lon in SPOTS:
        for km in (1.0, 50.0, 1000.0):
            ranges = circle_ranges(lat, lon, km)
            assert len(ranges) <= 64 and all(a <= b < c for (a, b), (c, _) in zip(ranges, ranges[1:]))
    wide = sum(b - a + 1 for a, b in circle_ranges(48.0, 11.0, 50.0)) / (1 << 2 * BITS)
    assert wide < 20 * (50 / 6371) ** 2
    text = within(table, LAT, LON, 48.0, 11.0, 50.0)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(__cell" in text and "LessThanOrEqual(__cell" in text


def test_no_place_no_distance(spark):
    rows = spark.createDataFrame([(None, 1.0), (1.0, None), (None, None), (1.0, 1.0)], "lat double, lon double")
    assert [r[0] is None for r in rows.select(haversine_km(F.col("lat"), F.col("lon"), -1.0, -179.0)).collect()] == [True, True, True, False]


@pytest.mark.parametrize("spot", SPOTS)
def test_nearest(table, places, spot):
    for take, start in ((1, None), (7, 0.001), (40, None), (3000, None)):
        got = nearest(table, LAT, LON, *spot, take, ["i"], start_km=start).collect()
        wanted = sorted((distance(*p, *spot), i) for i, p in enumerate([*places, (10.0, 190.0)]))[:take]
        assert [round(r.km, 6) for r in got] == [round(d, 6) for d, _ in wanted]


def test_one_place_has_one_distance(spark):
    """A pole at any longitude and the date line from either side are one place: such rows are ties."""
    rows = [(i, s * 90.0, float(lon)) for s in (1, -1) for i, lon in enumerate(range(-180, 181, 5))]
    rows += [(i, lat, lon) for i, lat in enumerate((-33.3, 0.0, 71.5)) for lon in (-180.0, 180.0)]
    df = spark.createDataFrame(rows, "i int, lat double, lon double")
    for lat, lon in [(-88.0, 20.0), (3.7, 14.3), (10.0, 179.0), (12.5, -179.9), (90.0, 5.0), (-90.0, 5.0)]:
        got = df.select("i", "lat", "lon", haversine_km(F.col("lat"), F.col("lon"), lat, lon).alias("km")).collect()
        of = {}
        for r in got:
            of.setdefault(r.lat if abs(r.lat) == 90 else (r.lat, r.i), set()).add(r.km)
            assert abs(r.km - distance(r.lat, r.lon, lat, lon)) < 1e-5
        assert {k: len(v) for k, v in of.items()} == dict.fromkeys(of, 1), (lat, lon)
    poles = with_cells(df.filter("lat = -90"), "lat", "lon")
    assert [r.i for r in nearest(poles, "lat", "lon", -88.0, 20.0, 9, ["i"]).collect()] == list(range(9))


TEXTS = ["red widget", "Red Gadget", "steel red bolt", "green gear", "widget-red", "can't stop", "Größe 42", "a" * 30 + " x", "a" * 30 + "b", "", None, "red widget"]
TYPED = ["r", "Red w", "red g", "wid red", "red steel b", "grö", "a" * 25, "a" * 30 + "b", "nothing", "", None, "x a", "red re", "gear green"]


@pytest.fixture(scope="module")
def named(spark):
    return with_flags(spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], f"{KEY} string, name string"), "name", suggestable=True)


@pytest.mark.parametrize("typed", TYPED)
def test_completions_equal_suggestions(named, typed):
    pairs = completion_pairs(named, ["name"])
    got = complete(completions(pairs, 3), pairs, typed, 3).collect()
    assert got == suggest(named, typed, ["name"], 3).collect()


def test_merged_completions(named):
    halves = [completions(completion_pairs(named.filter(F.col(KEY).cast("int") % 2 == r), ["name"]), 2) for r in (0, 1)]
    whole = completions(completion_pairs(named, ["name"]), 2)
    as_rows = lambda df: sorted((r.prefix, r.texts) for r in df.collect())
    assert as_rows(merge_completions(*halves, 2)) == as_rows(whole)
    assert max(len(r.texts) for r in whole.collect()) == 2


def test_completions_cut_before_the_shuffle(named):
    text = completions(completion_pairs(named, ["name"]))._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 or "Partial" in text


def test_completions_of_standard_words_and_wrong_fields(named):
    pairs = completion_pairs(named, ["name", "no such field"], words=STANDARD_WORDS)
    assert [r.text for r in complete(completions(pairs), pairs, "can't", words=STANDARD_WORDS).collect()] == ["can't stop"]
    assert completion_pairs(named, ["no such field"]).count() == 0
    with pytest.raises(FieldError):
        completion_pairs(with_flags(named, "name", suggestable=False), ["name"])
