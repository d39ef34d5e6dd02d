"""Instants are UTC whatever the session's time zone."""

import pytest
from pyspark.sql import functions as F

from sieveline import Range, RangeValue, Term, TermFacet, apply_filter, facets, retrieve


@pytest.fixture
def events(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    # The second and third read alike on New York clocks.
    micros = [1577836800, 1604206800 + 1800, 1604210400 + 1800]
    yield spark.createDataFrame([(i, m) for i, m in enumerate(micros)], "id long, s long").select("id", F.timestamp_seconds("s").alias("at"))
    spark.conf.set("spark.sql.session.timeZone", old)


def test_retrieved_in_utc(events):
    found = [r.at.isoformat() for r in retrieve(events).orderBy("id").collect()]
    assert found == ["2020-01-01T00:00:00", "2020-11-01T05:30:00", "2020-11-01T06:30:00"]


def test_facet_texts_in_utc(events):
    found = {r.value_id: r["count"] for r in facets(events, [TermFacet("at", size=0)]).collect()}
    assert found == {"01/01/2020 00:00:00 +00:00": 1, "11/01/2020 05:30:00 +00:00": 1, "11/01/2020 06:30:00 +00:00": 1}


def test_literals_without_a_zone_are_utc(events):
    assert [r.id for r in apply_filter(events, Term("at", ["2020-01-01 00:00:00"])).collect()] == [0]
    late = Range("at", [RangeValue("2020-11-01T06:00:00", "2020-11-01T02:00:00-05:00")])
    assert [r.id for r in apply_filter(events, late).collect()] == [2]
