"""Places by cell numbers: circles as a few ranges of a sorted column, and the nearest places by growing rings.

A cell number interleaves the bits of latitude and longitude, so that places near each other mostly
have near numbers. In a table sorted by it, the reader skips the row groups outside of a
circle's ranges; distances are then worked out for the few rows inside. Poles and the date line are
covered; a place without a cell number (coordinates that are null or out of range) is looked at by
its distance alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import EARTH_RADIUS_KM, haversine_km

# Bits of each coordinate: cells are about a metre wide.
BITS = 24
# A circle is covered by at most about so many cells.
COVER = 48
HALF_WAY_KM = math.pi * EARTH_RADIUS_KM
CELL = "__cell"

# Shifts and masks that spread the bits of a 32-bit number to every second place.
SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _place(lat: str | Column, lon: str | Column) -> tuple[Column, Column]:
    return (F.col(lat) if isinstance(lat, str) else lat, F.col(lon) if isinstance(lon, str) else lon)


def _spread(value: Column) -> Column:
    for shift, mask in SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def _step(value: float, span: float) -> int:
    """Number of the strip a coordinate lies in; the columns are reckoned in the same way."""
    return max(0, min(math.floor((value + span / 2) / span * (1 << BITS)), (1 << BITS) - 1))


def _steps(value: Column, span: float) -> Column:
    strip = F.floor((value + F.lit(span / 2)) / F.lit(float(span)) * F.lit(float(1 << BITS)))
    inside = (value >= -span / 2) & (value <= span / 2)
    return F.when(inside, F.least(strip, F.lit((1 << BITS) - 1)))


def cell_number(lat: str | Column, lon: str | Column) -> Column:
    """The cell of a place; null where a coordinate is null, not a number or out of range."""
    lat, lon = _place(lat, lon)
    return _spread(_steps(lon, 360)).bitwiseOR(F.shiftleft(_spread(_steps(lat, 180)), 1))


def with_cells(df: DataFrame, lat: str | Column, lon: str | Column, name: str = CELL) -> DataFrame:
    """The rows with their cell numbers, sorted by them: write this to be read by ``within`` and ``nearest``."""
    return df.withColumn(name, cell_number(lat, lon)).repartitionByRange(name).sortWithinPartitions(name)


def boxes(lat: float, lon: float, km: float) -> list[tuple[float, float, float, float]]:
    """(lowest latitude, highest, lowest longitude, highest) of one or two boxes around a circle."""
    angle = km / EARTH_RADIUS_KM + 1e-9
    degrees = math.degrees(angle)
    low, high = max(-90.0, lat - degrees), min(90.0, lat + degrees)
    if lat - degrees <= -90 or lat + degrees >= 90:
        return [(low, high, -180.0, 180.0)]
    width = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + 1e-9
    west, east = lon - width, lon + width
    if west < -180:
        return [(low, high, -180.0, east), (low, high, west + 360, 180.0)]
    if east > 180:
        return [(low, high, west, 180.0), (low, high, -180.0, east - 360)]
    return [(low, high, west, east)]


def circle_ranges(lat: float, lon: float, km: float) -> list[tuple[int, int]]:
    """(first, last) cell numbers of a few ranges that hold every place within ``km``."""
    if km >= HALF_WAY_KM:
        return [(0, (1 << 2 * BITS) - 1)]
    found = []
    for south, north, west, east in boxes(lat, lon, km):
        rows, columns = (_step(south, 180), _step(north, 180)), (_step(west, 360), _step(east, 360))
        # Squares of one level that touch the box, by row and column; a level further as long as they stay few.
        level, squares = 0, [(0, 0)]
        while level < BITS:
            shift = BITS - level - 1
            finer = [
                (y, x)
                for row, column in squares
                for y in (2 * row, 2 * row + 1)
                if rows[0] >> shift <= y <= rows[1] >> shift
                for x in (2 * column, 2 * column + 1)
                if columns[0] >> shift <= x <= columns[1] >> shift
            ]
            if len(finer) > COVER:
                break
            level, squares = level + 1, finer
        size = 2 * (BITS - level)
        for y, x in squares:
            number = sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(level))
            found.append((number << size, (number + 1 << size) - 1))
    merged: list[tuple[int, int]] = []
    for first, last in sorted(found):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def within(
    df: DataFrame, lat: str | Column, lon: str | Column, to_lat: float, to_lon: float, km: float, cell: str = CELL
) -> DataFrame:
    """Rows of a table with cells whose place is at most ``km`` away."""
    number = F.col(cell)
    ranges = [(number >= first) & (number <= last) for first, last in circle_ranges(to_lat, to_lon, km)]
    return df.filter(reduce(or_, ranges) | number.isNull()).filter(haversine_km(*_place(lat, lon), to_lat, to_lon) <= F.lit(float(km)))


def nearest(
    df: DataFrame,
    lat: str | Column,
    lon: str | Column,
    to_lat: float,
    to_lon: float,
    take: int,
    ties: Sequence[str | Column] = (),
    cell: str = CELL,
    start_km: float | None = None,
    distance: str = "km",
) -> DataFrame:
    """The ``take`` nearest rows of a table with cells, nearest first, with their distance.

    A ring is read, and a wider one as long as it holds too few: rows outside of it are further away
    than all within. The first ring would hold a few times as many rows if they lay evenly; each is
    three times as wide as the one before, so there are at most some ten. Rows without a place are
    left out.
    """
    away = haversine_km(*_place(lat, lon), to_lat, to_lon)
    order = [F.col(distance).asc(), *ties]
    rows = df.filter(away.isNotNull())
    radius = start_km or 4 * EARTH_RADIUS_KM * math.sqrt(take / max(1, df.count()))
    while radius < HALF_WAY_KM:
        found = within(rows, lat, lon, to_lat, to_lon, radius, cell).withColumn(distance, away).orderBy(*order).limit(take)
        if found.count() >= take:
            return found
        radius *= 3
    return rows.withColumn(distance, away).orderBy(*order).limit(take)
