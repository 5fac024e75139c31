"""Replay of stored long and wide files: set GOLDEN_DIR to a folder that holds such pairs.

Without it a small extract stands in.  A pair are two CSV files of one folder
whose names differ in ``long`` and ``wide`` only.
"""

import csv
import os
from pathlib import Path

import pytest

from gaugeframe.operators.reshape import mean_cells, pivot_wide, wide_keys
from gaugeframe.sinks.csv import wide_csv_lines

EXTRACT_LONG = """REGION,YEAR,IndicatorCode,NumericValue
North,2031,Q7,2.5
South,2031,Q7,7.0
South,2031,Q7,8.0
South,2031,Q7,8.0
South,2029,Q8,31.0
North,2029,Q8,
West,2029,Q8,
"""
EXTRACT_WIDE = """IndicatorCode,Q7,Q8
YEAR,2031,2029
REGION,,
North,2.5,
South,7.666666666666667,31.0
"""


def pairs():
    folder = os.environ.get("GOLDEN_DIR")
    if not folder:
        return [None]
    found = sorted(Path(folder).rglob("*long*.csv"))
    return [p for p in found if p.with_name(p.name.replace("long", "wide")).exists()]


@pytest.mark.parametrize("pair", pairs(), ids=lambda p: p.stem if p else "extract")
def test_wide_file_follows_from_long_file(spark, tmp_path, pair):
    if pair is None:
        long_file = tmp_path / "x_long.csv"
        long_file.write_text(EXTRACT_LONG)
        expected = EXTRACT_WIDE.splitlines()
    else:
        long_file = pair
        expected = pair.with_name(pair.name.replace("long", "wide")).read_text().splitlines()
    entity = long_file.read_text().split(",", 1)[0]
    schema = f"`{entity}` string, YEAR int, IndicatorCode string, NumericValue double"
    cells = mean_cells(spark.read.schema(schema).csv(str(long_file), header=True), entity)
    keys = wide_keys(cells)
    lines = [r["line"] for r in wide_csv_lines(cells, keys, entity).collect()]
    found, expected = list(csv.reader(lines)), list(csv.reader(expected))
    assert found[:3] == expected[:3]
    assert [r[0] for r in found] == [r[0] for r in expected]
    assert [list(r[0:1]) for r in pivot_wide(cells, entity, keys).collect()] == [r[:1] for r in found[3:]]
    for ours, theirs in zip(found[3:], expected[3:]):
        assert [v == "" for v in ours] == [v == "" for v in theirs]
        numbers = [[float(v) for v in r[1:] if v] for r in (ours, theirs)]
        assert numbers[0] == pytest.approx(numbers[1], rel=1e-12)


def wide_files():
    folder = os.environ.get("GOLDEN_DIR")
    return sorted(Path(folder).rglob("*wide*.csv")) if folder else [None]


@pytest.mark.parametrize("file", wide_files(), ids=lambda p: p.stem if p else "extract")
def test_wide_file_survives_a_round_trip(spark, file):
    """Cells of a wide file as long rows, in any order, give the same file."""
    expected = list(csv.reader((file.read_text() if file else EXTRACT_WIDE).splitlines()))
    codes, years, (entity, *_), *body = expected
    cells = [
        (name, int(year), code, float(value))
        for name, *values in reversed(body)
        for code, year, value in zip(codes[1:], years[1:], values)
        if value
    ]
    long = spark.createDataFrame(cells, f"`{entity}` string, YEAR int, IndicatorCode string, NumericValue double")
    means = mean_cells(long, entity)
    keys = wide_keys(means)
    lines = wide_csv_lines(means, keys, entity)
    assert list(csv.reader(r["line"] for r in lines.collect())) == expected
