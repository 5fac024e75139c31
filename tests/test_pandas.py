"""Agreement with plain Python on random tables: rows, wide shape and the text of the files."""

import csv
import io
import random
from pathlib import Path

import pytest

from gaugeframe.operators.reshape import clean_long, mean_cells, pivot_wide, wide_keys
from gaugeframe.sinks.csv import write_long_csv, write_wide_csv

RAW = "SpatialDim string, TimeDim double, IndicatorCode string, NumericValue double, Dim1 string"
ENTITIES = ["AFG", "ALB", "EUR", 'Côte "d\'Or", x', " padded ", "A|B", None]
CODES = ["HIV_1", "A,b", "Z", "a", None]


def random_rows(seed, n=400):
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        # Copies of one short binary fraction have an exact mean, so that the text can be compared.
        entity, code, year = pick.choice(ENTITIES), pick.choice(CODES), pick.choice([1999.0, 2000.0, 2016.0, None])
        exact = random.Random(f"{entity}{code}{year}").choice([0.125, 1e7, 12345678.25, 2e16, 2.0**-20, -4.0, None])
        value = None if pick.random() < 0.2 else exact
        rows.append((entity, year, code, value, "x"))
    return rows


def text_of(folder):
    return [p.read_text() for p in sorted(Path(folder).glob("part-*"))]


def as_csv(rows):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    return text.getvalue()


@pytest.mark.parametrize("seed", range(4))
def test_tables_and_files(spark, tmp_path, seed):
    rows = random_rows(seed)
    kept = [(e, int(y), c, v) for e, y, c, v, _ in rows if None not in (e, y, c)]
    groups = {}
    for e, y, c, v in kept:
        if v is not None:
            groups.setdefault((e, (c, y)), []).append(v)
    columns = sorted({k for _, k in groups})
    entities = sorted({e for e, _ in groups})
    means = {k: sum(v) / len(v) for k, v in groups.items()}
    wide_rows = [["IndicatorCode", *(c for c, _ in columns)], ["YEAR", *(y for _, y in columns)], ["COUNTRY", *("" for _ in columns)]]
    wide_rows += [[e, *(repr(means[e, k]) if (e, k) in means else "" for k in columns)] for e in entities]
    long_rows = [[e, y, c, "" if v is None else repr(v)] for e, y, c, v in kept]

    long = clean_long(spark.createDataFrame(rows, RAW))
    cells = mean_cells(long)
    keys = wide_keys(cells)
    assert [tuple(k) for k in keys] == columns
    wide = pivot_wide(cells, keys=keys)
    assert [r[0] for r in wide.collect()] == entities

    write_wide_csv(cells, str(tmp_path / "wide"))
    assert "".join(text_of(tmp_path / "wide")) == as_csv(wide_rows)
    write_long_csv(long, str(tmp_path / "long"))
    ours = [line for part in text_of(tmp_path / "long") for line in part.splitlines()[1:]]
    assert sorted(ours) == sorted(as_csv(long_rows).splitlines())

