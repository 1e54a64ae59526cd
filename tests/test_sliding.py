"""Statistics over ranges of years against plain loops, with cells that have to be cut finer."""

import random

import numpy as np
import pytest

from forecourt.operators import quantiles, scoring
from forecourt.operators.sliding import cell_counts, sliding_boxes, sliding_quantiles, sliding_totals

SCHEMA = "make string, year int, price double, n_comparables string"


def _table():
    draw = random.Random(5)
    rows = [("hot", draw.randrange(2000, 2012), 1000 + draw.random()) for _ in range(900)]
    rows += [("hot", 2003, 1000.25)] * 60 + [("odd", 1990, -5.0), ("odd", 1994, 0.0), ("odd", 1994, 1e9)]
    rows += [("wide", draw.randrange(2000, 2004), draw.choice([1.0, 7.0, 50.0, 51.0, 52.0, 4000.0])) for _ in range(80)]
    rows += [(None, 2003, 1.0), ("hot", None, 1.0), ("hot", 2003, None), ("hot", 2003, float("nan"))]
    return rows


def _ranges(rows, reach):
    known = [r for r in rows if None not in r and r[2] == r[2]]
    at = {(m, y + d) for m, y, _ in known for d in range(-reach, reach + 1)}
    return {(m, y): np.sort([p for n, z, p in known if n == m and abs(z - y) <= reach]) for m, y in at}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(*r, "x") for r in _table()], SCHEMA)


@pytest.mark.parametrize("cell_rows", [1, 40, quantiles.CELL_ROWS])
def test_quantiles_of_ranges(df, cell_rows):
    found = sliding_quantiles(df, "price", [0.25, 0.5, 0.9], ["make"], "year", 2, cell_rows=cell_rows).collect()
    want = _ranges(_table(), 2)
    assert len(found) == len(want)
    for r in found:
        assert tuple(r)[2:] == pytest.approx(np.quantile(want[r.make, r.year], [0.25, 0.5, 0.9]), abs=1e-9)


def test_totals_and_boxes_of_ranges(df):
    counts = cell_counts(df, "price", ["make"], "year").persist()
    want = _ranges(_table(), 3)
    totals = {(r.make, r.year): (r["count"], r.min, r.max) for r in sliding_totals(counts, ["make"], "year", 3).collect()}
    assert totals == {k: (len(v), v[0], v[-1]) for k, v in want.items()}
    boxes = sliding_boxes(df, "price", ["make"], "year", 3, counts).collect()
    assert len(boxes) == len(want)
    for r in boxes:
        v = want[r.make, r.year]
        q1, median, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        near = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert tuple(r)[2:] == pytest.approx((q1, median, q3, near[0], near[-1], len(v) - len(near), v.mean(), len(v)))


def test_ranges_of_nothing(spark, df):
    none = df.where("year < 0")
    assert sliding_quantiles(none, "price", [0.5], ["make"], "year", 2).isEmpty()
    assert scoring.comparables_index(none).isEmpty()
    asked = spark.createDataFrame([("hot", 2003), (None, 2003), ("hot", None), ("new", 2003)], "make string, year int")
    found = scoring.comparables_stats(asked, none).collect()
    assert [(r.n_comparables, r.median_price) for r in found] == [(0, None)] * 4


def test_an_index_serves_many_tables(spark, df):
    index = scoring.comparables_index(df.drop("n_comparables"))
    asked = spark.createDataFrame([("hot", 2003), ("hot", 2003), (None, 2003), ("odd", 1992)], "make string, year int")
    found = scoring.comparables_stats(asked, df, index=index).collect()
    want = _ranges(_table(), 2)
    of = lambda v: (len(v), float(np.median(v)))
    hot, odd = of(want["hot", 2003]), of(want["odd", 1992])
    assert sorted((r.n_comparables, r.median_price) for r in found if r.make) == sorted([hot, hot, odd])
    assert [r.n_comparables for r in found if r.make is None] == [0]
