import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelweave.operators import timeseries as S


def series(frame, data):
    return frame([(k, y, v) for k, points in data.items() for y, v in points], "k string, year int, value double")


CASES = {
    "gaps": [(1, None), (2, 4.0), (3, None), (4, None), (5, 10.0), (6, None)],
    "one": [(1, None), (2, 3.0), (3, None)],
    "none": [(1, None), (2, None)],
    "twice": [(1, 1.0), (1, 3.0), (2, None), (3, 6.0)],
    "same_year_only": [(1, 1.0), (1, 3.0), (2, None)],
}


def expected_linear(points, rule):
    known = {}
    for y, v in points:
        if v is not None:
            known.setdefault(y, []).append(v)
    xs = sorted(known)
    if len(xs) < 2:
        return [None] * len(points)
    ys = [np.mean(known[x]) for x in xs]
    out = []
    for y, _ in points:
        inside = xs[0] <= y <= xs[-1]
        out.append(float(np.interp(y, xs, ys)) if inside or rule == 2 else None)
    return out


@pytest.mark.parametrize("rule", [1, 2])
def test_linear_interpolation(frame, rule):
    out = S.interpolate(series(frame, CASES), ["k"], rule=rule).orderBy("k", "year").collect()
    for key, points in CASES.items():
        got = [r.value for r in out if r.k == key]
        assert got == pytest.approx(expected_linear(points, rule), nan_ok=True) if None not in got else got == expected_linear(points, rule)


def test_step_interpolation(frame, rows):
    data = {"a": [(1, None), (2, 4.0), (3, None), (4, 6.0), (5, None)], "b": [(1, None), (2, 3.0), (3, None)]}
    inside = [r.value for r in S.interpolate_step(series(frame, data), ["k"]).orderBy("k", "year").collect()]
    assert inside == [None, 4.0, 4.0, 6.0, None, None, 3.0, None]
    filled = [r.value for r in S.interpolate_step(series(frame, data), ["k"], rule=2).orderBy("k", "year").collect()]
    assert filled == [4.0, 4.0, 4.0, 6.0, 6.0, 3.0, 3.0, 3.0]


@pytest.mark.parametrize("rule", [1, 2])
def test_resample_matches_interp(frame, rule):
    rng = np.random.default_rng(1)
    xs, ys = np.sort(rng.uniform(0, 100, 40)), rng.uniform(0, 1, 40)
    df = frame([("a", float(x), float(y)) for x, y in zip(xs, ys)], "k string, x double, y double")
    grid = [-1.0, 5.0, float(xs[3]), 50.0, 101.0]
    out = {r.x: r.y for r in S.resample(df, ["k"], "x", "y", grid, rule=rule).collect()}
    for q in grid:
        want = float(np.interp(q, xs, ys)) if rule == 2 or xs[0] <= q <= xs[-1] else None
        assert out[q] == (pytest.approx(want) if want is not None else None)


def test_decay_with_shadow_and_without_parameters(frame):
    schema = "technology string, year int, value double, improvement_rate double, improvement_max double, improvement_shadow_technology string"
    df = frame(
        [
            ("lead", 2000, 100.0, 0.1, 0.5, None),
            ("lead", 2010, 80.0, 0.1, 0.5, None),
            ("follow", 2000, 150.0, 0.2, 0.25, "lead"),
            ("follow", 2010, 120.0, 0.2, 0.25, "lead"),
            ("fixed", 2000, 9.0, None, None, None),
            ("fixed", 2010, 8.0, None, None, None),
        ],
        schema,
    )
    out = {(r.technology, r.year): r.value for r in S.decay_extrapolate(df, [], [2005, 2010, 2015]).collect()}
    assert set(y for _, y in out) == {2005, 2010, 2015}
    assert out["lead", 2005] == 90.0
    lead = 80 * 0.5 + (80 - 80 * 0.5) * 0.9**5
    assert out["lead", 2015] == pytest.approx(lead)
    assert out["follow", 2015] == pytest.approx(lead + 40 * 0.25 + (40 - 40 * 0.25) * 0.8**5)
    assert out["fixed", 2015] is None and out["fixed", 2005] == 8.5


def test_graft_uses_latest_common_year(frame, rows):
    past = frame([("a", 2000, 10.0), ("a", 2005, 20.0)], "k string, year int, value double")
    future = frame(
        [(s, "a", y, v) for s, f in (("hi", 2.0), ("lo", 1.0)) for y, v in ((2000, 1.0), (2005, 4.0), (2010, 4.0 * f + 2))],
        "scenario string, k string, year int, value double",
    )
    assert rows(S.graft(past, future, ["k"])) == [
        ("hi", "a", 2000, 10.0), ("hi", "a", 2005, 20.0), ("hi", "a", 2010, 50.0),
        ("lo", "a", 2000, 10.0), ("lo", "a", 2005, 20.0), ("lo", "a", 2010, 30.0),
    ]


def test_backcast_keeps_totals_and_splits_equally_without_data(frame):
    rows = [("i", "P", 1990, 100.0), ("j", "P", 1990, 50.0)]
    rows += [("i", "A", 1992, 30.0), ("i", "B", 1992, 10.0), ("i", "B", 1994, 20.0), ("j", "A", 1992, 0.0), ("j", "B", 1993, None)]
    df = frame(rows, "item string, area string, year int, value double")
    out = S.backcast_parent(df, F.col("area") == "P", 1992, ["item"], "area")
    got = {(r.item, r.area): r.value for r in out.where("year = 1990").collect()}
    assert got == {("i", "A"): 50.0, ("i", "B"): 50.0, ("j", "A"): 25.0, ("j", "B"): 25.0}


def simulate_vintages(years, values, lifetime, first_step):
    steps = [first_step] + [b - a for a, b in zip(years, years[1:])]
    added = []
    for i, year in enumerate(years):
        running = 0.0
        for v in range(i):
            last = min(years[-1], years[v] - steps[v] + lifetime)
            if year <= last:
                running += added[v]
            elif years[i - 1] < last:
                running += added[v] * (year - last) / (year - years[i - 1])
        added.append(values[i] if i == 0 else max(values[i] - running, 0.0))
    return added


@pytest.mark.parametrize("lifetime", [3, 10, 17, 60])
def test_vintages(frame, lifetime):
    years, values = [1975, 1990, 2005, 2010, 2015], [10.0, 14.0, 9.0, 20.0, 21.0]
    df = frame([("a", y, v) for y, v in zip(years, values)], "k string, year int, value double")
    out = S.vintage_additions(df, ["k"], years, lifetime).orderBy("year").collect()
    assert [r.additions for r in out] == pytest.approx(simulate_vintages(years, values, lifetime, 15))


def test_backfill_from_total_against_a_loop(frame):
    rng = np.random.default_rng(3)
    years = list(range(1, 7))
    members = {(g, m): [float(v) if rng.random() > 0.4 else None for v in rng.integers(1, 50, len(years))] for g in "xy" for m in range(5)}
    totals = {(g, y): 300.0 for g in "xy" for y in years}
    want = {k: list(v) for k, v in members.items()}
    for g in "xy":
        for i in range(len(years) - 2, -1, -1):
            mine = [k for k in want if k[0] == g]
            gap = [k for k in mine if members[k][i] is None]
            left = totals[g, years[i]] - sum(members[k][i] for k in mine if members[k][i] is not None)
            later = sum(want[k][i + 1] for k in gap if want[k][i + 1] is not None)
            for k in gap:
                want[k][i] = want[k][i + 1] * left / later if want[k][i + 1] is not None and later else None
    df = frame([(g, m, y, v) for (g, m), vs in members.items() for y, v in zip(years, vs)], "g string, m int, year int, value double")
    limits = frame([(g, y, v) for (g, y), v in totals.items()], "g string, year int, value double")
    out = S.fill_members_from_total(df, limits, ["g"], ["m"], years).collect()
    for r in out:
        expect = want[r.g, r.m][years.index(r.year)]
        assert r.value == (pytest.approx(expect) if expect is not None else None)


def test_recurrence_against_a_loop(frame):
    growth = [None, 0.1, None, 0.3, 0.2]
    df = frame([("a", i, g) for i, g in enumerate(growth)], "k string, year int, g double")
    step = lambda last, row: F.when(row["year"] == 0, F.lit(1.0)).when(row["g"].isNull(), F.lit(0.15)).otherwise(last * 0.5 + row["g"])
    out = [r.x for r in S.fold_years(df, ["k"], ["g"], F.lit(1.0), step, "x").orderBy("year").collect()]
    want, last = [], 1.0
    for i, g in enumerate(growth):
        last = 1.0 if i == 0 else 0.15 if g is None else last * 0.5 + g
        want.append(last)
    assert out == pytest.approx(want)


def test_moving_average_keeps_ends_empty(frame):
    df = frame([("a", i, float(v)) for i, v in enumerate([1, 2, 6, 4])], "k string, year int, value double")
    out = [r.m for r in S.moving_average(df, ["k"], "value", "m", 3).orderBy("year").collect()]
    assert out == [None, 3.0, 4.0, None]
    with pytest.raises(ValueError):
        S.moving_average(df, ["k"], "value", "m", 4)


def test_cumulative_product_with_zero_and_negative(frame):
    df = frame([("a", 1, 2.0), ("a", 2, -3.0), ("a", 3, 0.0), ("a", 4, 5.0)], "k string, year int, f double")
    assert [r.p for r in S.cumulative_product(df, ["k"], "f", "p").orderBy("year").collect()] == [2.0, -6.0, 0.0, 0.0]


def test_many_splits_with_a_merge(frame):
    rows = [("P", 1990, 100.0), ("A", 1992, 30.0), ("B", 1992, 10.0), ("Q", 1995, 8.0), ("C", 1996, 0.0), ("D", 1996, 0.0), ("X", 1990, 5.0), ("X", 1996, 6.0)]
    df = frame(rows, "area string, year int, value double")
    splits = frame([("P", "A", 1992), ("P", "B", 1992), ("Q", "C", 1996), ("Q", "D", 1996)], "parent string, part string, split_year int")
    merges = frame([("D", "C")], "part string, whole string")
    got = {(r.area, r.year): r.value for r in S.backcast_splits(df, splits, [], "area", merges=merges).collect()}
    assert got == {
        ("A", 1990): 75.0, ("A", 1992): 30.0, ("B", 1990): 25.0, ("B", 1992): 10.0,
        ("C", 1995): 8.0, ("C", 1996): 0.0, ("X", 1990): 5.0, ("X", 1996): 6.0,
    }


def test_backcast_by_ratio_without_trend(frame):
    rows = [("i", "P", 1990, 50.0), ("i", "A", 1992, 30.0), ("i", "B", 1992, 70.0), ("j", "P", 1990, 5.0), ("j", "A", 1992, 0.0)]
    df = frame(rows, "item string, area string, year int, value double")
    out = S.backcast_by_ratio(df, F.col("area") == "P", 1992, ["item"], "area")
    got = {(r.item, r.area): r.value for r in out.where("year = 1990").collect()}
    assert got == {("i", "A"): 15.0, ("i", "B"): 35.0, ("j", "A"): 0.0}


@pytest.mark.parametrize("extra", [("m", 1, 6.0), ("m", 9, 6.0)], ids=["second row", "year not listed"])
def test_members_and_vintages_fail_on_rows_they_cannot_place(frame, extra):
    rows = frame([("m", 1, 5.0), ("m", 2, 7.0), extra], "member string, year int, value double")
    with pytest.raises(PySparkException):
        S.vintage_additions(rows, ["member"], [1, 2], 30).collect()
    totals = frame([("g", 1, 9.0), ("g", 2, 9.0)], "grp string, year int, value double")
    members = rows.withColumn("grp", F.lit("g"))
    with pytest.raises(PySparkException):
        S.fill_members_from_total(members, totals, ["grp"], ["member"], [1, 2]).collect()


def test_missing_shadow_technology_fails(frame):
    df = frame(
        [("r", "a", y, 10.0 - y, 0.1, 0.5, None) for y in (1, 2)] + [("r", "b", y, 20.0 - y, 0.1, 0.5, "gone") for y in (1, 2)],
        "region string, technology string, year int, value double, improvement_rate double, improvement_max double, improvement_shadow_technology string",
    )
    with pytest.raises(PySparkException, match="shadow technology"):
        S.decay_extrapolate(df, ["region"], [1, 2, 3]).collect()


def test_annualised_rates_span_the_years_between(frame):
    df = series(frame, {"a": [(2000, 100.0), (2002, 121.0), (2003, None), (2004, 0.0), (2005, 5.0)]})
    got = [r.rate for r in S.annualised_rate(df, ["k"], "value", "rate").orderBy("year").collect()]
    assert got[1] == pytest.approx(0.1) and [got[0], got[2], got[3], got[4]] == [None] * 4


def test_a_decline_is_guarded_by_the_first_year(frame):
    points = lambda *v: list(zip((2000, 2004, 2006, 2007), v))
    df = series(frame, {"falls": points(10.0, 8.0, 6.0, 1.0), "dips": points(10.0, 14.0, 6.0, 1.0), "grows": points(1.0, 2.0, 3.0, 4.0), "late": [(2004, 1.0), (2006, 0.5)]})
    out = S.guard_decline(df, ["k"], "value", 2000, 2004, 2006)
    assert out.columns == df.columns
    got = {(r.k, r.year): r.value for r in out.collect()}
    assert [got["falls", y] for y in (2000, 2004, 2006, 2007)] == [10.0, 10.0, 10.0, 1.0]
    assert [got["dips", y] for y in (2004, 2006, 2007)] == [14.0, 16.0, 1.0]
    assert got["grows", 2006] == 3.0 and got["late", 2004] == 1.0 and got["late", 2006] == 0.5


def test_rates_start_at_the_first_active_year(frame):
    df = series(frame, {"a": [(1, 0.0), (2, 4.0), (3, 4.4), (4, 400.0)], "never": [(1, 0.0), (2, None)]})
    out = S.rate_from_first_active(df, ["k"], "value", "rate", -0.5, 0.5).orderBy("year").collect()
    assert [(r.k, r.year, r.base_year) for r in out] == [("a", 3, 2), ("a", 4, 2)]
    assert out[0].rate == pytest.approx(0.1) and out[1].rate == 0.5


def test_costs_decline_to_a_floor(frame):
    base = frame([("a", 100.0), ("b", None)], "k string, v double")
    out = S.decline_with_floor(base, "v", F.lit(0.19), 2, 0.15, [2000, 2001, 2002], "cost")
    got = {(r.k, r.year): r.cost for r in out.collect()}
    assert [got["a", y] for y in (2000, 2001, 2002)] == pytest.approx([100.0, 90.0, 85.0])
    assert got["b", 2001] is None and len(got) == 6
