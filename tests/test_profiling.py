"""Repeated rows of every type."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from ledgerline.operators.profiling import column_profile, table_profile

KIND = (
    "at timestamp, local timestamp_ntz, x double, f float, raw binary, list array<string>, "
    "box struct<t:timestamp,n:array<int>>, map map<string,double>, d decimal(9,2), s string"
)


def row(**other):
    base = {
        "at": datetime(2020, 1, 1, 0, 0, 0, 1), "local": datetime(2020, 1, 1, 0, 0, 0, 1), "x": 0.0, "f": 0.0, "raw": b"ab",
        "list": ["a", None], "box": (datetime(2020, 1, 1, 0, 0, 0, 1), [1, None]), "map": {"k": 1.0, "l": None},
        "d": Decimal("1.50"), "s": "1,2",
    }
    return tuple({**base, **other}.values())


def duplicates(spark, *rows):
    return table_profile(spark.createDataFrame(list(rows), KIND), "t").first()["duplicate_rows"]


def test_rows_that_differ_in_any_type_are_told_apart(spark):
    later = datetime(2020, 1, 1, 0, 0, 0, 2)
    others = [
        {"at": later}, {"local": later}, {"x": 5e-324}, {"x": float("nan")}, {"x": None}, {"f": float("nan")}, {"raw": b"a"}, {"raw": None},
        {"list": [None, "a"]}, {"list": ["a"]}, {"list": ["a", ""]}, {"list": None}, {"list": []}, {"box": (later, [1, None])},
        {"box": (datetime(2020, 1, 1, 0, 0, 0, 1), [None, 1])}, {"box": None}, {"box": (None, None)}, {"map": {"k": 1.0}},
        {"map": {"k": None, "l": 1.0}}, {"map": {"k": -0.5, "l": None}}, {"d": Decimal("1.51")}, {"s": "1"}, {"s": ""}, {"s": None},
    ]
    assert duplicates(spark, row(), *[row(**o) for o in others]) == 0
    assert duplicates(spark, *[row(**o) for o in others], *[row(**o) for o in others]) == len(others)


def test_one_zero_and_one_nan(spark):
    assert duplicates(spark, row(), row(x=-0.0), row(f=-0.0), row(map={"l": None, "k": 1.0})) == 3
    assert duplicates(spark, row(x=float("nan")), row(x=float("nan"))) == 1
    assert duplicates(spark, row(x=None), row(x=None), row(x=float("nan"))) == 1


def test_nulls_do_not_slide_into_the_next_column(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "p string, q string")
    assert table_profile(df, "t").first()["duplicate_rows"] == 0
    assert table_profile(df.limit(0), "t").first()["rows"] == 0


def test_columns_are_counted_without_sorting_cells(spark):
    rows = [(float(i % 3) if i % 5 else float("nan"), -0.0 if i % 2 else 0.0, [i % 4, None], "v" * 30 + str(i % 7), i % 2 == 0, None) for i in range(70)]
    df = spark.createDataFrame(rows, "x double, zero double, list array<int>, s string, flag boolean, none int")
    exact, guess, bare = column_profile(df), column_profile(df, approx=True), column_profile(df, samples=0)
    for profile in (exact, guess, bare):
        text = profile._jdf.queryExecution().executedPlan().toString()
        cells = text[text.index("Generate explode") :] if profile is not guess else text
        assert "SortAggregate" not in cells and "md5" not in text
    assert "Generate explode" not in guess._jdf.queryExecution().executedPlan().toString()
    got = {r["column"]: tuple(r)[1:] for r in exact.collect()}
    assert got["x"] == ("double", 56, 14, 20.0, 3, "0.0, 1.0, 2.0")
    assert got["zero"] == ("double", 70, 0, 0.0, 1, "0.0")
    assert got["list"][4:] == (4, "[0, null], [1, null], [2, null], [3, null]")
    assert got["s"][4:] == (7, ", ".join(["v" * 22 + "..."] * 5))
    assert got["flag"][4:] == (2, "false, true") and got["none"] == ("int", 0, 70, 100.0, 0, None)
    assert {r["column"]: tuple(r)[1:] for r in bare.collect()} == {c: v[:-1] for c, v in got.items()}
    assert {r["column"]: tuple(r)[1:5] for r in guess.collect()} == {c: v[:4] for c, v in got.items()}
    assert column_profile(df.limit(0)).count() == column_profile(df.limit(0), approx=True).count() == 0
