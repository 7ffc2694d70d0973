"""Dirty cells, keys, orphans and counts."""

from __future__ import annotations

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.text import normalise_name
from ledgerline.operators import cleaning, integrity
from ledgerline.sources.contracts import CONTRACTS, ForeignKey, TableContract
from ledgerline.sources.files import normalise_headers, resolve_columns

INTEGERS = [
    ("567335", 567335, "plain"), ("567335.0", 567335, "plain"), ("fd123", 123, "prefix"), ("mn45", 45, "prefix"),
    ("50+ ratings", 50, "band"), ("1K+ ratings", 1000, "band"), ("500+", 500, "band"), ("1.5k+", 1500, "band"),
    ("Too Few Ratings", None, "lost"), ("567335.5", None, "nonint"), ("1,234", 1234, "plain"), (None, None, None),
    ("-7", -7, "plain"), ("  8 ", 8, "plain"), ("1e3", 1000, "plain"), ("inf", None, "lost"), ("nan", None, "lost"),
    ("1d", None, "lost"), ("9007199254740993", 9007199254740993, "plain"), ("abc-12", 12, "prefix"), ("", None, "lost"),
    ("1234567890123456789", 1234567890123456789, "plain"), ("fd9007199254740993", 9007199254740993, "prefix"),
    ("9007199254740993.0", 9007199254740993, "plain"), ("9007199254740993+", 9007199254740993, "band"),
    ("9223372036854775808", None, "plain"),
]
NUMBERS = [
    ("₹ 200", 200.0), ("--", None), ("NEW", None), ("4.1", 4.1), ("-300.5", -300.5), ("1,250.00", 1250.0),
    ("1-2", None), (None, None), (".", None), ("3.9/5", 3.95),
]


def test_integers(spark):
    df = spark.createDataFrame([(t,) for t, *_ in INTEGERS], "text string").withColumn("v", F.col("text"))
    got = {r["text"]: (r["v"], r["v_reading"]) for r in cleaning.parse_integers(df, ["v"], readings=True).collect()}
    assert got == {t: (v, how) for t, v, how in INTEGERS}


def test_integer_stats_count_every_reading(spark):
    df = spark.createDataFrame([(t,) for t, *_ in INTEGERS], "v string")
    row = cleaning.integer_stats(df, ["v"]).first()
    hows = [how for *_, how in INTEGERS]
    assert (row["prefix"], row["band"], row["nonint"]) == (hows.count("prefix"), hows.count("band"), 1)
    assert row["lost"] == hows.count("lost") + hows.count("nonint")


def test_numbers(spark):
    df = spark.createDataFrame([(t,) for t, _ in NUMBERS], "text string").withColumn("v", F.col("text"))
    assert {r["text"]: r["v"] for r in cleaning.parse_numbers(df, ["v"]).collect()} == dict(NUMBERS)


def spelled(text: str):
    """The documented rule for one cell, in plain Python."""
    t = text.strip(" \t\n\x0b\x0c\r\xa0").replace(",", "")
    if re.fullmatch(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?", t):
        number = float(t)
    elif m := re.fullmatch(r"[A-Za-z_\-]*([0-9]+(?:\.[0-9]+)?)", t):
        number = float(m.group(1))
    elif m := re.match(r"([0-9]+(?:\.[0-9]+)?)\s*([kK])?\+", t):
        number = float(m.group(1)) * (1000 if m.group(2) else 1)
    else:
        return None
    return int(number) if number == int(number) else None


def test_random_integers_follow_the_rule(spark):
    rng = random.Random(11)
    pieces = ["", "fd", "mn_", "-", "+", "K", "k", "+ ratings", ".", "0", "7", "42", "1,000", " ", "e1", "x", ".50", "₹"]
    cells = sorted({"".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))) for _ in range(3000)})
    df = spark.createDataFrame([(c,) for c in cells], "text string").withColumn("v", F.col("text"))
    got = {r["text"]: r["v"] for r in cleaning.parse_integers(df, ["v"]).collect()}
    assert got == {c: spelled(c) for c in cells}


def test_strings(spark):
    cells = ["", "nan", "None", " \tINR\r\n", "a b", None, "   "]
    df = cleaning.clean_strings(spark.createDataFrame([(c,) for c in cells], "c string"))
    assert [r["c"] for r in df.collect()] == [None, None, None, "INR", "a b", None, None]


@pytest.mark.parametrize(
    "cells, expected",
    [
        (["25/12/2019", "03/04/2019"], [datetime(2019, 12, 25), datetime(2019, 4, 3)]),
        (["12/25/2019", "03/04/2019"], [datetime(2019, 12, 25), datetime(2019, 3, 4)]),
        (["03/04/2019", "2019-05-06 10:30"], [datetime(2019, 3, 4), datetime(2019, 5, 6, 10, 30)]),
        (["31/12/2019", "soon", "1-2-2020 5:06:07"], [datetime(2019, 12, 31), None, datetime(2020, 2, 1, 5, 6, 7)]),
        (["2020/02/29", "2019-02-29", "2019"], [datetime(2020, 2, 29), None, None]),
        (
            ["2019-12-25T10:00:00Z", "12/25/2019 10:00 PM", "25-Dec-2019", "December 25, 2019", "12/25/19", "20191225",
             "25.12.2019", "2019-12-25 10:00:00+05:30"],
            [datetime(2019, 12, 25, 10), datetime(2019, 12, 25, 22), *[datetime(2019, 12, 25)] * 5, datetime(2019, 12, 25, 4, 30)],
        ),
        (["1 jan 70", "Feb 30, 2019", "Xyz 3, 2019", "3/4/2019 12:05 am", "13/13/2019", "2019-01-02T03:04:05.678"],
         [datetime(1970, 1, 1), None, None, datetime(2019, 3, 4, 0, 5), None, datetime(2019, 1, 2, 3, 4, 5, 678000)]),
    ],
)
def test_dates(spark, cells, expected):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    assert [r["c"] for r in cleaning.parse_timestamps(df, ["c"]).orderBy("i").collect()] == expected


def test_headers(spark):
    assert normalise_name(" Approx Cost (for two) ") == "approx_cost_for_two"
    df = spark.createDataFrame([("1", "x", "y", "200", "z")], ["ID", "r_id", "Restaurant Name", "Cost!", "other"])
    contract = TableContract({k: CONTRACTS["restaurant"].headers[k] for k in ("restaurant_id", "name", "cost_for_two")}, {})
    with pytest.warns(UserWarning, match="ignoring"):
        out = resolve_columns(normalise_headers(df), "restaurant", contract)
    assert out.columns == ["restaurant_id", "name", "cost_for_two"]
    assert tuple(out.first()) == ("1", "y", "200")  # "id" is preferred to "r_id"
    with pytest.raises(ValueError, match="no header for"):
        resolve_columns(normalise_headers(df), "orders", CONTRACTS["orders"])


def test_keep_first_and_null_keys(spark):
    data = [(1, 1, "a", 1), (1, 1, "b", 2), (None, 1, "c", 3), (2, 1, None, 4), (2, 1, "e", 5), (2, None, "f", 6)]
    df = spark.createDataFrame(data, "r int, f int, v string, at int")
    got = cleaning.keep_first(df, ["r", "f"], ["at"]).orderBy("r").collect()
    assert [tuple(r) for r in got] == [(1, 1, "a", 1), (2, 1, None, 4)]


def test_keep_first_without_key_keeps_all(spark):
    df = spark.range(5)
    assert cleaning.keep_first(df, (), ["id"]).count() == 5


def test_orphans_are_reported_under_their_first_key(spark):
    orders = spark.createDataFrame(
        [(1, 1, 1), (2, 9, 9), (3, 1, 9), (4, None, 9), (5, None, None), (6, 9, 1)], "id int, user_id int, seller int"
    )
    keys = [ForeignKey("user_id", "users", "user_id"), ForeignKey("seller", "sellers", "seller")]
    parents = {"users": spark.createDataFrame([(1,)], "user_id int"), "sellers": spark.createDataFrame([(1,)], "seller int")}
    marked = integrity.mark_orphans(orders, keys, parents)
    got = {r["id"]: r["reject_reason"] for r in marked.collect()}
    assert got == {1: None, 2: "user_id", 3: "seller", 4: "seller", 5: None, 6: "user_id"}
    kept, rejected = integrity.split_orphans(marked)
    assert (kept.count(), rejected.count()) == (2, 4)


@pytest.mark.parametrize(
    "listing, expected", [([1, 2], 1), ([1, None], 0), ([], 3), ([None], 0), ([1, 2, 3, 3], 0)]
)
def test_never_listed_follows_not_in(spark, listing, expected):
    catalog = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    listed = spark.createDataFrame([(k,) for k in listing], "k int")
    row = integrity.never_listed(catalog, listed, "k").first()
    assert (row["total_items"], row["never_listed"]) == (3, expected)


def test_constraints(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "abcdef"), (None, "x")], "k long, t string")
    contract = TableContract({}, {"k": "smallint", "t": "varchar(5)"}, key=("k",))
    got = {r["rule"]: r["violations"] for r in integrity.constraint_violations("x", df, contract, {}).collect()}
    assert got == {"not null k": 1, "range k smallint": 0, "length t <= 5": 1, "unique k": 1}


def test_reconciliation(spark):
    report = integrity.reconcile_counts({"a": 5, "b": 4}, {"a": spark.range(5), "b": spark.range(5)})
    with pytest.raises(AssertionError, match="b"):
        integrity.require_reconciled(report)
