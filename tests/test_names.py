"""Names by trigrams against the plain rule, and event flags against plain intervals."""

from datetime import date, timedelta

import pytest
from hypothesis import given, settings, strategies as st

from bazaarline.functions import events
from bazaarline.operators.names import best_matches

NAMES = ["Tomatoes", "tomatoes", "Red Tomatoes", "Oil", "oil (olive)", "É", "bé", "x", "", "Lamb", "lamb chops", None, "aaaa", "aaaaa", "日本 米"]
ASKED = ["TOMATOES", "tomato", "oil", "OLIVE", "the lamb chops of today", "é", "", "none of them?", "x", "ob", "aaa", "AAAAAA", "本 米", None, "oil", "am"]


def plain(names, request):
    if request is None:
        return None
    names, wanted = sorted({n for n in names if n is not None}), request.lower()
    for n in names:
        if n.lower() == wanted:
            return n
    return next((n for n in names if wanted in n.lower() or n.lower() in wanted), None)


def run(spark, names, asked):
    table = spark.createDataFrame([(n, 1) for n in names], "name string, requested int")
    wanted = spark.createDataFrame([(r,) for r in asked], "requested string")
    rows = best_matches(table.drop("requested"), wanted).collect()
    assert len(rows) == len({r for r in asked})
    return {r.requested: r.name for r in rows}


@pytest.mark.parametrize("drop", [[], [""], ["", "x", "É"]])
def test_names_follow_the_rule(spark, drop):
    names = [n for n in NAMES if n not in drop]
    assert run(spark, names, ASKED) == {r: plain(names, r) for r in ASKED}


def test_no_names_and_no_requests(spark):
    assert run(spark, [], ["a", ""]) == {"a": None, "": None}
    assert run(spark, ["a"], []) == {}


word = st.text("abAB é", max_size=7)


@settings(max_examples=6, deadline=None)
@given(st.lists(word, max_size=25), st.lists(word, max_size=25))
def test_names_at_random(spark, names, asked):
    assert run(spark, names, asked) == {r: plain(names, r) for r in asked}


def test_no_nested_loop_join(spark):
    table = spark.createDataFrame([("Oil",), ("Lamb",)], "name string")
    plan = best_matches(table, table.toDF("requested"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


SPANS = [
    (date(2020, 1, 31), date(2020, 2, 1), "a"),
    (date(2020, 2, 27), date(2020, 5, 3), "a"),
    (date(2020, 4, 1), date(2020, 4, 1), "b"),
    (date(2020, 4, 30), date(2020, 4, 2), "b"),
    (None, date(2020, 6, 1), "a"),
    (date(2019, 11, 5), date(2021, 1, 1), None),
    (date(2020, 12, 31), date(2021, 3, 31), "b"),
    (date(2020, 3, 1), date(2020, 3, 31), "a"),
]


@pytest.mark.parametrize("keyed", [False, True])
def test_event_flags_equal_intervals(spark, keyed):
    days = [date(2019, 10, 20) + timedelta(days=i) for i in range(560)] + [None]
    rows = spark.createDataFrame([(d, k, 5) for d in days for k in ("a", "b")], "date date, kind string, _month int")
    table = spark.createDataFrame(SPANS, "start date, end date, kind string")
    spans = SPANS if keyed else [s for s in SPANS if s[2]]
    flagged = events.add_event_flag(rows, table.where("kind is not null") if not keyed else table, "on", keys=["kind"] if keyed else [])
    assert flagged.columns == [*rows.columns, "on"]
    got = flagged.collect()
    assert len(got) == rows.count()
    inside = lambda d, k: any(a and a <= d <= b and (not keyed or k == s) for a, b, s in spans)
    assert all(r.on == (1 if r.date and inside(r.date, r.kind) else 0) for r in got)


def test_yearly_flags_and_no_events(spark):
    rows = spark.createDataFrame([(date(2020, 2, 29),), (date(2021, 2, 28),), (date(2021, 12, 31),), (None,)], "date date")
    table = spark.createDataFrame([(2, 29), (12, 31), (13, 1), (2, None)], "month int, day int")
    assert sorted((str(r.date), r.on) for r in events.add_yearly_flag(rows, table, "on").collect()) == [
        ("2020-02-29", 1), ("2021-02-28", 0), ("2021-12-31", 1), ("None", 0)
    ]
    none = spark.createDataFrame([], "start date, end date")
    assert [r.on for r in events.add_event_flag(rows, none, "on").collect()] == [0] * 4


def test_events_meet_by_equality(spark):
    rows = spark.range(10).selectExpr("date_add(date'2020-01-01', cast(id as int)) as date")
    table = spark.createDataFrame(SPANS, "start date, end date, kind string")
    plan = events.add_event_flag(rows, table, "on")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
