"""Moving frames, as-of joins, interval joins and subtotals: boundaries, hot keys, odd rows and plans."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from compare import SMALL
from kerbline.functions.money import money_sum
from kerbline.operators import intervals, moving, rollup
from kerbline.operators.asof import asof_join
from workload import analysis, stage

START = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- moving frames --------------------------------------------------------


def _days(spark, rows):
    return spark.createDataFrame(rows, "zone string, day string, n bigint").withColumn("trip_date", F.to_date("day")).drop("day")


def test_frames_reach_six_days_back_and_not_seven(spark):
    days = _days(spark, [("a", "2024-02-26", 1), ("a", "2024-03-03", 10), ("a", "2024-03-04", 100)])
    rows = {r.trip_date.isoformat(): r for r in moving.moving_measure(days, ["zone"], "n").collect()}
    # 2024 has a 29th of February: the 26th lies six days before the third of March.
    assert rows["2024-03-03"].moving_sum == 11 and rows["2024-03-04"].moving_sum == 110
    assert rows["2024-03-04"].change_to_day == 90 and rows["2024-03-03"].change_to_day == 10
    assert (rows["2024-02-26"].change_to_day, rows["2024-03-03"].change_to_span) == (None, None)
    assert rows["2024-03-04"].change_to_span == 99 and rows["2024-03-04"].days_known == 7
    assert rows["2024-03-03"].moving_avg == 11 / 7


def test_days_without_a_row_are_zero_between_first_and_last(spark):
    days = _days(spark, [("a", "2024-01-30", 5), ("a", "2024-02-02", 7), ("b", "2024-05-01", 1), (None, "2024-01-01", 2), (None, "2024-01-03", 3), ("c", None, 9)])
    filled = moving.calendar_days(days, ["zone"], ["n"])
    found = sorted((r.zone or "", r.trip_date.isoformat(), r.n) for r in filled.collect())
    assert found == [
        ("", "2024-01-01", 2), ("", "2024-01-02", 0), ("", "2024-01-03", 3), ("a", "2024-01-30", 5), ("a", "2024-01-31", 0),
        ("a", "2024-02-01", 0), ("a", "2024-02-02", 7), ("b", "2024-05-01", 1),
    ]
    ranged = {(r.zone, r.trip_date): r.moving_sum for r in moving.moving_measure(days.where("trip_date IS NOT NULL"), ["zone"], "n").collect()}
    dense = {(r.zone, r.trip_date): r.moving_sum for r in moving.moving_measure(filled, ["zone"], "n").collect()}
    assert all(dense[place] == value for place, value in ranged.items())
    assert moving.calendar_days(days.where("false"), ["zone"], ["n"]).count() == 0


def test_moving_frames_cost_one_shuffle_after_the_daily_sums(spark):
    text = plan(analysis.all_queries()["moving_zone_demand"](spark, SMALL))
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text and "partial_sum" in text


def test_running_amounts_are_exact(spark):
    rows = [("a", f"2024-01-{d:02d}", 0) for d in range(1, 31)]
    days = _days(spark, rows).withColumn("x", F.lit(0.1))
    last = moving.running_amount(days, ["zone"], "x").orderBy(F.desc("trip_date")).first()
    assert last.running_amount == 3.0 and last.share_of_whole == 1.0


# -- as-of join -----------------------------------------------------------


def _at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def _plain_asof(facts, lookup, tolerance=None):
    out = []
    for number, key, at in facts:
        usable = [r for r in lookup if key is not None and at is not None and r[0] == key and r[1] is not None and r[1] <= at]
        best = max(usable, key=lambda r: (r[1], r[2] is not None, r[2] or "")) if usable else None
        if best and tolerance is not None and at - best[1] > tolerance:
            best = None
        out.append((number, key, at, best[2] if best else None))
    return sorted(out, key=lambda r: r[0])


def _asof(spark, facts, lookup, **more):
    one = spark.createDataFrame([(n, k, _at(t)) for n, k, t in facts], "number int, key int, at timestamp").repartition(3)
    two = spark.createDataFrame([(k, _at(t), name) for k, t, name in lookup], "key int, since timestamp, name string")
    joined = asof_join(one, two, ["key"], "at", "since", ["name"], **more)
    return sorted(((r.number, r.key, None if r.at is None else int((r.at - START).total_seconds() // 60), r.name) for r in joined.collect()))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("range_seconds", [600, 86_400 * 365])
def test_asof_equals_a_plain_search(spark, seed, range_seconds):
    pick = random.Random(seed)
    facts = [(n, pick.choice([1, 1, 1, 2, 3, None]), pick.choice([None, *range(200)])) for n in range(200)]
    lookup = [(pick.choice([1, 2, 4, None]), pick.choice([None, *range(-50, 200, 3)]), pick.choice(["a", "b", None])) for _ in range(60)]
    assert _asof(spark, facts, lookup, range_seconds=range_seconds) == _plain_asof(facts, lookup)
    assert _asof(spark, facts, lookup, range_seconds=range_seconds, tolerance_seconds=300) == _plain_asof(facts, lookup, 5)


def test_asof_of_equal_times_early_facts_and_empty_sides(spark):
    lookup = [(1, 10, "old"), (1, 10, "new"), (1, 20, "last")]
    assert [r[3] for r in _asof(spark, [(0, 1, 9), (1, 1, 10), (2, 1, 19), (3, 1, 20), (4, 1, 9000)], lookup)] == [None, "old", "old", "last", "last"]
    assert [r[3] for r in _asof(spark, [(0, 1, 5)], [])] == [None]
    assert _asof(spark, [], lookup) == []
    with pytest.raises(ValueError, match="both sides"):
        facts = spark.range(1).select(F.lit(1).alias("key"), F.current_timestamp().alias("at"), F.lit("x").alias("name"))
        asof_join(facts, facts.withColumnRenamed("at", "since"), ["key"], "at", "since", ["name"])


def test_asof_forms_no_pairs_and_cuts_a_hot_key_by_time(spark):
    query = analysis.all_queries()["asof_zone_names"](spark, SMALL)
    text = plan(query)
    assert "Join" not in text and text.count("Window ") == 2
    main = max((line for line in text.splitlines() if "Exchange hashpartitioning" in line), key=lambda line: line.count("#"))
    assert "pickup_location_id" in main and "_range" in main


# -- interval join --------------------------------------------------------


def _spans(spark, rows):
    return spark.createDataFrame([(n, k, _at(a), _at(b)) for n, k, a, b in rows], "n int, k int, a timestamp, b timestamp").repartition(3)


def _plain_pairs(rows):
    return sorted(
        (x[0], y[0], max(x[2], y[2]), (min(x[3], y[3]) - max(x[2], y[2])) * 60)
        for x, y in itertools.permutations(rows, 2)
        if x[0] < y[0] and x[1] is not None and x[1] == y[1] and x[2] < x[3] and y[2] < y[3] and x[2] < y[3] and y[2] < x[3]
    )


def _pairs(spark, rows, bin_seconds):
    spans = _spans(spark, rows)
    found = intervals.overlapping_pairs(spans, spans, ["k"], ("a", "b"), ("a", "b"), bin_seconds, F.col("left.n") < F.col("right.n"))
    return sorted((r.left.n, r.right.n, int((r.overlap_start - START).total_seconds() // 60), int(r.overlap_seconds)) for r in found.collect())


def _random_spans(seed, count=60):
    pick = random.Random(seed)
    starts = [pick.randrange(-100, 300) for _ in range(count)]
    return [(n, pick.choice([1, 1, 2, None]), a, a + pick.choice([-5, 0, 1, 7, 30, 400])) for n, a in enumerate(starts)]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("bin_seconds", [60, 3600, 86_400])
def test_pairs_equal_a_plain_search_for_any_bin(spark, seed, bin_seconds):
    rows = _random_spans(seed)
    assert _pairs(spark, rows, bin_seconds) == _plain_pairs(rows)


def test_touching_and_empty_spans_do_not_overlap(spark):
    rows = [(1, 1, 0, 60), (2, 1, 60, 120), (3, 1, 30, 30), (4, 1, 40, 20), (5, 1, 59, 61)]
    assert [(a, b) for a, b, *_ in _pairs(spark, rows, 3600)] == [(1, 5), (2, 5)]
    assert _pairs(spark, [(1, 1, 0, 60)], 60) == []


@pytest.mark.parametrize("range_seconds", [120, 86_400 * 30])
def test_event_counts_agree_with_the_pairs(spark, range_seconds):
    rows = _random_spans(7)
    moments = intervals.under_way(_spans(spark, rows), ["k"], ("a", "b"), range_seconds)
    assert sum(r.p for r in moments.select(intervals.pairs_begun().alias("p")).collect()) == len(_plain_pairs(rows))
    for r in moments.collect():
        at = int((r.instant - START).total_seconds() // 60)
        mine = [row for row in rows if row[1] == r.k and row[2] < row[3]]
        assert r.after == sum(a <= at < b for _, _, a, b in mine)
        assert r.before == sum(a < at <= b for _, _, a, b in mine)
        assert (r.begun, r.ended) == (sum(a == at for _, _, a, _ in mine), sum(b == at for *_, b in mine))


def test_pairs_come_from_an_equi_join_and_counts_from_no_join(spark):
    joined = plan(analysis.all_queries()["overlapping_trips"](spark, SMALL))
    assert ("SortMergeJoin" in joined or "HashJoin" in joined) and "NestedLoop" not in joined and "Cartesian" not in joined
    assert "Join" not in plan(analysis.all_queries()["zone_concurrency"](spark, SMALL))


# -- subtotals ------------------------------------------------------------


def test_a_null_value_and_a_total_are_told_apart(spark):
    rows = spark.createDataFrame([("m", None, 1.1), ("m", "x", 2.2), ("n", "x", 3.3)], "month string, borough string, v double")
    totals = rollup.subtotals(rows, rollup.rollup_levels(["month", "borough"]), [money_sum("v").alias("v")])
    found = sorted(((r.level, r.month or "-", r.borough or "-", r.v) for r in totals.collect()))
    assert found == [(0, "m", "-", 1.1), (0, "m", "x", 2.2), (0, "n", "x", 3.3), (1, "m", "-", 3.3), (1, "n", "-", 3.3), (3, "-", "-", 6.6)]
    assert rollup.subtotals(rows.where("false"), rollup.rollup_levels(["month"]), [F.count("*").alias("n")]).collect() == []


def test_subtotals_read_their_input_once(spark):
    text = plan(analysis.all_queries()["revenue_rollup"](spark, SMALL))
    assert text.count("Expand") == 1 and text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_stated_values_need_no_pass_over_the_data(spark):
    payment = stage.table(spark, SMALL, "payment_behavior_mart")
    wide = rollup.side_by_side(payment, ["trip_month"], "payment_type", [1, 77], F.sum("trip_count"), "t")
    assert wide.columns == ["trip_month", "t1", "t77"] and {r.t77 for r in wide.collect()} == {None}
