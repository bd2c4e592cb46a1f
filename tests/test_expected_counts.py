"""The counts listed in FIXTURES.md, and orders and invariants the SQL checks cannot see."""

import pytest

from compare import SMALL
from kerbline.operators.quality import check_trips, keep_valid, quarantine
from kerbline.plans import gold, reports, silver
from workload import stage
from workload.relations import AIRPORTS

MIDDLE = SMALL.replace("0.001", "0.01")
EXPECTED = {
    SMALL: {
        "bronze": 6874, "deduped": 6000, "silver": 3812, "total": 210751.75, "passengers": 13135,
        "airport": 944, "demand": 3146, "revenue": 1252, "spikes": 27,
        "checks": [44, 295, 601, 65, 98, 819, 684],
    },
    MIDDLE: {
        "bronze": 68590, "deduped": 60000, "silver": 47364, "total": 2622212.15, "passengers": 163956,
        "airport": 13928, "demand": 36991, "revenue": 8228, "spikes": 312,
        "checks": [295, 2981, 1178, 655, 1221, 3875, 4297],
    },
}


@pytest.mark.parametrize("sf_dir", EXPECTED)
def test_counts(spark, sf_dir):
    expected = EXPECTED[sf_dir]
    bronze = stage.table(spark, sf_dir, "yellow_trips")
    enriched = silver.enriched_trips(bronze, stage.table(spark, sf_dir, "silver_zones"), carried=[])
    assert bronze.count() == expected["bronze"]
    assert enriched.count() == expected["deduped"]
    assert [row.failed_rows for row in check_trips(enriched).collect()] == expected["checks"]
    assert keep_valid(enriched).count() == expected["silver"]
    assert quarantine(enriched).count() == expected["deduped"] - expected["silver"]

    fact = stage.table(spark, sf_dir, "fact_taxi_trips")
    demand = stage.table(spark, sf_dir, "demand_by_zone_hour_mart")
    kpi = reports.kpi_snapshot(fact).first()
    assert (kpi.total_trips, kpi.total_revenue) == (expected["silver"], expected["total"])
    assert demand.groupBy().sum("passenger_total").first()[0] == expected["passengers"]
    assert gold.airport_trips(fact, AIRPORTS).count() == expected["airport"]
    assert demand.count() == expected["demand"]
    assert stage.table(spark, sf_dir, "revenue_by_borough_day_mart").count() == expected["revenue"]
    assert reports.spikes(demand).count() == expected["spikes"]


def test_silver_passes_its_own_checks(spark):
    assert all(row.passed for row in check_trips(stage.table(spark, SMALL, "silver_trips")).collect())


# report -> (mart, sort keys: '-' for descending)
ORDERS = {
    reports.hourly_demand: ("demand_by_zone_hour_mart", "trip_date trip_hour -pickup_trip_count"),
    reports.peak_zone_hours: ("demand_by_zone_hour_mart", "-hourly_demand pickup_zone trip_hour"),
    reports.zone_ranking: ("demand_by_zone_hour_mart", "demand_rank pickup_zone"),
    reports.top_zones: ("demand_by_zone_hour_mart", "-total_pickups pickup_zone"),
    reports.spikes: ("demand_by_zone_hour_mart", "-z_score trip_date"),
    reports.hourly_heatmap: ("demand_by_zone_hour_mart", "trip_date trip_hour pickup_borough"),
    reports.top_zone_hours: ("demand_by_zone_hour_mart", "-pickup_trip_count trip_date trip_hour"),
    reports.hourly_volume: ("demand_by_zone_hour_mart", "trip_hour"),
    reports.daily_revenue: ("revenue_by_borough_day_mart", "trip_date -daily_revenue"),
    reports.monthly_revenue: ("revenue_by_borough_day_mart", "revenue_month -monthly_revenue"),
    reports.revenue_by_borough: ("revenue_by_borough_day_mart", "-revenue"),
    reports.payment_trends: ("payment_behavior_mart", "trip_date -trip_count pickup_borough payment_type"),
    reports.airport_routes: ("airport_trip_mart", "-trip_count -revenue pickup_zone"),
    reports.airport_revenue_rank: ("airport_trip_mart", "revenue_rank pickup_zone dropoff_zone"),
    reports.distance_duration: ("trip_efficiency_mart", "-avg_trip_distance"),
    reports.trip_efficiency: ("trip_efficiency_mart", "-avg_fare_per_mile"),
    reports.monthly_trips: ("fact_taxi_trips", "month"),
}


@pytest.mark.parametrize("report", ORDERS, ids=lambda report: report.__name__)
def test_report_order(spark, report):
    table, keys = ORDERS[report]
    rows = [row.asDict() for row in report(stage.table(spark, SMALL, table)).collect()]
    expected = list(rows)
    for key in reversed(keys.split()):
        expected.sort(key=lambda row: row[key.lstrip("-")], reverse=key.startswith("-"))
    assert rows == expected and rows
