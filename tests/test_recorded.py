"""Recorded figures of the 41-vendor data set, recomputed by the operators.

The purchase lines behind them are not available, only the vendor results, so
the operators that work on vendor results are checked against the record.
"""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from procurelens.plans import delivery, opportunity, vendor
from tests.conftest import one, rows

# Spend, price index, on-time %, days late, composite score per vendor.
RECORDED = [
    ("2250817.81", 0.9443, 97.2, 3.6, 85.2),
    ("3315575.47", 0.9513, 95.0, 1.8, 83.8),
    ("5978702.79", 0.9168, 84.4, 6.4, 72.9),
    ("4297745.29", 0.9585, 87.3, 13.3, 68.2),
    ("11851525.33", 0.8310, 89.5, 30.4, 65.4),
    ("7892424.65", 0.9507, 89.5, 20.2, 65.0),
    ("17688556.19", 0.9220, 79.7, 8.2, 64.4),
    ("14293641.30", 0.9611, 86.2, 15.8, 62.8),
    ("15460921.61", 0.9923, 82.6, 7.8, 62.8),
    ("21935082.04", 0.9243, 77.8, 6.3, 62.8),
    ("5320890.77", 1.0345, 83.1, 7.6, 62.7),
    ("44978383.00", 1.1231, 96.5, 5.1, 61.1),
    ("29733206.34", 0.9538, 86.0, 15.9, 59.5),
    ("19118014.62", 0.8689, 82.7, 24.7, 58.9),
    ("2509713.45", 1.1765, 88.5, 7.6, 58.3),
    ("2706277.59", 1.0925, 81.3, 9.6, 56.3),
    ("4500157.05", 0.7548, 59.0, 14.6, 56.0),
    ("4161740.65", 0.9516, 74.3, 15.9, 55.1),
    ("5986693.10", 1.0048, 79.8, 17.1, 55.0),
    ("2249638.33", 0.7981, 52.8, 4.5, 54.9),
    ("1817274.88", 1.0907, 81.0, 12.2, 54.5),
    ("7334335.21", 0.9429, 75.1, 18.3, 54.0),
    ("19047805.25", 1.0396, 88.0, 22.5, 53.2),
    ("8515901.08", 0.8826, 65.4, 14.7, 51.8),
    ("6170190.56", 1.1188, 85.8, 18.4, 51.5),
    ("5613713.09", 0.9446, 70.3, 16.0, 51.5),
    ("2204299.93", 1.0268, 73.0, 13.6, 50.7),
    ("2944158.02", 0.9602, 61.4, 6.6, 49.7),
    ("5882072.62", 0.9995, 63.9, 8.5, 47.1),
    ("21940058.14", 1.0481, 80.7, 20.1, 47.0),
    ("41574951.21", 1.0128, 74.4, 10.2, 46.2),
    ("3818936.36", 0.9751, 59.6, 14.4, 41.3),
    ("19818851.24", 0.8492, 55.9, 18.7, 40.2),
    ("3614868.99", 1.0411, 56.2, 5.1, 40.2),
    ("33088786.40", 1.1142, 68.1, 4.1, 39.6),
    ("26274309.11", 0.9798, 68.6, 22.2, 38.5),
    ("25263785.60", 1.0960, 68.2, 10.8, 38.1),
    ("11099793.17", 1.0764, 60.6, 10.7, 36.0),
    ("13496250.34", 1.1045, 61.5, 10.8, 34.2),
    ("7082072.48", 1.0326, 60.8, 20.4, 33.4),
    ("6819450.48", 1.1802, 56.1, 7.8, 27.6),
]


@pytest.fixture(scope="module")
def metrics(spark):
    data = [(f"V{i:02d}", Decimal(r[0]), float(r[1]), float(r[2]), float(r[3]), float(r[4]))
            for i, r in enumerate(RECORDED)]
    df = spark.createDataFrame(
        data, "vendor_id string, spend decimal(18,2), price_index double, on_time_pct double, "
              "avg_days_late double, recorded double")
    total = sum(Decimal(r[0]) for r in RECORDED)
    return df.select(
        "*", (F.col("spend").cast("double") / float(total)).alias("spend_share"),
        opportunity.price_band("price_index").alias("price_band"),
        opportunity.delivery_band("on_time_pct").alias("delivery_band"))


def test_concentration(metrics):
    got = one(vendor.concentration_of(metrics.select("vendor_id", "spend")))
    assert {k: round(v, 3) for k, v in got.items()} == {
        "top1_pct": 9.002, "top5_pct": 35.154, "top10_pct": 56.785, "hhi": 439.386}


def test_weak_delivery_share(metrics):
    got = one(delivery.weak_share_of(metrics))
    assert (got["vendors"], round(got["pct_of_spend"], 3)) == (15, 34.918)


def test_tail(metrics):
    got = {r["segment"]: r for r in opportunity.tail_spend_of(
        metrics.select("vendor_id", "spend"), 0.8).collect()}
    tail = got[opportunity.TAIL]
    assert (tail["vendors"], tail["pct_of_spend"]) == (22, 19.3)
    assert round(tail["avg_spend_per_vendor"]) == 4389969
    assert got[opportunity.HEAD]["vendors"] == 19


def test_quadrants(metrics):
    got = {(r[0], r[1]): (r[2], str(r[3])) for r in rows(opportunity.quadrants_of(metrics))}
    above, at, below = opportunity.ABOVE, opportunity.AT, opportunity.BELOW
    weak, mid, strong = opportunity.WEAK, opportunity.MID, opportunity.STRONG
    assert got == {
        (above, weak): (5, "89768065.99"), (above, mid): (2, "4523552.47"),
        (above, strong): (3, "53658287.01"), (at, weak): (6, "49616417.58"),
        (at, mid): (7, "96649555.41"), (at, strong): (6, "78580398.30"),
        (below, weak): (4, "35084547.70"), (below, mid): (6, "77668403.94"),
        (below, strong): (2, "14102343.14")}


def test_correlation(metrics):
    assert round(one(opportunity.correlation_of(metrics))["pearson_r"], 4) == 0.0919


def test_composite_score(metrics):
    scored = opportunity.scored(metrics)
    worst = one(scored.agg(F.max(F.abs(F.col("composite") - F.col("recorded"))).alias("d")))["d"]
    assert worst <= 0.11  # the recorded inputs are rounded
