"""Purchase star, data tests and scalar helpers on golden rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paddock.functions import scalars
from paddock.operators import checks, models


def _purchases(spark):
    cp = spark.createDataFrame(
        [(1, "Ann", 10, 100, 2), (2, "Bob", 20, 100, 1), (3, "Cy", 10, 200, 5), (4, "Di", 99, 100, 1)],
        "id bigint, name string, region bigint, product bigint, qty int",
    )
    region = spark.createDataFrame([(10, "EU"), (20, "US")], "id bigint, name string")
    products = spark.createDataFrame([(100, "Pen"), (200, "Ink")], "id bigint, product string")
    return cp, region, products


def test_purchase_star(spark):
    pe = models.purchase_enriched(*_purchases(spark))
    assert pe.columns == ["id", "name", "region", "product", "qty"]
    assert sorted(map(tuple, pe.collect())) == [
        (1, "Ann", "EU", "Pen", 2), (2, "Bob", "US", "Pen", 1), (3, "Cy", "EU", "Ink", 5)
    ]
    assert dict(map(tuple, models.products_purchase_count(pe).collect())) == {"Pen": 2, "Ink": 1}
    assert dict(map(tuple, models.region_purchase_count(pe).collect())) == {"EU": 2, "US": 1}


def test_purchase_star_without_broadcast_matches(spark):
    a = models.purchase_enriched(*_purchases(spark), broadcast=False)
    b = models.purchase_enriched(*_purchases(spark), broadcast=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id bigint")
    assert [tuple(r) for r in checks.unique(df, "id").collect()] == [(2, 2)]
    assert checks.not_null(df, "id").count() == 1
    s = checks.summarize(checks.unique(df, "id"), "unique_id").first()
    assert (s.test_name, s.failures, s.status) == ("unique_id", 1, "fail")
    ok = spark.createDataFrame([(1,), (2,), (None,)], "id bigint")
    assert checks.summarize(checks.unique(ok, "id"), "u").first().status == "pass"
    assert checks.summarize(checks.not_null(ok.where("id is not null"), "id"), "n").first().status == "pass"


def test_json_map_total_and_report(spark):
    df = spark.createDataFrame([('{"1001": 301.27, "1002": 433.21, "1003": 502.22}',)], "props string")
    row = df.select(
        scalars.map_values_sum(scalars.json_number_map("props")).alias("t")
    ).select("t", scalars.total_report("t").alias("r")).first()
    assert abs(row.t - 1236.70) < 1e-9
    assert row.r == "Total order value is: 1236.70"


def test_day_helpers(spark):
    days = [dt.datetime(2024, 1, d, 12) for d in range(1, 8)]  # Mon 1 Jan .. Sun 7 Jan
    df = spark.createDataFrame([(i, t) for i, t in enumerate(days)], "event_id int, ts timestamp")
    routed = {r.day_name: (r.is_weekend, r.route) for r in scalars.weekday_route(df, "ts").collect()}
    assert routed["monday"] == (False, "weekday")
    assert routed["saturday"] == (True, "weekend")
    assert routed["sunday"] == (True, "weekend")
    acts = {r.day_name: r for r in scalars.day_activity(spark, df, "ts").collect()}
    assert len(acts) == 7
    assert acts["thursday"].task_path == "weekday_activities.contributing_to_Airflow"
    assert acts["saturday"].task_path == "weekend_activities.going_to_the_beach"
    assert acts["monday"].message == "It's Monday and I'm busy with guitar lessons."


def test_average_speed_uses_utc_day(spark):
    df = spark.createDataFrame(
        [("T", "D", "L", dt.datetime(2023, 9, 1, 23, 59, 59), 100, 8),
         ("T", "D", "L", dt.datetime(2023, 9, 2, 0, 0, 0), 200, 8)],
        "team_name string, full_name string, location string, date timestamp, speed int, n_gear int",
    )
    rows = sorted((str(r.date), r.average_speed) for r in models.average_speed(df).collect())
    assert rows == [("2023-09-01", 100.0), ("2023-09-02", 200.0)]
    assert models.sort_model(models.avg_speed_gear(df)).columns == [
        "team_name", "full_name", "location", "date", "n_gear", "average_speed"
    ]
    assert df.select(F.year("date")).distinct().count() == 1


def test_declared_test_table_schemas_match_the_files(spark):
    from paddock.plans.standins import TABLE_SCHEMAS
    from pyspark.sql.types import StructType

    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        for name, ddl in TABLE_SCHEMAS.items():
            inferred = spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet").schema
            assert inferred.simpleString() == StructType.fromDDL(ddl).simpleString(), (sf, name)


def test_models_from_partials_equal_direct_averages(spark):
    from conftest import SF_ORACLE
    from paddock.plans.queries.base import enriched_fact

    e = enriched_fact(spark, SF_ORACLE)
    p = models.speed_partials(e)
    for direct, derived in ((models.average_speed(e), models.average_speed_from_partials(p)),
                            (models.avg_speed_gear(e), models.avg_speed_gear_from_partials(p))):
        assert derived.columns == direct.columns
        assert derived.schema == direct.schema
        assert direct.exceptAll(derived).isEmpty() and derived.exceptAll(direct).isEmpty()


def test_fused_tests_equal_the_single_ones(spark):
    rows = [(1, "a", None, 1.0), (2, "a", None, 2.0), (2, None, "x", None), (None, "b", "y", 2.0), (None, "b", "y", 0.0), (3, "", "z", -0.0)]
    df = spark.createDataFrame(rows, "n bigint, set_0 string, nulls_0 string, key_0 double")
    cases = [("unique", c) for c in df.columns] + [("not_null", c) for c in df.columns]
    for some in (cases, cases[:1], cases[4:], cases[1:3] + cases[6:], [cases[7]], [cases[0], cases[0], cases[4]]):
        got = checks.fused(df, [(f"{t}_{c}", t, c) for t, c in some]).collect()
        want = [checks.summarize(checks.TESTS[t](df, c), f"{t}_{c}").first() for t, c in some]
        assert got == want
    none = df.where("false")
    assert [r.failures for r in checks.fused(none, [(c, t, c) for t, c in cases]).collect()] == [0] * len(cases)


def test_fused_tests_refuse_unknown_ones(spark):
    import pytest

    with pytest.raises(ValueError, match="no such"):
        checks.fused(spark.range(1), [("x", "between", "id")])
