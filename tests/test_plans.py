"""Plan assertions: pushdown, pruning, broadcast only when measured, one
shuffle per aggregate, no extra shuffle in the merge."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL, write_text
from paddock.operators import joins, models
from paddock.plans import ingest, registry
from paddock.sources import files
from test_golden_ingest import BATCH1, CAR_COLUMNS_A, _car_rows, _csv


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def tree(text: str) -> str:
    """The operator tree part of a formatted plan."""
    return text.split("\n\n")[0]


def test_enrich_broadcasts_measured_dims_and_scans_fact_once(spark):
    p = plan(registry.QUERIES["enrich"](spark, SF_SMALL))
    t = tree(p)
    assert "SortMergeJoin" not in t
    assert t.count("BroadcastHashJoin") == 3  # car-driver, car-session, nation-region
    assert len(re.findall(r"Location: InMemoryFileIndex \[[^\]]*events\.parquet", p)) == 1
    # Only the columns the projection needs are read from the fact.
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in p


def test_dimension_over_the_cap_is_not_broadcast(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(5).withColumnRenamed("id", "k2")
    small = joins.dimension(dim, max_rows=10)
    big = joins.dimension(dim, max_rows=3)
    assert "BroadcastHashJoin" in tree(plan(fact.join(small, fact.k == small.k2)))
    t = tree(plan(fact.join(big, fact.k == big.k2)))
    assert "BroadcastHashJoin" not in t and "SortMergeJoin" in t
    check = joins.measure(dim, max_rows=3)
    assert check.capped and not check.fits(3, 10**9)


def test_average_speed_is_partial_then_final_with_one_shuffle(spark):
    t = tree(plan(registry.QUERIES["average_speed"](spark, SF_SMALL)))
    assert t.count("HashAggregate") == 2
    assert len(re.findall(r"\+- Exchange \(", t)) == 1


def test_merge_reuses_the_aggregate_partitioning(spark):
    t = tree(plan(registry.QUERIES["merge_average_speed"](spark, SF_SMALL)))
    assert "SortMergeJoin FullOuter" in t
    # One hash exchange per aggregate side and none added for the join.
    assert len(re.findall(r"\+- Exchange \(", t)) == 2


def test_watermark_literal_reaches_the_csv_scan(spark, workdir):
    write_text(f"{workdir}/car/one.csv", _csv(CAR_COLUMNS_A, _car_rows(BATCH1)))
    car = files.read_car_csv(spark, f"{workdir}/car")
    wm = 1693573200000000  # 2023-09-01 13:00:00 UTC in microseconds
    new = car.where(F.col("date") > ingest.token_literal(wm, car.schema["date"].dataType))
    p = plan(new)
    assert re.search(r"PushedFilters: \[IsNotNull\(date\), GreaterThan\(date,2023-09-01 13:00:00", p) or \
        re.search(r"PushedFilters: \[IsNotNull\(date\), GreaterThan\(date,2023-09-01T13:00", p), p
    assert new.count() == 5


def test_upsert_reads_only_touched_partitions(spark, workdir):
    import datetime as dt
    import uuid

    from paddock.plans import sinks
    from paddock.schemas import AVERAGE_SPEED_KEYS

    schema = "team_name string, full_name string, location string, date date, average_speed double"
    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    t = spark.createDataFrame([("T", "D", "L", d, 1.0) for d in days], schema)
    name = f"prune_{uuid.uuid4().hex[:8]}"
    sinks.upsert(t, name, AVERAGE_SPEED_KEYS, path=f"{workdir}/{name}")
    src = spark.createDataFrame([("T", "D", "L", days[-1], 5.0), ("T", "D", "L", dt.date(2024, 1, 11), 6.0)], schema)
    sinks.upsert(src, name, AVERAGE_SPEED_KEYS)
    got = sorted((str(r.date), r.average_speed) for r in spark.table(name).collect())
    assert len(got) == 11 and got[-2:] == [("2024-01-10", 5.0), ("2024-01-11", 6.0)]
    assert got[0] == ("2024-01-01", 1.0)
    # The pruned read the sink builds: a literal partition filter on the target.
    target = spark.table(name).where(F.col("date").isin([days[-1]]))
    assert "PartitionFilters: [isnotnull(date" in plan(target) or "PartitionFilters: [date" in plan(target)


def test_partitioned_write_is_rebalanced(spark):
    from paddock.plans.sinks import cluster_for_write

    df = models.average_speed(registry.QUERIES["enrich"](spark, SF_SMALL))
    assert "REBALANCE" in plan(cluster_for_write(df, ["date"]), "extended").upper()


def test_ntz_watermark_round_trip_ignores_session_zone(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [(dt.datetime(2024, 3, 10, 2, 30, 0, 123456),)], "date timestamp_ntz"
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:30 does not exist on this day in New York; no zone may touch it.
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        token, n = ingest.watermark_token(df, "date")
        assert token == "2024-03-10 02:30:00.123456" and n == 1
        assert df.where(F.col("date") > ingest.token_literal(token, df.schema["date"].dataType)).count() == 0
        assert ingest.token_to_datetime(spark, token, df.schema["date"].dataType) == dt.datetime(2024, 3, 10, 2, 30, 0, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_upsert_keeps_rows_of_a_rewritten_null_partition(spark, workdir):
    import datetime as dt
    import uuid

    from paddock.plans import sinks
    from paddock.schemas import AVERAGE_SPEED_KEYS

    schema = "team_name string, full_name string, location string, date date, average_speed double"
    d1 = dt.date(2024, 1, 1)
    for null_safe, want in ((False, [("None", 1.0), ("None", 2.0), ("2024-01-01", 1.0)]),
                            (True, [("None", 2.0), ("2024-01-01", 1.0)])):
        name = f"nullpart_{uuid.uuid4().hex[:8]}"
        t = spark.createDataFrame([("T", "D", "L", None, 1.0), ("T", "D", "L", d1, 1.0)], schema)
        sinks.upsert(t, name, AVERAGE_SPEED_KEYS, path=f"{workdir}/{name}", null_safe=null_safe)
        s = spark.createDataFrame([("T", "D", "L", None, 2.0)], schema)
        sinks.upsert(s, name, AVERAGE_SPEED_KEYS, null_safe=null_safe)
        got = sorted((str(r.date), r.average_speed) for r in spark.table(name).collect())
        assert got == sorted(want), (null_safe, got)


def test_upsert_duplicate_null_keys_only_matter_when_null_safe(spark, workdir):
    import datetime as dt
    import uuid

    import pytest

    from paddock.plans import sinks
    from paddock.schemas import AVERAGE_SPEED_KEYS

    schema = "team_name string, full_name string, location string, date date, average_speed double"
    rows = [(None, "D", "L", dt.date(2024, 1, 1), 1.0), (None, "D", "L", dt.date(2024, 1, 1), 2.0)]
    sinks.upsert(spark.createDataFrame(rows, schema), f"dn_{uuid.uuid4().hex[:8]}", AVERAGE_SPEED_KEYS,
                 path=f"{workdir}/a")
    with pytest.raises(ValueError):
        sinks.upsert(spark.createDataFrame(rows, schema), f"dn_{uuid.uuid4().hex[:8]}", AVERAGE_SPEED_KEYS,
                     path=f"{workdir}/b", null_safe=True)


def test_broadcast_caps_come_from_session_settings(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(7).withColumnRenamed("id", "k2")
    try:
        spark.conf.set(joins.MAX_ROWS_CONF, "5")
        t = tree(plan(fact.join(joins.dimension(dim), fact.k == dim.k2)))
        assert "BroadcastHashJoin" not in t
        spark.conf.set(joins.MAX_ROWS_CONF, "50")
        spark.conf.set(joins.MAX_BYTES_CONF, "10")  # 7 rows x 8 bytes > 10 bytes
        t = tree(plan(fact.join(joins.dimension(dim), fact.k == dim.k2)))
        assert "BroadcastHashJoin" not in t
    finally:
        spark.conf.unset(joins.MAX_ROWS_CONF)
        spark.conf.unset(joins.MAX_BYTES_CONF)
    assert "BroadcastHashJoin" in tree(plan(fact.join(joins.dimension(dim), fact.k == dim.k2)))


def test_upsert_beyond_the_literal_bound_uses_a_semi_join(spark, workdir, monkeypatch):
    import datetime as dt
    import uuid

    from paddock.plans import sinks
    from paddock.schemas import AVERAGE_SPEED_KEYS

    monkeypatch.setattr(sinks, "MAX_PRUNING_VALUES", 1)
    schema = "team_name string, full_name string, location string, date date, average_speed double"
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    name = f"semi_{uuid.uuid4().hex[:8]}"
    sinks.upsert(spark.createDataFrame([("T", "D", "L", d, 1.0) for d in days], schema), name,
                 AVERAGE_SPEED_KEYS, path=f"{workdir}/{name}")
    src = spark.createDataFrame([("T", "D", "L", days[0], 2.0), ("T", "D", "L", days[1], 3.0),
                                 ("T", "D", "L", dt.date(2024, 1, 9), 4.0)], schema)
    sinks.upsert(src, name, AVERAGE_SPEED_KEYS)
    got = sorted((str(r.date), r.average_speed) for r in spark.table(name).collect())
    assert got == [("2024-01-01", 2.0), ("2024-01-02", 3.0), ("2024-01-03", 1.0),
                   ("2024-01-04", 1.0), ("2024-01-05", 1.0), ("2024-01-09", 4.0)]


def test_streaming_frames_are_never_measured(spark, workdir):
    from paddock.streaming import file_ingest

    stream = file_ingest.car_stream(spark, workdir)
    assert joins.dimension(stream) is stream


def test_table_watermark_reads_the_latest_year_and_survives_an_empty_one(spark, workdir):
    import datetime as dt
    import uuid

    from paddock.plans import sinks

    rows = [(dt.datetime(2023, 5, 1, 10), 2023, "a"), (dt.datetime(2024, 2, 1, 9), 2024, "b"),
            (dt.datetime(2024, 3, 1, 8), 2024, "c")]
    df = spark.createDataFrame(rows, "date timestamp, year int, v string")
    name = f"wm_{uuid.uuid4().hex[:8]}"
    sinks.create_table(df, name, ["year"], path=f"{workdir}/{name}")
    token, n = ingest.table_watermark(spark, name)
    assert n == 3
    assert ingest.token_to_datetime(spark, token, df.schema["date"].dataType) == dt.datetime(2024, 3, 1, 8)
    # The pruned read is what the watermark job runs.
    pruned = spark.table(name).where(F.col("year") == 2024).agg(F.max("date"))
    assert "PartitionFilters: [isnotnull(year" in plan(pruned)

    # A registered but empty later partition must not hide the real maximum.
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (year=2025)")
    assert "2025" in sinks.partition_values(spark, name, "year")
    token, n = ingest.table_watermark(spark, name)
    assert ingest.token_to_datetime(spark, token, df.schema["date"].dataType) == dt.datetime(2024, 3, 1, 8)


def test_data_tests_read_each_model_once(spark):
    p = plan(registry.QUERIES["data_tests_by_column"](spark, SF_SMALL))
    for table, columns in (("orders", 4), ("documents", 2)):
        assert len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*{table}\.parquet", p)) == 1
    # counted in the scan's own tasks before the one shuffle by value; without unique tests no value is shuffled
    assert p.count("Expand") and len(re.findall(r"Exchange\n.*\n?Arguments: hashpartitioning", p)) <= 1


def test_join_accounts_read_the_fact_once(spark):
    p = plan(registry.QUERIES["enrich_accounts"](spark, SF_SMALL))
    assert len(re.findall(r"Location: InMemoryFileIndex \[[^\]]*events\.parquet", p)) == 1


def test_join_accounts_add_up_to_the_join(spark):
    accounts = registry.QUERIES["enrich_accounts"](spark, SF_SMALL).collect()
    kept = registry.QUERIES["enrich_keep_all"](spark, SF_SMALL)
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    for dimension, column in (("drivers", "full_name"), ("sessions", "location")):
        of = [r for r in accounts if r.dimension == dimension]
        assert sum(r.fact_rows for r in of) == total
        assert any(r.joined_rows == 0 for r in of) and any(r.joined_rows > r.fact_rows for r in of)
        # rows that miss one dimension stay, once for each match in the other
        assert (kept.where(F.col(column).isNull()).count() > 0) == any(r.dimension_rows == 0 for r in of)
