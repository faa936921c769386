"""Dimensions, catalog source, constraints, FK checks and stream checks."""

import json
from datetime import date

from pyspark.sql import functions as F

from salespark.functions import money as M
from salespark.operators import facts as FA
from salespark.operators import quality as Q
from salespark.operators.validate import tag_events, valid_events
from salespark.session import work_dir
from salespark.sources import dims as D
from tests.helpers import messages, sale


def test_dim_user(spark):
    u = D.dim_user(spark)
    counts = {r.segment: r["count"] for r in u.groupBy("segment").count().collect()}
    assert u.count() == 100 and counts == {"new": 25, "regular": 50, "vip": 25}
    assert u.filter("user_id = 'U-0002'").first().segment == "vip"


def test_dim_product(spark):
    p = D.dim_product(spark)
    assert p.count() == 24
    assert {r.category for r in p.select("category").distinct().collect()} == set(D.CATEGORIES)


def test_dim_date_seed(spark):
    d = D.dim_date(spark).orderBy("date_id").collect()
    assert len(d) == 730 and d[0].date_id == date(2025, 1, 1) and d[-1].date_id == date(2026, 12, 31)
    first = d[0]  # 2025-01-01 was a Wednesday
    assert first.month_name == "January  " and first.day_name == "Wednesday"
    assert first.day_of_week == 3 and first.is_weekend is False and first.quarter == 1
    sunday = [r for r in d if r.date_id == date(2025, 1, 5)][0]
    assert sunday.day_of_week == 0 and sunday.is_weekend is True and sunday.day_name == "Sunday   "


def test_catalog_json(spark, tmp_path):
    path = tmp_path / "products.json"
    path.write_text(json.dumps(D.catalog_rows(), ensure_ascii=False))
    cat = D.read_catalog(spark, str(path))
    rows = cat.collect()
    assert len(rows) == 24 and rows[0].product_id == 101 and rows[0].base_price == 1999.99
    as_dim = D.catalog_as_dim(cat)
    assert as_dim.exceptAll(D.dim_product(spark)).count() == 0 and as_dim.count() == 24


def test_sequence_source(spark):
    assert [r.id for r in D.sequence_source(spark).collect()] == [1, 2, 3, 4, 5]


def _facts_from(spark, events):
    return FA.fact_rows(valid_events(tag_events(messages(spark, events))))


def test_fk_split_reports_orphans(spark):
    known = {"user_id": "U-0042", "product_id": 203, "event_timestamp": "2025-05-05T05:05:05"}
    wrong = {"user_id": "someone", "product_id": 777, "event_timestamp": "2031-05-05"}
    sets = [(), ("user_id",), ("product_id",), ("event_timestamp",), tuple(wrong)]
    rows = _facts_from(spark, [sale(i, **{**known, **{k: wrong[k] for k in s}}) for i, s in enumerate(sets)])
    ok, orphans = Q.fk_split(rows, D.dim_user(spark), D.dim_product(spark), D.dim_date(spark))
    assert [r.ingest_key for r in ok.collect()] == [0]
    got = {r.ingest_key: r.missing_keys for r in orphans.collect()}
    assert got == {i: [k.replace("event_timestamp", "date_id") for k in s] for i, s in enumerate(sets) if s}


def test_check_fact_band_sets(spark):
    rows = _facts_from(spark, [sale(total_amount=M.BAND_LOW_BELOW), sale(total_amount=1)])
    counts = {r.rule: r.failures for r in Q.rule_counts(rows, Q.fact_rules()).collect()}
    assert counts["value_band_in_schema"] == 1 and counts["value_band_known"] == 0


def test_first_wins_hot_key(spark):
    """One sale id holding most rows: the earliest arrival is kept."""
    events = [sale(i, sale_id="HOT") for i in range(300)] + [sale(i) for i in range(50)]
    rows = FA.by_contract(_facts_from(spark, events))[0]
    out = FA.first_wins(rows.repartition(8))
    hot = out.filter("sale_id = 'HOT'").collect()
    assert out.count() == 51 and len(hot) == 1 and hot[0].ingest_key == 0


def test_event_quality(spark):
    events = [sale(), sale(quantity=0), sale(extra=1), sale(event_timestamp="29.02.2024"), sale(quantity=-1)]
    q = Q.event_quality(messages(spark, events)).first()
    assert q.events == 5 and q.unknown_key_events == 1 and q.bad_ts_events == 1
    assert q.negative_qty_events == 1 and q.anomaly_events == 1
    assert q.min_bytes <= q.avg_bytes <= q.max_bytes


def test_checkpoint_folder_from_session(spark):
    path = work_dir(spark, "probe")
    root = spark.sparkContext.getCheckpointDir()
    assert root and path.startswith(root.rstrip("/"))


def test_partition_spread(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (2, "d")], "partition int, value string")
    got = {r.partition: r.events for r in Q.partition_spread(df).collect()}
    assert got == {0: 1, 1: 2, 2: 1} and len(got) >= 2


def test_create_table_if_not_exists(spark):
    from salespark.schemas import ANOMALY_ALERTS
    from salespark.streaming.sinks import create_table_if_not_exists
    path = work_dir(spark, "table_init")
    assert create_table_if_not_exists(spark, path, ANOMALY_ALERTS) is True
    assert create_table_if_not_exists(spark, path, ANOMALY_ALERTS) is False
    t = spark.read.parquet(path)
    assert t.count() == 0 and t.columns == [f.name for f in ANOMALY_ALERTS.fields]


def test_strict_parse_fails_on_bad_json(spark):
    import pytest as _pytest
    from salespark.functions import json as J
    df = spark.createDataFrame([("{bad",)], "value string")
    assert df.select(J.parse("value").isNull().alias("n")).first().n is True
    with _pytest.raises(Exception):
        df.select(J.parse("value", strict=True).alias("v")).collect()


def test_cluster_conf_shapes():
    from salespark.session import cluster_conf
    conf = cluster_conf(4000)
    assert conf["spark.sql.shuffle.partitions"] == "16000"
    assert "RocksDB" in conf["spark.sql.streaming.stateStore.providerClass"]


def test_empty_guard_on_no_rows(spark):
    from salespark.operators.windows import empty_guarded
    empty = spark.createDataFrame([], "total_value decimal(22,2)")
    row = empty_guarded(empty).first()
    assert row.sale_count == 0 and float(row.total_revenue) == 0 and float(row.avg_order_value) == 0


def test_kept_plus_skipped_is_every_fact_row(spark, sf_small):
    from salespark.plans.queries import QUERIES, valid
    rows = FA.by_contract(FA.fact_rows(valid(spark, sf_small)))[0].count()
    kept = QUERIES["pk_first_wins"].run(spark, sf_small).count()
    skipped = QUERIES["conflict_anti"].run(spark, sf_small).count()
    assert kept + skipped == rows


def test_hot_window(spark):
    """A third of the events in one 30 s window: partial aggregation per task."""
    from salespark.operators.windows import window_stats
    hot = [sale(i, total_amount=10.0, event_timestamp="2026-07-09T10:00:05") for i in range(100)]
    cold = [sale(i, total_amount=20.0, event_timestamp=f"2026-07-09T{11 + i // 60:02d}:{i % 60:02d}:00") for i in range(200)]
    valid_df = valid_events(tag_events(messages(spark, hot + cold))).repartition(8)
    stats = window_stats(valid_df, "event_ts")
    w = stats.filter("window_start = timestamp_ntz'2026-07-09 10:00:00'").first()
    assert w.sale_count == 100 and float(w.total_revenue) == 1000.0 and float(w.avg_order_value) == 10.0
    assert stats.agg(F.sum("sale_count")).first()[0] == 3 * 300


def test_windows_count_totals_that_do_not_fit_the_fact_table(spark):
    from salespark.operators.windows import merged, window_stats
    events = [sale(i, total_amount=t) for i, t in enumerate((12_345_678_901.5, 1, 2.5))]
    stats = window_stats(valid_events(tag_events(messages(spark, events))), "event_ts")
    assert {(r.sale_count, float(r.total_revenue)) for r in stats.collect()} == {(3, 12_345_678_905.0)}
    twice = merged(stats.union(stats)).collect()
    assert {(r.sale_count, float(r.total_revenue), float(r.avg_order_value)) for r in twice} == {(6, 24_691_357_810.0, 4_115_226_301.67)}
