"""The validation rules through the real path (JSON text -> VARIANT -> rule CASE -> enrichment / outgoing record).

Cases follow from the rules: a value below, at and above each threshold; each rule broken alone; each pair of rules
broken together, where the earlier one names the event."""

import itertools
import json
from datetime import date, timedelta

import pytest

from salespark.functions import money as M
from salespark.functions.time import DAY_NAMES
from salespark.operators import facts as FA
from salespark.operators import validate as V
from salespark.schemas import ENRICH_FIELDS, ID_FIELDS, RAW_FIELDS
from tests.helpers import messages, sale, tag_rows

# How to break each rule, in the order of the rules.
BREAK = {
    V.MISSING_FIELD: {"drop": ("user_id",)},
    V.QUANTITY_ZERO: {"quantity": -7},
    V.NEGATIVE_PRICE: {"unit_price": -0.5},
    V.CORRUPTED_TIMESTAMP: {"event_timestamp": "29.02.2024"},
}


def broken(*rules):
    changes = {}
    for r in rules:
        changes.update(BREAK[r])
    return sale(**changes)


def reasons(spark, events):
    return [r["error_reason"] for r in tag_rows(spark, events)]


def test_each_rule_alone_and_each_pair(spark):
    sets = [(r,) for r in BREAK] + list(itertools.combinations(BREAK, 2)) + [tuple(BREAK)]
    assert reasons(spark, [broken(*s) for s in sets]) == [s[0] for s in sets]
    assert reasons(spark, [sale()]) == [None]


def test_any_missing_id_counts(spark):
    sets = [s for n in (1, 2, 3) for s in itertools.combinations(ID_FIELDS, n)]
    rows = tag_rows(spark, [sale(drop=s) for s in sets])
    for s, row in zip(sets, rows):
        out = json.loads(row["value"])
        assert row["error_reason"] == V.MISSING_FIELD
        assert {k for k in ID_FIELDS if out[k] == V.NA} == set(s)
        assert set(out) == {*RAW_FIELDS, "error_reason"}


def test_bands_around_their_thresholds(spark):
    # The thresholds, a cent below, at and a cent above.
    steps = [(t + d / 100, "low" if t + d / 100 < M.BAND_LOW_BELOW else "medium" if t + d / 100 < M.BAND_MEDIUM_BELOW else "high")
             for t in (0, M.BAND_LOW_BELOW, M.BAND_MEDIUM_BELOW) for d in (-1, 0, 1)]
    rows = tag_rows(spark, [sale(total_amount=t) for t, _ in steps] + [sale(drop=("total_amount",))])
    assert [r["value_band"] for r in rows] == [b for _, b in steps] + ["low"]


@pytest.mark.parametrize("field,reason", [("quantity", V.QUANTITY_ZERO), ("unit_price", V.NEGATIVE_PRICE)])
def test_numbers_must_be_over_zero(spark, field, reason):
    rows = reasons(spark, [sale(**{field: x}) for x in (-1, 0, 1)] + [sale(drop=(field,))])
    assert rows == [reason, reason, None, reason]


def test_timestamps(spark):
    texts = ["2024-02-29T23:59:58Z", "20240229", "2024-W09-4", "", " ", "soon", "2023-02-29", None, 20240229]
    rows = reasons(spark, [sale(event_timestamp=t) for t in texts] + [sale(drop=("event_timestamp",))])
    assert rows == [None] * 3 + [V.CORRUPTED_TIMESTAMP] * 7


def test_weekdays_and_clock(spark):
    first = date(2024, 1, 7)  # a Sunday
    days = [first + timedelta(i) for i in range(7)]
    rows = tag_rows(spark, [sale(event_timestamp=f"{d}T0{i}:1{i}:00") for i, d in enumerate(days)])
    assert [r["day_of_week"] for r in rows] == list(DAY_NAMES)
    assert [(r["date_id"], r["sale_hour"], r["sale_minute"]) for r in rows] == [(str(d), i, 10 + i) for i, d in enumerate(days)]


def test_offset_is_kept_on_the_clock_and_applied_to_the_instant(spark):
    row = tag_rows(spark, [sale(event_timestamp="2024-03-01T01:30:00+02:00")])[0]
    assert (row["date_id"], row["sale_hour"], row["day_of_week"]) == ("2024-03-01", 1, "Friday")
    assert str(row["event_ts"]) == "2024-03-01 01:30:00" and str(row["event_instant"]) == "2024-02-29 23:30:00"


NOT_NUMBERS = [None, "4", True, [1], {"n": 1}]


def test_what_would_crash_the_original_is_a_dead_letter(spark):
    texts = ["{oops", "", "[]", "3", '"text"', "null"]
    values = [sale(**{k: x}) for k in ("quantity", "unit_price", "total_amount") for x in NOT_NUMBERS]
    rows = tag_rows(spark, [*texts, *values])
    assert all(r["error_reason"] == V.MALFORMED for r in rows)
    for text, row in zip([*texts, *(json.dumps(v) for v in values)], rows):
        assert json.loads(row["value"]) == {"raw": text, "error_reason": V.MALFORMED}


def test_valid_record_is_the_event_with_enrichment(spark):
    event = sale(3, shop={"city": "Ulm"}, note=None)
    out = json.loads(tag_rows(spark, [event])[0]["value"])
    assert {k: out[k] for k in event} == event and set(out) == {*event, *ENRICH_FIELDS}


def test_invalid_record_is_the_event_with_the_reason(spark):
    event = sale(4, quantity=0, note="kept")
    assert json.loads(tag_rows(spark, [event])[0]["value"]) == {**event, "error_reason": V.QUANTITY_ZERO}


def test_record_of_an_empty_event_holds_only_defaults(spark):
    row = tag_rows(spark, [{"note": 1}])[0]
    numbers = {"quantity", "unit_price", "total_amount"}
    assert json.loads(row["value"]) == {**{k: 0 if k in numbers else V.NA for k in RAW_FIELDS}, "error_reason": V.MISSING_FIELD}


def test_key_with_null_is_present(spark):
    row = tag_rows(spark, [sale(sale_id=None)])[0]
    assert row["error_reason"] is None and row["sale_id"] is None


def test_repeated_key_counts_with_its_last_value(spark):
    text = json.dumps(sale(5))[:-1] + ', "quantity": 0}'
    assert reasons(spark, [text]) == [V.QUANTITY_ZERO]


# What doesn't fit a column of the fact table, and the rules it breaks there.
UNFIT = [
    (sale(1, quantity=2.5), ["quantity_not_null"]), (sale(2, quantity=0.5), ["quantity_not_null"]),
    (sale(3, total_amount=10 ** 10 + 0.5), ["total_amount_not_null"]), (sale(4, product_id="ABC"), ["product_id_not_null"]),
    (sale(5, product_id=7.5), ["product_id_not_null"]), (sale(6, user_id=None, sale_id=None), ["sale_id_not_null", "user_id_not_null"]),
    (sale(7, drop=("total_amount",)), ["total_amount_not_null"]), (sale(8, quantity=2.0), []), (sale(9), []),
]


def test_valid_sales_that_do_not_fit_are_rejected_with_their_rules(spark):
    valid = V.valid_events(V.tag_events(messages(spark, [e for e, _ in UNFIT])))
    assert valid.count() == len(UNFIT)
    ok, bad = FA.by_contract(FA.fact_rows(valid))
    assert {r.ingest_key: r.violations for r in bad.collect()} == {i: v for i, (_, v) in enumerate(UNFIT) if v}
    assert [r.ingest_key for r in ok.orderBy("ingest_key").collect()] == [i for i, (_, v) in enumerate(UNFIT) if not v]
    assert ok.filter("ingest_key = 7").first().quantity == 2


def test_wide_stages_are_compiled_in_any_session(spark, sf_small):
    """A session without the project's settings runs the jobs' stages as code that the JVM compiles."""
    from salespark.session import work_dir
    from salespark.sources.fixture import raw_messages
    from salespark.streaming import topics as T
    key = "spark.sql.codegen.hugeMethodLimit"
    topic = T.file_topic(T.RAW_TOPIC, work_dir(spark, "test_compiled"))
    before = spark.conf.get(key)
    try:
        for use in (lambda: V.tag_events(messages(spark, [sale()])), lambda: raw_messages(spark, sf_small), lambda: T.read_stream(spark, topic)):
            spark.conf.unset(key)
            use()
            assert spark.conf.get(key) == "8000"
    finally:
        spark.conf.set(key, before)
