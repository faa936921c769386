"""SQL-dialect behaviour and alert defaults on literal events."""

from salespark.operators import validate as V
from tests.helpers import CLOCK, messages, sale


def _typed(spark, events):
    return V.parse_typed(messages(spark, events))


def test_sql_reason_order_and_dropped_rows(spark):
    events = [
        sale(sale_id="A"),                                          # fact
        sale(sale_id="B", quantity=0, drop=("user_id",)),           # quantity comes first
        sale(sale_id="C", quantity=None),                           # NULL: in neither branch
        sale(sale_id="D", event_timestamp=CLOCK.replace(" ", "T")),  # the pattern has no 'T'
        sale(sale_id="E", drop=("product_id",)),
    ]
    t = _typed(spark, events)
    facts = [r.sale_id for r in V.sql_facts(t).collect()]
    invalid = {r.sale_id: r.error_reason for r in V.sql_invalid(t).collect()}
    dropped = [r.sale_id for r in V.sql_dropped(t).collect()]
    assert facts == ["A"]
    assert invalid == {"B": "quantity_zero", "D": "corrupted_timestamp", "E": "missing_field"}
    assert dropped == ["C"]


def test_sql_null_total_is_high(spark):
    t = _typed(spark, [sale(drop=("total_amount",))])
    assert V.sql_facts(t).first().value_band == "high"


def test_sql_fact_columns(spark):
    row = V.sql_facts(_typed(spark, [sale()])).first()
    assert str(row.date_id) == "2024-02-29" and row.sale_hour == 23 and row.sale_minute == 59
    assert row.day_of_week == "Thursday"


def _alerts(spark, events, coded=True):
    tagged = V.tag_events(messages(spark, events))
    inv = V.invalid_events(tagged)
    out = V.coded_alerts(inv) if coded else V.basic_alerts(inv)
    return {r.id: r for r in out.collect()}


def test_coded_alerts_defaults(spark):
    events = [
        sale(drop=("sale_id",)),              # 0: N/A id, code 1
        sale(unit_price=-5.0),                # 1: code 2
        sale(quantity=0),                     # 2: code 3
        sale(drop=("event_timestamp",)),      # 3: absent -> N/A
        sale(event_timestamp=None),           # 4: null -> NULL
        "{broken",                            # 5: malformed: no code
        sale(),                               # 6: valid: no alert
    ]
    got = _alerts(spark, events)
    assert set(got) == {0, 1, 2, 3, 4}
    assert got[0].sale_id == "N/A" and got[0].anomaly_code == 1 and got[0].anomaly_type == "missing_field"
    assert got[1].anomaly_code == 2 and got[2].anomaly_code == 3
    assert got[3].anomaly_code == 4 and got[3].event_timestamp == "N/A"
    assert got[4].anomaly_code == 4 and got[4].event_timestamp is None


def test_basic_alerts_keep_every_insale(spark):
    got = _alerts(spark, [sale(quantity=0), "{broken"], coded=False)
    assert {r.anomaly_type for r in got.values()} == {"quantity_zero", "malformed"}


def test_code_lookup_map(spark):
    df = spark.createDataFrame([("missing_field",), ("corrupted_timestamp",), ("other",)], "r string")
    got = [r.c for r in df.select(V.code_of("r").alias("c")).collect()]
    assert got == [1, 4, None]
