"""Properties of the event path on generated events; none needs a second implementation of the rules."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from salespark.operators import validate as V
from salespark.schemas import ENRICH_FIELDS
from tests.helpers import sale, tag_rows
from tests.test_validator import BREAK

RULES = list(BREAK)
numbers = st.integers(1, 10_000)
broken_sets = st.lists(st.sampled_from(RULES), unique=True)
extras = st.dictionaries(st.text("xyz", min_size=1, max_size=3), st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.text(max_size=4)), max_size=3)
many = settings(max_examples=6, deadline=None)


def event(number, rules, extra):
    changes = {}
    for r in rules:
        changes.update(BREAK[r])
    return {**extra, **sale(number, **changes)}


events = st.lists(st.tuples(numbers, broken_sets, extras), min_size=30, max_size=30)


@many
@given(events)
def test_valid_if_and_only_if_no_rule_is_broken(spark, batch):
    rows = tag_rows(spark, [event(*e) for e in batch])
    assert [r["error_reason"] is None for r in rows] == [not rules for _, rules, _ in batch]
    for row in rows:
        assert all((row[k] is not None) == (row["error_reason"] is None) for k in ENRICH_FIELDS)


@many
@given(events)
def test_mending_the_first_broken_rule_moves_on_to_the_next(spark, batch):
    chains = [(n, sorted(rules, key=RULES.index), extra) for n, rules, extra in batch]
    flat = [(n, rules[k:], extra) for n, rules, extra in chains for k in range(len(rules) + 1)]
    rows = iter(tag_rows(spark, [event(*e) for e in flat]))
    for _, rules, _ in chains:
        assert [next(rows)["error_reason"] for _ in range(len(rules) + 1)] == [*rules, None]


@many
@given(events)
def test_unknown_keys_change_nothing_but_the_record(spark, batch):
    with_keys = tag_rows(spark, [event(*e) for e in batch])
    without = tag_rows(spark, [event(n, rules, {}) for n, rules, _ in batch])
    for (_, _, extra), a, b in zip(batch, with_keys, without):
        record, plain = json.loads(a.pop("value")), json.loads(b.pop("value"))
        assert a == b
        kept = {} if a["error_reason"] == V.MISSING_FIELD else extra
        assert record == {**kept, **plain}


@many
@given(events)
def test_order_of_keys_does_not_matter(spark, batch):
    texts = [json.dumps(event(*e)) for e in batch]
    turned = [json.dumps(dict(reversed(event(*e).items()))) for e in batch]
    a, b = tag_rows(spark, texts), tag_rows(spark, turned)
    for x, y in zip(a, b):
        assert json.loads(x.pop("value")) == json.loads(y.pop("value")) and x == y
