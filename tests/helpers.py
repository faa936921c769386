"""Test events, made from the event schema."""

import json

from pyspark.sql import types as T

from salespark.schemas import RAW_EVENT, TOPIC_MESSAGE

CLOCK = "2024-02-29 23:59:58"  # a Thursday


def sale(number: int = 1, drop: tuple = (), **changes) -> dict:
    """A valid event of its own for each ``number``, with values that follow from the fields' types."""
    event = {}
    for k, field in enumerate(RAW_EVENT.fields):
        if isinstance(field.dataType, T.DecimalType):
            event[field.name] = 10.25 * (number + k)
        elif isinstance(field.dataType, T.IntegerType):
            event[field.name] = number + k
        else:
            event[field.name] = f"{field.name}/{number}"
    event["event_timestamp"] = CLOCK
    return {k: v for k, v in {**event, **changes}.items() if k not in drop}


def messages(spark, payloads):
    """JSON texts (dicts are serialised) -> topic messages, in order of arrival."""
    rows = [(p if isinstance(p, str) or p is None else json.dumps(p), None, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, TOPIC_MESSAGE)


def tag_rows(spark, payloads):
    from salespark.operators.validate import tag_events
    return [r.asDict() for r in tag_events(messages(spark, payloads)).drop("_v").orderBy("ingest_key").collect()]
