"""Contract checks: every record is either a valid event or a quarantined text with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.contracts import (
    EVENT_SCHEMA,
    EVENT_TYPES,
    PAYLOAD_TIME,
    PAYMENT_TOPIC,
    STATUS_OF_TYPE,
    TOPIC_EVENT_TYPES,
    TOPIC_SCHEMAS,
)
from tallyguard.functions.times import parse_millis
from tallyguard.sources.json_events import CORRUPT, WHOLE, form_breaches, parse_topic

REASONS = "reasons"
INVALID_EVENTS = "invalid_time_or_contract_events"
# Breaches of the JSON form stop a strict job; the other reasons only drop the record.
FORM_REASONS = ("malformed_json", "missing:", "type:")


def business_rules(topic: str) -> dict[str, Column]:
    """Rules about values; null where an input is null, since the null has its own reason."""
    event_type, event_ms = F.col("event_type"), F.col("event_time_ms")
    # A valid time text is in the business zone, so its date digits are the business date.
    date_digits = F.translate(F.substring("event_time", 1, 10), "-", "")
    in_time = F.when(F.col("event_time").isNotNull(), event_ms.isNotNull())
    timed = event_ms.isNotNull() & F.col(PAYLOAD_TIME[topic]).isNotNull()
    rules = {
        "event_type": event_type.isin(*TOPIC_EVENT_TYPES[topic]),
        "event_time": in_time,
        "business_date": F.when(event_ms.isNotNull(), date_digits == F.col("business_date")),
        "payload_time": F.when(timed, F.col("payload_time_ms").eqNullSafe(event_ms)),
    }
    if topic == PAYMENT_TOPIC:
        expected = F.create_map(*[F.lit(text) for pair in STATUS_OF_TYPE.items() for text in pair])
        rules["payment_status"] = F.try_element_at(expected, event_type) == F.col("payment_status")
    return rules


def optional_rules(topic: str) -> dict[str, Column]:
    """Checks the written contract names but the default ones leave out: signs of numbers."""
    rules = {}
    for name, dtype in ((f.name, f.dataType) for f in TOPIC_SCHEMAS[topic].fields):
        if isinstance(dtype, T.DecimalType):
            rules[f"negative:{name}"] = F.coalesce(F.col(name) >= 0, F.lit(True))
        elif name == "sku_num":
            rules["sku_num"] = F.coalesce(F.col(name) > 0, F.lit(True))
    return rules


def with_reasons(raw: DataFrame, topic: str, extra: bool = False) -> DataFrame:
    """Parsed columns of ``raw`` plus the array of broken rules' names."""
    event_time, payload_time = F.col("event_time"), F.col(PAYLOAD_TIME[topic])
    event_ms = F.explode(F.array(parse_millis(event_time))).alias("event_time_ms")
    parsed = parse_topic(raw, topic).select("*", event_ms)
    payload_ms = F.when(payload_time == event_time, F.col("event_time_ms")).otherwise(parse_millis(payload_time))
    timed = parsed.select("*", F.explode(F.array(payload_ms)).alias("payload_time_ms"))

    rules = business_rules(topic) | (optional_rules(topic) if extra else {})
    rules = {name: F.coalesce(ok, F.lit(True)) for name, ok in rules.items()}
    sound = F.col(WHOLE)
    for ok in rules.values():
        sound = sound & ok
    of_form = F.when(F.col(WHOLE), F.array().cast("array<string>")).otherwise(form_breaches(topic))
    of_values = F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()])
    of_values = F.when(F.col(CORRUPT).isNull(), F.array_compact(of_values)).otherwise(F.array())
    reasons = F.when(sound, F.array().cast("array<string>")).otherwise(F.concat(of_form, of_values))
    # As generator outputs, times and reasons are computed once; a plain column would
    # be copied into every later filter that reads it.
    return timed.select("*", F.explode(F.array(reasons)).alias(REASONS))


def _as_events(checked: DataFrame, topic: str) -> DataFrame:
    available = set(TOPIC_SCHEMAS[topic].names)
    time_column = PAYLOAD_TIME[topic] + "_ms"
    columns = []
    for f in EVENT_SCHEMA.fields:
        if f.name == "event_time_ms":
            source = F.col("event_time_ms")
        elif f.name == time_column:
            source = F.col("payload_time_ms")
        else:
            source = F.col(f.name) if f.name in available else F.lit(None)
        columns.append(source.cast(f.dataType).alias(f.name))
    return checked.select(*columns)


def _ill_formed() -> Column:
    def of_form(reason: Column) -> Column:
        first, *others = [reason.startswith(name) for name in FORM_REASONS]
        for other in others:
            first = first | other
        return first

    return F.exists(REASONS, of_form)


def unchecked_events(raw: DataFrame, topic: str) -> DataFrame:
    """Events that meet the contract, without a stop or a count for the others: for a second reading."""
    return _as_events(with_reasons(raw, topic).filter(F.size(REASONS) == 0), topic)


def valid_events(raw: DataFrame, topic: str, strict: bool = True, extra: bool = False) -> DataFrame:
    """Events that meet the contract, in the one wide form.

    ``strict`` stops the job on text that is not JSON of the topic's form;
    otherwise such text is dropped like any other invalid record. Dropped records are
    counted in the observed metric ``invalid_time_or_contract_events``.
    """
    checked = with_reasons(raw, topic, extra)
    if strict:
        message = F.concat(F.lit(f"{topic}: "), F.array_join(REASONS, ","), F.lit(" in "), F.col("value"))
        stop = F.when(_ill_formed(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        checked = checked.filter(stop)
    invalid = F.count_if(F.size(REASONS) > 0).alias(INVALID_EVENTS)
    observed = checked.observe(f"{topic}_checks", invalid)
    return _as_events(observed.filter(F.size(REASONS) == 0), topic)


def quarantined(raw: DataFrame, topic: str, extra: bool = False) -> DataFrame:
    """The texts that break the contract, with the names of the broken rules."""
    bad = with_reasons(raw, topic, extra).filter(F.size(REASONS) > 0)
    return bad.select(F.lit(topic).alias("topic"), "value", REASONS)


def known_event_type() -> Column:
    """True, or a stop of the job at an event type no rule handles."""
    event_type = F.col("event_type")
    message = F.concat(F.lit("unsupported event type: "), F.coalesce(event_type, F.lit("null")))
    return F.when(event_type.isin(*EVENT_TYPES), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def union_events(*events: DataFrame) -> DataFrame:
    first, *rest = events
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
