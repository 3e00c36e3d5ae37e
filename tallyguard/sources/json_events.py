"""JSON text of a topic to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.contracts import TOPIC_SCHEMAS

CORRUPT = "_corrupt"
# Whether the text is JSON and every field has a value that fits its type.
WHOLE = "_whole"
# All whole digits that an amount in range has, and twenty digits behind the point, so that only the
# cast to cents rounds.
EXACT_MONEY = T.DecimalType(38, 20)
# Wide enough to tell an amount that is out of range from one that is no number.
WIDE_MONEY = T.DecimalType(38, 10)


def _read_type(dtype: T.DataType, amount: T.DecimalType) -> T.DataType:
    """Amounts are read as ``amount``; integers as text, since producers may quote them."""
    return amount if isinstance(dtype, T.DecimalType) else T.StringType()


def _fit(f: T.StructField, read: Column) -> Column:
    return read if isinstance(f.dataType, T.StringType) else read.try_cast(f.dataType)


def _parsed(topic: str, amount: T.DecimalType = EXACT_MONEY) -> Column:
    schema = T.StructType([T.StructField(f.name, _read_type(f.dataType, amount)) for f in TOPIC_SCHEMAS[topic].fields])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(F.col("value"), schema.add(CORRUPT, T.StringType()), options)


def parse_topic(raw: DataFrame, topic: str) -> DataFrame:
    """Parse the ``value`` text of ``raw`` with the topic's schema.

    Besides the topic's columns the result carries ``value``, the corrupt text (null
    when the JSON fits) and whether the record is whole. Both steps are generators, so
    filters on their columns do not repeat them.
    """
    fields = TOPIC_SCHEMAS[topic].fields
    read = raw.select("value", F.explode(F.array(_parsed(topic))).alias("_read"))
    corrupt = F.col("_read")[CORRUPT]
    typed = {f.name: _fit(f, F.col("_read")[f.name]) for f in fields}
    whole = corrupt.isNull()
    for column in typed.values():
        whole = whole & column.isNotNull()
    columns = [column.alias(name) for name, column in typed.items()]
    row = F.struct(*columns, corrupt.alias(CORRUPT), whole.alias(WHOLE))
    return read.select("value", F.inline(F.array(row)))


def form_breaches(topic: str) -> Column:
    """Names of what keeps the ``value`` text from being a whole record of the topic.

    The text is parsed again, with wider amounts, and the object's keys tell a missing field from a null
    one; so this belongs behind a test for records that are not whole. As a lambda's
    body it is evaluated only there and stays out of the generated code.
    """
    fields = TOPIC_SCHEMAS[topic].fields
    again = F.struct(_parsed(topic, WIDE_MONEY).alias("read"), F.json_object_keys("value").alias("keys"))

    def breaches(record: Column) -> Column:
        read, keys = record["read"], record["keys"]
        formed = read[CORRUPT].isNull() & keys.isNotNull()
        missing = [F.when(~F.array_contains(keys, f.name), F.lit(f"missing:{f.name}")) for f in fields]
        null = [
            F.when(F.array_contains(keys, f.name) & read[f.name].isNull(), F.lit(f"null:{f.name}")) for f in fields
        ]
        misfit = [
            F.when(
                read[f.name].isNotNull() & _fit(f, read[f.name]).isNull(),
                F.lit(f"{'range' if isinstance(f.dataType, T.DecimalType) else 'type'}:{f.name}"),
            )
            for f in fields
            if not isinstance(f.dataType, T.StringType)
        ]
        found = F.array_compact(F.array(*missing, *null, *misfit))
        return F.when(formed, found).otherwise(F.array(F.lit("malformed_json")))

    return F.get(F.transform(F.array(again), breaches), F.lit(0))
