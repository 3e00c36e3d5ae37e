"""The order rules on streams: facts, then the state of orders with event-time timers, both in slices."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.config import OrderParams
from tallyguard.contracts import MONEY
from tallyguard.operators.order_rules import order_alerts, order_facts
from tallyguard.streaming.facts import DETAIL, ORDER, PAYMENT, OrderFact
from tallyguard.streaming.intake import Input, distinct_facts, distinct_pieces, with_late_count
from tallyguard.streaming.slices import (
    DEALT_SCHEMA,
    PIECE_SCHEMA,
    SLICES,
    SliceState,
    dealer,
    numbers,
    pieces,
    starts_of,
    unpack,
)

CHANGES = T.StructType(
    [T.StructField("order_id", T.LongType()), T.StructField("change", T.StringType())]
    + [T.StructField("fact_id", T.LongType()), T.StructField("amount", MONEY)]
    + [T.StructField(n, T.LongType()) for n in ("number", "time_ms", "user_id", "shop_id", "event_time_ms")]
)
FACT_COLUMNS = ["fact_id", "event_time_ms", "event_id", "success", "amount", "time_ms", "user_id", "shop_id"]
SNAPSHOT_SCHEMA = (
    "order_id bigint, user_id bigint, shop_id bigint, order_amount decimal(20,2), create_ms bigint, "
    "detail_amount decimal(20,2), detail_count int, payment_id bigint, payment_ms bigint, "
    "payment_amount decimal(20,2)"
)


def merged_details(table: pa.Table) -> pa.Table:
    """Line changes added up per order; other changes stay."""
    is_detail = pc.equal(table["change"], "detail")
    lines = table.filter(is_detail)
    if not lines.num_rows:
        return table
    sums = lines.group_by(["order_id", "change"], use_threads=False).aggregate(
        [("amount", "sum"), ("number", "sum"), ("event_time_ms", "max")]
    )
    found = {"amount": "amount_sum", "number": "number_sum", "event_time_ms": "event_time_ms_max"}
    columns = [
        sums[found.get(f.name, f.name)].cast(f.type)
        if found.get(f.name, f.name) in sums.column_names
        else pa.nulls(sums.num_rows, f.type)
        for f in table.schema
    ]
    summed = pa.Table.from_arrays(columns, schema=table.schema)
    return pa.concat_tables([table.filter(pc.invert(is_detail)), summed])


def merge_details(batches):
    """Line changes of an Arrow batch added up per order; other changes pass."""
    for batch in batches:
        yield from merged_details(pa.Table.from_batches([batch])).to_batches()


class OrderJudge(SliceState):
    """Order, line totals and successful payments of each order of a slice; each order is judged once.

    The state has the form of the changes: an order's lines in one row, its order and its
    successes, and a mark (``seen`` or ``judged``) with the newest event time. The first
    success whose wait is over is judged with what has arrived by then. The data is
    released afterwards; the mark that the order was judged stays until the
    state expires, so a second success raises nothing.
    """

    # Changes by what they overwrite: a success and its revocation are about the same payment.
    groups = {"detail": 0, "order": 1, "success": 2, "revoked": 2, "seen": 3, "judged": 3}

    def __init__(self, params: OrderParams, allowance_ms: int):
        self.params = params
        self.allowance_ms = allowance_ms

    def _judge_timer(self, payment_ms):
        return payment_ms + self.params.wait_ms - self.allowance_ms

    def _expiry(self, newest_ms):
        # Never before the judgement of the newest payment.
        return newest_ms + max(self.params.ttl_ms, self.params.wait_ms + 1) - self.allowance_ms

    def _is(self, table: pa.Table, change: str) -> np.ndarray:
        return pc.equal(table["change"], change).to_numpy().astype(bool)

    def _group(self, table: pa.Table) -> np.ndarray:
        index = pc.index_in(table["change"], pa.array(list(self.groups))).to_numpy()
        return np.array(list(self.groups.values()))[index]

    def _marks(self, table: pa.Table, orders, newest, judged) -> pa.Table:
        change = pa.DictionaryArray.from_arrays(pa.array(judged.astype(np.int8)), ["seen", "judged"])
        known = {"order_id": pa.array(orders), "change": change.dictionary_decode(), "event_time_ms": pa.array(newest)}
        columns = [known.get(f.name, pa.nulls(len(orders), f.type)) for f in table.schema]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, table.schema)], schema=table.schema)

    def _merged(self, table: pa.Table) -> pa.Table:
        """The state's form of all changes. Of one fact's changes the last by event time counts."""
        table = merged_details(table).combine_chunks()
        group = self._group(table)
        order_id, fact_id, at = (numbers(table, name) for name in ("order_id", "fact_id", "event_time_ms"))
        order = np.lexsort((at, fact_id, group, order_id))
        order_id, group, fact_id, at = order_id[order], group[order], fact_id[order], at[order]
        orders = starts_of(order_id)
        sizes = np.diff(np.append(orders, len(at)))
        newest = np.maximum.reduceat(at, orders)
        judged = np.logical_or.reduceat(self._is(table, "judged")[order], orders)
        last = np.append(starts_of(order_id, group, fact_id)[1:], len(at)) - 1
        last = last[(group[last] != 3) & ~np.repeat(judged, sizes)[last]]
        facts = table.take(pa.array(order[last]))
        facts = facts.filter(pa.array(~self._is(facts, "revoked")))
        return pa.concat_tables([facts, self._marks(table, order_id[orders], newest, judged)]).combine_chunks()

    def _keep(self, table: pa.Table, pending: int | None) -> None:
        due = None
        if table.num_rows:
            marks = numbers(table, "event_time_ms")[self._group(table) == 3]
            due = self._expiry(marks.min())
            waiting = numbers(table, "time_ms")[self._is(table, "success")]
            if len(waiting):
                due = min(due, self._judge_timer(waiting.min()))
        self.keep(table, pending, due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pending, old = self.load()
        new = self.arrived(rows)
        self._keep(self._merged(new if old is None else pa.concat_tables([old, new])), pending)
        return iter(())

    def _snapshots(self, table: pa.Table, due: np.ndarray) -> pa.Table:
        """The orders of the payments in the rows ``due``, ascending by order."""
        orders = numbers(table, "order_id")
        wanted = orders[due]
        payment = table.take(pa.array(due))

        def others(change: str) -> pa.Table:
            at = np.flatnonzero(self._is(table, change))
            at = at[np.argsort(orders[at], kind="stable")]
            place = np.searchsorted(orders[at], wanted)
            inside = place < len(at)
            found = np.append(at, -1)[np.where(inside, place, -1)]
            return table.take(pa.array(found, mask=~inside | (orders[found] != wanted)))

        order, lines = others("order"), others("detail")
        zero = pa.scalar(Decimal("0.00"), table.schema.field("amount").type)
        return pa.table(
            {
                "order_id": payment["order_id"],
                "user_id": order["user_id"],
                "shop_id": order["shop_id"],
                "order_amount": order["amount"],
                "create_ms": order["time_ms"],
                "detail_amount": pc.fill_null(lines["amount"], zero),
                "detail_count": pc.fill_null(lines["number"], 0).cast(pa.int32()),
                "payment_id": payment["fact_id"],
                "payment_ms": payment["time_ms"],
                "payment_amount": payment["amount"],
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        pending, table = self.load()
        if table is None:
            return
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        order_id, time, fact_id = (numbers(table, name) for name in ("order_id", "time_ms", "fact_id"))
        due = np.flatnonzero(self._is(table, "success") & (self._judge_timer(time) <= now))
        due = due[np.lexsort((fact_id[due], time[due], order_id[due]))]
        due = due[starts_of(order_id[due])]
        if len(due):
            for rows in pieces(self._snapshots(table, due)):
                yield Row(rows=rows)
        is_mark = self._group(table) == 3
        marks = table.filter(pa.array(is_mark))
        orders, newest = numbers(marks, "order_id"), numbers(marks, "event_time_ms")
        judged = self._is(marks, "judged") | np.isin(orders, order_id[due])
        live = self._expiry(newest) > now
        facts = table.filter(pa.array(~is_mark & np.isin(order_id, orders[live & ~judged])))
        marks = self._marks(table, orders[live], newest[live], judged[live])
        self._keep(pa.concat_tables([facts, marks]).combine_chunks(), None)


def facts_by_kind(events: DataFrame) -> DataFrame:
    """Facts with a number for what they are, which is shorter in state than its name."""
    kind = F.when(F.col("fact") == "order", ORDER).when(F.col("fact") == "detail", DETAIL).otherwise(PAYMENT)
    return order_facts(events).withColumn("kind", kind.cast("tinyint"))


def versioned_changes(facts: DataFrame, params: OrderParams, allowance_ms: int, packed: bool) -> DataFrame:
    """What facts change, in bytes, where a later version of a fact replaces the earlier one."""
    changes = (
        facts.mapInArrow(dealer(OrderFact.keys, SLICES, packed=packed), DEALT_SCHEMA)
        .groupBy("slice")
        .transformWithState(
            OrderFact(params.ttl_ms, allowance_ms), PIECE_SCHEMA, "append", "eventTime", eventTimeColumnName="event_ts"
        )
    )
    return with_late_count(changes).filter("rows IS NOT NULL").select("rows")


def immutable_changes(facts: DataFrame) -> DataFrame:
    """What facts change, where a fact has one version: no state but that of the duplicates."""
    change = F.when(F.col("fact") != "payment", F.col("fact")).when(F.col("success"), F.lit("success"))
    return facts.withColumns({"change": change, "number": F.lit(1).cast("bigint")}).filter(change.isNotNull())


def merged_immutable(table: pa.Table) -> pa.Table:
    """The same for facts with their kind, added up per order."""
    kind, success = numbers(table, "kind"), numbers(table, "success").astype(bool)
    table = table.filter(pa.array((kind != PAYMENT) | success))
    change = pa.DictionaryArray.from_arrays(table["kind"].combine_chunks(), ["order", "detail", "success"])
    number = pa.array(np.ones(table.num_rows, np.int64))
    changes = table.append_column("change", change.dictionary_decode()).append_column("number", number)
    return merged_details(changes.select(CHANGES.names))


def stream_snapshots(
    events: DataFrame | list[Input],
    params: OrderParams = OrderParams(),
    allowance_ms: int | None = None,
    immutable_facts: bool = False,
    by_slice: bool = False,
) -> DataFrame:
    """Snapshots of paid orders as their wait ends in event time.

    ``immutable_facts`` is for producers that keep the contract's promise never to send
    a second version of an order, a line or a payment attempt: facts then need no state
    in Python. Late rows are used all the same but not counted.

    ``by_slice`` finds duplicates by slice instead of by Spark's operator, for micro-batches that hold whole
    tables. Late rows are then dropped by the present watermark, not by that of the micro-batch before.
    """
    allowance = params.ttl_ms if allowance_ms is None else allowance_ms
    columns, times = ["order_id", "kind", *FACT_COLUMNS], (params.disorder_ms, allowance)
    merge, packed = merged_details, by_slice or not immutable_facts
    if immutable_facts and by_slice:
        columns.remove("event_id")
        changes = distinct_pieces(events, facts_by_kind, ["kind", "order_id", "fact_id"], columns, *times)
        merge = merged_immutable
    elif immutable_facts:
        keys = ["order_id", "fact", "fact_id"]
        facts = distinct_facts(events, order_facts, keys, *times, by_event=False)
        changes = immutable_changes(facts).select(*CHANGES.names)
    else:
        if by_slice:
            facts = distinct_pieces(events, facts_by_kind, ["order_id", "event_id"], columns, *times)
        else:
            facts = distinct_facts(events, facts_by_kind, ["order_id"], *times).select(*columns)
        changes = versioned_changes(facts, params, allowance, packed=by_slice)
    dealt = changes.mapInArrow(dealer(["order_id"], SLICES, merge, packed=packed), DEALT_SCHEMA)
    snapshots = dealt.groupBy("slice").transformWithState(
        OrderJudge(params, allowance), "rows binary", "append", "eventTime"
    )
    return snapshots.mapInArrow(unpack, SNAPSHOT_SCHEMA)


def stream_order_alerts(
    events: DataFrame | list[Input],
    params: OrderParams = OrderParams(),
    allowance_ms: int | None = None,
    immutable_facts: bool = False,
    by_slice: bool = False,
) -> DataFrame:
    return order_alerts(stream_snapshots(events, params, allowance_ms, immutable_facts, by_slice), params)
