"""State of many keys in one value: keys are dealt to slices, and a slice's rows are merged by column.

A Python call with its state access and timers costs about a millisecond, whatever it is given. A call per
key bounds a job to some thousand events a second, so a processor here is called once per slice and
micro-batch: rows arrive as Arrow tables in a few binary values, and the state is an Arrow table as well.
The number of slices is fixed for a checkpoint's life, like that of the partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

SLICES = 1024
# Rows that a task holds while it deals them out, rows in one binary value, and values in one Arrow batch.
DEAL_ROWS, PIECE_ROWS, PIECES = 1 << 18, 1 << 16, 128
# What an Arrow stream begins with: bytes that are not compressed, as checkpoints of earlier code have them.
PLAIN = 0xFFFFFFFF
# Texts of no more values than this are kept by number.
FEW = 8
DEALT_SCHEMA = "slice int, rows binary"
PIECE_SCHEMA = "rows binary, late bigint, event_ts timestamp"


def _by_number(table: pa.Table) -> pa.Table:
    """The table with texts of few values, such as the names of changes, as numbers of a dictionary."""
    for at, field in enumerate(table.schema):
        if field.type == pa.string() and pc.count_distinct(table[at].slice(0, 64 * FEW)).as_py() <= FEW:
            column = table[at].combine_chunks().dictionary_encode()
            table = table.set_column(at, field.name, column)
    return table


def to_bytes(table: pa.Table) -> bytes:
    """The table's size and its compressed bytes. They are compressed as a whole, since that shortens the schema
    and equal columns too, which Arrow's compression per column leaves as they are."""
    table, sink = _by_number(table), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    plain = sink.getvalue()
    if plain.size >= PLAIN:
        return plain.to_pybytes()
    return plain.size.to_bytes(4, "little") + pa.Codec("zstd", 3).compress(plain, asbytes=True)


def from_bytes(data) -> pa.Table:
    packed = pa.py_buffer(bytes(data))
    size = int.from_bytes(packed[:4].to_pybytes(), "little")
    plain = packed if size == PLAIN else pa.decompress(packed[4:], size, codec="zstd")
    table = pa.ipc.open_stream(plain).read_all()
    for at, field in enumerate(table.schema):
        if pa.types.is_dictionary(field.type):
            table = table.set_column(at, field.name, table[at].cast(field.type.value_type))
    return table


def numbers(table: pa.Table, name: str) -> np.ndarray:
    """A column without nulls; nulls count as 0."""
    column = table[name].combine_chunks() if table[name].num_chunks != 1 else table[name].chunk(0)
    return (column.fill_null(0) if column.null_count else column).to_numpy(zero_copy_only=False)


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in sorted key columns."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def slice_numbers(keys: list[np.ndarray], slices: int) -> np.ndarray:
    mixed = np.zeros(len(keys[0]), np.uint64)
    for key in keys:
        mixed = (mixed ^ key.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(slices)).astype(np.int32)


def dealer(
    keys: list[str], slices: int, merge: Callable | None = None, packed: bool = False, spent: tuple[str, ...] = ()
):
    """A function for ``mapInArrow`` that gives rows as (slice, rows in bytes).

    ``merge`` makes a table smaller before; ``packed`` input has its rows in bytes already. The columns
    ``spent`` are left out once the slices are known.
    """

    def deal_out(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(held).combine_chunks()
        table = merge(table).combine_chunks() if merge else table
        if not table.num_rows:
            return
        columns = [numbers(table, key) for key in keys]
        numbered = slice_numbers(columns, slices)
        # Rows in the order of their keys take less room; by a key that is spent they would be in none.
        order = np.lexsort([*([] if spent else columns[::-1]), numbered])
        table, numbered = table.drop_columns(list(spent)).take(pa.array(order)), numbered[order]
        starts = starts_of(numbered)
        ends = np.append(starts[1:], len(numbered))
        for at in range(0, len(starts), PIECES):
            some = slice(at, at + PIECES)
            rows = [to_bytes(table.slice(a, b - a)) for a, b in zip(starts[some], ends[some])]
            arrays = [pa.array(numbered[starts[some]], pa.int32()), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["slice", "rows"])

    def deal(batches):
        held, count = [], 0
        for batch in batches:
            for table in unpacked(batch) if packed else [pa.Table.from_batches([batch])]:
                held.append(table)
                count += table.num_rows
                if count >= DEAL_ROWS:
                    yield from deal_out(held)
                    held, count = [], 0
        if held:
            yield from deal_out(held)

    return deal


def unpacked(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    for rows in batch.column("rows"):
        yield from_bytes(rows.as_buffer())


def unpack(batches):
    """For ``mapInArrow``: the rows that were kept in bytes."""
    for batch in batches:
        for table in unpacked(batch):
            yield from table.to_batches()


def pieces(table: pa.Table) -> Iterator[bytes]:
    for at in range(0, table.num_rows, PIECE_ROWS):
        yield to_bytes(table.slice(at, PIECE_ROWS))


def event_ts(millis: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=int(millis))


class SliceState(StatefulProcessor):
    """Common part: one Arrow table and one pending timer per slice."""

    state_schema = "timer_ms bigint, rows binary"

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("slice", self.state_schema)

    def close(self) -> None:
        pass

    def load(self) -> tuple[int | None, pa.Table | None]:
        value = self.state.get()
        return (None, None) if value is None else (value[0], from_bytes(value[1]))

    def arrived(self, rows) -> pa.Table:
        return pa.concat_tables([from_bytes(row.rows) for row in rows]).combine_chunks()

    def keep(self, table: pa.Table, pending: int | None, due: int | None) -> None:
        """The new state and its timer; ``pending`` is the timer that was set and has not fired."""
        due = int(due) if table.num_rows else None
        if due != pending:
            if pending is not None:
                self.handle.deleteTimer(pending)
            if due is not None:
                self.handle.registerTimer(due)
        if due is None:
            self.state.clear()
        else:
            self.state.update((due, to_bytes(table)))
