"""The first n rows of every group, kept while Arrow batches stream by."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Rows that gather before a group is cut to its first n again.
BUFFER_ROWS = 1 << 14
# A task hands on what it keeps beyond so many bytes, and starts anew.
TASK_BYTES = 128 << 20


@dataclass(frozen=True)
class Nearest:
    """The first ``n`` rows of each group by a number, then by an id; nulls first, NaN last.

    With ``distinct``, rows of one group, number and id count once.
    """

    n: int
    group: str
    number: str
    tie: str
    distinct: bool = False

    def cut(self, table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """The rows that stay, in order, and their places in their groups from 1 on."""
        number = table.column(self.number)
        known = pc.is_valid(number)
        nan = pc.fill_null(pc.is_nan(number), False) if pa.types.is_floating(number.type) else pc.invert(known)
        keys = pa.table(
            {
                "group": table.column(self.group),
                "known": known,
                "nan": nan,
                "number": pc.if_else(nan, pa.scalar(None, number.type), number),
                "tie": table.column(self.tie),
            }
        )
        if self.distinct:
            # The first row of each key, by grouping; the sort below then has different keys only.
            numbered = keys.append_column("row", pa.array(np.arange(len(table))))
            first = numbered.group_by(keys.column_names, use_threads=False).aggregate([("row", "min")])
            places = first.column("row_min").combine_chunks()
            table, keys = table.take(places), keys.take(places)
        order = pc.sort_indices(keys, [(name, "ascending") for name in keys.column_names], null_placement="at_start")
        group = table.column(self.group).combine_chunks().take(order)
        ends = np.ones(len(group), bool)
        if len(group):
            ends[1:] = pc.not_equal(group[1:], group[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(ends)
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group)))) + 1
        stay = place <= self.n
        return table.take(order.filter(pa.array(stay))), place[stay]

    def _streamed(self, batches: Iterator[pa.RecordBatch], limit: int | None) -> Iterator[pa.Table]:
        """The cut of all rows; in several parts when it outgrows ``limit`` bytes."""
        held: list[pa.Table] = []
        kept = fresh = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            fresh += batch.num_rows
            # As many new rows as there are kept ones, so that every row is sorted a few times only.
            if fresh >= max(BUFFER_ROWS, kept):
                held = [self.cut(pa.concat_tables(held))[0]]
                kept, fresh = held[0].num_rows, 0
                if limit is not None and held[0].nbytes > limit:
                    yield held[0]
                    held, kept = [], 0
        if held:
            yield pa.concat_tables(held)

    def partial(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in self._streamed(batches, TASK_BYTES):
            yield from self.cut(table)[0].to_batches()

    def numbered(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows of the groups must come; each that stays gets its place."""
        for table in self._streamed(batches, None):
            rows, place = self.cut(table)
            yield from rows.append_column("position", pa.array(place, pa.int32())).to_batches()
