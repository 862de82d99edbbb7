"""Places and running totals in ordered groups of any size.

Rows are ranged by group and order, so a group that holds most of a table is spread over many
tasks. Each task counts within its range; what the ranges before it hold of its first group is
added afterwards. Only one row per range reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rareclass.llm.words import powers
from rareclass.session import materialize

_WRAP = 1 << 64


class _Counter:
    """Places and totals of the rows of one range, batch after batch."""

    def __init__(self, group: list[str], sums: list[str], chained: list[str]):
        self.group, self.sums, self.chained = group, sums, chained
        self.key, self.seen, self.groups, self.rows = None, 0, 0, 0
        self.carry = np.zeros(len(sums) + len(chained), dtype=np.uint64)

    def add(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        n = batch.num_rows
        fresh = np.zeros(n, dtype=bool)
        for name in self.group:
            column = batch.column(name)
            fresh[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        fresh[0] = self.key != [batch.column(g)[0].as_py() for g in self.group]
        at = np.arange(n)
        begin = np.maximum.accumulate(np.where(fresh, at, -1))
        place = np.where(begin < 0, at + self.seen, at - begin)
        number = self.groups + np.cumsum(fresh)
        out = {"place": place, "range_first": number == 1, "range_row": self.rows + at}
        for i, name in enumerate(self.sums + self.chained):
            value = batch.column(name).to_numpy().view(np.uint64)
            if i >= len(self.sums):
                value = value * powers(int(place.max()) + 1)[place]
            total = np.cumsum(value)
            run = total - np.where(begin < 0, np.uint64(0) - self.carry[i], (total - value)[begin])
            self.carry[i] = run[-1]
            out[f"run_{name}"] = run.view(np.int64)
        self.key = [batch.column(g)[-1].as_py() for g in self.group]
        self.seen, self.groups, self.rows = int(place[-1]) + 1, int(number[-1]), self.rows + n
        return {k: pa.array(v) for k, v in out.items()}


def _carries(ends: list, width: int, chained: int) -> dict[int, tuple[int, list[int]]]:
    """For each range, the place and totals at which its first group continues, where it does."""
    carries, key, at, totals = {}, None, 0, [0] * width
    for row in sorted(ends, key=lambda r: r["range_no"]):
        head, last = tuple(row["head"]), tuple(row["last"])
        own, *runs = row["totals"]
        if head == key:
            carries[row["range_no"]] = (at, totals)
        if last == head and head == key:  # the group goes on through the whole range
            shift = [1] * (width - chained) + [pow(int(powers(2)[1]), at, _WRAP)] * chained
            at, totals = at + own + 1, [(x + s * y) % _WRAP for x, s, y in zip(totals, shift, runs)]
        else:
            at, totals = own + 1, [y % _WRAP for y in runs]
        key = last
    return carries


def running(rows: DataFrame, group: list[str], order: list[str], sums: list[str] = (), chained: list[str] = (),
            name: str = "running") -> DataFrame:
    """``rows`` with ``place`` (0, 1, ... in its group) and ``run_<column>`` for the named bigint columns.

    ``run_x`` is the sum of ``x`` up to and with the row; for ``chained`` columns that of
    ``x * powers(place)``, modulo 2**64, which tells sequences apart. ``group`` and summed
    columns hold no nulls; ``rows`` is a written table, and its ``order`` (nulls first) tells
    any two rows apart that are not equal. An empty table stays empty.
    """
    sums, chained = list(sums), list(chained)
    runs = [f"run_{c}" for c in sums + chained]
    ordered = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, number = _Counter(group, sums, chained), TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                new = counter.add(batch) | {"range_no": pa.array(np.full(batch.num_rows, number))}
                yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=[*batch.schema.names, *new])

    number = T.LongType()
    out = T.StructType([*rows.schema.fields, T.StructField("place", number), T.StructField("range_first", T.BooleanType()),
                        *[T.StructField(c, number) for c in ["range_row", *runs, "range_no"]]])
    counted = materialize(ordered.mapInArrow(count, out), name)
    ends = counted.groupBy("range_no").agg(
        F.min_by(F.struct(*group), "range_row").alias("head"), F.max_by(F.struct(*group), "range_row").alias("last"),
        F.max_by(F.array("place", *runs), "range_row").alias("totals")).collect()  # one row per range
    carries = _carries(ends, len(runs), len(chained))
    if not carries:
        return counted.drop("range_no", "range_first", "range_row")

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            new = {c: batch.column(c) for c in ["place", *runs]}
            number = batch.column("range_no").to_numpy()
            first = batch.column("range_first").to_numpy(zero_copy_only=False)
            for p in np.unique(number):
                if (found := carries.get(int(p))) is None:
                    continue
                at, totals = found
                here = first & (number == p)
                for i, c in enumerate(["place", *runs]):
                    value = new[c].to_numpy().view(np.uint64)
                    if i > len(sums):
                        value = value * np.uint64(pow(int(powers(2)[1]), at, _WRAP))
                    value = value + np.uint64(at if i == 0 else totals[i - 1])
                    new[c] = pa.array(np.where(here, value.view(np.int64), new[c].to_numpy()))
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names=names)

    return counted.mapInArrow(shift, out).drop("range_no", "range_first", "range_row")
