"""Running sums over a whole table in a stated order, without a task that sees all of it or all of one key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import fresh, written


def running(df: DataFrame, order: Sequence[str | Column], sums: Sequence[str] = (), xors: Sequence[str] = (),
            keep: Sequence[str] | None = None, name: str = "running", partitions: int | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of every row, ``<c>_upto`` for each long column in ``sums`` (sum) and ``xors``
    (exclusive or) over this row and all rows before it in ``order``, and ``at``, the row's number from 0.

    Rows are sorted by ranges of ``order``, every range is summed on its own, and one total per range gives what to
    add. The sorted rows are written, so that a lost executor can't sort ties anew. Nulls count as 0.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = list(keep if keep is not None else df.columns)
    part = fresh(df, "part")
    added = [*[f"{c}_upto" for c in [*sums, *xors]], "at"]
    steps = [np.cumsum] * len(sums) + [np.bitwise_xor.accumulate] * len(xors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, carried, rows = TaskContext.get().partitionId(), [np.int64(0)] * len(steps), 0
        for batch in batches:
            size, new = batch.num_rows, []
            for i, (c, step) in enumerate(zip([*sums, *xors], steps)):
                own = batch.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = step(np.concatenate((carried[i:i + 1], own)))[1:]
                if size:
                    carried[i] = upto[-1]
                new.append(pa.array(upto))
            new += [pa.array(np.arange(rows, rows + size)), pa.array(np.full(size, number, np.int32))]
            rows += size
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new], [*kept, *added, part])

    types = dict(df.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in kept], *[f"`{c}` long" for c in added], f"`{part}` int"])
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    table = written(ranged.mapInArrow(run, schema), name)
    last = F.max_by(F.struct(*added), "at").alias("last")
    totals = {r[part]: r["last"] for r in table.groupBy(part).agg(last).collect()}  # one row for each range
    before = []
    for i, c in enumerate(added):
        own = [totals[p][c] + (c == "at") if p in totals else 0 for p in range(n)]
        before.append(list(accumulate(own, (lambda a, b: a ^ b) if len(sums) <= i < len(added) - 1 else (lambda a, b: a + b), initial=0)))
    offsets = spark.createDataFrame([(p, *[b[p] for b in before]) for p in range(n)],
                                    f"`{part}` int, " + ", ".join(f"`{c}_before` long" for c in added))
    joined = table.join(F.broadcast(offsets), part)
    whole = [(F.col(c).bitwiseXOR(F.col(f"{c}_before")) if c[:-5] in xors else F.col(c) + F.col(f"{c}_before")).alias(c) for c in added]
    return joined.select(*kept, *whole)
