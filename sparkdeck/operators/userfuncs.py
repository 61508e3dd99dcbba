"""A user's own functions in place of a mapper and a reducer.

Built-in expressions are the fast way; these are for what has none.  Rows cross
to Python in Arrow batches, and a group never meets in one place: every task
keeps a partial state a key, and the states are merged in two steps, many keys
in one call.

The functions are shipped to the workers by value when they are lambdas or
closures; module-level ones must be importable there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

#: Keys of one task whose states are held before they are passed on.
KEYS_HELD = 100_000
#: States of a key that meet in the last merge, at most.
FAN_IN = 64
#: Parts that the keys are dealt into; a merge takes the keys of one part at once.
BUCKETS = 1024
#: Keys whose states travel in one row, and rows made in one batch, at most.
PACKED, MADE = 1_000, 10_000


def group_reduce(df: DataFrame, key: str, values: Sequence[str], zero: Callable[[], object],
                 update: Callable[[object, tuple], object], merge: Callable[[object, object], object],
                 finish: Callable[[object], tuple], result: str, keys_held: int = KEYS_HELD, fan_in: int = FAN_IN,
                 buckets: int = BUCKETS) -> DataFrame:
    """One row a key: the key and ``finish``'s columns (``result``, as DDL).

    ``update(state, row)`` takes the rows of a task one by one, starting from
    ``zero()``; ``merge`` joins two states and must not depend on their order.
    A task passes its states on whenever it holds ``keys_held`` keys, so its
    memory is bounded.  Keys are dealt into ``buckets``, and the states of a
    bucket's keys travel together, pickled: a group is a bucket, not a key, so
    the work grows with the states and not with calls.  States are merged by
    ``fan_in`` slots first, then across slots, so a key that every task has seen
    is no bottleneck; the last merge holds the keys of one bucket.  A null key
    is a key, NaN counts as null; no rows give none."""
    field = StructField(key, df.schema[key].dataType)
    fractional = isinstance(field.dataType, (FloatType, DoubleType))
    final_schema = StructType([field, *StructType.fromDDL(result).fields])
    names = [f.name for f in final_schema.fields]

    def packed(states: dict) -> dict[str, list]:
        import pickle
        import zlib
        from itertools import batched

        dealt: dict[int, list] = {}
        for item in states.items():
            dealt.setdefault(zlib.crc32(repr(item[0]).encode()) % buckets, []).append(item)
        rows = [(b, pickle.dumps(some)) for b, items in dealt.items() for some in batched(items, PACKED)]
        return {"_bucket": [b for b, _ in rows], "_states": [x for _, x in rows]}

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        slot, states = TaskContext.get().partitionId() % fan_in, {}

        def out():
            rows = packed(states)
            states.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows["_bucket"], pa.int32()), pa.array([slot] * len(rows["_bucket"]), pa.int32()),
                                               pa.array(rows["_states"], pa.binary())], names=["_bucket", "_slot", "_states"])

        for batch in batches:
            keys, *columns = (c.to_pylist() for c in batch.columns)
            if fractional:  # one zero
                keys = [None if k is None or k != k else k + 0.0 for k in keys]
            for k, row in zip(keys, zip(*columns, strict=True) if columns else [()] * len(keys), strict=True):
                states[k] = update(states[k] if k in states else zero(), row)
                if len(states) >= keys_held:
                    yield out()
        if states:
            yield out()

    def add(states: dict, rows: pd.DataFrame) -> None:
        import pickle

        for some in rows["_states"]:
            for k, s in pickle.loads(some):
                states[k] = merge(states[k], s) if k in states else s

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict = {}
        for rows in batches:
            add(states, rows)
            if len(states) >= keys_held:
                yield pd.DataFrame(packed(states))
                states.clear()
        if states:
            yield pd.DataFrame(packed(states))

    def finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict = {}
        for rows in batches:
            add(states, rows)
        done = ((k, *finish(s)) for k, s in states.items())
        while some := list(islice(done, MADE)):
            yield pd.DataFrame(some, columns=names, dtype=object)

    states = df.select(key, *values).mapInArrow(partial, "_bucket int, _slot int, _states binary")
    slots = states.groupBy("_bucket", "_slot").applyInPandas(merged, "_bucket int, _states binary")
    return slots.groupBy("_bucket").applyInPandas(finished, final_schema)


def generate_rows(df: DataFrame, column: str, generate: Callable[[object], Iterator[tuple]], result: str) -> DataFrame:
    """The rows that ``generate(value)`` yields for every row of ``df``, as
    columns ``result`` (DDL).  Values are read and rows leave in Arrow batches,
    many values to a batch, and bounded however many rows a value makes.  Only
    what is made is returned."""
    schema = StructType.fromDDL(result)
    single = len(schema) == 1

    def made(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = to_arrow_schema(schema)
        rows = (row if not single or isinstance(row, tuple) else (row,) for batch in batches
                for value in batch.column(0).to_pylist() for row in generate(value) or ())
        while some := list(islice(rows, MADE)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], schema=kinds)

    return df.select(F.col(column).alias("_value")).mapInArrow(made, schema)
