"""A caller's own aggregate given by zero, seq and comb, in two phases.

The first phase folds rows into one state per key inside each task and sends the states on, at most
``MOST_KEYS`` held at once; the second merges the states of a key, which come sorted by key, so it holds
one at a time. A key's states are as many as tasks (and refills) that met it, however many rows it has.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MOST_KEYS = 100_000


def folded(df: DataFrame, keys: Sequence[str], values: Sequence[str], zero: Callable, seq: Callable, comb: Callable, done: Callable, out: T.StructType,
           most_keys: int = MOST_KEYS) -> DataFrame:
    """(*``keys``, *``out``) where a group's state begins as ``zero()``, takes its rows by ``seq(state, *values)``, in any order,
    meets the states of other tasks by ``comb(a, b)`` and ends as the tuple ``done(state)``.

    ``comb`` has to be associative and commutative, ``zero()`` its neutral element. States are pickled between the phases. Null
    keys are keys of their own.
    """
    keys, values = list(keys), list(values)
    narrow = df.select(*keys, *values)
    key_fields = [narrow.schema[k] for k in keys]
    partial = T.StructType([*key_fields, T.StructField("_state", T.BinaryType())])
    result = T.StructType([*key_fields, *out.fields])

    def batch_of(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
        arrow = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(arrow), arrow)], schema=arrow)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, object] = {}
        sent = lambda: batch_of([(*k, pickle.dumps(s)) for k, s in states.items()], partial)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                key = row[:len(keys)]
                state = states[key] if key in states else zero()
                states[key] = seq(state, *row[len(keys):])
            if len(states) >= most_keys:
                yield sent()
                states.clear()
        if states:
            yield sent()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            ready = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key, more = row[:-1], pickle.loads(row[-1])
                if now is not None and key == now[0]:
                    state = comb(state, more)
                    continue
                if now is not None:
                    ready.append((*now[0], *done(state)))
                now, state = (key,), more
            if ready:
                yield batch_of(ready, result)
        if now is not None:
            yield batch_of([(*now[0], *done(state))], result)

    states = narrow.mapInArrow(fold, partial)
    dealt = states.repartition(*keys).sortWithinPartitions(*keys) if keys else states.repartition(1)
    return dealt.mapInArrow(merge, result)
