"""user-defined aggregates in Python that merge.

An ``Aggregator`` folds Arrow batches into one state a key, merges states and finishes each once. States are made
where the rows lie (``mapInArrow``: rows are never shuffled), so a hot key becomes one small state in each task. The
states are then merged by key in two levels, first in groups of ``WIDTH`` tasks, so that no task merges more states
of a key than the square root of the number of tasks, or ``WIDTH`` where that is more.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, DataType, StructField, StructType

#: Keys whose states a task holds before it passes them on.
HELD = 50_000
WIDTH = 64


class Aggregator(Protocol):
    """Rules of one aggregate. ``update`` and ``merge`` return the new state; states must be picklable."""

    def zero(self) -> Any: ...

    def update(self, state: Any, rows: pd.DataFrame) -> Any: ...

    def merge(self, a: Any, b: Any) -> Any: ...

    def finish(self, state: Any) -> Any: ...


def aggregate_by(df: DataFrame, keys: Sequence[str], inputs: Sequence[str], aggregator: Aggregator, result: DataType,
                 out: str = "value", held: int = HELD, width: int = WIDTH) -> DataFrame:
    """``keys`` and ``out``: the aggregate of the ``inputs`` columns for every key (null keys are a key)."""
    src = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
                    *[F.col(f"`{c}`") for c in inputs], F.spark_partition_id().alias("task"))
    key_names = [f"k{i}" for i in range(len(keys))]
    key_fields = [StructField(n, src.schema[n].dataType) for n in key_names]
    partial = StructType([*key_fields, StructField("task", src.schema["task"].dataType), StructField("state", BinaryType())])
    input_names = list(inputs)

    def rows(states: dict, task: int, schema: pa.Schema) -> pa.RecordBatch:
        columns = [[k[i] for k in states] for i in range(len(key_names))]
        columns += [[task] * len(states), [pickle.dumps(s) for s in states.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def fold(batches):
        states: dict[tuple, Any] = {}
        task, schema = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            fields = [pa.field(n, b.schema.field(n).type) for n in key_names]
            schema = pa.schema([*fields, pa.field("task", pa.int32()), pa.field("state", pa.binary())])
            task = t["task"][0].as_py()
            # rows of a key lie together after one sort of the batch; Arrow compares keys, nulls included
            t = t.append_column("row", pa.array(range(len(t))))
            groups = t.group_by(key_names, use_threads=False).aggregate([("row", "list")]) if key_names else None
            pdf = t.select(input_names).to_pandas()
            for g in groups.to_pylist() if groups is not None else [{"row_list": None}]:
                key = tuple(g[n] for n in key_names)
                own = pdf if g["row_list"] is None else pdf.iloc[g["row_list"]]
                states[key] = aggregator.update(states[key] if key in states else aggregator.zero(), own)
            if len(states) >= held:
                yield rows(states, task, schema)
                states = {}
        if states:
            yield rows(states, task, schema)

    def merging(final: bool):
        def merge(batches):
            for pdf in batches:
                out_rows = []
                for r in pdf.itertuples(index=False):
                    state = None
                    for s in r.states:
                        s = pickle.loads(s)
                        state = s if state is None else aggregator.merge(state, s)
                    out_rows.append((*r[:len(key_names)], aggregator.finish(state) if final else pickle.dumps(state)))
                yield pd.DataFrame(out_rows, columns=[*key_names, "state"])
        return merge

    states = src.mapInArrow(fold, partial)
    some = states.groupBy(*key_names, F.floor(F.col("task") / width).alias("task")).agg(F.collect_list("state").alias("states"))
    once = some.select(*key_names, "states").mapInPandas(merging(False), StructType([*key_fields, StructField("state", BinaryType())]))
    all_ = once.groupBy(*key_names).agg(F.collect_list("state").alias("states"))
    done = all_.mapInPandas(merging(True), StructType([*key_fields, StructField("state", result)]))
    return done.toDF(*keys, out)


class Agreement:
    """1 - sqrt(1 - ((pos - neg) / (pos + neg)) ** 2) of a label column; null without a positive or negative label."""

    def __init__(self, label_col: str = "sentiment_label"):
        self.label_col = label_col

    def zero(self) -> tuple[int, int]:
        return 0, 0

    def update(self, state, rows):
        labels = rows[self.label_col]
        return state[0] + int((labels == "BULLISH").sum()), state[1] + int((labels == "BEARISH").sum())

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def finish(self, state):
        pos, neg = state
        return None if pos + neg == 0 else 1.0 - (1.0 - ((pos - neg) / (pos + neg)) ** 2) ** 0.5


class Distinct:
    """Number of distinct non-null values by a state of the k smallest hashes; exact below k values."""

    def __init__(self, col: str, k: int = 1024):
        self.col, self.k = col, k

    def zero(self):
        return frozenset()

    def _least(self, hashes):
        return frozenset(sorted(hashes)[:self.k])

    def update(self, state, rows):
        values = rows[self.col].dropna()
        return self._least(state.union(pd.util.hash_array(values.astype(str).to_numpy(object)).tolist()))

    def merge(self, a, b):
        return self._least(a | b)

    def finish(self, state):
        if len(state) < self.k:
            return float(len(state))
        return (self.k - 1) / (max(state) / 2 ** 64)
