"""User folds over all rows."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cellflow.session import written

#: States that one task merges, give or take what an even deal of them leaves.
FAN = 32
STATE = "state binary"


def fold_rows(
    rows: DataFrame,
    fields: Sequence[str],
    initial: Callable[[], Any],
    step: Callable[[Any, pd.DataFrame], Any],
    merge: Callable[[Any, Any], Any],
    finish: Callable[[Any], Any],
    result: str,
    result_type: str | T.DataType = "double",
) -> DataFrame:
    """Fold rows with a user function and return one row with the finished value.

    Use built-in aggregates where one exists. ``step(state, batch)`` takes an Arrow batch as a pandas
    frame; every partition folds to one state. The states are written, and merged FAN at a time in as many rounds as their number asks for,
    so that the last task merges a handful however many partitions there were. ``merge`` must be associative and
    commutative, ``initial()`` its neutral element. A state is whatever Python can pickle; a task holds two at a time.
    """

    def fold_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = initial()
        for batch in batches:
            state = step(state, batch)
        yield pd.DataFrame({"state": [pickle.dumps(state)]})

    def finish_states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merged = None
        for batch in batches:
            for packed in batch["state"]:
                state = pickle.loads(packed)
                merged = state if merged is None else merge(merged, state)
        yield pd.DataFrame({result: [finish(initial() if merged is None else merged)]})

    states = merged_states(rows.select(*fields).mapInPandas(fold_partition, STATE), merge)
    schema = T.StructType([T.StructField(result, _type(result_type))])
    # Not coalesce: that would pull the parallel merge into the last task.
    return states.repartition(1).mapInPandas(finish_states, schema)


def merged_states(states: DataFrame, merge: Callable[[Any, Any], Any], fan: int | None = None) -> DataFrame:
    """Pickled states, one a row, to at most ``fan`` of them: a tree of merges, each level written."""
    fan = FAN if fan is None else fan

    def merge_some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merged = None
        for batch in batches:
            for packed in batch["state"]:
                state = pickle.loads(packed)
                merged = state if merged is None else merge(merged, state)
        if merged is not None:
            yield pd.DataFrame({"state": [pickle.dumps(merged)]})

    states = written(states, "states")
    left = states.count()
    while left > fan:
        states = written(states.repartition(-(-left // fan)).mapInPandas(merge_some, STATE), "states")
        left = states.count()
    return states


def _type(t: str | T.DataType) -> T.DataType:
    return t if isinstance(t, T.DataType) else T.DataType.fromDDL(t)
