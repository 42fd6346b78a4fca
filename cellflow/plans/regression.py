"""Linear regression by batch gradient descent."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflow.functions import as_column, dot
from cellflow.operators.folds import STATE, merged_states
from cellflow.operators.joins import cross_with_row

#: Features up to which the sums are columns of one aggregate; their number grows with the square.
WIDE = 24


def train_linear(
    rows: DataFrame,
    features: Sequence[str | Column],
    target: str | Column,
    parameters: DataFrame | Sequence[float] | None = None,
    learning_rate: float | Column = 0.25,
    max_iterations: int = 100,
    epsilon: float = 0.001,
) -> DataFrame:
    """Parameters after gradient descent: rows of (index, theta, gradient, iterations).

    Each step adds ``learning_rate`` times the gradient sum((y - theta.x) x), with x0 = 1, and the
    loop ends when the norm of the previous gradient is below ``epsilon``. The gradient is a sum over
    all rows, so a rate that fits few rows diverges on many: scale the columns and give a rate such
    as ``F.lit(0.5) / F.count("*")``. A result that is not finite fails.

    The gradient needs only the sums of x_i x_j and x_i y. They are taken in one pass over the
    data; the steps then run on those sums, so the data is read once, not once per step. Up to ``WIDE`` features the sums are
    one aggregate; beyond that every partition multiplies its batches as matrices, and its sums are added in a tree.

    ``parameters`` gives the starting theta, by default zeros: a list, or a frame of
    (index, theta, gradient) whose gradient counts as the previous one.
    """
    if max_iterations < 1:
        raise ValueError("at least one iteration is needed")
    names = [f"_x{i}" for i in range(len(features) + 1)]
    x = [F.lit(1.0), *[as_column(f).cast("double") for f in features]]
    data = rows.select(*[c.alias(n) for c, n in zip(x, names)], as_column(target).cast("double").alias("_y"))
    data = data.where(reduce(and_, [F.col(n).isNotNull() for n in [*names[1:], "_y"]]))

    size = len(names)
    if size > WIDE + 1:
        return _train_wide(data, names, parameters, learning_rate, max_iterations, epsilon)
    sums = [
        F.sum(F.col(names[i]) * F.col(names[j])).alias(f"_s{i}_{j}") for i in range(size) for j in range(i, size)
    ]
    cross = [F.sum(F.col(n) * F.col("_y")).alias(f"_t{i}") for i, n in enumerate(names)]
    rate = learning_rate if isinstance(learning_rate, Column) else F.lit(float(learning_rate))
    totals = data.agg(*sums, *cross, rate.cast("double").alias("_rate"))
    totals = totals.select(
        F.array(*[F.array(*[F.col(f"_s{min(i, j)}_{max(i, j)}") for j in range(size)]) for i in range(size)]).alias("_a"),
        F.array(*[F.col(f"_t{i}") for i in range(size)]).alias("_b"),
        "_rate",
    )
    totals = _with_start(totals, parameters, size)

    def step(state: Column, _: Column) -> Column:
        done = F.sqrt(dot(state.gradient, state.gradient)) < epsilon
        gradient = F.zip_with("_b", "_a", lambda b, a: b - dot(a, state.theta))
        theta = F.zip_with(state.theta, gradient, lambda t, g: t + F.col("_rate") * g)
        return F.when(done, state).otherwise(_state(theta, gradient, state.iterations + 1))

    final = F.aggregate(F.sequence(F.lit(1), F.lit(max_iterations)), _state(F.col("_theta"), F.col("_gradient"), F.lit(0)), step)
    fitted = totals.select(final.alias("_fit"))
    finite = F.forall(F.col("_fit.theta"), lambda t: F.abs(t) < float("inf"))
    checked = F.when(finite, F.col("_fit")).otherwise(
        F.raise_error(F.lit("gradient descent diverged: scale the columns or lower the learning rate"))
    )
    return fitted.select(
        F.posexplode(F.arrays_zip(checked.theta.alias("theta"), checked.gradient.alias("gradient"))).alias("index", "_p"),
        F.col("_fit.iterations").alias("iterations"),
    ).select("index", "_p.theta", "_p.gradient", "iterations")


def _train_wide(
    data: DataFrame, names: Sequence[str], parameters: DataFrame | Sequence[float] | None, learning_rate: float | Column, max_iterations: int, epsilon: float
) -> DataFrame:
    """The same steps on a matrix of sums. Its size follows the number of features alone, so one task holds it."""
    size = len(names)
    if isinstance(learning_rate, Column):
        learning_rate = data.agg(learning_rate.cast("double")).first()[0]
    gradient = np.full(size, np.inf)
    if isinstance(parameters, DataFrame):
        rows = sorted(map(tuple, parameters.select("index", "theta", "gradient").limit(size + 1).collect()))
        parameters, gradient = [r[1] for r in rows], np.array([r[2] for r in rows], dtype=float)
    theta = np.zeros(size) if parameters is None else np.array(parameters, dtype=float)
    if len(theta) != size:
        raise ValueError(f"{size} parameters expected, {len(theta)} given")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size, size + 1))
        for batch in batches:
            table = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            sums += table[:, :size].T @ table
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(sums)], pa.binary())], ["state"])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size, size + 1))
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                sums += pickle.loads(packed)
        t, g, n = theta, gradient, 0
        with np.errstate(over="ignore", invalid="ignore"):
            while n < max_iterations and not np.sqrt(g @ g) < epsilon:
                g = sums[:, size] - sums[:, :size] @ t
                t, n = t + learning_rate * g, n + 1
        if not np.isfinite(t).all():
            raise ValueError("gradient descent diverged: scale the columns or lower the learning rate")
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype=np.int32)), pa.array(t), pa.array(g), pa.array(np.full(size, n, dtype=np.int32))],
            ["index", "theta", "gradient", "iterations"])

    states = merged_states(data.select(*names, "_y").mapInArrow(products, STATE), lambda a, b: a + b)
    return states.repartition(1).mapInArrow(steps, "index int, theta double, gradient double, iterations int")


def _state(theta: Column, gradient: Column, iterations: Column) -> Column:
    return F.struct(
        F.transform(theta, lambda t: t.cast("double")).alias("theta"),
        F.transform(gradient, lambda g: g.cast("double")).alias("gradient"),
        iterations.cast("int").alias("iterations"),
    )


def _with_start(totals: DataFrame, parameters: DataFrame | Sequence[float] | None, size: int) -> DataFrame:
    # No gradient is known before the first step, so that it is always made.
    unknown = F.array_repeat(F.lit(float("inf")), size)
    if isinstance(parameters, DataFrame):
        rows = parameters.select("index", "theta", "gradient")
        ordered = rows.agg(F.array_sort(F.collect_list(F.struct("index", "theta", "gradient"))).alias("_p"))
        wrong = F.raise_error(F.lit(f"{size} parameters expected"))
        ordered = ordered.select(F.when(F.size("_p") == size, F.col("_p")).otherwise(wrong).alias("_p"))
        started = cross_with_row(totals, ordered)
        return started.select("*", F.col("_p.theta").alias("_theta"), F.col("_p.gradient").alias("_gradient"))
    start = [0.0] * size if parameters is None else [float(t) for t in parameters]
    if len(start) != size:
        raise ValueError(f"{size} parameters expected, {len(start)} given")
    return totals.select("*", F.array(*[F.lit(t) for t in start]).alias("_theta"), unknown.alias("_gradient"))


def parse_parameters(lines: DataFrame, line: str = "line") -> DataFrame:
    """(index, theta, gradient) from text lines of the three, separated by white space."""
    parts = F.split(F.trim(F.col(line)), r"\s+")
    return lines.select(
        parts[0].cast("int").alias("index"), parts[1].cast("double").alias("theta"), parts[2].cast("double").alias("gradient")
    )


def format_parameters(fitted: DataFrame) -> DataFrame:
    """The lines to store, in index order."""
    return fitted.orderBy("index").select(F.concat_ws("\t", "index", "theta", "gradient").alias("line"))


def predict(features: Sequence[str | Column], theta: Sequence[float]) -> Column:
    """theta.x with x0 = 1."""
    terms = [as_column(f).cast("double") * F.lit(t) for f, t in zip(features, theta[1:], strict=True)]
    return reduce(lambda a, b: a + b, terms, F.lit(float(theta[0])))
