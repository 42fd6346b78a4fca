"""The model life cycle: prepare, train, extract and score, evaluate."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflow.operators import slices
from cellflow.operators.folds import fold_rows
from cellflow.sources.cell_log import CellLog
from cellflow.sources.cells import CellTable
from cellflow.sources.requests import ColumnRequest, DataRequest
from cellflow.sources.scan import scan
from cellflow.sources.side_data import lookup

ALL = "*"
RESULTS = "results"
PHASES = ("prepare", "train", "score", "evaluate")


class InvalidModel(ValueError):
    """A model or environment that cannot run; names every fault."""


# --- user functions ---


def _names(fields: str | Sequence[str]) -> list[str] | str:
    return fields if fields in (ALL, RESULTS) else [fields] if isinstance(fields, str) else list(fields)


def _columns(result: Column | Sequence[Column], names: Sequence[str], what: str) -> list[Column]:
    found = [result] if isinstance(result, Column) else list(result)
    if len(found) != len(names):
        raise InvalidModel(f"{what} gives {len(found)} values for the fields {', '.join(names)}")
    return [c.alias(n) for c, n in zip(found, names)]


def _arity(fn: Callable, inputs: Sequence[str] | str, what: str) -> None:
    if inputs == ALL:
        return
    try:
        inspect.signature(fn).bind(*inputs)
    except TypeError as e:
        raise InvalidModel(f"{what} does not take the {len(inputs)} fields {', '.join(inputs)}: {e}") from None


@dataclass(frozen=True)
class SideLookup:
    """Adds the field ``into`` from a named side-data frame before a function runs (M7).

    ``key`` is a Column over the fields, e.g. ``lambda f: slices.first_value(f("word"))``, or a
    constant.
    """

    store: str
    key: Callable[[Callable[[str], Column]], Column] | Any
    into: str
    on_missing: str = "error"
    keep_first_by: str | None = None
    small: bool | None = None


@dataclass(frozen=True, eq=False)
class Extractor:
    """Input fields to feature fields.

    ``fn`` gets one Column per input and returns one per output: expressions, or a pandas UDF where
    no expression exists. ``inputs="*"`` takes every bound field and ``outputs="results"`` names the
    features like the inputs (M5).
    """

    inputs: str | Sequence[str]
    outputs: str | Sequence[str]
    fn: Callable[..., Column | Sequence[Column]]
    lookups: Sequence[SideLookup] = ()

    def __post_init__(self):
        _arity(self.fn, _names(self.inputs), "the extractor")


@dataclass(frozen=True, eq=False)
class Scorer:
    """Feature fields to one value."""

    inputs: str | Sequence[str]
    fn: Callable[..., Column]
    lookups: Sequence[SideLookup] = ()

    def __post_init__(self):
        _arity(self.fn, _names(self.inputs), "the scorer")


def _each(select: Callable[[Column], Column]) -> Extractor:
    return Extractor(ALL, RESULTS, lambda *fields: [select(f) for f in fields])


def first_value_extractor() -> Extractor:
    """The first value of every slice (M8)."""
    return _each(slices.first_value)


def last_value_extractor() -> Extractor:
    return _each(slices.last_value)


def slice_extractor() -> Extractor:
    """All values of every slice, in order."""
    return _each(slices.values)


# --- score ---


def score_rows(
    table: CellTable,
    columns: Mapping[str, str | ColumnRequest] | DataRequest,
    scorer: Scorer,
    extractor: Extractor | None = None,
    side_data: Mapping[str, DataFrame] | None = None,
    out: str = "score",
    on_missing: str = "empty",
) -> DataFrame:
    """One score per entity (M3-M7).

    Functions may also use the entity columns as fields. An entity lacking a column gives an empty
    slice, on which ``first_value`` fails, as any entity with at least one requested cell is scored;
    ``on_missing="skip"`` leaves such entities out. Functions are Columns of the scanned row, so
    scoring adds no exchange to the scan.
    """
    if on_missing not in ("empty", "skip"):
        raise InvalidModel('on_missing is "empty" or "skip"')
    request = columns if isinstance(columns, DataRequest) else DataRequest(dict(columns))
    bound = list(request.columns)
    rows = scan(table, request, keep_missing=on_missing == "empty")
    if on_missing == "empty":
        empty = {f: F.array().cast(rows.schema[f].dataType) for f in bound}
        rows = rows.select(*table.entity, *[F.coalesce(F.col(f), empty[f]).alias(f) for f in bound])
    side_data = side_data or {}
    # Features may be named like the entity columns; those to write scores under are kept apart.
    own = [f"_entity{i}" for i in range(len(table.entity))]
    rows = rows.select("*", *[F.col(e).alias(o) for e, o in zip(table.entity, own)])

    fields = bound
    if extractor is not None:
        rows = _with_lookups(rows, extractor.lookups, side_data)
        inputs = _names(extractor.inputs)
        inputs = [*bound, *[l.into for l in extractor.lookups]] if inputs == ALL else inputs
        outputs = _names(extractor.outputs)
        outputs = inputs if outputs == RESULTS else outputs
        _known(inputs, rows.columns, "extract")
        features = _columns(extractor.fn(*[F.col(f) for f in inputs]), outputs, "the extractor")
        keep = [F.col(e) for e in table.entity if e not in outputs]
        rows = rows.select(*own, *keep, *features)
        fields = outputs
    rows = _with_lookups(rows, scorer.lookups, side_data)
    inputs = _names(scorer.inputs)
    inputs = [*fields, *[l.into for l in scorer.lookups]] if inputs == ALL else inputs
    _known(inputs, rows.columns, "score")
    score = _columns(scorer.fn(*[F.col(f) for f in inputs]), [out], "the scorer")
    return rows.select(*[F.col(o).alias(e) for e, o in zip(table.entity, own)], *score)


def _known(inputs: Sequence[str], have: Sequence[str], phase: str) -> None:
    unknown = [f for f in inputs if f not in have]
    if unknown:
        raise InvalidModel(f"the {phase} function uses unknown fields: {', '.join(unknown)}")


def _with_lookups(rows: DataFrame, lookups: Iterable[SideLookup], side_data: Mapping[str, DataFrame]) -> DataFrame:
    for l in lookups:
        if l.store not in side_data:
            raise InvalidModel(f"no side data named {l.store}")
        key = l.key(F.col) if callable(l.key) else F.lit(l.key)
        rows = lookup(rows, side_data[l.store], key, l.into, l.on_missing, l.keep_first_by, l.small)
    return rows


# --- evaluate ---


@dataclass(frozen=True, eq=False)
class Distance:
    """A distance per row, in one or more output fields."""

    inputs: str | Sequence[str]
    outputs: str | Sequence[str]
    fn: Callable[..., Column | Sequence[Column]]

    def __post_init__(self):
        _arity(self.fn, _names(self.inputs), "the distance")


@dataclass(frozen=True, eq=False)
class Fold:
    """A user fold for an evaluation without a built-in aggregate."""

    fields: Sequence[str]
    initial: Callable[[], Any]
    step: Callable[[Any, Any], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any]
    result: str
    result_type: str = "double"


@dataclass(frozen=True, eq=False)
class Evaluator:
    """Distance per row, then an optional aggregate: Columns over the distance fields, or a Fold."""

    distance: Distance
    aggregate: Mapping[str, Column] | Fold | None = None


def evaluate_rows(rows: DataFrame, evaluator: Evaluator) -> DataFrame:
    """Distances of the rows, or their aggregate."""
    distance = evaluator.distance
    inputs, outputs = _names(distance.inputs), _names(distance.outputs)
    _known(inputs, rows.columns, "distance")
    measured = rows.select("*", *_columns(distance.fn(*[F.col(f) for f in inputs]), outputs, "the distance"))
    aggregate = evaluator.aggregate
    if aggregate is None:
        return measured
    if isinstance(aggregate, Fold):
        return fold_rows(
            measured, aggregate.fields, aggregate.initial, aggregate.step, aggregate.merge,
            aggregate.finish, aggregate.result, aggregate.result_type,
        )
    return measured.agg(*[c.alias(n) for n, c in aggregate.items()])


# --- life cycle ---


class Readable(Protocol):
    def read(self, spark: SparkSession) -> DataFrame: ...


class Writable(Protocol):
    def write(self, rows: DataFrame) -> None: ...


@dataclass(frozen=True, eq=False)
class PhaseEnvironment:
    """Named inputs and outputs of a prepare or train phase (M1, M2). An input is anything with
    ``read(spark)``, or a frame; an output is anything with ``write(rows)``."""

    inputs: Mapping[str, Readable | DataFrame]
    outputs: Mapping[str, Writable]
    side_data: Mapping[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True, eq=False)
class ScoreEnvironment:
    """Where scores are read from and written to. ``table`` is a cell log, or a function giving a
    table when the phase starts, so that it sees what earlier phases wrote."""

    table: CellLog | Callable[[], CellTable]
    columns: Mapping[str, str | ColumnRequest] | DataRequest
    output: Writable
    side_data: Mapping[str, DataFrame | Callable[[], DataFrame]] = field(default_factory=dict)
    out: str = "score"
    on_missing: str = "empty"


@dataclass(frozen=True, eq=False)
class EvaluateEnvironment:
    """What is compared: fields of a cell table, and where the result goes."""

    table: CellLog | Callable[[], CellTable]
    columns: Mapping[str, str | ColumnRequest] | DataRequest
    output: Writable
    values: Callable[[str], Column] = slices.first_value


@dataclass
class PhaseContext:
    """Handed to prepare and train functions."""

    spark: SparkSession
    environment: PhaseEnvironment
    arguments: Mapping[str, Any]

    def input(self, name: str) -> DataFrame:
        if name not in self.environment.inputs:
            raise InvalidModel(f"no input named {name}")
        source = self.environment.inputs[name]
        return source if isinstance(source, DataFrame) else source.read(self.spark)

    def output(self, name: str) -> Writable:
        if name not in self.environment.outputs:
            raise InvalidModel(f"no output named {name}")
        return self.environment.outputs[name]

    def publish(self, name: str, rows: DataFrame) -> DataFrame:
        """Write an output now and return it as read back, for a later job of the same phase."""
        sink = self.output(name)
        sink.write(rows)
        return sink.read(self.spark)


# A phase function reads its inputs and returns frames by output name. False stops the run.
PhaseFunction = Callable[[Mapping[str, DataFrame], PhaseContext], "Mapping[str, DataFrame] | bool | None"]


@dataclass(frozen=True, eq=False)
class Model:
    """Which phases a model has; checked as a whole when it is made."""

    prepare: PhaseFunction | None = None
    train: PhaseFunction | None = None
    extractor: Extractor | None = None
    scorer: Scorer | None = None
    evaluator: Evaluator | None = None

    def __post_init__(self):
        faults = []
        if not (self.prepare or self.train or self.scorer or self.evaluator):
            faults.append("a model needs at least one phase")
        if self.prepare and self.scorer and not self.train:
            faults.append("prepare and score need train between them")
        if self.evaluator and self.prepare and not (self.train and self.scorer):
            faults.append("evaluate after prepare needs train and score")
        elif self.evaluator and self.train and not self.scorer:
            faults.append("evaluate after train needs score")
        if self.extractor and not self.scorer:
            faults.append("an extractor needs a scorer")
        if faults:
            raise InvalidModel("; ".join(faults))


@dataclass(frozen=True, eq=False)
class Environment:
    prepare: PhaseEnvironment | None = None
    train: PhaseEnvironment | None = None
    score: ScoreEnvironment | None = None
    evaluate: EvaluateEnvironment | None = None


def run_model(
    spark: SparkSession,
    model: Model,
    environment: Environment,
    skip: Iterable[str] = (),
    arguments: Mapping[str, Any] | None = None,
) -> dict[str, bool]:
    """Run the phases in order, each reading what the former wrote.

    Phases a model lacks or that are skipped are passed over; the first that fails ends the run.
    Returns the outcome of every phase that ran.
    """
    skip = set(skip)
    unknown = skip - set(PHASES)
    if unknown:
        raise InvalidModel(f"no phase named {', '.join(sorted(unknown))}")
    has = {"prepare": model.prepare, "train": model.train, "score": model.scorer, "evaluate": model.evaluator}
    planned = [p for p in PHASES if has[p] is not None and p not in skip]
    lacking = [p for p in planned if getattr(environment, p) is None]
    if lacking:
        raise InvalidModel(f"no environment for the phases {', '.join(lacking)}")
    steps = {
        "prepare": lambda: _run_phase(spark, model.prepare, environment.prepare, arguments or {}),
        "train": lambda: _run_phase(spark, model.train, environment.train, arguments or {}),
        "score": lambda: run_score(model, environment.score),
        "evaluate": lambda: run_evaluate(model, environment.evaluate),
    }
    outcome: dict[str, bool] = {}
    for phase in planned:
        outcome[phase] = steps[phase]()
        if not outcome[phase]:
            break
    return outcome


def _run_phase(spark: SparkSession, fn: PhaseFunction, environment: PhaseEnvironment, arguments: Mapping) -> bool:
    context = PhaseContext(spark, environment, arguments)
    result = fn({n: context.input(n) for n in environment.inputs}, context)
    if isinstance(result, bool):
        return result
    for name, rows in (result or {}).items():
        context.output(name).write(rows)
    return True


def _open(table: CellLog | Callable[[], CellTable]) -> CellTable:
    return table.table() if isinstance(table, CellLog) else table()


def run_score(model: Model, environment: ScoreEnvironment) -> bool:
    side = {n: s if isinstance(s, DataFrame) else s() for n, s in environment.side_data.items()}
    scores = score_rows(
        _open(environment.table), environment.columns, model.scorer, model.extractor, side,
        environment.out, environment.on_missing,
    )
    environment.output.write(scores)
    return True


def run_evaluate(model: Model, environment: EvaluateEnvironment) -> bool:
    table = _open(environment.table)
    request = environment.columns
    fields = list(request.columns if isinstance(request, DataRequest) else request)
    rows = scan(table, request).select(*table.entity, *[environment.values(f).alias(f) for f in fields])
    environment.output.write(evaluate_rows(rows, model.evaluator))
    return True
