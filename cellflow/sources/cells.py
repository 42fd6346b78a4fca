"""Cell tables: views of long or wide DataFrames as (entity, family, qualifier, version, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflow.functions import as_column, micros, timestamp_of_micros
from cellflow.sources.requests import ALL_TIME, ColumnRequest, TimeRange


class MissingColumns(ValueError):
    """Every unknown column of a request, in one message."""


@dataclass(frozen=True)
class Version:
    """How a stored column becomes a BIGINT version.

    A range of versions is turned into a range of the *stored* column, so that it reaches the file
    scan as a pushed filter instead of being evaluated on the converted number.
    """

    stored: Column
    from_timestamp: bool = False
    #: Partition columns that hold the least version of a file and the end of its versions, if the files are laid out so.
    low: Column | None = None
    high: Column | None = None

    @classmethod
    def number(cls, column: str | Column, low: str | Column | None = None, high: str | Column | None = None) -> Version:
        return cls(as_column(column), False, None if low is None else as_column(low), None if high is None else as_column(high))

    @classmethod
    def micros_of(cls, column: str | Column) -> Version:
        """Microseconds since 1970 of a TIMESTAMP_NTZ column."""
        return cls(as_column(column), True)

    @property
    def value(self) -> Column:
        return micros(self.stored) if self.from_timestamp else self.stored.cast("bigint")

    def bound(self, version: int) -> Column:
        return timestamp_of_micros(version) if self.from_timestamp else F.lit(version).cast("bigint")

    def within(self, time_range: TimeRange) -> Column | None:
        begin, end = time_range.begin, time_range.end
        low = None if begin is None else self.stored >= self.bound(begin)
        high = None if end is None else self.stored < self.bound(end)
        if low is not None and self.high is not None:
            low = low & (self.high >= begin)  # the last range includes its end
        if high is not None and self.low is not None:
            high = high & (self.low < end)
        if low is None or high is None:
            return high if low is None else low
        return low & high


@dataclass(frozen=True, eq=False)
class LongCells:
    """One family stored as one row per cell.

    ``qualifiers`` lists the columns of a group-type family; None makes it a map-type family.
    ``write_order`` ranks several rows of one (entity, qualifier, version): the highest wins, which
    is the upsert rule (K5). Leave it out only when those rows are known to be unique. ``colocated``: Spark knows
    the frame to be partitioned by the entity, so that a scan needs no exchange. ``resolve`` names the columns that
    tell its cells apart, and the order of writes: rows are resolved as they are stored then, before any column is renamed.
    """

    frame: DataFrame
    family: str
    entity: Mapping[str, str | Column]
    qualifier: str | Column
    version: Version
    value: str | Column
    write_order: str | Column | None = None
    qualifiers: Sequence[str] | None = None
    colocated: bool = False
    resolve: tuple[Sequence[str], Column] | None = None

    def names(self) -> list[str]:
        return [self.family] if self.qualifiers is None else [f"{self.family}:{q}" for q in self.qualifiers]

    def covers(self, request: ColumnRequest) -> bool:
        if request.family_name != self.family:
            return False
        return request.qualifier is None or self.qualifiers is None or request.qualifier in self.qualifiers

    def rows(self, request: ColumnRequest, time_range: TimeRange = ALL_TIME) -> DataFrame:
        """Stored rows of one request, before versions are resolved."""
        qualifier = as_column(self.qualifier)
        frame = self.frame.where(request.wants(qualifier))
        in_time = self.version.within(time_range)
        if in_time is not None:
            frame = frame.where(in_time)
        value = as_column(self.value)
        if self.resolve is not None:
            keys, order = self.resolve
            frame, value = frame.groupBy(*keys).agg(F.max_by(value, order).alias("_resolved")), F.col("_resolved")
        extra = [] if self.write_order is None else [as_column(self.write_order).alias("_order")]
        return frame.select(
            *[as_column(c).alias(n) for n, c in self.entity.items()],
            qualifier.alias("qualifier"),
            self.version.value.alias("version"),
            narrowed(value, request).alias("value"),
            *extra,
        )


@dataclass(frozen=True, eq=False)
class WideCells:
    """Group-type columns stored as one row per entity, one version each; NULL means no cell."""

    frame: DataFrame
    family: str
    entity: Mapping[str, str | Column]
    columns: Mapping[str, str | Column]
    version: Version = field(default_factory=lambda: Version.number(F.lit(0)))

    def names(self) -> list[str]:
        return [f"{self.family}:{q}" for q in self.columns]

    def covers(self, request: ColumnRequest) -> bool:
        if request.family_name != self.family:
            return False
        return request.qualifier is None or request.qualifier in self.columns


def narrowed(value: Column, request: ColumnRequest) -> Column:
    """A record value with the requested fields only, so that no other field is read."""
    if request.fields is None:
        return value
    return F.when(value.isNotNull(), F.struct(*[value.getField(f).alias(f) for f in request.fields]))


class CellTable:
    """A catalogue of cell views sharing one entity key."""

    def __init__(self, entity: Sequence[str], views: Sequence[LongCells | WideCells]):
        self.entity = list(entity)
        self.views = list(views)
        for view in self.views:
            if list(view.entity) != self.entity:
                raise ValueError(f"family {view.family}: entity {list(view.entity)} is not {self.entity}")

    def columns(self) -> list[str]:
        return [name for view in self.views for name in view.names()]

    def find(self, request: ColumnRequest) -> LongCells | WideCells | None:
        return next((v for v in self.views if v.covers(request)), None)

    def validate(self, requests: Sequence[ColumnRequest]) -> None:
        unknown = sorted({r.name for r in requests if self.find(r) is None})
        if unknown:
            raise MissingColumns(
                f"the table has no column {', '.join(unknown)}; it has {', '.join(self.columns())}"
            )
        for r in requests:
            if r.fields is None:
                continue
            view = self.find(r)
            if isinstance(view, LongCells):
                stored = [view.value]
            else:
                stored = [view.columns[r.qualifier]] if r.qualifier else list(view.columns.values())
            for field in view.frame.select(*[as_column(c) for c in stored]).schema.fields:
                lost = [f for f in r.fields if f not in getattr(field.dataType, "names", [])]
                if lost:
                    raise MissingColumns(f"{r.name} has no record field {', '.join(lost)}")

    def entities(self) -> DataFrame:
        """Every entity with a cell in any family: a scan without columns."""
        frames = []
        for view in self.views:
            rows = view.frame
            if isinstance(view, WideCells):  # already one row per entity
                rows = rows.where(reduce(or_, [as_column(c).isNotNull() for c in view.columns.values()]))
            keys = rows.select(*[as_column(c).alias(n) for n, c in view.entity.items()])
            frames.append(keys if isinstance(view, WideCells) else keys.distinct())
        out = frames[0]
        for frame in frames[1:]:
            out = out.union(frame)
        return out if len(frames) == 1 else out.distinct()
