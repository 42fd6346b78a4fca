"""What to read from a cell table: columns, versions, qualifier filters, defaults and time range."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_VERSIONS = None
NEWEST_POSSIBLE = 2**63 - 1


class Cell:
    """A literal cell of a default slice. Without a version it counts as the newest possible."""

    def __init__(self, value: Any, version: int = NEWEST_POSSIBLE, qualifier: str | None = None):
        self.value, self.version, self.qualifier = value, version, qualifier

    def __repr__(self) -> str:
        return f"Cell({self.value!r}, version={self.version}, qualifier={self.qualifier!r})"


@dataclass(frozen=True)
class TimeRange:
    """Versions in [begin, end); None leaves a side open (A5)."""

    begin: int | None = None
    end: int | None = None

    def __post_init__(self):
        if self.begin is not None and self.end is not None and self.begin > self.end:
            raise ValueError(f"time range begins at {self.begin}, after its end {self.end}")

    @classmethod
    def at(cls, version: int) -> TimeRange:
        return cls(version, None if version == NEWEST_POSSIBLE else version + 1)

    @classmethod
    def after(cls, begin: int) -> TimeRange:
        return cls(begin, None)

    @classmethod
    def before(cls, end: int) -> TimeRange:
        return cls(None, end)

    @classmethod
    def between(cls, begin: int, end: int) -> TimeRange:
        return cls(begin, end)


ALL_TIME = TimeRange()


class QualifierFilter:
    """A predicate on the qualifier; combine with ``&`` and ``|``."""

    def condition(self, qualifier: Column) -> Column:
        raise NotImplementedError

    def __and__(self, other: QualifierFilter) -> QualifierFilter:
        return And([self, other])

    def __or__(self, other: QualifierFilter) -> QualifierFilter:
        return Or([self, other])


_META = re.compile(r"[\\^$.|?*+()\[\]{}]")


@dataclass(frozen=True)
class Regex(QualifierFilter):
    """The whole qualifier matches. A plain leading text is also pushed to the files as a prefix."""

    pattern: str

    def literal_prefix(self) -> str:
        # With alternatives the leading text is not common to all, and a following quantifier
        # (also a counted one) may drop the last character.
        if "|" in self.pattern or "\\Q" in self.pattern or self.pattern.startswith("(?"):
            return ""
        meta = _META.search(self.pattern)
        if meta is None:
            return self.pattern
        prefix = self.pattern[: meta.start()]
        return prefix[:-1] if meta.group() in "?*{" else prefix

    def condition(self, qualifier: Column) -> Column:
        whole = qualifier.rlike(f"^(?:{self.pattern})\\z")
        prefix = self.literal_prefix()
        return qualifier.startswith(prefix) & whole if prefix else whole


@dataclass(frozen=True)
class Range(QualifierFilter):
    """Qualifiers between two texts, compared by bytes; None leaves a side open."""

    low: str | None = None
    high: str | None = None
    low_included: bool = True
    high_included: bool = False

    def condition(self, qualifier: Column) -> Column:
        parts = []
        if self.low is not None:
            parts.append(qualifier >= self.low if self.low_included else qualifier > self.low)
        if self.high is not None:
            parts.append(qualifier <= self.high if self.high_included else qualifier < self.high)
        return reduce(lambda a, b: a & b, parts, F.lit(True))


@dataclass(frozen=True)
class And(QualifierFilter):
    filters: Sequence[QualifierFilter]

    def condition(self, qualifier: Column) -> Column:
        return reduce(lambda a, b: a & b, [f.condition(qualifier) for f in self.filters])


@dataclass(frozen=True)
class Or(QualifierFilter):
    filters: Sequence[QualifierFilter]

    def condition(self, qualifier: Column) -> Column:
        return reduce(lambda a, b: a | b, [f.condition(qualifier) for f in self.filters])


@dataclass(frozen=True)
class ColumnRequest:
    """One column of a scan (A4): ``"family:qualifier"`` or a whole ``"family"``.

    ``fields`` reads a record value as a narrower record (A11); ``default`` is the slice used for an
    entity without the column (A8); ``page_size`` asks for bounded pages instead of whole slices (A9).
    """

    name: str
    max_versions: int | None = 1
    filter: QualifierFilter | None = None
    default: tuple[Cell, ...] | None = None
    page_size: int | None = None
    fields: tuple[str, ...] | None = None

    def __post_init__(self):
        family, _, qualifier = self.name.partition(":")
        if not family or self.name.endswith(":"):
            raise ValueError(f"malformed column name {self.name!r}")
        if self.max_versions is not None and self.max_versions < 1:
            raise ValueError(f"{self.name}: max_versions must be positive or ALL_VERSIONS")
        if self.page_size is not None and self.page_size < 1:
            raise ValueError(f"{self.name}: page_size must be positive")
        if self.default is not None:
            object.__setattr__(self, "default", tuple(self.default))
            if not qualifier and any(c.qualifier is None for c in self.default):
                raise ValueError(f"{self.name}: default cells of a family need a qualifier")
        if self.fields is not None:
            object.__setattr__(self, "fields", tuple(self.fields))

    @classmethod
    def family(cls, name: str, **options) -> ColumnRequest:
        if ":" in name:
            raise ValueError(f"a family name holds no ':': {name!r}")
        return cls(name, **options)

    @property
    def family_name(self) -> str:
        return self.name.partition(":")[0]

    @property
    def qualifier(self) -> str | None:
        return self.name.partition(":")[2] or None

    def wants(self, qualifier: Column) -> Column:
        """Whether a cell with this qualifier is asked for."""
        parts = [] if self.qualifier is None else [qualifier == self.qualifier]
        parts += [] if self.filter is None else [self.filter.condition(qualifier)]
        return reduce(lambda a, b: a & b, parts, F.lit(True))

    def replace_missing_with(self, *values: Any) -> ColumnRequest:
        """Default values without versions; for a family give ``(qualifier, value)`` pairs."""
        return self._with_default(
            [Cell(v[1], qualifier=v[0]) for v in values] if self.qualifier is None else [Cell(v) for v in values]
        )

    def replace_missing_with_versioned(self, *values: tuple) -> ColumnRequest:
        """Default ``(version, value)`` pairs; for a family ``(qualifier, version, value)``."""
        return self._with_default(
            [Cell(v[2], v[1], v[0]) for v in values] if self.qualifier is None else [Cell(v[1], v[0]) for v in values]
        )

    def _with_default(self, cells: Iterable[Cell]) -> ColumnRequest:
        return ColumnRequest(
            self.name, self.max_versions, self.filter, tuple(cells), self.page_size, self.fields
        )


def as_request(column: str | ColumnRequest) -> ColumnRequest:
    return column if isinstance(column, ColumnRequest) else ColumnRequest(column)


@dataclass(frozen=True)
class DataRequest:
    """A time range with named columns, as used by the model phases."""

    columns: dict[str, ColumnRequest]
    time_range: TimeRange = ALL_TIME

    def __post_init__(self):
        requests = {f: as_request(c) for f, c in self.columns.items()}
        names = [r.name for r in requests.values()]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"columns bound to more than one field: {', '.join(twice)}")
        object.__setattr__(self, "columns", requests)
