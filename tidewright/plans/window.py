"""Watermarks: marks of a kind, windows between them, and bounds as Column predicates."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, functions as F

KINDS = ("timestamp", "date", "number", "version")


@dataclass(frozen=True, order=False)
class Mark:
    """A place in a source's order: a datetime, a date or a Decimal, by its kind. Its text is canonical."""

    at: datetime | date | Decimal
    kind: str

    @classmethod
    def of(cls, value, kind: str) -> Mark | None:
        """From text or a value as Spark returns it; None stays None, and what is no mark of the kind raises ValueError."""
        if value is None:
            return None
        if kind not in KINDS:
            raise ValueError(f"no such kind of mark: {kind}")
        return cls(_number(value) if kind in ("number", "version") else _moment(value, kind == "date"), kind)

    def __str__(self) -> str:
        if isinstance(self.at, Decimal):
            return format(self.at, "f")
        return self.at.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(self.at, datetime) else self.at.isoformat()

    def rewound(self, by: timedelta | None) -> Mark:
        """Earlier by a duration; a mark that is a number has none, and a part of a day takes a date back by all of it."""
        if not by or isinstance(self.at, Decimal):
            return self
        if isinstance(self.at, datetime):
            return Mark(self.at - by, self.kind)
        return Mark(self.at - timedelta(days=by.days + bool(by % timedelta(days=1))), self.kind)

    def column(self) -> Column:
        if isinstance(self.at, datetime):
            return F.lit(self.at.isoformat(sep=" ")).cast("timestamp_ntz")
        return F.lit(self.at)


def _number(value) -> Decimal:
    try:
        d = Decimal(str(value).strip())
    except InvalidOperation:
        raise ValueError(f"not a number: {value!r}") from None
    if not d.is_finite():
        raise ValueError(f"not a finite number: {value!r}")
    return d


def _moment(value, day: bool) -> datetime | date:
    if not isinstance(value, (datetime, date)):
        value = datetime.fromisoformat(str(value).strip().replace("T", " "))
        if value.tzinfo:
            raise ValueError(f"watermarks carry no zone: {value}")
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value.date() if day else value


def text_of(value, kind: str) -> str | None:
    """Canonical text of a mark."""
    mark = Mark.of(value, kind)
    return None if mark is None else str(mark)


def ahead(value, stored, kind: str) -> bool:
    """Whether a mark lies beyond the stored one; compared as what they are, not as text."""
    new, old = Mark.of(value, kind), Mark.of(stored, kind)
    return new is not None and (old is None or new.at > old.at)


@dataclass(frozen=True)
class Window:
    """Where an extract begins: the stored mark, taken back by the overlap, or the floor where none is stored."""

    stored: Mark | None
    floor: Mark | None = None
    overlap: timedelta | None = None

    @property
    def first(self) -> bool:
        return self.stored is None

    @property
    def lower(self) -> str | None:
        begin = self.stored.rewound(self.overlap) if self.stored else self.floor
        return None if begin is None else str(begin)


def window(stored, kind: str, overlap: timedelta | None = None, floor=None) -> Window:
    return Window(Mark.of(stored, kind), Mark.of(floor, kind), overlap)


def predicate(column: str, kind: str, lower: str | None = None, upper: str | None = None, inclusive: bool = True) -> Column | None:
    """lower <= column < upper as a pushable filter; None if unbounded.

    The upper bound is exclusive and becomes the next lower bound, which is
    therefore inclusive unless told otherwise: no row falls between two runs.
    """
    c, tests = F.col(column), []
    if lower is not None:
        low = Mark.of(lower, kind).column()
        tests.append(c >= low if inclusive else c > low)
    if upper is not None:
        tests.append(c < Mark.of(upper, kind).column())
    if not tests:
        return None
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]
