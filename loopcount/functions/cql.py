"""Filters written as CQL text (S8), as Columns on the stored tables.

Comparisons, ``[NOT] LIKE | ILIKE | IN | BETWEEN``, ``IS [NOT] NULL``, ``BBOX(geometry, x1, y1, x2, y2)``, the dates' ``DURING a/b``,
``BEFORE``, ``AFTER`` and ``TEQUALS``, ``AND``, ``OR``, ``NOT``, brackets, ``INCLUDE`` and ``EXCLUDE``. Attributes have the names of the
declared types (``V00`` to ``V95`` are elements of the counts); the columns' own names are read too.

The text becomes the Column that a caller would write by hand, so Spark prunes and pushes down as
usual. What the layout offers is added to it: a weekday is a partition as it is, a date's bound
also bounds the month, a box is also ranges of ``place`` (``functions.curve``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loopcount.feature_types import COLUMNS
from loopcount.functions import curve
from loopcount.schemas import OBSERVATIONS_SCHEMA, SLOT_NAMES

_TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^']|'')*')|(?P<time>\d{4}-\d\d-\d\d(?:T[\d:.]+Z?)?(?:/\d{4}-\d\d-\d\d(?:T[\d:.]+Z?)?)?)|"
                    r"(?P<number>[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)|(?P<word>[A-Za-z_]\w*|\"[^\"]+\")|(?P<sign><=|>=|<>|[=<>(),]))")
_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b, "<>": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


class BadFilter(ValueError):
    """A filter text that cannot be read; the message tells where."""


def cql_filter(text: str) -> Column:
    """The Column of a filter text."""
    return _Reader(text).filter()


def _attribute(name: str) -> Column:
    name = name.strip('"')
    if name.upper() in SLOT_NAMES:
        return F.col("volumes")[SLOT_NAMES.index(name.upper())]
    upper = {k.upper(): v for k, v in COLUMNS.items()}
    known = upper.get(name.upper(), name if name in OBSERVATIONS_SCHEMA.fieldNames() else None)
    if known is None:
        raise BadFilter(f"unknown attribute {name}")
    return F.col(known)


def _months(op: str, day: date) -> Column:
    """What a bound of ``obs_date`` says of the month, for partitions."""
    month = F.lit(day.year * 100 + day.month)
    return _COMPARE[{"<": "<=", ">": ">=", "=": "="}.get(op[0], op)](F.col("obs_month"), month)


def _day(op: str, day: date) -> Column:
    """A comparison of ``obs_date`` with a day, bounding its partition too."""
    exact = _COMPARE[op](F.col("obs_date"), F.lit(day))
    return exact if op == "<>" else exact & _months(op, day)


class _Reader:
    def __init__(self, text: str):
        self.text, self.tokens, at = text, [], 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if m is None:
                raise BadFilter(f"cannot read the filter at {at}: {text[at:at + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup], m.start(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str | None, str, int]:
        return self.tokens[self.at] if self.at < len(self.tokens) else (None, "", len(self.text))

    def take(self, *wanted: str) -> str | None:
        """The next token, if it is one of these words or signs (case does not matter)."""
        kind, value, _ = self.peek()
        if kind in ("word", "sign") and value.upper() in wanted:
            self.at += 1
            return value.upper()
        return None

    def need(self, *wanted: str) -> str:
        got = self.take(*wanted)
        if got is None:
            _, value, place = self.peek()
            raise BadFilter(f"expected {' or '.join(wanted)} at {place}, found {value or 'the end'!r}")
        return got

    def next(self, *kinds: str) -> str:
        kind, value, place = self.peek()
        if kind not in kinds:
            raise BadFilter(f"expected a {' or '.join(kinds)} at {place}, found {value or 'the end'!r}")
        self.at += 1
        return value

    def filter(self) -> Column:
        out = self.either()
        if self.peek()[0] is not None:
            raise BadFilter(f"unexpected {self.peek()[1]!r} at {self.peek()[2]}")
        return out

    def either(self) -> Column:
        parts = [self.both()]
        while self.take("OR"):
            parts.append(self.both())
        return reduce(lambda a, b: a | b, parts)

    def both(self) -> Column:
        parts = [self.one()]
        while self.take("AND"):
            parts.append(self.one())
        return reduce(lambda a, b: a & b, parts)

    def one(self) -> Column:
        if self.take("NOT"):
            return ~self.one()
        if self.take("("):
            out = self.either()
            self.need(")")
            return out
        if word := self.take("INCLUDE", "EXCLUDE"):
            return F.lit(word == "INCLUDE")
        if self.take("BBOX"):
            return self.box()
        return self.predicate(self.next("word"))

    def box(self) -> Column:
        self.need("(")
        if _attribute(self.next("word"))._jc.toString() != F.col("point_wkt")._jc.toString():
            raise BadFilter("BBOX is on the geometry")
        corners = []
        for _ in range(4):
            self.need(",")
            corners.append(float(self.next("number")))
        if self.take(","):
            self.next("text")  # the reference system: there is one only
        self.need(")")
        return curve.in_box(*corners)

    def literal(self, column: str):
        kind, value, place = self.peek()
        if kind not in ("text", "time", "number"):
            raise BadFilter(f"expected a value at {place}, found {value or 'the end'!r}")
        self.at += 1
        value = value[1:-1].replace("''", "'") if kind == "text" else value
        if column == "obs_date":
            try:
                return date.fromisoformat(value[:10])
            except ValueError:
                raise BadFilter(f"{value!r} at {place} is no date") from None
        return float(value) if kind == "number" and re.search(r"[.eE]", value) else int(value) if kind == "number" else value

    def predicate(self, name: str) -> Column:
        column = _attribute(name)
        known = {k.upper(): v for k, v in COLUMNS.items()}.get(name.strip('"').upper(), name)
        if known == "obs_date" and (word := self.take("DURING", "BEFORE", "AFTER", "TEQUALS")):
            return self.temporal(word)
        if op := self.take(*_COMPARE):
            value = self.literal(known)
            return _day(op, value) if isinstance(value, date) else _COMPARE[op](column, F.lit(value))
        if self.take("IS"):
            inverse = self.take("NOT")
            self.need("NULL")
            return column.isNotNull() if inverse else column.isNull()
        inverse = self.take("NOT")
        word = self.need("LIKE", "ILIKE", "IN", "BETWEEN")
        if word in ("LIKE", "ILIKE"):
            pattern = self.next("text")[1:-1].replace("''", "'")
            out = column.like(pattern) if word == "LIKE" else column.ilike(pattern)
        elif word == "IN":
            self.need("(")
            values = [self.literal(known)]
            while self.take(","):
                values.append(self.literal(known))
            self.need(")")
            out = column.isin(values)
            if known == "obs_date" and not inverse:
                out = out & F.col("obs_month").isin(sorted({v.year * 100 + v.month for v in values}))
        else:
            low = self.literal(known)
            self.need("AND")
            high = self.literal(known)
            out = column.between(low, high)
            if known == "obs_date" and not inverse:
                out = _day(">=", low) & _day("<=", high)
        return ~out if inverse else out

    def temporal(self, word: str) -> Column:
        value, place = self.next("time"), self.peek()[2]
        parts = value.split("/")
        try:
            days = [date.fromisoformat(p[:10]) for p in parts]
        except ValueError:
            raise BadFilter(f"{value!r} is no time") from None
        if (word == "DURING") != (len(days) == 2):
            raise BadFilter(f"{word} before {place} needs {'two times a/b' if word == 'DURING' else 'one time'}")
        # A count's date is the start of its day; DURING leaves out both of its ends, as BEFORE and AFTER do.
        later = [len(p) > 10 and p[11:].rstrip("Z").strip("0:.") != "" for p in parts]
        if word == "DURING":
            return _day(">", days[0]) & (_day("<=", days[1]) if later[1] else _day("<", days[1]))
        if word == "BEFORE":
            return _day("<=", days[0]) if later[0] else _day("<", days[0])
        if word == "AFTER":
            return _day(">", days[0])
        return F.lit(False) if later[0] else _day("=", days[0])
