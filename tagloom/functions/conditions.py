"""Filter text and predicates.

Condition text looks like ``modified[ge]2019-09-01,gender[eq]1``; a comma means AND.
Relative windows look like ``modified#day#30``.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHAPE = re.compile(r"^(?P<field>[^\[\]]+)\[(?P<op>[^\[\]]+)\](?P<value>.*)$", re.DOTALL)

# Operator names of the condition text.
_COMPARE = {
    "eq": operator.eq,
    "ne": operator.ne,
    "gt": operator.gt,
    "lt": operator.lt,
    "ge": operator.ge,
    "le": operator.le,
}

# Days in one unit of a relative window.
_UNIT_DAYS = {"day": 1, "month": 30, "year": 365}


@dataclass(frozen=True)
class Condition:
    field: str
    op: str
    value: str

    def column(self, as_text: bool = True, missing_passes: bool = False) -> Column:
        """As text, values compare byte by byte; typed, Spark casts the literal to the column."""
        side = F.col(self.field).cast("string") if as_text else F.col(self.field)
        test = _COMPARE[self.op](side, F.lit(self.value))
        return (test | F.col(self.field).isNull()) if missing_passes else test


def parse_condition(text: str) -> Condition:
    found = _SHAPE.match(text.strip())
    if not found or found["op"].lower() not in _COMPARE:
        raise ValueError(f"not a condition: {text!r}")
    return Condition(found["field"].strip(), found["op"].lower(), found["value"])


def parse_conditions(text: str) -> list[Condition]:
    return [parse_condition(part) for part in text.split(",") if part.strip()]


def condition_filter(text: str, as_text: bool = True, missing_passes: bool = False) -> Column:
    """One predicate for a whole comma-separated condition text."""
    return all_of(c.column(as_text, missing_passes) for c in parse_conditions(text))


def relative_window(text: str, as_of: Column) -> Column:
    """``field#unit#n``: the ``n`` units of days that end yesterday, both ends included.

    The bounds are compared with the bare column, so the predicate can reach the scan.
    """
    field, unit, amount = (part.strip() for part in text.split("#"))
    if unit.lower() not in _UNIT_DAYS:
        raise ValueError(f"unknown unit in {text!r}")
    days = int(amount) * _UNIT_DAYS[unit.lower()]
    first, after_last = F.date_sub(as_of, 1 + days), as_of
    return (F.col(field) >= first) & (F.col(field) < after_last)


def compare(field: str, op: str, value) -> Column:
    """Typed comparison; a missing value never passes."""
    return _COMPARE[op](F.col(field), F.lit(value))


def all_of(tests: Iterable[Column]) -> Column:
    return reduce(operator.and_, tests)


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(operator.or_, tests)


def equals_all(values: Mapping[str, object]) -> Column:
    return all_of(F.col(c) == F.lit(v) for c, v in values.items())


def equals_any(values: Mapping[str, object]) -> Column:
    return any_of(F.col(c) == F.lit(v) for c, v in values.items())


def contains_text(field: str, text: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(F.col(field)).contains(text.lower())


def key_range(field: str, start, stop) -> Column:
    """Half-open: ``start`` is in, ``stop`` is out."""
    return (F.col(field) >= F.lit(start)) & (F.col(field) < F.lit(stop))
