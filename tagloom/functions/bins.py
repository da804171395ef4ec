"""Numeric value -> score through a table of ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bins:
    """Ranges ``(score, lo, hi)`` in ascending order; ``None`` means open.

    ``edge`` names the end that decides in closed mode: with ``"hi"`` a value belongs to the
    first range whose upper end it does not exceed, with ``"lo"`` to the last range whose lower
    end it reaches.  Closed mode has no gaps.  ``strict`` mode takes the ranges literally, and a
    value outside all of them scores NULL.  ``open_lo`` / ``open_hi`` make the open-sided first
    or last range exclude its finite end in strict mode.
    """

    ranges: tuple[tuple[float, float | None, float | None], ...]
    edge: str = "hi"
    open_lo: bool = False
    open_hi: bool = False

    def score(self, value: Column | str, strict: bool = False) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return self._strict(value) if strict else self._closed(value)

    def _closed(self, value: Column) -> Column:
        out = F.when(value.isNull(), F.lit(None).cast("double"))
        if self.edge == "hi":
            for score, _, hi in self.ranges[:-1]:
                out = out.when(value <= hi, float(score))
            return out.otherwise(float(self.ranges[-1][0]))
        for score, lo, _ in reversed(self.ranges[1:]):
            out = out.when(value >= lo, float(score))
        return out.otherwise(float(self.ranges[0][0]))

    def _strict(self, value: Column) -> Column:
        out = None
        for score, lo, hi in self.ranges:
            if lo is None:
                test = value < hi if self.open_hi else value <= hi
            elif hi is None:
                test = value > lo if self.open_lo else value >= lo
            else:
                test = value.between(lo, hi)
            score = F.lit(float(score))
            out = F.when(test, score) if out is None else out.when(test, score)
        return out


def cut_bins(cuts: list[float], scores: list[float], edge: str) -> Bins:
    """Bins from ``len(scores) - 1`` ascending cut points."""
    los = [None, *cuts] if edge == "lo" else [None, *[c + 1 for c in cuts]]
    his = [*[c - 1 for c in cuts], None] if edge == "lo" else [*cuts, None]
    return Bins(tuple(zip(scores, los, his)), edge)


# Score ranges of the customer-value, activity and per-bean models.
RFM_RECENCY = Bins(((5, 1, 3), (4, 4, 6), (3, 7, 9), (2, 10, 15), (1, 16, None)), "hi", open_lo=True)
RFM_FREQUENCY = Bins(((1, 1, 49), (2, 50, 99), (3, 100, 149), (4, 150, 199), (5, 200, None)), "lo")
RFM_MONETARY = Bins(
    ((1, None, 10000), (2, 10000, 49999), (3, 50000, 99999), (4, 100000, 199999), (5, 200000, None)),
    "lo",
    open_hi=True,
)
RFE_RECENCY = Bins(((5, 0, 15), (4, 16, 30), (3, 31, 45), (2, 46, 60), (1, 61, None)), "hi", open_lo=True)
RFE_FREQUENCY = Bins(((1, None, 99), (2, 100, 199), (3, 200, 299), (4, 300, 399), (5, 400, None)), "lo")
RFE_ENGAGEMENTS = Bins(((1, None, 49), (2, 50, 149), (3, 150, 199), (4, 200, 249), (5, 250, None)), "lo")
# The second activity version: recency from 1, last range from 61, engagements below 49.
RFE_RECENCY_FROM_ONE = Bins(((5, 1, 15), (4, 16, 30), (3, 31, 45), (2, 46, 60), (1, 61, None)), "hi")
RFE_ENGAGEMENTS_BELOW_49 = Bins(
    ((1, None, 49), (2, 50, 149), (3, 150, 199), (4, 200, 249), (5, 250, None)), "lo", open_hi=True
)
BEAN_RECENCY = Bins(((6, None, 1), (5, 2, 3), (4, 4, 5), (3, 6, 7), (2, 8, 14), (1, 15, None)), "hi")
BEAN_FREQUENCY = Bins(((1, 1, 1), (2, 2, 3), (3, 4, 5), (4, 6, 7), (5, 8, 9), (6, 10, None)), "lo")
BEAN_ENGAGEMENTS = Bins(((1, 1, 1), (2, 2, 2), (3, 3, 3), (4, 4, 4), (5, 5, 5), (6, 6, None)), "lo")
