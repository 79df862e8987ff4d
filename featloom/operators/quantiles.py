"""Quantile bounds of many columns, approximate or exact."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from featloom.specs import BandSpec

# Exact selection: accuracy of the sketch in each narrowing pass, and the number
# of values between two bounds up to which they are sorted as one array.
_NARROWING_ACCURACY = 500
_SORTABLE_VALUES = 10_000


def quantile_bounds(
    df: DataFrame, columns: Sequence[str], band: BandSpec
) -> dict[str, tuple[float, float]]:
    """Lower and upper quantile per column, all columns in the same jobs.

    An approximate call is one job; what a task sends on is a sketch whose size
    depends on the error, not on the rows. Null and NaN are ignored. A column
    without any value is an error.
    """
    probabilities = [band.lower, band.upper]
    if band.relative_error == 0:
        found = exact_quantiles(df, columns, probabilities)
    else:
        lists = df.stat.approxQuantile(list(columns), probabilities, band.relative_error)
        found = dict(zip(columns, lists))
    empty = [c for c in columns if not found[c]]
    if empty:
        raise ValueError(f"no values to take quantiles of in {', '.join(empty)}")
    return {c: (found[c][0], found[c][1]) for c in columns}


def _around(fractions: Sequence[float]) -> list[float]:
    """Fractions whose approximate quantiles lie on both sides of the given ones."""
    slack = 2.0 / _NARROWING_ACCURACY
    return [min(1.0, max(0.0, f + s)) for f in fractions for s in (-slack, slack)]


def _cuts() -> int:
    """Parts that the candidates between two values are cut into, for the pass after."""
    return _NARROWING_ACCURACY // 2


def _few(candidates: int) -> bool:
    """Whether few enough of them lie between two values around the wanted one: the
    slack on both sides, or two parts, and the sketch's error."""
    return candidates * 6 / _NARROWING_ACCURACY <= _SORTABLE_VALUES


def _sketch(values: Column, fractions: Sequence[float]) -> Column:
    return F.percentile_approx(values, _around(fractions), _NARROWING_ACCURACY)


@dataclass
class _Search:
    """One wanted order statistic, known to lie strictly between low and high."""

    column: str
    rank: int  # wanted position, from 1, among the values in between
    inside: int  # how many values are in between
    low: float | None = None
    high: float | None = None
    answer: float | None = None
    ends: tuple[float, float] | None = None  # values on both sides of the wanted one

    def inside_window(self) -> Column:
        """Whether the column's value is still a candidate. NaN is above everything, so
        it has to be kept out only while there is no upper bound."""
        value = F.col(self.column).cast("double")
        keep = value.isNotNull() & ~F.isnan(value)
        if self.low is not None:
            keep &= value > self.low
        if self.high is not None:
            keep &= value < self.high
        return keep

    def values(self) -> Column:
        """The column's value where it is still a candidate, else null."""
        return F.when(self.inside_window(), F.col(self.column).cast("double"))

    def sizes(self, low: float, high: float) -> Column:
        """Exact numbers of candidates below, at, between, at and above the two."""
        v = self.values()
        return F.array(
            F.count_if(v < low),
            F.count_if(v == low),
            F.count_if((v > low) & (v < high)),
            F.count_if((v == high) & F.lit(high > low)),
            F.count_if(v > high),
        )

    def ahead(self, low: float, high: float) -> Column:
        """What the next pass needs if the answer lies between the two, as it nearly
        always does: those values, if the sketch's error leaves few of them, or else
        cut points spread evenly over them."""
        v = self.values()
        between = F.when((v > low) & (v < high), v)
        if _few(self.inside):
            return F.sort_array(F.collect_list(between))
        return F.percentile_approx(between, [i / _cuts() for i in range(_cuts() + 1)], _NARROWING_ACCURACY)

    def narrow(self, low: float, high: float, sizes: Sequence[int], ahead: Sequence[float] | None) -> None:
        """Go on with the part the wanted rank falls into."""
        gathered = _few(self.inside)
        parts = [(self.low, low), low, (low, high), high, (high, self.high)]
        self.ends = None
        for place, (part, size) in enumerate(zip(parts, sizes)):
            if self.rank > size:
                self.rank -= size
            elif isinstance(part, tuple):
                if place == 2 and gathered:
                    self.answer = ahead[self.rank - 1]
                elif place == 2:
                    at = self.rank / size * _cuts()
                    self.ends = (ahead[max(0, math.floor(at - 0.5))], ahead[min(_cuts(), math.ceil(at + 0.5))])
                self.low, self.high = part
                self.inside = size
                return
            else:
                self.answer = part
                return


def _windows(searches: Sequence[_Search]) -> Column:
    """Rows that hold a candidate of any search: plain comparisons, so that a scan
    skips the row groups without any. NaN may be left to ``values``."""

    def window(s: _Search) -> Column:
        value = F.col(s.column).cast("double")
        bounds = ([value > s.low] if s.low is not None else []) + ([value < s.high] if s.high is not None else [])
        return reduce(and_, bounds)

    return reduce(or_, map(window, searches))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """The value at rank ``ceil(p * n)`` of each column, for each probability.

    Neither sorts the table nor gathers its values in one place. The first pass counts
    the values and takes two approximate quantiles around each wanted rank. Every
    further pass counts exactly on which side of the two the rank falls and, in the
    same aggregate, gets ready what comes next: the values between the two, if there
    can be no more than a fixed number, or finer cut points among them. A pass leaves
    about one hundredth of the candidates, so 800,000 rows take two passes, and each
    hundredfold one more. Values that many rows share are settled by the count. The
    passes are aggregates over the named columns, shared by all searches, and from the
    third on over the rows of their windows only.
    """
    everything = {c: _Search(c, 1, 1).values() for c in columns}
    first = df.agg(
        *[F.count(v).alias(f"n_{c}") for c, v in everything.items()],
        *[_sketch(v, probabilities).alias(f"q_{c}") for c, v in everything.items()],
    ).first()
    searches = []
    for c in columns:
        n, ends = first[f"n_{c}"], first[f"q_{c}"]
        for i, p in enumerate(probabilities if n else []):
            searches.append(_Search(c, max(1, math.ceil(p * n)), n, ends=tuple(ends[2 * i : 2 * i + 2])))

    while pending := [s for s in searches if s.answer is None]:
        # Only if the sketch was wrong has a search no ends to go on with.
        if lost := [s for s in pending if s.ends is None]:
            sketches = [_sketch(s.values(), [s.rank / s.inside]) for s in lost]
            row = df.agg(*[q.alias(f"s{i}") for i, q in enumerate(sketches)]).first()
            for search, ends in zip(lost, row):
                search.ends = tuple(ends)
        known = [s.ends for s in pending]
        rows = df if any(s.low is None and s.high is None for s in pending) else df.where(_windows(pending))
        row = rows.agg(
            *[s.sizes(*ends).alias(f"s{i}") for i, (s, ends) in enumerate(zip(pending, known))],
            *[s.ahead(*ends).alias(f"a{i}") for i, (s, ends) in enumerate(zip(pending, known))],
        ).first()
        for i, (search, ends) in enumerate(zip(pending, known)):
            search.narrow(*ends, row[f"s{i}"], row[f"a{i}"])
    return {c: [s.answer for s in searches if s.column == c] for c in columns}
