"""Exact order statistics without a global sort.

``percent_rank() over (order by x)`` sends every row to one task. What the
scores need are a few order statistics, and those can be selected: count the
values per slice of the value range, keep the slice that holds the wanted
position, cut that slice again. A slice of few rows is counted value by value, which ends the search. Each
round is one partially aggregated count with at most ``SLICES`` groups per open interval and metric, so neither the
driver nor any task ever holds more than that, however the values are distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.columns import MONEY

SLICES = 16384
SCALE = 9  # decimals of the values; inside, they are whole numbers of 10 ** -SCALE
_EXACT = Context(prec=80)


@dataclass
class _Open:
    """One wanted position: it lies among ``rows`` values in [low, high], ``before`` values precede low."""

    metric: str
    position: int
    low: int
    high: int
    before: int
    rows: int


def order_statistics(
    frame: DataFrame,
    metrics: dict[str, Column],
    positions: Callable[[int], Iterable[int]],
    known_only: bool = False,
) -> tuple[int | dict[str, int], dict[str, dict[int, Decimal | None]]]:
    """Row count and, per metric, ``{position: value}`` in ascending order, NULLs first.

    ``metrics`` maps a name to a number of at most nine decimals; ``positions`` maps the row count to the
    wanted zero-based positions. The frame is scanned once per round for all metrics together, so hand in a pinned one when
    it is costly to compute. ``known_only`` leaves NULLs out: counts and positions are then each metric's own.
    """
    values = frame.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(name).alias("metric"), column.cast(MONEY).alias("v"))
                for name, column in metrics.items()
            ])
        ).alias("m")
    ).select("m.metric", "m.v")

    extent = {
        r["metric"]: r
        for r in values.groupBy("metric")
        .agg(F.count("*").alias("n"), F.count("v").alias("known"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()  # one row per metric
    }
    found: dict[str, dict[int, Decimal | None]] = {name: {} for name in metrics}
    pending: list[_Open] = []
    totals = {name: extent[name]["known" if known_only else "n"] if name in extent else 0 for name in metrics}
    for name, total in totals.items():
        nulls = 0 if known_only or not total else total - extent[name]["known"]
        for position in sorted(set(positions(total))) if total else []:
            if position < nulls:
                found[name][position] = None
            else:
                low, high = (_units(extent[name][k]) for k in ("lo", "hi"))
                pending.append(_Open(name, position, low, high, nulls, total - nulls))

    while pending:
        for item in [p for p in pending if p.low == p.high]:
            found[item.metric][item.position] = _value(item.low)
        pending = [p for p in pending if p.low != p.high]
        if pending:
            _narrow(values, pending)
    return totals if known_only else max(totals.values(), default=0), found


def _units(value: Decimal) -> int:
    return int(value.scaleb(SCALE, context=_EXACT))


def _value(units: int) -> Decimal:
    return Decimal(units).scaleb(-SCALE, context=_EXACT)


def _literal(units: int) -> Column:
    return F.lit(_value(units)).cast(MONEY)


def _narrow(values: DataFrame, pending: list[_Open]) -> None:
    """One counting round: shrink every open interval to one of its slices, or to one of its values where they are few."""
    intervals = sorted({(p.metric, p.low, p.high, p.rows) for p in pending})
    interval = slot = None
    for i, (metric, low, high, rows) in enumerate(intervals):
        inside = (F.col("metric") == metric) & F.col("v").between(_literal(low), _literal(high))
        if rows <= SLICES:
            number = F.col("v")
        else:
            number = F.call_function("div", F.col("v") - _literal(low), _literal(_width(low, high))).cast(MONEY)
        interval = F.when(inside, i) if interval is None else interval.when(inside, i)
        slot = F.when(inside, number) if slot is None else slot.when(inside, number)
    counts: dict[int, dict[Decimal, int]] = {i: {} for i in range(len(intervals))}
    grouped = (
        values.select(interval.alias("interval"), slot.alias("slot"))
        .filter(F.col("interval").isNotNull())
        .groupBy("interval", "slot")
        .count()
        .collect()  # at most SLICES rows per open interval
    )
    for r in grouped:
        counts[r["interval"]][r["slot"]] = r["count"]
    for item in pending:
        by_slot = counts[intervals.index((item.metric, item.low, item.high, item.rows))]
        before, width = item.before, _width(item.low, item.high)
        for number in sorted(by_slot):
            if before + by_slot[number] > item.position:
                if item.rows <= SLICES:
                    item.low = item.high = _units(number)
                else:
                    item.low += int(number) * width
                    item.high = min(item.high, item.low + width - 1)
                item.before, item.rows = before, by_slot[number]
                break
            before += by_slot[number]


def _width(low: int, high: int) -> int:
    return (high - low) // SLICES + 1


def rank_cuts(total: int, parts: int = 5) -> list[int]:
    """Positions k with ``percent_rank(x) <= a/parts  <=>  x <= x[k]``, a = 1 .. parts-1."""
    return [a * (total - 1) // parts for a in range(1, parts)]
