"""Exponential indicators of new days from what is kept of a company, without its history.

Smoothing is an affine recurrence, so all that earlier prices say of later ones is the last price and, for each average,
its value, the weight that has faded since its last observation, and how many observations it has had. That state is a row
a company. A new day costs a row a company, and any cut of the history gives what one pass over all of it gives.

Many companies take a step at once: a task gets its companies one after the other, each in order of its days, and moves
the first days of some hundred thousand rows' companies, then the second days, and so on, as numpy columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.functions.shared import stage

SMOOTHED = ("ema20", "ema50", "rsi14", "macd", "macd_signal", "macd_histogram", "atr14", "adx14")
#: Weight of a new value and least observations of each average.
AVERAGES = {
    "ema20": (2 / 21, 20), "ema50": (2 / 51, 50), "ema12": (2 / 13, 12), "ema26": (2 / 27, 26), "signal": (0.2, 9),
    "gain": (1 / 14, 14), "loss": (1 / 14, 14), "range": (1 / 14, 14), "plus": (1 / 14, 14), "minus": (1 / 14, 14), "dx": (1 / 14, 14),
}
#: A task smooths so many rows at once, or one company's if those are more.
ROWS = 200_000
#: The averages of prices, and those of other averages.
_FIRST = [i for i, c in enumerate(AVERAGES) if c not in ("signal", "dx")]
_ALPHA = np.array([[a] for a, _ in AVERAGES.values()])
_LEAST = np.array([[n] for _, n in AVERAGES.values()])


class Smoother:
    """The averages of companies, a column each. A company's state is a flat list: last high, low and close, then three
    numbers for each average, which are its value, the weight that has faded since its last observation, and how many it had."""

    def __init__(self, companies: int):
        self.last = np.full((3, companies), np.nan)
        self.value = np.full((len(AVERAGES), companies), np.nan)
        self.weight = np.ones((len(AVERAGES), companies))
        self.n = np.zeros((len(AVERAGES), companies))

    def load(self, company: int, state: list[float]) -> None:
        self.last[:, company] = state[:3]
        self.value[:, company], self.weight[:, company], self.n[:, company] = state[3::3], state[4::3], state[5::3]

    def state(self, companies: np.ndarray) -> np.ndarray:
        """A row for each of some companies."""
        averages = np.stack([self.value[:, companies], self.weight[:, companies], self.n[:, companies]], axis=1)
        return np.concatenate([self.last[:, companies], averages.reshape(-1, len(companies))]).T

    def average(self, which: list[int], x: np.ndarray) -> np.ndarray:
        """Some averages of the first companies after x; NaN is no observation, but the weight of what is there fades."""
        k, alpha = x.shape[1], _ALPHA[which]
        value, weight = self.value[which, :k], self.weight[which, :k]
        there, had = x == x, value == value
        faded = np.where(had, weight * (1 - alpha), weight)
        moved = np.where(value != x, (faded * value + alpha * x) / (faded + alpha), value)
        value = np.where(there, np.where(had, moved, x), value)
        n = self.n[which, :k] + there
        self.value[which, :k], self.weight[which, :k], self.n[which, :k] = value, np.where(there & had, 1.0, faded), n
        return np.where(n >= _LEAST[which], value, np.nan)

    def step(self, high: np.ndarray, low: np.ndarray, close: np.ndarray) -> np.ndarray:
        """The indicators SMOOTHED of the first companies after a day's prices."""
        k = len(close)
        was_high, was_low, was = self.last[:, :k].copy()
        self.last[:, :k] = high, low, close
        move = close - was
        up, down = high - was_high, was_low - low
        spans = np.fmax(np.fmax(high - low, np.abs(high - was)), np.abs(low - was))
        plus_move, minus_move = np.where((up > down) & (up > 0), up, 0.0), np.where((down > up) & (down > 0), down, 0.0)
        ema20, ema50, ema12, ema26, gain, loss, atr, plus, minus = self.average(_FIRST, np.array([close, close, close, close, np.maximum(move, 0.0), np.maximum(-move, 0.0), spans, plus_move, minus_move]))
        macd, plus, minus = ema12 - ema26, 100 * plus / atr, 100 * minus / atr
        both = plus + minus
        signal, adx = self.average(_SECOND, np.array([macd, 100 * np.abs(plus - minus) / np.where(both != 0, both, np.nan)]))
        found = np.array([ema20, ema50, np.where(loss == 0, 100.0, 100 - 100 / (1 + gain / loss)), macd, signal, macd - signal, atr, adx])
        found[np.isinf(found)] = np.nan
        return found


_SECOND = [i for i in range(len(AVERAGES)) if i not in _FIRST]


def _whole_companies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in order, in tables of about ROWS rows that cut no company in two; _n is a row's number in its company."""
    held: list[pa.RecordBatch] = []
    rows, full = 0, ROWS
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= full:
            both = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(both.column("_n").to_numpy() == 1)[-1])
            if cut:
                yield both.slice(0, cut)
            held, rows = both.slice(cut).to_batches(), both.num_rows - cut
            full = max(ROWS, 2 * rows)
    if rows:
        yield pa.Table.from_batches(held)


def _smooth(rows: pa.Table, with_state: bool) -> pa.Table:
    """The rows' indicators; with_state: rows may begin with a state, and a company's last row gets its state."""
    number = rows.column("_n").to_numpy()
    starts = np.flatnonzero(number == 1)
    lengths = np.diff(np.append(starts, len(number)))
    assert starts[0] == 0 and (number == np.arange(len(number)) - np.repeat(starts, lengths) + 1).all(), "rows of a company must follow each other"
    # the longest first, so that those with a row left are always the first ones
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    smoother = Smoother(len(starts))
    prices = np.array([rows.column(c).to_numpy() for c in ("high", "low", "close")])
    found = np.full((len(SMOOTHED), len(number)), np.nan)
    told = np.zeros(len(number), dtype=bool)
    if with_state:
        told = ~rows.column("state").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        for company in np.flatnonzero(told[starts]):
            smoother.load(company, rows.column("state")[int(starts[company])].as_py())
    with np.errstate(all="ignore"):
        # days from 1 on, or from the row after the state: a company with a state starts a step later
        skip = told[starts].astype(np.int64)
        for t in range(int(lengths[0])):
            k = int(np.searchsorted(-lengths, -t, side="left"))
            at = starts[:k] + t
            if t == 0 and skip.any():
                kept = smoother.last.copy(), smoother.value.copy(), smoother.weight.copy(), smoother.n.copy()
            found[:, at] = smoother.step(*prices[:, at])
            if t == 0 and skip.any():
                for now, before in zip((smoother.last, smoother.value, smoother.weight, smoother.n), kept):
                    now[:, skip == 1] = before[:, skip == 1]
                found[:, at[skip == 1]] = np.nan
    out = {"company_id": rows.column("company_id"), "trade_date": rows.column("trade_date"), **{c: pa.array(x, from_pandas=True) for c, x in zip(SMOOTHED, found)}}
    if not with_state:
        return pa.table(out)
    last = starts + lengths - 1
    offsets = np.zeros(len(number) + 1, dtype=np.int32)
    width = 3 + 3 * len(AVERAGES)
    offsets[last + 1] = width
    absent = np.ones(len(number), dtype=bool)
    absent[last] = False
    states = smoother.state(np.arange(len(starts)))[np.argsort(last)]
    made = pa.ListArray.from_arrays(pa.array(np.cumsum(offsets, dtype=np.int32)), pa.array(states.ravel()), mask=pa.array(absent))
    # a state that nothing follows is kept, as a row that is no day
    return pa.table({**out, "state": made, "_new": pa.array(~told)}).filter(pa.array(~told | ~absent))


_SCHEMA = "company_id long, trade_date date, " + ", ".join(f"{c} double" for c in SMOOTHED)


def _line(rows: DataFrame, *order: str, by: tuple[str, ...] = ("company_id",)) -> DataFrame:
    """rows with their number in their company, by whose window they lie company by company and in order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def smoothed_beside(prices: DataFrame, by: tuple[str, ...] = ("company_id",)) -> DataFrame:
    """prices, with all their columns, and the columns SMOOTHED; a line of days is of one value of `by`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_companies(batches):
            found = _smooth(rows, False)
            for c in SMOOTHED:
                rows = rows.append_column(c, found.column(c))
            yield from rows.drop_columns(["_n"]).to_batches()

    double = {c: F.col(c).cast("double") for c in ("high", "low", "close")}
    schema = StructType([*prices.withColumns(double).schema.fields, *[StructField(c, DoubleType()) for c in SMOOTHED]])
    return _line(prices.withColumns(double), "trade_date", by=by).mapInArrow(run, schema)


def smoothed(prices: DataFrame) -> DataFrame:
    """Exponential averages, RSI, MACD with signal and histogram, ATR and ADX, after Wilder where he smooths."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_companies(batches):
            yield from _smooth(rows, False).to_batches()

    double = [F.col(c).cast("double").alias(c) for c in ("high", "low", "close")]
    return _line(prices.select("company_id", "trade_date", *double), "trade_date").mapInArrow(run, _SCHEMA)


def smooth_on(prices: DataFrame, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, state): the indicators of prices, and (company_id, trade_date, state) of each company after them.

    prices are days after those that state (company_id, state) tells of; without a state they are all there is. A company
    without new prices keeps its state, with the date that it had. Only the new days are read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_companies(batches):
            yield from _smooth(rows, True).to_batches()

    double = [F.col(c).cast("double").alias(c) for c in ("high", "low", "close")]
    days = prices.select("company_id", "trade_date", *double, F.lit(None).cast("array<double>").alias("state"))
    if state is not None:
        days = days.unionByName(state.select("company_id", "trade_date", "state"), allowMissingColumns=True)
    # a state comes before the days
    line = _line(days.withColumn("_day", F.col("state").isNull()), "_day", "trade_date").drop("_day")
    whole = stage(line.mapInArrow(run, f"{_SCHEMA}, state array<double>, _new boolean"), "smoothed")
    return whole.where("_new").select("company_id", "trade_date", *SMOOTHED), whole.where("state IS NOT NULL").select("company_id", "trade_date", "state")
