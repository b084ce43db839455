"""One gated recurrent cell for all series, trained on windows by all tasks at once.

The cell reads a window step by step and its last state corrects the newest price:
``y = x[-1, 0] + state · readout + bias``. Every round each task adds up the gradient of the mean
squared error over its windows; tasks' sums are added in a tree, and only the last few
reach the driver, which takes an Adam step on a few hundred weights. A round reads the
staged windows anew, so a lost executor costs its tasks and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.staging import spread, stage
from .features import GROUP, build_sequences, normalise, scaler_parameters
from .forecast import fit_gate
from .window_model import WINDOW_FEATURES, last_windows, priced

#: Windows that a task holds states of at a time.
BATCH = 1024
#: Sums of tasks that one task of the next level of the tree adds up.
FAN = 16


@dataclass(frozen=True)
class Cell:
    """Weights in one array: of inputs, of states and biases for the update, reset and new
    gates side by side, then readout and bias."""

    inputs: int
    hidden: int
    weights: np.ndarray

    @classmethod
    def start(cls, inputs: int, hidden: int, seed: int = 42) -> Cell:
        """Small random weights; the readout is zero: the forecast begins as the newest price."""
        random = np.random.default_rng(seed)
        made = random.normal(0, 1, (inputs + hidden, 3 * hidden)) / np.sqrt(inputs + hidden)
        return cls(inputs, hidden, np.concatenate([made.ravel(), np.zeros(4 * hidden + 1)]))

    def parts(self, flat: np.ndarray) -> tuple[np.ndarray, ...]:
        """Views of an array of weights, or of their gradient."""
        f, h = self.inputs, self.hidden
        a, b = f * 3 * h, (f + h) * 3 * h
        return flat[:a].reshape(f, 3 * h), flat[a:b].reshape(h, 3 * h), flat[b : b + 3 * h], flat[b + 3 * h : -1], flat[-1:]

    def states(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """State before, update, reset and new gates, and state after, of every step."""
        w, u, bias, _, _ = self.parts(self.weights)
        h = self.hidden
        state = np.zeros((len(x), h))
        for t in range(x.shape[1]):
            pre = x[:, t] @ w + bias
            both = 1 / (1 + np.exp(-(pre[:, : 2 * h] + state @ u[:, : 2 * h])))
            update, reset = both[:, :h], both[:, h:]
            new = np.tanh(pre[:, 2 * h :] + (reset * state) @ u[:, 2 * h :])
            after = (1 - update) * new + update * state
            yield state, update, reset, new, after
            state = after

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The next value after each of windows ``x`` (window, step, feature)."""
        *_, readout, bias = self.parts(self.weights)
        for *_, state in self.states(x):
            pass
        return x[:, -1, 0] + state @ readout + bias

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """Sum of squared errors over the windows, and its derivative by every weight."""
        w, u, _, readout, bias = self.parts(self.weights)
        h, steps = self.hidden, list(self.states(x))
        error = x[:, -1, 0] + steps[-1][-1] @ readout + bias - y
        out = np.zeros_like(self.weights)
        dw, du, db, dreadout, dbias = self.parts(out)
        dreadout += 2 * error @ steps[-1][-1]
        dbias += 2 * error.sum()
        back = 2 * error[:, None] * readout
        for t in range(x.shape[1] - 1, -1, -1):
            state, update, reset, new, _ = steps[t]
            to_new = back * (1 - update) * (1 - new * new)
            to_update = back * (state - new) * update * (1 - update)
            through = to_new @ u[:, 2 * h :].T
            to_reset = through * state * reset * (1 - reset)
            gates = np.hstack([to_update, to_reset])
            dw += x[:, t].T @ np.hstack([gates, to_new])
            db += np.hstack([gates, to_new]).sum(0)
            du[:, : 2 * h] += state.T @ gates
            du[:, 2 * h :] += (reset * state).T @ to_new
            back = back * update + through * reset + gates @ u[:, : 2 * h].T
        return float(error @ error), out


def _windows(column: pa.Array, inputs: int) -> np.ndarray:
    """Arrow's nested lists of equal lengths as (window, step, feature)."""
    flat = column.flatten().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1, inputs)


def _added(rows: DataFrame) -> DataFrame:
    """Rows of ``n`` and ``sums`` of one task as one row."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for count, sums in zip(batch.column("n").to_pylist(), batch.column("sums")):
                own = sums.values.to_numpy(zero_copy_only=False)
                n, total = n + count, own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"n": [n], "sums": [total]})

    return rows.mapInArrow(add, "n long, sums array<double>")


def total_gradient(windows: DataFrame, cell: Cell) -> tuple[int, float, np.ndarray]:
    """Number of windows, sum of squared errors and gradient over all of ``x, y``.

    A task of each level adds up ``FAN`` tasks of the level below; the driver gets at most
    ``FAN`` rows of a few hundred numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(len(cell.weights) + 1)
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.slice(at, BATCH)
                x, y = _windows(part.column("x"), cell.inputs), part.column("y").to_numpy(zero_copy_only=False)
                loss, own = cell.gradient(x, y)
                n, total = n + len(y), total + np.append(own, loss)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "sums": [total]})

    sums = windows.select("x", "y").mapInArrow(run, "n long, sums array<double>")
    width = windows.rdd.getNumPartitions()
    while width > FAN:
        width = -(-width // FAN)
        sums = _added(sums.repartition(width))
    rows = sums.collect()
    total = np.sum([r.sums for r in rows], axis=0) if rows else np.zeros(len(cell.weights) + 1)
    return sum(r.n for r in rows), float(total[-1]), total[:-1]


def fit_recurrent(
    features: DataFrame, length: int = 60, hidden: int = 8, rounds: int = 120, rate: float = 0.02,
    seed: int = 42, penalty: float = 1e-4,
) -> Cell:
    """A cell trained by ``rounds`` steps of Adam on every window of every series.

    The default number of rounds was chosen on the made-up series of its test. Without any window the cell stays as it starts: it forecasts the newest price.
    """
    if "price_norm" not in features.columns:
        features = normalise(features)
    names = ["price_norm", *[c for c in WINDOW_FEATURES if c in features.columns]]
    windows = stage(spread(build_sequences(features, length, "price_norm", WINDOW_FEATURES).select("x", "y").where("y is not null")), "windows")
    cell = Cell.start(len(names), hidden, seed)
    mean, square = np.zeros_like(cell.weights), np.zeros_like(cell.weights)
    for step in range(1, rounds + 1):
        n, _, sums = total_gradient(windows, cell)
        if not n:
            return cell
        slope = sums / n + penalty * cell.weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
        move = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        cell = replace(cell, weights=cell.weights - rate * move)
    return cell


def predict_recurrent(cell: Cell, features: DataFrame, horizon: int = 12, length: int = 60) -> DataFrame:
    """Feeds each prediction back as the newest price; other features keep their last value."""
    if "price_norm" not in features.columns:
        features = normalise(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.slice(at, BATCH)
                x, path = _windows(part.column("x"), cell.inputs), []
                for _ in range(horizon):
                    path.append(cell.predict(x))
                    newest = x[:, -1:].copy()
                    newest[:, 0, 0] = path[-1]
                    x = np.concatenate([x[:, 1:], newest], axis=1)
                columns = [part.column(c) for c in (*GROUP, "last_date")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(np.array(path).T))], [*GROUP, "last_date", "path"])

    seeds = spread(last_windows(features, length), *GROUP)
    kinds = ", ".join(f"`{c}` {seeds.schema[c].dataType.simpleString()}" for c in (*GROUP, "last_date"))
    paths = seeds.select(*GROUP, "last_date", "x").mapInArrow(run, f"{kinds}, path array<double>")
    return priced(paths, scaler_parameters(features), horizon)


def forecast_recurrent(features: DataFrame, horizon: int = 12, length: int = 60, **settings) -> DataFrame:
    """Trains on every series with at least 24 rows, then forecasts those with a full window."""
    rows = fit_gate(features)
    return predict_recurrent(fit_recurrent(rows, length, **settings), rows, horizon, length)


def save_cell(spark: SparkSession, cell: Cell, path: str) -> None:
    row = [(cell.inputs, cell.hidden, cell.weights.tolist())]
    spark.createDataFrame(row, "inputs int, hidden int, weights array<double>").write.mode("overwrite").parquet(path)


def load_cell(spark: SparkSession, path: str) -> Cell:
    row = spark.read.parquet(path).first()
    return Cell(row.inputs, row.hidden, np.array(row.weights))
