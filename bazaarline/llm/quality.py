"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded; a
gated attention (tanh of one projection times the sigmoid of another) learned from the
document labels weighs the passages; the weighted mean of their codes is scored. The
model is fitted on a bounded sample and scores every passage of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Words in a passage.
WORDS = 50
#: Byte classes: a-z, A-Z, digits, space, sentence marks, other ASCII, beyond ASCII.
CLASSES = 7
FEATURES = CLASSES + 6


def byte_classes() -> np.ndarray:
    out = np.full(256, 5, "u1")
    for number, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b".,;:?'\"()-")):
        out[list(chars)] = number
    out[128:] = 6
    return out


CLASS_OF = byte_classes()


def passages(text: str | None, words: int = WORDS) -> np.ndarray:
    """Features of all passages of a whole text; a text without words is one empty passage."""
    tokens = (text or "").encode("utf-8").split()
    out = np.zeros((max(1, -(-len(tokens) // words)), FEATURES))
    for row, at in enumerate(range(0, len(tokens), words)):
        part = tokens[at : at + words]
        joined, n = b" ".join(part), len(part)
        out[row, :CLASSES] = np.bincount(CLASS_OF[np.frombuffer(joined, "u1")], minlength=CLASSES) / len(joined)
        again = sum(a == b for a, b in zip(part, part[1:]))
        lone = sum(map(bytes.isalnum, part))
        out[row, CLASSES:] = (
            len(joined) / n / 10,
            len(set(part)) / n,
            again / n,
            lone / n,
            sum(map(bytes.isupper, part)) / n,
            np.log1p(n) / 4,
        )
    return out


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Passages of several texts in a row, and where each text's begin."""
    parts = [passages(t) for t in texts]
    starts = np.cumsum([0, *(len(p) for p in parts)])[:-1]
    return np.concatenate(parts), starts


@dataclass
class Model:
    """Weights; ``prior`` alone scores where no two classes were there to learn from."""

    prior: float
    weights: dict[str, np.ndarray] | None = None

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        bag = np.repeat(np.arange(len(starts)), np.diff([*starts, len(x)]))
        h = np.tanh((x - w["mean"]) / w["scale"] @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
        s = (t * g) @ w["a"]
        e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        attention = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(attention[:, None] * h, starts, axis=0)
        return {"bag": bag, "h": h, "t": t, "g": g, "attention": attention, "z": z, "p": sigmoid(z @ w["c"] + w["d"])}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        return self.forward(*bags(texts))["p"]


def sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -50, 50)))


def train(x: np.ndarray, starts: np.ndarray, y: np.ndarray, hidden: int = 16, gate: int = 8, steps: int = 300, rate: float = 0.03, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam on the cross entropy of the bags, both classes weighing the same."""
    prior = float((y.sum() + 1) / (len(y) + 2))
    if len(np.unique(y)) < 2:
        return Model(prior)
    rng = np.random.default_rng(seed)
    shapes = {"W": (FEATURES, hidden), "b": hidden, "V": (hidden, gate), "U": (hidden, gate), "a": gate, "c": hidden, "d": 1}
    w = {k: rng.normal(0, 0.3, shape) for k, shape in shapes.items()}
    w["b"][:], w["d"][:] = 0, 0
    model = Model(prior, w | {"mean": x.mean(0), "scale": x.std(0) + 1e-6})
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    normal = (x - model.weights["mean"]) / model.weights["scale"]
    for step in range(1, steps + 1):
        f = model.forward(x, starts)
        bag, h, t, g, attention = f["bag"], f["h"], f["t"], f["g"], f["attention"]
        out = (f["p"] - y) * share
        to_z = out[:, None] * w["c"]
        to_a = (h * to_z[bag]).sum(1)
        to_s = attention * (to_a - np.add.reduceat(attention * to_a, starts)[bag])
        to_t = to_s[:, None] * w["a"] * g * (1 - t**2)
        to_g = to_s[:, None] * w["a"] * t * g * (1 - g)
        to_h = attention[:, None] * to_z[bag] + to_t @ w["V"].T + to_g @ w["U"].T
        to_x = to_h * (1 - h**2)
        slopes = {
            "W": normal.T @ to_x, "b": to_x.sum(0), "V": h.T @ to_t, "U": h.T @ to_g,
            "a": (t * g).T @ to_s, "c": f["z"].T @ out, "d": out.sum(keepdims=True),
        }
        for k, slope in slopes.items():
            slope = slope + decay * w[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            model.weights[k] = w[k]
    return model


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 3; 1 is held out. Null keys: null."""
    return F.crc32(F.col(key).cast("string")) % 3


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = 2000, passages_each: int = 200,
) -> Model:
    """Fit on at most ``sample`` labelled documents of each class outside the held-out fold.

    The documents are those of the smallest key hashes; of a longer one every n-th passage
    is taken so that at most ``passages_each`` are. These bounds hold for the fit alone.
    Null or other labels and unknown keys are passed over. Without both classes the model is
    the share of label 1 (one added to each class).
    """
    known = labels.where((fold(key) != 1) & F.col(label).isin(0, 1)).select(F.col(key).alias("_k"), F.col(label).alias("_y"))
    known = known.join(docs.select(F.col(key).alias("_k")), "_k", "left_semi")
    order = F.xxhash64("_k")
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("_y") == value).orderBy(order, "_k").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(F.broadcast(chosen), "_k")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [passages(t.as_py()) for t in batch.column("_t")]
            x = [p[:: -(-len(p) // passages_each)] for p in x]
            lists = pa.array([p.ravel() for p in x], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("_k"), batch.column("_y"), lists], ["_k", "_y", "x"])

    kind = docs.schema[key].dataType.simpleString()
    found = rows.select("_k", F.col("_y").cast("int"), "_t").mapInArrow(features, f"_k {kind}, _y int, x array<double>")
    table = found.orderBy("_k", "_y", "x").limit(2 * sample).toArrow()
    if not table.num_rows:
        return Model(0.5)
    parts = [np.array(v).reshape(-1, FEATURES) for v in table.column("x").to_pylist()]
    starts = np.cumsum([0, *(len(p) for p in parts)])[:-1]
    return train(np.concatenate(parts), starts, np.array(table.column("_y").to_pylist(), "f8"))


def score(model: Model, text: Column | str, block: int = 256) -> Column:
    """Probability of label 1 from a whole text alone; null texts are empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made = [model.scores(batch.slice(at, block).to_pylist()) for at in range(0, len(batch), block)]
            yield pa.array(np.concatenate([np.empty(0), *made]), pa.float64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(F.col(text) if isinstance(text, str) else text)
