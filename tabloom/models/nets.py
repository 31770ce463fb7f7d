"""A feed-forward net trained by minibatches: shards of rows take their steps in tasks, the driver averages the weights.

Rows are dealt to shards of bounded size by the hash of their key and written, a shard in one row. An
epoch is one job whatever the number of batches: each task takes Adam's steps over its shards from the
weights of the epoch before, and weights and moments are averaged by rows.
The weights after every epoch are kept, so one pass over a test table gives the whole curve.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..session import ship_package, written

# fixed values: Adam's published defaults
BETA_1, BETA_2, TINY = 0.9, 0.999, 1e-8
SHARD_VALUES = 500_000  # features of all rows of a shard, about
STATE = ["weights", "first", "second"]
LOSS, ROWS = -1, -2  # places of the loss and of the number of rows among the sums


@dataclass(frozen=True)
class Shape:
    """Sizes of the layers, from the features to the classes."""

    sizes: tuple[int, ...]

    def __len__(self) -> int:
        return sum((a + 1) * b for a, b in zip(self.sizes, self.sizes[1:], strict=False))

    def start(self, seed: int) -> np.ndarray:
        """Weights and biases, uniform within 1 / sqrt(inputs)."""
        rng, parts = np.random.default_rng(seed), []
        for a, b in zip(self.sizes, self.sizes[1:], strict=False):
            parts.append(rng.uniform(-1, 1, (a + 1) * b) / np.sqrt(a))
        return np.concatenate(parts)

    def layers(self, weights: np.ndarray) -> list[np.ndarray]:
        """One matrix per layer; its last row is the bias."""
        out, at = [], 0
        for a, b in zip(self.sizes, self.sizes[1:], strict=False):
            out.append(weights[at : at + (a + 1) * b].reshape(a + 1, b))
            at += (a + 1) * b
        return out

    def forward(self, weights: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """What each layer gives: rectified, but for the last."""
        out, layers = [x], self.layers(weights)
        for k, w in enumerate(layers):
            z = out[-1] @ w[:-1] + w[-1]
            out.append(np.maximum(z, 0) if k + 1 < len(layers) else z)
        return out

    def probabilities(self, weights: np.ndarray, x: np.ndarray) -> np.ndarray:
        z = self.forward(weights, x)[-1]
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def gradient(self, weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Sums over the rows of the cross-entropy's gradient, and of the cross-entropy."""
        out, layers = self.forward(weights, x), self.layers(weights)
        z = out[-1] - out[-1].max(1, keepdims=True)
        log_p = z - np.log(np.exp(z).sum(1, keepdims=True))
        back = np.exp(log_p)
        back[np.arange(len(y)), y] -= 1
        parts = []
        for k in reversed(range(len(layers))):
            parts.append(np.concatenate([(out[k].T @ back), back.sum(0)[None, :]]).ravel())
            if k:
                back = (back @ layers[k][:-1].T) * (out[k] > 0)
        return np.concatenate(parts[::-1]), float(-log_p[np.arange(len(y)), y].sum())


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().astype(float).reshape(len(batch), -1)


class Net:
    """ReLU layers and softmax, Adam on batches of about `batch` rows, for `epochs` passes.

    `vector` is a column of scaled features, `label` holds 0 .. classes - 1, and `key` names the
    columns that tell rows apart. Rows are dealt to shards by the hash of their key. In an epoch each
    shard goes through all its batches in one task, from the same weights; then weights and moments are
    averaged, by rows. A table of one shard is trained batch after batch. Batches are dealt anew every
    `deal_every` epochs, and their order changes every epoch. Rows without a label are left out.
    """

    def __init__(
        self, label: str, vector: str, key: str | Sequence[str], classes: int, hidden: Sequence[int] = (32, 16), epochs: int = 100,
        batch: int = 256, rate: float = 0.01, deal_every: int = 10, seed: int = 2026, shard_values: int = SHARD_VALUES,
    ):
        self.label, self.vector, self.key, self.classes, self.hidden = label, vector, key, classes, tuple(hidden)
        self.epochs, self.batch, self.rate, self.deal_every, self.seed = epochs, batch, rate, deal_every, seed
        self.shard_values = shard_values

    def fit(self, df: DataFrame) -> FittedNet:
        ship_package(df.sparkSession)
        rows = df.where(F.col(self.label).isNotNull()).select(
            vector_to_array(self.vector).alias("x"), F.col(self.label).cast("int").alias("y"), digest(self.key, "deal").alias("id")
        )
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
        if not found["n"]:
            raise ValueError("there are no rows to learn from")
        shape = Shape((found["width"], *self.hidden, self.classes))
        shards = self._shards(rows, max(1, -(-found["n"] * found["width"] // self.shard_values)))
        state, steps = [shape.start(self.seed), np.zeros(len(shape)), np.zeros(len(shape))], 0
        curve, losses = [], []
        for epoch in range(self.epochs):
            parts = self._epoch(shards, shape, state, steps, epoch)
            n = sum(p["n"] for p in parts)
            state = [sum(np.array(p[c]) for p in parts) / n for c in STATE]
            steps = max(p["steps"] for p in parts)
            curve.append(state[0])
            losses.append(sum(p["loss"] for p in parts) / n)
        return FittedNet(shape, self.vector, curve, losses)

    def _shards(self, rows: DataFrame, shards: int) -> DataFrame:
        """(shard, n, blob): the rows of a shard as one row, in the order of their hash, so that no task gets part of a shard."""

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if len(b)]
            if not held:
                return
            whole = pa.concat_batches(held)
            numbers = whole.column(3).to_numpy()
            for k in np.unique(numbers):
                part = whole.filter(pa.array(numbers == k))
                n, x = len(part), _matrix(part, 0)
                y, ids = part.column(1).to_numpy(), part.column(2).to_numpy(zero_copy_only=False).astype(str)
                order = np.lexsort((*x.T, y, ids))  # rows with equal keys, too, lie in one order
                blob = x[order].tobytes() + y[order].astype(np.int32).tobytes()
                columns = [pa.array([int(k)], pa.int32()), pa.array([n], pa.int64()), pa.array([blob], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "n", "blob"])

        shard = F.pmod(F.xxhash64("id", F.lit(self.seed)), F.lit(shards)).cast("int").alias("shard")
        dealt = rows.select("x", "y", "id", shard).repartitionById(shards, "shard")
        return written(dealt.mapInArrow(pack, "shard int, n long, blob binary"), "shards")

    def _epoch(self, shards: DataFrame, shape: Shape, state: list[np.ndarray], steps: int, epoch: int) -> list[Row]:
        """What each task's shards make of weights and moments, times their rows; loss, rows and the steps done."""
        batch, rate, seed, deal = self.batch, self.rate, self.seed, epoch - epoch % self.deal_every

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, loss, rows, most = np.zeros((3, len(shape))), 0.0, 0, 0
            for part in parts:
                for k, n, blob in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    x = np.frombuffer(blob, float, n * shape.sizes[0]).reshape(n, -1)
                    y = np.frombuffer(blob, np.int32, n, x.nbytes)
                    batches = -(-n // batch)
                    dealt = np.array_split(np.random.default_rng([seed, deal, k]).permutation(n), batches)
                    order = np.random.default_rng([seed, epoch, k, 1]).permutation(batches)
                    made, done, lost = _descend(shape, [(x[dealt[i]], y[dealt[i]]) for i in order], state, steps, rate)
                    sums, loss, rows, most = sums + n * np.stack(made), loss + lost, rows + n, max(most, done)
            if rows:
                columns = [*[pa.array([s], pa.list_(pa.float64())) for s in sums], pa.array([loss]), pa.array([rows]), pa.array([most])]
                yield pa.RecordBatch.from_arrays(columns, [*STATE, "loss", "n", "steps"])

        schema = ", ".join(f"{c} array<double>" for c in STATE) + ", loss double, n long, steps long"
        return shards.mapInArrow(run, schema).collect()


def _descend(
    shape: Shape, batches: Sequence[tuple[np.ndarray, np.ndarray]], state: Sequence[np.ndarray], steps: int, rate: float
) -> tuple[list[np.ndarray], int, float]:
    """Adam's weights and moments after a step for each batch, the number of steps, and the sum of the loss."""
    weights, first, second = state
    loss = 0.0
    for x, y in batches:
        grad, lost = shape.gradient(weights, x, y)
        grad, steps, loss = grad / len(y), steps + 1, loss + lost
        first = BETA_1 * first + (1 - BETA_1) * grad
        second = BETA_2 * second + (1 - BETA_2) * grad * grad
        step = first / (1 - BETA_1**steps) / (np.sqrt(second / (1 - BETA_2**steps)) + TINY)
        weights = weights - rate * step
    return [weights, first, second], steps, loss


def gradient_sums(batch: DataFrame, shape: Shape, weights: np.ndarray) -> dict[int, float]:
    """Sum of the gradient by place, and of LOSS and ROWS, over a table (x, y)."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, n = np.zeros(len(shape)), 0.0, 0
        for b in batches:
            if len(b):
                grad, more = shape.gradient(weights, _matrix(b, 0), b.column(1).to_numpy())
                total, loss, n = total + grad, loss + more, n + len(b)
        if n:
            place = np.concatenate([np.arange(len(shape)), [LOSS, ROWS]])
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array([*total, loss, n], pa.float64())], ["place", "v"])

    sums = batch.where("y is not null").mapInArrow(add_up, "place int, v double").groupBy("place").agg(F.sum("v").alias("v"))
    return {r["place"]: r["v"] for r in sums.collect()}


class FittedNet:
    """The weights after every epoch; `transform` adds prediction and the array probability by the last."""

    def __init__(self, shape: Shape, vector: str, curve: list[np.ndarray], losses: list[float]):
        self.shape, self.vector, self.curve, self.losses = shape, vector, curve, losses

    def transform(self, df: DataFrame) -> DataFrame:
        df = df.drop("prediction", "probability")
        shape, weights = self.shape, self.curve[-1]
        inner = df.withColumn("__x", vector_to_array(self.vector))
        # the vector column stays in the JVM beside its array
        plain = [c for c in df.columns if c != self.vector]
        schema = inner.select(*plain, "__x").schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                p = shape.probabilities(weights, _matrix(b, b.num_columns - 1)) if len(b) else np.zeros((0, shape.sizes[-1]))
                ends = pa.array(np.arange(len(b) + 1, dtype=np.int32) * p.shape[1])
                made = pa.ListArray.from_arrays(ends, pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], made], [*plain, "__x"])

        out = inner.select(*plain, "__x").mapInArrow(run, schema).withColumnRenamed("__x", "probability")
        best = (F.array_position("probability", F.array_max("probability")) - 1).cast("double")
        return out.withColumn("prediction", best)

    def accuracies(self, df: DataFrame, label: str) -> DataFrame:
        """(epoch, rows, accuracy) for every epoch, by one pass over the table."""
        shape, curve = self.shape, self.curve
        rows = df.where(F.col(label).isNotNull()).select(vector_to_array(self.vector).alias("x"), F.col(label).cast("int").alias("y"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            right, n = np.zeros(len(curve), np.int64), 0
            for b in batches:
                if len(b):
                    x, y = _matrix(b, 0), b.column(1).to_numpy()
                    right += [int((shape.forward(w, x)[-1].argmax(1) == y).sum()) for w in curve]
                    n += len(b)
            if n:
                columns = [np.arange(1, len(curve) + 1), np.full(len(curve), n), right]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["epoch", "rows", "hits"])

        counted = rows.mapInArrow(run, "epoch long, rows long, hits long").groupBy("epoch")
        counted = counted.agg(F.sum("rows").alias("rows"), F.sum("hits").alias("hits"))
        return counted.select("epoch", "rows", (F.col("hits") / F.col("rows")).alias("accuracy"))
