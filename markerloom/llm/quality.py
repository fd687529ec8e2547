"""Quality classifier by attention-based multiple-instance learning, trained in numpy.

A document is a bag of passages. Every passage is encoded from its byte counts, hashed byte-pair
counts and how much of it repeats; gated attention weighs the encodings, and the weighted sum is
scored. Only documents carry labels, so the attention weights are learned from those alone.

Training reads a bounded, documented sample: ``train_docs`` labelled documents in hash order and
up to ``train_passages`` passages spread over each. It takes a fixed number of steps, however many
labels there are, and both labels weigh alike. A fifth of the sample is held back from it; there the
scale of the scores is fitted, so that 0.7 lies where both labels, taken as equally frequent, are
equally likely. Scoring reads every passage of every text.

Defined results: a null text counts as empty; an empty text is one empty passage and gets the
score the model gives that; repeated rows are judged each on its own; of rows that repeat a labelled
id the least sampled passages and the least label teach; a row without id teaches nothing and is not
held out; without any labelled row every score is
0.5; a very long text is scored whole, a stretch of passages at a time, by running sums of the
attention; equal scores are not ordered; an empty table gives an empty table; labels that are null
teach nothing; columns other than id, text and label, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markerloom.llm.blocks import hash_sample
from markerloom.llm.language_id import remainder

PASSAGE = 512
PAIRS = 256
#: The score at which a document counts as good.
CUT = 0.7
#: Bytes whose features a task holds at a time: whole passages.
STRETCH = 1024 * PASSAGE


def features(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of the texts, and the number of passages of each text."""
    counts = np.array([max(1, -(-len(p) // PASSAGE)) for p in parts])
    starts = np.concatenate([[0], np.cumsum(counts)])
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    lengths = np.array([len(p) for p in parts])
    first = np.concatenate([[0], np.cumsum(lengths)])
    owner = np.repeat(np.arange(len(parts)), lengths)
    passage = starts[owner] + (np.arange(len(data)) - first[owner]) // PASSAGE
    n = int(starts[-1])
    single = np.bincount(passage * 256 + data, minlength=n * 256).reshape(n, 256)
    code = (data[:-1].astype(np.int64) * 31 + data[1:].astype(np.int64) * 1009) % PAIRS
    same = passage[:-1] == passage[1:]
    double = np.bincount((passage[:-1] * PAIRS + code)[same], minlength=n * PAIRS).reshape(n, PAIRS)
    size = np.maximum(1, single.sum(axis=1, keepdims=True))
    # how many of the byte-pair codes a passage uses: repeated text uses few
    spread = (double > 0).sum(axis=1, keepdims=True) / PAIRS
    return np.concatenate([np.sqrt(single / size), np.sqrt(double / size), spread, np.log1p(size) / 7], axis=1).astype(np.float32), counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionBag:
    """tanh encoder, gated attention (tanh times sigmoid), logistic score of the weighted sum."""

    def __init__(self, inputs: int, hidden: int = 24, gate: int = 12, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.params = {
            "W": rng.normal(0, 1 / np.sqrt(inputs / 8), (inputs, hidden)), "b": np.zeros(hidden), "V": rng.normal(0, 0.3, (hidden, gate)),
            "U": rng.normal(0, 0.3, (hidden, gate)), "w": rng.normal(0, 0.3, gate), "o": rng.normal(0, 0.3, hidden), "c": np.zeros(1),
        }
        self.slope, self.shift = 1.0, 0.0

    def _forward(self, x: np.ndarray, counts: np.ndarray) -> tuple:
        p = self.params
        bag = np.repeat(np.arange(len(counts)), counts)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return bag, first, h, t, g, a, z, _sigmoid(z @ p["o"] + p["c"])

    def margin(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What the score is a sigmoid of, before it is put to scale."""
        return self._forward(x, counts)[6] @ self.params["o"] + self.params["c"]

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x, counts) + self.shift)

    def score_in_stretches(self, data: bytes, stretch: int) -> float:
        """The score of one text of any length, ``stretch`` bytes (whole passages) of features at a time."""
        p, top, total, weighted = self.params, -np.inf, 0.0, 0.0
        for at in range(0, max(1, len(data)), stretch):
            h = np.tanh(features([data[at : at + stretch]])[0] @ p["W"] + p["b"])
            e = (np.tanh(h @ p["V"]) * _sigmoid(h @ p["U"])) @ p["w"]
            before, top = top, max(top, e.max())
            a, shrink = np.exp(e - top), np.exp(before - top)
            total, weighted = total * shrink + a.sum(), weighted * shrink + a @ h
        return float(_sigmoid(self.slope * (weighted / total @ p["o"] + p["c"]) + self.shift)[0])

    def gradients(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted mean cross entropy of the bags, and the decay of the encoder."""
        p = self.params
        bag, first, h, t, g, a, z, s = self._forward(x, counts)
        d = (s - y) * weight / len(y)
        grads = {"o": z.T @ d, "c": np.array([d.sum()])}
        dz = d[:, None] * p["o"]
        da = (dz[bag] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, first)[bag])
        grads["w"] = (t * g).T @ de
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        grads["V"], grads["U"] = h.T @ dt, h.T @ dg
        dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        grads["W"], grads["b"] = x.T @ dh + 1e-5 * p["W"], dh.sum(axis=0)
        return grads

    def fit(self, bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, steps: int = 1100, batch: int = 64, rate: float = 0.005, seed: int = 4) -> AttentionBag:
        rng = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.params.items()}
        order = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            if not len(order):
                order = rng.permutation(len(bags))
            rows, order = order[:batch], order[batch:]
            x, counts = np.concatenate([bags[i] for i in rows]).astype(np.float64), np.array([len(bags[i]) for i in rows])
            p, grads = self.params, self.gradients(x, counts, y[rows], weight[rows])
            for k, grad in grads.items():
                m, v = moments[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p[k] -= rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def put_to_scale(self, bags: list[np.ndarray], y: np.ndarray, rounds: int = 50) -> AttentionBag:
        """Fit slope and shift of the score by Newton steps on the cross entropy, both labels weighing alike.

        Targets keep off 0 and 1 by the number of documents, as if one more of the other label had
        been seen, so that a few documents that are told apart well do not make the slope infinite.
        """
        if not len(y) or y.min() == y.max():
            return self
        ones, zeros = y.sum(), len(y) - y.sum()
        target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        weight = np.where(y == 1, 0.5 / ones, 0.5 / zeros)
        m = self.margin(np.concatenate(bags).astype(np.float64), np.array([len(b) for b in bags]))
        x = np.stack([m, np.ones(len(m))], axis=1)
        known = np.array([1.0, 0.0])
        for _ in range(rounds):
            p = _sigmoid(x @ known)
            bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-6 * np.eye(2)
            known = known - np.clip(np.linalg.solve(bend, x.T @ (weight * (p - target))), -1, 1)
        self.slope, self.shift = max(float(known[0]), 1e-3), float(known[1]) + float(np.log(CUT / (1 - CUT)))
        return self


def train(docs: DataFrame, labels: DataFrame, text: str, label: str, id_col: str, train_docs: int = 5000, train_passages: int = 8) -> AttentionBag | None:
    """Fit on ``train_docs`` labelled ids at most.

    The sample is drawn from the labels alone, so ``train_docs`` bounds what is broadcast to the
    texts, and of each text only its sampled passages travel.
    """
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    step = lambda i: F.substring(F.coalesce(F.col(text), F.lit("")), (F.floor(F.greatest(size - PASSAGE, F.lit(0)) * (i / (train_passages - 1))) + 1).cast("int"), F.lit(PASSAGE))
    chosen = hash_sample(labels.filter(F.col(label).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")), "id", train_docs).groupBy("id").agg(F.min("y").alias("y"))
    narrow = docs.select(F.col(id_col).alias("id"), F.array_distinct(F.array(*map(step, range(train_passages)))).alias("parts"))
    rows = narrow.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("parts").alias("parts"), F.min("y").alias("y")).orderBy("id").collect()
    if not rows:
        return None
    bags = [features([part.encode()[:PASSAGE] for part in r["parts"]])[0] for r in rows]
    y = np.array([1.0 if r["y"] == 1 else 0.0 for r in rows])
    # every fifth document of either label is held back, where there are enough of both
    place = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y == 0))
    few = min((y == 1).sum(), (y == 0).sum()) < 20
    held, taught = (np.ones(len(y), bool), np.ones(len(y), bool)) if few else (place % 5 == 0, place % 5 != 0)
    some = lambda which: [b for b, ok in zip(bags, which, strict=True) if ok]
    share = np.array([(y[taught] == v).sum() for v in (0, 1)])
    weight = len(y[taught]) / (2 * np.maximum(share, 1))[y[taught].astype(int)]
    net = AttentionBag(bags[0].shape[1]).fit(some(taught), y[taught], weight)
    return net.put_to_scale(some(held), y[held])


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", id_col: str = "doc_id", **bounds: int) -> DataFrame:
    """``id_col`` and ``score`` of every row of ``docs``; only the text is an input of a score.

    ``labels`` holds ids and labels of the rows to learn from.
    """
    net = train(docs, labels, text, label, id_col, **bounds)
    columns = docs.select(id_col, text)
    schema = T.StructType([columns.schema[id_col], T.StructField("score", T.DoubleType())])
    if net is None:
        return columns.select(id_col, F.lit(0.5).alias("score"))
    spread = docs.sparkSession.sparkContext.broadcast(net)

    def batches(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = spread.value
        for batch in batches_:
            out: list[np.ndarray] = []
            held, size = [], 0
            for s in batch.column(1):
                data = (s.as_py() or "").encode()
                if size + len(data) > STRETCH and held:
                    out.append(model.score(*features(held)))
                    held, size = [], 0
                if len(data) > STRETCH:
                    out.append(np.array([model.score_in_stretches(data, STRETCH)]))
                    continue
                held.append(data)
                size += len(data)
            if held:
                out.append(model.score(*features(held)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())], names=[id_col, "score"])

    return columns.mapInArrow(batches, schema)


def op10_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = score_quality(docs, labels.filter(remainder("doc_id", 4) != 2))
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
