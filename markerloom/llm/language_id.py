"""Language identification by a byte convolutional network trained in numpy.

Filters of several widths run over the embedded bytes of fixed-length windows; each filter's
largest response in a window feeds a softmax over the languages. A document's probabilities are
the means over all windows of its whole text.

Training reads a bounded, documented sample: ``train_docs`` labelled documents in hash order, and
``train_windows`` windows spread over each. Prediction reads every byte of every document.

Because a filter is linear in one-hot bytes, its response is a sum of table rows: one table of
byte pairs for width 2, pairs plus bytes for width 3, two pairs for width 4.

Defined results: a null text, or one without a letter (as Unicode has it), is ``und`` with score
0; ties go to the language first in code-point order; repeated rows are judged each on its own;
where no labelled row exists, every document is ``und``; a very long text is read whole, some
thousand windows at a time; a row without id is not held out and teaches nothing; of rows that repeat
an id in the sample the least teach; an empty table gives an empty table; further columns are carried along unless they bear the name of a result column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markerloom.llm.blocks import give_back, hash_sample, raw_values

WIDTHS = (2, 3, 4)
WINDOW = 192
#: Bytes of a text whose windows are laid out at a time.
STRETCH = 4096 * WINDOW


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def windows(raw: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """All windows of a text's bytes as rows; the last one is filled up with zero bytes."""
    n = max(1, -(-len(raw) // length))
    out = np.zeros(n * length, dtype=np.uint8)
    out[: len(raw)] = raw
    return out.reshape(n, length)


class ByteConvNet:
    """Byte embedding, convolutions of several widths, max pooling, softmax."""

    def __init__(self, classes: list[str], embed: int = 8, filters: int = 8, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.classes, self.filters = classes, filters
        self.params = {"E": rng.normal(0, 0.5, (256, embed)), "O": rng.normal(0, 0.1, (filters * len(WIDTHS), len(classes))), "c": np.zeros(len(classes))}
        for w in WIDTHS:
            self.params[f"K{w}"] = rng.normal(0, 1 / np.sqrt(w * embed), (w, embed, filters))
            self.params[f"b{w}"] = np.zeros(filters)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 6) -> ByteConvNet:
        """Adam on the cross entropy of single windows."""
        rng = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.params.items()}
        step = 0
        for epoch in range(epochs):
            lr = rate * (1 - epoch / epochs)
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                grads = self._gradients(x[rows], y[rows])
                step += 1
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.params[k] -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        p, n = self.params, len(x)
        e = p["E"][x]
        pooled, places = [], []
        for w in WIDTHS:
            length = x.shape[1] - w + 1
            r = sum(e[:, t : t + length] @ p[f"K{w}"][t] for t in range(w))
            best = r.argmax(axis=1)
            places.append(best)
            pooled.append(np.take_along_axis(r, best[:, None], axis=1)[:, 0] + p[f"b{w}"])
        z = np.concatenate(pooled, axis=1)
        h = np.maximum(z, 0)
        s = h @ p["O"] + p["c"]
        s = np.exp(s - s.max(axis=1, keepdims=True))
        d = s / s.sum(axis=1, keepdims=True)
        d[np.arange(n), y] -= 1
        d /= n
        grads = {"O": h.T @ d + 1e-4 * p["O"], "c": d.sum(axis=0), "E": np.zeros_like(p["E"])}
        dz = (d @ p["O"].T) * (z > 0)
        for i, w in enumerate(WIDTHS):
            g, best = dz[:, i * self.filters : (i + 1) * self.filters], places[i]
            grads[f"b{w}"], kernel = g.sum(axis=0), np.zeros_like(p[f"K{w}"])
            for t in range(w):
                taken = x[np.arange(n)[:, None], best + t]
                kernel[t] = np.einsum("nfe,nf->ef", p["E"][taken], g)
                np.add.at(grads["E"], taken.ravel(), (g[:, :, None] * p[f"K{w}"][t].T[None]).reshape(-1, p["E"].shape[1]))
            grads[f"K{w}"] = kernel
        return grads

    def tables(self) -> dict:
        """Response tables of bytes and byte pairs, in single precision."""
        p = {k: v.astype(np.float32) for k, v in self.params.items()}
        tap = {w: [p["E"] @ p[f"K{w}"][t] for t in range(w)] for w in WIDTHS}
        pair = lambda a, b: np.ascontiguousarray((a[None, :, :] + b[:, None, :]).reshape(65536, -1))  # noqa: E731  index: first byte + 256 * second
        return {"p2": pair(*tap[2]), "p3": pair(*tap[3][:2]), "u3": tap[3][2], "p4": pair(*tap[4][:2]), "q4": pair(*tap[4][2:]), "b": np.concatenate([p[f"b{w}"] for w in WIDTHS]), "O": p["O"], "c": p["c"]}


def responses(t: dict, x: np.ndarray) -> np.ndarray:
    """Softmax probabilities of windows (rows of bytes)."""
    pairs = x[:, :-1].astype(np.int64) + (x[:, 1:].astype(np.int64) << 8)
    top = [t["p2"][pairs].max(axis=1)]
    r = t["p3"][pairs[:, :-1]]
    r += t["u3"][x[:, 2:]]
    top.append(r.max(axis=1))
    r = t["p4"][pairs[:, :-2]]
    r += t["q4"][pairs[:, 2:]]
    top.append(r.max(axis=1))
    s = np.maximum(np.concatenate(top, axis=1) + t["b"], 0) @ t["O"] + t["c"]
    s = np.exp(s - s.max(axis=1, keepdims=True))
    return s / s.sum(axis=1, keepdims=True)


def train(labelled: DataFrame, text: str, lang: str, id_col: str, train_docs: int = 3000, train_windows: int = 4) -> ByteConvNet | None:
    """Fit on ``train_docs`` labelled rows at most, those whose ids hash lowest; null labels and texts teach nothing."""
    # no more of a very long text is sent to the driver than its sampled windows
    places = F.array(*[F.substring(F.col(text), (F.floor(F.greatest(F.length(text) - WINDOW, F.lit(0)) * (i / max(1, train_windows - 1))) + 1).cast("int"), F.lit(WINDOW)) for i in range(train_windows)])
    taught = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    narrow = taught.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.array_distinct(places).alias("parts"))
    rows = [r for r in hash_sample(narrow, "id", train_docs).collect() if any(any(map(str.isalpha, part)) for part in r["parts"])]
    classes = sorted({r["lang"] for r in rows})
    if not classes:
        return None
    x, y = [], []
    for r in rows:
        for part in r["parts"]:
            x.append(windows(np.frombuffer(part.encode(), np.uint8))[0])
            y.append(classes.index(r["lang"]))
    return ByteConvNet(classes).fit(np.array(x), np.array(y))


def predict(docs: DataFrame, net: ByteConvNet | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row."""
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if net is None:
        return docs.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))
    tables, classes = net.tables(), net.classes
    spread = docs.sparkSession.sparkContext.broadcast(tables)
    chunk = 256

    def batches(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = spread.value
        for batch in batches_:
            texts = batch.column(batch.schema.get_field_index(text))
            sums = np.zeros((len(texts), len(classes)))
            counts = np.ones(len(texts))
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            parts, owners, held = [], [], 0

            def flush() -> None:
                x, who = np.concatenate(parts), np.concatenate(owners)
                for at in range(0, len(x), chunk):
                    np.add.at(sums, who[at : at + chunk], responses(t, x[at : at + chunk]))

            for i, raw in enumerate(raw_values(texts)):
                counts[i] = max(1, -(-len(raw) // WINDOW))
                for at in range(0, len(raw) if lettered[i] else 0, STRETCH):
                    w = windows(raw[at : at + STRETCH])
                    parts.append(w)
                    owners.append(np.full(len(w), i))
                    held += len(w)
                    if held >= 4096:
                        flush()
                        parts, owners, held = [], [], 0
            if parts:
                flush()
            mean = sums / counts[:, None]
            best = mean.argmax(axis=1)
            score = np.clip(mean[np.arange(len(texts)), best], 0.0, 1.0) if len(texts) else np.zeros(0)
            names = pa.array([classes[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, names, pa.array(np.where(lettered, score, 0.0), pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])
        give_back()

    return docs.mapInArrow(batches, schema)


def identify(docs: DataFrame, learn_from: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", carry: tuple[str, ...] = (), **bounds: int) -> DataFrame:
    """``id_col``, ``carry`` columns, ``lang_pred`` and ``score``; only the text is an input of a prediction."""
    net = train(learn_from, text, lang, id_col, **bounds)
    columns = list(dict.fromkeys([id_col, text, *carry]))
    out = predict(docs.select(*columns), net, text)
    return out if text in carry else out.drop(text)


def op7_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, docs.filter(remainder("doc_id", 5) != 0))
    return found.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
