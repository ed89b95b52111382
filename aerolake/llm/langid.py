"""Language identification by a byte convolutional network in numpy.

Text is cut into fixed-length byte windows. A window's bytes are embedded, convolved by
filters of several widths, rectified, max-pooled over the window and classified by a softmax;
a text's probabilities are the mean over all of its windows, weighted by their bytes. The network is trained on the driver
from a bounded sample: every language with a training text, ``fit_docs`` documents of each, fewer where there are
so many languages that the sample would pass ``FIT_TOTAL`` documents, ``fit_windows`` windows of each,
spread evenly over its whole text; one row of each sampled id (that of the smallest text).

Defined cases: texts of any length are whole; a NULL text, or one without a letter, is ``und`` with score 0; a NULL language
or id is not learned from; with no training text every text is ``und``. A row is judged by its
text alone. Other columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import quoted, small_batches

WINDOW, WIDTHS, FILTERS, EMBED = 128, (2, 3, 4), 24, 8
FIT_DOCS, FIT_WINDOWS, FIT_TOTAL, EPOCHS, SEED = 600, 6, 76_800, 6, 7
#: Windows convolved at once.
BLOCK = 256
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def byte_windows(text: bytes, size: int = WINDOW) -> np.ndarray:
    """(n, size) bytes, the last window filled up with zeros; none for an empty text."""
    a = np.frombuffer(text, np.uint8)
    n = -(-len(a) // size)
    out = np.zeros(n * size, np.uint8)
    out[:len(a)] = a
    return out.reshape(n, size)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class ByteCNN:
    langs: list[str]
    params: dict[str, np.ndarray]

    def features(self, x: np.ndarray) -> np.ndarray:
        """Max-pooled filter responses of byte windows."""
        e = self.params["embed"][x]
        out = []
        for w in WIDTHS:
            wide = np.lib.stride_tricks.sliding_window_view(e.reshape(len(x), -1), w * EMBED, axis=1)[:, ::EMBED]
            z = wide.reshape(-1, w * EMBED) @ self.params[f"w{w}"]
            out.append(z.reshape(len(x), -1, FILTERS).max(axis=1) + self.params[f"b{w}"])
        return np.maximum(np.concatenate(out, axis=1), 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = [_softmax(self.features(x[i:i + BLOCK]) @ self.params["out"] + self.params["bias"]) for i in range(0, len(x), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.langs)), np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        raw = [t.encode("utf-8", "replace") if t and _LETTER.search(t) else b"" for t in texts]
        cut = [byte_windows(t) for t in raw]
        counts = np.array([len(c) for c in cut], dtype=np.int64)
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        full = np.flatnonzero(counts)
        if len(full):
            x = np.concatenate([cut[i] for i in full])
            n, size = counts[full], np.array([len(raw[i]) for i in full])
            weight = np.full(len(x), float(WINDOW))
            weight[np.cumsum(n) - 1] = size - (n - 1) * WINDOW
            p = np.add.reduceat(self.probabilities(x) * weight[:, None], np.cumsum(n) - n, axis=0) / size[:, None]
            best = p.argmax(axis=1)
            for i, b in zip(full, best):
                lang[i] = self.langs[b]
            score[full] = np.clip(p[np.arange(len(best)), best], 0, 1)
        return lang, score


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = SEED) -> ByteCNN:
    """Adam on cross entropy; languages weigh the same, and half of each batch is cut short like a short text."""
    rng = np.random.default_rng(seed)
    f32 = np.float32
    p = {"embed": rng.normal(0, 0.5, (256, EMBED)).astype(f32), "bias": np.zeros(len(langs), f32),
         "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(f32)}
    p["embed"][0] = 0
    for w in WIDTHS:
        p[f"w{w}"] = rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)).astype(f32)
        p[f"b{w}"] = np.zeros(FILTERS, f32)
    net = ByteCNN(langs, p)
    m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    freq = np.bincount(labels, minlength=len(langs)).astype(float)
    weight = (len(labels) / (np.count_nonzero(freq) * np.maximum(freq, 1)))[labels]
    steps = max(1, epochs * -(-len(labels) // 64))
    for _ in range(steps):
        pick = rng.integers(0, len(labels), 64)
        x, y, c = windows[pick].copy(), labels[pick], weight[pick].astype(f32)
        short = rng.integers(12, WINDOW, 32)
        x[:32][np.arange(WINDOW)[None, :] >= short[:, None]] = 0
        e = p["embed"][x]
        views, pooled, where = {}, [], {}
        for w in WIDTHS:
            wide = np.lib.stride_tricks.sliding_window_view(e.reshape(64, -1), w * EMBED, axis=1)[:, ::EMBED]
            z = (wide.reshape(-1, w * EMBED) @ p[f"w{w}"]).reshape(64, -1, FILTERS)
            where[w], views[w] = z.argmax(axis=1), wide
            pooled.append(z.max(axis=1) + p[f"b{w}"])
        h = np.maximum(np.concatenate(pooled, axis=1), 0)
        g = _softmax(h @ p["out"] + p["bias"])
        g[np.arange(64), y] -= 1
        g *= c[:, None] / 64
        grads = {"out": h.T @ g, "bias": g.sum(axis=0), "embed": np.zeros_like(p["embed"])}
        gh = (g @ p["out"].T) * (h > 0)
        ge = np.zeros_like(e)
        for i, w in enumerate(WIDTHS):
            gz = gh[:, i * FILTERS:(i + 1) * FILTERS]
            rows, cols = np.arange(64)[:, None], where[w]
            seen = views[w][rows, cols]  # the embedded bytes under each filter's maximum
            grads[f"b{w}"] = gz.sum(axis=0)
            grads[f"w{w}"] = np.einsum("nfk,nf->kf", seen, gz)
            back = gz[:, :, None] * p[f"w{w}"].T[None]
            for k in range(w):
                np.add.at(ge, (rows, cols + k), back[:, :, k * EMBED:(k + 1) * EMBED])
        np.add.at(grads["embed"], x.ravel(), ge.reshape(-1, EMBED))
        grads["embed"][0] = 0
        t += 1
        rate = 3e-3 * (1 - t / (steps + 1))
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * grads[k]
            v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
            p[k] -= (rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(f32)
    return net


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS, fit_total: int = FIT_TOTAL) -> ByteCNN | None:
    """The sampled ids (at most ``fit_total``, or one a language) are bounded, so they are broadcast to one scan of the texts.

    A hash of the id picks somewhat more of each language than wanted, by its count; only those few are ranked."""
    usable = docs.where(learn & quoted(lang_col).isNotNull()).select(
        quoted(id_col).cast("long").alias("_id"), quoted(lang_col).cast("string").alias("_lang"))
    usable = usable.distinct()
    counts = usable.groupBy("_lang").agg(F.count(F.lit(1)).alias("n"))
    each = max(1, min(fit_docs, fit_total // max(1, counts.count())))
    luck = (F.xxhash64("_id").cast("double") + 2.0 ** 63) / 2.0 ** 64
    few = usable.join(counts, "_lang").where(luck * F.col("n") < 2 * each + 64).select("_id", "_lang")
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id"))
    ids = [tuple(r) for r in few.withColumn("_n", rank).where(F.col("_n") <= each).select("_id", "_lang").collect()]
    langs = sorted({lang for _, lang in ids})
    if not langs:
        return None
    picked = docs.sparkSession.createDataFrame(sorted(ids), "_id long, _lang string")

    @F.arrow_udf("array<binary>")
    def spread(text: pa.Array) -> pa.Array:
        out = []
        for t in text.to_pylist():
            w = byte_windows(t or b"")
            rows = range(len(w)) if len(w) <= fit_windows else [i * len(w) // fit_windows for i in range(fit_windows)]
            out.append([w[i].tobytes() for i in rows])
        return pa.array(out, pa.list_(pa.binary()))

    small_batches(docs.sparkSession)
    rows = docs.select(quoted(id_col).cast("long").alias("_id"), quoted(lang_col).cast("string").alias("_lang"),
                       quoted(text_col).cast("binary").alias("_text")).join(F.broadcast(picked), ["_id", "_lang"])
    rows = rows.groupBy("_id", "_lang").agg(F.min("_text").alias("_text"))
    rows = sorted(rows.select("_id", "_lang", spread("_text").alias("w")).collect())
    flat = [(bytes(w), langs.index(r["_lang"])) for r in rows for w in r["w"]]
    if not flat:
        return None
    return train(np.frombuffer(b"".join(w for w, _ in flat), np.uint8).reshape(-1, WINDOW), np.array([y for _, y in flat]), langs)


def with_language(docs: DataFrame, model: ByteCNN | None, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with a struct (lang, score) of each whole text."""
    if model is None:
        return docs.withColumn(out_col, F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score")))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def predict(text: pa.Array) -> pa.Array:
        lang, score = shared.value.predict(text.to_pylist())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], names=["lang", "score"])

    return docs.withColumn(out_col, predict(quoted(text_col).cast("string")))
