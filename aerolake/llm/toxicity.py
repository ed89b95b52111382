"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on toxic text, of which near copies count
once: on its one-word windows whose stems toxic documents use far more often, each as often as it occurs, or on all
windows of toxic text where no stem is that telling. (Longer windows around such words train worse, see the README.) A window
of text is compressed twice, after the ordinary content followed by the toxic content, and after
the ordinary content followed by as many zeros. The ordinary content is equally far away both
times, so the lengths differ only where the toxic content explains the window better. The
mean, largest and common gains of a document's windows go through thresholds calibrated, on training
documents the dictionaries have not seen, by a logistic fit.

Only a bounded sample is fitted: ``fit_docs`` ids of each label, in hash order, one row an id (that of the
smallest text). The dictionaries learn from ``fit_windows`` windows of each, spread evenly over the whole text; the calibration, like
the scoring, takes all windows of a text, whose four features are made in its task. Every whole text is scored, however long.

Defined cases: a NULL or empty text has no window and gets the score of zero gains; a NULL label
or id is not learned from; without training documents of both labels every score is 0. A row
is scored by its text alone, so repeated rows get equal scores. Other columns pass through.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import drop_staged, quoted, small_batches, staged

#: Documents of each label that are fitted, and windows of each document.
FIT_DOCS, FIT_WINDOWS = 3000, 256
WINDOW_WORDS, STEM_BYTES = 8, (4, 5)
#: Documents a stem must be in, and the least log ratio of its rates (at the lower end of its error) to count as toxic.
STEM_DOCS, STEM_LOG_RATIO, STEM_SIGMAS = 5, math.log(4), 2.0
ORDINARY_BYTES, TOXIC_BYTES = 32768, 4096
#: Weight of all toxic documents together in the calibration; the ordinary ones have the rest.
TOXIC_WEIGHT = 0.3
THRESHOLD = 0.5


def _params() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        window_log=16, chain_log=15, hash_log=15, search_log=6, min_match=3, target_length=64,
        strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)


def windows(text: bytes | None, size: int = WINDOW_WORDS) -> list[bytes]:
    words = (text or b"").lower().split()
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(0, len(words), size)]


class Compressor:
    """Compressed lengths of windows under one dictionary, used as plain content."""

    def __init__(self, content: bytes):
        params = _params()
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        self.zstd = zstandard.ZstdCompressor(dict_data=d, compression_params=params)

    def lengths(self, parts: list[bytes]) -> np.ndarray:
        if not parts:
            return np.zeros(0, np.int64)
        packed = self.zstd.multi_compress_to_buffer(parts)
        return np.fromiter((len(packed[i]) for i in range(len(parts))), np.int64, len(parts))


def compressors(ordinary: bytes, toxic: bytes) -> tuple[Compressor, Compressor]:
    """Without and with the toxic content, the ordinary content at the same distance."""
    return Compressor(ordinary + bytes(len(toxic))), Compressor(ordinary + toxic)


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    bias: float

    def scorer(self):
        base, both = compressors(self.ordinary, self.toxic)

        def score(texts: list[bytes | None]) -> np.ndarray:
            x = gain_features([windows(t) for t in texts], base, both)
            return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.bias, -30, 30)))

        return score


def gain_features(docs: list[list[bytes]], base: Compressor, both: Compressor) -> np.ndarray:
    """Per document: mean gain (damped for few windows), its logarithm, largest gain, share of windows with a clear gain."""
    out = np.zeros((len(docs), 4))
    counts = np.array([len(d) for d in docs], dtype=np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        flat = [w for d in docs for w in d]
        gain = (base.lengths(flat) - both.lengths(flat)).astype(float)
        n, at = counts[full], (np.cumsum(counts) - counts)[full]
        total = np.add.reduceat(gain, at)
        mean = np.maximum(total, 0) / (n + 2)
        out[full] = np.column_stack([mean, np.log1p(20 * mean), np.maximum.reduceat(gain, at) / 4,
                                     np.add.reduceat((gain >= 2).astype(float), at) / n])
    return out


def stems_of(word: bytes) -> set[bytes]:
    """Starts of a word; a shorter word is its own stem."""
    return {word[:n] for n in STEM_BYTES if len(word) >= n} or {word}


def _without_copies(docs: list[list[bytes]]) -> list[list[bytes]]:
    """The documents that share no smallest 3-word shingle hash, of three kinds, with an earlier one."""
    from xxhash import xxh64_intdigest

    seen: set[tuple[int, int]] = set()
    out = []
    for d in docs:
        words = b" ".join(d).split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
        keys = {(k, min(xxh64_intdigest(s, k) for s in shingles)) for k in range(3)}
        if seen.isdisjoint(keys):
            out.append(d)
        seen |= keys
    return out


def _toxic_words(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> list[bytes]:
    """One-word windows, as often as they occur, whose stem toxic documents use clearly more often than ordinary ones; without
    such a stem all windows."""

    def stems(docs):
        return Counter(s for d in docs for s in {s for part in d for w in part.split() for s in stems_of(w)})

    t, o = stems(toxic), stems(ordinary)

    def ratio(s):
        a, b = t[s] + 0.5, o[s] + 0.5
        return math.log(a / len(toxic)) - math.log(b / len(ordinary)) - STEM_SIGMAS * math.sqrt(1 / a + 1 / b)

    telling = {s for s, n in t.items() if n >= STEM_DOCS and ratio(s) > STEM_LOG_RATIO}
    words = [b" " + w + b" " for d in toxic for part in d for w in part.split() if not telling.isdisjoint(stems_of(w))]
    return words or [part for d in toxic for part in d]


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples to train on are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[np.ndarray, float]:
    """Newton steps; the labels weigh ``TOXIC_WEIGHT`` and the rest, however many rows they have."""
    a = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, TOXIC_WEIGHT / max(y.sum(), 1), (1 - TOXIC_WEIGHT) / max((1 - y).sum(), 1)) * len(y)
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) / len(y) + ridge * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a / len(y) + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w[:-1], float(w[-1])


def train_dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[bytes, bytes]:
    """Ordinary and toxic dictionary of documents given as lists of windows, near copies left out."""
    toxic, ordinary = _without_copies(toxic), _without_copies(ordinary)
    base = _dictionary(ORDINARY_BYTES, [w for d in ordinary for w in d]) or b" "
    return base, _dictionary(TOXIC_BYTES, _toxic_words(toxic, ordinary))


def calibrate(base: bytes, extra: bytes, toxic: np.ndarray, ordinary: np.ndarray) -> ToxicityModel:
    """Thresholds from the features of documents of both labels."""
    w, b = _logistic(np.concatenate([toxic, ordinary]), np.array([1.0] * len(toxic) + [0.0] * len(ordinary)))
    return ToxicityModel(base, extra, tuple(w), b)


def split_sample(docs: list) -> tuple[list, list]:
    """(what trains, what calibrates): every third one calibrates; a single one does both."""
    return [d for i, d in enumerate(docs) if i % 3] or docs, docs[::3]


def fit_windows(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> ToxicityModel | None:
    """Fit on documents given as lists of all their windows."""
    toxic, ordinary = [d for d in toxic if d], [d for d in ordinary if d]
    if not toxic or not ordinary:
        return None
    (train_t, check_t), (train_o, check_o) = split_sample(toxic), split_sample(ordinary)
    base, extra = train_dictionaries(train_t, train_o)
    pair = compressors(base, extra)
    return calibrate(base, extra, gain_features(check_t, *pair), gain_features(check_o, *pair))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", fit_docs: int = FIT_DOCS, fit_windows_each: int = FIT_WINDOWS) -> ToxicityModel | None:
    """``learn`` says, of ``labels``, which rows may be learned from.

    The sampled ids (at most ``2 * fit_docs``) are bounded, so they are broadcast to the scans of the documents; what is
    collected is ``fit_windows_each`` windows of each id, then four numbers of the ids that calibrate.
    """
    usable = labels.where(learn & F.col(label_col).isin(0, 1)).select(
        quoted(id_col).alias("_id"), quoted(label_col).cast("int").alias("_y")).distinct()
    order = [F.xxhash64("_id"), F.col("_id")]
    ids = usable.where("_y = 1").orderBy(*order).limit(fit_docs).unionByName(usable.where("_y = 0").orderBy(*order).limit(fit_docs))
    ids = [tuple(r) for r in ids.collect()]
    if not ids:
        return None
    picked = docs.sparkSession.createDataFrame(ids, "_id long, _y int")
    texts = docs.select(quoted(id_col).cast("long").alias("_id"), quoted(text_col).cast("binary").alias("_text"))
    one = texts.join(F.broadcast(picked), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))

    @F.arrow_udf("array<binary>")
    def spread(text: pa.Array) -> pa.Array:
        out = []
        for t in text.to_pylist():
            w = windows(t)
            out.append(w if len(w) <= fit_windows_each else [w[i * len(w) // fit_windows_each] for i in range(fit_windows_each)])
        return pa.array(out, pa.list_(pa.binary()))

    small_batches(docs.sparkSession)
    sample = staged(one, "toxicity-sample")
    rows = [r for r in sorted(sample.select("_id", "_y", spread("_text").alias("w")).collect(), key=lambda r: (r["_id"], r["_y"])) if r["w"]]
    (train_t, check_t), (train_o, check_o) = (split_sample([r for r in rows if r["_y"] == y]) for y in (1, 0))
    if not train_t or not train_o:
        return None
    base, extra = train_dictionaries(*([[bytes(w) for w in r["w"]] for r in part] for part in (train_t, train_o)))

    @F.arrow_udf("array<double>")
    def features(text: pa.Array) -> pa.Array:
        x = gain_features([windows(t) for t in text.to_pylist()], *compressors(base, extra))
        return pa.array(list(x), pa.list_(pa.float64()))

    checks = docs.sparkSession.createDataFrame([(r["_id"], r["_y"]) for r in check_t + check_o], "_id long, _y int")
    found = sample.join(F.broadcast(checks), ["_id", "_y"]).select("_id", "_y", features("_text").alias("x")).collect()
    found.sort(key=lambda r: (r["_id"], r["_y"]))
    drop_staged(sample)
    return calibrate(base, extra, *(np.array([r["x"] for r in found if r["_y"] == y]).reshape(-1, 4) for y in (1, 0)))


def with_toxicity(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text."""
    if model is None:
        return docs.withColumn(out_col, F.lit(0.0))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = {}

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        if "score" not in made:
            made["score"] = shared.value.scorer()
        return pa.array(made["score"](text.to_pylist()))

    return docs.withColumn(out_col, score(quoted(text_col).cast("binary")))
