"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover the whole text. Each
byte gets a learned vector; learned filters slide over a chunk, their outputs
are rectified and max-pooled over the chunk, and a linear layer gives a chunk's
log-odds. A document's probability comes from the mean of its chunks' log-odds.

The model is fitted on a bounded sample of labelled training rows: at most
``SAMPLE`` rows of each class, those with the smallest hash of their id, and of
each at most ``SAMPLE_CHUNKS`` evenly spaced chunks. Rows whose crc32(id) mod 5
is 0 are held out. The intercept is moved to the class shares of all training
labels. Only text bytes enter a score. If one class has no rows, every score is
the share of label 1 (0.5 without any labels).

Nulls: a null text is the empty text, which gets the score of an empty chunk; a
null id counts as the empty text in the fold rule. Labels other than 0 and 1 are
not learned from; of repeated labels of one id the smallest holds. Repeated rows
give repeated scores. Columns other than id and text are ignored, or carried
through unchanged by ``accepted``. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import empty_text

FOLDS, SAMPLE, SAMPLE_CHUNKS = 5, 1_500, 6
CHUNK, OVERLAP = 512, 64
EMBED, FILTERS, WIDTH, STRIDE = 8, 32, 8, 4
PAD = 256
STEPS, RATE, BATCH = 750, 3e-3, 32
GROUP = 1_024  # chunks scored at once
THRESHOLD = 0.3


def chunks(raw: bytes) -> np.ndarray:
    """(n, CHUNK) byte codes; the last chunk is padded."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    padded = np.full((n - 1) * step + CHUNK, PAD, np.int16)
    padded[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


class ByteCnn:
    def __init__(self, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (PAD + 1, EMBED)),
            "filter": rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)),
            "bias": np.zeros(FILTERS),
            "out": rng.normal(0, FILTERS ** -0.5, FILTERS),
            "shift": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def windows(self, codes: np.ndarray) -> np.ndarray:
        e = self.p["embed"][codes].reshape(len(codes), CHUNK * EMBED)
        return np.lib.stride_tricks.sliding_window_view(e, WIDTH * EMBED, axis=1)[:, ::STRIDE * EMBED]

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        """Max-pooled filter outputs (n, FILTERS) of n chunks."""
        return np.maximum((self.windows(codes) @ self.p["filter"]).max(axis=1) + self.p["bias"], 0)

    def chunk_logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self.pooled(codes[i:i + GROUP]) @ self.p["out"] for i in range(0, len(codes), GROUP)]
        return np.concatenate(parts) + self.p["shift"]

    def score(self, raws: list[bytes]) -> np.ndarray:
        """One probability for each text."""
        out = np.empty(len(raws))
        group: list[np.ndarray] = []
        start = held = 0
        for i, raw in enumerate(raws):
            group.append(chunks(raw))
            held += len(group[-1])
            if held >= GROUP or i + 1 == len(raws):
                logits = self.chunk_logits(np.concatenate(group)).astype(np.float64)
                sizes = np.array([len(g) for g in group])
                sums = np.add.reduceat(logits, np.cumsum(sizes) - sizes)
                out[start:i + 1] = 1 / (1 + np.exp(-np.clip(sums / sizes, -40, 40)))
                group, start, held = [], i + 1, 0
        return out

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, seed: int = 9) -> None:
        """At least STEPS Adam steps on the logistic loss of each document's mean chunk log-odds."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(-(-STEPS // -(-len(texts) // BATCH))):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                pick = order[i:i + BATCH]
                grads = self.gradients([texts[j] for j in pick], labels[pick])
                step += 1
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)

    def gradients(self, texts: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        codes = np.concatenate(texts)
        sizes = np.array([len(t) for t in texts])
        doc = np.repeat(np.arange(len(texts)), sizes)
        win = self.windows(codes)
        raw = win @ self.p["filter"]
        top = raw.argmax(axis=1)
        h = np.take_along_axis(raw, top[:, None], 1)[:, 0] + self.p["bias"]
        act = np.maximum(h, 0)
        logits = np.bincount(doc, act @ self.p["out"] + self.p["shift"][0]) / sizes
        d_logit = ((1 / (1 + np.exp(-logits)) - labels) / len(texts) / sizes)[doc].astype(np.float32)
        d_h = d_logit[:, None] * self.p["out"] * (h > 0)
        rows = np.arange(len(codes))
        d_filter = np.empty_like(self.p["filter"])
        d_embed = np.zeros_like(self.p["embed"])
        for f in range(FILTERS):
            d_filter[:, f] = win[rows, top[:, f]].T @ d_h[:, f]
        # bytes under each filter's best window
        at = top[:, :, None] * STRIDE + np.arange(WIDTH)
        under = np.take_along_axis(codes, at.reshape(len(codes), -1).astype(np.int64), 1).reshape(at.shape)
        taps = self.p["filter"].reshape(WIDTH, EMBED, FILTERS).transpose(2, 0, 1)
        d_under = d_h[:, :, None, None] * taps
        flat = under.ravel()
        for e in range(EMBED):
            d_embed[:, e] = np.bincount(flat, d_under[..., e].ravel(), PAD + 1)
        return {"embed": d_embed, "filter": d_filter, "bias": d_h.sum(0), "out": act.T @ d_logit,
                "shift": d_logit.sum(keepdims=True)}


def fold(id_col: str | Column) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> ByteCnn:
    """Fit on the bounded sample; the sample's chunks are the only rows on the driver."""
    rows = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id") != 0))
            .groupBy("doc_id").agg(F.min("label").alias("label")))
    shares = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}  # at most two rows
    sample = None
    for k in shares:
        part = rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        sample = part if sample is None else sample.unionByName(part)
    model = ByteCnn()
    have = []
    if sample is not None:
        picked = (docs.select(F.col(id_col).alias("doc_id"), empty_text(text_col).alias("text"))
                  .join(sample, "doc_id"))

        def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                out = []
                for text in pdf["text"]:
                    own = chunks(text.encode("utf-8", "surrogatepass"))
                    at = np.unique(np.linspace(0, len(own) - 1, SAMPLE_CHUNKS).astype(int))
                    out.append(own[at].astype("<i2").tobytes())
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "codes": out})

        have = picked.mapInPandas(cut, f"doc_id {dict(rows.dtypes)['doc_id']}, label int, codes binary").collect()
    if len({r.label for r in have}) < 2:
        total = sum(shares.values())
        p = min(max(shares.get(1, 0) / total, 1e-6), 1 - 1e-6) if total else 0.5
        model.p["out"][:] = 0
        model.p["shift"][:] = np.log(p / (1 - p))
        return model
    have.sort(key=lambda r: (r.doc_id, bytes(r.codes)))
    y = np.array([r.label for r in have], np.float32)
    model.fit([np.frombuffer(r.codes, "<i2").reshape(-1, CHUNK) for r in have], y)
    model.p["shift"] += np.float32(np.log(shares[1] / shares[0]) - np.log(y.sum() / (1 - y).sum()))
    return model


def score_column(model: ByteCnn, text: Column) -> Column:
    """Probability of label 1 for each whole text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(model.score(s.tolist()))

    return score(F.coalesce(text.cast("binary"), F.lit(b"")))


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = fit(docs, labels, id_col, text_col)
    return (docs.select(F.col(id_col).alias("doc_id"), score_column(model, F.col(text_col)).alias("score"))
            .select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def accepted(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents (all columns) whose score reaches ``THRESHOLD``."""
    model = fit(docs, labels, text_col=text_col)
    return docs.where(score_column(model, F.col(text_col)) >= THRESHOLD)
