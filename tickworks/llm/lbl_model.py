"""Language-model scoring with a log-bilinear neural model, trained in numpy.

The model predicts a token's class from the ``CONTEXT`` classes before it: the
sum of their vectors, each scaled by its position's learned diagonal, meets the
class vectors in one matrix product, plus a bias; a softmax over all classes
gives normalised log-probabilities. Classes are the ``CLASSES`` most frequent
training words, the end, and one class for all other words, within which a
word has probability (c + 0.1) / (n + 0.1 (v + 1)), with n and v the number of
tokens and distinct words of that class in the training documents.

Training uses every token of every training document (crc32(id) mod 10 is not 0)
with noise-contrastive estimation: each task walks through its own documents in
mini-batches whose noise words are shared, with Adagrad steps, and the tasks'
models are averaged by their numbers of tokens in a tree of ``FAN_IN``. A first
round over every ``WARM``-th mini-batch brings the tasks close to one another; the
second round uses all.

Word counts cover all training documents; they are counted per task, then
shuffled by word. The most frequent words, at most ``HEAD`` (a bounded table), are looked up
in the tasks, so hot words are never shuffled; a document's other words are
joined with the counts by word.

Lower-casing is A-Z only; words are runs outside ASCII white space.

Nulls: a null text is the empty text (one token, the end). A null id counts as
the empty text in the fold rule. Every row gets a result, repeated rows the same
one. Extra columns are ignored. Without training documents c = N = V = 0 and the
model is uniform over end and the rest. Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import empty_text, frequent, rebatch, stored

FOLDS = 10
CLASSES, HEAD = 1_022, 1 << 16
CONTEXT, DIM = 2, 24
NOISE, NOISE_RATIO, BATCH, RATE, WARM = 64, 16.0, 4_096, 0.1, 10
FAN_IN = 64
BATCH_CHARS, COUNTED = 4_000_000, 300_000
BLOCK = 4_096


class Lbl:
    """Parameters: ``r`` context vectors, ``q`` class vectors, ``b`` biases, ``c`` position scales."""

    NAMES = ("r", "q", "b", "c")

    def __init__(self, words: int, noise: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.end, self.rest, self.start = words, words + 1, words + 2
        self.noise = noise  # share of each class among the training tokens
        self.r = rng.normal(0, 0.1, (words + 3, DIM)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (words + 2, DIM)).astype(np.float32)
        self.b = np.log(noise).astype(np.float32)
        self.c = np.ones((CONTEXT, DIM), np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def sequence(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(contexts, targets, document) of every token of texts given as classes, ends included."""
        lead, end = np.full(CONTEXT, self.start), np.array([self.end])
        flat = np.concatenate([x for d in docs for x in (lead, d, end)])
        at = np.flatnonzero(flat != self.start)
        contexts = np.stack([flat[at - 1 - i] for i in range(CONTEXT)], axis=1)
        return contexts, flat[at], np.repeat(np.arange(len(docs)), [len(d) + 1 for d in docs])

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        return sum(self.r[contexts[:, i]] * self.c[i] for i in range(CONTEXT))

    def log_probs(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target."""
        return Scorer(self).log_probs(contexts, targets)

    def train(self, contexts: np.ndarray, targets: np.ndarray, state: dict, rng: np.random.Generator, every: int = 1) -> int:
        """One pass of noise-contrastive steps over (shuffled) tokens; returns the tokens used."""
        order = rng.permutation(len(targets))
        log_kq = np.log(NOISE_RATIO * self.noise).astype(np.float32)
        cdf = np.cumsum(self.noise)
        used = 0
        for i in range(0, len(order), BATCH * every):
            pick = order[i:i + BATCH]
            ctx, w = contexts[pick], targets[pick]
            x = np.minimum(np.searchsorted(cdf, rng.random(NOISE) * cdf[-1]), len(cdf) - 1)
            h = self.predicted(ctx)
            qw, qx = self.q[w], self.q[x]
            d_w = 1 - 1 / (1 + np.exp(-(np.einsum("ij,ij->i", h, qw) + self.b[w] - log_kq[w])))
            d_x = -(NOISE_RATIO / NOISE) / (1 + np.exp(-(h @ qx.T + self.b[x] - log_kq[x])))
            d_h = d_w[:, None] * qw + d_x @ qx
            at = np.concatenate([w, x])
            self.step("q", at, np.concatenate([d_w[:, None] * h, d_x.T @ h]), state)
            self.step("b", at, np.concatenate([d_w, d_x.sum(axis=0)]), state)
            rows = [d_h * self.c[k] for k in range(CONTEXT)]
            d_c = np.stack([(d_h * self.r[ctx[:, k]]).sum(axis=0) for k in range(CONTEXT)])
            self.step("r", ctx.T.ravel(), np.concatenate(rows), state)
            self.step("c", np.arange(CONTEXT), d_c, state)
            used += len(pick)
        return used

    def step(self, name: str, at: np.ndarray, grad: np.ndarray, state: dict) -> None:
        """Adagrad on the rows ``at``, whose gradients add up."""
        p = getattr(self, name)
        at = at.astype(np.uint16 if len(p) <= 1 << 16 else np.int64)  # short integers are sorted by radix
        order = np.argsort(at, kind="stable")
        own = at[order]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        g = np.add.reduceat(grad[order], first, axis=0) / np.float32(np.sqrt(BATCH))
        sums = state.setdefault(name, np.full_like(p, 1e-2))
        rows = own[first]
        sums[rows] += g * g
        p[rows] += RATE * g / np.sqrt(sums[rows])


class Scorer:
    """Log-probabilities of a trained model. The product of each position's scaled context vectors with all class
    vectors is one matrix, so a logit is a sum of ``CONTEXT`` entries; a context is normalised once, and its norm
    kept in a table over all contexts, (classes + 1) ^ ``CONTEXT`` numbers (4 MB)."""

    def __init__(self, model: Lbl):
        self.size = len(model.r)
        self.logits = [(model.r * model.c[i]) @ model.q.T for i in range(CONTEXT)]
        self.logits[0] += model.b
        self.norm = np.full(self.size ** CONTEXT, np.nan, np.float32)

    def log_probs(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        scale = self.size ** np.arange(CONTEXT, dtype=np.int64)
        code = contexts @ scale
        new = np.unique(code[np.isnan(self.norm[code])])
        for i in range(0, len(new), BLOCK):
            part = new[i:i + BLOCK]
            block = sum(m[part // s % self.size] for m, s in zip(self.logits, scale))
            top = block.max(axis=1)
            block -= top[:, None]
            np.exp(block, out=block)
            self.norm[part] = top + np.log(block.sum(axis=1))
        return sum(m[contexts[:, i], targets] for i, m in enumerate(self.logits)) - self.norm[code]


def text_words(text: str) -> list[bytes]:
    """``bytes`` lower-cases A-Z only and splits at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def fold(id_col: str | Column) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % FOLDS


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, c) over all texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for pdf in frames:
            for text in pdf["text"]:
                counts.update(text_words(text))
                if len(counts) > COUNTED:
                    yield pd.DataFrame({"word": list(counts.keys()), "c": list(counts.values())})
                    counts = Counter()
        if counts:
            yield pd.DataFrame({"word": list(counts.keys()), "c": list(counts.values())})

    return texts.select("text").mapInPandas(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def train_round(texts: DataFrame, classes, model: Lbl, every: int) -> np.ndarray:
    """The tasks' models after their documents, averaged by tokens in a tree."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        own, state, rng, used = Lbl(model.end, model.noise), {}, np.random.default_rng(task), 0
        own.load(model.flat())
        index, rest = classes.value, own.rest
        for pdf in rebatch(frames, "text", BATCH_CHARS):
            docs = [np.array([index.get(w, rest) for w in text_words(t)], np.int64) for t in pdf["text"]]
            contexts, targets, _ = own.sequence(docs)
            used += own.train(contexts, targets, state, rng, every)
        if used:
            yield pd.DataFrame({"task": [task], "weight": [float(used)], "flat": [own.flat().astype("<f4").tobytes()]})

    def mean(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("task")
        total, weight = 0.0, pdf["weight"].to_numpy()
        for f, w in zip(pdf["flat"], weight):
            total = total + np.frombuffer(f, "<f4").astype(np.float64) * (w / weight.sum())
        return pd.DataFrame({"task": [key[0]], "weight": [weight.sum()], "flat": [total.astype("<f4").tobytes()]})

    rows = stored(texts.select("text").mapInPandas(run, "task bigint, weight double, flat binary"), "lbl-models")
    most = rows.agg(F.max("task")).first()[0]
    while most:
        rows = stored(rows.groupBy(F.floor(F.col("task") / FAN_IN).alias("up")).applyInPandas(
            mean, "task bigint, weight double, flat binary"), "lbl-models")
        most //= FAN_IN
    got = rows.select("flat").first()
    return np.frombuffer(got[0], "<f4") if got else model.flat()


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), empty_text(text_col).alias("text"), (fold(id_col) == 0).alias("held_out"))
    train = src.where(~F.col("held_out"))
    counts = stored(word_counts(train), "lbl-counts")
    facts = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_docs = train.count()
    total, distinct = facts.n + n_docs, facts.v + (n_docs > 0)
    top, edge = frequent(counts, "c", HEAD)
    head = sorted(top.collect(), key=lambda r: (-r.c, bytes(r.word)))  # bounded by HEAD
    if len(head) < CLASSES:
        head += edge.orderBy("word").limit(CLASSES - len(head)).collect()
    words = head[:CLASSES]
    rest_n, rest_v = facts.n - sum(r.c for r in words), facts.v - len(words)
    seen = np.array([*[r.c for r in words], n_docs, rest_n], np.float64) + 0.1
    model = Lbl(len(words), seen / seen.sum())
    classes = spark.sparkContext.broadcast({bytes(r.word): i for i, r in enumerate(words)})
    if n_docs:
        for every in (WARM, 1):
            model.load(train_round(train, classes, model, every))
    table = spark.sparkContext.broadcast({bytes(r.word): (i, r.c) for i, r in enumerate(head)})
    ln10, end_log = float(np.log(10)), float(np.log10(n_docs + 0.1))
    n_words = len(words)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = {w: i for w, (i, _) in table.value.items()}
        c = np.array([0, *[c for _, c in table.value.values()]], np.float64)  # by index + 1
        log_c = np.log10(c + 0.1)
        scorer = Scorer(model)
        for pdf in rebatch(frames, "text", BATCH_CHARS):
            classes_of, facts_of, tails = [], [], []
            for row, text in zip(pdf["row_id"], pdf["text"]):
                ws = text_words(text)
                at = np.array([index.get(w, -1) for w in ws], np.int64)
                tail = Counter(w for w, i in zip(ws, at.tolist()) if i < 0) if (at < 0).any() else {}
                tails += [(row, w, k) for w, k in tail.items()]
                other = at >= n_words
                n_tail = int((at < 0).sum())
                facts_of.append((len(ws) + 1, len(ws) - n_tail + (n_docs > 0), n_tail, int(other.sum()) + n_tail,
                                 float(log_c[at[at >= 0] + 1].sum()) + end_log, float(log_c[at[other] + 1].sum())))
                classes_of.append(np.where((at < 0) | other, model.rest, at))
            contexts, targets, doc = model.sequence(classes_of)
            lp = np.bincount(doc, scorer.log_probs(contexts, targets), len(pdf)) / ln10
            f = pd.DataFrame(facts_of, columns=["n_tokens", "n_known", "n_tail", "n_rest", "base_log", "rest_log"])
            yield pd.DataFrame({"row_id": pdf["row_id"], "doc_id": pdf["doc_id"], "held_out": pdf["held_out"], **f, "lp": lp,
                                "word": None, "k": 0})
            if tails:
                t = pd.DataFrame(tails, columns=["row_id", "word", "k"])
                yield pd.DataFrame({"row_id": t["row_id"], "doc_id": None, "held_out": None, **{x: 0 for x in f.columns[:4]},
                                    "base_log": 0.0, "rest_log": 0.0, "lp": 0.0, "word": t["word"], "k": t["k"]})

    rows = stored(src.withColumn("row_id", F.monotonically_increasing_id()).mapInPandas(
        run, f"row_id bigint, doc_id {dict(src.dtypes)['doc_id']}, held_out boolean, n_tokens bigint, n_known bigint, "
             "n_tail bigint, n_rest bigint, base_log double, rest_log double, lp double, word binary, k bigint"), "lbl-rows")
    tails = (rows.where("word is not null").select("row_id", "word", "k").join(counts, "word", "left")
             .groupBy("row_id").agg(F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("tail_log"),
                                    F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("tail_known")))
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    base_norm = float(np.log10(total + 0.1 * (distinct + 1)))
    rest_norm = float(np.log10(rest_n + 0.1 * (rest_v + 1)))
    return rows.where("word is null").join(tails, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base_log") + tail_log - F.col("n_tokens") * base_norm).alias("base_score"),
        (F.col("lp") + F.col("rest_log") + tail_log - F.col("n_rest") * rest_norm).alias("score"))
