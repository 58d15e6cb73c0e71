"""Operator 5, toxicity: subword-bag embeddings averaged into a linear softmax.

A text is lower-cased; runs of anything but letters and digits become one
boundary symbol. Its bag holds every character 3- to 5-gram inside a word with
its boundaries, hashed to one of ``BUCKETS`` embeddings, so an unseen
misspelling shares most of its vectors with the word it bends. A window of
``WINDOW`` words averages the embeddings of its distinct words (over
``MIN_BAG`` n-grams at least, so that a run of one repeated word is not taken
for evidence), a linear softmax over two classes scores it, and the text's
score is that of its most toxic window: one insult in a long text is not
averaged away. All windows of the whole text count.

Training is joint (embeddings, softmax weights, bias) by stochastic gradient
descent in numpy, with windows pooled by a softmax whose sharpness rises to
near the maximum. It uses
a bounded sample of labelled rows: about ``TOXIC_ROWS`` and ``CLEAN_ROWS``
rows at most, chosen by a hash of the id, of at most ``SAMPLE_BYTES`` bytes of
text each. Scoring covers all rows and whole texts.

Defined results: null, empty and wordless texts get the score of an empty bag
(the bias); rows with a null doc_id count as held out and are scored; labels
that are null teach nothing, contradicting labels of one id count as toxic;
without labelled rows of both classes every score is 0; repeated rows get
equal scores; other columns never reach the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.common import id_bucket, table

TOXIC_ROWS, CLEAN_ROWS, SAMPLE_BYTES = 3000, 6000, 32_768
BUCKETS, DIM, GRAMS, WINDOW, MIN_BAG = 1 << 18, 8, (3, 4, 5), 64, 96
STEPS, BATCH, RATE, SOFTMAX_RATE, DECAY, BALANCE = 400, 256, 20.0, 0.5, 1e-5, 0.5
THRESHOLD = 0.7
#: Symbols handled at once; longer texts are cut at window bounds.
CHUNK = 1 << 21
_alnum: np.ndarray | None = None


def symbols(text: str | None) -> np.ndarray:
    """Code points of lower-cased letters and digits, runs of anything else as
    one 0, with a 0 at both ends; empty without letters and digits."""
    global _alnum
    if _alnum is None:
        _alnum = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
    cp = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    s = np.where(_alnum[cp], cp, 0)
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    keep[0] = True
    s = s[keep]
    return s if len(s) > 2 and s.any() else np.empty(0, np.uint32)


def bag(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram in a symbol array; words count from 0."""
    word = np.cumsum(s == 0) - 1
    words, buckets = [], []
    wide = s.astype(np.uint64)
    h = wide.copy()
    inner = np.ones(len(s), bool)  # no boundary strictly inside the n-gram
    for n in range(2, max(GRAMS) + 1):
        if len(h) < 2:
            break
        h = h[:-1] * np.uint64(0x100000001B3) + wide[n - 1 :]
        inner = inner[:-1] if n == 2 else inner[:-1] & (s[n - 2 : -1] != 0)
        if n in GRAMS:
            mixed = (h[inner] ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            words.append(word[: len(h)][inner])
            buckets.append((mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(words), np.concatenate(buckets)


def distinct_words(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols without words that repeat inside their window, and the
    window of each word left."""
    marks = np.flatnonzero(s == 0)
    n = len(marks) - 1
    word = np.cumsum(s == 0) - 1
    place = (np.arange(len(s)) - marks[word]).astype(np.uint64)
    mixed = (s + (place << np.uint64(21)) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    by_word = np.add.reduceat((mixed ^ (mixed >> np.uint64(32)))[:-1], marks[:-1])
    window = np.arange(n) // WINDOW
    _, first = np.unique(by_word + window.astype(np.uint64) * np.uint64(0x94D049BB133111EB), return_index=True)
    kept = np.zeros(n + 1, bool)
    kept[first] = kept[n] = True
    if kept.all():
        return s, window
    return s[kept[word]], window[kept[:n]]


def _cuts(s: np.ndarray) -> Iterator[np.ndarray]:
    """Symbol arrays of whole windows, about CHUNK symbols each."""
    if len(s) <= CHUNK:
        yield s
        return
    ends = np.flatnonzero(s == 0)[::WINDOW]  # a window starts at each
    at = 0
    while at < len(s) - 1:
        later = ends[ends > at]
        cut = later[later - at <= CHUNK]
        stop = int(cut[-1]) if len(cut) else int(later[0]) if len(later) else len(s) - 1
        if len(s) - 1 - at <= CHUNK:
            stop = len(s) - 1
        yield s[at : stop + 1]
        at = stop


class Model:
    def __init__(self, emb: np.ndarray, weight: np.ndarray, bias: np.ndarray):
        self.emb, self.weight, self.bias = emb, weight, bias
        self._margin: np.ndarray | None = None

    @property
    def margin(self) -> np.ndarray:
        """What each bucket adds to the difference of the two class scores."""
        if self._margin is None:
            self._margin = self.emb @ (self.weight[1] - self.weight[0])
        return self._margin

    def score(self, text: str | None) -> float:
        best, bias = -np.inf, float(self.bias[1] - self.bias[0])
        for s in _cuts(symbols(text)):
            if len(s) < 3:
                continue
            s, window_of = distinct_words(s)
            word, bucket = bag(s)
            if len(word):
                window = window_of[word]
                n = np.bincount(window)
                z = np.bincount(window, weights=self.margin[bucket])[n > 0] / np.maximum(n[n > 0], MIN_BAG)
                best = max(best, float(z.max()) + bias)
        if best == -np.inf:
            best = bias
        return float(1 / (1 + np.exp(-np.clip(best, -500, 500))))


def _csr(lists: list[np.ndarray], dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, values) of a list of arrays."""
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    return bounds, (np.concatenate(lists) if lists else np.empty(0)).astype(dtype)


def _rows(bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, row) of every value of some rows of a CSR table."""
    n = bounds[rows + 1] - bounds[rows]
    row = np.repeat(np.arange(len(rows)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + bounds[rows][row], row


def fit(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Model | None:
    """Joint training on a bounded sample held in memory."""
    if len(set(toxic.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    types: dict[bytes, int] = {}
    tokens, windows = [], []  # distinct words of each window; windows of each text
    for text in texts:
        s = symbols(text)
        marks = np.flatnonzero(s == 0)
        raw = s.tobytes()
        ids = [types.setdefault(raw[4 * a : 4 * b + 4], len(types)) for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True)]
        parts = [np.unique(ids[k : k + WINDOW]) for k in range(0, len(ids), WINDOW)]
        windows.append(np.arange(len(tokens), len(tokens) + len(parts)))
        tokens += parts
    gram_bounds, gram = _csr([bag(np.frombuffer(t, np.uint32))[1] for t in types], np.int32)
    token_bounds, token = _csr(tokens, np.int32)
    texts_with = np.array([d for d, w in enumerate(windows) if len(w)])
    size = np.diff(gram_bounds)
    y = toxic.astype(float)
    # each class has half of the weight, softened: a rare class is not drowned, nor are clean texts sacrificed
    balance = np.where(y == 1, (1 - y.mean()) / y.mean(), 1.0) ** BALANCE
    batches = []  # fixed batches of texts, visited in a new order in each epoch
    order = rng.permutation(texts_with)
    for at in range(0, len(order), BATCH):
        docs = order[at : at + BATCH]
        window = np.concatenate([windows[d] for d in docs])
        doc = np.repeat(np.arange(len(docs)), [len(windows[d]) for d in docs])
        kinds, kind = np.unique(token[_rows(token_bounds, window)[0]], return_inverse=True)
        in_window = token_bounds[window + 1] - token_bounds[window]
        first = np.cumsum(in_window) - in_window
        n = np.maximum(np.add.reduceat(size[kinds][kind], first), MIN_BAG)
        batches.append((docs, doc, in_window, first, kind.astype(np.int32), size[kinds], gram[_rows(gram_bounds, kinds)[0]], n))
    emb = rng.normal(0, 1e-3, (BUCKETS, DIM))
    weight, bias = rng.normal(0, 0.5, (2, DIM)), np.zeros(2)
    epochs = -(-STEPS // len(batches))
    steps, step = epochs * len(batches), 0
    for _ in range(epochs):
        for i in rng.permutation(len(batches)):
            docs, doc, in_window, first, kind, sizes, grams, n = batches[i]
            left, sharp = 1 - step / steps, 3.0 * step / steps
            step += 1
            diff = weight[1] - weight[0]
            per_kind = np.add.reduceat((emb @ diff)[grams], np.cumsum(sizes) - sizes)
            z = np.add.reduceat(per_kind[kind], first) / n + bias[1] - bias[0]
            top = np.full(len(docs), -np.inf)
            np.maximum.at(top, doc, z)
            a = np.exp(np.clip(sharp * (z - top[doc]), -60, 0))
            a /= np.bincount(doc, weights=a)[doc]
            pooled = np.bincount(doc, weights=a * z)
            r = (1 / (1 + np.exp(-np.clip(pooled, -60, 60))) - y[docs]) * balance[docs]
            share = a * r[doc]  # gradient of the summed loss in each window's score
            per_kind = np.bincount(kind, weights=np.repeat(share / n, in_window), minlength=len(sizes))
            coef = np.bincount(grams, weights=np.repeat(per_kind, sizes), minlength=BUCKETS)
            g_diff = coef @ emb
            emb *= 1 - RATE * left * DECAY
            emb -= (RATE * left * coef)[:, None] * diff
            weight += SOFTMAX_RATE * left / len(docs) * np.stack((g_diff, -g_diff))
            bias += SOFTMAX_RATE * left / len(docs) * share.sum() * np.array((1, -1))
    return Model(emb.astype(np.float32), weight.astype(np.float32), bias.astype(np.float32))


def sample(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the training sample. ``rows`` has doc_id, text. A class
    with more rows than its bound keeps the ids whose hash is under the bound's
    share; of rows with one id the text with the smallest hash is taken, so about
    that many rows reach the driver. Only chosen texts move."""
    short = rows.where(F.octet_length("text") <= SAMPLE_BYTES)
    marked = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic is not null and doc_id is not null")
    marked = marked.join(short.select("doc_id"), "doc_id", "left_semi")
    sizes = {r["toxic"]: r["count"] for r in marked.where(F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()}
    parts = 1_000_000
    chosen = F.lit(False)
    for c, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        share = parts if sizes.get(c, 0) <= most else most * parts // sizes[c]
        chosen = chosen | (F.col("toxic") == c) & (F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share)
    picked = short.join(F.broadcast(marked.where(chosen)), "doc_id")  # about TOXIC_ROWS + CLEAN_ROWS ids
    one = picked.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic"))
    return one.select("text", "toxic")


def train(rows: DataFrame, labels: DataFrame) -> Model | None:
    got = sample(rows, labels).toPandas().sort_values(["toxic", "text"])
    return fit(got["text"].tolist(), got["toxic"].to_numpy())


def score(df: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus score."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(t) if shared.value else 0.0 for t in batch], dtype=float)

    return df.select(*keep, scored(F.col(text_col)).alias("score"))


def toxicity(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 3
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Learns from
    labels of rows whose crc32(id as text) mod ``folds`` is not 1."""
    held = F.coalesce(id_bucket(id_col, folds) == 1, F.lit(True))
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
    model = train(rows.where(~F.col("held_out")), marks.where(id_bucket("doc_id", folds) != 1))
    return score(rows, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
