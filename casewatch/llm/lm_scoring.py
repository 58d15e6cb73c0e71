"""Operator 2, LM scoring: log-likelihood of complete documents under a gated
recurrent language model (``casewatch.llm.lm``) and under a smoothed unigram
model, both learned from all training rows.

Tokens: A-Z are lower-cased; words are runs of anything but blank and the
characters 9-13; every text ends with one end token.

1. Counts. Each task splits its training texts with Arrow, a few MB at once, and
   counts their tokens, Spark adds them up; the vocabulary is a staged table of any size.
2. Model vocabulary. The most frequent tokens get an embedding and an output
   each; their number grows with the corpus (``model_size``), and the classes of
   the softmax with its root. All others share one symbol, and a token's share of
   it is its smoothed count among them. The probabilities of all tokens, unseen
   ones included, sum to one.
3. Training. ``ROUNDS`` rounds, each over its own part of the training rows;
   together they cover every row once. In a round each task trains the common
   parameters on its rows; Spark averages the results, weighted by tokens, in
   two grouped steps of bounded size. What a task sends is the model, whatever
   the data; the number of tasks grows with the data.
4. Scoring. Each task scores its texts and looks up the ``KNOWN`` most frequent
   tokens in a broadcast table (bounded by number and token length). All other
   tokens are joined with the vocabulary table by Spark.

Defined results: null and empty texts are one end token; rows with a null
doc_id are scored and count as held out; repeated rows are scored each; with
no training rows the counts are zero and the model is the uniform one; other
columns never reach the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import isqrt, log10

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm import lm
from casewatch.llm.common import Workspace, id_bucket, most_frequent, table

#: Tokens with an output of their own, and classes of the factored softmax, at least.
VOCAB, CLASSES = 2048, 48
#: Outputs for each unit of the square root of the distinct tokens, up to ``KNOWN`` (268 million distinct ones).
GROWTH = 8
#: Most frequent tokens whose counts are broadcast; longer tokens (bytes) are joined.
KNOWN, KNOWN_BYTES = 131_072, 32
ROUNDS = 4
RATES = (0.02, 0.01, 0.005, 0.0025)
#: Training tokens a task should have at least in a round.
TASK_TOKENS = 400_000
#: Bytes of the texts split into tokens at once, and of the tokens counted at once.
TEXT_BYTES, COUNT_BYTES = 1 << 22, 1 << 25
#: Tokens trained on and scored at once. Scoring takes a text in one lane, so
#: it wants many tokens beside the longest text; training starts long texts
#: anew after SEGMENT tokens and needs less.
CHUNK, SCORE_CHUNK, SEGMENT = 1_000_000, 4_000_000, 2048
#: Parameters of one row when models are averaged, and models of one first group.
BLOCK, FAN = 16_384, 64
END = b" "  # no word holds a blank


def words(text: bytes | None) -> list[bytes]:
    """``bytes.lower`` and ``bytes.split`` touch A-Z, blank and 9-13 only."""
    return (text or b"").lower().split()


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of binary texts without nulls, one after the other, as ``words`` has
    them, and where each text begins (and the last one ends)."""
    # Arrow's ASCII functions look at bytes only, but are defined for strings.
    as_string = pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string()
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pa.Array.from_buffers(as_string, len(texts), texts.buffers(), 0, texts.offset)))
    n = np.where(pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0, 1, 0)
    parts = pc.ascii_split_whitespace(texts)
    n *= pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    flat = parts.flatten()
    if not n.all():  # an empty text is split into one empty word
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
    return flat.cast(pa.large_binary() if pa.types.is_large_string(flat.type) else pa.binary()), np.append(0, np.cumsum(n))


def stretches(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in order, few enough at once for ``TEXT_BYTES``, at least one."""
    ends, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < len(texts):
        most = (ends[at - 1] if at else 0) + TEXT_BYTES
        stop = max(at + 1, int(np.searchsorted(ends, most, side="right")))
        yield texts.slice(at, stop - at)
        at = stop


def _counted(tokens: list[pa.Array]) -> pa.RecordBatch:
    sums = pa.chunked_array([t.cast(pa.large_binary()) for t in tokens], pa.large_binary()).value_counts()
    return pa.RecordBatch.from_arrays([sums.field("values").cast(pa.binary()), sums.field("counts")], ["token", "n"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, ends = [], 0
    for batch in batches:
        ends += len(batch)
        for texts in stretches(batch.column("text")):
            held.append(tokens_of(texts)[0])
            if sum(t.nbytes for t in held) >= COUNT_BYTES:
                yield _counted(held)
                held.clear()
    if held:
        yield _counted(held)
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], ["token", "n"])


def model_size(distinct: int) -> int:
    """Tokens with an output of their own in a corpus of so many distinct ones."""
    return max(VOCAB, min(KNOWN, GROWTH * isqrt(distinct)))


class Vocabulary:
    """The broadcast part: frequent tokens by falling count, and totals.
    Index ``size`` of the model stands for all tokens beyond."""

    def __init__(self, tokens: list[bytes], counts: np.ndarray, total: int, distinct: int):
        most = model_size(distinct)
        if END not in tokens[:most]:  # the end always has an output of its own
            at = tokens.index(END) if END in tokens else None
            n = counts[at] if at is not None else 0
            if at is not None:
                tokens, counts = tokens[:at] + tokens[at + 1 :], np.delete(counts, at)
            place = min(most - 1, len(tokens))
            tokens, counts = tokens[:place] + [END] + tokens[place:], np.insert(counts, place, n)
        self.counts, self.total, self.distinct = counts, total, distinct
        self.size = min(most, len(tokens))
        self.index = {t: i for i, t in enumerate(tokens)}
        rest_total = total - int(counts[: self.size].sum())
        rest_distinct = distinct - int((counts[: self.size] > 0).sum())
        self.rest_total = rest_total
        self.base_log = np.log10(counts + 1.0)
        self.base_scale = log10(total + distinct + 1)
        self.rest_scale = log10(rest_total + rest_distinct + 1)

    def model_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(counts by falling order, model symbol of each index, the last one
        being that of all other tokens)."""
        c = np.append(self.counts[: self.size], self.rest_total)
        order = np.argsort(-c, kind="stable")
        symbol = np.empty(len(c), np.int32)
        symbol[order] = np.arange(len(c), dtype=np.int32)
        return c[order], symbol


def learn_vocabulary(rows: DataFrame, work: Workspace) -> tuple[Vocabulary, DataFrame]:
    """The broadcast part and the whole table (token, n)."""
    counts = rows.select("text").mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    vocab = work.put(counts, "vocabulary")
    total, distinct = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = most_frequent(vocab.where(F.octet_length("token") <= KNOWN_BYTES), "n", KNOWN).toPandas()
    top = top.sort_values(["n", "token"], ascending=[False, True])
    tokens = [bytes(t) for t in top["token"]]
    return Vocabulary(tokens, top["n"].to_numpy(np.int64), int(total), int(distinct)), vocab


def _look_up(tokens: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each token in ``known``, or -1."""
    return pc.fill_null(pc.index_in(tokens, value_set=known.cast(tokens.type)), -1).to_numpy()


def _ids(texts: pa.Array, known: pa.Array, symbol: np.ndarray) -> list[np.ndarray]:
    """The model's symbols of each text; ``known`` has the tokens with an own output."""
    tokens, at = tokens_of(texts)
    return np.split(symbol[_look_up(tokens, known)], at[1:-1]) if len(texts) else []  # -1: the last symbol


def _chunks(docs: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    held, n = [], 0
    for d in docs:
        held.append(d)
        n += len(d) + 1
        if n >= CHUNK:
            yield held
            held, n = [], 0
    if held:
        yield held


def _train_task(shared: Broadcast, rate: float, n_lanes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, net = shared.value
        symbol = vocab.model_counts()[1]
        end = int(symbol[vocab.index[END]])
        net, adam, seen = net.unflat(net.flat()), {}, 0
        known = pa.array(list(vocab.index)[: vocab.size], pa.binary())
        texts = (d for batch in batches for some in stretches(batch.column("text")) for d in _ids(some, known, symbol))
        docs = (d[i : i + SEGMENT] for d in texts for i in range(0, len(d) or 1, SEGMENT))
        for chunk in _chunks(docs):
            seen += lm.train(net, chunk, end, n_lanes, rate, adam)
        if seen:
            flat = net.flat()
            at = range(0, len(flat), BLOCK)
            blocks = pa.array([flat[i : i + BLOCK] for i in at], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK for i in at], pa.int32()), pa.array([float(seen)] * len(at)), blocks], ["block", "tokens", "v"])

    return run


def _average(df: pd.DataFrame) -> pd.DataFrame:
    """Weighted mean of the parameter blocks of one group."""
    w = df["tokens"].to_numpy()
    v = np.average(np.stack(df["v"].to_list()), axis=0, weights=w).astype(np.float32)
    return pd.DataFrame({"block": [df["block"].iloc[0]], "tokens": [w.sum()], "v": [v]})


def train(rows: DataFrame, vocab: Vocabulary, work: Workspace) -> lm.Net:
    """``rows`` has text and part (0 to ROUNDS - 1)."""
    spark = rows.sparkSession
    counts, _ = vocab.model_counts()
    net = lm.Net.fresh(counts, max(CLASSES, isqrt(len(counts) // 2)))
    shape = "block int, tokens double, v array<float>"
    tasks = int(max(1, vocab.total // ROUNDS // TASK_TOKENS))
    n_lanes = int(np.clip(vocab.total // ROUNDS // tasks // (lm.WINDOW * 100), 16, 320))
    for r in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vocab, net))
        part = rows.where(F.col("part") == r).select("text").coalesce(tasks)
        sent = part.mapInArrow(_train_task(shared, RATES[r], n_lanes), shape).withColumn("task", F.spark_partition_id())
        sent = work.put(sent, f"sent{r}")
        first = sent.groupBy("block", (F.col("task") % max(1, tasks // FAN)).alias("salt")).applyInPandas(_average, shape)
        mean = first.groupBy("block").applyInPandas(_average, shape).toPandas().sort_values("block")
        if len(mean):
            net = net.unflat(np.concatenate(mean["v"].to_list()))
        work.drop(f"sent{r}")
    return net


def score(df: DataFrame, vocab: Vocabulary, net: lm.Net) -> DataFrame:
    """``df`` plus ``s``: n_tokens, known, base and model log10 sums of the
    looked-up tokens, and the tokens that have to be joined with their number
    of occurrences."""
    shared = df.sparkSession.sparkContext.broadcast((vocab, net))
    shape = "n_tokens long, known long, base double, model double, tokens array<binary>, times array<int>"

    @F.pandas_udf(shape)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocab, net = shared.value
        size, symbol = vocab.size, vocab.model_counts()[1]
        known_tokens, end_at = pa.array(list(vocab.index), pa.binary()), vocab.index[END]
        end = int(symbol[end_at])
        for batch in batches:
            out, docs, likelihood, waiting = [], [], [], 0
            for some in stretches(pa.array(batch, pa.binary())):
                tokens, at = tokens_of(some)
                places = _look_up(tokens, known_tokens)
                unknown = np.flatnonzero(places < 0)
                joined, cut = tokens.take(pa.array(unknown)).to_pylist(), np.searchsorted(unknown, at)
                for i in range(len(some)):
                    raw = places[at[i] : at[i + 1]]
                    found = raw[raw >= 0]
                    rest = Counter(joined[cut[i] : cut[i + 1]])
                    beyond = found[found >= size]
                    base = vocab.base_log[found].sum() + vocab.base_log[end_at]
                    shares = vocab.base_log[beyond].sum() - len(raw[(raw < 0) | (raw >= size)]) * vocab.rest_scale
                    known = int((vocab.counts[found] > 0).sum()) + int(vocab.counts[end_at] > 0)
                    out.append((len(raw) + 1, known, base - (len(raw) + 1) * vocab.base_scale, shares, list(rest), list(rest.values())))
                    docs.append(symbol[np.where((raw < 0) | (raw >= size), size, raw)])
                    waiting += len(raw) + 1
                    if waiting >= SCORE_CHUNK:
                        likelihood.append(lm.score(net, docs, end))
                        docs, waiting = [], 0
            likelihood.append(lm.score(net, docs, end))
            frame = pd.DataFrame(out, columns=["n_tokens", "known", "base", "model", "tokens", "times"])
            frame["model"] += np.concatenate(likelihood) / np.log(10)
            yield frame

    return df.withColumn("s", scored(F.col("text"))).drop("text")


def log_likelihood(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score. Learns from the rows whose crc32(id as
    text) mod ``folds`` is not ``held``."""
    bucket = id_bucket(id_col, folds)
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        F.coalesce(bucket == held, F.lit(True)).alias("held_out"),
        F.pmod(F.xxhash64(id_col, F.lit(folds)), F.lit(ROUNDS)).alias("part"),
    )
    learned = rows.where(~F.col("held_out"))
    vocab, whole = learn_vocabulary(learned, work)
    net = train(learned, vocab, work)
    scored = score(rows.drop("part"), vocab, net).withColumn("rid", F.monotonically_increasing_id())
    scored = work.put(scored.select("rid", "doc_id", "held_out", "s.*"), "scored")
    rare = scored.select("rid", F.explode(F.arrays_zip("tokens", "times")).alias("x")).select("rid", "x.tokens", "x.times")
    joined = rare.join(whole, rare["tokens"] == whole["token"], "left")
    c = F.coalesce(F.col("n"), F.lit(0))
    added = joined.groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10(c + 1)).alias("logs")
    )
    logs = F.coalesce(F.col("logs"), F.lit(0.0))
    return scored.join(added, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce(F.col("more_known"), F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_likelihood(table(spark, sf_dir, "documents"), Workspace(spark, "op2"))
