"""Operator 6, language ID: interpolated Kneser-Ney character models.

Text is lower-cased; everything but letters becomes one boundary symbol. Each
task counts trigrams per language (whole training texts, all rows), Spark adds
the counts up, and one interpolated Kneser-Ney model (trigram, bigram,
unigram, absolute discounts from counts of counts) is built per language. A
model is sorted arrays of 64-bit n-gram hashes with log probabilities and
backoff weights. A text gets the language with the lowest cross-entropy per
symbol.

No trigram is dropped. Up to ``MAX_NGRAMS`` of them in ``MAX_LANGS`` languages
reach the driver and are broadcast as models (about 30 bytes an n-gram). More
stay tables: the same probabilities are computed by groupings and joined to the
distinct trigrams of the texts (``predict_joined``).

Rejection: the cross-entropy a text may have is calibrated per language on
the scored training rows, as their ``KEEP`` quantile + ``SLACK`` /
sqrt(symbols), an allowance for short texts; a text above it is rejected
(noise, or a language that was not learned). Texts without a letter are
rejected as ``und``.

Defined results: null, empty and letterless texts give ``und`` with score 0;
rows with a null doc_id count as held out; rows with null lang teach nothing;
with no training rows at all every text is ``und``; repeated rows get equal
results; other columns never reach the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.common import Workspace, id_bucket, table

MAX_NGRAMS = 2_000_000
MAX_LANGS = 256
KEEP = 0.9998
SLACK = 4.0
#: Symbols handled at once inside a task.
CHUNK = 1 << 20
_UNICODE = 0x110000
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(_UNICODE)), bool, _UNICODE)
    return _letters


def symbols(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, runs of anything else as one 0,
    framed by two zeros in front and one behind; empty without letters."""
    cp = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    s = np.where(_letter_table()[cp], cp, 0)
    if not s.any():
        return np.empty(0, np.uint32)
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    s = s[keep]
    lead = 1 + (s[0] != 0)
    return np.concatenate((np.zeros(lead, np.uint32), s, np.zeros(int(s[-1] != 0), np.uint32)))


def trigrams(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, code, ends): distinct trigram keys (3 x 21 bits), for each
    window its place in keys, and where each piece's windows end."""
    lens = np.array([len(p) - 2 for p in pieces], np.int64)
    s = np.concatenate(pieces)
    inside = np.ones(len(s), bool)
    tails = np.cumsum(lens + 2)
    inside[tails - 1] = inside[tails - 2] = False
    at = np.flatnonzero(inside)
    points = np.flatnonzero(np.bincount(s))
    a = len(points)
    if a**3 <= 1 << 22:  # dense numbering of the chunk's own alphabet
        small = np.zeros(int(points[-1]) + 1, np.int32)
        small[points] = np.arange(a, dtype=np.int32)
        d = small[s]
        code = (d[at] * a + d[at + 1]) * a + d[at + 2]
        present = np.flatnonzero(np.bincount(code, minlength=a**3))
        place = np.zeros(a**3, np.int32)
        place[present] = np.arange(len(present), dtype=np.int32)
        p = points.astype(np.uint64)
        keys = (p[present // (a * a)] << np.uint64(42)) | (p[present // a % a] << np.uint64(21)) | p[present % a]
        return keys, place[code], np.cumsum(lens)
    w = s.astype(np.uint64)
    keys, code = np.unique((w[at] << np.uint64(42)) | (w[at + 1] << np.uint64(21)) | w[at + 2], return_inverse=True)
    return keys, code, np.cumsum(lens)


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Chunks of about CHUNK symbols: (row of each piece, pieces). A longer
    text is cut into pieces that overlap by two symbols, so it keeps all its
    trigrams."""
    rows: list[int] = []
    out: list[np.ndarray] = []
    held = 0
    for i, t in enumerate(texts):
        s = symbols(t)
        for k in range(0, max(0, len(s) - 2), CHUNK):
            rows.append(i)
            out.append(s[k : k + CHUNK + 2])
            held += len(out[-1])
            if held >= CHUNK:
                yield rows, out
                rows, out, held = [], [], 0
    if out:
        yield rows, out


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, text) to (lang, key, n), added up within the task."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, keys: np.ndarray, n: np.ndarray) -> None:
        if lang in sums:
            keys, n = np.concatenate((sums[lang][0], keys)), np.concatenate((sums[lang][1], n))
        u, inv = np.unique(keys, return_inverse=True)
        sums[lang] = u, np.bincount(inv, weights=n, minlength=len(u)).astype(np.int64)

    def flush() -> Iterator[pd.DataFrame]:
        for lang, (keys, n) in sums.items():
            yield pd.DataFrame({"lang": lang, "key": keys.view(np.int64), "n": n})
        sums.clear()

    for df in batches:
        for lang, part in df.groupby("lang"):
            for _, pieces in _pieces(part["text"].tolist()):
                keys, code, _ = trigrams(pieces)
                add(lang, keys, np.bincount(code, minlength=len(keys)))
        if sum(len(k) for k, _ in sums.values()) > MAX_NGRAMS:
            yield from flush()
    yield from flush()


def _hash(keys: np.ndarray) -> np.ndarray:
    """64-bit mix (a bijection, so distinct n-grams keep distinct hashes)."""
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sorted:
    """Values by n-gram hash: a sorted hash array and parallel values."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        h = _hash(keys)
        order = np.argsort(h)
        self.h, self.values = h[order], [v[order].astype(np.float32) for v in values]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, present) of each key."""
        h = _hash(keys)
        i = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return i, self.h[i] == h


def _grouped(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    u, inv = np.unique(keys, return_inverse=True)
    return u, np.bincount(inv, weights=weights, minlength=len(u)), inv


def _discount(counts: np.ndarray) -> float:
    n1, n2 = float(np.sum(counts == 1)), float(np.sum(counts == 2))
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


_LOW = np.uint64((1 << 21) - 1)
_PAIR = np.uint64((1 << 42) - 1)


class KneserNey:
    """One language: interpolated Kneser-Ney of order three."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        w, vw, uv = keys & _LOW, keys & _PAIR, keys >> np.uint64(21)
        one = np.ones(len(keys))
        # unigrams: in how many distinct bigrams w ends
        pairs, ends2, pair_of = _grouped(vw, one)  # N1+(. v w)
        words, ends1, _ = _grouped(pairs & _LOW, np.ones(len(pairs)))  # N1+(. w)
        d1, total1, n_words = _discount(ends1), ends1.sum(), len(words)
        p1 = np.maximum(ends1 - d1, 0) / total1
        self.unknown = float(np.log(d1 * n_words / total1 / (n_words + 1)))
        p1 = p1 + np.exp(self.unknown)
        # bigrams, by continuation counts
        d2 = _discount(ends2)
        ctx2, total2, ctx2_of = _grouped(pairs >> np.uint64(21), ends2)
        bow2 = d2 * np.bincount(ctx2_of) / total2
        p2 = np.maximum(ends2 - d2, 0) / total2[ctx2_of] + bow2[ctx2_of] * p1[np.searchsorted(words, pairs & _LOW)]
        # trigrams, by counts
        d3 = _discount(counts)
        ctx3, total3, ctx3_of = _grouped(uv, counts)
        bow3 = d3 * np.bincount(ctx3_of) / total3
        p3 = np.maximum(counts - d3, 0) / total3[ctx3_of] + bow3[ctx3_of] * p2[pair_of]
        self.one, self.two, self.three = Sorted(words, np.log(p1)), Sorted(pairs, np.log(p2)), Sorted(keys, np.log(p3))
        self.back2, self.back3 = Sorted(ctx2, np.log(bow2)), Sorted(ctx3, np.log(bow3))

    def log_prob(self, keys: np.ndarray) -> np.ndarray:
        """Natural log of P(third | first two) for trigram keys."""
        i, known = self.one.find(keys & _LOW)
        p = np.where(known, self.one.values[0][i], self.unknown)
        i, known = self.back2.find((keys & _PAIR) >> np.uint64(21))
        p = p + np.where(known, self.back2.values[0][i], 0)
        i, known = self.two.find(keys & _PAIR)
        p = np.where(known, self.two.values[0][i], p)
        i, known = self.back3.find(keys >> np.uint64(21))
        p = p + np.where(known, self.back3.values[0][i], 0)
        i, known = self.three.find(keys)
        return np.where(known, self.three.values[0][i], p)


def ngram_counts(df: DataFrame, work: Workspace, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Stored (lang, key, n) of every row of ``df`` with a language."""
    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null")
    counts = rows.mapInPandas(_count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    return work.put(counts, "ngrams")


def fits(counts: DataFrame) -> bool:
    """Whether the models may be held by the driver and every task."""
    langs = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    size = langs.agg(F.count(F.lit(1)).alias("langs"), F.sum("rows").alias("rows")).first()
    return size["langs"] <= MAX_LANGS and (size["rows"] or 0) <= MAX_NGRAMS


def train(counts: DataFrame) -> dict[str, KneserNey]:
    """Models by language from counts that ``fits`` allows."""
    got = counts.toPandas()
    return {
        lang: KneserNey(part["key"].to_numpy(np.int64).view(np.uint64), part["n"].to_numpy(float))
        for lang, part in got.sort_values("key").groupby("lang")
    }


def _lower(key: str | Column, mask: np.uint64) -> Column:
    return (F.col(key) if isinstance(key, str) else key).bitwiseAND(F.lit(int(mask)))


def _rate(n: str, name: str) -> Column:
    n1, n2 = F.count_if(F.col(n) == 1), F.count_if(F.col(n) == 2)
    return F.when((n1 > 0) & (n2 > 0), n1 / (n1 + 2 * n2)).otherwise(0.5).alias(name)


def joined_log_probs(counts: DataFrame, keys: DataFrame, work: Workspace) -> DataFrame:
    """(key, lang, lp) of the distinct ``keys`` under every language: ``KneserNey``
    as groupings and joins."""
    pairs = work.put(counts.groupBy("lang", _lower("key", _PAIR).alias("pair")).agg(F.count(F.lit(1)).alias("ends2")), "pairs")
    words = pairs.groupBy("lang", _lower("pair", _LOW).alias("word")).agg(F.count(F.lit(1)).alias("ends1"))
    rates = words.groupBy("lang").agg(_rate("ends1", "d1"), F.sum("ends1").alias("total1"), F.count(F.lit(1)).alias("n_words"))
    rates = rates.join(pairs.groupBy("lang").agg(_rate("ends2", "d2")), "lang").join(counts.groupBy("lang").agg(_rate("n", "d3")), "lang")
    unknown = F.log(F.col("d1") * F.col("n_words") / F.col("total1") / (F.col("n_words") + 1))
    rates = work.put(rates.withColumn("unknown", unknown), "rates")
    rate = F.broadcast(rates)  # one row a language
    one = words.join(rate, "lang").select(
        "lang", "word", (F.greatest(F.col("ends1") - F.col("d1"), F.lit(0.0)) / F.col("total1") + F.exp("unknown")).alias("p1")
    )
    one = work.put(one, "one")
    back2 = pairs.groupBy("lang", F.shiftright("pair", 21).alias("ctx2")).agg(F.sum("ends2").alias("total2"), F.count(F.lit(1)).alias("n2"))
    back2 = work.put(back2.join(rate, "lang").select("lang", "ctx2", "total2", (F.col("d2") * F.col("n2") / F.col("total2")).alias("bow2")), "back2")
    two = pairs.select("*", F.shiftright("pair", 21).alias("ctx2"), _lower("pair", _LOW).alias("word"))
    two = two.join(back2, ["lang", "ctx2"]).join(one, ["lang", "word"]).join(rate.select("lang", "d2"), "lang")
    p2 = F.greatest(F.col("ends2") - F.col("d2"), F.lit(0.0)) / F.col("total2") + F.col("bow2") * F.col("p1")
    two = work.put(two.select("lang", "pair", p2.alias("p2")), "two")
    back3 = counts.groupBy("lang", F.shiftright("key", 21).alias("ctx3")).agg(F.sum("n").alias("total3"), F.count(F.lit(1)).alias("n3"))
    back3 = work.put(back3.join(rate, "lang").select("lang", "ctx3", "total3", (F.col("d3") * F.col("n3") / F.col("total3")).alias("bow3")), "back3")
    three = counts.select("*", F.shiftright("key", 21).alias("ctx3"), _lower("key", _PAIR).alias("pair"))
    three = three.join(back3, ["lang", "ctx3"]).join(two, ["lang", "pair"]).join(rate.select("lang", "d3"), "lang")
    p3 = F.greatest(F.col("n") - F.col("d3"), F.lit(0.0)) / F.col("total3") + F.col("bow3") * F.col("p2")
    three = three.select("lang", "key", p3.alias("p3"))

    asked = keys.crossJoin(rate.select("lang", "unknown")).select(
        "lang", "key", "unknown", _lower("key", _LOW).alias("word"), _lower("key", _PAIR).alias("pair"),
        F.shiftright(_lower("key", _PAIR), 21).alias("ctx2"), F.shiftright("key", 21).alias("ctx3"),
    )
    asked = asked.join(one, ["lang", "word"], "left").join(back2.drop("total2"), ["lang", "ctx2"], "left").join(two, ["lang", "pair"], "left")
    asked = asked.join(back3.drop("total3"), ["lang", "ctx3"], "left").join(three, ["lang", "key"], "left")

    def backed(bow: str) -> Column:
        return F.coalesce(F.log(bow), F.lit(0.0))

    low = F.coalesce(F.log("p2"), backed("bow2") + F.coalesce(F.log("p1"), F.col("unknown")))
    return asked.select("key", "lang", F.coalesce(F.log("p3"), backed("bow3") + low).alias("lp"))


def _seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(__llm_row, text) to (__llm_row, key, m): the trigrams of each text."""
    for df in batches:
        ids = df["__llm_row"].to_numpy(np.int64)
        for rows, pieces in _pieces(df["text"].tolist()):
            keys, code, ends = trigrams(pieces)
            row = np.repeat(np.array(rows, np.int64), np.diff(ends, prepend=0))
            both, m = np.unique(row * len(keys) + code, return_counts=True)
            yield pd.DataFrame({"__llm_row": ids[both // len(keys)], "key": keys.view(np.int64)[both % len(keys)], "m": m})


def predict_joined(df: DataFrame, counts: DataFrame, work: Workspace, out: str, text_col: str = "text") -> DataFrame:
    """``predict`` for models of any size: nothing of them is held whole."""
    rows = work.put(df.withColumn("__llm_row", F.monotonically_increasing_id()), "numbered")
    seen = rows.select("__llm_row", F.col(text_col).alias("text")).mapInPandas(_seen, "__llm_row long, key long, m long")
    seen = work.put(seen.groupBy("__llm_row", "key").agg(F.sum("m").alias("m")), "seen")
    lp = work.put(joined_log_probs(counts, seen.select("key").distinct(), work), "log_probs")
    total = seen.join(lp, "key").groupBy("__llm_row", "lang").agg(F.sum(F.col("m") * F.col("lp")).alias("total"), F.sum("m").alias("n"))
    best = total.groupBy("__llm_row").agg(
        F.min(F.struct((-F.col("total")).alias("loss"), "lang")).alias("best"), F.collect_list("total").alias("totals"), F.first("n").alias("n")
    )
    rest = F.aggregate("totals", F.lit(0.0), lambda s, t: s + F.exp(F.greatest(t + F.col("best.loss"), F.lit(-700.0))))
    best = best.select("__llm_row", F.col("best.lang").alias("lang_pred"), (1 / rest).alias("score"), (F.col("best.loss") / F.col("n")).alias("entropy"), "n")
    found = F.struct(
        F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.col("entropy"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_symbols"),
    )
    best = best.select("__llm_row", found.alias(out))
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(0).cast("long").alias("n_symbols"))
    return rows.join(best, "__llm_row", "left").withColumn(out, F.coalesce(out, none)).drop("__llm_row")


def classify(texts: list[str | None], models: dict[str, KneserNey]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(language, score, cross-entropy, symbols) of each text."""
    langs = sorted(models)
    total = np.zeros((len(langs), len(texts)))
    n = np.zeros(len(texts))
    for rows, pieces in _pieces(texts):
        keys, code, ends = trigrams(pieces)
        starts = np.concatenate(([0], ends[:-1]))
        row = np.array(rows)
        np.add.at(n, row, ends - starts)
        for k, lang in enumerate(langs):
            lp = models[lang].log_prob(keys).astype(np.float32)
            np.add.at(total[k], row, np.add.reduceat(lp[code], starts, dtype=np.float64))
    seen = n > 0
    if not langs:
        return ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan), n
    best = total.argmax(axis=0)
    rest = np.exp(np.clip(total - total.max(axis=0), -700, 0)).sum(axis=0)
    entropy = np.where(seen, -total.max(axis=0) / np.maximum(n, 1), np.nan)
    lang = [langs[b] if ok else "und" for b, ok in zip(best, seen, strict=True)]
    return lang, np.where(seen, 1 / rest, 0.0), entropy, n


def predict(df: DataFrame, models: dict[str, KneserNey], out: str, text_col: str = "text") -> DataFrame:
    """``df`` plus ``out``: struct(lang_pred, score, entropy in nats a symbol,
    n_symbols)."""
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("lang_pred string, score double, entropy double, n_symbols long")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            lang, score, entropy, n = classify(batch.tolist(), shared.value)
            yield pd.DataFrame({"lang_pred": lang, "score": score, "entropy": entropy, "n_symbols": n.astype(np.int64)})

    return df.withColumn(out, scored(F.col(text_col)))


def limits(scored: DataFrame) -> DataFrame:
    """Calibration: one row (__llm_lang, __llm_limit) per language, from scored
    training rows that got their own language."""
    own = scored.where(~F.col("__llm_held") & (F.col("__llm_lang") == F.col("__llm_s.lang_pred")))
    return own.groupBy("__llm_lang").agg(F.percentile_approx("__llm_s.entropy", KEEP, 100_000).alias("__llm_limit"))


def scored_rows(df: DataFrame, work: Workspace, id_col: str, text_col: str, lang_col: str, folds: int, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row plus __llm_held (not learned from),
    __llm_s (see ``predict``) and __llm_rejected."""
    rows = df.withColumn("__llm_lang", F.col(lang_col).cast("string")).withColumn(
        "__llm_held", F.coalesce(id_bucket(id_col, folds) == 0, F.lit(True))
    )
    counts = ngram_counts(rows.where(~F.col("__llm_held")), work, text_col, "__llm_lang")
    if fits(counts):
        found = predict(rows, train(counts), "__llm_s", text_col)
    else:
        found = predict_joined(rows, counts, work, "__llm_s", text_col)
    scored = work.put(found.select(*keep, "__llm_held", "__llm_lang", "__llm_s"), "scored")
    limit = F.broadcast(limits(scored).withColumnRenamed("__llm_lang", "__llm_for"))  # one row a language
    top = F.col("__llm_limit") + SLACK / F.sqrt(F.greatest("__llm_s.n_symbols", F.lit(1)))
    rejected = (F.col("__llm_s.lang_pred") == "und") | F.coalesce(F.col("__llm_s.entropy") > top, F.lit(False))
    joined = scored.join(limit, F.col("__llm_s.lang_pred") == F.col("__llm_for"), "left")
    return joined.withColumn("__llm_rejected", rejected).drop("__llm_lang", "__llm_for", "__llm_limit")


def identify(
    df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, entropy,
    n_symbols, rejected. Learns from the rows whose crc32(id as text) mod
    ``folds`` is not 0; a language without calibration rows rejects none."""
    rows = scored_rows(df, work, id_col, text_col, lang_col, folds, [id_col])
    return rows.select(F.col(id_col).alias("doc_id"), F.col("__llm_held").alias("held_out"), "__llm_s.*", F.col("__llm_rejected").alias("rejected"))


def keep_identified(
    df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5
) -> DataFrame:
    """The rows of ``df``, all columns, that are not rejected."""
    rows = scored_rows(df, work, id_col, text_col, lang_col, folds, df.columns)
    return rows.where(~F.col("__llm_rejected")).select(*df.columns)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents"), Workspace(spark, "op6"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "entropy", "rejected")
