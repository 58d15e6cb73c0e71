"""Operator 11, importance resampling towards a target distribution.

Features are all runs of 1 to ``max_words`` consecutive words, repeats counted,
hashed into ``buckets`` by CRC-32. A bucket's gain is the floored log ratio of
its smoothed shares in the target and in the corpus; a document's weight is the
sum of the gains of its features, looked up in one array. The score adds a
Gumbel number drawn from the document's id, so the highest scores are a sample
without replacement whose chances follow the weights.

Steps: one pass counts buckets (a vector per task, then summed by bucket), one
pass scores; id, score and row number are stored. The score of the last row to
be drawn is found by bisection of the range of scores: each job counts exactly
how many rows lie over ``CUTS`` thresholds at once, and the interval shrinks to
the piece that holds the cutoff. Rows tied at that score are cut in the same
way by doc_id, and rows tied in both by row number. Nothing is sorted for it.
Drawn rows are range-partitioned by (score, doc_id); a row's rank is its place
in its partition plus the rows of the partitions before it.

Bounds: the gains are one array of ``buckets`` numbers (80 KB) on the driver and
in each task; a job returns ``CUTS`` counts. Everything covers all rows.

Defined results: null and empty texts have no features, weight 0, and are never
drawn while ``min_words`` is over 0; a null doc_id hashes as the empty text and
ties behind every id; repeated rows are rows of their own (equal scores, the
row number decides which of them is drawn); an empty target or corpus gives
gains from the smoothing alone; an empty table gives none; other columns of the
input never reach the result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from casewatch.llm.common import Workspace, table

BUCKETS = 10_000
MAX_WORDS = 1
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
#: Thresholds that one count job tries: it halves the interval four times.
CUTS = 15
#: Bytes that end a word become blanks; A-Z become a-z; bytes over 0x7F are parts of words.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def feature_buckets(found: list[bytes], max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each feature of a text, repeats included."""
    parts = [np.fromiter(map(zlib.crc32, found), np.int64, len(found))]
    for n in range(2, max_words + 1):
        runs = [b" ".join(found[i : i + n]) for i in range(len(found) - n + 1)]
        parts.append(np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)))
    return np.concatenate(parts) % buckets


def bucket_counts(texts: DataFrame, text_col: str, max_words: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                at = feature_buckets(words(text), max_words, buckets)
                total += np.bincount(at, minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    raw = texts.select(F.col(text_col).cast("binary").alias("text"))
    sums = raw.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket, smoothed by one a bucket."""
    size = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    ratio = [(t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weights(gain: np.ndarray, max_words: int, buckets: int):
    kind = StructType([StructField(c, LongType()) for c in ("n_words", "n_features", "weight")])

    @F.pandas_udf(kind)
    def weigh(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                found = words(text)
                at = feature_buckets(found, max_words, buckets)
                rows.append((len(found), len(at), int(gain[at].sum())))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"], dtype="int64")

    return weigh


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 * a Gumbel number) drawn from the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _cut(rows: DataFrame, value: Column, quota: int) -> tuple[int, int]:
    """(cutoff, over): the largest whole number c with at least ``quota`` rows
    at ``value`` >= c, and how many rows are over c. ``rows`` has ``quota`` rows
    at least, ``quota`` is over 0."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    over = 0  # rows at value > high
    while low < high:
        steps = sorted({low + (high - low) * i // (CUTS + 1) for i in range(1, CUTS + 1)} | {high})
        steps = [t for t in steps if t > low]
        counts = rows.agg(*[F.count_if(value >= t).alias(f"n{i}") for i, t in enumerate(steps)]).first()
        enough = [i for i in range(len(steps)) if counts[i] >= quota]
        reached = enough[-1] if enough else -1
        if reached + 1 < len(steps):
            high, over = steps[reached + 1] - 1, counts[reached + 1]
        low = steps[reached] if enough else low
    return low, over


def drawn(rows: DataFrame, quota: int, order: Sequence[Column]) -> Column:
    """A condition that holds for exactly the first ``quota`` rows by
    descending ``order`` (whole numbers, the last one unique)."""
    total = rows.count()
    if quota <= 0:
        return F.lit(False)
    if quota >= total:
        return F.lit(True)
    taken, tied = F.lit(False), F.lit(True)
    for value in order:
        cutoff, over = _cut(rows, value, quota)
        taken, quota = taken | (tied & (value > cutoff)), quota - over
        tied = tied & (value == cutoff)
        rows = rows.where(value == cutoff)
        if rows.count() == quota:
            break
    return taken | tied


def resample(
    df: DataFrame,
    target: DataFrame,
    work: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score and, for drawn
    rows, rank."""
    gain = gains(bucket_counts(df, text_col, max_words, buckets), bucket_counts(target, target_text_col, max_words, buckets))
    weigh = _weights(gain, max_words, buckets)
    doc_id = F.col(id_col).cast("long")
    scored = df.select(doc_id.alias("doc_id"), weigh(F.col(text_col).cast("binary")).alias("w"))
    scored = scored.select("doc_id", "w.*", (F.col("w.weight") + gumbel(F.col("doc_id"), seed)).alias("score"))
    rows = work.put(scored.withColumn("row_no", F.monotonically_increasing_id()), "scored")  # stored: the numbers stay

    pool = F.col("n_words") >= min_words
    early_id = F.coalesce(F.bitwise_not("doc_id"), F.lit(-(1 << 63)))  # falls as the id rises; null last
    order = [F.col("score"), early_id, F.bitwise_not("row_no")]
    chosen = pool & drawn(rows.where(pool), rows.where(pool).count() * percent // 100, order)

    cols = ["doc_id", "n_features", "weight", "score"]
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    first = [o.desc() for o in order]
    ranked = rows.where(chosen).repartitionByRange(parts, *first).sortWithinPartitions(*first)
    ranked = work.put(ranked.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))  # partition and row in it
    sizes = ranked.groupBy(part.alias("part")).count().collect()  # one row a partition
    before, n = {}, 0
    for r in sorted(sizes):
        before[r["part"]], n = n, n + r["count"]
    start = F.from_json(F.lit(str([before.get(p, 0) for p in range(max(before, default=-1) + 1)])), "array<bigint>")
    rank = F.get(start, part.cast("int")) + place + 1
    return ranked.select(*cols, rank.cast("long").alias("rank")).unionByName(
        rows.where(~F.coalesce(chosen, F.lit(False))).select(*cols, F.lit(None).cast("long").alias("rank"))
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark, "op11"))


OP11_SQL = r"""
WITH RECURSIVE crc(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8
), lut AS (
  SELECT list(c ORDER BY i) AS lut FROM crc WHERE k = 8
), d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark
), dw AS (
  SELECT row_no, unnest(words) AS word FROM d
), vocabulary AS (
  SELECT word, xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(word) + 1),
             lambda p: ('0x' || hex(encode(word))[2 * p - 1 : 2 * p])::BIGINT)),
           lambda c, x: xor(c >> 8, lut[1 + (xor(c, x) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM dw UNION SELECT word FROM b), lut
), s AS (
  SELECT bucket, count(*) AS n FROM dw JOIN vocabulary USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM b JOIN vocabulary USING (word) GROUP BY bucket
), gain AS (
  SELECT r.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0) + 10000)::DOUBLE
           / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) r(bucket) LEFT JOIN s ON s.bucket = r.bucket LEFT JOIN t ON t.bucket = r.bucket
), w AS (
  SELECT row_no, sum(gain) AS weight FROM dw JOIN vocabulary USING (word) JOIN gain USING (bucket) GROUP BY row_no
), scored AS (
  SELECT row_no, doc_id, len(words) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT::DOUBLE + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (row_no)
), ranked AS (
  SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST, row_no) AS rank
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM ranked) * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (row_no)
"""
