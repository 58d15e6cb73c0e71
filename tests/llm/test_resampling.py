"""Operator 11 against brute force and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from casewatch.llm import resampling

SF = "/root/testdata/sf0.001"
COLS = ["doc_id", "n_features", "weight", "score", "rank"]


def runs(text, max_words):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i : i + n]) for n in range(1, max_words + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=10, min_words=20, max_words=1, buckets=10_000, seed=2024):
    """docs: (doc_id, text). Rows without rank as dicts, and the drawn ranks as {doc_id: rank}."""
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(at(f) for _, t in docs for f in runs(t, max_words)[1])
    t = Counter(at(f) for x in target for f in runs(x, max_words)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out, pool = [], []
    for no, (doc_id, text) in enumerate(docs):
        words, feats = runs(text, max_words)
        weight = sum(gain[at(f)] for f in feats)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(feats), weight, score, None])
        if len(words) >= min_words:
            pool.append((-score, doc_id is None, doc_id or 0, no))
    for rank, (*_, no) in enumerate(sorted(pool)[: len(pool) * percent // 100], 1):
        out[no][4] = rank
    return sorted(map(tuple, out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def test_twin(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = con.execute(f"SELECT {', '.join(COLS)} FROM ({resampling.OP11_SQL})").fetchall()
    df = resampling.op11_resampling(spark, SF)
    assert dict(df.dtypes) == dict.fromkeys(COLS, "bigint")
    assert got(df) == sorted(want, key=repr)


@pytest.mark.parametrize("max_words,percent,buckets", [(1, 10, 10_000), (2, 37, 500), (3, 100, 64), (1, 0, 64)])
def test_brute_force(spark, work, max_words, percent, buckets):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    df = resampling.resample(docs, target, work(), percent=percent, min_words=30, max_words=max_words, buckets=buckets)
    texts = [r.text for r in target.collect()]
    assert got(df) == brute([tuple(r) for r in docs.collect()], texts, percent, 30, max_words, buckets)


def test_ties_and_repeats(spark, work):
    """A third of the rows repeats one id and text; many others tie in score by a common id hash."""
    rows = [(7, "alpha beta gamma")] * 30 + [(i, "alpha beta") for i in range(30)] + [(None, "delta eps zeta")] * 30
    df = resampling.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), spark.createDataFrame([("alpha",)], "text string"), work(), percent=50, min_words=1)
    out = got(df)
    want = brute(rows, ["alpha"], 50, 1)
    assert len(out) == 90 and sorted(r[4] for r in out if r[4]) == list(range(1, 46))
    assert Counter((r[0], r[3]) for r in out if r[4]) == Counter((r[0], r[3]) for r in want if r[4])
    assert [r[3] for r in sorted((r for r in out if r[4]), key=lambda r: r[4])] == [r[3] for r in sorted((r for r in want if r[4]), key=lambda r: r[4])]


@pytest.mark.parametrize("quota", [1, 2, 499, 500, 501, 998, 999])
def test_cutoff(spark, quota):
    rng = np.random.default_rng(quota)
    values = np.concatenate([rng.integers(-(10**12), 10**12, 500), np.full(300, 5), rng.integers(-3, 3, 200)]).tolist()
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long").cache()
    order = [F.col("v"), F.bitwise_not("i")]
    taken = rows.where(resampling.drawn(rows, quota, order)).collect()
    want = sorted((-v, i) for i, v in enumerate(values))[:quota]
    assert sorted((-r.v, r.i) for r in taken) == want
    rows.unpersist()


def test_odd_rows(spark, odd_docs, no_docs, work):
    target = spark.createDataFrame([("the cat and the dog",), (None,)], "text string")
    out = got(resampling.resample(odd_docs, target, work(), percent=50, min_words=2))
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert out == brute(rows, ["the cat and the dog"], 50, 2)
    assert resampling.resample(no_docs, target, work()).count() == 0
    none = target.limit(0)
    assert got(resampling.resample(odd_docs, none, work(), min_words=2)) == brute(rows, [], 10, 2)


def test_ranks_take_no_single_task(spark, work):
    """Ranks come from range partitions: no window and no single-partition exchange."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = resampling.resample(docs, spark.read.parquet(f"{SF}/benchmark.parquet"), work())._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
