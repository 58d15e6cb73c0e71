"""Operator 13 against brute force over all pairs and on odd rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewatch.llm import jaccard_join as J

SF = "/root/testdata/sf0.001"


def brute_set(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, percent=85, k=4):
    """(doc_id, n_shingles, component_id) of every row, comparing all pairs of distinct sets."""
    sets = [brute_set(t, k) for _, t in rows]
    distinct = list({frozenset(s) for s in sets if s})
    up = list(range(len(distinct)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(distinct):
        for j in range(i):
            both = len(a & distinct[j])
            if 100 * both >= percent * (len(a) + len(distinct[j]) - both):
                up[find(i)] = find(j)
    at = {s: find(i) for i, s in enumerate(distinct)}
    ids = {}
    for (doc_id, _), s in zip(rows, sets, strict=True):
        if s:
            ids.setdefault(at[frozenset(s)], []).append(doc_id)
    least = {root: min((i for i in found if i is not None), default=None) for root, found in ids.items()}
    out = [(d, len(s), least[at[frozenset(s)]] if s else d) for (d, _), s in zip(rows, sets, strict=True)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("percent", [85, 70, 95])
def test_linked_sets_share_a_signature(percent):
    rng = random.Random(percent)
    linked = 0
    for _ in range(1500):
        size = rng.choice([1, 2, 5, 6, 7, 8, 9, 11, 13, 16, 20, 31, 50, 90, 200, 500])
        x = np.array([rng.getrandbits(64) for _ in range(size)], np.uint64)
        gone, new = rng.randint(0, size * (100 - percent) // 100 + 1), rng.randint(0, size * (100 - percent) // 100 + 1)
        y = np.concatenate([x[gone:], np.array([rng.getrandbits(64) for _ in range(new)], np.uint64)])
        both = len(x[gone:])
        if len(y) and 100 * both >= percent * (len(x) + len(y) - both):
            linked += 1
            assert set(J.signatures(x, percent).tolist()) & set(J.signatures(y, percent).tolist())
            assert int(np.bitwise_count((J.sketch(x) ^ J.sketch(y)).view(np.uint64)).sum()) <= len(x) + len(y) - 2 * both
    assert linked > 400


def test_bands():
    """Linked sizes are in the same band or in neighbouring ones."""
    for size in range(1, 3000):
        assert J.band_of(size * 100 // 85, 85) - J.band_of(size, 85) in (0, 1)
        assert J.band_top(J.band_of(size, 85) - 1, 85) < size <= J.band_top(J.band_of(size, 85), 85)


@pytest.mark.parametrize("percent,heavy", [(85, 64), (60, 64), (60, 2)])
def test_brute_force(spark, work, percent, heavy):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], percent)
    assert got(J.jaccard_classes(docs, work(), percent=percent, heavy=heavy)) == want


def test_families(spark, work):
    """Two families of near copies of one text each, chains of links inside
    them, exact copies, and a passage that all other texts share."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for family in range(2):
        base = [f"f{family}w{i}" for i in range(120)]
        for _ in range(90):
            text = list(base)
            for _ in range(rng.randint(0, 7)):
                text[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(text))
        rows += [" ".join(base)] * 20
    rows += [passage + " " + " ".join(f"o{i}a{j}" for j in range(rng.randint(0, 40))) for i in range(60)]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert len({r[2] for r in want}) > 20
    assert got(J.jaccard_classes(df, work(), heavy=16)) == want
    assert got(J.jaccard_classes(df, work(), heavy=10**6)) == want


def test_sets_that_just_miss_each_other_are_told_apart(spark):
    """Sixty sets of 400 with 70 to 90 differences where 64 are allowed, in five groups."""
    rng = random.Random(8)
    base, made = [rng.getrandbits(64) for _ in range(362)], []
    for _ in range(60):
        made.append(np.array(base + [rng.getrandbits(64) for _ in range(rng.randint(38, 42))], np.uint64))
    for x, y in zip(made, made[1:], strict=False):
        differ = len(x) + len(y) - 2 * 362
        for sketch in (J.sketch, J.wide_sketch):
            assert int(np.bitwise_count((sketch(x) ^ sketch(y)).view(np.uint64)).sum()) <= differ
    short = [(sig, i, len(h), *map(int, J.sketch(h))) for i, h in enumerate(made) for sig in range(5)]
    members = spark.createDataFrame(short, "sig long, node long, n long, " + ", ".join(f"{c} long" for c in J._SKETCH))
    wide = spark.createDataFrame([(i, *map(int, J.wide_sketch(h))) for i, h in enumerate(made)], "node long, " + ", ".join(f"{c} long" for c in J._WIDE))
    fold = wide.select("node", *J._folded()).collect()
    assert all(tuple(r)[1:] == tuple(J.sketch(made[r.node]).tolist()) for r in fold)
    roots = spark.createDataFrame([], "node long, root long")
    passed = J.light_pairs(members, 85).count()
    assert passed > 1500 and J.apart_pairs(members, roots, wide, 85).count() < passed / 20


def test_odd_rows(spark, odd_docs, no_docs, work):
    df = odd_docs.withColumn("node", F.lit("clash")).withColumn("sig", F.lit(1)).withColumn("first_id", F.lit(2))
    assert got(J.jaccard_classes(df, work())) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert J.jaccard_classes(no_docs, work()).count() == 0


def test_clashing_names_are_replaced():
    text = b"one two three four five"
    _, node, second = J._named(4, frozenset())(text)
    assert J._named(4, frozenset([node]))(text)[1:] == (second, second)
