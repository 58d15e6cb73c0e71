"""Operator 12 against SQL, brute force and on odd rows."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from casewatch.llm import phrases as P
from casewatch.llm.hashing import filter_of, passes

SF = "/root/testdata/sf0.001"
COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=30, longest=4, covered=80, top=2000):
    """rows: (text, lang). The report by counting every run."""
    f, words_of = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            words_of["und" if lang is None else lang] += len(w)
            for n in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + n]
            for p, a in cands.items()
            for n in range(2, len(p))
            for i in range(len(p) - n + 1)
            if 100 * a >= covered * cands[p[i : i + n]]
        }
        rows_of = []
        for p, a in cands.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                rows_of.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words_of[lang], -s))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def made(seed=3, n=400):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [f"w{min(rng.randrange(40), rng.randrange(40))}" for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            words[len(words) // 2 : len(words) // 2] = rng.choice(["New York City", "state of the art", "ÉTÉ été", "a\tb  c"]).split(" ")
        texts.append((rng.choice(" ,.\n").join(words) if rng.random() < 0.1 else " ".join(words).replace("w1 ", "w1, ")))
    return [(i, t, rng.choice(["en", "fr", None, "und"])) for i, t in enumerate(texts)]


def test_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(COLS)} FROM ({P.OP12_SQL})").fetchall()
    df = P.op12_phrases(spark, SF)
    assert {c: t for c, t in df.dtypes if t != "bigint"} == {"lang": "string", "phrase": "string"}
    assert want and got(df) == sorted(map(tuple, want), key=repr)


@pytest.mark.parametrize("least,sample,sample_least,longest", [(6, 4, 3, 4), (6, 50, 1, 4), (3, 2, 40, 3), (10, 1, 10, 2)])
def test_brute_force(spark, work, least, sample, sample_least, longest):
    """Samples that propose nearly nothing must give the same rows."""
    rows = made()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    want = brute([r[1:] for r in rows], least, longest, top=300)
    assert len(want) > 30
    assert got(P.phrases(df, work(), least=least, longest=longest, top=300, sample=sample, sample_least=sample_least)) == want


def test_border_failures_are_expanded(spark, work, monkeypatch):
    """Nothing is proposed: runs of three and four words are found by expansion alone."""
    rows = [(i, "alpha beta gamma delta", "en") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    passes_made = []
    plain = P.count_runs
    monkeypatch.setattr(P, "count_runs", lambda *a: passes_made.append(a[3:]) or plain(*a))
    out = got(P.phrases(df, work(), sample=7, sample_least=1000))
    assert [r[2] for r in out] == ["alpha beta gamma delta"]
    assert passes_made == [(2, 2), (3, 3), (2, 4), (3, 4), (3, 4)]  # two of the sample, the full one, two expansions


def test_cut_runs():
    words = P.tokens(b"The CAT sat, the dog.. one\ttwo rare three")
    m = b"\xff"
    assert words == [b"the", b"cat", b"sat", m, b"the", b"dog", m, m, b"one", b"two", b"rare", b"three", m]
    h = P.word_hashes(words, "en")
    assert [x == 0 for x in h] == [w == m for w in words] and h[0] == h[4]
    every = np.full(1 << 10, 2**64 - 1, np.uint64)
    out, kept = P.cut_runs(h, every)
    assert out[kept].tolist() == [*h[:3], 0, *h[4:6], 0, *h[8:12], 0]
    h[10] = 0  # not frequent; 'three' is then alone
    out, kept = P.cut_runs(h, every)
    assert out[kept].tolist() == [*h[:3], 0, *h[4:6], 0, *h[8:10], 0]
    out, kept = P.cut_runs(h, np.zeros(1 << 10, np.uint64))
    assert out[kept].tolist() == []


def test_chunks_keep_texts_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(P, "_CHUNK_BYTES", 20)
    rows = pa.RecordBatch.from_pydict({"text": [b"a b", None, b"", b"c d. e", b"f" * 50], "lang": ["x", None, "x", "x", "und"], "picked": [True, False, False, False, True]})
    got = list(P.chunks(iter([rows, rows])))
    m = b"\xff"
    assert sum(w.count(m) for _, w, _ in got) == 12 and {lang for lang, *_ in got} == {"x", "und"}
    assert all(w[-1] == m and len(w) == len(flags) for _, w, flags in got)
    assert sorted(w for _, ws, flags in got for w, f in zip(ws, flags) if f and w != m) == sorted([b"a", b"b", b"f" * 50] * 2)


def test_rare_pairs_are_cut_before_the_passes(spark, work, monkeypatch):
    """Every word is frequent, but one pair only: no pass counts any other run."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha beta", *(f"w{i}" for i in range(60))]) for _ in range(30)) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    want = brute([(t, "en") for t in texts], 30)
    counted, plain = [], P.count_runs
    monkeypatch.setattr(P, "count_runs", lambda *a: counted.append(plain(*a).count()) or plain(*a))
    monkeypatch.setattr(P, "_FLUSH_PAIRS", 500)
    assert got(P.phrases(df, work())) == want and [r[2] for r in want] == ["alpha beta"]
    assert max(counted) <= 3


@pytest.mark.parametrize("parts", [1, 3])
def test_cells(spark, monkeypatch, parts):
    monkeypatch.setattr(P, "_CELLS", 1 << 12)
    cells = P.cells_of(np.random.default_rng(3).integers(0, 2**64, 3000, np.uint64), parts)
    cells = np.concatenate([cells, np.repeat(cells[:4], 50)])
    found = []
    for part, size, steps in zip(*(c.to_pylist() for c in P.packed_cells(cells, parts, 30).columns), strict=True):
        found += (P._places(size, steps) + part * P._CELLS).tolist()
    want = Counter(cells.tolist())
    assert Counter(found) == {c: min(n, 30) for c, n in want.items()} and max(want.values()) > 30


def test_cut_pairs():
    h = np.array([5, 6, 7, 0, 8, 9, 4, 3, 0], np.uint64)
    passed = np.array([1, 0, 0, 0, 0, 1, 1, 0], bool)
    assert P.cut_pairs(h, passed).tolist() == [5, 6, 0, 9, 4, 3, 0]
    assert P.cut_pairs(h, np.zeros(8, bool)).tolist() == [] == P.cut_pairs(h[:0], passed[:0]).tolist()


def test_phrases_of_parts(spark, work, monkeypatch):
    """Rows of many phrases, several a part and language, give each phrase once."""
    rows = made(n=60)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    texts = df.selectExpr("cast(text as binary) AS text", "lang")
    every = np.full(1 << 10, 2**64 - 1, np.uint64)
    monkeypatch.setattr(P, "_FLUSH_PHRASES", 40)
    monkeypatch.setattr(P, "_CHUNK_BYTES", 300)
    found = {(r.lang, r.phrase): r.n for r in P.count_phrases(texts, every, 3, 5).collect()}
    want = Counter()
    for _, text, lang in rows:
        words = [w.decode() if w != b"\xff" else None for w in P.tokens(text.encode())]
        lang = lang or "und"
        want[lang, ""] += sum(w is not None for w in words)
        want.update((lang, " ".join(words[i : i + n])) for n in (1, 2, 3) for i in range(len(words) - n + 1) if None not in words[i : i + n])
    assert found == dict(want)


def test_filter(spark):
    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    words = filter_of(spark.createDataFrame([(int(x),) for x in h[:2500]], "h long"), "h")
    assert passes(words, h[:2500].view(np.uint64)).all()
    assert passes(words, h[2500:].view(np.uint64)).mean() < 0.05
    small = filter_of(spark.createDataFrame([(int(x),) for x in h], "h long"), "h", 1 << 10)
    assert len(small) == 16 and passes(small, h.view(np.uint64)).all()


def test_odd_rows(spark, odd_docs, no_docs, work):
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    df = odd_docs.selectExpr("*", "'clash' AS phrase", "1 AS h", "2 AS n", "'x' AS words")
    assert got(P.phrases(df, work(), least=2)) == brute(rows, 2)
    assert P.phrases(no_docs, work()).count() == 0


def test_products_past_64_bits(spark, work):
    big = 6_000_000_000_000_000_000
    counts = spark.createDataFrame([("en", "", big), ("en", "a b", big - 1), ("en", "a", big), ("en", "b", big)], "lang string, phrase string, n long")
    assert got(P.scored(counts, work(), 30, 80, 10)) == [("en", 1, "a b", big - 1, big, big, big, 2_000_000 * (big - 1) // (2 * big))]
