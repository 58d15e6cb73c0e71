"""Operators 2, 5 and 6: the models themselves, held-out accuracy, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from casewatch.llm import langid, lm, lm_scoring, toxicity
from casewatch.llm.common import Workspace

SF = "/root/testdata/sf0.01"


def bucket(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


# 2 ------------------------------------------------------------------------------------------


def tiny_net(n=11, classes=3):
    counts = np.arange(n, 0, -1).astype(float)
    net = lm.Net.fresh(counts, classes, dim=lm.DIM)
    rng = np.random.default_rng(0)
    net.all += rng.normal(0, 0.2, net.all.shape).astype(np.float32)
    return net


def test_probabilities_sum_to_one():
    net = tiny_net()
    s = np.random.default_rng(1).normal(size=(5, lm.DIM)).astype(np.float32)
    total = sum(np.exp(net.log_probs(s, np.full(5, w))) for w in range(11))
    assert np.allclose(total, 1, atol=1e-5)


def test_gradients():
    net = tiny_net()
    net = lm.Net(net.bounds, {k: v.astype(np.float64) for k, v in net.p.items()})
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 11, (4, 3)), rng.integers(0, 11, (4, 3))
    begin = np.zeros((4, 3), bool)
    begin[0] = begin[2, 1] = True
    h0 = np.zeros((3, lm.DIM), np.float32)

    def loss():
        states, _ = net.run(x, begin, h0)
        return -net.log_probs(states.reshape(-1, lm.DIM).astype(np.float64), y.ravel()).mean()

    tape, grad = [], net.zeros()[1]
    states, _ = net.run(x, begin, h0, tape)
    net.log_probs(states.reshape(-1, lm.DIM), y.ravel(), grad)
    net.back(x, tape, grad.pop("s").reshape(4, 3, lm.DIM), grad)
    for k, v in net.p.items():
        for at in rng.integers(0, v.size, 4):
            old, eps = v.flat[at], 1e-3
            v.flat[at] = old + eps
            up = loss()
            v.flat[at] = old - eps
            down = loss()
            v.flat[at] = old
            assert abs((up - down) / (2 * eps) - grad[k].flat[at]) < 2e-3, k


def test_lanes_cover_every_token_once_and_carry_state():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 9, n).astype(np.int32) for n in (0, 1, 5, 16, 33, 100, 3, 17)]
    seen = {i: [] for i in range(len(docs))}
    for x, y, begin, who in lm.lanes(docs, 9, 3):
        for lane in range(x.shape[1]):
            for t in range(len(x)):
                if who[t, lane] >= 0:
                    seen[who[t, lane]].append((x[t, lane], y[t, lane], begin[t, lane]))
    for i, d in enumerate(docs):
        full = [9, *d, 9]
        assert [(a, b) for a, b, _ in seen[i]] == list(zip(full[:-1], full[1:], strict=True))
        assert [c for _, _, c in seen[i]] == [True] + [False] * len(d)
    net = tiny_net()
    together = lm.score(net, docs, 9, 3)
    alone = [lm.score(net, [d], 9)[0] for d in docs]  # neither lanes nor windows change a likelihood
    assert np.allclose(together, alone, atol=1e-3)
    states, _ = net.run(np.append(9, docs[5])[:, None], np.eye(101, 1, dtype=bool), np.zeros((1, lm.DIM), np.float32))
    assert abs(net.log_probs(states[:, 0], np.append(docs[5], 9)).sum() - alone[5]) < 1e-3


def test_training_learns_a_pattern():
    docs = [np.array([1, 2, 3, 4] * 20, np.int32) for _ in range(64)]
    net = lm.Net.fresh(np.array([1, 20, 20, 20, 20.0]), 3)
    before = lm.score(net, docs, 0)[0]
    adam = {}
    for _ in range(12):
        lm.train(net, docs, 0, 16, 0.02, adam)
    assert lm.score(net, docs, 0)[0] > 0.3 * before


def test_scoring_takes_the_softmax_of_many_windows_at_once(monkeypatch):
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 9, n).astype(np.int32) for n in (0, 700, 40, 16, 300, 5)]
    net, calls, plain = tiny_net(), [], lm.Net.log_probs

    def counted(self, s, *a, **k):
        calls.append(len(s))
        return plain(self, s, *a, **k)

    monkeypatch.setattr(lm.Net, "log_probs", counted)
    at_once = lm.score(net, docs, 9, 2)
    assert calls == [sum(map(len, docs)) + len(docs)]
    monkeypatch.setattr(lm, "SCORED", 1)
    assert np.allclose(lm.score(net, docs, 9, 2), at_once, rtol=1e-6) and len(calls) > 20


@pytest.mark.parametrize("scale", [1, 30, 400])
def test_log_probs_of_any_weights(scale):
    """Logits far out of the range of exp, and each row's own shift."""
    net = tiny_net()
    net.all *= scale
    p, b = {k: v.astype(np.float64) for k, v in net.p.items()}, net.bounds
    s = np.random.default_rng(5).uniform(-1, 1, (3000, lm.DIM)).astype(np.float32)
    y = np.arange(3000) % 11
    soft = lambda z: z - z.max() - np.log(np.exp(z - z.max()).sum())
    got = net.log_probs(s, y)
    for i in range(0, 3000, 7):
        c, x = net.class_of[y[i]], s[i].astype(np.float64)
        want = soft(p["wc"] @ x + p["bc"])[c] + soft(p["ww"][b[c] : b[c + 1]] @ x + p["bw"][b[c] : b[c + 1]])[y[i] - b[c]]
        assert got[i] == pytest.approx(want, rel=1e-4, abs=1e-3 * scale)


def test_lm_scores(spark, work):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in lm_scoring.log_likelihood(docs, work()).collect()}
    texts = {r.doc_id: lm_scoring.words((r.text or "").encode()) for r in docs.collect()}
    counts = Counter()
    for d, ws in texts.items():
        if bucket(d, 7) != 2:
            counts.update([*ws, b" "])
    n, v = sum(counts.values()), len(counts)
    gain = 0.0
    for d, ws in texts.items():
        r, tokens = got[d], [*ws, b" "]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (bucket(d, 7) == 2, len(tokens), n)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel=1e-9)
        if r.held_out:
            gain += r.score - r.base_score
    assert gain > 0


def test_lm_odd_rows(odd_docs, no_docs, work, monkeypatch):
    monkeypatch.setattr(lm_scoring, "KNOWN", 6)  # most tokens take the join
    monkeypatch.setattr(lm_scoring, "VOCAB", 4)
    got = lm_scoring.log_likelihood(odd_docs, work()).collect()
    assert len(got) == odd_docs.count()
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    twice = [r for r in got if r.doc_id == 2]
    assert len(twice) == 2 and twice[0].score == pytest.approx(twice[1].score, rel=1e-5)
    assert lm_scoring.log_likelihood(no_docs, work()).count() == 0


def test_classes_make_a_token_need_few_outputs():
    counts = 1e8 / np.arange(2, 14_002)
    counts[0] = 0.4 * counts.sum()  # all tokens without an output of their own
    share, bounds = counts / counts.sum(), lm.word_classes(counts, 84)
    sizes = np.diff(bounds)
    needed = len(sizes) + (np.add.reduceat(share, bounds[:-1]) * sizes * (sizes > 1)).sum()
    assert len(sizes) >= 80 and bounds[-1] == len(counts)
    assert needed < 1.1 * 2 * np.sqrt(share).sum()  # the least that two steps can need, nearly


def test_optimiser_stretches_do_not_change_the_training(monkeypatch):
    docs = [np.random.default_rng(i).integers(0, 9, 40).astype(np.int32) for i in range(20)]
    nets = []
    for stretch in (1 << 20, 7):
        monkeypatch.setattr(lm, "STRETCH", stretch)
        nets.append(lm.Net.fresh(np.arange(9, 0, -1.0), 3))
        before, adam = nets[-1].flat(), {}
        lm.train(nets[-1], docs, 0, 4, 0.02, adam)
        lm.train(nets[-1], docs, 0, 4, 0.02, adam)
    assert np.allclose(nets[0].all, nets[1].all, atol=1e-6) and np.abs(nets[0].all - before).max() > 0.01


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_arrow_tokens_are_the_words(kind, monkeypatch):
    texts = [b"", b" \t", b"Aa\x0bB\x0c c  ", *(b"x" + bytes([b]) + b"Y" for b in range(256)), b"", b"\xc3\x89\xff \x00 \x85\x1c"]
    column = pa.array([b"sliced off", *texts], kind).slice(1)
    tokens, at = lm_scoring.tokens_of(column)
    tokens = tokens.to_pylist()
    assert [tokens[a:b] for a, b in zip(at[:-1], at[1:], strict=True)] == [lm_scoring.words(t) for t in texts]
    monkeypatch.setattr(lm_scoring, "TEXT_BYTES", 5)
    parts = list(lm_scoring.stretches(column))
    assert len(parts) > 100 and pa.concat_arrays(parts).equals(column)
    monkeypatch.setattr(lm_scoring, "COUNT_BYTES", 40)
    counted = Counter()
    for batch in lm_scoring._count([pa.RecordBatch.from_arrays([column], ["text"])]):
        for token, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counted[token] += n
    assert counted == Counter(tokens) + Counter({lm_scoring.END: len(texts)})


def test_model_vocabulary_grows_with_the_corpus():
    tokens = [b" ", *(b"w%d" % i for i in range(9_999))]
    counts = np.arange(10_000, 0, -1)
    sizes = [lm_scoring.Vocabulary(tokens, counts, 10**8, n).size for n in (20_000, 404_216, 1_000_000)]
    assert sizes == [2048, 5080, 8000]
    assert lm_scoring.ROUNDS == len(lm_scoring.RATES) == 4


def test_vocabulary_shares_sum_to_one():
    counts = np.array([50, 20, 9, 5, 3, 2])
    vocab = lm_scoring.Vocabulary([b"a", b"b", b" ", b"c", b"d", b"e"], counts, int(counts.sum()) + 4, 10)
    vocab.size = 3
    rest = 4 + 5 + 3 + 2
    scale = rest + 7 + 1  # four rare types beyond the table, three within, one unseen
    total = sum((c + 1) / scale for c in (5, 3, 2, 1, 1, 1, 1)) + 1 / scale
    assert total == pytest.approx(1)


# 5 ------------------------------------------------------------------------------------------


def test_bag_is_every_gram_inside_a_word():
    s = toxicity.symbols("Abc  d!ef")
    assert "".join(chr(c) if c else "_" for c in s) == "_abc_d_ef_"
    word, _ = toxicity.bag(s)
    # _abc_: 3 + 2 + 1 grams of 3, 4, 5; _d_: 1; _ef_: 2 + 1
    assert Counter(word.tolist()) == {0: 6, 1: 1, 2: 3}


def test_distinct_words_and_cuts(monkeypatch):
    monkeypatch.setattr(toxicity, "WINDOW", 4)
    s = toxicity.symbols("a b a b c a d d")
    kept, window = toxicity.distinct_words(s)
    assert "".join(chr(c) if c else "_" for c in kept) == "_a_b_c_a_d_"
    assert window.tolist() == [0, 0, 1, 1, 1]
    monkeypatch.setattr(toxicity, "CHUNK", 10)
    parts = ["".join(chr(c) if c else "_" for c in p) for p in toxicity._cuts(toxicity.symbols("aa bb cc dd ee ff gg hh ii"))]
    assert parts == ["_aa_bb_cc_dd_", "_ee_ff_gg_hh_", "_ii_"]


def test_toxicity_held_out(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 150)
    sf = "/root/testdata/sf0.1"  # the smaller tables have some thirty toxic texts to learn from
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (bucket(d, 3) == 1) and r.predicted == (r.score >= 0.7) for d, r in got.items())
    held = [(got[d].score, t) for d, t in truth.items() if got[d].held_out]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in bad for b in good])
    assert auc > 0.9 and np.mean([s >= 0.7 for s in good]) < 0.03


def test_unseen_misspelling_shares_grams():
    texts = ["what an idiot you are", "this idiot again", "idiots all of them"] * 8 + ["what a day this is", "the train again", "all of them came"] * 8
    model = toxicity.fit(texts, np.array([1] * 24 + [0] * 24))
    assert model.score("such an idiotic idea") > model.score("such an excellent idea")


def test_toxicity_sample_has_one_row_an_id(spark):
    rows = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other"), (3, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    got = toxicity.sample(rows, labels).collect()
    assert sorted(r.toxic for r in got) == [0, 1]
    assert sorted(r.text for r in toxicity.sample(rows.repartition(5), labels).collect()) == sorted(r.text for r in got)


def test_toxicity_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 3)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (6, 0), (8, 0), (9, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert {r.score for r in toxicity.toxicity(odd_docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(no_docs, labels).count() == 0


# 6 ------------------------------------------------------------------------------------------


def trigram_counts(texts):
    c = Counter()
    for t in texts:
        s = langid.symbols(t).tolist()
        c.update(zip(s, s[1:], s[2:], strict=False))
    return c


def test_kneser_ney_by_hand():
    texts = ["abab cab", "bab a", "cabba"]
    c = trigram_counts(texts)
    pack = lambda g: (g[0] << 42) | (g[1] << 21) | g[2]
    grams = sorted(c)
    model = langid.KneserNey(np.array([pack(g) for g in grams], np.uint64), np.array([c[g] for g in grams], float))

    def disc(counts):
        n1, n2 = sum(x == 1 for x in counts), sum(x == 2 for x in counts)
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    pairs = Counter((v, w) for _, v, w in c)  # distinct left extensions
    words = Counter(w for _, w in pairs)
    d1, d2, d3 = disc(words.values()), disc(pairs.values()), disc(c.values())

    def p1(w):
        unk = d1 * len(words) / sum(words.values()) / (len(words) + 1)
        return max(words[w] - d1, 0) / sum(words.values()) + unk

    def p2(v, w):
        total = sum(n for (a, _), n in pairs.items() if a == v)
        if not total:
            return p1(w)
        kinds = sum(a == v for a, _ in pairs)
        return max(pairs[v, w] - d2, 0) / total + d2 * kinds / total * p1(w)

    def p3(u, v, w):
        total = sum(n for (a, b, _), n in c.items() if (a, b) == (u, v))
        if not total:
            return p2(v, w)
        kinds = sum((a, b) == (u, v) for a, b, _ in c)
        return max(c[u, v, w] - d3, 0) / total + d3 * kinds / total * p2(v, w)

    letters = [0, *map(ord, "abcz")]
    for u in letters:
        for v in letters:
            got = np.exp(model.log_prob(np.array([pack((u, v, w)) for w in letters], np.uint64)))
            assert np.allclose(got, [p3(u, v, w) for w in letters], rtol=1e-4)
    assert sum(p3(ord("a"), ord("b"), w) for w in letters) == pytest.approx(1)  # z stands for the one unseen symbol


def test_trigrams_dense_and_sorted_paths_agree(monkeypatch):
    texts = ["Der Hund", "日本語のテキスト " * 30, "x", "".join(chr(0x4E00 + i) for i in range(400))]
    for chunk in (1 << 20, 40):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        got = Counter()
        for _, pieces in langid._pieces(texts):
            keys, code, ends = langid.trigrams(pieces)
            assert ends[-1] == len(code)
            for k, n in zip(keys.tolist(), np.bincount(code, minlength=len(keys)).tolist(), strict=True):
                got[k >> 42, k >> 21 & 0x1FFFFF, k & 0x1FFFFF] += n
        assert got == trigram_counts(texts)


def test_language_held_out(spark, work):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in langid.identify(docs, work()).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [d for d in got if got[d].held_out]
    assert all(got[d].held_out == (bucket(d, 5) == 0) for d in got)
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.97
    assert np.mean([r.rejected for r in got.values()]) < 0.01
    assert all(0 <= r.score <= 1 for r in got.values())


def test_noise_is_rejected_and_clean_text_kept(spark, work):
    rng = np.random.default_rng(4)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    noise = ["".join(rng.choice(list("qxzjkwvy "), 400)) for _ in range(5)] + ["これは日本語の文章です。" * 20, "12 34 56", ""]
    more = spark.createDataFrame([(10_000_000 + i, t, None) for i, t in enumerate(noise)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in langid.keep_identified(docs.unionByName(more), work()).collect()}
    assert not any(10_000_000 + i in kept for i in range(len(noise)))
    assert len(kept) > 0.99 * docs.count()


def test_language_odd_rows(odd_docs, no_docs, work):
    got = langid.identify(odd_docs, work()).collect()
    assert len(got) == odd_docs.count()
    assert all((r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in got if r.doc_id in (3, 4, 5, 7))
    assert langid.identify(no_docs, work()).count() == 0
    kept = langid.keep_identified(odd_docs, work())
    assert kept.columns == odd_docs.columns and {r.entropy for r in kept.collect()} <= {"clash"}


def test_workspace_is_used_once(spark):
    assert Workspace(spark, "a").root != Workspace(spark, "a").root


def test_models_too_large_to_hold_are_joined_whole(spark, odd_docs, work, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").union(odd_docs.select("doc_id", "text", "lang"))
    held = sorted(langid.identify(docs, work()).collect(), key=str)
    monkeypatch.setattr(langid, "MAX_NGRAMS", 100)
    joined = sorted(langid.identify(docs, work()).collect(), key=str)

    def shown(rows):
        return sorted((str(r.doc_id), r.held_out, r.lang_pred, r.n_symbols, r.rejected, round(r.score, 3), r.entropy and round(r.entropy, 3)) for r in rows)

    def near(a, b):
        return all(x[:5] == y[:5] and x[5] == pytest.approx(y[5], abs=0.01) and (x[6] is None) == (y[6] is None) and (x[6] is None or x[6] == pytest.approx(y[6], abs=0.01)) for x, y in zip(a, b, strict=True))

    assert near(shown(held), shown(joined))
