"""Operators 4, 9 and 10 and the pipeline against brute force, odd rows."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from casewatch.llm import components, html_text, line_dedup, mixing, simhash
from casewatch.llm.html_text import parse, text_of

SF = "/root/testdata/sf0.001"


# 4 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>a  b<p>c<br>d", "a b c d"),
        ("<article><h1>T&amp;t</h1><p><b>x<br><p>y</p></article><footer>f</footer>", "T&t x y"),
        ("<body><nav><ul><li>m</li></ul></nav><div class='ad'>buy</div><div id=post>text</div></body>", "text"),
        ("<article>a<script>var t='</p>';x<y</script>b<style>p{}</style>c</article>", "abc"),
        ("<article>a<aside>s</aside><form>f<input></form><div class=comments>c</div><p>b</p></article>", "a b"),
        ("<article><header><h1>h</h1></header><p>b</article><header>x</header>", "h b"),
        ("<p>caf&eacute; &#233; &#xe9; &lt;i&gt; &bogus;</p>", "café é é <i> &bogus;"),
        ("<!-- <p>no</p> --><p>yes<!-- never closed", "yes"),
        ("<p>2 < 3 and <b>bold</b>ness</p>", "2 < 3 and boldness"),
        ("<div hidden>x</div><div style='display:none'>y</div><p>z</p>", "z"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<p title='a>b'>t</p>", "t"),
        ("<p class='download readme'>t</p>", "t"),
        ("<p>cut <a href='x", "cut"),
        ("</p></div>text</b>", "text"),
        ("", ""),
        (None, ""),
    ],
)
def test_extraction(html, want):
    assert text_of(parse(html)) == want


def test_deep_nesting_does_not_overflow():
    assert text_of(parse("<div>" * 5000 + "x" + "</div>" * 5000)) == "x"


def site(rng, n, host, extra=""):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    shared = "<p>A passage that stands on very many pages of this site.</p>"
    pages = []
    for i in range(n):
        body = " ".join(word() for _ in range(30))
        html = f"<body><div class=x1><b>Site</b> slogan</div><div class=x2><ul><li>one<li>two</ul></div><div class=x3><h1>t{i}</h1><p>{body}</p>{shared}</div><div class=x4>Imprint {extra}</div></body>"
        pages.append((i, f"http://{host}/p{i}", html, f"t{i} {body} A passage that stands on very many pages of this site."))
    return pages


def test_templates_are_counted_per_host(spark, work):
    rng = random.Random(1)
    pages = site(rng, 40, "a.example") + site(rng, 3, "b.example", "other")
    df = spark.createDataFrame([(i, *p[1:3]) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in html_text.extract(df, work()).collect()}
    for i, p in enumerate(pages):
        want = p[3] if i < 40 else f"Site slogan one two {p[3]} Imprint other"  # three pages are no template
        assert got[i] == want


def test_pages(spark, work):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in html_text.extract(df, work()).join(df.select("page_id", "html"), "page_id").collect():
        inner = r.html[r.html.index("<article>") + 9 :].partition("</article>")[0]
        import html as h
        import re

        want = " ".join(" ".join(h.unescape(x).split()) for x in re.split(r"<[^>]*>", inner) if x.strip())
        assert r.text == want and r.n_chars == len(want)


def test_html_odd_rows(spark, work):
    rows = [(1, None, None), (1, None, None), (None, "x", ""), (2, "http://h/", "<p>" + "word " * 300_000), (3, "HTTP://u@H:80/p", "<p>a")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS text", "'c' AS host", "1 AS template", "0 AS n_chars")
    got = html_text.extract(df, work()).collect()
    assert len(got) == 5 and sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 1_499_999), (3, 1)]
    assert html_text.extract(df.limit(0), work()).count() == 0
    assert {r.host for r in df.select(html_text.host(df.url).alias("host")).collect()} == {"", "h"}


# 9 ------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, bits=4):
    """Smallest index reachable over pairs within ``bits``."""
    a = np.array(fps, np.uint64)
    label = np.arange(len(a))
    near = [np.flatnonzero(np.bitwise_count(a ^ x) <= bits) for x in a]
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_simhash_query(spark):
    got = {r.doc_id: r for r in simhash.op9_simhash(spark, SF).collect()}
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    fps = [brute_fingerprint(t) for _, t in docs]
    assert [got[d].fingerprint for d, _ in docs] == [f"{f:016x}" for f in fps]
    ids = [d for d, _ in docs]
    assert [got[d].component_id for d in ids] == [ids[c] for c in brute_classes(fps)]


@pytest.mark.parametrize("heavy", [2, 48])
def test_links_find_all_classes(spark, work, heavy, monkeypatch):
    """Random points, chains of near points and a dense ball, whatever the
    limit beyond which keys are listed by points."""
    monkeypatch.setattr(simhash, "HEAVY", heavy)
    rng = random.Random(heavy)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, 2**64 - 1, 1 << 63}

    def flip(x, n):
        for b in rng.sample(range(64), n):
            x ^= 1 << b
        return x

    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(6):
            fps.add(x := flip(x, rng.choice([1, 3, 4, 4, 5])))
    center = rng.getrandbits(64)
    fps |= {flip(center, rng.choice([2, 3, 4])) for _ in range(120)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(rows, work()).collect()}
    assert [got[s] for s in signed] == brute_classes(fps)


def test_components(spark, work):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(70)]
    label = {x: x for p in pairs for x in p}
    for _ in range(len(label)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long"), work()).collect()}
    assert got == {x: r for x, r in label.items() if x != r}


def test_simhash_odd_rows(spark, odd_docs, no_docs, work):
    got = simhash.near_duplicates(odd_docs, work()).collect()
    assert len(got) == odd_docs.count()
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert {(r.fingerprint, r.component_id) for r in got if r.doc_id in (3, 4, 5)} == {("0" * 16, 3)}
    kept = simhash.keep_one(odd_docs, work())
    assert kept.columns == odd_docs.columns
    classes = {r.component_id for r in got}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(classes)
    assert simhash.near_duplicates(no_docs, work()).count() == 0 and simhash.keep_one(no_docs, work()).count() == 0
    lone = spark.createDataFrame([(None, "only null ids"), (None, "only null ids")], "doc_id long, text string")
    assert {r.component_id for r in simhash.near_duplicates(lone, work()).collect()} == {None}
    assert simhash.keep_one(lone, work()).count() == 1


# 10 -----------------------------------------------------------------------------------------


def brute_removed(docs, least):
    """Lines of any run of ``least`` words that starts earlier elsewhere."""
    seqs = []
    for _, text in sorted(docs):
        split = (text or "").split("\n")
        seqs.append([(i, x.strip(), len(x.split())) for i, x in enumerate(split) if x.split()])
    out, first = [set() for _ in seqs], {}
    for d, s in enumerate(seqs):
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                run = tuple(x[1] for x in s[a:b])
                if run not in first:
                    first[run] = (d, b)
                elif sum(x[2] for x in s[a:b]) >= least:
                    home, end = first[run]
                    out[d].update(x[0] for x in s[max(a, end) if home == d else a : b])
    return {d: sorted(x) for (d, _), x in zip(sorted(docs), out, strict=True)}


def test_line_dedup_leaves_the_first_of_overlapping_copies(spark, work):
    line = "one two three four five six seven eight nine"
    docs = [(1, "\n".join([line] * 60)), (2, "\n".join([line] * 7)), (None, "\n".join([line] * 6))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.removed for r in line_dedup.repeated_lines(df, work()).collect()}
    assert got == {1: list(range(6, 60)), 2: list(range(7)), None: list(range(6))}


@pytest.mark.parametrize("least", [1, 7, 12])
def test_line_dedup_brute_force(spark, work, least):
    rng = random.Random(least)
    lines = ["", "a", "b b", "c c c", "d d d d d d d d", "e", "  a ", "f f f f f f f f f f f f f"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    docs += [(40, docs[0][1]), (41, docs[1][1] + "\n" + docs[2][1]), (42, "a\n" * 30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.removed for r in line_dedup.repeated_lines(df, work(), least=least).collect()}
    assert got == brute_removed(docs, least)


def test_pieces_cover_runs():
    words = np.array([60, 1, 1, 49, 10, 10, 30, 5])
    s, n = line_dedup.pieces(words, 50)
    want = {(0, 1), (1, 3), (2, 2), (3, 2), (4, 3)} | {(0, 2), (0, 3), (3, 3), (4, 4)}  # from each start, to each end
    assert set(zip(s.tolist(), n.tolist(), strict=True)) == want


def test_passages_are_removed_and_texts_rebuilt(spark, work):
    passage = " ".join(f"word{i}" for i in range(55))
    docs = [(5, f"intro one\n{passage}\nend one"), (3, f"{passage}\nend two"), (9, f"short\nshort\n{passage}"), (10, "short")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS removed")
    got = {r.doc_id: (r.text, r.removed) for r in line_dedup.remove(df, work()).collect()}
    assert got == {3: (f"{passage}\nend two", "x"), 5: ("intro one\nend one", "x"), 9: ("short\nshort", "x"), 10: ("short", "x")}


def test_line_dedup_odd_rows(odd_docs, no_docs, work):
    got = line_dedup.repeated_lines(odd_docs, work(), least=3).collect()
    assert len(got) == odd_docs.count()
    by = Counter((r.doc_id, tuple(r.removed)) for r in got)
    assert by[1, ()] == 1 and by[2, (0,)] == 2 and by[3, ()] == 1  # equal rows of id 2 get one result
    out = line_dedup.remove(odd_docs, work())
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert line_dedup.repeated_lines(no_docs, work()).count() == 0


# pipeline -----------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, SF)
        if name != names[-1]:
            assert out.columns == docs.columns
        before, after = seen.count(), out.count()
        assert after <= before and (name not in ("mixing", "sharding") or after == before)
        seen = out
    assert {"shard", "grown_shard"} <= set(seen.columns)


def test_pipeline_result(spark):
    got = corpus_pipeline.run(spark, SF)
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 50
    # one document of each class of near duplicates, none with a benchmark passage
    fps = [brute_fingerprint(r.text) for r in got.collect()]
    assert brute_classes(fps) == list(range(len(fps)))
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [r.text for r in got.select("text").collect()]
    assert not any(b in t for b in bench for t in texts)


def test_pipeline_result_has_the_mixed_order(spark, work):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    rows = [(r.doc_id, r.source) for r in docs.collect()]
    stored = work().put(corpus_pipeline.stage_shard(spark, corpus_pipeline.stage_mix(spark, docs, SF).repartition(7), SF), "out")
    got = stored.orderBy("mix_position").collect()
    assert [r.mix_position for r in got] == list(range(len(rows)))
    # brute force: blocks of each source in the order of the hashed ids, dealt by the phases
    left = {s: n for s, n in Counter(s for _, s in rows).items()}
    plan = mixing.phases(left, {s: n**mixing.TEMPERATURE for s, n in left.items()}, mixing.BLOCK_ROWS)
    slots = {}
    for p in plan:
        for j in range(p["n_blocks"]):
            turn, at = divmod(j, len(p["slots"]))
            slots[p["first_slot"] + turn * p["period"] + p["slots"][at]] = (p["source"], p["first_block"] + j)
    want = [s for _, (s, b) in sorted(slots.items()) for _ in range(min(mixing.BLOCK_ROWS, left[s] - b * mixing.BLOCK_ROWS))]
    assert [r.source for r in got] == want
    assert "mix_position" in corpus_pipeline.run(spark, SF).columns


def test_pipeline_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() > 0
