"""Operators 1, 3, 7 and 8 against brute force and on odd rows."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from casewatch.llm import decontamination, exact_dedup, mixing, sharding

SF = "/root/testdata/sf0.001"


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# 1 ------------------------------------------------------------------------------------------


def test_exact_dedup_twin(spark):
    got = rows_of(exact_dedup.op1_exact_dedup(spark, SF), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({exact_dedup.OP1_SQL})").fetchall()
    assert got == sorted(map(tuple, want), key=repr)


def test_exact_dedup_odd_rows(spark, odd_docs, work):
    w = work()
    index = exact_dedup.DigestIndex(spark, f"{w.root}/index", 4)
    got = exact_dedup.exact_dedup(odd_docs, index, w).collect()
    assert len(got) == odd_docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    # the three white space characters make row 5 the longest of the empty ones
    assert {r.keep_id for r in got if r.text_sha256 == empty} == {5}
    assert {r.group_size for r in got if r.text_sha256 == empty} == {4}
    assert {r.keep_id for r in got if r.doc_id in (1, 2)} == {1}


def test_exact_dedup_keeps_one_row_of_a_group(spark, work):
    """By the contract: most code points, then smallest id, then any one row."""
    rows = [(5, "a b"), (5, "ab"), (6, "zz"), (6, "zz"), (7, "zz"), (None, "y"), (None, "y "), (8, None), (8, ""), (8, None)]
    rows += [(i, "hot text") for i in range(2000)] + [(0, "hot text")] * 500
    w = work()
    index = exact_dedup.DigestIndex(spark, f"{w.root}/index", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = exact_dedup.exact_dedup(df, index, w)
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups["".join((text or "").split())].append((-len(text or ""), doc_id is None, doc_id or 0))
    want = []
    for norm, members in groups.items():
        first, *others = sorted(members)
        keep = None if first[1] else first[2]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        want += [(None if m[1] else m[2], keep, len(members), m is first, sha) for m in (first, *others)]
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    later = exact_dedup.exact_dedup(df, index, work())
    assert later.where("kept").count() == 0
    assert {(r.group_size, r.keep_id) for r in later.where("doc_id = 6").collect()} == {(3, 6), (2500, 0)}


def test_exact_dedup_appends_and_reopens(spark, work):
    w = work()
    first = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "a  b "), (5, "d")], "doc_id long, text string")
    exact_dedup.exact_dedup(first, exact_dedup.DigestIndex(spark, f"{w.root}/index", 4), w)
    again = exact_dedup.DigestIndex(spark, f"{w.root}/index", 4)  # a new table over the same files
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_dedup(second, again, work()).collect()}
    assert got == {4: (1, False), 5: (5, True)}
    assert again.table().count() == 3


def test_exact_dedup_index_is_not_shuffled(spark, work):
    w = work()
    index = exact_dedup.DigestIndex(spark, f"{w.root}/index", 4)
    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    index.append(index.groups(index.digests(df)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        join = index.groups(index.digests(df)).join(index.table().select("digest").hint("merge"), "digest", "left_anti")
        plan = join._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_exact_dedup_empty(spark, no_docs, work):
    w = work()
    assert exact_dedup.exact_dedup(no_docs, exact_dedup.DigestIndex(spark, f"{w.root}/i", 2), w).count() == 0


# 3 ------------------------------------------------------------------------------------------


def brute_jump(doc_id, shards):
    """The same chain in plain Python."""

    def hash64(x):
        return xxhash.xxh64_intdigest((x & (2**64 - 1)).to_bytes(8, "little"), 42)

    h, at, new = hash64(doc_id), 0, 0
    while new < shards:
        at = new
        h = hash64(h)
        new = int((at + 1) / (((h >> 33) + 1) / (1 << 31)))
    return at


def test_sharding(spark, work):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sharding.assign(docs, work(), 40).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    slots = defaultdict(list)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r.shard == brute_jump(r.doc_id, 40) and r.grown_shard == brute_jump(r.doc_id, 41)
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert len(got) == docs.count()
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_spreads_and_grows(spark):
    df = sharding.with_shard(spark.range(60_000).withColumnRenamed("id", "doc_id"), 10)
    counts = [r["count"] for r in df.groupBy("shard").count().collect()]
    assert len(counts) == 10 and max(counts) < 1.1 * min(counts)
    moved = df.where("grown_shard != shard")
    assert moved.where("grown_shard != 10").count() == 0
    assert 0.08 < moved.count() / 60_000 < 0.10


def test_sharding_odd_rows(odd_docs, no_docs, work):
    got = sharding.assign(odd_docs, work(), 3).collect()
    assert len(got) == odd_docs.count()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert {(r.size, r.text_crc32) for r in got if r.doc_id == 3} == {(16, 0)}
    assert sharding.assign(no_docs, work(), 3).count() == 0
    assert sharding.with_shard(odd_docs, 3).select("shard").distinct().count() <= 3


# 7 ------------------------------------------------------------------------------------------


def brute_overlaps(docs, items, min_match=10):
    """Best segment of every alignment of every pair that shares a mask hit."""
    token = lambda t: [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    out = {}
    for d, text in docs:
        a = token(text)
        for i, item in items:
            b = token(item)
            masks = decontamination.MASKS if len(b) >= 9 else ("1" * len(b),)
            for diag in range(-len(b) + 1, len(a)):
                same = [(k, a[k] == b[k - diag]) for k in range(max(0, diag), min(len(a), len(b) + diag))]
                hit = any(
                    all(same[s + k][1] for k, c in enumerate(m) if c == "1") for m in masks for s in range(len(same) - len(m) + 1)
                )
                if not hit:
                    continue
                best = score = matches = start = 0
                seg = (0, 0, 0)
                for k, e in same:
                    if score <= 0:
                        score, matches, start = 0, 0, k
                    score += 1 if e else -decontamination.PENALTY
                    matches += e
                    if score > best:
                        best, seg = score, (matches, -start, k + 1 - start)
                if seg[0] < min(min_match, len(b)):  # else the longest segment that is 0.8 similar, the earliest of equal ones
                    spans = [(z - x, -x) for x in range(len(same)) for z in range(x + 1, len(same) + 1) if 5 * sum(e for _, e in same[x:z]) >= 4 * (z - x)]
                    if spans:
                        n, x = max(spans)
                        seg = (sum(e for _, e in same[-x : -x + n]), -same[-x][0], n)
                if seg[0] >= min(min_match, len(b)):
                    out[d, i] = max(out.get((d, i), (0, 0, 0)), seg)
    return {k: (v[0], -v[1], v[2]) for k, v in out.items()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination_brute_force(spark, work, broadcast, monkeypatch):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, make(rng.choice([3, 6, 12, 30, 45]))) for i in range(14)]
    docs = []
    for d in range(60):
        words = make(rng.randint(0, 60))
        if d % 2:
            part = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2, 3, 9])):
                part[rng.randrange(len(part))] = "x"
            at = rng.randint(0, len(words))
            words[at:at] = part[rng.choice([0, 0, 2]) :]
        docs.append((d, rng.choice([" ", "  ", ", "]).join(words).title()))
    items = [(i, " ".join(w)) for i, w in items]
    if not broadcast:
        monkeypatch.setattr(decontamination, "MAX_BROADCAST", 0)
    found = decontamination.find_overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), work()
    )
    got = {(r.doc_id, r.item_id): (r.n_matches, r.start_token, r.n_tokens) for r in decontamination.overlaps_by_pair(found).collect()}
    assert got == brute_overlaps(docs, items) and len(got) > 10


def test_any_single_substitution_is_found():
    """Whichever of 14 tokens is replaced, some mask position ignores it."""

    def reads(mask, start, at):
        return start <= at < start + len(mask) and mask[at - start] == "1"

    for bad in range(14):
        assert any(not reads(m, s, bad) for m in decontamination.MASKS for s in range(14 - len(m) + 1))


def test_every_accepted_pattern_is_found(spark, work):
    """Whole items with replaced tokens, the rule alone deciding: 10 matches, 0.8 similar."""
    items, docs, want = [], [], set()
    for n, k in ((11, 1), (12, 2), (13, 2), (14, 2), (15, 3), (16, 3)):
        item = [f"i{n}x{j}" for j in range(n)]
        items.append((n, " ".join(item)))
        for bad in itertools.combinations(range(n), k):
            assert n - k >= 10 and n - k >= 0.8 * n
            text = [f"z{len(docs)}" if j in bad else w for j, w in enumerate(item)]
            want.add((len(docs), n))
            docs.append((len(docs), "some words before " + " ".join(text) + " and behind"))
    found = decontamination.find_overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), work()
    )
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == want


def test_masks_hit_every_accepted_pattern():
    """All segments of 10 to 24 tokens with the most replaced tokens that the rule accepts."""
    for n in range(10, 25):
        k = min(n - 10, n // 5)
        masks = [sum(1 << (s + i) for i, c in enumerate(m) if c == "1") for m in decontamination.MASKS for s in range(n - len(m) + 1)]
        for bad in itertools.combinations(range(n), k):
            pattern = sum(1 << i for i in bad)
            assert any(not m & pattern for m in masks), (n, bad)


def test_decontamination_odd_rows(spark, odd_docs, no_docs, work):
    items = spark.createDataFrame([(1, "der hund lief durch den wald"), (2, None), (None, ""), (3, "cat sat on the mat and the dog ran over")], "item_id long, text string")
    found = decontamination.find_overlaps(odd_docs, items, work())
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps_by_pair(found).collect()}
    assert got == {(None, 1), (8, 1), (1, 3), (2, 3)}
    assert decontamination.find_overlaps(no_docs, items, work()).count() == 0
    assert decontamination.find_overlaps(odd_docs, items.limit(0), work()).count() == 0


def test_text_is_not_exploded(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id long, text string")
    hashed = docs.select("doc_id", F.transform(decontamination.tokens(F.col("text")), lambda x: F.xxhash64(x)).alias("hashes"))
    plan = decontamination.seed_rows(hashed, ["doc_id"], decontamination.MASKS)._jdf.queryExecution().optimizedPlan().toString()
    generates = [x for x in plan.splitlines() if "Generate" in x]
    assert generates and all(", [0]," in x or "[1]" in x for x in generates)


# 8 ------------------------------------------------------------------------------------------


def test_one_period_keeps_release_and_deadline():
    for weights in ({"a": 1, "b": 1, "c": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 1}, {f"s{i}": i * i + 1 for i in range(12)}):
        whole = mixing.whole_weights(weights, 200)
        assert sum(whole.values()) == 200 and min(whole.values()) >= 1
        slots = mixing.one_period(whole)
        assert sorted(t for s in slots.values() for t in s) == list(range(200))
        for s, w in whole.items():
            for t in range(201):
                assert abs(sum(x < t for x in slots[s]) - t * w / 200) < 1


def test_mix(spark):
    rng = random.Random(5)
    sizes = {"hot": 900, "b": 300, "c": 40, "d": 3, "": 11}
    rows = [(i, s, rng.random()) for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_slot double")
    weights = {"hot": 1.0, "b": 2.0, "c": 1.0, "d": 0.5, "": 0.5}
    got = mixing.mix(df, weights, block_rows=4).collect()
    assert sorted(r.mix_position for r in got) == list(range(len(rows)))
    assert Counter(r.source for r in got) == Counter(sizes)
    # blocks are contiguous and whole but for a source's last one
    blocks = defaultdict(list)
    for r in got:
        blocks[r.mix_slot].append(r)
    order = [blocks[k] for k in sorted(blocks)]
    assert sorted(blocks) == list(range(len(order)))
    assert [r.mix_position for b in order for r in sorted(b, key=lambda r: r.mix_position)] == list(range(len(rows)))
    # while nothing has run out, each source is less than a block from its share
    last = {s: max(r.mix_slot for r in got if r.source == s) for s in sizes}
    whole, seen = mixing.whole_weights(weights), Counter()
    for t in range(min(last.values()) + 1):
        seen[order[t][0].source] += 1
        assert all(abs(seen[s] - (t + 1) * w / mixing.PERIOD) < 1 for s, w in whole.items())


def test_mix_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs, order=("doc_id", "n_chars")).collect()
    assert sorted(r.mix_position for r in got) == list(range(odd_docs.count()))
    assert mixing.mix(no_docs).count() == 0
    with pytest.raises(ValueError, match="without a weight"):
        mixing.mix(odd_docs, {"a": 1.0})


def test_no_python_in_native_plans(spark):
    for query in (exact_dedup.op1_exact_dedup, sharding.op3_sharding, decontamination.op7_decontamination, mixing.op8_mixing):
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_workspace_folders(spark, work):
    from casewatch.llm import common

    assert os.path.isabs(common.shared_dir(spark).removeprefix("file:"))
    w = work()
    assert w.put(spark.range(3), "a").count() == 3 and w.put(spark.range(0), "b").count() == 0
    w.drop("a")
    assert not os.path.exists(w.root.removeprefix("file:") + "/a")


def test_shared_dir_is_required_on_a_cluster():
    from casewatch.llm import common

    class Nothing:
        def get(self, *_):
            return None

        def getCheckpointDir(self):  # noqa: N802
            return None

        master = "spark://host:7077"

    session = Nothing()
    session.conf = session.sparkContext = session
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(session)
