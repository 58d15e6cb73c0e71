"""Operator 12, phrase collocation mining by Toivonen's sampling.

Phrases are runs of 2 to ``MAX_WORDS`` words inside a piece of text (between marks
of punctuation), counted per language. A phrase is frequent at ``LEAST`` or more
occurrences; every part of a frequent phrase is frequent too.

1. Words are counted. Texts are stored once more as arrays of word hashes, cut at
   ends of pieces and at words that are not frequent. Then pairs of words are counted
   in cells by hash, of which there are as many as half the words: a cell with fewer than
   ``LEAST`` holds no frequent pair, and the texts are cut again between such words.
2. A sample (every ``SAMPLE``-th row by hash) proposes phrases: level by level,
   those that reach ``SAMPLE_LEAST`` in it.
3. One full pass counts the proposed phrases and their negative border: every
   run whose two longest parts are proposed, whether or not the sample
   proposed the run itself.
4. Frequent phrases that were not proposed are failures of the border: longer runs
   over them have not been counted. They join the proposals, and another
   pass counts exactly the runs that this lets in, until a pass brings no failure.
   Then every frequent phrase has been counted, whatever the sample held.

Steps 1 to 4 count 64-bit hashes, which can only bring in too many phrases. A
last pass over the texts counts the phrases themselves (language and words), so
that the counts are exact, and the scores are worked out from these. Tasks hand on
many phrases, or many cells, in one row for each part of the phrases or cells, and the
part is summed up by one task.

Proposals are looked up in a bit filter of bounded size (8 MB); its false
positives make runs be counted that need not be. Sampling decides the number of
passes, never the result. All counts are summed within a task, then by
partial aggregation, so no frequent phrase is hot.

Defined results: null texts count as empty; a null language is ``und``; a language
without a frequent phrase gives no row; repeated rows count each for itself; ties
in score and count go by the phrase's UTF-8 bytes; empty tables give none; other
input columns never reach the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewatch.llm.common import Workspace, arrow_rows, table
from casewatch.llm.hashing import ODD, filter_of, mix, passes, u64

MAX_WORDS = 4
LEAST = 30
TOP = 2000
#: A shorter phrase goes if a longer one has this part (percent) of its count.
COVERED = 80
#: One row of so many is in the sample, and the count that proposes a phrase there:
#: 40 % of the expected count of a phrase that is just frequent.
SAMPLE = 4
SAMPLE_LEAST = 3
#: Bytes of text that a task takes at a time, hashes and phrases that it holds
#: before it hands on their counts.
_CHUNK_BYTES = 1 << 20
_FLUSH_HASHES = 1 << 18
_FLUSH_PHRASES = 1 << 20
#: Texts, and rows of many texts' hashes, that a task is handed at a time, and rows of
#: hashes in a file.
_TEXT_ROWS, _CUT_ROWS, _FILE_ROWS = 1000, 8, 4
#: The same for texts whose phrases are counted, and for the rows of many phrases.
_PACKED_ROWS = 100
#: Cells of pairs that a task counts at once, pairs a cell has on average at most, and
#: pairs whose cells a task hands on at a time.
_CELLS, _LOAD, _FLUSH_PAIRS = 1 << 20, 2, 1 << 20
#: Frequent phrases of a part, about.
_PART_PHRASES = 1 << 14
#: Stands between pieces; no byte of UTF-8.
_MARK = b"\xff"
#: A-Z become a-z, tab becomes blank, ends of pieces become marks.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c == 9 else 0xFF if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)
)
_LENGTH_BITS = np.uint64(7)


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a text, with marks at ends of pieces and at its own end.
    ``split`` splits at blanks: the other white space has become marks."""
    return [*(text or b"").translate(_FOLD).replace(_MARK, b" \xff ").split(), _MARK]


def salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang))


def _sized(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of n words: the low bits hold n - 1; none is 0."""
    out = (h & ~_LENGTH_BITS) | np.uint64(n - 1)
    out[out == 0] = 8
    return out


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    """Hashes of the words of one language, 0 for marks."""
    raw = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), np.uint64)
    out = _sized(mix(raw ^ salt(lang)), 1)
    out[raw == _MARK_HASH] = 0
    return out


_MARK_HASH = np.frombuffer(xxhash.xxh64_digest(_MARK), np.uint64)[0]


def numbered(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words, and the place of each word among them."""
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return list(place), np.fromiter(map(place.__getitem__, words), np.int64, len(words))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, words with marks, sample flag of each word) of about
    ``_CHUNK_BYTES`` of texts of one language; ``batches``: text, lang and perhaps picked."""

    def made(lang: str, rows: list[tuple[bytes | None, bool]]) -> tuple[str, list[bytes], np.ndarray]:
        found = [tokens(text) for text, _ in rows]
        flags = np.repeat(np.array([flag for _, flag in rows], bool), [len(f) for f in found])
        return lang, [w for f in found for w in f], flags

    waiting: dict[str, list[tuple[bytes | None, bool]]] = {}
    size: Counter = Counter()
    for batch in batches:
        flags = batch.column("picked").to_pylist() if "picked" in batch.schema.names else [False] * len(batch)
        for text, lang, flag in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), flags, strict=True):
            lang = "und" if lang is None else lang
            waiting.setdefault(lang, []).append((text, flag))
            size[lang] += len(text or b"") + 1
            if size[lang] >= _CHUNK_BYTES:
                yield made(lang, waiting.pop(lang))
                del size[lang]
            elif sum(size.values()) >= 8 * _CHUNK_BYTES:
                yield from (made(k, waiting.pop(k)) for k in list(waiting))
                size.clear()
    yield from (made(lang, rows) for lang, rows in waiting.items())


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the run of n words that starts at each place."""
    size = max(0, len(h) - n + 1)
    total = np.zeros(size, np.uint64)
    for i in range(n):
        total += h[i : i + size] * u64(ODD * (2 * i + 1))
    return _sized(mix(total), n)


def cut_runs(h: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, mask of those to keep): 0 at marks and at words that the filter
    does not hold. Kept are words with a neighbour and the first 0 behind each run."""
    out = np.where(passes(frequent, h), h, np.uint64(0))
    held = np.concatenate(([False], out != 0, [False]))
    paired = held[1:-1] & (held[:-2] | held[2:])  # a neighbour on either side
    end = ~paired & np.concatenate(([False], paired[:-1]))
    return np.where(paired, out, np.uint64(0)), paired | end


def counted_runs(h: np.ndarray, proposed: np.ndarray | None, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, hashes, mask) for runs of 2 to ``longest`` words: the mask marks runs
    whose two longest parts are proposed (parts of one word always are)."""
    inside = h != 0
    for n in range(2, longest + 1):
        if len(inside) < 2:
            return
        inside = inside[:-1] & inside[1:]
        runs = run_hashes(h, n)
        yield n, runs, inside
        if n < longest:
            inside = inside & passes(proposed, runs)


def _counted(values: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])


def count_runs(texts: DataFrame, proposed: np.ndarray | None, earlier: np.ndarray | None, shortest: int, longest: int) -> DataFrame:
    """h, n: how often each run occurs that the proposals let in and the
    earlier ones did not."""
    sc = texts.sparkSession.sparkContext
    now, before = sc.broadcast(proposed), sc.broadcast(earlier)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tally(held: list[np.ndarray]) -> pa.RecordBatch:
            h = np.concatenate(held)
            old = {} if before.value is None else {n: mask for n, _, mask in counted_runs(h, before.value, longest)}
            found = []
            for n, runs, mask in counted_runs(h, now.value, longest):
                if n >= shortest:
                    found.append(runs[mask & ~old[n] if n in old else mask])
            values, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            return _counted(values, n)

        held, size = [], 0
        for batch in batches:
            held.append(batch.column("words").flatten().to_numpy().view(np.uint64))  # each row ends with 0
            size += len(held[-1])
            if size >= _FLUSH_HASHES:
                yield tally(held)
                held, size = [], 0
        if held:
            yield tally(held)

    counts = texts.select("words").mapInArrow(count, "h long, n long")
    return counts.groupBy("h").agg(F.sum("n").alias("n"))


def frequent_words(texts: DataFrame, least: int) -> DataFrame:
    """Hashes (h) of the words with ``least`` or more occurrences in a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tally(held: list[np.ndarray]) -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return _counted(values, n)

        held, size = [], 0
        for lang, words, _ in chunks(batches):
            h = word_hashes(words, lang)
            held.append(h[h != 0])
            size += len(words)
            if size >= _FLUSH_HASHES:
                yield tally(held)
                held, size = [], 0
        if held:
            yield tally(held)

    counts = texts.select("text", "lang").mapInArrow(count, "h long, n long")
    return counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")


def cut_texts(texts: DataFrame, words: np.ndarray, sample: int) -> DataFrame:
    """words (array of hashes, each run of them ended by 0), picked (in the
    sample): the texts of the sample and the others, in rows of many texts each."""
    sent = texts.sparkSession.sparkContext.broadcast(words)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found, picked in chunks(batches):
            h, kept = cut_runs(word_hashes(found, lang), sent.value)
            rows = [(h[kept & (picked == flag)].view(np.int64), flag) for flag in (True, False)]
            rows = [r for r in rows if len(r[0])]
            words = pa.array([w for w, _ in rows], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([words, pa.array([flag for _, flag in rows], pa.bool_())], ["words", "picked"])

    picked = F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0
    return texts.withColumn("picked", picked).select("text", "lang", "picked").mapInArrow(cut, "words array<long>, picked boolean")


def cells_of(pairs: np.ndarray, parts: int) -> np.ndarray:
    """Cell of each hash: the part, then the place within it."""
    return ((pairs >> np.uint64(32)) % np.uint64(parts)) * np.uint64(_CELLS) + ((pairs >> np.uint64(8)) & np.uint64(_CELLS - 1))


def packed_cells(cells: np.ndarray, parts: int, least: int) -> pa.RecordBatch:
    """part, size, steps: sorted cells of each part as differences, each cell at
    most ``least`` times."""
    cells = np.sort(cells)
    kept = np.ones(len(cells), bool)
    kept[least:] = cells[least:] != cells[:-least]
    cells = cells[kept]
    cuts = np.searchsorted(cells, np.arange(parts + 1, dtype=np.uint64) * np.uint64(_CELLS))
    rows = []
    for part in np.flatnonzero(np.diff(cuts)).tolist():
        steps = np.diff(cells[cuts[part] : cuts[part + 1]] & np.uint64(_CELLS - 1), prepend=np.uint64(0))
        width = next(w for w in ("u1", "u2", "u4") if steps.max() <= np.iinfo(w).max)
        rows.append((part, len(steps), steps.astype(width).tobytes()))
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, ["part", "size", "steps"])


def _places(size: int, steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, f"u{len(steps) // size}"), dtype=np.int64)


def frequent_cells(texts: DataFrame, parts: int, least: int) -> DataFrame:
    """h: the cells (mixed) that ``least`` or more pairs of words fall into."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            h = batch.column("words").flatten().to_numpy().view(np.uint64)
            held.append(cells_of(run_hashes(h, 2)[(h[:-1] != 0) & (h[1:] != 0)], parts))
            size += len(held[-1])
            if size >= _FLUSH_PAIRS:
                yield packed_cells(np.concatenate(held), parts, least)
                held, size = [], 0
        if size:
            yield packed_cells(np.concatenate(held), parts, least)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(part: int, total: np.ndarray) -> pa.RecordBatch:
            cells = np.flatnonzero(total >= least).astype(np.uint64) + np.uint64(part * _CELLS)
            return pa.RecordBatch.from_arrays([pa.array(mix(cells).view(np.int64))], ["h"])

        now, total, held = None, None, []
        for batch in batches:
            for part, size, steps in zip(*(batch.column(c).to_pylist() for c in ("part", "size", "steps")), strict=True):
                if part != now:
                    if now is not None:
                        yield found(now, total + np.bincount(np.concatenate(held), minlength=_CELLS))
                    now, total, held = part, np.zeros(_CELLS, np.int64), []
                held.append(_places(size, steps))
                if sum(map(len, held)) >= _CELLS:
                    total += np.bincount(np.concatenate(held), minlength=_CELLS)
                    held = [np.zeros(0, np.int64)]
        if now is not None:
            yield found(now, total + np.bincount(np.concatenate(held), minlength=_CELLS))

    packed = texts.select("words").mapInArrow(pack, "part int, size int, steps binary")
    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(add, "h long")


def cut_pairs(h: np.ndarray, passed: np.ndarray) -> np.ndarray:
    """Hashes cut where the pair of a word and the next one has not passed, without words
    that have no pair left; each run ends with 0."""
    right = np.append(passed, False)
    kept = np.flatnonzero(right | np.append(False, passed))
    ends = ~right[kept]
    out = np.zeros(len(kept) + int(ends.sum()), np.uint64)
    out[np.arange(len(kept)) + np.cumsum(ends) - ends] = h[kept]
    return out


def cut_at_rare_pairs(cut: DataFrame, work: Workspace, least: int) -> DataFrame:
    """``cut`` without pairs of words that cannot be frequent."""
    total = cut.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(1, total // (_CELLS * _LOAD))
    cells = work.put(frequent_cells(cut, parts, least), "cells")
    sent = cut.sparkSession.sparkContext.broadcast(filter_of(cells, "h"))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for words in batch.column("words"):
                h = words.values.to_numpy().view(np.uint64)
                at = np.flatnonzero((h[:-1] != 0) & (h[1:] != 0))
                passed = np.zeros(max(0, len(h) - 1), bool)
                passed[at] = passes(sent.value, mix(cells_of(run_hashes(h, 2)[at], parts)))
                rows.append(cut_pairs(h, passed).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64())), batch.column("picked")], ["words", "picked"])

    fewer = cut.select("words", "picked").mapInArrow(again, "words array<long>, picked boolean").where(F.size("words") > 0)
    fewer = work.put(fewer, "cut2", rows_per_file=_FILE_ROWS)
    work.drop("cut")
    return fewer


def chunk_phrases(words: list[bytes], lang: str, frequent: np.ndarray, longest: int) -> Iterator[tuple[bytes, int]]:
    """(phrase, occurrences) of the runs that the filter holds, each once."""
    distinct, ids = numbered(words)
    hashes = word_hashes(distinct, lang)
    yield b"", int((hashes[ids] != 0).sum())
    held = (hashes != 0) & passes(frequent, hashes)
    times = np.bincount(ids, minlength=len(distinct))
    yield from zip(compress(distinct, held.tolist()), times[held].tolist(), strict=True)
    h, inside, code = hashes[ids], held[ids], ids  # equal codes: equal runs, one word shorter
    for n in range(2, longest + 1):
        if len(inside) < 2:
            return
        at = np.flatnonzero(inside[:-1] & inside[1:])
        at = at[passes(frequent, run_hashes(h, n)[at])]
        _, first, of, times = np.unique(
            code[at] * len(distinct) + ids[at + n - 1], return_index=True, return_inverse=True, return_counts=True
        )
        inside, code = np.zeros(len(inside) - 1, bool), np.zeros(len(inside) - 1, np.int64)
        inside[at], code[at] = True, of
        yield from ((b" ".join(words[i : i + n]), k) for i, k in zip(at[first].tolist(), times.tolist(), strict=True))


def count_phrases(texts: DataFrame, frequent: np.ndarray, longest: int, parts: int) -> DataFrame:
    """lang, phrase, n of all runs of 1 to ``longest`` words that the filter
    holds; the phrase '' has the number of all words."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(lang: str, counter: Counter) -> pa.RecordBatch:
            phrases = list(counter)
            of = np.fromiter((xxhash.xxh32_intdigest(p) % parts for p in phrases), np.int32, len(phrases))
            order = np.argsort(of, kind="stable")
            found, cuts = np.unique(of[order], return_index=True)
            cuts = pa.array(np.append(cuts, len(phrases)), pa.int32())
            sorted_phrases = pa.array([phrases[i] for i in order.tolist()], pa.binary())
            times = pa.array(np.fromiter(counter.values(), np.int64, len(phrases))[order])
            columns = [pa.array(found), pa.array([lang] * len(found), pa.string()), pa.ListArray.from_arrays(cuts, sorted_phrases), pa.ListArray.from_arrays(cuts, times)]
            return pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrases", "times"])

        held: dict[str, Counter] = {}
        for lang, words, _ in chunks(batches):
            counter = held.setdefault(lang, Counter())
            for phrase, n in chunk_phrases(words, lang, sent.value, longest):
                counter[phrase] += n
            if sum(map(len, held.values())) >= _FLUSH_PHRASES:
                yield from (handed(*x) for x in held.items())
                held = {}
        yield from (handed(*x) for x in held.items())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(held: dict[str, Counter]) -> pa.RecordBatch:
            langs = pa.array([lang for lang, counter in held.items() for _ in counter], pa.string())
            phrases = pa.array([p for counter in held.values() for p in counter], pa.binary())
            n = pa.array([n for counter in held.values() for n in counter.values()], pa.int64())
            return pa.RecordBatch.from_arrays([langs, phrases, n], ["lang", "phrase", "n"])

        now, held = None, {}
        for batch in batches:
            for part, lang, phrases, times in zip(*(batch.column(c).to_pylist() for c in ("part", "lang", "phrases", "times")), strict=True):
                if part != now and held:
                    yield summed(held)
                    held = {}
                now, counter = part, held.setdefault(lang, Counter())
                for phrase, n in zip(phrases, times, strict=True):
                    counter[phrase] += n
        if held:
            yield summed(held)

    packed = texts.select("text", "lang").mapInArrow(count, "part int, lang string, phrases array<binary>, times array<long>")
    counts = packed.repartition("part").sortWithinPartitions("part").mapInArrow(add, "lang string, phrase binary, n long")
    return counts.withColumn("phrase", F.col("phrase").cast("string"))


def frequent_hashes(texts: DataFrame, work: Workspace, least: int, longest: int, sample: int, sample_least: int) -> DataFrame:
    """Hashes (h) of all frequent runs of 1 to ``longest`` words, and perhaps
    some more. ``texts``: doc_id, text (binary), lang."""
    with arrow_rows(texts.sparkSession, _TEXT_ROWS):
        words = work.put(frequent_words(texts, least), "words")
        cut = work.put(cut_texts(texts, filter_of(words, "h"), sample), "cut", rows_per_file=_FILE_ROWS)
    with arrow_rows(texts.sparkSession, _CUT_ROWS):
        cut = cut_at_rare_pairs(cut, work, least)
        return _mined(cut, words, work, least, longest, sample_least)


def _mined(cut: DataFrame, words: DataFrame, work: Workspace, least: int, longest: int, sample_least: int) -> DataFrame:
    picked = cut.where("picked")
    shorter = F.col("h").bitwiseAND(7) < longest - 1  # runs that longer ones can be built on

    proposed = work.put(words.limit(0), "proposed1")
    lookup = None
    for n in range(2, longest):  # the sample, level by level
        level = count_runs(picked, lookup, None, n, n).where(F.col("n") >= sample_least).select("h")
        proposed = work.put(proposed.unionByName(level), f"proposed{n}")
        lookup = filter_of(proposed, "h")

    counts = count_runs(cut, lookup, None, 2, longest)
    frequent, k = work.put(words.unionByName(counts.where(F.col("n") >= least).select("h")), "frequent0"), 0
    fresh = frequent.where(F.col("h").bitwiseAND(7) > 0)
    while True:
        failed = work.put(fresh.where(shorter).join(proposed, "h", "left_anti"), f"failed{k}")
        if longest < 3 or not failed.take(1):
            return frequent
        k += 1
        proposed = work.put(proposed.unionByName(failed), f"expanded{k}")
        earlier, lookup = lookup, filter_of(proposed, "h")
        counts = count_runs(cut, lookup, earlier, 3, longest)
        fresh = work.put(counts.where(F.col("n") >= least).select("h"), f"fresh{k}")
        frequent = work.put(frequent.unionByName(fresh), f"frequent{k}")


def scored(counts: DataFrame, work: Workspace, least: int, covered: int, top: int) -> DataFrame:
    """The report from exact counts (lang, phrase, n)."""
    wide = lambda c: F.col(c).cast("decimal(20,0)")  # noqa: E731  products outgrow 64 bits
    part = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    totals = counts.where("phrase = ''").select("lang", F.col("n").alias("all_words"))
    freq = counts.where((F.col("phrase") != "") & (F.col("n") >= least))
    cands = freq.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1).withColumnRenamed("n", "a")

    lengths = F.expr("explode(sequence(2, size(w) - 1))")
    inner = cands.where(F.size("w") > 2).select("lang", "w", "a", lengths.alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.expr("explode(sequence(1, size(w) - size + 1))").alias("start"))
    longer = inner.select("lang", part(F.col("start"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = cands.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * covered)
    )

    cuts = kept.select("lang", "phrase", "a", "w", F.expr("explode(sequence(1, size(w) - 1))").alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("w")).alias("right"))
    side = lambda name, out: freq.select("lang", F.col("phrase").alias(name), F.col("n").alias(out))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    score = F.expr("cast(2000000 * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b")
    rows = cuts.groupBy("lang", "phrase", "a").agg(best)
    order = Window.partitionBy("lang").orderBy(F.col("b.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "b.l", "b.r", F.col("all_words").alias("n"), "b.score"
    )


def phrases(
    df: DataFrame,
    work: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = MAX_WORDS,
    covered: int = COVERED,
    top: int = TOP,
    sample: int = SAMPLE,
    sample_least: int = SAMPLE_LEAST,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r,
    n, score. ``longest`` is at most 8."""
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.col(lang_col).alias("lang"))
    hashes = frequent_hashes(texts, work, least, longest, sample, sample_least)
    parts = hashes.count() // _PART_PHRASES + 1
    with arrow_rows(df.sparkSession, _PACKED_ROWS):
        counts = work.put(count_phrases(texts, filter_of(hashes, "h"), longest, parts), "counts")
    return scored(counts, work, least, covered, top)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"), Workspace(spark, "op12"))


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), totals AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang
), runs AS (
  SELECT lang, s.size AS size, words, unnest(range(1, len(words) - s.size + 2)) AS pos
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) s WHERE len(words) >= s.size
), freq AS (
  SELECT lang, size, phrase, count(*) AS a
  FROM (SELECT lang, size, array_to_string(words[pos : pos + size - 1], ' ') AS phrase FROM runs)
  GROUP BY ALL HAVING count(*) >= 30
), longer AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (
    SELECT lang, a, array_to_string(string_split(phrase, ' ')[pos : pos + s - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, size - s + 2)) AS pos FROM (SELECT *, unnest(range(2, size)) AS s FROM freq WHERE size > 2))
  ) GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r,
         CAST(2000000::HUGEINT * c.a::HUGEINT // (l.a::HUGEINT + r.a::HUGEINT) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM freq WHERE size > 1) c
  JOIN freq l ON l.lang = c.lang AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1 : c.k], ' ')
  JOIN freq r ON r.lang = c.lang AND r.phrase = array_to_string(string_split(c.phrase, ' ')[c.k + 1 :], ' ')
  LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase
  WHERE g.longer IS NULL OR 100::HUGEINT * g.longer < 80::HUGEINT * c.a
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE pick = 1
)
SELECT lang, rank, phrase, a, l, r, totals.n AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
