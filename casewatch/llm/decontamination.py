"""Operator 7, benchmark decontamination by spaced-seed hashing.

Tokens are lower-cased runs of letters and digits. Each mask is laid at every
token position; it hashes only the positions it selects, so a passage whose
token was replaced at an ignored position still gives the same hash. Hashes of
benchmark items are joined with hashes of documents; every hit fixes an
alignment (document position minus item position). The alignment is then
verified: along it there must be a segment with a similarity of 0.8 or more
and ``MIN_MATCH`` matching tokens (all of them for a shorter item). The segment
that maximises matches - 4 * mismatches is taken if it has that many, which
gives an exact copy its exact bounds; if not, the longest segment of that
similarity, which bears substitutions all along a short passage.

Everything runs on built-in expressions. Document hashes are probed where they
are made when the benchmark's hashes fit ``MAX_BROADCAST`` rows (checked by a
count), and joined by shuffle beyond that. Only hits go on: one row per text,
item and alignment, whatever the number of seeds that hit.

Defined results: null and empty texts have no tokens and no hits; items with
fewer tokens than the shortest mask span are matched by their whole token
sequence through a mask of their length; copies of a text are verified each
for itself; repeated ids give one row per (doc_id, item_id) with the longest
overlap; a null doc_id gives rows with a null doc_id; empty tables give an
empty result; other input columns never reach the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.common import Workspace, table

#: Fixed masks: 1 selects a token, 0 ignores it. Counted out over all patterns of
#: replaced tokens: any segment of 10 to 24 tokens that the rule accepts is hit by
#: at least one of them. A longer one can be cut into pieces of 12 to 23 tokens, of
#: which one at least is as similar as the whole and so is hit as well.
MASKS = ("110110101", "1100010111", "101001000011")
#: Rows of benchmark hashes up to which they are broadcast (about 64 MB).
MAX_BROADCAST = 2_000_000
MIN_MATCH = 10
#: A segment without a negative sum of 1 a match, -4 a mismatch is 0.8 similar.
PENALTY = 4


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, without empty ones."""
    t = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(t, lambda x: x != "")


def seeds(hashes: Column, mask: str) -> Column:
    """Mask hash at each position (empty array when the text is shorter)."""
    at = [i for i, c in enumerate(mask) if c == "1"]
    n = F.size(hashes) - len(mask)
    picked = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in at], F.lit(mask))
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), picked)).otherwise(
        F.array().cast("array<bigint>")
    )


def seed_rows(df: DataFrame, keep: list[str], masks: tuple[str, ...]) -> DataFrame:
    """One row per mask and position: keep..., pos, seed. ``df`` has
    ``hashes``; the tokens themselves are not carried along."""
    out = None
    for mask in masks:
        part = df.select(*keep, F.posexplode(seeds(F.col("hashes"), mask)).alias("pos", "seed"))
        out = part if out is None else out.unionByName(part)
    return out


def alignment(doc: Column, item: Column, diag: Column, least: Column) -> Column:
    """struct(matches, length, start) of the segment that is kept along the
    alignment doc[i] ~ item[i - diag], start counted in document tokens;
    matches may be under ``least``."""
    lo = F.greatest(F.lit(0), diag)
    hi = F.least(F.size(doc), F.size(item) + diag)
    same = F.zip_with(F.slice(doc, lo + 1, hi - lo), F.slice(item, lo - diag + 1, hi - lo), lambda a, b: a == b)
    best = _best_segment(same)
    segment = F.when(best["matches"] >= least, best).otherwise(_longest_segment(same))
    return F.struct(segment["matches"].alias("matches"), segment["length"].alias("length"), (segment["start"] + lo).alias("start"))


def _segment(matches: Column, length: Column, start: Column) -> Column:
    return F.struct(matches.cast("int").alias("matches"), length.cast("int").alias("length"), start.cast("int").alias("start"))


def _best_segment(same: Column) -> Column:
    """The segment with the highest sum, the earliest of equal ones."""

    def step(s: Column, e: Column) -> Column:
        fresh = s["score"] <= 0
        score = F.when(fresh, F.lit(0)).otherwise(s["score"]) + F.when(e, F.lit(1)).otherwise(F.lit(-PENALTY))
        matches = F.when(fresh, F.lit(0)).otherwise(s["matches"]) + F.when(e, F.lit(1)).otherwise(F.lit(0))
        start = F.when(fresh, s["i"]).otherwise(s["start"])
        better = score > s["top"]
        best = F.when(better, _segment(matches, s["i"] + 1 - start, start)).otherwise(s["best"])
        return F.struct(
            score.alias("score"),
            matches.alias("matches"),
            start.alias("start"),
            (s["i"] + 1).alias("i"),
            F.when(better, score).otherwise(s["top"]).alias("top"),
            best.alias("best"),
        )

    zero = F.lit(0)
    init = F.struct(*[zero.alias(c) for c in ("score", "matches", "start", "i", "top")], _segment(zero, zero, zero).alias("best"))
    return F.aggregate(same, init, step, lambda s: s["best"])


def _longest_segment(same: Column) -> Column:
    """The longest segment whose sum is not negative, the earliest of equal
    ones: it ends at j and starts where the running minimum of the sums first
    comes down to the sum at j. Takes (length of the item) squared steps."""
    sums = F.aggregate(
        same,
        F.array(F.lit(0)),
        lambda acc, e: F.concat(acc, F.array(F.element_at(acc, -1) + F.when(e, F.lit(1)).otherwise(F.lit(-PENALTY)))),
    )
    lows = lambda p: F.aggregate(
        p, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(F.least(F.get(acc, F.size(acc) - 1), x)))
    )

    def ending(p: Column, low: Column, j: Column) -> Column:
        start = F.size(F.filter(low, lambda x: x > F.get(p, j)))
        return F.struct((j - start).alias("length"), (-start).alias("before"), (F.get(p, j) - F.get(p, start)).alias("sum"))

    # one-element transforms bind the two arrays, so each is worked out once
    over = F.transform(
        F.array(F.struct(sums.alias("p"))),
        lambda s: F.transform(
            F.array(F.struct(s["p"].alias("p"), lows(s["p"]).alias("low"))),
            lambda t: F.array_max(F.transform(F.sequence(F.lit(0), F.size(same)), lambda j: ending(t["p"], t["low"], j))),
        ),
    )
    top = F.get(F.get(over, F.lit(0)), F.lit(0))
    return _segment((top["sum"] + PENALTY * top["length"]) / (PENALTY + 1), top["length"], -top["before"])


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    work: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: tuple[str, ...] = MASKS,
    min_match: int = MIN_MATCH,
) -> DataFrame:
    """Verified overlaps: doc_id, text_key (hash of the whole text), item_id,
    start (document token), length, matches, item_tokens; one row per text,
    item and alignment."""
    shortest = min(len(m) for m in masks)
    items = benchmark.select(F.col(item_col).alias("item_id"), tokens(F.col(item_text_col)).alias("item")).where(F.size("item") > 0)
    items = work.put(items.withColumn("hashes", F.transform("item", lambda x: F.xxhash64(x))), "items")
    lengths = [r[0] for r in items.where(F.size("item") < shortest).select(F.size("item").alias("n")).distinct().collect()]

    def item_seeds() -> DataFrame:
        s = seed_rows(items.where(F.size("item") >= shortest), ["item_id"], masks)
        for n in sorted(lengths):  # at most len(shortest mask) - 1 values
            s = s.unionByName(seed_rows(items.where(F.size("item") == n), ["item_id"], ("1" * n,)))
        return s.select("item_id", F.col("pos").alias("item_pos"), "seed").distinct()

    bench = work.put(item_seeds(), "bench_seeds")
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = base.select(F.xxhash64("text").alias("text_key"), F.transform(tokens(F.col("text")), lambda x: F.xxhash64(x)).alias("hashes"))
    probes = seed_rows(hashed, ["text_key"], (*masks, *("1" * n for n in sorted(lengths))))
    if bench.count() <= MAX_BROADCAST:
        bench = F.broadcast(bench)
    hits = probes.join(bench, "seed").select("text_key", "item_id", (F.col("pos") - F.col("item_pos")).alias("diag")).distinct()
    hits = work.put(hits, "hits")
    found = (
        base.withColumn("text_key", F.xxhash64("text"))
        .join(hits, "text_key")
        .join(items.drop("hashes"), "item_id")
        .select("doc_id", "text_key", "item_id", F.size("item").alias("item_tokens"), alignment(tokens(F.col("text")), F.col("item"), F.col("diag"), F.least(F.lit(min_match), F.size("item"))).alias("a"))
        .select("doc_id", "text_key", "item_id", F.col("a.start").alias("start"), F.col("a.length").alias("length"), F.col("a.matches").alias("matches"), "item_tokens")
    )
    return found.where(F.col("matches") >= F.least(F.lit(min_match), F.col("item_tokens")))


def overlaps_by_pair(found: DataFrame) -> DataFrame:
    """The longest overlap of each (doc_id, item_id); ties: the earliest."""
    best = F.max(F.struct("matches", (-F.col("start")).alias("s"), "length", "item_tokens")).alias("b")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "item_id",
            (-F.col("b.s")).cast("int").alias("start_token"),
            F.col("b.length").alias("n_tokens"),
            F.col("b.matches").alias("n_matches"),
            F.round(F.col("b.matches") / F.col("b.length"), 6).alias("similarity"),
        )
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op7")
    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), work)
    return overlaps_by_pair(found)
