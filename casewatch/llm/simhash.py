"""Operator 9, SimHash near-dedup with pigeonring filtering.

A text's fingerprint has 64 bits: a bit is 1 if it is set in over half of the
XXH64 values (seed 42) of its 4-word shingles, repeats included. Fingerprints
at ``MAX_BITS`` or fewer differing bits are linked; classes are the connected
components.

Candidates: the 64 bits lie on a ring of five segments. If two fingerprints
differ in at most 4 bits, some segment starts a chain whose running sums of
differences stay within the proportional budgets 0, 1, 2, 3, 4. So the pair
agrees in that segment and differs in at most one bit of the next: a join key
of 26 bits, looked up with the next segment as it is and with each of its bits
flipped. The rest of the chain is tested, then the full distance. This holds
whatever the data; no candidate is capped.

Dense groups: a key that more than ``HEAVY`` distinct fingerprints share is
not paired up. All fingerprints that meet such a key are listed under every
point within two flipped bits (2,081 points); two of them differ in at most
four bits exactly if they share a point, and each point links its members to
the smallest one. That is linear in the group, and a point has at most 2,081
members.

Exact copies share a fingerprint and enter as one; rows come back by a join.

Defined results: null texts and texts without words have fingerprint zero,
linked like any other; shorter texts hash their whole word sequence; repeated
rows share a class; a class without any doc_id has a null component_id; other
columns of the input never reach the result; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from casewatch.llm.common import Workspace, table
from casewatch.llm.components import components

SHINGLE = 4
MAX_BITS = 4
#: Widths of the segments on the ring, lowest bits first.
SEGMENTS = (13, 13, 13, 13, 12)
#: Distinct fingerprints of one key up to which they are paired by the join.
HEAVY = 48
_BLOCK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text (UTF-8). ``bytes.lower`` and
    ``bytes.split`` change A-Z and split at blank and characters 9-13 only."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[s:e], 42) for s, e in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        ones += np.unpackbits(hashes[i : i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))


def fingerprint_col(text: Column) -> Column:
    """Fingerprint as a signed long (same 64 bits)."""
    return _fingerprints(F.coalesce(text, F.lit("")).cast("binary"))


def _ring() -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    out, at = [], 0
    for w in SEGMENTS:
        out.append((at, w))
        at += w
    return out


def _keys(fp: Column) -> Column:
    """Array with, for each segment i, the key of (i, segment i, segment i+1)."""
    ring = _ring()
    part = lambda i: F.shiftrightunsigned(fp, ring[i][0]).bitwiseAND(F.lit((1 << ring[i][1]) - 1).cast("long"))
    m = len(ring)
    return F.array(
        *[F.shiftleft(F.lit(i).cast("long"), 26) + F.shiftleft(part(i), 13) + part((i + 1) % m) for i in range(m)]
    )


def _chain_ok(diff: Column, i: Column) -> Column:
    """The running sums over the first 3 and 4 segments from i keep to 2 and 3."""
    ring, m = _ring(), len(SEGMENTS)

    def mask(start: int, length: int) -> int:
        bits = sum(((1 << ring[(start + k) % m][1]) - 1) << ring[(start + k) % m][0] for k in range(length))
        return bits - (1 << 64) if bits >= 1 << 63 else bits

    def within(length: int) -> Column:
        masks = F.array(*[F.lit(mask(s, length)).cast("long") for s in range(m)])
        return F.bit_count(diff.bitwiseAND(F.get(masks, i))) <= length * MAX_BITS // m

    return within(3) & within(4)


def links(fps: DataFrame, work: Workspace) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``): every pair
    within MAX_BITS is linked directly or through others."""
    exact = fps.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    i = F.shiftrightunsigned("key", 26).cast("int")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(13)])
    width = F.when(i == len(SEGMENTS) - 2, SEGMENTS[-1]).otherwise(13)  # of the segment that follows i
    probes = (
        exact.select("fp", "key", F.posexplode(flips).alias("b", "flip"))
        .where(F.col("b") <= width)
        .select("fp", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))
    )
    heavy = work.put(exact.groupBy("key").count().where(F.col("count") > HEAVY).select("key"), "heavy")
    light = exact.join(heavy, "key", "left_anti").select("key", F.col("fp").alias("other"))
    diff = F.col("fp").bitwiseXOR(F.col("other"))
    near = (
        probes.join(light.hint("merge"), "key")  # the planner's size of either side does not know of the 14 keys a segment
        .where(F.col("fp") < F.col("other"))
        .where(_chain_ok(diff, i) & (F.bit_count(diff) <= MAX_BITS))
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )
    dense = work.put(probes.join(heavy, "key", "left_semi").select("fp").distinct(), "dense")
    return near.unionByName(_ball_links(dense))


def _ball_links(fps: DataFrame) -> DataFrame:
    """Star links between fingerprints that share a point within two flips."""
    bits = [1 << b if b < 63 else -(1 << 63) for b in range(64)]
    flips = F.array(*[F.lit(x).cast("long") for x in (0, *bits)])  # 0: no flip
    points = (
        fps.select("fp", F.posexplode(flips).alias("i", "x"))
        .select("fp", "i", "x", F.posexplode(flips).alias("j", "y"))
        .where((F.col("i") < F.col("j")) | (F.col("j") == 0) & (F.col("i") == 0))
        .select("fp", F.col("fp").bitwiseXOR(F.col("x")).bitwiseXOR(F.col("y")).alias("point"))
    )
    least = F.min("fp").over(Window.partitionBy("point"))
    return points.select(F.col("fp").alias("a"), least.alias("b")).where("a != b").distinct()


def classes(rows: DataFrame, work: Workspace) -> DataFrame:
    """``rows`` (doc_id, fp): returns (fp, root, component_id) per distinct
    fingerprint."""
    fps = work.put(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    roots = components(links(fps.select("fp"), work), work)
    rooted = work.put(
        fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id"), "rooted"
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id."""
    rows = work.put(df.select(F.col(id_col).alias("doc_id"), fingerprint_col(F.col(text_col)).alias("fp")), "rows")
    found = classes(rows, work)
    return rows.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, reduced to one row of each class: the
    one with the smallest id (any one among rows that repeat that id)."""
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))  # finds the rows again; fingerprints are worked out once
    rows = work.put(df.select(F.col(id_col).alias("doc_id"), key.alias("key"), fingerprint_col(F.col(text_col)).alias("fp")), "rows")
    found = classes(rows, work)
    firsts = rows.join(found, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    firsts = firsts.select(F.col("doc_id").alias("__llm_id"), F.col("key").alias("__llm_key"), F.col("root").alias("__llm_root")).distinct()
    kept = df.withColumn("__llm_text", key).join(
        firsts, F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.col("__llm_text") == F.col("__llm_key"))
    )
    return kept.dropDuplicates(["__llm_root"]).select(*df.columns)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark, "op9"))
