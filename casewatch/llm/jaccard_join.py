"""Operator 13, n-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct ``SHINGLE``-word shingles; two documents link
when their sets' Jaccard similarity is ``PERCENT`` or more.

Sizes are cut into bands whose ends differ by at most that similarity, so linked
sets lie in the same band or in neighbouring ones; a set takes part in the scheme
of its own band and in that of the next. In the scheme of a band with largest size
r, linked sets differ in at most k = 2 r (1 - s) / (1 + s) elements. The domain is
dealt by hash into first-level partitions, each one into second-level cells. A
signature is the projection of the set on all but k2 cells of one partition, for
every such choice of cells. With more than k / (k2 + 1) partitions some partition
holds at most k2 differences, so linked sets share a signature there: no link is
lost, whatever the data.

Empty projections: a partition where some signature would be empty is weak. A set
with fewer weak partitions than there are surely good ones shares a non-empty
signature with every set it links with, so its empty ones are left out. A set with
more emits the signatures of a second deal of the domain as well, and so on; of
two linked sets either both go on or they have met.

In Spark: one pass over the texts stores each document's signatures; they are counted
by (least, greatest) set (partial aggregation, so no signature is hot), and read again
for the rows of signatures that two different sets share. Sets that share a signature
with at most ``HEAVY`` others are paired; sets of larger groups are first compared
with the group's most popular set, and then only with sets that are not in the same
component yet. Pairs are tested by size and by a 256-bit parity sketch (differing
bits are at most the differing elements, so no link is lost), the last ones by a
1024-bit sketch, then exactly on the sets of the documents that are left.

Bounds: the filter that finds these rows has at most 8 MB; with more shared signatures
than fit, it lets more rows through to the join that decides, never fewer. In a group of more than HEAVY sets of which most are
neither linked with the popular one nor dissimilar, the number of comparisons
grows with the square of the unlinked ones; emitted are only those that pass
the wide sketch. Sets are compared as 64-bit hashes of shingles. A set is named by a
64-bit sum of its hashes; sums shared by different sets (told by a second sum) are
replaced by the second one.

Defined results: null and empty texts have no shingles, link with nothing and are
their own component; texts with fewer words are one shingle; equal sets are one
class; repeated rows share a class; a class without any doc_id has a null
component_id; other columns never reach the result; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch.llm.common import Workspace, arrow_rows, table
from casewatch.llm.components import components
from casewatch.llm.hashing import ODD, filter_of, mix, passes, u64

SHINGLE = 4
PERCENT = 85
#: Sets that share a signature up to which they are paired at once.
HEAVY = 64
#: Deals of the domain; the last one keeps empty signatures.
DEALS = 12
#: Hashes that a task hands on at a time, documents that it is handed at a time, and
#: documents in a file of signatures.
_FLUSH = 1 << 18
_ROWS = 500
_FILE_ROWS = 2000
_SKETCH = [f"s{i}" for i in range(4)]
_WIDE = [f"w{i}" for i in range(16)]


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(shingle, len(found))
    n = len(found) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += ids[i : i + n] * u64(ODD * (2 * i + 1))
    return np.unique(mix(total))


def names(h: np.ndarray) -> tuple[int, int]:
    """Two sums that name a set, as signed numbers."""
    return tuple(int(mix(h ^ u64(ODD * s)).sum(dtype=np.uint64).view(np.int64)) for s in (3, 5))


def wide_sketch(h: np.ndarray) -> np.ndarray:
    """Parities of the elements in 1024 cells, as 16 signed numbers."""
    cell = (h >> np.uint64(56)) + ((h >> np.uint64(54)) & np.uint64(3)) * np.uint64(256)
    odd = np.bincount(cell.astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def sketch(h: np.ndarray) -> np.ndarray:
    """The same in 256 cells: the wide one folded (``_folded`` in Spark)."""
    return np.bitwise_xor.reduce(wide_sketch(h).reshape(4, 4), axis=0)


def _folded() -> list[Column]:
    fold = lambda i: F.col(f"w{i}").bitwiseXOR(F.col(f"w{i + 4}")).bitwiseXOR(F.col(f"w{i + 8}")).bitwiseXOR(F.col(f"w{i + 12}"))
    return [fold(i).alias(c) for i, c in enumerate(_SKETCH)]


@lru_cache(maxsize=None)
def band_top(band: int, percent: int) -> int:
    """The largest size of a band; band 0 has size 0."""
    return 0 if band == 0 else (band_top(band - 1, percent) + 1) * 100 // percent


def band_of(size: int, percent: int) -> int:
    band = 0
    while band_top(band, percent) < size:
        band += 1
    return band


@lru_cache(maxsize=None)
def scheme(k: int) -> tuple[int, int, tuple[tuple[int, ...], ...], int]:
    """(partitions, cells of each, choices of cells, partitions that are surely
    good) for at most k differences."""
    cells, k2 = {0: (1, 0), 1: (3, 1), 2: (4, 2)}.get(k, (3, 1))
    parts = k // (k2 + 1) + 1
    parts += parts // 32
    return parts, cells, tuple(combinations(range(cells), cells - k2)), parts - k // (k2 + 1)


def signatures(h: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """All signatures of a non-empty set, in the schemes of its band and the next."""
    own = band_of(len(h), percent)
    out = []
    for band in (own, own + 1):
        k = 2 * band_top(band, percent) * (100 - percent) // (100 + percent)
        parts, cells, choices, good = scheme(k)
        for deal in range(DEALS):
            x = mix(h ^ u64(ODD * (7 + band * DEALS + deal)))
            at = (x % np.uint64(parts * cells)).astype(np.int64)
            n = np.bincount(at, minlength=parts * cells).reshape(parts, cells)
            low = np.bincount(at, weights=(x & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=parts * cells)
            high = np.bincount(at, weights=(x >> np.uint64(32)).astype(np.float64), minlength=parts * cells)
            # both sums are exact (under 2**53 up to two million elements a cell)
            cell = (low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))).reshape(parts, cells)
            part = np.arange(parts, dtype=np.uint64) * u64(ODD * 11)
            weak = np.zeros(parts, bool)
            for c, chosen in enumerate(choices):
                total = part + u64(ODD * (13 + (band * DEALS + deal) * 64 + c))
                held = np.zeros(parts, np.int64)
                for j in chosen:
                    total = total + cell[:, j] * u64(ODD * (2 * j + 17))
                    held += n[:, j]
                out.append(mix(total)[(held > 0) | (deal == DEALS - 1)])
                weak |= held == 0
            if weak.sum() < good:
                break
    return np.concatenate(out)


def _named(shingle: int, clashes: frozenset[int]) -> Callable:
    def of(text: bytes | None) -> tuple[np.ndarray, int, int]:
        h = shingle_set(text, shingle)
        node, second = names(h)
        return h, second if node in clashes else node, second

    return of


def signed_sets(df: DataFrame, id_col: str, text_col: str, percent: int, shingle: int) -> DataFrame:
    """doc_id, n (size of the set), node, second, w0 to w15, sigs: one row per
    input row."""
    cols = ["n", "node", "second", *_WIDE]

    @F.pandas_udf(", ".join(f"{c} long" for c in cols) + ", sigs array<long>")
    def sign(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.uint64)
        for batch in texts:
            numbers, sigs = np.zeros((len(batch), len(cols)), np.int64), []
            for i, text in enumerate(batch):
                h = shingle_set(text, shingle)
                numbers[i] = (len(h), *names(h), *wide_sketch(h))
                sigs.append((signatures(h, percent) if len(h) else none).view(np.int64))
            yield pd.DataFrame(numbers, columns=cols).assign(sigs=pd.Series(sigs, dtype=object))

    return df.select(F.col(id_col).alias("doc_id"), sign(F.col(text_col).cast("binary")).alias("s")).select("doc_id", "s.*")


def shared_rows(sets: DataFrame, shared: np.ndarray) -> DataFrame:
    """sig, node, n, s0 to s3 of the signatures that the filter lets through."""
    sent = sets.sparkSession.sparkContext.broadcast(shared)
    cols = ["node", "n", *_SKETCH]

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            per_set = [len(x) for x in batch["sigs"]]
            sigs = np.concatenate([np.zeros(0, np.int64), *batch["sigs"]])
            held = np.flatnonzero(passes(sent.value, sigs.view(np.uint64)))
            rows = np.repeat(batch[cols].to_numpy(np.int64), per_set, axis=0)[held]
            yield pd.DataFrame(rows, columns=cols).assign(sig=sigs[held])

    return sets.select("node", "n", *_folded(), "sigs").mapInPandas(pick, ", ".join(f"{c} long" for c in [*cols, "sig"]))


def _near(x: str, y: str, percent: int, cols: list[str] = _SKETCH) -> Column:
    """Sizes and sketches allow a link."""
    col = lambda side, c: F.col(f"{side}.{c}")
    size, other = col(x, "n"), col(y, "n")
    differ = sum((F.bit_count(col(x, s).bitwiseXOR(col(y, s))) for s in cols), F.lit(0))
    return (100 * F.least(size, other) >= percent * F.greatest(size, other)) & (
        (100 + percent) * differ <= (100 - percent) * (size + other)
    )


def _pairs(x: str, y: str) -> list[Column]:
    a, b = F.col(f"{x}.node"), F.col(f"{y}.node")
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def light_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs within each group; groups have at most HEAVY members."""
    x, y = members.alias("x"), members.alias("y")
    met = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.node") < F.col("y.node"))
    return x.join(y, met & _near("x", "y", percent)).select(*_pairs("x", "y")).distinct()


def leader_pairs(members: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Each member of a group with the group's leader: the member that shares
    its signatures with most others, the likely origin of a family of copies."""
    popular = members.join(sizes, "sig").groupBy("node").agg(F.sum("members").alias("popular"))
    best = F.max(F.struct("popular", "node", "n", *_SKETCH)).alias("l")
    leaders = members.join(popular, "node").groupBy("sig").agg(best).select("sig", "l.*")
    x, y = members.alias("x"), leaders.alias("y")
    met = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.node") != F.col("y.node"))
    return x.join(y, met & _near("x", "y", percent)).select(*_pairs("x", "y")).distinct()


def apart_pairs(members: DataFrame, roots: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Pairs of each group that are not in the same component yet. Members of a family
    of near copies share many groups and just miss each other, so that the narrow sketch
    passes most of their pairs in each group; the wide one (node, w0 to w15) passes few."""
    rooted = members.drop(*_SKETCH).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    rooted = rooted.join(mixed.select("sig"), "sig", "left_semi").join(wide, "node")
    x, y = rooted.alias("x"), rooted.alias("y")
    met = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.root") < F.col("y.root"))
    return x.join(y, met & _near("x", "y", percent, _WIDE)).select(*_pairs("x", "y")).distinct()


def verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, name: str, work: Workspace, percent: int, of: Callable) -> DataFrame:
    """The pairs whose sets are similar enough. Only documents that occur in a
    pair are read into sets, one for each set."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, held = [], 0
        for batch in batches:
            for text in batch["text"]:
                h, node, _ = of(text)
                found.append((node, h.view(np.int64)))
                held += len(h)
                if held >= _FLUSH:
                    yield pd.DataFrame(found, columns=["node", "h"])
                    found, held = [], 0
        yield pd.DataFrame(found, columns=["node", "h"])

    nodes = work.put(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{name}_nodes")
    wanted = work.put(firsts.join(nodes, "node", "left_semi").select("first_id").distinct(), f"{name}_ids")
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi").select("text")
    held = texts.mapInPandas(sets, "node long, h array<long>").join(nodes, "node", "left_semi")
    held = work.put(held.groupBy("node").agg(F.first("h").alias("h")), f"{name}_sets")
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(held.select(F.col("node").alias("a"), F.col("h").alias("x")), "a")
        .join(held.select(F.col("node").alias("b"), F.col("h").alias("y")), "b")
        .where((100 + percent) * both >= percent * (F.size("x") + F.size("y")))
        .select("a", "b")
    )


def jaccard_classes(
    df: DataFrame,
    work: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    heavy: int = HEAVY,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    with arrow_rows(df.sparkSession, _ROWS):
        return _classes(df, work, id_col, text_col, percent, shingle, heavy)


def _classes(df: DataFrame, work: Workspace, id_col: str, text_col: str, percent: int, shingle: int, heavy: int) -> DataFrame:
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    sets = work.put(signed_sets(df, id_col, text_col, percent, shingle), "sets", rows_per_file=_FILE_ROWS)
    # two sums of one node differ with probability n^2 / 2^65: none in 10^8 sets, some 70 in 5 * 10^10
    seconds = sets.where("n > 0").groupBy("node").agg(F.min("second").alias("lo"), F.max("second").alias("hi"))
    clashes = frozenset(r["node"] for r in seconds.where("lo != hi").select("node").collect())
    if clashes:
        sets = sets.withColumn("node", F.when(F.col("node").isin(*clashes), F.col("second")).otherwise(F.col("node")))
    of = _named(shingle, clashes)
    rows = work.put(sets.select("doc_id", "n", "node"), "rows")
    firsts = work.put(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id")), "firsts")

    spans = sets.select(F.explode("sigs").alias("sig"), "node").groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = work.put(spans.where("lo < hi").select("sig"), "shared")
    members = shared_rows(sets, filter_of(shared, "sig")).distinct()
    members = work.put(members.join(shared, "sig", "left_semi"), "members")

    sizes = work.put(members.groupBy("sig").agg(F.count(F.lit(1)).alias("members")), "sizes")
    large = sizes.where(F.col("members") > heavy)
    in_light = members.join(sizes.where(F.col("members") <= heavy), "sig", "left_semi")
    in_heavy = work.put(members.join(large, "sig", "left_semi"), "heavy")
    pairs = light_pairs(in_light, percent)
    any_heavy = bool(in_heavy.take(1))
    if any_heavy:
        nodes = in_heavy.select("node").distinct()
        wide = sets.select("node", *_WIDE).join(nodes, "node", "left_semi").groupBy("node")
        wide = work.put(wide.agg(*(F.first(c).alias(c) for c in _WIDE)), "wide")
        pairs = pairs.unionByName(leader_pairs(in_heavy, large, percent)).distinct()
    work.drop("sets")  # the signatures are the largest table
    pairs = work.put(pairs, "pairs")
    links = work.put(verified(pairs, docs, firsts, "first", work, percent, of), "links")
    if any_heavy:
        roots = work.put(components(links, work), "roots")
        apart = work.put(apart_pairs(in_heavy, roots, wide, percent).join(pairs, ["a", "b"], "left_anti"), "apart")
        links = work.put(links.unionByName(verified(apart, docs, firsts, "second", work, percent, of)), "all_links")

    rooted = work.put(
        firsts.join(components(links, work), "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted"
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = rooted.join(least, "root").select("node", "component_id")
    named = rows.where("n > 0").join(found, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.unionByName(alone)


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), Workspace(spark, "op13"))
