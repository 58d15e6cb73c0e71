"""Operator 10, line dedup: repeated runs of lines by a suffix array over
line-ID sequences, built by distributed prefix doubling.

A document is the sequence of its lines that are not blank; two lines are
equal if they are identical once white space at their ends is cut. A run of
consecutive lines with ``MIN_WORDS`` words or more that occurs more than once
in the corpus (in another document or in the same one) is kept at its first
place, in the order of doc_id, and deleted at all later places; a later copy that
overlaps the first one is deleted from the end of the first one on, so one copy is
always left. Runs never cross documents.

Suffixes are ranked by their first line, then by their first 2, 4, 8, ...
lines: the rank of 2n lines is the place of the pair (rank of n lines here,
rank of n lines further on) among all such pairs. Suffixes that share a rank
form an interval of the suffix array whose longest common prefix has that many
lines; those that share it with nobody leave, so each round only carries what
repeats. An interval of any other length l is named by the ranks of its first
and last 2^k lines (2^k < l <= 2^(k+1)).

A maximal repeated run of MIN_WORDS words or more is the union of its shortest
pieces with that many words, those that start at each of its lines and those
that end there, and each piece repeats where the run does. So only these
pieces are named; a piece whose interval has an earlier member is deleted, and
the union of deleted pieces is the union of all later copies. Every
line has a word, so pieces have at most MIN_WORDS lines and doubling ends after
log2(MIN_WORDS) rounds, however long the runs are.

Counting and first places are grouped sums, pre-aggregated before the shuffle;
they are read back by a join, so a line in a third of all documents is never
gathered.

Defined results: null, empty and blank texts have no lines; rows equal in
doc_id and text are one document and get the same result; a null doc_id comes
after all others; an empty table gives an empty result; other columns never
reach the result of ``repeated_lines`` and are untouched by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from casewatch.llm.common import Workspace, table

#: Shortest run that is deleted, in words.
MIN_WORDS = 50

_DOCS = "doc_id string, text_key long, n_lines int, line array<int>, words array<int>, a array<long>, b array<long>"
_KEYS = "rid long, doc_id string, text_key long, s int, l int, a long, b long, piece boolean"


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Line numbers, word counts and 128-bit line IDs of each text."""
    for df in batches:
        cols: list[list] = [[], [], [], [], []]
        for text in df["text"]:
            line, words, ids = [], [], []
            split = bytes(text).split(b"\n")
            for i, raw in enumerate(split):
                n = len(raw.split())
                if n:
                    line.append(i)
                    words.append(n)
                    ids.append(xxhash.xxh3_128_digest(raw.strip()))
            halves = np.frombuffer(b"".join(ids), np.int64).reshape(-1, 2)
            for col, x in zip(cols, (len(split) if len(text) else 0, line, words, halves[:, 0], halves[:, 1]), strict=True):
                col.append(x)
        out = df[["doc_id", "text_key"]].copy()
        for name, col in zip(("n_lines", "line", "words", "a", "b"), cols, strict=True):
            out[name] = col
        yield out


def pieces(words: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(start, lines) of the shortest pieces with ``least`` words that start
    at a line or end at one, each once."""
    n = len(words)
    c = np.concatenate(([0], np.cumsum(words)))
    end = np.searchsorted(c, c[:-1] + least, "left")
    s1 = np.flatnonzero(end <= n)
    full = np.flatnonzero(c[1:] >= least) + 1
    s2 = np.searchsorted(c, c[full] - least, "right") - 1
    code = np.unique(np.concatenate((s1 * (n + 1) + end[s1] - s1, s2 * (n + 1) + full - s2)))
    return code // (n + 1), code % (n + 1)


def _next_keys(level: int, least: int):
    """Keys of the pieces with 2^level < lines <= 2^(level+1), and of the next
    doubling step where a longer piece needs it."""
    one, two = 1 << level, 2 << level

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            parts = []
            for row in df.itertuples(index=False):
                words = np.asarray(row.words)
                name = np.full(len(words) + 1, -1, np.int64)
                name[np.asarray(row.s)] = np.asarray(row.name)
                start, lines = pieces(words, least)
                now = (lines > one) & (lines <= two)
                s, n = start[now], lines[now]
                if (lines > two).any() and len(words) >= two:
                    double = np.setdiff1d(np.arange(len(words) - two + 1), s[n == two])
                else:
                    double = np.empty(0, np.int64)
                s, n = np.concatenate((s, double)), np.concatenate((n, np.full(len(double), two)))
                piece = np.arange(len(s)) < now.sum()
                a, b = name[s], name[s + n - one]
                ok = (a >= 0) & (b >= 0)
                if ok.any():
                    parts.append(pd.DataFrame({"rid": row.rid, "doc_id": row.doc_id, "text_key": row.text_key, "s": s[ok], "l": n[ok], "a": a[ok], "b": b[ok], "piece": piece[ok]}))
            if parts:
                out = pd.concat(parts, ignore_index=True)
                yield out.astype({"s": np.int32, "l": np.int32})

    return run


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("s").alias("s"))


def _rank(keys: DataFrame, work: Workspace, tag: str) -> DataFrame:
    """Each key row whose key repeats, with ``name`` (its rank) and whether an
    earlier row has the key. Ranks need not be dense, only ordered."""
    repeated = keys.groupBy("l", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(_order()).alias("first")).where("n > 1")
    ranked = work.put(repeated.orderBy("l", "a", "b").withColumn("name", F.monotonically_increasing_id()), f"ranks{tag}")
    joined = keys.join(ranked.drop("n"), ["l", "a", "b"])
    at_home = F.col("first.d").eqNullSafe(F.col("doc_id")) & (F.col("first.t") == F.col("text_key"))
    # in its own document the first copy stays whole: a copy that overlaps it goes from its end on
    cut_from = F.when(at_home, F.greatest("s", F.col("first.s") + F.col("l"))).otherwise(F.col("s"))
    later = (_order() > F.col("first")) & (cut_from < F.col("s") + F.col("l"))
    return joined.select("rid", "doc_id", "text_key", "s", "l", "piece", "name", later.alias("later"), cut_from.alias("cut_from"))


def repeated_lines(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """One row per input row: doc_id, text_key (hash of the text), n_lines,
    removed (line numbers from 0 to delete, ascending), removed_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    as_long = F.col("doc_id").cast("long")  # ids pass through pandas as text: nulls would turn longs into floats
    rows = df.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("text"))
    docs = work.put(rows.mapInPandas(_lines, _DOCS).withColumn("doc_id", as_long).withColumn("rid", F.monotonically_increasing_id()), "docs")
    keys = docs.select("rid", "doc_id", "text_key", F.posexplode(F.arrays_zip("a", "b", "words")).alias("s", "x")).select(
        "rid", "doc_id", "text_key", "s", F.lit(1).alias("l"), "x.a", "x.b", (F.col("x.words") >= least).alias("piece")
    )
    cuts, level = None, 0
    while True:
        ranked = work.put(_rank(keys, work, str(level)), f"ranked{level}")
        cut = ranked.where("piece and later").select("rid", F.col("cut_from").alias("s"), (F.col("s") + F.col("l") - F.col("cut_from")).alias("l"))
        cuts = cut if cuts is None else cuts.unionByName(cut)
        if 1 << level >= least:
            break
        names = ranked.where(F.col("l") == 1 << level).groupBy("rid").agg(F.collect_list(F.struct("s", "name")).alias("x"))
        names = names.where(F.size("x") > 1).select("rid", F.col("x.s").alias("s"), F.col("x.name").alias("name"))
        held = docs.select("rid", F.col("doc_id").cast("string").alias("doc_id"), "text_key", "words").join(names, "rid")
        keys = work.put(held.mapInPandas(_next_keys(level, least), _KEYS).withColumn("doc_id", as_long), f"keys{level}")
        if keys.isEmpty():
            break
        level += 1
    covered = (
        cuts.select("rid", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("l") - 1)).alias("i"))
        .groupBy("rid")
        .agg(F.array_sort(F.collect_set("i")).alias("i"))
    )
    at = lambda array: F.transform("i", lambda i: F.get(array, i))
    out = docs.join(covered, "rid", "left").select(
        "doc_id",
        "text_key",
        "n_lines",
        F.coalesce(at("line"), F.array().cast("array<int>")).alias("removed"),
        F.coalesce(F.aggregate(at("words"), F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0)).cast("long").alias("removed_words"),
    )
    return out


@F.pandas_udf(StringType())
def _without(texts: pd.Series, removed: pd.Series) -> pd.Series:
    out = []
    for text, gone in zip(texts, removed, strict=True):
        if text is None or gone is None or not len(gone):
            out.append(text)
        else:
            drop = set(gone)
            out.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop))
    return pd.Series(out, dtype=object)


def remove(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with later copies of repeated runs deleted from its texts; rows
    and other columns stay as they are."""
    found = repeated_lines(df, work, id_col, text_col).where(F.size("removed") > 0).dropDuplicates(["doc_id", "text_key"])
    found = found.select(F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key"), F.col("removed").alias("__llm_removed"))
    same = F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__llm_key"))
    joined = df.join(found, same, "left").withColumn(text_col, _without(F.col(text_col), F.col("__llm_removed")))
    return joined.select(*df.columns)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_lines(table(spark, sf_dir, "documents"), Workspace(spark, "op10"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed", "removed_words")
