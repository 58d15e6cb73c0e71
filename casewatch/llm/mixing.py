"""Operator 8, mixing sources to target weights by Pfair scheduling.

Rows of a source are dealt into blocks of ``block_rows`` rows. Block i of a
source with weight w may not start before slot floor(i/w) (its release) and
must be placed before slot ceil((i+1)/w) (its deadline). Earliest deadline
first over the released blocks meets every deadline, so after any number of
slots each source is less than one block away from its share.

Weights are rounded to whole numbers that sum to ``PERIOD`` (largest
remainders, one at least), which makes the schedule periodic: it is worked out
for one period from the weights alone and holds for any amount of data. When a
source runs out, the phase ends, and the others go on with their weights
scaled up. Every row is placed exactly once; none is dropped or repeated.

Only the row count of each source reaches the driver; at most ``MAX_SOURCES``
sources are accepted, so the schedule that is broadcast has at most
MAX_SOURCES * PERIOD numbers.

Defined results: a null source counts as the source with the empty name; null
ids and texts are placed like any other; repeated rows have places of their
own; an empty table gives an empty result; a source without a given weight is
an error, a weight without rows is ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from casewatch.llm.common import Workspace, gapless_index, table

#: Slots of one period: weights are multiples of 1/PERIOD.
PERIOD = 1000
#: Most sources of one mix; more is an error, never a cut.
MAX_SOURCES = 256
#: Rows of one block.
BLOCK_ROWS = 32
#: Default target: weight proportional to rows ** TEMPERATURE (small sources are lifted).
TEMPERATURE = 0.5


def whole_weights(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Weights as whole numbers that sum to ``period``."""
    total = sum(weights.values())
    exact = {s: w * period / total for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    spare = period - sum(out.values())
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    for i in range(max(0, spare)):
        out[by_rest[i % len(by_rest)]] += 1
    while sum(out.values()) > period:
        out[max(out, key=lambda s: (out[s], s))] -= 1
    return out


def one_period(whole: Mapping[str, int]) -> dict[str, list[int]]:
    """Slots of each source in one period: earliest deadline first among the
    sources whose next block is released; ties by name."""
    period = sum(whole.values())
    slots: dict[str, list[int]] = {s: [] for s in whole}
    for t in range(period):
        released = [s for s, w in whole.items() if len(slots[s]) < w and len(slots[s]) * period // w <= t]
        s = min(released, key=lambda s: (-(-(len(slots[s]) + 1) * period // whole[s]), s))
        slots[s].append(t)
    return slots


def phases(rows: Mapping[str, int], weights: Mapping[str, float], block_rows: int) -> list[dict]:
    """One entry for each phase and source that has blocks in it."""
    left = {s: -(-n // block_rows) for s, n in rows.items() if n > 0}
    first, slot, row, out = dict.fromkeys(left, 0), 0, 0, []
    while left:
        whole = whole_weights({s: weights[s] for s in left})
        period, slots = sum(whole.values()), one_period(whole)
        # the slot of each source's last block; the earliest ends the phase
        ends = {s: (n - 1) // whole[s] * period + slots[s][(n - 1) % whole[s]] for s, n in left.items()}
        done = min(ends, key=ends.get)
        length = ends[done] + 1
        used = {s: length // period * whole[s] + sum(t < length % period for t in slots[s]) for s in left}
        out += [
            {"source": s, "first_block": first[s], "n_blocks": used[s], "period": period, "slots": slots[s], "first_slot": slot, "first_row": row}
            for s in left
            if used[s]
        ]
        slot += length
        row += length * block_rows - (-rows[done] % block_rows)
        first = {s: first[s] + used[s] for s in left}
        left = {s: n - used[s] for s, n in left.items() if n > used[s]}
    return out


PLAN = StructType(
    [StructField("__llm_source", StringType()), *(StructField(f"__llm_{c}", LongType()) for c in ("first_block", "n_blocks", "period", "first_slot", "first_row"))]
    + [StructField("__llm_slots", ArrayType(IntegerType()))]
)


def mix(
    df: DataFrame,
    weights: Mapping[str, float] | None = None,
    source_col: str = "source",
    order: tuple[str, ...] = ("doc_id",),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every column of ``df`` plus mix_block (the source's block), mix_slot
    (place of the block among all blocks) and mix_position (place of the row
    among all rows, gapless from 0); input columns of these names are
    replaced. ``df`` is read twice: counts, then rows."""
    spark = df.sparkSession
    keyed = df.drop("mix_block", "mix_slot", "mix_position").withColumn("__llm_source", F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    counts = keyed.groupBy("__llm_source").count().limit(MAX_SOURCES + 1).collect()
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = {r[0]: r[1] for r in counts}
    if weights is None:
        weights = {s: n**TEMPERATURE for s, n in rows.items()}
    if missing := sorted(set(rows) - set(weights)):
        raise ValueError(f"sources without a weight: {missing[:5]}")
    plan = [
        (p["source"], p["first_block"], p["n_blocks"], p["period"], p["first_slot"], p["first_row"], p["slots"])
        for p in phases(rows, weights, block_rows)
    ]
    numbered = gapless_index(keyed, ["__llm_source"], list(order), "__llm_i", sum(rows.values()))
    numbered = numbered.withColumn("mix_block", F.expr(f"__llm_i div {block_rows}"))
    # bounded: at most MAX_SOURCES phases of PERIOD slots in all
    plan_df = F.broadcast(spark.createDataFrame(plan, PLAN))
    j = F.col("mix_block") - F.col("__llm_first_block")
    joined = numbered.join(
        plan_df.withColumnRenamed("__llm_source", "__llm_s"),
        (F.col("__llm_source") == F.col("__llm_s")) & (j >= 0) & (j < F.col("__llm_n_blocks")),
    ).withColumn("__llm_j", j)
    joined = joined.withColumn(
        "__llm_slot",
        F.expr("__llm_j div size(__llm_slots) * __llm_period + element_at(__llm_slots, cast(__llm_j % size(__llm_slots) as int) + 1)"),
    )
    joined = joined.withColumn("mix_slot", F.col("__llm_first_slot") + F.col("__llm_slot")).withColumn(
        "mix_position",
        F.col("__llm_first_row") + F.col("__llm_slot") * block_rows + F.col("__llm_i") % block_rows,
    )
    return joined.drop(*(c for c in joined.columns if c.startswith("__llm_")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op8")
    rows = work.put(table(spark, sf_dir, "documents").select("doc_id", "source"), "rows")
    return mix(rows).select("doc_id", "source", "mix_block", "mix_slot", "mix_position")
