"""Stored cases (S2 + D1): a table of newest versions, bucketed and sorted by case
id, that takes in deliveries one after another.

A delivery is reduced to its newest rows and joined with the store bucket by bucket:
only the delivery is shuffled, the stored cases are read where they lie, however many
there are. Each merge writes a new generation beside the old one; the old one stays
whole until the new one is complete, so a merge that fails or is run again changes
nothing. A generation is a folder named by its number under the store's path, and
counts as complete once Spark's ``_SUCCESS`` file is in it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casewatch.operators.rowset import latest_version


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


class CaseStore:
    """The newest row per case at ``path`` (a folder that all executors share).

    ``schema`` gives the columns; ``version`` and ``tiebreak`` decide as in
    ``latest_version``. A later session opens the same path with the same
    arguments. ``buckets`` defaults to the session's shuffle partitions, for which
    a merge needs no other exchange than the version pick of the delivery.
    ``keep`` is a SQL condition on the columns; cases whose newest row does not
    meet it (expired ones, say) leave the store with the next merge."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        key: str = "safetyreportid",
        version: str = "safetyreportversion",
        tiebreak: Sequence[str] = (),
        buckets: int | None = None,
        keep: str | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.version, self.tiebreak = key, version, list(tiebreak)
        self.shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = buckets or self.shuffles
        self.keep = keep
        self._tables: dict[int, str] = {}

    # -- generations ------------------------------------------------------------

    def _folder(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def generations(self) -> list[int]:
        """Numbers of the complete generations, rising."""
        fs, at = self._folder(self.path)
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        done = lambda n: fs.exists(self._folder(f"{self.path}/{n}/_SUCCESS")[1])
        return sorted(int(n) for n in names if n.isdigit() and done(n))

    def _table(self, generation: int) -> str:
        """The generation as a bucketed table of this session."""
        if generation not in self._tables:
            name = f"case_store_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{generation}'"
            )
            self._tables[generation] = name
        return self._tables[generation]

    def cases(self) -> DataFrame:
        """The newest row per case; an empty table before the first merge."""
        held = self.generations()
        return self.spark.table(self._table(held[-1])) if held else self.spark.createDataFrame([], self.schema)

    def drop_before(self, generation: int) -> None:
        """Delete older generations, once nothing reads them any more."""
        for g in self.generations():
            if g < generation:
                if g in self._tables:
                    self.spark.sql(f"DROP TABLE {self._tables.pop(g)}")
                fs, at = self._folder(f"{self.path}/{g}")
                fs.delete(at, True)

    # -- merge ------------------------------------------------------------------

    def _newest(self, delivery: DataFrame) -> DataFrame:
        picked = latest_version(delivery.select(*[_q(c) for c in self.schema.names]), self.key, self.version, self.tiebreak)
        return picked if self.buckets == self.shuffles else picked.repartition(self.buckets, _q(self.key))

    def compared(self, delivery: DataFrame) -> DataFrame:
        """``(key, old, new)``: stored and delivered row of each case as structs
        in the order that decides; null where there is none. Null ids are one case."""
        first = [self.version, *self.tiebreak]
        order = [*first, *[c for c in self.schema.names if c not in (self.key, *first)]]
        row = F.struct(*[_q(c) for c in order])
        old = self.cases().select(_q(self.key).alias("_k"), row.alias("old"))
        new = self._newest(delivery).select(_q(self.key), row.alias("new"))
        named = old.where("_k IS NOT NULL").join(new.where(_q(self.key).isNotNull()), F.col("_k") == _q(self.key), "full")
        both = named.select(F.coalesce("_k", _q(self.key)).alias(self.key), "old", "new")
        # at most one stored and one delivered row have no id
        nameless = old.where("_k IS NULL").select("old", F.lit(None).cast(new.schema["new"].dataType).alias("new")).unionByName(
            new.where(_q(self.key).isNull()).select(F.lit(None).cast(old.schema["old"].dataType).alias("old"), "new")
        )
        one = nameless.agg(F.max("old").alias("old"), F.max("new").alias("new")).where("old IS NOT NULL OR new IS NOT NULL")
        return both.unionByName(one.select(F.lit(None).cast(self.schema[self.key].dataType).alias(self.key), "old", "new"))

    def _resolved(self, delivery: DataFrame) -> DataFrame:
        """``(key, old, new)``, ``new`` the row that a merge leaves, if any."""
        both = self.compared(delivery).withColumn("new", F.greatest("old", "new"))  # a null loses
        if self.keep is None:
            return both
        names = [c for c in self.schema.names if c != self.key]
        flat = both.select("old", "new", _q(self.key), *[F.col(f"new.`{c}`").alias(c) for c in names])
        stays = F.coalesce(F.expr(self.keep), F.lit(False))
        return flat.select(_q(self.key), "old", F.when(stays, F.col("new")).alias("new"))

    def merge(self, delivery: DataFrame) -> int:
        """Take in a delivery (any number of versions per case) and return the
        new generation's number."""
        held = self.generations()
        generation = held[-1] + 1 if held else 0
        rows = self._resolved(delivery).where("new IS NOT NULL")
        rows = rows.select(*[_q(c) if c == self.key else F.col(f"new.`{c}`").alias(c) for c in self.schema.names])
        name = f"case_store_{uuid.uuid4().hex}"
        (
            rows.write.mode("overwrite")
            .bucketBy(self.buckets, self.key)
            .sortBy(self.key)
            .option("path", f"{self.path}/{generation}")
            .format("parquet")
            .saveAsTable(name)
        )
        self._tables[generation] = name
        return generation

    def changes(self, delivery: DataFrame) -> DataFrame:
        """``(key, old, new)`` of the cases that a merge of ``delivery`` would
        change: ``old`` is null for new cases, ``new`` for cases that leave. Counts
        over the stored cases have to be corrected by them."""
        return self._resolved(delivery).where(~F.col("old").eqNullSafe(F.col("new")))


def corrected_counts(counts: DataFrame, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts by ``columns`` (``(columns..., n)``) after ``changes``: old rows
    taken off, new ones added, groups without a case left out."""
    side = lambda name, sign: changes.where(F.col(name).isNotNull()).select(
        *[F.col(f"{name}.`{c}`").alias(c) for c in columns], F.lit(sign).cast("long").alias("n")
    )
    moved = counts.select(*[_q(c) for c in columns], F.col("n").cast("long").alias("n"))
    moved = moved.unionByName(side("old", -1)).unionByName(side("new", 1))
    return moved.groupBy(*[_q(c) for c in columns]).agg(F.sum("n").alias("n")).where("n <> 0")
