"""Evidence documents of any shape (S5, F3): every leaf of a JSON document as a
row, without a declared structure.

Documents are parsed once into VARIANT. Each step replaces objects and lists by
their members, inside the row and by one Generate; as many steps are planned as
the deepest document has levels, which one aggregate over the texts finds. Rows
of shallower documents pass through the remaining steps as they are, so every
document is read once whatever the depths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels beyond which documents are violations (a bound on the plan's size).
MAX_DEPTH = 60

NOT_JSON = "not valid JSON"
NOT_AN_OBJECT = "not a JSON object"
TOO_DEEP = "nested too deeply"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def nesting_depth(text: Column) -> Column:
    """Levels of objects and lists: brackets outside strings, opened less closed."""
    outside = F.regexp_replace(text, r'"(?:[^"\\]++|\\.)*+"', "")
    brackets = F.regexp_replace(outside, r"[^\[\]{}]++", "")
    steps = F.transform(F.split(F.translate(brackets, "{[}]", "(())"), ""), lambda c: F.when(c == "(", 1).when(c == ")", -1).otherwise(0))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("top"))

    def step(s: Column, x: Column) -> Column:
        return F.struct((s["at"] + x).alias("at"), F.greatest(s["top"], s["at"] + x).alias("top"))

    return F.aggregate(steps, start, step, lambda s: s["top"])


def _members(path: Column, v: Column) -> Column:
    """A value's members, or the value itself if it has none to go into."""
    kind = "array<struct<path:string,v:variant>>"
    fields = F.transform(
        F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")),
        lambda e: F.struct(F.concat_ws(".", F.nullif(path, F.lit("")), e["key"]).alias("path"), e["value"].alias("v")),
    )
    items = F.transform(
        F.try_variant_get(v, "$", "array<variant>"),
        lambda x, i: F.struct(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")).alias("path"), x.alias("v")),
    )
    return F.coalesce(fields.cast(kind), items.cast(kind), F.array(F.struct(path.alias("path"), v.alias("v"))).cast(kind))


def document_leaves(docs: DataFrame, by: Sequence[str], text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(leaves, violations) of the JSON objects in ``text_col``.

    Leaves: ``(by..., path, kind, value_num, value_str)``, one row per number,
    text, boolean or null; ``kind`` is int (any number without a fraction, 5.0
    too), float, str, bool or null, and ``path`` is ``a.b[0].c``. Empty objects and lists have no leaves. Violations: ``(by...,
    reason, document)``; each document is in one of the two, a null one is not
    valid JSON."""
    keys = [_q(c) for c in by]
    text = _q(text_col)
    opened = F.coalesce(nesting_depth(text), F.lit(0))
    read = docs.select(*keys, text.alias("document"), opened.alias("_depth"), F.try_parse_json(text).alias("v"))
    reason = (
        F.when(F.col("_depth") > MAX_DEPTH, TOO_DEEP)
        .when(F.col("v").isNull(), NOT_JSON)
        .when(~F.ltrim(F.regexp_replace("document", r"^\s+", "")).startswith("{"), NOT_AN_OBJECT)
    )
    read = read.withColumn("reason", reason)
    depth = read.where(F.col("reason").isNull()).agg(F.max("_depth")).first()[0] or 0
    rows = read.where(F.col("reason").isNull()).select(*keys, F.lit("").alias("path"), "v")
    for _ in range(depth):
        rows = rows.select(*keys, F.inline(_members(F.col("path"), F.col("v"))))
    kind = F.schema_of_variant("v")
    is_int = kind.isin("BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$")
    is_float = (kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")) & ~is_int
    named = (
        F.when(F.is_variant_null("v"), "null")
        .when(kind == "STRING", "str")
        .when(kind == "BOOLEAN", "bool")
        .when(is_int, "int")
        .when(is_float, "float")
    )
    leaf = rows.withColumn("kind", named).where(F.col("kind").isNotNull())  # the rest are empty objects and lists
    number = F.when(F.col("kind").isin("int", "float"), F.try_variant_get("v", "$", "double"))
    shown = F.when(F.col("kind").isin("str", "bool"), F.try_variant_get("v", "$", "string"))
    leaves = leaf.select(*keys, "path", "kind", number.alias("value_num"), shown.alias("value_str"))
    return leaves, read.where(F.col("reason").isNotNull()).select(*keys, "reason", "document")
