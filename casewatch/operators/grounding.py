"""Grounding checks over text (F1-F6), in bulk: any number of texts against
any number of evidence sets, matched on group keys.

* numbers are extracted with one JVM regex per text (whole text, no prefix);
* "is this number in the evidence" is a ``left_anti`` equi-join on
  (group..., value, salt): a hot group spreads by value, a hot value by salt;
* phrase flags are an in-row ``filter`` over a literal array — no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.config import (
    CLAIM_MESSAGE_PREFIX,
    EMPTY_TEXT_FINDING,
    FLAGGED_PHRASES,
    NUMBER_PATTERN,
)
from casewatch.functions import extract_numbers, number_value, strip
from casewatch.functions.joins import join_null_safe

#: Tasks over which the numbers of one (group, value) are dealt.
SALTS = 16


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def text_numbers(
    texts: DataFrame, ids: Sequence[str], text_col: str = "text", pattern: str = NUMBER_PATTERN
) -> DataFrame:
    """F1 + F2: ``(ids..., pos, number, value)`` — every number token in
    order (1-based ``pos``), with its normalized numeric value."""
    exploded = texts.select(
        *[_q(c) for c in ids], F.posexplode(extract_numbers(_q(text_col), pattern)).alias("pos", "number")
    )
    return exploded.select(
        *[_q(c) for c in ids], (F.col("pos") + 1).alias("pos"), "number", number_value("number").alias("value")
    )


def evidence_numbers_from_text(
    evidence: DataFrame, group: Sequence[str], text_col: str, pattern: str = NUMBER_PATTERN
) -> DataFrame:
    """F3 for evidence given as text: distinct ``(group..., value)``."""
    nums = evidence.select(*[_q(c) for c in group], F.explode(extract_numbers(_q(text_col), pattern)).alias("n"))
    return nums.select(*[_q(c) for c in group], number_value("n").alias("value")).distinct()


def evidence_numbers_from_facts(facts: DataFrame, group: Sequence[str], pattern: str = NUMBER_PATTERN) -> DataFrame:
    """F3 for ``evidence_facts``: numeric leaves plus numbers inside string
    leaves; map keys and booleans are ignored. Distinct ``(group..., value)``."""
    nums = facts.filter(F.col("kind").isin("int", "float")).select(
        *[_q(c) for c in group], F.col("value_num").alias("value")
    )
    in_text = facts.filter(F.col("kind") == "str").select(
        *[_q(c) for c in group], F.explode(extract_numbers(F.col("value_str"), pattern)).alias("n")
    )
    text_vals = in_text.select(*[_q(c) for c in group], number_value("n").alias("value"))
    return nums.unionByName(text_vals).distinct()


def unsupported_numbers(numbers: DataFrame, evidence: DataFrame, group: Sequence[str]) -> DataFrame:
    """text numbers whose value is not in the evidence of their group
    (original token kept, duplicates and order kept via ``pos``). Null groups
    match each other. A pair (group, value) that a large part of all numbers
    share is dealt over ``SALTS`` tasks: each evidence row is there once for
    every salt."""
    salted = numbers.withColumn("_salt", F.pmod(F.xxhash64(*[_q(c) for c in numbers.columns]), F.lit(SALTS)).cast("int"))
    known = evidence.select(
        *[_q(c) for c in group], "value", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    return join_null_safe(salted, known, group, "left_anti", plain=["value", "_salt"]).drop("_salt")


def claim_array(text: Column, phrases: Sequence[str] = FLAGGED_PHRASES) -> Column:
    """F5 as an expression: array of ``struct(ord, phrase, finding)`` for every
    flagged phrase contained (lower-case substring) in the text, in list
    order; an empty or null text yields the single fixed finding (ord 0)."""
    lowered = F.lower(text)  # one common subexpression, lower-cased once per text
    hits = F.filter(
        F.array(
            *[
                F.when(
                    F.contains(lowered, F.lit(p)),
                    F.struct(
                        F.lit(i + 1).alias("ord"),
                        F.lit(p).alias("phrase"),
                        F.lit(CLAIM_MESSAGE_PREFIX + p + "'").alias("finding"),
                    ),
                )
                for i, p in enumerate(phrases)
            ]
        ),
        lambda x: x.isNotNull(),
    )
    empty = F.array(
        F.struct(
            F.lit(0).alias("ord"), F.lit(None).cast("string").alias("phrase"), F.lit(EMPTY_TEXT_FINDING).alias("finding")
        )
    )
    return F.when(text.isNull() | (text == ""), empty).otherwise(hits)


def claim_findings(
    texts: DataFrame,
    ids: Sequence[str],
    text_col: str = "text",
    phrases: Sequence[str] = FLAGGED_PHRASES,
) -> DataFrame:
    """``(ids..., ord, phrase, finding)`` — one row per finding."""
    return texts.select(*[_q(c) for c in ids], F.inline(claim_array(_q(text_col), phrases)))


def fact_numbers(pattern: str = NUMBER_PATTERN) -> Column:
    """Evidence numbers of one ``evidence_facts`` row as an array: the
    numeric value, or the numbers inside a string value; keys and booleans
    give none."""
    kind = F.col("kind")
    return (
        F.when(kind.isin("int", "float"), F.array(F.col("value_num")))
        .when(kind == "str", F.transform(extract_numbers(F.col("value_str"), pattern), number_value))
        .otherwise(F.array().cast("array<double>"))
    )


def section_validation(
    texts: DataFrame,
    ids: Sequence[str],
    group: Sequence[str],
    evidence: DataFrame,
    text_col: str = "text",
    phrases: Sequence[str] = FLAGGED_PHRASES,
    pattern: str = NUMBER_PATTERN,
) -> DataFrame:
    """Per text ``n_unsupported_numbers, n_unsupported_claims, valid,
    human_review_required`` (valid = no bad number, no finding, not blank).

    Phrase findings and the blank test are computed inside the row, one small
    row a text. The numbers are taken out of the text before they are
    un-nested, so no text is copied for its numbers; texts without numbers
    have no row here and no null key is joined. What the anti-join leaves is
    counted per text together with the findings, in one partial + final
    aggregate. ``ids`` must identify a text; ``evidence`` is distinct
    ``(group..., value)``."""
    t = _q(text_col)
    keys = [_q(c) for c in ids]
    carry = [c for c in group if c not in ids]
    flags = texts.select(
        *keys,
        F.lit(0).cast("long").alias("_bad"),
        F.size(claim_array(t, phrases)).cast("long").alias("_claims"),
        F.coalesce(strip(t) != "", F.lit(False)).alias("_nonblank"),
    )
    values = texts.select(*keys, *[_q(c) for c in carry], F.transform(extract_numbers(t, pattern), number_value).alias("_values"))
    numbers = values.select(*keys, *[_q(c) for c in carry], F.posexplode("_values").alias("_pos", "value"))
    bad = unsupported_numbers(numbers, evidence, group).select(
        *keys, F.lit(1).cast("long").alias("_bad"), F.lit(0).cast("long").alias("_claims"), F.lit(False).alias("_nonblank")
    )
    per_text = flags.unionByName(bad).groupBy(*keys).agg(
        F.sum("_bad").alias("n_unsupported_numbers"),
        F.max("_claims").alias("n_unsupported_claims"),
        F.max("_nonblank").alias("_nonblank"),
    )
    valid = (F.col("n_unsupported_numbers") == 0) & (F.col("n_unsupported_claims") == 0) & F.col("_nonblank")
    return per_text.select(
        *[_q(c) for c in ids],
        "n_unsupported_numbers",
        "n_unsupported_claims",
        valid.alias("valid"),
        (~valid).alias("human_review_required"),
    )
