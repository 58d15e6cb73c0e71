"""Skewed inputs: one key / group holds a third of all rows. Results must be
whole and equal to a brute-force computation on the same small fixture."""

import datetime as dt
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from casewatch.operators import grounding as G
from casewatch.operators import metrics as M
from casewatch.operators.rowset import latest_version

N = 30_000


def _hot(i: int) -> bool:
    return i % 3 == 0


def test_hot_case_id_keeps_its_newest_version(spark):
    df = spark.range(N).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("safetyreportid"),
        (F.col("id") % 997).cast("double").alias("safetyreportversion"),
        F.col("id").alias("row"),
    )
    got = {r["safetyreportid"]: r["row"] for r in latest_version(df, tiebreak=["row"]).collect()}
    best: dict[int, tuple[float, int]] = {}
    for i in range(N):
        k = 7 if _hot(i) else i + 100
        cand = (float(i % 997), i)
        if k not in best or cand > best[k]:
            best[k] = cand
    assert got == {k: v[1] for k, v in best.items()}


def _reactions(spark):
    """Group 'hot' holds a third of the rows and thousands of distinct terms."""
    rows = []
    for i in range(N):
        g = "hot" if _hot(i) else f"g{i % 7}"
        term = f"t{(i * 7919) % 2003}" if g == "hot" else f"t{i % 13}"
        if i % 101 == 0:
            term = None
        date = None if i % 17 == 0 else dt.date(2024, 1 + i % 12, 1)
        rows.append((g, term, date))
    return rows, spark.createDataFrame(rows, "g string, reaction_pt string, case_report_date date").repartition(8)


def _ranked(counter: Counter, k: int):
    return sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))[:k]


def test_hot_group_top_terms_concentration_and_month_matrix(spark):
    rows, df = _reactions(spark)
    terms: dict[str, Counter] = defaultdict(Counter)
    total: Counter = Counter()
    dated: Counter = Counter()
    cells: dict[tuple[str, str], Counter] = defaultdict(Counter)
    for g, t, d in rows:
        total[g] += 1
        dated[g] += d is not None
        if t is not None:
            terms[g][t] += 1
            if d is not None:
                cells[(g, t)][d.strftime("%Y-%m")] += 1

    top = {(r["g"], r["rank"]): (r["reaction_pt"], r["n"]) for r in M.top_terms(df, ["g"]).collect()}
    want = {(g, i + 1): kv for g, c in terms.items() for i, kv in enumerate(_ranked(c, 10))}
    assert top == want

    conc = {(r["g"], r["rank"]): (r["reaction_pt"], r["count"], r["percentage_of_reactions"])
            for r in M.reaction_concentration(df, ["g"]).collect()}
    want = {
        (g, i + 1): (t, n, round(n / total[g] * 100, 2))
        for g, c in terms.items() if dated[g] > 0
        for i, (t, n) in enumerate(_ranked(c, 5))
    }
    assert conc.keys() == want.keys()
    for key, (t, n, p) in want.items():
        assert conc[key][:2] == (t, n) and abs(conc[key][2] - p) < 1e-9

    matrix = {(r["g"], r["reaction_pt"], r["month"]): r["n"] for r in M.reaction_month_matrix(df, ["g"]).collect()}
    want = {
        (g, t, m): n
        for g, c in terms.items()
        for t, _ in _ranked(c, 5)
        for m, n in cells[(g, t)].items()
    }
    assert matrix == want


def test_hot_language_and_hot_number_validation(spark):
    texts = []
    for i in range(3000):
        lang = "en" if _hot(i) else f"l{i % 5}"
        body = " ".join(["7"] * (i % 4) + [str(i % 50), "it proves that" if i % 9 == 0 else "fine"])
        texts.append((i, lang, "" if i % 250 == 0 else body))
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(8)
    evidence_rows = [("en", 7.0)] + [(f"l{j}", float(v)) for j in range(5) for v in range(0, 50, 2)]
    evidence = spark.createDataFrame(evidence_rows, "lang string, value double")
    got = {r["doc_id"]: (r["n_unsupported_numbers"], r["n_unsupported_claims"], r["valid"])
           for r in G.section_validation(docs, ["doc_id"], ["lang"], evidence).collect()}
    ev = set(evidence_rows)
    for doc_id, lang, text in texts:
        nums = [float(x) for x in re.findall(r"\d+", text)]
        bad = sum((lang, v) not in ev for v in nums)
        claims = 1 if text == "" else sum(p in text.lower() for p in ("proves that",))
        assert got[doc_id][:2] == (bad, claims), doc_id
        assert got[doc_id][2] == (bad == 0 and claims == 0 and text.strip() != "")
