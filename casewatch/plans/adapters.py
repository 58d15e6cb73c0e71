"""Driver tables -> case-shaped tables (see FIXTURES.md section 3).

The driver data holds no case reports, so these adapters derive wide case
tables with the reference's column names from the TPC-H-style tables. Nulls,
blank items and unparsable values are created on purpose
(the source tables contain none). ``%`` below only *derives values*; no
adapter filters rows, so every query covers the whole tables.

Every SQL twin in ``casewatch.plans.oracle`` mirrors these definitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TARGET_PATTERN = r"\bWIDGET\b"

#: Written forms of a date (Spark pattern, tail); the tail " " marks upper case.
DATE_TEXTS = (
    ("yyyyMMdd", ""),
    ("yyyy-MM-dd", ""),
    ("MM/dd/yyyy", ""),
    ("MMM yyyy", ""),
    ("yyyy-MM", ""),
    ("M/d/yyyy", ""),
    ("yyyy-M-d", ""),
    ("dd-MMM-yyyy", ""),
    ("dd-MMM-yyyy", " "),
    ("yyyy/MM/dd", ""),
    ("d MMM yyyy", ""),
    ("MMM d, yyyy", ""),
    ("MMMM yyyy", ""),
    ("yyyy-MM-dd", " 10:00"),
    ("yyyy-MM-dd", "T00:00:00Z"),
    ("yyyy-MM-dd", " 00:00:00.0"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _case_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cases: flags, date, age and sex from orders + customer +
    nation + region (FIXTURES 3.1). Dimension joins are on tiny tables
    (nation 25, region 5 rows) and broadcast by size."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    df = (
        o.join(c, o.o_custkey == c.c_custkey, "left")
        .join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(r, n.n_regionkey == r.r_regionkey, "left")
    )
    return df.select(
        key,
        _s(key).alias("safetyreportid"),
        F.lit("1").alias("safetyreportversion"),
        F.when(prio == "1-URGENT", "Yes ")
        .when(prio == "2-HIGH", "1")
        .when(prio == "3-MEDIUM", "0")
        .when(prio == "5-LOW", "no")
        .alias("serious"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000), "yes")
        .otherwise("no")
        .alias("seriousnessdeath"),
        F.when(F.col("o_totalprice") > 450000, "true").otherwise("false").alias("seriousnesslifethreatening"),
        F.when(F.col("o_orderstatus") == "P", "1").otherwise("0").alias("seriousnesshospitalization"),
        F.when(prio.isin("1-URGENT", "2-HIGH"), "yes").otherwise("no").alias("fulfillexpeditecriteria"),
        F.col("n_name").alias("primarysourcecountry"),
        F.col("r_name").alias("occurcountry"),
        F.col("o_orderstatus").alias("reporttype"),
        F.when(key % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("report_date"),
        F.when(key % 29 == 0, "n.k.")
        .when(key % 31 == 0, "3d")
        .otherwise(_s(F.floor(F.abs(F.col("c_acctbal")) / 100).cast("int")))
        .alias("patient_patientonsetage"),
        F.when(key % 5 == 0, "Year")
        .when(key % 5 == 1, "year")
        .when(key % 5 == 2, "month")
        .when(key % 5 == 3, "day")
        .otherwise("decade")
        .alias("patient_patientonsetageunit"),
        F.when(key % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias(
            "patient_patientsex"
        ),
    )


def case_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES 3.1: one raw case row per order, no packed lists."""
    return _case_core(spark, sf_dir).drop("o_orderkey")


def line_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES 3.2: a flat reaction table, one row per line item."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    df = li.join(p, li.l_partkey == p.p_partkey, "left")
    return df.select(
        F.col("l_orderkey").alias("safetyreportid"),
        F.concat("p_type", F.lit(" "), "p_name").alias("reaction_pt"),
        F.when(F.col("l_returnflag") == "A", "Recovered ")
        .when(F.col("l_returnflag") == "N", "unknown")
        .alias("reaction_outcome"),
        F.col("l_linenumber").alias("version_tag"),
    )


def packed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, the line items packed into comma lists (FIXTURES 3.3/3.4).

    Item order is pinned by every sort key (line number alone is not
    unique)."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    df = li.join(p, li.l_partkey == p.p_partkey, "left")
    item = F.struct(
        F.col("l_linenumber").alias("k1"),
        F.col("l_partkey").alias("k2"),
        F.col("l_suppkey").alias("k3"),
        F.col("l_returnflag").alias("k4"),
        F.col("l_linestatus").alias("k5"),
        F.coalesce(F.concat("p_type", F.lit(" "), "p_name"), F.lit("")).alias("term"),
        F.when(F.col("l_returnflag") == "A", "Recovered ")
        .when(F.col("l_returnflag") == "N", "unknown")
        .otherwise("")
        .alias("outcome"),
        F.coalesce("p_brand", F.lit("")).alias("product"),
        F.coalesce("p_name", F.lit("")).alias("substance"),
        F.coalesce("p_type", F.lit("")).alias("route"),
    )
    # sort_array and a field of all items are compiled, a lambda per item is not
    grouped = df.groupBy(F.col("l_orderkey")).agg(F.sort_array(F.collect_list(item)).alias("_items"))

    def packed(field: str) -> Column:
        return F.array_join(F.col("_items")[field].cast("array<string>"), ",")

    return grouped.select(
        F.col("l_orderkey"),
        packed("term").alias("patient_reaction_reactionmeddrapt"),
        packed("outcome").alias("patient_reaction_reactionoutcome"),
        packed("k1").alias("patient_reaction_reactionmeddraversionpt"),
        packed("k5").alias("patient_drug_drugcharacterization"),
        packed("product").alias("patient_drug_medicinalproduct"),
        packed("substance").alias("patient_drug_activesubstance_activesubstancename"),
        packed("route").alias("patient_drug_drugadministrationroute"),
    )


def raw_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full wide raw table: case columns + packed reaction/drug lists.
    Orders without line items keep null lists (left join)."""
    core = _case_core(spark, sf_dir)
    lists = packed_lists(spark, sf_dir)
    return core.join(lists, core.o_orderkey == lists.l_orderkey, "left").drop("o_orderkey", "l_orderkey")


def versioned_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES 3.4 ``versions``: each order is a version of its customer's
    case. Version = order year as text (ties on purpose), some versions
    unparsable (-> 0), some ids non-numeric (-> one null-id case)."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        F.when(F.col("o_custkey") % 97 == 0, F.lit("unknown"))
        .otherwise(_s(F.col("o_custkey")))
        .alias("safetyreportid"),
        F.when(key % 17 == 0, F.lit("v2"))
        .otherwise(_s(F.year("o_orderdate")))
        .alias("safetyreportversion"),
        key.alias("o_orderkey"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("report_date"),
        F.col("o_orderstatus").alias("reporttype"),
    )


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES 3.4 ``date_text``, widened to the written forms of DATE_TEXTS."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    d = F.col("o_orderdate")
    text = F.lit("n/a")
    for i, (fmt, tail) in enumerate(DATE_TEXTS):
        form = F.concat(F.date_format(d, fmt), F.lit(tail))
        text = F.when(key % (len(DATE_TEXTS) + 1) == i, F.upper(form) if tail == " " else form).otherwise(text)
    return o.select(key.alias("safetyreportid"), text.alias("date_text"))


def id_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw id/version text for numeric coercion."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("o_orderkey"),
        F.when(key % 23 == 0, F.concat(F.lit("ID-"), _s(key)))
        .when(key % 31 == 0, F.concat(_s(key), F.lit(".5")))
        .when(key % 5 == 0, F.concat(_s(key), F.lit(".0")))
        .when(key % 7 == 0, F.concat(_s(key), F.lit("0.0E-1")))
        .otherwise(_s(key))
        .alias("safetyreportid"),
        F.when(key % 11 == 0, F.lit(None).cast("string"))
        .when(key % 9 == 0, F.lit("NaN"))
        .when(key % 10 == 0, F.lit("3d"))
        .when(key % 13 == 0, F.lit("v2"))
        .otherwise(F.concat(_s(F.col("o_custkey") % 7), F.lit(".5")))
        .alias("safetyreportversion"),
    )


#: Columns of the written-out lines below.
LINE_COLUMNS = ("safetyreportid", "serious", "primarysourcecountry", "report_date", "remark")


def _line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    remark = (
        F.when(key % 3 == 0, F.concat(F.lit('see "'), F.col("serious"), F.lit('", then '), F.col("reporttype")))
        .when(key % 3 == 1, F.lit("plain"))
    )
    return _case_core(spark, sf_dir).select("o_orderkey", *LINE_COLUMNS[:-1], remark.alias("remark"))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases as lines of four CSV files. One file has its columns in another
    order under upper-case names, one has no header; some lines lack a cell, have
    one too many or a quote that is never closed."""
    key = F.col("o_orderkey")
    quoted = F.concat(F.lit('"'), F.replace("remark", F.lit('"'), F.lit('""')), F.lit('"'))
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in LINE_COLUMNS[:-1]}
    text["remark"] = F.when(F.col("remark").isNull(), F.lit("")).when(key % 3 == 0, quoted).otherwise(F.col("remark"))
    line = F.concat_ws(",", *[text[c] for c in LINE_COLUMNS])
    turned = F.concat_ws(",", *[text[c] for c in reversed(LINE_COLUMNS)])
    line = F.when(key % 4 == 2, turned).otherwise(line)
    line = (
        F.when(key % 19 == 0, F.substring_index(line, ",", 3))
        .when(key % 23 == 0, F.concat(line, F.lit(",more")))
        .when(key % 29 == 0, F.concat(line, F.lit(',"open')))
        .otherwise(line)
    )
    file = F.concat(F.lit("part-"), (key % 4).cast("string"))
    cells = _line_cells(spark, sf_dir)
    header = F.when(key % 4 == 2, F.lit(" , ".join(reversed(LINE_COLUMNS)).upper())).otherwise(",".join(LINE_COLUMNS))
    headers = cells.select(file.alias("source_file"), header.alias("line")).where("source_file != 'part-3'").distinct()
    return cells.select(file.alias("source_file"), line.alias("line")).unionByName(headers)


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases as JSON lines; some are cut off, no object, or repeat a name."""
    key = F.col("o_orderkey")
    cells = F.struct(
        F.col("safetyreportid").cast("long").alias("SafetyReportId"),
        *LINE_COLUMNS[1:],
        F.array(F.col("serious"), F.lit("x")).alias("codes"),
        F.struct(F.lit(1).alias("a")).alias("nested"),
    )
    whole = F.to_json(cells)
    line = (
        F.when(key % 19 == 0, F.substring(whole, F.lit(1), F.length(whole) - 9))
        .when(key % 23 == 0, F.lit("[1, 2]"))
        .when(key % 29 == 0, F.concat(F.lit('{" SERIOUS": "twice", '), F.substring(whole, F.lit(2), F.length(whole))))
        .otherwise(whole)
    )
    return _line_cells(spark, sf_dir).select(F.lit("lines").alias("source_file"), line.alias("line"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON documents of four shapes; some are no objects or cut off."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    inner = F.struct(F.col("o_orderstatus").alias("status"), price.alias("price"))
    gone = F.lit(None).cast("string").alias("gone")
    flat = F.to_json(F.struct(key.alias("key"), (key % 2 == 0).alias("even"), gone), {"ignoreNullFields": "false"})
    notes = F.array(F.col("o_orderpriority"), F.lit("of 1,016")).alias("notes")
    listed = F.to_json(F.struct(notes, F.array().cast("array<int>").alias("none")))
    nested = F.to_json(F.struct(F.struct(F.array(inner, inner).alias("b")).alias("a"), key.alias("key")))
    text = (
        F.when(key % 31 == 0, "[1, 2]")
        .when(key % 37 == 0, F.substring(nested, F.lit(1), F.length(nested) - 3))
        .when(key % 3 == 0, flat)
        .when(key % 3 == 1, listed)
        .otherwise(nested)
    )
    return o.select("o_orderkey", text.alias("value"))


def prompt_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers asking for a section by name, some names unknown, some
    customers of no country."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    section = (
        F.when(key % 7 == 0, " Narrative_Summary ")
        .when(key % 7 == 1, "SUMMARY_ANALYSIS")
        .when(key % 7 == 2, "reaction_analysis")
        .when(key % 7 == 3, "serious_alert_analysis\t")
        .when(key % 7 == 4, "trend_interpretation")
        .when(key % 7 == 5, "conclusion")
    )
    country = F.when(key % 11 == 0, "NOWHERE").otherwise(F.col("n_name"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select("c_custkey", country.alias("country"), section.alias("section"))


def limitation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with limitations as JSON text: a list, an object, nulls, nothing."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    words = F.array(F.concat(F.lit("status "), F.col("o_orderstatus")), F.col("o_orderpriority"))
    gone = F.lit(None).cast("string").alias("gone")
    named = F.struct(key.alias("order"), gone, words.alias("notes"), (key % 2 == 0).alias("even"))
    text = (
        F.when(key % 5 == 0, F.to_json(words))
        .when(key % 5 == 1, F.to_json(named, {"ignoreNullFields": "false"}))
        .when(key % 5 == 2, F.lit('{"a": null, "b": []}'))
        .when(key % 5 == 3, "[]")
    )
    return o.select("o_orderkey", text.alias("limitations"))
