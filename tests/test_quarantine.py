"""Raw lines: nothing vanishes, no cell moves to another column."""

import csv
import io
import json
import os
import random
import tempfile

import pytest

from casewatch.sources import quarantine as Q
from casewatch.sources import read_raw, read_raw_checked

NAMES = ["id", "serious", "country"]


def write(files):
    d = tempfile.mkdtemp(prefix="casewatch-lines-", dir="/tmp")
    for name, text in files.items():
        with open(os.path.join(d, name), "w", newline="") as f:
            f.write(text)
    return d


def told(scan):
    rows = sorted((os.path.basename(r.source_file), *[r[c] for c in NAMES]) for r in scan.rows.collect())
    bad = sorted((os.path.basename(r.source_file), r.reason, r.line) for r in scan.violations.collect())
    return rows, bad


def test_csv(spark):
    d = write(
        {
            "a.csv": '﻿ID,Serious,Country\n1,yes,"Korea, South"\n2,no\n\n3,"a ""b"" c",x\n4,no,fr,extra\n5,"open,x\n',
            "b.csv": " country , SERIOUS , id\r\nde,no,6\r\n,yes,7\r\n",
            "c.csv": "8,no,fr\n9,no,fr\n",
            "d.csv": "id,serious,country,country\n10,no,fr,de\n",
            "e.csv": "id,serious,country\n11,no,fr\ncountry,id,serious\nfr,12,no\n",
            "f.csv": "id,serious,country,note\n13,N/A,es,hello\nid,serious,country,note\n14,,\"\",x\n",
        }
    )
    scan = read_raw_checked(spark, d, required=NAMES)
    rows, bad = told(scan)
    assert rows == [
        ("a.csv", "1", "yes", "Korea, South"),
        ("a.csv", "3", 'a "b" c', "x"),
        ("b.csv", "6", "no", "de"),
        ("b.csv", "7", "yes", None),
        ("f.csv", "13", None, "es"),
        ("f.csv", "14", None, ""),
    ]
    assert bad == sorted([
        ("a.csv", Q.RAGGED, "2,no"),
        ("a.csv", Q.RAGGED, "4,no,fr,extra"),
        ("a.csv", Q.BROKEN_QUOTES, '5,"open,x'),
        ("c.csv", Q.NO_HEADER, "8,no,fr"),
        ("c.csv", Q.NO_HEADER, "9,no,fr"),
        ("d.csv", Q.REPEATED_NAME, "10,no,fr,de"),
        ("e.csv", Q.TWO_HEADERS, "11,no,fr"),
        ("e.csv", Q.TWO_HEADERS, "fr,12,no"),
    ])
    assert scan.rows.columns == ["source_file", "country", "id", "note", "serious"]


def test_cells_like_a_csv_reader(spark):
    rng = random.Random(1)
    cells = [[rng.choice(["", "a", 'q"q', "x,y", '"', " b ", "é" * 3, "1,2,\"3\""]) for _ in range(rng.randint(1, 6))] for _ in range(300)]
    lines = []
    for row in cells:
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(row)
        lines.append((out.getvalue(),))
    got = [r[0] for r in spark.createDataFrame(lines, "line string").select(Q.csv_cells(Q.F.col("line"))).collect()]
    assert [[c or "" for c in r] for r in got] == cells
    long = 'x,"' + 'y""' * 40_000 + '",z'
    assert [len(c) for c in spark.createDataFrame([(long,)], "line string").select(Q.csv_cells(Q.F.col("line"))).first()[0]] == [1, 80_000, 1]


def test_json(spark):
    whole = {"ID": 1, "serious": True, "country": None, "codes": ["a", "b"], "deep": {"x": [1]}}
    text = "\n".join([json.dumps(whole), json.dumps(whole)[:-4], "[1]", "7", "", '{"id": "2", " Id ": "3"}', '{"id": "4"}'])
    scan = read_raw_checked(spark, write({"a.json": text}), "json", required=["id"], columns=["id", "serious", "country", "codes", "deep"])
    assert sorted(tuple(r)[1:] for r in scan.rows.collect()) == [("1", "true", None, "a,b", '{"x":[1]}'), ("4", None, None, None, None)]
    assert sorted((r.reason, r.line) for r in scan.violations.collect()) == sorted([
        (Q.NOT_AN_OBJECT, json.dumps(whole)[:-4]), (Q.NOT_AN_OBJECT, "[1]"), (Q.NOT_AN_OBJECT, "7"),
        (Q.REPEATED_NAME, '{"id": "2", " Id ": "3"}'),
    ])


def test_read_raw_json_is_not_inferred(spark):
    d = write({"a.json": '{"id": 7.5, "serious": 1}\n{"id": "x"}\n'})
    df = read_raw(spark, d, "json", required=["id"])
    assert dict(df.dtypes) == {"id": "string", "serious": "string"}
    assert sorted((r.id, r.serious) for r in df.collect()) == [("7.5", "1"), ("x", None)]
    broken = write({"a.json": '{"id": 1}\n{"id": \n'})
    with pytest.raises(Exception, match="not a complete JSON object"):
        read_raw(spark, broken, "json", required=["id"]).collect()


def test_empty(spark):
    scan = Q.parse_csv(spark.createDataFrame([], "source_file string, line string"), required=["id"], columns=["id"])
    assert scan.rows.count() == 0 and scan.violations.count() == 0
    with pytest.raises(ValueError, match="Missing required columns: id"):
        Q.parse_csv(spark.createDataFrame([("f", "x,y")], "source_file string, line string"), required=["id"])
