"""Readers and sinks on small fixture files written per test."""

import os

from flowlens.sources import readers as R
from flowlens.sources import schemas
from flowlens.sources.sinks import dot_lines, write_csv, write_dot

LEADS_CSV = """lead_id,age,gender,current_city,current_education,parent_occupation,lead_gen_source
L-7,41,FEMALE,Oslo,School,Farmer,poster
L-8,211,MALE,Turin,,Baker,radio
L-9,23,FEMALE,Quito,College,Pilot,fair
"""

CREDIT_CSV = '''"Time","V1","V2","Amount","Class"
"0","-1.3598","0.5","149.62","0"
"1","1.19","abc","2.69","0"

"2","-0.96","1.5","378.66","1"
"3","",,"",""
broken
'''


def _write(tmp_path, name, text):
    p = os.path.join(tmp_path, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_with_schema_keeps_dirty_values(spark, tmp_path):
    p = _write(tmp_path, "leads.csv", LEADS_CSV)
    df = R.read_csv(spark, p, schemas.LEADS)
    got = {r.lead_id: r for r in df.collect()}
    assert got["L-8"].age == 211  # outlier kept
    assert got["L-8"].current_education is None  # empty string → NULL (D12)
    assert df.schema == schemas.LEADS


def test_edge_list_space_separated(spark, tmp_path):
    p = _write(tmp_path, "edges.txt", "0 1\n0 2\n1 2\n")
    df = R.read_edge_list(spark, p)
    assert sorted(tuple(r) for r in df.collect()) == [(0, 1), (0, 2), (1, 2)]


def test_tolerant_labelled_csv(spark, tmp_path):
    p = _write(tmp_path, "cc.csv", CREDIT_CSV)
    df = R.read_labelled_csv(spark, p, feature_cols=["V1", "V2", "Amount"], label_col="Class")
    got = sorted((tuple(r.features), r.label) for r in df.collect())
    # quotes stripped; 'abc' → 0.0; blank line and line of one field dropped; a line of empty fields stays
    assert got == [((-1.3598, 0.5, 149.62), 0), ((-0.96, 1.5, 378.66), 1), ((0.0, 0.0, 0.0), 0), ((1.19, 0.0, 2.69), 0)]


def test_missing_file_gives_empty(spark, tmp_path):
    df = R.read_labelled_csv(spark, os.path.join(tmp_path, "nope.csv"), feature_cols=["V1"], label_col="Class")
    assert df.count() == 0 and df.columns == ["features", "label"]


def test_csv_sink_round_trip(spark, tmp_path):
    df = R.small_table(spark, [("a", 1), ("b", 2)], "k string, v int")
    out = os.path.join(tmp_path, "out")
    write_csv(df, out)
    back = spark.read.schema("k string, v int").option("header", True).csv(out)
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1), ("b", 2)]


def test_preview_and_sql_source(spark, tmp_path):
    df = R.small_table(spark, [(i,) for i in range(10)], "x int")
    p = R.preview(df, 3)
    assert len(p["head"]) == 3 and p["columns"] == ["x"] and not p["is_empty"]
    s = R.sql_source(spark, "SELECT COUNT(*) AS n FROM t WHERE x > 4", {"t": df})
    assert s.first().n == 5


def test_warehouse_format_scan(spark, tmp_path):
    out = os.path.join(tmp_path, "pq")
    R.small_table(spark, [(1, "a")], "id int, s string").write.parquet(out)
    assert R.read_warehouse(spark, "parquet", path=out).count() == 1


def test_dot_sink(spark, tmp_path):
    nodes = R.small_table(spark, [("A", "Alpha"), ("B", 'Be"ta')], "id string, label string")
    edges = R.small_table(spark, [("A", "B", "2 leads")], "src string, dst string, label string")
    lines = dot_lines("G", nodes, edges)
    out = os.path.join(tmp_path, "dot")
    write_dot(lines, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part-"))
    assert text.startswith('digraph "G" {')
    assert '"A" -> "B" [label="2 leads"];' in text
    assert '[label="Be\\"ta"]' in text
    assert text.rstrip().endswith("}")


def test_records_and_rejects(spark):
    from flowlens.sources.records import parse_records

    lines = ['1,"2,5",x,1', '1,2,3,0', "", None, "  ", "7", '"a ""b""",2,3,1', "1,2", "1,2,3,4,5", ",,,"]
    df = spark.createDataFrame(list(enumerate(lines)), "id int, line string")
    good, rejects = parse_records(df, "id", "line", 3)
    assert {r.id: (list(r.features), r.label, r.n_repaired) for r in good.collect()} == {
        0: ([1.0, 0.0, 0.0], 1, 2), 1: ([1.0, 2.0, 3.0], 0, 0), 6: ([0.0, 2.0, 3.0], 1, 1),
        7: ([1.0, 2.0, 0.0], 0, 2), 8: ([1.0, 2.0, 3.0], 4, 0), 9: ([0.0, 0.0, 0.0], 0, 4),
    }
    assert {r.id: r.reason for r in rejects.collect()} == {2: "blank", 3: "blank", 4: "blank", 5: "one field"}
    good, rejects = parse_records(df.limit(0), "id", "line", 3)
    assert good.count() == rejects.count() == 0


def test_dot_clusters_open_and_close_around_their_nodes(spark):
    nodes = spark.createDataFrame([("x", "main", "box", 'a "b"\nc'), ("y", None, "diamond", "d"), ("z", "side", None, "e")],
                                  "id string, cluster string, shape string, label string")
    edges = spark.createDataFrame([("x", "y")], "src string, dst string")
    clusters = spark.createDataFrame([("main", "Main"), ("side", "Side")], "cluster string, label string")
    lines = [r.line for r in dot_lines("G", nodes, edges, clusters=clusters).orderBy("seq", "key").collect()]
    assert lines == [
        'digraph "G" {',
        '  "y" [label="d", shape="diamond"];',
        '  subgraph "cluster_main" { label="Main";',
        '  "x" [label="a \\"b\\"\\nc", shape="box"];',
        "  }",
        '  subgraph "cluster_side" { label="Side";',
        '  "z" [label="e"];',
        "  }",
        '  "x" -> "y";',
        "}",
    ]
