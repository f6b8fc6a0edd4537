"""File scans and sinks."""

import datetime as dt
import json

from tidemark.sources import evidence, sinks


def test_manifest_types_and_blanks(spark, tmp_path):
    (tmp_path / "m.csv").write_text("source,congress_no,size_bytes\na,113,\nb,x,12\n")
    rows = evidence.manifest(spark, str(tmp_path / "m.csv")).collect()
    assert [(r.congress_no, r.size_bytes) for r in rows] == [(113, None), (None, 12)]


def test_snapshot_dialects(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"name": "A", "type": "Senate", "democrats": ["x", " "]}, {"committee": "B", "republicans": ["y"]}]))
    rows = evidence.directory_snapshots(spark, str(tmp_path / "s.json")).collect()
    assert {(r.body, r.chamber, r.party, r.label) for r in rows} == {("A", "Senate", "D", "x"), ("B", "House", "R", "y")}


def test_proceedings_date_from_file_name(spark, tmp_path):
    (tmp_path / "REC-2013-01-15-pt1-PgS1.json").write_text(json.dumps({"header": {}, "content": [{"kind": "speech", "text": "a"}, {"kind": "speech", "text": "b"}]}))
    rows = evidence.proceedings(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.day, r.chamber, r.text) for r in rows] == [(dt.date(2013, 1, 15), "Senate", "a"), (dt.date(2013, 1, 15), "Senate", "b")]


def test_mixed_content_keeps_its_order(spark, tmp_path):
    (tmp_path / "r1eh.xml").write_text("<r><legis-num>H. RES. 6</legis-num><action-date date='20130103'/><committee-appointment-paragraph><header>Body</header><text>Mr. <em>A</em>, to rank after B</text></committee-appointment-paragraph></r>")
    row = evidence.resolutions(spark, str(tmp_path)).first()
    assert (row.citation, row.day, row.header, row.text) == ("H. RES. 6", dt.date(2013, 1, 3), "Body", "Mr. A, to rank after B")


def test_release_csv_is_deterministic(spark, tmp_path):
    rows = [(2, dt.date(2020, 1, 2), True, 1.5), (1, None, False, None)]
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        df = spark.createDataFrame(rows, "id int, day date, flag boolean, pct double").repartition(2)
        sinks.write_release_csv(df, str(tmp_path / name / "x.csv"), ["id"])
        sinks.write_metadata(str(tmp_path / name), {"x": 2}, "1.1.0")
    assert (tmp_path / "a/x.csv").read_text() == "id,day,flag,pct\n1,,false,\n2,2020-01-02,true,1.500\n"
    assert {s for _, s in sinks.compare_folders(str(tmp_path / "a"), str(tmp_path / "b"))} == {"same"}


def test_rebuild_empties_a_requested_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 113), (2, 114), (3, 115)], "id int, congress int")
    df.write.partitionBy("congress").parquet(path)
    sinks.rebuild_partitions(df.filter("congress = 114").withColumn("id", df.id + 10), path, "congress", [113, 114])
    assert {(r.id, r.congress) for r in spark.read.parquet(path).collect()} == {(12, 114), (3, 115)}
