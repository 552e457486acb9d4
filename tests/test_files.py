import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from gridlens.operators.batch import historical_statistics
from gridlens.sinks import files, messages
from gridlens.sources import csv_folder, geojson, streams, tables


@pytest.fixture
def raw_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "2023_01.csv").write_bytes("\ufeffNRO_DOC_FAC;CONSUMO;DISTRITO\n1;1,5;X\n2;2,5\n3;3;Y;extra\n".encode())
    (folder / "2023_02.csv").write_text("CONSUMO,NRO_DOC_FAC\n7,4\n8,5\n")
    (folder / "2023_03.csv").write_text("NRO_DOC_FAC\tCONSUMO\tDISTRITO\n6\t9\tZ\n")
    (folder / "2023_04.csv").write_text("NRO_DOC_FAC;CONSUMO;DISTRITO\n7;1;X\n8;2;X\n9;3;X\n")
    (folder / "notes.txt").write_text("not a table")
    return str(folder)


def test_separators(spark, raw_folder):
    found = {f.rsplit("/", 1)[1]: s for f, s in rows(csv_folder.detect_separator(spark, raw_folder))}
    assert found == {"2023_01.csv": ";", "2023_02.csv": ",", "2023_03.csv": "\t", "2023_04.csv": ";"}


def test_ties_and_absence_prefer_the_first_separator(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b,c\n")
    (tmp_path / "b.csv").write_text("single\n1\n")
    assert {s for _, s in rows(csv_folder.detect_separator(spark, str(tmp_path)))} == {";"}


def test_folder_is_stacked_by_name(spark, raw_folder):
    df = csv_folder.read_csv_folder(spark, raw_folder)
    got = sorted(rows(df, "NRO_DOC_FAC", "CONSUMO", "DISTRITO"))
    assert got == [
        ("1", "1,5", "X"), ("2", "2,5", None),  # padded; the row with too many fields is left out
        ("4", "7", None), ("5", "8", None), ("6", "9", "Z"), ("7", "1", "X"), ("8", "2", "X"), ("9", "3", "X"),
    ]


def test_row_limits_per_file(spark, raw_folder):
    assert csv_folder.read_csv_folder(spark, raw_folder, max_per_file=1).count() == 4
    assert csv_folder.read_csv_folder(spark, raw_folder, max_total=9).count() == 7
    assert csv_folder.read_csv_folder(spark, raw_folder, max_total=2).count() == 4
    sample = csv_folder.sample_first_files(spark, raw_folder, rows=6)
    assert sorted(r[0] for r in rows(sample, "NRO_DOC_FAC")) == ["1", "2", "4", "5", "6"]


def test_known_layout_needs_no_detection(spark, raw_folder):
    df = csv_folder.read_csv_folder(
        spark, f"{raw_folder}/2023_04.csv", separator=";", columns=["NRO_DOC_FAC", "CONSUMO", "DISTRITO"], keep_source=True
    )
    assert df.count() == 3 and df.first()["_source"].endswith("2023_04.csv")


def test_known_layout_reads_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A;B\na1;b1\na2\na3;b3;too many\n")
    (tmp_path / "b.csv").write_text("\ufeffB;A\nb2;a4\n")
    (tmp_path / "notes.txt").write_text("hello;world\n")
    expected = [("a1", "b1"), ("a2", None), ("a4", "b2")]
    read = csv_folder.read_csv_folder
    assert sorted(rows(read(spark, str(tmp_path), separator=";", columns=["A", "B"]), "A", "B")) == expected
    assert sorted(rows(read(spark, str(tmp_path)), "A", "B")) == expected
    marked = read(spark, str(tmp_path), separator=";", columns=["A", "B"], keep_malformed=True)
    assert marked.filter("_malformed").count() == 1
    (tmp_path / "c.csv").write_text("A;C\n1;2\n")
    with pytest.raises(PySparkException):
        read(spark, str(tmp_path), separator=";", columns=["A", "B"]).collect()


def test_only_the_first_line_is_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A;B\nx;y\nA;B\nB;A\n\nA;B\n")
    (tmp_path / "b.csv").write_text("B;A\nB;A\n2;1\n")
    expected = sorted([("x", "y"), ("A", "B"), ("B", "A"), ("A", "B"), ("A", "B"), ("1", "2")])
    read = csv_folder.read_csv_folder
    assert sorted(rows(read(spark, str(tmp_path)), "A", "B")) == expected
    assert sorted(rows(read(spark, str(tmp_path), separator=";", columns=["B", "A"]), "A", "B")) == expected


def test_layouts_of_every_kind_in_one_scan(spark, tmp_path):
    """Different separators, widths, orders and spellings; a quoted separator; a file of a header and one of nothing."""
    (tmp_path / "a.csv").write_text('A;B;C\n1;"2;5";3\n4\n5;6;7;8\n')
    (tmp_path / "b.csv").write_text('b,A\n"y,z",x\nu,v,w\n')
    (tmp_path / "c.csv").write_text("C\tD\n9\t\n")
    (tmp_path / "d.csv").write_text("A;B;C\n")
    (tmp_path / "e.csv").write_text("")
    df = csv_folder.read_csv_folder(spark, str(tmp_path), keep_malformed=True)
    assert df.columns == ["A", "B", "C", "D", "_malformed"]
    assert sorted(rows(df), key=repr) == sorted([
        ("1", "2;5", "3", None, False), ("4", None, None, None, False), ("5", "6", "7", None, True),
        ("x", "y,z", None, None, False), ("v", "u", None, None, True), (None, None, "9", None, False)], key=repr)
    plan = df.filter("true")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_rows_of_many_layouts_are_joined_by_path(spark, tmp_path, monkeypatch):
    for k in range(12):
        (tmp_path / f"{k:02}.csv").write_text(f"A;B{k % 4}\n{k};{k * k}\n" * (1 + k % 2))
    wide = csv_folder.read_csv_folder(spark, str(tmp_path))
    got = sorted(map(repr, rows(wide)))
    monkeypatch.setattr(csv_folder, "BROADCAST_FILES", 0)
    assert sorted(map(repr, rows(csv_folder.read_csv_folder(spark, str(tmp_path))))) == got
    assert wide.columns == ["A", "B0", "B1", "B2", "B3"] and len(got) == 24


def test_known_layout_is_one_scan_without_exchange(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("A;B\n" + "1;2\n" * 10)
    df = csv_folder.read_csv_folder(spark, str(tmp_path), separator=";", columns=["A", "B"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan and "Join" not in plan
    with pytest.raises(PySparkException, match="not"):
        csv_folder.read_csv_folder(spark, str(tmp_path), separator=";", columns=["A", "C"])


def test_heads_take_one_task_a_file(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"{k}.csv").write_text("A;B\n" + f"{k};2\n" * 50_000)
    heads = csv_folder.file_heads(spark, str(tmp_path), num_lines=3)
    assert sorted(rows(heads.select("n", "line")))[:6] == [(0, "A;B")] * 5 + [(1, "0;2")]
    assert heads.count() == 15 and heads.select("file").distinct().count() == 5
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != csv_folder.ONE_FILE


def test_quoted_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"A;1";B\nx;y\n')
    df = csv_folder.read_csv_folder(spark, str(tmp_path))
    assert df.columns == ["A;1", "B"] and rows(df) == [("x", "y")]


def test_latin1(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("A;B\nCOMÚN;Ñ\n".encode("latin-1"))
    assert rows(csv_folder.read_csv_folder(spark, str(tmp_path), "ISO-8859-1")) == [("COMÚN", "Ñ")]


def test_empty_folder(spark, tmp_path):
    with pytest.raises((FileNotFoundError, PySparkException)):
        csv_folder.read_csv_folder(spark, str(tmp_path))


def test_fact_and_dim_are_read_by_name(spark, tmp_path):
    (tmp_path / "fact.csv").write_text(
        "CONSUMO,NRO_DOC_FAC,FECHA_CONSUMO_DESDE,FECHA_CONSUMO_HASTA,PERIODO\n1.5,7,2023-01-01,2023-01-31,202301\nx,8,bad,,\n")
    fact = tables.read_fact(spark, str(tmp_path / "fact.csv"))
    assert [tuple(map(str, r)) for r in rows(fact)] == [
        ("7", "202301", "1.5", "2023-01-01", "2023-01-31"), ("8", "None", "None", "None", "None")]
    (tmp_path / "dim.csv").write_text("NRO_DOC_FAC,UBIGEO,DISTRITO\n7,30101,X\n")
    assert rows(tables.read_dim(spark, str(tmp_path / "dim.csv")), "UBIGEO", "DISTRITO") == [("030101", "X")]


def test_headers_that_differ_raise(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv" / "1.csv").write_text("NRO_DOC_FAC,CONSUMO\n1,2\n")
    (tmp_path / "t.csv" / "2.csv").write_text("CONSUMO,NRO_DOC_FAC\n1,2\n")
    with pytest.raises(Exception, match="does not conform"):
        tables.read_fact(spark, str(tmp_path / "t.csv")).collect()


def test_statistics_prefer_csv(spark, tmp_path):
    invoices = spark.createDataFrame(
        [("X", "T", "C", 1.0, 2.0), ("X", "T", "C", 3.0, 2.0)],
        "DISTRITO string, TARIFA string, CARTERA string, CONSUMO double, IMPORTE double")
    stats = historical_statistics(invoices)
    base = str(tmp_path / "stats")
    with pytest.raises(FileNotFoundError):
        tables.read_statistics(spark, base)
    files.write_parquet(stats, base)
    assert rows(tables.read_statistics(spark, base)) == rows(stats)
    files.write_csv(stats.withColumn("consumo_promedio", F.lit(9.0)), f"{base}.csv")
    assert rows(tables.read_statistics(spark, base), "consumo_promedio", "total_registros") == [(9.0, 2)]


def test_stored_events(spark, tmp_path):
    row = {"NRO_DOC_FAC": "7", "CONSUMO": "1.5", "PERIODO": "x", "FECHA_EMISION": "2024-01-02"}
    (tmp_path / "lines.json").write_text(json.dumps(row) + "\n" + json.dumps({**row, "NRO_DOC_FAC": "8"}) + "\n")
    (tmp_path / "array.json").write_text(json.dumps([row, row], indent=1))
    lines = tables.read_events_json(spark, str(tmp_path / "lines.json"))
    assert rows(lines, "NRO_DOC_FAC", "CONSUMO", "PERIODO") == [("7", 1.5, None), ("8", 1.5, None)]
    assert tables.read_events_json(spark, str(tmp_path / "array.json"), array=True).count() == 2


def test_first_available_anomalies(spark, tmp_path):
    files.write_parquet(spark.range(3), str(tmp_path / "b"))
    assert tables.read_anomalies(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b")]).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_anomalies(spark, [str(tmp_path / "nothing")])


def test_centroids(spark, tmp_path):
    square = [[[0, 0], [4, 0], [4, 2], [0, 2]], [[1, 1], [9, 9]]]
    features = [
        {"properties": {"IDDIST": "130101"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"properties": {"IDDIST": "130102"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, [[[10, 10]]]]}},
        {"properties": {"IDDIST": ""}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"properties": {"IDDIST": "1"}, "geometry": None},
        {"properties": {"IDDIST": "130103"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"properties": {"IDDIST": "130103"}, "geometry": {"type": "Polygon", "coordinates": [[[5.5, 6]]]}},
    ]
    path = tmp_path / "d.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    out = geojson.district_centroids(geojson.read_geojson_features(spark, str(path)))
    assert sorted(rows(out)) == [("130101", 1.0, 2.0), ("130102", 14 / 5, 18 / 5), ("130103", 6.0, 5.5)]


def test_large_csv_is_split_and_complete(spark, tmp_path):
    path = str(tmp_path / "big")
    files.write_large_csv(spark.range(95).coalesce(1), path, rows_per_file=10)
    assert len(list((tmp_path / "big").glob("part-*.csv"))) == 10
    assert spark.read.option("header", True).csv(path).count() == 95


def test_report_keeps_null_fields(spark, tmp_path):
    files.write_report(spark.sql("SELECT 1 AS a, CAST(NULL AS double) AS b"), str(tmp_path / "r"))
    (part,) = (tmp_path / "r").glob("part-*.json")
    assert json.loads(part.read_text()) == {"a": 1, "b": None}


def test_kafka_settings(spark):
    options = streams.kafka_options("h:9092", "t")
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "50000"
    assert options["subscribe"] == "t" and options["failOnDataLoss"] == "true"
    assert messages.producer_options("h:9092", "t")["topic"] == "t"


def test_messages(spark):
    df = spark.createDataFrame([("7", 1.5), (None, 2.0)], "NRO_DOC_FAC string, CONSUMO double")
    out = rows(messages.as_messages(df))
    assert [k for k, _ in out] == ["7", "0"] and json.loads(out[0][1]) == {"NRO_DOC_FAC": "7", "CONSUMO": 1.5}
    assert rows(messages.as_messages(df.select("CONSUMO")))[0][0] == "0"


def test_lines_of_mixed_separators_are_split_once(spark, tmp_path):
    """Quotes, escapes, empty, missing and additional cells; the plan parses a line once for each separator."""
    lines = {"a": ["x;y;z", "1;2;3", '"4;5";"say \\"no\\"";', ";;", "6", "7;8;9;10", "11;12;13;", " 14 ; ,\t;15"],
             "b": ["z,x,y", "1,2,3", '"4,5","",6', ",,", "7", "8,9,10,11", "é,\\,"]}
    for name, found in lines.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(found) + "\n", encoding="latin-1")
    df = csv_folder.read_csv_folder(spark, str(tmp_path), keep_malformed=True)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 2
    want = []
    for name, separator in (("a", ";"), ("b", ",")):
        rows = spark.read.option("header", False).option("sep", separator).option("encoding", "ISO-8859-1").schema(
            "c0 string, c1 string, c2 string, c3 string").csv(str(tmp_path / f"{name}.csv")).collect()
        places = [rows[0][:3].index(c) for c in "xyz"]
        want += [(*[r[p] for p in places], r[3] is not None) for r in rows[1:]]
    assert sorted(map(tuple, df.select("x", "y", "z", csv_folder.MALFORMED).collect()), key=repr) == sorted(want, key=repr)
