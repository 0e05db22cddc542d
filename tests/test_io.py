import datetime as dt

import pytest
from pyspark.sql import types as T

from kestrel.sinks import export as ex
from kestrel.sources.delimited import delimited_scan
from kestrel.sources.workbook import read_sheet, workbook_bytes, workbook_scan, workbook_write


def test_cp932_tsv(spark, tmp_path):
    p = tmp_path / "in.tsv"
    p.write_bytes("INDEX\tPARTS_NAME\tCYCLE\n79\tソフト\\フィルタ\t591808.0\n80\t表示\t\n".encode("cp932"))
    schema = "INDEX bigint, PARTS_NAME string, CYCLE double"
    got = [tuple(r) for r in delimited_scan(spark, str(p), schema, encoding="cp932").collect()]
    assert got == [(79, "ソフト\\フィルタ", 591808.0), (80, "表示", None)]


def test_csv_lines_quote_non_numeric(spark):
    df = spark.createDataFrame([('a"b', 1, 1.5, None, dt.datetime(2022, 6, 9))],
                               "s string, i int, f double, n string, t timestamp")
    assert ex.csv_lines(df).first().value == '"a""b",1,1.5,"","2022-06-09 00:00:00"'


def test_csv_numbers_in_script_form(spark):
    values = [12345678.9, 1e-05, 1.0, -0.0, 0.1, 1e16, 1.5e16, 123456789012345.6, 9999999999999998.0, 0.0001, 0.00012345, 1.23e-10,
              1.7976931348623157e308, 100.0, -2.5e-05, 3.0e7, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.value for r in ex.csv_lines(df).collect()] == [repr(v) for v in values]
    assert ex.csv_lines(spark.createDataFrame([(0.1,)], "v float")).first().value == "0.1"


def test_malformed_rows_fail(spark, tmp_path):
    from py4j.protocol import Py4JError
    from pyspark.errors import PySparkException
    from kestrel.sources.delimited import STAGING_SCHEMA
    good = ["79", "S", "P", "フィルタ", "21", "2022/06/09", "H", "D", "K25", "1", "故障交換", "UM", "26996896", "failure", "2022/06/09 00:00:00",
            "", "591808.0", "K", "2022/06/09", "2022/06/09 00:00:00"]
    head = "\t".join(f.name for f in STAGING_SCHEMA)
    p = tmp_path / "staging.tsv"
    p.write_bytes((head + "\n" + "\t".join(good) + "\n").encode("cp932"))
    r = delimited_scan(spark, str(p), STAGING_SCHEMA).first()
    assert len(STAGING_SCHEMA) == 20 and r.PARTS_NAME == "フィルタ" and r.METER_TOTAL_DIFF is None and r.CYCLE == 591808.0
    for bad in (good[:-3], ["x"] + good[1:]):
        q = tmp_path / f"bad{len(bad)}.tsv"
        q.write_bytes((head + "\n" + "\t".join(bad) + "\n").encode("cp932"))
        with pytest.raises((PySparkException, Py4JError), match="(?i)malformed"):
            delimited_scan(spark, str(q), STAGING_SCHEMA).collect()


def test_workbook_roundtrip(spark, tmp_path):
    data = workbook_bytes(["ID", "NOTE", "V"], [("1", "a<b&c", 1.25), ("2", None, 7)])
    assert read_sheet(data) == [["ID", "NOTE", "V"], ["1", "a<b&c", "1.25"], ["2", None, "7"]]
    with pytest.raises(ValueError):
        read_sheet(data, "Nope")
    df = spark.createDataFrame([(i, f"n{i}", i / 4) for i in range(50)], "ID bigint, NOTE string, V double")
    out = str(tmp_path / "books")
    workbook_write(df.repartition(3), out, row_cap=7)
    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("V", T.DoubleType())])
    back = sorted(tuple(r) for r in workbook_scan(spark, out, schema).collect())
    assert back == [(i, i / 4) for i in range(50)]


def test_workbook_dates_escapes_and_sheets(spark, tmp_path):
    import zipfile
    from kestrel.sources.workbook import report_workbook, workbook_sheets
    at = dt.datetime(2023, 1, 23, 4, 5, 6)
    data = workbook_sheets([("a", ["t", "s"], [(at, "bell\x07 _x0041_ \r")], 0, 0), ('b "&"', ["d"], [(dt.date(1999, 12, 31),)], 3, 2)])
    assert read_sheet(data, "a") == [["t", "s"], ["2023/01/23 04:05:06", "bell\x07 _x0041_ \r"]]
    assert read_sheet(data, 'b "&"') == [[None, None, "d"], [None, None, "1999/12/31 00:00:00"]]
    # as other programs write it: a built-in date format, the 1904 system
    src, out = zipfile.ZipFile(__import__("io").BytesIO(data)), tmp_path / "book.xlsx"
    with zipfile.ZipFile(out, "w") as z:
        for n in src.namelist():
            x = src.read(n).decode()
            x = x.replace("<sheets>", '<workbookPr date1904="1"/><sheets>').replace('<xf numFmtId="164"', '<xf numFmtId="14"')
            z.writestr(n, x)
    assert read_sheet(out.read_bytes(), "a")[1][0] == "2027/01/24 04:05:06"  # the same day number, four years and a day on
    schema = T.StructType([T.StructField("t", T.TimestampType()), T.StructField("s", T.StringType())])
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / "x.xlsx").write_bytes(data)
    assert workbook_scan(spark, str(tmp_path / "own"), schema, "a").first().t == at
    df = spark.createDataFrame([(1, 1.25, "00000123", at)], "i int, f double, s string, t timestamp")
    report_workbook({"df1": df, "df2": (df, 2, 2)}, str(tmp_path / "rep"), "r.xlsx")
    back = (tmp_path / "rep" / "r.xlsx").read_bytes()
    assert read_sheet(back, "df1")[1] == ["1", "1.25", "00000123", "2023/01/23 04:05:06"]
    assert read_sheet(back, "df2")[0] == [None, None, "i", "f", "s", "t"]


def test_workbook_writer_takes_uris_and_replaces(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    uri = "file://" + str(tmp_path / "w")
    workbook_write(df, uri)
    workbook_write(df.union(df), uri)
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    assert workbook_scan(spark, uri, schema).count() == 2
    workbook_write(df, uri, mode="append")
    assert workbook_scan(spark, uri, schema).count() == 3 and not list((tmp_path / "w").glob("*.tmp"))


def test_text_and_staging(spark, tmp_path):
    from kestrel.sources.text import text_document_scan
    df = spark.createDataFrame([("line one",), ("line two",)], "t string")
    ex.text_write(df.coalesce(1), "t", str(tmp_path / "txt"))
    docs = text_document_scan(spark, str(tmp_path / "txt")).collect()
    assert len(docs) == 1 and docs[0].page_content == "line one\nline two\n"
    assert docs[0].metadata["source"].endswith(".txt")
    ex.staging_overwrite(df, str(tmp_path / "stage"))
    ex.staging_overwrite(df.limit(1), str(tmp_path / "stage"))
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 1


def test_sequence_source(spark):
    from kestrel.sources.inline import sequence_source
    s = sequence_source(spark, 1000, seed=3, partitions=4)
    a = s.collect()
    assert len(a) == 1000 and abs(sum(r.y for r in a) / 1000 - 10) < 0.2
    assert a == sequence_source(spark, 1000, seed=3, partitions=4).collect()


def test_jdbc_reads_in_one_task_only_if_asked(spark):
    from kestrel.sources.jdbc import jdbc_query_scan
    for kw in ({}, {"sql": "select 1", "table": "t"}, {"sql": "select 1"}, {"table": "t", "partition_column": "k"}):
        with pytest.raises(ValueError):
            jdbc_query_scan(spark, "jdbc:none:", **kw)


def test_page_folder(spark, tmp_path):
    from kestrel.sources.text import page_scan
    (tmp_path / "a.html").write_text("<p>é</p>", encoding="utf-8")
    (tmp_path / "b.txt").write_text("no page")
    got = page_scan(spark, str(tmp_path), "files").collect()
    assert [(r.url.rpartition("/")[2], r.html) for r in got] == [("a.html", "<p>é</p>")]


def test_entry_frees_what_earlier_queries_kept(spark):
    import __spark_entry__ as e
    from kestrel import session
    from tests.conftest import SF001
    e.queries()["mean_median"](spark, SF001)
    kept = list(session._KEPT)
    e.queries()["row_count"](spark, SF001)
    assert kept and not session._KEPT and not any(df.storageLevel.useMemory for df in kept)
