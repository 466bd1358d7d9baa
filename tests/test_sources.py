"""Files in and out."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordbridge.sources import readers, schemas, writers


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sp_client.csv").write_text('client_id,active,note\n1,TRUE,"two\nlines, ""quoted"""\n2,FALSE,\n')
    (tmp_path / "Funder.csv").write_text("FunderID,Amount,Start,Made,Open\n12345678901,1.5,2020-01-02,2020-01-02 03:04:05,true\n7,x,bad,,\n")
    (tmp_path / "readme.txt").write_text("no table")
    return str(tmp_path)


def test_dump_folder_becomes_tables(spark, folder):
    schema = T.StructType.fromDDL("client_id long, active boolean, note string")
    tables = readers.read_dump_dir(spark, folder, {"sp_client": schema}, unbroken=["Funder"])
    assert sorted(tables) == ["Funder", "sp_client"]
    assert [tuple(r) for r in spark.table("sp_client").orderBy("client_id").collect()] == [(1, True, 'two\nlines, "quoted"'), (2, False, None)]
    assert {f.dataType for f in tables["Funder"].schema} == {T.StringType()}


def test_type_letters(spark, folder):
    df = readers.read_typed_csv(spark, folder + "/Funder.csv", "nnDTl", line_breaks=False)
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "date", "timestamp", "boolean"]
    first, second = df.orderBy(F.desc("FunderID")).collect()
    assert tuple(first)[:3] == (12345678901, 1.5, dt.date(2020, 1, 2)) and first["Open"] is True
    assert tuple(second) == (7, None, None, None, None)
    with pytest.raises(ValueError):
        schemas.schema_of(["a"], "nn")
    assert schemas.client_letters(["c"] * 36) == schemas.EXTRACT_TYPES["Client"]


@pytest.mark.parametrize("line_breaks", [True, False])
def test_no_value_is_lost_in_silence(spark, tmp_path, line_breaks):
    text = 'id,amount,day,note\n1,2.5,2020-01-02,fine\n2,x,soon,"quoted, with comma"\n3,,,\n4,1\n5,1,2020-01-01,a,b\nsix,1,2020-01-01,\n'
    (tmp_path / "t.csv").write_text(text + ('7,y,2020-01-01,"two\nlines"\n' if line_breaks else ""))
    table, rejects = readers.read_checked_csv(spark, str(tmp_path / "t.csv"), "inDc", line_breaks=line_breaks)
    got = sorted((tuple(r)[1:] for r in rejects.collect()), key=repr)
    want = [
        ("2,x,soon,\"quoted, with comma\"", "amount", "x", "double"), ("2,x,soon,\"quoted, with comma\"", "day", "soon", "date"),
        ("4,1", None, None, "4 cells"), ("5,1,2020-01-01,a,b", None, None, "4 cells"), ("six,1,2020-01-01,", "id", "six", "int"),
    ]
    assert got == sorted(want + ([('7,y,2020-01-01,"two\nlines"', "amount", "y", "double")] if line_breaks else []), key=repr)
    assert {r.file.rsplit("/")[-1] for r in rejects.collect()} == {"t.csv"}
    plain = readers.read_typed_csv(spark, str(tmp_path / "t.csv"), "inDc", line_breaks=line_breaks)
    assert sorted(map(tuple, table.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert table.where("id = 2").head()["note"] == "quoted, with comma"
    clean, none = readers.read_checked_csv(spark, str(tmp_path / "t.csv"), "cccc", line_breaks=line_breaks)
    assert none.count() == 2 and {r.expected for r in none.collect()} == {"4 cells"}


def test_sheet_export(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,day\n1,44000\n2,\n")
    out = readers.read_sheet_export(spark, str(tmp_path / "s.csv"), T.StructType.fromDDL("id int, day int"), ["day"])
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, dt.date(2020, 6, 18)), (2, None)]


def test_import_file_format(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, True, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5), 'a "b", c', None), (2, None, None, None, "plain", "")],
        "id int, ok boolean, d date, t timestamp, s string, n string",
    )
    writers.write_import_csv(df.coalesce(1), str(tmp_path / "out"))
    (file,) = glob.glob(str(tmp_path / "out" / "part-*.csv"))
    assert open(file).read() == 'id,ok,d,t,s,n\n1,1,2020-01-02,2020-01-02 03:04:05,"a ""b"", c",\n2,,,,plain,\n'


def test_unquote_rewrite(spark, folder, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("unquoted"))
    writers.unquote_rewrite(spark, folder, target, ["Funder"])
    (file,) = glob.glob(target + "/Funder.csv/part-*.csv")
    assert open(file).read().startswith("FunderID,Amount,Start,Made,Open\n12345678901,1.5,2020-01-02,")
    with pytest.raises(ValueError):
        writers.unquote_rewrite(spark, folder, folder + "/")


def test_literal_table_is_known_to_be_small(spark):
    df = readers.literal_table(spark, [(1, "a"), (None, "b")], "k long, v string")
    assert [tuple(r) for r in df.collect()] == [(1, "a"), (None, "b")]
    joined = spark.range(1000).join(df, F.col("id") == F.col("k"))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_import_set_is_the_same_each_time(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.concat(F.lit('a "b", '), F.col("id").cast("string")).alias("text"), (F.col("id") % 2 == 0).alias("even"), F.lit(None).cast("string").alias("none"))
    one = writers.write_import_set(df, str(tmp_path / "one"), "T", ["k"], 300)
    writers.write_import_set(df.orderBy(F.rand(3)).repartition(9), str(tmp_path / "two"), "T", ["k"], 300)
    names = sorted(p.name for p in (tmp_path / "one").glob("[!.]*"))
    assert names == ["T-00001.csv", "T-00002.csv", "T-00003.csv", "T-00004.csv", "manifest.csv"]
    for n in names:
        assert (tmp_path / "one" / n).read_bytes() == (tmp_path / "two" / n).read_bytes()
    assert [r.rows for r in one.orderBy("file").collect()] == [300, 300, 300, 100] and writers.broken_files(spark, str(tmp_path / "one")).count() == 0
    back = readers.read_text_csv(spark, str(tmp_path / "one" / "T-0*.csv"))
    assert back.count() == 1000 and back.where("even = 1").count() == 500
    assert (tmp_path / "one" / "T-00001.csv").read_text().startswith('k,text,even,none\n0,"a ""b"", 0",1,\n')
    with pytest.raises(ValueError, match="exists"):
        writers.write_import_set(df, str(tmp_path / "one"), "T", ["k"], 300)
    with open(tmp_path / "two" / "T-00002.csv", "a") as file:
        file.write("more\n")
    (tmp_path / "two" / ".T-00002.csv.crc").unlink(missing_ok=True)
    (tmp_path / "two" / "T-00004.csv").unlink()
    assert sorted(map(tuple, writers.broken_files(spark, str(tmp_path / "two")).collect())) == [("T-00002.csv", "changed"), ("T-00004.csv", "missing")]
    assert writers.write_import_set(df.where("false"), str(tmp_path / "none"), "T", ["k"]).count() == 0
    assert not list(tmp_path.glob("*.making-*"))
