import gzip
from xml.etree import ElementTree

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from panelweave.sources import annotated_csv as A, sinks, tables

GOOD = "# File: speeds.csv\n# Title: speeds\n# Units: mph for 'speed', ft for 'dist'\n# Source: a book\n# page 3\n# Column types: nn \n# ----------\nspeed,dist\n4.0,2.0\n7.0,NA\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_annotated_file(spark, tmp_path, rows):
    table = A.read_annotated(spark, write(tmp_path / "speeds.csv", GOOD))
    assert rows(table.df) == [(4.0, 2.0), (7.0, None)]
    assert table.metadata["title"] == "speeds" and table.metadata["reference"] == "a book\npage 3"


@pytest.mark.parametrize(
    "old,new,why",
    [
        ("types: nn", "types: nnn", "3 type letters for 2 columns"),
        ("File: speeds", "File: other", "header names"),
        ("# Title: speeds\n", "", "title missing"),
        ("# Units: mph for 'speed', ft for 'dist'", "# Units:", "units is empty"),
        ("# Title", '"# Title', "quoted comment"),
        ("# Title: speeds", "# Title: speeds,,", "trailing commas"),
        ("types: nn", "types: nz", "unknown type letters"),
    ],
)
def test_header_contract(spark, tmp_path, old, new, why):
    path = write(tmp_path / "speeds.csv", GOOD.replace(old, new))
    with pytest.raises(A.HeaderError, match=why):
        A.read_annotated(spark, path)


def test_bad_cell_fails_the_job(spark, tmp_path):
    path = write(tmp_path / "speeds.csv", GOOD.replace("4.0,2.0", "four,2.0"))
    with pytest.raises((PySparkException, Py4JJavaError), match="four"):
        A.read_annotated(spark, path).df.collect()


def test_skipped_columns_and_types(spark, tmp_path):
    path = write(tmp_path / "t.csv", GOOD.replace("speeds.csv", "t.csv").replace("types: nn", "types: i-").replace("4.0,2.0\n7.0,NA", "4,2\n7,NA"))
    df = A.read_annotated(spark, path).df
    assert df.columns == ["speed"] and df.schema["speed"].dataType == T.IntegerType()


def test_extension_probe_and_optional(spark, tmp_path):
    with gzip.open(tmp_path / "speeds.csv.gz", "wt") as f:
        f.write(GOOD)
    base = str(tmp_path / "speeds")
    assert A.find_table(spark, base) == base + ".csv.gz"
    schema = T.StructType([T.StructField("x", T.DoubleType())])
    out = A.read_many(spark, [base, base, str(tmp_path / "absent")], {str(tmp_path / "absent"): schema})
    assert len(out) == 2 and out[base].count() == 2 and out[str(tmp_path / "absent")].isEmpty()
    with pytest.raises(FileNotFoundError):
        A.find_table(spark, str(tmp_path / "absent"))


def test_quirky_file(spark, tmp_path, rows):
    path = write(tmp_path / "q.csv", "Population,,\nin thousands,,\nChad,,5.5\nMali,,7\nTotal West,,12.5\n")
    schema = T.StructType([T.StructField("c", T.StringType()), T.StructField("b", T.StringType()), T.StructField("v", T.DoubleType())])
    out = A.read_quirky(spark, path, schema, skip="^(Population|in thousands)", keep=~F.col("c").startswith("Total"))
    assert rows(out, "c", "v") == [("Chad", 5.5), ("Mali", 7.0)]


def test_fallback(frame, rows):
    a, b = frame([], "x int"), frame([(1,)], "x int")
    assert rows(tables.with_fallback(a, b)) == [(1,)] and rows(tables.with_fallback(frame([(2,)], "x int"), b)) == [(2,)]


def test_annotations(spark):
    notes = tables.Annotations().add("t", "title", "old").add("t", "title", "new").add("t", "comments", "a").add("t", "comments", "b")
    notes.add("t", "precursors", "raw").same("u", "t", ["title"])
    row = notes.data_map(spark).where(F.col("table") == "t").first()
    assert (row.title, row.comments, row.precursors) == ("new", "a; b", "raw")
    assert notes.get("u", "title") == ["new"] and notes.get("u", "comments") == []
    assert [tuple(r) for r in notes.edges(spark).collect()] == [("raw", "t")]
    with pytest.raises(KeyError):
        notes.add("t", "colour", "red")


def test_units_in_column_metadata(frame):
    df = tables.with_units(frame([(1.0,)], "v double"), {"v": "EJ"})
    assert df.schema["v"].metadata == {"units": "EJ"}


def test_document_round_trip(spark, frame, tmp_path):
    df = frame([("r", "a", 1, 2.0), ("r", "a", 2, 3.0), ("r", "b", 1, 4.0)], "region string, sector string, year int, value double")
    nested = sinks.nest_levels(df, [["region"], ["sector"], ["year"]], ["sectors", "points"])
    assert nested.count() == 1 and nested.select(F.size("sectors")).first()[0] == 2
    paths = sinks.write_document({"area": nested}, str(tmp_path), suffix="_hi")
    assert paths["area"].endswith("area_hi")
    back = spark.read.format("xml").option("rowTag", "area").load(paths["area"])
    assert back.select(F.size("sectors")).first()[0] == 2


def test_suffix():
    assert sinks.with_suffix("a/b.xml", "_x") == "a/b_x.xml"
    assert sinks.with_suffix("a.d/b", "_x") == "a.d/b_x" and sinks.with_suffix("a/b.xml", None) == "a/b.xml"


def test_type_split_defaults(frame):
    df = frame([(1, None), (2, "absolute-cost-logit")], "id int, logit_type string")
    parts = {n: d.count() for n, d in sinks.split_by_type(df).items()}
    assert parts == {"relative-cost-logit": 1, "absolute-cost-logit": 1, "all": 2}


def test_inputs_are_not_written_unless_asked(frame, tmp_path):
    made = {"a": frame([(1,)], "x int"), "b": frame([(1,)], "x int"), "c": frame([(1,)], "x int")}
    flags = {"b": ["input"], "c": ["no_output"]}
    assert set(sinks.write_tables(made, flags, str(tmp_path / "1"))) == {"a"}
    assert set(sinks.write_tables(made, flags, str(tmp_path / "2"), write_inputs=True)) == {"a", "b"}


def test_one_document_holds_several_tables(spark, frame, tmp_path):
    import xml.etree.ElementTree as tree

    many = frame([(i, f"n & <{i}>") for i in range(300)], "k int, name string")
    few = frame([(1.5, [(2001, 3.0)])], "v double, point array<struct<year: int, value: double>>")
    path = sinks.write_one_document({"many": many, "few": few}, str(tmp_path / "doc"), {"many": ["name", "k"]})
    files = sorted(f for f in (tmp_path / "doc").iterdir() if f.name.startswith("part-"))
    root = tree.fromstring("".join(f.read_text() for f in files))
    assert root.tag == "scenario" and [c.tag for c in root] == ["many"] * 300 + ["few"]
    assert {(c[0].text, c[1].text) for c in root[:300]} == {(f"n & <{i}>", str(i)) for i in range(300)}
    assert root[300].find("point/year").text == "2001"
    back = sinks.read_from_document(spark, path, "many", "name string, k int")
    assert sorted(map(tuple, back.collect())) == sorted((f"n & <{i}>", i) for i in range(300))


def parsed(path):
    text = "".join(f.read_text() for f in sorted(path.glob("part-*")))
    return ElementTree.fromstring(text)


def test_nested_document_of_odd_names(spark, tmp_path):
    data = [("b", 1, "x"), ("a", 2, "<&> \"q\"\nz"), ("a", 2, "y"), ("a", None, "n"), (None, 1, "w"), ('<"&>', 7, None), ("b", 1, "x")]
    df = spark.createDataFrame(data, "sector string, tech int, note string").repartition(3)
    path = sinks.write_nested_document(df, {"sector": "sector", "technology": "tech"}, "row", str(tmp_path / "d"), suffix="_low")
    root = parsed(tmp_path / "d_low")
    assert path.endswith("d_low") and root.tag == "scenario"
    assert [s.get("name") for s in root] == [None, '<"&>', "a", "b"]
    assert [t.get("name") for t in root[2]] == [None, "2"]
    back = [(s.get("name"), t.get("name"), r.findtext("note")) for s in root for t in s for r in t]
    want = [(a, None if b is None else str(b), c) for a, b, c in data]
    assert sorted(back, key=str) == sorted(want, key=str)
    sinks.write_nested_document(df.limit(0), {"sector": "sector"}, "row", str(tmp_path / "none"))
    assert len(parsed(tmp_path / "none")) == 0


def test_one_element_is_written_by_many_tasks(spark, tmp_path):
    n = 200_000
    df = spark.range(n).select(F.lit("all").alias("top"), F.lit(1).alias("inner"), (F.col("id") % 1000).alias("k"), "id")
    sinks.write_nested_document(df, {"top": "top", "inner": "inner"}, "row", str(tmp_path / "d"))
    parts = [len(f.read_text().splitlines()) for f in sorted((tmp_path / "d").glob("part-*"))]
    assert len([p for p in parts if p]) > 4 and max(parts) < n / 2
    rows = parsed(tmp_path / "d")[0][0]
    assert len(rows) == n and {int(r.findtext("id")) for r in rows} == set(range(n))
