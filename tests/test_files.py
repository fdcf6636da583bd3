from __future__ import annotations

import pytest

from aqarlens.sources.files import inferred_schema, read_checked, read_listings, write_table

ROWS = [(1, 'say "hi", twice'), (2, "back\\slash"), (3, " spaced "), (4, None)]
BROKEN = [(5, "two\nlines"), (6, "carriage\rreturn")]


def test_quotes_and_backslashes_come_back(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id int, note string")
    write_table(df, str(tmp_path / "t"))
    back = read_listings(spark, str(tmp_path / "t"), schema=df.schema)
    assert sorted(map(tuple, back.collect())) == ROWS
    inferred = read_listings(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, inferred.collect())) == ROWS


def test_line_breaks_need_multi_line(spark, tmp_path):
    df = spark.createDataFrame(ROWS + BROKEN[:1], "id int, note string")
    write_table(df, str(tmp_path / "t"), multi_line=True)
    back = read_listings(spark, str(tmp_path / "t"), schema=df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == ROWS + BROKEN[:1]
    for row in BROKEN:
        with pytest.raises(Exception, match="line break"):
            write_table(spark.createDataFrame([row], "id int, note string"), str(tmp_path / "refused"))


LINES = ["id,price,note,on", "1,2.5,a,2024-01-31", "2,,b,", "3,7,\"c, d\",2024-02-01", "4,cheap,e,2024-02-02", "5,1", "6,8.25,f,2024-02-03,more", "x7,1,g,soon", "8,9,,2024-02-05"]


def _written(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_checked_read_tells_good_from_bad(spark, tmp_path):
    read = read_checked(spark, _written(spark, str(tmp_path / "t"), LINES), share=0.7)
    assert [f.dataType.simpleString() for f in read.schema.fields] == ["bigint", "double", "string", "date"]
    assert sorted((r.id, r.price, r.note, str(r.on)) for r in read.good.collect()) == [
        (1, 2.5, "a", "2024-01-31"), (2, None, "b", "None"), (3, 7.0, "c, d", "2024-02-01"), (8, 9.0, None, "2024-02-05"),
    ]
    assert sorted(map(tuple, read.bad.collect())) == [
        ("4,cheap,e,2024-02-02", "price"), ("5,1", "fields"), ("6,8.25,f,2024-02-03,more", "fields"), ("x7,1,g,soon", "id,on"),
    ]
    # Neither count nor a narrow projection changes which records are bad.
    assert read.good.select("id").count() == 4 and read.bad.select("reason").count() == 4


def test_checked_read_with_a_schema_and_without_a_header(spark, tmp_path):
    path = _written(spark, str(tmp_path / "t"), ["1,2", "a,3", "4"])
    schema = spark.createDataFrame([], "k int, v string").schema
    read = read_checked(spark, path, schema, columns=("k", "v"))
    assert [tuple(r) for r in read.good.collect()] == [(1, "2")]
    assert sorted(map(tuple, read.bad.collect())) == [("4", "fields"), ("a,3", "k")]


def test_inferred_types(spark):
    frame = spark.createDataFrame([("true", "1", "1.5", "x", None, "2024-01-01 10:00:00"), ("false", " 2", "3", "4", None, "2024-01-02 11:30:00")], "a string, b string, c string, d string, e string, f string")
    assert [f.dataType.simpleString() for f in inferred_schema(frame).fields] == ["boolean", "bigint", "double", "string", "string", "timestamp"]
    assert {f.dataType.simpleString() for f in inferred_schema(frame.limit(0)).fields} == {"string"}
