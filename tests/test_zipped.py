"""The zipped CSV source: entries, byte-order marks, duplicate headers, quoting, bad cells."""

import zipfile

import pytest

from subscope.sources import zipped

SCHEMA = "i long, s string, v double"


def test_round_trip(spark, tmp_path):
    rows = [(1, 'a, "b"', 2.5), (2, None, None), (3, "", 1.0), (4, "x\ny", 3.0), (None, "é", 1.5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for folder in (str(tmp_path / "a"), f"file://{tmp_path}/b"):
        paths = zipped.write_zipped_csv(df, folder)
        key = lambda r: (r[0] is None, r[0])
        for given in (paths, [folder]):
            got = zipped.read_zipped_csv(spark, *given, schema=SCHEMA)
            assert sorted(map(tuple, got.collect()), key=key) == sorted(rows, key=key)
    assert zipped.write_zipped_csv(df.limit(0), str(tmp_path / "c")) == []


def test_entries_marks_headers_and_bad_cells(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("one.csv", "﻿id,id,id\r\n1,a,0.5\r\n2,\"b \"\"c\"\"\",oops\r\n".encode())
        z.writestr("deep/two.CSV", "id,id,id\n3,,1\nbad,\"\",2\n" + "".join(f"{k},t,{k}.5\n" for k in range(10, 5010)))
        z.writestr("readme.md", "not,a,table\n")
        z.writestr("empty.csv", "")
        z.writestr("header.csv", "id,id,id\n")
    df = zipped.read_zipped_csv(spark, str(tmp_path / "x.zip"), schema=SCHEMA)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 5004
    got = {r["v"]: (r["i"], r["s"]) for r in df.where("i is null or i < 10").collect()}
    assert got == {0.5: (1, "a"), None: (2, 'b "c"'), 1.0: (3, None), 2.0: (None, "")}
    bare = zipped.read_zipped_csv(spark, str(tmp_path / "x.zip"), schema=SCHEMA, header=False)
    assert bare.count() == 5007
    with pytest.raises(Exception, match="nowhere"):
        zipped.read_zipped_csv(spark, str(tmp_path / "nowhere.zip"), schema=SCHEMA).count()
    (tmp_path / "none").mkdir()
    assert zipped.read_zipped_csv(spark, str(tmp_path / "none"), schema=SCHEMA).count() == 0
