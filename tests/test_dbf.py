"""DBF data source (A6): header, types, deleted records, ranges, folders."""

import datetime as dt
import os

from lakeloom.sources.dbf import dbf_fields, encode_dbf, read_dbf

FIELDS = dbf_fields([("ip_cod", "C", 10, 0), ("ip_name", "C", 20, 0), ("qty", "N", 6, 0),
                     ("price", "N", 10, 2), ("rate", "F", 8, 3), ("since", "D", 8, 0),
                     ("active", "L", 1, 0)])

ROWS = [
    ("0301010072", "Consulta médica", 12, 10.5, 0.125, dt.date(2020, 1, 31), True),
    ("0301010080", "Deleted row", 1, 1.0, 1.0, dt.date(2020, 2, 1), False),
    ("0401010015", None, None, None, None, None, None),
    ("0501010016", "Ação", -7, -3.25, 2.5, dt.date(1999, 12, 1), False),
]


def write(path, rows, deleted=None):
    with open(path, "wb") as fh:
        fh.write(encode_dbf(rows, FIELDS, deleted=deleted))


def test_types_deleted_and_blanks(spark, tmp):
    write(os.path.join(tmp, "TB_SIGTAP.DBF"), ROWS, deleted=[False, True, False, False])
    df = read_dbf(spark, tmp)
    assert df.dtypes == [("ip_cod", "string"), ("ip_name", "string"), ("qty", "bigint"),
                         ("price", "double"), ("rate", "double"), ("since", "date"),
                         ("active", "boolean")]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [
        ("0301010072", "Consulta médica", 12, 10.5, 0.125, dt.date(2020, 1, 31), True),
        ("0401010015", "", None, None, None, None, None),
        ("0501010016", "Ação", -7, -3.25, 2.5, dt.date(1999, 12, 1), False),
    ]


def test_record_ranges_and_folder(spark, tmp):
    many = [(f"{i:010d}", f"name {i}", i, i / 4, None, None, i % 2 == 0) for i in range(1000)]
    write(os.path.join(tmp, "a.dbf"), many[:600])
    write(os.path.join(tmp, "b.DBF"), many[600:])
    df = read_dbf(spark, tmp, partition_bytes=2000, file_name_column="arquivo_origem")
    assert df.rdd.getNumPartitions() > 10
    got = sorted((r.ip_cod, r.qty, r.price, r.active, r.arquivo_origem) for r in df.collect())
    want = sorted((r[0], r[2], r[3], r[6], "a.dbf" if i < 600 else "b.DBF") for i, r in enumerate(many))
    assert got == want


def test_schema_merges_all_headers(spark, tmp):
    specs = {"a.dbf": ([("id", "N", 4, 0), ("qty", "N", 4, 0), ("big", "N", 18, 0), ("code", "N", 5, 0)],
                       [(1, 3, 123456789012345678, 7), (2, None, None, None)]),
             "b.dbf": ([("id", "N", 9, 0), ("qty", "N", 8, 1), ("big", "N", 8, 1), ("code", "C", 5, 0),
                        ("extra", "C", 4, 0)], [(300000000, 2.5, 0.5, "x7", "new")])}
    for name, (spec, rows) in specs.items():
        with open(os.path.join(tmp, name), "wb") as fh:
            fh.write(encode_dbf(rows, dbf_fields(spec)))
    df = read_dbf(spark, tmp)
    assert df.dtypes == [("id", "bigint"), ("qty", "double"), ("big", "string"), ("code", "string"),
                         ("extra", "string")]
    assert sorted(map(tuple, df.collect())) == [
        (1, 3.0, "123456789012345678", "7", None), (2, None, None, None, None),
        (300000000, 2.5, "0.5", "x7", "new")]


def test_binary_types_and_code_page(spark, tmp):
    from decimal import Decimal

    spec = [("a", "I", 4, 0), ("b", "B", 8, 0), ("y", "Y", 8, 4), ("t", "T", 8, 0), ("wide", "N", 20, 0),
            ("money", "N", 20, 2), ("c", "C", 6, 0)]
    rows = [(-5, 2.5, -1234.5678, dt.datetime(2023, 2, 3, 4, 5, 6, 789000), 12345678901234567891, 123456789012345.67, "çã"),
            (7, -1e300, Decimal("922337203685477"), dt.datetime(1969, 12, 31, 23, 59, 59), -1, None, "x"),
            (None,) * 7]
    with open(os.path.join(tmp, "a b%41.dbf"), "wb") as fh:
        fh.write(encode_dbf(rows, dbf_fields(spec), encoding="cp850", code_page=0x02))
    df = read_dbf(spark, tmp, file_name_column="src")
    assert [t for _, t in df.dtypes] == ["int", "double", "decimal(19,4)", "timestamp_ntz", "decimal(20,0)", "decimal(19,2)",
                                         "string", "string"]
    got = {r.a: r for r in df.collect()}
    assert (got[-5].b, got[-5].y, got[-5].t) == (2.5, Decimal("-1234.5678"), dt.datetime(2023, 2, 3, 4, 5, 6, 789000))
    assert (got[-5].wide, got[-5].c, got[-5].src) == (12345678901234567891, "çã", "a b%41.dbf")
    assert got[7].t == dt.datetime(1969, 12, 31, 23, 59, 59) and got[7].y == Decimal("922337203685477.0000")
    assert got[0].wide is None and got[0].t is None
    assert read_dbf(spark, tmp, encoding="cp1252").where("a = -5").first().c != "çã"


def test_memo_files_of_all_kinds(spark, tmp):
    import random

    from lakeloom.sources import dbf as D

    rng = random.Random(4)
    texts = [None if k % 5 == 0 else ("memo %d ção\r\n" % k * rng.randrange(1, 60)).encode("latin-1") for k in range(400)]
    texts[7] = b"x" * 300_000
    for kind, ext, version, width in (("fpt", "FPT", 0x30, 4), ("dbt4", "dbt", 0x8B, 10), ("dbt3", "DBT", 0x83, 10)):
        folder = os.path.join(tmp, kind)
        os.makedirs(folder)
        memo, at = D.encode_memos(texts, kind)
        rows = [(k, n or None) for k, n in enumerate(at)]
        with open(os.path.join(folder, "T.DBF"), "wb") as fh:
            fh.write(encode_dbf(rows, dbf_fields([("k", "N", 6, 0), ("note", "M", width, 0)]), version=version))
        with open(os.path.join(folder, "T." + ext), "wb") as fh:
            fh.write(memo)
        df = read_dbf(spark, folder, partition_bytes=500)
        assert df.rdd.getNumPartitions() > 5
        assert {r.k: r.note for r in df.collect()} == {k: t.decode("latin-1") if t else None for k, t in enumerate(texts)}
        assert spark.read.format("dbf").load(folder).where("note IS NOT NULL").count() == 320
    import pytest
    with open(os.path.join(tmp, "fpt", "T.FPT"), "r+b") as fh:
        fh.truncate(5000)
    with pytest.raises(Exception, match="ends before memo block"):
        read_dbf(spark, os.path.join(tmp, "fpt")).collect()
    os.remove(os.path.join(tmp, "fpt", "T.FPT"))
    with pytest.raises(Exception, match="no .dbt or .fpt"):
        read_dbf(spark, os.path.join(tmp, "fpt")).collect()


def test_layouts_merge_in_tasks_and_folders_nest(spark, tmp):
    import pytest

    from lakeloom.sources.dbf import _wider

    os.makedirs(os.path.join(tmp, "x", "y"))
    for path, spec, rows in (("x/a.dbf", [("k", "N", 5, 0), ("v", "N", 25, 0)], [(1, 10 ** 24)]),
                             ("x/y/b.DBF", [("v", "N", 8, 0), ("w", "C", 3, 0)], [(3, "q"), (4, None)]),
                             ("c.dbf", [("k", "N", 5, 0), ("v", "N", 25, 0)], [(2, 5)]),
                             ("none.dbf", [("k", "N", 5, 0)], [])):
        with open(os.path.join(tmp, path), "wb") as fh:
            fh.write(encode_dbf(rows, dbf_fields(spec)))
    df = read_dbf(spark, tmp, recursive=True)
    assert dict(df.dtypes) == {"k": "bigint", "v": "decimal(25,0)", "w": "string"}
    assert {(r.k, int(r.v), r.w) for r in df.collect()} == {(1, 10 ** 24, None), (2, 5, None), (None, 3, "q"), (None, 4, "")}
    assert read_dbf(spark, tmp).count() == 1
    assert read_dbf(spark, os.path.join(tmp, "c.dbf")).first().k == 2
    assert _wider("decimal(20,0)", "decimal(19,4)", True) == "decimal(24,4)"
    assert _wider("decimal(38,0)", "decimal(19,4)", True) == "string" and _wider("double", "decimal(20,0)", True) == "string"
    with open(os.path.join(tmp, "odd.dbf"), "wb") as fh:
        fh.write(encode_dbf([], dbf_fields([("k", "Q", 5, 0)])))
    with pytest.raises(ValueError, match="not supported"):
        read_dbf(spark, tmp)
