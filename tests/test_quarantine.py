"""Folders with bad files: set aside whole, the rest loaded, and a report."""

import bz2
import gzip
import os

import pytest

from lakeloom.sources.fixed_width import FixedField
from lakeloom.sources.quarantine import load_fixed_width_folder

LAYOUT = (FixedField(0, 3, "a", "int"), FixedField(3, 4, "b", "string"))


def put(folder, name, data):
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(data)


def load(spark, folder, encoding="UTF-8", **kw):
    got = load_fixed_width_folder(spark, folder, LAYOUT, encoding, **kw)
    return (sorted(tuple(r) for r in got.rows.collect()),
            {r.file_name: (r.status, r.lines, r.kept, r.rejected, r.blank, r.reason) for r in got.report.collect()})


def test_outcomes_of_a_folder(spark, tmp):
    body = b"  1abc\n  2d\xc3\xa9f\n"
    put(tmp, "good.cnv", body)
    put(tmp, "no_end.CNV", b"  3x")
    put(tmp, "crlf.cnv", b"  4x\r\n  5y\r\n")
    put(tmp, "cr.cnv", b"  6x\r  7y\r")
    put(tmp, "rejects.cnv", b"xxxq\n  8r\n       \n")
    put(tmp, "empty.cnv", b"")
    put(tmp, "bytes.cnv", b" 10ok\n 11\xff\xfe\n 12ok\n")
    put(tmp, "good.cnv.gz", gzip.compress(b" 20g\n") + gzip.compress(b" 21h\n"))
    put(tmp, "cut.cnv.gz", gzip.compress(b" 30g\n" * 5000)[:-9])
    put(tmp, "other.cnv.gz", b"no gzip at all\n")
    put(tmp, "good.cnv.bz2", bz2.compress(b" 22i\n"))
    put(tmp, "cut.cnv.bz2", bz2.compress(b" 40g\n" * 5000)[:-5])
    put(tmp, "ignored.txt", b" 50g\n")
    rows, report = load(spark, tmp)
    assert rows == [(1, "abc", "good.cnv"), (2, "déf", "good.cnv"), (3, "x", "no_end.CNV"), (4, "x", "crlf.cnv"),
                    (5, "y", "crlf.cnv"), (6, "x", "cr.cnv"), (7, "y", "cr.cnv"), (8, "r", "rejects.cnv"),
                    (20, "g", "good.cnv.gz"), (21, "h", "good.cnv.gz"), (22, "i", "good.cnv.bz2")]
    assert report["good.cnv"] == ("read", 2, 2, 0, 0, None)
    assert report["rejects.cnv"] == ("rejected", 3, 1, 1, 1, None)
    assert "empty.cnv" not in report
    assert report["bytes.cnv"] == ("failed", 0, 0, 0, 0, "1 lines are not UTF-8")
    assert {n for n, r in report.items() if r[0] == "failed"} == {"bytes.cnv", "cut.cnv.gz", "other.cnv.gz", "cut.cnv.bz2"}
    assert "unpacked" in report["cut.cnv.gz"][5] and "unpacked" in report["other.cnv.gz"][5]
    assert "ignored.txt" not in report


def test_any_byte_is_latin1(spark, tmp):
    put(tmp, "a.cnv", b"  1\xe7\xe3o\n")
    rows, report = load(spark, tmp, "ISO-8859-1")
    assert rows == [(1, "ção", "a.cnv")] and report["a.cnv"][0] == "read"
    assert load(spark, tmp, "US-ASCII")[1]["a.cnv"][0] == "failed"
    with pytest.raises(ValueError):
        load(spark, tmp, "UTF-16")


def test_a_file_of_many_splits(spark, tmp):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    put(tmp, "big.cnv", b"".join(b"%3dabcd\r\n" % (i % 900) for i in range(5000)))
    put(tmp, "bad.cnv", b"  1ab\n" * 3000 + b"  2\xff\n" + b"  1ab\n" * 3000)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
        rows, report = load(spark, tmp)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 5000 and report["big.cnv"][:3] == ("read", 5000, 5000)
    assert report["bad.cnv"][0] == "failed"
