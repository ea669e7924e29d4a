"""Driver-side file operations on any path that Spark itself can reach.

They go through Hadoop's file system, as Spark's readers and writers do, so a
probe sees what a scan would see. Only small, single steps are taken here:
probing, listing one folder, moving a finished folder into place.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return p.getFileSystem(conf), p, conf


def _local(spark: SparkSession, path: str) -> str | None:
    """The path on a local (or mounted) disk; None for other file systems."""
    fs, p, _ = _fs(spark, path)
    return p.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder? A fault of the file system is raised."""
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, p, _ = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def modified(spark: SparkSession, path: str) -> int:
    fs, p, _ = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, _ = _fs(spark, path)
    n = int(fs.getFileStatus(p).getLen())
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(n)).decode("utf-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file where none is: complete and by one caller only, or
    not at all. False if it is there already."""
    fs, p, _ = _fs(spark, path)
    fs.mkdirs(p.getParent())
    own = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    local = _local(spark, path)
    if local is not None:
        staged = _local(spark, own)
        with open(staged, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(staged, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(staged)
    _write_text(spark, own, text)
    try:
        return move_new(spark, own, path)
    finally:
        delete(spark, own)


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename to a place where nothing is; False if something is there. One
    atomic step on local disks and HDFS; a store whose rename copies is not a
    place for this."""
    a, z = _local(spark, source), _local(spark, target)
    if a is not None and z is not None:
        if os.path.isfile(a):
            try:
                os.link(a, z)
            except FileExistsError:
                return False
            os.unlink(a)
            return True
        try:
            os.rename(a, z)  # fails where the target holds anything
            return True
        except OSError:
            if os.path.exists(z):
                return False
            raise
    jvm = spark._jvm
    _, p, conf = _fs(spark, source)
    _, q, _ = _fs(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(p, q, none)
        return True
    except Exception as exc:  # noqa: BLE001 - told apart below
        if "FileAlreadyExists" in str(exc) or exists(spark, target):
            return False
        raise
