"""Full refresh without a gap: every load writes a folder of its own, and a
numbered pointer file makes it the table.

    <table>/load-<id>/...            the files of one load
    <table>/_versions/00000007       names the folder of version 7

A pointer is put in place whole and by one writer only, after its load has
ended. Readers take the highest one, so they see the old version until the new
one is complete; a load that fails leaves a folder that nothing points to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from lakeloom import hadoop

KEEP = 2  # versions kept: the current one and the one that readers may still hold


def versions(spark: SparkSession, location: str) -> list[int]:
    return sorted(int(n) for n in hadoop.names(spark, f"{location}/_versions") if n.isdigit())


def current_folder(spark: SparkSession, location: str, version: int | None = None) -> str | None:
    """Folder of a version, the latest by default; None if there is none."""
    known = versions(spark, location)
    if version is None:
        if not known:
            return None
        version = known[-1]
    elif version not in known:
        return None
    return f"{location}/{hadoop.read_text(spark, f'{location}/_versions/{version:08d}')}"


def publish(writer: DataFrameWriter, spark: SparkSession, location: str, *, only_first: bool = False,
            keep: int = KEEP) -> int | None:
    """Write a load and make it the next version; its number.

    With ``only_first`` it becomes version 1 or nothing: None if another load
    was there first. Of concurrent refreshes the last to end is the current
    one. Versions before the last ``keep`` are removed.
    """
    location = location.rstrip("/")
    name = f"load-{uuid.uuid4().hex}"
    try:
        writer.save(f"{location}/{name}")
        while True:
            known = versions(spark, location)
            if only_first and known:
                hadoop.delete(spark, f"{location}/{name}")
                return None
            number = (known[-1] if known else 0) + 1
            if hadoop.claim(spark, f"{location}/_versions/{number:08d}", name):
                break
    except BaseException:
        hadoop.delete(spark, f"{location}/{name}")
        raise
    for old in known[:max(0, len(known) + 1 - keep)]:
        folder = current_folder(spark, location, old)
        # the pointer first: nobody finds a folder that is going
        hadoop.delete(spark, f"{location}/_versions/{old:08d}")
        if folder:
            hadoop.delete(spark, folder)
    return number


def folder_to_read(spark: SparkSession, location: str, version: int | None = None) -> str:
    found = current_folder(spark, location.rstrip("/"), version)
    if found is None:
        raise FileNotFoundError(f"no version of {location}" + (f" numbered {version}" if version else ""))
    return found


def read_version(spark: SparkSession, location: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The table as of a version, the latest by default. The version is fixed
    when this is called, whatever is published afterwards."""
    return spark.read.format(fmt).load(folder_to_read(spark, location, version))
