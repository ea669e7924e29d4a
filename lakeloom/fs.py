"""Filesystem access for Python-side readers and writers (any URI pyarrow
knows: local, HDFS, object stores)."""

from __future__ import annotations

import pyarrow.fs as pafs


# --- fixed values: Hadoop's names of schemes that pyarrow calls otherwise ---
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "gcs": "gs"}


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a URI as Spark writes it."""
    scheme, sep, rest = uri.partition("://")
    if sep and scheme in SCHEMES:
        uri = f"{SCHEMES[scheme]}://{rest}"
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri.replace(" ", "%20"))


def exists(uri: str) -> bool:
    fs, p = resolve(uri)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def size(uri: str) -> int:
    fs, p = resolve(uri)
    return fs.get_file_info(p).size


def list_files(uri: str, suffixes: tuple[str, ...] = ()) -> list[str]:
    """Files directly under a folder (or the file itself), sorted by name;
    ``suffixes`` match case-insensitively. Returned paths keep the URI scheme
    of the input."""
    fs, p = resolve(uri)
    info = fs.get_file_info(p)
    prefix = uri[: len(uri) - len(p)] if uri.endswith(p) else ""
    if info.type == pafs.FileType.File:
        return [uri]
    if info.type != pafs.FileType.Directory:
        return []
    found = [f.path for f in fs.get_file_info(pafs.FileSelector(p, recursive=False))
             if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_"))]
    if suffixes:
        found = [f for f in found if f.lower().endswith(tuple(s.lower() for s in suffixes))]
    return [prefix + f for f in sorted(found)]
