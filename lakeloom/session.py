"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "lakeloom",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the defaults above.

    On a cluster leave ``master`` unset so spark-submit decides. The shuffle
    partition count should be sized to the data (~128-256 MB per partition);
    AQE then coalesces small partitions at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_work_dir(spark)
    return spark


_PRIVATE_WORK: dict[str, str] = {}


def ensure_work_dir(spark: SparkSession) -> str:
    """Return the shared work folder.

    In order: ``spark.checkpoint.dir`` from the session (on a cluster this
    names a folder every executor can reach -- HDFS, object store), else
    the checkpoint folder already set on the context. Only when neither
    exists -- local tests -- a private temporary folder is created and
    registered as the context's checkpoint folder (the config itself cannot
    be changed once the session runs).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if configured:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if sc is not None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    key = sc.applicationId if sc is not None else "connect"
    if key not in _PRIVATE_WORK:
        _PRIVATE_WORK[key] = tempfile.mkdtemp(prefix="lakeloom-work-")
        if sc is not None:
            sc.setCheckpointDir(_PRIVATE_WORK[key])
    return _PRIVATE_WORK[key]


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the work folder for one run."""
    return f"{ensure_work_dir(spark)}/lakeloom/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``lakeloom`` importable in Python workers (Python data sources
    and pandas functions run there).

    On a cluster the package travels with ``--py-files`` and this helper
    does nothing. With a local work folder (local mode, tests) it zips the
    package into that folder once per application and adds it with
    ``addPyFile``.
    """
    import os
    import zipfile

    flag = "spark.lakeloom.shipped"
    if spark.conf.get(flag, "false") == "true":
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    work = ensure_work_dir(spark)
    local = work[len("file:"):] if work.startswith("file:") else work
    if "://" in local:
        return  # a cluster work folder: the package ships with --py-files
    local = os.path.join(local, "lakeloom-pkg")
    os.makedirs(local, exist_ok=True)
    archive = os.path.join(local, f"lakeloom-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc = _context(spark)
    if sc is not None:
        sc.addPyFile(archive)
    else:
        spark.addArtifacts(archive, pyfile=True)
    spark.conf.set(flag, "true")
