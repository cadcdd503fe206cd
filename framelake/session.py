"""Session construction, the shared checkpoint folder, and shipping this
package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

from framelake.settings import Settings, session_conf

_PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def build_session(settings: Settings | None = None, app_name: str = "framelake", master: str | None = None) -> SparkSession:
    """Session configured from ``settings`` (UTC, AQE, Arrow, header key
    de-duplication, connectors and catalog)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config(map=session_conf(settings or Settings()))
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def configured_root(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``, read from the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else None


def checkpoint_root(spark: SparkSession) -> str:
    """The configured shared folder, for anything that must survive a restart
    (stream checkpoints). There is no fallback: a folder made up per process
    would make a restarted job begin anew and lose or repeat records."""
    root = configured_root(spark)
    if not root:
        raise ValueError("set CHECKPOINT_LOCATION or spark.checkpoint.dir to a folder that survives a restart and that all executors share")
    return root


def scratch_root(spark: SparkSession) -> str:
    """Folder for tables a query writes for its own use within one
    application: the configured shared folder; in single-process local mode
    with none configured (tests), a folder of this application's own."""
    root = configured_root(spark)
    if root:
        return root
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), f"framelake-{context.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the scratch folder (never reused)."""
    return f"{scratch_root(spark)}/framelake/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``framelake`` importable in Python workers, once per application.
    The zip is made on the driver and handed out by Spark's own file server
    (``addPyFile``), so no folder has to be shared."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="framelake-pyfiles-"), "framelake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in sorted(os.walk(_PACKAGE_DIR)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE_DIR)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
