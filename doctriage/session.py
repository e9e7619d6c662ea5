"""Session helpers: a tuned local session for tests/bench and a shared scratch folder.

On a cluster the session is created by the platform; library code only reads its
settings.  ``scratch_dir`` resolves the folder that intermediate tables are written
to from ``spark.checkpoint.dir`` and only invents one when the setting is absent
(local tests), as required for lineage cuts that survive executor loss.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "doctriage", extra_conf: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects (UTC, AQE, no UI)."""
    parts = shuffle_partitions or (8 if cores == "*" else max(2, int(cores)))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.driver.memory", os.environ.get("DOCTRIAGE_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _classic_context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the shared checkpoint directory.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); only when
    neither is set and the session is local (tests) a temporary folder is created and registered.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = _classic_context(spark)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="doctriage-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(base)
        else:
            spark.conf.set("spark.checkpoint.dir", base)
    sub = f"{name or 'scratch'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub


def materialize(df, name: str = "stage", fmt: str = "parquet"):
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor later recomputes from these files, not from
    the scorer) and is how reports reuse scored rows without re-scoring.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write.mode("overwrite").format(fmt)
    # written once and read a few times: what it takes on disk counts for more than the time to pack it
    (writer.option("compression", "zstd") if fmt == "parquet" else writer).save(path)
    return spark.read.format(fmt).schema(df.schema).load(path)  # known: no job that looks for it


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``doctriage`` importable on executors (UDFs reference its functions).

    Zips the package's sources once per application and registers the archive
    with ``addPyFile``; Spark distributes it to every executor's Python path.
    Harmless where the package is already installed.
    """
    sc = _classic_context(spark)
    app = sc.applicationId if sc is not None else f"connect-{spark.session_id}"
    if app in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="doctriage-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, dirnames, files in os.walk(pkg):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, parent))
    if sc is not None:
        sc.addPyFile(path)
    else:  # Spark Connect: artifacts instead of the SparkContext
        spark.addArtifacts(path, pyfile=True)
    _SHIPPED.add(app)
