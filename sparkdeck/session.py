"""Session construction and the shared working folder.

``build_session`` is what tests and ``bench.py`` use; library functions never
create a session themselves.

``shared_dir`` hands out a fresh folder under the cluster's
``spark.checkpoint.dir``.  Sinks that must materialise (the round-trip
operators) and lineage cuts write there, never to a machine-local temporary
folder.  Where the setting is absent, a local master gets a folder of its own
and any other master an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "sparkdeck", extra: dict | None = None) -> SparkSession:
    """Session tuned for the operators here: AQE on (coalescing, skew-join
    splitting, runtime broadcast), UTC, no UI server."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("SPARKDECK_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the context's, else ``spark.checkpoint.dir``
    from the session conf, else (local runs only) a new one."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a session without a JVM context (Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not conf:
        # Only a run on one machine may make up a folder: on a cluster every
        # executor would write to its own disk.
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="sparkdeck-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", conf)
        except Exception:  # noqa: BLE001 - core confs may be read-only at run time
            pass
    if sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    return conf


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sparkdeck/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss;
    never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
