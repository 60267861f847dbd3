"""Session settings the engine relies on.

All time semantics are UTC instants (the source system is UTC), and every
cast of raw text is a ``try_*`` cast, so ANSI mode may stay on.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings applied to any session handed to the engine. Only runtime
# (session-scoped) SQL confs belong here; cluster sizing is left to the caller.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not JIT methods over 8000 bytecodes; larger generated
    # methods (wide validation predicates) fall back to per-operator code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Stored records are read and written whole: shredded into columns, each
    # write takes them apart and each read puts them together again.
    "spark.sql.variant.inferShreddingSchema": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's session-scoped settings and return the session."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "moodline",
                shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    The web UI stays off: no port beyond Spark's own RPC is opened.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # Python call-site capture for error messages costs several JVM
               # round trips per Column call (documented overhead); jobs built
               # from hundreds of Column calls plan noticeably faster without it.
               .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**ENGINE_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and stream checkpoints.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the
    operator (a shared filesystem); unset there is an error. Only in local
    mode, as in tests, a fresh scratch folder is created when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # A driver-local folder is invisible to executors on a cluster.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        configured = tempfile.mkdtemp(prefix="moodline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
