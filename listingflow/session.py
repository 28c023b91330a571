"""Session and scratch-space helpers.

Nothing here tunes what Catalyst plans; it only makes sure the knobs a job relies on are on
(AQE with skew-join splitting and partition coalescing, UTC session time) and gives jobs a
shared place for checkpoints and written intermediates.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here assumes. They are applied only when the caller builds the session
# through ``get_spark``; an existing session keeps its own values.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytecodes; wide projections (the listing
    # cleaning has ~40 expressions) would then run interpreted inside whole-stage codegen.
    # With this limit Spark falls back to per-expression codegen for such stages instead
    # (the setting the Spark configuration docs recommend for HotSpot).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app: str = "listingflow", master: str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


_LOCAL_ROOT: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a path every executor can reach). Only when
    it is unset, as in a local test session, a private temporary folder is created once and set
    as the context's checkpoint folder (``spark.checkpoint.dir`` itself cannot be changed at
    runtime).
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root and sc is not None and not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: a machine-local "
                           "one would lose what other executors write")
    if not root:
        root = _LOCAL_ROOT.setdefault("root", tempfile.mkdtemp(prefix="listingflow-ckpt-"))
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; ``None`` for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:
        return None


_SCRATCH_ROOTS: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one job's written intermediates, under
    ``<checkpoint root>/listingflow/<application id>/``. That application folder is removed when
    the driver process exits (frames returned to a caller may read from it until then)."""
    sc = _context(spark)
    app = sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "app")
    root = f"{checkpoint_root(spark)}/listingflow/{app}"
    if root not in _SCRATCH_ROOTS and sc is not None:
        _SCRATCH_ROOTS.add(root)
        atexit.register(_remove_tree, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _remove_tree(spark: SparkSession, root: str) -> None:
    """Best effort: delete a scratch tree through the session's Hadoop file system."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the JVM may already be gone at interpreter exit
        pass


def stage(df, name: str = "stage"):
    """Write ``df`` once as parquet under the checkpoint root and return a frame reading it.

    Used where a plan reads the same intermediate several times (a batch and its group means):
    the upstream joins and shuffles run once, lineage is cut (a lost executor costs a re-read,
    not a recompute), and later stages get real file statistics for AQE.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def spread(df, min_partitions: int | None = None):
    """Round-robin ``df`` over at least ``min_partitions`` tasks (default: the cluster's cores)
    when its scan yields fewer, e.g. a large file written as one unsplittable row group.

    A scan that already has enough splits (the normal case for a big table) is left alone, so
    this costs a shuffle only where the alternative is one task doing all the work.
    """
    sc = _context(df.sparkSession)
    if sc is None:           # Spark Connect: no partition count to inspect
        return df
    want = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
