"""Session settings for tests and benchmarks; on a cluster the caller's session is used as it is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str | int = 8, shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cohortry")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_BASE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    The folder is read from the session. A local session without the setting, as in tests, gets a
    temporary one; on a cluster that would be out of the executors' reach, so there it is an error. All
    folders of an application stand in one of its own, which its driver deletes when it exits. Names are short, as
    plans show no more than 100 letters of a path.
    """
    app = spark.sparkContext.applicationId
    if app not in _OWN_BASE:
        base = spark.conf.get(CHECKPOINT_CONF, None)
        if not base and spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that every executor can reach")
            base = tempfile.gettempdir()
        own = f"{base.rstrip('/')}/cohortry-{uuid.uuid4().hex[:12]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWN_BASE[app] = own
    return f"{_OWN_BASE[app]}/{uuid.uuid4().hex[:16]}"
