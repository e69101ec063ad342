"""Session helpers.

The library never creates its own cluster settings behind the caller's
back: `configure` only sets the SQL options whose values change answers
(session time zone) or that every plan here relies on (AQE, skew join).
`build_session` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Options the operators rely on.  Time zone is pinned because the
# reference's UTC -> local conversions are only right with a UTC session.
SESSION_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL options every plan in this package assumes."""
    for k, v in SESSION_SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts (checkpoint / written tables).

    On a cluster this is whatever `spark.checkpoint.dir` names (a shared
    file system).  Only when nothing is configured - tests and local
    runs - a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tallyline-ckpt-")      # one machine: tests and local runs
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def ship_package(spark: SparkSession) -> None:
    """Give every Python worker this package (once per context), so that
    functions run on executors import wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyline_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tallyline-zip-"), "tallyline.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tallyline", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._tallyline_shipped = True


def build_session(master: str | None = None, app: str = "tallyline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests / bench.  UI off, no ports beyond Spark's own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.parquet.datetimeRebaseModeInRead", "CORRECTED")
         .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
         .config("spark.executor.extraJavaOptions", "-Duser.timezone=UTC"))
    for k, v in SESSION_SQL_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
