"""Session builder and the settings the library relies on."""
import os

from pyspark.sql import SparkSession


def build_session(app="tickloom", master=None, **conf):
    """A session with UTC time, ANSI arithmetic and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # window chains are heavy on CPU per byte: do not merge their partitions down to one task
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark):
    """All time arithmetic is in UTC; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_STAGED = []


def shared_dir(spark, name):
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder is read from spark.checkpoint.dir. Only in local mode, where driver and executors are
    one process, a temporary folder takes its place if nothing is set; on a cluster that is an error, since executors
    would not see each other's files.
    """
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "tickloom-work")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def release_staged(spark):
    """Delete the shared folders this session has made; call it when no result that reads them is needed any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)


def materialize(df, name="table"):
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives the
    loss of executors and saves recomputing a frame that several branches use."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
