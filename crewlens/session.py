"""Session settings and the shared folder for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Runtime re-planning does the sizing: many initial shuffle partitions are merged up to the
# advisory size on small inputs and kept on large ones, and hot partitions are split.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


MB = 1 << 20


def sizing(scan_bytes: int, cores: int, shuffled: float = 0.1) -> dict[str, str]:
    """Split and shuffle settings for an input size and a number of executor cores.

    Scan tasks: about forty per core, between 128 MB and 1 GB each, so that a large input does
    not turn into a million tasks. Shuffles: the share ``shuffled`` of the input that pruning
    and partial aggregation leave, cut to 256 MB, at least one partition per core; the runtime
    merges partitions that turn out small.
    """
    split = min(max(scan_bytes // (cores * 40), 128 * MB), 1024 * MB)
    partitions = max(int(scan_bytes * shuffled) // (256 * MB), cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def session(
    app: str = "crewlens", master: str | None = None, scan_bytes: int = 0, cores: int = 0, **settings: str
) -> SparkSession:
    """A session with the defaults above; keyword dots are written as double underscores.

    ``scan_bytes`` and ``cores`` together add the settings of ``sizing``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    named = {key.replace("__", "."): value for key, value in settings.items()}
    sized = sizing(scan_bytes, cores) if scan_bytes and cores else {}
    for key, value in {**DEFAULTS, **sized, **named}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    A local run without the setting gets a temporary folder; a cluster without it is an error,
    since a folder of one machine would be lost with that machine.
    """
    known = spark.conf.get(CHECKPOINT_DIR, None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="crewlens-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


_copies: list[str] = []


def discard_copies(spark: SparkSession) -> None:
    """Delete what was written to ``scratch`` paths in this process; tables that read it end with it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _copies:
        path = jvm.org.apache.hadoop.fs.Path(_copies.pop())
        path.getFileSystem(conf).delete(path, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``discard_copies`` deletes."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _copies.append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Used where several results share one expensive input: the lineage ends here, the columnar
    copy lets each reader prune columns, and its known size lets joins choose a broadcast.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write a table to the shared folder, dealt to buckets by a key and sorted by it, and read it.

    Steps by that key on tables of the same number of buckets need no shuffle. Rows are dealt
    before they are written, so that a bucket is one file.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, f"`{key}`").write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", scratch(spark, name)).saveAsTable(table)
    return spark.table(table)
