"""Session helpers: a local session for tests/bench and lineage cuts.

Library code never builds its own session; it takes the caller's. The only
session state it relies on is ``spark.checkpoint.dir`` (a shared folder on a
cluster), which it reads and never overrides when set. ``bucketed_table`` sets one
setting while it writes and puts it back.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tierwell", extra_conf: dict | None = None) -> SparkSession:
    """Session for tests and the local benchmark (never used by operators)."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a bare local session (tests) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="tierwell-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and cut its lineage.

    Used where one intermediate feeds several jobs (ODS snapshot, dimension
    tables) or where later steps must see exactly one evaluation of a
    nondeterministic expression (partition-offset ids). Survives executor
    loss, unlike a local checkpoint or a cache.
    """
    spark = df.sparkSession
    import uuid
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tierwell-tables/{uuid.uuid4().hex}"
    # a written table in the shared checkpoint folder: columnar, so later
    # reads prune columns and push filters (is_active = 1, key ranges)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


_TASK_BYTES, _TASK_MB = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16


def bucketed_table(df: DataFrame, cols) -> DataFrame:
    """``materialize`` into as many buckets of ``cols`` as the session shuffles into.

    The rows are bucketed by the tasks that make them, without a shuffle; a later
    grouping or join on exactly ``cols`` finds them in place. Each task sorts its rows by
    bucket: rows grow wide after the shuffle that deals them out, so Spark's usual 64 MB of
    shuffled bytes would be sorted as more than a GB, and spill. The tasks of the write are dealt
    ``_TASK_MB`` instead (as far as the shuffle has that many partitions).
    """
    import uuid
    spark = df.sparkSession
    name = f"tierwell_rows_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tierwell-tables/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get(_TASK_BYTES)
    spark.conf.set(_TASK_BYTES, f"{_TASK_MB}m")
    try:
        # its files are many and small, so snappy finds little in them
        (df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, *cols)
         .saveAsTable(name))
    finally:
        spark.conf.set(_TASK_BYTES, before)
    return spark.table(name)


class WorkTables:
    """Bucketed tables of one job in the shared checkpoint folder, removed when the job is done.

    ``with WorkTables(spark) as work: work.bucketed(df, ["key"], 8)`` writes ``df``
    by bucket and reads it back, so that joins on the key find it in place.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.made = spark, {}

    def bucketed(self, df: DataFrame, cols, buckets: int) -> DataFrame:
        import uuid
        name = f"tierwell_job_{uuid.uuid4().hex}"
        self.made[name] = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/tierwell-tables/{name}"
        (df.write.format("parquet").option("path", self.made[name]).bucketBy(buckets, *cols).sortBy(*cols)
         .saveAsTable(name))
        return self.spark.table(name)

    def __enter__(self):
        return self

    def __exit__(self, *error):
        jvm = self.spark.sparkContext._jvm
        for name, folder in self.made.items():
            self.spark.sql(f"drop table if exists {name}")
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.made = {}


def empty_frame(spark: SparkSession, schema) -> DataFrame:
    """An empty DataFrame Catalyst knows to be empty.

    Built as a one-row relation filtered by ``false`` (folded to an empty
    local relation), so unions with it and joins against it are pruned at
    planning time; ``createDataFrame([])`` would be an opaque RDD scan.
    """
    from pyspark.sql import functions as F
    df = (spark.range(1)
          .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
          .where(F.lit(False)))
    setattr(df, _EMPTY, True)
    return df


_EMPTY = "_tierwell_empty"


def known_empty(df: DataFrame) -> bool:
    """Whether ``df`` was made by :func:`empty_frame` (nothing is counted)."""
    return getattr(df, _EMPTY, False)
