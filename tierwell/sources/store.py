"""Layered table store on plain files: snapshot versions, layer overwrite, counts.

* ``SnapshotStore`` (M5, Q14): a table is a sequence of immutable snapshots
  ``<base>/<table>/v=<n>``. A version is written beside the others and counts
  only once its commit marker is there; the current version is the highest
  committed one. No version is ever overwritten, a failed run leaves the
  previous version current, and a table can be rebuilt from itself (the
  version being read is never the one being written).
* ``load_layer`` (S4, S5, S9): overwrite ``<base>/<layer>_<table>`` and return
  the reconciliation of rows written (observed during the write) against
  rows read back.
* ``write_checked``, ``checksum``: the content of a table as one row, observed during
  the write and comparable with what is read back.
* ``Run``, ``RunView`` (S14): many tables written as one unit; a manifest names the
  version of each, is committed last, and is what readers go by.
* ``write_batch`` (M8): the rows of one batch of a table (rejects), kept under
  the batch's name, so a batch that is run again replaces its own rows.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

COMMITTED = "_COMMITTED"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the session's shared checkpoint directory."""
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tierwell-{name}-{uuid.uuid4().hex[:12]}"


def write_counted(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                  partition_by=None, options: dict | None = None) -> int:
    """Write ``df`` and return the number of rows written (one pass, observed)."""
    obs = Observation("rows_written")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode).format(fmt)
    w = w.options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["n"])


def checksum(columns) -> list:
    """Aggregates that stand for a multiset of rows: their number, and sums of two hashes of each row.

    Order does not matter, and a changed, missing or doubled row does. NULLs are
    told apart from what they leave out.
    """
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    one = F.xxhash64(nulls, *[F.col(c) for c in columns])
    two = F.xxhash64(*[F.col(c) for c in reversed(list(columns))], nulls, F.lit("c"))
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string")
    return [F.count(F.lit(1)).alias("n"), total(one).alias("h1"), total(two).alias("h2")]


def write_checked(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                  options: dict | None = None) -> dict:
    """Write ``df`` and return the checksum of the rows as they were written (one pass, observed)."""
    obs = Observation("content_written")
    (df.observe(obs, *checksum(df.columns)).write.mode(mode).format(fmt).options(**(options or {})).save(path))
    return dict(obs.get)


def load_layer(df: DataFrame, table: str, base: str, layer: str = "stg") -> DataFrame:
    """Overwrite ``<layer>_<table>``; one-row reconciliation (table, written, read)."""
    spark = df.sparkSession
    name = f"{layer}_{table}"
    path = f"{base.rstrip('/')}/{name}"
    written = write_counted(df, path)
    read = spark.read.parquet(path).count()
    return spark.createDataFrame([(name, written, read)],
                                 "table_name string, rows_written long, rows_read long")


def _folder_name(batch: str) -> str:
    """A batch's name as a folder name that Spark reads back as the same text."""
    return re.sub(r"[^0-9A-Za-z_.-]", lambda m: f"%{ord(m[0]):02X}" if ord(m[0]) < 128 else m[0], batch)


def write_batch(df: DataFrame, base: str, table: str, batch: str) -> int:
    """Store one batch's rows of a table; running the batch again replaces them.

    Batches of different names never touch each other's rows. The table is read
    with :func:`read_batches`.
    """
    if not str(batch):
        raise ValueError("a batch needs a name")
    return write_counted(df, f"{base.rstrip('/')}/{table}/batch={_folder_name(str(batch))}")


def read_batches(spark: SparkSession, base: str, table: str) -> DataFrame:
    """All batches of a table, with the batch's name as text column ``batch``."""
    path = f"{base.rstrip('/')}/{table}"
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name != "batch"]
    return spark.read.schema(T.StructType([*fields, T.StructField("batch", T.StringType())])).parquet(path)


class SnapshotStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _path(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, table: str) -> dict[int, bool]:
        """Versions that have a folder, and whether each is committed.

        Only a folder that is absent means no versions; any other failure to
        list it raises.
        """
        folder, fs = self._path(f"{self.base}/{table}")
        if not fs.exists(folder):
            return {}
        out = {}
        for status in fs.listStatus(folder):
            m = re.fullmatch(r"v=(\d+)", status.getPath().getName())
            if m and status.isDirectory():
                out[int(m[1])] = fs.exists(self._path(f"{self.base}/{table}/v={m[1]}/{COMMITTED}")[0])
        return out

    def version(self, table: str) -> int | None:
        """The highest committed version, or None if the table has none."""
        return max((v for v, done in self.versions(table).items() if done), default=None)

    def read(self, table: str) -> DataFrame | None:
        v = self.version(table)
        return None if v is None else self.spark.read.parquet(f"{self.base}/{table}/v={v}")

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Write the next version and commit it; returns the stored table.

        A version number that has a folder, committed or left behind by a
        failed run, is never used again.
        """
        v = max(self.versions(table), default=0) + 1
        path = f"{self.base}/{table}/v={v}"
        df.write.mode("errorifexists").parquet(path)
        self.commit(table, v)
        return self.spark.read.parquet(path)

    def commit(self, table: str, v: int) -> None:
        marker, fs = self._path(f"{self.base}/{table}/v={v}/{COMMITTED}")
        fs.create(marker, False).close()


RUNS = "_runs"


class RunView:
    """The tables as one committed run left them: never a mixture of two runs.

    ``number`` is the run's; the latest committed one by default.
    """

    def __init__(self, store: SnapshotStore, number: int | None = None):
        self.store = store
        self.number = store.version(RUNS) if number is None else number
        self.tables: dict[str, int] = {} if not self.number else _load(store, f"{RUNS}/v={self.number}/run.json")["tables"]

    def read(self, table: str) -> DataFrame | None:
        v = self.tables.get(table)
        return None if v is None else self.store.spark.read.parquet(f"{self.store.base}/{table}/v={v}")


def _load(store: SnapshotStore, name: str) -> dict:
    path, fs = store._path(f"{store.base}/{name}")
    stream = fs.open(path)
    try:
        return json.loads(store.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _save(store: SnapshotStore, name: str, content: dict) -> None:
    """Write a small file under a name that no one else takes, whole or not at all."""
    path, fs = store._path(f"{store.base}/{name}")
    part, _ = store._path(f"{store.base}/{name}.{uuid.uuid4().hex}")
    out = fs.create(part, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if fs.exists(path) or not fs.rename(part, path):
        fs.delete(part, False)
        raise RuntimeError(f"{name} exists")


class Run:
    """One ordered run over a store, as a unit that can be taken up again.

    Tables are written as snapshots, one after another, each noted when it is
    stored. The run counts when its manifest (a version of every table) is
    committed, last, under the number after the run it started from; if
    another run took that number meanwhile, the commit raises. Readers go by
    manifests (:class:`RunView`), so a run that stopped half way is never seen.

    Starting a run under the same ``run_id`` again skips the tables that are
    stored, and the whole run if it is committed. The tables it starts from
    are those of the first start.
    """

    def __init__(self, store: SnapshotStore, run_id: str):
        self.store, self.run_id = store, str(run_id)
        self.folder = f"{RUNS}/id={_folder_name(self.run_id)}"
        started, fs = store._path(f"{store.base}/{self.folder}/started.json")
        if not fs.exists(started):
            _save(store, f"{self.folder}/started.json", {"from": store.version(RUNS)})
        self.base = _load(store, f"{self.folder}/started.json")["from"]
        self._before = RunView(store, self.base or 0)
        folder, _ = store._path(f"{store.base}/{self.folder}")
        noted = (re.fullmatch(r"(\w+)=v(\d+)", x.getPath().getName()) for x in fs.listStatus(folder))
        self.done = {m[1]: int(m[2]) for m in noted if m}

    def before(self, table: str) -> DataFrame | None:
        """The table as the run found it; None if no committed run has it."""
        return self._before.read(table)

    def write(self, table: str, build) -> DataFrame:
        """The table of this run: stored already, or ``build()`` stored now."""
        if table not in self.done:
            self.store.write(table, build())
            v = self.store.version(table)
            note, fs = self.store._path(f"{self.store.base}/{self.folder}/{table}=v{v}")
            fs.create(note, False).close()
            self.done[table] = v
        return self.store.spark.read.parquet(f"{self.store.base}/{table}/v={self.done[table]}")

    def committed(self) -> bool:
        store, n = self.store, (self.base or 0) + 1
        return store.versions(RUNS).get(n, False) and _load(store, f"{RUNS}/v={n}/run.json")["run"] == self.run_id

    def commit(self) -> None:
        """Make this run's tables, and the untouched ones of the run before, the current ones."""
        if self.committed():
            return
        n = (self.base or 0) + 1
        try:
            _save(self.store, f"{RUNS}/v={n}/run.json",
                  {"run": self.run_id, "tables": {**self._before.tables, **self.done}})
        except RuntimeError:
            # this run's own manifest from a start that stopped before the marker is as good
            if _load(self.store, f"{RUNS}/v={n}/run.json")["run"] != self.run_id:
                raise RuntimeError(f"another run was committed since run {self.run_id} started") from None
        self.store.commit(RUNS, n)
