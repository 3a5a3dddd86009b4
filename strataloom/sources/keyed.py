"""A table by key that is updated in place: buckets of Parquet files, and snapshots that say which files count."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class KeyedTable:
    """Rows by `key`, each key once, below a folder that all executors share.

    A row's bucket follows from its key. A snapshot names a version of each bucket; versions are folders that never change once they are written.
    An update writes the buckets that have changed rows as new versions, and then a snapshot, which counts from the moment its file is there.
    So readers see a whole snapshot, a failed update leaves the last one, and two writers of one snapshot can't both succeed.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = spark.createDataFrame([], schema).schema

    def _at(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def version(self) -> int:
        """The last snapshot's number; 0 where there is none."""
        files, at = self._at("_snapshots")
        if not files.exists(at):
            return 0
        return max((int(f.getPath().getName()) for f in files.listStatus(at) if f.getPath().getName().isdigit()), default=0)

    def _folders(self, version: int) -> dict[str, str]:
        """By bucket, the folder that holds it: one small file, as many entries as buckets."""
        if not version:
            return {}
        return json.loads(self.spark.read.text(f"{self.path}/_snapshots/{version}", wholetext=True).first()["value"])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _read(self, folders: dict[str, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders.values()])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a snapshot, the last one if none is named."""
        return self._read(self._folders(self.version() if version is None else version))

    def upsert(self, rows: DataFrame) -> int:
        """Puts rows (all columns) in by key and returns how many differ from what is there; where none does nothing is written.

        A null key is refused; of several rows with a key the greatest, by its columns in order, counts. Only changed buckets are read whole and written.
        """
        now = self.version()
        folders = self._folders(now)
        names = self.schema.names
        new = rows.select(*names).groupBy(self.key).agg(F.max(F.struct(*names)).alias("_row")).select("_row.*")
        if not new.where(F.col(self.key).isNull()).isEmpty():
            raise ValueError(f"rows without {self.key}")
        old = self._read(folders).select(F.struct(*names).alias("_old"), F.col(self.key).alias("_key"))
        differs = new.join(old, F.col(self.key) == F.col("_key"), "left").where(F.col("_old").isNull() | ~F.struct(*names).eqNullSafe(F.col("_old")))
        changed, at = self._stored(differs.select(*names).withColumn("_bucket", self._bucket()))
        counts = {str(r["_bucket"]): r["count"] for r in changed.groupBy("_bucket").count().collect()}
        if counts:
            touched = {b: f for b, f in folders.items() if b in counts}
            kept = self._read(touched).withColumn("_bucket", self._bucket()).join(changed.select(self.key), self.key, "left_anti")
            run = f"data/{now + 1}-{uuid.uuid4().hex}"
            whole = kept.select(*names, "_bucket").unionByName(changed)
            whole.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{run}")
            self._snapshot(now + 1, folders | {b: f"{run}/_bucket={b}" for b in counts})
        files, path = self._at(at)
        files.delete(path, True)
        return sum(counts.values())

    def _stored(self, df: DataFrame) -> tuple[DataFrame, str]:
        """What has changed is decided once, and read twice."""
        at = f"_changed-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{at}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{at}"), at

    def _snapshot(self, version: int, folders: dict[str, str]) -> None:
        """Another writer's snapshot of this number isn't overwritten: the update fails, and its files count nowhere."""
        files, at = self._at(f"_snapshots/{version}")
        out = files.create(at, False)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()

    def forget(self, keep: int = 2) -> None:
        """Deletes snapshots but the last `keep`, and the files that no other names."""
        last = self.version()
        named = {f.split("/")[1] for v in range(max(1, last - keep + 1), last + 1) for f in self._folders(v).values()}
        files, at = self._at("_snapshots")
        for f in files.listStatus(at) if files.exists(at) else []:
            if f.getPath().getName().isdigit() and int(f.getPath().getName()) <= last - keep:
                files.delete(f.getPath(), False)
        files, at = self._at("data")
        for f in files.listStatus(at) if files.exists(at) else []:
            if f.getPath().getName() not in named:
                files.delete(f.getPath(), True)
