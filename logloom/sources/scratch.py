"""Tables that cut lineage, in the folder named by spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The shared folder; a temporary one only on one machine where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="logloom-work-"))
    return f"{named.rstrip('/')}/logloom-work"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back."""
    return WorkTables(df.sparkSession, label).save("table", df)


class WorkTables:
    """Tables of one operator's rounds; those that nothing reads any more can go."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and return it as read back; an older table of that name stays until dropped."""
        path = f"{work_folder(self.spark)}/{self.label}-{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, keep_last: bool = False) -> None:
        """Delete all tables of these names, or all but the newest of each."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            paths = self.paths.get(name, [])
            old, self.paths[name] = (paths[:-1], paths[-1:]) if keep_last else (paths, [])
            for path in old:
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
