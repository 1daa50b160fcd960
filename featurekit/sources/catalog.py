"""Feature tables stored by number and joined to a base table by key."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators.columns import rename
from featurekit.operators.lookup import attach_all


class FeatureCatalog:
    """Parquet tables under ``{root}/feature_id={id}/name={name}``, one folder per dataset inside.

    Every table holds the key, the dataset name and columns prefixed with ``{id}__``. An id belongs to one name:
    saving it under another name and loading an unknown id are errors.

    With ``buckets`` every table is stored hashed and sorted by the key into so many buckets, and so is what
    :meth:`save_base` stores; joining tables of equal buckets moves no rows. A base that is not stored this way is shuffled
    once, whatever the number of tables. All tables of one folder need the same number of buckets.
    """

    def __init__(
        self, spark: SparkSession, root: str, key: str = "TransactionID", dataset: str = "dataset", buckets: int | None = None
    ):
        self.spark, self.root, self.key, self.dataset, self.buckets = spark, root.rstrip("/"), key, dataset, buckets

    def _folder(self, path: str) -> tuple:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _entries(self, path: str, prefix: str) -> list[str]:
        folder, files = self._folder(path)
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(n[len(prefix):] for n in names if n.startswith(prefix))

    def ids(self) -> list[str]:
        return self._entries(self.root, "feature_id=")

    def names(self, feature_id: str) -> list[str]:
        return self._entries(f"{self.root}/feature_id={feature_id}", "name=")

    def save(self, df: DataFrame, feature_id: str, name: str) -> None:
        """Store a feature table; columns that lack the id prefix get it."""
        taken = [n for n in self.names(feature_id) if n != name]
        if taken:
            raise ValueError(f"feature id {feature_id} already belongs to {taken[0]}")
        prefix = f"{feature_id}__"
        fixed = [c for c in df.columns if c in (self.key, self.dataset) or c.startswith(prefix)]
        path = f"{self.root}/feature_id={feature_id}/name={name}"
        self._write(rename(df, prefix=prefix, key=fixed), path)
        repeated = self._read(path).groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not repeated.isEmpty():
            self._folder(path)[1].delete(self._folder(path)[0], True)
            raise ValueError(f"feature id {feature_id}: {self.key} is not unique in {name}")

    def load(self, feature_id: str) -> DataFrame:
        """The one table stored under an id."""
        names = self.names(feature_id)
        if len(names) != 1:
            raise LookupError(f"feature id {feature_id}: expected one table, found {len(names)}")
        return self._read(f"{self.root}/feature_id={feature_id}/name={names[0]}")

    def save_base(self, df: DataFrame) -> DataFrame:
        """Store the table that features are joined to like a feature table, and return it."""
        self._write(df, f"{self.root}/base")
        return self._read(f"{self.root}/base")

    def _table(self, path: str) -> str:
        return "features_" + hashlib.md5(f"{path}|{self.buckets}".encode()).hexdigest()

    def _write(self, df: DataFrame, path: str) -> None:
        if not self.buckets:
            df.write.mode("overwrite").partitionBy(self.dataset).parquet(path)
            return
        name = self._table(path)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files of an external table stay, and are overwritten
        # Rows come together by bucket first, so a bucket is one file and its order is kept when it is read.
        placed = df.repartition(self.buckets, self.key)
        placed.write.mode("overwrite").option("path", path).bucketBy(self.buckets, self.key).sortBy(self.key).format("parquet").saveAsTable(name)

    def _read(self, path: str) -> DataFrame:
        """A stored table; a session that did not write it learns its buckets from the catalogue's settings."""
        if not self.buckets:
            return self.spark.read.parquet(path)
        name = self._table(path)
        if not self.spark.catalog.tableExists(name):
            kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({kinds}) USING parquet LOCATION '{path}' "
                           f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS")
        return self.spark.table(name)

    def attach(self, base: DataFrame, ids: Sequence[str] | str = ()) -> DataFrame:
        """Join feature tables to ``base``; one id, a list of ids, or nothing for all.

        Nothing is computed here. Stored keys are unique, so the rows of ``base`` stay as many as they are.
        """
        wanted = [ids] if isinstance(ids, str) else list(ids) or self.ids()
        return attach_all(base, [self.load(i).drop(self.dataset) for i in wanted], self.key)

    def feature(self, feature_id: str, name: str) -> Callable:
        """Decorator for a function that returns key, dataset and new columns: the result is stored, then returned."""

        def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            @wraps(build)
            def run(*args, **kwargs) -> DataFrame:
                self.save(build(*args, **kwargs), feature_id, name)
                return self.load(feature_id)

            return run

        return register
