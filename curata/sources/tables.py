"""S3. Reader tables: the driver's Parquet tables, read lazily with column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """``Tables(spark, sf_dir).pages`` etc.; every access is a lazy Parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        from curata.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(spark)  # also ships the package to the workers
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        # A scan is an immutable plan: this object lists files and reads footers once.
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._scans[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)
