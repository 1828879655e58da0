"""Tables as Parquet folders: names to paths, evolution by added columns, and overwriting only touched partitions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrafold.functions.text import stratified_cap


class Tables:
    """layer.name tables below a root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        """The table; with a schema, its columns in that order, missing ones NULL, even if the table is not there yet."""
        if schema is None:
            return self.spark.read.parquet(self.path(name))
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return align(self.spark.read.option("mergeSchema", True).parquet(self.path(name)), schema)

    def exists(self, name: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def append(self, df: DataFrame, name: str, partition: list[str] | None = None) -> None:
        df.write.mode("append").partitionBy(*(partition or [])).parquet(self.path(name))

    def overwrite(self, df: DataFrame, name: str, partition: list[str] | None = None) -> None:
        df.write.mode("overwrite").partitionBy(*(partition or [])).parquet(self.path(name))

    def overwrite_partitions(self, df: DataFrame, name: str, partition: list[str]) -> None:
        """Replaces the partitions that df has rows of, and leaves the others."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(self.path(name))

    def export(self, df: DataFrame, name: str, files: int = 1) -> None:
        """A small result in few files."""
        df.coalesce(files).write.mode("overwrite").parquet(self.path(name))

    def export_csv(self, df: DataFrame, name: str, files: int = 1) -> None:
        """The same as CSV with a header, quotes doubled; for people and other tools."""
        df.coalesce(files).write.mode("overwrite").option("header", True).option("escape", '"').csv(self.path(name))

    def export_sample(self, df: DataFrame, name: str, label: str, each: int, order: list[Column]) -> None:
        """A CSV of at most so many rows of each label, the first by order: for checking by hand."""
        self.export_csv(stratified_cap(df, label, each, order), name)


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema in its order: cast, or NULL where df has none."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def added_columns(df: DataFrame, schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.name not in df.columns]


def _name(name: str) -> str:
    """A table's or column's name with each part quoted."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ddl(name: str, schema: StructType, partition: list[str] | None = None, properties: dict[str, str] | None = None, location: str | None = None, replace: bool = False) -> str:
    """A CREATE TABLE IF NOT EXISTS for the schema, or one that replaces what is there, for catalogs that can.

    Parts of names are quoted; a location makes the table external.
    """
    columns = ", ".join(f"{_name(f.name.replace('.', chr(0))).replace(chr(0), '.')} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(_name(p) for p in partition)})" if partition else ""
    place = f" LOCATION {_text(location)}" if location else ""
    extra = f" TBLPROPERTIES ({', '.join(f'{_text(k)}={_text(v)}' for k, v in (properties or {}).items())})" if properties else ""
    return f"CREATE {'OR REPLACE TABLE' if replace else 'TABLE IF NOT EXISTS'} {_name(name)} ({columns}) USING parquet{parts}{place}{extra}"


class Catalog:
    """Namespaces and tables of the session's catalog by DDL."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def create_namespace(self, name: str, location: str | None = None) -> None:
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_name(name)}" + (f" LOCATION {_text(location)}" if location else ""))

    def drop_namespace(self, name: str, tables_too: bool = False) -> None:
        self.spark.sql(f"DROP NAMESPACE IF EXISTS {_name(name)}{' CASCADE' if tables_too else ''}")

    def create(self, name: str, schema: StructType, partition: list[str] | None = None, properties: dict[str, str] | None = None, location: str | None = None, replace: bool = False) -> None:
        """The table by ddl. Where the catalog cannot replace, the old table is dropped first."""
        try:
            self.spark.sql(ddl(name, schema, partition, properties, location, replace))
        except AnalysisException as refused:
            if not replace or "REPLACE TABLE" not in str(refused).upper():
                raise
            self.drop(name)
            self.spark.sql(ddl(name, schema, partition, properties, location))

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {_name(name)}")

    def tables(self, namespace: str) -> list[str]:
        """Names of the namespace's tables, in order."""
        return sorted(r.tableName for r in self.spark.sql(f"SHOW TABLES IN {_name(namespace)}").collect() if not r.isTemporary)
