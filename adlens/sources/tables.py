"""View and table materialization with persisted column documentation.

A view is a lazy DataFrame registered by name. A table is written in full as
Parquet, optionally partitioned, to a folder of its own, and then takes the
place of the former one by rename, so that a run that ends while writing
leaves the former table as it was (``replacing``); column descriptions travel as
``comment`` metadata in the Parquet footer's Spark schema, and as column
comments when the table is saved to the catalog. A written table also cuts
the lineage of everything downstream: a lost executor re-reads files instead
of recomputing the models above it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adlens.session import delete_path, path_exists, rename_path


def with_docs(df: DataFrame, docs: Mapping[str, str]) -> DataFrame:
    """Attach ``comment`` metadata to documented columns."""
    for c in df.columns:
        if c in docs:
            df = df.withMetadata(c, {**_meta(df, c), "comment": docs[c]})
    return df


def _meta(df: DataFrame, c: str) -> dict:
    return dict(df.schema[c].metadata or {})


def column_docs(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["comment"] for f in df.schema.fields
            if f.metadata and "comment" in f.metadata}


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def _aside(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_replacing/{name}"


def restore(spark: SparkSession, path: str) -> None:
    """Put back the former table where a run ended between the two renames, and
    drop what such a run left besides."""
    aside = _aside(path)
    if not path_exists(spark, path) and path_exists(spark, f"{aside}/former"):
        rename_path(spark, f"{aside}/former", path)
    delete_path(spark, aside)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write the new contents of ``path`` to; they take its place
    when the block ends well, and otherwise nothing changes."""
    restore(spark, path)
    aside = _aside(path)
    try:
        yield f"{aside}/new"
        if path_exists(spark, path):
            rename_path(spark, path, f"{aside}/former")
        rename_path(spark, f"{aside}/new", path)
    finally:
        restore(spark, path)


def write_table(df: DataFrame, path: str, docs: Mapping[str, str] | None = None,
                partition_by: list[str] | None = None, mode: str = "overwrite",
                dynamic_partitions: bool = False) -> str:
    """Full-refresh Parquet table at ``path``, replaced only once it is written.

    With ``partition_by`` and ``dynamic_partitions=True`` only the partitions
    present in ``df`` are replaced (the rest of the table is kept).
    """
    if docs:
        df = with_docs(df, docs)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if mode == "overwrite" and not dynamic_partitions:
        with replacing(df.sparkSession, path) as new:
            w.parquet(new)
    else:
        w.parquet(path)
    return path


def save_table(spark: SparkSession, df: DataFrame, name: str,
               docs: Mapping[str, str] | None = None, table_comment: str | None = None,
               partition_by: list[str] | None = None) -> str:
    """Catalog table (``saveAsTable``) with relation and column comments."""
    if docs:
        df = with_docs(df, docs)
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    if table_comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quote(table_comment)}")
    return name


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                   comment: str | None = None, partition_by: str | None = None) -> str:
    """A catalog table over the Parquet files at ``path``, with the comments of
    its columns (from the schema) and its own; an earlier entry is replaced,
    its files stay."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     + (f" COMMENT {_quote(f.metadata['comment'])}" if (f.metadata or {}).get("comment") else "")
                     for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet"
              + (f" PARTITIONED BY ({partition_by})" if partition_by else "")
              + f" LOCATION {_quote(path)}" + (f" COMMENT {_quote(comment)}" if comment else ""))
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return name


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        restore(spark, path)
    return spark.read.parquet(path)
