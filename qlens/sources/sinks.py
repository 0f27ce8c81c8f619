"""Writing classified rows and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qlens.config import KEYWORDS, SchemaConfig, binary, denormalize
from qlens.sources.tables import is_path
from qlens.storage import join_path, setting

MAX_RECORDS_PER_FILE = 5_000_000
BATCH_LOAD = "batch"


def append_keywords(
    facts: DataFrame,
    path: str,
    cfg: SchemaConfig = SchemaConfig(),
    mode: str = "append",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    load: str = BATCH_LOAD,
) -> None:
    """Appends fact rows as parquet, one folder per day and load.

    ``overwrite`` replaces the whole path, ``replace`` only the days of this
    load that have rows again. Rows are rebalanced by day first: small days
    are put together into few files, a day too large for one task is split
    over several.
    """
    out = stored_columns(facts, cfg).withColumn("load", F.lit(load))
    (
        out.hint("rebalance", "created_date")
        .write.mode("overwrite" if mode == "replace" else mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("partitionOverwriteMode", "dynamic" if mode == "replace" else "static")
        .partitionBy("created_date", "load")
        .parquet(path)
    )


def stored_columns(facts: DataFrame, cfg: SchemaConfig = SchemaConfig()) -> DataFrame:
    """Physical columns without collations, and the day that tables are partitioned by."""
    texts = {c: binary(c) for c in ("query_text", "keyword")}
    out = denormalize(facts.select(*KEYWORDS).withColumns(texts), KEYWORDS, cfg)
    return out.withColumn("created_date", F.to_date(cfg.physical("created_at")))


def append_keywords_table(
    facts: DataFrame, table: str, cfg: SchemaConfig = SchemaConfig(), mode: str = "append", load: str = BATCH_LOAD
) -> None:
    """Appends fact rows to a catalog table, matching columns by name; the first run creates it.

    ``replace`` overwrites only the partitions (day, load) that have rows
    again. A table of somebody else's making may lack the load column; then it
    can be appended to, but not replaced in.
    """
    spark = facts.sparkSession
    out = stored_columns(facts, cfg).withColumn("load", F.lit(load)).hint("rebalance", "created_date")
    if not spark.catalog.tableExists(table):
        out.write.partitionBy("created_date", "load").saveAsTable(table)
        return
    columns = spark.table(table).columns
    if mode == "replace" and "load" not in columns:
        raise ValueError(f"{table} has no load column to replace by")
    # any other column a table has is filled with NULL
    row = out.select(*[F.col(f"`{c}`") if c in out.columns else F.lit(None).alias(c) for c in columns])
    if mode != "replace":
        row.write.mode("append").insertInto(table)
        return
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        row.write.mode("overwrite").insertInto(table)


def store_keywords(
    facts: DataFrame, sink: str, cfg: SchemaConfig = SchemaConfig(), mode: str = "append", load: str = BATCH_LOAD
) -> None:
    """Writes fact rows to a fact folder or a catalog table, whichever ``sink`` names."""
    write = append_keywords if is_path(sink) else append_keywords_table
    write(facts, sink, cfg, mode=mode, load=load)


def append_keywords_jdbc(
    facts: DataFrame, options: dict[str, str], cfg: SchemaConfig = SchemaConfig(), batch_size: int = 10_000
) -> None:
    """Appends fact rows to a database table, in batched inserts per task."""
    (
        stored_columns(facts, cfg)
        .drop("created_date")
        .write.format("jdbc")
        .options(**options)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )


def write_rejects(rejects: DataFrame, path: str, load: str | None = None) -> None:
    """Appends rejected rows; those of a named load replace that load's."""
    if load is None:
        rejects.write.mode("append").parquet(join_path(path, f"load={BATCH_LOAD}"))
    else:
        rejects.write.mode("overwrite").parquet(join_path(path, f"load={load}"))


def write_report(sheets: dict[str, DataFrame], path: str, fmt: str = "csv") -> dict[str, str]:
    """One folder per sheet under ``path``; returns sheet name to folder."""
    folders = {name: join_path(path, name) for name in sheets}
    for name, df in sheets.items():
        writer = df.write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(folders[name])
    return folders
