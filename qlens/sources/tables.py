"""Reading the three tables from files, catalog tables or a database."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from qlens.config import CATEGORIES, CHATS, KEYWORDS, SchemaConfig, normalize, resolve_query_column
from qlens.operators.lookup import bounded_dimension
from qlens.period import Period, in_period

# Database URL schemes understood, and the JDBC driver class of each.
JDBC_DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "postgresql": "org.postgresql.Driver",
    "sqlite": "org.sqlite.JDBC",
}


def jdbc_url(url: str) -> str:
    """``mysql+driver://...`` style URLs, or JDBC URLs, as a JDBC URL."""
    if url.startswith("jdbc:"):
        return url
    scheme, sep, rest = url.partition("://")
    scheme = scheme.split("+")[0]
    if not sep or scheme not in JDBC_DRIVERS:
        raise ValueError("database URL must start with one of " + ", ".join(JDBC_DRIVERS))
    if scheme == "sqlite":
        return "jdbc:sqlite:" + rest.removeprefix("/")
    # Credentials go into options, never into the URL.
    return f"jdbc:{scheme}://{rest.rpartition('@')[2]}"


def jdbc_credentials(url: str) -> dict[str, str]:
    """``user`` and ``password`` options found in a URL, percent-decoded."""
    login, at, _ = url.partition("://")[2].rpartition("@")
    if not at:
        return {}
    user, _, password = login.partition(":")
    return {"user": unquote(user), "password": unquote(password)} if password else {"user": unquote(user)}


@dataclass(frozen=True)
class JdbcSource:
    """A database table read in parallel slices of a date or number column."""

    url: str
    table: str
    partition_column: str | None = "created_at"
    lower: str | None = None
    upper: str | None = None
    partitions: int = 8
    fetch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        url = jdbc_url(self.url)
        opts = {
            "url": url,
            "dbtable": self.table,
            "driver": JDBC_DRIVERS[url.split(":")[1]],
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
            **jdbc_credentials(self.url),
        }
        if self.partition_column and self.lower and self.upper:
            opts |= {
                "partitionColumn": self.partition_column,
                "lowerBound": self.lower,
                "upperBound": self.upper,
                "numPartitions": str(self.partitions),
            }
        return opts | self.options

    def for_period(self, period: Period) -> "JdbcSource":
        """Slices of equal time that span the period; a single day is sliced as well."""
        return replace(self, lower=f"{period.start} 00:00:00", upper=f"{period.end} 23:59:59")

    def bounds(self, spark: SparkSession) -> tuple[str, str] | None:
        """Least and greatest value of the partition column, found by the database; None for an empty table."""
        opts = {k: v for k, v in self.reader_options().items() if k != "dbtable"}
        query = f"SELECT min({self.partition_column}) AS low, max({self.partition_column}) AS high FROM {self.table} AS t"
        row = spark.read.format("jdbc").options(**opts, query=query).load().first()
        return None if row is None or row["low"] is None else (str(row["low"]), str(row["high"]))

    def sliced(self, spark: SparkSession) -> "JdbcSource":
        """With slices that span the whole table, where no bounds were given.

        Rows outside of the bounds would still be read, by the first or last
        slice, so a table that grows meanwhile loses nothing.
        """
        if not self.partition_column or (self.lower and self.upper) or self.partitions < 2:
            return self
        found = self.bounds(spark)
        return self if found is None else replace(self, lower=found[0], upper=found[1])

    def load(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self.sliced(spark).reader_options()).load()


Source = str | JdbcSource | DataFrame


def load(spark: SparkSession, source: Source, fmt: str = "parquet") -> DataFrame:
    """A path, a catalog table name, a database table or a ready DataFrame."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, JdbcSource):
        return source.load(spark)
    return spark.read.format(fmt).load(source) if is_path(source) else spark.table(source)


def table_columns(df: DataFrame) -> DataFrame:
    """Column names and types in ordinal order."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal_position int, column_name string, data_type string")


def read_chats(
    spark: SparkSession, source: Source, cfg: SchemaConfig = SchemaConfig(), period: Period | None = None
) -> DataFrame:
    """Raw messages: only the three columns used, in their logical names and types."""
    if isinstance(source, JdbcSource) and period is not None:
        source = source.for_period(period)
    return in_period(normalize(load(spark, source), CHATS, cfg), period)


def read_keywords(
    spark: SparkSession, source: Source, cfg: SchemaConfig = SchemaConfig(), period: Period | None = None
) -> DataFrame:
    """The classified fact; the question column is found by name priority.

    A table partitioned by ``created_date`` keeps that column beside the
    logical ones, so that it is pruned to ``period`` and to any period an
    operator filters by later.
    """
    if isinstance(source, JdbcSource) and period is not None:
        source = source.for_period(period)
    raw = load(spark, source)
    if cfg.physical("query_text") not in raw.columns:
        cfg = SchemaConfig(
            cfg.chats_table,
            cfg.keywords_table,
            cfg.categories_table,
            {**cfg.columns, "query_text": resolve_query_column(raw.columns)},
            cfg.collation,
        )
    days = [F.col("created_date")] if "created_date" in raw.columns else []
    return in_period(raw.select(*cfg.select_list(KEYWORDS), *days), period)


def stored_facts(spark: SparkSession, source: str, cfg: SchemaConfig = SchemaConfig()) -> DataFrame:
    """Every row written so far by any run, as stored: a fact folder or a catalog table; empty before the first."""
    columns = {cfg.physical(name): dtype for name, dtype in KEYWORDS.items()} | {"created_date": "date", "load": "string"}
    schema = ", ".join(f"`{name}` {dtype}" for name, dtype in columns.items())
    if is_path(source):
        try:
            return spark.read.schema(schema).parquet(source)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    elif spark.catalog.tableExists(source):
        spark.catalog.refreshTable(source)  # another session, such as a stream's, may have written to it
        return spark.table(source)
    return spark.createDataFrame([], schema)


def facts_of_other_loads(spark: SparkSession, source: str, cfg: SchemaConfig, load: str) -> DataFrame:
    """Stored facts under logical names that a load did not write itself; all of a table without loads."""
    stored = stored_facts(spark, source, cfg)
    if "load" in stored.columns:
        stored = stored.filter(F.col("load") != load)
    facts = read_keywords(spark, stored, cfg)
    return facts if "created_date" in facts.columns else facts.withColumn("created_date", F.to_date("created_at"))


def is_path(source: str) -> bool:
    return "/" in source


def read_categories(spark: SparkSession, source: Source, cfg: SchemaConfig = SchemaConfig()) -> DataFrame:
    """The category dimension, marked for broadcast once its size has been checked."""
    return bounded_dimension(normalize(load(spark, source), CATEGORIES, cfg))

