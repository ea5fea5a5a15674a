"""JDBC source and sink.

Connection settings live in one :class:`JdbcConnection` value; credentials
are passed in by the caller (from a secret store or the environment), never
written in code.  Reads are split across tasks with a numeric partition
column; the bounds, when not given, are fetched with one pushed-down
``MIN/MAX`` query so no table is scanned twice by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    properties: dict[str, str] = field(default_factory=dict)
    #: identifier quote of the database (ANSI ``"``; MySQL uses a backtick)
    quote: str = '"'

    def ident(self, name: str) -> str:
        return f"{self.quote}{name}{self.quote}"

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, **self.properties}
        if self.driver:
            opts["driver"] = self.driver
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        return opts


def _reader(spark: SparkSession, conn: JdbcConnection, fetch_size: int):
    return spark.read.format("jdbc").options(**conn.options()).option("fetchsize", fetch_size)


def column_bounds(spark: SparkSession, conn: JdbcConnection, table: str, column: str) -> tuple[int | None, int | None]:
    """MIN and MAX of a numeric column, computed by the database."""
    col = conn.ident(column)
    q = f"SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table}"
    row = _reader(spark, conn, 10).option("query", q).load().first()
    return (row[0], row[1]) if row is not None else (None, None)


def read_table(
    spark: SparkSession,
    conn: JdbcConnection,
    table: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    fetch_size: int = 10_000,
    single_task: bool = False,
) -> DataFrame:
    """Read a table; filters and projections applied later are pushed
    to the database by Spark.  The read runs as ``num_partitions`` parallel
    range queries over ``partition_column``; a read through one connection and
    one task has to be asked for with ``single_task``."""
    if not partition_column and not single_task:
        raise ValueError(f"name a partition_column for {table}, or ask for single_task")
    reader = _reader(spark, conn, fetch_size).option("dbtable", table)
    if partition_column:
        if lower_bound is None or upper_bound is None:
            lo, hi = column_bounds(spark, conn, table, partition_column)
            lower_bound = lo if lower_bound is None else lower_bound
            upper_bound = hi if upper_bound is None else upper_bound
        if lower_bound is not None and upper_bound is not None:
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", int(lower_bound))
                .option("upperBound", int(upper_bound) + 1)
                .option("numPartitions", num_partitions or spark.sparkContext.defaultParallelism)
            )
    return reader.load()


def read_query(spark: SparkSession, conn: JdbcConnection, query: str, fetch_size: int = 10_000) -> DataFrame:
    """Let the database run a whole sub-query (filter, projection, join)."""
    return _reader(spark, conn, fetch_size).option("query", query).load()


def write_table(
    df: DataFrame,
    conn: JdbcConnection,
    table: str,
    mode: str = "overwrite",
    truncate: bool = True,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    column_types: str | None = None,
) -> None:
    """K1: write a DataFrame; ``overwrite`` replaces the rows (keeping the
    table definition when ``truncate``).  ``num_partitions`` caps the number
    of concurrent database connections; the rows are dealt out anew for it, so
    that the work before the write keeps its own tasks.  Overwrite is a snapshot, not a
    history: append a dated table for that."""
    out = df.repartition(num_partitions) if num_partitions else df
    w = (
        out.write.format("jdbc")
        .options(**conn.options())
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("truncate", truncate)
    )
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    w.mode(mode).save()


def read_back_check(written: DataFrame, read_back: DataFrame) -> DataFrame:
    """K2: compare what was written with what the database returns, as a
    one-row report (n_written, n_read, n_missing, n_extra).

    Both sides meet in one aggregation per distinct row, +1 for a written and -1
    for a read one, so each of them is read once."""
    cols = written.columns
    both = written.select(*cols, F.lit(1).alias("_w"), F.lit(0).alias("_r")).unionByName(
        read_back.select(*cols, F.lit(0).alias("_w"), F.lit(1).alias("_r"))
    )
    per_row = both.groupBy(*cols).agg(F.sum("_w").alias("_w"), F.sum("_r").alias("_r"))
    gap, zero = F.col("_w") - F.col("_r"), F.lit(0).cast("bigint")
    return per_row.agg(
        F.coalesce(F.sum("_w"), zero).alias("n_written"),
        F.coalesce(F.sum("_r"), zero).alias("n_read"),
        F.coalesce(F.sum(F.greatest(gap, zero)), zero).alias("n_missing"),
        F.coalesce(F.sum(F.greatest(-gap, zero)), zero).alias("n_extra"),
    )


def _connection(spark: SparkSession, conn: JdbcConnection):
    """A driver-side connection; the caller closes it."""
    jvm = spark.sparkContext._jvm
    if conn.driver:
        jvm.java.lang.Class.forName(conn.driver)
    props = jvm.java.util.Properties()
    for k, v in conn.options().items():
        if k not in ("url", "driver"):
            props.setProperty(k, str(v))
    return jvm.java.sql.DriverManager.getConnection(conn.url, props)


def table_exists(spark: SparkSession, conn: JdbcConnection, table: str) -> bool:
    """Whether the database lists the table, as spelled or in upper case."""
    c = _connection(spark, conn)
    try:
        return any(c.getMetaData().getTables(None, None, name, None).next() for name in {table, table.upper()})
    finally:
        c.close()


def execute_ddl(spark: SparkSession, conn: JdbcConnection, statements: list[str]) -> None:
    """Run DDL statements on the database from the driver (one connection)."""
    c = _connection(spark, conn)
    try:
        st = c.createStatement()
        for sql in statements:
            st.execute(sql)
        st.close()
    finally:
        c.close()


def publish_table(
    df: DataFrame,
    conn: JdbcConnection,
    table: str,
    rename_sql: str = "RENAME TABLE {src} TO {dst}",
    drop_sql: str = "DROP TABLE {name}",
    **write_options,
) -> None:
    """K1 without half-written tables: write into ``<table>_STAGING``, move the
    published table to ``<table>_BACKUP``, move the new one in, drop the backup.

    Each Spark write task commits its own transaction, so a job that fails
    half-way has committed some partitions only; with staging, that partial
    result never replaces the published table.  Nothing published is dropped
    before its successor is in place: if moving that in fails, the backup is
    moved back and the error raised.  Existing tables are looked up, so no error
    of the database is taken for a missing table.  ``rename_sql`` follows the
    database's dialect (``ALTER TABLE {src} RENAME TO {dst}`` on PostgreSQL).
    """
    spark, staging, backup = df.sparkSession, f"{table}_STAGING", f"{table}_BACKUP"
    published = table_exists(spark, conn, table)
    if table_exists(spark, conn, backup):
        if published:  # left over from a run that ended before its last step
            execute_ddl(spark, conn, [drop_sql.format(name=backup)])
        else:  # from one that ended between the two moves
            execute_ddl(spark, conn, [rename_sql.format(src=backup, dst=table)])
            published = True
    if table_exists(spark, conn, staging):
        execute_ddl(spark, conn, [drop_sql.format(name=staging)])
    write_table(df, conn, staging, mode="overwrite", truncate=False, **write_options)
    if published:
        execute_ddl(spark, conn, [rename_sql.format(src=table, dst=backup)])
    try:
        execute_ddl(spark, conn, [rename_sql.format(src=staging, dst=table)])
    except Exception:
        if published:
            execute_ddl(spark, conn, [rename_sql.format(src=backup, dst=table)])
        raise
    if published:
        execute_ddl(spark, conn, [drop_sql.format(name=backup)])
