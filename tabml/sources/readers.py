"""Sources: files by extension, all-text tables, tables of the catalog, JDBC."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions.scalars import safe_timestamp


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header row. Naming the schema saves the pass that infers it."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.csv(path, inferSchema=True)


def read_file(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet or CSV by extension; any other name is tried as parquet, then as CSV."""
    low = path.lower().rstrip("/")
    if low.endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    if low.endswith(".csv"):
        return read_csv(spark, path, schema)
    try:
        df = spark.read.parquet(path)
        df.schema  # the footers are read here, so a wrong guess shows now
        return df
    except Exception as problem:
        if isinstance(problem, AnalysisException) and problem.getCondition() == "PATH_NOT_FOUND":
            raise
        return read_csv(spark, path, schema)


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table with every column as text, the way a text-only query service returns it."""
    return spark.read.option("header", True).csv(path)


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns by name; values that do not parse become NULL."""
    return df.select(
        *[
            F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def with_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Named text columns parsed as timestamps; what doesn't parse is NULL, unknown names are ignored."""
    return df.withColumns({c: safe_timestamp(F.col(f"`{c}`")) for c in columns if c in df.columns})


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    split_column: str,
    bounds: tuple[int, int],
    partitions: int = 32,
    **options: str,
) -> DataFrame:
    """A warehouse query, fetched by many connections, each a range of the split column."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    low, high = bounds
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", split_column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(partitions))
        .load()
    )


def load_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """One entry for all sources: ``file``, ``text``, ``table``, ``sql`` or ``jdbc``."""
    if kind == "file":
        return read_file(spark, options["path"], options.get("schema"))
    if kind == "text":
        return read_text_table(spark, options["path"])
    if kind == "table":
        return spark.table(options["name"])
    if kind == "sql":
        return spark.sql(options["query"])
    if kind == "jdbc":
        return read_jdbc(spark, **options)
    raise ValueError(f"unknown source {kind!r}")


def default_source(settings: dict[str, str]) -> str:
    """The JDBC warehouse if one is configured, else tables of the session's catalog."""
    return "jdbc" if settings.get("jdbc_url") else "sql"
