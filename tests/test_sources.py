import pytest
from pyspark.sql import functions as F

from tabml.session import bounded_rows, new_path, staged
from tabml.sources import readers, writers


def test_unknown_extension(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    plain, table = new_path(spark, "x"), new_path(spark, "y")
    writers.write_csv(df, plain)
    df.write.parquet(table)
    assert readers.read_file(spark, plain).filter("n = 2 and s is null").count() == 1
    assert readers.read_file(spark, table).schema == df.schema
    with pytest.raises(Exception):
        readers.read_file(spark, new_path(spark, "missing"))


def test_dataset_is_never_overwritten(spark):
    base = new_path(spark, "base")
    df = spark.range(3)
    path = writers.write_dataset(df, base, "20240101T000000Z")
    assert path.endswith("/datasets/20240101T000000Z")
    with pytest.raises(Exception):
        writers.write_dataset(df, base, "20240101T000000Z")
    assert writers.manifest(df).first()["columns"] == "id"


def test_reading_one_split_skips_the_others(spark):
    path = new_path(spark, "splits")
    rows = spark.range(10).withColumn("split", F.when(F.col("id") < 6, "train").otherwise("test"))
    writers.write_splits(rows, path)
    train = writers.read_split(spark, path, "train")
    assert train.columns == ["id"] and train.count() == 6
    assert "PartitionFilters: [isnotnull" in train._jdf.queryExecution().toString()


def test_text_table_and_types(spark):
    path = new_path(spark, "text")
    writers.write_csv(spark.createDataFrame([("1", "2024-01-02"), ("x", "bad")], "a string, d string"), path)
    raw = readers.load_source(spark, "text", path=path)
    assert {t for _, t in raw.dtypes} == {"string"}
    got = readers.typed(raw, {"a": "int", "d": "date"}).filter("a is null and d is null")
    assert got.count() == 1


def test_plan_round_trip(spark):
    path = new_path(spark, "plan")
    columns = spark.createDataFrame([("a", "onehot")], "column string, encoder string")
    writers.write_plan(columns, {"seed": 42}, path)
    again, options = writers.read_plan(spark, path)
    assert options == {"seed": 42} and again.collect() == columns.collect()


def test_sources_by_name(spark):
    assert readers.default_source({"jdbc_url": "jdbc:x"}) == "jdbc"
    assert readers.load_source(spark, "sql", query="select 1 as a").first()["a"] == 1
    with pytest.raises(ValueError):
        readers.load_source(spark, "other")


def test_bounds_and_stage(spark):
    assert len(bounded_rows(spark.range(5), 5, "rows")) == 5
    with pytest.raises(ValueError):
        bounded_rows(spark.range(6), 5, "rows")
    assert staged(spark.range(4)).inputFiles()
