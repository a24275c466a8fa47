import os
from unittest.mock import MagicMock

import pytest
from pyspark.sql import types as T

from tillbook.sources import jdbc
from tillbook.sources.tables import (
    SchemaChangedError, new_version, publish, read_staged, remove_old_versions, shared_root, stage,
)


def session(master, folder=None):
    conf = {"spark.master": master, "spark.checkpoint.dir": folder}
    spark = MagicMock()
    spark.sparkContext.applicationId = "app-1"
    spark.conf.get = lambda key, default=None: conf.get(key) or default
    return spark


def test_shared_folder_is_the_clusters():
    assert shared_root(session("spark://x", "hdfs:///ck")) == "hdfs:///ck/tillbook/app-1"
    assert shared_root(session("local[2]", "/ck")) == "/ck/tillbook/app-1"


def test_only_a_local_session_gets_a_local_folder():
    first = shared_root(session("local[2]"))
    assert os.path.isdir(first) and shared_root(session("local[2]")) == first
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(session("yarn"))


def test_publish_moves_a_table_to_the_new_version(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    root = str(tmp_path / "it's here")
    for n in (3, 5):
        path = stage(spark.range(n), root, "numbers")
        publish(spark, "numbers_published", path, schema)
        assert spark.table("numbers_published").count() == n
    assert read_staged(spark, path, schema).count() == 5
    assert len(os.listdir(f"{root}/numbers")) == 2


def test_publish_does_not_take_another_schema_silently(spark, tmp_path):
    old, new = (T.StructType([T.StructField(n, T.LongType())]) for n in ("id", "number"))
    first, second = stage(spark.range(3), str(tmp_path), "t"), stage(spark.range(5).toDF("number"), str(tmp_path), "t")
    publish(spark, "changing", first, old)
    with pytest.raises(SchemaChangedError, match="id.*number"):
        publish(spark, "changing", second, new)
    assert spark.table("changing").count() == 3
    publish(spark, "changing", second, new, replace_definition=True)
    assert sorted(r.number for r in spark.table("changing").collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(SchemaChangedError):
        publish(spark, "changing", second, T.StructType([T.StructField("number", T.StringType())]))


def test_old_versions_go(spark, tmp_path):
    versions = [new_version() for _ in range(4)]
    for v in versions:
        stage(spark.range(1), str(tmp_path), "t", version=v)
    os.mkdir(tmp_path / "t" / "something else")
    assert remove_old_versions(spark, str(tmp_path), "t", versions[2], 2) == versions[:1]
    assert sorted(os.listdir(tmp_path / "t")) == sorted([*versions[1:], "something else"])
    with pytest.raises(ValueError):
        remove_old_versions(spark, str(tmp_path), "t", versions[2], 0)


def test_jdbc_read_and_write_are_parallel():
    connection = jdbc.connection_options("jdbc:postgresql://h/db", "sales", "u", "p@:/")
    assert connection["password"] == "p@:/"
    assert "user" not in jdbc.connection_options("jdbc:x", "t")
    spark, df = MagicMock(), MagicMock()
    jdbc.read_table(spark, connection, "date", "2019-01-01", "2020-01-01", 12)
    reader = spark.read.format("jdbc").options(**connection)
    spark.read.format.assert_called_with("jdbc")
    reader.option.assert_called_with("partitionColumn", "date")
    jdbc.replace_table(df, connection, 8)
    df.write.format.assert_called_with("jdbc")
    df.write.format("jdbc").options(**connection).option.assert_called_with("truncate", True)
