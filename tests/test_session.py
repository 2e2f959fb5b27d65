from types import SimpleNamespace

import pytest

from clusterprep.session import (
    checkpointed,
    cut_lineage,
    fresh_path,
    read_written,
    scratch,
    shared_folder,
    write_parts,
)


def session(master, warehouse, **conf):
    values = {"spark.master": master, "spark.sql.warehouse.dir": warehouse, **conf}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, *default: values.get(name, *default)))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(master, "file:/home/me/spark-warehouse"))
    assert shared_folder(session(master, "hdfs://names/wh")) == "hdfs://names/wh/_clusterprep"
    named = session(master, "file:/x", **{"spark.checkpoint.dir": "file:///mounted/"})
    assert shared_folder(named) == "file:///mounted"


def test_local_master_has_a_folder_of_its_own():
    local = session("local[4]", "file:/x")
    assert "clusterprep-" in shared_folder(local) and shared_folder(local) == shared_folder(local)


def test_scratch_deletes_what_it_wrote_and_nothing_else(spark):
    kept = cut_lineage(spark.range(5), "kept")
    with scratch(spark):
        gone = cut_lineage(spark.range(7), "gone")
        assert gone.count() == 7
    assert kept.count() == 5
    with pytest.raises(Exception, match="(?i)not.*exist|FAILED_READ_FILE|PATH_NOT_FOUND"):
        spark.read.parquet(gone._clusterprep_path).count()


def test_checkpoint_keeps_partitions_and_order(spark):
    rows = spark.range(0, 100, 1, 7).repartition(5, "id").sortWithinPartitions("id")
    before = rows.rdd.glom().collect()
    kept = checkpointed(rows)
    assert kept.rdd.glom().collect() == before


def test_parts_are_written_by_a_column(spark):
    rows = spark.range(100).selectExpr("id", "CAST(id % 3 AS INT) AS part")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    path = fresh_path(spark, "parts")
    write_parts(rows, path, "part")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    one = read_written(spark, path, rows.select("id").schema, ("part", 1))
    assert sorted(r["id"] for r in one.collect()) == list(range(1, 100, 3))
