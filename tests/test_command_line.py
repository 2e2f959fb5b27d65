import pytest

from clusterprep.__main__ import _target, main, parsed
from clusterprep.session import fresh_path
from clusterprep.sinks.tables import (
    METRICS_TABLE,
    PREDICTIONS_TABLE,
    CatalogTarget,
    JdbcTarget,
    ParquetTarget,
)


def test_cluster(spark, sf_dir, capsys):
    out = fresh_path(spark, "out")
    main(["cluster", f"{sf_dir}/lineitem.parquet", out, "--k", "3", "--target-rows", "500", "--text",
          "--exclude", "l_orderkey", "l_partkey", "l_suppkey"])
    printed = capsys.readouterr().out
    assert "rows: 500 of 6000" in printed and "l_orderkey" not in printed
    predictions = ParquetTarget(out).read(spark, PREDICTIONS_TABLE)
    assert predictions.count() == 500 and {kind for _, kind in predictions.dtypes} == {"string"}
    score = float(ParquetTarget(out).read(spark, METRICS_TABLE).first().value)
    assert f"silhouette: {score:.4f}" in printed


def test_sample(spark, sf_dir):
    out = fresh_path(spark, "copy")
    main(["sample", f"{sf_dir}/orders.parquet", out, "70"])
    assert spark.read.parquet(out).count() == 70


def test_words(spark, tmp_path):
    (tmp_path / "t.txt").write_text("b a\na")
    out = fresh_path(spark, "words")
    main(["words", str(tmp_path / "t.txt"), out])
    assert [tuple(r) for r in spark.read.parquet(out).orderBy("word").collect()] == [("a", 2), ("b", 1)]


def test_unknown_strategy_is_refused():
    with pytest.raises(SystemExit):
        main(["cluster", "in", "out", "--imputer-strategy", "max"])


def test_parameters_from_a_file(tmp_path):
    file = tmp_path / "job.json"
    file.write_text('{"k": 5, "target_rows": 70, "exclude": ["id"]}')
    args = parsed(["cluster", "in", "out", "--config", str(file), "--k", "4"])
    assert (args.k, args.target_rows, args.exclude, args.seed) == (4, 70, ["id"], 42)
    file.write_text('{"clusters": 5}')
    with pytest.raises(SystemExit):
        parsed(["cluster", "in", "out", "--config", str(file)])


def test_all_rows_by_default():
    assert parsed(["cluster", "in", "out"]).target_rows is None


def test_targets(tmp_path):
    file = tmp_path / "login.json"
    file.write_text('{"user": "u"}')
    assert _target(parsed(["cluster", "in", "out"])) == ParquetTarget("out")
    assert _target(parsed(["cluster", "in", "db", "--catalog"])) == CatalogTarget("db")
    args = parsed(["cluster", "in", "jdbc:x", "--jdbc", "--jdbc-properties", str(file)])
    assert _target(args) == JdbcTarget("jdbc:x", {"user": "u"})
