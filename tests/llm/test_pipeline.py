import pytest

import __spark_entry__ as driver
import corpus_pipeline
from clusterprep.llm import queries
from tests.llm.test_order_minhash import classes
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, duck, name):
    assert difference(queries.queries()[name](spark, SF_DIR), duck, queries.oracle_sql()[name]) is None


def test_all_operators_are_registered():
    names = [n.split("_")[0] for n in driver.queries() if n.startswith("op")]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{n}" for n in range(1, 14)]
    assert "pipeline" in driver.queries()


def test_stages(spark):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    scores = {r["doc_id"]: r["predicted"] for r in queries.op1_quality(spark, SF_DIR).collect()}
    good = corpus_pipeline.good_quality(spark, docs, SF_DIR)
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == {i for i, p in scores.items() if p == 1}

    apart = corpus_pipeline.without_copies(spark, docs, SF_DIR)
    assert apart.columns == docs.columns
    bare = {}
    for i in sorted(texts):
        bare.setdefault("".join(c for c in texts[i] if c not in " \t\n\x0b\x0c\r"), []).append(i)
    best = {max(ids, key=lambda i: (len(texts[i]), -i)) for ids in bare.values()}
    assert {r["doc_id"] for r in apart.collect()} == best

    some = docs.filter("doc_id < 150")
    near = corpus_pipeline.without_near_copies(spark, some, SF_DIR)
    ids = sorted(i for i in texts if i < 150)
    roots = classes([texts[i] for i in ids])
    assert {r["doc_id"] for r in near.collect()} == {ids[r] for r in set(roots)}

    from tests.llm.test_winnowing import brute

    clean = corpus_pipeline.without_benchmark(spark, some, SF_DIR)
    expected = {i for i in ids if not brute(texts[i], list(enumerate(items)))[1]}
    assert {r["doc_id"] for r in clean.collect()} == expected


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    pieces = rows.collect()
    assert pieces and len({(r["doc_id"], r["piece"]) for r in pieces}) == len(pieces)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
    assert corpus_pipeline.packed(spark, docs, SF_DIR).count() == 0
