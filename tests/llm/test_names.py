"""Document columns whose names clash with those inside the operators."""

from pyspark.sql import functions as F

from mapledger.llm import alignment, count_trees, pair_index, quality
from tests.llm import cases


def _odd(spark):
    own = cases.documents(spark, [(i, f"plain text number {i}") for i in range(12)])
    return own.withColumns({"_posteriors": F.lit(7), "posteriors": F.lit(8), "own": F.lit("o"), "n_tokens": F.lit(9), "a.b": F.lit("dot")})


def test_the_quality_stage_returns_the_columns_it_got(spark):
    documents = _odd(spark)
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    kept = quality.accepted(documents, labels)
    assert kept.columns == documents.columns
    rows = kept.collect()
    assert rows and all((r["_posteriors"], r["posteriors"], r["own"], r["a.b"]) == (7, 8, "o", "dot") for r in rows)


def test_trees_replace_columns_of_their_names(spark):
    trees = count_trees.with_trees(_odd(spark))
    assert trees.columns.count("tree") == trees.columns.count("n_tokens") == 1
    assert trees.select("tree", "n_tokens", "`a.b`").where("n_tokens = 9").count() == 0


def test_other_columns_stay(spark):
    documents = _odd(spark)
    assert set(pair_index.encoded(documents).columns) == {*documents.columns, "ids", "decoded"}
    assert set(alignment.aligned(documents).columns) == {*documents.columns, "tokens_a", "groups_a", "tokens_b", "groups_b"}
    assert pair_index.encoded(documents).select("`a.b`").first()[0] == "dot"
