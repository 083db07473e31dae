"""Python workers outlive their tasks: what an operator keeps there goes when another one runs."""
from feedlens.llm import bpe, common


def test_a_worker_lets_go_of_the_vocabulary_when_another_operator_runs(spark):
    def count(texts):
        import gc
        return [[sum(type(x).__name__ == "Bpe" for x in gc.get_objects())] * len(texts)]

    docs = spark.range(64).selectExpr("id AS doc_id", "concat('text number ', id) AS text").repartition(8)
    assert bpe.encode(docs, *bpe.public_vocabulary()).selectExpr("min(_n_tokens) AS n").first().n > 0
    held = common.annotate(docs, count, "held long").selectExpr("max(held) AS held").first().held
    assert held == 0


def test_a_worker_keeps_the_vocabulary_between_tasks_of_its_operator():
    mine = common.kept("an operator")
    mine["x"] = 1
    assert list(common.sliced(iter([]), "an operator")) == [] and mine == {"x": 1} and common.kept("an operator") is mine
    assert list(common.sliced(iter([]))) == [] and mine == {}
