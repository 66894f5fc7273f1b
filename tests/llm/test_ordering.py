import random

from pyspark.sql import functions as F

from quarrylane.llm.ordering import successors
from quarrylane.llm.shared import components


def test_successors_are_global(spark):
    keys = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(7)
    found = {r.k: r.next.k for r in successors(df, [F.col("k").desc()], ["k"]).collect()}
    ordered = sorted(keys, reverse=True)
    assert found == {a: b for a, b in zip(ordered, ordered[1:] + ordered[:1], strict=True)}
    assert [r.next.k for r in successors(df.limit(1), [F.col("k")], ["k"]).collect()] == [df.limit(1).first().k]
    assert successors(df.limit(0), [F.col("k")], ["k"]).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (None, 7), (2001, 2000), (2000, 2001)]
    found = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert all(found[i] == 0 for i in range(301)) and all(found[i] == 1000 for i in range(1000, 1200))
    assert found[2001] == found[2000] == 2000 and len(found) == 301 + 200 + 2
