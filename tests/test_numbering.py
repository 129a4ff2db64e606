import random

from pyspark.sql import functions as F

from topicgraph.functions.numbering import numbered


def test_numbers_in_order(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), rnd.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(7)
    got = {r.i: r.number for r in numbered(df, ["x", F.desc("i")]).collect()}
    order = sorted(rows, key=lambda r: (r[1], -r[2]))
    assert got == {r[2]: k for k, r in enumerate(order)}
    got = {r.i: r.place for r in numbered(df, [F.desc("x"), "i"], "place", by=("g",)).collect()}
    for g in "ab":
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[r[2]] for r in order] == list(range(len(order)))
    assert numbered(df.limit(0), ["x"]).columns == ["g", "x", "i", "number"] and numbered(df.limit(0), ["x"]).count() == 0
