from pyspark.sql import functions as F

from ferry.operators import keys as K
from ferry.operators.sampling import sample_rows, sample_size


def test_sample_size_rule():
    assert [sample_size(n) for n in (50, 5000, 20_000_000)] == [50, 500, 1_000_000]
    assert sample_size(100, 1, 10, 50_000) == 100


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumn("k", F.col("id").cast("string"))
    a = sorted(r["k"] for r in sample_rows(df, ["k"], 123).collect())
    b = sorted(r["k"] for r in sample_rows(df.repartition(7), ["k"], 123).collect())
    assert len(a) == 123 and a == b


def test_pk_unique_fk(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, None), (None, None)], "a int, b int")
    pk = {(r["a"], r["b"], r["violation"]) for r in K.pk_violations(df, ["a", "b"]).collect()}
    assert pk == {(1, 1, "DUPLICATE"), (2, None, "NULL_KEY"), (None, None, "NULL_KEY")}
    uq = {(r["a"], r["b"]) for r in K.unique_violations(df, ["a", "b"]).collect()}
    assert uq == {(1, 1)}                                # all-NULL keys may repeat
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    orphans = {(r["p"], r["orphan_rows"]) for r in K.fk_orphans(child, "p", parent, "id").collect()}
    assert orphans == {(5, 2)}


def test_jdbc_options_partitioned_read():
    from ferry.sources.readers import jdbc_options, qualified_name
    cfg = {"source_table": "Orders", "source_schema": None}
    src = {"url": "jdbc:x://h/db", "properties": {"user": "u"}, "partition_column": "ID",
           "lower_bound": 1, "upper_bound": 1000, "num_partitions": 8}
    o = jdbc_options(src, qualified_name(cfg))
    assert o["dbtable"] == "dbo.Orders" and o["partitionColumn"] == "ID" and o["numPartitions"] == "8"
    assert o["user"] == "u" and o["lowerBound"] == "1"
