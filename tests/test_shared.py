"""How long working tables live."""

import gc
import time

from pyspark.sql import functions as F

from loomwork import shared
from loomwork.operators import ordered, ranks, setjoin, similarity


def tables(spark):
    found, system = shared.hadoop_path(spark, shared.shared_folder(spark))
    return {f.getPath().getName() for f in system.listStatus(found) if f.getPath().getName().startswith(shared.TABLE)}


def swept(spark, before, tries=20):
    """What is left of the tables made since, once garbage has been collected."""
    for _ in range(tries):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)
        shared.sweep(spark)
        if not tables(spark) - before:
            break
    return tables(spark) - before


def test_a_table_lives_as_long_as_what_is_derived_from_it(spark):
    shared.shared_folder(spark)
    before = tables(spark)
    table = shared.cut_lineage(spark.range(100).withColumn("x", F.col("id") % 7))
    derived = table.where("x = 3").groupBy("x").count()
    again = derived.join(spark.range(10), derived["x"] == F.col("id"))
    del table, derived
    assert len(swept(spark, before, 3)) == 1
    assert [r["count"] for r in again.collect()] == [14]
    del again
    assert swept(spark, before) == set()


def test_operators_leave_no_table(spark):
    shared.shared_folder(spark)
    before = tables(spark)
    rows = spark.createDataFrame([(i % 3, i, float(i) if i % 4 else None) for i in range(60)], "k int, t int, v double")
    docs = spark.createDataFrame([(i, f"a b c d e f g{i % 4} h{i % 5}", ["t"]) for i in range(30)], "doc_id int, body string, topics array<string>")
    assert ordered.interpolate(rows, "v", ["t"], ["k"]).count() == 60
    assert ordered.lag_diff(rows, ["v"], ["k"], ["t"]).count() == 60
    assert ranks.medians(rows, "k", ["v"]).count() == 3
    shingled = similarity.shingles(docs)
    groups = shared.cut_lineage(similarity.signature_groups(similarity.minhash(shingled, 20)))
    assert similarity.pair_metrics(groups, similarity.group_pairs(groups, 20, 5), docs).count() == 1
    assert setjoin.similar_sets(setjoin.set_classes(shingled)).count() >= 0
    assert tables(spark) - before
    del groups
    assert swept(spark, before) == set()
