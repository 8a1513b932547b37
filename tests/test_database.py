"""Reads from a file database in ranges of equal size, and again after failures."""

import random

import pytest
from pyspark.sql import functions as F

from vialstream.sources import tabular


def filled(spark, url, table, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.jdbc(url, table, "overwrite", {"driver": DRIVER})


DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.fixture(scope="module")
def url(spark, tmp_path_factory):
    return f"jdbc:derby:{tmp_path_factory.mktemp('db')}/d;create=true"


def test_skewed_keys_give_equal_parts(spark, url):
    r = random.Random(3)
    rows = [(int(1000 * r.paretovariate(0.7)) if k % 50 else None, k, f"n{k}") for k in range(4000)]
    filled(spark, url, "MEDS", rows, "K long, ID int, NAME string")
    df = tabular.jdbc_table(spark, url, "MEDS", "K", parts=8, driver=DRIVER)
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert df.rdd.getNumPartitions() == 8 and sum(sizes) == 4000 and max(sizes) < 1.3 * 4000 / 8
    assert {tuple(x) for x in df.collect()} == set(rows)
    # the range of an even split would hold nearly all rows
    plain = spark.read.jdbc(url, "MEDS", column="K", lowerBound=1000, upperBound=max(k for k, *_ in rows if k), numPartitions=8, properties={"driver": DRIVER})
    assert max(r["n"] for r in plain.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()) > 3000
    plan = df.filter("ID > 5").select("NAME")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(ID,5)" in plan


def test_one_key_no_keys_and_no_rows(spark, url):
    for name, rows in (("ONE", [(7, k) for k in range(50)]), ("NUL", [(None, k) for k in range(50)]), ("NON", [])):
        filled(spark, url, name, rows, "K int, ID int")
        assert tabular.jdbc_table(spark, url, name, "K", parts=4, driver=DRIVER).count() == len(rows)
    assert tabular.jdbc_table(spark, url, "ONE", driver=DRIVER).count() == 50
    filled(spark, url, "DBL", [(k / 7, k) for k in range(100)], "K double, ID int")
    df = tabular.jdbc_table(spark, url, "DBL", "K", parts=4, driver=DRIVER)
    assert df.count() == 100 and df.rdd.getNumPartitions() == 4


def test_failures_are_tried_again():
    waits, left = [], [OSError("a"), OSError("b")]

    def act():
        if left:
            raise left.pop(0)
        return 5

    assert tabular.retried(act, 4, 0.5, waits.append) == 5 and waits == [0.5, 1.0]
    left[:] = [OSError(str(k)) for k in range(9)]
    with pytest.raises(OSError, match="2"):
        tabular.retried(act, 3, 1, waits.append)
