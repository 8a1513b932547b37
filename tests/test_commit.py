"""Transactions and ids that last: all or nothing, equal reruns, numbers that stay."""

import os

import pytest
from pyspark.sql import functions as F

from vialstream.operators import persist
from vialstream.plans import build
from vialstream.sources import commit


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def files_below(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


def rows(spark, n=1000):
    return spark.range(0, n, 1, 4).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("t"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("x"), F.array("id").alias("a"))


def killed(batches):
    """Kills the Python worker of one task after it has written some rows."""
    for k, b in enumerate(batches):
        yield b
        if b.column(0)[0].as_py() >= 500 or k:
            os.kill(os.getpid(), 9)


def test_a_killed_task_leaves_nothing(spark, root):
    with pytest.raises(Exception, match="(?i)worker|crash|python|exit"), commit.Transaction(spark, root) as t:
        t.write("whole", rows(spark))
        t.write("broken", rows(spark).mapInArrow(killed, rows(spark).schema))
    assert commit.versions(root) == [] and files_below(root) == []
    with pytest.raises(FileNotFoundError):
        commit.read(spark, root, "whole")


def test_a_failed_version_leaves_the_last_one(spark, root):
    build.write({"a": rows(spark, 10)}, root)
    before = files_below(root)
    bad = rows(spark).withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        build.write({"a": rows(spark, 20), "b": bad}, root)
    assert files_below(root) == before and commit.read(spark, root, "a").count() == 10


def test_reruns_give_equal_files(spark, root):
    for _ in range(2):
        build.write({"a": rows(spark), "none": rows(spark, 0)}, root)
        build.write_sql({"b": rows(spark, 50).select("id", "t", "x")}, root + "-sql")
    first, second = map(commit.contents, commit.versions(root))
    assert first == second and sum(n for _, n, _ in first["a"]) == 1000 and [n for _, n, _ in first["none"]] == [0]
    first, second = map(commit.contents, commit.versions(root + "-sql"))
    assert first == second
    folder = commit.versions(root + "-sql")[-1] + "/b"
    lines = "".join(open(f"{folder}/{name}").read() for name, *_ in commit.contents(commit.versions(root + "-sql")[-1])["b"]).splitlines()
    assert sorted(lines) == sorted(r["value"] for r in commit.read(spark, root + "-sql", "b").collect())
    assert lines[0].startswith("SET ") and lines[-1] == "COMMIT;" and len(lines) == 52 and "NULL" in lines[1]
    got = commit.read(spark, root, "a")
    assert got.dtypes == rows(spark).dtypes and got.exceptAll(rows(spark)).isEmpty() and got.count() == 1000
    assert commit.read(spark, root, "none").collect() == []


def test_of_two_transactions_one_wins(spark, root):
    a, b = commit.Transaction(spark, root), commit.Transaction(spark, root)
    a.write("t", rows(spark, 1))
    b.write("t", rows(spark, 2))
    b.commit()
    with pytest.raises(commit.Conflict):
        a.commit()
    a.abort()
    assert commit.read(spark, root, "t").count() == 2
    assert not any("_staging" in f for f in files_below(root))
    lost = commit.Transaction(spark, root)
    lost.write("t", rows(spark, 3))
    commit.sweep(root)
    assert commit.read(spark, root, "t").count() == 2
    with pytest.raises(RuntimeError, match="not prepared"):
        lost.commit()


def test_text_takes_one_string_column(spark, root):
    with pytest.raises(Exception, match="one string column"), commit.Transaction(spark, root) as t:
        t.write("t", rows(spark), "text")
    with commit.Transaction(spark, root) as t:
        t.write("t", spark.createDataFrame([("a",), (None,), ("é|'",)], "value string").coalesce(1), "text")
        with pytest.raises(ValueError, match="already"):
            t.write("t", rows(spark))
    assert [r[0] for r in commit.read(spark, root, "t").collect()] == ["a", "", "é|'"]


def test_ids_last(spark, root):
    make = lambda *k: spark.createDataFrame([(x, y) for x, y in k], "a string, b int")
    ids = lambda df: {(r["a"], r["b"]): r["id"] for r in persist.durable_ids(df, ["a", "b"], "id", root).collect()}
    one = ids(make(("m", 1), ("c", 2), (None, 3)))
    assert one == {(None, 3): 100, ("c", 2): 101, ("m", 1): 102}
    two = ids(make(("a", 1), ("m", 1), (None, 3), (None, None)))
    assert {k: two[k] for k in ((None, 3), ("m", 1))} == {(None, 3): 100, ("m", 1): 102}
    assert {two[("a", 1)], two[(None, None)]} == {103, 104}
    versions = commit.versions(root)
    assert ids(make(("c", 2), ("a", 1), ("a", 1))) == {("c", 2): 101, ("a", 1): two[("a", 1)]}
    assert commit.versions(root) == versions  # nothing new, nothing written
    assert persist.durable_ids(make(), ["a", "b"], "id", root).collect() == []


def test_ids_of_two_builds_at_once(spark, root, monkeypatch):
    """A build that finds its version taken reads the other's numbers and tries again."""
    other = spark.createDataFrame([("x",)], "a string")
    inner, state = commit.Transaction.commit, {"first": True}

    def late(self):
        if state.pop("first", None):
            persist.durable_ids(other, ["a"], "id", root)
        return inner(self)

    monkeypatch.setattr(commit.Transaction, "commit", late)
    got = {r["a"]: r["id"] for r in persist.durable_ids(spark.createDataFrame([("x",), ("y",)], "a string"), ["a"], "id", root).collect()}
    assert got == {"x": 100, "y": 101}


def test_products_keep_their_least_number(spark, root):
    none = spark.createDataFrame([], "guid string, substance_id long")
    ids = lambda *p: {r["product"]: r["id"] for r in persist.durable_product_ids(spark.createDataFrame(list(p), "product string, guid string"), none, root).collect()}
    assert ids(("p", "g1"), ("p", "g2"), ("q", "g3")) == {"p": 100, "q": 101}
    # p parts: its number stays with its least label; a product of new labels comes after
    assert ids(("p", "g1"), ("q", "g2"), ("q", "g3"), ("q", "g9"), ("r", "g0")) == {"p": 100, "q": 101, "r": 102}
    again = ids(("q", "g3"), ("r", "g0"))
    assert again["q"] == 101 and again["r"] == 102


def test_tables_keep_their_ids(spark, root):
    atoms = spark.createDataFrame([("A1", "C1", "10", "10", "rash", "PT", "MDR")], "aui string, cui string, code string, pt_code string, term string, tty string, sab string")
    more = atoms.unionByName(spark.createDataFrame([("A0", "C0", "01", "01", "ache", "PT", "MDR")], atoms.schema))
    e = spark.createDataFrame([("g1", "AE", "exact", "A1", None, ["g1"])], "product string, section string, match string, aui string, first_added date, sources array<string>")
    winners = spark.createDataFrame([("g1", "g1"), ("g2", "g1")], "guid string, winner string")
    first = {r["aui"]: r["id"] for r in build.tables(e, atoms, winners, ids=root)["meddra"].collect()}
    later = build.tables(e, more, spark.createDataFrame([("g0", "g0"), ("g2", "g2")], winners.schema), ids=root)
    assert first == {"A1": 100} and {r["aui"]: r["id"] for r in later["meddra"].collect()} == {"A1": 100, "A0": 101}
    assert {r["product"]: r["id"] for r in persist.durable_product_ids(spark.createDataFrame([("g2", "g2"), ("g0", "g0")], "product string, guid string"), spark.createDataFrame([], "guid string, substance_id long"), f"{root}/substance").collect()} == {"g2": 100, "g0": 101}
