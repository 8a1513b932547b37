import datetime as dt
import random

from pyspark.sql import functions as F

from vialstream.operators import events, merge, persist, products, terminology, training

D = dt.date
EVENT = "product string, section string, match string, aui string, cui string, pt_key string, first_added date, term string"


def ev(spark, rows):
    return spark.createDataFrame([(*r, None)[: 8] if len(r) == 7 else r for r in rows], EVENT)


def test_earliest_date_and_sources(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 2), "s1"), ("a", None, "s2"), ("a", D(2019, 1, 1), "s1"), ("b", None, "s3")], "aui string, d date, source string")
    got = {r["aui"]: (r["first_added"], r["sources"]) for r in events.earliest(df, ["aui"]).collect()}
    assert got == {"a": (D(2019, 1, 1), ["s1", "s2"]), "b": (None, ["s3"])}


def test_reconcile(spark):
    rows = [("p", "AE", "exact", "a", "c1", "t1", D(2020, 1, 1)), ("p", "AE", "exact", "b", "c1", "t2", D(2018, 1, 1)), ("p", "AE", "exact", "c", None, "", D(2021, 1, 1)), ("p", "AE", "exact", "d", None, "", D(2010, 1, 1)), ("p", "BOX", "nlp", "a", "c1", "t1", None)]
    once = events.reconcile_bucket(ev(spark, rows), ["product", "section", "match"])
    got = {(r["section"], r["aui"]): r["first_added"] for r in once.collect()}
    assert got[("AE", "a")] == D(2018, 1, 1) and got[("AE", "c")] == D(2021, 1, 1) and got[("BOX", "a")] is None
    twice = events.reconcile_bucket(once, ["product", "section", "match"])
    assert {(r["section"], r["aui"]): r["first_added"] for r in twice.collect()} == got
    cross = {(r["section"], r["aui"]): r["first_added"] for r in events.reconcile_across(once).collect()}
    assert cross[("BOX", "a")] == D(2018, 1, 1)
    random.Random(1).shuffle(rows)
    again = {(r["section"], r["aui"]): r["first_added"] for r in events.reconcile_bucket(ev(spark, rows).repartition(3), ["product", "section", "match"]).collect()}
    assert again == got


def test_resolve(spark):
    rows = [("p", s, m, a, None, None, None) for s, m, a in [("IND", "exact", "1"), ("IND", "nlp", "1"), ("AE", "exact", "1"), ("IND", "nlp", "2"), ("BOX", "nlp", "2"), ("AE", "exact", "3"), ("AE", "nlp", "3"), ("BOX", "exact", "3")]]
    got = {(r["section"], r["match"], r["aui"]) for r in events.resolve(ev(spark, rows)).collect()}
    assert got == {("IND", "exact", "1"), ("IND", "nlp", "2"), ("AE", "exact", "3"), ("BOX", "exact", "3")}


def test_changes_windows_death(spark):
    e = spark.createDataFrame([("p", "a", D(2020, 1, 1), ["s"])], "product string, aui string, first_added date, sources array<string>")
    c = spark.createDataFrame([("p", "a", D(2019, 1, 1), "g"), ("p", "b", D(2021, 1, 1), "g")], "product string, aui string, first_added date, guid string")
    got = {r["aui"]: (r["first_added"], r["sources"]) for r in events.apply_changes(e, c, ["product", "aui"]).collect()}
    assert got == {"a": (D(2019, 1, 1), ["s"]), "b": (D(2021, 1, 1), ["g"])}
    rows = ev(spark, [("p", "IND", "exact", "1", None, None, None, "sudden Death"), ("p", "AE", "exact", "1", None, None, None, "death")])
    assert [r["section"] for r in events.without_death(rows).collect()] == ["AE"]
    w = ev(spark, [("p", "AE", "exact", "1", None, None, D(2020, 5, 1)), ("p", "BOX", "exact", "1", None, None, D(2019, 1, 1)), ("p", "AE", "exact", "2", None, None, D(2020, 1, 1)), ("p", "AE", "exact", "3", None, None, D(2020, 2, 1))])
    day = lambda y: F.lit(f"{y}-01-01").cast("date")
    assert [r["aui"] for r in events.new_in_window(w, "AE", "BOX", day(2020), day(2021)).collect()] == ["3"]


def test_components_and_keys(spark):
    rows = spark.createDataFrame([(k, [k, k + 1]) for k in range(0, 60)] + [(100, [500]), (101, [500]), (200, [])], "node int, keys array<int>")
    got = {r["node"]: r["root"] for r in merge.components(rows.select("node"), merge.key_edges(rows, "node", ["keys"])).collect()}
    assert all(got[k] == 0 for k in range(60)) and got[101] == 100 and got[200] == 200


def test_merge_order_does_not_matter(spark):
    base = {"source_type": 1, "copack": False, "parents": [], "ingredients": [], "ndas": [], "ndcs": []}
    rows = [{"guid": "a", "cuis": ["C1"], **base}, {"guid": "b", "cuis": ["C1"], **base}, {"guid": "c", "cuis": ["C1", "C2"], **base}, {"guid": "d", "cuis": ["C9"], **base}, {"guid": "e", "cuis": ["C1"], **base | {"source_type": 2}}, {"guid": "f", "cuis": ["C8"], **base | {"ndas": ["7"]}}, {"guid": "g", "cuis": ["C7"], **base | {"ndas": ["7"]}}]
    schema = "guid string, cuis array<string>, source_type int, copack boolean, parents array<string>, ingredients array<string>, ndas array<string>, ndcs array<string>"
    results = []
    for seed in (1, 2):
        r = rows[:]
        random.Random(seed).shuffle(r)
        df = spark.createDataFrame([tuple(x[k] for k in ("guid", "cuis", "source_type", "copack", "parents", "ingredients", "ndas", "ndcs")) for x in r], schema)
        results.append({x["guid"]: x["winner"] for x in merge.merge_products(df).collect()})
    assert results[0] == results[1]
    assert results[0]["a"] == results[0]["b"] == "c"  # a takes in b, and both join the group that holds their concept
    assert results[0]["e"] == "e" and results[0]["g"] == "f" and results[0]["d"] == "d"


def test_set_joins(spark):
    s = spark.createDataFrame([("x", ["1", "2"]), ("y", ["1"]), ("z", ["2", "1"])], "k string, items array<string>")
    assert {tuple(r) for r in merge.contains(s, "k", "items").collect()} == {("x", "y"), ("z", "y"), ("x", "z"), ("z", "x")}
    assert [tuple(r) for r in merge.equal_sets(s, "k", "items").collect()] == [("1|2", "x", 2)]


def test_ids_are_dense_and_stable(spark):
    df = spark.createDataFrame([(f"c{k:03}", "t", str(k)) for k in range(50)], "code string, term string, aui string")
    a = {r["aui"]: r["id"] for r in persist.terminology_table(df.repartition(7)).collect()}
    assert sorted(a.values()) == list(range(100, 150)) and a["0"] == 100 and a["49"] == 149
    prior = spark.createDataFrame([("g1", 500)], "guid string, substance_id int")
    p = spark.createDataFrame([("p1", "g1"), ("p2", "g2"), ("p3", "g0")], "product string, guid string")
    assert {r["product"]: r["id"] for r in persist.product_ids(p, prior).collect()} == {"p1": 500, "p3": 501, "p2": 502}


def test_ndc_table_orphans_lines(spark):
    r = spark.createDataFrame([("1", "b", "x"), ("1", "a", "y"), ("", "n", "z"), ("", "n", "z")], "ndc string, name string, aui string")
    assert sorted((x["ndc"], x["name"]) for x in persist.ndc_table(r).collect()) == [("", "n"), ("1", "a")]
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,)], "k int")
    assert [x["k"] for x in persist.orphans(a, "k", b, "k").collect()] == [2]
    line = persist.insert_lines(spark.createDataFrame([(1, "o'x", None)], "id int, t string, d date"), "T").first()[0]
    assert line == "INSERT INTO T (id, t, d) VALUES (1, 'o''x', NULL);"


def test_products(spark):
    rows = spark.createDataFrame([(1, "orig", " ap", D(2020, 1, 1)), (1, "ORIG", "AP", D(2019, 1, 1)), (1, "SUPPL", "AP", D(2000, 1, 1))], "appl_no int, submission_type string, status string, status_date date")
    assert [tuple(r) for r in products.first_approvals(rows).collect()] == [(1, D(2019, 1, 1))]
    labels = spark.createDataFrame([(1, None), (1, D(2021, 1, 1))], "appl_no int, label_date date")
    got = products.fill_approvals(labels, products.first_approvals(rows)).collect()
    assert sorted(r["label_date"] for r in got) == [D(2019, 1, 1), D(2021, 1, 1)]
    cls = spark.createDataFrame([("012345678", "A1"), ("012345678", "A2")], "ndc string, class_aui string")
    assert [tuple(r) for r in products.classes_of(spark.createDataFrame([("p", "1234-5678")], "product string, ndc string"), cls).collect()] == [("p", "012345678", "A2")]


def test_terminology(spark):
    c = spark.createDataFrame(
        [("C1", "A1", "RXNORM", "BN", "Brand", "1", None, "ENG", "N", "Y"), ("C2", "A2", "RXNORM", "SBD", "Brand 5 mg", "2", None, "ENG", "N", "Y"), ("C3", "A3", "MTHSPL", "DP", "Drug", "3", None, "ENG", "N", "Y"), ("C2", "A4", "MDR", "PT", "Rash", "4", "4", "ENG", "N", "Y")],
        "CUI string, AUI string, SAB string, TTY string, STR string, CODE string, SDUI string, LAT string, SUPPRESS string, ISPREF string",
    )
    rel = spark.createDataFrame([("C2", "A2", "C1", "A1", "RO", "ingredient_of", "RXNORM")], "CUI1 string, AUI1 string, CUI2 string, AUI2 string, REL string, RELA string, SAB string")
    att = spark.createDataFrame([("C2", "A2", "2", "NDC", "0123456789012", "RXNORM", "N"), ("C3", "A3", "3", "SPL_SET_ID", "g1", "MTHSPL", "N"), ("C2", "A2", "2", "SPL_SET_ID", "g1", "RXNORM", "N")], "CUI string, METAUI string, CODE string, ATN string, ATV string, SAB string, SUPPRESS string")
    assert [r["brand"] for r in terminology.brand_names(c, rel).collect()] == ["Brand"]
    assert [tuple(r) for r in terminology.clinical_drug_ndcs(c, att).collect()] == [("C2", "Brand 5 mg", "0123456789012")]
    assert [r["guid"] for r in terminology.label_atoms(c, att).collect()] == ["g1"]
    assert [r["aui"] for r in terminology.drugs_by_label(c, att).collect()] == ["A2"]
    cls = spark.createDataFrame([("X1", "C9", "brand"), ("X2", "C9", "other")], "aui string, cui string, term string")
    got = terminology.ndc_classes(terminology.clinical_drug_ndcs(c, att), spark.createDataFrame([("C2", "C9")], "cui1 string, cui2 string"), cls)
    assert [tuple(r) for r in got.collect()] == [("0001234567890", "X1")]
    types = spark.createDataFrame([("C2", "B2.2.1"), ("C1", "A1")], "CUI string, STN string")
    assert [r["cui"] for r in terminology.without_ignored(terminology.atoms(c, "MDR"), types, ("B2.2",)).collect()] == ["C2"]
    assert terminology.preferred_by_concept(c, spark.createDataFrame([("C2",)], "cui string"), "MDR").count() == 1
    hier = spark.createDataFrame([("A4", "P1"), ("A4", "P1"), ("A9", "P2")], "AUI string, PAUI string")
    assert [tuple(r) for r in terminology.parents(hier, spark.createDataFrame([("A4",)], "aui string")).collect()] == [("A4", "P1")]


def test_section_classifier(spark):
    rows = spark.createDataFrame([("indicated for treatment of pain", "IND"), ("adverse reactions were rash", "AE")] * 8, "text string, label string")
    model = training.section_model(rows)
    kept = training.gate(spark.createDataFrame([("indicated for treatment of rash",)], "text string"), model, "IND")
    assert kept.count() == 1
