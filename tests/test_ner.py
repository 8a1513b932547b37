import pytest
from pyspark.sql import functions as F

from vialstream.operators import ner

TERMS = [
    ("A1", "knee swelling", "PT"), ("A2", "hives", "PT"), ("A3", "tumour", "LLT"), ("A4", "bone tumour", "PT"), ("A5", "aids", "PT"), ("A6", "pax", "PT"), ("A7", "immunodeficiency", "PT"),
    ("A8", "hiv negative", "PT"), ("A9", "disorders of the gut wall", "HT"), ("B1", "gastric ulcer", "PT"), ("B2", "blood bilirubin increased", "PT"), ("B3", "kaposi's sarcoma aids related", "PT"),
    ("B4", "sarcoma", "PT"), ("B5", "hives", "LLT"), ("B6", "kaposi's sarcoma", "PT"), ("B7", "alkaline phosphatase increased", "PT"),
]


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame(TERMS, "aui string, term string, tty string").persist()


CASES = [
    ("AE", "Hives and knee swelling came up in two people", {"hives", "knee swelling"}),
    ("AE", "it was hives, hives and hives again", {"hives"}),
    ("AE", "We saw no evidence of hives", set()),
    ("AE", "Such marks are not indicative of knee swelling", set()),
    ("AE", "this came from a preexisting bone tumour", set()),
    ("AE", "this came from a pre-existing bone tumour", {"bone tumour"}),  # hyphens between letters are spaces by then
    ("AE", "the trial excluded patients with hives", set()),
    ("AE", "hives is suspected", set()),
    ("AE", "hives from other causes", set()),
    ("AE", "hives from causes other than this", set()),
    ("AE", "a case report of hives", set()),
    ("AE", "those ineligible had hives", set()),
    ("AE", "in patient with gastric ulcer we counted", set()),
    ("AE", "   ", set()),
    ("AE", None, set()),
    ("IND", "Product q is indicated for treatment of hives", {"hives"}),
    ("IND", "given in patients with knee swelling", set()),
    ("IND", "for hives see posology", set()),
    ("IND", "for hives see clinical studies", set()),
    ("IND", "for hives see symptoms and treatment of overdos", set()),
    ("IND", "hives was not studied", set()),
    ("IND", "hives after oral intercourse", set()),
    ("IND", "treatment of hives, gastric ulcer was not studied in patients", set()),
    ("IND", "q is indicated for the prevention of bone tumour", {"bone tumour"}),
    ("AE", "one had disorders of the gut wall", set()),
    ("IND", "indicated for treatment of disorders of the gut wall", {"disorders of the gut wall"}),
    ("AE", "it aids in the prevention of aids", set()),
    ("AE", "pax is a gel for the skin", set()),
    ("AE", "pax is given before pre-radiation care", set()),
    ("AE", "apply q where hives are", set()),
    ("AE", "apply q to treat hives", {"hives"}),
    ("AE", "pax ® was taken", set()),
    ("AE", "™  pax was taken", set()),
    ("AE", "pax (tm) came late, then pax came", {"pax"}),
    ("IND", "treatment of those who are hiv negative", set()),
    ("AE", "human immunodeficiency virus", set()),
    ("AE", "an immunodeficiency came", {"immunodeficiency"}),
    ("AE", "bilirubin was high", {"blood bilirubin increased"}),
    ("AE", "a rise of alkaline  phosphatase", {"alkaline phosphatase increased"}),
    ("IND", "treatment of high bilirubin", set()),
    ("IND", "q is indicated for treatment of AIDS–related Kaposi’s sarcoma", {"aids related kaposi's sarcoma"}),
]


@pytest.fixture(scope="module")
def found(spark, terms):
    """All cases of a section in one run."""
    out = {}
    for section in ("AE", "IND"):
        rows = spark.createDataFrame([(k, s) for k, (c, s, _) in enumerate(CASES) if c == section], "id int, sentence string")
        for r in ner.recognise(rows, ner.dictionary(terms), section).collect():
            out.setdefault(r["id"], {})[r["key"]] = (r["tty"], list(r["auis"]))
    return out


@pytest.mark.parametrize("k", range(len(CASES)))
def test_rules(found, k):
    assert set(found.get(k, {})) == CASES[k][2]


def test_first_type(found):
    assert found[0]["hives"] == ("PT", ["A2"])


def test_stems_and_loose_places(spark, terms):
    said = [(1, "frequent knees swellings were noted"), (2, "severe knees swellings were seen, apply the balm"), (3, "knee swelling seen, apply the balm"), (4, "knees swellings seen, apply the balm to treat it")]
    hits = ner.recognise(spark.createDataFrame(said, "id int, sentence string"), ner.dictionary(terms, True), "AE", True)
    assert sorted(r["id"] for r in hits.collect() if r["key"].startswith("knee")) == [1, 4]


def test_places(spark):
    rows = [("a rash and rash", "rash"), ("knees  swellings, knee swelling", "knee swel"), ("nothing", "x"), ("a+b a+b", "a+b")]
    got = spark.createDataFrame(rows, "s string, k string").select(ner.occurrences(F.col("s"), F.col("k"))).collect()
    assert [list(r[0]) for r in got] == [[3, 12], [19], [], [1, 5]]


def test_absorption(spark):
    df = spark.createDataFrame([(["aids related kaposi's sarcoma", "aids", "sarcoma"],), (["kaposi's sarcoma", "sarcoma", "aids"],), (["sarcoma", "aids"],)], "k array<string>")
    assert [sorted(r[0]) for r in df.select(ner.absorb(F.col("k"))).collect()] == [["aids related kaposi's sarcoma", "sarcoma"], ["aids", "kaposi's sarcoma"], ["aids", "sarcoma"]]


def test_antonyms_and_codes(spark, terms):
    hits = spark.createDataFrame([(1, "longword"), (1, "much up"), (2, "longword"), (3, "up"), (3, "down")], "id int, key string")
    pairs = spark.createDataFrame([("longword", "much up"), ("up", "down")], "a string, b string")
    assert {tuple(r) for r in ner.without_antonyms(hits, pairs, ["id"]).select("id", "key").collect()} == {(1, "much up"), (2, "longword"), (3, "up"), (3, "down")}
    atoms = spark.createDataFrame([("L", "10", "LLT", "99"), ("P", "10", "PT", "10")], "aui string, pt_code string, tty string, code string")
    got = ner.codes_of(spark.createDataFrame([(1, ["L"])], "id int, auis array<string>"), atoms)
    assert {r["aui"] for r in got.collect()} == {"L", "P"}


def test_dictionary_unites_equal_keys(spark):
    t = spark.createDataFrame([("X", "Rash", "PT"), ("Y", "rash", "PT"), ("Z", "carcinoma of the ovary", "PT")], "aui string, term string, tty string")
    d = {r["key"]: r["auis"] for r in ner.dictionary(t).collect()}
    assert d["rash"] == ["X", "Y"] and d["ovarian carcinoma"] == ["Z"]


def test_generic(spark):
    df = spark.createDataFrame([(["cancer", "breast cancer", "rash"],)], "k array<string>")
    assert sorted(df.select(ner.drop_generic(F.col("k"))).first()[0]) == ["breast cancer", "rash"]


def test_every_exclusion_pattern_has_a_sign():
    """Sentences made from the patterns themselves: each that a pattern finds holds one of the signs."""
    import random
    import re
    from itertools import product

    r = random.Random(2)
    parts = {"AE": (*ner.NOT_AN_EVENT, *ner.STUDY, *ner.PRIOR), "IND": ner.NOT_A_USE}
    for kind, patterns in parts.items():
        for p in patterns:
            # every choice of alternatives, optional groups in and out
            plain = p.replace(r"\b", "").replace(r"\s+", " ").replace(r"\s*", " ").replace(r"\-", "-").replace("[^ ]+ ", "word ").replace("[- ]", "-").replace("patients?", "patients")
            choices = []
            for x in re.split(r"(\((?:[^()]|\([^()]*\))*\)\??)", plain):
                if x.startswith("("):
                    body = re.sub(r"\?$", "", x)[1:-1]
                    flat = [body] if "(" in body and "|" not in re.sub(r"\([^()]*\)", "", body) else re.split(r"\|(?![^(]*\))", body)
                    flat = [y for f in flat for y in ([re.sub(r"\(([^()]*)\)\??", lambda m: m[1].split("|")[k % len(m[1].split("|"))], f) for k in range(3)] + ([re.sub(r"\([^()]*\)\?", "", f)] if ")?" in f else []))]
                    choices.append([*flat, ""] if x.endswith("?") else flat)
                else:
                    choices.append([x])
            made = ["".join(c) for c in product(*choices)]
            r.shuffle(made)
            hits = [s for s in made if re.search(p, s)]
            assert hits, p
            for s in hits:
                assert any(x in s for x in ner.SIGNS_OF_EXCLUSION[kind]), (p, s)
    for c in ner.NEGATION:
        assert any(x in c for x in ner.SIGNS_OF_EXCLUSION["cue"]), c


def test_trie_and_join_agree(spark, terms, monkeypatch):
    rows = spark.createDataFrame([(k, s) for k, (_, s, _) in enumerate(CASES)] + [(900, "hives ast elevated hives bone tumour tumour"), (901, "alkaline phosphatase raised and blood bilirubin increased bilirubin high")], "id int, sentence string")
    for section in ("AE", "IND"):
        for stemmed in (False, True):
            entries = ner.dictionary(terms, stemmed)
            by_trie = sorted(map(str, ner.recognise(rows, entries, section, stemmed).collect()))
            labs = sorted(map(str, ner.match(rows, entries, section, stemmed, True).collect()))
            with monkeypatch.context() as m:
                m.setattr(ner, "MOST_BROADCAST", 0)
                assert by_trie and by_trie == sorted(map(str, ner.recognise(rows, entries, section, stemmed).collect()))
                assert labs == sorted(map(str, ner.match(rows, entries, section, stemmed, True).collect()))


def test_sentences_meet_as_numbers(spark, terms):
    """What is shuffled to apply the rules between keys are numbers, neither keys nor their atoms; without a cue a sentence is one row."""
    rows = spark.createDataFrame([(1, "Hives and knee swelling came up"), (1, "a bone tumour"), (2, "pax is a gel " + "and so on " * 12 + "bone tumour")], "id int, sentence string")
    got = ner.recognise(rows, ner.dictionary(terms), "AE")
    assert {(r["id"], r["key"]) for r in got.collect()} == {(1, "hives"), (1, "knee swelling"), (1, "bone tumour"), (2, "bone tumour")} and got.count() == 4
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(_hits" in plan and "collect_set(struct" not in plan, plan


def test_signs_are_in_every_sentence_that_rules_find(spark):
    """The quick patterns may find more than the rules, never less."""
    import random

    import pyarrow as pa

    from vialstream.operators import trie

    r = random.Random(2)
    bits = [*ner.NEGATION, "not", "observed", "may be", "x associated", "case report", "were", "is", "may", "occur", "causes", "not\x0bnot studied", "see", "posology", "oral", "sex", "ineligible", "history of", "known", "baseline low",
            "in patients with", "is a gel", "are given as\ttablets", "dose", "pre-radiation", "apply", "for  external\x0buse", "(r)", "®", "™", "(tm)", "aids", "hiv", "excluded", "é", "\u2028", "ſ", "K", "kit", "mg5", "hives", "exclusion criteria"]
    said = [r.choice(("", " ", "é")).join(["", *[r.choice(bits) + r.choice((" ", "\t", "", " q ")) for _ in range(r.randint(1, 4))]]).lower() for _ in range(4000)]
    for section in ("AE", "IND"):
        found = spark.createDataFrame([(s,) for s in said], "s string").select(ner.excluded(F.col("s"), section), ner.may_suppress(F.col("s"))).collect()
        signs = trie._signs(pa.array(said), ner._signs_of(section)).to_pylist()
        for s, (out, cue), n in zip(said, found, signs, strict=True):
            assert (not out or n & 1) and (not cue or n & 2), (s, section)
        assert any(out for out, _ in found) and not all(n == 3 for n in signs)
