import pytest
from pyspark.sql import functions as F

from vialstream.functions import codes, text
from vialstream.functions.stem import lemma, porter2, stem_words


def one(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(f(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("f", "given", "wanted"),
    [
        (text.clean_term, "Acute-Phase  reaction", "acute-phase  reaction"),
        (text.clean_term, " (Rash)! ", "rash"),
        (text.reverse_term, "heart rate increased", "increased heart rate"),
        (text.reverse_term, "abnormal liver test", "liver test abnormal"),
        (text.reverse_term, "rash", "rash"),
        (text.normalize_punct, "AIDS–related Kaposi’ s sarcoma", "AIDS related Kaposi's sarcoma"),
        (text.split_special, "pain®, (severe); a-b", "pain severe a-b"),
        (text.qualifier_first, "kaposi's sarcoma aids related", "aids related kaposi's sarcoma"),
        (text.qualifier_first, "drug related", None),
        (text.of_the_rotation, "carcinoma of the ovary", "ovarian carcinoma"),
        (text.of_the_rotation, "ovarian carcinoma", None),
        (text.of_the_rotation, "cancer of the blood", "hematologic cancer"),
        (text.of_the_rotation, "disease of the skin", "skin disease"),
        (text.sanitize_literal, "a\r\nb'c\x01\\", "a\nb''c"),
        (text.sanitize_literal, "D'Arc\nnext", "D''Arc\nnext"),
        (text.sanitize_literal, "D''''Arc", "D''Arc"),
        (text.sanitize_literal, "D'''Arc''''''x", "D''Arc''x"),
        (text.sanitize_literal, "p\x00q\nr\x01s\rt\tu\x7f", "pq\nrs\nt\tu"),
        (text.sanitize_literal, "c\\d\\e\nf\\\\", "c\\d\\e\nf"),
        (text.sanitize_literal, "xyz'", "xyz"),
        (text.sanitize_literal, "xyz''", "xyz''"),
        (text.sanitize_literal, "xyz'''", "xyz''"),
        (text.sanitize_literal, "Y" * 15_799 + "'z", "Y" * 15_799),
        (text.sanitize_literal, "Y" * 15_799 + "\\z", "Y" * 15_799),
        (text.sanitize_literal, None, ""),
        (text.sanitize_literal, "", ""),
        (text.strip_doses, "Drug 120 mg/5 mL (10-20 mg) 5 ml tablet", "Drug tablet"),
        (codes.normalize_ndc, "1234-5678", "012345678"),
        (codes.normalize_ndc, "12345-6789", "123456789"),
        (codes.normalize_ndc, "12345-67-89", ""),
        (codes.normalize_ndc, "garbage", ""),
        (codes.pad_ndc, "0123", "0000000000123"),
        (codes.pad_ndc, "123", "123"),
        (codes.compact_date, "20210203101112", "20210203"),
        (codes.compact_date, "2021-02", "20210201"),
        (codes.compact_date, "2021", "20210101"),
        (codes.compact_date, "x", None),
        (codes.change_id, "https://x.example/?a=b&DrugNameID=17", 17),
        (codes.change_id, "https://x.example/?drug_id=5&z=1", 5),
        (codes.change_id, "none", -1),
        (codes.source_type, "/data/Prescription/x.zip", "PRESCRIPTION"),
    ],
)
def test_values(spark, f, given, wanted):
    assert one(spark, [given], f) == [wanted]


def test_nulls_pass_through(spark):
    for f in (text.clean_term, text.split_special, text.normalize_punct, codes.compact_date, text.strip_doses):
        assert one(spark, [None], f) == [None]


def test_bad_dates_are_null(spark):
    assert one(spark, ["20211301", "2021-02-03"], lambda c: codes.parse_date(c).cast("string")) == [None, "2021-02-03"]


def test_sentences_and_ngrams(spark):
    assert one(spark, ["One. Two!  Three?\nFour"], text.sentences) == [["One.", "Two!", "Three?", "Four"]]
    assert one(spark, ["a b c"], lambda c: text.ngrams(text.words(c), 2)) == [["a", "b", "c", "a b", "b c"]]
    assert one(spark, ["a"], lambda c: text.ngrams(text.words(c), 3)) == [["a"]]
    assert one(spark, ["abcd"], text.char_ngrams) == [["abc", "bcd", "abcd"]]


def test_stopwords(spark):
    assert one(spark, ["The pain, as well as a rash"], text.remove_stopwords) == ["pain rash"]
    assert one(spark, ["the", "pain", "x"], text.is_stopword) == [True, False, True]


def test_possessives(spark):
    df = spark.createDataFrame([(["kaposi", "'s", "x"],), (["kaposi", "'", "s"],)], "w array<string>")
    assert [r[0] for r in df.select(text.join_possessives(F.col("w"))).collect()] == [["kaposi's", "x"], ["kaposi's"]]


def test_suffixes(spark):
    got = one(spark, ["nivolumab-nvhy 10, relatlimab-zzzz"], lambda c: text.strip_suffixes(c, F.array(F.lit("nvhy"))))
    assert got == ["nivolumab 10, relatlimab-zzzz"]


def test_ndcs_of_text(spark):
    assert one(spark, ["a 12345-678-90 b 1234-5678-9, 12345-678-90 912345-678-90"], codes.find_ndcs) == [["12345-678-90", "1234-5678-9"]]


@pytest.mark.parametrize(("word", "stem"), [("headaches", "headach"), ("pains", "pain"), ("caresses", "caress"), ("hopping", "hop"), ("relational", "relat"), ("generously", "generous"), ("skies", "sky"), ("happily", "happili"), ("ties", "tie"), ("cries", "cri"), ("consolation", "consol")])
def test_porter2(word, stem):
    assert porter2(word) == stem


def test_stem_words_and_lemmas(spark):
    df = spark.createDataFrame([(["headaches", "pains"],), (None,), ([],)], "w array<string>")
    assert [r[0] for r in df.select(stem_words(F.col("w"))).collect()] == [["headach", "pain"], None, []]
    assert (lemma("children", "N"), lemma("studies", "N"), lemma("stopped", "V"), lemma("happier", "A")) == ("child", "study", "stop", "happy")


def test_excipients(spark):
    df = spark.createDataFrame([(["C3", "C1", "C1", "C2"], ["C2"])], "a array<string>, b array<string>")
    assert df.select(codes.excipient_signature(F.col("a"), F.col("b"))).first()[0] == "C1|C3"


def test_split_special_as_its_sql(spark, tmp_path):
    """Texts of which nothing is left, and a vertical tab, which the SQL's white space lacks."""
    import duckdb

    from vialstream.plans import queries

    given = ["", "!!!", " \n ", None, "a\x0bb", " \x0b a \x0b", "a \t?\x0c b", "-- ! --", "a\x85b\u2028", "x  y"]
    spark.createDataFrame([(k, v, "en") for k, v in enumerate(given)], "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["digest"] for r in queries.SPARK["split_special"](spark, str(tmp_path)).collect()}
    clean = {r["doc_id"]: r["digest"] for r in queries.SPARK["clean_text"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == dict(c.execute(queries.SQL["split_special"]).fetchall())
    assert clean == dict(c.execute(queries.SQL["clean_text"]).fetchall())
    assert got[0] is None and got[1] is None
