"""Dictionary recognition of terms in sentences, with context, negation and specificity rules.

Sentences, tokens and rules are Column expressions.  A dictionary under a counted size is a trie over words that Arrow
batches walk; beyond it each word meets the keys that start with it in an equi-join, and the rest of a key is compared on
the joined pairs.  No n-gram is ever built.  Exclusion and local-context rules run on sentences that have hits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialstream.functions import text
from vialstream.functions.stem import stem_words
from vialstream.operators import tagging, trie
from vialstream.operators.terminology import TERM_TYPE_RANK, TERM_TYPES

#: Keys, and bytes of keys and atoms, of a dictionary that is broadcast at most.
MOST_BROADCAST, MOST_BYTES = 500_000, 128 << 20

# Patterns and cues, one entry each.
NOT_AN_EVENT = (
    r"\bnot (been )?(associated|observed|reported|recommended)\b",
    r"\b(may be|not) ([^ ]+ )?(associated|impaired|demonstrated|shown)\b",
    r"\bis suspected\b",
    r"\bdisease[- ]related\b",
    r"\bfrom causes other\b",
    r"\bfrom other causes\b",
    r"\bno evidence\b",
    r"\bnot (accompanied|indicated|expected|suspected)\b",
    r"\bno( significant)? difference\b",
    r"\b(single|case) report\b",
)
NOT_A_USE = (
    r"\b(were|is|may be|not) ([^ ]+ )?(associated|observed|reported|impaired|demonstrated|shown)\b",
    r"\b(may|might|can|could) occur\b",
    r"\bhas caused\b",
    r"\bcauses\b",
    r"\bincreased incidence\b",
    r"\blimitations of use\b",
    r"\b(not|was|were)\s+not\s+studied\b",
    r"\bwas\s+not\s+studied\s+in\s+patients\b",
    r"\bsee (contraind|overdos|abuse|dosage|warnings|precautions|interactions|symptoms and treatment of overdos|(description of)?clinical studies|posology)\b",
    r"\b(receptive|insertive)?\s*(anal|oral|vaginal)\s+(sex|intercourse|coitus)\b",
)
STUDY = (
    r"\b(exclusion criteria|were excluded if|patients? (were )?excluded (if|for)|the trial excluded patients? with)\b",
    r"\b(ineligible|ineligibility criteria)\b",
)
PRIOR = (
    r"\bhistory of\b",
    r"\b(known|pre\-existing|preexisting)\b",
    r"\bat baseline\b",
    r"\b(baseline|screening) (abnormal|elevated|low|reduced)\b",
    r"\bin patients? with\b",
)
NEGATION = (
    "not indicated for", "not indicative of", "no evidence of", "not suggestive of", "no signs of", "does not indicate", "without evidence of",
    "free from", "absence of", "rule out", "secondary to", "due to an underlying", "because of an underlying",
    "resulting from a pre-existing", "caused by a pre-existing", "have not been", "exclusion criteria",
    "were excluded if", "patients were excluded", "trial excluded patients", "history of", "at baseline", "baseline", "pre-existing", "preexisting", "known",
)
LAB_TRIGGERS = (
    (r"\bbilirubin\b", r"\b(elevated|increase|increased|rise|raised|high)\b", "blood bilirubin increased"),
    (r"\balkaline\s+phosphatase\b", r"\b(elevated|increase|increased|rise|raised|high)\b", "alkaline phosphatase increased"),
    (r"\b(ast|aspartate\s+aminotransferase)\b", r"\b(elevated|increase|increased|rise|raised|high)\b", "aspartate aminotransferase increased"),
)
PRODUCT = r"\b(is|are|was|were)\b.{0,48}\b(cream|ointment|gel|lotion|spray|solution|suspension|tablet|capsule|injection|patch|kit|device|topical|pre[- ]?radiation|brand|product|dose|dosage|mg|mcg|ml)\b"
INSTRUCTION = r"\b(apply|applied)\b|\bfor\s+external\s+use\b"
CLINICAL = r"\b(treat|treatment\s+of|prevent|prevention\s+of|manage|management\s+of|indicated\s+for)\b"
HIV_STATUS = r"\bhiv\s+(test\s+)?(negative|positive)\b"
HIV_VIRUS = r"\bhuman\s+immunodeficiency\s+virus\b"
LOCAL_STUDY = r"\b(exclusion criteria|were excluded if|patients? (were )?excluded (if|for))"
COMPOSITES = (("aids related kaposi's sarcoma", "aids"), ("kaposi's sarcoma", "sarcoma"))


#: Every exclusion pattern and cue holds one of these, so a sentence without any needs no pattern.
SIGNS_OF_EXCLUSION = {
    "cue": ("not", "evidence", "signs", "free", "absence", "rule", "secondary", "underlying", "existing", "exclu", "history", "baseline", "known"),
    "AE": ("not", "may be", "suspected", "disease", "other", "evidence", "difference", "report", "exclu", "ineligib", "history", "known", "existing", "baseline", "screening", "in patient"),
    "IND": ("associated", "observed", "reported", "impaired", "demonstrated", "shown", "occur", "cause", "incidence", "limitations", "studied", "see ", "sex", "intercourse", "coitus"),
}


def has_any(sentence: Column, signs: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [sentence.contains(x) for x in signs])


def any_of(patterns: tuple) -> str:
    """One pattern, whatever the case, that finds what any of the patterns finds."""
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns)


def cues() -> str:
    """One pattern that finds any cue of ``NEGATION``."""
    return "|".join(NEGATION)


def dictionary(terms: DataFrame, stemmed: bool = False) -> DataFrame:
    """(tty, n_tokens, key, auis): each term and its rotations as normalised keys; equal keys unite their atoms.

    terms: aui, term, tty.  A rotation counts as many tokens as its term, as lookups by length expect.
    """
    base = terms.filter(F.col("tty").isin(*TERM_TYPES)).withColumn("w", text.join_possessives(text.words(F.lower(text.normalize_punct(F.col("term"))))))
    base = base.withColumn("n_tokens", F.size("w")).withColumn("line", F.array_join("w", " "))
    keys = base.withColumn("key", F.explode(F.array_distinct(F.filter(F.array("line", text.qualifier_first(F.col("line")), text.of_the_rotation(F.col("line"))), lambda k: k.isNotNull() & (k != "")))))
    if stemmed:
        keys = keys.withColumn("key", F.array_join(stem_words(F.split("key", " ")), " "))
    return keys.groupBy("tty", "n_tokens", "key").agg(F.array_sort(F.collect_set("aui")).alias("auis"))


def excluded(sentence: Column, section: str) -> Column:
    """Whether a lower-cased sentence states no event (AE, BLACKBOX) or use (IND)."""
    kind = "IND" if section == "IND" else "AE"
    patterns = any_of(NOT_A_USE if kind == "IND" else (*NOT_AN_EVENT, *STUDY, *PRIOR))
    signs = tuple(dict.fromkeys((*SIGNS_OF_EXCLUSION["cue"], *SIGNS_OF_EXCLUSION[kind])))
    hit = has_any(sentence, signs) & (sentence.rlike(cues()) | sentence.rlike(patterns))
    if section == "IND":
        stated = sentence.contains("indicated for") | sentence.contains("treatment of") | sentence.contains("prevention of")
        return hit | (~stated & sentence.contains("in patients with"))
    return hit


def sentence_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, sentence): sentences in lower case, special characters out."""
    parts = F.transform(text.sentences(F.col(text_col)), lambda s: F.lower(text.split_special(s)))
    return docs.select(id_col, F.posexplode(parts).alias("n", "sentence")).filter("sentence <> ''")


#: A tagger and a dictionary of lemmas; with them words of the stemmed pass become lemmas before stems.
Lemmatiser = tuple[tagging.Tagger, tagging.Lemmas]


def _words(spark: SparkSession, sentence: Column, stemmed: bool, lemmas: Lemmatiser | None = None) -> Column:
    if not stemmed:
        w = text.words(sentence)
        return F.when(sentence.contains("'") | sentence.contains("\u0001"), text.join_possessives(w)).otherwise(w)
    w = text.words(text.remove_stopwords(sentence))
    return stem_words(tagging.lemmatised(spark, *lemmas, w) if lemmas else w)


def _in_memory(entries: DataFrame, section: str) -> pa.Table | None:
    """The entries that a section may use, on the driver, if they are under a counted size."""
    d = entries.filter(F.col("tty").isin(*_types(section))).select("key", "tty", "auis")
    n, size = d.agg(F.count("*"), F.coalesce(F.sum(F.length("key") + 16 * F.size("auis") + 64), F.lit(0))).first()
    return d.toArrow() if n <= MOST_BROADCAST and size <= MOST_BYTES else None


def _types(section: str) -> list[str]:
    return [t for t in TERM_TYPES if section == "IND" or t not in ("HG", "HT")]


def _numbered(rows: DataFrame, known: pa.Table, stemmed: bool, labs: bool, kept: Callable[[DataFrame], DataFrame], lemmas: Lemmatiser | None, signs: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows that have hits, as ``_hits``, numbers of keys by one walk over the words of a batch; entries with these numbers; all keys.

    A key of a laboratory value has the number ``-1 - n``.  ``kept`` sees the rows that have hits, with ``_signs`` beside them.
    """
    spark = rows.sparkSession
    keys = known.column("key").combine_chunks().dictionary_encode()
    numbers = keys.dictionary.to_pylist()
    s = F.col("sentence")
    # a plain sentence goes as it is, unless its possessives are to be joined
    words = _words(spark, s, stemmed, lemmas) if stemmed else F.when(s.contains("'") | s.contains("\u0001"), F.array_join(text.join_possessives(text.words(s)), " "))
    found = trie.found_keys(spark, trie.Trie([k.split(" ") for k in numbers]), s, words, signs)
    entries = spark.createDataFrame(pa.table({"_no": keys.indices, "key": known.column("key"), "tty": known.column("tty"), "auis": known.column("auis")}))
    cols = rows.columns
    canonical = {k: n for n, k in enumerate(numbers) if k in {key for *_, key in LAB_TRIGGERS}} if labs else {}
    rows = rows.withColumn("_found", found)
    hits = F.col("_found.keys")
    if canonical:
        number = lambda k: reduce(lambda out, x: F.when(k == x[0], F.lit(-1 - x[1])).otherwise(out), canonical.items(), F.lit(0))
        hits = F.concat(hits, F.filter(F.transform(lab_keys(s), number), lambda n: n < 0))
    # out of a generator the hits are a column; out of a projection each use below would compute them anew
    rows = rows.select(*cols, F.col("_found.signs").alias("_signs"), F.explode(F.array(hits)).alias("_hits")).filter(F.size("_hits") > 0)
    return kept(rows).drop("_signs"), entries, numbers


def _by_trie(rows: DataFrame, known: pa.Table, *how) -> DataFrame:
    """Hits with all entries of their keys; ``kept`` sees the rows that have hits, before these part."""
    cols = rows.columns
    rows, entries, _ = _numbered(rows, known, *how)
    more = [c for c in rows.columns if c not in cols and c != "_hits"]
    rows = rows.select(*cols, *more, F.explode("_hits").alias("_x"))
    rows = rows.select(*cols, *more, F.when(F.col("_x") < 0, -1 - F.col("_x")).otherwise(F.col("_x")).alias("_no"), (F.col("_x") < 0).alias("lab"))
    return rows.join(F.broadcast(entries), "_no").drop("_no")


def match(rows: DataFrame, entries: DataFrame, section: str = "AE", stemmed: bool = False, labs: bool = False, kept: Callable[[DataFrame], DataFrame] = lambda rows: rows, lemmas: Lemmatiser | None = None) -> DataFrame:
    """rows (any ids, sentence) with each dictionary key found, once a sentence: key, tty, auis, lab.

    A dictionary under a counted size is a trie in memory; beyond it every word looks for the keys that start with it in
    a join.  With ``labs`` the canonical keys of raised laboratory values are looked up as well (lab: true).  ``kept``
    may filter the rows, or add columns to them, on which a trie has found keys.
    """
    known = _in_memory(entries, section)
    if known is not None:
        hits = _by_trie(rows, known, stemmed, labs, kept, lemmas)
    else:
        hits = _by_join(kept(rows), entries, section, stemmed, labs, lemmas)
    return hits if labs else hits.drop("lab")


def _by_join(rows: DataFrame, entries: DataFrame, section: str, stemmed: bool, labs: bool, lemmas: Lemmatiser | None) -> DataFrame:
    """Every word meets the keys that start with it; a key that follows there, for the first time in the sentence, is a hit."""
    cols = rows.columns
    rows = rows.withColumn("_w", _words(rows.sparkSession, F.col("sentence"), stemmed, lemmas))
    rows = rows.withColumn("_line", F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" ")))
    rows = rows.withColumn("_labs", lab_keys(F.col("sentence")) if labs else F.array().cast("array<string>"))
    # labs stand behind the words
    words = F.concat("_w", F.transform("_labs", lambda k: F.element_at(F.split(k, " "), 1)))
    rows = rows.select("*", F.posexplode(words).alias("_at", "_first"))
    before = F.length(F.array_join(F.slice("_w", F.lit(1), F.col("_at")), " "))
    here = F.when(F.col("_at") == 0, 1).otherwise(before + 2)
    lab = F.col("_at") >= F.size("_w")
    found = F.when(lab, F.try_element_at("_labs", F.col("_at") - F.size("_w") + 1) == F.col("key")).otherwise(F.instr(F.col("_line"), F.concat(F.lit(" "), F.col("key"), F.lit(" "))) == here)
    d = entries.filter(F.col("tty").isin(*_types(section))).select("key", "tty", "auis", F.element_at(F.split("key", " "), 1).alias("_first"))
    return rows.join(d, "_first").filter(found).withColumn("lab", lab).select(*cols, "lab", "key", "tty", "auis")


def _around(s: Column, at: Column, n: Column, width: int) -> Column:
    first = F.greatest(at - width, F.lit(1))
    return F.substring(s, first, at + n + width - first)


def _places(parts: Column, sizes: Column) -> Column:
    """Where the matches between ``parts`` start, from 1; sizes: of the matches."""
    return F.aggregate(
        F.sequence(F.lit(1), F.size(parts) - 1),
        F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda a, k: F.struct((a["at"] + F.length(F.element_at(parts, k)) + F.element_at(sizes, k)).alias("at"), F.array_append(a["all"], a["at"] + F.length(F.element_at(parts, k))).alias("all")),
    )["all"]


def occurrences(sentence: Column, key: Column) -> Column:
    """Where a key stands, from 1; a (stemmed) key that does not stand as it is, where words that start like its words do."""
    parts = F.split(sentence, F.concat(F.lit("\\Q"), key, F.lit("\\E")), F.lit(-1))
    exact = F.when(F.size(parts) > 1, _places(parts, F.array_repeat(F.length(key), F.size(parts))))
    loose = F.concat(F.lit("(?i)"), F.array_join(F.transform(F.split(key, r"\s+"), lambda t: F.concat(F.lit("\\b\\Q"), t, F.lit("\\E\\w*"))), "\\s+"))
    cut = F.split(sentence, loose, F.lit(-1))
    relaxed = F.when(F.size(cut) > 1, _places(cut, F.transform(F.regexp_extract_all(sentence, loose, F.lit(0)), lambda m: F.length(m))))
    return F.coalesce(exact, relaxed, F.array().cast("array<int>"))


def may_suppress(sentence: Column) -> Column:
    """Whether any cue of the local rules stands anywhere in a sentence; without one, every hit is allowed."""
    cue = has_any(sentence, SIGNS_OF_EXCLUSION["cue"]) & sentence.rlike(cues())
    return has_any(sentence, ("®", "™", "(r)", "(tm)", "aids", "hiv", "immunodeficiency")) | cue | sentence.rlike(any_of((PRODUCT, INSTRUCTION))) | (sentence.contains("exclu") & sentence.rlike(any_of((LOCAL_STUDY,))))


def allowed_locally(sentence: Column, key: Column) -> Column:
    """Whether some occurrence of the key is not suppressed by what stands around it; keys not found pass.

    Suppression: a trademark sign beside it, functional "aids", HIV status, the virus's name, product talk
    (unless a clinical cue stands with mere instructions), and negation or prior state within 60 characters.
    """
    n = F.length(key)

    def suppressed(at: Column) -> Column:
        before = F.rtrim(F.substring(sentence, F.lit(1), at - 1))
        after = F.ltrim(F.substring(sentence, at + n, F.length(sentence)))
        sign = after.rlike(r"^(®|™|\(r\)|\(tm\))") | before.rlike(r"(®|™|\(r\))$")
        helps = key.isin("aids", "hiv") & (sentence.contains("aids in the prevention of") | sentence.rlike(r"\b(use|uses)\s+aids\b"))
        status = key.contains("hiv") & _around(sentence, at, n, 80).rlike(any_of((HIV_STATUS,)))
        virus = (key == "immunodeficiency") & _around(sentence, at, n, 40).rlike(any_of((HIV_VIRUS,)))
        near = _around(sentence, at, n, 70)
        product = near.rlike(any_of((PRODUCT,))) | (near.rlike(any_of((INSTRUCTION,))) & ~near.rlike(any_of((CLINICAL,))))
        close = _around(sentence, at, n, 60)
        study = close.rlike(any_of((LOCAL_STUDY,))) & (
            F.rlike(close, F.concat(F.lit(any_of((LOCAL_STUDY,)) + r"\s+.*?\Q"), key, F.lit("\\E"))) | F.rlike(close, F.concat(F.lit("(?i)\\Q"), key, F.lit(r"\E\s+.*?" + LOCAL_STUDY + r"\b")))
        )
        return sign | helps | status | virus | product | close.rlike(cues()) | study

    places = occurrences(sentence, key)
    return ~may_suppress(sentence) | (F.size(places) == 0) | F.exists(places, lambda at: ~suppressed(at))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def drop_generic(keys: Column) -> Column:
    """Keys whose words are not all among those of a longer key."""
    parts = F.transform(keys, lambda k: F.struct(k.alias("k"), F.split(k, r"\s+").alias("w")))
    longer = lambda a, b: (F.size(b["w"]) > F.size(a["w"])) & (F.size(F.array_except(a["w"], b["w"])) == 0)
    return _bound(parts, lambda p: F.transform(F.filter(p, lambda a: ~F.exists(p, lambda b: longer(a, b))), lambda x: x["k"]))


def absorb(keys: Column) -> Column:
    """Keys without those that a composite key stands for."""

    def one(keys: Column, whole: str, part: str) -> Column:
        return _bound(keys, lambda k: F.when(F.array_contains(k, whole), F.array_except(k, F.array(F.lit(part)))).otherwise(k))

    return reduce(lambda out, c: one(out, *c), COMPOSITES, keys)


def without_antonyms(hits: DataFrame, antonyms: DataFrame, ids: list[str]) -> DataFrame:
    """Of two antonym keys of one sentence the one of fewer words goes; equally long ones stay."""
    words = lambda c: F.size(F.split(c, r"\s+"))
    both = antonyms.select(F.col("a").alias("key"), F.col("b").alias("other")).unionByName(antonyms.select(F.col("b").alias("key"), F.col("a").alias("other"))).distinct()
    other = hits.select(*ids, F.col("key").alias("other")).distinct()
    gone = hits.join(both, "key").join(other, [*ids, "other"]).filter(words("key") < words("other")).select(*ids, "key").distinct()
    return hits.join(gone, [*ids, "key"], "left_anti")


def lab_keys(sentence: Column) -> Column:
    """Canonical keys of laboratory values that a sentence calls raised."""
    found = F.array(*[F.when(sentence.rlike(f"(?i){a}") & sentence.rlike(f"(?i){up}"), F.lit(k)) for a, up, k in LAB_TRIGGERS])
    some = has_any(F.lower(sentence), ("bilirubin", "alkaline", "ast", "aspartate"))
    return F.when(some & sentence.rlike(any_of(tuple(a for a, _, _ in LAB_TRIGGERS))), F.filter(found, lambda k: k.isNotNull())).otherwise(F.array().cast("array<string>"))


def _type_rank(section: str) -> Column:
    rank = F.lit(99)
    for t, k in TERM_TYPE_RANK.items():
        if section == "IND" or t not in ("HG", "HT"):
            rank = F.when(F.col("tty") == t, k).otherwise(rank)
    return rank


def _may_have(patterns: tuple[str, ...]) -> str:
    """One pattern of RE2 that finds, in ASCII text, at least what any of these does in Java."""
    return "(?is)" + "|".join(f"(?:{p})" for p in patterns).replace(r"\s", r"[\s\x0b]")


def _signs_of(section: str) -> tuple[str, str]:
    """What a sentence has that ``excluded`` or ``may_suppress`` finds; of product talk the nouns alone, as a bounded gap is costly there."""
    patterns = NOT_A_USE if section == "IND" else (*NOT_AN_EVENT, *STUDY, *PRIOR)
    stated = ("in patients with",) if section == "IND" else ()
    nouns = PRODUCT.split(".{0,48}")[1]
    return _may_have((*NEGATION, *patterns, *stated)), _may_have((*NEGATION, r"\(r\)", r"\(tm\)", "aids", "hiv", "immunodeficiency", "exclu", INSTRUCTION, nouns))


def recognise(rows: DataFrame, entries: DataFrame, section: str = "AE", stemmed: bool = False, antonyms: DataFrame | None = None, lemmas: Lemmatiser | None = None) -> DataFrame:
    """(ids, key, tty, auis) of sentences: all rules in order; the first term type that has a key gives its atoms.

    With ``lemmas`` the stemmed pass takes each word's lemma under its tag first.
    One pass: one group for each sentence applies the rules between keys.  Keys of a dictionary in memory are numbers until then.
    """
    ids = [c for c in rows.columns if c != "sentence"]
    # out of a generator a sentence is a column; out of a projection each filter below would compute it anew
    once = lambda c: F.explode(F.array(c)).alias("sentence")
    rows = rows.select(*ids, once(F.trim(F.lower("sentence")))).select(*ids, once(text.normalize_punct(F.col("sentence")))).filter(F.trim("sentence") != "")

    def kept(r: DataFrame) -> DataFrame:
        # the signs keep the costly patterns from most sentences
        may = lambda bit: F.col("_signs").bitwiseAND(bit) > 0 if "_signs" in r.columns else F.lit(True)
        return r.filter(~(may(1) & excluded(F.col("sentence"), section))).withColumn("_cue", may(2) & may_suppress(F.col("sentence")))

    known, labs = _in_memory(entries, section), section != "IND"
    if known is not None and antonyms is None:
        return _own_of(*_numbered(rows, known, stemmed, labs, kept, lemmas, _signs_of(section)), ids, section)
    hits = _by_trie(rows, known, stemmed, labs, kept, lemmas, _signs_of(section)) if known is not None else _by_join(kept(rows), entries, section, stemmed, labs, lemmas)
    # the sentence's own flag keeps the costly test from sentences without any cue
    hits = hits.filter(F.when(~F.col("_cue") | F.col("lab"), F.lit(True)).otherwise(allowed_locally(F.col("sentence"), F.col("key"))))
    hits = hits.withColumn("_rank", _type_rank(section)).filter("_rank < 99").select(*ids, "key", "_rank", "tty", "auis", "lab")
    if antonyms is not None:
        hits = without_antonyms(hits.filter("NOT lab"), antonyms, ids).unionByName(hits.filter("lab"))
    each = hits.groupBy(*ids).agg(F.collect_set(F.struct("key", "_rank", "tty", "auis", "lab")).alias("h"))
    plain = F.array_distinct(F.transform(F.filter("h", lambda x: ~x["lab"]), lambda x: x["key"]))
    each = each.withColumn("k", F.array_union(drop_generic(absorb(plain)), F.transform(F.filter("h", lambda x: x["lab"]), lambda x: x["key"])))
    best = F.transform("k", lambda k: F.array_min(F.transform(F.filter("h", lambda x: x["key"] == k), lambda x: F.struct(x["_rank"], x["tty"], x["auis"], x["key"]))))
    return each.select(*ids, F.explode(best).alias("b")).select(*ids, "b.key", "b.tty", "b.auis")


def _own_of(rows: DataFrame, entries: DataFrame, keys: list[str], ids: list[str], section: str) -> DataFrame:
    """The rules around and between the numbered keys of sentences, then each key's first entry.

    Composite keys need no rule here: what they absorb are parts of them.
    """
    # only sentences with a cue part into their keys
    each = F.when(F.col("_cue"), F.transform("_hits", lambda n: F.array(n))).otherwise(F.array("_hits"))
    rows = rows.select(*ids, "sentence", "_cue", F.explode(each).alias("_hits")).withColumn("_no", F.when(F.col("_cue"), F.get("_hits", F.lit(0))))
    rows = rows.join(F.broadcast(entries.select("_no", F.col("key").alias("_key")).distinct()), "_no", "left")
    rows = rows.filter(F.when(F.col("_key").isNull(), F.lit(True)).otherwise(allowed_locally(F.col("sentence"), F.col("_key"))))
    said = rows.groupBy(*ids).agg(F.flatten(F.collect_list("_hits")).alias("_hits"))
    own = said.select(*ids, F.explode(trie.own_keys(rows.sparkSession, trie.Parts(keys), F.col("_hits"))).alias("_no"))
    best = entries.groupBy("_no").agg(F.min(F.struct(_type_rank(section).alias("rank"), "tty", "auis", "key")).alias("b"))
    return own.join(F.broadcast(best), "_no").select(*ids, "b.key", "b.tty", "b.auis")


def first_type(hits: DataFrame, ids: list[str], section: str = "AE") -> DataFrame:
    """One row for each key of a sentence: the atoms of the first term type that has it."""
    w = Window.partitionBy(*ids, "key").orderBy("_rank", "tty")
    return hits.withColumn("_rank", _type_rank(section)).filter("_rank < 99").withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*ids, "key", "tty", "auis")


def codes_of(hits: DataFrame, atoms: DataFrame, add_preferred: bool = True) -> DataFrame:
    """hits (ids, auis) as atoms; lowest-level terms also bring their preferred term, by its code."""
    ids = [c for c in hits.columns if c not in ("key", "tty", "auis")]
    long = hits.select(*ids, F.explode("auis").alias("aui")).join(atoms.select("aui", "pt_code", "tty"), "aui")
    out = long.select(*ids, "aui")
    if add_preferred:
        p = atoms.filter("tty = 'PT'").groupBy(F.col("code").alias("pt_code")).agg(F.min("aui").alias("pt_aui"))
        up = long.filter(F.col("tty").isin("LLT", "MTH_LT")).join(p, "pt_code").select(*ids, F.col("pt_aui").alias("aui"))
        out = out.unionByName(up)
    return out.distinct()
