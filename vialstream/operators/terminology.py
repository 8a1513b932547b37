"""Terminology tables: the selections, joins and filters over concept, relation, attribute and hierarchy rows.

Inputs are DataFrames with the public column names of such tables: concepts (CUI, AUI, SAB, TTY, STR, CODE,
SDUI, LAT, SUPPRESS, ISPREF), relations (CUI1, AUI1, CUI2, AUI2, REL, RELA, SAB), attributes (CUI, METAUI,
CODE, ATN, ATV, SAB, SUPPRESS), hierarchy (AUI, PAUI) and semantic types (CUI, STN).  A lookup by a list of
keys is a semi-join, so nothing is cut into lists of a thousand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialstream.functions import codes, text

# Fixed values.
TERM_TYPES = ("PT", "LLT", "HT", "HG", "OS")
TERM_TYPE_RANK = {t: k for k, t in enumerate(TERM_TYPES)}


def atoms(concepts: DataFrame, source: str, unsuppressed: bool = False) -> DataFrame:
    """Atoms of one vocabulary: aui, cui, code, pt_code, term, tty, sab."""
    rows = concepts.filter(F.col("SAB") == source)
    if unsuppressed:
        rows = rows.filter("SUPPRESS = 'N'")
    return rows.select(F.col("AUI").alias("aui"), F.col("CUI").alias("cui"), F.col("CODE").alias("code"), F.col("SDUI").alias("pt_code"), F.col("STR").alias("term"), F.col("TTY").alias("tty"), F.col("SAB").alias("sab"))


def ndc_concepts(attributes: DataFrame) -> DataFrame:
    """Distinct (cui, ndc)."""
    return attributes.filter("ATN = 'NDC'").select(F.col("CUI").alias("cui"), F.col("ATV").alias("ndc")).distinct()


def clinical_drug_ndcs(concepts: DataFrame, attributes: DataFrame, source: str = "RXNORM") -> DataFrame:
    """Distinct (cui, term, ndc) of clinical and branded drugs, by atom."""
    c = concepts.filter((F.col("SAB") == source) & F.col("TTY").isin("SCD", "SBD"))
    a = attributes.filter("ATN = 'NDC'").select("METAUI", "ATV")
    return c.join(a, c["AUI"] == a["METAUI"]).select(F.col("CUI").alias("cui"), F.col("STR").alias("term"), F.col("ATV").alias("ndc")).distinct()


def brand_names(concepts: DataFrame, relations: DataFrame, source: str = "RXNORM") -> DataFrame:
    """(brand_aui, brand, drug_aui, drug): English unsuppressed brand names that are an ingredient of branded drugs."""
    live = concepts.filter((F.col("SAB") == source) & (F.col("LAT") == "ENG") & (F.col("SUPPRESS") == "N"))
    brand = live.filter("TTY = 'BN'").select(F.col("CUI").alias("b"), F.col("AUI").alias("brand_aui"), F.col("STR").alias("brand"))
    drug = live.filter(F.col("TTY").isin("SBD", "SBDC")).select(F.col("CUI").alias("d"), F.col("AUI").alias("drug_aui"), F.col("STR").alias("drug"))
    rel = relations.filter("RELA = 'ingredient_of'").select("CUI1", "CUI2")
    return brand.join(rel, F.col("b") == F.col("CUI2")).join(drug, F.col("d") == F.col("CUI1")).select("brand_aui", "brand", "drug_aui", "drug").distinct()


def related(relations: DataFrame, source: str, rel: str) -> DataFrame:
    """Distinct (cui1, cui2) pairs of one relation of a source."""
    return relations.filter((F.col("SAB") == source) & (F.col("REL") == rel)).select(F.col("CUI1").alias("cui1"), F.col("CUI2").alias("cui2")).distinct()


def label_atoms(concepts: DataFrame, attributes: DataFrame) -> DataFrame:
    """Drug-product atoms with any attribute value as the label's guid."""
    dp = concepts.filter("TTY = 'DP'")
    return dp.join(attributes.select("METAUI", "ATV"), dp["AUI"] == F.col("METAUI")).select(F.col("AUI").alias("aui"), F.col("CUI").alias("cui"), F.col("STR").alias("term"), F.col("ATV").alias("guid")).distinct()


def preferred_by_concept(concepts: DataFrame, wanted: DataFrame, source: str = "SNOMEDCT_US") -> DataFrame:
    """Preferred atoms of a source for the concepts in ``wanted`` (cui)."""
    return atoms(concepts.filter("TTY = 'PT'"), source).join(wanted.select("cui").distinct(), "cui", "left_semi")


def parents(hierarchy: DataFrame, wanted: DataFrame) -> DataFrame:
    """Distinct (aui, parent_aui) for the atoms in ``wanted`` (aui)."""
    return hierarchy.select(F.col("AUI").alias("aui"), F.col("PAUI").alias("parent_aui")).join(wanted.select("aui").distinct(), "aui", "left_semi").distinct()


def ingredients(relations: DataFrame, concepts: DataFrame, wanted: DataFrame, kinds: tuple, preferred_only: bool) -> DataFrame:
    """Distinct (aui, ingredient_aui, term): relations of ``kinds`` from the wanted atoms; optionally only preferred ones."""
    c = concepts.filter("ISPREF = 'Y' AND SUPPRESS = 'N'") if preferred_only else concepts
    r = relations.filter(F.col("RELA").isin(*kinds)).join(wanted.select("aui").distinct(), F.col("AUI1") == F.col("aui"))
    return r.join(c.select(F.col("AUI").alias("ingredient_aui"), F.col("STR").alias("term")), F.col("AUI2") == F.col("ingredient_aui")).select("aui", "ingredient_aui", "term").distinct()


def drugs_by_label(concepts: DataFrame, attributes: DataFrame, source: str = "RXNORM") -> DataFrame:
    """(guid, aui, term, tty): drug atoms by their label set id, synonyms and trade names left out."""
    a = attributes.filter("ATN = 'SPL_SET_ID'").select("METAUI", F.col("ATV").alias("guid"))
    c = concepts.filter((F.col("SAB") == source) & ~F.col("TTY").isin("TMSY", "ET"))
    return c.join(a, c["AUI"] == a["METAUI"]).select("guid", F.col("AUI").alias("aui"), F.col("STR").alias("term"), F.col("TTY").alias("tty"))


def allowed_concepts(types: DataFrame, tree_codes: tuple) -> DataFrame:
    """Concepts with a semantic type whose tree number contains one of the codes."""
    hit = F.lit(False)
    for c in tree_codes:
        hit = hit | F.col("STN").contains(c)
    return types.filter(hit).select("CUI").distinct()


def without_ignored(terms: DataFrame, types: DataFrame, tree_codes: tuple) -> DataFrame:
    return terms.join(allowed_concepts(types, tree_codes).withColumnRenamed("CUI", "cui"), "cui", "left_semi")


def without_stop_terms(terms: DataFrame) -> DataFrame:
    """Terms that are no stop word or phrase."""
    return terms.filter(~text.is_stopword(F.col("term")))


def without_duplicate_lowest(terms: DataFrame) -> DataFrame:
    """Lowest-level terms go if a preferred term has the same code and term."""
    p = terms.filter("tty = 'PT'").select("code", "term").distinct()
    low = terms.filter("tty = 'LLT'").join(p, ["code", "term"], "left_anti").select(terms.columns)
    return terms.filter("tty <> 'LLT' OR tty IS NULL").unionByName(low)


def ndc_classes(drugs: DataFrame, relation: DataFrame, classes: DataFrame) -> DataFrame:
    """(ndc, class_aui): classes of related concepts whose term is part of the drug's term; the code loses two characters.

    drugs (cui, term, ndc), relation (cui1, cui2), classes (aui, cui, term): equi-joins with a residual test.
    """
    c = classes.select(F.col("cui").alias("cui2"), F.col("aui").alias("class_aui"), F.col("term").alias("class_term"))
    j = drugs.join(relation, F.col("cui") == F.col("cui1")).join(c, "cui2").filter(F.lower("term").contains(F.lower("class_term")))
    return j.select(codes.pad_ndc(F.col("ndc").substr(F.lit(1), F.length("ndc") - 2)).alias("ndc"), "class_aui").distinct()
