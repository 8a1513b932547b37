"""Product tables of the star schema: safety changes, source files, code and concept bridges, facts with their sources,
and their text forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialstream.functions import codes, text
from vialstream.operators import persist

# Words in a file's path that tell its source type, tested in this order.
SOURCE_TYPES = (("prescription", 1), ("other", 2), ("otc", 3))
CHANGE = ("application_number", "drug_name", "active_ingredient", "supplement_date", "database_updated", "url")


def change_tables(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The change table (drug_id, ...) and its bridge (product, drug_id) from links (product, drug_id, ...).

    One row for each positive drug id: that of its least product, then the least row. Products link to an id once.
    """
    ok = links.filter("drug_id > 0")
    first = ok.groupBy("drug_id").agg(F.min(F.struct("product", *CHANGE)).alias("r"))
    return first.select("drug_id", *[f"r.{c}" for c in CHANGE]), ok.select("product", "drug_id").distinct()


def source_type(path: Column) -> Column:
    p, out = F.lower(path), F.lit(None).cast("int")
    for word, k in reversed(SOURCE_TYPES):
        out = F.when(p.contains(word), k).otherwise(out)
    return out


#: Gives rows ids: (rows, order, name of the ids).
Number = Callable[[DataFrame, list, str], DataFrame]


def source_files(files: DataFrame, root: str = "", number: Number = persist.numbered) -> DataFrame:
    """(src_id, product, guid, xml_name, source_type_id, canonical) of files (product, guid, path).

    Ids go by product, guid and name below ``root``; a guid's least id is canonical; blank paths have no row.
    """
    name = F.replace(F.col("path"), F.lit(root), F.lit("")) if root else F.col("path")
    rows = files.filter("trim(path) <> '' AND guid IS NOT NULL").select("product", "guid", name.alias("xml_name"))
    ids = number(rows, ["product", "guid", "xml_name"], "src_id")
    first = persist.first_sources(ids).withColumnRenamed("src_id", "_first")
    return ids.join(first, "guid").select("src_id", "product", "guid", "xml_name", source_type(F.col("xml_name")).alias("source_type_id"), (F.col("src_id") == F.col("_first")).alias("canonical"))


def approved_files(files: DataFrame, labels: DataFrame) -> DataFrame:
    """``source_files`` rows with application_number, nda_sponsor and approval_date of ``products.approved_labels`` rows; unknown labels have number 0."""
    own = labels.select("product", "guid", "application_number", F.col("sponsor").alias("nda_sponsor"), "approval_date")
    return files.join(own, ["product", "guid"], "left").fillna(0, ["application_number"]).select(*files.columns, "application_number", "nda_sponsor", "approval_date")


def code_tables(names: DataFrame, classes: DataFrame, number: Number = persist.numbered) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The code table (ndc_id, ndc, name, hash), product links (product, ndc_id), and class links (product, ndc_id, atc_id).

    names (product, aui, ndc, name), classes (product, ndc, atc_id). A code is one row, with the least name of its least
    product; rows without a code are one for each (aui, name); a class's code that no product names gets a row without name.
    """
    v = lambda c: F.trim(F.coalesce(c, F.lit("")))
    n = names.select("product", v("aui").alias("aui"), v("ndc").alias("ndc"), v("name").alias("name"))
    n = n.withColumn("key", F.when(F.col("ndc") != "", F.concat(F.lit("c|"), "ndc")).otherwise(F.concat(F.lit("n|"), F.lower(F.concat_ws("|", "aui", "name")))))
    c = classes.filter("atc_id IS NOT NULL AND trim(ndc) <> ''").select("product", v("ndc").alias("ndc"), "atc_id").withColumn("key", F.concat(F.lit("c|"), "ndc"))
    named = n.groupBy("key").agg(F.min(F.struct("product", "ndc", "name", "aui")).alias("r")).select("key", "r.ndc", "r.name", F.when(F.col("r.ndc") != "", F.col("r.ndc")).otherwise(F.col("r.aui")).alias("by"))
    bare = c.select("key", "ndc", F.lit("").alias("name"), F.col("ndc").alias("by")).distinct().join(named.select("key"), "key", "left_anti")
    table = number(named.unionByName(bare).withColumn("hash", codes.name_hash(F.col("by"), F.col("name"))).drop("by"), ["key"], "ndc_id")
    ids = table.select("key", "ndc_id")
    return table.select("ndc_id", "ndc", "name", "hash"), n.join(ids, "key").select("product", "ndc_id").distinct(), c.join(ids, "key").select("product", "ndc_id", "atc_id").distinct()


def concept_bridge(links: DataFrame, atoms: DataFrame, name: str) -> DataFrame:
    """(product, name): each product's known concepts once.  links (product, aui), atoms (aui, id); ids start at 1."""
    return links.join(atoms.filter("id > 0").select("aui", F.col("id").alias(name)), "aui").select("product", name).distinct()


def fact_tables(facts: DataFrame, files: DataFrame, order: list[str], number: Number = persist.numbered) -> tuple[DataFrame, DataFrame]:
    """Facts with ids (without their sources) and links (fact_id, src_id) from facts (..., sources) and source_files rows.

    Ids go by ``order``, which must tell facts apart; a source that is no file's guid (a safety change) gives no link.
    """
    ids = number(facts, order, "fact_id")
    canonical = files.filter("canonical").select("guid", "src_id")
    return ids.drop("sources"), persist.fact_sources(ids, canonical)


def kept(products: DataFrame) -> DataFrame:
    """Products still marked to be saved."""
    return products.filter(F.coalesce("save", F.lit(False)))


def _plain(term: Column) -> Column:
    return F.lower(F.trim(F.coalesce(term, F.lit(""))))


def same_atom(cui: Column, tty: Column, term: Column, of_cui: Column, of_tty: Column, of_term: Column) -> Column:
    """Whether two atoms agree in concept, type and (trimmed, in any case) term; a null concept or type never agrees, a null term is empty."""
    return F.coalesce((cui == of_cui) & (tty == of_tty) & (_plain(term) == _plain(of_term)), F.lit(False))


def same_atoms(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of rows of ``a`` (cui, tty, term, ...) and ``b`` (cui, tty, of_term, ...) that are the ``same_atom``.

    All three are keys of the join, so that a row meets only those it agrees with.
    """
    return a.withColumn("_plain", _plain(F.col("term"))).join(b.withColumn("_plain", _plain(F.col("of_term"))), ["cui", "tty", "_plain"]).drop("_plain")


def atom_line(columns: tuple, sep: str = "|") -> Column:
    """An atom's columns as one line; nulls are empty."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


#: An atom's line with and without the preferred term's code.
TERM_LINE = ("id", "aui", "cui", "code", "pt_code", "term", "tty")
CODE_LINE = ("id", "aui", "cui", "code", "term", "tty")


def short_concept_line() -> Column:
    """An atom as a concept-file line that ends after the term."""
    v = lambda c: F.coalesce(F.col(c), F.lit(""))
    e = F.lit("")
    return F.concat(F.concat_ws("|", v("cui"), e, e, e, e, e, e, v("aui"), e, e, v("pt_code"), F.lit("MDR"), v("tty"), v("code"), v("term")), F.lit("|"))


def sql_file(rows: DataFrame, table: str) -> DataFrame:
    """(value): a text file's INSERT lines between the line that opens a transaction and the one that commits it."""
    spark = rows.sparkSession
    line = lambda s: spark.range(1, numPartitions=1).select(F.lit(s).alias("value"))
    return line("SET autocommit = OFF;").unionByName(persist.insert_lines(rows, table)).unionByName(line("COMMIT;"))


def remaining_text(sections: DataFrame, found: DataFrame) -> DataFrame:
    """Sections (guid, section, text, ...) without the terms that exact matching found there; found (guid, section, term)."""
    terms = found.groupBy("guid", "section").agg(F.collect_set("term").alias("_terms"))
    return sections.join(terms, ["guid", "section"], "left").withColumn("text", text.remove_terms(F.col("text"), F.col("_terms"))).drop("_terms")


def vocabulary_table(atoms: DataFrame, number: Number = persist.numbered) -> DataFrame:
    """(id, aui, cui, code, term, tty): a vocabulary's atoms, each once, with ids by aui; of unlike rows of one aui the least counts."""
    once = atoms.filter("trim(aui) <> ''").groupBy("aui").agg(F.min(F.struct("cui", "code", "term", "tty")).alias("r"))
    return number(once.select("aui", "r.*"), ["aui"], "id").select("id", "aui", "cui", "code", "term", "tty")


def text_tables(texts: DataFrame, number: Callable[[str], Number] = lambda _: persist.numbered) -> dict[str, DataFrame]:
    """The three text tables (id, guid, label_date, spl_text) of texts (guid, section, label_date, spl_text), ids by guid and text."""
    out = {}
    for section in ("AE", "IND", "BOX"):
        name = f"spl_{section.lower()}_text"
        rows = texts.filter((F.col("section") == section) & F.col("guid").isNotNull() & (F.col("spl_text") != "")).select("guid", "label_date", "spl_text").distinct()
        key = F.sha2(F.concat_ws("|", F.col("label_date").cast("string"), "spl_text"), 256)
        out[name] = number(name)(rows.withColumn("key", key), ["guid", "key"], "id").select("id", "guid", "label_date", "spl_text")
    return out


def source_type_table(spark: SparkSession) -> DataFrame:
    """(id, name): the fixed source types."""
    return spark.createDataFrame([(k, word.upper()) for word, k in SOURCE_TYPES], "id int, name string")


def version_table(spark: SparkSession, version: str) -> DataFrame:
    return spark.createDataFrame([(1, version)], "ref_id int, version string")
