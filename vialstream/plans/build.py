"""The whole build: labels and terminology to event, product and bridge tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialstream.functions import codes, text
from vialstream.operators import events, merge, ner, persist, star, training
from vialstream.operators import products as products_
from vialstream.sources import commit, html


def sections(labels: DataFrame) -> DataFrame:
    """(guid, section, label_date, text) of parsed labels (guid, label); a section without a date has the label's."""
    s = labels.select("guid", codes.parse_date(F.col("label.label_date")).alias("d"), F.explode("label.sections").alias("s"))
    return s.select("guid", "s.section", F.coalesce(codes.parse_date(F.col("s.section_date")), "d").alias("label_date"), "s.text")


def section_rows(parts: DataFrame) -> DataFrame:
    """(guid, label_date, section, n, sentence) of sections."""
    s = parts.select("guid", "label_date", "section", F.posexplode(text.sentences(F.lower("text"))).alias("n", "raw"))
    return s.select("guid", "label_date", "section", "n", text.split_special(F.col("raw")).alias("sentence"))


def gated(rows: DataFrame, model: PipelineModel | None, section: str, box: bool = False) -> DataFrame:
    """Sentences of one section that the classifier of sections leaves to it; box warnings pass unless ``box``."""
    if model is None or (section == "BOX" and not box):
        return rows
    return training.gate(rows.withColumn("text", text.normalize_punct(F.trim(F.lower("sentence")))), model, section).drop("text")


def _matches(rows: DataFrame, atoms: DataFrame, match: str, model: PipelineModel | None) -> DataFrame:
    """Atoms found in sections' sentences, by the exact or the stemmed pass."""
    entries, out = ner.dictionary(atoms, stemmed=match == "nlp"), None
    for section in ("IND", "AE", "BOX"):
        own = gated(rows.filter(F.col("section") == section), model, section)
        hits = ner.recognise(own, entries, "IND" if section == "IND" else "BLACKBOX" if section == "BOX" else "AE", match == "nlp")
        got = ner.codes_of(hits, atoms, match == "exact").withColumn("match", F.lit(match))
        out = got if out is None else out.unionByName(got)
    return out


def _both_passes(parts: DataFrame, atoms: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Exact and stemmed matches of sections (guid, section, label_date, text); the stemmed pass reads what the exact one left."""
    rows = section_rows(parts).persist()
    exact = merge.shared_folder(_matches(rows, atoms, "exact", model), "exact")
    rows.unpersist()
    left = star.remaining_text(parts, exact.select("guid", "section", "aui").distinct().join(atoms.select("aui", "term"), "aui"))
    return exact.unionByName(_matches(section_rows(left), atoms, "nlp", model))


def change_events(pages: DataFrame, links: DataFrame, atoms: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """(product, section, match, aui, first_added, guid): what safety changes add.

    pages (drug_id, html), links (product, guid, drug_id).  A page's sections are cleaned, boxes that say they were deleted go, both
    passes read the rest, and each product that links to the page gets the atoms with the change's date.
    """
    s = pages.select("drug_id", F.explode(html.change_rows(F.col("html"))).alias("s"))
    day = F.expr("try_to_date(s.date, 'M/d/yyyy')")
    s = s.select(F.col("drug_id").cast("string").alias("guid"), "s.section", day.alias("label_date"), text.clean_change_text(F.col("s.text")).alias("text"))
    s = merge.shared_folder(s.filter("label_date IS NOT NULL AND text <> ''").filter((F.col("section") != "BOX") | ~text.deleted_box(F.col("text"))), "changes")
    found = _both_passes(s, atoms, model).groupBy(F.col("guid").alias("drug_id"), "section", "match", "aui").agg(F.min("label_date").alias("first_added"))
    return found.join(links.filter("drug_id > 0").select("product", "guid", F.col("drug_id").cast("string").alias("drug_id")), "drug_id").select("product", "section", "match", "aui", "first_added", "guid")


def label_events(labels: DataFrame, atoms: DataFrame, changes: DataFrame | None = None, model: PipelineModel | None = None) -> DataFrame:
    """Event rows of labels: exact and stemmed matches of each section, with the earliest date of each atom.

    ``changes`` (``change_events`` rows by guid as product) bring dates forward and add codes before events are resolved.
    With ``model`` (``training.section_model``) both passes read only sentences that it leaves to their section.
    """
    parts = sections(labels).persist()
    out = merge.shared_folder(_both_passes(parts, atoms, model), "matches")
    parts.unpersist()
    e = events.earliest(out.withColumnsRenamed({"guid": "product", "label_date": "d"}).withColumn("source", F.col("product")), ["product", "section", "match", "aui"])
    if changes is not None:
        e = events.apply_changes(e, changes, ["product", "section", "match", "aui"])
    pt_key = F.coalesce(F.nullif(F.col("pt_code"), F.lit("")), F.col("code"))
    e = e.join(atoms.select("aui", "cui", "term", pt_key.alias("pt_key")), "aui")
    e = events.resolve(events.without_death(e))
    return events.reconcile_across(events.reconcile_bucket(e, ["product", "section", "match"]))


def tables(e: DataFrame, atoms: DataFrame, winners: DataFrame, more: dict[str, DataFrame] | None = None, ids: str | None = None, version: str | None = None) -> dict[str, DataFrame]:
    """Substances, terms, events and indications with ids; winners (guid, winner).

    ``more`` gives the rows of further tables by product guid: files (guid, path), changes (guid, drug_id, ...),
    names (guid, aui, ndc, name), classes (guid, ndc, atc_id), and links (guid, aui) named rxnorm, ingredient,
    snomed_pt and snomed_parent, with the ids of concepts (aui, id) in rxnorm_atoms and snomed_atoms.
    The ids of these may instead come from the build: rxnorm_terms, snomed_terms and atc_terms (aui, cui, code, term, tty) become
    tables of their own.  texts (guid, section, label_date, spl_text) become the three text tables; brands (guid, name) join the
    code table's names.  labels (guid, appl_no, label_date), approvals (appl_no, approved) and sponsors (appl_no, sponsor) give the
    source files their numbers, dates and sponsors.  Without classes, codes (guid, ndc) find them in code_classes
    (ndc, class_aui) and atc_atoms (aui, id).  brand_names (drug_aui, brand_aui) join the rxnorm links of branded drugs.  ``ids`` is a folder in which ids are kept from build to build; without one each build numbers anew.
    """
    more = more or {}

    def number(table: str) -> star.Number:
        return (lambda rows, order, name: persist.durable_ids(rows, order, name, f"{ids}/{table}")) if ids else persist.numbered

    terms = number("meddra")(atoms, ["code", "term", "aui"], "id")
    products = winners.select(F.col("winner").alias("product"), "guid")
    none = products.sparkSession.createDataFrame([], "guid {}, substance_id long".format(dict(products.dtypes)["guid"]))
    substances = persist.durable_product_ids(products, none, f"{ids}/substance") if ids else persist.numbered(products.select("product").distinct(), ["product"], "id")
    # each table below joins its labels to these: the join of winners and ids is made once
    product_of = merge.shared_folder(winners.join(substances, winners["winner"] == substances["product"]).select("guid", F.col("id").alias("product")), "products")
    own = lambda name: more[name].join(product_of, "guid")
    named = e.withColumnRenamed("product", "guid").join(product_of.withColumnRenamed("product", "product_id"), "guid")
    keys = named.groupBy("product_id", "section", "match", "aui").agg(F.min("first_added").alias("label_date"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"))
    facts = keys.join(terms.select("aui", F.col("id").alias("meddra_id")), "aui")
    shown = facts.select("product_id", "meddra_id", "label_date", (F.col("match") == "exact").alias("exact_match"), "section", "sources")
    out = {
        "substance": substances.select("id"), "meddra": terms, "product_ind": shown.filter("section = 'IND'").drop("section"),
        "product_ae": shown.filter("section <> 'IND'").withColumns({"warning": F.col("section") == "AE", "blackbox": F.col("section") == "BOX"}).drop("section"),
    }
    spark = products.sparkSession
    out["source_type"] = star.source_type_table(spark)
    if version:
        out["umls_version"] = star.version_table(spark, version)
    for name in ("rxnorm", "snomed", "atc"):
        if f"{name}_terms" in more:
            out[name] = star.vocabulary_table(more[f"{name}_terms"], number(name))
            more = {f"{name}_atoms": out[name].select("aui", "id")} | more
    if "texts" in more:
        out |= star.text_tables(more["texts"], number)
    if "brands" in more and "names" in more:
        own_brands = more["brands"].select("guid", F.lit("").alias("aui"), F.lit("").alias("ndc"), "name")
        more = more | {"names": more["names"].unionByName(own_brands)}
    if "codes" in more and "code_classes" in more and "classes" not in more:
        found = products_.classes_of(more["codes"].withColumnRenamed("guid", "product"), more["code_classes"], raw=True)
        ids_of = more["atc_atoms"].select(F.col("aui").alias("class_aui"), F.col("id").alias("atc_id"))
        more = more | {"classes": found.join(ids_of, "class_aui").select(F.col("product").alias("guid"), "ndc", "atc_id")}
    if "brand_names" in more and "rxnorm" in more:
        more = more | {"rxnorm": products_.with_brands(more["rxnorm"], more["brand_names"], "guid")}
    if "files" in more:
        files = star.source_files(own("files"), number=number("spl_srcfile"))
        out["spl_srcfile"] = files
        if "labels" in more:
            none_of = lambda c, kind: spark.createDataFrame([], f"appl_no int, {c} {kind}")
            labels = products_.approved_labels(own("labels"), more.get("approvals", none_of("approved", "date")), more.get("sponsors", none_of("sponsor", "string")))
            out["spl_srcfile"] = star.approved_files(files, labels)
        out["product_ind"], out["product_ind_src"] = star.fact_tables(out["product_ind"], files, ["product_id", "meddra_id", "exact_match"], number("product_ind"))
        out["product_ae"], out["product_ae_src"] = star.fact_tables(out["product_ae"], files, ["product_id", "meddra_id", "blackbox", "exact_match"], number("product_ae"))
    if "changes" in more:
        out["srlc"], out["substance_srlc"] = star.change_tables(own("changes"))
    if "names" in more and "classes" in more:
        out["ndc_code"], out["product_ndc"], out["substance_atc"] = star.code_tables(own("names"), own("classes"), number("ndc_code"))
    for table, name, of in (("substance_rxnorm", "rxnorm", "rxnorm"), ("substance_ingredient", "ingredient", "snomed"), ("substance_snomed_pt", "snomed_pt", "snomed"), ("substance_snomed_parent", "snomed_parent", "snomed")):
        if name in more:
            out[table] = star.concept_bridge(own(name), more[f"{of}_atoms"], f"{of}_id")
    return out


def write(out: dict[str, DataFrame], root: str) -> str:
    """All tables as the next version below ``root``, at once or not at all; returns its folder."""
    spark = next(iter(out.values())).sparkSession
    with commit.Transaction(spark, root) as t:
        for name, df in out.items():
            t.write(name, df)
    return commit.versions(root)[-1]


def write_sql(out: dict[str, DataFrame], root: str) -> str:
    """The tables as text files of INSERT statements, ordered by all columns, as ``write``."""
    spark = next(iter(out.values())).sparkSession
    with commit.Transaction(spark, root) as t:
        for name, df in out.items():
            t.write(name, star.sql_file(df.orderBy(*df.columns), name.upper()), "text")
    return commit.versions(root)[-1]
