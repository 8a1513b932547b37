"""Labels to products: the joins that give a label its atoms, codes, approvals and sponsors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vialstream.functions import codes


def split_mapped(labels: DataFrame, atoms: DataFrame, key: str = "guid") -> tuple[DataFrame, DataFrame]:
    """Labels with an atom, and those without."""
    keys = atoms.select(key).distinct()
    return labels.join(keys, key, "left_semi"), labels.join(keys, key, "left_anti")


def first_donor(unmapped: DataFrame, mapped: DataFrame, key: str = "ndc", order: str = "guid") -> DataFrame:
    """(order, donor): for each unmapped row the least mapped holder of the identical raw code."""
    donors = mapped.groupBy(key).agg(F.min(order).alias("donor"))
    return unmapped.filter(codes.digits(F.col(key)) != "").join(donors, key).groupBy(order).agg(F.min("donor").alias("donor"))


#: Keys of one concept set go in so many lanes, and there in blocks of at most so many drugs or labels.
LANES, DRUGS, LABELS = 16, 256, 32


def _blocks(rows: DataFrame, key: str, sets: str, most: int, out: str) -> DataFrame:
    """(sets, _lane, out): a set's keys in lanes by hash and, within a lane, in ascending blocks; a null key stays one."""
    n = F.row_number().over(Window.partitionBy(sets, "_lane").orderBy(key))
    laned = rows.withColumn("_lane", F.pmod(F.xxhash64(key), F.lit(LANES)).cast("int")).withColumn("_block", F.floor((n - 1) / most))
    keys = F.transform(F.collect_list(F.struct(F.col(key).alias("k"))), lambda x: x["k"])
    return laned.groupBy(sets, "_lane", "_block").agg(keys.alias(out)).drop("_block")


def drugs_by_ndc(labels: DataFrame, ndc_concepts: DataFrame, drugs: DataFrame) -> DataFrame:
    """(guid, aui) by raw code and concept, each pair once.

    The pairs may be far more than the input, so they are not shuffled to find copies: copies go before the join, and a pair
    that several concepts give is that of the least of them.  Blocks of drugs meet blocks of labels and open only behind the
    join: the rows of a block of drugs follow each other, so that files of the pairs stay small.  Lanes deal a concept to
    several tasks.
    """
    n = 4 * labels.sparkSession.sparkContext.defaultParallelism
    of = labels.select("guid", "ndc").join(ndc_concepts.select("ndc", "cui").distinct(), "ndc").groupBy("guid").agg(F.array_sort(F.collect_set("cui")).alias("_of"))
    has = drugs.groupBy("aui").agg(F.array_sort(F.collect_set("cui")).alias("_has"))
    left = _blocks(has, "aui", "_has", DRUGS, "_auis").select("_has", "_auis", F.explode("_has").alias("cui"))
    left = left.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))).repartition(n, "cui", "_lane")
    right = _blocks(of, "guid", "_of", LABELS, "_guids").withColumn("cui", F.explode("_of")).repartition(n, "cui", "_lane")
    once = (F.size("_of") == 1) | (F.size("_has") == 1) | (F.array_min(F.array_intersect("_of", "_has")) == F.col("cui"))
    # compiled with the join, explode would hold the rows of all matches of a block at once; coalesce parts the two
    both = left.hint("merge").join(right, ["cui", "_lane"]).filter(once).coalesce(n)
    return both.select("_auis", F.explode("_guids").alias("guid")).select("guid", F.explode("_auis").alias("aui"))


def union_by_priority(parts: list[DataFrame], key: str = "guid") -> DataFrame:
    """All parts, one row for each key: the first part that has it."""
    rows = None
    for k, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(k))
        rows = p if rows is None else rows.unionByName(p)
    w = Window.partitionBy(key).orderBy("_part")
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_part")


def classes_of(product_ndcs: DataFrame, ndc_class: DataFrame, raw: bool = False) -> DataFrame:
    """(product, ndc, class_aui): the greatest class atom of each normalised code; with ``raw`` the code stays as it was."""
    last = ndc_class.groupBy(F.col("ndc").alias("_norm")).agg(F.max("class_aui").alias("class_aui"))
    rows = product_ndcs.withColumn("_norm", codes.normalize_ndc(F.col("ndc"))).filter("_norm <> ''").join(last, "_norm")
    return rows.select("product", "ndc" if raw else F.col("_norm").alias("ndc"), "class_aui").distinct()


def with_brands(links: DataFrame, brands: DataFrame, key: str = "product") -> DataFrame:
    """(key, aui): links, and the brand names of the branded drugs among them; brands (drug_aui, brand_aui).

    Copies of a pair of drug and brand go before the join, which they would multiply.
    """
    own = links.select(key, "aui").distinct()
    more = own.join(brands.select(F.col("drug_aui").alias("aui"), "brand_aui").distinct(), "aui").select(key, F.col("brand_aui").alias("aui"))
    return own.unionByName(more).distinct()


def first_approvals(rows: DataFrame) -> DataFrame:
    """(appl_no, approved): the least date of original approvals."""
    ok = (F.upper(F.trim("submission_type")) == "ORIG") & (F.upper(F.trim("status")) == "AP")
    return rows.filter(ok).groupBy("appl_no").agg(F.min("status_date").alias("approved"))


def last_row_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value) of the last row of each key."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def first_row_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min_by(value, order).alias(value))


def fill_approvals(labels: DataFrame, approvals: DataFrame) -> DataFrame:
    """Labels without a date of their own get that of their application."""
    return labels.join(approvals, "appl_no", "left").withColumn("label_date", F.coalesce("label_date", "approved")).drop("approved")


def approved_labels(labels: DataFrame, approvals: DataFrame, sponsors: DataFrame) -> DataFrame:
    """(product, guid, application_number, approval_date, sponsor): one row for each label of a product.

    labels (product, guid, appl_no, label_date), approvals (appl_no, approved), sponsors (appl_no, sponsor).  A label without a
    date of its own gets the approval of the first label (by guid) of its product whose application has one; a date it has
    stays.  A product's sponsor is that of its last label (by guid) whose application has one.  Of several rows of one label
    the least date and the greatest number count; a label without a number has 0.
    """
    one = labels.groupBy("product", "guid").agg(F.max("appl_no").alias("appl_no"), F.min("label_date").alias("label_date"))
    known = one.join(approvals.select("appl_no", "approved"), "appl_no", "left").join(sponsors.select("appl_no", "sponsor"), "appl_no", "left")
    has = lambda c: F.when(F.col(c).isNotNull(), F.col("guid"))
    of = known.groupBy("product").agg(F.min_by("approved", has("approved")).alias("approved"), F.max_by("sponsor", has("sponsor")).alias("sponsor"))
    number, day = F.coalesce("appl_no", F.lit(0)), F.coalesce("label_date", "approved")
    return one.join(of, "product").select("product", "guid", number.alias("application_number"), day.alias("approval_date"), "sponsor")


def conflicts(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n): keys with several values."""
    return rows.groupBy(key).agg(F.count_distinct(value).alias("n")).filter("n > 1")


def owners(rows: DataFrame, key: str, owner: str) -> DataFrame:
    """Keys that several owners hold: an empty table if each has one."""
    return conflicts(rows, key, owner)


def by_keys(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Distinct rows whose key is wanted: an IN list of any length as a semi-join."""
    return rows.join(wanted.select(key), key, "left_semi").distinct()
