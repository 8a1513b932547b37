"""Star-schema tables: ids by stable order, bridges, facts, exports and foreign-key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialstream.functions import codes, text
from vialstream.sources import commit

FIRST_ID = 100


def numbered(rows: DataFrame, order: list, name: str = "id", first: int = FIRST_ID) -> DataFrame:
    """Dense ids from ``first`` in a stable order, without one task that sorts all rows: ranges are sorted apart, and
    each range's ids start after the rows of the ranges before it."""
    spark = rows.sparkSession
    cut = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    from vialstream.operators.merge import shared_folder

    cut = shared_folder(cut, "numbered")  # the numbers must not be drawn anew
    cut = cut.withColumn("_p", F.shiftright("_m", 33))
    sizes = cut.groupBy("_p").count()
    before = sizes.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    return cut.join(F.broadcast(before), "_p").withColumn(name, F.col("_before") + F.col("_m") - F.shiftleft("_p", 33) + first).drop("_m", "_p", "_before")


def terminology_table(atoms: DataFrame, first: int = FIRST_ID) -> DataFrame:
    """Atoms with ids, by (code, term, aui)."""
    return numbered(atoms, ["code", "term", "aui"], "id", first)


def product_ids(products: DataFrame, prior: DataFrame, first: int = FIRST_ID) -> DataFrame:
    """(product, min_guid, id): the least prior id of its labels, else the next number by least guid.

    products (product, guid), prior (guid, substance_id).
    """
    least = products.join(prior, "guid", "left").groupBy("product").agg(F.min("guid").alias("min_guid"), F.min("substance_id").alias("prior_id"))
    top = prior.agg(F.coalesce(F.max("substance_id"), F.lit(first - 1))).first()[0]
    new = numbered(least.filter("prior_id IS NULL"), ["min_guid", "product"], "id", max(first, int(top) + 1))
    return least.filter("prior_id IS NOT NULL").select("product", "min_guid", F.col("prior_id").cast("long").alias("id")).unionByName(new.select("product", "min_guid", "id"))


def durable_ids(rows: DataFrame, order: list[str], name: str, root: str, first: int = FIRST_ID, tries: int = 5) -> DataFrame:
    """``rows`` with ids that later builds keep: keys (the ``order`` columns) known below ``root`` have theirs, new ones
    get the next numbers in a stable order and are added in one transaction.

    No number is ever given twice or taken back; keys that a build lacks keep theirs for a later one.  Rows without new
    keys add nothing.  A build that meets another's commit reads its numbers and tries again.
    """
    spark = rows.sparkSession
    keys = rows.select(*order).distinct()
    for _ in range(tries):
        known = commit.read(spark, root, "ids", every=True) if commit.versions(root) else spark.createDataFrame([], keys.schema.add(name, "long"))
        new = _by_keys(keys, known, order, "left_anti")
        top = known.agg(F.max(name)).first()[0]
        added = numbered(new, order, name, first if top is None else max(first, top + 1)).select(*order, name)
        if added.isEmpty():
            return _by_keys(rows, known, order, "inner")
        try:
            with commit.Transaction(spark, root) as t:
                t.write("ids", added)
        except commit.Conflict:
            continue
        return _by_keys(rows, commit.read(spark, root, "ids", every=True), order, "inner")
    raise commit.Conflict(f"{root}: others committed {tries} times")


def _by_keys(rows: DataFrame, ids: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join on keys that may be null."""
    ids = ids.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on &= rows[k].eqNullSafe(ids[f"_{k}"])
    return rows.join(ids, on, how).drop(*[f"_{k}" for k in keys])


def durable_product_ids(products: DataFrame, prior: DataFrame, root: str, first: int = FIRST_ID) -> DataFrame:
    """``product_ids`` that later builds keep: each label's number is remembered below ``root``.

    Where labels part, their number goes with the least guid of those that had it; a product has the least number that
    came to it so, else the next new one.
    """
    from vialstream.operators.merge import shared_folder

    spark = products.sparkSession
    kinds = dict(products.dtypes)
    known = commit.read(spark, root, "labels", every=True) if commit.versions(root) else spark.createDataFrame([], f"guid {kinds['guid']}, substance_id long")
    had = products.join(prior.select("guid", F.col("substance_id").cast("long").alias("substance_id")).unionByName(known), "guid")
    heirs = had.groupBy("substance_id").agg(F.min(F.struct("guid", "product")).alias("least")).select("substance_id", "least.product", "least.guid")
    top = known.agg(F.max("substance_id")).first()[0]
    ids = shared_folder(product_ids(products, heirs.select("guid", "substance_id"), max(first, (top or 0) + 1)), "products")
    added = products.join(ids, "product").join(known.select("guid"), "guid", "left_anti").groupBy("guid").agg(F.min("id").alias("substance_id"))
    if not added.isEmpty():
        with commit.Transaction(spark, root) as t:
            t.write("labels", added)
    return ids


def ndc_table(rows: DataFrame) -> DataFrame:
    """(ndc, name, hash): one row for each code, with its least name; rows without a code are kept by (aui, name)."""
    some = rows.filter("ndc <> ''").groupBy("ndc").agg(F.min("name").alias("name"))
    none = rows.filter("ndc = '' OR ndc IS NULL").select("aui", "name").distinct().select(F.lit("").alias("ndc"), "name")
    return some.unionByName(none).withColumn("hash", codes.name_hash(F.col("ndc"), F.col("name")))


def first_sources(files: DataFrame) -> DataFrame:
    """(guid, src_id): the least id of each guid's files."""
    return files.groupBy("guid").agg(F.min("src_id").alias("src_id"))


def fact_sources(facts: DataFrame, sources: DataFrame) -> DataFrame:
    """(fact_id, src_id): known sources of each fact; unknown ones drop out."""
    return facts.select("fact_id", F.explode("sources").alias("guid")).join(sources, "guid").select("fact_id", "src_id").distinct()


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose foreign key has no parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def pipe_line(columns: list[Column]) -> Column:
    """One line of a pipe-delimited export; nulls are empty."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def concept_line(a: str = "") -> Column:
    """An atom as a concept-file line: cui, language, aui, source, type, code and term in their places."""
    v = lambda c: F.coalesce(F.col(f"{a}{c}"), F.lit(""))
    e = F.lit("")
    return F.concat(F.concat_ws("|", v("cui"), F.lit("ENG"), e, e, e, e, e, v("aui"), e, e, v("pt_code"), v("sab"), v("tty"), v("code"), v("term"), e, F.lit("N"), e), F.lit("|"))


def insert_lines(rows: DataFrame, table: str) -> DataFrame:
    """Rows as INSERT statements (text sinks only; Parquet tables need none)."""
    literals = [F.when(F.col(c).isNull(), "NULL").otherwise(F.col(c).cast("string")) if t in ("int", "bigint", "double", "boolean") else F.when(F.col(c).isNull(), "NULL").otherwise(F.concat(F.lit("'"), text.sanitize_literal(F.col(c).cast("string")), F.lit("'"))) for c, t in rows.dtypes]
    return rows.select(F.concat(F.lit(f"INSERT INTO {table} ({', '.join(rows.columns)}) VALUES ("), F.concat_ws(", ", *literals), F.lit(");")).alias("value"))


def write_export(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("sep", "|").option("header", True).csv(path)


def export_products(facts: DataFrame, codes_: DataFrame, names: DataFrame) -> DataFrame:
    """(line): each product's distinct codes with the product's name.  facts (product, atom), codes_ (atom, code), names (product, name)."""
    j = facts.select("product", "atom").distinct().join(codes_, "atom").join(names, "product")
    return j.select(pipe_line([F.col("product"), F.col("code"), F.col("name")]).alias("line")).distinct().orderBy("line")


def export_events(facts: DataFrame, atoms: DataFrame) -> DataFrame:
    """(line): product, atom, first date and boxed flag of each event.  facts (product, atom, date, boxed), atoms (atom)."""
    g = facts.join(atoms, "atom", "left_semi").groupBy("product", "atom").agg(F.min("date").alias("date"), F.max(F.col("boxed").cast("int")).alias("boxed"))
    return g.select(pipe_line([F.col("product"), F.col("atom"), F.date_format("date", "yyyy-MM-dd"), F.col("boxed")]).alias("line"))


def export_labels(labels: DataFrame) -> DataFrame:
    """(line): labels (id, guid, name) in order of id and guid; null names are empty."""
    return labels.orderBy("id", "guid").select(pipe_line([F.col("id"), F.col("guid"), F.col("name")]).alias("line"))


def export_bridge(links: DataFrame, left: str, right: str) -> DataFrame:
    """(line): a bridge table's links in the order of both ids."""
    return links.select(left, right).orderBy(left, right).select(pipe_line([F.col(left), F.col(right)]).alias("line"))
