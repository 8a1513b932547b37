"""Training data and the section classifier of the label pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vialstream.functions import text


def top_sentences(rows: DataFrame, label: str, most: int, least_words: int = 4) -> DataFrame:
    """At most ``most`` distinct normalised sentences of each class, those of the least ids: (label, sentence, id)."""
    n = rows.withColumn("sentence", text.clean_term(F.regexp_replace("sentence", r"\s+", " "))).filter(F.size(text.words(F.col("sentence"))) >= least_words)
    once = n.groupBy(label, "sentence").agg(F.min("id").alias("id"))
    w = Window.partitionBy(label).orderBy("id", "sentence")
    return once.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")


def lemma_triples(rows: DataFrame) -> DataFrame:
    return rows.select("token", "tag", "lemma").distinct()


def section_model(rows: DataFrame, cutoff: int = 2, steps: int = 30):
    """A section classifier (text, label): words, word pairs and character n-grams, logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer, NGram, RegexTokenizer, SQLTransformer, StringIndexer, VectorAssembler

    chars = "SELECT *, flatten(transform(w, x -> flatten(transform(sequence(3, 5), n -> transform(sequence(1, greatest(length(x) - n + 1, 1)), i -> substring(x, i, n)))))) AS c FROM __THIS__"
    stages = [
        RegexTokenizer(inputCol="text", outputCol="w", pattern="[^a-z0-9]+"), NGram(n=2, inputCol="w", outputCol="p"), SQLTransformer(statement=chars),
        CountVectorizer(inputCol="w", outputCol="fw", minDF=cutoff), CountVectorizer(inputCol="p", outputCol="fp", minDF=cutoff), CountVectorizer(inputCol="c", outputCol="fc", minDF=cutoff),
        VectorAssembler(inputCols=["fw", "fp", "fc"], outputCol="features"), StringIndexer(inputCol="label", outputCol="y"), LogisticRegression(labelCol="y", maxIter=steps),
    ]
    return Pipeline(stages=stages).fit(rows)


def gate(rows: DataFrame, model, section: str, least: float = 0.25) -> DataFrame:
    """Rows that the classifier doesn't give to another section with less than ``least`` left for this one; none of a section it never saw."""
    from pyspark.ml.functions import vector_to_array

    labels = model.stages[-2].labels
    if section not in labels:
        return rows.filter(F.lit(False))
    at = labels.index(section)
    scored = model.transform(rows.withColumn("label", F.lit(section)))
    ok = (F.col("prediction") == at) | (vector_to_array("probability")[at] >= least)
    return scored.filter(ok).select(rows.columns)


def word_counts(rows: DataFrame, column: str, least: int = 1) -> DataFrame:
    """(word, n): words of cleaned texts that occur ``least`` times or more; counted before the shuffle."""
    w = rows.select(F.explode(text.words(text.clean_term(F.col(column)))).alias("word"))
    return w.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def harvest_suffixes(terms: DataFrame, bases: DataFrame, order: str) -> DataFrame:
    """(suffix, base, example): four-letter tails ``-xxxx`` behind a known base name; the first term of each tail counts.

    A tail's base is what stands before it (letters and spaces, from the letter where the match before it ended), else its last two
    words, else its last word.  terms (term, ``order``), bases (base); both are compared in lower case.
    """
    tail = F.lit(r"(?i)([A-Za-z][A-Za-z\s]{0,60})-([a-z]{4})\b")
    low = terms.select(order, F.lower("term").alias("term"))
    stems, tails = (F.regexp_extract_all("term", tail, F.lit(k)) for k in (1, 2))
    cut = low.select(order, "term", F.posexplode(F.arrays_zip(stems.alias("stem"), tails.alias("suffix"))).alias("at", "x"))
    w = text.words(F.regexp_replace("x.stem", r"[^a-z\s]", " "))
    n = F.size("w")
    last = lambda k: F.array_join(F.slice("w", n - k + 1, F.lit(k)), " ")
    cut = cut.select(order, "term", "at", F.col("x.suffix").alias("suffix"), w.alias("w")).filter(n > 0)
    tries = F.array(F.array_join("w", " "), F.when(n >= 2, last(2)), last(1))
    rows = cut.select(order, "term", "at", "suffix", F.posexplode(tries).alias("rank", "base")).filter("base IS NOT NULL")
    known = rows.join(bases.select(F.lower(F.trim("base")).alias("base")).distinct(), "base", "left_semi")
    best = known.groupBy(order, "at", "suffix", "term").agg(F.min_by("base", "rank").alias("base"))
    first = F.struct(order, "at")
    return best.groupBy("suffix").agg(F.min_by("base", first).alias("base"), F.min_by("term", first).alias("example"))


def section_training(tables: dict[str, DataFrame], most: int, since: str | None = None, least_words: int = 4) -> DataFrame:
    """``top_sentences`` of text tables (id, text, label_date) by label: the first 2 * ``most`` rows of each since a date, cut into sentences."""
    parts = None
    for label, rows in tables.items():
        rows = rows if since is None else rows.filter(F.col("label_date") >= F.to_date(F.lit(since)))
        rows = rows.orderBy("id").limit(2 * most).select(F.lit(label).alias("label"), "id", F.explode(text.sentences(F.col("text"))).alias("sentence"))
        parts = rows if parts is None else parts.unionByName(rows)
    return top_sentences(parts, "label", most, least_words)


def lemma_words(rows: DataFrame, most: int = 70_000, since: str | None = None, shortest: int = 2, longest: int = 60) -> DataFrame:
    """(id, n, word): words of the first ``most`` texts (id, text, label_date) since a date, of bounded length."""
    rows = rows if since is None else rows.filter(F.col("label_date") >= F.to_date(F.lit(since)))
    w = rows.orderBy("id").limit(most).select("id", F.posexplode(text.words(text.clean_term(F.col("text")))).alias("n", "word"))
    return w.filter(F.length("word").between(shortest, longest))
