"""Product codes, hashes, dates and identifiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NDC_PATTERN = r"(?<![0-9A-Za-z_])[0-9]{4,5}-[0-9]{3,4}-[0-9]{1,2}(?![0-9A-Za-z_])"


def normalize_ndc(c: Column) -> Column:
    """``dddd-dddd`` gets a leading 0 and ``ddddd-dddd`` its nine characters; anything else is empty."""
    parts = F.split(c, "-", -1)
    a, b = F.length(parts[0]), F.length(F.try_element_at(parts, F.lit(2)))
    both = F.concat_ws("", parts)
    return F.when((F.size(parts) == 2) & (a == 4) & (b == 4), F.concat(F.lit("0"), both)).when((F.size(parts) == 2) & (a == 5) & (b == 4), both).otherwise("")


def pad_ndc(c: Column, length: int = 13) -> Column:
    """Codes that start with 0 are filled with zeros on the left."""
    return F.when(c.startswith("0"), F.lpad(c, F.greatest(F.length(c), F.lit(length)), F.lit("0"))).otherwise(c)


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def find_ndcs(c: Column) -> Column:
    """Distinct codes of a text, in order."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(NDC_PATTERN), 0))


def name_hash(code: Column, name: Column) -> Column:
    return F.sha2(F.lower(F.concat_ws("|", F.coalesce(code, F.lit("")), F.coalesce(name, F.lit("")))), 256)


def compact_date(c: Column) -> Column:
    """``yyyyMMdd`` of a mixed date string: the first 8 of 14 digits or more, 8, 6 (day 01) or 4 (January 1st)."""
    d = F.regexp_replace(c, "[^0-9]", "")
    n = F.length(d)
    return F.when(n >= 14, F.substring(d, 1, 8)).when(n == 8, d).when(n == 6, F.concat(d, F.lit("01"))).when(n == 4, F.concat(d, F.lit("0101")))


def parse_date(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(compact_date(c), F.lit("yyyyMMdd")))


def first_match_date(c: Column) -> Column:
    """A date or date and time, with ``T`` or a space between them; null if neither."""
    t = F.replace(F.trim(c), F.lit("T"), F.lit(" "))
    return F.to_date(F.coalesce(*[F.try_to_timestamp(t, F.lit(p)) for p in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy")]))


def change_id(url: Column) -> Column:
    """The id of a safety-change link: ``drug_id``, ``drugid`` or ``id``, else the second pair's value, else -1."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    named = F.regexp_extract(query, r"(?i)(?:^|&)(?:drug_id|drugid|id)=([0-9]+)(?:&|$)", 1)
    second = F.regexp_extract(query, r"^[^&]*&[^=&]*=([0-9]+)(?:&|$)", 1)
    return F.coalesce(F.try_to_number(F.when(named != "", named).when(second != "", second), F.lit("9999999999")).cast("int"), F.lit(-1))


def excipient_signature(ingredients: Column, actives: Column) -> Column:
    """Sorted distinct inactive ingredients, joined by ``|``."""
    return F.array_join(F.array_sort(F.array_distinct(F.array_except(ingredients, actives))), "|")


def source_type(path: Column) -> Column:
    p = F.lower(path)
    return F.when(p.contains("prescription"), "PRESCRIPTION").when(p.contains("other"), "OTHER").when(p.contains("otc"), "OTC").otherwise("UNKNOWN")
