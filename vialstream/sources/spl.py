"""Structured product labels: hardened XML, section text, codes, dates and numbers."""

from __future__ import annotations

import datetime
import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vialstream.functions import codes
from vialstream.functions import text as text_

# Section codes, code systems and roots of the public label format.
SECTIONS = {"IND": ("34067-9", "Indications"), "AE": ("34084-4", "Adverse_Reactions"), "BOX": ("34066-1", "Box")}
NDC_SYSTEM = "2.16.840.1.113883.6.69"
APPROVAL_ROOT = "2.16.840.1.113883.3.150"
FIRST_YEAR = 1910
OTHER_CODES = ("53404-0", "60683-0", "60684-8", "60682-2", "53405-7")
MOST_BYTES = 15 << 20
_NDC = re.compile(r"(?<![0-9A-Za-z_])[0-9]{4,5}-[0-9]{3,4}-[0-9]{1,2}(?![0-9A-Za-z_])")


def parse(xml: bytes | None) -> ET.Element | None:
    """The document's root with local tag names; None for broken files and any with a DOCTYPE or entities."""
    if not xml or re.search(rb"<!(DOCTYPE|ENTITY)", xml, re.I):
        return None
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return None
    for e in root.iter():
        if isinstance(e.tag, str):
            e.tag = e.tag.rpartition("}")[2]
    return root


def _squeeze(s: str) -> str:
    return re.sub(r"[\s ]+", " ", s).strip()


def label_class(doc: ET.Element | None) -> str | None:
    code = None if doc is None else doc.find("code")
    return None if code is None else code.get("displayName")


def document_code(doc: ET.Element | None) -> str | None:
    code = None if doc is None else doc.find("code")
    return None if code is None else code.get("code")


def product_name(doc: ET.Element | None) -> str | None:
    """The first product name that isn't blank, in capitals."""
    for body in [] if doc is None else doc.iter("structuredBody"):
        for p in body.iter("manufacturedProduct"):
            for n in p.findall("name"):
                if name := _squeeze("".join(n.itertext())):
                    return name.upper()
    return None


def layout(text: ET.Element) -> str:
    """Paragraphs, one a line; then tables, one row a line; then the rest."""
    lines = [_squeeze("".join(p.itertext())) for p in text.iter("paragraph")]
    for row in text.iter("tr"):
        lines.append(" ".join(_squeeze("".join(c.itertext())) for c in row if c.tag in ("td", "th")))
    taken = {id(x) for p in text.iter() if p.tag in ("paragraph", "table") for x in p.iter()}

    def rest(e: ET.Element):
        if id(e) not in taken:
            yield e.text or ""
            for c in e:
                yield from rest(c)
                yield c.tail or ""

    lines.append(_squeeze(" ".join(rest(text))))
    return "\n".join(x for x in lines if x)


def section_text(doc: ET.Element | None, code: str, name: str) -> tuple[str, int]:
    """Text of the sections with a code, and the pass that found it: 1 with the name as ID, 2 by code alone, 0 none."""
    found = [] if doc is None else [s for s in doc.iter("section") if any(c.get("code") == code for c in s.iter("code"))]
    for k, some in ((1, [s for s in found if (s.get("ID") or "").lower() == name.lower()]), (2, found)):
        if text := "\n".join(t for s in some for x in s.findall("text") if (t := layout(x))):
            return text, k
    return "", 0


def sane_date(value: str | None) -> str | None:
    d = re.sub(r"[^0-9]", "", value or "")[:8]
    if len(d) == 8 and FIRST_YEAR <= int(d[:4]) <= datetime.date.today().year + 1:
        try:
            datetime.datetime.strptime(d, "%Y%m%d")
        except ValueError:
            return None
        return d
    return None


def effective_dates(doc: ET.Element | None) -> list[str]:
    return [] if doc is None else [d for e in doc.iter("effectiveTime") if (d := sane_date(e.get("value")))]


def section_date(doc: ET.Element | None, code: str) -> str | None:
    """The first date of the first section whose own (first) code is ``code`` and which has one; None where it isn't sane."""
    for s in [] if doc is None else doc.iter("section"):
        own, at = next(s.iter("code"), None), next(s.iter("effectiveTime"), None)
        if own is not None and own.get("code") == code and at is not None and at.get("value"):
            return sane_date(at.get("value"))
    return None


def approval_date(doc: ET.Element | None) -> str | None:
    """The title's year of first approval, else the earliest sane date."""
    title = None if doc is None else doc.find("title")
    m = re.search(r"Initial\s+U\.?\s*S\.?\s+Approval\s*:\s*([0-9]{4})", _squeeze("".join(title.itertext())) if title is not None else "", re.I)
    if m and sane_date(m[1] + "0101"):
        return m[1] + "0101"
    return min(effective_dates(doc), default=None)


def application_number(doc: ET.Element | None) -> int:
    for e in [] if doc is None else doc.iter("id"):
        if e.get("root") == APPROVAL_ROOT:
            d = re.sub(r"[^0-9]", "", e.get("extension") or "")
            return int(d) if d and len(d) < 10 else -1
    return -1


def ndc_codes(doc: ET.Element | None, raw: str = "") -> list[str]:
    """Codes of the code system, then those the text shows; each once."""
    coded = [] if doc is None else [e.get("code") for e in doc.iter("code") if e.get("codeSystem") == NDC_SYSTEM and e.get("code")]
    return list(dict.fromkeys([*coded, *_NDC.findall(raw)]))


LABEL = T.StructType([
    T.StructField("ok", T.BooleanType()), T.StructField("document_code", T.StringType()), T.StructField("label_date", T.StringType()), T.StructField("approval_date", T.StringType()),
    T.StructField("application_number", T.IntegerType()), T.StructField("ndcs", T.ArrayType(T.StringType())),
    T.StructField("sections", T.ArrayType(T.StructType([T.StructField("section", T.StringType()), T.StructField("found_by", T.IntegerType()), T.StructField("section_date", T.StringType()), T.StructField("text", T.StringType())]))),
])


def _label(xml: bytes) -> dict:
    doc = parse(xml)
    dates = effective_dates(doc)
    sections = []
    for s, (code, name) in SECTIONS.items():
        text, by = section_text(doc, code, name)
        if text:
            sections.append({"section": s, "found_by": by, "section_date": section_date(doc, code) or (dates[0] if dates else None), "text": text})
    return {
        "ok": doc is not None, "document_code": document_code(doc), "label_date": dates[0] if dates else None, "approval_date": approval_date(doc),
        "application_number": application_number(doc), "ndcs": ndc_codes(doc, (xml or b"").decode("utf-8", "replace") if doc is not None else ""), "sections": sections,
    }


def labels(rows: DataFrame, xml: str = "xml") -> DataFrame:
    """``rows`` with the label's parts (column ``label``); broken files have ok false and nothing else."""

    @F.pandas_udf(LABEL)
    def parts(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_label(v) for v in x], columns=[f.name for f in LABEL.fields])

    return rows.withColumn("label", parts(xml)).drop(xml)


def allowed_codes(code: Column, mode: str, codes: tuple = OTHER_CODES) -> Column:
    """The filter of other labels' document codes: include, exclude or off; a null or blank code never passes."""
    if mode not in ("include", "exclude", "off"):
        raise ValueError(mode)
    code = F.coalesce(code, F.lit(""))
    some = F.trim(code) != ""
    return some if mode == "off" else some & code.isin(*codes) if mode == "include" else some & ~code.isin(*codes)


def guarded_files(files: DataFrame, root: str, most: int = MOST_BYTES) -> DataFrame:
    """Files (path, source_type, length) with the reason that bars each from parsing, null where none does.

    ``outside root``: not below ``root`` once ``.`` and ``..`` are resolved; ``outside subtree``: no folder xml_files with
    the source type's folder in it (any case) on the way; ``too large``: more bytes than ``most``, or none known.
    """
    parts = F.filter(F.split(F.regexp_replace("path", r"^file:/+", "/"), "/"), lambda p: (p != "") & (p != "."))
    flat = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, p)))
    base = [p for p in re.sub(r"^file:/+", "/", root).split("/") if p]
    n = len(base)
    below = (F.slice("_flat", 1, n) == F.array(*map(F.lit, base))) if n else F.lit(True)
    rest = F.slice("_flat", n + 1, F.greatest(F.size("_flat") - n, F.lit(0)))
    pairs = F.zip_with(F.slice(rest, 1, F.greatest(F.size(rest) - 2, F.lit(0))), F.slice(rest, 2, F.greatest(F.size(rest) - 2, F.lit(0))), lambda a, b: (a == "xml_files") & (F.lower(b) == F.lower("source_type")))
    inside = F.coalesce(F.exists(pairs, lambda x: x), F.lit(False))
    reason = F.when(~F.coalesce(below, F.lit(False)), "outside root").when(~inside, "outside subtree").when(F.coalesce(F.col("length") > most, F.lit(True)), "too large")
    return files.withColumn("_flat", flat).withColumn("barred", reason).drop("_flat")


def section_texts(labels: DataFrame) -> DataFrame:
    """(guid, section, label_date, spl_text): the text table of parsed labels (guid, label); sections without text have no row."""
    s = labels.select("guid", F.explode("label.sections").alias("s"))
    return s.filter("s.text <> ''").select("guid", "s.section", codes.parse_date(F.col("s.section_date")).alias("label_date"), text_.sanitize_literal(F.col("s.text")).alias("spl_text"))
