"""Extraction of fields from a table of pages with column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import once

# What the public pages' elements look like.
_ELEMENT = r"(?is)<(?:label|span|div)\b[^>]*>(.*?)</(?:label|span|div)>"
#: The element after the first one, which is taken whole (a match never goes back into it).
_SECOND = "(?is)(?>" + _ELEMENT.removeprefix("(?is)").replace("(.*?)", ".*?") + ").*?" + _ELEMENT.removeprefix("(?is)")
WINDOW = 12_000
#: Code points of named entities, from Python's table of HTML.
_NAMES = {**name2codepoint, "apos": 39}
_ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def decoded(text: Column) -> Column:
    """Named and numeric entities as characters; an unknown one stays as it is. Each is decoded once, so &amp;lt; gives &lt;."""
    names = F.create_map(*[F.lit(x) for kv in _NAMES.items() for x in kv])
    found = F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(1))

    def one(name: Column) -> Column:
        hexadecimal = F.conv(F.substring(name, 3, 8), 16, 10)
        number = F.when(F.lower(name).startswith("#x"), hexadecimal.cast("int")).when(name.startswith("#"), F.substring(name, 2, 8).cast("int")).otherwise(F.try_element_at(names, name))
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32")
        return F.when(F.coalesce(valid, F.lit(False)), char).otherwise(F.concat(F.lit("&"), name, F.lit(";")))

    rest = F.split(text, _ENTITY, -1)
    joined = F.array_join(F.zip_with(rest, F.transform(found, one), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(text.contains("&"), joined).otherwise(text)


def visible_text(markup: Column) -> Column:
    """Text without scripts, styles and tags, entities decoded, space (no-break space too) collapsed."""
    out = F.regexp_replace(markup, r"(?is)<script\b.*?</script>|<style\b.*?</style>", " ")
    return F.trim(F.regexp_replace(decoded(F.regexp_replace(out, "<[^>]+>", " ")), r"[\s\x{A0}]+", " "))


def text_by_id(markup: Column, element: str) -> Column:
    import re

    return visible_text(F.regexp_extract(markup, rf"(?is)<(?:label|span|div)\b[^>]*\bid=[\"']{re.escape(element)}[\"'][^>]*>(.*?)</(?:label|span|div)>", 1))


def value_after(markup: Column, label: str) -> Column:
    """Text of the first element with any within 12,000 characters after the label; empty if the label isn't there."""
    at = F.locate(label, markup)
    tail = F.substring(markup, at + len(label), F.lit(WINDOW))
    given = lambda texts: F.try_element_at(F.filter(F.transform(texts, visible_text), lambda t: (t != "") & (t != label.rstrip(":"))), F.lit(1))
    # Mostly the first or second element has it; all of them are read only where neither does.
    near = [given(F.array(F.regexp_extract(tail, p, 1))) for p in (_ELEMENT, _SECOND)]
    return F.when(at > 0, F.coalesce(*near, given(F.regexp_extract_all(tail, F.lit(_ELEMENT), F.lit(1))), F.lit(""))).otherwise("")


def options(pages: DataFrame, markup: str = "html", key: str = "page_id") -> DataFrame:
    """(key, value, code, label) of level-5 options, the first for each code of a page."""
    p = r"(?is)<option\b[^>]*\bvalue=[\"'](REF_CLASS_ATC:([A-Z][0-9]{2}[A-Z]{2}[0-9]{2}))[\"'][^>]*>(.*?)</option>"
    get = lambda g: F.regexp_extract_all(F.col(markup), F.lit(p), F.lit(g))
    rows = pages.select(key, F.posexplode(F.arrays_zip(get(1).alias("value"), get(2).alias("code"), get(3).alias("label"))).alias("pos", "o"))
    first = rows.groupBy(key, F.col("o.code").alias("code")).agg(F.min_by("o", "pos").alias("o"))
    return first.select(key, "o.value", "code", visible_text(F.col("o.label")).alias("label"))


def link_ids(markup: Column, pattern: str = r"(?i)\bid=[\"'](mainForm:dt-medicamentos:\d+:linkNome)[\"']") -> Column:
    return F.array_distinct(F.regexp_extract_all(markup, F.lit(pattern), F.lit(1)))


def result_count(markup: Column) -> Column:
    return F.coalesce(F.regexp_extract(markup, r"(?i)\btotal de\s+(\d+)\s+registos\b", 1).try_cast("int"), F.lit(0))


def sections(pages: DataFrame, marker: str, markup: str = "html") -> DataFrame:
    """One row for each section of a page, from a marker to the next one."""
    parts = F.split(F.col(markup), marker)
    return pages.select("*", F.posexplode(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("section_no", "section"))


def joined_labels(section: Column, pattern: str = r"(?is)<span\b[^>]*\bbtn\s+btn-link\b[^>]*>(.*?)</span>") -> Column:
    return F.array_join(F.array_distinct(F.filter(F.transform(F.regexp_extract_all(section, F.lit(pattern), F.lit(1)), visible_text), lambda t: t != "")), "; ")


def price_rows(pages: DataFrame, markup: str = "html", key: str = "page_id") -> DataFrame:
    """One row for each presentation with a numeric price, each (code, presentation, price) of a page once."""
    m, s = F.col(markup), F.col("section")
    base = {"Nome do Medicamento": F.coalesce(F.nullif(text_by_id(m, "detalheMedNomeMed"), F.lit("")), value_after(m, "Nome do Medicamento:"))}
    base |= {n: value_after(m, lab) for n, lab in (("Substância Ativa/DCI", "Substância Ativa/DCI:"), ("Forma Farmacêutica", "Forma Farmacêutica:"), ("Dosagem", "Dosagem:"), ("Titular de AIM", "Titular de AIM:"), ("Via", "Via(s) de Administração:"), ("ATC", "Classificação ATC:"))}
    rows = sections(pages.select(key, m.alias(markup), *[v.alias(k) for k, v in base.items()]), r"(?i)\bembalagem-main-panel\b", markup)
    rows = once(rows, PVP=F.trim(F.replace(value_after(s, "PVP:"), F.lit("€"), F.lit("")))).where(F.col("PVP").rlike("[0-9]"))
    rows = rows.withColumns({"Apresentação": joined_labels(s), "Código": value_after(s, "Número de Registo:"), "CNPEM": value_after(s, "CNPEM:")})
    return rows.dropDuplicates([key, "Código", "Apresentação", "PVP"]).drop(markup, "section", "section_no")
