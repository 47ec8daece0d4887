"""Column expressions for cleaning, parsing and keying price records. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE = "decimal(18,6)"
EXACT = "decimal(38,20)"
PARSED = "decimal(28,10)"

# Strength patterns in order, with the unit that each stands for.
STRENGTH_PATTERNS = (
    ("mg/ml", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*mg\s*/\s*ml\s*$"),
    ("mg/ml", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*mg\s*/\s*([0-9]+(?:\.[0-9]+)?)\s*ml\s*$"),
    ("ug/ml", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(?:mcg|µg|ug)\s*/\s*ml\s*$"),
    ("[iU]/ml", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(?:IU|iu)\s*/\s*ml\s*$"),
    ("mg", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*mg\s*$"),
    ("g", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*g\s*$"),
    ("ug", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(?:mcg|µg|ug)\s*$"),
    ("[iU]", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*(?:IU|iu|j\.?\s*m\.?)\s*$"),
    ("%", r"^\s*([0-9]+(?:\.[0-9]+)?)\s*%\s*$"),
)
# Pack-size patterns in order.
PACK_PATTERNS = (
    ("integer", r"^\s*([0-9]+)\s*$"),
    (
        "integer_tablets",
        r"^\s*([0-9]+)\s*(?:tab|tabs|tablet|tablets|caps|capsules|tabletka|tabletki|kapsu[lł]ka|kapsu[lł]ki|comprime|comprimes|comprimés|comprimé|gélule|gélules|gelule|gelules)\s*$",
    ),
    ("polish_szt", r"^\s*([0-9]+)\s*szt\.?\s*$"),
    ("polish_fiol", r"^\s*([0-9]+)\s*fiol\.?\s*$"),
    ("polish_amp", r"^\s*([0-9]+)\s*amp\.?\s*$"),
    ("count_x_volume", r"^\s*([0-9]+)\s*[xX×]\s*[0-9]+(?:\.[0-9]+)?\s*[a-zA-Z/]*\s*$"),
)
_FOLD = "(?iu)"


def null_if_blank(c: Column) -> Column:
    """Trimmed text; null where it is blank or the word nan."""
    text = F.trim(c.cast("string"))
    return F.when((text != "") & (F.lower(text) != "nan"), text)


def filled(mapped: Column, derived: Column) -> Column:
    """``mapped`` where it holds something, else ``derived``."""
    return F.coalesce(null_if_blank(mapped), derived)


def locale_decimal(c: Column, separator: str = ".") -> Column:
    """A price with the given decimal separator; spaces are passed over where that is a comma. Null where it isn't a number."""
    text = F.replace(F.trim(c), F.lit(separator), F.lit("."))
    if separator == ",":
        text = F.replace(text, F.lit(" "), F.lit(""))
    return text.try_cast(PRICE)


def retail_decimal(c: Column) -> Column:
    """A public retail price: no-break spaces and euro signs go; a dot parts thousands only where there is a comma."""
    text = F.trim(F.regexp_replace(null_if_blank(c), "[ €]", ""))
    grouped = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(text.contains(","), grouped).otherwise(text).try_cast(PRICE)


def first_match(text: Column, patterns: list[str]) -> Column:
    """Group 1 of the first pattern that matches, ignoring case; null where none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, _FOLD + p, 1), F.lit("")) for p in patterns])


def first_label(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Label of the first (pattern, label) whose pattern is found in ``text``."""
    return F.coalesce(*[F.when(text.rlike(_FOLD + p), F.lit(label)) for p, label in rules])


def once(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are computed once for each row, whatever refers to them: the optimiser merges projections and would
    repeat an expression at every reference, but never merges through a generator (here of one row)."""
    for name, value in values.items():
        df = df.select("*", F.explode(F.array(value)).alias(name))
    return df


def _first(text: Column, patterns: tuple[tuple[str, str], ...]) -> Column:
    """struct(label, a, b) of the first pattern that matches the text, with its first two groups; null where none does."""
    found = []
    for label, p in patterns:
        group = lambda g: F.regexp_extract(text, _FOLD + p, g)
        second = group(2) if p.count("([0-9]+") > 1 else F.lit(None).cast("string")
        found.append(F.when(text.rlike(_FOLD + p), F.struct(F.lit(label).alias("label"), group(1).alias("a"), second.alias("b"))))
    return F.coalesce(*found)


def parse_strength(raw: Column) -> Column:
    """struct(value, unit, pattern): milligrams by volume are divided; null for combinations, a zero volume and what no pattern reads."""
    text = F.trim(raw)
    combined = text.rlike(r"(?i)^[0-9.]+/[0-9.]+(?!\s*ml)")

    def made(found: Column) -> Column:
        value, volume = found["a"].try_cast(PARSED), found["b"].try_cast(PARSED)
        one = F.when(found["b"].isNull(), value).when(volume != 0, (value / volume).cast(PARSED))
        return F.struct(one.alias("value"), found["label"].alias("unit"), F.concat(F.lit("strength:"), found["label"]).alias("pattern"))

    # The cascade is written once: a lambda's variable stands for what it found.
    parsed = F.transform(F.array(F.when(~combined, _first(text, STRENGTH_PATTERNS))), made)[0]
    return F.transform(F.array(parsed), lambda p: F.when(p["value"].isNotNull(), p))[0]


def parse_pack(raw: Column) -> Column:
    """struct(units, pattern); null where no pattern reads it."""
    made = lambda f: F.when(f.isNotNull(), F.struct(f["a"].try_cast("int").alias("units"), F.concat(F.lit("pack:"), f["label"]).alias("pattern")))
    return F.transform(F.array(_first(raw, PACK_PATTERNS)), made)[0]


def leading_pack(c: Column) -> Column:
    """The integer that the text begins with, else the trimmed text."""
    return F.coalesce(F.nullif(F.regexp_extract(F.trim(c), r"^\d+", 0), F.lit("")), F.trim(c))


def joined_name(name: Column, detail: Column) -> Column:
    """``name`` with ``detail`` appended, unless either is empty or the name has it already, whatever the case."""
    a, b = F.coalesce(null_if_blank(name), F.lit("")), F.coalesce(null_if_blank(detail), F.lit(""))
    return F.when(b == "", a).when(a == "", b).when(F.contains(F.lower(a), F.lower(b)), a).otherwise(F.concat_ws(" ", a, b))


def atc_code(c: Column) -> Column:
    """The level-5 code in the text, else null."""
    return F.nullif(F.regexp_extract(c, r"\b([A-Z][0-9]{2}[A-Z]{2}[0-9]{2})\b", 1), F.lit(""))


def per_unit(amount: Column, units: Column) -> Column:
    return F.when((amount > 0) & (units > 0), (amount.cast("decimal(28,12)") / units.cast("decimal(10,0)")).cast(EXACT))


def per_strength(unit_price: Column, value: Column) -> Column:
    return F.when(value > 0, F.try_divide(unit_price.cast("decimal(29,17)"), value.cast(PRICE)).cast(EXACT))


def stable_id(*parts: Column) -> Column:
    """A UUID-shaped id from the SHA-256 of the parts, joined by colons: the same parts give the same id."""
    h = F.sha2(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def plain_decimal(c: Column) -> Column:
    """A decimal as text without an exponent or trailing zeros."""
    text = c.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def attribute_list(c: Column) -> Column:
    """An array of arrays as one array, without nulls and blanks."""
    return F.filter(F.flatten(F.filter(c, lambda a: a.isNotNull())), lambda x: x.isNotNull() & (F.trim(x) != ""))


def polish_name(text: Column, forms: list[tuple[str, str]]) -> Column:
    """struct(name, form, strength) of a composite name such as ``Adeksa, tabl., 100 mg``.

    Fields are parted by commas; a field of digits takes in the fields that follow and begin with a digit,
    because the comma was a decimal one. The first later field with a form or a strength gives it.
    """
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    numeric = lambda p: p.rlike(r"^[0-9]") & ~p.rlike("[a-zA-ZąćęłńóśźżĄĆĘŁŃÓŚŹŻ]")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(acc: Column, p: Column) -> Column:
        goes_on = acc["open"].isNotNull() & p.rlike(r"^[0-9]")
        closed = F.when(acc["open"].isNotNull(), F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
        return (
            F.when(goes_on, F.struct(acc["done"].alias("done"), F.concat_ws(",", acc["open"], p).alias("open")))
            .when(numeric(p), F.struct(closed.alias("done"), p.alias("open")))
            .otherwise(F.struct(F.concat(closed, F.array(p)).alias("done"), F.lit(None).cast("string").alias("open")))
        )

    merged = F.aggregate(parts, start, step, lambda a: F.when(a["open"].isNotNull(), F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"]))
    rest = F.slice(merged, F.lit(2), F.greatest(F.size(merged), F.lit(1)))
    strong = r"(?iu)[0-9]+(?:[.,][0-9]+)?(?:\s*\+\s*[0-9]+(?:[.,][0-9]+)?)?\s*(?:mg|g|mcg|µg|ml|iu|j\.?\s*m\.?|%|mln|tys)"
    strength = F.try_element_at(F.filter(rest, lambda p: p.rlike(strong)), F.lit(1))
    strength = F.regexp_replace(F.replace(strength, F.lit(","), F.lit(".")), r"(\d)\s+(\d)", "$1$2")
    form = F.try_element_at(F.filter(F.transform(rest, lambda p: first_label(p, forms)), lambda x: x.isNotNull()), F.lit(1))
    return F.struct(F.try_element_at(merged, F.lit(1)).alias("name"), form.alias("form"), strength.alias("strength"))
