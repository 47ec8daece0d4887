"""Raw country rows to canonical price records, with every rejected row kept as an anomaly."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.forms import IE_NAME_FORMS, PL_NAME_FORMS, normalised_form
from ..functions.molecules import first_per_key, resolve_identity
from ..functions.scalars import atc_code, filled, first_label, first_match, joined_name, leading_pack, locale_decimal, null_if_blank, once, polish_name, retail_decimal, stable_id
from ..sources.tables import by_texts
from .policy import small

REQUIRED = ("product_name", "strength", "dosage_form", "pack_size")
TARGETS = ("product_code", "product_name", "inn", "atc_code", "strength", "dosage_form", "pack_size", "manufacturer", "price")
#: What a record keeps of its form's reading.
FORM = ("route_of_administration", "dosage_form_raw", "form_attributes", "form_confidence", "form_rule_id", "form_caveat")


@dataclass(frozen=True)
class Country:
    """How one country's list is read.

    ``mapping``: source column -> canonical field (of several columns of a field the first that holds something).
    ``prefixes``: price column -> beginning of its header. ``derived``: field -> function of the frame, applied where the
    mapped value is empty. ``cleaned``: field -> function of its column, applied last. ``prices``: columns to unpivot, else
    ``price`` is one lane named ``price_type``. ``skipped``: true for rows that are no priced medicine, which go without a
    trace. ``labels``: columns that name the active ingredient. ``form_from``: the text that the form rules read beside
    the form, else the product name. ``form_needed``: a form that isn't known is a missing one. ``by_code``: the molecule
    is that of the row's code, else the first word of its name. ``texts``: all columns that ``derived`` and ``form_from`` read, which
    are then read once for each distinct set of their values; None: not known, so every row is read."""

    code: str
    currency: str
    mapping: dict[str, str]
    price_type: str = "list price"
    separator: str = ","
    encoding: str = "UTF-8"
    decimal: str = "."
    retail: bool = False
    prices: tuple[str, ...] = ()
    prefixes: dict[str, str] = field(default_factory=dict)
    derived: dict = field(default_factory=dict)
    cleaned: dict = field(default_factory=dict)
    skipped: Callable[[DataFrame], Column] | None = None
    labels: tuple[str, ...] = ()
    form_from: Callable[[DataFrame], Column] | None = None
    form_needed: bool = False
    by_code: bool = False
    vat_pattern: str | None = None
    vat: bool | None = None
    zero_is_anomaly: bool = False
    texts: tuple[str, ...] | None = None


def column(df: DataFrame, name: str) -> Column:
    """The column as text, null where the list hasn't got it."""
    return F.col(f"`{name}`").cast("string") if name in df.columns else F.lit(None).cast("string")


def mapped(raw: DataFrame, c: Country) -> DataFrame:
    """Canonical columns from the country's, empty ones derived; further columns stay for lineage and unpivoting."""
    out = _derived(_listed(raw, c), c)
    return out.withColumns({name: f(F.col(name)) for name, f in c.cleaned.items()})


def _listed(raw: DataFrame, c: Country) -> DataFrame:
    for name, prefix in c.prefixes.items():
        raw = prefix_column(raw, prefix, name)
    if c.skipped:
        raw = raw.where(~F.coalesce(c.skipped(raw), F.lit(False)))
    # Column names are compared without case: a list's own column of a canonical name is kept under another one.
    clash = {t: F.lit(None).cast("string") for t in TARGETS}
    for t in TARGETS:
        sources = [k for k, v in c.mapping.items() if v == t and k in raw.columns]
        if sources:
            clash[t] = F.coalesce(*[null_if_blank(F.col(f"`{k}`")) for k in sources])
    return raw.select(*[F.col(f"`{x}`") for x in raw.columns if x.lower() not in TARGETS], *[v.alias(k) for k, v in clash.items()], *[F.col(f"`{x}`").alias(f"_list_{x}") for x in raw.columns if x.lower() in TARGETS])


def _derived(out: DataFrame, c: Country) -> DataFrame:
    for name, f in c.derived.items():
        out = out.withColumn(name, filled(F.col(name), f(out)))
    return out


def read(raw: DataFrame, c: Country) -> DataFrame:
    """``mapped`` rows with their form. Where the list says which texts are read (``texts``), each distinct set of them is read once."""
    texts = c.texts if c.texts is not None or c.derived or c.form_from else ()
    if texts is None:
        return with_form(mapped(raw, c), c)
    rows = _listed(raw, c)
    asked = (*texts, *c.derived, "dosage_form", *([] if c.form_from else ["product_name"]))
    given = [x for x in dict.fromkeys(asked) if x in rows.columns]
    clean = lambda df, those: df.withColumns({n: f(F.col(n)) for n, f in c.cleaned.items() if those(n)})
    rows = by_texts(rows, given, lambda t: with_form(clean(_derived(t, c), lambda n: n in given), c))
    return clean(rows, lambda n: n not in given)


def with_form(rows: DataFrame, c: Country) -> DataFrame:
    """``dosage_form`` as the form's class (the text stays where none is known, unless a known form is needed), and FORM."""
    name = c.form_from(rows) if c.form_from else F.col("product_name")
    rows = once(rows, _f=normalised_form(F.col("dosage_form"), c.code, name))
    known = F.col("_f.form_class")
    return rows.withColumns({
        "route_of_administration": F.col("_f.route"), "dosage_form_raw": F.col("dosage_form"), "form_attributes": F.col("_f.attributes"), "form_confidence": F.col("_f.confidence"),
        "form_rule_id": F.col("_f.rule_id"), "form_caveat": F.col("_f.caveat"), "dosage_form": known if c.form_needed else F.coalesce(known, F.col("dosage_form")),
    }).drop("_f")


def prefix_column(df: DataFrame, prefix: str, name: str) -> DataFrame:
    """Copy the first column whose header begins with ``prefix`` to ``name``."""
    hit = next((x for x in df.columns if x.strip().lower().startswith(prefix.lower())), None)
    return df if hit is None or name in df.columns else df.withColumn(name, F.col(f"`{hit}`"))


def long_prices(df: DataFrame, c: Country) -> DataFrame:
    """One row for each row and price column; empty prices go, but for one row without any price, which has a null one."""
    if not c.prices:
        return df.withColumn("price_type", F.lit(c.price_type)).withColumn("price_text", F.col("price"))
    pairs = F.array(*[F.struct(F.lit(p).alias("t"), null_if_blank(column(df, p)).alias("v")) for p in c.prices])
    priced = F.filter(pairs, lambda p: p["v"].isNotNull())
    none = F.array(F.struct(F.lit(c.price_type).alias("t"), F.lit(None).cast("string").alias("v")))
    return df.withColumn("_p", F.explode(F.when(F.size(priced) > 0, priced).otherwise(none))).withColumn("price_type", F.col("_p.t")).withColumn("price_text", F.col("_p.v")).drop("_p")


def vat_flag(c: Country) -> Column:
    if c.vat_pattern:
        return F.lower("price_type").rlike(c.vat_pattern)
    return F.lit(c.vat).cast("boolean")


def judged(raw: DataFrame, c: Country) -> DataFrame:
    """Every lane of every raw row with price_amount, missing fields and ``reason`` (null where the row is good)."""
    rows = long_prices(read(raw, c), c)
    amount = retail_decimal(F.col("price_text")) if c.retail else locale_decimal(F.col("price_text"), c.decimal)
    rows = once(rows, price_amount=amount).withColumn("missing", F.array_compact(F.array(*[F.when(null_if_blank(F.col(r)).isNull(), F.lit(r)) for r in REQUIRED])))
    zero = F.when(F.lit(c.zero_is_anomaly) & (F.col("price_amount") == 0), ZERO)
    reason = zero if c.zero_is_anomaly else F.lit(None).cast("string")
    rest = F.when(F.size("missing") > 0, F.concat(F.lit("missing: "), F.array_join("missing", ", "))).when(F.col("price_amount").isNull(), "price can't be read")
    return rows.withColumn("reason", F.coalesce(reason, rest)).withColumns({"country_code": F.lit(c.code), "price_currency": F.lit(c.currency), "price_includes_vat": vat_flag(c)})


ZERO = "price is zero"


def named(rows: DataFrame, c: Country, words: DataFrame) -> DataFrame:
    """``inn`` where the list itself hasn't got one: by the row's code (``by_code``), or resolved from code, ingredient labels
    and product name (``labels``). ``words`` is a dictionary (name, codes)."""
    if c.by_code:
        names = words.select(F.explode("codes").alias("_code"), "name").groupBy("_code").agg(F.min("name").alias("_name"))
        j = rows.join(small(names), F.upper(F.trim("atc_code")) == F.col("_code"), "left")
        return j.withColumn("inn", F.coalesce("_name", F.lower(F.split(F.col("product_name"), " ")[0]))).drop("_code", "_name")
    if c.labels:
        plain = rows.withColumn("inn", null_if_blank(F.col("inn")))
        return resolve_identity(plain, words, tuple(x for x in c.labels if x in rows.columns)).withColumn("inn", F.lower("canonical_inn")).drop("canonical_inn", "resolved_atc", "identity_method")
    return rows


def canonical(raw: DataFrame, c: Country, snapshot: Column, document: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(canonical rows, anomalies, lineage) of a raw snapshot that carries row_index. Canonical and anomalies add up to the judged lanes."""
    raw_id = stable_id(F.lit("raw"), F.lit(c.code), snapshot, F.col("row_index"))
    j = judged(raw, c).withColumn("raw_record_id", raw_id).withColumn("snapshot_date", snapshot).withColumn("source_document_id", document)
    j = j.withColumn("id", stable_id(F.lit("canonical"), F.col("raw_record_id"), F.col("price_type")))
    cols = ["id", "raw_record_id", "country_code", "snapshot_date", *[t for t in TARGETS if t != "price"], *FORM, "price_type", "price_amount", "price_currency", "price_includes_vat"]
    good = j.where("reason is null")
    severity = F.when(F.col("reason") == ZERO, "low").otherwise("medium")
    bad = j.where("reason is not null").select(stable_id(F.lit("anomaly"), F.col("raw_record_id"), F.col("reason")).alias("id"), "raw_record_id", "country_code", "snapshot_date", F.col("reason").alias("title"), severity.alias("severity"), "missing")
    lineage = good.select(F.col("id").alias("canonical_id"), "raw_record_id", "source_document_id", "country_code", "snapshot_date")
    return good.select(*cols), bad.dropDuplicates(["title", "raw_record_id"]), lineage


def guard_country(df: DataFrame, expected: str) -> DataFrame:
    """Fails when a row belongs to another country."""
    return df.withColumn("country_code", F.when(F.col("country_code") == expected, F.col("country_code")).otherwise(F.raise_error(F.concat(F.lit(f"expected {expected}, found "), F.coalesce("country_code", F.lit("null"))))))


def snapshot_states(raw: DataFrame, good: DataFrame, bad: DataFrame) -> DataFrame:
    """Counts and state of each snapshot: anomaly_reported, needs_review, canonicalized or parsed."""
    keys = ["country_code", "snapshot_date"]
    r = raw.groupBy(*keys).agg(F.count("*").alias("n_raw"))
    g = good.groupBy(*keys).agg(F.count("*").alias("n_canonical"))
    b = bad.groupBy(*keys).agg(F.count("*").alias("n_anomalies"))
    j = r.join(g, keys, "left").join(b, keys, "left").fillna(0, ["n_canonical", "n_anomalies"])
    state = F.when((F.col("n_canonical") == 0) & (F.col("n_anomalies") > 0), "anomaly_reported").when(F.col("n_anomalies") > 0, "needs_review").when(F.col("n_canonical") > 0, "canonicalized").otherwise("parsed")
    return j.withColumn("state", state)


def sample_rows(df: DataFrame, keys: list[str], order: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows of each group and how many more there are."""
    from pyspark.sql.window import Window

    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where(F.col("rank") <= n)
    return ranked.join(df.groupBy(*keys).agg(F.greatest(F.lit(0), F.count("*") - n).alias("more")), keys)


def unique_rows(df: DataFrame, keys: list[str], order: str = "row_index") -> DataFrame:
    return first_per_key(df, keys, order)


def _dotted(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("."))


def _found(name: str, patterns: list[str], dotted: bool = False):
    def f(df: DataFrame) -> Column:
        text = column(df, name)
        return _dotted(first_match(text, patterns)) if dotted else first_match(text, patterns)

    return f


def _both(*names: str):
    return lambda df: F.concat_ws(" ", *[null_if_blank(column(df, n)) for n in names])


_PL_NAME = ("Nazwa  postać i dawka", "Nazwa  postać i dawka leku")


def _pl_text(df: DataFrame) -> Column:
    return F.coalesce(*[null_if_blank(column(df, n)) for n in _PL_NAME])


def _pl(part: str):
    return lambda df: polish_name(_pl_text(df), list(PL_NAME_FORMS))[part]


def _be_pack(df: DataFrame) -> Column:
    by_name = first_match(column(df, "S_NAM"), BE_PACK_IN_NAME)
    in_text = first_match(_both("RPT_PCK_LBL_FR", "RPT_PCK_LBL_NL")(df), BE_PACK_IN_LABEL)
    return F.coalesce(null_if_blank(column(df, "VOLUME_TOTAL")), by_name, in_text)


# Headers of the published lists and the patterns that read their texts.
BE_PACK_IN_NAME = [r"\b(\d+)\s*(?:tablets?|comprim[eé]s?|capsules?|g[ée]lules?|vials?|flacons?)\b", r"\b(?:x|pack of)\s*(\d+)\b"]
BE_PACK_IN_LABEL = [r"\b(\d+)\s+(?:comprim[eé]s?|tabletten?|capsules?|g[ée]lules?|flacons?|injectieflacons?|ampoules?)\b"]
COUNTRIES = {
    "IE": Country(
        "IE", "EUR", {"Drug Name": "product_name", "INN": "inn", "Strength Measure": "strength", "Pack Size": "pack_size", "Code": "product_code", "Non Proprietary Name": "manufacturer", "Reimbursement Price": "price"},
        "Reimbursement Price", vat=False, zero_is_anomaly=True, texts=("product_name",), derived={"dosage_form": lambda df: first_label(F.col("product_name"), list(IE_NAME_FORMS))},
    ),
    "FR": Country(
        "FR", "EUR",
        {"CIP13": "product_code", "DENOMINATION": "product_name", "DOSAGE": "strength", "FORME": "dosage_form", "CONDITIONNEMENT": "pack_size", "LABORATOIRE": "manufacturer", "INN": "inn", "ATC": "atc_code", "PRIX_FABRICANT_EUR": "price"},
        "PRIX_FABRICANT_EUR", vat=False,
    ),
    "PL": Country(
        "PL", "PLN", {"Substancja czynna": "inn", "Zawartość opakowania": "pack_size", "Numer GTIN lub inny kod jednoznacznie identyfikujący produkt": "product_code", "Numer GTIN": "product_code"},
        "Cena hurtowa brutto", separator=";", decimal=",", vat_pattern="brutto|detaliczna|urzędowa", prices=("Cena zbytu netto", "Urzędowa cena zbytu", "Cena hurtowa brutto", "Cena detaliczna"),
        derived={"product_name": _pl("name"), "dosage_form": _pl("form"), "strength": _pl("strength")}, cleaned={"inn": F.lower}, form_from=_pl_text, form_needed=True, texts=_PL_NAME,
    ),
    "ES": Country(
        "ES", "EUR",
        {"Código Nacional": "product_code", "Nombre del producto farmacéutico": "product_name", "Principio activo o asociación de principios activos": "inn", "Nombre del laboratorio ofertante": "manufacturer", "Precio de venta al público con IVA": "price"},
        "Precio de venta al público con IVA", separator=";", retail=True, vat=True, texts=("product_name",), skipped=lambda df: null_if_blank(column(df, "Tipo de fármaco")).isNull() | null_if_blank(column(df, "Precio de venta al público con IVA")).isNull(),
        derived={
            "strength": _found("product_name", [r"(\d+(?:[,.]\d+)?\s*(?:mg/ml|mg|microgramos|mcg|g|%))"], True),
            "pack_size": _found("product_name", [r",\s*(\d+)\s+comprimidos?", r"\b(\d+)\s+comprimidos?", r"\b(\d+)\s+c[aá]psulas?", r"\b(\d+)\s+frascos?", r"\b(\d+)\s+viales?"]),
            "dosage_form": _found("product_name", [r"\b(comprimidos?(?:\s+gastrorresistentes)?)\b", r"\b(c[aá]psulas?)\b", r"\b(soluci[oó]n\s+inyectable)\b", r"\b(jarabe|suspensi[oó]n oral|soluci[oó]n oral)\b"]),
        },
    ),
    "IT": Country(
        "IT", "EUR", {"AIC": "product_code", "Denominazione e Confezione": "product_name", "Principio Attivo": "inn", "Titolare AIC": "manufacturer", "Prezzo al pubblico": "price"},
        "Prezzo al pubblico", separator=";", encoding="ISO-8859-1", retail=True, vat=True, texts=("product_name", "Descrizione Gruppo"), prefixes={"Prezzo al pubblico": "Prezzo al pubblico"},
        derived={
            "strength": _found("Descrizione Gruppo", [r"\b(\d+(?:[,.]\d+)?\s*(?:MG/ML|MG|MCG|G|%))\b"], True),
            "pack_size": _found("Descrizione Gruppo", [r"\b(\d+)\s+UNITA'"]),
            "dosage_form": lambda df: first_match(_both("product_name", "Descrizione Gruppo")(df), [r"\b(cpr)\b", r"\b(cps)\b", r"\b(uso parenterale)\b", r"\b(orale sosp|orale soluz)\b"]),
        },
    ),
    "PT": Country(
        "PT", "EUR", {"Nome do Medicamento": "product_name", "Substância Ativa/DCI": "inn", "Forma Farmacêutica": "dosage_form", "Dosagem": "strength", "Titular de AIM": "manufacturer", "Código": "product_code", "PVP": "price"},
        "PVP", separator=";", retail=True, vat=True, texts=("Apresentação", "ATC"),
        derived={
            "pack_size": _found("Apresentação", [r"\b(\d+)\s+comprimidos?", r"\b(\d+)\s+c[aá]psulas?", r"\b(\d+)\s+frascos?", r"\b(\d+)\s+seringas?", r"\b(\d+)\s+unidade"]),
            "atc_code": lambda df: atc_code(column(df, "ATC")),
        },
    ),
    "CZ": Country(
        "CZ", "CZK", {"kodSUKL": "product_code", "nazev": "product_name", "sila": "strength", "lekovaFormaKod": "dosage_form", "ATCkod": "atc_code"},
        "cenaPuvodce", prices=("cenaPuvodce", "maxCenaLekarna"), vat_pattern="maxcenalekarna", by_code=True, form_needed=True, texts=("baleni",), form_from=lambda df: F.lit(None).cast("string"),
        skipped=lambda df: F.coalesce(null_if_blank(column(df, "cenaPuvodce")), F.lit("0")).isin("0", "0.0"), derived={"pack_size": lambda df: leading_pack(column(df, "baleni"))}, cleaned={"strength": F.upper},
    ),
    "BE": Country(
        "BE", "EUR", {"F_ORGA": "manufacturer", "S_COD": "product_code", "ATC_COD": "atc_code", "SI_CONC_NOM": "strength", "SPB_PRICE": "price", "INN": "inn", "INN_NAM": "inn", "DCI": "inn", "SUBSTANCE": "inn"},
        "SPB_PRICE", retail=True, vat=False, labels=("B_LBL_FR", "B_LBL_NL"), texts=("S_NAM", "S_NAM_SPECIF", "VOLUME_TOTAL", "RPT_PCK_LBL_FR", "RPT_PCK_LBL_NL"), skipped=lambda df: null_if_blank(column(df, "SPB_PRICE")).isNull(),
        derived={
            "product_name": lambda df: F.nullif(joined_name(column(df, "S_NAM"), column(df, "S_NAM_SPECIF")), F.lit("")),
            "strength": _found("S_NAM", [r"(\d+(?:[,.]\d+)?\s*(?:mg/ml|mg|microgram|mcg|g|%))"], True),
            "pack_size": _be_pack,
            "dosage_form": lambda df: first_match(_both("RPT_PCK_LBL_FR", "RPT_PCK_LBL_NL", "S_NAM")(df), [
                r"\b(tablets?|comprim[eé]s?|tabletten?)\b", r"\b(capsules?|g[ée]lules?)\b", r"\b(solution|suspension|po(?:e|è)dre)\s+(?:pour|voor)\s+(?:injection|injectie|perfusion|infusie)\b",
                r"\b(injectieflacon|ampoules?|injectable)\b", r"\b(perfusion|infusie)\b", r"\b(oral(?:e)?\s+solution|solution\s+buvable|orale?\s+suspension)\b",
            ]),
        },
    ),
}
