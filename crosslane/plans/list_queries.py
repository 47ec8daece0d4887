"""Queries over the countries' lists: written in each list's own format from the driver's tables, read back and made canonical."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import molecules
from ..operators import canonical, policy, quality, stored_index
from ..sources import archive, html, tables
from . import surrogate as s
from .queries import query

_DAY = "date'2026-05-01'"
_FORMS = ("STANDARD", "MEDIUM", "PROMO", "LARGE", "ECONOMY", "SMALL")


def _of(values: dict[str, str]):
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("dosage_form"))


#: What lists read of an observation.
_LISTED = ("product_name", "inn", "strength", "pack_size", "dosage_form", "price_type", "price_amount", "manufacturer", "product_code", "tax")


def _lists(spark: SparkSession, d: str, several: bool = True) -> dict[str, DataFrame]:
    """One raw list for each country, in its own headers. Rows of price type R have no readable price (none at all in ES, BE and CZ).
    Where ``several`` are read, line items meet their parts once for all of them."""
    o = s.observations(spark, d).select(*_LISTED)
    o = tables.few_files(o, "listed") if several else o
    o = o.select("*", F.split("strength", " ")[0].alias("mg"), F.split("pack_size", " ")[0].alias("units"), F.col("price_amount").cast("decimal(18,2)").cast("string").alias("p"))
    good = F.col("price_type") != "R"
    dot, comma = F.col("p"), F.replace("p", F.lit("."), F.lit(","))
    word = lambda t: F.upper(t)
    ie = dict(zip(_FORMS, ("Film Coated Tabs.", "Hard Caps.", "Oral Soln.", "Soln for Inj.", "Cream", "thing"), strict=True))
    pl = dict(zip(_FORMS, ("tabl. powl.", "kaps. twarde", "syrop", "inj.", "krem", "rzecz"), strict=True))
    es = dict(zip(_FORMS, ("comprimidos", "cápsulas", "jarabe", "solución inyectable", "comprimidos gastrorresistentes", "nada"), strict=True))
    it = dict(zip(_FORMS, ("cpr", "cps", "orale soluz", "uso parenterale", "cpr", "altro"), strict=True))
    pt = dict(zip(_FORMS, ("Comprimido", "Cápsula", "Xarope", "Solução injetável", "Comprimido revestido", "Outro"), strict=True))
    cz = dict(zip(_FORMS, ("TBL FLM", "CPS DUR", "OPH GTT", "INJ SOL", "DRM GEL", "XXX"), strict=True))
    be = dict(zip(_FORMS, ("comprimés", "gélules", "solution buvable", "ampoules", "perfusion", "rien"), strict=True))
    return {
        "IE": o.select(F.concat_ws(" ", word("product_name"), F.concat("mg", F.lit("mg")), _of(ie)).alias("Drug Name"), word("inn").alias("INN"), F.col("strength").alias("Strength Measure"), F.col("units").alias("Pack Size"), F.col("product_code").alias("Code"), F.col("manufacturer").alias("Non Proprietary Name"), F.when(good, dot).otherwise("0").alias("Reimbursement Price")),
        "FR": o.select(F.col("product_code").alias("CIP13"), F.col("product_name").alias("DENOMINATION"), F.col("inn").alias("INN"), F.lit("N02BE01").alias("ATC"), F.concat("mg", F.lit("mg")).alias("DOSAGE"), F.when(F.col("dosage_form") == "SMALL", "").otherwise("tablet").alias("FORME"), F.col("units").alias("CONDITIONNEMENT"), F.col("manufacturer").alias("LABORATOIRE"), F.when(good, dot).otherwise("not-a-number").alias("PRIX_FABRICANT_EUR")),
        "PL": o.select(F.concat(F.initcap("inn"), F.lit(", "), _of(pl), F.lit(", "), F.col("mg"), F.lit(" mg")).alias("Nazwa  postać i dawka"), F.initcap("inn").alias("Substancja czynna"), F.concat("units", F.lit(" szt.")).alias("Zawartość opakowania"), F.col("product_code").alias("Numer GTIN"), comma.alias("Cena zbytu netto"), F.when(good, comma).otherwise("").alias("Urzędowa cena zbytu"), F.when(good, comma).otherwise("brak").alias("Cena hurtowa brutto"), F.lit("").alias("Cena detaliczna")),
        "ES": o.select(F.col("product_code").alias("Código Nacional"), F.concat(word("product_name"), F.lit(" "), F.col("mg"), F.lit(",5 mg "), _of(es), F.lit(", "), F.col("units"), F.lit(" "), _of({**es, "LARGE": "viales", "PROMO": "frascos", "SMALL": "comprimidos"})).alias("Nombre del producto farmacéutico"), F.when(F.col("tax") < 0.07, "Medicamento").otherwise("").alias("Tipo de fármaco"), F.col("manufacturer").alias("Nombre del laboratorio ofertante"), F.col("inn").alias("Principio activo o asociación de principios activos"), F.when(good, comma).otherwise("nan").alias("Precio de venta al público con IVA")),
        "IT": o.select(F.initcap("inn").alias("Principio Attivo"), F.concat(word("inn"), F.lit(" "), F.col("mg"), F.lit("MG "), F.col("units"), F.lit(" UNITA' È")).alias("Descrizione Gruppo"), F.concat(word("product_name"), F.lit("* "), _of(it)).alias("Denominazione e Confezione"), F.when(good, F.concat(comma, F.lit(" "))).otherwise("x").alias("Prezzo al pubblico euro"), F.col("manufacturer").alias("Titolare AIC"), F.col("product_code").alias("AIC")),
        "PT": o.select(F.col("product_name").alias("Nome do Medicamento"), F.col("inn").alias("Substância Ativa/DCI"), _of(pt).alias("Forma Farmacêutica"), F.col("strength").alias("Dosagem"), F.concat(F.lit("Blister; "), F.col("units"), F.lit(" comprimidos")).alias("Apresentação"), F.col("manufacturer").alias("Titular de AIM"), F.lit("A10BF01 - acarbose").alias("ATC"), F.when(good, F.concat(comma, F.lit(" €"))).otherwise("x").alias("PVP"), F.col("product_code").alias("Código")),
        "CZ": o.select(F.col("product_code").alias("kodSUKL"), F.col("product_name").alias("nazev"), F.concat("mg", F.lit("mg")).alias("sila"), _of(cz).alias("lekovaFormaKod"), F.concat("units", F.lit(" I")).alias("baleni"), F.when(F.col("inn") == "bolt", "B01AA02").alias("ATCkod"), F.when(good, dot).alias("cenaPuvodce"), F.when(F.col("price_type") == "A", dot).alias("maxCenaLekarna"), F.when(F.col("price_type") == "N", F.lit(None).cast("string")).when(F.col("tax") > 0.07, "timeout").alias("_error")),
        "BE": o.select(F.when(good, F.concat(dot, F.lit("€"))).otherwise(" ").alias("SPB_PRICE"), F.col("product_code").alias("S_COD"), word("product_name").alias("S_NAM"), F.concat("mg", F.lit(" mg ")).alias("S_NAM_SPECIF"), F.col("manufacturer").alias("F_ORGA"), F.when(F.col("price_type") == "A", "B01AA02").otherwise("").alias("ATC_COD"), F.col("strength").alias("SI_CONC_NOM"), F.lit("").alias("VOLUME_TOTAL"), F.lit("").alias("INN"), F.col("inn").alias("B_LBL_FR"), F.concat("units", F.lit(" "), _of({**be, "PROMO": "flacons", "ECONOMY": "flacons", "SMALL": "flacons"}), F.lit(" "), _of(be)).alias("RPT_PCK_LBL_FR"), F.lit("").alias("RPT_PCK_LBL_NL")),
    }


def _read_back(spark: SparkSession, code: str, raw: DataFrame) -> tuple[DataFrame, str]:
    """The list written in the country's format, compressed, and read again (the register of CZ as JSON lines with failed requests); its
    folder, which is the caller's to drop."""
    path, c = tables.shared_path(spark, f"list-{code}"), canonical.COUNTRIES[code]
    if code == "CZ":
        raw.write.json(path, compression="gzip")
        return tables.read_json_records(spark, path, ", ".join(f"`{x}` string" for x in raw.columns if x != "_error"), "cenaPuvodce"), path
    raw.write.csv(path, header=True, sep=c.separator, encoding=c.encoding, quote='"', escape='"', compression="gzip")
    return tables.read_delimited(spark, path, raw.columns, c.separator, c.encoding), path


def _of_lists(spark: SparkSession, d: str, found) -> DataFrame:
    """What ``found`` tells of the judged rows of each list, together. Each list is a job of its own, as it comes in: it is dropped when
    what was found is written, so the disk holds one list."""
    words = molecules.dictionary(s.atc(spark))
    out = None
    for code, raw in _lists(spark, d).items():
        c = canonical.COUNTRIES[code]
        back, path = _read_back(spark, code, raw)
        j = tables.written(found(canonical.named(canonical.judged(back, c), c, words).withColumn("inn", F.lower("inn"))), f"canonical-{code}")
        tables.dropped(spark, path)
        out = j if out is None else out.unionByName(j)
    return out


_CASE = lambda *v: "CASE dosage_form " + " ".join(f"WHEN '{f}' THEN {x}" for f, x in zip(_FORMS, v, strict=True)) + " END"
_q = lambda *v: [f"'{x}'" if x else "NULL" for x in v]
_BE_ATC = "CASE WHEN price_type = 'A' THEN 'bolt' ELSE inn END"
#: What each list must give: country, price type, name, molecule, code, strength, pack, form, route, price, currency, VAT, reason.
_WANT = f"""{s.OBS}, o AS (SELECT *, CAST(strength_value AS VARCHAR) AS mg, CAST(pack_units AS VARCHAR) AS units, CAST(price_amount AS DECIMAL(18,2)) AS p, price_type <> 'R' AS good FROM obs),
ie AS (SELECT 'IE' AS country_code, 'Reimbursement Price' AS price_type, upper(product_name) || ' ' || mg || 'mg ' || {_CASE(*_q('Film Coated Tabs.', 'Hard Caps.', 'Oral Soln.', 'Soln for Inj.', 'Cream', 'thing'))} AS product_name, inn, NULL AS atc_code, mg || ' mg' AS strength, units AS pack_size,
  {_CASE(*_q('oral_solid', 'oral_solid', 'oral_liquid', 'injectable', 'topical_semisolid', ''))} AS dosage_form, {_CASE(*_q('oral', 'oral', 'oral', 'parenteral', 'topical', ''))} AS route, CASE WHEN good THEN p ELSE 0 END AS price_amount, 'EUR' AS ccy, false AS vat,
  CASE WHEN NOT good THEN 'price is zero' WHEN dosage_form = 'SMALL' THEN 'missing: dosage_form' END AS reason FROM o),
fr AS (SELECT 'FR', 'PRIX_FABRICANT_EUR', product_name, inn, 'N02BE01', mg || 'mg', units, CASE WHEN dosage_form = 'SMALL' THEN NULL ELSE 'oral_solid' END, CASE WHEN dosage_form = 'SMALL' THEN NULL ELSE 'oral' END, CASE WHEN good THEN p END, 'EUR', false,
  CASE WHEN dosage_form = 'SMALL' THEN 'missing: dosage_form' WHEN NOT good THEN 'price can''t be read' END FROM o),
pl AS (SELECT 'PL', t, upper(inn[1]) || inn[2:], inn, NULL, mg || ' mg', units || ' szt.', {_CASE(*_q('oral_solid', 'oral_solid', 'oral_liquid', 'injectable', 'topical_semisolid', ''))}, {_CASE(*_q('oral', 'oral', 'oral', 'parenteral', 'topical', ''))},
  CASE WHEN t = 'Cena hurtowa brutto' AND NOT good THEN NULL ELSE p END, 'PLN', t <> 'Cena zbytu netto', CASE WHEN dosage_form = 'SMALL' THEN 'missing: dosage_form' WHEN t = 'Cena hurtowa brutto' AND NOT good THEN 'price can''t be read' END
  FROM o, (VALUES ('Cena zbytu netto'), ('Urzędowa cena zbytu'), ('Cena hurtowa brutto')) v(t) WHERE good OR t <> 'Urzędowa cena zbytu'),
es AS (SELECT 'ES', 'Precio de venta al público con IVA', upper(product_name) || ' ' || mg || ',5 mg ' || {_CASE(*_q('comprimidos', 'cápsulas', 'jarabe', 'solución inyectable', 'comprimidos gastrorresistentes', 'nada'))} || ', ' || units || ' ' || {_CASE(*_q('comprimidos', 'cápsulas', 'frascos', 'viales', 'comprimidos gastrorresistentes', 'comprimidos'))}, inn, NULL, mg || '.5 mg', units,
  {_CASE(*_q('oral_solid', 'oral_solid', 'oral_liquid', 'injectable', 'oral_solid', 'oral_solid'))}, {_CASE(*_q('oral', 'oral', 'oral', 'parenteral', 'oral', 'oral'))}, p, 'EUR', true, NULL FROM o WHERE good AND tax < 0.07),
it AS (SELECT 'IT', 'Prezzo al pubblico', upper(product_name) || '* ' || {_CASE(*_q('cpr', 'cps', 'orale soluz', 'uso parenterale', 'cpr', 'altro'))}, inn, NULL, mg || 'MG', units, {_CASE(*_q('oral_solid', 'oral_solid', 'oral_liquid', 'injectable', 'oral_solid', ''))}, {_CASE(*_q('oral', 'oral', 'oral', 'parenteral', 'oral', ''))}, CASE WHEN good THEN p END, 'EUR', true,
  CASE WHEN dosage_form = 'SMALL' THEN 'missing: dosage_form' WHEN NOT good THEN 'price can''t be read' END FROM o),
pt AS (SELECT 'PT', 'PVP', product_name, inn, 'A10BF01', mg || ' mg', units, {_CASE(*_q('oral_solid', 'oral_solid', 'oral_liquid', 'injectable', 'oral_solid', 'Outro'))}, {_CASE(*_q('oral', 'oral', 'oral', 'parenteral', 'oral', ''))}, CASE WHEN good THEN p END, 'EUR', true, CASE WHEN NOT good THEN 'price can''t be read' END FROM o),
cz AS (SELECT 'CZ', t, product_name, CASE WHEN inn = 'bolt' THEN 'bolt' ELSE split_part(product_name, ' ', 1) END, CASE WHEN inn = 'bolt' THEN 'B01AA02' END, mg || 'MG', units, {_CASE(*_q('oral_solid', 'oral_solid', 'eye_drops', 'injectable', 'topical_semisolid', ''))}, {_CASE(*_q('oral', 'oral', 'ocular', 'parenteral', 'topical', ''))}, p, 'CZK', t = 'maxCenaLekarna',
  CASE WHEN dosage_form = 'SMALL' THEN 'missing: dosage_form' END FROM o, (VALUES ('cenaPuvodce'), ('maxCenaLekarna')) v(t) WHERE good AND (t = 'cenaPuvodce' OR price_type = 'A') AND (price_type = 'N' OR tax <= 0.07)),
be AS (SELECT 'BE', 'SPB_PRICE', upper(product_name) || ' ' || mg || ' mg', {_BE_ATC}, CASE WHEN price_type = 'A' THEN 'B01AA02' END, mg || ' mg', units, {_CASE(*_q('oral_solid', 'oral_solid', 'oral_liquid', 'injectable', 'infusible', ''))}, {_CASE(*_q('oral', 'oral', 'oral', 'parenteral', 'parenteral', ''))}, p, 'EUR', false, CASE WHEN dosage_form = 'SMALL' THEN 'missing: dosage_form' END FROM o WHERE good),
w AS (SELECT * FROM ie UNION ALL SELECT * FROM fr UNION ALL SELECT * FROM pl UNION ALL SELECT * FROM es UNION ALL SELECT * FROM it UNION ALL SELECT * FROM pt UNION ALL SELECT * FROM cz UNION ALL SELECT * FROM be)"""


@query(f"""WITH {_WANT} SELECT country_code, price_type, inn, atc_code, strength, dosage_form, route, vat, ccy, reason, count(*) AS n, min(pack_size) AS least_pack, max(pack_size) AS most_pack, min(product_name) AS first_name, max(product_name) AS last_name, CAST(sum(price_amount) AS DECIMAL(38,2)) AS total FROM w GROUP BY ALL""")
def canonical_by_country(spark, d):
    """Every country's list in its own format, read and judged."""
    keys = ["country_code", "price_type", "inn", "atc_code", "strength", "dosage_form", F.col("route_of_administration").alias("route"), F.col("price_includes_vat").alias("vat"), F.col("price_currency").alias("ccy"), "reason"]
    ends = [f(c).alias(n) for f, c, n in ((F.min, "pack_size", "least_pack"), (F.max, "pack_size", "most_pack"), (F.min, "product_name", "first_name"), (F.max, "product_name", "last_name"))]
    # A list has one country, so its groups are its own.
    return _of_lists(spark, d, lambda j: j.groupBy(*keys).agg(F.count("*").alias("n"), *ends, F.sum("price_amount").cast("decimal(38,2)").alias("total")))


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    """The list of IE, each row once, with a row_index."""
    return _lists(spark, d, several=False)["IE"].dropDuplicates(["Code", "Drug Name", "Pack Size", "Reimbursement Price"]).withColumn("row_index", F.xxhash64("Code", "Drug Name", "Pack Size", "Reimbursement Price"))


def _snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    raw = _lists(spark, d, several=False)["IE"].withColumn("row_index", F.xxhash64("Code", "Drug Name", "Pack Size", "Reimbursement Price"))
    return canonical.canonical(raw, canonical.COUNTRIES["IE"], F.expr(_DAY), F.lit("doc-ie"))


def _fields(df: DataFrame) -> str:
    """The schema of a table of the archive, without what its folders tell."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in archive.KEYS)


@query(f"""WITH {_WANT} SELECT 'IE' AS country, '2026-05-01' AS day, count(*) AS n_records, CAST(sum(price_amount) AS DECIMAL(38,2)) AS total, count(*) AS n_traced FROM ie WHERE reason IS NULL""")
def snapshot_outputs(spark, d):
    """Canonical rows and lineage committed as a snapshot and read back, the country and date taken from the files' paths."""
    good, _, lineage = _snapshots(spark, d)
    path = tables.shared_path(spark, "snapshots")
    archive.commit({"canonical": good.withColumn("price_amount", F.col("price_amount").cast("string")), "lineage": lineage}, path, one=True)
    back = archive.read(spark, path, "canonical", _fields(good.withColumn("price_amount", F.lit("")))).withColumn("price_amount", F.col("price_amount").try_cast("decimal(18,6)"))
    back = tables.with_path_value(tables.with_path_value(back, "country_code=([A-Z]+)", "country").drop("file_name"), "snapshot_date=([0-9-]+)", "day")
    traced = archive.read(spark, path, "lineage", _fields(lineage)).select(F.col("canonical_id").alias("id")).distinct().withColumn("traced", F.lit(1))
    return back.join(traced, "id", "left").groupBy("country", "day").agg(F.count("*").alias("n_records"), F.sum("price_amount").cast("decimal(38,2)").alias("total"), F.count("traced").alias("n_traced"))


@query(f"""WITH {s.OBS}, raw AS (SELECT DISTINCT product_code, product_name, strength_value, dosage_form, pack_units, price_type = 'R' AS zero, price_amount * CAST(price_type <> 'R' AS INT) AS p FROM obs), z AS (SELECT day, refused FROM (VALUES ('2026-05-01', true), ('2026-06-01', false)) v(day, refused))
SELECT 'IE' AS country_code, day AS snapshot_date, (SELECT count(*) FROM raw) AS n_raw, (SELECT count(*) FROM raw WHERE NOT zero AND dosage_form <> 'SMALL') AS n_canonical, (SELECT count(*) FROM raw WHERE zero OR dosage_form = 'SMALL') AS n_anomalies, (SELECT count(*) FROM raw WHERE zero) AS n_zero, refused FROM z""")
def snapshot_archive(spark, d):
    """A list of one date is added to the archive, then that of another date; the first one again is refused. Of each snapshot the
    raw, canonical and anomaly rows that are there afterwards, and the raw rows whose stored fields have a price of zero."""
    # Each table of each snapshot reads the list, so rows are made distinct once.
    raw, path = tables.few_files(_numbered(spark, d), "numbered"), tables.shared_path(spark, "archive")

    def add(day: str) -> bool:
        date, document = F.lit(day).cast("date"), F.lit(f"doc-ie-{day}")
        good, bad, lineage = canonical.canonical(raw, canonical.COUNTRIES["IE"], date, document)
        parts = {"raw": archive.raw_records(raw, "IE", date, document), "canonical": good, "anomalies": bad, "lineage": lineage}
        kinds.update({n: _fields(p) for n, p in parts.items()})
        try:
            archive.commit(parts, path, one=True)
        except archive.SnapshotExists:
            return False
        return True

    kinds: dict[str, str] = {}
    done = [add("2026-05-01"), add("2026-06-01"), add("2026-05-01")]
    back = {n: archive.read(spark, path, n, k) for n, k in kinds.items()}
    counts = archive.snapshot_counts(back["raw"], back["canonical"], back["anomalies"])
    zero = back["raw"].groupBy(*archive.KEYS).agg(F.count_if(F.col("raw_fields")["Reimbursement Price"] == "0").alias("n_zero"))
    refused = F.when(F.col("snapshot_date") == F.lit("2026-05-01").cast("date"), F.lit(not done[2])).otherwise(F.lit(not done[1]))
    return counts.join(zero, archive.KEYS).withColumn("refused", refused).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


# Policies of lists: country, price type, category, VAT position.
_LIST_POLICIES = (
    ("IE", "Reimbursement Price", "ex_factory", "vat_exclusive"), ("PL", "Cena zbytu netto", "ex_factory", "vat_exclusive"), ("PL", "Urzędowa cena zbytu", "wholesale", "vat_inclusive"),
    ("PL", "Cena hurtowa brutto", "not_comparable", "vat_inclusive"), ("ES", "Precio de venta al público con IVA", "retail", "vat_inclusive"), ("IT", "Prezzo al pubblico", "retail", "vat_inclusive"),
)


def _list_policies(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(f"{c}-{k}", c, t, k, v) for c, t, k, v in _LIST_POLICIES], "id string, country_code string, price_type string, category string, vat string")
    none = F.array().cast("array<string>")
    semantics = F.struct(F.col("category").alias("comparison_category"), F.col("vat").alias("vat_position"), F.lit("none").alias("margin_position"), F.lit("published").alias("derivation_kind"))
    return rows.select(
        "id", "country_code", "price_type", F.col("category").alias("comparison_category"), F.lit("2020-01-01").cast("date").alias("effective_from"), F.lit(None).cast("date").alias("effective_to"), F.lit(None).cast("string").alias("superseded_by"),
        F.lit("high").alias("confidence"), F.lit("2020-01-01").cast("timestamp").alias("authored_at"), none.alias("caveats"), F.array(F.lit("inline")).alias("source_references"), semantics.alias("semantics"), F.array().cast(f"array<{policy.RULE}>").alias("derivation_rules"),
    )


_LIST_LANES = ", ".join(f"('{c}', '{t}', '{k}|{v}|none')" for c, t, k, v in _LIST_POLICIES if k != "not_comparable")


@query(f"""WITH {_WANT}, {s.FX}, latest AS (SELECT ccy, max_by(rate, since) AS rate FROM fx GROUP BY ccy), v AS (SELECT * FROM (VALUES {_LIST_LANES}) v(cc, t, lane_key)),
r AS (SELECT w.*, v.lane_key, CAST(regexp_extract(strength, '^([0-9.]+)', 1) AS DOUBLE) AS mg, CAST(regexp_extract(pack_size, '^([0-9]+)', 1) AS DOUBLE) AS units FROM w JOIN v ON v.cc = w.country_code AND v.t = w.price_type WHERE reason IS NULL AND price_amount > 0)
SELECT country_code, lane_key, lower(inn) || '|' || CAST(mg AS DECIMAL(18,1)) || '|' || dosage_form || '|' || route AS product, count(*) AS n, round(sum(CAST(price_amount AS DOUBLE) / CASE r.ccy WHEN 'EUR' THEN 1 ELSE l.rate END / units / mg), 2) AS eur
FROM r LEFT JOIN latest l ON l.ccy = r.ccy WHERE units > 0 AND mg > 0 GROUP BY ALL""")
def index_by_snapshot(spark, d):
    """The index of four countries' lists with their forms and routes, stored by snapshot: two lists first, the two others later, each
    read and judged alone; all are converted at the latest snapshot's date on reading."""
    lists, words, policies, path = _lists(spark, d), molecules.dictionary(s.atc(spark)), _list_policies(spark), tables.shared_path(spark, "index")
    path = f"{path}/{stored_index.rules_key(policies, words)}"
    days = {"IE": "2026-05-01", "PL": "2026-05-01", "ES": "2026-05-22", "IT": "2026-06-01"}

    def records(code: str) -> DataFrame:
        c = canonical.COUNTRIES[code]
        back, folder = _read_back(spark, code, lists[code])
        j = canonical.named(canonical.judged(back, c), c, words).where("reason is null")
        row = F.concat_ws("|", "product_code", "product_name", "pack_size", "price_text", "price_type")
        made = tables.written(j.select(F.sha2(row, 256).alias("id"), "country_code", F.lit(days[code]).cast("date").alias("snapshot_date"), "product_name", F.lower("inn").alias("canonical_inn"), "strength", "pack_size", "price_type", "price_amount", "price_currency", F.col("dosage_form").alias("form_class"), F.col("route_of_administration").alias("route")), f"records-{code}")
        tables.dropped(spark, folder)
        return made.withColumn("raw_record_id", F.col("id"))

    for some in (("IE", "PL"), ("ES",), ("IT",)):
        for country, _ in stored_index.missing(spark, path, [(c, days[c]) for c in some]):
            own = records(country)
            stored_index.add(own, policies, quality.plausibility(quality.numeric_profile(own, "price_amount", quality.SNAPSHOT)), path, one=True)
    i = stored_index.read(spark, path, s.rates(spark))
    product = F.concat_ws("|", "canonical_inn", F.col("strength_value").cast("decimal(18,1)").cast("string"), "form_class", "route")
    eur = F.round(F.sum(F.col("eur_per_strength").cast("double")) + 3.14159265e-9, 2)
    return i.groupBy("country_code", "lane_key", product.alias("product")).agg(F.count("*").alias("n"), eur.alias("eur"))


@query(f"""WITH {s.OBS}, r AS (SELECT DISTINCT product_code, product_name, strength_value, dosage_form, pack_units, CASE WHEN price_type = 'R' THEN 0 ELSE price_amount END AS p, price_type = 'R' AS zero FROM obs)
SELECT CASE WHEN zero THEN 'price is zero' ELSE 'missing: dosage_form' END AS title, CASE WHEN zero THEN 'low' ELSE 'medium' END AS severity, count(*) AS n FROM r WHERE zero OR dosage_form = 'SMALL' GROUP BY ALL""")
def anomaly_titles(spark, d):
    """Anomalies of a list, one for each title and raw record, with their severity."""
    return _snapshots(spark, d)[1].groupBy("title", "severity").agg(F.count("*").alias("n"))


@query(f"""WITH {s.OBS}, r AS (SELECT country_code, product_code, price_date, id, row_number() OVER (PARTITION BY country_code ORDER BY id) AS k, count(*) OVER (PARTITION BY country_code) AS n FROM obs)
SELECT country_code, id, CAST(k AS INTEGER) AS rank, greatest(0, n - 5) AS more FROM r WHERE k <= 5""")
def snapshot_samples(spark, d):
    o = s.observations(spark, d).select("country_code", "id")
    return canonical.sample_rows(o, ["country_code"], "id").select("country_code", "id", "rank", "more")


@query(f"""WITH {s.OBS} SELECT country_code, count(*) AS n FROM obs WHERE country_code IN ('CC', 'DD') GROUP BY ALL""")
def guarded_countries(spark, d):
    """Rows of two countries, each behind its guard, which would fail on a row of another country."""
    o = s.observations(spark, d).select("country_code")
    both = canonical.guard_country(o.where("country_code = 'CC'"), "CC").unionByName(canonical.guard_country(o.where("country_code = 'DD'"), "DD"))
    return both.groupBy("country_code").agg(F.count("*").alias("n"))


@query("""SELECT source AS name, CASE WHEN source IS NULL THEN 'missing' WHEN source = (SELECT max(source) FROM documents) THEN 'mismatch' WHEN source = (SELECT min(source) FROM documents) THEN 'missing' ELSE 'ok' END AS status, count(*) AS n_docs FROM documents WHERE source IS NOT NULL GROUP BY source""")
def file_integrity(spark, d):
    """One file for each source, checked against a manifest in which the last digest is wrong and the first file is another one."""
    docs = spark.read.parquet(f"{d}/documents.parquet").where("source is not null").select("source", "doc_id")
    path = tables.shared_path(spark, "files")
    docs.repartition("source").sortWithinPartitions("source", "doc_id").select("source", F.col("doc_id").cast("string").alias("value")).write.partitionBy("source").text(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_extract("path", "(source=[^/]+/[^/]+)$", 1).alias("file"), F.url_decode(F.regexp_extract("path", "source=([^/]+)/", 1)).alias("source"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    least, most = docs.agg(F.min("source")).scalar(), docs.agg(F.max("source")).scalar()
    entry = F.struct(F.when(F.col("source") == least, F.concat("file", F.lit(".gone"))).otherwise(F.col("file")).alias("name"), F.when(F.col("source") == most, F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"), "bytes")
    listed = files.select("source", F.lit("ZZ").alias("country_code"), F.expr(_DAY).alias("snapshot_date"), F.array(entry).alias("files"))
    found = tables.verify_files(spark, path, listed)
    status = found.join(listed.select("source", F.col("files")[0]["name"].alias("name")), "name").select("source", "status")
    return docs.groupBy("source").agg(F.count("*").alias("n_docs")).join(status, "source", "left").select(F.col("source").alias("name"), "status", "n_docs")


@query(f"""WITH r AS (SELECT 'C' || (o_custkey % 3) AS ccy, CAST(date_trunc('month', o_orderdate) AS DATE) AS day, max(o_orderkey) AS rate FROM orders GROUP BY ALL),
q AS (SELECT o_orderkey, 'C' || (o_custkey % 3) AS ccy, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT q.ccy, count(*) AS n, CAST(sum((SELECT arg_max(rate, r.day) FROM r WHERE r.ccy = q.ccy AND r.day <= q.day)) AS BIGINT) AS rates FROM q GROUP BY ALL""")
def rate_log(spark, d):
    """Rates appended to a log in two steps, read back as a dimension and met by the day of each order."""
    from ..operators import fx

    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.concat(F.lit("C"), F.col("o_custkey") % 3).alias("ccy"), F.col("o_orderdate").cast("date").alias("day"))
    rates = orders.groupBy("ccy", F.trunc("day", "month").alias("rate_date")).agg(F.max("o_orderkey").cast("decimal(18,10)").alias("rate"))
    rates = rates.select(F.lit("EUR").alias("from_ccy"), F.col("ccy").alias("to_ccy"), "rate_date", "rate", F.lit("log").alias("source_url"), F.col("rate_date").cast("timestamp").alias("stored_at"))
    path = tables.shared_path(spark, "rates")
    tables.append_rates(rates.where("rate_date < date'1998-01-01'"), path)
    tables.append_rates(rates.where("rate_date >= date'1998-01-01'"), path)
    j = fx.as_of(orders, tables.read_dimension(spark, path, fx.RATE), "ccy", "day", "rate")
    return j.groupBy("ccy").agg(F.count("*").alias("n"), F.sum("rate").cast("long").alias("rates"))


@query(f"""WITH {s.OBS} SELECT country_code, CAST(year(snapshot_date) AS INTEGER) AS year, count(*) AS n FROM obs WHERE country_code <> 'AA' AND year(snapshot_date) <> 1997 GROUP BY ALL""")
def materialised_counts(spark, d):
    """A table kept under the key of its set of snapshots: the second call reads what the first one built."""
    o = s.observations(spark, d).where("country_code <> 'AA' and year(snapshot_date) <> 1997")
    snaps = o.select("country_code", "snapshot_date").distinct()
    folder = tables.shared_path(spark, "kept")
    build = lambda: o.groupBy("country_code", F.year("snapshot_date").alias("year")).agg(F.count("*").alias("n"))
    tables.materialised(spark, folder, snaps, build)
    return tables.materialised(spark, folder, snaps, lambda: build().limit(0))


# --- pages of prices


def _price_pages(spark: SparkSession, d: str) -> DataFrame:
    """A detail page for each part, with a section for each of its offers."""
    line = spark.read.parquet(f"{d}/lineitem.parquet").select("l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("p"), "l_returnflag")
    part = spark.read.parquet(f"{d}/part.parquet")
    price = F.when(F.col("l_returnflag") == "R", F.lit("sem preço")).otherwise(F.concat(F.replace("p", F.lit("."), F.lit(",")), F.lit(" €")))
    section = F.concat(F.lit('<div class="embalagem-main-panel"><span class="btn btn-link">'), F.col("l_suppkey").cast("string"), F.lit(' unidades</span><span class="btn btn-link">Caixa</span><span>PVP:</span><span>'), price, F.lit("</span><label>Número de Registo:</label><span>N"), F.col("l_suppkey").cast("string"), F.lit("</span><label>CNPEM:</label><div> </div><div>5015</div></div>"))
    offers = line.withColumn("s", section).groupBy("l_partkey").agg(F.array_join(F.sort_array(F.collect_list("s")), "").alias("offers"))
    head = F.concat(F.lit('<script>x("<b>")</script><span id="detalheMedNomeMed">'), F.initcap("p_name"), F.lit(" &eacute;&#233;&#xE9; &amp;lt;</span><label>Substância Ativa/DCI:</label><span> </span><span>"), F.col("p_name"), F.lit("</span><label>Dosagem:</label><span>"), F.col("p_size").cast("string"), F.lit(" mg</span>"))
    return part.join(offers, part.p_partkey == offers.l_partkey).select(F.col("p_partkey").alias("page_id"), F.concat(head, "offers").alias("html"))


@query("""WITH l AS (SELECT DISTINCT l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem WHERE l_returnflag <> 'R')
SELECT p_partkey AS page_id, upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] || ' ééé &lt;' AS name, p_name AS substance, p_size || ' mg' AS dose, 'N' || l_suppkey AS code, l_suppkey || ' unidades; Caixa' AS presentation,
replace(CAST(p AS VARCHAR), '.', ',') AS price, '5015' AS cnpem FROM part JOIN l ON l_partkey = p_partkey""")
def price_pages(spark, d):
    """Detail pages to price rows: text by id, values after labels, sections, joined labels, numeric prices only."""
    r = html.price_rows(_price_pages(spark, d))
    return r.select("page_id", F.col("Nome do Medicamento").alias("name"), F.col("Substância Ativa/DCI").alias("substance"), F.col("Dosagem").alias("dose"), F.col("Código").alias("code"), F.col("Apresentação").alias("presentation"), F.col("PVP").alias("price"), F.col("CNPEM").alias("cnpem"))


#: Part keys of one search page, so a page has a bounded number of entries.
PAGE = 1000
_PAGE_ID = f"p_brand || '/' || (p_partkey // {PAGE})"


def _search_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of a brand's parts, those of PAGE part keys in a row on one: options of their sizes (some with short codes), links and a total."""
    part = spark.read.parquet(f"{d}/part.parquet").withColumn("page_id", F.concat_ws("/", "p_brand", F.floor(F.col("p_partkey") / PAGE)))
    code = F.concat(F.lit("A"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("BC01"))
    option = F.concat(F.lit('<option value="REF_CLASS_ATC:'), F.when(F.col("p_size") % 5 == 0, F.left(code, F.lit(5))).otherwise(code), F.lit('">'), F.lit("size &gt; "), F.col("p_size").cast("string"), F.lit("</option>"))
    link = F.concat(F.lit('<a id="mainForm:dt-medicamentos:'), F.col("p_size").cast("string"), F.lit(':linkNome">x</a>'))
    made = part.groupBy("p_brand", "page_id").agg(F.array_join(F.sort_array(F.collect_list(option)), "").alias("o"), F.array_join(F.sort_array(F.collect_list(link)), "").alias("l"), F.count("*").cast("string").alias("n"))
    total = F.when(F.col("p_brand") == "Brand#3", "none").otherwise(F.concat(F.lit("total de "), F.col("n"), F.lit(" registos")))
    return made.select("page_id", F.concat("o", "l", total).alias("html"))


@query(f"""SELECT DISTINCT {_PAGE_ID} AS page_id, 'A' || lpad(CAST(p_size AS VARCHAR), 2, '0') || 'BC01' AS code, 'size > ' || p_size AS label FROM part WHERE p_size % 5 <> 0""")
def page_options(spark, d):
    return html.options(_search_pages(spark, d)).select("page_id", "code", "label")


@query(f"""SELECT {_PAGE_ID} AS page_id, CAST(count(DISTINCT p_size) AS INTEGER) AS n_links, CAST(count(CASE WHEN p_brand <> 'Brand#3' THEN 1 END) AS INTEGER) AS n_results FROM part GROUP BY p_brand, page_id""")
def page_links(spark, d):
    return _search_pages(spark, d).select("page_id", F.size(html.link_ids(F.col("html"))).alias("n_links"), html.result_count(F.col("html")).alias("n_results"))
