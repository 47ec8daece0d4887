import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from crosslane.functions import molecules
from crosslane.operators import candidates, canonical, fx, lanes, policy, quality, review
from crosslane.sources import html, tables

DAY = datetime.date


def test_default_formulas(spark):
    rows = [("1", "IE", "Reimbursement Price", "112.00", "injectable"), ("2", "IE", "Reimbursement Price", "108.00", "oral_solid"), ("3", "IT", "Prezzo al pubblico", "100.00", ""), ("4", "PT", "PVP", "776.28", ""), ("5", "ES", "Precio de venta al público con IVA", "104.00", ""), ("6", "IT", "Prezzo al pubblico", "0", "")]
    df = spark.createDataFrame(rows, "id string, country_code string, price_type string, p string, dosage_form string").select("*", F.col("p").cast("decimal(18,6)").alias("price_amount"), F.lit("2026-01-01").cast("date").alias("snapshot_date"), F.lit(None).cast("string").alias("route_of_administration"), F.lit(True).alias("price_includes_vat"))
    got = {r.source_record_id: r.price_amount for r in policy.virtual_lanes(df, policy.default_policies(spark), {"default-IE": policy.IE_BRANCHES}).collect()}
    assert got == {"1": Decimal("100.000000"), "2": Decimal("100.000000"), "3": Decimal("66.650000"), "4": Decimal("690.932947"), "5": Decimal("66.620417")}


def test_lane_is_not_derived_where_it_exists(spark):
    rows = [("1", "IT", "Prezzo al pubblico", "10"), ("2", "IT", policy.DERIVED, "5")]
    df = spark.createDataFrame(rows, "id string, country_code string, price_type string, p string").select("*", F.col("p").cast("decimal(18,6)").alias("price_amount"), F.lit("2026-01-01").cast("date").alias("snapshot_date"))
    assert policy.virtual_lanes(df, policy.default_policies(spark)).count() == 0


def test_latest_policy_wins(spark):
    def p(i, since, until=None, over=None):
        return (i, "BE", "X", "ex_factory", since, until, over, "high", None, [], ["s"], ("ex_factory", "vat_exclusive", "none", "published"), [])

    rows = [p("old", DAY(2026, 1, 1)), p("new", DAY(2026, 5, 22)), p("gone", DAY(2026, 5, 23), None, "new"), p("short", DAY(2026, 5, 22), DAY(2026, 5, 22))]
    asked = spark.createDataFrame([("BE", "X", DAY(2026, 5, 23)), ("BE", "Y", DAY(2026, 5, 23))], "country_code string, price_type string, snapshot_date date")
    for some in (rows, rows[::-1]):
        got = policy.valid_policy(asked, spark.createDataFrame(some, policy.POLICY)).withColumn("g", policy.policy_gate())
        assert {(r.price_type, r.policy and r.policy.id, r.g.reason) for r in got.collect()} == {("X", "new", None), ("Y", None, "no policy interpretation")}


def test_fx(spark):
    rates = spark.createDataFrame([("EUR", "PLN", DAY(2026, 5, 15), Decimal("4.2465"), "", None), ("EUR", "CZK", DAY(2026, 5, 19), Decimal("25.095"), "", None)], fx.RATE)
    rows = [("PLN", DAY(2026, 5, 20), Decimal("42.465")), ("PLN", DAY(2026, 5, 14), Decimal("1")), ("EUR", DAY(2026, 1, 1), Decimal("7")), ("XXX", DAY(2026, 6, 1), Decimal("1"))]
    df = spark.createDataFrame(rows, "price_currency string, fx_date date, price_amount decimal(18,6)")
    assert sorted(float(r.amount_eur) for r in fx.to_base(df, rates).collect()) == [7.0, 10.0]


def test_profiles_and_gate(spark):
    rows = [("IE", DAY(2024, 7, 1), Decimal(x)) for x in (0, 0, 0, 5, 6)]
    p = quality.plausibility(quality.numeric_profile(spark.createDataFrame(rows, "country_code string, snapshot_date date, v decimal(18,6)"), "v", quality.SNAPSHOT))
    r = p.withColumn("g", quality.data_gate()).first()
    assert (r.assessment, r.g.blocked, r.outlier_count) == ("implausible", True, 3)
    assert quality.snapshot_status(p).first().status == "red"


def record(i, country, name, amount, pack, ccy="EUR"):
    return (i, country, DAY(2024, 9, 1), name, name, name, "500 mg", f"{pack} tabs", "list", Decimal(amount), ccy, i, "tablet")


def records(spark, rows):
    cols = "id string, country_code string, snapshot_date date, product_name string, inn string, canonical_inn string, strength string, pack_size string, price_type string, price_amount decimal(18,6), price_currency string, raw_record_id string, dosage_form string"
    return spark.createDataFrame(rows, cols).withColumns({"form_class": F.lit("oral_solid"), "route": F.lit("oral"), "atc_code": F.lit("N02BE01")})


def test_golden_pair_and_review(spark):
    df = records(spark, [record("f", "FR", "paracetamol", "2.10", 30), record("i", "IE", "paracetamol", "2.85", 30)])
    df = lanes.parsed(df).withColumns({"comparison_category": F.lit("ex_factory"), "vat_position": F.lit("vat_exclusive"), "attributes": F.array().cast("array<string>"), "form_confidence": F.lit("strong")})
    rates = spark.createDataFrame([], fx.RATE)
    c = candidates.candidates(df, rates).withColumns({f"{k}_id_{s}": F.lit(v) for s in "ab" for k, v in (("policy", "p"), ("profile", "q"))})
    r = c.first()
    assert (r.id_a, r.id_b, r.identity_confidence) == ("f", "i", "exact") and r.price_ratio == pytest.approx(0.7368421053)
    pol = spark.createDataFrame([("p", "high", ["note"])], "id string, confidence string, caveats array<string>")
    for level, want in (("plausible", "usable"), ("suspect", "usable_with_caveat"), ("implausible", "not_comparable")):
        got = review.assess(c, pol, spark.createDataFrame([("q", level)], "id string, assessment string"))
        assert got.first().usability == want
    counts = {x.usability: x.n for x in review.usability_counts(got).collect()}
    assert counts == {"usable": 0, "usable_with_caveat": 0, "exploratory": 0, "not_comparable": 1}
    assert "0.7368" in review.reports(got).first().report and review.reports(got, "zh-CN").first().report.startswith("# 价格比较")
    lineage = spark.createDataFrame([("f", "d"), ("i", "gone")], "raw_record_id string, source_document_id string")
    links = review.audit_links(c, got, candidates.derivation_rules(df), spark.createDataFrame([("q",)], "id string"), pol, df, lineage, spark.createDataFrame([("d",)], "id string"))
    assert review.resolution(links).first().broken == "b:document"
    assert review.for_molecule(c, candidates.evidence(c), got, " Paracetamol").first().amount_a == "2.100000"


def test_cohorts_need_countries(spark):
    df = lanes.parsed(records(spark, [record(c, c, "ibuprofen", "3", 30) for c in ("FR", "IE", "ES")] + [record("x", "FR", "other", "3", 30)]))
    df = df.withColumns({"lane_key": F.lit("l"), "identity_key": lanes.identity_key(), "eur_per_strength": F.col("strength_price")})
    got = lanes.cohorts(df, 3)
    assert got.count() == 3 and lanes.summary(lanes.cheapest(got)).first().n_countries == 3


def test_canonical_routes_every_row(spark):
    raw = spark.createDataFrame([(1, "A", "10", "tab", "5", "1,5"), (2, "", "10", "tab", "5", "2"), (3, "C", "10", "tab", "5", "not-a-number"), (4, "D", "10", "tab", "5", "0")], "row_index int, n string, s string, f string, p string, price_text_ string")
    c = canonical.Country("XX", "EUR", {"n": "product_name", "s": "strength", "f": "dosage_form", "p": "pack_size", "price_text_": "price"}, decimal=",", zero_is_anomaly=True)
    good, bad, lineage = canonical.canonical(raw, c, F.lit("2024-05-15").cast("date"), F.lit("doc"))
    assert (good.count(), bad.count(), lineage.count()) == (1, 3, 1)
    assert {r.title for r in bad.collect()} == {"missing: product_name", "price can't be read", "price is zero"}
    with pytest.raises(Exception, match="expected IE"):
        canonical.guard_country(good, "IE").collect()


def test_unpivot_of_price_columns(spark):
    raw = spark.createDataFrame([(1, "Lek, tabl., 10 mg", "Subst", "30 szt.", "10,5", "11", "", "12"), (2, "Lek, tabl., 10 mg", "Subst", "30 szt.", "", None, "", "")], "row_index int, `Nazwa  postać i dawka` string, `Substancja czynna` string, `Zawartość opakowania` string, `Cena zbytu netto` string, `Urzędowa cena zbytu` string, `Cena hurtowa brutto` string, `Cena detaliczna` string")
    rows = canonical.judged(raw, canonical.COUNTRIES["PL"]).where("row_index = 1").collect()
    assert sorted((r.price_type, float(r.price_amount), r.price_includes_vat) for r in rows) == [("Cena detaliczna", 12.0, True), ("Cena zbytu netto", 10.5, False), ("Urzędowa cena zbytu", 11.0, True)]
    assert (rows[0].strength, rows[0].dosage_form, rows[0].inn) == ("10 mg", "oral_solid", "subst")
    assert [r.reason for r in canonical.judged(raw, canonical.COUNTRIES["PL"]).where("row_index = 2").collect()] == ["price can't be read"]


LISTS = {
    "IE": {"Drug Name": "PARACET 500mg Film Coated Tabs", "INN": "Paracetamol", "Strength Measure": "500 mg", "Pack Size": "30", "Code": "12345", "Non Proprietary Name": "Maker", "Reimbursement Price": "2.85"},
    "FR": {"CIP13": "340", "DENOMINATION": "DOLIPRANE", "INN": "paracetamol", "ATC": "N02BE01", "DOSAGE": "500mg", "FORME": "tablet", "CONDITIONNEMENT": "30", "LABORATOIRE": "Labo", "PRIX_FABRICANT_EUR": "2.10"},
    "ES": {"Código Nacional": "650004", "Nombre del producto farmacéutico": "DEPAKINE 500 mg comprimidos gastrorresistentes, 20 comprimidos", "Tipo de fármaco": "Medicamento Etica", "Nombre del laboratorio ofertante": "SANOFI", "Principio activo o asociación de principios activos": "VALPROATO SODIO", "Precio de venta al público con IVA": "2,50"},
    "IT": {"Principio Attivo": "Acarbosio", "Descrizione Gruppo": "ACARBOSIO 100MG 40 UNITA' USO ORALE", "Denominazione e Confezione": "ACARBOSIO*40 cpr 100 mg", "Prezzo al pubblico €": "5,63", "Titolare AIC": "DOC", "AIC": "044155024"},
    "PT": {"Nome do Medicamento": "ACARBOSIO", "Substância Ativa/DCI": "Acarbose", "Forma Farmacêutica": "Comprimido", "Dosagem": "100 mg", "Apresentação": "40 comprimidos", "Titular de AIM": "Holder", "ATC": "A10BF01 - acarbose", "PVP": "5,63", "Código": "PT-1"},
    "BE": {"SPB_PRICE": "10.80", "S_COD": "1234567", "S_NAM": "BELGIAN TEST", "S_NAM_SPECIF": "500 mg 30 tablets", "F_ORGA": "Pharma NV", "ATC_COD": "N02BE01", "SI_CONC_NOM": "500 mg", "VOLUME_TOTAL": "30", "INN": "paracetamol", "RPT_PCK_LBL_FR": "30 comprimés pelliculés", "RPT_PCK_LBL_NL": "30 filmomhulde tabletten"},
    "CZ": {"kodSUKL": "0001", "nazev": "PARALEN 500", "sila": "500mg", "lekovaFormaKod": "TBL NOB", "baleni": "24 I", "ATCkod": "N02BE01", "cenaPuvodce": "20.5", "maxCenaLekarna": None},
}
#: product name, strength, pack, form, route, price, VAT, price type, code.
RECORDS = {
    "IE": ("PARACET 500mg Film Coated Tabs", "500 mg", "30", "oral_solid", "oral", "2.85", False, "Reimbursement Price", "12345"),
    "FR": ("DOLIPRANE", "500mg", "30", "oral_solid", "oral", "2.10", False, "PRIX_FABRICANT_EUR", "340"),
    "ES": ("DEPAKINE 500 mg comprimidos gastrorresistentes, 20 comprimidos", "500 mg", "20", "oral_solid", "oral", "2.50", True, "Precio de venta al público con IVA", "650004"),
    "IT": ("ACARBOSIO*40 cpr 100 mg", "100MG", "40", "oral_solid", "oral", "5.63", True, "Prezzo al pubblico", "044155024"),
    "PT": ("ACARBOSIO", "100 mg", "40", "oral_solid", "oral", "5.63", True, "PVP", "PT-1"),
    "BE": ("BELGIAN TEST 500 mg 30 tablets", "500 mg", "30", "oral_solid", "oral", "10.80", False, "SPB_PRICE", "1234567"),
    "CZ": ("PARALEN 500", "500MG", "24", "oral_solid", "oral", "20.5", False, "cenaPuvodce", "0001"),
}


@pytest.mark.parametrize("code", sorted(LISTS))
def test_country_lists(spark, code):
    c, row = canonical.COUNTRIES[code], LISTS[code]
    words = molecules.dictionary(spark.createDataFrame([("N02BE01", "paracetamol"), ("A10BF01", "acarbose")], "atc_code string, atc_name string"))
    raw = spark.createDataFrame([tuple(row.values())], ", ".join(f"`{k}` string" for k in row))
    (r,) = canonical.named(canonical.judged(raw, c), c, words).collect()
    name, strength, pack, form, route, price, vat, kind, number = RECORDS[code]
    assert (r.reason, r.product_name, r.strength, r.pack_size, r.dosage_form, r.route_of_administration, r.price_amount, r.price_includes_vat, r.price_type, r.product_code) == (None, name, strength, pack, form, route, Decimal(price), vat, kind, number)
    assert (r.inn or "").lower() == {"ES": "valproato sodio", "IT": "acarbosio", "PT": "acarbose"}.get(code, "paracetamol")
    assert r.atc_code == {"FR": "N02BE01", "BE": "N02BE01", "CZ": "N02BE01", "PT": "A10BF01"}.get(code)


def test_rows_that_are_no_priced_medicine_go(spark):
    for code, gone in (("ES", "Tipo de fármaco"), ("BE", "SPB_PRICE"), ("CZ", "cenaPuvodce")):
        row = {**LISTS[code], gone: "nan"}
        assert canonical.judged(spark.createDataFrame([tuple(row.values())], ", ".join(f"`{k}` string" for k in row)), canonical.COUNTRIES[code]).count() == 0


def test_list_without_any_expected_column(spark):
    for code, c in canonical.COUNTRIES.items():
        if code not in ("ES", "BE", "CZ"):
            assert canonical.judged(spark.createDataFrame([("x",)], "other string"), c).first().reason.startswith("missing"), code


def test_pages(spark):
    page = '<span id="detalheMedNomeMed">Humira</span><label>Substância Ativa/DCI:</label><span>adalimumab</span><div class="embalagem-main-panel"><span class="btn btn-link">2 unidades</span><span>PVP:</span><span>776,28 €</span><span>Número de Registo:</span><span>5671003</span><span>CNPEM:</span><span>50157000</span></div>'
    search = '<option value="REF_CLASS_ATC:N02BE01">a</option><option value="REF_CLASS_ATC:N02BE">x</option><option value="REF_CLASS_ATC:L04AB04">b</option> total de 2 registos'
    df = spark.createDataFrame([(1, page), (2, search)], "page_id int, html string")
    r = html.price_rows(df).collect()
    assert [(x["Nome do Medicamento"], x["Substância Ativa/DCI"], x["PVP"], x["Código"], x["CNPEM"], x["Apresentação"]) for x in r] == [("Humira", "adalimumab", "776,28", "5671003", "50157000", "2 unidades")]
    assert {x.code for x in html.options(df).collect()} == {"N02BE01", "L04AB04"}
    assert df.select(html.result_count(F.col("html"))).collect()[1][0] == 2


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("x;y\n1;\"a;b\"\n")
    rows = tables.read_delimited(spark, f"file://{tmp_path}/in/a.csv", ["x", "y"], ";")
    assert [tuple(r) for r in rows.collect()] == [("1", "a;b")]
    import hashlib

    sha = hashlib.sha256((tmp_path / "in/a.csv").read_bytes()).hexdigest()
    manifest = spark.createDataFrame([("FR", DAY(2024, 1, 1), [("a.csv", sha, 1), ("b.csv", sha, 1)])], tables.MANIFEST)
    assert {(r.name, r.status) for r in tables.verify_files(spark, f"file://{tmp_path}/in", manifest).collect()} == {("a.csv", "ok"), ("b.csv", "missing")}
    snap = spark.createDataFrame([("FR", DAY(2024, 1, 1), 1)], "country_code string, snapshot_date date, v int")
    built = []
    for _ in range(2):
        tables.materialised(spark, f"file://{tmp_path}/cache", snap, lambda: built.append(1) or snap).count()
    assert len(built) == 1
    keys = [tables.files_key(spark, [f"file://{tmp_path}/in"]) for _ in range(2)]
    (tmp_path / "in/c.csv").write_text("z")
    assert keys[0] == keys[1] != tables.files_key(spark, [f"file://{tmp_path}/in"])
    assert not tables.complete(spark, f"file://{tmp_path}/in")
    assert tables.read_records(spark, f"file://{tmp_path}/none", "price_amount string").count() == 0


def test_sections_of_a_page_with_many_markers(spark):
    df = spark.createDataFrame([(1, "<li>" * 100_003), (2, "none"), (3, None), (4, "")], "page_id int, html string")
    assert {r.page_id: r["count"] for r in html.sections(df, "<li>").groupBy("page_id").count().collect()} == {1: 100_003}
