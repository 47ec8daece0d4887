from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from crosslane.functions import forms, molecules
from crosslane.functions import scalars as s
from crosslane.functions.forms import PL_NAME_FORMS


def values(spark, rows, column, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_strength(spark):
    got = values(spark, ["500 mg", "2.5mg/ml", "25 mg/0.5 ml", "10 mg/0 ml", "500/800MG/IU", "5 mcg", "100 J.M.", "2 %", "x", "", None], s.parse_strength(F.col("x")))
    assert [(g and (float(g.value), g.unit)) for g in got] == [(500, "mg"), (2.5, "mg/ml"), (50, "mg/ml"), None, None, (5, "ug"), (100, "[iU]"), (2, "%"), None, None, None]


def test_pack(spark):
    got = values(spark, ["30", "28 tabs", "20 szt.", "5 fiol.", "10 amp", "3 x 10 ml", "14 kapsułki", "a", None], s.parse_pack(F.col("x")))
    assert [g and g.units for g in got] == [30, 28, 20, 5, 10, 3, 14, None, None]


@pytest.mark.parametrize(("text", "want"), [("1.234,50", "1234.50"), ("12.50", "12.50"), ("5,63 €", "5.63"), ("nan", None), ("not-a-number", None), (None, None)])
def test_retail_decimal(spark, text, want):
    assert values(spark, [text], s.retail_decimal(F.col("x"))) == [want and Decimal(want).quantize(Decimal("0.000001"))]


def test_locale_decimal(spark):
    assert values(spark, ["1 234,5", "x", ""], s.locale_decimal(F.col("x"), ",")) == [Decimal("1234.500000"), None, None]


def test_polish_name(spark):
    names = ["Adeksa, tabl., 100 mg", "Lek, tabl. powl., 29,03+66,66 mg", "Witamina, kaps., 25 000 j.m.", "Sam", ""]
    got = values(spark, names, s.polish_name(F.col("x"), list(PL_NAME_FORMS)))
    assert [(g.name, g.form, g.strength) for g in got[:4]] == [("Adeksa", "tablet", "100 mg"), ("Lek", "tablet", "29.03+66.66 mg"), ("Witamina", "capsule", "25000 j.m."), ("Sam", None, None)]


def test_polish_name_of_many_parts(spark):
    long = "Lek, " + ", ".join(["x"] * 2000) + ", tabl., 5 mg"
    assert [(g.name, g.form, g.strength) for g in values(spark, [long], s.polish_name(F.col("x"), list(PL_NAME_FORMS)))] == [("Lek", "tablet", "5 mg")]


def test_names_and_keys(spark):
    df = spark.createDataFrame([("ABC", "abc 10"), ("Abc 10 x", "abc 10"), (None, "b"), ("a", None)], "a string, b string")
    assert [r[0] for r in df.select(s.joined_name(F.col("a"), F.col("b"))).collect()] == ["ABC abc 10", "Abc 10 x", "b", "a"]
    assert values(spark, [Decimal("20.0000"), Decimal("0.5000")], s.plain_decimal(F.col("x")), "x decimal(10,4)") == ["20", "0.5"]
    assert values(spark, ["12 caps", "caps"], s.leading_pack(F.col("x"))) == ["12", "caps"]
    assert len(values(spark, ["a"], s.stable_id(F.col("x")))[0]) == 36


@pytest.mark.parametrize(
    ("raw", "country", "name", "rule"),
    [("TBL FLM", "CZ", None, "cz.sukl.tbl_flm"), ("", "IE", "X 10mg Film Coated Tabs", "ie.pcrs.tablet"), ("MAŚĆ", "PL", None, "pl.mz.topical_semisolid"), ("Tablet", "DE", None, "global.tablet"), ("comprimidos", "ES", None, "es.nomenclator.tablet"), ("?", "DE", None, None)],
)
def test_forms(spark, raw, country, name, rule):
    df = spark.createDataFrame([(raw, country, name)], "r string, c string, n string")
    assert df.select(forms.normalised_form(F.col("r"), F.col("c"), F.col("n")).alias("f")).select("f.rule_id").first()[0] == rule


def test_compatibility(spark):
    df = spark.createDataFrame([("TBL FLM", "TBL NOB"), ("TBL NOB", "INJ SOL"), ("TBL NOB", "?"), ("TBL NOB", "CPS DUR")], "a string, b string")
    sides = df.select(*[forms.normalised_form(F.col(c), "CZ", F.lit("")).alias(c) for c in "ab"])
    parts = [{f: F.col(f"{c}.{f}") for f in ("form_class", "route", "attributes", "confidence")} for c in "ab"]
    made = sides.select(forms.compatibility(*parts).alias("x")).select("x.*").collect()
    assert [(r.fits, r.cap, r.notes) for r in made] == [(True, "high", [forms.OTHER_ATTRIBUTES]), (False, None, [forms.OTHER_ROUTE]), (False, None, [forms.NO_FORM]), (True, "exact", [])]


def test_rewriting(spark):
    names = ["acidum acetylsalicylicum", "metforminum", "natrii valproas", "Losartanum", "paracetamol"]
    got = values(spark, names, molecules.rewritten(F.col("x"), F.lit("pl")))
    assert [g.name for g in got] == ["acetylsalicylic acid", "metformin", "valproate sodium", "losartan", "paracetamol"]
    assert got[4].labels == []


def test_identity_resolution(spark):
    words = molecules.dictionary(spark.createDataFrame([("N02BE01", "paracetamol"), ("A10BK01", "dapagliflozin"), ("A10BA02", "metformin"), ("A10BA", "x")], "atc_code string, atc_name string"))
    rows = [(1, "BE", None, "N02BE01", None, "DAFALGAN"), (2, "BE", None, None, "Dapagliflozine", "FORXIGA"), (3, "BE", None, None, None, "FORXIGA 10 mg"), (4, "BE", None, None, None, "METFORMINE VIATRIS 500 mg")]
    df = spark.createDataFrame(rows, "k int, country_code string, inn string, atc_code string, label string, product_name string")
    got = {r.k: (r.canonical_inn, r.identity_method) for r in molecules.resolve_identity(df, words, ("label",)).collect()}
    assert got == {1: ("paracetamol", "atc_exact"), 2: ("dapagliflozin", "active_ingredient_label"), 3: (None, "none"), 4: ("metformin", "product_name_prefix")}


def test_ambiguous_near_match(spark):
    words = molecules.dictionary(spark.createDataFrame([("A01AA01", "abcdef"), ("A01AA02", "abcdeg"), ("A01AA03", "zzzzzz")], "atc_code string, atc_name string"))
    got = {r.inn: (r.canonical, r.method) for r in molecules.normalise_names(spark.createDataFrame([("IE", "abcdeh"), ("IE", "zzzzz"), ("IE", "zzzzzz")], "country_code string, inn string"), words).collect()}
    assert got == {"abcdeh": (None, "ambiguous"), "zzzzz": ("zzzzzz", "fuzzy"), "zzzzzz": ("zzzzzz", "exact")}


def test_product_type(spark):
    df = spark.createDataFrame([("Metformin Teva", "metformin"), ("Metformin 500", "metformin"), ("Glucophage", "metformin"), ("", "x"), ("X", None), ("Prednison 5", "prednisone")], "n string, i string")
    assert [r[0] for r in df.select(molecules.product_type(F.col("n"), F.col("i"))["type"]).collect()] == ["generic", "generic", "brand", "brand", "brand", "generic"]
