"""Policies: temporal join, gates, formulas and virtual price lanes."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import stable_id
from ..sources.tables import written

RULE = (
    "struct<source_price_type:string,target_price_type:string,target_category:string,formula_id:string,formula:string,parameters:map<string,string>,"
    "tiers:array<struct<id:string,lower:string,upper:string,max_pvp:string,coefficient:string,fixed_fee:string,divisor:string,vat_rate:string,fixed_margin:string>>,"
    "legal_basis:array<string>,confidence:string,caveats:array<string>>"
)
POLICY = (
    "id string, country_code string, price_type string, comparison_category string, effective_from date, effective_to date, superseded_by string, confidence string, "
    "authored_at timestamp, caveats array<string>, source_references array<string>, semantics struct<comparison_category:string,vat_position:string,margin_position:string,derivation_kind:string>, "
    f"derivation_rules array<{RULE}>"
)
#: Policies are a hand-written dimension; beyond this count they are joined by a shuffle.
MOST_BROADCAST = 100_000
DERIVED = "derived_ex_factory"
#: The built-in formulas count from this day on.
DEFAULTS_SINCE = date(1990, 1, 1)


def small(df: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """A dimension marked for broadcast if a count shows that it is small. Not for frames derived from records: counting
    those would run their plan twice, and adaptive execution broadcasts them by their actual size."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def valid_policy(asked: DataFrame, policies: DataFrame, lanes: DataFrame | None = None) -> DataFrame:
    """Add ``policy``, the struct in force for each (country_code, price_type, snapshot_date) of ``asked``; null if none.

    In force: from <= date <= to (open if null) and not superseded; of several the latest by start, then by authoring.
    Keys are made distinct first, so the range join runs on keys, not on records. What they find is written, so its size decides how the
    records meet it: few keys are broadcast, and no record is shuffled for them. ``lanes``: the keys, where they are told by less than ``asked``; more
    of them do no harm.
    """
    keys = ["country_code", "price_type", "snapshot_date"]
    p = policies.where("superseded_by is null")
    p = p.select(F.col("country_code").alias("_cc"), F.col("price_type").alias("_pt"), F.struct(*policies.columns).alias("_p"))
    d = (asked if lanes is None else lanes).select(*keys).distinct()
    ok = (F.col("_p.effective_from") <= F.col("snapshot_date")) & (F.col("_p.effective_to").isNull() | (F.col("snapshot_date") <= F.col("_p.effective_to")))
    hit = d.join(small(p), (F.col("_cc") == F.col("country_code")) & (F.col("_pt") == F.col("price_type")) & ok)
    best = hit.groupBy(*keys).agg(F.max_by("_p", F.struct("_p.effective_from", "_p.authored_at", "_p.id")).alias("policy"))
    return asked.join(written(best, "in_force"), keys, "left")


def policy_gate(policy: str = "policy") -> Column:
    """struct(blocked, reason) of the policy that was found."""
    category = F.col(f"{policy}.comparison_category")
    reason = (
        F.when(F.col(f"{policy}.id").isNull(), "no policy interpretation")
        .when(category == "unmapped", "price type is unmapped")
        .when(category == "not_comparable", "price type is not comparable")
    )
    return F.struct(reason.isNotNull().alias("blocked"), reason.alias("reason"))


def lane_semantics(policy: str = "policy") -> list[Column]:
    names = ("comparison_category", "vat_position", "margin_position", "derivation_kind")
    return [F.col(f"{policy}.semantics.{n}").alias(n) for n in names] + [F.col(f"{policy}.confidence").alias("policy_confidence"), F.col(f"{policy}.caveats").alias("policy_caveats"), F.col(f"{policy}.id").alias("policy_id")]


def derivation_edges(policies: DataFrame, country: str | None = None) -> DataFrame:
    """One row for each derivation rule of a policy."""
    p = policies if country is None else policies.where(F.upper("country_code") == country.upper())
    return p.select("country_code", F.col("id").alias("policy_id"), F.col("semantics.vat_position").alias("vat_position"), F.explode("derivation_rules").alias("rule")).select("country_code", "policy_id", "vat_position", "rule.*")


def edges_by_country(edges: DataFrame) -> DataFrame:
    one = F.struct("source_price_type", "target_price_type", "formula_id", "policy_id")
    return edges.groupBy("country_code").agg(F.sort_array(F.collect_list(one)).alias("edges"), F.count("*").alias("n_edges"))


def condition(tree: dict) -> Column:
    """A Boolean column from {any: [...]}, {all: [...]}, {field, equals} or {field, contains}; texts are compared without case."""
    if tree.get("any"):
        parts = [condition(t) for t in tree["any"]]
        return F.coalesce(parts[0] if len(parts) == 1 else _fold(parts, lambda a, b: a | b), F.lit(False))
    if tree.get("all"):
        parts = [condition(t) for t in tree["all"]]
        return F.coalesce(parts[0] if len(parts) == 1 else _fold(parts, lambda a, b: a & b), F.lit(False))
    if not tree.get("field"):
        return F.lit(False)
    text = F.lower(F.trim(F.col(tree["field"]).cast("string")))
    if tree.get("equals") is not None:
        return F.coalesce(text == str(tree["equals"]).strip().lower(), F.lit(False))
    if tree.get("contains") is not None:
        return F.coalesce(F.contains(text, F.lit(str(tree["contains"]).strip().lower())), F.lit(False))
    return F.lit(False)


def _fold(parts: list[Column], f: Callable) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = f(out, p)
    return out


def conditional_parameters(parameters: Column, branches: list[tuple[dict, dict]]) -> Column:
    """``parameters`` overridden by those of the first (condition, parameters) branch that holds."""
    out = None
    for when, values in branches:
        over = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
        merged = F.map_concat(_without(parameters, list(values)), over)
        out = F.when(condition(when), merged) if out is None else out.when(condition(when), merged)
    return parameters if out is None else out.otherwise(parameters)


def _without(parameters: Column, names: list[str]) -> Column:
    return F.map_filter(parameters, lambda k, v: ~k.isin(*names))


def _num(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("decimal(18,6)")


def _first_tier(tiers: Column, amount: Column, value: Callable, fits: Callable) -> Column:
    got = F.transform(tiers, lambda t: F.struct(value(t, amount).alias("v"), fits(t, amount, value(t, amount)).alias("ok")))
    return F.try_element_at(F.filter(got, lambda g: g["ok"]), F.lit(1))["v"]


def _by_result(tiers: Column, amount: Column) -> Column:
    """The first tier whose own result lies in [lower, upper]; between tiers there is none."""
    value = lambda t, a: F.try_divide(a - _num(t["fixed_fee"]), _num(t["coefficient"]))
    return _first_tier(tiers, amount, value, lambda t, a, v: F.coalesce((v >= _num(t["lower"])) & (t["upper"].isNull() | (v <= _num(t["upper"]))), F.lit(False)))


def _by_input(tiers: Column, amount: Column) -> Column:
    """The first tier whose bound isn't below the amount: a divisor, or VAT and a fixed margin. Not positive: none."""
    value = lambda t, a: F.when(t["divisor"].isNotNull(), F.try_divide(a, _num(t["divisor"]))).otherwise(F.try_divide(a, 1 + _num(t["vat_rate"])) - _num(t["fixed_margin"]))
    got = _first_tier(tiers, amount, value, lambda t, a, v: F.coalesce((t["max_pvp"].isNull() | (a <= _num(t["max_pvp"]))) & v.isNotNull(), F.lit(False)))
    return F.when(got > 0, got)


#: Formula id -> column of (amount, parameters, tiers). A new formula is a new entry.
FORMULAS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "multiply_by_factor": lambda a, p, t: a * _num(p["factor"]),
    "divide_by_divisor": lambda a, p, t: F.try_divide(a, _num(p["divisor"])),
    "divide_by_one_plus_markup": lambda a, p, t: F.try_divide(a, 1 + _num(F.coalesce(p["markup"], p["default_markup"]))),
    "subtract_fixed_fee_then_divide": lambda a, p, t: F.when((a - _num(p["fixed_fee"])) > 0, F.try_divide(a - _num(p["fixed_fee"]), _num(p["coefficient"]))),
    "tiered_pt_pvp_to_pva": lambda a, p, t: _by_result(t, a),
    "tiered_es_pvp_to_pva": lambda a, p, t: _by_input(t, a),
}


def formula_amount(formula: Column, amount: Column, parameters: Column, tiers: Column) -> Column:
    """The derived amount, rounded half up to six decimals; null for an amount that isn't positive or a rule that can't apply."""
    out = None
    for name, f in FORMULAS.items():
        value = f(amount, parameters, tiers).cast("decimal(38,12)")
        out = F.when(formula == name, value) if out is None else out.when(formula == name, value)
    return F.when(amount > 0, F.round(out, 6).cast("decimal(18,6)"))


def virtual_lanes(records: DataFrame, policies: DataFrame, branches: dict[str, list[tuple[dict, dict]]] | None = None) -> DataFrame:
    """Derived rows for every rule whose target type the snapshot hasn't got: the source row's columns with a new id, type,
    amount and VAT flag, and source_record_id, policy_id, formula_id and formula. ``branches``: conditional parameters by policy id."""
    edges = derivation_edges(policies).select(
        F.col("country_code").alias("_cc"), F.col("source_price_type").alias("_source"), F.col("target_price_type").alias("_target"), "policy_id", "formula_id", "formula",
        F.coalesce("parameters", F.create_map().cast("map<string,string>")).alias("_params"), F.coalesce("tiers", F.array()).alias("_tiers"), (F.col("vat_position") == "vat_inclusive").alias("_vat"),
    )
    there = records.select(F.col("country_code").alias("_cc"), F.col("snapshot_date"), F.col("price_type").alias("_target")).distinct()
    hit = records.join(small(edges), (F.col("_cc") == F.col("country_code")) & (F.col("_source") == F.col("price_type")))
    hit = hit.join(there, ["_cc", "snapshot_date", "_target"], "left_anti")
    params = F.col("_params")
    for policy_id, some in (branches or {}).items():
        params = F.when(F.col("policy_id") == policy_id, conditional_parameters(F.col("_params"), some)).otherwise(params)
    amount = formula_amount(F.col("formula_id"), F.col("price_amount"), params, F.col("_tiers"))
    new_id = stable_id(F.lit("derived-record"), F.col("country_code"), F.col("id"), F.col("_target"), F.col("policy_id"))
    return (
        hit.withColumn("_amount", amount).where("_amount is not null").withColumn("source_record_id", F.col("id")).withColumn("id", new_id)
        .withColumn("price_type", F.col("_target")).withColumn("price_amount", F.col("_amount")).withColumn("price_includes_vat", F.col("_vat"))
        .select(*[c for c in records.columns if c != "price_includes_vat"], "price_includes_vat", "source_record_id", "policy_id", "formula_id", "formula")
    )


def with_virtual_lanes(records: DataFrame, policies: DataFrame, branches: dict | None = None) -> DataFrame:
    return records.unionByName(virtual_lanes(records, policies, branches), allowMissingColumns=True)


def _rule(source: str, formula: str, parameters: dict, tiers: list[dict], basis: str) -> dict:
    names = ("id", "lower", "upper", "max_pvp", "coefficient", "fixed_fee", "divisor", "vat_rate", "fixed_margin")
    return {"source_price_type": source, "target_price_type": DERIVED, "target_category": "ex_factory", "formula_id": formula, "formula": formula, "parameters": parameters, "tiers": [tuple(t.get(n) for n in names) for t in tiers], "legal_basis": [basis], "confidence": "medium", "caveats": []}


# Published margin tiers and factors of countries without a stored policy.
PT_TIERS = [
    {"id": "1", "lower": "0", "upper": "5.00", "coefficient": "1.1475", "fixed_fee": "0.94"},
    {"id": "2", "lower": "5.01", "upper": "7.00", "coefficient": "1.1460", "fixed_fee": "1.95"},
    {"id": "3", "lower": "7.01", "upper": "10.00", "coefficient": "1.1439", "fixed_fee": "2.66"},
    {"id": "4", "lower": "10.01", "upper": "20.00", "coefficient": "1.1393", "fixed_fee": "4.17"},
    {"id": "5", "lower": "20.01", "upper": "50.00", "coefficient": "1.1316", "fixed_fee": "8.00"},
    {"id": "6", "lower": "50.01", "coefficient": "1.1051", "fixed_fee": "12.73"},
]
ES_TIERS = [
    {"id": "1", "max_pvp": "143.04", "divisor": "1.561083"},
    {"id": "2", "max_pvp": "260.9464", "vat_rate": "0.04", "fixed_margin": "45.91"},
    {"id": "3", "max_pvp": "578.1464", "vat_rate": "0.04", "fixed_margin": "50.91"},
    {"id": "4", "vat_rate": "0.04", "fixed_margin": "55.91"},
]
DEFAULT_RULES = {
    "IE": _rule("Reimbursement Price", "divide_by_one_plus_markup", {"markup": "0.08"}, [], "S.I. 639/2019"),
    "IT": _rule("Prezzo al pubblico", "multiply_by_factor", {"factor": "0.6665"}, [], "Class A public price framework"),
    "PT": _rule("PVP", "tiered_pt_pvp_to_pva", {}, PT_TIERS, "commercial margin tiers"),
    "ES": _rule("Precio de venta al público con IVA", "tiered_es_pvp_to_pva", {}, ES_TIERS, "reference price conversion"),
}
IE_BRANCHES = [({"any": [{"field": "dosage_form", "equals": "injectable"}, {"field": "dosage_form", "equals": "infusible"}, {"field": "route_of_administration", "equals": "parenteral"}]}, {"markup": "0.12"})]


def default_policies(spark) -> DataFrame:
    """The countries' built-in formulas as policies of the derived price type; use with branches={"default-IE": IE_BRANCHES}."""
    rows = []
    for cc, r in DEFAULT_RULES.items():
        rule = tuple(r[k] for k in ("source_price_type", "target_price_type", "target_category", "formula_id", "formula", "parameters", "tiers", "legal_basis", "confidence", "caveats"))
        rows.append((f"default-{cc}", cc, r["target_price_type"], "ex_factory", DEFAULTS_SINCE, None, None, "medium", datetime.combine(DEFAULTS_SINCE, time()), [], r["legal_basis"], ("ex_factory", "vat_exclusive", "excluded", "derived"), [rule]))
    return spark.createDataFrame(rows, POLICY)


def violations(policies: DataFrame) -> DataFrame:
    """(id, rule) for every constraint that a policy breaks."""
    rule = F.coalesce("derivation_rules", F.array().cast(f"array<{RULE}>"))
    rules = {
        "category disagrees with semantics": ~F.col("comparison_category").eqNullSafe(F.col("semantics.comparison_category")),
        "no source reference": F.coalesce(F.size("source_references"), F.lit(0)) <= 0,
        "not authored": F.col("authored_at").isNull(),
        "rule target is another type": F.exists(rule, lambda r: ~r["target_price_type"].eqNullSafe(F.col("price_type"))),
        "rule target is another category": F.exists(rule, lambda r: ~r["target_category"].eqNullSafe(F.col("comparison_category"))),
        "rule without legal basis": F.exists(rule, lambda r: F.coalesce(F.size(r["legal_basis"]), F.lit(0)) <= 0),
        "ends before it begins": F.col("effective_to") < F.col("effective_from"),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return policies.select("id", F.explode(broken).alias("rule"))
