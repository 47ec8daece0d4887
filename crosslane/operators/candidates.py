"""Pairing the records of countries into comparison candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.forms import compatibility
from ..functions.scalars import stable_id
from ..sources.tables import few_files, written
from .fx import as_of, ratio
from .grid import self_join
from .policy import policy_gate, small, valid_policy
from .quality import data_gate

#: What a side must have; the join keys of a pair besides the molecule are hard exclusions.
HARD = ["comparison_category", "form_class", "route", "strength_unit", "strength_value"]
#: What pairs, candidates, evidence and reviews read of a record.
PAIRED = {
    *HARD, "id", "raw_record_id", "country_code", "snapshot_date", "product_name", "canonical_inn", "atc_code", "price_type", "price_amount", "price_currency", "pack_units", "unit_price", "strength_price",
    "attributes", "form_confidence", "vat_position", "lane_caveats", "policy_id", "profile_id", "source_document_id", "figures", "chain_a", "chain_b",
}
CONFIDENCE = ("low", "medium", "high", "exact")
#: What the judgement of a pair reads of a side besides HARD, the pack and whether there is a price.
JUDGED = ("country_code", "snapshot_date", "price_currency", "atc_code", "attributes", "form_confidence", "vat_position", "lane_caveats")
#: From this price on a class holds any price as one: no rate between two currencies makes it zero.
SURE_PRICE = 1e-4


def lanes_with_skips(records: DataFrame, policies: DataFrame, profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lanes that pass both gates, skipped lanes with the reason), one row for each (country, snapshot, price type)."""
    keys = ["country_code", "snapshot_date", "price_type"]
    asked = valid_policy(records.groupBy(*keys).agg(F.count("*").alias("n_records")), policies)
    prof = profiles.select("country_code", "snapshot_date", "population_rate", "assessment").dropDuplicates(["country_code", "snapshot_date"])
    j = asked.join(prof, ["country_code", "snapshot_date"], "left").withColumn("_d", data_gate()).withColumn("_p", policy_gate())
    j = j.withColumn("reason", F.coalesce("_d.reason", "_p.reason")).withColumn("comparison_category", F.col("policy.comparison_category"))
    cols = [*keys, "n_records", "comparison_category"]
    return j.where("reason is null").select(*cols), j.where("reason is not null").select(*cols, "reason")


def first_lane_gate(records: DataFrame, policies: DataFrame, profiles: DataFrame, order: str = "id") -> DataFrame:
    """(country_code, snapshot_date, price_type, reason): the price type of each snapshot's first row, and why it is blocked."""
    keys = ["country_code", "snapshot_date"]
    first = records.groupBy(*keys).agg(F.min_by("price_type", order).alias("price_type"))
    j = valid_policy(first, policies).join(profiles.select(*keys, "population_rate", "assessment").dropDuplicates(keys), keys, "left")
    reason = F.coalesce(F.concat(F.lit("policy: "), policy_gate()["reason"]), F.concat(F.lit("data: "), data_gate()["reason"]))
    return j.select(*keys, "price_type", reason.alias("reason"))


def lane_pairs(lanes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs of lanes of two countries with one category, lanes without any partner)."""
    a = lanes.select(*[F.col(c).alias(f"{c}_a") for c in ("country_code", "price_type")], "comparison_category").distinct()
    b = lanes.select(*[F.col(c).alias(f"{c}_b") for c in ("country_code", "price_type")], "comparison_category").distinct()
    pairs = a.join(b, "comparison_category").where("country_code_a < country_code_b")
    ends = pairs.select(F.col("country_code_a").alias("country_code"), "comparison_category").unionByName(pairs.select(F.col("country_code_b").alias("country_code"), "comparison_category")).distinct()
    return pairs, lanes.join(ends, ["country_code", "comparison_category"], "left_anti")


def pairs(records: DataFrame, same_quarter: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of records of two countries (a's code is the smaller) that agree on HARD and on the molecule, or on a 7-character code; and on ``also``.

    Two equi-joins instead of one with OR: the second leaves out what the first has, so nothing needs a distinct. A molecule
    or code of very many records is dealt to a grid of tasks (``grid.self_join``), so pass a written table: it is read several times.
    Only records whose code goes with two molecules, or with one and none, are joined by it.
    """
    r = records.withColumn("atc7", F.when(F.length("atc_code") == 7, F.upper("atc_code")))
    hard = [*HARD, *also, *(["quarter"] if same_quarter else [])]
    if same_quarter:
        r = r.withColumn("quarter", F.date_trunc("quarter", "snapshot_date"))
    ordered = F.col("country_code_a") < F.col("country_code_b")
    named = self_join(r, [*hard, "canonical_inn"]).where(ordered)
    named = named.withColumns({"canonical_inn_a": F.col("canonical_inn"), "canonical_inn_b": F.col("canonical_inn"), "method": F.lit("molecule")}).drop("canonical_inn")
    many = _named_apart(r, [*hard, "atc7"])
    if many.isEmpty():
        return named
    coded = self_join(r.join(many, [*hard, "atc7"], "left_semi"), [*hard, "atc7"]).where(ordered & ~F.col("canonical_inn_a").eqNullSafe(F.col("canonical_inn_b")))
    coded = coded.withColumns({"atc7_a": F.col("atc7"), "atc7_b": F.col("atc7"), "method": F.lit("code")}).drop("atc7")
    return named.unionByName(coded)


def _named_apart(r: DataFrame, keys: list[str]) -> DataFrame:
    """The keys whose rows haven't all the same molecule (none is one as well); written."""
    inn = F.col("canonical_inn")
    told = r.na.drop(subset=keys).groupBy(*keys).agg(F.min(inn).alias("_least"), F.max(inn).alias("_most"), F.count(inn).alias("_known"), F.count("*").alias("_n"))
    return written(told.where("_least < _most or (_known > 0 and _known < _n)").select(*keys), "codes")


def _capped(base: Column, *caps: Column) -> Column:
    order = F.array(*[F.lit(c) for c in CONFIDENCE])
    least = F.least(F.array_position(order, base), *[F.when(c.isNotNull(), F.array_position(order, c)) for c in caps])
    return F.element_at(order, least.cast("int"))


def assess(p: DataFrame) -> DataFrame:
    """Add identity_confidence and identity_reason: equal packs are exact, other packs high, an unreadable one low; caps for
    differing attributes or weaker form mappings (high) and for no code on either side (medium)."""
    side = lambda x: {"form_class": F.col("form_class"), "route": F.col("route"), "attributes": F.col(f"attributes_{x}"), "confidence": F.col(f"form_confidence_{x}")}
    p = p.withColumn("_fit", compatibility(side("a"), side("b")))
    no_code = F.col("atc_code_a").isNull() & F.col("atc_code_b").isNull()
    unread = F.col("pack_units_a").isNull() | F.col("pack_units_b").isNull()
    other_pack = F.col("pack_units_a") != F.col("pack_units_b")
    base = F.when(unread, "low").when(other_pack, "high").otherwise("exact")
    cap = _capped(base, F.col("_fit.cap"), F.when(no_code, F.lit("medium")))
    reasons = F.concat(F.array_compact(F.array(F.when(unread, "unread pack"), F.when(~unread & other_pack, "other pack: priced per unit"))), F.col("_fit.notes"))
    return p.withColumn("identity_confidence", cap).withColumn("identity_reason", F.array_join(reasons, "; ")).drop("_fit")


def priced(p: DataFrame, rates: DataFrame) -> DataFrame:
    """Add price_ratio: a's price per strength unit over b's in a's currency, at the later snapshot's date."""
    p = p.withColumn("fx_date", F.greatest("snapshot_date_a", "snapshot_date_b"))
    p = as_of(as_of(p, rates, "price_currency_a", "fx_date", "_ra"), rates, "price_currency_b", "fx_date", "_rb")
    r = ratio(F.col("strength_price_a"), F.col("strength_price_b"), F.col("price_currency_a"), F.col("price_currency_b"), F.col("_ra"), F.col("_rb"))
    return p.withColumn("price_ratio", r).withColumn("fx_used", F.col("price_currency_a") != F.col("price_currency_b")).drop("_ra", "_rb")


def candidates(records: DataFrame, rates: DataFrame, same_quarter: bool = False) -> DataFrame:
    """Candidates with id, confidence, ratio and caveats in order: identity, VAT, lane rules, exchange rate. Swapping sides can't change an id."""
    used = [c for c in records.columns if c in PAIRED]  # nothing else is shuffled
    c = described(pairs(records.select(*used), same_quarter), rates)
    return c.withColumn("id", stable_id(F.lit("candidate"), F.col("id_a"), F.col("id_b")))


def described(p: DataFrame, rates: DataFrame) -> DataFrame:
    """Pairs, or counted pairs, with confidence, ratio and caveats."""
    p = priced(assess(p), rates)
    own = lambda s: F.coalesce(F.col(f"lane_caveats_{s}"), F.array()) if f"lane_caveats_{s}" in p.columns else F.array().cast("array<string>")
    caveats = F.concat(
        F.array(F.nullif(F.col("identity_reason"), F.lit("")), F.when(~F.col("vat_position_a").eqNullSafe(F.col("vat_position_b")), "VAT positions differ")), own("a"), own("b"),
        F.array(F.when(F.col("fx_used"), "converted at the later snapshot's rate")),
    )
    return p.withColumn("caveats", F.array_compact(caveats))


def classes(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The classes of records whose pairs are judged alike, with pack_units and n, their number of records; written.

    A class is what HARD, the molecule, JUDGED and ``keep`` say, and the pack. Of its prices a class tells only whether there is one
    (strength_price: null, 1, or the price itself where a rate might make it zero)."""
    used = [c for c in dict.fromkeys([*HARD, "canonical_inn", *JUDGED, *keep, "pack_units"]) if c in records.columns]
    some = F.when(F.col("strength_price") >= SURE_PRICE, F.lit(1.0)).otherwise(F.col("strength_price").cast("double"))
    # A class is wide and few rows of a task share one, so the rows are written first: there a column of few values takes bits, and a task reads many.
    r = few_files(records.select(*used, some.alias("strength_price")), "judged")
    return written(r.groupBy(*r.columns).agg(F.count("*").alias("n")).withColumn("id", F.xxhash64(*r.columns)), "classes")


def counted_pairs(records: DataFrame, keep: tuple[str, ...] = (), same_quarter: bool = False, added: bool = True) -> DataFrame:
    """Pairs as counts: a row for each set of values of JUDGED and ``keep`` on both sides, with n, how many pairs of records have them.

    Records are put into ``classes``, so nothing grows with the number of pairs. Whether packs are equal takes two joins: all pairs of
    classes without their packs, and those of one pack; other packs are the difference. pack_units is 1 and 1, 1 and 2, or null, and
    strength_price that of a class, so ``described`` and the review read these rows like pairs. Forms and routes, which both sides share, and
    codes are only given or not (unless ``keep`` has them). id tells the rows apart. Where they aren't ``added`` up, a set has several rows without an
    id, and those of one pack are taken off by a negative n: for sums by less (``summed``), before which these rows needn't be shuffled."""
    fine = classes(records, keep)
    rest = [c for c in fine.columns if c not in ("id", "n", "pack_units")]
    read = F.col("pack_units").isNotNull()
    coarse = written(fine.groupBy(*rest, read.alias("_read")).agg(F.sum("n").alias("n"), F.min("id").alias("id")), "classes")
    both = F.col("n_a").cast("decimal(38,0)") * F.col("n_b")
    one, two = F.lit(1), F.lit(2)
    met = pairs(coarse, same_quarter)
    met = met.withColumns({"pack_units_a": F.when(F.col("_read_a"), one), "pack_units_b": F.when(F.col("_read_b"), F.when(F.col("_read_a"), two).otherwise(one)), "_n": both})
    same = pairs(fine.where(read).withColumn("_pack", F.col("pack_units")), same_quarter, ("_pack",))
    # Each pair of one pack counts there, and no longer among those of other packs.
    same = same.withColumn("_n", both).select("*", F.explode(F.array(F.struct(one.alias("p"), one.alias("s")), F.struct(two.alias("p"), F.lit(-1).alias("s")))).alias("_as"))
    same = same.withColumns({"pack_units_a": one, "pack_units_b": F.col("_as.p"), "_n": F.col("_n") * F.col("_as.s")})
    told = [c for c in dict.fromkeys([*JUDGED, *keep, "strength_price"]) if c in rest]
    out = []
    for p in (met, same):
        given = lambda c: F.when(F.col(c).isNotNull(), F.lit("given"))
        sides = [(given(f"{c}_{s}") if c == "atc_code" and c not in keep else F.col(f"{c}_{s}")).alias(f"{c}_{s}") for s in "ab" for c in told if c not in HARD]
        hard = [(F.col(c) if c in keep else given(c)).alias(c) for c in HARD if c in keep or c in ("form_class", "route")]
        out.append(p.select(*hard, "method", *sides, "pack_units_a", "pack_units_b", "_n"))
    every = out[0].unionByName(out[1])
    if not added:
        return every.withColumnRenamed("_n", "n")
    by = [c for c in every.columns if c != "_n"]
    one_id = stable_id(F.lit("counted"), F.to_json(F.struct(*by)))
    return every.groupBy(*by).agg(F.sum("_n").cast("long").alias("n")).where("n > 0").withColumn("id", one_id)


def summed(c: DataFrame, *by: Column | str) -> DataFrame:
    """How many pairs (n) the rows of ``counted_pairs`` stand for, by less than they tell; sets without any are left out."""
    return c.groupBy(*by).agg(F.sum("n").cast("long").alias("n")).where("n > 0")


def extreme_pairs(records: DataFrame, rates: DataFrame, same_quarter: bool = False) -> DataFrame:
    """Pairs as counts with the ends of their ratios: rows of both sides' country_code and snapshot_date, identity_confidence, n, lowest, highest.

    Records judged alike are one class, as in ``counted_pairs``. A ratio rises with a's price and falls with b's, so the ends of a pair of
    classes are those of its ends of prices. For pairs of other packs a class keeps, beside either end, the next one among its
    other packs: of two classes whose ends have the same pack, one side takes that. A price that a rate might make zero is a class of its own."""
    told = [c for c in JUDGED if c in records.columns and c not in ("vat_position", "lane_caveats")]
    used = [c for c in dict.fromkeys([*HARD, "canonical_inn", *told, "pack_units"]) if c in records.columns]
    own = F.when(F.col("strength_price") >= SURE_PRICE, F.lit(None)).otherwise(F.col("strength_price"))
    r = records.select(*used, "strength_price", own.alias("_own"))
    fine = r.groupBy(*used, "_own").agg(F.count("*").alias("n"), F.min("strength_price").alias("low"), F.max("strength_price").alias("high"), F.xxhash64(*used, "_own").alias("id"))
    fine = written(fine, "classes")
    rest = [c for c in used if c != "pack_units"] + ["_own"]
    read = F.col("pack_units").isNotNull()
    there = lambda c, by: F.when(F.col(c).isNotNull(), F.struct(by, "pack_units"))
    packs = [F.min_by(F.struct("pack_units", "low"), there("low", F.col("low"))).alias("_low"), F.max_by(F.struct("pack_units", "high"), there("high", F.col("high"))).alias("_high")]
    firsts = fine.groupBy(*rest, read.alias("_read")).agg(F.sum("n").alias("n"), F.min("id").alias("id"), *packs)
    # Keys may be null, so they are compared as one value that isn't.
    key = lambda df: df.withColumn("_key", F.to_json(F.struct(*rest, "_read"), {"ignoreNullFields": "false"}))
    other = lambda c, f: f(F.when(F.col("pack_units") != F.col(f"_{c}.pack_units"), F.col(c))).alias(f"_{c}2")
    ends = key(firsts).select("_key", "_low", "_high")
    seconds = key(fine.withColumn("_read", read)).join(ends, "_key").groupBy("_key").agg(other("low", F.min), other("high", F.max))
    coarse = written(key(firsts).join(seconds, "_key").drop("_key"), "classes")
    both = F.col("n_a").cast("decimal(38,0)") * F.col("n_b")
    one, two = F.lit(1), F.lit(2)

    def rated(p: DataFrame, **ends: tuple[Column, Column]) -> DataFrame:
        p = as_of(as_of(p.withColumn("_day", F.greatest("snapshot_date_a", "snapshot_date_b")), rates, "price_currency_a", "_day", "_ra"), rates, "price_currency_b", "_day", "_rb")
        return p.withColumns({name: ratio(x, y, F.col("price_currency_a"), F.col("price_currency_b"), F.col("_ra"), F.col("_rb")) for name, (x, y) in ends.items()})

    def kept(p: DataFrame, lows: list[str], highs: list[str]) -> DataFrame:
        p = p.withColumns({"_lowest": F.least(*[F.col(c) for c in (*lows, lows[0])]), "_highest": F.greatest(*[F.col(c) for c in (*highs, highs[0])])})
        return assess(p).select("country_code_a", "country_code_b", "snapshot_date_a", "snapshot_date_b", "identity_confidence", "_n", "_lowest", "_highest")

    met = pairs(coarse, same_quarter)
    met = met.withColumns({"pack_units_a": F.when(F.col("_read_a"), one), "pack_units_b": F.when(F.col("_read_b"), F.when(F.col("_read_a"), two).otherwise(one)), "_n": both})
    at = lambda c, s: F.col(f"_{c}_{s}.{c}")
    asked = {}
    for name, ca, cb in (("low", "low", "high"), ("high", "high", "low")):
        # Packs that aren't read are never the same.
        clash = F.coalesce(F.col(f"_{ca}_a.pack_units") == F.col(f"_{cb}_b.pack_units"), F.lit(False))
        asked[f"_{name}_0"] = (at(ca, "a"), F.when(clash, F.col(f"_{cb}2_b")).otherwise(at(cb, "b")))
        asked[f"_{name}_1"] = (F.when(clash, F.col(f"_{ca}2_a")).otherwise(at(ca, "a")), at(cb, "b"))
    met = rated(met, **asked)
    same = pairs(fine.where(read).withColumn("_pack", F.col("pack_units")), same_quarter, ("_pack",)).withColumn("_n", both)
    # Each pair of one pack is counted there, and no longer among those of other packs.
    same = rated(same, _l=(F.col("low_a"), F.col("high_b")), _h=(F.col("high_a"), F.col("low_b"))).withColumn("_as", F.explode(F.array(one, two)))
    apart = F.col("_as") == 2
    same = same.withColumns({"pack_units_a": one, "pack_units_b": F.col("_as"), "_n": F.when(apart, -F.col("_n")).otherwise(F.col("_n")), "_l": F.when(~apart, F.col("_l")), "_h": F.when(~apart, F.col("_h"))})
    every = kept(met, ["_low_0", "_low_1"], ["_high_0", "_high_1"]).unionByName(kept(same, ["_l"], ["_h"]))
    by = ["country_code_a", "country_code_b", "snapshot_date_a", "snapshot_date_b", "identity_confidence"]
    return every.groupBy(*by).agg(F.sum("_n").cast("long").alias("n"), F.min("_lowest").alias("lowest"), F.max("_highest").alias("highest")).where("n > 0")


def with_partner(records: DataFrame, same_quarter: bool = False) -> DataFrame:
    """The records that are a side of any pair: their molecule or code is there in another country too."""
    r = records.withColumn("_atc7", F.when(F.length("atc_code") == 7, F.upper("atc_code")))
    hard = HARD
    if same_quarter:
        r, hard = r.withColumn("_quarter", F.date_trunc("quarter", "snapshot_date")), [*HARD, "_quarter"]
    for name, key in (("_named", "canonical_inn"), ("_coded", "_atc7")):
        wide = r.groupBy(*hard, key).agg(F.min("country_code").alias("_least"), F.max("country_code").alias("_most")).where("_least < _most")
        # Written, so that a count shows whether the records need be shuffled for them.
        r = r.join(small(written(wide.select(*hard, key, F.lit(True).alias(name)), "partners")), [*hard, key], "left")
    return r.where("_named or _coded").select(*records.columns)


def number(c: DataFrame):
    """How many candidates the rows of a group stand for: their counts, or one each."""
    return F.sum("n") if "n" in c.columns else F.count("*")


def evidence(c: DataFrame) -> DataFrame:
    """(candidate_id, bundle): both sides and the rate as one nested value."""
    side = lambda s: F.struct(*[F.col(f"{n}_{s}").alias(n) for n in ("id", "country_code", "snapshot_date", "product_name", "price_type", "price_amount", "price_currency", "pack_units", "unit_price", "strength_price")])
    return c.select(F.col("id").alias("candidate_id"), F.struct(side("a").alias("a"), side("b").alias("b"), F.struct("fx_used", "fx_date").alias("fx"), "price_ratio").alias("bundle"))


def derivation_rules(records: DataFrame) -> DataFrame:
    """(id, rule_type, record_id, formula): one audit row for each computed value of the records, each once: prices per unit and
    per strength unit, and where the records have them derived lanes (formula) and prices converted to euro (amount_eur)."""
    made = {"per_unit": F.when(F.col("unit_price").isNotNull(), "price_amount / pack_units"), "per_strength_unit": F.when(F.col("strength_price").isNotNull(), "unit_price / strength_value")}
    if "source_record_id" in records.columns:
        made["price_lane"] = F.when(F.col("source_record_id").isNotNull(), F.coalesce("formula", F.lit("")))
    if "amount_eur" in records.columns:
        rate = F.concat_ws(" ", F.lit("price_amount from"), "price_currency", F.lit("to EUR on"), F.col("fx_date").cast("string"))
        made["currency_conversion"] = F.when(F.col("amount_eur").isNotNull() & (F.col("price_currency") != "EUR"), rate)
    # A record goes through the shuffle once, whatever the number of its rules.
    one = records.groupBy(F.col("id").alias("record_id")).agg(*[F.max(f).alias(k) for k, f in made.items()])
    rules = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.struct(F.lit(k).alias("rule_type"), F.col(k).alias("formula"))) for k in made]))
    e = one.select("record_id", F.explode(rules).alias("r")).select("record_id", "r.*")
    return e.withColumn("id", stable_id(F.col("rule_type"), F.col("record_id")))


def candidate_summary(c: DataFrame, most: int = 20) -> tuple[DataFrame, DataFrame]:
    """(counts by country pair and confidence, the first ``most`` candidates as text)."""
    counts = summary_counts(c)
    line = F.format_string("%s %s/%s %s", "canonical_inn_a", "country_code_a", "country_code_b", F.format_number("price_ratio", 4))
    return counts, c.orderBy("canonical_inn_a", "id").limit(most).select("id", line.alias("line"))


def summary_counts(c: DataFrame) -> DataFrame:
    """Candidates, and those with a ratio, by country pair and confidence."""
    rated = F.sum(F.when(F.col("price_ratio").isNotNull(), F.col("n")).otherwise(F.lit(0))) if "n" in c.columns else F.count("price_ratio")
    return c.groupBy("country_code_a", "country_code_b", "identity_confidence").agg(number(c).alias("n"), rated.alias("n_ratio"))
