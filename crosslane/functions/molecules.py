"""Molecule names: linguistic rewriting, dictionary joins, identity resolution, brand or generic."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import written

# Language of a country; rewriting rules of a language: label, pattern, replacement, ends the rewriting.
LANGUAGES = {"IE": "en", "PL": "pl", "FR": "fr"}
RULES = {
    "pl": (
        ("acidum_X_to_X_acid", r"^acidum\s+(.+?)(?:ic)?um$", "$1ic acid", True),
        ("compound_hydrochloridum", r"^(.+)(?:ini|i|um)\s+hydrochloridum$", "$1 hydrochloride", True),
        ("compound_sodium_salt", r"^natrii\s+(.+?)(?:as)$", "$1ate sodium", True),
        ("as_to_ate", r"^(.+)as$", "$1ate", False),
        ("strip_um_i_suffix", r"^(.+?)(?:um|i)$", "$1", False),
    ),
}
# Makers whose name in a product name marks a generic.
GENERIC_MAKERS = (
    "teva", "mylan", "sandoz", "zentiva", "krka", "accord", "stada", "actavis", "ratiopharm", "aurobindo", "glenmark",
    "egis", "richter", "biotika", "léčiva", "leciva", "medochemie", "pharmavision", "rowex", "clonmel", "rowa",
)
PASSES, MAX_DISTANCE, MIN_LENGTH = 5, 2, 4
#: Words of up to so many characters are indexed by deletions, longer ones by their parts.
SHORT = 24


def rewritten(name: Column, language: Column) -> Column:
    """struct(name, labels): ordered rules, the first that matches in each of five passes; a final rule ends it.

    A language without rules leaves the name as it is; ``labels`` is empty where nothing matched.
    """
    state = lambda n, labels, done: F.struct(n.alias("name"), labels.alias("labels"), done.alias("done"))
    no_labels = F.array().cast("array<string>")
    out = F.when(F.lit(False), state(name, no_labels, F.lit(True)))
    for lang, rules in RULES.items():
        start = state(F.lower(F.trim(name)), no_labels, F.lit(False))

        out = out.when(language == lang, F.aggregate(F.sequence(F.lit(1), F.lit(PASSES)), start, _pass(rules, state)))
    kept = out.otherwise(state(name, no_labels, F.lit(True)))
    return F.struct(kept["name"].alias("name"), kept["labels"].alias("labels"))


def _pass(rules: tuple, state):
    def one(acc: Column, _: Column) -> Column:
        made = acc
        for label, pattern, replacement, final in reversed(rules):
            to = F.lower(F.trim(F.regexp_replace(acc["name"], pattern, replacement)))
            made = F.when(acc["name"].rlike(pattern), state(to, F.concat(acc["labels"], F.array(F.lit(label))), F.lit(final))).otherwise(made)
        return F.when(acc["done"], acc).otherwise(made)

    return one


def language_of(country: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for p in LANGUAGES.items() for x in p]), F.upper(country))


def dictionary(atc: DataFrame) -> DataFrame:
    """(name, codes): level-5 codes of each lower-cased name, sorted. ``atc`` has atc_code and atc_name."""
    clean = atc.where(F.length("atc_code") == 7).select(F.lower(F.trim("atc_name")).alias("name"), F.upper("atc_code").alias("code"))
    return clean.groupBy("name").agg(F.sort_array(F.collect_set("code")).alias("codes"))


def by_code(words: DataFrame) -> DataFrame:
    """(code, name) of the codes that belong to one name only."""
    return words.select(F.explode("codes").alias("code"), "name").groupBy("code").agg(F.min("name").alias("name"), F.count("*").alias("n")).where("n = 1").drop("n")


def deletions(name: Column) -> Column:
    """Distinct hashes of what is left of ``name`` without up to two of its characters; the first one always stays."""
    # Two marks at the end may go as well, so that exactly two characters go in every case.
    padded, n = F.concat(name, F.lit("\0\0")), F.length(name)

    def left(i: Column, j: Column) -> Column:
        return F.xxhash64(F.replace(F.concat(F.substr(padded, F.lit(1), i - 1), F.substr(padded, i + 1, j - i - 1), F.substr(padded, j + 1)), F.lit("\0"), F.lit("")))

    each = F.transform(F.sequence(F.lit(2), n + 1), lambda i: F.transform(F.sequence(i + 1, n + 2), lambda j: left(i, j)))
    return F.array_distinct(F.flatten(each))


def _segment(length: Column, k: int) -> tuple[Column, Column]:
    """Place (from 1) and length of the k-th of MAX_DISTANCE + 1 parts of a text of ``length`` characters."""
    parts = MAX_DISTANCE + 1
    begin, end = F.floor(length * k / parts), F.floor(length * (k + 1) / parts)
    return (begin + 1).cast("int"), (end - begin).cast("int")


def near_pairs(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, word, distance) of distinct names and words that begin with the same character, within distance 2.

    Two texts within two edits share what is left of them without up to two characters, so names meet words of up to SHORT characters by
    hashes of these (some 80 for 12 characters). A longer word is cut in three parts, one of which two edits leave whole and shift by two places at most;
    names meet it by (length, part, text). Either way the distance itself is computed for pairs that have met, each once.
    """
    a = names.select("name").where(F.length("name") > 0).distinct()
    b = words.select(F.col("name").alias("word")).where(F.length("name") > 0).distinct()
    short = a.where(F.length("name") <= SHORT + MAX_DISTANCE).select("name", F.explode(deletions(F.col("name"))).alias("_key"))
    met = short.join(b.where(F.length("word") <= SHORT).select("word", F.explode(deletions(F.col("word"))).alias("_key")), "_key").select("name", "word")
    segment = lambda text, length, k, shift: F.xxhash64(F.lit(k), length, F.substr(text, _segment(length, k)[0] + shift, _segment(length, k)[1]))
    n, ks, shifts = F.length("name"), range(MAX_DISTANCE + 1), range(-MAX_DISTANCE, MAX_DISTANCE + 1)
    asked = a.where(n > SHORT - MAX_DISTANCE).select("name", F.explode(F.array_distinct(F.array(*[segment(F.col("name"), n + more, k, s) for more in shifts for k in ks for s in shifts]))).alias("_key"))
    parts = b.where(F.length("word") > SHORT).select("word", F.explode(F.array(*[segment(F.col("word"), F.length("word"), k, 0) for k in ks])).alias("_key"))
    both = met.unionByName(asked.join(parts, "_key").select("name", "word")).where(F.substring("name", 1, 1) == F.substring("word", 1, 1)).distinct()
    return both.withColumn("distance", F.levenshtein("name", "word", MAX_DISTANCE)).where(F.col("distance").between(0, MAX_DISTANCE))


def fuzzy(names: DataFrame, words: DataFrame, ratio: float, col: str = "name") -> DataFrame:
    """(name, match, ambiguous): the one dictionary name nearest to each distinct name, within distance 2.

    Both names begin with the same character and neither is shorter than ``ratio`` of the other; names under four
    characters aren't tried. Without a single nearest one the match is null and ambiguous holds all of the nearest.
    """
    pairs = near_pairs(names.select(F.col(col).alias("name")).where(F.length(col) >= MIN_LENGTH), words)
    near = pairs.where((F.length("name") >= ratio * F.length("word")) & (F.length("word") >= ratio * F.length("name")))
    # The words at each distance, at most three rows a name: the nearest are those of its least distance.
    least = near.groupBy("name", "distance").agg(F.sort_array(F.collect_set("word")).alias("words"))
    best = least.groupBy("name").agg(F.min_by("words", "distance").alias("words"))
    return best.select("name", F.when(F.size("words") == 1, F.col("words")[0]).alias("match"), F.when(F.size("words") > 1, F.col("words")).alias("ambiguous"))


def normalise_names(names: DataFrame, words: DataFrame, name_col: str = "inn", country_col: str = "country_code") -> DataFrame:
    """(country, inn, canonical, atc, method, label) for each distinct (country, name): rewriting, exact lookup,
    base of a compound, near match, else the rewritten name; an ambiguous near match gives no canonical name."""
    from pyspark.sql.functions import broadcast  # the dictionary is a parameter-sized dimension when counted so

    small = broadcast if words.count() <= 200_000 else (lambda d: d)
    d = names.select(F.col(country_col).alias("country"), F.col(name_col).alias("inn")).where(F.trim("inn") != "").distinct()
    d = d.withColumn("_r", rewritten(F.col("inn"), language_of(F.col("country")))).select("country", "inn", F.lower(F.trim("_r.name")).alias("name"), F.col("_r.labels").alias("labels"))
    exact = small(words.select("name", F.col("codes")[0].alias("exact_atc")))
    d = d.join(exact, "name", "left").withColumn("_at", F.locate(" ", F.col("name")))
    d = d.withColumn("base", F.when(F.col("_at") > 0, F.expr("substr(name, 1, _at - 1)"))).withColumn("salt", F.when(F.col("_at") > 0, F.expr("substr(name, _at + 1)")))
    base_exact = small(words.select(F.col("name").alias("base"), F.col("codes")[0].alias("base_atc")))
    open_names = d.where("exact_atc is null")
    base_near = fuzzy(open_names.where("base is not null"), words, 0.65, "base").select(F.col("name").alias("base"), F.col("match").alias("base_match")).where("base_match is not null")
    base_near = base_near.join(small(words.select(F.col("name").alias("base_match"), F.col("codes")[0].alias("near_base_atc"))), "base_match")
    near = fuzzy(open_names, words, 0.80)
    near = near.join(small(words.select(F.col("name").alias("match"), F.col("codes")[0].alias("near_atc"))), "match", "left")
    j = d.join(base_exact, "base", "left").join(base_near, "base", "left").join(near, "name", "left")
    label = F.nullif(F.array_join("labels", " + "), F.lit(""))
    made = lambda n, atc, m: F.struct(n.cast("string").alias("canonical"), atc.cast("string").alias("atc"), F.lit(m).alias("method"))
    none = F.lit(None)
    pick = (
        F.when(F.col("exact_atc").isNotNull(), made(F.col("name"), F.col("exact_atc"), "exact"))
        .when(F.col("base_atc").isNotNull(), made(F.col("name"), F.col("base_atc"), "compound_exact"))
        .when(F.col("base_match").isNotNull(), made(F.concat_ws(" ", "base_match", "salt"), F.col("near_base_atc"), "compound_fuzzy"))
        .when(F.col("match").isNotNull(), made(F.col("match"), F.col("near_atc"), "fuzzy"))
        .when(F.col("ambiguous").isNotNull(), made(none, none, "ambiguous"))
        .otherwise(made(F.col("name"), none, "passthrough"))
    )
    return j.select("country", "inn", pick.alias("_p"), label.alias("label")).select("country", "inn", "_p.canonical", "_p.atc", "_p.method", "label")


def leading_token(name: Column) -> Column:
    """The first word without marks around it, if it has four characters and a letter."""
    token = F.regexp_replace(F.split(F.trim(name), r"\s+")[0], r"^[ ,;:()\[\]{}*]+|[ ,;:()\[\]{}*]+$", "")
    return F.when((F.length(token) >= MIN_LENGTH) & token.rlike(r"\p{L}"), token)


def resolve_identity(records: DataFrame, words: DataFrame, labels: tuple[str, ...] = ()) -> DataFrame:
    """Add canonical_inn, resolved_atc and identity_method: a unique code, the stated name, ingredient labels in order,
    then the first word of the product name where the dictionary knows it."""
    codes = by_code(words)
    tries = [F.col("inn"), *[F.col(c) for c in labels], leading_token(F.col("product_name"))]
    all_names = records.select("country_code", F.explode(F.array(*[t.cast("string") for t in tries])).alias("inn")).where("inn is not null and trim(inn) <> ''")
    # Distinct names and what they resolve to are written once, so that neither the records' plan nor the joins of names run again.
    known = written(normalise_names(written(all_names.distinct(), "names"), words), "known")
    out = records.withColumn("_code", F.upper(F.trim("atc_code"))).join(codes.select(F.col("code").alias("_code"), F.col("name").alias("_by_code")), "_code", "left")
    picks = [F.when(F.col("_by_code").isNotNull(), F.struct(F.col("_by_code").alias("n"), F.col("_code").alias("a"), F.lit("atc_exact").alias("m")))]
    for k, t in enumerate(tries):
        last = k == len(tries) - 1
        out = out.withColumn(f"_t{k}", t.cast("string"))
        side = known.select(F.col("country").alias("country_code"), F.col("inn").alias(f"_t{k}"), F.struct("canonical", "atc").alias(f"_k{k}"))
        out = out.join(side, ["country_code", f"_t{k}"], "left")
        method = "product_name_prefix" if last else "explicit_inn" if k == 0 else "active_ingredient_label"
        canonical, atc = F.col(f"_k{k}.canonical"), F.col(f"_k{k}.atc")
        if last:
            picks.append(F.when(canonical.isNotNull() & atc.isNotNull(), F.struct(canonical.alias("n"), atc.alias("a"), F.lit(method).alias("m"))))
        else:
            named = F.trim(f"_t{k}") != ""
            picks.append(F.when(named, F.struct(F.coalesce(canonical, F.lower(F.trim(f"_t{k}"))).alias("n"), atc.alias("a"), F.lit(method).alias("m"))))
    none = F.struct(F.lit(None).cast("string").alias("n"), F.nullif(F.col("_code"), F.lit("")).alias("a"), F.lit("none").alias("m"))
    return out.withColumn("_i", F.coalesce(*picks, none)).select(*[F.col(f"`{c}`") for c in records.columns], F.col("_i.n").alias("canonical_inn"), F.col("_i.a").alias("resolved_atc"), F.col("_i.m").alias("identity_method"))


def product_type(name: Column, inn: Column) -> Column:
    """struct(type, confidence, reason): brand or generic by a cascade over product and molecule names."""
    low = F.lower(F.regexp_replace(F.trim(name), r"\s+", " "))
    ref = F.lower(F.trim(inn))
    stem = F.split(ref, " ")[0]
    first = F.regexp_replace(F.split(low, " ")[0], "-+$", "")
    near = F.least(F.length(first), F.length(stem))
    makers = F.lit("|".join(re.escape(m) for m in GENERIC_MAKERS))
    made = lambda t, c, r: F.struct(F.lit(t).alias("type"), F.lit(c).alias("confidence"), F.lit(r).alias("reason"))
    return (
        F.when(F.coalesce(low, F.lit("")) == "", made("brand", 0.3, "no name"))
        .when(F.coalesce(ref, F.lit("")) == "", made("brand", 0.3, "no molecule to compare with"))
        .when(low.contains(" ") & F.regexp_like(low, makers), made("generic", 0.85, "known generic maker in the name"))
        .when(F.startswith(low, ref), made("generic", 0.95, "name starts with the molecule"))
        .when((F.length(stem) >= 5) & F.startswith(low, stem), made("generic", 0.90, "name starts with the molecule's stem"))
        .when((F.length(stem) >= 6) & F.contains(low, stem), made("generic", 0.70, "the molecule's stem is in the name"))
        .when((F.length(stem) >= 6) & (F.length(first) >= 5) & (near >= 6) & (F.left(first, near - 1) == F.left(stem, near - 1)), made("generic", 0.80, "name nearly matches the molecule"))
        .otherwise(made("brand", 0.80, "name doesn't match the molecule"))
    )


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row by ``order`` for each key, ignoring case."""
    w = Window.partitionBy(*[F.lower(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys]).orderBy(order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
