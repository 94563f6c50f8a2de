"""Laboratory tests to one clean phenotype per sample and drug."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainwise import rules
from strainwise.functions.intervals import lower_bound, upper_bound
from strainwise.functions.text import first_match, priority
from strainwise.operators.relational import best_ranked, previous_value


def _or_zero(name: str) -> Column:
    """NULL equals NULL, and also equals 0, in the lookups below."""
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


# ------------------------------------------------------------------ critical concentrations
def who_cutoffs(category: DataFrame) -> DataFrame:
    """Per (drug, method, medium) the current critical concentrations, or the past ones where none is current."""
    known = category.where(F.col("category").isin("WHO_current", "WHO_past"))
    return best_ranked(
        known, ["drug_id", "method_id", "medium_id"], priority(F.col("category"), ["WHO_current", "WHO_past"])
    )


def agar_cutoffs(category: DataFrame, medium: DataFrame, method: DataFrame) -> DataFrame:
    """Lowest and highest cut-off of each drug over the two agar media, attached to the undetermined agar medium."""
    solid = medium.where(F.col("medium_name").isin("Middlebrook7H10", "Middlebrook7H11")).select("medium_id")
    bounds = (
        who_cutoffs(category)
        .join(solid, "medium_id", "left_semi")
        .join(method.select("method_id", "method_name"), "method_id", "left")
        .where(F.col("method_name").isNull() | (F.col("method_name") == "Proportions"))
        .groupBy("drug_id")
        .agg(F.min("concentration").alias("min_concentration"), F.max("concentration").alias("max_concentration"))
    )
    agar = medium.where(F.col("medium_name") == "Agar").select("medium_id").scalar()
    return bounds.withColumn("medium_id", agar).where("medium_id IS NOT NULL")


def _method_class() -> Column:
    """No method and Proportions stand for each other; every other method stands for itself."""
    unnamed = F.col("method_name").isNull() | (F.col("method_name") == "Proportions")
    return F.when(unnamed, F.lit(0)).otherwise(F.col("method_id")).alias("method_class")


def concentration_limits(category: DataFrame, medium: DataFrame, method: DataFrame) -> DataFrame:
    """One row per (drug, medium, method class): an S below ``s_below`` and an R above ``r_above`` are conclusive.

    Collapsing the cut-offs to one row per key turns the inequality joins into a
    single equi join.
    """
    own = who_cutoffs(category).join(method.select("method_id", "method_name"), "method_id", "left").select(
        "drug_id", _or_zero("medium_id"), _method_class(),
        F.col("concentration").alias("low"), F.col("concentration").alias("high"),
    )
    # On agar an S must lie below every cut-off and an R above every cut-off.
    agar = agar_cutoffs(category, medium, method).select(
        "drug_id", "medium_id", F.lit(0).alias("method_class"),
        F.col("max_concentration").alias("low"), F.col("min_concentration").alias("high"),
    )
    return (
        own.unionByName(agar)
        .groupBy("drug_id", "medium_id", "method_class")
        .agg(F.max("high").alias("s_below"), F.min("low").alias("r_above"))
    )


def categorise_tests(
    phenotype: DataFrame, category: DataFrame, drug: DataFrame, medium: DataFrame, method: DataFrame
) -> DataFrame:
    """Give each drug-susceptibility test its category.

    Moxifloxacin on MGIT between the old and the new cut-off comes first, then a
    listed category that is current, past or excluded, then the conclusive side of
    a cut-off (``non_WHO_CC_S`` / ``non_WHO_CC_R``), then any other listed category.
    """
    key = ["drug_id", "medium_id", "method_id", "concentration"]
    listed = category.select(
        *[(F.col(c) if c == "drug_id" else F.coalesce(F.col(c), F.lit(0))).alias(f"_c_{c}") for c in key],
        F.col("category").alias("_listed"),
    )
    limits = concentration_limits(category, medium, method).withColumnsRenamed(
        {c: f"_l_{c}" for c in ("drug_id", "medium_id", "method_class")}
    )
    tests = (
        phenotype.join(drug.select("drug_id", "drug_name"), "drug_id")
        .join(medium.select("medium_id", F.col("medium_name").alias("_medium")), "medium_id", "left")
        .join(method.select("method_id", "method_name"), "method_id", "left")
        .select(*phenotype.columns, "drug_name", "_medium", _method_class())
    )
    conclusive = first_match(
        [
            ((F.col("test_result") == "S") & (F.col("concentration") < F.col("s_below")), F.lit("non_WHO_CC_S")),
            ((F.col("test_result") == "R") & (F.col("concentration") > F.col("r_above")), F.lit("non_WHO_CC_R")),
        ]
    )
    between = (
        (F.col("drug_name") == "Moxifloxacin") & (F.col("_medium") == "MGIT") & F.col("concentration").isin(0.5, 1.0)
    )
    final = first_match(
        [
            (between, F.lit("non_WHO_CC_SR")),
            (F.col("_listed").isin("WHO_past", "WHO_current", "to_be_excluded"), F.col("_listed")),
        ],
        F.coalesce(conclusive, F.col("_listed")),
    )
    same_listing = F.col("drug_id") == F.col("_c_drug_id")
    for c in key[1:]:
        same_listing = same_listing & (F.coalesce(F.col(c), F.lit(0)) == F.col(f"_c_{c}"))
    same_limits = (
        (F.col("drug_id") == F.col("_l_drug_id"))
        & (F.coalesce("medium_id", F.lit(0)) == F.col("_l_medium_id"))
        & (F.col("method_class") == F.col("_l_method_class"))
    )
    return (
        tests.join(listed, same_listing, "left")
        .join(limits, same_limits, "left")
        .withColumn("phenotypic_category", final)
        .select(*phenotype.columns, "phenotypic_category")
    )


# ------------------------------------------------------------------ pooling and consensus
def pool_drugs(df: DataFrame, drug: DataFrame, pairs: list[tuple[str, str]] = rules.POOLED_DRUGS) -> DataFrame:
    """Move tests of a drug to the drug it is pooled with."""
    names = rules.rule_frame(drug.sparkSession, pairs, "drug_name string, _pooled_name string")
    targets = drug.select(F.col("drug_name").alias("_pooled_name"), F.col("drug_id").alias("_target"))
    moves = (
        drug.select("drug_id", "drug_name")
        .join(names, "drug_name", "left")
        .join(targets, "_pooled_name", "left")
        .select("drug_id", F.coalesce("_target", "drug_id").alias("_pooled"))
    )
    pooled = df.join(moves, "drug_id").withColumn("drug_id", F.col("_pooled"))
    return pooled.select(*df.columns)


def agreed_result(df: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose results are all R or all S.  Flags combine map-side; no result set is collected."""
    result = F.col("test_result")
    return (
        df.groupBy(*keys)
        .agg(
            F.coalesce(F.bool_or(result == "R"), F.lit(False)).alias("_r"),
            F.coalesce(F.bool_or(result == "S"), F.lit(False)).alias("_s"),
            F.coalesce(F.bool_or(~result.isin("R", "S", "")), F.lit(False)).alias("_other"),
        )
        .where((F.col("_r") != F.col("_s")) & ~F.col("_other"))
        .withColumn("test_result", F.when(F.col("_r"), F.lit("R")).otherwise(F.lit("S")))
        .drop("_r", "_s", "_other")
    )


def _usable(df: DataFrame) -> DataFrame:
    return df.where(~F.col("phenotypic_category").isin(rules.UNUSABLE_CATEGORIES))


def consensus_by_medium(df: DataFrame, medium: DataFrame, order: list[str] = rules.MEDIUM_ORDER) -> DataFrame:
    """Agreed result per (sample, drug, category) on the best medium that has one."""
    keys = ["sample_id", "drug_id", "phenotypic_category"]
    named = _usable(df).join(medium.select("medium_id", "medium_name"), "medium_id", "left")
    agreed = agreed_result(named, [*keys, "medium_name"])
    rank = priority(F.col("medium_name"), order, len(order) + 1)
    return best_ranked(agreed, keys, rank).select(*keys, "test_result")


def consensus_by_category(df: DataFrame, order: list[str] = rules.CATEGORY_ORDER) -> DataFrame:
    """Agreed result per (sample, drug) in the best category that has one."""
    agreed = agreed_result(_usable(df), ["sample_id", "drug_id", "phenotypic_category"])
    return best_ranked(agreed, ["sample_id", "drug_id"], priority(F.col("phenotypic_category"), order)).select(
        "sample_id", "drug_id", "phenotypic_category", F.col("test_result").alias("phenotype")
    )


# ------------------------------------------------------------------ minimum inhibitory concentrations
def normalise_plate_names(mic: DataFrame, labels: list[tuple[str, str]] = rules.PLATE_LABELS) -> DataFrame:
    plate = F.replace("plate", F.lit("Middlebrook"), F.lit(""))
    return mic.withColumn("plate", first_match([(plate == old, F.lit(new)) for old, new in labels], plate))


def cutoff_pairs(cutoff: DataFrame, plate_concentration: DataFrame) -> DataFrame:
    """(drug_id, medium_name, value, lowered): every cut-off, and one tested concentration down (half of it where the plate did not test it)."""
    steps = previous_value(
        plate_concentration.where(F.col("plate").isin(rules.MICRODILUTION_PLATES)),
        ["plate", "drug_id"],
        "concentration",
        "lower",
    ).select(F.col("plate").alias("medium_name"), "drug_id", F.col("concentration").alias("value"), "lower")
    return (
        cutoff.where(F.col("medium_name").isin(rules.CUTOFF_MEDIA))
        .join(steps, ["medium_name", "drug_id", "value"], "left")
        .select("drug_id", "medium_name", "value", F.coalesce(F.col("lower"), F.col("value") / 2).alias("lowered"))
    )


def atu_cutoffs(cutoff: DataFrame, plate_concentration: DataFrame) -> DataFrame:
    """Cut-offs moved one tested concentration down."""
    return cutoff_pairs(cutoff, plate_concentration).select("drug_id", "medium_name", F.col("lowered").alias("value"))


def _possible_mics(mic: DataFrame, drug: DataFrame) -> DataFrame:
    name, plate = F.col("drug_name"), F.col("plate")
    refused = (plate == "MYCOTB") & name.isin(rules.NOT_ON_MYCOTB)
    for bad_plate, bad_drug, bad_value in rules.IMPOSSIBLE_MIC:
        refused = refused | ((plate == bad_plate) & (name == bad_drug) & (F.col("mic_value") == bad_value))
    return mic.join(drug.select("drug_id", "drug_name"), "drug_id").where(~refused)


def _mic_result(limit: str) -> Column:
    return first_match(
        [
            (upper_bound(F.col("mic_value")) <= F.col(limit), F.lit("S")),
            (lower_bound(F.col("mic_value")) >= F.col(limit), F.lit("R")),
        ]
    )


def _mic_category() -> Column:
    plate = F.col("plate")
    return first_match(
        [
            (plate == "MYCOTB", F.lit("MYCOTB_MIC")),
            (plate.isin(rules.PLATES_FOR_ALL_DRUGS), F.lit("CRyPTIC_MIC")),
            (F.col("test_result").isNotNull(), F.concat(F.lit("non_WHO_CC_"), F.col("test_result"))),
        ],
        F.lit("to_be_excluded"),
    )


def binarise_mic(
    mic: DataFrame, cutoff: DataFrame, plate_concentration: DataFrame, drug: DataFrame, atu: bool = False
) -> DataFrame:
    """R / S of each MIC interval against its cut-off; NULL when the interval straddles it."""
    limits = atu_cutoffs(cutoff, plate_concentration) if atu else cutoff
    limits = limits.where(F.col("medium_name").isin(rules.CUTOFF_MEDIA)).select(
        "drug_id", F.col("medium_name").alias("plate"), F.col("value").alias("_cutoff")
    )
    return (
        _possible_mics(mic, drug)
        .join(limits, ["drug_id", "plate"], "left")
        .withColumn("test_result", _mic_result("_cutoff"))
        .select(
            F.col("id").alias("mictest_id"),
            "sample_id",
            "drug_id",
            "plate",
            "mic_value",
            "test_result",
            _mic_category().alias("phenotypic_category"),
        )
    )


def filter_plate_drug_rules(
    mic: DataFrame, drug: DataFrame, pairs: list[tuple[str, str]] = rules.PLATE_DRUGS
) -> DataFrame:
    """Keep MICs on plates that are accepted for their drug."""
    allowed = rules.rule_frame(drug.sparkSession, pairs, "_plate string, drug_name string")
    allowed = allowed.join(drug.select(F.col("drug_id").alias("_drug"), "drug_name"), "drug_name")
    accepted = F.col("plate").isin(rules.PLATES_FOR_ALL_DRUGS) | F.col("_drug").isNotNull()
    return (
        mic.join(drug.select("drug_id"), "drug_id", "left_semi")
        .join(allowed, (F.col("plate") == F.col("_plate")) & (F.col("drug_id") == F.col("_drug")), "left")
        .where(accepted)
        .select(*mic.columns)
    )


def reciprocal_semi(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of each side whose (sample, drug) the other side has too."""
    keys = ["sample_id", "drug_id"]
    return (
        first.join(second.select(*keys), keys, "left_semi"),
        second.join(first.select(*keys), keys, "left_semi"),
    )


def relabel_categories(df: DataFrame, prefix: str | Column) -> DataFrame:
    plates = F.col("phenotypic_category").isin("CRyPTIC_MIC", "MYCOTB_MIC")
    label = F.when(plates, F.col("phenotypic_category")).otherwise(F.lit("WHO_MIC"))
    return df.withColumn("phenotypic_category", F.concat(F.lit(prefix), label))


# ------------------------------------------------------------------ clean phenotypes
def clean_binary_phenotypes(
    phenotype: DataFrame,
    category: DataFrame,
    drug: DataFrame,
    medium: DataFrame,
    method: DataFrame,
    mic: DataFrame,
    cutoff: DataFrame,
    tier: DataFrame,
    plate_concentration: DataFrame,
) -> DataFrame:
    """One R or S per sample and drug from both kinds of tests, for drugs that have resistance genes."""
    columns = ["sample_id", "drug_id", "phenotypic_category", "test_result"]
    tests = pool_drugs(categorise_tests(phenotype, category, drug, medium, method), drug)
    mics = pool_drugs(binarise_mic(mic, cutoff, plate_concentration, drug), drug).select(*columns)
    ranked = consensus_by_category(consensus_by_medium(tests, medium).select(*columns).unionByName(mics))
    return ranked.join(tier.select("drug_id").distinct(), "drug_id", "left_semi")


def cc_phenotypes(
    mic: DataFrame, drug: DataFrame, plate_concentration: DataFrame, cutoff: DataFrame, tier: DataFrame
) -> DataFrame:
    """Phenotypes at the cut-off (CC) and one concentration below (CC-ATU) in one relation, kept only where both exist.

    MICs are read once: each meets both cut-offs in one join, and both results are states of the same aggregations.
    """
    limits = cutoff_pairs(cutoff, plate_concentration).withColumnsRenamed({"medium_name": "plate", "value": "exact"})
    states = F.explode(F.array(*[
        F.struct(F.lit(state).alias("state"), _mic_result(state).alias("test_result")) for state in ("exact", "lowered")
    ]))
    results = (
        _possible_mics(filter_plate_drug_rules(mic, drug), drug)
        .join(limits, ["drug_id", "plate"], "left")
        .select("sample_id", "drug_id", "plate", states.alias("_s"))
        .select("sample_id", "drug_id", "plate", "_s.*")
        .withColumn("phenotypic_category", _mic_category())
    )
    pooled = pool_drugs(results, drug).join(tier.select("drug_id").distinct(), "drug_id", "left_semi")
    agreed = agreed_result(_usable(pooled), ["sample_id", "drug_id", "state", "phenotypic_category"])
    best = F.struct(priority(F.col("phenotypic_category"), rules.CATEGORY_ORDER), "phenotypic_category", "test_result")
    paired = agreed.groupBy("sample_id", "drug_id").agg(
        *[F.min(F.when(F.col("state") == state, best)).alias(state) for state in ("exact", "lowered")]
    ).where("exact IS NOT NULL AND lowered IS NOT NULL")
    rows = F.explode(F.array(*[
        F.struct(F.lit(prefix).alias("_prefix"), f"{state}.phenotypic_category", F.col(f"{state}.test_result").alias("phenotype"))
        for state, prefix in (("exact", "CC_"), ("lowered", "CC-ATU_"))
    ]))
    listed = paired.select("sample_id", "drug_id", rows.alias("_r")).select("sample_id", "drug_id", "_r.*")
    return relabel_categories(listed, F.col("_prefix")).drop("_prefix")


def clean_cc_phenotypes(
    mic: DataFrame, drug: DataFrame, plate_concentration: DataFrame, cutoff: DataFrame, tier: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`cc_phenotypes` at the cut-off, and those one concentration below."""
    both = cc_phenotypes(mic, drug, plate_concentration, cutoff, tier)
    return tuple(both.where(F.col("phenotypic_category").startswith(prefix)) for prefix in ("CC_", "CC-ATU_"))


def who_only_phenotypes(tests: DataFrame) -> DataFrame:
    """Agreed R or S from tests at current critical concentrations, or past ones where no current test exists."""
    known = tests.where(F.col("phenotypic_category").isin("WHO_current", "WHO_past"))
    current = F.col("phenotypic_category") == "WHO_current"
    result = F.col("test_result")
    flags = known.groupBy("sample_id", "drug_id").agg(
        F.bool_or(current).alias("has_current"),
        *[
            F.coalesce(F.bool_or(is_current & condition), F.lit(False)).alias(f"{label}_{kind}")
            for label, is_current in (("current", current), ("past", ~current))
            for kind, condition in (("r", result == "R"), ("s", result == "S"), ("x", ~result.isin("R", "S", "")))
        ],
    )

    def pick(kind: str) -> Column:
        return F.when(F.col("has_current"), F.col(f"current_{kind}")).otherwise(F.col(f"past_{kind}"))

    return flags.where((pick("r") != pick("s")) & ~pick("x")).select(
        "sample_id", "drug_id", F.when(pick("r"), F.lit("R")).otherwise(F.lit("S")).alias("phenotype")
    )


# ------------------------------------------------------------------ reports
def test_count_report(tests: DataFrame, drug: DataFrame, medium: DataFrame, method: DataFrame) -> DataFrame:
    """R and S tests by drug, ``medium (method)``, concentration, category and result."""
    label = first_match(
        [
            (F.col("method_name").isNull(), F.col("medium_name")),
            (F.col("medium_name").isNull(), F.col("method_name")),
        ],
        F.concat("medium_name", F.lit(" ("), "method_name", F.lit(")")),
    )
    keys = ["drug_id", "medium_id", "method_id", "concentration", "phenotypic_category", "test_result"]
    counted = tests.where(F.col("test_result").isin("R", "S")).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return (
        counted.join(drug.select("drug_id", "drug_name"), "drug_id")
        .join(medium.select("medium_id", "medium_name"), "medium_id", "left")
        .join(method.select("method_id", "method_name"), "method_id", "left")
        .groupBy(
            "drug_name",
            label.alias("medium_name"),
            "concentration",
            "test_result",
            "phenotypic_category",
        )
        .agg(F.sum("count").alias("count"))
        .withColumn("type", F.lit("pDST"))
    )


def mic_count_report(binarised: DataFrame, drug: DataFrame, category: str = "phenotypic_category") -> DataFrame:
    keys = ["drug_id", "plate", "mic_value", "test_result", category]
    counted = binarised.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counted.join(drug.select("drug_id", "drug_name"), "drug_id").select(
        "drug_name",
        F.lit("MIC").alias("type"),
        "plate",
        "mic_value",
        "test_result",
        F.col(category).alias("phenotypic_category"),
        "count",
    )


def _with_package(binarised: DataFrame, mic: DataFrame) -> DataFrame:
    return binarised.join(mic.select(F.col("id").alias("mictest_id"), "package_id"), "mictest_id")


def complete_panels(binarised: DataFrame, mic: DataFrame, plates: list[str] = rules.COMPLETE_PANEL_PLATES) -> DataFrame:
    """(package, drug, plate) without a single test that could not be binarised."""
    return (
        _with_package(binarised, mic)
        .where(F.col("plate").isin(plates))
        .groupBy("package_id", "drug_id", "plate")
        .agg(F.count_if(F.coalesce("test_result", F.lit("U")) == "U").alias("_open"))
        .where("_open = 0")
        .drop("_open")
    )


def recategorise_complete_panels(binarised: DataFrame, mic: DataFrame) -> DataFrame:
    """Tests of complete panels count as current."""
    keys = ["package_id", "drug_id", "plate"]
    complete = complete_panels(binarised, mic).withColumn("_complete", F.lit(True))
    corrected = F.when(F.col("_complete"), F.lit("WHO_current")).otherwise(F.col("phenotypic_category"))
    return (
        _with_package(binarised, mic)
        .join(complete, keys, "left")
        .withColumn("phenotypic_category_corrected", corrected)
        .drop("_complete")
    )


def unbinarised_by_package(binarised: DataFrame, mic: DataFrame, drug: DataFrame, package: DataFrame) -> DataFrame:
    keys = ["package_id", "drug_id", "plate"]
    return (
        _with_package(binarised, mic)
        .where(F.col("test_result").isNull() | ~F.col("test_result").isin("R", "S"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .join(drug.select("drug_id", "drug_name"), "drug_id")
        .join(package.select(F.col("id").alias("package_id"), F.col("name").alias("package_name")), "package_id")
    )
