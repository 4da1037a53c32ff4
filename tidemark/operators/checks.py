"""Assertions as DataFrames: each returns the offending rows, so an empty result passes."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import second_boundaries
from .staging import IDENTITY, POSTING_KEYS, SWEEP_KEYS

BASES = ("observed", "source_reported", "inferred_absence")
ABANDONED_AFTER = 4


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def label_conflicts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("nuts_code").agg(F.countDistinct("nuts_label").alias("n_labels")).where("n_labels > 1")


def outside_vocabulary(rows: DataFrame, column: str, words) -> DataFrame:
    return rows.where(~F.col(column).isin(*words)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def row_count_mismatch(sweeps: DataFrame, observations: DataFrame) -> DataFrame:
    counted = observations.groupBy(*SWEEP_KEYS).agg(F.count(F.lit(1)).alias("found"))
    return sweeps.join(counted, SWEEP_KEYS, "left").select(*SWEEP_KEYS, "row_count", F.coalesce("found", F.lit(0)).alias("found")).where("row_count <> found")


def excluded_but_staged(postings: DataFrame, manifests: DataFrame) -> DataFrame:
    """Postings of sweeps that were not complete."""
    return postings.join(manifests.where("status <> 'complete'"), SWEEP_KEYS, "left_semi")


def orphan_observations(observations: DataFrame, manifests: DataFrame) -> DataFrame:
    return observations.join(manifests, SWEEP_KEYS, "left_anti")


def inferred_without_sweep(closures: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Inferred closures that no sweep of their key and time stands for."""
    at = sweeps.select(*SWEEP_KEYS, "hmac_key_version", F.col("observed_at").alias("event_at"))
    return closures.where("event_basis = 'inferred_absence'").join(at, [*SWEEP_KEYS, "hmac_key_version", "event_at"], "left_anti")


def closed_by_rotation(closures: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Inferred closures at a time when only sweeps of another key were taken."""
    own = sweeps.select("source", "scope_id", "hmac_key_version", F.col("observed_at").alias("event_at"))
    return closures.where("event_basis = 'inferred_absence'").join(own, ["source", "scope_id", "hmac_key_version", "event_at"], "left_anti")


def cross_key_closures(closures: DataFrame, manifests: DataFrame) -> DataFrame:
    """Closures by a sweep of another key version."""
    versions = manifests.select(*SWEEP_KEYS, F.col("hmac_key_version").alias("sweep_version"))
    return closures.join(versions, SWEEP_KEYS).where("sweep_version <> hmac_key_version")


def latest_missing(sweeps: DataFrame, latest: DataFrame) -> DataFrame:
    """Scopes, those with an empty last sweep included, whose newest sweep is not their latest one."""
    newest = sweeps.groupBy("source", "scope_id").agg(F.max("observed_at").alias("observed_at"))
    return newest.join(latest, ["source", "scope_id", "observed_at"], "left_anti")


def suppression_leaks(rows: DataFrame, counts: list[str]) -> DataFrame:
    """Published counts of 1 to 4."""
    leak = F.lit(False)
    for c in counts:
        leak = leak | (F.coalesce(F.col(c), F.lit(0)).between(1, 4))
    return rows.where(leak)


def flow_leaks(flows: DataFrame) -> DataFrame:
    """Flow rows with a negative or an unmasked small count."""
    negative = reduce(or_, (F.coalesce(F.col(c) < 0, F.lit(False)) for c in ("openings", "closures", "active_postings", "active_vacancies")))
    small = reduce(or_, (F.coalesce(F.col(c).between(1, 4), F.lit(False)) for c in ("openings", "closures", "active_postings")))
    return flows.where(negative | small).select("source", "scope_id", "grain", "bucket_start")


def survival_leaks(survival: DataFrame) -> DataFrame:
    """Survival rows that are masked and still tell something, small and not masked, or of negative length."""
    told = reduce(or_, (F.col(c).isNotNull() for c in ("posting_count", "advertised_vacancies", "median_duration_days", "p25_duration_days", "p75_duration_days", "max_duration_days")))
    masked = F.coalesce("is_suppressed", F.lit(False))
    small = F.coalesce(F.col("posting_count").between(1, 4), F.lit(False))
    return survival.where((masked & told) | (~masked & small) | F.coalesce(F.col("max_duration_days") < 0, F.lit(False))).select("source", "scope_id", "lifecycle_status")


def requirement_totals(requirements: DataFrame, postings: DataFrame, latest: DataFrame, dimensions: int = 3) -> DataFrame:
    """(source, scope_id, sweep_id, dimension): counts that don't add up to the sweep's postings, repeated values, codes that contradict their status, and sweeps without all dimensions."""
    keys = [*SWEEP_KEYS, "dimension"]
    added = requirements.groupBy(*keys).agg(F.sum("posting_count").alias("counted"))
    totals = postings.join(latest.select(*SWEEP_KEYS), SWEEP_KEYS, "left_semi").groupBy(*SWEEP_KEYS).agg(F.countDistinct("source_id").alias("total"))
    unequal = added.join(totals, SWEEP_KEYS).where("counted <> total").select(*keys)
    twice = requirements.groupBy(*keys, "value_code", "value_label").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    contrary = requirements.where("(mapping_status <> 'not_present' AND value_code IS NULL) OR (mapping_status = 'not_present' AND value_code IS NOT NULL)").select(*keys)
    lacking = requirements.groupBy(*SWEEP_KEYS).agg(F.countDistinct("dimension").alias("n")).where(F.col("n") != dimensions).select(*SWEEP_KEYS, F.lit("incomplete-dimensions").alias("dimension"))
    return reduce(DataFrame.unionByName, (unequal, twice, contrary, lacking))


def coverage_disorder(coverage: DataFrame, quality: DataFrame) -> DataFrame:
    """(source, scope_id, sweep_id, dimension): mapped above valued or valued above all, repeated dimensions, and totals that the outcomes contradict."""
    keys = [*SWEEP_KEYS, "dimension"]
    disorder = coverage.where("postings_mapped > postings_with_source_value OR postings_with_source_value > postings_total OR postings_total < 1").select(*keys)
    twice = repeated(coverage, keys).select(*keys)
    outcomes = quality.groupBy(*keys).agg(F.max("total_outcomes").alias("outcomes"))
    unequal = coverage.where(F.col("dimension").isin("region", "occupation")).join(outcomes, keys).where("outcomes <> postings_total").select(*keys)
    return reduce(DataFrame.unionByName, (disorder, twice, unequal))


STATUSES = ("mapped", "ambiguous", "low_confidence", "unmapped", "not_present")


def output_faults(demand: DataFrame, skills: DataFrame, quality: DataFrame, versions: tuple[str, ...], skill_version: str) -> DataFrame:
    """(mart, problem): values without a URI or of another version, statuses outside the vocabulary, and counts that cannot be."""
    off = lambda rows, name, good: rows.where(F.col("value_uri").isNull() | ~F.col("taxonomy_version").isin(*good)).select(F.lit(name).alias("mart"), F.lit("value or version").alias("problem"))
    wrong = quality.where(~F.col("mapping_status").isin(*STATUSES) | (F.col("outcome_count") < 1) | (F.col("total_outcomes") < F.col("outcome_count"))).select(F.lit("mapping_quality").alias("mart"), F.lit("status or count").alias("problem"))
    return off(demand, "dimension_demand", versions).unionByName(off(skills, "skill_demand", (skill_version,))).unionByName(wrong)


def uncovered(coverage: DataFrame) -> DataFrame:
    """Sweeps that are not covered, and freshness outside the vocabulary."""
    return coverage.where((F.col("coverage_status") != "covered") | ~F.col("freshness_status").isin("fresh", "stale", "unknown")).select(*SWEEP_KEYS, "coverage_status", "freshness_status")


def missing_cases(coverage: DataFrame) -> DataFrame:
    """(detail): cases that a sample has to hold and doesn't: a covered sweep without rows, a fresh and a stale one."""
    held = coverage.agg(F.coalesce(F.bool_or((F.col("observed_rows") == 0) & (F.col("coverage_status") == "covered")), F.lit(False)).alias("empty"), F.coalesce(F.bool_or(F.col("freshness_status") == "fresh"), F.lit(False)).alias("fresh"), F.coalesce(F.bool_or(F.col("freshness_status") == "stale"), F.lit(False)).alias("stale"))
    return held.select(F.explode(F.array_compact(F.array(*(F.when(~F.col(c), c) for c in ("empty", "fresh", "stale"))))).alias("detail"))


def no_divergence(survival: DataFrame) -> DataFrame:
    """One row if no published cell has more vacancies than postings."""
    held = survival.agg(F.coalesce(F.bool_or(F.col("advertised_vacancies") > F.col("posting_count")), F.lit(False)).alias("held"))
    return held.where("NOT held").select(F.lit("no vacancy/posting divergence is published").alias("failure"))


def mapped_without_code(postings: DataFrame) -> DataFrame:
    return postings.where("(region_mapping_status = 'mapped' AND nuts_code IS NULL) OR (occupation_mapping_status = 'mapped' AND esco_occupation_uri IS NULL)")


def negative_durations(lifecycle: DataFrame) -> DataFrame:
    """Row-level: a source may report a removal before the first sighting."""
    return lifecycle.where("posting_duration_days < 0").select(*IDENTITY, "posting_duration_days")


def abandoned(latest: DataFrame, reference_time: Column) -> DataFrame:
    """Scopes whose last sweep is older than four times their threshold."""
    age = second_boundaries(F.col("observed_at"), reference_time) / F.lit(3600.0)
    return latest.select("source", "scope_id", age.alias("age_hours"), "freshness_threshold_hours").where(F.col("age_hours") > ABANDONED_AFTER * F.col("freshness_threshold_hours"))


def zero_sweeps_unpublished(latest: DataFrame, demand: DataFrame) -> DataFrame:
    return latest.where("row_count = 0").join(demand, SWEEP_KEYS, "left_anti")


def frame_counts(labels: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Countries whose number of five-letter regions is not the expected one."""
    found = labels.where(F.length("nuts_code") == 5).groupBy(F.left("nuts_code", F.lit(2)).alias("country")).agg(F.countDistinct("nuts_code").alias("found"))
    wanted = F.create_map(*(F.lit(x) for pair in expected.items() for x in pair))
    return found.withColumn("expected", F.element_at(wanted, F.col("country"))).where("expected IS NOT NULL AND expected <> found")


#: Regions of the pinned frame, by country.
FRAME = {"DE": 400, "SE": 21}
#: Patterns of personal data that no text field may show.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "url": r"https?://", "phone": r"\+[0-9][0-9 ()-]{7,}[0-9]", "card": r"\b[0-9]{16}\b"}
#: Of a German panel also its postcodes; these fields may hold what looks like one.
PANEL_PATTERNS = PATTERNS | {"postcode": r"(?<![0-9a-f])[0-9]{5}(?![0-9a-f])"}
EXEMPT = ("source_id", "sweep_id", "observed_at", "first_published", "last_modified", "removed_at", "nuts_code", "esco_version", "jobtech_taxonomy_version")


def panel_pii(rows: DataFrame) -> DataFrame:
    """(field, pattern, hits) over a panel's text fields but the exempt ones."""
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string" and f.name not in EXEMPT]
    return pii_fields(rows, texts, PANEL_PATTERNS)


def pii_fields(rows: DataFrame, columns: list[str], patterns: dict[str, str] = PATTERNS) -> DataFrame:
    """(field, pattern, hits) for the fields that any pattern matches: one pass over the rows."""
    tallies = rows.agg(*(F.count_if(F.col(c).rlike(p)).alias(f"{c}|{name}") for c in columns for name, p in patterns.items()))
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.lit(name).alias("pattern"), F.col(f"{c}|{name}").alias("hits")) for c in columns for name in patterns)))
    return tallies.select(cells.alias("c")).select("c.*").where("hits > 0")


def page_problems(pages: DataFrame, page_size: int) -> DataFrame:
    """(scope, problem) of paged collections (scope, page, last_page, total, n_ids, n_distinct): constant totals, full pages, unique ids, reconciled sums."""
    by = pages.groupBy("scope").agg(F.countDistinct("total").alias("totals"), F.count_if((F.col("page") < F.col("last_page")) & (F.col("n_ids") != page_size)).alias("short"), F.sum(F.col("n_ids") - F.col("n_distinct")).alias("repeats"), F.sum("n_ids").alias("ids"), F.max("total").alias("total"))
    problems = F.array_compact(F.array(F.when(F.col("totals") > 1, "total changed"), F.when(F.col("short") > 0, "short page"), F.when(F.col("repeats") > 0, "repeated id"), F.when(F.col("ids") != F.col("total"), "rows do not reconcile")))
    return by.select("scope", F.explode(problems).alias("problem"))


def truncated(pages: DataFrame, page_size: int) -> DataFrame:
    """Segments whose last page is full and which therefore hide rows."""
    return pages.groupBy("scope").agg(F.max_by("n_ids", "page").alias("last_rows")).where(F.col("last_rows") == page_size)


def filter_not_applied(pages: DataFrame, least: int = 10, share: float = 0.5) -> DataFrame:
    """Pages (page, asked, hits: array of the field's values) of which no majority reports what was asked for; short pages prove nothing."""
    matching = F.size(F.filter("hits", lambda h: h == F.col("asked")))
    told = pages.select("page", "asked", F.size("hits").alias("n"), matching.alias("matching"))
    return told.where(F.col("asked").isNotNull() & (F.col("n") >= least) & (F.col("matching") <= F.col("n") * share))


def unreachable(scopes: DataFrame, max_offset: int = 2000) -> DataFrame:
    """Scopes (scope, total, page_size) whose last row lies behind the last usable offset."""
    reachable = (F.floor(F.lit(max_offset) / F.col("page_size")) + 1) * F.col("page_size")
    return scopes.select("*", reachable.cast("long").alias("reachable")).where("total > reachable")


def resume_faults(checkpoints: DataFrame, plan: DataFrame, fields: list[str]) -> DataFrame:
    """Pages of a checkpoint (page, sha256, stored_sha256, fields…) that were altered, or taken under another plan (one row of the fields)."""
    other = checkpoints.join(plan.select(*(F.col(f).alias(f"plan_{f}") for f in fields)).hint("broadcast"))
    differs = reduce(or_, (~F.col(f).eqNullSafe(F.col(f"plan_{f}")) for f in fields))
    problem = F.when(~F.col("sha256").eqNullSafe(F.col("stored_sha256")), "altered").when(differs, "another plan")
    return other.select("page", problem.alias("problem")).where("problem IS NOT NULL")


def panel_faults(sweeps: DataFrame, rows: DataFrame, pinned_hash: str, cap: int, least_regions: int = 390) -> DataFrame:
    """(sweep_id, problem) of a panel's sweeps: unreconciled, too few regions, another membership, no declared cap, failed pages.

    ``sweeps`` has the manifest's numbers, membership_hash, page_cap, coverage_limitations and failed_pages.
    """
    mapped = F.when((F.col("region_mapping_status") == "mapped") & (F.col("nuts_code") != ""), F.col("nuts_code"))
    found = rows.groupBy("sweep_id").agg(F.count(F.lit(1)).alias("lines"), F.countDistinct(mapped).alias("regions"))
    told = sweeps.join(found, "sweep_id", "left").fillna(0, ["lines", "regions"])
    same = (F.col("status") == "complete") & (F.col("expected_pages") == F.col("completed_pages")) & (F.col("expected_rows") == F.col("row_count")) & (F.col("row_count") == F.col("lines"))
    problems = F.array_compact(F.array(
        F.when(~F.coalesce(same, F.lit(False)), "not reconciled"), F.when(F.col("regions") < least_regions, "too few regions"), F.when(~F.col("membership_hash").eqNullSafe(F.lit(pinned_hash)), "another membership"),
        F.when(~F.coalesce((F.col("page_cap") == cap) & F.col("coverage_limitations").contains("not a census"), F.lit(False)), "cap not declared"), F.when(F.col("failed_pages") > 0, "failed pages"),
    ))
    return told.select("sweep_id", F.explode(problems).alias("problem"))


def segmented_faults(rows: DataFrame, least_regions: int, least_mapped: float = 0.85, most_unmapped: float = 0.05, country: str = "DE") -> DataFrame:
    """(problem, value) of a segmented census, each posting counted once: rows of another country, shares of mapped and unmapped, breadth."""
    once = rows.groupBy("source_id").agg(F.min_by(F.struct("country", "region_mapping_status", "nuts_code"), "sweep_id").alias("r")).select("r.*")
    status = F.col("region_mapping_status")
    told = once.agg(
        F.count_if(~F.col("country").eqNullSafe(F.lit(country))).cast("double").alias("foreign"), F.coalesce(F.avg((status == "mapped").cast("double")), F.lit(0.0)).alias("mapped"), F.coalesce(F.avg((status == "unmapped").cast("double")), F.lit(0.0)).alias("unmapped"),
        F.countDistinct(F.when((status == "mapped") & (F.col("nuts_code") != ""), F.col("nuts_code"))).cast("double").alias("breadth"),
    )
    faults = {"rows of another country": ("foreign", F.col("foreign") > 0), "too few mapped": ("mapped", F.col("mapped") < least_mapped), "too many unmapped": ("unmapped", F.col("unmapped") > most_unmapped), "too few regions": ("breadth", F.col("breadth") < least_regions)}
    return told.select(F.explode(F.array_compact(F.array(*(F.when(bad, F.struct(F.lit(name).alias("problem"), F.col(value).alias("value"))) for name, (value, bad) in faults.items())))).alias("f")).select("f.*")


def schema_drift(counts: DataFrame) -> DataFrame:
    """Collections (scope, seen, usable) that saw rows of which none was usable."""
    return counts.where("seen > 0 AND usable = 0")


def suite(model, closures: DataFrame, marts: dict[str, DataFrame], reference_time: Column, direct_closures: DataFrame) -> dict[str, DataFrame]:
    """The offending rows of every assertion, by name.

    ``marts`` has coverage, demand, skills, requirements, quality, mapped
    (mapping coverage), labour, survival and flows.
    """
    key = [c for c in closures.columns]
    return {
        "cadence_not_abandoned": abandoned(model.latest, reference_time),
        "closure_basis_vocabulary": outside_vocabulary(closures, "event_basis", BASES),
        "incomplete_observations_excluded": excluded_but_staged(model.postings, model.manifests),
        "inferred_closures_complete": inferred_without_sweep(closures, model.sweeps),
        "key_rotation_does_not_close": closed_by_rotation(closures, model.sweeps),
        "latest_sweeps_include_empty": latest_missing(model.sweeps, model.latest),
        "manifest_row_counts": row_count_mismatch(model.sweeps, model.observations),
        "mapping_coverage": coverage_disorder(marts["mapped"], marts["quality"]),
        "mapping_outputs": output_faults(marts["demand"], marts["skills"], marts["quality"], ("2024", "1.2.1"), "1.2.1"),
        "no_cross_key_closures": cross_key_closures(closures, model.manifests),
        "no_orphan_observations": orphan_observations(model.observations, model.manifests),
        "nuts_frame_counts": frame_counts(model.labels, FRAME),
        "nuts_label_unambiguous": label_conflicts(model.labels),
        "posting_flows_suppression": flow_leaks(marts["flows"]),
        "posting_lifecycle_grain_unique": repeated(model.lifecycle(), IDENTITY),
        "posting_survival_suppression": survival_leaks(marts["survival"]),
        "postings_grain_unique": repeated(model.postings, POSTING_KEYS),
        "requirement_totals": requirement_totals(marts["requirements"], model.postings, model.latest),
        "sample_coverage_fixtures": missing_cases(marts["coverage"]),
        "skill_grain_unique": repeated(model.skills, [*POSTING_KEYS, "skill_ordinal"]),
        "source_coverage": uncovered(marts["coverage"]),
        "survival_logic": closures.select(*key).subtract(direct_closures.select(*key)).unionByName(direct_closures.select(*key).subtract(closures.select(*key))),
        "vacancies_distinct_from_postings": no_divergence(marts["survival"]),
        "zero_sweep_published": zero_sweeps_unpublished(model.latest.join(uncovered(marts["coverage"]), SWEEP_KEYS, "left_anti"), marts["labour"]),
    }
