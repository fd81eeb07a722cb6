"""The five marts over the canonical state: fraud, retention, operations, region, policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimforge import functions as fn
from claimforge.operators.matching import nearest_by_date, rolling_count
from claimforge.plans.core import Core

c = F.col

# The dates of the study, and the documents that each type of claim needs.
HISTORY, EXTRACT_END = "2023-07-01", "2026-06-30"
SNAPSHOT, OBSERVED, OUTCOME = "2026-03-31", "2025-04-01", "2026-04-01"
DOCUMENTS = {
    "prescription_drugs": ("receipt", "prescription"), "vision": ("receipt", "prescription"), "health_practitioner": ("receipt",), "preventive": ("receipt",), "basic": ("receipt",),
    "hearing_aids": ("receipt", "referral"), "medical_equipment": ("receipt", "referral"), "ambulance": ("invoice",), "hospital_cash": ("hospital_discharge_summary",), "major": ("receipt", "treatment_plan", "xray"),
    "emergency_medical": ("itemized_invoice", "medical_report", "proof_of_travel"), "trip_cancellation": ("cancellation_invoice", "booking_confirmation", "supporting_statement"),
    "trip_interruption": ("receipt", "booking_confirmation", "supporting_statement"), "baggage": ("baggage_irregularity_report", "receipt", "proof_of_travel"),
}
DECIDED = ("approved", "partially_approved")


#: A column of marts: the names of the amounts and rates that are 0 because there are no rows behind them.
FILLED = "filled"


def filled(*columns: str) -> Column:
    return F.array_compact(F.array(*(F.when(c(x).isNull(), F.lit(x)) for x in columns))).alias(FILLED)


def day(x: str) -> Column:
    return F.lit(x).cast("date")


def ratio(a: Column, b: Column) -> Column:
    """a / b rounded to four places in exact decimals; null where b is 0 or unknown."""
    return F.when(b != 0, F.round(a.cast("decimal(20,4)") / b.cast("decimal(20,4)"), 4)).cast("decimal(12,4)")


def total(x: Column) -> Column:
    return F.round(F.sum(x), 2).cast("decimal(18,2)")


def mean(x: Column) -> Column:
    """Mean of amounts, rounded once from an exact quotient."""
    return F.round(F.sum(x).cast("decimal(24,6)") / F.count(x).cast("decimal(12,0)"), 2).cast("decimal(18,2)")


def required(claim_type: str = "claim_type") -> Column:
    none = F.array().cast("array<string>")
    out = None
    for kind, papers in DOCUMENTS.items():
        value = F.array(*map(F.lit, papers))
        out = F.when(c(claim_type) == kind, value) if out is None else out.when(c(claim_type) == kind, value)
    return out.otherwise(none)


def claims_in_full(core: Core) -> DataFrame:
    """Claims with their policy, owner, payment and document."""
    policies = core.policies.select("policy_id", "plan_name", "coverage_type")
    people = core.customers.select("customer_id", "province", "fsa", "date_of_birth")
    payments = core.payments.select("claim_id", "decision_outcome", "processing_start_date", "decision_date", "payment_date", "payment_status", "payment_amount", F.lit(True).alias("is_decided"))
    details = core.details.drop("stem", "product_line")
    return (
        core.claims.drop("approved_amount", "region", "claim_status").join(policies, "policy_id").join(people, "customer_id").join(payments, "claim_id", "left").join(details, "claim_id", "left")
        .withColumnRenamed("policy_type", "product_line").withColumn("required_documents", required())
    )


def region_summary(core: Core) -> DataFrame:
    """Claims by province, product, type and quarter."""
    denied = F.count_if(c("decision_outcome") == "denied")
    decided = F.count("is_decided")
    kept = F.when(c("decision_outcome").isin(*DECIDED), c("payment_amount"))
    return (
        claims_in_full(core).filter(c("claim_date").between(HISTORY, EXTRACT_END))
        .groupBy("province", "product_line", "claim_type", F.trunc("claim_date", "quarter").alias("quarter_start"), F.year("claim_date").alias("calendar_year"), F.quarter("claim_date").alias("calendar_quarter"))
        .agg(
            F.count("*").cast("int").alias("claim_count"), F.countDistinct("customer_id").cast("int").alias("customer_count"), F.countDistinct("policy_id").cast("int").alias("policy_count"),
            total(c("claim_amount")).alias("total_claim_amount"), mean(c("claim_amount")).alias("average_claim_amount"), decided.cast("int").alias("decided_claim_count"), denied.cast("int").alias("denied_claim_count"),
            F.count_if(c("is_decided").isNull()).cast("int").alias("pending_claim_count"), ratio(denied, decided).alias("denial_rate"), total(c("payment_amount")).alias("total_approved_amount"), mean(kept).alias("average_approved_amount"),
        )
    )


def operations(core: Core) -> DataFrame:
    """Durations between the steps of a claim, and whether its papers are complete."""
    span = lambda a, b: F.datediff(a, b)
    return claims_in_full(core).select(
        "claim_id", "policy_id", "customer_id", "province", "product_line", "claim_type", "claim_amount", c("claim_date").alias("submission_date"), "submitted_at", "submission_channel", "adjuster_id", "provider_type",
        F.coalesce("decision_outcome", F.lit("pending")).alias("decision_outcome"), "processing_start_date", "decision_date", "payment_date", "payment_status", "payment_amount",
        c("decision_outcome").isNull().alias("is_pending"), c("decision_outcome").isNotNull().alias("is_decided"), (c("payment_status") == "paid").alias("is_paid"),
        span("processing_start_date", "claim_date").alias("queue_days"), span("decision_date", "processing_start_date").alias("handling_days"), span("decision_date", "claim_date").alias("submission_to_decision_days"),
        span("payment_date", "decision_date").alias("decision_to_payment_days"), span("payment_date", "claim_date").alias("submission_to_payment_days"),
        c("documents_submitted").isNotNull().alias("document_information_known"), fn.length_or_null(c("required_documents")).alias("required_document_count"), F.size("documents_submitted").alias("submitted_document_count"),
        fn.contains_all(c("documents_submitted"), c("required_documents")).alias("required_documents_complete"),
    )


def fraud(core: Core) -> DataFrame:
    """One row per claim with its suspicious patterns; a flag whose inputs are unknown is null."""
    rate = F.coalesce("exchange_rate_to_cad", F.lit(1).cast("decimal(10,4)"))
    lines = core.line_items.join(core.details.select("stem", "product_line", "exchange_rate_to_cad"), "stem").groupBy("claim_id").agg(
        F.count("*").cast("int").alias("line_item_count"),
        F.round(F.sum(c("amount") * F.when(c("product_line") == "travel", c("exchange_rate_to_cad")).otherwise(rate)), 2).cast("decimal(12,2)").alias("reconciled_line_total_cad"),
    )
    travel = c("product_line") == "travel"
    service, start, amount, most = c("service_date"), c("start_date"), c("claim_amount"), c("applicable_benefit_maximum")
    local = F.from_utc_timestamp("submitted_at", "America/Regina")
    known_trip = c("trip_start").isNotNull() & c("trip_end").isNotNull() & c("incident_date").isNotNull()
    flags = {
        "f1_early_claim_flag": service.between(start, F.date_add(start, 30)),
        "f2_waiting_period_flag": F.when((c("product_line") != "dental") | ~c("claim_type").isin("basic", "major"), False).otherwise(service < F.date_add(start, 90)),
        "f3_near_maximum_flag": amount >= most * F.lit("0.90").cast("decimal(3,2)"),
        "f4_repeat_claims_30d_flag": c("claims_including_current_prior_30d") >= 3,
        "f6_line_item_mismatch_flag": F.abs(amount - c("reconciled_line_total_cad")) > F.lit("0.01").cast("decimal(4,2)"),
        "f7_missing_required_documents_flag": ~fn.contains_all(c("documents_submitted"), c("required_documents")),
        "f8_unusual_submission_time_flag": fn.is_weekend(local) | (F.hour(local) <= 5),
        "f9_travel_date_anomaly_flag": F.when(~travel, False).when(known_trip & (c("claim_type") == "trip_cancellation"), c("incident_date") >= c("trip_start")).when(known_trip, ~c("incident_date").between(c("trip_start"), c("trip_end"))),
    }
    base = claims_in_full(core).join(lines, "claim_id", "left").withColumn("applicable_benefit_maximum", F.when(travel, F.coalesce("incident_sub_limit", "coverage_amount")).otherwise(c("coverage_amount")))
    base = rolling_count(base, ["customer_id"], "claim_date", 30, "claims_including_current_prior_30d").withColumns(flags)
    patterns = sum(F.coalesce(c(f).cast("int"), F.lit(0)) for f in flags)
    flagged = base.withColumn("suspicious_pattern_count_excluding_provider", patterns)
    suspicious = c("suspicious_pattern_count_excluding_provider") > 0
    with_provider = flagged.filter(c("provider_id").isNotNull())
    providers = with_provider.groupBy("provider_id").agg(F.count("*").alias("provider_claim_count"), F.count_if(suspicious).alias("provider_suspicious_claim_count"))
    everything = with_provider.agg(F.count("*").alias("with_provider"))  # one row
    out = flagged.join(providers, "provider_id", "left").crossJoin(F.broadcast(everything))
    return out.select(
        "claim_id", "policy_id", "customer_id", F.coalesce(fn.age_band(fn.age_years(c("date_of_birth"), c("claim_date"))), F.lit("Unknown")).alias("age_band_at_claim"), "province", "fsa", "product_line", "plan_name", "coverage_type", "claim_type",
        start.alias("policy_start_date"), "service_date", "claim_date", F.datediff(service, start).alias("days_from_policy_start"), "claim_amount", c("payment_amount").alias("authoritative_approved_amount"),
        F.coalesce("decision_outcome", F.lit("pending")).alias("decision_outcome"), "applicable_benefit_maximum", ratio(amount, most).alias("claim_amount_to_max_ratio"), "submission_channel", "provider_id", "provider_type", "adjuster_id",
        "line_item_count", "reconciled_line_total_cad", (amount - c("reconciled_line_total_cad")).cast("decimal(12,2)").alias("header_line_amount_difference_cad"), "claims_including_current_prior_30d",
        fn.length_or_null(c("required_documents")).alias("required_document_count"), F.size("documents_submitted").alias("submitted_document_count"), *list(flags)[:4], "provider_claim_count",
        ratio(c("provider_claim_count"), c("with_provider")).alias("provider_claim_share"), "provider_suspicious_claim_count", ratio(c("provider_suspicious_claim_count"), c("provider_claim_count")).alias("provider_suspicious_claim_share"),
        *list(flags)[4:], "suspicious_pattern_count_excluding_provider", (c("suspicious_pattern_count_excluding_provider") >= 2).alias("has_multiple_suspicious_patterns"),
    )


def retention(core: Core) -> DataFrame:
    """Features of each customer as they were known at the snapshot, and whether they left after it."""
    snapshot = day(SNAPSHOT)
    held = core.policies.filter(c("policy_type").isin("health", "dental"))
    current = held.filter((c("start_date") <= snapshot) & (c("end_date").isNull() | (c("end_date") >= snapshot)))
    left = c("status").isin("lapsed", "cancelled") & c("end_date").between(OUTCOME, EXTRACT_END)
    cohort = current.groupBy("customer_id").agg(
        F.count("*").cast("int").alias("active_hd_policy_count"), F.count_if(c("policy_type") == "health").cast("int").alias("active_health_policy_count"), F.count_if(c("policy_type") == "dental").cast("int").alias("active_dental_policy_count"),
        F.bool_and(F.coalesce(left, F.lit(False))).alias("all_left"),
    )
    again = held.filter((c("start_date") > snapshot) & (c("start_date") <= day(EXTRACT_END))).select("customer_id").distinct().withColumn("again", F.lit(True))
    paid = c("paid_date") <= snapshot
    state = F.when(paid & (c("paid_date") <= c("due_date")), "paid").when(paid, "late").when(c("due_date") <= F.date_sub(snapshot, 30), "missed").otherwise("outstanding")
    w = Window.partitionBy("policy_id").orderBy("due_date", "premium_id")
    owners = core.policies.select("policy_id", "policy_type", c("customer_id").alias("owner"))
    rows = (
        core.premiums.join(owners, "policy_id").filter(c("policy_type").isin("health", "dental") & c("due_date").between(OBSERVED, SNAPSHOT)).withColumn("state", state)
        .withColumn("band_before", F.lag("age_band").over(w)).withColumn("amount_before", F.lag("premium_amount").over(w))
    )
    changed = c("band_before").isNotNull() & ~c("age_band").eqNullSafe(c("band_before"))
    late = F.count_if(c("state").isin("late", "missed"))
    premium = rows.groupBy(c("owner").alias("customer_id")).agg(
        F.count("*").cast("int").alias("premium_installment_count_12m"), F.count_if(c("state") == "late").cast("int").alias("late_premium_count_12m"), F.count_if(c("state") == "missed").cast("int").alias("missed_premium_count_12m"),
        late.cast("int").alias("late_or_missed_count_12m"), ratio(late, F.count("*")).alias("late_or_missed_rate_12m"), total(c("premium_amount")).alias("premium_due_total_12m"), total(F.when(paid, c("premium_amount"))).alias("premium_paid_total_12m"),
        F.count_if(changed).cast("int").alias("age_band_change_count_12m"), F.count_if(changed & (c("premium_amount") > c("amount_before"))).cast("int").alias("age_band_change_with_increase_count_12m"),
    )
    denied, decided = F.count_if(c("decision_outcome") == "denied"), F.count("is_decided")
    recent = claims_in_full(core).filter(c("product_line").isin("health", "dental") & c("claim_date").between(OBSERVED, SNAPSHOT)).groupBy("customer_id").agg(
        F.count("*").cast("int").alias("claim_count_12m"), decided.cast("int").alias("decided_claim_count_12m"), denied.cast("int").alias("denied_claim_count_12m"), ratio(denied, decided).alias("denied_claim_rate_12m"),
        total(c("claim_amount")).alias("claimed_amount_total_12m"), total(c("payment_amount")).alias("approved_amount_total_12m"), F.max("claim_date").alias("last_claim_date_12m"),
    )
    zero = [x for x in [*premium.columns[1:], *recent.columns[1:]] if x != "last_claim_date_12m"]
    out = core.customers.join(cohort, "customer_id").join(premium, "customer_id", "left").join(recent, "customer_id", "left").join(again, "customer_id", "left")
    tenure = F.datediff(snapshot, "customer_since")
    return out.select(
        "customer_id", F.coalesce(fn.age_band(fn.age_years(c("date_of_birth"), snapshot)), F.lit("Unknown")).alias("age_band_at_snapshot"), "gender", "province", "fsa", tenure.alias("tenure_days_at_snapshot"),
        F.round(tenure.cast("decimal(12,4)") / F.lit("30.4375").cast("decimal(6,4)"), 1).alias("tenure_months_at_snapshot"), *cohort.columns[1:4], *(F.coalesce(x, F.lit(0)).alias(x) for x in zero), "last_claim_date_12m",
        F.datediff(snapshot, "last_claim_date_12m").alias("days_since_last_claim_at_snapshot"), (c("all_left") & c("again").isNull()).cast("int").alias("churned"),
        day(OBSERVED).alias("observation_start"), snapshot.alias("snapshot_date"), day(OUTCOME).alias("outcome_start"), day(EXTRACT_END).alias("outcome_end_date"), filled(*zero),
    )


def policy_performance(core: Core) -> DataFrame:
    """Exposure months, premiums and claims by product, plan, coverage, province and age band."""
    keys = ["policy_type", "plan_name", "age_band", "coverage_type", "province"]
    held = core.policies.join(core.customers.select("customer_id", "province", "date_of_birth"), "customer_id").withColumn("plan_name", F.coalesce("plan_name", F.lit("Unknown"))).drop("status")
    instalments = core.premiums.select("policy_id", "due_date", "age_band", "premium_id")
    first = F.trunc(F.greatest("start_date", day(HISTORY)), "month")
    last = F.trunc(F.least(F.coalesce("end_date", day(EXTRACT_END)), day(EXTRACT_END)), "month")
    months = held.withColumn("first", first).withColumn("last", last).filter("first <= last").withColumn("at", F.explode(F.expr("sequence(first, last, interval 1 month)")))

    def banded(rows: DataFrame, at: str, ids: list[str]) -> DataFrame:
        """The age band at a day: by birth date, else that of the nearest instalment, else unknown."""
        near = nearest_by_date(rows.filter("date_of_birth is null").select("policy_id", *[x for x in ids if x != "policy_id"], at), instalments, ["policy_id"], at, "due_date", ["premium_id", "age_band"], ids)
        own = fn.age_band(fn.age_years(c("date_of_birth"), c(at)))
        return rows.join(near.select(*ids, c("age_band").alias("near")), ids, "left").withColumn("age_band", F.coalesce(own, c("near"), F.lit("Unknown")))

    exposure = banded(months, "at", ["policy_id", "at"]).groupBy(*keys).agg(F.count("*").cast("int").alias("policy_months"), F.countDistinct("policy_id").cast("int").alias("policy_count"))
    premium = core.premiums.select("policy_id", "age_band", "premium_amount", "due_date").join(held, "policy_id").filter(c("due_date").between(HISTORY, EXTRACT_END)).groupBy(*keys).agg(
        F.count("*").cast("int").alias("premium_installment_count"), total(c("premium_amount")).alias("premium_due_total")
    )
    outcome = core.payments.select("claim_id", "decision_outcome", "payment_amount", F.lit(True).alias("decided"))
    made = core.claims.select("claim_id", "policy_id", "claim_date").filter(c("claim_date").between(HISTORY, EXTRACT_END)).join(held, "policy_id").join(outcome, "claim_id", "left")
    claims = banded(made, "claim_date", ["claim_id", "claim_date"]).groupBy(*keys).agg(
        F.count("*").cast("int").alias("claim_count"), F.count("decided").cast("int").alias("decided_claim_count"), F.count_if(c("decision_outcome").isin(*DECIDED)).cast("int").alias("approved_claim_count"), total(c("payment_amount")).alias("approved_claim_amount")
    )
    spine = exposure.select(*keys).union(premium.select(*keys)).union(claims.select(*keys)).distinct()
    measures = ["policy_count", "policy_months", "premium_installment_count", "premium_due_total", "claim_count", "decided_claim_count", "approved_claim_count", "approved_claim_amount"]
    joined = spine.join(exposure, keys, "left").join(premium, keys, "left").join(claims, keys, "left")
    out = joined.select(*keys, *(F.coalesce(x, F.lit(0)).alias(x) for x in measures), filled("premium_due_total", "approved_claim_amount"))
    rated = out.withColumn("claims_to_premium_performance_ratio", ratio(c("approved_claim_amount"), c("premium_due_total"))).withColumn("low_exposure_flag", c("policy_months") < 12)
    return rated.select(*keys, *measures, "claims_to_premium_performance_ratio", "low_exposure_flag", FILLED)


MARTS = {"fraud_detection": fraud, "customer_retention": retention, "operational_efficiency": operations, "region_wise_insights": region_summary, "policy_optimization": policy_performance}
