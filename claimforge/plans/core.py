"""One canonical state: identities applied, sources reconciled, claims and payments repaired."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimforge import functions as fn
from claimforge.operators.upsert import upsert
from claimforge.plans.quality import Finding, details, events
from claimforge.plans.staging import Staging, accepted

c = F.col


@dataclass
class Core:
    customers: DataFrame
    policies: DataFrame
    claims: DataFrame
    payments: DataFrame
    premiums: DataFrame
    details: DataFrame
    line_items: DataFrame
    events: DataFrame | None = None
    identities: DataFrame | None = None


def valid_birth(x: str = "date_of_birth"):
    """Ages of 18 to 89 at the end of the extract."""
    return c(x).between("1936-07-01", "2008-06-30")


def evidence(s: Staging) -> DataFrame:
    """(claim_id, json_service_date, json_amount) from the documents' line items, in CAD."""
    sums = s.line_items.groupBy("stem").agg(F.min("service_date").alias("json_service_date"), F.sum("amount").alias("total"))
    rate = F.when(c("product_line") == "travel", c("exchange_rate_to_cad")).when(c("product_line").isNotNull(), F.lit(1).cast("decimal(10,4)"))
    return accepted(s.details).join(sums, "stem").select("claim_id", "json_service_date", F.round(c("total") * rate, 2).cast("decimal(12,2)").alias("json_amount"))


def reconciled_claims(s: Staging, policies: DataFrame) -> DataFrame:
    """Claims with the service date and the amount that the better source gives.

    A date must lie in the policy's term and not after the claim; the document's is taken where the
    header's does not. The document's amount, if positive, replaces one that is missing, not positive,
    or ten times off either way.
    """
    terms = policies.select("policy_id", "customer_id", "start_date", "end_date", "policy_type", "coverage_amount")
    header = accepted(s.claims).select(
        "claim_id", c("raw_row_id").alias("source_raw_row_id"), "policy_id", c("customer_id").alias("claim_customer_id"), "claim_type", c("service_date").alias("header_date"), "claim_date",
        c("claim_amount").alias("header_amount"), c("approved_amount").alias("header_approved"), "claim_status", "region",
    )
    joined = header.join(terms, "policy_id").join(evidence(s), "claim_id", "left")
    fits = lambda d: (c(d) >= c("start_date")) & (c("end_date").isNull() | (c(d) <= c("end_date"))) & (c(d) <= c("claim_date"))
    off = (c("header_amount") >= 10 * c("json_amount")) | (c("json_amount") >= 10 * c("header_amount"))
    replace = (c("json_amount") > 0) & (c("header_amount").isNull() | (c("header_amount") <= 0) | off)
    amount = F.when(replace, c("json_amount")).otherwise(c("header_amount"))
    sane = (c("header_approved") >= 0) & (c("claim_amount").isNull() | (c("header_approved") <= c("claim_amount")))
    return (
        joined.withColumn("service_date", F.when(fits("header_date"), c("header_date")).when(fits("json_service_date"), c("json_service_date")))
        .withColumn("claim_amount", F.when(amount > 0, amount))
        .withColumn("approved_amount", F.when(sane, c("header_approved")))
    )


def reconciled_payments(s: Staging, claims: DataFrame) -> DataFrame:
    """Accepted payments with their dates and states as far as they are possible, beside those given (``raw_``)."""
    joined = accepted(s.payments).drop("raw").join(claims.select("claim_id", "claim_date"), "claim_id")
    given = joined.withColumns({f"raw_{x}": c(x) for x in ("decision_date", "payment_date", "payment_status")})
    backwards = F.coalesce(c("decision_date") < c("processing_start_date"), F.lit(False))
    early = F.coalesce(c("payment_date") < c("claim_date"), F.lit(False)) | F.coalesce(c("payment_date") < c("decision_date"), F.lit(False))
    return (
        given.withColumn("decision_date", F.when(~backwards, c("decision_date"))).withColumn("payment_date", F.when(~early, c("payment_date")))
        .withColumn("payment_status", F.when(~F.coalesce((c("payment_status") == "paid") & c("payment_date").isNull(), F.lit(False)), c("payment_status")))
    )


def settled_payments(payments: DataFrame) -> DataFrame:
    """Reconciled payments with denied ones emptied; a denial without a reason and a payment without a method are left out."""
    denied = c("decision_outcome") == "denied"
    empty = lambda x: F.when(~denied, c(x)).alias(x)
    return payments.filter((denied & c("denial_reason").isNotNull()) | (~denied & c("payment_method").isNotNull())).select(
        "payment_id", c("raw_row_id").alias("source_raw_row_id"), "claim_id", "processing_start_date", "decision_date", "decision_outcome",
        F.when(denied, F.lit(0)).otherwise(c("payment_amount")).cast("decimal(12,2)").alias("payment_amount"),
        *(empty(x) for x in ("payment_date", "payment_method", "payment_status", "transaction_reference")), F.when(denied, c("denial_reason")).alias("denial_reason"),
    )


def changed(a: str, b: str) -> Column:
    return ~c(a).eqNullSafe(c(b))


def customer_repairs() -> list[Finding]:
    why = details(reason="DOB is outside the valid extract-end age range (18-89) and no authoritative alternate source exists", pii_value_redacted=True)
    return [Finding(c("raw_birth").isNotNull() & c("date_of_birth").isNull(), "CORE_DOB_NULLIFIED", "date_of_birth", "error", "repaired", details=why)]


def claim_repairs() -> list[Finding]:
    """What claims, with ``owner`` (whom the claim names), ``province`` and ``truth`` (its real status), were found to be."""
    source, cent = "Claim.csv + JSON", F.lit("0.01").cast("decimal(4,2)")
    date, amount = details(json_service_date=c("json_service_date")), details(json_claim_amount=c("json_amount"))
    both = (c("header_amount") > 0) & (c("json_amount") > 0) & (c("claim_amount") == c("header_amount"))
    off = details(difference_cad=F.round(c("header_amount") - c("json_amount"), 2), treatment="retain valid Claim.csv header amount; mismatch remains an analytical/fraud signal")
    differs = (c("service_date") != c("json_service_date")) & (c("header_date") == c("service_date"))
    authority = lambda x: details(authoritative_source=x)
    return [
        Finding(changed("service_date", "header_date") & c("service_date").isNotNull(), "CORE_SERVICE_DATE_REPAIRED", "service_date", "error", "repaired", c("header_date"), c("service_date"), date, source),
        Finding(c("service_date").isNull(), "CORE_SERVICE_DATE_UNRECOVERABLE", "service_date", "error", "flagged", c("header_date"), None, date, source),
        Finding(changed("claim_amount", "header_amount") & c("claim_amount").isNotNull(), "CORE_CLAIM_AMOUNT_REPAIRED", "claim_amount", "error", "repaired", c("header_amount"), c("claim_amount"), amount, source),
        Finding(c("claim_amount").isNull(), "CORE_CLAIM_AMOUNT_UNRECOVERABLE", "claim_amount", "error", "flagged", c("header_amount"), None, amount, source),
        Finding(both & (F.abs(c("header_amount") - c("json_amount")) > cent), "CORE_AMOUNT_RECON_MISMATCH", "claim_amount", "warning", "flagged", c("header_amount"), c("json_amount"), off, source),
        Finding(differs, "CORE_JSON_SERVICE_DATE_MISMATCH", "service_date", "warning", "flagged", c("service_date"), c("json_service_date"), details(treatment="claim remains canonical; mismatch retained for audit"), source),
        Finding(changed("owner", "customer_id"), "CORE_OWNER_CONFLICT", "customer_id", "warning", "repaired", c("claim_customer_id"), c("customer_id"), authority("Policy.csv.customer_id"), "Claim.csv vs Policy.csv"),
        Finding(changed("region", "province"), "CORE_REGION_CONFLICT", "region", "warning", "repaired", c("region"), c("province"), authority("Customer.csv.province"), "Claim.csv vs Customer.csv"),
        Finding(changed("claim_status", "truth"), "CORE_STATUS_CONFLICT", "claim_status", "warning", "repaired", c("claim_status"), c("truth"), authority("Claim_Payment.csv decision presence/outcome"), "Claim.csv vs Claim_Payment.csv"),
    ]


def payment_repairs() -> list[Finding]:
    treatment = F.when(c("raw_payment_status") == "paid", "set core payment_status to null because paid date is unusable").otherwise("unchanged")
    dates = details(claim_date=c("claim_date"), decision_date=c("decision_date"), payment_status_treatment=treatment)
    start = details(processing_start_date=c("processing_start_date"))
    authority = details(authoritative_source="Claim_Payment.csv.payment_amount")
    return [
        Finding(changed("header_approved", "payment_amount"), "CORE_PAYMENT_AMOUNT_CONFLICT", "payment_amount", "warning", "flagged", c("header_approved"), c("payment_amount"), authority, "Claim.csv vs Claim_Payment.csv"),
        Finding(c("raw_decision_date").isNotNull() & c("decision_date").isNull(), "CORE_DECISION_DATE_NULLIFIED", "decision_date", "error", "repaired", c("raw_decision_date"), None, start),
        Finding(c("raw_payment_date").isNotNull() & c("payment_date").isNull(), "CORE_PAYMENT_DATE_NULLIFIED", "payment_date", "error", "repaired", c("raw_payment_date"), None, dates, "Claim_Payment.csv + Claim.csv"),
    ]


def premium_repairs() -> list[Finding]:
    owner, basis = details(authoritative_source="Policy.csv.customer_id"), details(authoritative_basis="canonical DOB at premium due_date")
    return [
        Finding(changed("named", "customer_id"), "CORE_PREMIUM_OWNER_CONFLICT", "customer_id", "warning", "repaired", c("claimed_customer_id"), c("customer_id"), owner, "Policy_Premium.csv vs Policy.csv"),
        Finding(changed("given_band", "age_band"), "CORE_AGE_BAND_REPAIRED", "age_band", "warning", "repaired", c("given_band"), c("age_band"), basis, "Policy_Premium.csv + Customer.csv"),
    ]


def build(s: Staging, known: DataFrame | None = None) -> Core:
    """The canonical tables of one batch, without direct identifiers of persons, and the repairs' events.

    ``known`` are the identities of earlier batches; those of this batch come first.
    """
    hold = s.hold
    identities = s.identities
    survivors = identities.select("customer_id").distinct()
    if known is not None:
        identities = upsert(known.select("source_customer_id", "customer_id"), identities, ["source_customer_id"])
    identities = hold(identities)
    first = accepted(s.customers).join(survivors, "customer_id", "left_semi").withColumn("rank", F.row_number().over(Window.partitionBy("customer_id").orderBy("raw_row_id"))).filter("rank = 1")
    customers = hold(first.select(
        "customer_id", F.when(valid_birth(), c("date_of_birth")).alias("date_of_birth"), "gender", "province", "fsa", "customer_since", c("date_of_birth").alias("raw_birth"), c("raw_row_id").alias("source_raw_row_id")
    ))
    alias = identities.select(c("source_customer_id").alias("alias_id"), c("customer_id").alias("survivor_id"))
    policies = hold(
        accepted(s.policies).join(alias, c("customer_id") == c("alias_id"))
        .select("policy_id", c("survivor_id").alias("customer_id"), "policy_type", "plan_name", "coverage_type", "start_date", "end_date", "status", "sales_channel", "coverage_amount", "deductible_amount", c("raw_row_id").alias("source_raw_row_id"))
    )
    claims = hold(reconciled_claims(s, policies))
    reconciled = hold(reconciled_payments(s, claims))
    people = policies.join(customers, "customer_id").select("policy_id", c("customer_id").alias("owner"), "date_of_birth", "start_date")
    premiums = hold(
        accepted(s.premiums).drop("raw").join(people, "policy_id")
        .withColumn("derived_band", fn.age_band(fn.age_years(c("date_of_birth"), c("due_date"))))
        .select(
            "premium_id", "policy_id", c("owner").alias("customer_id"), c("customer_id").alias("claimed_customer_id"), "premium_amount", "premium_frequency", F.coalesce("derived_band", "age_band").alias("age_band"),
            c("age_band").alias("given_band"), "due_date", "paid_date", "payment_status", "payment_method", c("raw_row_id").alias("source_raw_row_id"),
        )
    )
    kept = hold(accepted(s.details).drop("adjuster_notes", "parent", "duplicate", "record_status"))
    whole = (c("line_no") > 0) & c("service_date").isNotNull() & c("description").isNotNull() & (c("quantity") > 0) & (c("unit_amount") > 0) & (c("amount") > 0)
    adds_up = F.abs(c("amount") - c("quantity") * c("unit_amount")) <= F.lit("0.01").cast("decimal(4,2)")
    lines = hold(s.line_items.join(kept.select("stem"), "stem", "left_semi").filter(whole & adds_up))
    named = lambda df, column, to: df.join(alias, c(column) == c("alias_id"), "left").withColumn(to, F.coalesce("survivor_id", column)).drop("alias_id", "survivor_id")
    truth = reconciled.select("claim_id", c("decision_outcome").alias("outcome"))
    seen = named(claims, "claim_customer_id", "owner").join(customers.select("customer_id", "province"), "customer_id", "left").join(truth, "claim_id", "left").withColumn("truth", F.coalesce("outcome", F.lit("pending")))
    paid = reconciled.join(claims.select("claim_id", "header_approved"), "claim_id")
    row = "source_raw_row_id"
    repairs = [
        events(customers, "customer", "customer_id", customer_repairs(), "staging.customers", row), events(seen, "claim", "claim_id", claim_repairs(), "staging.claims", row),
        events(paid, "payment", "payment_id", payment_repairs(), "staging.claim_payments"), events(named(premiums, "claimed_customer_id", "named"), "premium", "premium_id", premium_repairs(), "staging.policy_premiums", row),
    ]
    return Core(customers, policies, claims, settled_payments(reconciled), premiums, kept, lines, hold(reduce(DataFrame.unionByName, repairs)), identities)
