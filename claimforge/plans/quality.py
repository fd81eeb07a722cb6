"""The quality log: what was changed, found wrong, deduplicated or rejected in a batch.

Every table has a list of findings; a row's findings are one array that is taken apart once, so a table is
read once for all its rules.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimforge import functions as fn
from claimforge.operators.drift import Field, audit

c = F.col

# The file and the raw table of each entity's source.
SOURCES = {
    "customer": ("Customer.csv", "raw.customer_csv"),
    "policy": ("Policy.csv", "raw.policy_csv"),
    "claim": ("Claim.csv", "raw.claim_csv"),
    "payment": ("Claim_Payment.csv", "raw.claim_payment_csv"),
    "premium": ("Policy_Premium.csv", "raw.policy_premium_csv"),
    "claim_detail": (None, "raw.claim_detail_files"),
}
# The fields whose changes are logged, by entity and rule.
FORMATS = {
    "customer": {
        "FMT_DATE": ("date_of_birth", "customer_since"),
        "FMT_GENDER": ("gender",),
        "FMT_PROVINCE": ("province",),
        "FMT_POSTAL": ("postal_code",),
        "FMT_PHONE": ("phone",),
        "FMT_TEXT_WHITESPACE": ("first_name", "last_name", "city", "email"),
    },
    "policy": {
        "FMT_ID": ("customer_id",),
        "FMT_CATEGORY_CASE": ("policy_type", "coverage_type", "status", "sales_channel"),
        "FMT_DATE": ("start_date", "end_date"),
        "TYPE_AMOUNT_TEXT": ("coverage_amount", "deductible_amount"),
        "MISS_ERROR": ("plan_name",),
    },
    "claim": {
        "FMT_ID": ("claim_id", "policy_id", "customer_id"),
        "FMT_CATEGORY_CASE": ("claim_type", "claim_status"),
        "FMT_PROVINCE": ("region",),
        "FMT_DATE": ("service_date", "claim_date"),
        "TYPE_AMOUNT_TEXT": ("claim_amount", "approved_amount"),
    },
    "payment": {
        "FMT_ID": ("claim_id",),
        "FMT_DATE": ("processing_start_date", "decision_date", "payment_date"),
        "FMT_CATEGORY_CASE": ("decision_outcome", "payment_method", "payment_status"),
        "TYPE_AMOUNT_TEXT": ("payment_amount",),
    },
    "premium": {
        "FMT_ID": ("policy_id", "customer_id"),
        "TYPE_AMOUNT_TEXT": ("premium_amount",),
        "FMT_CATEGORY_CASE": ("premium_frequency", "payment_status", "payment_method"),
        "FMT_DATE": ("due_date", "paid_date"),
    },
}
# What a claim's document must look like, and what of other shapes is understood.
DOCUMENT = [
    Field("claim_id", legacy=("ClaimID",)),
    Field("line_items", "array", drifted=("object",), legacy=("lineItems",)),
    Field("documents_submitted", "array", drifted=("string",), required="error"),
    Field("submission_channel", required="error"),
    Field("provider.type", required="error"),
    Field("adjuster_id", required="warning"),
    Field("line_items[*].amount", "number", drifted=("string",)),
    Field("line_items[*].unit_amount", "number", drifted=("string",)),
    Field("travel.exchange_rate_to_cad", "number", drifted=("string",)),
]
UNSERVED = ("QC", "NB", "NU")
# The columns of the log.
COLUMNS = ("entity", "source_name", "source_table", "source_record_id", "business_key", "rule_id", "field_name", "severity", "action", "original_value", "clean_value", "details")


@dataclass
class Finding:
    """An event of every row for which ``when`` holds.

    ``original`` and ``clean`` default to the field's raw and typed value, where the table has a raw one; ``source`` to the entity's file.
    """

    when: Column
    rule: str | Column
    field: str | None
    severity: str
    action: str | Column
    original: Column | None = None
    clean: Column | None = None
    details: Column | None = None
    source: str | None = None


def details(**values: Column | str) -> Column:
    """A JSON object of the values; a null is a null there."""
    return F.to_json(F.struct(*((x if isinstance(x, Column) else F.lit(x)).alias(k) for k, x in values.items())), {"ignoreNullFields": "false"})


def events(df: DataFrame, entity: str, key: str, findings: list[Finding], table: str | None = None, row: str = "raw_row_id") -> DataFrame:
    """The events of ``df`` with their sources and rows: one array a row, taken apart once."""
    name, raw_table = SOURCES[entity]
    file = F.concat("stem", F.lit(".json")) if name is None and "stem" in df.columns else F.lit(name)
    raw = set(df.schema["raw"].dataType.names) if "raw" in df.columns else set()

    def text(given: Column | None, default: str | None) -> Column:
        return (F.lit(None) if given is None and default is None else c(default) if given is None else given).cast("string")

    def struct(f: Finding) -> Column:
        held = f.field if f.field in raw else None
        return F.struct(
            (F.lit(f.source) if f.source else file).alias("source_name"),
            (F.lit(f.rule) if isinstance(f.rule, str) else f.rule).alias("rule_id"),
            F.lit(f.field).cast("string").alias("field_name"),
            F.lit(f.severity).alias("severity"),
            (F.lit(f.action) if isinstance(f.action, str) else f.action).alias("action"),
            text(f.original, held and f"raw.{held}").alias("original_value"),
            text(f.clean, held).alias("clean_value"),
            text(f.details, None).alias("details"),
        )

    found = F.array_compact(F.array(*(F.when(f.when, struct(f)) for f in findings)))
    own = (c(row) if row in df.columns else F.lit(None)).cast("long")
    out = df.select(F.lit(entity).alias("entity"), F.lit(table or raw_table).alias("source_table"), own.alias("source_record_id"), c(key).alias("business_key"), F.inline(found))
    return out.select(*COLUMNS)


def formats(entity: str) -> list[Finding]:
    """A finding for each field whose raw text is not its typed value, a value that only one of them has included."""
    out = []
    for rule, fields in FORMATS[entity].items():
        for field in fields:
            raw, clean = c(f"raw.{field}"), c(field).cast("string")
            filled = raw.isNull() & clean.isNotNull()
            changed = ~raw.eqNullSafe(clean)
            action: Column | str = "normalized"
            if rule == "MISS_ERROR":
                action = F.when(filled, "repaired").otherwise("flagged")
            elif (entity, field) == ("customer", "province"):
                action = F.when(filled, "repaired").otherwise("normalized")
            if (entity, field) == ("premium", "payment_status"):
                derived = ~fn.normalize_category(raw).eqNullSafe(clean)
                out.append(Finding(changed & derived, "INV_DERIVED_STATUS", field, "warning", "repaired"))
                changed &= ~derived
            out.append(Finding(changed, rule, field, "info", action))
    return out


def customer_findings() -> list[Finding]:
    born, province = c("date_of_birth"), c("province")
    had_birth, had_province = c("raw.date_of_birth").isNotNull(), c("raw.province").isNotNull()
    odd = (born == F.lit("1900-01-01").cast("date")) | (born > F.lit("2026-06-30").cast("date"))
    return [
        Finding(~had_birth, "MISS_ERROR", "date_of_birth", "error", "flagged", details=details(reason="required source DOB is missing")),
        Finding(had_birth & born.isNull(), "PARSE_DATE", "date_of_birth", "error", "flagged", details=details(reason="DOB could not be parsed using the declared source conventions")),
        Finding(odd, "INV_AGE", "date_of_birth", "error", "flagged", details=details(reason="sentinel or future DOB")),
        Finding(province.isin(*UNSERVED), "INV_UNSERVED_PROVINCE", "province", "error", "quarantined", details=details(reason="province is outside the served-province domain")),
        Finding(~had_province, "MISS_ERROR", "province", "error", F.when(province.isNotNull(), "repaired").otherwise("flagged"), details=details(recovered_from_postal_code=province.isNotNull())),
    ]


def rejection(own: str, parent: str, dates: tuple[str, str] | None = None) -> Finding:
    """Why a row was rejected: an orphan, a rejected parent, the order of its dates, or its own values."""
    reason = F.when(c("parent").isNull(), "ORPHAN_FK").when(c("parent") != "accepted", "UPSTREAM_PARENT_REJECTED")
    if dates:
        reason = reason.when(c(dates[1]) < c(dates[0]), "INV_DATE_ORDER")
    return Finding(c("record_status") == "rejected", reason.otherwise(own), None, "error", "quarantined", details=details(**{parent: c(parent)}))


def missing(field: str, **why: str) -> Finding:
    return Finding((c("record_status") == "accepted") & c(field).isNull(), "MISS_ERROR", field, "error", "flagged", F.lit(None), F.lit(None), details(**why))


def duplicate(field: str, rule: Column | str, note: Column | None = None) -> Finding:
    return Finding(c("duplicate"), rule, field, "warning", "deduplicated", F.lit(None), F.lit(None), note)


def quality_log(customers: DataFrame, policies: DataFrame, claims: DataFrame, payments: DataFrame, premiums: DataFrame, claim_details: DataFrame, people: DataFrame, files: DataFrame) -> DataFrame:
    """All events of a batch's typed tables and documents; ``people`` are the identities with the way they were found."""
    treated = details(processing_start_date=c("processing_start_date"), decision_date=c("decision_date"), core_treatment="retain decision row and null invalid decision_date")
    late = (c("record_status") == "accepted") & (c("decision_date") < c("processing_start_date"))
    document = F.when(c("claim_id").isNotNull() & c("parent").isNull(), "JSON_ORPHAN").when(c("claim_id").isNotNull() & (c("parent") != "accepted"), "UPSTREAM_PARENT_REJECTED").otherwise("JSON_INVALID_REQUIRED")
    alias = details(survivor_customer_id=c("customer_id"), resolution=F.when(c("same_birth"), "normalized_identity_key").otherwise("high_confidence_match_with_invalid_dob"))
    claim = fn.normalize_id(F.coalesce(F.try_variant_get("payload", "$.claim_id", "string"), F.try_variant_get("payload", "$.ClaimID", "string")))
    well_formed = claims.filter(c("claim_id").rlike(r"^[HDT]\d{5}$")).groupBy("claim_id").agg(F.min("raw_row_id").alias("raw_row_id"))
    absent = well_formed.join(files.select(fn.normalize_id(c("stem")).alias("claim_id")), "claim_id", "left_anti")
    drift = audit(files.select(F.concat("stem", F.lit(".json")).alias("source_name"), claim.alias("business_key"), "payload"), "payload", DOCUMENT)
    parts = [
        events(customers, "customer", "customer_id", formats("customer") + customer_findings()),
        events(people, "customer", "source_customer_id", [Finding(c("source_customer_id") != c("customer_id"), "DUP_ENTITY", "customer_id", "warning", "deduplicated", c("source_customer_id"), c("customer_id"), alias)], row="source_row"),
        events(policies, "policy", "policy_id", [*formats("policy"), rejection("INVALID_REQUIRED", "customer_id", ("start_date", "end_date"))]),
        events(claims, "claim", "claim_id", [
            *formats("claim"), duplicate("claim_id", F.when(c("exact"), "DUP_EXACT").otherwise("DUP_NEAR_KEY"), details(normalized_claim_id=c("claim_id"))), rejection("INVALID_REQUIRED", "policy_id"),
            missing("service_date", repair_candidate="JSON min(line_items.service_date)"), missing("claim_amount", repair_candidate="JSON reconciled line-item total"),
        ]),
        events(payments, "payment", "payment_id", [
            *formats("payment"), duplicate("payment_id", "DUP_EXACT"), rejection("INVALID_REQUIRED", "claim_id", ("processing_start_date", "decision_date")),
            missing("decision_date", reason="decided payment row is missing decision_date"), Finding(late, "INV_DATE_ORDER", "decision_date", "error", "flagged", clean=F.lit(None), details=treated),
        ]),
        events(premiums, "premium", "premium_id", [*formats("premium"), duplicate("premium_id", "DUP_EXACT"), rejection("INVALID_REQUIRED", "policy_id")]),
        events(claim_details, "claim_detail", "claim_id", [Finding(c("record_status") == "rejected", document, None, "error", "quarantined", details=details(claim_id=c("claim_id")))]),
        events(files.drop("payload"), "claim_detail", "stem", [Finding(c("malformed"), "JSON_MALFORMED", None, "error", "quarantined", F.left("raw_text", F.lit(500)), details=details(parse_error="not valid JSON"))]),
        events(absent, "claim_detail", "claim_id", [Finding(F.lit(True), "JSON_MISSING_FILE", None, "warning", "flagged", details=details(reason="no physical JSON file exists for the claim"), source="Claim.csv / JSON directory")], "staging.claims"),
    ]
    parts.append(drift.withColumns({"entity": F.lit("claim_detail"), "source_table": F.lit(SOURCES["claim_detail"][1]), "source_record_id": F.lit(None).cast("long")}).select(*COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def quarantine(log: DataFrame) -> DataFrame:
    """The rejected rows of a log, once for each rule."""
    reason = F.when(c("rule_id") == "JSON_MALFORMED", "JSON could not be parsed").otherwise("Rejected during staging validation")
    return log.filter("action = 'quarantined'").select("source_name", "source_table", "source_record_id", "business_key", "rule_id", reason.alias("reason"), "details").distinct()
