"""Typed rows with a status, the events of what was changed, and the identities of customers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimforge import functions as fn
from claimforge.operators.matching import Alike, best_alike
from claimforge.plans.quality import UNSERVED, quality_log, quarantine
from claimforge.sources.raw import EXTRACTS, read_documents, read_extract
from claimforge.sources.shared import Workspace

c = F.col

# Domains of the typed columns.
SERVED = ("SK", "AB", "MB", "ON", "BC", "NS", "PE", "NL", "YT", "NT")
PRODUCTS = ("health", "dental", "travel")
COVERAGES = ("single", "couple", "family")
POLICY_STATES = ("active", "lapsed", "cancelled", "expired")
CLAIM_TYPES = (
    "prescription_drugs", "health_practitioner", "vision", "hearing_aids", "medical_equipment", "ambulance", "hospital_cash", "preventive", "basic",
    "major", "emergency_medical", "trip_cancellation", "trip_interruption", "baggage",
)
OUTCOMES = ("approved", "partially_approved", "denied")
FREQUENCIES = ("monthly", "quarterly", "yearly", "single")
BANDS = ("Under 35", "35-44", "45-54", "55-64", "65-74", "75+")
PREMIUM_STATES = ("paid", "late", "missed")
# Plan names by type and coverage amount.
PLANS = {("health", 1500): "BasicPlan", ("health", 3000): "ExtendaPlan", ("health", 5000): "OmniPlan", ("health", 2000): "Replacement Health", ("dental", 1000): "Dental Basic", ("dental", 2000): "Dental Plus", ("travel", 5000000): "TravelStar", ("travel", 2000000): "StudentPlan"}
# Postal codes with the letters that they may have.
POSTAL = "^[ABCEGHJ-NPRSTVXY][0-9][ABCEGHJ-NPRSTV-Z] [0-9][ABCEGHJ-NPRSTV-Z][0-9]$"
# The way each extract writes dates.
DATES = {"Customer": "DMY", "Policy": "MDY", "Claim": "DMY", "Claim_Payment": "YYYYMMDD", "Policy_Premium": "MDY"}


@dataclass
class Staging:
    """The typed tables of one batch; every one has ``record_status`` accepted, rejected or duplicate."""

    customers: DataFrame
    policies: DataFrame
    claims: DataFrame
    payments: DataFrame
    premiums: DataFrame
    details: DataFrame
    line_items: DataFrame
    identities: DataFrame
    events: DataFrame
    quarantine: DataFrame
    hold: Workspace


def money(x: Column) -> Column:
    return F.round(fn.parse_amount(x), 2).cast("decimal(12,2)")


def typed(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every extract with its values normalised and typed."""
    ids = {"customer_id", "policy_id", "claim_id", "payment_id", "premium_id"}
    categories = {"policy_type", "coverage_type", "status", "sales_channel", "claim_type", "claim_status", "decision_outcome", "payment_method", "payment_status", "denial_reason", "premium_frequency"}
    dates = {"date_of_birth", "customer_since", "start_date", "end_date", "service_date", "claim_date", "processing_start_date", "decision_date", "payment_date", "due_date", "paid_date"}
    special = {
        "first_name": lambda x: fn.initcap_words(fn.clean_text(x)), "last_name": lambda x: fn.initcap_words(fn.clean_text(x)), "city": lambda x: fn.initcap_words(fn.clean_text(x)),
        "gender": fn.normalize_gender, "province": lambda x: F.coalesce(fn.normalize_province(x), fn.postal_province(c("postal_code"), c("city"))), "region": fn.normalize_province,
        "postal_code": fn.normalize_postal, "phone": fn.normalize_phone, "email": lambda x: F.lower(fn.clean_text(x)), "last_updated": fn.parse_timestamp,
    }
    out = {}
    for name, df in raw.items():
        pick = []
        for column in EXTRACTS[name]:
            x = c(column)
            made = (
                fn.normalize_id(x) if column in ids else fn.normalize_category(x) if column in categories else fn.parse_date(x, DATES[name]) if column in dates
                else money(x) if column.endswith("_amount") else special[column](x) if column in special else fn.clean_text(x)
            )
            pick.append(made.alias(column))
        out[name] = df.select("raw_row_id", *pick, F.struct(*EXTRACTS[name]).alias("raw"))
    out["Customer"] = out["Customer"].withColumn("fsa", F.left("postal_code", F.lit(3)))
    plan = reduce(lambda w, k: w.when((c("policy_type") == k[0]) & (c("coverage_amount") == k[1]), PLANS[k]), list(PLANS)[1:], F.when((c("policy_type") == "health") & (c("coverage_amount") == 1500), PLANS["health", 1500]))
    out["Policy"] = out["Policy"].withColumn("plan_name", F.coalesce("plan_name", plan))
    if "Policy_Premium" in out:
        status = F.when(c("paid_date").isNull() | c("due_date").isNull(), c("payment_status")).when(c("paid_date") <= c("due_date"), "paid").otherwise("late")
        out["Policy_Premium"] = out["Policy_Premium"].withColumn("payment_status", status)
    return out


def accepted(df: DataFrame) -> DataFrame:
    return df.filter("record_status = 'accepted'")


def not_in(column: str, values: tuple[str, ...]) -> Column:
    """SQL's NOT IN: a null value is unknown, and an unknown rule rejects nothing."""
    return ~c(column).isin(*values)


def any_of(*rules: Column) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, (F.coalesce(r, F.lit(False)) for r in rules)), F.lit(False))


def duplicates(df: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """Mark all but the first row of a key; exact ones repeat every raw value."""
    by_key, by_row = Window.partitionBy(key).orderBy("raw_row_id"), Window.partitionBy(*(c(f"raw.{x}") for x in columns)).orderBy("raw_row_id")
    later = c(key).isNotNull() & (F.row_number().over(by_key) > 1)
    return df.withColumn("duplicate", later).withColumn("exact", F.row_number().over(by_row) > 1)


def with_parent(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Add ``parent``: the status of the parent row, null for an orphan; accepted rows come first."""
    best = parents.groupBy(key).agg(F.min("record_status").alias("parent"))
    return df.join(best, key, "left")


def status(bad: Column) -> Column:
    return F.when(c("duplicate"), "duplicate").when(bad, "rejected").otherwise("accepted")


def identities(customers: DataFrame) -> DataFrame:
    """(source_customer_id, customer_id, source_row, same_birth): accepted customers and the best record of the same person.

    The same person has equal names and postal code, and an equal birth date or an equal address and
    contact with different birth dates of which just one is valid. Best is by validity of the birth date with unknown
    first, number of known fields, last update and row order. Validity follows from the birth date, so rows that
    differ in it differ in the date; each rule is a least value for each of its keys, and no pairs are made.
    """
    valid = c("date_of_birth").between("1936-07-01", "2008-06-30")
    score = sum(c(x).isNotNull().cast("int") for x in ("date_of_birth", "province", "phone", "email"))
    base = accepted(customers).select(
        "customer_id", "raw_row_id", F.lower("first_name").alias("first"), F.lower("last_name").alias("last"), F.replace("postal_code", F.lit(" "), F.lit("")).alias("post"),
        "date_of_birth", F.lower("address").alias("address"), F.lower("city").alias("city"), "email", "phone", "last_updated", valid.alias("valid"), score.alias("score"),
    )
    unknown_first = F.when(c("valid").isNull(), 0).when(c("valid"), 1).otherwise(2)
    order = F.struct(
        unknown_first.alias("validity"), (-c("score")).alias("score"), c("last_updated").isNull().alias("no_update"), (-F.unix_micros("last_updated")).alias("updated"),
        c("raw_row_id").alias("row"), c("customer_id").alias("survivor"), c("date_of_birth").alias("born"),
    )
    person = ("first", "last", "post")
    rules = [Alike((*person, "date_of_birth")), *(Alike((*person, "address", "city", contact), differ="valid") for contact in ("email", "phone"))]
    best = best_alike(base, order, rules, "best").groupBy("customer_id").agg(F.min(F.struct("best", "raw_row_id", "date_of_birth")).alias("found"))
    return best.select(
        c("customer_id").alias("source_customer_id"), c("found.best.survivor").alias("customer_id"), c("found.raw_row_id").alias("source_row"),
        c("found.date_of_birth").eqNullSafe(c("found.best.born")).alias("same_birth"),
    )


def documents(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Claim details and their line items from parsed documents; drifted keys and shapes are understood."""
    parsed = files.filter("payload is not null")
    at = lambda path: F.try_variant_get("payload", f"$.{path}", "string")
    claim = fn.normalize_id(F.coalesce(at("claim_id"), at("ClaimID")))
    category, text, number = fn.normalize_category, fn.clean_text, fn.parse_integer
    details = parsed.select(
        "stem", claim.alias("claim_id"), text(at("schema_version")).alias("schema_version"), category(at("product_line")).alias("product_line"), category(at("submission_channel")).alias("submission_channel"),
        fn.parse_timestamp(at("submitted_at")).alias("submitted_at"), fn.normalize_id(at("provider.provider_id")).alias("provider_id"), text(at("provider.name")).alias("provider_name"),
        category(at("provider.type")).alias("provider_type"), fn.normalize_id(at("adjuster_id")).alias("adjuster_id"), text(at("adjuster_notes")).alias("adjuster_notes"),
        fn.text_array(F.try_variant_get("payload", "$.documents_submitted", "variant")).alias("documents_submitted"),
        category(at("health.practitioner_type")).alias("practitioner_type"), number(at("health.number_of_visits")).alias("number_of_visits"), text(at("health.prescription.din")).alias("din"),
        text(at("health.prescription.drug_name")).alias("drug_name"), number(at("health.prescription.days_supply")).alias("days_supply"), fn.parse_boolean(at("health.prescription.is_generic")).alias("is_generic"),
        category(at("dental.claim_category")).alias("dental_claim_category"), fn.parse_date(at("travel.trip_start")).alias("trip_start"), fn.parse_date(at("travel.trip_end")).alias("trip_end"),
        F.upper(text(at("travel.destination_country"))).alias("destination_country"), category(at("travel.incident_type")).alias("incident_type"), fn.parse_date(at("travel.incident_date")).alias("incident_date"),
        F.upper(text(at("travel.currency"))).alias("currency"), fn.parse_amount(at("travel.exchange_rate_to_cad")).cast("decimal(10,4)").alias("exchange_rate_to_cad"), money(at("travel.incident_sub_limit")).alias("incident_sub_limit"),
    )
    found = F.coalesce(F.try_variant_get("payload", "$.line_items", "variant"), F.try_variant_get("payload", "$.lineItems", "variant"))
    kind = F.schema_of_variant(found)
    items = F.when(kind.startswith("ARRAY"), found.try_cast("array<variant>")).when(kind.startswith("OBJECT"), F.array(found))
    of = lambda path: F.try_variant_get("item", f"$.{path}", "string")
    lines = parsed.select("stem", claim.alias("claim_id"), F.posexplode(items).alias("source_array_index", "item")).select(
        "stem", "claim_id", "source_array_index", number(of("line_no")).alias("line_no"), fn.parse_date(of("service_date")).alias("service_date"), text(of("description")).alias("description"),
        number(of("quantity")).alias("quantity"), money(of("unit_amount")).alias("unit_amount"), money(of("amount")).alias("amount"), text(of("procedure_code")).alias("procedure_code"),
        category(of("procedure_category")).alias("procedure_category"), number(of("tooth_number")).alias("tooth_number"),
    )
    return details, lines


def stage(spark: SparkSession, folder: str, premiums: bool = True, hold: Workspace | None = None) -> Staging:
    """Read and type a batch. Without the premium extract (``premiums=False``) that table is empty."""
    hold = hold or Workspace(spark)
    names = [n for n in EXTRACTS if premiums or n != "Policy_Premium"]
    raw = {n: read_extract(spark, folder, n) for n in names}
    if not premiums:
        raw["Policy_Premium"] = spark.createDataFrame([], ", ".join(f"{x} string" for x in EXTRACTS["Policy_Premium"]) + ", raw_row_id long")
    t = typed(raw)
    files = hold(read_documents(spark, folder).drop("payload")).withColumn("payload", F.try_parse_json("raw_text")).withColumn("malformed", c("payload").isNull())

    missing = reduce(lambda a, b: a | b, (c(x).isNull() for x in ("first_name", "last_name", "address", "city", "province", "postal_code", "customer_since", "last_updated")))
    postal = ~c("postal_code").rlike(POSTAL)
    bad = any_of(c("customer_id").isNull(), ~c("customer_id").rlike(r"^C\d{5}$"), missing, c("province").isin(*UNSERVED), postal)
    customers = hold(t["Customer"].withColumn("record_status", F.when(bad, "rejected").otherwise("accepted")))
    people = hold(identities(customers))

    known = people.select(c("source_customer_id").alias("customer_id"), F.lit("accepted").alias("record_status"))
    every = customers.select("customer_id", "record_status").unionByName(known)
    policies = with_parent(t["Policy"].withColumn("duplicate", F.lit(False)), every, "customer_id")
    own = any_of(
        c("policy_id").isNull(), ~c("policy_id").rlike(r"^P\d{5}$"), c("customer_id").isNull(), not_in("policy_type", PRODUCTS), not_in("coverage_type", COVERAGES), not_in("status", POLICY_STATES),
        c("start_date").isNull(), c("end_date") < c("start_date"), c("coverage_amount").isNull() | (c("coverage_amount") <= 0), c("deductible_amount").isNull() | (c("deductible_amount") < 0),
    )
    orphan = F.coalesce(c("parent") != "accepted", F.lit(True))
    policies = hold(policies.withColumn("record_status", status(own | orphan)))

    claims = with_parent(duplicates(t["Claim"], "claim_id", EXTRACTS["Claim"]), policies, "policy_id")
    own = any_of(c("claim_id").isNull(), ~c("claim_id").rlike(r"^[HDT]\d{5}$"), c("policy_id").isNull(), not_in("claim_type", CLAIM_TYPES), c("claim_date").isNull())
    claims = hold(claims.withColumn("record_status", status(own | orphan)))

    payments = with_parent(duplicates(t["Claim_Payment"], "payment_id", EXTRACTS["Claim_Payment"]), claims, "claim_id")
    own = any_of(c("payment_id").isNull(), ~c("payment_id").rlike(r"^PAY\d{5}$"), c("claim_id").isNull(), not_in("decision_outcome", OUTCOMES), c("payment_amount").isNull() | (c("payment_amount") < 0))
    payments = hold(payments.withColumn("record_status", status(own | orphan)))

    prem = with_parent(duplicates(t["Policy_Premium"], "premium_id", EXTRACTS["Policy_Premium"]), policies, "policy_id")
    own = any_of(
        c("premium_id").isNull(), ~c("premium_id").rlike(r"^PRM\d{6}$"), c("policy_id").isNull(), c("due_date").isNull(), c("premium_amount").isNull() | (c("premium_amount") <= 0), not_in("premium_frequency", FREQUENCIES),
        not_in("age_band", BANDS), not_in("payment_status", PREMIUM_STATES), c("payment_status").isin("paid", "late") & c("paid_date").isNull(), (c("payment_status") == "missed") & c("paid_date").isNotNull(),
    )
    prem = hold(prem.withColumn("record_status", status(own | orphan)))

    details, lines = documents(files)
    lines = hold(lines)
    details = with_parent(details.withColumn("duplicate", F.lit(False)), claims, "claim_id")
    own = any_of(c("claim_id").isNull(), ~c("claim_id").rlike(r"^[HDT]\d{5}$"), not_in("product_line", PRODUCTS), c("submitted_at").isNull(), c("provider_id").isNull(), c("provider_name").isNull())
    details = hold(details.withColumn("record_status", status(own | orphan)))

    log = hold(quality_log(customers, policies, claims, payments, prem, details, people, files))
    return Staging(customers, policies, claims, payments, prem, details, lines, people.select("source_customer_id", "customer_id"), log, quarantine(log), hold)
