"""What the canonical tables must satisfy; a batch that breaks any of it is not published.

Row checks are SQL conditions, counted while a table is written. A check is broken where it is false; unknown is not broken.
"""

from __future__ import annotations

from claimforge.plans.staging import BANDS, CLAIM_TYPES, COVERAGES, FREQUENCIES, OUTCOMES, PLANS, POLICY_STATES, PREMIUM_STATES, PRODUCTS, SERVED
from claimforge.sources.layers import Constraints

# Domains that only the canonical tables have.
CHANNELS = ("online", "broker", "call_centre")
SUBMISSIONS = ("online_portal", "mobile_app", "provider_direct_billing", "mail")
PAYMENT_METHODS, PAYMENT_STATES = ("direct_deposit", "cheque", "provider_direct"), ("paid", "scheduled")
PREMIUM_METHODS = ("pad", "credit_card", "cheque")
DENIALS = ("not_covered", "waiting_period", "benefit_maximum_reached", "missing_documentation", "policy_inactive", "late_submission", "duplicate_claim")
PROCEDURES = ("preventive", "basic", "major")
FSA = "^[ABCEGHJ-NPRSTVXY][0-9][ABCEGHJ-NPRSTV-Z]$"


def present(*columns: str) -> dict[str, str]:
    return {f"{x} is known": f"{x} is not null" for x in columns}


def among(**domains: tuple[str, ...]) -> dict[str, str]:
    return {f"{x} is in its domain": f"{x} in ({', '.join(repr(v) for v in values)})" for x, values in domains.items()}


def matching(**patterns: str) -> dict[str, str]:
    return {f"{x} has its form": f"{x} rlike '{p}'" for x, p in patterns.items()}


ROWS = {
    "customers": {
        **matching(customer_id="^C[0-9]{5}$", fsa=FSA),
        **among(gender=("F", "M", "X"), province=SERVED),
        **present("customer_id", "province", "customer_since"),
    },
    "policies": {
        **matching(policy_id="^P[0-9]{5}$"),
        **present("policy_id", "customer_id", "policy_type", "coverage_type", "start_date", "status", "coverage_amount", "deductible_amount"),
        **among(policy_type=PRODUCTS, plan_name=tuple(PLANS.values()), coverage_type=COVERAGES, status=POLICY_STATES, sales_channel=CHANNELS),
        "policies end after they start": "end_date >= start_date",
        "coverage is positive": "coverage_amount > 0",
        "deductible is not negative": "deductible_amount >= 0",
    },
    "claims": {
        **matching(claim_id="^[HDT][0-9]{5}$"),
        **present("claim_id", "policy_id", "claim_type", "claim_date"),
        **among(claim_type=CLAIM_TYPES),
        "service is not after the claim": "service_date <= claim_date",
        "amounts of claims are positive": "claim_amount > 0",
        "approved amounts are within the claim's": "approved_amount >= 0 and (claim_amount is null or approved_amount <= claim_amount)",
    },
    "payments": {
        **matching(payment_id="^PAY[0-9]{5}$"),
        **present("payment_id", "claim_id", "decision_outcome", "payment_amount"),
        **among(decision_outcome=OUTCOMES, payment_method=PAYMENT_METHODS, payment_status=PAYMENT_STATES, denial_reason=DENIALS),
        "amounts of payments are not negative": "payment_amount >= 0",
        "decisions follow the start": "decision_date >= processing_start_date",
        "payments follow decisions": "payment_date >= decision_date",
        "denied payments are empty": "decision_outcome <> 'denied' or (payment_amount = 0 and coalesce(payment_date::string, payment_method, payment_status, transaction_reference) is null and denial_reason is not null)",
        "others have a method": "decision_outcome = 'denied' or payment_method is not null",
        "paid ones have date and reference": "payment_status is distinct from 'paid' or (payment_date is not null and transaction_reference is not null)",
        "scheduled ones have neither": "payment_status is distinct from 'scheduled' or (payment_date is null and transaction_reference is null)",
    },
    "premiums": {
        **matching(premium_id="^PRM[0-9]{6}$"),
        **present("premium_id", "policy_id", "premium_amount", "premium_frequency", "age_band", "due_date", "payment_status"),
        **among(premium_frequency=FREQUENCIES, age_band=BANDS, payment_status=PREMIUM_STATES, payment_method=PREMIUM_METHODS),
        "premiums are positive": "premium_amount > 0",
        "paid ones are paid in time": "payment_status <> 'paid' or (paid_date is not null and paid_date <= due_date)",
        "late ones are paid late": "payment_status <> 'late' or (paid_date is not null and paid_date > due_date)",
        "missed ones are not paid": "payment_status <> 'missed' or (paid_date is null and payment_method is null)",
    },
    "details": {
        **matching(adjuster_id="^ADJ[0-9]{3}$", provider_id="^PRV[0-9]{4}$"),
        **present("claim_id", "product_line", "submitted_at", "provider_id", "provider_name"),
        **among(product_line=PRODUCTS, submission_channel=SUBMISSIONS),
        "visits are positive": "number_of_visits >= 1",
        "supplies last 1 to 90 days": "days_supply between 1 and 90",
        "trips end after they start": "trip_end >= trip_start",
        "rates are positive": "exchange_rate_to_cad > 0",
        "sub-limits are positive": "incident_sub_limit > 0",
    },
    "line_items": {
        **present("claim_id", "line_no", "service_date", "description", "quantity", "unit_amount", "amount"),
        **matching(procedure_code="^[0-9]{5}$"),
        **among(procedure_category=PROCEDURES),
        "line numbers are positive": "line_no > 0",
        "quantities are positive": "quantity > 0",
        "unit amounts are positive": "unit_amount > 0",
        "line amounts are positive": "amount > 0",
        "lines add up": "abs(amount - quantity * unit_amount) <= 0.01",
        "teeth exist": "tooth_number div 10 between 1 and 4 and tooth_number % 10 between 1 and 8",
    },
}

CONSTRAINTS = Constraints(
    ROWS,
    unique={
        "customers": [("customer_id",)],
        "policies": [("policy_id",)],
        "claims": [("claim_id",)],
        "payments": [("payment_id",), ("claim_id",), ("transaction_reference",)],
        "premiums": [("premium_id",)],
        "details": [("claim_id",)],
        "line_items": [("claim_id", "line_no")],
        "identities": [("source_customer_id",)],
    },
    references=[
        ("policies", "customers", "customer_id"),
        ("claims", "policies", "policy_id"),
        ("payments", "claims", "claim_id"),
        ("premiums", "policies", "policy_id"),
        ("details", "claims", "claim_id"),
        ("line_items", "claims", "claim_id"),
    ],
)
