"""A small batch, made by hand, through all layers."""

import csv
import json

import pytest

from claimforge.plans import core, pipeline, staging
from claimforge.sources.raw import EXTRACTS

ROWS = {
    "Customer": [
        ["C00001", "mona ", "TREMBLE", "1971-02-14", "Female", "1 Main St", "regina", "Sask.", "s4p3y2", "(306) 555-0142", "E@X.CA", "2014-05-06", "2024-09-02T00:00:00-06:00"],
        ["C00002", "Mona", "Tremble", "14/02/1971", "F", "1 Main St", "Regina", "", "S4P 3Y2", "", "", "2016-01-01", "2023-01-01T00:00:00-06:00"],
        ["C00003", "Luc", "Roy", "1990-01-01", "M", "2 Rue A", "Montreal", "QC", "H2X 1Y4", "", "", "2019-01-01", "2024-01-01T00:00:00-06:00"],
        ["C00004", "Ann", "St. john", "", "X", "3 Elm", "Calgary", "AB", "T2P 1A1", "", "", "2020-02-02", "2024-01-01T00:00:00-06:00"],
    ],
    "Policy": [
        ["P00001", "C00002", "Health", "", "single", "01/15/2024", "", "Active", "online", "$1,500.00", "0"],
        ["P00002", "C00003", "health", "BasicPlan", "single", "2024-01-01", "", "active", "broker", "1500", "0"],
        ["P00003", "C00004", "dental", "Dental Basic", "family", "2025-01-01", "2026-05-01", "lapsed", "broker", "1000.00", "50"],
        ["P00004", "C00004", "travel", "TravelStar", "single", "2025-05-01", "2025-04-01", "active", "broker", "5000000", "0"],
    ],
    "Claim": [
        ["H00001", "P00001", "C00001", "vision", "2024-02-01", "10/02/2024", "100.00", "90.00", "approved", "SK"],
        ["H00001", "P00001", "C00001", "vision", "2024-02-01", "10/02/2024", "100.00", "90.00", "approved", "SK"],
        ["D00001", "P00003", "C00004", "basic", "", "2025-03-01", "2000", "", "pending", "AB"],
        ["H00002", "P00002", "C00003", "vision", "2024-02-01", "2024-02-03", "50", "", "pending", "QC"],
        ["H00009", "P99999", "C00001", "vision", "2024-02-01", "2024-02-03", "50", "", "pending", "SK"],
    ],
    "Claim_Payment": [
        ["PAY00001", "H00001", "20240212", "20240214", "approved", "20240216", "90.00", "direct_deposit", "paid", "TX1", ""],
        ["PAY00002", "H00009", "20240212", "20240214", "denied", "", "0", "", "", "", "not_covered"],
    ],
    "Policy_Premium": [
        ["PRM000001", "P00003", "C00004", "50.00", "monthly", "35-44", "2026-01-01", "2026-01-05", "late", "credit_card"],
        ["PRM000002", "P00003", "C00004", "60.00", "monthly", "45-54", "2026-02-01", "", "missed", ""],
        ["PRM000003", "P00001", "C00001", "40.00", "monthly", "35-44", "2026-03-20", "", "missed", ""],
    ],
}
DOCUMENTS = {
    "H00001": {"claim_id": "H00001", "product_line": "health", "submission_channel": "online_portal", "submitted_at": "2024-02-10T12:00:00-06:00", "provider": {"provider_id": "PRV0001", "name": "A", "type": "optometrist"}, "adjuster_id": "ADJ001", "documents_submitted": ["receipt"], "line_items": [{"line_no": 1, "service_date": "2024-02-01", "description": "glasses", "quantity": 2, "unit_amount": 50, "amount": "100.00"}], "health": {}},
    "D00001": {"ClaimID": "D00001", "product_line": "dental", "submitted_at": "2025-03-02T02:00:00-06:00", "provider": {"provider_id": "PRV0001", "name": "A", "type": "dentist"}, "documents_submitted": "receipt", "lineItems": {"line_no": 1, "service_date": "2025-02-20", "description": "filling", "quantity": 1, "unit_amount": 200, "amount": 200}, "dental": {"claim_category": "basic"}},
}


@pytest.fixture(scope="module")
def batch(tmp_path_factory):
    folder = tmp_path_factory.mktemp("batch")
    for name, rows in ROWS.items():
        with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8-sig") as f:
            csv.writer(f).writerows([EXTRACTS[name], *rows])
    (folder / "json").mkdir()
    for name, doc in DOCUMENTS.items():
        (folder / "json" / f"{name}.json").write_text(json.dumps(doc))
    (folder / "json" / "H00005.json").write_text('{"claim_id": "H00005",')
    return str(folder)


def test_layers(spark, batch):
    s = staging.stage(spark, batch)
    status = lambda df, key: {r[0]: r[1] for r in df.select(key, "record_status").filter("record_status <> 'duplicate'").collect()}
    assert status(s.customers, "customer_id") == {"C00001": "accepted", "C00002": "accepted", "C00003": "rejected", "C00004": "accepted"}
    assert status(s.policies, "policy_id") == {"P00001": "accepted", "P00002": "rejected", "P00003": "accepted", "P00004": "rejected"}
    assert status(s.claims, "claim_id") == {"H00001": "accepted", "D00001": "accepted", "H00002": "rejected", "H00009": "rejected"}
    assert {tuple(r) for r in s.identities.collect()} == {("C00001", "C00001"), ("C00002", "C00001"), ("C00004", "C00004")}
    events = {(r.business_key, r.rule_id) for r in s.events.collect()}
    assert {("C00003", "INV_UNSERVED_PROVINCE"), ("C00002", "DUP_ENTITY"), ("H00001", "DUP_EXACT"), ("P00004", "INV_DATE_ORDER"), ("P00002", "UPSTREAM_PARENT_REJECTED"), ("H00009", "ORPHAN_FK"), ("PAY00002", "UPSTREAM_PARENT_REJECTED"), ("H00005", "JSON_MALFORMED"), ("D00001", "JSON_KEY_DRIFT"), ("P00001", "MISS_ERROR"), ("C00004", "MISS_ERROR")} <= events
    c = core.build(s)
    claims = {r.claim_id: r for r in c.claims.collect()}
    assert str(claims["D00001"].service_date) == "2025-02-20" and str(claims["D00001"].claim_amount) == "200.00" and str(claims["H00001"].claim_amount) == "100.00"
    assert {r.policy_id: r.customer_id for r in c.policies.collect()} == {"P00001": "C00001", "P00003": "C00004"}
    assert c.policies.filter("policy_id = 'P00001'").first().plan_name == "BasicPlan"
    repaired = {(r.business_key, r.rule_id) for r in c.events.collect()}
    assert {("D00001", "CORE_SERVICE_DATE_REPAIRED"), ("D00001", "CORE_CLAIM_AMOUNT_REPAIRED")} <= repaired


def read(path):
    with open(path, newline="") as f:
        return list(csv.DictReader(f))


@pytest.fixture(scope="module")
def published(spark, batch, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("published") / "out")
    return root, pipeline.run(spark, batch, root)


def test_run_twice(spark, batch, published):
    root, first = published
    fraud = {r["claim_id"]: r for r in read(f"{root}/output/fraud_detection.csv")}
    assert len(fraud["H00001"]) == 43 and fraud["H00001"]["f1_early_claim_flag"] == "True" and fraud["H00001"]["f7_missing_required_documents_flag"] == "True" and fraud["H00001"]["f8_unusual_submission_time_flag"] == "True"
    assert fraud["D00001"]["f2_waiting_period_flag"] == "True" and fraud["D00001"]["provider_claim_share"] == "1.0000"
    kept = {r["customer_id"]: r for r in read(f"{root}/output/customer_retention.csv")}
    assert kept["C00004"]["churned"] == "1" and kept["C00001"]["churned"] == "0"
    assert (kept["C00004"]["late_premium_count_12m"], kept["C00004"]["missed_premium_count_12m"], kept["C00004"]["age_band_change_with_increase_count_12m"]) == ("1", "1", "1")
    assert kept["C00001"]["missed_premium_count_12m"] == "0" and kept["C00001"]["premium_installment_count_12m"] == "1"
    policy = {(r["policy_type"], r["age_band"]): r for r in read(f"{root}/output/policy_optimization.csv")}
    assert policy["dental", "45-54"]["premium_due_total"] == "60.00" and sum(int(r["policy_months"]) for (t, _), r in policy.items() if t == "dental") == 17
    assert len(read(f"{root}/output/region_wise_insights.csv")) == 2 and len(read(f"{root}/output/operational_efficiency.csv")[0]) == 30
    assert pipeline.run(spark, batch, root) == first


def test_broken_batches_publish_nothing(spark, batch, tmp_path):
    root = str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    with pytest.raises(Exception):
        pipeline.run(spark, str(tmp_path / "in"), root)
    assert not (tmp_path / "out" / "core").exists()


def test_log_and_quarantine(spark, published):
    root, _ = published
    log = {(r["business_key"], r["rule_id"], r["field_name"]): r for r in read(f"{root}/output/data_quality_log.csv")}
    date = log["P00001", "FMT_DATE", "start_date"]
    assert (date["load_id"], date["source_name"], date["source_table"], date["source_record_id"]) == ("1", "Policy.csv", "raw.policy_csv", "2")
    assert (date["original_value"], date["clean_value"], date["details"], date["detected_at"]) == ("01/15/2024", "2024-01-15", "", "")
    hidden = log["C00001", "FMT_POSTAL", "postal_code"]
    assert (hidden["original_value"], hidden["clean_value"], hidden["details"]) == ("", "", '{"pii_value_redacted":true}')
    amount = log["D00001", "CORE_CLAIM_AMOUNT_REPAIRED", "claim_amount"]
    assert (amount["source_table"], amount["source_record_id"], amount["original_value"], amount["clean_value"]) == ("staging.claims", "4", "2000.00", "200.00")
    assert not any("Tremble" in "".join(r.values()) or "S4P" in "".join(r.values()) for r in log.values())
    layers = pipeline.Layers(spark, root)
    held = {(r.business_key, r.rule_id): r for r in layers.read("core", "quarantine").collect()}
    assert held["H00009", "ORPHAN_FK"].details == '{"policy_id":"P99999"}' and held["H00009", "ORPHAN_FK"].source_record_id == 6
    assert held["H00005", "JSON_MALFORMED"].source_name == "H00005.json" and held["H00005", "JSON_MALFORMED"].reason == "JSON could not be parsed"
    assert {r.source_load_id for r in layers.read("core", "claims").collect()} == {1}


def test_identities_are_kept_across_batches(spark, batch):
    s = staging.stage(spark, batch)
    known = spark.createDataFrame([("C00002", "C00008"), ("C00077", "C00001")], "source_customer_id string, customer_id string")
    built = core.build(s, known)
    assert {tuple(r) for r in built.identities.collect()} == {("C00001", "C00001"), ("C00002", "C00001"), ("C00004", "C00004"), ("C00077", "C00001")}
