"""A batch from raw files to exports: registered, staged, reconciled, validated and published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.plans import core, marts, staging
from claimforge.plans.constraints import CONSTRAINTS
from claimforge.sources.export import export_csv
from claimforge.sources.layers import BUCKETS, Change, Layers, Snapshot, children, rebuilt, replaced, upserted
from claimforge.sources.raw import EXTRACTS, batch_fingerprint, discover
from claimforge.sources.shared import Workspace

KEYS = {
    "customers": "customer_id", "policies": "policy_id", "claims": "claim_id", "payments": "payment_id", "premiums": "premium_id", "details": "claim_id", "identities": "source_customer_id",
}
# The order of each export.
ORDERS = {
    "fraud_detection": ["claim_date", "claim_id"],
    "customer_retention": ["customer_id"],
    "operational_efficiency": ["submission_date", "claim_id"],
    "region_wise_insights": ["quarter_start", "province", "product_line", "claim_type"],
    "policy_optimization": ["policy_type", "plan_name", "age_band", "coverage_type", "province"],
}
# Columns that identify a person, which no published table has.
PERSONAL = ("first_name", "last_name", "address", "email", "phone", "adjuster_notes", "city", "postal_code")
# Fields of customer rows whose values the exported log leaves out, and the order of the log.
REDACTED = ("first_name", "last_name", "date_of_birth", "address", "city", "postal_code", "phone", "email")
LOG_ORDER = ["source_name", "source_table", "source_record_id", "business_key", "rule_id", "field_name", "severity", "action", "original_value", "clean_value", "details"]


class InvalidBatch(ValueError):
    """A batch that cannot be told from others."""


def register(layers: Layers, fp: str) -> tuple[int, bool]:
    """(load id, whether this batch has been loaded before); an equal fingerprint is an equal batch.

    A new batch gets the next id in the same step that makes it known, so batches that come together get ids of
    their own. A batch that failed, or whose run was lost, is loaded again under its id.
    """
    while True:
        version, state = layers.state("control")
        loads = state.get("loads", [])  # one entry per batch
        same = [x for x in loads if x["fingerprint"] == fp]
        if len(same) > 1:
            raise InvalidBatch(f"loads {sorted(x['load_id'] for x in same)} are of one batch")
        if same:
            return same[0]["load_id"], same[0]["status"] == "succeeded"
        new = 1 + max((x["load_id"] for x in loads), default=0)
        if layers.advance("control", version, {"loads": [*loads, {"load_id": new, "fingerprint": fp, "status": "running", "note": ""}]}):
            return new, False


def record(layers: Layers, load_id: int, status: str, note: str = "") -> None:
    """Set the status of a load that is registered."""
    while True:
        version, state = layers.state("control")
        loads = [x | {"status": status, "note": note[:4000]} if x["load_id"] == load_id else x for x in state["loads"]]
        if layers.advance("control", version, {"loads": loads}):
            return


def changes(base: Snapshot, staged: staging.Staging, load_id: int, buckets: int) -> dict[str, Change]:
    """What a batch does to the canonical tables: rows of the batch win, children of its claims and the log of its load are replaced."""
    known = base.read("identities") if base.has("identities") else None
    batch = core.build(staged, known)
    loaded = lambda df: df.withColumn("source_load_id", F.lit(load_id).cast("long"))
    out = {name: upserted(loaded(getattr(batch, name) if name != "identities" else staged.identities), key, buckets=buckets) for name, key in KEYS.items()}
    if found := {x for change in out.values() for x in change.new.columns if x in PERSONAL}:
        raise ValueError(f"personal columns {sorted(found)} would be published")
    out["line_items"] = children(loaded(batch.line_items), batch.details, "claim_id", buckets)
    log = redacted(staged.events.unionByName(batch.events), load_id)
    held = staged.quarantine.select(F.lit(load_id).cast("long").alias("load_id"), "*")
    return out | {"quality_log": rebuilt(log, "load_id", load_id), "quarantine": rebuilt(held, "load_id", load_id)}


def redacted(events: DataFrame, load_id: int) -> DataFrame:
    """The log of a load; values of personal fields of customers are left out, and the details say so."""
    hide = (F.col("source_table") == "raw.customer_csv") & F.coalesce(F.col("field_name").isin(*REDACTED), F.lit(False))
    note = '"pii_value_redacted":true}'
    noted = F.coalesce(F.regexp_replace("details", r"\}$", f",{note}"), F.lit("{" + note))
    shown = lambda x: F.when(~hide, F.col(x)).alias(x)
    return events.select(F.lit(load_id).cast("long").alias("load_id"), *LOG_ORDER[:8], shown("original_value"), shown("clean_value"), F.when(hide, noted).otherwise(F.col("details")).alias("details"))


def run(spark: SparkSession, folder: str, root: str, premiums: bool = True, buckets: int = BUCKETS) -> dict[str, int]:
    """Load a batch from ``folder`` into the layers under ``root`` and export the marts.

    Returns the rows of each export. A batch that was loaded before changes nothing but is exported
    again. A failure is recorded and leaves the published layers as they were. Only those of a table's ``buckets``
    that the batch has rows for are written.
    """
    layers = Layers(spark, root)
    names = [n for n in EXTRACTS if premiums or n != "Policy_Premium"]
    discover(spark, folder, names)
    load_id, done = register(layers, batch_fingerprint(spark, folder, names))
    if not done:
        hold = Workspace(spark)
        try:
            staged = staging.stage(spark, folder, premiums, hold)
            layers.publish("core", lambda base: changes(base, staged, load_id, buckets), CONSTRAINTS)
        except Exception as e:
            record(layers, load_id, "failed", str(e))
            raise
        finally:
            hold.release()
        record(layers, load_id, "succeeded")
    now = layers.snapshot("core")
    state = core.Core(**{name: now.read(name) for name in (*KEYS, "line_items") if name != "identities"})
    layers.publish("marts", lambda _: {name: replaced(mart(state)) for name, mart in marts.MARTS.items()})
    made = layers.snapshot("marts")
    rows = {name: export_csv(made.read(name), f"{root}/output/{name}.csv", ORDERS[name], marts.FILLED if marts.FILLED in made.read(name).columns else None) for name in marts.MARTS}
    log = now.read("quality_log", [str(load_id)]).withColumn("detected_at", F.lit(None).cast("timestamp"))
    order = [*LOG_ORDER[:8], *(F.coalesce(x, F.lit("")) for x in LOG_ORDER[8:])]
    return rows | {"data_quality_log": export_csv(log, f"{root}/output/data_quality_log.csv", order)}
