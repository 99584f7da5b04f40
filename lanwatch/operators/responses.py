"""Administrator-approved response requests (Q1–Q4).

Requests are rows; administrator commands are an ordered log.  The state of
a request is the fold of its commands (``aggregate`` over the sorted command
array of that request: a handful of entries).  Nothing here acts on a
device: execution records a dry-run result string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import SAFE_ACTIONS
from .dataset import _dense_index

# Statuses and error texts.
PENDING, APPROVED, REJECTED, EXECUTED = "PENDING", "APPROVED", "REJECTED", "EXECUTED"
ERR_APPROVE = "Only pending requests can be approved"
ERR_REJECT = "Only pending requests can be rejected"
ERR_EXECUTE = "Administrator approval is required before execution"
ERR_UNKNOWN = "Unknown response request: %s"
ERR_ACTION = "Unsupported defensive action: %s"
DEFAULT_ACTION = "ISOLATE_DEVICE"

REQUEST_COLUMNS = ["request_id", "incident_id", "action", "target", "reason", "status", "created_at",
                   "approved_by", "executed_at", "result"]


def target_repr(mac: Column, ip: Column) -> Column:
    """The target dict as the dry-run executor prints it."""
    ip_txt = F.when(ip.isNull(), F.lit("None")).otherwise(F.concat(F.lit("'"), ip, F.lit("'")))
    return F.concat(F.lit("{'mac': '"), mac, F.lit("', 'ip': "), ip_txt, F.lit("}"))


def dry_run_result(action: Column, target: Column) -> Column:
    """Q4."""
    return F.concat(F.lit("DRY_RUN: "), action, F.lit(" for "),
                    target_repr(target["mac"], target["ip"]))


def validate_actions(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q2: upper-case the action; unsupported ones go to a rejects frame."""
    r = requests.withColumn("action", F.upper(F.col("action")))
    ok = F.col("action").isin(SAFE_ACTIONS)
    rejects = r.where(~ok).withColumn("error", F.format_string(ERR_ACTION, F.col("action")))
    return r.where(ok), rejects


def create_requests(incidents: DataFrame, created_at: str, start_number: int = 0,
                    order_cols=("incident_id",), action: str = DEFAULT_ACTION,
                    existing: DataFrame | None = None) -> DataFrame:
    """Q1: one PENDING request per HIGH/CRITICAL incident, ids ``resp-<n>``.

    Numbers continue after the rows of ``existing``, the stored request table, or after ``start_number``, in ``order_cols`` order; the numbering is a distributed
    dense index, not a single-task window.
    """
    if existing is not None:
        start_number = existing.count()
    alerts = incidents.where(F.col("severity").isin("HIGH", "CRITICAL")).select(
        *[c for c in order_cols if c != "incident_id"],
        "incident_id",
        F.lit(action).alias("action"),
        F.struct(F.col("details.device_mac").alias("mac"), F.col("details.device_ip").alias("ip")).alias("target"),
        F.col("details.risk.explanation").alias("reason"),
    )
    alerts, _ = validate_actions(alerts)
    numbered = _dense_index(alerts, list(order_cols), "_n")
    return numbered.select(
        F.concat(F.lit("resp-"), (F.col("_n") + F.lit(start_number + 1)).cast("string")).alias("request_id"),
        "incident_id", "action", "target", "reason",
        F.lit(PENDING).alias("status"), F.lit(created_at).alias("created_at"),
        F.lit(None).cast("string").alias("approved_by"), F.lit(None).cast("string").alias("executed_at"),
        F.lit(None).cast("string").alias("result"),
    )


_STATE = "struct<status:string,approved_by:string,executed_at:string,result:string,errors:array<string>>"


def apply_commands(requests: DataFrame, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q3: fold ``commands`` (request_id, command, admin, at, order) into requests.

    ``command`` is approve / reject / execute.  Illegal transitions leave the
    state unchanged and are reported with the reference's message; commands
    for unknown ids are reported too.  Returns ``(requests, errors)``.
    """
    cmds = commands.select(
        "request_id",
        F.struct(F.col("order").cast("long").alias("order"), F.lower("command").alias("command"),
                 F.col("admin").cast("string").alias("admin"), F.col("at").cast("string").alias("at"))
        .alias("c"))
    per_req = cmds.groupBy("request_id").agg(F.sort_array(F.collect_list("c")).alias("cmds"))
    r = requests.join(per_req, "request_id", "left")
    init = F.struct(F.col("status"), F.col("approved_by"), F.col("executed_at"), F.col("result"),
                    F.array().cast("array<string>").alias("errors")).cast(_STATE)
    result_txt = dry_run_result(F.col("action"), F.col("target"))

    def step(acc, c):
        st = acc["status"]
        approve_ok = (c["command"] == "approve") & (st == PENDING)
        reject_ok = (c["command"] == "reject") & (st == PENDING)
        exec_ok = (c["command"] == "execute") & (st == APPROVED)
        err = (F.when((c["command"] == "approve") & ~approve_ok, F.lit(ERR_APPROVE))
               .when((c["command"] == "reject") & ~reject_ok, F.lit(ERR_REJECT))
               .when((c["command"] == "execute") & ~exec_ok, F.lit(ERR_EXECUTE)))
        return F.struct(
            F.when(approve_ok, F.lit(APPROVED)).when(reject_ok, F.lit(REJECTED))
             .when(exec_ok, F.lit(EXECUTED)).otherwise(st).alias("status"),
            F.when(approve_ok | reject_ok, c["admin"]).otherwise(acc["approved_by"]).alias("approved_by"),
            F.when(exec_ok, c["at"]).otherwise(acc["executed_at"]).alias("executed_at"),
            F.when(exec_ok, result_txt).otherwise(acc["result"]).alias("result"),
            F.when(err.isNotNull(), F.concat(acc["errors"], F.array(F.format_string(
                "%s (order %d)", err, c["order"])))).otherwise(acc["errors"]).alias("errors"),
        ).cast(_STATE)

    folded = r.withColumn("_s", F.aggregate(F.coalesce(F.col("cmds"), F.array().cast(
        "array<struct<order:bigint,command:string,admin:string,at:string>>")), init, step))
    out = folded.select(
        "request_id", "incident_id", "action", "target", "reason",
        F.col("_s.status").alias("status"), "created_at",
        F.col("_s.approved_by").alias("approved_by"), F.col("_s.executed_at").alias("executed_at"),
        F.col("_s.result").alias("result"), F.col("_s.errors").alias("_errors"))
    errors = out.select("request_id", F.explode("_errors").alias("error")).unionByName(
        per_req.join(requests.select("request_id"), "request_id", "left_anti")
        .select("request_id", F.format_string(ERR_UNKNOWN, F.col("request_id")).alias("error")))
    return out.drop("_errors"), errors
