"""Routing of rows by the severity of the checks they fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checks import Check

# What a failed check does with its row, by severity.
ACTIONS = {"CRITICAL": "halt", "HIGH": "quarantine", "MEDIUM": "flag", "LOW": "flag"}
ROUTES = ["halt", "quarantine", "flag", "pass"]


def with_routes(df: DataFrame, checks: list[Check], quarantine: bool = True) -> DataFrame:
    """``df`` with ``_flags`` (names of the checks a row fails, in their order) and
    ``_route``: the gravest action among them, ``pass`` without any. With
    ``quarantine`` off, rows that would go there are kept and flagged."""
    actions = {**ACTIONS, **({} if quarantine else {"HIGH": "flag"})}
    failed = F.filter(F.array(*[F.when(c.failed, F.lit(c.rule_name)) for c in checks]), lambda x: x.isNotNull())
    route = F.lit("pass")
    for action in reversed(ROUTES[:-1]):
        own = [c.failed for c in checks if actions[c.severity] == action]
        for cond in own:
            route = F.when(cond, F.lit(action)).otherwise(route)
    return df.withColumns({"_flags": failed, "_route": route})


def split_by_route(df: DataFrame, checks: list[Check], quarantine: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(kept, quarantined)``: kept rows with their ``_flags``, quarantined ones
    with ``_validation_errors``. A row that fails a CRITICAL check ends the job
    that reads either frame."""
    routed = with_routes(df, checks, quarantine)
    halt = F.concat(F.lit("CRITICAL check failed: "), F.array_join("_flags", ", "))
    routed = routed.where(F.when(F.col("_route") == "halt", F.raise_error(halt).cast("boolean")).otherwise(True))
    out = F.col("_route") == "quarantine"
    return (routed.where(~out).drop("_route"),
            routed.where(out).drop("_route").withColumnRenamed("_flags", "_validation_errors"))
