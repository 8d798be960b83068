"""Checking rows against a contract, as DataFrame to DataFrame steps.

``annotate`` is the heart: one projection that gives each row the array of
reasons it breaks and a verdict. Everything else (accepted rows, quarantine,
counts) reads those two columns, so the rules are evaluated once per row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.contracts import TableContract
from intake.functions.casts import typed_value
from intake.operators.rules import CORRUPT, Castable, References, Rule, WellFormed

REASONS = "reasons"
RAW_LINE = "raw_line"
VERDICT = "verdict"
ACCEPTED = "accepted"
REJECTED = "rejected"


def _checks(df: DataFrame, contract: TableContract) -> list[tuple[int, str, Rule]]:
    """(slot, reason, rule) of the checks that ``df`` can be put to.

    Rows that are not text have their types already, and rows that do not come from a
    file have no raw line.
    """
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return [
        (slot, reason, rule)
        for slot, (reason, rule) in enumerate(contract.checks)
        if not (isinstance(rule, Castable) and rule.column not in texts)
        and not (isinstance(rule, WellFormed) and CORRUPT not in df.columns)
    ]


def _with_lookups(df: DataFrame, contract: TableContract) -> DataFrame:
    for slot, (_, rule) in enumerate(contract.checks):
        if isinstance(rule, References):
            df = rule.attach(df, slot)
    return df


def _flag(slot: int) -> str:
    return f"_broken_{slot}"


def flags(contract: TableContract) -> list[str]:
    """Names of the boolean helper columns of ``annotate``, one per check."""
    return [_flag(slot) for slot, _ in enumerate(contract.checks)]


def annotate(df: DataFrame, contract: TableContract) -> DataFrame:
    """Add to every row ``reasons`` (array of string), ``verdict`` and the flags.

    Each check is made once, into its flag; reasons, verdict and counts are made of
    flags. Only conditionals and ``concat``, which Spark compiles: a higher-order
    function such as ``array_compact`` would take the row out of generated code.
    """
    nothing = F.array().cast("array<string>")
    checks = {slot: rule.violated(slot) for slot, _, rule in _checks(df, contract)}
    every = [(_flag(slot), reason) for slot, (reason, _) in enumerate(contract.checks)]
    any_broken = reduce(or_, [F.col(flag) for flag, _ in every], F.lit(False))
    found = [F.when(F.col(flag), F.array(F.lit(reason))).otherwise(nothing) for flag, reason in every]
    out = _with_lookups(df, contract).withColumns(
        {_flag(slot): checks.get(slot, F.lit(False)) for slot, _ in enumerate(contract.checks)}
    )
    for slot, (_, rule) in enumerate(contract.checks):
        if isinstance(rule, References):
            out = rule.detach(out, slot)
    return out.withColumns(
        {
            REASONS: F.when(any_broken, F.concat(nothing, *found)).otherwise(nothing),
            VERDICT: F.when(any_broken, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED)),
        }
    )


def accepted(df: DataFrame, contract: TableContract) -> DataFrame:
    """Only the rows that break no rule, in the contract's columns.

    A plain filter: a caller who wants no reasons should not pay for the array.
    """
    keep = F.lit(True)
    for slot, _, rule in _checks(df, contract):
        keep = keep & ~rule.violated(slot)
    return _with_lookups(df, contract).where(keep).select(*contract.columns)


def rejected(df: DataFrame, contract: TableContract) -> DataFrame:
    """The rows that break a rule, with their reasons; with the raw line of those of
    another width, if the contract has a rule for them."""
    bad = annotate(df, contract).where(F.col(VERDICT) == REJECTED)
    if contract.wants_raw_line:
        bad = bad.withColumnRenamed(CORRUPT, RAW_LINE)
    return bad.drop(VERDICT, CORRUPT, *flags(contract))


def by_reason(quarantine: DataFrame) -> DataFrame:
    """One row per (rejected row, reason)."""
    columns = [c for c in quarantine.columns if c not in (REASONS, VERDICT)]
    return quarantine.select(*columns, F.explode(REASONS).alias("reason"))


def count_columns(contract: TableContract) -> list[Column]:
    """Aggregates over an annotated frame: totals and one count per rule."""
    return [
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col(VERDICT) == ACCEPTED).alias("accepted"),
        F.count_if(F.col(VERDICT) == REJECTED).alias("rejected"),
        *[
            F.count_if(F.col(_flag(slot))).alias(reason)
            for slot, (reason, _) in enumerate(contract.checks)
        ],
    ]


def violation_counts(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per rule: rows seen and rows that break it, in a single scan."""
    broken = {slot: rule.violated(slot) for slot, _, rule in _checks(df, contract)}
    totals = _with_lookups(df, contract).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.count_if(broken.get(slot, F.lit(False))).alias(reason)
            for slot, (reason, _) in enumerate(contract.checks)
        ],
    )
    return totals.unpivot(
        "n_rows", [f"`{reason}`" for reason, _ in contract.checks], "reason", "n_violations"
    ).select("reason", "n_rows", "n_violations")


def assert_clean(df: DataFrame, contract: TableContract) -> None:
    """Raise ``ValueError`` with the counts if any row breaks any rule."""
    found = violation_counts(df, contract).where("n_violations > 0").collect()
    if found:
        detail = ", ".join(f"{r.reason}={r.n_violations}" for r in found)
        raise ValueError(f"{contract.name}: rows break the contract: {detail}")


def assert_not_empty(n_accepted: int, contract: TableContract) -> None:
    if not n_accepted:
        raise ValueError(f"{contract.name}: no row left after validation")


def typed(df: DataFrame, contract: TableContract) -> DataFrame:
    """Landing text to the contract's types; a value that was accepted is never lost."""
    return df.select(
        *[
            typed_value(f.name, f.data_type, contract.mode_of(f.name)).alias(f.name)
            for f in contract.fields
        ]
    )
