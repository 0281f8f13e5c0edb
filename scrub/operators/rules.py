"""Validation rules, applied in order and in one pass over the rows.

A rule's expression describes bad rows. Instead of filtering the table once per rule, every row
gets a verdict: NULL while it is kept, else the number of the rule that took it out. Later rules
only touch rows without a verdict, so rows taken out keep the values they had at that rule. The
clean table, the quarantined table and the counts are three readings of that one tagged table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from enum import Enum
from functools import cached_property
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import lenient, ref, rows_from_one
from ..functions.hashing import row_hash
from .nulls import any_missing, drop_null_keys

VERDICT = "__verdict"
HIT = "__hit_{}"
NULL_KEY = -1

# Audit columns that do not take part in a quarantined row's hash.
NOT_HASHED = ("etl_load_timestamp", "etl_job_id", "etl_source_path")


class Action(Enum):
    DROP_ROW = "drop_row"
    SET_NULL = "set_null"
    SET_DEFAULT = "set_default"
    FLAG_RECORD = "flag_record"
    QUARANTINE = "quarantine"


class Severity(Enum):
    CRITICAL = "critical"
    HIGH = "high"
    MEDIUM = "medium"
    LOW = "low"


NO_DEFAULT = object()


@dataclass(frozen=True)
class Rule:
    column: str
    expression: str
    action: Action = Action.DROP_ROW
    rule_name: str = "unnamed_rule"
    severity: Severity = Severity.MEDIUM
    default: Any = field(default=NO_DEFAULT)
    message: str | None = None
    enabled: bool = True

    @property
    def flag_column(self) -> str:
        return f"{self.column}_{self.rule_name}_flag"

    @property
    def takes_rows_out(self) -> bool:
        return self.action in (Action.DROP_ROW, Action.QUARANTINE)


@dataclass(frozen=True)
class RuleResult:
    """The tagged table and its readings. All frames are lazy.

    ``filtered`` is set when all the rules do is drop rows: the clean rows as plain filters, which
    can reach the scan where a verdict cannot.
    """

    tagged: DataFrame
    rules: tuple[Rule, ...]
    status: tuple[str, ...]
    filtered: DataFrame | None = None

    def over(self, tagged: DataFrame) -> RuleResult:
        """The same result read from another copy of the tagged table, such as a stored one."""
        return RuleResult(tagged, self.rules, self.status)

    @cached_property
    def _visible(self) -> list[str]:
        hidden = {VERDICT, *(HIT.format(i) for i in range(len(self.rules)))}
        return [c for c in self.tagged.columns if c not in hidden]

    @property
    def clean(self) -> DataFrame:
        """Rows no rule took out."""
        if self.filtered is not None:
            return self.filtered
        kept = self.tagged.filter(F.col(VERDICT).isNull())
        return kept.select(*[ref(c) for c in self._visible])

    @property
    def quarantined(self) -> DataFrame:
        """Rows moved aside: reason, time and md5 of the row as it was when it was moved.

        Flag columns of rules that came after the one that moved a row are NULL in it.
        """
        numbers = self._numbers(Action.QUARANTINE)
        reason = F.lit(None).cast("string")
        for i in numbers:
            reason = F.when(F.col(VERDICT) == i, self.rules[i].rule_name).otherwise(reason)
        moved = self.tagged.filter(F.col(VERDICT).isin(*numbers) if numbers else F.lit(False))
        hashed = [c for c in self._visible if c not in NOT_HASHED]
        return moved.select(
            *[ref(c) for c in self._visible],
            reason.alias("quarantine_reason"),
            F.current_timestamp().alias("quarantine_timestamp"),
            row_hash(self.tagged, hashed).alias("original_row_hash"),
        )

    @property
    def moves_rows(self) -> bool:
        """True when some rule may quarantine rows."""
        return bool(self._numbers(Action.QUARANTINE))

    def _numbers(self, action: Action) -> list[int]:
        return [
            i for i, r in enumerate(self.rules)
            if r.action is action and self.status[i] == "applied"
        ]

    def affected(self, i: int) -> Column:
        """Aggregate: rows that rule ``i`` took out or changed."""
        if self.status[i] != "applied":
            return F.lit(0).cast("long")
        if self.rules[i].takes_rows_out:
            return F.count_if(F.col(VERDICT) == i)
        return F.count_if(F.col(HIT.format(i)))

    def totals(self) -> list[Column]:
        """Aggregates over the tagged table: the counters of a cleaning run."""
        verdict = F.col(VERDICT)

        def among(action: Action) -> Column:
            numbers = self._numbers(action)
            return F.count_if(verdict.isin(*numbers)) if numbers else F.lit(0).cast("long")

        return [
            F.count(F.lit(1)).alias("input_records"),
            F.count_if(verdict == NULL_KEY).alias("null_records"),
            among(Action.DROP_ROW).alias("validation_failures"),
            among(Action.QUARANTINE).alias("quarantined_records"),
            F.count_if(verdict.isNull()).alias("kept_records"),
        ]

    @property
    def counts(self) -> DataFrame:
        """One row per rule, in order, with the number of rows it affected; one aggregate."""
        if not self.rules:
            return self.counts_of(self.tagged.limit(0))
        return self.counts_of(self.tagged.agg(*self.affected_all()))

    def affected_all(self) -> list[Column]:
        """Aggregates over the tagged table: rows affected by rule i as ``n<i>``."""
        return [self.affected(i).alias(f"n{i}") for i in range(len(self.rules))]

    def counts_of(self, counted: DataFrame) -> DataFrame:
        """``counts`` from one row that holds what ``affected_all`` gives."""
        if not self.rules:
            return self.tagged.sparkSession.createDataFrame([], COUNTS_SCHEMA)
        return rows_from_one(
            counted,
            [
                {
                    "rule_order": F.lit(i),
                    "rule_name": F.lit(r.rule_name),
                    "column_name": F.lit(r.column).cast("string"),
                    "action": F.lit(r.action.value),
                    "severity": F.lit(r.severity.value),
                    "message": F.lit(r.message).cast("string"),
                    "status": F.lit(self.status[i]),
                    "affected_records": F.col(f"n{i}"),
                }
                for i, r in enumerate(self.rules)
            ],
        )


COUNTS_SCHEMA = (
    "rule_order int, rule_name string, column_name string, action string, severity string, "
    "message string, status string, affected_records long"
)


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    quarantine: bool = True,
    unknown: str = "drop",
    null_keys: Sequence[str] = (),
) -> RuleResult:
    """Tag every row with what the rules make of it.

    drop_row takes a row out when its expression is true, and also when it is NULL unless
    ``unknown="pass"``; quarantine only when it is true, so clean and quarantined rows together
    are the input. A rule is skipped when it is disabled, its column does not exist, it has no
    default to set, quarantine is off, or its expression does not fit the table; ``counts`` says
    which. Values that an expression cannot take give NULL. Rows with a missing value in ``null_keys`` are taken out before the first rule.
    """
    with lenient(df):
        return _apply_rules(df, rules, quarantine, unknown, null_keys)


def _apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    quarantine: bool = True,
    unknown: str = "drop",
    null_keys: Sequence[str] = (),
) -> RuleResult:
    if unknown not in ("drop", "pass"):
        raise ValueError(f"unknown must be drop or pass, not {unknown}")
    missing_key = any_missing(df, null_keys)
    start = F.when(missing_key, NULL_KEY) if missing_key is not None else F.lit(None).cast("int")
    tagged = df.withColumn(VERDICT, start.cast("int"))
    waiting: list[tuple[int, Column]] = []
    filtered: DataFrame | None = drop_null_keys(df, null_keys)
    status = []
    for i, rule in enumerate(rules):
        problem = _reason_to_skip(tagged, rule, quarantine)
        if problem is not None:
            status.append(problem)
            continue
        bad = F.expr(rule.expression)
        if rule.action is not Action.DROP_ROW:
            filtered = None
        elif unknown == "drop":
            filtered = None if filtered is None else filtered.filter(~bad)
            bad = F.coalesce(bad, F.lit(True))
        elif filtered is not None:
            filtered = filtered.filter(~F.coalesce(bad, F.lit(False)))
        if rule.takes_rows_out:
            waiting.append((i, bad))
        else:
            tagged = _change(_settle(tagged, waiting), i, rule, bad)
            waiting = []
        status.append("applied")
    return RuleResult(_settle(tagged, waiting), tuple(rules), tuple(status), filtered)


def _settle(df: DataFrame, waiting: list[tuple[int, Column]]) -> DataFrame:
    """Give verdicts for a run of rules that only take rows out: one CASE for all of them."""
    if not waiting:
        return df
    verdict = F.when(waiting[0][1], waiting[0][0])
    for i, bad in waiting[1:]:
        verdict = verdict.when(bad, i)
    return df.withColumn(VERDICT, F.coalesce(F.col(VERDICT), verdict))


def _change(df: DataFrame, i: int, rule: Rule, bad: Column) -> DataFrame:
    hit = F.col(VERDICT).isNull() & F.coalesce(bad, F.lit(False))
    df = df.withColumn(HIT.format(i), hit)
    hit = F.col(HIT.format(i))
    if rule.action is Action.FLAG_RECORD:
        return df.withColumn(rule.flag_column, F.when(F.col(VERDICT).isNull(), hit))
    kind = df.schema[rule.column].dataType
    value = rule.default if rule.action is Action.SET_DEFAULT else None
    return df.withColumn(
        rule.column, F.when(hit, F.lit(value).try_cast(kind)).otherwise(ref(rule.column))
    )


def _reason_to_skip(df: DataFrame, rule: Rule, quarantine: bool) -> str | None:
    if not rule.enabled:
        return "disabled"
    if rule.column not in df.columns:
        return "no such column"
    if rule.action is Action.QUARANTINE and not quarantine:
        return "quarantine is off"
    if rule.action is Action.SET_DEFAULT and rule.default in (NO_DEFAULT, None):
        return "no default"
    try:
        bad = F.expr(rule.expression)
        if rule.takes_rows_out:
            df.filter(bad).schema
        elif not isinstance(
            df.select(F.when(bad, F.lit(True)), bad.alias("bad")).schema["bad"].dataType,
            T.BooleanType,
        ):
            return "failed: not a condition"
        if rule.action is Action.SET_DEFAULT:
            df.select(F.lit(rule.default).try_cast(df.schema[rule.column].dataType)).schema
    except PySparkException as error:
        return "failed: " + str(error).splitlines()[0]
    return None
