"""Data-quality rules. All counting rules share one aggregation of the frame; only duplicate checks need a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.numbers import number
from tidewell.operators.features import col

SCHEMA = "rule_name string, rule_type string, passed boolean, details map<string,string>"
_ROWS = "rows"


class Rule:
    """aggregates() are evaluated over the frame in one pass with those of all rules; verdict() reads them."""

    kind = "rule"

    def __init__(self, name: str) -> None:
        self.name = name

    def aggregates(self, df: DataFrame) -> dict[str, Column]:
        return {}

    def verdict(self, df: DataFrame, found: dict[str, Any]) -> tuple[bool, dict[str, Any]]:
        raise NotImplementedError

    def check(self, df: DataFrame) -> dict[str, Any]:
        """This rule alone."""
        return run_rules(df, [self])[0]


class NullRule(Rule):
    kind = "null_check"

    def __init__(self, name: str, columns: Sequence[str] = ()) -> None:
        super().__init__(name)
        self.columns = list(columns)

    def aggregates(self, df: DataFrame) -> dict[str, Column]:
        bare = lambda c: col(c).isNull() | (F.isnan(col(c)) if dict(df.dtypes)[c] in ("double", "float") else F.lit(False))
        return {c: F.count_if(bare(c)) for c in self.columns if c in df.columns}

    def verdict(self, df: DataFrame, found: dict[str, Any]) -> tuple[bool, dict[str, Any]]:
        out: dict[str, Any] = {}
        for c in self.columns:
            if c not in df.columns:
                out[f"{c}_missing_column"] = True
                continue
            out |= {
                f"{c}_null_count": found[c],
                f"{c}_null_percentage": found[c] / found[_ROWS] * 100 if found[_ROWS] else None,
                f"{c}_has_nulls": found[c] > 0,
            }
        return not any(found.get(c) for c in self.columns), out


class DateRangeRule(Rule):
    kind = "date_range"

    def __init__(self, name: str, column: str, min_date: str | None = None, max_date: str | None = None) -> None:
        super().__init__(name)
        self.column, self.min_date, self.max_date = column, min_date, max_date

    def aggregates(self, df: DataFrame) -> dict[str, Column]:
        if self.column not in df.columns:
            return {}
        d = col(self.column).cast("timestamp_ntz")
        out = {"data_min_date": F.date_format(F.min(d), "yyyy-MM-dd"), "data_max_date": F.date_format(F.max(d), "yyyy-MM-dd")}
        if self.min_date:
            out["below_min_date"] = F.count_if(d < F.lit(self.min_date).cast("timestamp_ntz"))
        if self.max_date:
            out["above_max_date"] = F.count_if(d > F.lit(self.max_date).cast("timestamp_ntz"))
        return out

    def verdict(self, df: DataFrame, found: dict[str, Any]) -> tuple[bool, dict[str, Any]]:
        if self.column not in df.columns:
            return False, {"error": f"Column {self.column} not found"}
        out = {k: v for k, v in found.items() if k != _ROWS}
        for count, flag in (("below_min_date", "min_date_violations"), ("above_max_date", "max_date_violations")):
            if count in out:
                out[flag] = out[count] > 0
        return not (out.get("min_date_violations") or out.get("max_date_violations")), out


class PositiveRule(Rule):
    kind = "positive_value"

    def __init__(self, name: str, column: str, allow_negative: bool = False, allow_zero: bool = True) -> None:
        super().__init__(name)
        self.column, self.allow_negative, self.allow_zero = column, allow_negative, allow_zero

    def aggregates(self, df: DataFrame) -> dict[str, Column]:
        if self.column not in df.columns:
            return {}
        x = number(col(self.column))
        return {"negative_values": F.count_if(x < 0), "zero_values": F.count_if(x == 0), "min_value": F.min(x), "max_value": F.max(x)}

    def verdict(self, df: DataFrame, found: dict[str, Any]) -> tuple[bool, dict[str, Any]]:
        if self.column not in df.columns:
            return False, {"error": f"Column {self.column} not found"}
        passed = (self.allow_negative or not found["negative_values"]) and (self.allow_zero or not found["zero_values"])
        return bool(passed), {k: v for k, v in found.items() if k != _ROWS}


class DuplicateRule(Rule):
    """Rows beyond the first of each key; null equals null."""

    kind = "duplicate_check"

    def __init__(self, name: str, columns: Sequence[str] = ()) -> None:
        super().__init__(name)
        self.columns = list(columns)

    def count(self, df: DataFrame) -> DataFrame:
        """One row: duplicate_count."""
        groups = df.groupBy(*map(col, self.columns or df.columns)).count()
        return groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_count"))

    def verdict(self, df: DataFrame, found: dict[str, Any]) -> tuple[bool, dict[str, Any]]:
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            return False, {"error": f"no such columns: {missing}"}
        n = self.count(df).first().duplicate_count
        return n == 0, {"duplicate_count": n, "total_records": found[_ROWS]}


class CustomRule(Rule):
    """A callable over the frame: a dict with passed and details, or anything true. What it raises fails the rule."""

    kind = "custom"

    def __init__(self, name: str, function: Callable[..., Any], **params: Any) -> None:
        super().__init__(name)
        self.function, self.params = function, params

    def verdict(self, df: DataFrame, found: dict[str, Any]) -> tuple[bool, dict[str, Any]]:
        try:
            got = self.function(df, **self.params)
        except Exception as e:  # noqa: BLE001  a rule's own error is its result
            return False, {"error": str(e)}
        return (bool(got.get("passed", False)), got.get("details", {})) if isinstance(got, dict) else (bool(got), {"result": got})


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> list[dict[str, Any]]:
    return counted_rules(df, rules)[1]


def counted_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[int, list[dict[str, Any]]]:
    """The number of rows, from the one aggregation, and the rules' results."""
    wanted = {(i, k): c for i, r in enumerate(rules) for k, c in r.aggregates(df).items()}
    row = df.agg(F.count(F.lit(1)).alias(_ROWS), *(c.alias(f"a{j}") for j, c in enumerate(wanted.values()))).first()
    values = {key: row[f"a{j}"] for j, key in enumerate(wanted)}
    out = []
    for i, rule in enumerate(rules):
        try:
            passed, details = rule.verdict(df, {k: v for (j, k), v in values.items() if j == i} | {_ROWS: row[_ROWS]})
            out.append({"rule_name": rule.name, "rule_type": rule.kind, "passed": bool(passed), "details": details})
        except Exception as e:  # noqa: BLE001  one rule's failure is reported beside the others' results
            out.append({"rule_name": rule.name, "rule_type": "error", "passed": False, "details": {"error": str(e)}})
    return row[_ROWS], out


class Validator:
    def __init__(self, rules: Sequence[Rule] = (), enabled: bool = True) -> None:
        self.rules, self.enabled = list(rules), enabled

    @classmethod
    def from_config(cls, config: Any) -> Validator:
        make = {
            "null": lambda c: NullRule(c.get("name"), c.get("columns", [])),
            "date_range": lambda c: DateRangeRule(c.get("name"), c.get("column"), c.get("min_date"), c.get("max_date")),
            "positive": lambda c: PositiveRule(c.get("name"), c.get("column")),
            "duplicate": lambda c: DuplicateRule(c.get("name"), c.get("columns", [])),
        }
        enabled = config.get("validation.enabled", True)
        return cls(
            [make[c["type"]](c) for c in config.get("validation.rules", None) or [] if c.get("type") in make] if enabled else [],
            enabled,
        )

    def add_rule(self, rule: Rule) -> Validator:
        self.rules.append(rule)
        return self

    def add_custom_rule(self, name: str, function: Callable[..., Any], **params: Any) -> Validator:
        return self.add_rule(CustomRule(name, function, **params))

    def validate(self, df: DataFrame, stage: str | None = None) -> dict[str, Any]:
        now = datetime.now(UTC).isoformat()
        if not self.enabled:
            return {"validation_enabled": False, "passed": True, "stage": stage, "timestamp": now, "results": []}
        rows, results = counted_rules(df, self.rules)
        good = sum(r["passed"] for r in results)
        return {
            "validation_enabled": True, "passed": good == len(results), "stage": stage, "timestamp": now, "total_rules": len(results),
            "passed_rules": good, "failed_rules": len(results) - good, "data_shape": (rows, len(df.columns)), "results": results,
        }

    @staticmethod
    def get_failed_validations(report: dict[str, Any]) -> list[dict[str, Any]]:
        return [r for r in report.get("results", []) if not r["passed"]]


def report_frame(spark: SparkSession, report: dict[str, Any]) -> DataFrame:
    """The results as rows (rule_name, rule_type, passed, details)."""
    rows = [
        (
            r["rule_name"], r["rule_type"], r["passed"],
            {k: None if v is None else str(v) for k, v in r["details"].items()},
        ) for r in report["results"]
    ]
    return spark.createDataFrame(rows, SCHEMA)
