"""Table operators: plain functions from ``DataFrame`` to ``DataFrame``."""

from .dedup import dedup, dedup_counts
from .enrich import DerivedColumn, add_audit, derive, derive_report
from .metrics import before_after, completeness, consistency
from .nulls import drop_null_keys, fill_nulls
from .outliers import Limits, flag_outliers
from .parts import merge_profiles, part_limits, profile_part
from .profile import distinct_counts, profile, table_profile
from .quantiles import quantiles
from .rules import Action, Rule, RuleResult, Severity, apply_rules
from .schema import SchemaError, SchemaSpec, schema_report, validate_schema
from .strings import clean_strings
from .types import (
    ConvertOptions,
    add_type_counts,
    conversion_report,
    convert_types,
    infer_mapping,
    infer_shares,
    infer_types,
    type_counts,
    types_of_counts,
    wider_type,
)

__all__ = [
    "Action", "ConvertOptions", "DerivedColumn", "Limits", "Rule", "RuleResult", "SchemaError",
    "SchemaSpec", "Severity", "add_audit", "add_type_counts", "apply_rules", "before_after", "clean_strings",
    "completeness", "consistency", "conversion_report", "convert_types", "dedup", "dedup_counts",
    "derive", "derive_report", "distinct_counts", "drop_null_keys", "fill_nulls", "flag_outliers",
    "infer_mapping", "infer_shares", "infer_types", "merge_profiles", "part_limits", "profile", "profile_part",
    "quantiles", "schema_report", "table_profile", "type_counts", "types_of_counts", "validate_schema", "wider_type",
]
