"""DataFrame operators: mapping, unification, rules, quality, indicators and run metrics."""

from reviewlake.operators.kpis import prepare_for_kpis, review_kpis, sentiment_kpis
from reviewlake.operators.mapping import (
    app_reference_column,
    map_columns,
    resolve_source,
    with_control_columns,
)
from reviewlake.operators.metrics import (
    operations_dashboard,
    output_check_metrics,
    metrics_payload,
    run_metrics,
)
from reviewlake.operators.quality import (
    flag_duplicates,
    flag_nulls,
    flag_type_issues,
    quality_summary,
)
from reviewlake.operators.rules import apply_review_rules, dedup_reviews, filter_rating
from reviewlake.operators.unify import clean_reviews, unify_external, unify_internal, union_sources

__all__ = [
    "app_reference_column", "apply_review_rules", "clean_reviews", "dedup_reviews",
    "filter_rating", "flag_duplicates", "flag_nulls", "flag_type_issues", "map_columns",
    "metrics_payload", "operations_dashboard", "output_check_metrics", "prepare_for_kpis",
    "quality_summary", "resolve_source", "review_kpis", "run_metrics", "sentiment_kpis",
    "unify_external", "unify_internal", "union_sources", "with_control_columns",
]
