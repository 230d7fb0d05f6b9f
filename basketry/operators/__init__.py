"""``DataFrame -> DataFrame`` operators; each works on batch and, where
the operator is streamable, on streaming frames unchanged."""

from basketry.operators.audit import combine_audits, dataset_audit, validate_report
from basketry.operators.catalog import (
    category_conversion,
    category_conversion_of_events,
    enrich_with_catalog,
    fits_broadcast,
    normalize_catalog,
    planned_bytes,
    product_category_map,
    salted_left_join,
)
from basketry.operators.funnel import (
    average_rate,
    conversion_report,
    events_by_date,
    funnel_counts,
    funnel_join_form,
    low_performers,
    record_counts,
    top_by_rate,
    type_counts,
    with_event_date,
    with_rates,
)
from basketry.operators.ranking import product_views, top_products, top_products_lines
from basketry.operators.segments import (
    classify,
    daily_events,
    occurrences,
    render_event_list,
    segment_summary,
    user_event_counts,
    user_event_lists,
    user_segments,
)
from basketry.operators.union import union_event_sets
from basketry.operators.windows import (
    category_window_metrics,
    product_alerts,
    product_window_metrics,
    window_rates,
    with_watermark,
)

__all__ = [name for name in dir() if not name.startswith("_")]
