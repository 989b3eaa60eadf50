"""DataFrame → DataFrame operators."""

from blotter.operators.aggregates import (
    agg_dict,
    avg_and_count,
    count_by,
    dedupe_any,
    dedupe_first,
    mean_from_sum_count,
    sum_ones_by,
)
from blotter.operators.exact import exact_mean, exact_sum
from blotter.operators.filters import (
    where_contains,
    where_equal,
    where_in_range,
    where_not_equal,
    where_not_null,
    where_regex,
)
from blotter.operators.joins import (
    STRATEGIES,
    broadcast_join,
    join_normalised,
    join_with_strategy,
    map_side_join,
    repartition_join,
)
from blotter.operators.ordering import bottom_k, sort_by, sort_result, top_k
from blotter.operators.projections import derive, distinct_values, project, rename, repair_headers
from blotter.operators.setops import union_by_name, union_positional
from blotter.operators.skew import bounded_hash_join, frequent_keys, hot_key_join
from blotter.operators.windows import rank_within, top_n_per_group

__all__ = [
    "STRATEGIES",
    "agg_dict",
    "avg_and_count",
    "bottom_k",
    "bounded_hash_join",
    "broadcast_join",
    "count_by",
    "dedupe_any",
    "dedupe_first",
    "derive",
    "distinct_values",
    "exact_mean",
    "exact_sum",
    "frequent_keys",
    "hot_key_join",
    "join_normalised",
    "join_with_strategy",
    "map_side_join",
    "mean_from_sum_count",
    "project",
    "rank_within",
    "rename",
    "repair_headers",
    "repartition_join",
    "sort_by",
    "sort_result",
    "sum_ones_by",
    "top_k",
    "top_n_per_group",
    "union_by_name",
    "union_positional",
    "where_contains",
    "where_equal",
    "where_in_range",
    "where_not_equal",
    "where_not_null",
    "where_regex",
]
