from .aggregate import (
    Shares,
    Subset,
    agg_text,
    argmax_row,
    count_nonzero,
    every_column,
    first_per_key,
    percent_below,
    summarize,
)
from .colocate import bucketed, drop_bucketed, star, together
from .encode import (
    category_lists,
    category_share_rows,
    first_seen_codes,
    first_seen_encode,
    label_codes,
    label_encode,
    label_encode_binary,
    learn_categories,
    learn_values,
    one_hot,
    one_hot_encoder,
    one_hot_sparse,
    rare_labels,
    rare_labels_percent,
    text_columns,
)
from .join import align, attach, exists_flag, join_suffixed, semi_join_top, top_rows, union_all_by_name
from .lookup import attach_group_stats, lookup_join
from .profile import (
    cap_outliers,
    column_correlations,
    correlated_columns,
    duplicate_columns,
    low_variance_columns,
    narrow_types,
    null_shares,
    outlier_caps,
    quasi_constant_columns,
    value_frequencies,
)
from .project import (
    clean_names,
    columns_by_prefix,
    columns_by_type,
    feature_columns,
    fill_missing_label,
    fill_null,
    fill_zero,
    infinite_to_zero,
    null_sentinel_everywhere,
    null_sentinels,
    prefix_columns,
    split_on_label,
)
from .ranking import average_rank, column_quantiles, group_quantiles, roc_auc, row_positions

__all__ = [n for n in dir() if not n.startswith("_")]
