from .arithmetic import (
    cap_above,
    clip_zero,
    round_even,
    row_mean,
    safe_div,
    smoothed_ratio,
    to_long,
    xor_score,
)
from .labels import (
    band_between,
    bin_right_closed,
    code_to_int,
    flag,
    overwrite,
    regroup,
    sign_label,
)
from .nulls import (
    fill_infinite,
    is_member,
    nan_to_null,
    not_equal_keep_null,
    null_below,
    null_when_in,
)

__all__ = [
    "band_between",
    "bin_right_closed",
    "cap_above",
    "clip_zero",
    "code_to_int",
    "fill_infinite",
    "flag",
    "is_member",
    "nan_to_null",
    "not_equal_keep_null",
    "null_below",
    "null_when_in",
    "overwrite",
    "regroup",
    "round_even",
    "row_mean",
    "safe_div",
    "sign_label",
    "smoothed_ratio",
    "to_long",
    "xor_score",
]
