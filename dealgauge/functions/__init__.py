from dealgauge.functions.columns import (
    bin_index,
    blank,
    nullable_div,
    parse_size,
    right_closed_bins,
    share,
)

__all__ = ["bin_index", "blank", "nullable_div", "parse_size", "right_closed_bins", "share"]
