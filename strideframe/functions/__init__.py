from strideframe.functions.columns import (
    argmax,
    decode,
    guarded_rate,
    nan_to_null,
    norm,
    null_to_nan,
    parse_reading,
    rounded,
    series_label,
    snap_to_grid,
    strip_terminator,
)

__all__ = [
    "argmax",
    "decode",
    "guarded_rate",
    "nan_to_null",
    "norm",
    "null_to_nan",
    "parse_reading",
    "rounded",
    "series_label",
    "snap_to_grid",
    "strip_terminator",
]
