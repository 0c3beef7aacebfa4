"""Column-expression builders (pure ``Column -> Column``, no UDFs)."""

from cardlens.functions.parsing import (  # noqa: F401
    bool_expr,
    date_expr,
    double_expr,
    guarded_ratio,
    iso_weekday,
    text_expr,
    timestamp_expr,
)
