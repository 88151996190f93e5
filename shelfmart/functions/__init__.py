from shelfmart.functions.columns import (  # noqa: F401
    avg2, col, count_if, decimals_to_double, parse_source_date,
    render_source_date, round2, rows_differ,
)
