from emporia.functions.columns import (  # noqa: F401
    first_of,
    haversine_km,
    as_of_date,
    is_finite,
    money_sum,
    month_bound,
    order_window,
    rounded,
    safe_div,
    since,
    zero_pad,
)
