from sitefold.functions.semantics import (  # noqa: F401
    asc,
    cat,
    cents,
    check_fails,
    desc,
    email_ok,
    fmt_minute,
    from_cents,
    instant,
    is_upper,
    len_in,
    money,
    months_back,
    nvl,
    occupancy_pct,
    order_keys,
    route_site,
    row_label,
    to_second,
)
from sitefold.functions.airline import (  # noqa: F401
    booking_state,
    seat_fits,
    seat_models,
    status_at,
    ticket_price,
)
