from waybill.functions.policies import (  # noqa: F401
    AGING_BUCKETS,
    SLA_PRESETS,
    SlaPolicy,
    aging_bucket,
    movement_label,
    payment_efficiency,
    payment_status,
    sla_class,
    urgency,
    with_open_class,
)
from waybill.functions.scalars import (  # noqa: F401
    as_ts,
    average,
    bin_floor,
    day_of_week,
    diff_boundary,
    first_filled,
    is_blank,
    is_filled,
    month_start,
    pct,
    pct_change,
    ratio,
    week_start,
)
