"""All registered queries. Importing the modules fills the registry."""

from waybill.catalog import (  # noqa: F401
    access,
    entities,
    extraction,
    gold,
    jobs,
    kpis,
    messages,
    quality,
    reports,
    scanned,
    star,
)
from waybill.catalog.base import QUERIES, SQL, runnable  # noqa: F401

FLAGSHIP = "gld_2_orders_by_sla"
