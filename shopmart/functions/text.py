"""String helpers: address parts and the service-fault reason match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the cancellation reasons
# that count as a service fault.  Unanchored alternation on the lower-cased
# reason, so substrings match ("restored" contains "store").
SERVICE_FAULT_PATTERN = "service|сервис|курьер|driver|store|shop|магазин|delivery|доставка"

UNKNOWN_CITY = "UNKNOWN"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def address_part(address, index: int, sep: str = ",") -> Column:
    """Trimmed ``index``-th (0-based) part of a comma-separated address.

    ``get`` returns NULL past the end instead of raising under ANSI mode, so
    a one-part address has no second part; NULL address → NULL.
    """
    return F.when(_c(address).isNotNull(), F.trim(F.get(F.split(_c(address), sep), index)))


def is_service_fault(reason, pattern: str = SERVICE_FAULT_PATTERN) -> Column:
    """1 when the lower-cased reason contains a service-fault word, else 0."""
    text = F.lower(F.coalesce(_c(reason), F.lit("")))
    return F.when(text.rlike(pattern), F.lit(1)).otherwise(F.lit(0))
