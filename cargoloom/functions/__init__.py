from cargoloom.functions.addresses import address_city, address_district, full_address
from cargoloom.functions.dates import (
    calendar_days,
    date_key,
    day_name,
    is_holiday,
    is_weekend,
    minutes_between,
)
from cargoloom.functions.moments import batch_id, moment, moment_date
from cargoloom.functions.text import clip, contact_handle, fold_accents, trim_padding

__all__ = [
    "address_city",
    "address_district",
    "batch_id",
    "calendar_days",
    "clip",
    "contact_handle",
    "date_key",
    "day_name",
    "fold_accents",
    "full_address",
    "is_holiday",
    "is_weekend",
    "minutes_between",
    "moment",
    "moment_date",
    "trim_padding",
]
