"""The run's clock as literal columns.

Every operator that needs "now" takes ``as_of``; the literals carry no zone, so
results do not depend on the session's or the driver's time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

BATCH_ID_FORMAT = "%Y%m%d_%H%M%S"


def moment(as_of: datetime) -> Column:
    return F.lit(as_of.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def moment_date(as_of: datetime) -> Column:
    return F.lit(as_of.date().isoformat()).cast("date")


def batch_id(as_of: datetime) -> str:
    return as_of.strftime(BATCH_ID_FORMAT)
