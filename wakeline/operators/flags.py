"""Flag state of vessels from their identity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.sources.mid import bounded

# Fixed value: ship type 30 is fishing.
FISHING_TYPE = 30

_ID_COLUMNS = ["mmsi", "imo", "name", "callsign"]


def fishing_messages(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("type_and_cargo") == FISHING_TYPE)


def _join_mid(messages: DataFrame, mids: DataFrame, how: str) -> DataFrame:
    # Safe to broadcast: ``bounded`` leaves at most a thousand rows.
    return messages.join(
        F.broadcast(mids), F.substring(messages["mmsi"].cast("string"), 1, 3) == mids["mid"], how
    ).select(*_ID_COLUMNS, F.col("country").alias("vessel_country_origin_mid"))


def vessel_flag_state(messages: DataFrame, mids: DataFrame) -> DataFrame:
    """Flag state per message, NULL where the digits are not assigned."""
    return _join_mid(messages, bounded(mids), "left")


def reference_frame(messages: DataFrame, mids: DataFrame, country: str) -> DataFrame:
    """Distinct fishing vessels of one country.

    The country narrows the MID table before the join, so messages of other
    countries go no further than the broadcast lookup.
    """
    of_country = bounded(mids).where(F.col("country") == country)
    return _join_mid(fishing_messages(messages), of_country, "inner").distinct()
