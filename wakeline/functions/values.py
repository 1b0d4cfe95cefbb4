"""Cleaning and unit conversion of single values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The conversion factor as published, and the speed above which a
# report is taken for noise.
HOURS_PER_SECOND = 0.000277777778
MAX_SPEED = 20.0


def draught_or_zero(draught: Column) -> Column:
    """Missing draughts count as zero, and so enter the average."""
    return F.coalesce(draught, F.lit(0.0)).cast("double")


def clipped_speed(speed: Column) -> Column:
    return F.when(speed > MAX_SPEED, F.lit(0.0)).otherwise(speed)


def epoch_seconds(timestamp: Column) -> Column:
    return F.unix_timestamp(timestamp).cast("int")


def hours(seconds: Column) -> Column:
    return F.round(seconds * F.lit(HOURS_PER_SECOND), 2)


def exact(value: Column) -> Column:
    """A step or a speed as a decimal: its sums do not depend on the order of addition.

    Digits behind the twelfth are rounded. What is no number below a million is missing.
    """
    return value.try_cast("decimal(18,12)")


def parse_double(text: Column) -> Column:
    return text.try_cast("double")


def parse_int(text: Column) -> Column:
    """NULL unless the whole text is an integer; '1.5' and ' 7' are not."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def parse_amount(text: Column) -> Column:
    """Register figures may carry a decimal comma, and then points between thousands."""
    grouped = text.rlike(r"^\s*[+-]?[0-9]{1,3}(\.[0-9]{3})+,[0-9]+\s*$")
    plain = F.when(grouped, F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    return F.replace(plain, F.lit(","), F.lit(".")).try_cast("double")
