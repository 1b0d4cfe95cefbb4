"""Parameters the registered queries and their SQL share."""

from wakeline.functions.geo import Box
from wakeline.sources.mid import own_assignments

PORT = Box(4.2, 51.2, 4.6, 51.6)
HOME_PORT = "YE"
MAP = Box(4.0, 50.0, 6.0, 55.0)
START, END = "2024-01-05 00:00:00", "2024-01-20 12:00:00"
VESSEL = 211000003
COUNTRY = "Netherlands"


def mid_values() -> str:
    """The assignments as rows for a VALUES list."""
    return ", ".join(f"('{mid}', '{name}')" for mid, name in own_assignments())
