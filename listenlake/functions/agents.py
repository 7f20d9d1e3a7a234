"""Device attributes read from a user-agent text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens looked for; the leftmost one in the text wins.
DEVICE_TYPES = ["Mobile", "Tablet", "iPad", "iPhone", "Desktop", "Bot"]
OPERATING_SYSTEMS = ["Windows", "Mac OS X", "Linux", "Android", "iOS", "iPad", "iPhone"]
BROWSERS = ["Chrome", "Firefox", "Safari", "Edge", "Opera", "IE", "Trident", "SamsungBrowser"]

UNKNOWN = "Unknown"


def first_token(text: Column, tokens: list[str]) -> Column:
    """Leftmost of ``tokens`` in ``text``; ``Unknown`` when there is none or no text."""
    found = F.regexp_extract(text, f"({'|'.join(tokens)})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(UNKNOWN))


def device_columns(agent: Column) -> dict[str, Column]:
    return {
        "device_type": first_token(agent, DEVICE_TYPES),
        "operating_system": first_token(agent, OPERATING_SYSTEMS),
        "browser": first_token(agent, BROWSERS),
    }
