"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the word rule; words are the runs of everything else.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = rf"[^{SPACE}]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. Pure ASCII takes the byte-wise built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )
