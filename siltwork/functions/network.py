"""IPv4 addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOTTED_QUAD = r"^\d{1,3}(\.\d{1,3}){3}$"


def ipv4_number(address: Column) -> Column:
    """``1.2.3.4`` to 16909060; null for anything that is not a dotted quad."""
    pieces = F.split(address, r"\.")
    octets = [F.get(pieces, F.lit(i)).try_cast("bigint") for i in range(4)]
    number = ((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3]
    return F.when(address.rlike(DOTTED_QUAD) & (F.greatest(*octets) <= 255), number)
