"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(text: Column) -> Column:
    """Lower case without outer blanks; NULL stays NULL."""
    return F.lower(F.trim(text))


def label(word: Column) -> Column:
    """Display form of a single word: first letter upper, rest lower."""
    return F.initcap(word)
