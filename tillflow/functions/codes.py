from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the state codes in use.
STATE_NAMES = {
    "AZ": "Arizona",
    "CO": "Colorado",
    "IA": "Iowa",
    "IL": "Illinois",
    "OR": "Oregon",
}


def state_name(code: Column) -> Column:
    """Name of a known state code; any other text, and NULL, stays as it is."""
    names = F.create_map(*[F.lit(text) for text in chain.from_iterable(STATE_NAMES.items())])
    return F.coalesce(names[code], code)


def store_status(code: Column) -> Column:
    return F.when(code == "A", "active").when(code == "I", "inactive").otherwise(code)
