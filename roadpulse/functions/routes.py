"""Road names: recognise numbered highways in free-text street names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An interstate or US route: letters, then a dash or at least one space, then
# the number. Not anchored: it may start in the middle of a word.
HIGHWAY = r"(I|US)(?:\s*-\s*|\s+)(\d+)"


def highway(street: str | Column, anchored: bool = False) -> Column:
    """First highway named in ``street`` as ``I-95`` / ``US-101``, else null.

    ``anchored`` asks for a word boundary in front, so that "Hawaii 5 Hwy" is
    not read as I-5.
    """
    text = F.upper(F.col(street) if isinstance(street, str) else street)
    pattern = r"\b" + HIGHWAY if anchored else HIGHWAY
    system = F.regexp_extract(text, pattern, 1)
    number = F.regexp_extract(text, pattern, 2)
    return F.when(system != "", F.concat(system, F.lit("-"), number))


def normalise_route(street: str | Column, anchored: bool = False) -> Column:
    """Highway name where there is one, otherwise the street as written."""
    street = F.col(street) if isinstance(street, str) else street
    return F.coalesce(highway(street, anchored), street)
