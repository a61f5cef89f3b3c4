"""Column expressions on text that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What is not part of a word once A-Z are lower-cased: ASCII other than digits and a-z.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else; null counts as empty. Pure ASCII takes the quick built-in."""
    c = F.coalesce(c, F.lit(""))
    quick = F.length(c) == F.octet_length(c)
    return F.when(quick, F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def words(c: Column) -> Column:
    """Words of the lower-cased text, in order; an array without elements where there are none."""
    return F.filter(F.split(ascii_lower(c), NOT_WORD), lambda w: w != "")
