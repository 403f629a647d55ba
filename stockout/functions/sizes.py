"""Size text: parenthesis stripping, the size sort key and the ordered size string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named sizes and their sort keys (compared as strings).
NAMED_SIZE_KEYS = {"SS": "10", "S": "20", "M": "30", "L": "40", "XL": "50", "2XL": "60", "XXL": "60"}


def strip_paren(c: Column) -> Column:
    """Text before the first '(' (``M(95)`` -> ``M``). A leading '(' leaves nothing, which
    is NULL, as a zero-length substring is in the source warehouse."""
    return (F.when(F.instr(c, "(") > 0, F.nullif(F.substring_index(c, "(", 1), F.lit("")))
            .otherwise(c))


def size_sort_key(c: Column) -> Column:
    """String key that orders sizes: named sizes by the table above; otherwise ``1`` and the first
    digit run, filled up to four digits where it has one to three (a longer one is kept whole, a
    size without digits has none)."""
    digits = F.coalesce(F.regexp_substr(c, F.lit("[0-9]+")), F.lit(""))
    short = F.length(digits).between(1, 3)
    numeric = F.concat(F.lit("1"), F.when(short, F.lpad(digits, 4, "0")).otherwise(digits))
    named = None
    for name, key in NAMED_SIZE_KEYS.items():
        named = (F.when(c == name, F.lit(key)) if named is None
                 else named.when(c == name, F.lit(key)))
    return named.otherwise(numeric)


def ordered_size_string(size: str, key: str) -> Column:
    """Aggregate: the group's sizes joined by '_' in key order (value breaks ties); nulls
    and empty strings are skipped, an all-null group gives NULL. Feed it distinct sizes."""
    return F.expr(f"listagg(nullif({size}, ''), '_') WITHIN GROUP (ORDER BY {key}, {size})")
