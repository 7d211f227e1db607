"""Surrogate keys: md5 over '-'-joined string casts of the natural columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import ColumnOrName, _c

# Fixed value: the placeholder text hashed in place of a NULL key part.  It must
# equal the token used by the warehouse that produced existing keys.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: ColumnOrName) -> Column:
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def packed(key: ColumnOrName) -> Column:
    """A text as bytes, hashes in half of their letters (two lower-case hex digits a byte): what a shuffle of hashed keys carries.

    Equal texts and no others have equal bytes; ``unpacked`` gives the text back.
    """
    text = _c(key)
    hashed = text.rlike(r"\A([0-9a-f][0-9a-f])+\z")
    return F.when(hashed, F.concat(F.unhex(F.lit("01")), F.unhex(text))).when(
        text.isNotNull(), F.concat(F.unhex(F.lit("00")), text.cast("binary")))


def unpacked(key: ColumnOrName) -> Column:
    held = _c(key)
    rest = F.substring(held, 2, 2**31 - 1)
    return F.when(F.substring(held, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
