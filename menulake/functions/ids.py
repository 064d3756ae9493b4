"""D-01: deterministic ids from key parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from menulake.functions._util import col_of


def stable_id(*parts) -> Column:
    """Non-empty parts joined by ``|``, SHA-256 hex, first 32 chars.

    Null and empty parts are skipped, as in the source data model.
    """
    # each part is read once: an id made of ids would double their expressions at every level
    kept = F.array_remove(F.array(*[col_of(p).cast("string") for p in parts]), "")
    return F.substring(F.sha2(F.concat_ws("|", kept), 256), 1, 32)


def kept_id(df: DataFrame, name: str, *parts) -> Column:
    """D-01: the id that a row of ``df`` already has in column ``name``, else the stable id of ``parts``.

    An empty or null id is none; without such a column every id is made.
    """
    made = stable_id(*parts)
    if name not in df.columns:
        return made
    own = df[name].cast("string")
    return F.coalesce(F.when(own != "", own), made)
