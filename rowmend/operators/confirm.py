"""A second look at differences between tables that are written to while they are compared.

Slices of a live table are read at different moments, and its copy follows a little later, so
some differences are only a matter of time. Only the keys that differed are read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmend.operators.compare import DIFF_TYPE, MATCH, SRC, TGT, compare_least, compare_rows, rows_of_keys
from rowmend.operators.keys import OCCURRENCE, join_keys
from rowmend.operators.lookup import covering_ranges, within
from rowmend.operators.ranks import quoted
from rowmend.sources.storage import materialize

CONFIRMED, RESOLVED, CHANGED = "confirmed", "resolved", "changed"
STATE = "state"


def confirm_differences(
    rows: DataFrame,
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    primary_key: bool = False,
    least: bool = False,
) -> DataFrame:
    """The differing rows of a first comparison with ``state``, by both tables as they are now.

    ``confirmed``: both sides still have the values that differed. ``resolved``: the rows agree by now, or
    neither side has them any more. ``changed``: they differ, but otherwise than before; such rows have the
    class and the values of the second look. Rows that differ only since the first look, of keys
    that were looked at, are ``changed`` as well. ``src`` and ``tgt`` are read anew, in the ranges
    of the differing keys. ``least`` says that the first look was ``compare_least``.
    """
    differing = rows.where(F.col(DIFF_TYPE) != MATCH)
    place = [*keys, *([OCCURRENCE] if OCCURRENCE in rows.columns else [])]
    wanted = materialize(differing.select(*quoted(keys)).distinct(), "differing-keys")
    ranges = covering_ranges(wanted, keys)
    sides = [rows_of_keys(within(df, ranges), wanted, keys, not primary_key) for df in (src, tgt)]
    values = [f.name for f in rows.schema[SRC].dataType.fields] if columns is None else columns
    looked = compare_least(*sides, keys, values).rows if least else compare_rows(*sides, keys, values, primary_key=primary_key)
    again = looked.select(*quoted(place), DIFF_TYPE, SRC, TGT)
    again = materialize(again, "second-look")
    now = again.select(*quoted(place), F.col(DIFF_TYPE).alias("_type"), F.col(SRC).alias("_src"), F.col(TGT).alias("_tgt"))
    both = join_keys(differing.select(*quoted(place), DIFF_TYPE, SRC, TGT), now, place)
    gone = F.col("_type").isNull() | (F.col("_type") == MATCH)
    same = F.col(SRC).eqNullSafe(F.col("_src")) & F.col(TGT).eqNullSafe(F.col("_tgt"))
    state = F.when(gone, RESOLVED).when(same, CONFIRMED).otherwise(CHANGED)
    seen = lambda name, later: F.when(F.col(STATE) == CHANGED, F.col(later)).otherwise(F.col(name)).alias(name)
    known = both.withColumn(STATE, state).select(
        *quoted(place), seen(DIFF_TYPE, "_type"), seen(SRC, "_src"), seen(TGT, "_tgt"), STATE
    )
    fresh = join_keys(again.where(F.col(DIFF_TYPE) != MATCH), differing.select(*quoted(place)), place, "left_anti")
    return known.unionByName(fresh.withColumn(STATE, F.lit(CHANGED)))
