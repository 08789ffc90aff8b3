"""What the partition-refining operators share: keys that recur, and looking rows up by keys of which a few may be very common."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.bits import bit_table
from acervo.llm.common import stored

#: A key with more than one of so many rows is hot: there are fewer hot keys than this, whatever the input.
HOT_SHARE = 4096


def recurring(keys: DataFrame) -> np.ndarray:
    """A bit table of the keys (one long column, the rows combined before the shuffle) that more than one row has."""
    name = keys.columns[0]
    return bit_table(stored(keys.groupBy(name).agg(F.count("*").alias("n")).where("n > 1").select(name), "recurring"))


def looked_up(rows: DataFrame, known: DataFrame, key: list[str], n: str, total: int) -> DataFrame:
    """rows with what `known` has for their keys, or nulls.

    known has each key once, and in column n how many of the `total` rows have
    it.  Hot keys, HOT_SHARE at most, are sent to the tasks, so that their rows
    stay where they are; all others are joined by a shuffle.
    """
    hot = known.where(F.col(n) * HOT_SHARE > total)
    common = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(known.where(F.col(n) * HOT_SHARE <= total), key, "left")
    return common.unionByName(rest)
