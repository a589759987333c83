"""Joins whose keys may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are dealt to several tasks: at most so many, those with the most rows. A key of a thousandth of all rows or more is
#: always among them, so they are broadcast whatever the data.
HEAVY_KEYS = 1_000
#: Tasks that a heavy key's rows are dealt to, and the rows that make a key heavy.
SALTS, HEAVY_ROWS = 64, 200


def spread_join(
    rows: DataFrame, side: DataFrame, key: str, by: str, how: str = "inner", least: int = HEAVY_ROWS, counted: DataFrame | None = None, hashed: bool = False
) -> DataFrame:
    """rows joined with side on key; side has a row per key at most and no other column of rows.

    The rows of a heavy key are dealt to SALTS tasks by the hash of their column ``by`` and the key's row of side goes to
    each of them; other keys meet in one task as in any shuffled join. Keys are counted with a combine on the map side, or
    ``counted`` has the rows (key, n) of all keys that may be heavy. ``hashed`` asks for a shuffled hash join built on side.
    """
    salt, heavy = "salt_of_key", "is_heavy_key"
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")) if counted is None else counted
    top = counted.filter(F.col("n") >= least).orderBy(F.desc("n"), key).limit(HEAVY_KEYS)
    top = F.broadcast(top.select(key, F.lit(True).alias(heavy)))
    is_heavy = F.coalesce(heavy, F.lit(False))
    dealt = rows.join(top, key, "left").withColumn(salt, F.when(is_heavy, F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop(heavy)
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = side.join(top, key, "left").withColumn(salt, F.explode(copies)).drop(heavy)
    return dealt.join(copied.hint("shuffle_hash") if hashed else copied, [key, salt], how).drop(salt)
