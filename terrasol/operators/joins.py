"""Join helpers: null-safe multi-key joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

#: Parts that the left rows with a null key are dealt over.
NULL_SALTS = 64


def null_safe_left_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], salts: int = NULL_SALTS) -> DataFrame:
    """Left join where null keys match null keys (pandas ``merge`` semantics).

    Rows whose keys are all known go through a plain equi join.  Rows with a null key
    would be one hot key of a shuffle, so they are joined apart: the left ones are dealt
    over ``salts`` parts by a hash of the whole row, the right ones (one row per place
    without a code) are repeated in each part.  The two joins are united; no row of
    either side takes part in both.
    """
    unknown = lambda names: reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    on_left, on_right = [k for k, _ in keys], [k for _, k in keys]
    known_left, known_right = left.where(~unknown(on_left)), right.where(~unknown(on_right))
    equal = reduce(lambda a, b: a & b, [known_left[a] == known_right[b] for a, b in keys])
    known = known_left.join(known_right, equal, "left")

    salt = "_salt"
    while salt in left.columns or salt in right.columns:
        salt += "_"
    hashable = [F.col(f"`{f.name}`") for f in left.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    null_left = left.where(unknown(on_left)).withColumn(salt, F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int"))
    null_right = right.where(unknown(on_right)).withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = reduce(lambda a, b: a & b, [null_left[a].eqNullSafe(null_right[b]) for a, b in keys], null_left[salt] == null_right[salt])
    nulls = null_left.join(null_right, same, "left").drop(null_left[salt]).drop(null_right[salt])
    return known.unionByName(nulls)


def by_shuffle(side: DataFrame) -> DataFrame:
    """A join side that is shuffled, never broadcast.

    Catalyst takes the size of a side from the (compressed, pruned) files it is read from and
    knows nothing of rows that an explode multiplies, so a side of many hundred MB looks
    like a small one; broadcast, all of it would pass through the driver.
    """
    return side.hint("merge")
