"""Join shapes that stay splittable when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def settled(reduced: DataFrame) -> DataFrame:
    """End the stage of an aggregate that is about to be joined back on its own key.

    Joined directly, the aggregate and the join share one shuffle.  That saves a
    step but ties both sides to it: adaptive execution can then neither measure
    the reduced side and broadcast it when it is small, nor split a hot key on the
    other side.  Moving the reduced rows, one per key, once more allows both.
    """
    return reduced.hint("rebalance")


def one_to_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """Left join of a table with unique ``key`` to a table with many rows per key.

    A left outer join cannot split a hot key on its right side.  The matches come
    from an inner join, where adaptive execution can split it; rows without a
    match come from an anti join with the distinct keys, which are combined
    before their shuffle.
    """
    matched = one.join(many, key)
    lonely = one.join(many.select(key).distinct(), key, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)
