"""Keyed writes as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docloom.streaming.combine import bucket_of, earliest_rows, plain_values


def first_requests_stream(
    requests: DataFrame, *, key: str = "key", retention: str = "1 day"
) -> DataFrame:
    """The request of each key that is executed; repeats within ``retention`` are dropped.

    ``requests`` has ``ts``.  Of the requests of a key in one micro-batch the earliest
    is taken (equal times: the smaller ``request_id``, if there is one), whatever
    their order in the files; a key that has been answered stays answered, also if an
    earlier request arrives in a later micro-batch.  The answered keys are kept per
    bucket, so that a call of the step serves many of them.
    """
    columns = requests.columns
    order = ["__us", *(c for c in ("request_id",) if c in columns)]
    # A task hands on the earliest request of a key, with the latest time as the row's time.
    timed = requests.withColumn("__us", F.unix_micros("ts")).withColumn("__ts", F.col("ts"))
    timed = earliest_rows(timed, key, order, "__ts").withWatermark("__ts", retention)

    # In a frame a null would turn a column of integers into floats: they travel as text.
    whole = {f.name: f.dataType for f in requests.schema if isinstance(f.dataType, T.IntegralType)}
    timed = timed.withColumns({c: F.col(c).cast("string") for c in whole})
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in whole else f.dataType) for f in requests.schema])

    def step(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        answered = dict(zip(*state.get, strict=True)) if state.exists else {}
        kept: list[pd.DataFrame] = []
        first: dict[object, tuple[tuple, int, int]] = {}
        for frame in () if state.hasTimedOut else frames:
            keys = plain_values(frame[key], missing=bucket[0] is None)
            places = frame["__us"].tolist()
            ids = frame["request_id"].tolist() if len(order) > 1 else [0] * len(frame)
            for n, (one, us, number) in enumerate(zip(keys, places, ids, strict=True)):
                missing = pd.isna(number)
                if "request_id" in whole and not missing:
                    number = int(number)
                place = (us, missing, 0 if missing else number)
                if one not in first or place < first[one][0]:
                    first[one] = place, len(kept), n
            kept.append(frame)
        new: list[list[int]] = [[] for _ in kept]
        for one, (_, at, n) in first.items():
            if one not in answered:
                new[at].append(n)
        answered = {one: until for one, until in answered.items() if until >= mark or one in first}
        answered.update((one, max(place[0] // 1000, mark + 1)) for one, (place, _, _) in first.items())
        if answered:
            state.update((list(answered), list(answered.values())))
            state.setTimeoutTimestamp(min(answered.values()))
        else:
            state.remove()
        for frame, rows in zip(kept, new, strict=True):
            if rows:
                yield frame.iloc[rows][columns]

    key_type = schema[key].dataType.simpleString()
    out = timed.withColumn("__bucket", bucket_of(key)).groupBy("__bucket").applyInPandasWithState(
        step, schema, f"keys array<{key_type}>, until_ms array<long>", "append", GroupStateTimeout.EventTimeTimeout
    )
    return out.select(*[F.col(f"`{c}`").cast(whole[c]).alias(c) if c in whole else F.col(f"`{c}`") for c in columns])
