"""Duplicate detection over a stream: the matcher's state lives in Spark's state store."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.duplicates import BOX, MAX_AGE, MIN_SIMILARITY, Matcher


def detect(objects: DataFrame, sample: str, frame: str, min_similarity: float = MIN_SIMILARITY, max_age: int = MAX_AGE, timeout_ms: int | None = None) -> DataFrame:
    """(sample, frame, object_id, dupset_id) of a stream whose frames arrive whole and, per sample, in order.

    Within a micro-batch, frames are sorted. The state of a sample is at most the objects of max_age + 1 frames; with a
    timeout, it is dropped after that much processing time without new frames.
    """
    kind = {f.name: f.dataType.simpleString() for f in objects.schema}

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        matcher = Matcher(min_similarity, max_age)
        if state.exists:
            matcher.known = {k: (tuple(box), age) for k, box, age in json.loads(state.get[0])}
        rows = pd.concat(list(batches), ignore_index=True).sort_values([frame, "object_id"], ignore_index=True)
        for number, part in rows.groupby(frame, sort=True):
            ids = part["object_id"].tolist()
            yield pd.DataFrame({sample: key[0], frame: number, "object_id": ids, "dupset_id": matcher.frame(ids, part[BOX].to_numpy())})
        state.update((json.dumps([(k, [float(x) for x in box], age) for k, (box, age) in matcher.known.items()]),))
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)

    schema = f"`{sample}` {kind[sample]}, `{frame}` {kind[frame]}, object_id {kind['object_id']}, dupset_id {kind['object_id']}"
    timeout = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    return objects.groupBy(sample).applyInPandasWithState(run, schema, "known string", "append", timeout)
