"""Exact removal of replayed messages from a stream, with a state of intervals.

What has been seen of a topic partition is kept as sorted, disjoint intervals
of positions.  A topic partition hands out its positions one after the other,
so however many messages have come, the state holds little more than one
interval per range that is still incomplete; it grows with the gaps, not with
the rows.  No event time decides, so a message that comes late but was never
seen stays.

Positions are cut into ranges of 2^``RANGE_BITS`` and the ranges are dealt to
``SLOTS`` states per topic partition, so a busy partition is not one task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BITS = 20
SLOTS = 64
STATE = "intervals binary"


def seen(starts: np.ndarray, ends: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Which positions lie in one of the (inclusive, sorted, disjoint) intervals."""
    at = np.searchsorted(starts, positions, "right") - 1
    out = np.zeros(len(positions), bool)
    inside = at >= 0
    out[inside] = positions[inside] <= ends[at[inside]]
    return out


def add(starts: np.ndarray, ends: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals with the positions, joined where they touch."""
    return add_all(starts, ends, positions, positions)


def add_all(starts: np.ndarray, ends: np.ndarray, more: np.ndarray, more_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals of two sets as one set."""
    a, b = np.concatenate([starts, more]), np.concatenate([ends, more_ends])
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    first = np.r_[True, a[1:] > b[:-1] + 1] if len(a) else np.zeros(0, bool)
    last = np.r_[first[1:], True] if len(a) else first
    return a[first], b[last]


def _thin(numbers: np.ndarray) -> bytes:
    """Numbers of 0 to 2^64 - 1 in as many bytes each as the largest needs."""
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return bytes([width]) + numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: bytes) -> np.ndarray:
    """The numbers of ``_thin``."""
    out = np.zeros(((len(data) - 1) // data[0], 8), np.uint8)
    out[:, :data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, data[0])
    return out.reshape(-1).view("<u8")


def pack(starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Intervals as bytes: the steps between starts, then where and by how much an
    interval is longer than one position."""
    if not len(starts):
        return b""
    steps = np.diff(starts.view(np.uint64))
    long = np.flatnonzero(ends > starts)
    parts = [starts[:1].tobytes(), _thin(steps), _thin(long.astype(np.uint64)), _thin((ends - starts)[long].view(np.uint64))]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    parts, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 8], "little")
        parts.append(data[at + 8:at + 8 + size])
        at += 8 + size
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, steps, long, more = np.frombuffer(parts[0], np.uint64), *map(_wide, parts[1:])
    starts = np.cumsum(np.concatenate([first, steps]), dtype=np.uint64).view(np.int64)
    ends = starts.copy()
    ends[long.astype(np.int64)] += more.view(np.int64)
    return starts, ends


def _unseen(position: str, tie: list[str]):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, ends = unpack(state.get[0] if state.exists else b"")
        # What this micro-batch adds is kept apart, so that an Arrow batch costs
        # its own size and not that of the state.
        fresh = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for rows in batches:
            at = rows[position].to_numpy(np.int64)
            new = ~seen(starts, ends, at) & ~seen(*fresh, at)
            if len(np.unique(at)) < len(at):
                ordered = rows.reset_index(drop=True)
                ordered = ordered.sort_values(tie, kind="stable") if tie else ordered
                new[ordered.index[ordered[position].duplicated()]] = False
            if new.any():
                fresh = add(*fresh, at[new])
                yield (rows if new.all() else rows[new]).drop(columns="_slot")
        state.update((pack(*add_all(starts, ends, *fresh)),))
    return run


def dedup_positions(df: DataFrame, topic: str = "topic", partition: str = "partition", position: str = "offset_value",
                    first_by: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """The rows of a streaming ``df`` whose (topic, partition, position) has not
    come before.  Of copies in one micro-batch the first by ``first_by`` stays, if
    they arrive in one Arrow batch.  Topic, partition and position must not be null."""
    where = F.pmod(F.xxhash64(F.shiftright(F.col(position), RANGE_BITS)), F.lit(slots)).cast("int")
    return (df.withColumn("_slot", where).groupBy(topic, partition, "_slot")
            .applyInPandasWithState(_unseen(position, first_by or []), df.schema, STATE, "append",
                                    GroupStateTimeout.NoTimeout))

