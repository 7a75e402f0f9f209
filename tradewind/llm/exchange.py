"""Meeting of equal hashes, and anchors of windows: what the substring operators share.

Hashes travel as packed arrays: a task gathers many records, sends each hash once, and a
bucket of hashes becomes one row.  However often a hash occurs, a bucket receives it at most once
from each gathered lot, so a passage that a third of all documents hold is no hot key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import mix, store

#: Records a task gathers before it sends them.
LOT = 1_500_000
BUCKET_RECORDS = 750_000
DEALT = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])
DEALT_SCHEMA = "bucket int, payload binary"
#: Packed rows of several kinds, one after the other: what meets next, spans, and places.
KINDED = pa.schema([("kind", pa.int32()), *DEALT])
KINDED_SCHEMA = "kind int, bucket int, payload binary"
MEET, SPAN, PLACE = 0, 1, 2
SPAN_KINDS = ["<i8", "<i4", "<i4"]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key, text: the key orders documents; a null id ranks last, by a hash of its text."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), document_key(docs).alias("key"), "text")


def document_key(docs: DataFrame) -> Column:
    by_text = F.lit(2**62).cast("long") + F.shiftrightunsigned(F.xxhash64("text"), 3)
    return F.coalesce(docs["doc_id"].cast("long"), by_text)


def row_keyed(docs: DataFrame) -> DataFrame:
    """Like ``keyed``, but texts that share an id have keys of their own, in the order of a hash of the text.

    Only where some id has different texts the keys are dealt anew: ids and hashes, sorted by ranges, are numbered
    range by range, and the texts joined to them are written once.
    """
    plain = keyed(docs)
    hashed = plain.select("key", F.xxhash64("text").alias("of_text"))
    several = hashed.groupBy("key").agg((F.min("of_text") != F.max("of_text")).alias("several")).filter("several")
    if several.isEmpty():
        return plain
    ranges = hashed.distinct().repartitionByRange("key", "of_text").sortWithinPartitions("key", "of_text")
    numbers = store(ranges.withColumn("number", F.monotonically_increasing_id()), "keys")
    own = plain.withColumn("of_text", F.xxhash64("text")).join(numbers, ["key", "of_text"])
    return store(own.select("doc_id", F.col("number").alias("key"), "text"), "keyed")


def buckets_for(docs: DataFrame, units_per_record: float) -> int:
    """Number of buckets for one record per so many characters."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(8, math.ceil(chars / units_per_record / BUCKET_RECORDS))


def packed(columns: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def unpacked(payloads: Iterable[bytes], kinds: list[str]) -> list[np.ndarray]:
    """The columns of several payloads, put together."""
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    width = sum(np.dtype(k).itemsize for k in kinds)
    for payload in payloads:
        raw = zstandard.ZstdDecompressor().decompress(payload)
        at, n = 0, len(raw) // width
        for part, kind in zip(parts, kinds, strict=True):
            size = n * np.dtype(kind).itemsize
            part.append(np.frombuffer(raw[at : at + size], kind))
            at += size
    return [np.concatenate(p) if p else np.empty(0, k) for p, k in zip(parts, kinds, strict=True)]


def dealt(hashes: np.ndarray, buckets: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row per bucket with the records whose hash falls in it, in the given order."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))[: len(starts)]
    rows = [packed([c[order[a:b]] for c in columns]) for a, b in zip(starts, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(rows, pa.binary())], schema=DEALT)


def meet(rows: DataFrame, kinds: list[str], judge: Callable[[list[np.ndarray]], pa.Table], schema: str) -> DataFrame:
    """Apply ``judge`` to the records of each bucket."""

    def work(table: pa.Table) -> pa.Table:
        return judge(unpacked(table.column("payload").to_pylist(), kinds))

    return rows.groupBy("bucket").applyInArrow(work, schema)


def first_of(group: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort records by group, then ``order``; the sorting, and True where a group begins."""
    by = np.lexsort((*order[::-1], group))
    sorted_group = group[by]
    return by, np.append(True, sorted_group[1:] != sorted_group[:-1]) if len(by) else np.empty(0, bool)


def sizes_of(begins: np.ndarray) -> np.ndarray:
    """For each sorted record the size of its group."""
    starts = np.flatnonzero(begins)
    return np.repeat(np.diff(np.append(starts, len(begins))), np.diff(np.append(starts, len(begins))))


def later(begins: np.ndarray, key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For sorted records: True where the position differs from that of the group's first record."""
    first = np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))
    return (key != key[first]) | (at != at[first])


def by_key(buckets: int, key: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Records on their way to the bucket of their key."""
    kinds = ["<i8", *["<i4"] * len(columns)]
    return dealt(mix(key.astype("<i8").view("<u8"), 0), buckets, [c.astype(k) for c, k in zip((key, *columns), kinds, strict=True)])


def kinded(kind: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, kind, "<i4")), *rows.columns], schema=KINDED)


def of_kind(rows: DataFrame, kind: int) -> DataFrame:
    return rows.filter(F.col("kind") == kind).select("bucket", "payload")


def lists_per_key(rows: DataFrame, names: list[str], join=None) -> DataFrame:
    """One row per key with its records as arrays of integers, from rows of ``by_key``."""

    def gather(columns: list[np.ndarray]) -> pa.Table:
        if join:
            columns = join(*columns)
        by, begins = first_of(columns[0], columns[1])  # one group per key, in order
        starts = np.flatnonzero(begins)
        edges = pa.array(np.append(starts, len(by)), pa.int32())
        lists = [pa.ListArray.from_arrays(edges, pa.array(c[by], pa.int32())) for c in columns[1:]]
        return pa.table([pa.array(columns[0][by][starts], pa.int64()), *lists], names=["key", *names])

    schema = "key long" + "".join(f", {n} array<int>" for n in names)
    return meet(rows, ["<i8", *["<i4"] * len(names)], gather, schema)


def sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    least, span = values, 1
    while span * 2 <= width:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    return np.minimum(least[: len(least) - (width - span)], least[width - span :]) if span < width else least


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum in every window of the given width."""
    at, span = np.arange(len(values)), 1

    def joined(shift: int) -> np.ndarray:
        left, right = at[:-shift], at[shift:]
        return np.where(values[right] < values[left], right, left)

    while span * 2 <= width:
        at, span = joined(span), span * 2
    return joined(width - span) if span < width else at


def anchored(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors (leftmost minima) of all windows, and the first and last window start of each."""
    if len(values) < width:
        none = np.empty(0, np.int64)
        return none, none, none
    least = sliding_minima(values, width)
    begins = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    ends = np.append(begins[1:], len(least)) - 1
    anchors = begins + sliding_window_view(values, width)[begins].argmin(axis=1)
    if (anchors < ends).any():  # equal hashes within a window: the anchor moves while the minimum stays
        minima = leftmost_minima(values, width)
        begins = np.flatnonzero(np.append(True, minima[1:] != minima[:-1]))
        return minima[begins], begins, np.append(begins[1:], len(minima)) - 1
    return anchors, begins, ends


def repeated_anchors(
    docs: DataFrame, grams: Callable[[], Callable[[str], np.ndarray]], width: int, buckets: int
) -> DataFrame:
    """Per key, the anchors whose gram occurs elsewhere too: (key, anchors).

    ``grams`` makes, in each task, the function from a text to the hashes of its grams.
    """
    kinds = ["<u8", "<i8", "<i4", "u1"]

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = grams()
        lot: list[list] = [[], [], []]
        held = 0
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                values = gram(text) if text else None
                anchors = anchored(values, width)[0] if values is not None else ()
                if len(anchors):
                    lot[0].append(values[anchors]), lot[1].append(np.full(len(anchors), key, "<i8"))
                    lot[2].append(anchors.astype("<i4"))
                    held += len(anchors)
                if held >= LOT:
                    yield sent(lot)
                    lot, held = [[], [], []], 0
        if held:
            yield sent(lot)

    def sent(lot: list[list]) -> pa.RecordBatch:
        h, key, at = (np.concatenate(part) for part in lot)
        by, begins = first_of(h, key, at)
        again = sizes_of(begins) > 1
        extra = by[again & ~begins]  # repeats within the lot: known to survive
        send, flag = by[begins], again[begins]
        order = np.lexsort((at[send], key[send]))
        send, flag = send[order], flag[order].astype("u1")
        rows = dealt(h[send], buckets, [h[send], key[send], at[send], flag])
        own = packed([h[extra], key[extra], at[extra], np.full(len(extra), 2, "u1")])
        spare = pa.RecordBatch.from_arrays([pa.array([int(h[0] % np.uint64(buckets))], pa.int32()), pa.array([own])], schema=DEALT)
        return pa.Table.from_batches([rows, spare]).combine_chunks().to_batches()[0]

    def judge(columns: list[np.ndarray]) -> pa.Table:
        h, key, at, flag = columns
        sure = flag == 2
        out = [(key[sure], at[sure])]
        h, key, at, flag = h[~sure], key[~sure], at[~sure], flag[~sure]
        by, begins = first_of(h)
        keep = by[(sizes_of(begins) > 1) | (flag[by] == 1)]
        out.append((key[keep], at[keep]))
        return pa.Table.from_batches([by_key(buckets, *(np.concatenate(c) for c in zip(*out, strict=True)))])

    rows = docs.mapInArrow(send, DEALT_SCHEMA)
    return lists_per_key(meet(rows, kinds, judge, DEALT_SCHEMA), ["anchors"])


def first_windows(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """Packed spans of the windows (two hashes, key, start), sent as packed records, that start earlier elsewhere."""

    def judge(columns: list[np.ndarray]) -> pa.Table:
        h, h2, key, at = columns
        by = np.lexsort((at, key, h2, h))
        late = by[later(new_window(h[by], h2[by]), key[by], at[by])]
        return pa.Table.from_batches([by_key(buckets, *merged(key[late], at[late], at[late] + length))])

    return meet(rows, WINDOW_KINDS, judge, DEALT_SCHEMA)


WINDOW_KINDS = ["<u8", "<u8", "<i8", "<i4"]


def new_window(h: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return np.append(True, (h[1:] != h[:-1]) | (h2[1:] != h2[:-1]))[: len(h)]


def sent_windows(lot: list[list], buckets: int, length: int) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """Windows of a lot as rows, each once; and packed spans of the others, which are not first.

    The last part of the lot is a hash that equal windows share, and neighbouring ones often do: it
    chooses the bucket, so that neighbours stay together and their spans join.
    """
    h, h2, key, at, home = (np.concatenate(part) for part in lot)
    by = np.lexsort((at, key, h2, h))
    h, h2, key, at, home = h[by], h2[by], key[by], at[by], home[by]
    begins = new_window(h, h2)
    late = later(begins, key, at)
    spans = by_key(buckets, *merged(key[late], at[late], at[late] + length))
    send = np.flatnonzero(begins)
    send = send[np.lexsort((at[send], key[send]))]
    return dealt(home[send], buckets, [h[send], h2[send], key[send], at[send].astype("<i4")]), spans


def merged(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each key with overlapping and touching ones joined."""
    if not len(key):
        return key, start, end
    by = np.lexsort((start, key))
    key, start, end = key[by], start[by].astype(np.int64), end[by].astype(np.int64)
    group = np.cumsum(np.append(False, key[1:] != key[:-1]))
    base = group * (int(end.max()) + 2)  # keeps the keys apart in one running maximum
    reach = np.maximum.accumulate(end + base)
    begins = np.append(True, (start + base)[1:] > reach[:-1])
    starts = np.flatnonzero(begins)
    last = np.append(starts[1:], len(by)) - 1
    return key[starts], start[starts], reach[last] - base[last]


def spans_per_key(rows: DataFrame) -> DataFrame:
    """(key, starts, ends) from packed spans."""
    return lists_per_key(rows, ["starts", "ends"], merged)


def covered(length: int, starts, ends) -> np.ndarray:
    """Mask of the covered positions; spans beyond the text are cut."""
    edge = np.zeros(length + 1, np.int64)
    if starts is not None:
        np.add.at(edge, np.minimum(starts, length), 1)
        np.add.at(edge, np.minimum(ends, length), -1)
    return np.cumsum(edge[:-1]) > 0


def fold(values: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hashes of all windows of the given length, by repeated doubling."""
    if len(values) < length:
        return values[:0]
    result, done = None, 0
    power, span = mix(values, seed + 1), 1
    while span <= length:
        if length & span:
            n = len(values) - (done + span) + 1
            result = power[:n] if result is None else mix(result[:n], power[done : done + n])
            done += span
        if span * 2 <= length:
            power = mix(power[:-span], power[span:])
        span *= 2
    return result

