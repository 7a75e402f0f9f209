"""Suffix-array dedup: repeated byte strings through a distributed merge sort of suffixes.

Only suffixes that can matter are sorted.  Every wanted string of a document names one of its
short grams, the one with the least hash; equal strings name equal grams.  Suffixes start
at (or a fixed distance before) named grams that occur elsewhere too, and are as long as the
strings they stand for.

Tasks sort their suffixes into runs and front-code them: each suffix is stored as the
length of the prefix it shares with the one before, and the rest.  Runs are cut at common
splitters and exchanged; each range merges its runs with a loser tree whose nodes remember
shared prefix lengths, so known prefixes are never compared again.  Neighbours in the merged
order that share the guaranteed prefix form a group, in which the strings are compared in full.

A suffix so frequent that it would fill ranges by itself is not merged: its strings are
exchanged one by one, by their hash, each once per lot.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import discard, store, table_batches
from tradewind.llm.exchange import (
    DEALT_SCHEMA, KINDED_SCHEMA, LOT, MEET, SPAN, anchored, buckets_for, by_key, covered, first_windows, merged, row_keyed,
    of_kind, packed, repeated_anchors, sent_windows, spans_per_key,
)

LENGTH = 100
GRAM = 32
RUN_RECORDS = 400_000
BLOCK_RECORDS = 4_096
RANGE_RECORDS = 200_000
SAMPLES = 200_000
RUNS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary()), ("run", pa.int64()),
                  ("seq", pa.int32()), ("first", pa.binary()), ("last", pa.binary()), ("n", pa.int32())])
RUNS_SCHEMA = KINDED_SCHEMA + ", run long, seq int, first binary, last binary, n int"
BLOCK = 3  # kind of a row with a block of a run; its bucket is the range
#: Odd multipliers for the doubling steps of the gram hash, and one number per byte value.
STEPS = [int(x) | 1 for x in np.random.default_rng(5).integers(2**63, size=8)]
BYTES = np.random.default_rng(6).integers(2**63, size=256, dtype=np.uint64)

# A record is (suffix, bytes before it, key, first string's start, number of strings).
Record = tuple[bytes, bytes, int, int, int]


def gram_hashes(data: bytes) -> np.ndarray:
    """Hashes of all grams; GRAM is a power of two."""
    values, span = BYTES[np.frombuffer(data, np.uint8)], 1
    if len(values) < GRAM:
        return values[:0]
    for step in STEPS:
        if span == GRAM:
            break
        values, span = values[:-span] * np.uint64(step) + values[span:], span * 2
    return (values ^ (values >> np.uint64(31))) * np.uint64(STEPS[-1])


def shared_depth(length: int) -> int:
    """Bytes that all strings of a suffix hold from its start on."""
    return (length + GRAM) // 2


def records(data: bytes, key: int, survivors: np.ndarray, length: int) -> Iterator[Record]:
    """The suffixes of one document that stand for all strings whose gram survived."""
    anchors, first, last = anchored(gram_hashes(data), length - GRAM + 1)
    keep = np.isin(anchors, survivors)
    reach = length - shared_depth(length)  # how far right of a string's start its suffix may begin
    for p, lo, hi in zip(anchors[keep].tolist(), first[keep].tolist(), last[keep].tolist(), strict=True):
        for at, a, b in ((p, max(lo, p - reach), hi), (p - reach, lo, min(hi, p - reach - 1))):
            if a <= b:
                yield data[at : b + length], data[a:at], key, a, b - a + 1


def encode_block(block: list[Record]) -> bytes:
    """Front-coded sorted records."""
    n = len(block)
    lens = np.array([len(r[0]) for r in block], np.uint16)
    table = np.array([r[0] for r in block], f"S{lens.max()}").view(np.uint8).reshape(n, -1)
    shared = np.zeros(n, np.uint16)
    differ = table[1:] != table[:-1]
    place = np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])
    shared[1:] = np.minimum(place, np.minimum(lens[1:], lens[:-1]))
    rest = b"".join([r[0][s:] for r, s in zip(block, shared.tolist(), strict=True)])
    left = b"".join([r[1] for r in block])
    columns = [np.array([n], "<i4"), shared, lens, np.array([len(r[1]) for r in block], np.uint16),
               np.array([r[2] for r in block], "<i8"), np.array([r[3] for r in block], "<i4"),
               np.array([r[4] for r in block], "<u2"), np.frombuffer(rest, "u1"), np.frombuffer(left, "u1")]
    return packed(columns)


def decode_block(payload: bytes) -> Iterator[tuple[int, Record]]:
    """(prefix shared with the record before, record) in order."""
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, at, columns = int(np.frombuffer(raw, "<i4", 1)[0]), 4, []
    for kind in ("<u2", "<u2", "<u2", "<i8", "<i4", "<u2"):
        columns.append(np.frombuffer(raw, kind, n, at).tolist())
        at += n * np.dtype(kind).itemsize
    left_at = at + sum(columns[1]) - sum(columns[0])
    before = b""
    for shared, size, left, key, start, count in zip(*columns, strict=True):
        before = before[:shared] + raw[at : at + size - shared]
        at += size - shared
        yield shared, (before, raw[left_at : left_at + left], key, start, count)
        left_at += left


def run_rows(columns: dict[str, list]) -> pa.RecordBatch:
    size = len(columns["kind"])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in RUNS], schema=RUNS
    )


def packed_rows(kind: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    bucket, payload = (c.to_pylist() for c in rows.columns)
    return run_rows({"kind": [kind] * len(bucket), "bucket": bucket, "payload": payload})


def block_rows(run: int, some: list[Record], depth: int) -> pa.RecordBatch:
    """Sorted records as rows of front-coded blocks."""
    blocks = [some[at : at + BLOCK_RECORDS] for at in range(0, len(some), BLOCK_RECORDS)]
    return run_rows({
        "kind": [BLOCK] * len(blocks), "run": [run] * len(blocks), "seq": list(range(len(blocks))),
        "first": [b[0][0][:depth] for b in blocks], "last": [b[-1][0][:depth] for b in blocks],
        "n": [len(b) for b in blocks], "payload": [encode_block(b) for b in blocks],
    })


def sorted_runs(docs: DataFrame, survivors: DataFrame, buckets: int, length: int) -> DataFrame:
    """Sorted, front-coded runs of all candidate suffixes.

    Records of a run that stand for the same bytes are one: the first; the others are removed spans.
    """
    depth = shared_depth(length)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], Record] = {}
        late: list[tuple[int, int, int]] = []
        task, runs = TaskContext.get().partitionId() << 32, 0
        for rows in table_batches(batches, 200):
            for key, text, anchors in zip(rows["key"], rows["text"], rows["anchors"], strict=True):
                for record in records((text or "").encode(), key, np.array(anchors), length):
                    place = record[:2]
                    other = held.get(place)
                    if other is None:
                        held[place] = record
                    elif other[2:4] != record[2:4]:
                        if record[2:4] < other[2:4]:
                            held[place], record = record, other
                        late.append((record[2], record[3], record[3] + record[4] - 1 + length))
            if len(held) >= RUN_RECORDS:
                yield from finished(task + runs, held, late)
                held, late, runs = {}, [], runs + 1
        if held:
            yield from finished(task + runs, held, late)

    def finished(run: int, held: dict, late: list) -> Iterator[pa.RecordBatch]:
        yield block_rows(run, sorted(held.values(), key=lambda r: r[0]), depth)
        if late:
            yield packed_rows(SPAN, by_key(buckets, *merged(*np.array(late, np.int64).T)))

    return docs.join(survivors, "key").select("key", "text", "anchors").mapInArrow(build, RUNS_SCHEMA)


def splitters_of(blocks: DataFrame) -> tuple[list[bytes], set[bytes]]:
    """Bounds of the ranges, and suffixes too frequent for one range; from a bounded sample of block heads."""
    total = blocks.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_RECORDS))
    heads = blocks.select("first", F.xxhash64("run", "seq").alias("draw")).orderBy("draw", "first")
    sample = sorted(bytes(r["first"]) for r in heads.limit(min(SAMPLES, 50 * ranges)).collect())
    bounds = [sample[k * len(sample) // ranges] for k in range(1, ranges)] if sample else []
    times = Counter(bounds)
    return sorted(times), {b for b, n in times.items() if n > 1}


def deal_ranges(blocks: DataFrame, bounds: list[bytes], hot: set[bytes], buckets: int, length: int) -> DataFrame:
    """Blocks cut at the bounds, with their range; strings of hot suffixes as packed windows."""
    depth = shared_depth(length)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot: list[list] = [[] for _ in range(5)]
        held = 0
        for rows in table_batches(batches, 20):
            out: dict[str, list] = {name: [] for name in ("kind", "bucket", "payload", "run", "seq")}
            for run, seq, first, last, payload in zip(*(rows[c] for c in ("run", "seq", "first", "last", "payload")), strict=True):
                low, high = bisect_right(bounds, first), bisect_right(bounds, last)
                between = bounds[bisect_left(bounds, first) : high]
                if low == high and not hot.intersection(between):
                    add(out, low, payload, run, seq)
                    continue
                parts: dict[int, list[Record]] = {}
                for _, record in decode_block(payload):
                    head = record[0][:depth]
                    if head in hot:
                        held += windows(record, lot)
                    else:
                        parts.setdefault(bisect_right(bounds, head), []).append(record)
                for place, some in parts.items():
                    add(out, place, encode_block(some), run, seq)
            if held >= LOT:
                yield from hot_rows(lot)
                lot, held = [[] for _ in range(5)], 0
            yield run_rows(out)
        if held:
            yield from hot_rows(lot)

    def add(out: dict, *values) -> None:
        for column, value in zip(out.values(), (BLOCK, *values), strict=True):
            column.append(value)

    def windows(record: Record, lot: list[list]) -> int:
        text, (_, _, key, start, n) = record[1] + record[0], record
        sums = [xxhash.xxh3_128_intdigest(text[j : j + length]) for j in range(n)]
        lot[0].append(np.array([s >> 64 for s in sums], "<u8")), lot[1].append(np.array([s & (2**64 - 1) for s in sums], "<u8"))
        lot[2].append(np.full(n, key, "<i8")), lot[3].append(np.arange(start, start + n, dtype="<i4"))
        lot[4].append(lot[0][-1])  # one hot suffix must not meet in one bucket
        return n

    def hot_rows(lot: list[list]) -> Iterator[pa.RecordBatch]:
        for kind, rows in zip((MEET, SPAN), sent_windows(lot, buckets, length), strict=True):
            yield packed_rows(kind, rows)

    return blocks.mapInArrow(cut, RUNS_SCHEMA)


def common_prefix(x: bytes, y: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    end = min(len(x), len(y))
    while known < end and x[known : known + 16] == y[known : known + 16]:
        known += 16
    while known < end and x[known] == y[known]:
        known += 1
    return min(known, end)


def merge_runs(runs: list[Iterator[tuple[int, Record]]]) -> Iterator[tuple[int, Record]]:
    """Merge sorted runs; yields (prefix shared with the record before, record).

    Each inner node of the tree keeps the loser of its last match and the length of the prefix it
    shares with the winner.  A record that shares more with the last output is smaller, so
    bytes are compared only where both share equally much, and only beyond that.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[tuple[int, Record] | None] = [next(run, None) for run in runs] + [None] * (size - len(runs))
    shared = [0] * size  # of each run's head with the last output, or with the winner that beat it
    losers = [0] * size

    def beats(a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; updates the loser's shared length."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        p, q = x[1][0], y[1][0]
        k = common_prefix(p, q, shared[a])
        first = len(p) == k or (k < len(q) and p[k] < q[k])
        shared[b if first else a] = k
        return first

    def build(node: int) -> int:
        if node >= size:
            return node - size
        a, b = build(2 * node), build(2 * node + 1)
        won = beats(a, b)
        losers[node] = b if won else a
        return a if won else b

    winner = build(1) if size > 1 else 0
    while heads[winner] is not None:
        yield shared[winner], heads[winner][1]
        heads[winner] = next(runs[winner], None)
        if heads[winner] is not None:
            shared[winner] = heads[winner][0]
        node = (winner + size) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


def group_spans(group: list[Record], length: int) -> Iterator[tuple[int, int, int]]:
    """Removed spans of records whose suffixes share the guaranteed prefix."""
    group.sort(key=lambda r: r[2:4])
    first: dict[tuple[bytes, bytes], Record] = {}
    for record in group:
        same = first.setdefault(record[:2], record)
        if same[2:4] != record[2:4]:
            yield record[2], record[3], record[3] + record[4] - 1 + length
    if len(first) < 2:
        return
    seen: dict[bytes, tuple[int, int]] = {}
    for right, left, key, start, n in first.values():
        text, begin = left + right, None
        for j in range(n):
            place = (key, start + j)
            if seen.setdefault(text[j : j + length], place) != place:
                begin = j if begin is None else begin
            elif begin is not None:
                yield key, start + begin, start + j - 1 + length
                begin = None
        if begin is not None:
            yield key, start + begin, start + n - 1 + length


def merged_spans(ranges: DataFrame, buckets: int, length: int) -> DataFrame:
    """Merge the runs of every range and compare neighbours; packed spans."""
    depth = shared_depth(length)

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("run", "seq", "payload")), strict=True))
        blocks: dict[int, list[bytes]] = {}
        for run, _, payload in rows:
            blocks.setdefault(run, []).append(payload)

        def records_of(payloads: list[bytes]) -> Iterator[tuple[int, Record]]:
            before = b""
            for payload in payloads:
                fresh = True
                for shared, record in decode_block(payload):
                    yield common_prefix(before, record[0], 0) if fresh else shared, record
                    before, fresh = record[0], False

        spans: list[tuple[int, int, int]] = []
        group: list[Record] = []
        for shared, record in merge_runs([records_of(p) for p in blocks.values()]):
            if shared < depth:
                if len(group) > 1:
                    spans.extend(group_spans(group, length))
                group = []
            group.append(record)
        if len(group) > 1:
            spans.extend(group_spans(group, length))
        return pa.Table.from_batches([by_key(buckets, *merged(*np.array(spans, np.int64).reshape(-1, 3).T))])

    return ranges.groupBy("bucket").applyInArrow(merge, DEALT_SCHEMA)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Packed spans (key, start, end) of bytes covered by a string of the given length that also starts earlier."""
    if length < 2 * GRAM:
        raise ValueError(f"strings must have at least {2 * GRAM} bytes")
    buckets = buckets_for(docs, 30)

    def grams():
        return lambda text: gram_hashes(text.encode())

    survivors = store(repeated_anchors(docs, grams, length - GRAM + 1, buckets), "anchors")
    runs = store(sorted_runs(docs, survivors, buckets, length), "runs")
    discard(survivors)
    blocks = runs.filter(F.col("kind") == BLOCK).select("run", "seq", "first", "last", "n", "payload")
    bounds, hot = splitters_of(blocks)
    cut = deal_ranges(blocks, bounds, hot, buckets, length)
    spans = merged_spans(cut.filter(F.col("kind") == BLOCK).select("bucket", "run", "seq", "payload"), buckets, length)
    spans = spans.unionByName(of_kind(runs, SPAN))
    if hot:
        strings = store(cut.filter(F.col("kind") != BLOCK).select("kind", "bucket", "payload"), "hot")
        spans = spans.unionByName(first_windows(of_kind(strings, MEET), length, buckets)).unionByName(of_kind(strings, SPAN))
    spans = store(spans, "spans")
    discard(runs)
    return spans


def suffix_dedup(docs: DataFrame, length: int = LENGTH, *, with_bytes: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes).

    A null or empty text has no bytes.  Rows equal in id and text count as one document, so they
    do not remove each other; texts that share an id are documents of their own, in the order of a hash of the text.  A
    null id ranks after all others and is told apart by its text.
    """
    docs = row_keyed(docs)
    spans = spans_per_key(remove_repeats(docs, length))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in table_batches(batches):
            out: list[list] = [[], [], [], [], []]
            for doc_id, text, starts, ends in zip(rows["doc_id"], rows["text"], rows["starts"], rows["ends"], strict=True):
                data, gone, pieces = (text or "").encode(), 0, 0
                kept = data
                if starts:
                    mask = covered(len(data), starts, ends)
                    gone, pieces = int(mask.sum()), int((mask & ~np.append(False, mask[:-1])).sum())
                    kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
                for column, value in zip(out, (doc_id, len(data), gone, pieces, kept), strict=True):
                    column.append(value)
            sums = [hashlib.sha256(k).hexdigest() for k in out[4]]
            columns = [*[pa.array(c, pa.int64()) for c in out[:4]], pa.array(sums, pa.string())]
            columns += [pa.array(out[4], pa.binary())] if with_bytes else []
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    joined = docs.join(spans, "key", "left").select("doc_id", "text", "starts", "ends")
    return joined.mapInArrow(cut, schema)
