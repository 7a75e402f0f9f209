"""Substring dedup by level-wise doubling.

Windows of words are compared at doubling lengths, and only what is repeated at one length is
looked at again at twice that length, until the wanted length:

1. A quarter of the length.  Every wanted window names one of its short windows, the one
   with the least hash; equal wanted windows name equal short ones.  Short windows named in
   several places survive.
2. Half the length, around the surviving ones.  Places whose halves occur nowhere else drop out.
   Where all places also agree on everything their windows cover, the first stays and the
   others are removed.
3. The full length, for the remaining places: windows one by one; a window goes
   if the same words start earlier.

All windows are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import hash_cache, mix, store, table_batches, word_hashes, words_of
from tradewind.llm.exchange import (
    KINDED_SCHEMA, LOT, MEET, PLACE, SPAN, anchored, buckets_for, by_key, covered, dealt, first_of, first_windows, fold,
    kinded, later, lists_per_key, meet, merged, of_kind, repeated_anchors, row_keyed, sent_windows, sizes_of, spans_per_key,
)

WINDOW = 20
PLACE_KINDS = ["<u8", "<u8", "<i8", "<i4", "<i4"]


def short_windows(quarter: int) -> Callable[[], Callable[[str], np.ndarray]]:
    def make() -> Callable[[str], np.ndarray]:
        cache = hash_cache()
        return lambda text: fold(word_hashes(words_of(text), cache), quarter)

    return make


def places(hashes: np.ndarray, window: int, anchors: set[int]) -> Iterator[tuple[int, int, int, int]]:
    """(half-window hash, hash of all that is covered, first window, number of windows) of surviving anchors.

    A place's windows hold the half window right of the anchor, or the one from a quarter left of it.
    """
    quarter, half = window // 4, window // 2
    found, first, last = anchored(fold(hashes, quarter), window - quarter + 1)
    halves = fold(hashes, half)
    for p, lo, hi in zip(found.tolist(), first.tolist(), last.tolist(), strict=True):
        if p not in anchors:
            continue
        for side, a, b in ((0, max(lo, p - half), hi), (1, lo, min(hi, p - half - 1))):
            if a <= b:
                half_hash = int(halves[p - side * quarter])
                content = hashes[a : b + window].tobytes() + bytes([p - a, b - a, side])
                yield half_hash ^ side, xxhash.xxh3_64_intdigest(content), a, b - a + 1


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Packed spans (key, start, end) of words covered by a window that also starts earlier."""
    if window % 4:
        raise ValueError("the window must be a multiple of four words")
    quarter = window // 4
    buckets = buckets_for(docs, 40)
    survivors = store(repeated_anchors(docs, short_windows(quarter), window - quarter + 1, buckets), "anchors")

    def second_level(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, lot = hash_cache(), []
        for rows in table_batches(batches):
            for key, text, anchors in zip(rows["key"], rows["text"], rows["anchors"], strict=True):
                hashes = word_hashes(words_of(text), cache)
                lot += [(h, c, key, a, n) for h, c, a, n in places(hashes, window, set(anchors))]
            if len(lot) >= LOT // 3:
                yield from send(lot)
                lot = []
        if lot:
            yield from send(lot)

    def send(lot: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, c, key, at, n = (np.array(x, kind) for x, kind in zip(zip(*lot, strict=True), PLACE_KINDS, strict=True))
        by, begins = first_of(mix(h, c), key, at)
        late = by[later(begins, key[by], at[by])]
        yield kinded(SPAN, by_key(buckets, *merged(key[late], at[late], at[late] + n[late] - 1 + window)))
        by = by[begins]
        by = by[np.lexsort((at[by], key[by]))]
        yield kinded(MEET, dealt(h[by], buckets, [x[by] for x in (h, c, key, at, n)]))

    def judge(columns: list[np.ndarray]) -> pa.Table:
        h, c, key, at, n = columns
        by, begins = first_of(h, key, at)
        h, c, key, at, n = (x[by] for x in (h, c, key, at, n))
        group = np.cumsum(begins) - 1
        starts = np.flatnonzero(begins)
        alike = np.logical_and.reduceat(c == c[starts][group], starts) if len(starts) else np.empty(0, bool)
        several = sizes_of(begins) > 1
        late = several & alike[group] & later(begins, key, at) if len(starts) else several
        spans = by_key(buckets, *merged(key[late], at[late], at[late] + n[late] - 1 + window))
        open_ = several & ~alike[group] if len(starts) else several
        return pa.Table.from_batches([kinded(SPAN, spans), kinded(PLACE, by_key(buckets, key[open_], at[open_], n[open_]))])

    halves = store(docs.join(survivors, "key").mapInArrow(second_level, KINDED_SCHEMA), "halves")
    judged = store(meet(of_kind(halves, MEET), PLACE_KINDS, judge, KINDED_SCHEMA), "places")
    rest = lists_per_key(of_kind(judged, PLACE), ["starts", "counts"])

    def third_level(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, lot, held = hash_cache(), [[] for _ in range(5)], 0
        for rows in table_batches(batches):
            for key, text, begin, count in zip(*(rows[c] for c in ("key", "text", "starts", "counts")), strict=True):
                hashes = word_hashes(words_of(text), cache)
                starts = np.unique(np.concatenate([np.arange(a, a + n) for a, n in zip(begin, count, strict=True)]))
                starts = starts[starts <= len(hashes) - window]
                lot[0].append(fold(hashes, window)[starts]), lot[1].append(fold(hashes, window, 7)[starts])
                lot[2].append(np.full(len(starts), key, "<i8")), lot[3].append(starts.astype("<i4"))
                grams = fold(hashes, quarter)
                anchors, first, _ = anchored(grams, window - quarter + 1)
                lot[4].append(grams[anchors[np.searchsorted(first, starts, "right") - 1]])
                held += len(starts)
            if held >= LOT:
                yield from packed_windows(lot)
                lot, held = [[] for _ in range(5)], 0
        if held:
            yield from packed_windows(lot)

    def packed_windows(lot: list[list]) -> Iterator[pa.RecordBatch]:
        rows, spans = sent_windows(lot, buckets, window)
        yield kinded(MEET, rows)
        yield kinded(SPAN, spans)

    full = store(docs.join(rest, "key").mapInArrow(third_level, KINDED_SCHEMA), "windows")
    windows = first_windows(of_kind(full, MEET), window, buckets)
    for part in (halves, judged, full):
        windows = windows.unionByName(of_kind(part, SPAN))
    return windows


def substring_dedup(docs: DataFrame, window: int = WINDOW, *, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and the kept words as a text).

    A null or empty text has no words.  Rows equal in id and text count as one document, so they
    do not remove each other; texts that share an id are documents of their own, in the order of a hash of the text.  A
    null id ranks after all others and is told apart by its text.
    """
    docs = row_keyed(docs)
    spans = spans_per_key(remove_repeats(docs, window))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in table_batches(batches):
            out: list[list] = [[], [], [], []]
            for doc_id, text, starts, ends in zip(rows["doc_id"], rows["text"], rows["starts"], rows["ends"], strict=True):
                words = words_of(text)
                kept = words
                if starts:
                    gone = covered(len(words), starts, ends)
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                joined = " ".join(kept)
                out[0].append(doc_id), out[1].append(len(words)), out[2].append(len(words) - len(kept))
                out[3].append(joined)
            sums = [hashlib.sha256(t.encode()).hexdigest() for t in out[3]]
            columns = [*[pa.array(c, pa.int64()) for c in out[:3]], pa.array(sums, pa.string())]
            columns += [pa.array(out[3], pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    joined = docs.join(spans, "key", "left").select("doc_id", "text", "starts", "ends")
    return joined.mapInArrow(cut, schema)
