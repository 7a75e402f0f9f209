"""Ranked lexical search by K2-treaps over a grid of terms and documents.

Postings carry the whole impact of a term in a document, an integer.  Documents are dealt to grids of
bounded size; a grid's rows are terms and its columns documents.  Each grid becomes a compressed quadtree:
level by level a 4-bit mask of the quadrants that hold postings, and the largest impact of every quadrant, kept as the
difference to that of its parent.  Terms of like weight are neighbouring rows and documents
with the same strongest term neighbouring columns, so that maxima fall quickly on the way down.

An item asks a grid with the rows of its terms.  A range of documents stands for one cell per
row, and the sum of their maxima bounds the scores within; ranges are halved best first, the rows' paths
descending together, until no range can reach the k-th best score found.  A single column's bound is its score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import Cache, discard, store

K = 50
GRID_POSTINGS = 400_000  # average postings of a grid
BEAM = 32  # ranges halved at once, or twice the number of results if that is more
FILTER_BITS = 1 << 20
INDEX = "shard int, payload binary"

# Bytes of digits, letters and all characters from U+0080 on stay, A-Z in lower case; others become blanks.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# For a mask of quadrants and a quadrant: its place among the children, -1 if absent.
PLACE = np.array([[bin(m & ((1 << q) - 1)).count("1") if m >> q & 1 else -1 for q in range(4)] for m in range(16)], np.int8)
ONES = np.array([bin(m).count("1") for m in range(16)], np.int64)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


def filter_bit(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) & (FILTER_BITS - 1)


# ---------------------------------------------------------------- the grid


def spread(x: np.ndarray) -> np.ndarray:
    """Put a zero bit before every bit of 31-bit numbers."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def narrow(values: np.ndarray) -> np.ndarray:
    """The same non-negative numbers in as few bytes as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


class Grid:
    """A quadtree over points (row, column, impact > 0), at most one per cell, with maxima in its nodes.

    Node 0 stands for cells without points, node 1 is the root.  ``masks`` tells which quadrants (2 * lower
    half of the rows + right half of the columns) a node has; its children follow one another from ``first``.
    """

    def __init__(self, height: int, masks: list[np.ndarray], drops: list[np.ndarray], top: int):
        """Masks of each level above the cells, differences to the parent of each level below the root, and the root's maximum."""
        self.height = height
        maxima, level = [np.array([0, top], np.int64)], np.array([top], np.int64)
        for mask, drop in zip(masks, drops, strict=True):
            level = np.repeat(level, ONES[mask]) - drop.astype(np.int64)
            maxima.append(level)
        leaves = len(maxima[-1]) if height else 1
        self.maxima = np.concatenate(maxima)
        self.masks = np.concatenate([np.zeros(1, np.uint8), *masks, np.zeros(leaves, np.uint8)]).astype(np.int64)
        self.first = 2 + np.cumsum(ONES[self.masks]) - ONES[self.masks]

    @staticmethod
    def levels(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> tuple[int, list[np.ndarray], list[np.ndarray], int]:
        """What the constructor takes."""
        side = int(max(rows.max(initial=0), columns.max(initial=0))) + 1
        height = max(0, math.ceil(math.log2(side)))
        code = (spread(rows) << np.uint64(1)) | spread(columns)
        by = np.argsort(code)
        code, best = code[by], impacts[by].astype(np.int64)
        masks, drops = [], []
        for _ in range(height):
            above = code >> np.uint64(2)
            starts = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
            top = np.maximum.reduceat(best, starts)
            masks.append(np.bitwise_or.reduceat(1 << (code & np.uint64(3)).astype(np.int64), starts).astype(np.uint8))
            drops.append(narrow(np.repeat(top, np.diff(np.append(starts, len(code)))) - best))
            code, best = above[starts], top
        return height, masks[::-1], drops[::-1], int(best.max(initial=0))

    def best_columns(self, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns whose summed impacts over the rows are above 0 and among the k largest, ties included."""
        beam = max(BEAM, 2 * k)
        found_at, found, floor = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 1
        nodes = np.ones((1, len(rows)), np.int64)
        level, column = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = self.maxima[nodes].sum(axis=1)
        if self.height == 0:
            return (column, bound) if bound[0] >= floor else (found_at[0], found[0])
        while len(bound):
            if len(bound) > beam:
                order = np.argpartition(-bound, beam)
                now, later = order[:beam], order[beam:]
                later = later[bound[later] >= floor]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            now = now[bound[now] >= floor]
            below = self.height - 1 - level[now]
            lower = (rows[None, :] >> below[:, None]) & 1
            masks, first = self.masks[nodes[now]], self.first[nodes[now]]
            parts = [(nodes[later], level[later], column[later], bound[later])]
            for half in (0, 1):
                place = PLACE[masks, 2 * lower + half]
                child = np.where(place >= 0, first + place, 0)
                reach = self.maxima[child].sum(axis=1)
                at = 2 * column[now] + half
                done = (below == 0) & (reach >= floor)
                if done.any():
                    found_at.append(at[done]), found.append(reach[done])
                more = (below > 0) & (reach >= floor)
                parts.append((child[more], level[now][more] + 1, at[more], reach[more]))
            if len(found) > 1:
                found_at, found = [np.concatenate(found_at)], [np.concatenate(found)]
                if len(found[0]) >= k:
                    floor = max(floor, int(np.partition(found[0], len(found[0]) - k)[len(found[0]) - k]))
                    some = found[0] >= floor
                    found_at, found = [found_at[0][some]], [found[0][some]]
            nodes, level, column, bound = (np.concatenate(p) for p in zip(*parts, strict=True))
        return found_at[0], found[0]


def packed_grid(term_no: np.ndarray, doc: np.ndarray, weight: np.ndarray, impact: np.ndarray, ids: np.ndarray, has_id: np.ndarray) -> bytes:
    """A grid as bytes: its terms by row, the ids of its columns, and its levels.

    ``doc`` numbers the documents from 0; ``ids`` and ``has_id`` belong to them.
    """
    by_weight = np.lexsort((term_no, -weight))
    begins = np.append(True, term_no[by_weight][1:] != term_no[by_weight][:-1])
    terms = term_no[by_weight][begins]
    row = np.empty(len(term_no), np.int64)
    row[by_weight] = np.cumsum(begins) - 1
    strongest = np.lexsort((row, -impact, doc))
    heads = strongest[np.append(True, doc[strongest][1:] != doc[strongest][:-1])]  # one posting per document
    columns = np.lexsort((-impact[heads], row[heads]))
    column = np.empty(len(ids), np.int64)
    column[doc[heads][columns]] = np.arange(len(columns))
    place = doc[heads][columns]
    height, masks, drops, top = Grid.levels(row, column[doc], impact)
    sink = pa.BufferOutputStream()
    arrays = [terms, ids[place], has_id[place], np.array([top]), *masks, *drops]
    table = pa.table({str(k): pa.array([a.tobytes()], pa.binary()) for k, a in enumerate(arrays)})
    table = table.append_column("kinds", pa.array([[a.dtype.str for a in arrays]])).append_column("height", pa.array([height]))
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue())


def unpacked_grid(payload: bytes) -> tuple[Grid, np.ndarray, np.ndarray, np.ndarray]:
    """(grid, terms of the rows, ids of the columns, whether they have one)."""
    row = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)).read_all().to_pylist()[0]
    arrays = [np.frombuffer(row[str(k)], kind) for k, kind in enumerate(row["kinds"])]
    terms, ids, has_id, top = arrays[:4]
    height = row["height"]
    return Grid(height, arrays[4 : 4 + height], arrays[4 + height :], int(top[0])), terms, ids, has_id


# ---------------------------------------------------------------- the jobs


def postings_of(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """(term, row, doc_id, tf, n) for terms that pass the filter; a row without term holds the number and length of some documents."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(asked)
        wanted = Cache(lambda term: bool(bits[filter_bit(term)]))
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for start in range(0, batch.num_rows, 500):
                terms, counts, sizes, held = [None], [0], [], []
                for text in texts.slice(start, 500).to_pylist():
                    words = terms_of(text)
                    found = {t: c for t, c in Counter(words).items() if wanted[t]}
                    terms.extend(found), counts.extend(found.values())
                    sizes.append(len(words)), held.append(len(found))
                counts[0] = sum(1 for n in sizes if n)
                take = pa.array(np.repeat(np.arange(len(held)), held))
                none = pa.nulls(1, pa.int64())
                columns = [pa.array(terms, pa.binary())]
                for name in ("row", "doc_id"):
                    some = batch.column(name).slice(start, 500).take(take)
                    columns.append(pa.concat_arrays([none, some]))
                n = np.append(sum(sizes), np.repeat(sizes, held)).astype(np.int64)
                columns += [pa.array(counts, pa.int64()), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "row", "doc_id", "tf", "n"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(work, "term binary, row long, doc_id long, tf long, n long")


def terms_of_items(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            terms = pa.array([t for f in found for t in f], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(take), terms], names=["item_id", "term"])

    rows = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text"))
    return rows.mapInArrow(work, "item_id long, term binary").distinct()


def term_filter(asked: DataFrame) -> np.ndarray:
    """A fixed number of bits (128 KB), set for every asked term: what it lets through is joined exactly later."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(np.fromiter(map(filter_bit, batch.column("term").to_pylist()), np.int64, batch.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(bits)], names=["bit"])

    found = asked.select("term").mapInArrow(work, "bit long").distinct().toArrow()  # at most FILTER_BITS numbers
    flags = np.zeros(FILTER_BITS, np.uint8)
    flags[found.column("bit").to_numpy()] = 1
    return np.packbits(flags)


def build_index(docs: DataFrame, item_terms: DataFrame, grid_postings: int = GRID_POSTINGS) -> tuple[DataFrame, DataFrame, int]:
    """(grids, terms with their numbers, number of grids) over all documents, for the terms that items ask."""
    raw = store(postings_of(docs, term_filter(item_terms)), "postings")
    size = raw.filter("term IS NULL").agg(F.sum("tf").alias("docs"), F.sum("n").alias("length")).first()
    n_docs, length = size.docs or 0, size.length or 0
    found = raw.filter("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    terms = found.join(item_terms.select("term").distinct(), "term", "left_semi")
    terms = store(terms.select("term", "df", weight.alias("w"), F.monotonically_increasing_id().alias("term_no")), "terms")
    shards = max(1, math.ceil((terms.agg(F.sum("df")).first()[0] or 0) / grid_postings))
    m = F.lit(50).cast("long") + F.call_function("div", F.col("n") * (50 * n_docs), F.lit(max(length, 1)).cast("long"))
    part = F.call_function("div", F.col("tf") * 1_000_000_000, F.col("tf") * 1000 + 20 * F.col("m"))
    graded = raw.filter("term IS NOT NULL").join(terms.select("term", "w", "term_no"), "term").withColumn("m", m)
    graded = graded.select("row", "doc_id", "term_no", "w", (F.col("w") * part).alias("impact")).filter("impact > 0")
    graded = graded.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        row, term_no, w, impact = (table.column(c).to_numpy() for c in ("row", "term_no", "w", "impact"))
        _, head, doc = np.unique(row, return_index=True, return_inverse=True)
        ids = table.column("doc_id").take(pa.array(head)).combine_chunks()
        payload = packed_grid(term_no, doc, w, impact, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False))
        return pa.table([table.column("shard").slice(0, 1), pa.array([payload], pa.binary())], names=["shard", "payload"])

    grids = store(graded.groupBy("shard").applyInArrow(build, INDEX), "grids")
    discard(raw)
    return grids, terms, shards


def search(docs: DataFrame, items: DataFrame, k: int = K, grid_postings: int = GRID_POSTINGS) -> DataFrame:
    """The k best documents of each item: item_id, rank (from 1), doc_id, score; ties to the smaller doc_id, null ids last.

    Items that share an id (null included) are one item with the terms of all; an item without terms, or
    whose terms no document holds, has no rows.  Every row of ``docs`` is a document of its own, so repeated rows take a
    place each.  Null and empty texts are found by nothing.  Scores and impacts must fit 64 bits.
    """
    item_terms = store(terms_of_items(items), "item-terms")
    grids, terms, shards = build_index(docs, item_terms, grid_postings)
    asking = item_terms.join(terms.select("term", "term_no"), "term").groupBy("item_id").agg(F.collect_list("term_no").alias("rows"))
    # a grid's partition first brings the grid, then the items one after the other
    asking = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    asking = asking.select("shard", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("payload"), "item_id", "rows")
    none = (F.lit(None).cast("long").alias("item_id"), F.lit(None).cast("array<long>").alias("rows"))
    meeting = grids.select("shard", F.lit(0).alias("kind"), "payload", *none).unionByName(asking)
    meeting = meeting.repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, grid = None, None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            kind = batch.column("kind").to_numpy()
            out: list[list] = [[], [], []]
            for at in range(batch.num_rows):
                if kind[at] == 0:
                    current = shard[at]
                    grid, row_terms, ids, has_id = unpacked_grid(batch.column("payload")[at].as_py())
                    order = np.argsort(row_terms)
                    in_order = row_terms[order]
                elif current == shard[at]:
                    rows = np.array(batch.column("rows")[at].as_py(), np.int64)
                    place = np.minimum(np.searchsorted(in_order, rows), len(in_order) - 1)
                    mine = order[place[in_order[place] == rows]]
                    if len(mine):
                        column, score = grid.best_columns(mine, k)
                        best = np.lexsort((ids[column], ~has_id[column], -score))[:k]
                        out[0] += [batch.column("item_id")[at].as_py()] * len(best)
                        out[1] += [i if h else None for i, h in zip(ids[column[best]].tolist(), has_id[column[best]].tolist(), strict=True)]
                        out[2] += score[best].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["item_id", "doc_id", "score"])

    found = meeting.mapInArrow(ask, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
