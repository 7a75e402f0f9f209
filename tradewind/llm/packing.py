"""Best-fit packing: documents as token sequences of bounded length.

Tokens of a document are the tokenizer's ids followed by one separator id.  Documents
longer than the capacity are cut into full pieces; only the last piece may be shorter.
Pieces are packed by online best fit in bounded space: every task keeps a fixed number
of open bins, found through a bitset with one bit per amount of free space, so placing
a piece costs a few operations on one integer whatever the number of bins.  A bin that
is full closes at once; when a new bin is needed and none may be opened, the fullest
open bin closes first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import table_batches
from tradewind.llm.tokens import TOKEN_BYTES, token_encoder

CAPACITY = 2048
OPEN_BINS = 1024
SEPARATOR = 0


class Bins:
    """Open bins of one task, keyed by free space."""

    def __init__(self, capacity: int, open_bins: int, first_id: int = 0):
        self.capacity, self.most = capacity, open_bins
        self.bits, self.count, self.next_id = 0, 0, first_id
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        bin_id = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.count -= 1
        return bin_id

    def _keep(self, free: int, bin_id: int) -> None:
        if free:
            self.by_free[free].append(bin_id)
            self.bits |= 1 << free
            self.count += 1

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece: the open bin with the least sufficient free space."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(free)
        else:
            if length < self.capacity and self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, bin_id = self.capacity, self.next_id
            self.next_id += 1
        self._keep(free - length, bin_id)
        return bin_id, self.capacity - free


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, *, with_ids: bool = False
) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 (and the ids themselves).

    A null or empty text is the separator alone.  Repeated rows give repeated pieces.
    """
    step = capacity * TOKEN_BYTES
    end = SEPARATOR.to_bytes(TOKEN_BYTES, "little")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_encoder(tokenizer_path)
        for rows in table_batches(batches):
            out: dict[str, list] = {name: [] for name in schema_names}
            encoded = encoder.encode([text or "" for text in rows["text"]])
            for doc_id, ids in zip(rows["doc_id"], encoded, strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(at // TOKEN_BYTES)
                    out["length"].append(len(part) // TOKEN_BYTES)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(part)
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    arrow, schema_names = pa.schema(fields), [name for name, _ in fields]
    spark_schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, spark_schema)


def best_fit(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``.

    The rows, small without their texts, are dealt out evenly; adaptive execution joins small
    shares, so that few bins end part-full.  Within a share a hash decides the
    order, since best fit in bounded space does well on pieces in random order.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            ids = pa.array([b for b, _ in placed], pa.int64())
            offsets = pa.array([o for _, o in placed], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, ids, offsets], names=[*batch.schema.names, "sequence_id", "offset"]
            )

    shares = pieces.hint("rebalance")
    order = [c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]
    shares = shares.sortWithinPartitions(F.xxhash64(*order), *order)
    schema = pieces.schema.simpleString()[len("struct<") : -1]
    return shares.mapInArrow(pack, schema + ",sequence_id:bigint,offset:bigint")


def best_fit_packing(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, *, with_ids: bool = False
) -> DataFrame:
    """Pack all documents; one row per piece with its place.

    Only ``doc_id`` and ``text`` are read, so other columns may have any name.  An empty
    table gives no rows; null ids stay null; texts of any length work.
    """
    return best_fit(token_pieces(docs, tokenizer_path, capacity, with_ids=with_ids), capacity, open_bins)
