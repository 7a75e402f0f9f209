"""How the sources of a language differ in their words, by single-pass in-memory indexing.

A task gathers the postings of its documents in memory (occurrences of each term per language
and source, and the number of documents that hold it).  When the block is full it leaves the task as
term-sorted runs, one per hash shard, which are written to the shared folder.  The runs of a shard are
merged by a heap into the frequencies of its terms; while a shard has too many runs for one
merge, groups of them are merged into longer runs first, so no merge grows with the corpus.

Divergences of pairs of sources are sums over all kept terms of a language, most of which a
source does not hold.  Those have one constant share per source, so the sum starts from that
constant; terms that one of the two holds come from a histogram of the shares of each source, and
only terms that both hold are met one by one, streamed over the merged frequencies: nothing is
emitted for a pair of sources of a term, only sums per task.
"""

from __future__ import annotations

import heapq
import itertools
import json
import math
import operator
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import discard, store
from tradewind.llm.exchange import buckets_for

#: Postings (term, language, source) a task holds before it spills; some 100 MB of Python objects.
BLOCK_POSTINGS = 400_000
FAN_IN = 512  # runs of a shard that one merge reads
FIRST_SHARDS, SPLIT = 512, 64  # shards of a block, and into how many a merge may split one
SHARD_CHARS = 13.3  # characters of text per record, see ``buckets_for``: about 10 MB of text a shard
BUCKET_TERMS = 20_000
PAIRS = 1_000_000  # pairs of postings computed at once
SCALE = 1_000_000_000
MIN_DOCUMENTS, TOP_TERMS = 3, 200
FREQUENCIES = "lang string, term string, total long, sources array<string>, counts array<long>"

# Bytes of letters and of all characters from U+0080 on stay, A-Z in lower case; others become blanks.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Block:
    """Postings in memory: occurrences per (lang, source) and term, documents per lang and term."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.holders: dict[str, Counter] = defaultdict(Counter)

    def add(self, lang: str, source: str, text: bytes) -> None:
        terms = text.translate(LETTERS).split()
        if terms:
            self.counts[lang, source].update(terms)
            self.holders[lang].update(set(terms))

    def __len__(self) -> int:
        return sum(map(len, self.counts.values()))

    def runs(self, shards: int) -> Iterator[tuple[int, bytes]]:
        """(shard, run): the postings of each hash shard, sorted by term and language."""
        names = sorted({source for _, source in self.counts})
        place = {name: k for k, name in enumerate(names)}
        keys: list[bytes] = []
        documents, owners, sources, counts = [], [], [], []
        of_lang: dict[str, list[tuple[str, Counter]]] = defaultdict(list)
        for (lang, source), found in self.counts.items():
            of_lang[lang].append((source, found))
        for lang, holders in sorted(self.holders.items()):
            tail, number = b"\0" + lang.encode(), dict(zip(holders, itertools.count(len(keys))))  # no term holds a zero byte
            keys += [term + tail for term in holders]
            documents.append(np.fromiter(holders.values(), np.int64, len(holders)))
            for source, found in of_lang[lang]:
                owners.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
                counts.append(np.fromiter(found.values(), np.int64, len(found)))
                sources.append(np.full(len(found), place[source], np.int64))
        if not keys:
            return
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        entry, source, n = rank[np.concatenate(owners)], np.concatenate(sources), np.concatenate(counts)
        by = np.lexsort((source, entry))
        all_keys = [keys[k] for k in order.tolist()]
        postings = Postings(all_keys, np.concatenate(documents)[order], np.bincount(entry, minlength=len(keys)), names, source[by], n[by])
        yield from postings.sharded(shards)


class Postings:
    """Terms in order, each with the number of its documents and its occurrences in some sources."""

    def __init__(self, keys: list[bytes], documents: np.ndarray, sizes: np.ndarray, names: list[str], source: np.ndarray, count: np.ndarray):
        self.keys, self.documents, self.sizes = keys, documents, sizes
        self.names, self.source, self.count = names, source, count

        self.first = np.cumsum(sizes) - sizes

    def entries(self, rows: np.ndarray) -> np.ndarray:
        """Places of the postings of some terms, term after term."""
        sizes = self.sizes[rows]
        return np.repeat(self.first[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())

    def take(self, rows: np.ndarray) -> Postings:
        at = self.entries(rows)
        keys = [self.keys[k] for k in rows.tolist()]
        return Postings(keys, self.documents[rows], self.sizes[rows], self.names, self.source[at], self.count[at])

    def sharded(self, shards: int) -> Iterator[tuple[int, bytes]]:
        """(shard, run) for every hash shard that has terms."""
        shard = np.fromiter(map(zlib.crc32, self.keys), np.int64, len(self.keys)) % shards
        by_shard = np.argsort(shard, kind="stable")
        found, starts = np.unique(shard[by_shard], return_index=True)
        for k, rows in zip(found.tolist(), np.split(by_shard, starts[1:]), strict=True):
            yield k, self.take(rows).packed()

    def packed(self) -> bytes:
        """As a compressed Arrow stream of one batch; the names of the sources go with the schema."""
        edges = pa.array(np.append(0, np.cumsum(self.sizes)), pa.int32())
        lists = [pa.ListArray.from_arrays(edges, pa.array(x, k)) for x, k in ((self.source, pa.int32()), (self.count, pa.int64()))]
        batch = pa.RecordBatch.from_arrays([pa.array(self.keys, pa.binary()), pa.array(self.documents), *lists], names=["key", "documents", "sources", "counts"])
        batch = batch.replace_schema_metadata({"sources": json.dumps(self.names)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def unpacked(run: bytes) -> Postings:
        table = pa.ipc.open_stream(run).read_all().combine_chunks()
        sources, counts = (table.column(c).chunk(0) for c in ("sources", "counts"))
        return Postings(
            table.column("key").to_pylist(), table.column("documents").to_numpy(), sources.value_lengths().to_numpy().astype(np.int64),
            json.loads(table.schema.metadata[b"sources"]), sources.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy(),
        )


def heap_merge(runs: Iterable[bytes]) -> Postings:
    """The terms of several runs in order, each once: a heap brings equal ones together, arrays add them up."""
    parts = [Postings.unpacked(run) for run in runs]
    names = sorted({name for part in parts for name in part.names})
    place = {name: k for k, name in enumerate(names)}
    first = np.cumsum([0] + [len(part.keys) for part in parts])
    merged = heapq.merge(*(zip(part.keys, range(at, at + len(part.keys))) for part, at in zip(parts, first.tolist(), strict=False)))
    keys, at = zip(*merged, strict=True)
    rows = np.array(at, np.int64)
    every = Postings(
        [], np.concatenate([p.documents for p in parts]), np.concatenate([p.sizes for p in parts]), names,
        np.concatenate([np.array([place[n] for n in p.names], np.int64)[p.source] for p in parts]), np.concatenate([p.count for p in parts]),
    )
    begins = np.append(True, np.fromiter(map(operator.ne, keys[1:], keys), bool, len(keys) - 1))
    starts, owner = np.flatnonzero(begins), np.cumsum(begins) - 1
    at = every.entries(rows)
    code = np.repeat(owner, every.sizes[rows]) * len(names) + every.source[at]
    by = np.argsort(code, kind="stable")
    code, count = code[by], every.count[at][by]
    heads = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    code = code[heads]
    sizes = np.bincount(code // len(names), minlength=len(starts))
    kept = [keys[k] for k in starts.tolist()]
    return Postings(kept, np.add.reduceat(every.documents[rows], starts), sizes, names, code % len(names), np.add.reduceat(count, heads))


def spilled(docs: DataFrame, shards: int, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Rows (shard, run) of the blocks of all tasks."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, unseen = Block(), 0
        for batch in batches:
            columns = [batch.column("lang"), batch.column("source"), batch.column("text").cast(pa.binary())]
            for start in range(0, batch.num_rows, 500):
                for lang, source, text in zip(*(c.slice(start, 500).to_pylist() for c in columns), strict=True):
                    block.add(lang, source, text)
                    unseen += len(text)
                    if unseen > 1_000_000:
                        unseen = 0
                        if len(block) >= block_postings:
                            yield from rows(block)
                            block = Block()
        yield from rows(block)

    def rows(block: Block) -> Iterator[pa.RecordBatch]:
        for shard, run in block.runs(shards):
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([run], pa.binary())], names=["shard", "run"])

    return docs.mapInArrow(work, "shard int, run binary")


def frequencies(docs: DataFrame, min_documents: int, fan_in: int = FAN_IN, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """One stored row per kept term of a language with the occurrences in each source that holds it."""

    def longer(shards: int) -> Callable[[pa.Table], pa.Table]:
        def work(table: pa.Table) -> pa.Table:
            found = list(heap_merge(table.column("run").to_pylist()).sharded(shards))
            return pa.table({"shard": pa.array([k for k, _ in found], pa.int32()), "run": pa.array([run for _, run in found], pa.binary())})

        return work

    def final(table: pa.Table) -> pa.Table:
        found = heap_merge(table.column("run").to_pylist())
        found = found.take(np.flatnonzero(found.documents >= min_documents))
        split = [key.split(b"\0", 1) for key in found.keys]
        terms, langs = (pa.array([x[k].decode("utf-8", "replace") for x in split], pa.string()) for k in (0, 1))
        edges = np.append(0, np.cumsum(found.sizes))
        totals = np.add.reduceat(found.count, edges[:-1]) if split else np.empty(0, np.int64)
        source = pa.DictionaryArray.from_arrays(pa.array(found.source, pa.int32()), pa.array(found.names, pa.string())).cast(pa.string())
        lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), x) for x in (source, pa.array(found.count))]
        return pa.table([langs, terms, pa.array(totals), *lists], names=["lang", "term", "total", "sources", "counts"])

    # a block spills to a bounded number of shards; where the text needs more, the first merges split them
    wanted = buckets_for(docs, SHARD_CHARS)
    shards = min(wanted, FIRST_SHARDS)
    runs = store(spilled(docs, shards, block_postings), "runs")
    while (most := runs.groupBy("shard").count().agg(F.max("count")).first()[0] or 0) > fan_in:
        shards *= min(SPLIT, math.ceil(wanted / shards))
        lot = F.pmod(F.xxhash64("run"), F.lit(math.ceil(most / fan_in)))
        shorter, runs = runs, store(runs.groupBy("shard", lot.alias("lot")).applyInArrow(longer(shards), "shard int, run binary"), "runs")
        discard(shorter)
    kept = store(runs.groupBy("shard").applyInArrow(final, FREQUENCIES), "frequencies")
    discard(runs)
    return kept


def quotient(a: Column, b: Column) -> Column:
    """Whole-number division, rounded down, of numbers that are not negative."""
    return F.call_function("div", a, b)


def share(count: Column, below: Column) -> Column:
    """1 + floor(1e9 * (count + 1) / below), exact beyond 64 bits on the way."""
    wide = (count.cast("decimal(19,0)") + F.lit(1)) * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + quotient(wide, below.cast("decimal(19,0)"))


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of integers."""
    return quotient((p - q) * (p - q), q)


def wide_share(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    if len(counts) and int(counts.max()) >= 9_000_000_000:  # the products leave 64 bits: Python integers
        return np.array([1 + SCALE * (int(c) + 1) // int(b) for c, b in zip(counts, below, strict=True)], np.int64)
    return 1 + (counts + 1) * SCALE // below


def shared_term_sums(sizes: np.ndarray, source: np.ndarray, p: np.ndarray, p0: np.ndarray, sources: int) -> tuple[np.ndarray, np.ndarray]:
    """For ordered pairs of sources (as first * sources + second) the sum, over the terms both hold, of
    f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0); ``sizes`` are the numbers of postings of the terms."""

    def f(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a - b) ** 2 // b

    size = np.repeat(sizes, sizes)  # of the term of each posting
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    reach = np.cumsum(size)
    codes, sums, at = [], [], 0
    while at < len(source):
        end = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + PAIRS, "right")))
        n = size[at:end]
        left = np.repeat(np.arange(at, end), n)
        right = np.repeat(first[at:end], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        apart = left != right
        left, right = left[apart], right[apart]
        a, b, a0, b0 = p[left], p[right], p0[left], p0[right]
        code, back = np.unique(source[left].astype(np.int64) * sources + source[right], return_inverse=True)
        total = np.zeros(len(code), np.int64)
        np.add.at(total, back, f(a, b) - f(a, b0) - f(a0, b) + f(a0, b0))
        codes.append(code), sums.append(total)
        at = end
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code, back = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(code), np.int64)
    np.add.at(total, back, np.concatenate(sums))
    return code, total


def pair_corrections(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): partial sums over the terms that both sources hold."""
    # buckets of terms of one language; the sources of the language come along once per bucket
    counted = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BUCKET_TERMS).cast("int").alias("buckets"))
    dealt = kept.join(counted, "lang").withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int"))
    spread = groups.join(counted, "lang").withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))

    def work(terms: pa.Table, sources: pa.Table) -> pa.Table:
        names = sources.column("source").to_pylist()
        number = {name: k for k, name in enumerate(names)}
        below = np.array(sources.column("below").to_pylist(), np.int64)
        rest = np.array(sources.column("p0").to_pylist(), np.int64)
        lists = terms.column("sources").combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        source = np.fromiter(map(number.__getitem__, lists.flatten().to_pylist()), np.int64)
        counts = terms.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        code, total = shared_term_sums(sizes, source, wide_share(counts, below[source]), rest[source], len(names))
        lang = (terms.column("lang").to_pylist() or [""])[0]
        columns = ([lang] * len(code), [names[k // len(names)] for k in code.tolist()], [names[k % len(names)] for k in code.tolist()])
        return pa.table([*(pa.array(c, pa.string()) for c in columns), pa.array(total, pa.int64())], names=["lang", "source", "item", "value"])

    right = spread.select("lang", "bucket", "source", "below", "p0").groupBy("lang", "bucket")
    left = dealt.select("lang", "bucket", "sources", "counts").groupBy("lang", "bucket")
    return left.cogroup(right).applyInArrow(work, "lang string, source string, item string, value long")


def source_divergence(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS,
    fan_in: int = FAN_IN, block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """Divergence of each source from the others of its language, and the terms that set it apart.

    Returns lang, source, part, item, value, rank.  Part ``pair`` has a row for each other source of
    the language, part ``term`` the ``top_terms`` terms with the largest excess over the language.
    Null text, lang or source count as ''.  Every row of the input is a document of its own, also where ids are
    null or repeat; an empty table gives no rows, and a language without kept terms gives pairs of value 0.
    The number of pairs is that of the result: the square of the sources of one language.
    """
    docs = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = frequencies(docs, min_documents, fan_in, block_postings)
    one = kept.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    one = one.select("lang", "term", "total", F.col("x.sources").alias("source"), F.col("x.counts").alias("n"))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("all_lang"))
    sums = one.groupBy("lang", "source").agg(F.sum("n").alias("all_group"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(of_lang, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("terms", "all_group", "all_lang")))
    below = F.col("all_group") + F.col("terms")
    empty = F.col("terms") == 0
    groups = groups.withColumn("below", F.greatest(below, F.lit(1)))
    groups = groups.withColumn("p0", F.when(empty, 1).otherwise(share(zero, F.col("below"))))
    groups = store(groups, "groups")

    # every ordered pair of sources of a language is a row of the result
    this = groups.select("lang", "source", "terms", "p0")
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = this.join(other, "lang").filter("source <> item")
    base = base.select("lang", "source", "item", (F.col("terms") * excess(F.col("p0"), F.col("q0"))).alias("value"))
    shares = one.join(groups, ["lang", "source"])
    shares = shares.select("lang", "source", "term", "total", "n", "p0", "terms", "all_lang", share(F.col("n"), F.col("below")).alias("p"))
    histogram = shares.groupBy("lang", "source", "p0", "p").count()
    met = histogram.join(other, "lang").filter("source <> item")
    p, p0, q0 = F.col("p"), F.col("p0"), F.col("q0")
    held = met.groupBy("lang", "source", "item").agg(
        F.sum(F.col("count") * (excess(p, q0) - excess(p0, q0))).alias("as_first"),
        F.sum(F.col("count") * (excess(q0, p) - excess(q0, p0))).alias("as_second"),
    )
    one_holds = held.select("lang", F.explode(F.array(
        F.struct("source", "item", F.col("as_first").alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("as_second").alias("value")),
    )).alias("x")).select("lang", "x.*")
    parts = base.unionByName(one_holds).unionByName(pair_corrections(kept, groups))
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    terms = shares.withColumn("q", share(F.col("total"), F.col("all_lang") + F.col("terms"))).filter("p > q")
    terms = terms.select("lang", "source", F.col("term").alias("item"), excess(p, F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    ranked = ranked.withColumn("part", F.lit("term"))
    both = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair")).unionByName(ranked)
    return both.select("lang", "source", "part", "item", "value", "rank")
