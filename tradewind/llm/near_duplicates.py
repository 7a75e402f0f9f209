"""Near duplicates by SuperMinHash, banding, verification and components.

A document's set holds the distinct shingles of its words.  Documents with the same
set form one class, so copies cost one row each.  The smallest id of a class carries a
SuperMinHash signature: every shingle walks through a random permutation of the
slots, offering ``step + random`` to the slot of each step, and a document's walk stops when no
later step can lower a slot.  Equal bands make candidates; a sketch of one bit per slot
drops hopeless ones; the others are confirmed on full sets.

In each of a few rounds a bucket has one pivot, another one each time, and every member outside
the pivot's component is compared with the most promising pivot of its buckets.  So a group of
near copies needs a few comparisons per member.  Where that leaves a bucket in several components,
links across them are sought by rare shingles: two sets that are similar enough share one of
their rarest, so sets that merely resemble a linked group meet none of its members, and
no link that could join two components is left untested.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import Cache, discard, mix, store, table_batches, word_hashes
from tradewind.llm.components import connected
from tradewind.llm.exchange import document_key, keyed

BYTE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
# Sets of similarity 0.8 differ in 16 of 160 bits, give or take 3.8: six deviations away.
MOST_BITS = 39
CHUNK_SHINGLES = 100_000
#: Ids are ordered by their bits against these patterns to choose the pivot of each round.
ORDERS = (0, 0x5DEECE66D5DEECE6, 0x2545F4914F6CDD1D, 0x369DEA0F31A53F85)


def shingle_set(text: str | None, words: int, cache: Cache) -> np.ndarray:
    """Sorted distinct shingle hashes; A-Z count as a-z; fewer words make one shingle."""
    found = BYTE_WORD.findall(text.encode().lower()) if text else []
    hashes = word_hashes(found, cache)
    n = len(hashes)
    if not n:
        return hashes
    size = min(words, n)
    shingles = mix(hashes[: n - size + 1], size)
    for k in range(1, size):
        shingles = mix(shingles, hashes[k : n - size + 1 + k])
    return np.unique(shingles)


def superminhash(shingles: np.ndarray, owner: np.ndarray, owners: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (owners x slots) of shingle sets given one after the other."""
    values = np.full(owners * slots, np.inf)
    for start in range(0, len(shingles), CHUNK_SHINGLES):
        seeds, docs = shingles[start : start + CHUNK_SHINGLES], owner[start : start + CHUNK_SHINGLES]
        first, last = docs[0], docs[-1] + 1
        # the part of each permutation that swaps have changed is all that is looked at
        places = np.empty((len(seeds), slots), np.uint8)
        places[:] = np.arange(slots, dtype=np.uint8)
        active = np.arange(len(seeds))
        for step in range(slots):
            bits = mix(seeds[active], step + 1)
            fraction = (bits >> np.uint64(11)).astype(np.float64) * 2.0**-53
            pick = mix(bits, 0x5851F42D) >> np.uint64(32)
            pick = step + ((pick * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
            slot = places[active, pick]
            places[active, pick] = places[active, step]
            np.minimum.at(values, docs[active] * slots + slot, step + fraction)
            open_docs = values.reshape(owners, slots)[first:last].max(axis=1) >= step + 1
            active = active[open_docs[docs[active] - first]]
            if not len(active):
                break
    return values.reshape(owners, slots)


def signed_documents(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, key, text_key, n_shingles, set_key (null for no words), band keys, the sketch in three numbers, and row.

    The key is the id, or for a null id a hash of the text; the row number tells equal rows apart.
    """

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(xxhash.xxh3_64_intdigest)
        for rows in table_batches(batches, 500):
            sets = [shingle_set(text, words, cache) for text in rows["text"]]
            sizes = np.array([len(s) for s in sets])
            some = np.flatnonzero(sizes)
            bands, sketch = [None] * len(sets), np.zeros((len(sets), 3), np.int64)
            if len(some):
                owner = np.repeat(np.arange(len(some)), sizes[some])
                values = superminhash(np.concatenate([sets[k] for k in some]), owner, len(some)).view(np.uint64)
                keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(some), 1))
                for r in range(ROWS):
                    keys = mix(keys, values[:, r::ROWS])
                parity = mix(values, 1) >> np.uint64(63)
                weights = np.uint64(1) << (np.arange(SLOTS, dtype=np.uint64) % np.uint64(63))
                parts = [(parity * weights)[:, at : at + 63].sum(axis=1, dtype=np.uint64) for at in (0, 63, 126)]
                sketch[some] = np.stack(parts, axis=1).astype(np.int64)
                for k, row in zip(some, keys.view(np.int64).tolist(), strict=True):
                    bands[k] = row
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(rows[c], pa.int64()) for c in ids], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), *[pa.array(sketch[:, k]) for k in range(3)]],
                names=[*ids, "n_shingles", "set_key", "bands", "s0", "s1", "s2"],
            )

    ids = ["doc_id", "key", "text_key"]
    schema = "doc_id long, key long, text_key long, n_shingles long, set_key binary, bands array<long>, s0 long, s1 long, s2 long"
    signed = keyed(docs).select("doc_id", "key", text_key().alias("text_key"), "text").mapInArrow(sign, schema)
    return signed.withColumn("row", F.monotonically_increasing_id())


def text_key() -> Column:
    """With the key, tells rows of one id apart by their text."""
    return F.xxhash64(F.lit(1), "text")


def unequal_bits() -> Column:
    return sum((F.bit_count(F.col(f"a_{s}").bitwiseXOR(F.col(f"b_{s}"))) for s in ("s0", "s1", "s2")), F.lit(0))


def likely(percent: int) -> Column:
    """Whether sizes and sketches of a pair allow the similarity."""
    least, most = F.least("a_n_shingles", "b_n_shingles"), F.greatest("a_n_shingles", "b_n_shingles")
    return (100 * least >= percent * most) & (unequal_bits() <= MOST_BITS)


def described(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sketch columns of both, prefixed a_ and b_."""
    for side in "ab":
        names = [F.col(c).alias(f"{side}_{c}") for c in sketches.columns if c != "node"]
        pairs = pairs.join(sketches.select(F.col("node").alias(side), *names), side)
    return pairs


def full_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, items): the shingle sets of the given documents.

    The merge hint keeps the plan, and so the disk a run needs, the same at every size.
    """

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(xxhash.xxh3_64_intdigest)
        for rows in table_batches(batches, 500):
            sets = [shingle_set(text, words, cache).tobytes() for text in rows["text"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["node"], pa.int64()), pa.array(sets, pa.binary())], names=["node", "items"]
            )

    texts = keyed(docs).withColumnRenamed("key", "node")
    # copies of a text without id are one node and need one set, however many they are
    unnamed = texts.filter("doc_id IS NULL").select("node", "text").dropDuplicates(["node"])
    texts = texts.filter("doc_id IS NOT NULL").select("node", "text").unionByName(unnamed)
    texts = texts.join(nodes.hint("merge"), "node", "left_semi")
    return store(texts.mapInArrow(build, "node long, items binary"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, hint: str | None = None) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in table_batches(batches, 200):
            keep = []
            for k, (x, y) in enumerate(zip(rows["a_items"], rows["b_items"], strict=True)):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    keep.append(k)
            out = [pa.array([rows[c][k] for k in keep], pa.int64()) for c in "ab"]
            yield pa.RecordBatch.from_arrays(out, names=["a", "b"])

    for side in "ab":
        pairs = pairs.hint(hint) if hint else pairs
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("items").alias(f"{side}_items")), side)
    links = pairs.select("a", "b", "a_items", "b_items").mapInArrow(compare, "a long, b long")
    return store(links.distinct(), "similar")


def rare_items(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, item, place, n): each set's rarest shingles, of which similar sets share at least one.

    ``place`` counts from 1 in one order of all shingles, by the number of sets that hold them.
    Similar sets of at most n items share percent * n / 100, so at least one among the first
    n - that + 1.  Shingles of one set alone are left out, as nothing meets there.  A node may
    have several sets, or one of them several times, where rows share an id.
    """

    def items(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in table_batches(batches, 100):
            found = [np.frombuffer(packed, np.int64) for packed in rows["items"]]
            sizes = np.array([len(f) for f in found], np.int64)
            keys = np.array([xxhash.xxh3_64_intdigest(packed) for packed in rows["items"]], np.uint64).view(np.int64)
            owner = [np.repeat(column, sizes) for column in (np.array(rows["node"], np.int64), keys, sizes)]
            columns = [*owner, np.concatenate(found)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "key", "n", "item"])

    held = sets.join(nodes, "node", "left_semi").mapInArrow(items, "node long, key long, n long, item long")
    counts = held.groupBy("item").agg(F.count(F.lit(1)).alias("holders"))
    place = F.dense_rank().over(Window.partitionBy("node", "key", "n").orderBy("holders", "item"))
    ranked = held.join(counts, "item").withColumn("place", place)
    first = ranked.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    return store(first.filter("holders > 1").select("node", "item", "place", "n"), "rare")


def pairs_across(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may be similar; nodes carry component, size and sketch.

    Seen from the rarest item that a similar pair shares, what follows in both sets must
    suffice for the similarity; other items of the pair need not pass.
    """
    rare = rare_items(nodes.select("node"), sets, percent).join(nodes, "node")
    names = [c for c in rare.columns if c != "item"]
    left, right = (rare.select("item", *[F.col(c).alias(f"{s}_{c}") for c in names]) for s in "ab")
    rest = 1 + F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    enough = (100 + percent) * rest >= percent * (F.col("a_n") + F.col("b_n"))
    across = left.join(right, "item").filter((F.col("a_component") < F.col("b_component")) & likely(percent) & enough)
    return store(across.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct(), "pairs")


def with_components(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    return nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Links join documents whose shingle sets share at least ``percent`` per cent of their union;
    component_id is the smallest id reachable.  A text without words has no shingles and no
    links.  Rows that share an id count as one document linked with itself.  Rows with a null id are
    documents of their own and rank last: where no id is reachable, component_id is null and one row is kept.
    """
    return judged_documents(docs, words, percent).select("doc_id", "n_shingles", "component_id", "kept")


def distinct_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that ``near_duplicates`` keeps; of rows equal in id and text, one stays."""
    names = ["_key", "_text_key"]
    kept = judged_documents(docs, words, percent).filter("kept").select(F.col("key").alias("_key"), F.col("text_key").alias("_text_key"))
    # the rows as structs, so that columns of any name can come along
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    own = docs.select(whole, document_key(docs).alias("_key"), text_key().alias("_text_key"))
    # copies meet within tasks first, so that many of them are no hot key
    return own.dropDuplicates(names).join(kept.distinct(), names, "left_semi").select("row.*")


def judged_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The columns of ``near_duplicates``, and key and text_key, which tell the rows of an id apart."""
    signed = store(signed_documents(docs, words), "signed")
    least = F.min(F.struct("key", "row", "doc_id")).alias("least")
    classes = signed.filter("set_key IS NOT NULL").groupBy("set_key").agg(least, F.min("doc_id").alias("smallest_id"))
    classes = store(
        classes.select("set_key", F.col("least.key").alias("node"), F.col("least.row").alias("first"),
                       F.col("least.doc_id").isNull().alias("unnamed"), "smallest_id"),
        "classes",
    )
    # the class's row with the smallest key stands for it
    chosen = signed.join(classes.select("node", F.col("first").alias("row")), "row")
    nodes = store(chosen.select("node", "n_shingles", "bands", "s0", "s1", "s2"), "nodes")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    members = store(banded.join(shared.filter("first < last").select("band"), "band"), "members")
    sets = full_sets(docs, members.select("node").distinct(), words)

    parts = docs.sparkSession.createDataFrame([], "node long, component long")
    links = None
    for order in ORDERS:
        placed, sketches = with_components(members, parts), with_components(nodes.drop("bands"), parts)
        pivot = F.min(F.col("node").bitwiseXOR(F.lit(order))).bitwiseXOR(F.lit(order)).alias("a")
        pivots = placed.groupBy("band").agg(pivot, F.min("component").alias("low"), F.max("component").alias("high"))
        stars = members.join(pivots.filter("low < high").select("band", "a"), "band").filter("a <> node")
        pairs = described(stars.select("a", F.col("node").alias("b")).distinct(), sketches)
        pairs = pairs.filter(likely(percent) & (F.col("a_component") != F.col("b_component")))
        best = pairs.groupBy("b").agg(F.min(F.struct(unequal_bits().alias("bits"), "a")).alias("best"))
        chosen = store(best.select(F.col("best.a").alias("a"), "b"), "pairs")
        if links is not None and chosen.isEmpty():
            break
        found = confirmed(chosen, sets, percent, "merge" if links is None else None)
        links = found if links is None else links.unionByName(found)
        parts = store(connected(links), "parts")

    # buckets that still span several components
    placed = with_components(members, parts)
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    among = placed.join(mixed.filter("low < high").select("band"), "band").select("node", "component").distinct()
    pairs = pairs_across(store(among.join(nodes.drop("bands"), "node"), "mixed"), sets, percent)
    if not pairs.isEmpty():
        links = links.unionByName(confirmed(pairs, sets, percent))
        parts = store(connected(links), "parts")
    discard(members, sets, nodes)

    # components named by a text: their smallest id, if any
    placed = with_components(classes, parts)
    roots = placed.filter("unnamed AND node = component").select("component")
    named = placed.join(roots, "component", "left_semi").groupBy("component").agg(F.min("smallest_id").alias("named"))
    named = named.select(F.col("component").alias("root"), "named", F.lit(True).alias("by_text"))
    classes = classes.select("set_key", "node", "first")
    found = signed.select("doc_id", "key", "text_key", "row", "n_shingles", "set_key").join(classes, "set_key", "left")
    found = with_components(found, parts)
    found = found.join(named, F.col("component") == F.col("root"), "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).when(F.col("by_text"), F.col("named"))
    found = found.withColumn("component_id", component.otherwise(F.col("component")))
    first = F.col("set_key").isNull() | ((F.col("row") == F.col("first")) & (F.col("node") == F.col("component")))
    kept = F.when(F.col("doc_id").isNull(), F.col("component_id").isNull() & first)
    kept = kept.otherwise(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return found.select("doc_id", "key", "text_key", "n_shingles", "component_id", kept.alias("kept"))
