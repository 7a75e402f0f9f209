"""The text operators against brute-force versions, on edge cases and the smallest tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tradewind.llm import (
    importance, language_id, mixing, near_duplicates, packing, personal_data, quality_rules, substring, suffix_dedup,
    topk_search,
)
from tradewind.llm.exchange import keyed
from tradewind.llm.queries import QUERIES, table, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, key string, payload int, bucket string"


@pytest.fixture(scope="module")
def texts():
    """Prose with copies, near copies, shared passages, odd characters and long and empty texts."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, long = prose(60), prose(4000)
    rows = [prose(rng.randint(1, 120)) for _ in range(30)]
    rows += [rows[0], rows[0], rows[3] + " more", prose(10) + " " + passage + "\n" + prose(15), passage, prose(30) + " " + passage]
    near = prose(200).split()
    for _ in range(6):
        copy = list(near)
        copy[rng.randrange(200)] = "edit"
        rows.append(" ".join(copy))
    rows += ["same " * 70, "same " * 90, long, long[500:9000], "", "one", "a b", "<|endoftext|> İ ΣΑΣ it's ½ 日本 \x1c\x85 Ǆ", "x" * 3000, "\0" * 250]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    """The texts with null and repeated ids, null columns, and clashing column names."""
    rows = [(k * 3, t, ["en", "de", None][k % 3], ["b", "a", None, "c"][k % 4], "k", k, "b") for k, t in enumerate(texts)]
    rows += [(900, None, None, None, None, None, None), (None, texts[1], "en", "a", "k", 1, None), (None, None, "en", "a", None, 1, None)]
    rows += [rows[2], rows[2]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def ordered(docs):
    """Documents in the order of the contract; equal rows once, null ids last."""
    rows = {(d, t) for d, t in listed(docs)}
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_packing_round_trip(docs, empty):
    tokenizer = Tokenizer.from_file(vocabulary())
    found = packing.best_fit_packing(docs, vocabulary(), capacity=256, open_bins=8, with_ids=True).collect()
    pieces = Counter()
    for d, t in listed(docs):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        for p, at in enumerate(range(0, len(ids), 1024)):
            part = ids[at : at + 1024]
            pieces[d, p, at // 4, len(part) // 4, zlib.crc32(part), part] += 1
    assert pieces == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        assert [o for o, _ in sorted(spans)] == [0, *itertools.accumulate(n for _, n in sorted(spans))][:-1]
        assert sum(n for _, n in spans) <= 256
    assert packing.best_fit_packing(empty, vocabulary()).collect() == []


def test_bins_close_the_fullest_first():
    bins = packing.Bins(10, 2)
    assert [bins.place(n)[0] for n in (7, 8, 9, 3)] == [0, 1, 2, 0]  # bin 1 closed for bin 2
    assert bins.place(1) == (2, 9) and bins.place(10) == (3, 0)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizers_encode_whole_texts(docs, name):
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    expected = Counter(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in listed(docs))
    found = packing.token_pieces(docs, path, 10**6).collect()
    assert Counter(r.length for r in found) == expected


def test_quality_counts(docs, empty):
    found = Counter()
    for r in quality_rules.quality_rules(docs).collect():
        found[tuple(r)[:7]] += 1
        assert not (r.kept and r.base_failed)
    expected = Counter()
    for d, t in listed(docs):
        words = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        hit = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
        failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
        expected[d, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed] += 1
    assert found == expected
    assert quality_rules.quality_rules(empty).collect() == []


def test_distance_is_a_metric_between_zero_and_one():
    p, q = np.array([0.5, 0.5, 0]), np.array([[0.5, 0.5, 0], [0, 0, 1]])
    assert quality_rules.distance(p, q) == pytest.approx([0, 1])


def test_every_large_language_has_a_reference(spark, monkeypatch):
    rng, rows = random.Random(8), []
    for k in range(70):  # the last languages are the smallest, and each has a script or words of its own
        letters = "אבגדהוזחט" if k == 69 else "ABCDEFGHI" if k == 68 else "abcdefghi"
        words = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(12)]
        rows += [(12 * k + n, " ".join(rng.choice(words) for _ in range(300 - 2 * k)), f"l{k:02}") for n in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    expected = quality_rules.quality_rules(frame).orderBy("doc_id").collect()
    assert all(r.class_distance < 0.15 and r.word_distance < 0.25 for r in expected) and all(
        r.kept == (not r.base_failed) for r in expected
    )
    monkeypatch.setattr(quality_rules, "LANGUAGES", 9)
    assert quality_rules.quality_rules(frame).orderBy("doc_id").collect() == expected


def test_quality_rules_keep_good_and_drop_bad(spark, small):
    verdicts = quality_rules.quality_rules(table(spark, small, "documents"))
    labels = table(spark, small, "labels").filter("quality = 1")
    good = verdicts.join(labels, "doc_id").filter("NOT base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.97


BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True,
                    14 <= len(digits) <= 19 and personal_data.luhn(digits), 10 <= len(digits) <= 15)[kind]
            out += [(m.start(), kind, m.end())] * good
    return sorted(out)


def test_pattern_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("0123456789.@@a+- ()b_1199") for _ in range(rng.randint(0, 40)))
        assert personal_data.base_spans(text) == plain_spans(text)


def test_personal_data(spark, docs, empty):
    model = personal_data.train()
    runs = personal_data.labelled_runs(personal_data.LABELLED)
    assert personal_data.viterbi([r for r, _ in runs], model) == [labels for _, labels in runs]
    text = "mail é a.b@c.example.org or call (212) 555-0142 in 1999, card 4111 1111 1111 1111 for 12 of 40"
    frame = spark.createDataFrame([(1, text, "x"), (2, None, "y")], "doc_id int, text string, spans string")
    rows = {r.doc_id: r for r in personal_data.personal_data(frame).collect()}
    base = "email:7:24,card:62:81"
    assert rows[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and (rows[1].n_email, rows[1].n_phone) == (1, 0)
    assert rows[1].spans == "email:7:24,phone:33:47,card:62:81" or set(base.split(",")) < set(rows[1].spans.split(","))
    assert rows[2].spans == "" and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r.text for r in personal_data.mask_documents(frame).collect()}
    assert "<email>" in clean[1] and "4111" not in clean[1] and clean[2] is None
    assert personal_data.mask_documents(docs).count() == docs.count()
    assert personal_data.personal_data(empty).collect() == []


def test_top_k_by_narrowing(spark):
    frame = spark.range(1000).select("id", (F.col("id") * 7919 % 1009).cast("double").alias("key"))
    best = {r["id"] for r in frame.orderBy(F.desc("key")).limit(137).collect()}
    marked = importance.top_k(frame, "key", 137, "id")
    assert {r["id"] for r in marked.filter("selected").collect()} == best
    assert importance.top_k(frame, "key", 0, "id").filter("selected").count() == 0


def test_resampling(spark, docs, empty):
    ids = docs.filter("lang = 'en'").select("doc_id")
    found = importance.resample(docs, ids, 0.5).collect()
    assert len(found) == docs.count() and all(r.log_weight == 0 for r in found if not r.n_ngrams)
    cut = min(r.sample_key for r in found if r.selected)
    assert all(r.selected == (r.sample_key >= cut) for r in found)
    assert importance.resample(empty, ids, 0.5).collect() == []


def removed_words(docs, window):
    seen, out = set(), {}
    for d, t in ordered(docs):
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            piece = tuple(words[k : k + window])
            if piece in seen:
                gone[k : k + window] = [True] * window
            seen.add(piece)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[d, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] = 1
    return set(out)


@pytest.mark.parametrize("window", [20, 8])
def test_substring_dedup(docs, empty, window):
    found = substring.substring_dedup(docs, window).collect()
    assert len(found) == docs.count() and {tuple(r) for r in found} == removed_words(docs, window)
    assert substring.substring_dedup(empty).collect() == []


def removed_bytes(docs, length):
    seen, out = set(), set()
    for d, t in ordered(docs):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if data[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(data[k : k + length])
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(data) else 0
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.add((d, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, hot", [(100, False), (64, False), (100, True)])
def test_suffix_dedup(docs, empty, length, hot, monkeypatch):
    if hot:  # ranges so small that frequent suffixes are exchanged string by string
        monkeypatch.setattr(suffix_dedup, "RANGE_RECORDS", 20)
        monkeypatch.setattr(suffix_dedup, "BLOCK_RECORDS", 2)
    found = suffix_dedup.suffix_dedup(docs, length).collect()
    assert len(found) == docs.count() and {tuple(r) for r in found} == removed_bytes(docs, length)
    if not hot:
        assert suffix_dedup.suffix_dedup(empty).collect() == []


def test_merge_of_runs_and_front_coding():
    rng = random.Random(2)
    runs = [sorted(("".join(rng.choice("ab") for _ in range(rng.randint(1, 9))).encode(), b"l", k, j, 1) for j in range(50)) for k in range(5)]
    decoded = [suffix_dedup.decode_block(suffix_dedup.encode_block(run)) for run in runs]
    merged = list(suffix_dedup.merge_runs(decoded))
    assert [r[0] for _, r in merged] == sorted(r[0] for run in runs for r in run)
    for (_, a), (shared, b) in itertools.pairwise(merged):
        assert shared == suffix_dedup.common_prefix(a[0], b[0], 0)


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(docs, empty, words):
    sets = {}
    for d, t in ordered(docs):
        found = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        size = min(words, len(found))
        sets[d, t] = {tuple(found[k : k + size]) for k in range(len(found) - size + 1)} if found else set()
    parent = {k: k for k in sets}

    def root(k):
        return k if parent[k] == k else root(parent[k])

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[root(b)] = root(a)
    least = {}
    for k in sets:
        least[root(k)] = min(least.get(root(k), k[0]), k[0], key=lambda d: (d is None, d or 0))
    expected = {(k[0], len(sets[k]), least[root(k)], k[0] == least[root(k)]) for k in sets}
    found = near_duplicates.near_duplicates(docs, words).collect()
    assert len(found) == docs.count() and {tuple(r) for r in found} == expected
    assert near_duplicates.near_duplicates(empty).collect() == []


def test_near_duplicates_without_ids(spark):
    rng = random.Random(6)

    def prose():
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))

    a, b, c, bridge, alone, far = prose(), prose(), prose(), prose(), prose(), prose()
    left, right = (" ".join(bridge.split()[k : k + 90]) for k in (0, 10))  # alike to the bridge, not to each other
    rows = [(None, a), (None, a + " x"), (None, a), (None, b), (None, b), (1, c), (None, c + " y"), (None, c)]
    rows += [(2, left), (None, bridge), (3, right), (None, alone), (2**62 + 2**61 + 5, far), (None, far + " z"), (None, ""), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = near_duplicates.judged_documents(frame, 1).collect()
    assert len(found) == len(rows)
    group = {t: name for name, ts in {"a": (a, a + " x"), "b": (b,), "c": (c, c + " y"), "bridge": (left, bridge, right),
             "alone": (alone,), "far": (far, far + " z"), "": ("",)}.items() for t in ts}
    text = {(r.doc_id, r.key): r.text for r in keyed(frame).collect()}
    kept, names = Counter(), {}
    for r in found:
        name = group[text[r.doc_id, r.key]]
        kept[name] += r.kept
        names.setdefault(name, set()).add(r.component_id)
    assert kept == {"a": 1, "b": 1, "c": 1, "bridge": 1, "alone": 1, "far": 1, "": 2}
    assert names == {"a": {None}, "b": {None}, "c": {1}, "bridge": {2}, "alone": {None}, "far": {2**62 + 2**61 + 5}, "": {None}}


def test_pairs_across_lose_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(1, 2**62, 60)
    sets = []
    for _ in range(40):
        new = base.copy()
        at = rng.choice(60, rng.integers(1, 16), replace=False)
        new[at] = rng.integers(1, 2**62, len(at))
        sets.append(np.unique(new[: rng.integers(45, 61)]))
    owners = [k // 2 if k < 4 else k for k in range(40)]  # two nodes have two sets each
    rows = [(o, bytearray(s.astype("<i8").tobytes())) for o, s in zip(owners, sets, strict=True)]
    rows += rows[:6]  # and some have one of theirs twice
    stored = spark.createDataFrame(rows, "node long, items binary")
    nodes = [(o, o % 7, len(s), 0, 0, 0) for o, s in zip(owners, sets, strict=True)]
    nodes = spark.createDataFrame(nodes, "node long, component long, n_shingles long, s0 long, s1 long, s2 long")
    wanted = set()
    for (a, x), (b, y) in itertools.permutations(zip(owners, sets, strict=True), 2):
        common = len(np.intersect1d(x, y))
        if a % 7 < b % 7 and 100 * common >= 80 * (len(x) + len(y) - common):
            wanted.add((a, b))
    found = {tuple(r) for r in near_duplicates.pairs_across(nodes, stored, 80).collect()}
    assert wanted and wanted <= found


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    shared = rng.integers(2**63, size=800, dtype=np.uint64)
    sets = [np.append(shared, rng.integers(2**63, size=100, dtype=np.uint64)) for _ in range(2)]
    signatures = near_duplicates.superminhash(np.concatenate(sets), np.repeat([0, 1], 900), 2)
    assert abs((signatures[0] == signatures[1]).mean() - 0.8) < 0.1


def test_language_id(spark, small, docs, empty):
    documents = table(spark, small, "documents")
    found = language_id.identify_languages(documents)
    ids = [r.doc_id for r in found.filter("held_out").collect()]
    assert ids and all(zlib.crc32(str(d).encode()) % 4 == 2 for d in ids)
    right = found.filter("held_out").join(documents.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.9
    odd = language_id.identify_languages(docs).collect()
    assert all((r.lang_pred == "und") == (r.score == 0) and 0 <= r.score <= 1 for r in odd)
    assert language_id.identify_languages(empty).collect() == []


def test_exact_top_k(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(5, 12))
    rows = [(k, [float(x) for x in centers[k % 5] * rng.uniform(0.2, 3) + rng.normal(size=12) * 0.1], "x") for k in range(600)]
    rows += [(600 + k, rows[7][1], "x") for k in range(30)]
    rows += [(700, None, "x"), (720, [1.0, None], "x"), (740, [float("nan")] * 12, "x"), (760, [float("inf")] * 12, "x"), (780, [0.0] * 12, "x")]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<float>, norm string").repartition(3)
    good = [(k, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for k, v, _ in rows if k < 700 or k == 780]
    expected = set()
    for q, v in good:
        if q % 20 == 0:
            best = sorted((-int(v @ w), k) for k, w in good if k != q)[:20]
            expected |= {(q, r + 1, k, -s) for r, (s, k) in enumerate(best)}
    found = topk_search.top_inner_products(frame, F.col("vec_id") % 20 == 0)
    assert {tuple(r) for r in found.collect()} == expected
    assert topk_search.top_inner_products(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_exact_top_k_with_repeated_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(1, 400)]
    rows += [(400, [0.9] * 6)] * 90  # more copies of a query than places in a chunk
    rows += [(440, [2.0] + [0.0] * 5), (440, [1.0, 9.0] + [0.0] * 4)]  # the smaller vector is not the shorter one
    rows += [(460, [-1.0] + [0.0] * 5), (460, [-90.0] + [0.0] * 5)]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<float>").repartition(3)
    good = [(k, tuple(np.floor(64 * np.array(v, np.float32).astype(float)).astype(int).tolist())) for k, v in rows]
    asked = {}
    for q, v in good:
        if q % 20 == 0:
            asked[q] = min(asked.get(q, v), v)
    expected = []
    for q, v in asked.items():
        best = sorted((-int(np.dot(v, w)), k) for k, w in good if k != q)[:20]
        expected += [(q, r + 1, k, -s) for r, (s, k) in enumerate(best)]
    found = topk_search.top_inner_products(frame, F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_a_chunk_full_of_copies_of_the_query_gives_its_best():
    own = np.full((90, 4), 9)
    others = np.arange(1, 31)[:, None] * np.array([[0, 0, 0, 1]])
    rows, ids = np.concatenate([own, others]), np.append(np.zeros(90, np.int64), np.arange(1, 31))
    norms = np.sqrt((rows**2).sum(axis=1).astype(float))
    found = topk_search.search_block(
        np.zeros(1, np.int64), own[:1], norms[:1], np.array([-np.inf]), ids, rows, norms
    )
    assert {vec for _, vec, _ in found} == set(range(11, 31))


def test_source_mixing(spark, docs, empty):
    found = mixing.mix_sources(docs).collect()
    sizes, taken, targets = Counter(), Counter(), {}
    of = {(r.doc_id): r.source for r in docs.collect() if r.doc_id is not None}
    for r in found:
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else r.taken == 0
        if r.doc_id is not None:
            targets[of[r.doc_id]] = (r.target, r.source_size)
            taken[of[r.doc_id]] += r.taken
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    names = [*sorted(s for s in sizes if s is not None), None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * weight[s] / share > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in names:
        wanted = 3 * sizes[s] if s in capped else left * weight[s] / share
        assert targets[s] == (pytest.approx(wanted), sizes[s])
    again = mixing.mix_sources(docs.repartition(2)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    copies = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert all(copies[r.doc_id] * r.size >= r.taken for r in found)
    assert mixing.mix_sources(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_mixing_comes_near_its_targets(spark, small):
    found = mixing.mix_sources(table(spark, small, "documents"))
    source = table(spark, small, "documents").select("doc_id", "source")
    per = found.join(source, "doc_id").groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.max("size").alias("m"))
    assert all(abs(r.t - r.n) <= r.m for r in per.collect())


def test_stages_judge_rows_and_not_ids(spark, small):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
    good = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(40)]
    bad = ["too short", "same " * 70]
    rows = [(None, good[0], "en"), (None, bad[0], "en"), (None, bad[1], "en"), (5, good[1], "en"), (5, bad[0], "en"), (6, good[2], None)]
    rows += [(6, good[2], None), (None, good[0], "en"), (7, bad[1], "en"), (None, good[3], "en"), (None, None, "en")]
    rows += [(100 + k, good[k], "en") for k in range(4, 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = corpus_pipeline.quality_stage(spark, frame, small)
    assert kept.columns == frame.columns and Counter(map(tuple, kept.collect())) == Counter(r for r in rows if r[1] in good)
    rows += [(None, good[0] + " more", "en"), (8, good[1] + " more", "en")]
    frame = spark.createDataFrame(rows, frame.schema).repartition(3)
    left = Counter(r.text for r in corpus_pipeline.near_duplicate_stage(spark, frame, small).collect() if r.text and len(r.text) > 10)
    assert left.pop(good[0], 0) + left.pop(good[0] + " more", 0) == 1
    assert left.pop(good[1], 0) + left.pop(good[1] + " more", 0) == 1
    # rows that share an id count as one document; null ids and copies are one each
    assert left == {**{t: 1 for t in good[2:]}, bad[1]: 1}


def test_pipeline(spark, small):
    documents = table(spark, small, "documents")
    kept = corpus_pipeline.quality_stage(spark, documents, small)
    verdict = {r.doc_id for r in quality_rules.quality_rules(documents).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict and kept.columns == documents.columns
    found = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in found} <= verdict
    fill = Counter()
    for r in found:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= sum(fill.values()) / 2048 * 1.05 + 4
    assert [f.__name__ for _, f in corpus_pipeline.STAGES[:1]] == ["quality_stage"] and len(QUERIES) == 13
