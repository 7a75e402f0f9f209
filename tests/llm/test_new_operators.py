"""Lexical search, source divergence and toxicity against SQL or brute force, on edge cases."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tradewind.llm import lexical_search, source_divergence, toxicity
from tradewind.llm.queries import SQL

SCHEMA = "doc_id long, text string, lang string, source string, term string, total long, shard int, key string, item string"


@pytest.fixture(scope="module")
def docs(spark):
    """Prose with ties, copies, null columns and ids, empty and long texts, and clashing column names."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdeé9") for _ in range(rng.randint(1, 6))) for _ in range(150)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))

    texts = [prose(rng.randint(1, 80)) for _ in range(60)]
    texts += [texts[0], texts[0], texts[1].upper(), "", " \t\n", "É é Abc ABC abc", "same " * 500, prose(9000), "a_b-c\x7fd\x85e"]
    rows = [(k, t, ["en", "de", None, "en"][k % 4], [None, "b", "a", "é", "Z"][k % 5], "t", 1, 2, "k", "i") for k, t in enumerate(texts)]
    rows += [(None, texts[2], "en", "a", None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rows += [rows[3], rows[3], (7, texts[9], "zz", "only", "t", 1, 2, "k", "i"), (8, None, "yy", "x", "t", 1, 2, "k", "i"), (9, "", "yy", "y", "t", 1, 2, "k", "i")]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_sql(name, **tables):
    """Rows of the registered SQL over the given frames, as a bag."""
    con = duckdb.connect()
    for key, frame in tables.items():
        con.register(key, frame.toArrow())
    found = con.execute(SQL[name])
    return [x[0] for x in found.description], Counter(found.fetchall())


def same(found, name, **tables):
    columns, expected = by_sql(name, **tables)
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == expected
    return expected


@pytest.mark.parametrize("fan_in, block_postings", [(512, 400_000), (2, 40)])
def test_source_divergence(docs, empty, monkeypatch, fan_in, block_postings):
    if fan_in == 2:  # blocks of few shards, which the merges split
        monkeypatch.setattr(source_divergence, "FIRST_SHARDS", 2)
        monkeypatch.setattr(source_divergence, "SPLIT", 3)
    found = source_divergence.source_divergence(docs, fan_in=fan_in, block_postings=block_postings)
    assert len(same(found, "op12_source_divergence", documents=docs)) > 100
    assert source_divergence.source_divergence(empty).collect() == []


def test_runs_merge_in_order():
    block = source_divergence.Block()
    for lang, source, text in [("en", "a", b"x Y x"), ("en", "b", b"x"), ("de", "a", b"x z")]:
        block.add(lang, source, text)
    runs = [run for _, run in block.runs(1)] * 3
    merged = source_divergence.heap_merge(runs)
    assert merged.keys == [b"x\0de", b"x\0en", b"y\0en", b"z\0de"] and merged.names == ["a", "b"]
    assert merged.documents.tolist() == [3, 6, 3, 3] and merged.sizes.tolist() == [1, 2, 1, 1]
    assert merged.source.tolist() == [0, 0, 1, 0, 0] and merged.count.tolist() == [3, 6, 3, 3, 3]


def test_shared_terms_of_many_sources(monkeypatch):
    """Corrections are the same however many pairs are computed at once, and beyond 64-bit products."""
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 6, 40)
    source = np.concatenate([np.sort(rng.choice(8, n, replace=False)) for n in sizes])
    p, p0 = rng.integers(1, 10**9, len(source)), rng.integers(1, 1000, 8)
    expected, ends = Counter(), np.cumsum(sizes)
    for a, b in zip(ends - sizes, ends, strict=True):
        for i in range(a, b):
            for j in range(a, b):
                if i != j:
                    f = [(int(x) - int(y)) ** 2 // int(y) for x, y in [(p[i], p[j]), (p[i], p0[source[j]]), (p0[source[i]], p[j]), (p0[source[i]], p0[source[j]])]]
                    expected[int(source[i] * 8 + source[j])] += f[0] - f[1] - f[2] + f[3]
    for pairs in (1, 7, 10**6):
        monkeypatch.setattr(source_divergence, "PAIRS", pairs)
        code, total = source_divergence.shared_term_sums(sizes, source, p, p0[source], 8)
        assert dict(zip(code.tolist(), total.tolist(), strict=True)) == dict(expected)
    counts = np.array([10**13, 0, 8_999_999_999], np.int64)
    assert source_divergence.wide_share(counts, counts * 3 + 7).tolist() == [1 + 10**9 * (int(c) + 1) // (int(c) * 3 + 7) for c in counts]


ITEMS = "item_id long, text string, term string, shard int, kind int, rows string"


@pytest.mark.parametrize("grid_postings", [400_000, 300])
def test_lexical_search(spark, docs, empty, grid_postings):
    texts = [r.text for r in docs.collect() if r.text and r.text.strip()]
    rows = [(k, t[:300], "t", 1, 2, "r") for k, t in enumerate(texts[:12])]
    rows += [(3, texts[20], None, None, None, None), (None, texts[5], "t", 1, 2, "r"), (50, None, "t", 1, 2, "r"), (51, "", "t", 1, 2, "r")]
    rows += [(52, "notfoundanywhere", "t", 1, 2, "r"), (53, "same", "t", 1, 2, "r"), (54, "ABC abc \u00e9", "t", 1, 2, "r")]
    items = spark.createDataFrame(rows, ITEMS)
    found = lexical_search.search(docs, items, grid_postings=grid_postings)
    assert len(same(found, "op11_lexical_search", documents=docs, benchmark=items)) > 400
    if grid_postings > 1000:
        assert lexical_search.search(empty, items).collect() == []
        assert lexical_search.search(docs, items.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_grid_finds_the_best_columns(seed):
    """Exact sums and ties, through packing and back; a narrow beam gives the same as a wide one."""
    rng = np.random.default_rng(seed)
    rows, columns = int(rng.integers(1, 40)), int(rng.integers(1, 300))
    cells = np.unique(rng.integers(0, rows * columns, rng.integers(1, 1500)))
    row, column = cells // columns, cells % columns
    _, column = np.unique(column, return_inverse=True)
    impact = rng.integers(1, [5, 10**6][seed % 2], len(cells))
    ids, has = rng.integers(0, 9, column.max() + 1), rng.random(column.max() + 1) < 0.8
    payload = lexical_search.packed_grid(row * 7, column, row, impact, ids, has)
    grid, terms, got_ids, got_has = lexical_search.unpacked_grid(payload)
    for beam in (2, 500):
        lexical_search.BEAM, before = beam, lexical_search.BEAM
        for k in (1, 10, 50):
            asked = np.unique(rng.integers(0, rows, 6))
            mine = np.flatnonzero(np.isin(terms, asked * 7))
            if not len(mine):
                continue
            at, score = grid.best_columns(mine, k)
            sums = np.zeros(len(ids), np.int64)
            np.add.at(sums, column[np.isin(row, asked)], impact[np.isin(row, asked)])
            bar = max(1, np.sort(sums)[::-1][min(k, len(sums)) - 1])
            best = np.flatnonzero(sums >= bar)
            expected = Counter((int(sums[c]), int(ids[c]) if has[c] else None) for c in best)
            assert Counter((int(s), int(got_ids[c]) if got_has[c] else None) for c, s in zip(at, score, strict=True)) == expected
        lexical_search.BEAM = before


def test_ranges_are_left_out():
    """With impacts on a few columns only their paths are followed."""
    n = 4096
    impact = np.where(np.arange(n) % 1000 == 0, 1000, 1)
    payload = lexical_search.packed_grid(np.zeros(n, np.int64), np.arange(n), np.zeros(n), impact, np.arange(n), np.ones(n, bool))
    grid, *_ = lexical_search.unpacked_grid(payload)
    seen, real = [], grid.maxima

    class Counted(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return np.asarray(real)[at]

    grid.maxima = real.view(Counted)
    at, score = grid.best_columns(np.zeros(1, np.int64), 5)
    assert score.tolist() == [1000] * 5 and sum(seen) < n / 4


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_lexicon_against_edit_distances():
    """The automaton finds what comparing with every entry finds, before and after its states were thrown away."""
    rng = random.Random(2)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 8))) for _ in range(40)}
    entries = [(w, False) for w in sorted(words)] + [("cab", True), ("aacb", True)]
    lexicon = toxicity.FuzzyLexicon(entries)
    tried = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 10))) for _ in range(1500)] + sorted(words)
    for round_ in range(2):
        for word in tried:
            whole = [(edit_distance(word, w), n) for n, (w, stem) in enumerate(entries) if not stem]
            whole = [(d, n) for d, n in whole if d <= toxicity.allowed_edits(entries[n][0])]
            stems = [(0, n) for n, (w, stem) in enumerate(entries) if stem and word.startswith(w)]
            best, stem = min(whole, default=None), min(stems, default=None)
            expected = best if best and (not stem or best[0] <= stem[0]) else stem
            assert lexicon.match(word) == expected, word
        lexicon.reset()


def test_two_edits_in_long_entries():
    lexicon = toxicity.FuzzyLexicon([("disgusting", False), ("idiot", False)])
    assert lexicon.match("disgustign") == (2, 0) and lexicon.match("disgusting") == (0, 0)
    assert lexicon.match("idlot") == (1, 1) and lexicon.match("1diot") == (1, 1) and lexicon.match("idots") is None


def test_window_tells_quotation_from_abuse():
    model = toxicity.Model([("idiot", False), ("worthless", False)], [1.0, 1.0], ["idiom"])
    reader = model.reader()
    abuse = ["you idiot and you worthless thing", "You id1ot, you w0rthless!!", "IDIOOOOT !!! you idiot-idiot"]
    quotation = ['the report said "worthless" and quoted the term', "er schrieb das Wort „idiot“ laut Zitat", "«idiot» selon le mot cité"]
    assert min(map(reader.score, abuse)) > max(map(reader.score, quotation))
    assert reader.look_up("idiom") is None and reader.look_up("idio") == (1, 0)
    assert toxicity.quoted('a "b" c', 3, 4) and not toxicity.quoted('a "x" b "c"', 6, 7)
    assert not toxicity.quoted('"a\nb\nc"', 3, 4) and toxicity.quoted("«a b»", 3, 4)


@pytest.fixture(scope="module")
def labelled(spark):
    """Clean prose, and prose with insults, some of them misspelled, in many surroundings."""
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("etaoinsr") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    insults = ["mugwump", "knucklehead", "dunderkopf"]
    rows, labels = [], []
    for k in range(700):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        toxic = k % 4 == 0
        for _ in range(4 * toxic):
            word = rng.choice(insults)
            if k % 8 == 0 and k % 3:  # misspelled in half of them
                at = rng.randrange(1, len(word) - 1)
                word = word[:at] + "*" + word[at + 1 :]
            words.insert(rng.randrange(len(words)), word)
        rows.append((k, " ".join(words), "en", "s", "w", 1, "t"))
        labels.append((k, 1, int(toxic), "x"))
    rows += [(None, None, None, None, None, None, None), (None, "you mugwump, mugwump", "en", "s", "w", 1, "t"), (7, "", "en", "s", "w", 1, "t"),
             (5, "tea " * 30_000, "en", "s", "w", 1, "t"), rows[4], rows[4]]
    labels += [(None, 1, 1, "x"), (3, 1, None, "x"), (9_999, 0, 1, "x"), labels[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, word string, half int, toxic string")
    return docs.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_toxicity(labelled):
    docs, labels = labelled
    found = toxicity.score_toxicity(docs, labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in docs.collect())
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in found if r.held_out and r.doc_id < 700]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert len({r.score for r in found if r.doc_id == 4}) == 1
    assert max(r.score for r in found if r.doc_id is None) >= 0.7


def test_toxicity_reads_no_held_out_label_and_takes_a_bounded_sample(spark, labelled):
    docs, labels = labelled
    turned = labels.select("doc_id", toxicity.F.when(toxicity.is_held_out(toxicity.F.col("doc_id")), 1).otherwise(toxicity.F.col("toxic")).alias("toxic"))
    a, b = (toxicity.train(docs, x) for x in (labels, turned))
    assert a.entries == b.entries and (a.coefficients == b.coefficients).all()
    many = spark.range(300).selectExpr("1L AS doc_id", "concat('text ', id) AS text")
    one = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, toxic int")
    assert toxicity.examples(many, one, 20).count() <= 40


def test_toxicity_without_labels_or_documents(labelled):
    docs, labels = labelled
    assert {round(r.score, 9) for r in toxicity.score_toxicity(docs.limit(5), labels.limit(0)).collect()} == {round(1 / (1 + np.e**3), 9)}
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []
