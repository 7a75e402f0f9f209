"""Every stage of the pipeline against a brute-force version, each on its own input."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_mended import quality_distances
from tradewind.llm import personal_data, quality_rules
from tradewind.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, kept boolean"


@pytest.fixture(scope="module")
def docs(spark):
    """Prose with exact and near copies, junk, personal data, null and repeated ids, empty and long texts, clashing names."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(80)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    texts = [prose(rng.randint(5, 160)) for _ in range(120)]
    near = prose(120).split()
    for k in range(12):  # chains of edits: neighbours are alike, the ends are not
        near = [*near]
        near[9 * k] = f"edit{k}"
        texts.append(" ".join(near))
    texts += [texts[0], texts[0], texts[3] + " tail", "junk " * 60, "", prose(3000), "mail a.b@c.org or +1 (212) 555-0142, 10.0.0.1 " + prose(30),
              "card 4111 1111 1111 1111 " + prose(25)]
    rows = [(k, t, "en", ["a", "b", None][k % 3], len(t), "k", True) for k, t in enumerate(texts)]
    rows += [(None, texts[5], "en", "a", 1, None, None), (None, None, None, None, None, None, None), rows[7], rows[7]]
    rows += [(7, texts[9] + " other", "en", "c", 1, "k", False)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def repeated_words(words):
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    return len({j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)})


def test_quality_stage(spark, docs):
    """The counts and both distances of every row, from plain lists."""
    rows, rules, expected = [tuple(r) for r in docs.collect()], quality_rules.Rules(), Counter()
    for row, (by_class, by_word) in zip(rows, quality_distances([(r[1], r[2]) for r in rows]), strict=True):
        text, words = row[1] or "", WORD.findall(row[1] or "")
        far = len(text) >= rules.class_min_chars and by_class > rules.class_max_distance + rules.class_slack / len(text) ** 0.5
        far |= len(words) >= rules.word_min_words and by_word > rules.word_max_distance + rules.word_slack / len(words) ** 0.5
        if len(words) >= 10 and 100 * repeated_words(words) <= 20 * len(words) and not far:
            expected[row] += 1
    assert bag(corpus_pipeline.quality_stage(spark, docs, "")) == expected and 80 < sum(expected.values()) < len(rows)


def shingles(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicate_stage(spark, docs):
    """All pairs compared: one row of each group stays, and every other row equal in id and text goes."""
    rows = list(dict.fromkeys((r.doc_id, r.text) for r in docs.collect()))
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    group = {row: root(k) for k, row in enumerate(rows)}
    found = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    kept = [(r.doc_id, r.text) for r in found.collect()]
    assert sorted(group[r] for r in kept) == sorted(set(group.values()))
    assert found.columns == docs.columns and set(bag(found)) <= set(bag(docs))


def test_personal_data_stage(spark, docs):
    """Every row stays; texts change at the spans alone, and none of the plain patterns is left."""
    kinds = "|".join(f"<{k}>" for k in ("email", "ip", "card", "phone"))
    before = Counter((r.doc_id, r.text) for r in docs.collect())
    after = corpus_pipeline.personal_data_stage(spark, docs, "").collect()
    assert len(after) == sum(before.values())
    same = Counter((r.doc_id, r.text) for r in after)
    plain = Counter({row: n for row, n in before.items() if not row[1] or not any(c in row[1] for c in "@0123456789")})
    assert all(same[row] == n for row, n in plain.items())
    for r in after:
        if r.text:
            assert not personal_data.base_spans(r.text)
            pattern = re.compile(".+?".join(re.escape(part) for part in re.split(kinds, r.text)), re.DOTALL)
            assert any(pattern.fullmatch(t) for d, t in before if d == r.doc_id and t)
    assert sum(len(re.findall(kinds, r.text or "")) for r in after) >= 4


def test_mixing_stage(spark, docs):
    """Targets by water-filling over plain lists; each row comes the whole or the next number of times, near its source's target."""
    rows = [(r.source, r.doc_id, r.text, len(WORD.findall(r.text or ""))) for r in docs.collect()]
    sizes = Counter()
    for source, _, _, n in rows:
        sizes[source] += n
    names = [*sorted(s for s in sizes if s is not None), None]
    weight, capped = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, set()
    while True:
        left = sum(sizes.values()) - 3 * sum(sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * weight[s] > 3 * sizes[s] * share}
        if not over:
            break
        capped |= over
    target = {s: 3 * sizes[s] if s in capped else left * weight[s] / share for s in names}
    found = Counter((r.source, r.doc_id, r.text) for r in corpus_pipeline.mixing_stage(spark, docs, "").collect())
    copies, taken = Counter((s, d, t) for s, d, t, _ in rows), Counter()
    for (source, doc, text), n in copies.items():
        times = found[source, doc, text] / n
        whole = target[source] // sizes[source]
        assert times in (whole, whole + 1) and times <= 3
        taken[source] += found[source, doc, text] * len(WORD.findall(text or ""))
    largest = max(n for *_, n in rows)
    assert all(abs(taken[s] - target[s]) <= largest for s in names)


def test_packing_stage(spark, docs):
    """Pieces by the tokenizer itself; sequences without gaps or overlaps, near the least possible number."""
    tokenizer, expected = Tokenizer.from_file(vocabulary()), Counter()
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected[r.doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    found = corpus_pipeline.packing_stage(spark, docs, "").collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    spans = {}
    for r in found:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in spans.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(spans) <= sum(r.length for r in found) / 2048 + 4
