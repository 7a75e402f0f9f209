"""Text operators on null and repeated ids and tiny groups, and their models recomputed by brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import importance, language_id, mixing, quality_rules, substring, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string"


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(60)]


def distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = [sum(a * math.log2(a / c) for a, c in zip(x, m, strict=True) if a) for x in (p, q)]
    return math.sqrt(max(0.0, sum(kl) / 2))


def quality_distances(rows):
    """For rows (text, lang) their distances by characters and by words to the nearest language, themselves left out."""
    table = quality_rules.class_table()
    plain = [Counter(w for x in re.findall(r"[^\x20\x09-\x0D]+", t or "") if (w := quality_rules.plain_word(x))) for t, _ in rows]
    classes = [quality_rules.class_counts(t or "", table) for t, _ in rows]
    total = {lang: sum((c for c, (_, of) in zip(plain, rows, strict=True) if of == lang), Counter()) for _, lang in rows if lang}
    common = {lang: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:100]] for lang, c in total.items()}
    kinds = {lang: sum(c for c, (_, of) in zip(classes, rows, strict=True) if of == lang) for lang in total}
    out = []
    for words, chars, (_, own) in zip(plain, classes, rows, strict=True):
        best = []
        for lang in total:
            others = total[lang] - words if lang == own else total[lang]
            shares = [[c[w] / max(1, c.total()) for w in common[lang]] for c in (words, others)]
            rest = kinds[lang] - chars * (lang == own)
            best.append((distance(*[(c / max(1, c.sum())).tolist() for c in (chars, rest)]), distance(*[x + [1 - sum(x)] for x in shares])))
        out.append(tuple(min(b[k] for b in best) for k in (0, 1)))
    return out


def test_quality_distances_by_brute_force(spark, words):
    """Both distances of every document against references that leave it out; all lie between 0 and 1."""
    rng = random.Random(5)
    rows = [(k, prose(rng, words[:40] if k % 2 else words[20:], 80 + k) + ". A-1", ["en", "de"][k % 2], "s") for k in range(40)]
    expected = quality_distances([(t, lang) for _, t, lang, _ in rows])
    for r in quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect():
        assert (r.class_distance, r.word_distance) == pytest.approx(expected[r.doc_id], abs=1e-6)
        assert 0 < r.word_distance < 1 and 0 < r.class_distance < 1


@pytest.mark.parametrize("lang", [None, "zz", "en"])
def test_no_text_vouches_for_itself(spark, words, lang):
    """Junk is rejected whether its label is missing, its own, or that of a large language."""
    rng = random.Random(5)
    rows = [(k, prose(rng, words, 150), "en", "s") for k in range(40)]
    junk = " ".join("".join(rng.choice("0123456789@#~^") for _ in range(9)) for _ in range(120))
    found = quality_rules.quality_rules(spark.createDataFrame([*rows, (99, junk, lang, "s")], SCHEMA)).collect()
    assert {r.doc_id for r in found if not r.kept} == {99}


def test_resampling_by_brute_force(spark, words):
    """Buckets, ratios and weights recomputed; exactly the asked number taken, null and equal ids included."""
    rng = random.Random(7)
    rows = [(k, prose(rng, words[:30] if k % 3 else words[30:], rng.randint(0, 12)), "en", "s") for k in range(60)]
    rows += [(None, prose(rng, words, 6), "en", "s") for _ in range(50)] + [(7, "same text", "en", "s")] * 40 + [(8, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    target = {k for k in range(60) if k % 3 == 0}
    found = importance.resample(docs, spark.createDataFrame([(k,) for k in target], "doc_id long"), 0.3, buckets=64).collect()
    cache, raw, aim = importance.hash_cache(), np.zeros(64), np.zeros(64)
    for d, t, *_ in rows:
        counts = np.bincount(importance.ngram_buckets(t, cache, 64), minlength=64)
        raw, aim = raw + counts, aim + counts * (d in target)
    ratio = np.log((aim + 1) / (aim.sum() + 64)) - np.log((raw + 1) / (raw.sum() + 64))
    weights = sorted(round(float(ratio[importance.ngram_buckets(t, cache, 64)].sum()), 6) for _, t, *_ in rows)
    assert sorted(round(r.log_weight, 6) for r in found) == pytest.approx(weights, abs=2e-6)
    assert sum(r.selected for r in found) == round(0.3 * len(rows))
    assert 0 < sum(r.selected for r in found if r.doc_id is None) < 50
    bar = min(r.sample_key for r in found if r.selected)
    assert all(r.selected for r in found if r.sample_key > bar) and not any(r.selected for r in found if r.sample_key < bar)


@pytest.mark.parametrize("cells", [1, 7, 1000, None])
def test_marks_of_targets(spark, words, cells):
    """Every row once with the right mark, whether cells of hashed ids are shared by all, some or none."""
    rng = random.Random(8)
    rows = [(rng.choice([k, -k, 2**62 + k, None, 5]), f"{prose(rng, words, 3)} {k}", "en", "s") for k in range(400)] + [(9, None, "en", "s")]
    target = [(d,) for d, *_ in rows if d is None or d % 3 == 0] + [(5,), (5,), (777_777,), (None,)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = importance.marked_texts(docs, spark.createDataFrame(target, "doc_id long"), cells).collect()
    aims = {d for (d,) in target} - {None}
    assert Counter((r.text, r.is_target) for r in found) == Counter((t, d in aims) for d, t, *_ in rows)


def shuffled_bytes(plan):
    """Bytes that the shuffles of an executed plan sent."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return shuffled_bytes(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return shuffled_bytes(plan.plan())
    sent = plan.metrics().get("shuffleBytesWritten").get().value() if plan.nodeName() == "Exchange" else 0
    return sent + sum(shuffled_bytes(plan.children().apply(k)) for k in range(plan.children().size()))


def test_resampling_leaves_texts_in_place(spark, monkeypatch):
    """The models are counted without a shuffle of all texts, also where the target ids are too many to broadcast."""
    rng = random.Random(6)
    rows = [(k, " ".join(str(rng.randrange(300)) for _ in range(400)), "en", "s") for k in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).persist()
    ids = docs.filter("doc_id % 3 = 0").select("doc_id")
    seen = []
    monkeypatch.setattr(importance, "log_ratios", lambda counts, n, real=importance.log_ratios: seen.append(counts) or real(counts, n))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert docs.count() == importance.resample(docs, ids, 0.3, buckets=64).count()
        plain = docs.select("text").repartition(4)
        plain.collect()
        sent, whole = (shuffled_bytes(df._jdf.queryExecution().executedPlan()) for df in (seen[0], plain))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        docs.unpersist()
    assert 0 < sent < whole / 8, (sent, whole)


def test_top_k_of_equal_keys(spark):
    frame = spark.range(500).select("id", F.when(F.col("id") < 300, 1.0).otherwise(2.0).alias("key"))
    chosen = {r["id"] for r in importance.top_k(frame, "key", 350, "id").filter("selected").collect()}
    assert chosen == set(range(300, 500)) | set(range(150, 300))


def test_language_sample_is_bounded_by_rows(spark, words):
    rng = random.Random(9)
    settings = language_id.Settings(sample_per_language=50, sample=80, updates=50)
    rows = [(1, f"{prose(rng, words, 4)} {k}", "en", "s") for k in range(2000)] + [(k, prose(rng, words, 4), "de", "s") for k in range(60)]
    rows += [(4, "always the same", "en", "s")] * 500
    sample = language_id.labelled_sample(spark.createDataFrame(rows, SCHEMA), settings).collect()
    assert len(sample) == 80 and max(Counter(r.lang for r in sample).values()) <= 50
    assert sum(r.doc_id == 4 for r in sample) <= 1


def test_language_predictions_by_brute_force(spark, words):
    """Every prediction recomputed from the model, n-gram by n-gram; the model is the same for any order of rows."""
    rng = random.Random(2)
    settings = language_id.Settings(updates=200)
    rows = [(k, prose(rng, words[:30] if k % 2 else words[30:], rng.randint(1, 30)), ["en", "de"][k % 2], "s") for k in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language_id.train(language_id.labelled_sample(docs, settings), settings)
    again = language_id.train(language_id.labelled_sample(docs.repartition(7), settings), settings)
    assert (model.embeddings == again.embeddings).all() and model.temperature == again.temperature
    grams = language_id.gram_cache(settings)
    for r in language_id.predict(docs, model, settings).collect():
        buckets = []
        for word in rows[r.doc_id][1].lower().split():
            edged = f"<{word}>"
            buckets += [grams[edged[k : k + n]] for n in (1, 2, 3) for k in range(len(edged) - n + 1)]
        z = (model.embeddings[buckets].mean(axis=0) @ model.weights + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.score == pytest.approx(float(p.max()), abs=1e-4) and r.lang_pred == model.languages[int(p.argmax())]


def test_mix_comes_near_its_targets_without_ids(spark, words):
    """Null, repeated and unique ids alike: the sum of taken words is near the target, to a document."""
    rng = random.Random(4)
    rows = [(None, prose(rng, words, 20), "en", "a") for _ in range(1500)] + [(k % 5, prose(rng, words, 20), "en", "a") for k in range(500)]
    rows += [(k, prose(rng, words, 15), "en", "b") for k in range(2000)] + [(k, prose(rng, words, 30), "en", None) for k in range(300)]
    found = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    for size in {r.source_size for r in found}:
        mine = [r for r in found if r.source_size == size]
        assert sum(r.taken for r in mine) == pytest.approx(mine[0].target, rel=0.01)
        assert all(r.taken <= 3 * r.size for r in mine)


@pytest.mark.parametrize("operator, gone", [(substring.substring_dedup, "n_removed"), (suffix_dedup.suffix_dedup, "n_removed")])
def test_texts_that_share_an_id_are_documents_of_their_own(spark, words, operator, gone):
    rng = random.Random(6)
    a, b, c, d = (prose(rng, words, n) for n in (80, 90, 100, 110))
    joint = b + " " + c
    rows = [(1, a), (5, a), (5, d), (5, b), (5, b), (5, joint), (9, d), (9, c), (None, a), (0, "short")]
    found = operator(spark.createDataFrame([(*r, "en", "s") for r in rows], SCHEMA))
    by = {}
    for r in found.collect():
        by.setdefault((r.doc_id, r[1]), []).append(r[gone])
    size = {t: len(t.split()) if operator is substring.substring_dedup else len(t.encode()) for t in (a, b, c, d, joint)}
    assert by[1, size[a]] == [0] and by[5, size[a]] == [size[a]] and by[None, size[a]] == [size[a]]
    assert by[5, size[d]] == [0] and by[9, size[d]] == [size[d]] and by[9, size[c]] == [size[c]]
    twice, cut = by[5, size[b]], by[5, size[joint]]  # of the two texts that hold b the one with the smaller hash keeps it
    assert (twice, cut) in [([0, 0], [size[b]]), ([size[b]] * 2, [0])]
