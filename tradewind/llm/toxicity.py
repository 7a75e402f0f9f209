"""Toxicity by a learned lexicon, met through Levenshtein automata, and the window around each hit.

The lexicon holds words, and stems with many endings, that labelled toxic documents use in many
different surroundings and clean ones hardly ever (surroundings and not documents are counted, so that
copies of one text add nothing).  It lies in a trie.  The trie is intersected with the Levenshtein automata
of its entries, and the product is made deterministic as words are read: a state is a set of trie nodes with
the edits spent, and nearly all words leave it after a few characters.  A misspelled hit counts only if the
word is not one that clean documents use.

Around a hit a window decides whether it is abuse or quotation: quotation marks that enclose it, words of
reporting and words of address, and the words that stood near hits in labelled documents of either kind.
A logistic model over the sums of both kinds gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import Cache, store

#: Bounds of what is learned: labelled documents per class, and what leaves Spark for the model.
SAMPLE_PER_CLASS = 4_000
LEXICON_WORDS, LEXICON_STEMS, CLEAN_WORDS, WINDOW_WORDS = 600, 150, 50_000, 2_000
USUAL_WORDS = 500  # the most usual words of clean documents say nothing about a window
MIN_SURROUNDINGS, MIN_STEM_SURROUNDINGS, MIN_STEM_WORDS = 8, 24, 3
MIN_ODDS, MIN_STEM_ODDS = 2.5, 3.5  # natural logarithms
STEM_LENGTHS = range(4, 8)
WINDOW = 5  # words on each side
STATES = 30_000
THRESHOLD = 0.7

# Words of reporting and of address, and quotation marks, in the four languages of the tables.
REPORTING = (
    "said says say called calls quote quoted wrote written word words term insult reported according "
    "sagte sagt nannte zitat zitiert schrieb wort laut dit disait appelait mot cite écrit selon dijo dice llamó palabra cita según"
).split()
ADDRESS = "you your youre u du dich dir dein ihr euch tu te toi ton vous votre tú ti eres usted vosotros".split()
OPENING, CLOSING = "\"“„«‘‹", "\"”“»’›"

TOKEN = re.compile(r"[^\W_](?:\S*[^\W_])?")
PART = re.compile(r"[^\W_]+")
RUN = re.compile(r"(.)\1{2,}")


def allowed_edits(text: str, is_stem: bool = False) -> int:
    """Stems already allow for any ending, so they are met without edits."""
    return 0 if is_stem or len(text) < 5 else 1 if len(text) < 9 else 2


class FuzzyLexicon:
    """A trie of (text, is_stem) entries met by words with few edits; determinized as words are read."""

    def __init__(self, entries: list[tuple[str, bool]]):
        self.entries = entries
        self.children: list[dict[str, int]] = [{}]
        self.depth, self.limit = [0], [0]
        self.ends: list[list[int]] = [[]]
        for number, (text, is_stem) in enumerate(entries):
            node, edits = 0, allowed_edits(text, is_stem)
            self.limit[0] = max(self.limit[0], edits)
            for char in text:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({}), self.depth.append(self.depth[node] + 1)
                    self.limit.append(0), self.ends.append([])
                node = self.children[node][char]
                self.limit[node] = max(self.limit[node], edits)
            self.ends[node].append(number)
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.whole: list[tuple[int, int] | None] = []  # (edits, entry) if the word ends here
        self.stem: list[tuple[int, int] | None] = []
        self.start = self.state({0: 0})

    def may_spend(self, node: int, edits: int) -> bool:
        """A second edit only beyond the first characters of an entry, which keeps the automaton small."""
        return edits <= min(self.limit[node], 1 if self.depth[node] < 4 else 2)

    def state(self, least: dict[int, int]) -> int:
        """Number of the state with these nodes and edits, after skipping characters of entries."""
        todo = list(least.items())
        while todo:
            node, edits = todo.pop()
            if edits == least[node]:
                for child in self.children[node].values():
                    if edits + 1 < least.get(child, 99) and self.may_spend(child, edits + 1):
                        least[child] = edits + 1
                        todo.append((child, edits + 1))
        key = frozenset(least.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(key), self.next.append({})
            ends = [(edits, n) for node, edits in key for n in self.ends[node] if edits <= allowed_edits(*self.entries[n])]
            self.whole.append(min((x for x in ends if not self.entries[x[1]][1]), default=None))
            self.stem.append(min((x for x in ends if self.entries[x[1]][1]), default=None))
        return self.numbers[key]

    def step(self, state: int, char: str) -> int:
        least: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits < least.get(node, 99) and self.may_spend(node, edits):
                least[node] = edits

        for node, edits in self.sets[state]:
            reach(node, edits + 1)  # one character too many
            for own, child in self.children[node].items():
                reach(child, edits + (own != char))
        return self.state(least) if least else -1

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the closest entry: fewest edits, then whole words before stems."""
        if len(self.sets) > STATES:
            self.reset()
        state, found = self.start, None
        for char in word:
            following = self.next[state].get(char)
            if following is None:
                following = self.next[state][char] = self.step(state, char)
            state = following
            if state < 0:
                return found
            if self.stem[state] and (found is None or self.stem[state] < found):
                found = self.stem[state]
        whole = self.whole[state]
        return whole if whole and (found is None or whole[0] <= found[0]) else found


class Model:
    """Lexicon with weights, the words clean documents use, window weights and the logistic model."""

    def __init__(self, entries: list[tuple[str, bool]], weights: list[float], clean: list[str]):
        self.entries, self.weights, self.clean = entries, weights, frozenset(clean)
        self.usual = frozenset(clean[:USUAL_WORDS])
        self.window: dict[str, float] = {}
        self.coefficients = PRIOR.copy()

    def reader(self) -> Reader:
        return Reader(self)


#: Prior means of the logistic model, in the order of ``Reader.features``; training moves away from them where data say so.
PRIOR = np.array([-3.0, 3.0, 1.5, -0.5, 1.0])
PRIOR_WEIGHT = 2.0


class Reader:
    """A task's view of a model: automaton and cache of words."""

    def __init__(self, model: Model):
        self.model, self.lexicon = model, FuzzyLexicon(model.entries)
        self.cache = Cache(self.look_up)

    def look_up(self, token: str) -> tuple[int, int] | None:
        """(edits, entry) of a token: as a whole, or one of its parts between other characters."""
        plain = RUN.sub(r"\1", token.lower())
        best = self.accepted(plain)
        if not best and not plain.isalnum():
            best = min(filter(None, map(self.accepted, PART.findall(plain))), default=None)
        return best

    def accepted(self, word: str) -> tuple[int, int] | None:
        found = self.lexicon.match(word)
        return None if found and found[0] and word in self.model.clean else found

    def hits(self, text: str) -> tuple[int, list[tuple[int, int, list[str], bool]]]:
        """Number of words; (entry, edits, words of the window, quoted) of each hit."""
        tokens = TOKEN.findall(text)
        found = list(map(self.cache.__getitem__, tokens))
        at = [k for k, hit in enumerate(found) if hit]
        out, where, passed = [], 0, 0
        for k in at:
            for token in tokens[passed : k + 1]:  # places are sought only up to the last hit
                where = text.index(token, where) + len(token)
            passed = k + 1
            edits, entry = found[k]
            near = [w.lower() for w in tokens[max(0, k - WINDOW) : k] + tokens[k + 1 : k + 1 + WINDOW]]
            out.append((entry, edits, near, quoted(text, where - len(tokens[k]), where)))
        return len(tokens), out

    def quotation(self, near: list[str], quoted: bool) -> float:
        """From 0 (abuse) to 1 (quotation)."""
        score = 2.0 * quoted - 1.0
        score += 1.0 * any(w in REPORTING_SET for w in near) - 1.0 * any(w in ADDRESS_SET for w in near)
        learned = [self.model.window[w] for w in near if w in self.model.window]
        score -= sum(learned) / len(learned) if learned else 0.0
        return 1 / (1 + math.exp(-2 * score))

    def features(self, text: str) -> list[float]:
        words, hits = self.hits(text)
        exact = misspelled = cited = 0.0
        for entry, edits, near, in_quotes in hits:
            q = self.quotation(near, in_quotes)
            weight = self.model.weights[entry]
            cited += weight * q
            if edits:
                misspelled += weight * (1 - q)
            else:
                exact += weight * (1 - q)
        density = 100 * (exact + misspelled) / max(words, 20)
        return [1.0, math.log1p(exact), math.log1p(misspelled), math.log1p(cited), math.log1p(density)]

    def score(self, text: str) -> float:
        z = float(np.dot(self.model.coefficients, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


REPORTING_SET, ADDRESS_SET = frozenset(REPORTING), frozenset(ADDRESS)


def quoted(text: str, start: int, end: int, reach: int = 60) -> bool:
    """Whether quotation marks on the same line enclose the span, at most ``reach`` characters away on either side."""
    before = text[max(0, start - reach) : start].rpartition("\n")[2]
    after = text[end : end + reach].partition("\n")[0]
    opened = max((before.rfind(c) for c in OPENING), default=-1)
    closed = max((before.rfind(c) for c in CLOSING if c not in OPENING), default=-1)
    odd = before.count('"') % 2 == 1 if opened >= 0 and before[opened] == '"' else opened > closed
    return odd and any(c in after for c in CLOSING)


def is_held_out(doc_id: Column, remainder: int = 1, modulus: int = 3) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(toxic, half, text): at most ``per_class`` rows of each class, drawn by hashes.

    Labels first, which are small, then once more among the rows that carry the drawn ids, as ids may repeat.
    An id with both labels counts as toxic.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_id = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id")
    drawn = known.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= per_class)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = rows.join(F.broadcast(drawn.select("doc_id", "toxic")), "doc_id")  # at most two classes of ``per_class`` ids
    rows = rows.withColumn("hash", F.xxhash64("doc_id", "text"))
    by_row = Window.partitionBy("toxic").orderBy("hash", "doc_id")
    rows = rows.withColumn("place", F.row_number().over(by_row)).filter(F.col("place") <= per_class)
    # the lexicon is learned on two thirds, the logistic model on what the lexicon has not seen
    half = F.when(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) < 2, "lexicon").otherwise("model")
    return rows.select("toxic", half.alias("half"), F.coalesce("text", F.lit("")).alias("text"))


def surroundings(rows: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many different surroundings (word before, word after) each class has it."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                seen = set()
                for toxic, text in zip(part.column("toxic").to_pylist(), part.column("text").to_pylist(), strict=True):
                    words = [w.lower() for w in TOKEN.findall(text)]
                    seen.update(zip(words, ["", *words], [*words[1:], ""], [toxic] * len(words)))
                columns = list(zip(*seen, strict=True)) or [(), (), (), ()]
                kinds = [pa.string(), pa.string(), pa.string(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "before", "after", "toxic"])

    found = rows.select("toxic", "text").mapInArrow(work, "word string, before string, after string, toxic int").distinct()
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def learn_lexicon(rows: DataFrame) -> Model:
    """Words and stems that only toxic documents use in many surroundings, and the usual words of clean ones."""
    words = store(surroundings(rows), "toxicity-words")
    total = words.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    toxic_all, clean_all = (total.toxic or 0) + 1.0, (total.clean or 0) + 1.0
    odds = F.log((F.col("toxic") + 0.5) / toxic_all) - F.log((F.col("clean") + 0.5) / clean_all)
    length = F.length("word")
    sure = words.withColumn("odds", odds).filter((F.col("toxic") >= MIN_SURROUNDINGS) & (F.col("odds") >= MIN_ODDS) & length.between(3, 40))
    sure = sure.orderBy(F.desc("odds"), "word").limit(LEXICON_WORDS).collect()
    prefixes = F.explode(F.array(*[F.struct(F.expr(f"left(word, {n})").alias("stem"), (length > n).alias("longer")) for n in STEM_LENGTHS])).alias("x")
    stems = words.filter(length >= min(STEM_LENGTHS)).select("toxic", "clean", prefixes).select("toxic", "clean", "x.*").filter("longer")
    stems = stems.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count_if(F.col("toxic") > 0).alias("words"))
    stems = stems.withColumn("odds", odds).filter((F.col("toxic") >= MIN_STEM_SURROUNDINGS) & (F.col("odds") >= MIN_STEM_ODDS) & (F.col("words") >= MIN_STEM_WORDS))
    shortest: dict[str, float] = {}  # a stem that begins with another one adds nothing
    for r in stems.orderBy(F.desc("odds"), "stem").limit(8 * LEXICON_STEMS).collect():
        if not any(r.stem[:n] in shortest for n in STEM_LENGTHS) and len(shortest) < LEXICON_STEMS:
            shortest[r.stem] = r.odds
    entries = [(r.word, False) for r in sure] + [(stem, True) for stem in shortest]
    weights = [r.odds for r in sure] + list(shortest.values())
    top = max(weights, default=1.0)
    clean = words.filter("clean >= 1").orderBy(F.desc("clean"), "word").limit(CLEAN_WORDS).select("word").collect()
    known = {e for e, _ in entries}
    return Model(entries, [w / top for w in weights], [r.word for r in clean if r.word not in known])


def learn_window(rows: DataFrame, model: Model) -> dict[str, float]:
    """Per word its weight near hits: above 0 beside abuse, below 0 beside quotations, shrunk where seen little."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            words, toxic = [], []
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                near = {w for _, _, window, _ in reader.hits(text)[1] for w in window} - model.usual
                words.extend(near), toxic.extend([label] * len(near))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], names=["word", "toxic"])

    seen = rows.select("toxic", "text").mapInArrow(work, "word string, toxic int")
    counts = seen.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).filter("n >= 5")
    counts = counts.orderBy(F.desc("n"), "word").limit(WINDOW_WORDS).collect()
    toxic, n = sum(r.toxic for r in counts), sum(r.n for r in counts)
    base = math.log((toxic + 1) / (n - toxic + 1))
    shrunk = {r.word: (math.log((r.toxic + 1) / (r.n - r.toxic + 1)) - base) * r.n / (r.n + 20) for r in counts}
    return {w: max(-1.0, min(1.0, v)) for w, v in shrunk.items()} if 0 < toxic < n else {}


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray = PRIOR, weight: float = PRIOR_WEIGHT) -> np.ndarray:
    """Newton steps to the maximum of the likelihood with normal priors; classes count alike in sum."""
    w = prior.copy()
    if not len(y):
        return w
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * min(len(y), 2_000)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + weight * (w - prior)
        hessian = (x.T * (share * p * (1 - p))) @ x + weight * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Lexicon, window weights and logistic model of a bounded sample of labelled documents."""
    rows = store(examples(docs, labels, per_class), "toxicity-examples")
    model = learn_lexicon(rows.filter("half = 'lexicon'"))
    model.window = learn_window(rows.filter("half = 'lexicon'"), model)

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            x = np.array([reader.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(PRIOR))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(c) for c in x.T)], names=["toxic", *names])

    names = [f"x{k}" for k in range(len(PRIOR))]
    schema = "toxic int, " + ", ".join(f"{n} double" for n in names)
    sample = rows.filter("half = 'model'").select("toxic", "text").mapInArrow(measured, schema).toArrow()
    x = np.column_stack([sample.column(n).to_numpy() for n in names]) if sample.num_rows else np.empty((0, len(PRIOR)))
    order = np.lexsort(x.T) if len(x) else np.empty(0, int)  # the order of rows must not show in the last digits
    model.coefficients = fit_logistic(x[order], sample.column("toxic").to_numpy()[order])
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on) of each document.

    Labels of held-out ids are not read.  Null and empty texts have the score of a text without hits; rows are scored each
    for itself, so ids may be null or repeat.  Without labels the lexicon is empty and every score the prior's.
    """
    model = train(docs, labels, per_class)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                scores = [reader.score(text or "") for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    scored = rows.mapInArrow(work, "doc_id long, score double")
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
