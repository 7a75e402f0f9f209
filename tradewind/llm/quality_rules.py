"""Quality rules by distribution divergence.

For every language the corpus gives two reference histograms, counted over all documents
of that language: character classes, and its commonest words (all other words
form one class).  A document is compared with the references by the Jensen-Shannon
distance (square root of the divergence in bits, 0 to 1) and judged by the nearest one.
Short documents have noisy histograms, so each comparison has a minimum length.  So do references: a language needs
a minimum of documents and words, and a document's own counts are left out of the reference of its language, so
that no text can vouch for itself.  Documents of smaller languages are held against the others' references.

Fixed counts (words, symbols, repeated lines and windows) come first; a document that
fails them is rejected whatever its histograms say.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import store, table_batches, words_of

SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\v\f\r"
CLASSES = ["lower", "upper", "letter", "digit", "blank", "stop", "mark", "symbol", "other"]
#: Different words that a task counts before it sends the counts on.
HELD_WORDS = 400_000
STRIP = ".,;:!?()\"'"
#: Languages that a text is compared with at a time.
LANGUAGES = 512
LONGS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = ", ".join(f"{n} long" for n in LONGS)
SCHEMA += ", base_failed boolean, kept boolean, class_distance double, word_distance double"


@dataclass(frozen=True)
class Rules:
    """Parameters; a distance (0 to 1) may exceed its limit by slack / sqrt(length)."""

    min_words: int = 10
    max_repeat_percent: int = 20
    repeat_window: int = 5
    common_words: int = 100
    class_min_chars: int = 200
    class_max_distance: float = 0.16
    class_slack: float = 1.5
    word_min_words: int = 60
    word_max_distance: float = 0.42
    word_slack: float = 0.6
    reference_min_documents: int = 10
    reference_min_words: int = 1000


def class_table() -> np.ndarray:
    """Class number of every code point of the basic plane; the rest counts as other."""
    table = np.full(0x10000, CLASSES.index("other"), np.uint8)
    first = {"L": "letter", "M": "letter", "N": "digit", "P": "mark", "S": "symbol", "Z": "blank"}
    for point in range(0x10000):
        kind = unicodedata.category(chr(point))
        name = {"Ll": "lower", "Lu": "upper"}.get(kind) or first.get(kind[0], "other")
        table[point] = CLASSES.index(name)
    for chars, name in ((BLANK, "blank"), (STRIP + "-", "stop")):
        table[[ord(c) for c in chars]] = CLASSES.index(name)
    return table


def class_counts(text: str, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(table[np.minimum(points, 0xFFFF)], minlength=len(CLASSES))


def plain_word(word: str) -> str:
    return word.strip(STRIP).lower()


def repeated_words(words: list[str], window: int = 5) -> int:
    """Words covered by windows of consecutive words that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code, size = ids[:n].copy(), len(number)
    for k in range(1, window):  # dense ids keep the codes exact in 64 bits
        if size * len(number) >= 2**62:
            code = np.unique(code, return_inverse=True)[1]
            size = int(code.max()) + 1
        code = code * len(number) + ids[k : k + n]
        size *= len(number)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    return len(lines) - len(set(lines))


def distance(p: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of one distribution, or of one per row, to each row of the references."""
    middle = (refs + p) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(refs > 0, refs * np.log2(refs / middle), 0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def over(value: float | None, limit: float, slack: float, length: int) -> bool:
    return value is not None and value > limit + slack / length**0.5


def corpus_histograms(docs: DataFrame) -> DataFrame:
    """Counts (lang, kind, item, n) over all documents with a language and a text; kind is documents, class or word."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        holders: Counter = Counter()
        for rows in table_batches(batches):
            for lang, text in zip(rows["lang"], rows["text"], strict=True):
                if lang is not None and text:
                    words.setdefault(lang, Counter()).update(words_of(text))
                    classes[lang] = classes.get(lang, 0) + class_counts(text, table)
                    holders[lang] += 1
            if sum(map(len, words.values())) > HELD_WORDS:
                yield counted(words, classes, holders)
                words, classes, holders = {}, {}, Counter()
        yield counted(words, classes, holders)

    def counted(words: dict[str, Counter], classes: dict[str, np.ndarray], holders: Counter) -> pa.RecordBatch:
        out = [(lang, "documents", "", n) for lang, n in holders.items()]
        out += [(lang, "class", CLASSES[k], int(n)) for lang, c in classes.items() for k, n in enumerate(c) if n]
        for lang, counter in words.items():
            plain: Counter = Counter()
            for word, n in counter.items():
                plain[plain_word(word)] += n
            out += [(lang, "word", word, n) for word, n in plain.items() if word]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "kind", "item", "n"])

    types = [pa.string(), pa.string(), pa.string(), pa.int64()]
    counts = docs.select("lang", "text").mapInArrow(count, "lang string, kind string, item string, n long")
    return counts.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


@dataclass
class References:
    """A block of languages: counts of classes and of common words (others last), and where a word counts."""

    languages: dict[str, int]
    classes: np.ndarray
    words: np.ndarray
    place: dict[str, tuple[list[int], list[int]]]  # languages that have the word among their common ones, and columns

    def nearest_classes(self, counts: np.ndarray, lang: str | None) -> float:
        return nearest(np.broadcast_to(counts, self.classes.shape), self.classes, self.languages.get(lang))

    def nearest_words(self, plain: Counter, lang: str | None) -> float:
        total, counts = sum(plain.values()), np.zeros(self.words.shape)
        for word, n in plain.items():
            if word in self.place:
                counts[self.place[word]] = n
        counts[:, -1] = total - counts.sum(axis=1)
        return nearest(counts, self.words, self.languages.get(lang))


def nearest(counts: np.ndarray, references: np.ndarray, own: int | None) -> float:
    """Least distance of one document's counts, a row per reference, to the references; without itself in its ``own`` one."""
    shares = references / references.sum(axis=1, keepdims=True)
    if own is not None:
        others = np.maximum(references[own] - counts[own], 0)
        if not others.sum():
            shares, counts = np.delete(shares, own, axis=0), np.delete(counts, own, axis=0)
        else:
            shares[own] = others / others.sum()
    return float(distance(counts / counts.sum(axis=1, keepdims=True), shares).min()) if len(shares) else 1.0


def language_references(docs: DataFrame, rules: Rules) -> list[References]:
    """References of every language with enough documents and words.

    They are written with ``common_words`` words a language (some 2 KB) and fetched a partition at a time.
    """
    counts = store(corpus_histograms(docs), "histograms")
    totals = counts.groupBy("lang").agg(
        F.sum(F.when(F.col("kind") == "word", F.col("n"))).alias("words"),
        F.sum(F.when(F.col("kind") == "documents", F.col("n"))).alias("documents"),
        *[F.coalesce(F.sum(F.when((F.col("kind") == "class") & (F.col("item") == c), F.col("n"))), F.lit(0)).alias(c) for c in CLASSES],
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))
    top = counts.filter(F.col("kind") == "word").withColumn("rank", rank).filter(F.col("rank") <= rules.common_words)
    common = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "item", "n"))).alias("common"))
    enough = (F.col("words") >= rules.reference_min_words) & (F.col("documents") >= rules.reference_min_documents)
    rows = store(totals.filter(enough).join(common, "lang"), "references").toLocalIterator()
    out = []
    while some := list(islice(rows, LANGUAGES)):
        classes = np.array([[row[c] for c in CLASSES] for row in some], float)
        counts = np.zeros((len(some), rules.common_words + 1))
        place: dict[str, tuple[list[int], list[int]]] = {}
        for k, row in enumerate(some):
            found = np.array([n for _, _, n in row.common], float)
            counts[k, : len(found)] = found
            counts[k, -1] = row.words - found.sum()
            for column, (_, word, _) in enumerate(row.common):
                languages, columns = place.setdefault(word, ([], []))
                languages.append(k), columns.append(column)
        out.append(References({row.lang: k for k, row in enumerate(some)}, classes, counts, place))
    return out


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """One row per document: doc_id, counts, distances (null below the minimum length), verdicts.

    A null or empty text has no words and fails.  Without any language that is large enough there is
    no reference, and the counts alone decide.  Repeated rows are judged one by one.
    """
    return docs.select(F.col("doc_id").cast("long"), "text", "lang").mapInArrow(judgement(docs, rules), SCHEMA)


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """The documents that the rules keep: each row is judged by its own text, whatever its id."""
    judge = judgement(docs, rules)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = pa.nulls(batch.num_rows, pa.int64())
            texts = pa.RecordBatch.from_arrays([none, batch.column("text"), batch.column("lang")], names=["doc_id", "text", "lang"])
            verdicts = [v for judged in judge([texts]) for v in judged.column("kept").to_pylist()]
            yield batch.filter(pa.array(verdicts, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def judgement(docs: DataFrame, rules: Rules) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function from batches of doc_id, text and lang to their verdicts."""
    refs = language_references(docs, rules)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        for rows in table_batches(batches):
            out: dict[str, list] = {name: [] for name in names}
            for doc_id, text, lang in zip(rows["doc_id"], rows["text"], rows["lang"], strict=True):
                text = text or ""
                words = words_of(text)
                repeats = repeated_words(words, rules.repeat_window)
                failed = len(words) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(words)
                by_class = by_word = None
                if refs and len(text) >= rules.class_min_chars:
                    counts = class_counts(text, table)
                    by_class = min(r.nearest_classes(counts, lang) for r in refs)
                if refs and len(words) >= rules.word_min_words:
                    by_word = nearest_words(Counter(words), lang)
                far = over(by_class, rules.class_max_distance, rules.class_slack, len(text))
                far = far or over(by_word, rules.word_max_distance, rules.word_slack, len(words))
                values = (doc_id, len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
                          duplicate_lines(text), repeats, failed, not (failed or far), by_class, by_word)
                for name, value in zip(names, values, strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    def nearest_words(counter: Counter, lang: str | None) -> float | None:
        plain: Counter = Counter()
        for word, n in counter.items():
            plain[plain_word(word)] += n
        plain.pop("", None)
        return min(r.nearest_words(plain, lang) for r in refs) if plain else None

    fields = [(n, pa.int64()) for n in LONGS] + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
    fields += [("class_distance", pa.float64()), ("word_distance", pa.float64())]
    arrow, names = pa.schema(fields), [n for n, _ in fields]
    return judge

