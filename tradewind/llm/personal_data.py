"""Personal data: fixed patterns, and a linear-chain conditional random field for what they miss.

The patterns find plain addresses and numbers.  The field labels words by kind (or none), from
word-shape features of the word and its neighbours; it is trained on a small labelled
table and decoded by Viterbi for all candidate words of a batch at once.  Words without digit
or ``@`` are never personal data by definition of the model, so the chain falls apart into
runs of candidate words, and decoding these is decoding the whole text.

Spans of the field are added where no pattern matched; pattern spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import table_batches

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[int, int, int]  # start, kind, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a number that is not entered in its middle: the same matches, without retries in long digit runs
QUAD = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BLANKS = " \t\n\v\f\r"
BLANK = re.compile(r"[\x20\x09-\x0D]")
MARK = re.compile(r"[0-9@]")
LINE_END = re.compile(r"[\x0A-\x0D]")
#: A word has a digit or ``@``, and no number that is cut off has more digits than this.
PART_WORDS = 19


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [sum(divmod(2 * d, 10)) for d in values[1::2]]) % 10 == 0


def only_digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    """Pattern matches: leftmost, not overlapping within a kind, failing ones dropped; sorted."""
    spans: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append((start, 0, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    for match in QUAD.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.groups()):
            spans.append((match.start(), 1, match.end()))
    for match in DIGITS.finditer(text):
        if match.end() - match.start() >= 14:
            digits = only_digits(match.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 10 <= len(only_digits(match.group())) <= 15:
                spans.append((match.start(), 3, match.end()))
    return sorted(spans)


# The labelled table: sentences with [kind:text] around personal data.
LABELLED = [
    "call me at [phone:(212) 555-0142] after nine",
    "phone [phone:212-555-0187] or write",
    "tel [phone:020 7946 0958] in the morning",
    "his number is [phone:555-0173-22] and hers [phone:555-0198-41]",
    "mobile [phone:07700 900461] please",
    "reach us on [phone:0044 20 7946 0321] today",
    "dial [phone:1-800-555-0199] now",
    "fax: [phone:(030) 901820-11] or mail",
    "the desk answers [phone:+49 30 901820] daily",
    "ring [phone:+1 (415) 555-0136] twice",
    "write to [email:ann.lee@example.com] soon",
    "mail [email:bob_77@mail.example.org] for help",
    "contact [email:sales@localhost] or visit",
    "his address is [email:j.doe@intranet] there",
    "from [email:<kim@example.net>] to all",
    "send it to [email:info@example.co.uk,] thanks",
    "the server [ip:192.0.2.17] is down",
    "ping [ip:198.51.100.204] and wait",
    "from [ip:203.0.113.9:8080] came a request",
    "host [ip:2001:db8:0:1::17] answered",
    "gateway [ip:fe80:0:0:0:1:2:3:4] is up",
    "card [card:4111 1111 1111 1111] expires soon",
    "pay with [card:5500-0000-0000-0004] today",
    "the account [card:4000000000000002] was charged",
    "visa [card:4222222222222] was lost",
    "in 1984 there were 52 of them",
    "chapter 12 verse 3 and page 417",
    "the price is 19.99 or 1,299.00 in all",
    "version 2.10.4 of 2021 and build 20210417",
    "on 2024-05-17 at 10:45 we met",
    "from 12/05/1999 to 31/12/2003 only",
    "order 4736962573099581 has shipped",
    "the code 1232810148878564 is void",
    "item 2390409500648960 and item 77",
    "number 123456789 in a list of 1000000",
    "rooms 101 102 103 and 104 are free",
    "scores 3 4 5 6 7 8 9 10 of ten",
    "999.1.2.3 is a section and 1.2.3 another",
    "build 400.500.600.700 failed again",
    "see figure 3-4 and table 10-11",
    "isbn 978-3-16-148410-0 is a book",
    "about 50% of 3000 people in 20 towns",
    "@home and @work are tags",
    "follow @someone or meet @ noon",
    "call 911 or 112 at once",
    "the call lasted 45 minutes and 30 seconds",
    "flight 1549 left at 15:26 with 155 people",
    "card 12 of 52 was the ace",
    "mail 3 copies to room 210",
    "phone 4 has 128 gigabytes",
    "ip 67 protects and port 8080 is open",
    "1st 2nd 3rd 4th and 5th",
    "x1 y2 z3 are names and a1b2c3 too",
    "2 + 2 = 4 and 10 - 3 = 7",
    "temperatures of -3 to +12 degrees",
    "between 1990-1995 and 2001-2005 it grew",
    "3,5 4,6 und 7,8 prozent",
    "la page 33 et le 14 juillet 1789",
    "el 12 de octubre de 1492",
    "am 3. oktober 1990 um 12 uhr",
]


@dataclass
class Field:
    """Feature weights per label, and label-to-label weights; label 0 is none."""

    weights: np.ndarray
    moves: np.ndarray
    place: dict[str, int] = field(default_factory=dict)


def shape(word: str) -> str:
    """Digits become 0, letters a or A; runs are shortened to at most two."""
    plain = re.sub(r"[0-9]", "0", re.sub(r"[^\W\d_A-Z]", "a", re.sub(r"[A-Z]", "A", word)))
    return re.sub(r"(.)\1{2,}", r"\1\1", plain)[:24]


def word_features(word: str) -> list[str]:
    core = word.strip(".,;:!?<>()[]{}\"'#*$%&|")
    digits = only_digits(word)
    parts = core.split(".")
    out = ["shape=" + shape(core), "edge=" + shape(core)[:2] + "/" + shape(core)[-2:], f"digits={min(len(digits), 20)}"]
    out += [f"kind={bool(digits)}{'@' in word}{any(c.isalpha() for c in core)}"]
    out += ["has=" + c for c in "@+()-.:/%," if c in word]
    if "@" in core[1:-1]:
        out.append("inner@")
    if 13 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        out.append(f"quad={all(len(p) <= 3 and int(p) <= 255 for p in parts)}")
    if re.fullmatch(r"[0-9A-Fa-f]{0,4}(:[0-9A-Fa-f]{0,4}){4,7}", core):
        out.append("colons")
    return out


CUES = frozenset("call phone tel mobile fax dial ring number reach desk mail write contact address send from server ping "
                 "host gateway card pay account visa order code item isbn version page chapter".split())  # fmt: skip


def cue(word: str) -> str:
    plain = word.strip(".,;:!?").lower()
    return plain if plain in CUES else shape(word) if MARK.search(word) else "word" if word else "none"


@dataclass
class Run:
    """Neighbouring candidate words: their places, and the features of each."""

    spans: list[tuple[int, int]]
    features: list[list[str]]


def word_at(text: str, at: int) -> tuple[int, int]:
    start = at
    while start and text[start - 1] not in BLANKS:
        start -= 1
    end = BLANK.search(text, at)
    return start, end.start() if end else len(text)


def neighbour(text: str, at: int, step: int) -> tuple[str, int]:
    """The word before or after a position, cut to 32 characters, and its near edge."""
    while 0 <= at < len(text) and text[at] in BLANKS:
        at += step
    if not 0 <= at < len(text):
        return "", at
    if step > 0:
        end = BLANK.search(text, at, at + 32)
        return text[at : end.start() if end else at + 32], at
    start = at
    while start and text[start - 1] not in BLANKS and at - start < 31:
        start -= 1
    return text[start : at + 1], at


def candidate_runs(text: str) -> list[Run]:
    words: list[tuple[int, int]] = []
    mark = MARK.search(text)
    while mark:
        words.append(word_at(text, mark.start()))
        mark = MARK.search(text, words[-1][1])
    runs: list[Run] = []
    for start, end in words:
        before, edge = neighbour(text, start - 1, -1)
        after, _ = neighbour(text, end, 1)
        features = word_features(text[start:end]) + ["before=" + cue(before), "after=" + cue(after)]
        if runs and runs[-1].spans[-1][1] == edge + 1:
            runs[-1].spans.append((start, end))
            runs[-1].features.append(features)
        else:
            runs.append(Run([(start, end)], [features]))
    return runs


def labelled_runs(sentences: list[str]) -> list[tuple[Run, list[int]]]:
    """Candidate runs of marked sentences with the label of each word."""
    out = []
    for sentence in sentences:
        text, spans = "", []
        for part in re.split(r"(\[[a-z]+:[^\]]*\])", sentence):
            mark = re.fullmatch(r"\[([a-z]+):([^\]]*)\]", part)
            if mark:
                spans.append((len(text), len(text) + len(mark[2]), KINDS.index(mark[1]) + 1))
            text += mark[2] if mark else part
        for run in candidate_runs(text):
            labels = [next((k for a, b, k in spans if a < end and start < b), 0) for start, end in run.spans]
            out.append((run, labels))
    return out


def padded(runs: list[Run], model: Field) -> tuple[np.ndarray, np.ndarray]:
    """Feature scores (runs x words x labels), the longest run first, and lengths."""
    lengths = np.array([len(r.features) for r in runs])
    scores = np.zeros((len(runs), int(lengths.max()), model.weights.shape[1]))
    for k, run in enumerate(runs):
        for t, names in enumerate(run.features):
            found = [model.place[n] for n in names if n in model.place]
            scores[k, t] = model.weights[found].sum(axis=0)
    return scores, lengths


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(sentences: list[str] = LABELLED, steps: int = 300, rate: float = 0.1, decay: float = 0.01) -> Field:
    """Maximum likelihood by gradient ascent over all runs at once; chains begin and end in none."""
    data = labelled_runs(sentences)
    runs, labels = [d[0] for d in data], [d[1] for d in data]
    names = sorted({n for run in runs for names in run.features for n in names})
    n_labels = len(KINDS) + 1
    model = Field(np.zeros((len(names), n_labels)), np.zeros((n_labels, n_labels)), {n: k for k, n in enumerate(names)})
    width, n = max(map(len, labels)), len(runs)
    used = np.zeros((n, width, len(names)))
    gold, real = np.zeros((n, width), int), np.zeros((n, width), bool)
    for k, (run, mine) in enumerate(zip(runs, labels, strict=True)):
        gold[k, : len(mine)], real[k, : len(mine)] = mine, True
        for t, found in enumerate(run.features):
            used[k, t, [model.place[f] for f in found]] = 1
    one = np.eye(n_labels)
    gold_moves = one[0] * 0 + np.zeros((n_labels, n_labels))
    for mine in labels:
        for a, b in zip([0, *mine], [*mine, 0], strict=True):
            gold_moves[a, b] += 1
    velocity = [np.zeros_like(model.weights), np.zeros_like(model.moves)]
    square = [np.zeros_like(model.weights), np.zeros_like(model.moves)]
    for step in range(1, steps + 1):
        scores = used @ model.weights
        forward, backward = np.zeros((n, width, n_labels)), np.zeros((n, width, n_labels))
        forward[:, 0] = model.moves[0] + scores[:, 0]
        for t in range(1, width):
            reached = log_sum(forward[:, t - 1, :, None] + model.moves, 1) + scores[:, t]
            forward[:, t] = np.where(real[:, t, None], reached, forward[:, t - 1])
        total = log_sum(forward[:, -1] + model.moves[:, 0], 1)
        backward[:, -1] = model.moves[:, 0]
        for t in range(width - 2, -1, -1):
            ahead = log_sum(model.moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], ahead, model.moves[:, 0])
        share = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        moves = share[:, 0].sum(axis=0)[None, :] * one[0][:, None]
        for t in range(1, width):
            pair = forward[:, t - 1, :, None] + model.moves + (scores[:, t] + backward[:, t])[:, None, :]
            moves = moves + (np.exp(pair - total[:, None, None]) * real[:, t, None, None]).sum(axis=0)
        last = real.sum(axis=1) - 1
        moves = moves + share[np.arange(n), last].sum(axis=0)[:, None] * one[0][None, :]
        truth = one[gold] * real[:, :, None]
        slopes = [np.einsum("ktf,ktl->fl", used, truth - share) - decay * model.weights,
                  gold_moves - moves - decay * model.moves]
        for k, (values, slope) in enumerate(zip((model.weights, model.moves), slopes, strict=True)):
            velocity[k] = 0.9 * velocity[k] + 0.1 * slope
            square[k] = 0.999 * square[k] + 0.001 * slope**2
            values += rate * (velocity[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return model


def viterbi(runs: list[Run], model: Field) -> list[list[int]]:
    """Best labels of every run, all runs advancing word by word together."""
    if not runs:
        return []
    order = sorted(range(len(runs)), key=lambda k: -len(runs[k].features))
    out: list[list[int]] = [[] for _ in runs]
    for at in range(0, len(order), 4096):  # runs of similar length, so little is padded
        some = order[at : at + 4096]
        scores, lengths = padded([runs[k] for k in some], model)
        best = model.moves[0] + scores[:, 0]
        back = np.zeros(scores.shape, np.int8)
        for t in range(1, scores.shape[1]):
            active = int((lengths > t).sum())
            reached = best[:active, :, None] + model.moves
            back[:active, t] = reached.argmax(axis=1)
            best[:active] = reached.max(axis=1) + scores[:active, t]
        label = (best + model.moves[:, 0]).argmax(axis=1)
        for k, run in enumerate(some):
            mine, now = [], int(label[k])
            for t in range(lengths[k] - 1, -1, -1):
                mine.append(now)
                now = int(back[k, t, now])
            out[run] = mine[::-1]
    return out


def plausible(kind: int, text: str) -> bool:
    """Least requirements for a span of the field."""
    digits = len(only_digits(text))
    if kind == 0:
        return bool(re.search(r"[A-Za-z0-9]@[A-Za-z0-9]", text))
    if kind == 1:
        return text.count(":") >= 4 or bool(re.fullmatch(r"[0-9]+(\.[0-9]+){3}(:[0-9]+)?", text))
    return 13 <= digits <= 19 and luhn(only_digits(text)) if kind == 2 else 9 <= digits <= 15


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """A span without outer punctuation."""
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while a < b and not text[b - 1].isalnum():
        b -= 1
    return a, b


def split_items(text: str, kind: int, words: list[tuple[int, int]]) -> list[Span]:
    """Neighbouring words of one kind as one plausible span, or else as plausible parts.

    Of all ways to cut, the one that covers most words, crosses fewest line ends and has fewest parts.
    """
    a, b = trimmed(text, words[0][0], words[-1][1])
    if a < b and plausible(kind, text[a:b]):
        return [(a, kind, b)]
    best: list[tuple[tuple[int, int, int], int]] = [((0, 0, 0), 0)]  # for the words before: score, words of the last part
    for end in range(1, len(words) + 1):
        found = (best[-1][0], 0)
        for size in range(1, min(end, PART_WORDS) + 1):
            a, b = trimmed(text, words[end - size][0], words[end - 1][1])
            if a < b and plausible(kind, text[a:b]):
                covered, lines, parts = best[end - size][0]
                crossed = bool(LINE_END.search(text, a, b))
                found = max(found, ((covered + size, lines - crossed, parts - 1), size))
        best.append(found)
    out, end = [], len(words)
    while end:
        size = best[end][1]
        if size:
            a, b = trimmed(text, words[end - size][0], words[end - 1][1])
            out.append((a, kind, b))
        end -= max(size, 1)
    return out[::-1]


def outside(words: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """What the taken spans (apart, in order) leave of neighbouring words, in one list between two of them."""
    out: list[list[tuple[int, int]]] = [[]]
    k = bisect_right(taken, words[0][0], key=lambda span: span[1])
    for a, b in words:
        while k < len(taken) and taken[k][0] < b:
            if a < taken[k][0]:
                out[-1].append((a, taken[k][0]))
            out.append([])
            a = max(a, taken[k][1])
            if a >= b:
                break
            k += 1
        if a < b:
            out[-1].append((a, b))
        while k < len(taken) and taken[k][1] <= b:
            k += 1
    return [some for some in out if some]


def added_spans(text: str, runs: list[Run], labels: list[list[int]], base: list[Span]) -> list[Span]:
    """Neighbouring words of one kind as spans, without outer punctuation and without what base spans cover."""
    taken: list[tuple[int, int]] = []
    for x, _, y in sorted(base):
        if taken and x <= taken[-1][1]:
            taken[-1] = taken[-1][0], max(taken[-1][1], y)
        else:
            taken.append((x, y))
    out: list[Span] = []
    for run, mine in zip(runs, labels, strict=True):
        t = 0
        while t < len(mine):
            end = t
            while end + 1 < len(mine) and mine[end + 1] == mine[t]:
                end += 1
            if mine[t]:
                for words in outside(run.spans[t : end + 1], taken):
                    out += split_items(text, mine[t] - 1, words)
            t = end + 1
    return out


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_spans(texts: list[str], model: Field) -> Iterator[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of each text."""
    runs = [candidate_runs(text) for text in texts]
    labels = iter(viterbi([r for own in runs for r in own], model))
    for text, own in zip(texts, runs, strict=True):
        base = base_spans(text)
        yield base, sorted(base + added_spans(text, own, [next(labels) for _ in own], base))


def personal_data(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """One row per document: doc_id, number of pattern spans per kind, base_sha256, spans.

    Positions count code points; a null text is empty.  Repeated rows are treated one by one.
    """
    model = model or train()

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in table_batches(batches):
            found = list(find_spans([t or "" for t in rows["text"]], model))
            counts = [[sum(kind == k for _, kind, _ in base) for base, _ in found] for k in range(len(KINDS))]
            sums = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            columns = [pa.array(c, pa.int64()) for c in (rows["doc_id"], *counts)]
            columns += [pa.array(sums, pa.string()), pa.array([joined(spans) for _, spans in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    schema = ", ".join(f"{n} long" for n in names[:5]) + ", base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones together) replaced by its kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_documents(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """The documents with personal data masked; n_chars, where there is one, follows.  Null texts stay."""
    model = model or train()
    names = docs.columns

    def mask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            clean: list[str | None] = []
            for at in range(0, len(texts), 1000):
                some = texts[at : at + 1000]
                found = find_spans([t or "" for t in some], model)
                clean += [None if t is None else masked(t, spans) for t, (_, spans) in zip(some, found, strict=True)]
            columns = [pa.array(clean, batch.schema.field("text").type) if n == "text" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = docs.mapInArrow(mask, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
