"""Token ids of many texts at the price of their distinct words.

Whole-text encoding spends most of its time on words met before.  For tokenizers that
lower-case, drop white space and split words by the fixed pattern below, the ids of a text are
those of its words, numbers and runs of signs, one after the other; these are kept in a bounded cache, and
those not met before are encoded together.  Texts of plain Latin characters are split at once, others
by stretches between blanks: plain stretches are split alike, the rest goes through the tokenizer.
Any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np

TOKEN_BYTES = 4
CHUNK = re.compile(r"[^ \t\n\r]+")
# Fixed value: the split pattern of the public word-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Visible characters below U+0250 but U+0130: composed, and lower-cased one by one.
SIMPLE_CLASS = "!-~¡-įı-ɏ"
SIMPLE = re.compile(f"[{SIMPLE_CLASS}]+")
SIMPLE_TEXT = re.compile(f"[ \t\n\r{SIMPLE_CLASS}]*")
WORD_ENTRIES, GROUP = 500_000, 64


def plain_split() -> re.Pattern:
    """The split pattern for lower-cased plain characters, with their letters and numbers spelled out.

    Its alternatives differ in their first character or stand in their order, so the most frequent one is tried first.
    """
    plain = sorted({c for k in range(33, 0x250) if SIMPLE.fullmatch(chr(k)) for c in chr(k).lower()})
    letters, numbers = ("".join(c for c in plain if unicodedata.category(c)[0] == kind) for kind in "LN")
    rest = SPLIT.replace(r"[\p{L}]+|", "").replace(r"[\p{N}]", f"[{numbers}]").replace(r"\p{L}\p{N}", letters + numbers)
    return re.compile(f"[{letters}]+|{rest}")


class TwoAges(dict):
    """A bounded cache: entries not used for a whole age go.

    A key without a value stands for itself until it is learned, and is remembered in ``unknown``.
    """

    def __init__(self, entries: int):
        super().__init__()
        self.entries, self.old, self.unknown = entries, {}, set()

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            self.unknown.add(key)
            return key
        self[key] = value
        return value

    def turn(self) -> None:
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()


class WholeTexts:
    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class CachedWords(WholeTexts):
    def __init__(self, tokenizer, ends: np.ndarray):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__(tokenizer)
        self.ends, self.split = ends, plain_split()
        # the same merges, without normalising what is normal already
        self.words_only = Tokenizer(tokenizer.model)
        self.words_only.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in visible]
        self.byte_chars = {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.words = TwoAges(WORD_ENTRIES)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), GROUP):
            self.words.turn()
            group = [list(map(self.words.__getitem__, self.parts(text))) for text in texts[at : at + GROUP]]
            learned = self.learn()
            for ids in group:
                yield b"".join([i if type(i) is bytes else learned[i] for i in ids] if learned else ids)

    def parts(self, text: str) -> list[str | tuple[str]]:
        """Plain words, numbers and runs of signs, and, one in a tuple each, stretches for the tokenizer."""
        if SIMPLE_TEXT.fullmatch(text) and "<|" not in text:
            return self.split.findall(text.lower())
        parts: list[str | tuple[str]] = []
        for chunk in CHUNK.findall(text):
            if SIMPLE.fullmatch(chunk) and "<|" not in chunk:
                parts += self.split.findall(chunk.lower())
            else:
                parts.append((chunk,))
        return parts

    def learn(self) -> dict[str | tuple[str], bytes]:
        """Ids of the parts met without a value, which the cache has from now on."""
        learned: dict[str | tuple[str], bytes] = {}
        new = [part for part in self.words.unknown if isinstance(part, str)]
        for part in self.words.unknown.difference(new):
            learned[part] = next(super().encode([part[0]]))
        self.words.unknown.clear()
        for at in range(0, len(new), 2000):
            some = new[at : at + 2000]
            plain = [p if p.isascii() else p.encode().decode("latin-1").translate(self.byte_chars) for p in some]
            ids = np.array(self.words_only.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * TOKEN_BYTES).tolist()
            raw = ids.tobytes()
            learned.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        self.words.update(learned)
        return learned


_ENCODERS: dict[str, WholeTexts] = {}


def token_encoder(path: str) -> WholeTexts:
    """The encoder of this process; tasks that run in it one after the other share its cache."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        normal = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        pattern = steps[0].get("pattern", {}).get("Regex") if steps else None
        if normal == ["NFC", "Replace", "Lowercase"] and pattern == SPLIT and spec["model"]["end_of_word_suffix"] == "</w>":
            ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
            ends[[k for token, k in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
            _ENCODERS[path] = CachedWords(tokenizer, ends)
        else:
            _ENCODERS[path] = WholeTexts(tokenizer)
    return _ENCODERS[path]
