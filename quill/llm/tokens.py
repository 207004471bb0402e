"""Token ids of whole texts by a public tokenizer file, with a bounded cache.

Two kinds of vocabulary split a text at white space before any merge (``KEPT`` and
``DROPPED``, told by what their files say), so the ids of a text are the ids of its
parts one after another. Parts repeat; their ids are kept per Python worker, up to
``CACHE_UNITS`` of at most ``CACHE_UNIT_CHARS`` characters (others are encoded each
time). A text of any other kind of vocabulary goes through the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

from quill.llm.common import Memo

# What the files of the two kinds say before their merges.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
KEPT = (None, _BYTES | {"use_regex": True})
DROPPED = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        _BYTES | {"use_regex": False}]})

CACHE_UNITS = 500_000
CACHE_UNIT_CHARS = 40
# Python counts these as white space, the tokenizers' patterns don't.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_UNIT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# Units of these characters are split here and merged by the library's model;
# any other unit goes through the library as a whole.
_SIMPLE = re.compile("[!-~À-ÿ]+\\Z")
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_PARTS_KEPT = re.compile(f"{_ENDINGS}| ?[{_LETTER}]+| ?[0-9]+| ?[^\\s0-9{_LETTER}]+")
_PARTS_DROPPED = re.compile(f"{_ENDINGS}|[{_LETTER}]+|[0-9]|[^\\s0-9{_LETTER}]+")
# The byte-level vocabulary's own cut of a text of simple characters.
_CUT = re.compile(f"{_ENDINGS}| ?[{_LETTER}]+| ?[0-9]+| ?[^\\s0-9{_LETTER}]+|\\s+(?!\\S)|\\s+")
# A text of simple units only, and what stands between its runs of letters.
_SIMPLE_TEXT = re.compile("[\t-\r !-~À-ÿ]*\\Z")
_MARKS = re.compile(f"[0-9]|[^\\s0-9{_LETTER}]+")


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write each byte as one visible character."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: b for b in shown}
    table.update((b, 256 + i) for i, b in enumerate(b for b in range(256) if b not in table))
    return table


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned
    32-bit bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = (spec.get("normalizer"), spec.get("pre_tokenizer"))
        model = spec["model"]
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
        # Added tokens are looked for as they stand, and only whole texts are post-processed without special tokens.
        plain = plain and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"])
        self.known = plain and kind in (KEPT, DROPPED)
        self.spaces_kept = kind == KEPT
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.size = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        # Units as they stand, units that follow one space, and parts of units.
        self.plain: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.parts = Memo(self._merge, CACHE_UNITS, CACHE_UNIT_CHARS)

    def _merge(self, part: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _unit(self, unit: str) -> bytes:
        if not _SIMPLE.match(unit, unit[:1] == " ") or any(a in unit for a in self.added):
            return np.array(self.tokenizer.encode(unit, add_special_tokens=False).ids, "<u4").tobytes()
        if self.spaces_kept:
            return b"".join(map(self.parts.__getitem__, _PARTS_KEPT.findall(unit)))
        return b"".join(map(self.parts.__getitem__, self._parts_dropped(unit)))

    def _parts_dropped(self, text: str) -> list[str]:
        text = text.lower()
        if "'" in text:
            return _PARTS_DROPPED.findall(text)
        return _MARKS.sub(r" \g<0> ", text).split()

    def _look_up(self, units: list[str], cache: dict[str, bytes], before: str = "") -> list[bytes]:
        """Ids of each unit, read with ``before`` in front of it unless it opens a line."""
        got = list(map(cache.get, units))
        if None in got:
            if len(cache) > CACHE_UNITS:
                cache.clear()
            for i, g in enumerate(got):
                if g is None:
                    u = units[i]
                    if (g := cache.get(u)) is None:
                        g = self._unit(u if u[:1] == "\n" else before + u)
                        if len(u) <= CACHE_UNIT_CHARS:
                            cache[u] = g
                    got[i] = g
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.known:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return [self._text(t) if t else b"" for t in texts]

    def _text(self, text: str) -> bytes:
        if _SIMPLE_TEXT.match(text) and not any(a in text for a in self.added):
            return b"".join(map(self.parts.__getitem__, _CUT.findall(text) if self.spaces_kept else self._parts_dropped(text)))
        words = text.split()
        if not self.spaces_kept:
            if _SEPARATORS.search(text):
                words = [text]
            return b"".join(self._look_up(words, self.plain))
        if len(words) == text.count(" ") + text.count("\n") + 1:
            # Single spaces and line breaks between words only; a line break
            # after a word opens a unit of its own.
            head, *rest = text.replace("\n", " \n").split(" ") if "\n" in text else text.split(" ")
            return b"".join([*self._look_up([head], self.plain), *self._look_up(rest, self.spaced, " ")])
        units = [text] if _SEPARATORS.search(text) else _UNIT.findall(text)
        return b"".join(self._look_up(units, self.plain))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file (loaded once per Python worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
