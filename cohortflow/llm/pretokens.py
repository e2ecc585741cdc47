"""Encoding by pre-token, with caches, for texts whose pre-tokens a plain pattern finds exactly.

The pattern covers texts of Latin-1 characters, on whose letters, numbers and white space all Unicode
versions agree. Any other text, and a text that holds a special token's string, goes to the tokenizers
library as a whole, so every result is the library's own.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable
from itertools import islice

# The letters and numbers of Latin-1 in Unicode, and ASCII white space.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBER = "0-9²³¹¼-¾"
SPACE = " \\t-\\r"
# Other white space and control characters: texts with them are left to the library.
ODD = bytes(range(0x1C, 0x20)) + b"\x85\xa0\x00"

# The split patterns of the two public vocabularies, restated for Latin-1 with the common case first; only
# the suffixes and the last class but white space can begin alike.
SUFFIX = "'(?:s|t|re|ve|m|ll|d)"
BYTE_LEVEL = f" ?[{LETTER}]+| ?[{NUMBER}]+|{SUFFIX}| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
WORD_ENDS = f"[{LETTER}]+|[{NUMBER}]|{SUFFIX}|[^{SPACE}{LETTER}{NUMBER}]+"


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Cache(dict):
    """Values of chunks, computed when first asked for."""

    def __init__(self, compute: Callable, known: dict):
        super().__init__(known)
        self.compute, self.kept = compute, len(known)

    def __missing__(self, chunk: str):
        value = self[chunk] = self.compute(chunk)
        return value

    def trim(self, most: int) -> None:
        """At most `most` entries: those added first, which are the frequent ones, stay."""
        if len(self) > max(most, self.kept):
            for chunk in list(islice(reversed(self), len(self) - max(most // 2, self.kept))):
                del self[chunk]


class PretokenEncoder:
    """One value per text, joined from values of its chunks, or from the whole where the pattern does not apply.

    A chunk is a run between blanks, with the blank before it where the vocabulary keeps blanks: no pre-token
    crosses its ends. Given to tasks as one object per worker, the encoder has a cache of at most
    `cache_entries` chunks that outlives a task; `known` chunks are in it from the start and stay.
    """

    def __init__(self, tokenizer_json: str, cache_entries: int, value: Callable, join: Callable, known: dict | None = None):
        self.spec, self.cache_entries, self.known = tokenizer_json, cache_entries, known or {}
        self.value, self.join = value, join
        parsed = json.loads(tokenizer_json)
        self.special = [t["content"] for t in parsed["added_tokens"]]
        kinds = json.dumps(parsed["pre_tokenizer"])
        self.lower = "Lowercase" in json.dumps(parsed["normalizer"])
        if '"use_regex": true' in kinds and parsed["normalizer"] is None:
            self.pattern, self.blanks = BYTE_LEVEL, True
        elif "[\\\\p{N}]|" in kinds and self.lower:
            self.pattern, self.blanks = WORD_ENDS, False
        else:
            self.pattern = None
        self._live = None

    def __getstate__(self):
        return self.__dict__ | {"_live": None}

    def _ready(self):
        """(tokenizer, its model's tokenize, pre-token finder, chunk finder, cache), made once per process."""
        if self._live is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(self.spec)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            find = re.compile(self.pattern).findall if self.pattern else None
            model, table = tokenizer.model.tokenize, byte_characters()

            def compute(chunk: str):
                ids = []
                for piece in find(chunk):
                    ids += [t.id for t in model(piece.encode().decode("latin-1").translate(table))]
                return self.value(ids)

            self._live = tokenizer, find, re.compile(" ?[^ ]+").findall, _Cache(compute, self.known)
        return self._live

    def tokenizer(self):
        return self._ready()[0]

    def chunks(self, text: str) -> list[str] | None:
        """The chunks of a text, or None where only the library splits it right."""
        if self.pattern is None:
            return None
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if len(plain.translate(None, ODD)) != len(plain) or any(s in text for s in self.special):
            return None
        _, find, runs, _ = self._ready()
        if not self.blanks:
            return text.lower().split()
        if "  " in text or text.endswith(" "):
            return find(text)
        return runs(text)

    def values(self, texts: Iterable[str]) -> list:
        """join([value(ids) of every chunk]) of every text; of a text without chunks to tell, value(all ids)."""
        tokenizer, _, _, cache = self._ready()
        get, out = cache.__getitem__, []
        for text in texts:
            found = self.chunks(text)
            if found is None:
                out.append(self.value(tokenizer.encode(text, add_special_tokens=False).ids))
            else:
                out.append(self.join(map(get, found)))
                cache.trim(self.cache_entries)
        return out

    def value_of(self, chunk: str):
        """The value of one chunk."""
        return self._ready()[3][chunk]
