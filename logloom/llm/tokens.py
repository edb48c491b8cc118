"""Token ids of whole texts by a public tokenizer file, with a word cache.

The file's pipeline is normalise (NFC, white space to one space, lower case), cut
into words, encode each word by itself; no word holds white space.  The ids of what
stands between white space hence don't depend on its neighbours, and a worker
keeps those it has met.  Texts with
characters outside the plain Latin set below, or with a special token's string,
go through the tokenizer whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

#: Bytes of chunks and ids that a worker keeps, with what Python adds to each; longer chunks aren't kept.
CACHE_BYTES, ENTRY_BYTES, LONGEST_KEPT = 32 << 20, 200, 64
#: Text for which lower-casing and word cutting below equal the tokenizer's own.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xc0-\xff]*")
_WORDS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+")
#: The tokenizer lower-cases, so an upper-case letter never reaches the cutter.
_SPECIAL = re.compile(r"<\|(?:startoftext|endoftext)\|>")

#: Byte-level BPE writes each byte that isn't a visible character as one from 256 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _VISIBLE)}


#: The file settings under which words are cut as above; any other file's texts go through its tokenizer whole.
PLAIN_SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "added_tokens": ["<|startoftext|>", "<|endoftext|>"],
    "post_processor": None,
    "truncation": None,
}


def cuts_plain_words(tokenizer: Tokenizer) -> bool:
    """Whether the tokenizer's file has ``PLAIN_SETTINGS`` and a plain BPE model."""
    file = json.loads(tokenizer.to_str())
    settings = {**file, "added_tokens": [x["content"] for x in file["added_tokens"]]}
    model = file["model"]
    return all(settings.get(k) == v for k, v in PLAIN_SETTINGS.items()) and model["type"] == "BPE" and not model.get("dropout")


class RecentCache:
    """What was met of late, in two generations of half the bytes each."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size = limit // 2, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        found = self.old.get(key)
        if found is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(key) <= LONGEST_KEPT:
            self.size += len(key) + len(value) + ENTRY_BYTES
            if self.size > self.limit:
                self.old, self.new, self.size = self.new, {}, 0
            self.new[key] = value


class WordTokenizer:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are kept as native unsigned ints, which must be little-endian 32-bit")
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.cuts_words = self.tokenizer.model, cuts_plain_words(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        """Let the cache go; a task does so at its end, as its worker may serve other operators."""
        self.cache = RecentCache()

    def _ids(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return array("I", found.ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        packed = self.cache.get(chunk)
        if packed is None:
            words = [chunk] if chunk.isalpha() else _WORDS.findall(chunk)
            visible = [w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_LETTERS) for w in words]
            packed = array("I", [x.id for w in visible for x in self.model.tokenize(w)]).tobytes()
            self.cache.put(chunk, packed)
        return packed

    def encode(self, text: str) -> bytes:
        if not self.cuts_words or not _PLAIN.fullmatch(text) or _SPECIAL.search(text):
            return self._ids(text)
        cache, chunk = self.cache, self._chunk
        return b"".join([cache.new.get(x) or chunk(x) for x in text.lower().split()])


@lru_cache(maxsize=1)
def worker_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each worker process."""
    return WordTokenizer(path)
