"""Token ids of whole texts by a vocabulary file of the tokenizers library, with a bounded cache per Python worker.

The vocabulary is a parameter. Words (runs without ASCII white space) are encoded once per worker and then looked up, as
its rules never join characters across white space. Plain Western words are split as the vocabulary's own rule says and
handed to its merge model; every other word goes through the library as it is.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

#: Entries of each cache before it is emptied; about 140 MB for both.
CACHE_WORDS = 700_000

# The pre-tokenization rule of the public vocabulary, for words that hold nothing but ASCII and the letters À to ÿ.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceIds(dict):
    """Maps a lower-case piece of a plain word to its ids, by the merge model of the library."""

    def __init__(self, model) -> None:
        from tokenizers import pre_tokenizers

        super().__init__()
        self.model = model
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        text = piece.decode()
        tokens = self.model.tokenize(text if piece.isascii() else self.as_bytes.pre_tokenize_str(text)[0][0])
        ids = self[piece] = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        return ids


class WordIds(dict):
    """Maps a word's UTF-8 bytes to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.pieces = PieceIds(self.whole.model)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) > 200:
            return self.library(word.decode("utf-8", "replace"))
        core = word.rstrip(b".,;:!?")
        if core.isalpha():  # ASCII letters, then perhaps a run of punctuation
            ids = self.pieces[core.lower()]
            if len(core) < len(word):
                ids += self.pieces[word[len(core):]]
        else:
            text = word.decode("utf-8", "replace")
            if _PLAIN.fullmatch(text) and not any(s in word for s in self.special):
                ids = b"".join([self.pieces[p.encode()] for p in _PIECES.findall(text.lower())])
            else:
                ids = self.library(text)
        self[word] = ids
        return ids

    def library(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def text(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        return b"".join(map(self.__getitem__, text.split()))


def _same_rule(path: str) -> bool:
    """Whether the file's rules are those that ``_PIECES`` states."""
    import json

    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (steps[0].get("pattern") == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
            and [n.get("type") for n in (rules.get("normalizer") or {}).get("normalizers", [])]
            == ["NFC", "Replace", "Lowercase"])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One cache per vocabulary and Python worker. Its rules must end every token at white space."""
    if not _same_rule(path):
        raise ValueError("only vocabularies that drop white space and split there are read word by word")
    return WordIds(path)
