"""Tokenizing whole texts with a public tokenizer, one pre-token at a time.

The tokenizer of ``word_bpe_49k.json`` lower-cases a text and cuts it into words, digits
and runs of marks, whose ids it joins. In texts of ASCII and Latin letters one pattern
finds these pieces; other texts go by their white-space separated chunks, across which
the tokenizer never joins either. Each Python worker keeps the ids of what it has met;
only new pieces and chunks reach the ``tokenizers`` library.
"""

from __future__ import annotations

import re
import struct

#: White space, printable ASCII and Latin letters: normalising such a text only lower-cases it.
_LATIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: The tokenizer's own pre-tokens in such a text.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
#: How the names of special tokens begin, which are cut out before anything else.
_SPECIAL = "<|"
_WORKER: dict[tuple[str, int], "WordTokenizer"] = {}
#: Pieces and chunks whose ids a worker keeps, some 20 MB: a worker outlives its task, and later stages share its memory.
MAX_WORDS = 100_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(own))
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_PACK = [struct.Struct(f"<{n}I") for n in range(33)]


def _pieces(text: str) -> list[str] | None:
    """The pre-tokens of a Latin text; None for others."""
    return _PIECES.findall(text.lower()) if _LATIN.fullmatch(text) and _SPECIAL not in text else None


class WordTokenizer(dict):
    """Maps a piece (text), or a chunk (bytes without ASCII white space), to its ids as little-endian uint32 bytes.

    ``max_words`` bounds the memory: at half of it the collection starts afresh beside the
    one before, from which it takes what is met again.
    """

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = _byte_chars()
        self.max_words = max_words
        self.before: dict[str | bytes, bytes] = {}

    @classmethod
    def of_worker(cls, path: str, max_words: int = MAX_WORDS) -> "WordTokenizer":
        key = (path, max_words)
        if key not in _WORKER:
            _WORKER[key] = cls(path, max_words)
        return _WORKER[key]

    def __missing__(self, part: str | bytes) -> bytes:
        ids = self.before.get(part)
        if ids is None:
            ids = self._new(part)
        if len(part) <= 64:
            if 2 * len(self) >= self.max_words:
                self.before = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def _new(self, part: str | bytes) -> bytes:
        if type(part) is str:  # one pre-token: the model can take it as it is
            chars = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
            found = [t.id for t in self.model.tokenize(chars)]
        else:
            text = part.decode()
            pieces = _pieces(text)
            if pieces is not None:
                return b"".join(map(self.__getitem__, pieces))
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return _PACK[len(found)].pack(*found) if len(found) < len(_PACK) else struct.pack(f"<{len(found)}I", *found)

    def encode(self, text: bytes) -> bytes:
        """The ids of a whole text, as little-endian uint32 bytes."""
        pieces = _pieces(text.decode())
        return b"".join(map(self.__getitem__, text.split() if pieces is None else pieces))
