"""Token ids of whole texts from a public vocabulary file, one word at a time.

The ``word_bpe_49k`` tokenizer drops white space and never joins pieces across it, so a text's ids are the ids of its
white-space-separated chunks in order, and a chunk of letters and trailing marks has the letters' ids and then the
marks' ids. Each distinct chunk is encoded once by the ``tokenizers`` library and remembered; the memory is bounded,
and dropping from it changes nothing but time. So that there are fewer distinct chunks, a text of Latin-1 characters is
first put in lower case, with its commas and full stops set apart. ``tests/llm/test_tokens.py`` holds the result against whole-text
encoding.
"""

from __future__ import annotations

import os
from array import array

END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Chunks remembered by a worker in each of two generations, and the longest of them in bytes.
REMEMBERED, LONGEST = 200_000, 40
#: ASCII marks without the apostrophe, which the tokenizer may join to letters.
MARKS = b".,;:!?%&*$#|()[]{}-+=/<>\"@_~^`"


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if printable, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


_LETTERS = str.maketrans(_byte_letters())
#: Below it all letters are composed, with plain lower-case forms.
_SIMPLE = "\u0130"


def _simple_word(text: str) -> bool:
    return text.isalpha() and max(text) < _SIMPLE


def _latin(text: str) -> bool:
    """Whether no character lies beyond Latin-1: all are composed, and lower case comes one for one."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _set_apart(text: str, mark: str) -> str:
    """``text`` with a space before each ``mark`` that stands between a letter or digit and a space."""
    *parts, last = text.split(f"{mark} ")
    return "".join([f"{p} {mark} " if p[-1:].isalnum() else f"{p}{mark} " for p in parts]) + last


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Learner:
    """Encodes single chunks. It is told of the memory and keeps no reference to it: a memory in a cycle of references
    would stay in the worker after its task, until Python happens to look for cycles."""

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path or vocabulary_path())
        self._pieces = self._tokenizer.model.tokenize
        # Looked for in texts as they stand, before lower case.
        self._special = [t.content.lower() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._code = "H" if self.width == 2 else "I"

    def bytes_of(self, ids: list[int]) -> bytes:
        return array(self._code, ids).tobytes()

    def plain(self, text: str) -> str:
        """A text with the same ids and fewer distinct chunks."""
        if not _latin(text):
            return text
        low = text.lower()
        if any(t in low for t in self._special):
            return text
        return _set_apart(_set_apart(low, ","), ".")

    def learn(self, chunk: bytes, memory: _Memory) -> bytes:
        core = chunk.rstrip(MARKS)
        if core and len(core) < len(chunk) and (core.isalpha() or _simple_word(core.decode())):
            return memory[core] + memory[chunk[len(core) :]]
        if chunk.isalpha():  # ASCII letters only: normalisation is lower case, and the model sees them as they are
            return self.bytes_of([p.id for p in self._pieces(chunk.lower().decode())])
        text = chunk.decode()
        if _simple_word(text):  # its letters stay letters
            seen = text.lower().encode().decode("latin-1").translate(_LETTERS)
            return self.bytes_of([p.id for p in self._pieces(seen)])
        return self.bytes_of(self._tokenizer.encode(text, add_special_tokens=False).ids)


class _Memory(dict):
    """Ids of chunks; asks the learner for those that are missing. Holds two generations of ``most`` chunks."""

    def __init__(self, learner: _Learner, most: int):
        self._learner, self._most, self._old = learner, most, {}

    def __missing__(self, chunk: bytes) -> bytes:
        if (ids := self._old.get(chunk)) is None:
            ids = self._learner.learn(chunk, self)
        if len(chunk) <= LONGEST:
            if len(self) >= self._most:
                self._old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


class WordEncoder:
    """Encodes texts to little-endian unsigned ids of ``width`` bytes each."""

    def __init__(self, path: str | None = None, remembered: int = REMEMBERED):
        learner = _Learner(path)
        self.width = learner.width
        self.dtype = f"<u{self.width}"
        self._bytes, self._plain = learner.bytes_of, learner.plain
        self._ids = _Memory(learner, remembered).__getitem__

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text without special tokens; of a null or empty text none."""
        return b"".join(map(self._ids, self._plain(text or "").encode().split()))

    def encode_document(self, text: str | None, end_id: int = END_ID) -> bytes:
        """The text's ids, then the end id."""
        return self.encode(text) + self._bytes([end_id])
