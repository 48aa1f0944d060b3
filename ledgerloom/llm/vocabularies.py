"""Public tokenizer vocabularies, loaded once per Python worker.

A vocabulary is named by its file: a path, or the name of a file of the ``public_tokenizers`` package,
which every executor has.
"""

from __future__ import annotations

import ctypes
import json
from collections.abc import Callable, Hashable, Iterator
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Words, and pieces of words, whose ids a worker keeps; later ones are worked out again each time.
MEMO_ENTRIES = 300_000
#: New words worked out at once.
NEW_WORDS = 1 << 15
#: Results a worker keeps per ``Memo``.
MEMO_RESULTS = 300_000

#: A word of letters that stand alone and lower-case alone; no "<": it opens special tokens.
PLAIN = r"^[!-;=-~\x{A1}-įı-˿]+$"


def resolve(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_held: dict[Hashable, Any] = {}


def hold(key: Hashable, make: Callable[[], Any] = lambda: None) -> Any:
    """What ``make`` gives, kept for later tasks of this worker; only what was asked for last is kept."""
    if key not in _held:
        if _held:
            _held.clear()
            _give_back()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Lets go of what the worker holds: for the start of a task that needs nothing of it."""
    hold("nothing of the stages before")


def _give_back() -> None:
    """Returns freed memory to the system, which also runs the JVM of the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Memo(dict):
    """A function remembered for the first ``MEMO_RESULTS`` arguments it meets."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        value = self.function(key)
        if len(self) < MEMO_RESULTS:
            self[key] = value
        return value


def _taken(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` of these starts and sizes, one after another."""
    ends = np.cumsum(sizes)
    return ids[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class KnownIds:
    """Ids of strings, remembered for the first ``MEMO_ENTRIES`` strings; ``work`` gives ids and sizes for others.

    Strings and ids lie in arrays: a dictionary of Python strings takes ten times the memory.
    """

    def __init__(self, work: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]):
        self.work = work
        self.keys = pa.array([], pa.string())
        self.ids, self.borders = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __call__(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of the distinct strings where its own start there and how many they are."""
        found = pc.index_in(distinct, value_set=self.keys)
        new = distinct.filter(found.is_null())
        places = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        places[places < 0] = len(self.keys) + np.arange(len(new))
        ids, borders = self.ids, self.borders
        if len(new):
            found = [self.work(new.slice(low, NEW_WORDS)) for low in range(0, len(new), NEW_WORDS)]
            ids = np.concatenate([ids, *(more for more, _ in found)])
            borders = np.concatenate([borders, borders[-1] + np.cumsum(np.concatenate([sizes for _, sizes in found]))])
            room = MEMO_ENTRIES - len(self.keys)
            if room > 0:
                self.keys = pa.concat_arrays([self.keys, new.slice(0, room)])
                self.borders = borders[:len(self.keys) + 1].copy()
                self.ids = ids[:self.borders[-1]].copy()
        return ids, borders[places], borders[places + 1] - borders[places]


class TextIds:
    """Token ids of texts as the library gives them, as unsigned 32-bit numbers.

    A vocabulary that lower-cases, drops white space and splits at it gives a text the ids of its
    words one after another, so distinct words are looked up.  A word of plain letters is split by the
    vocabulary's own pattern and each distinct piece goes to the library's model; any other word goes
    through the whole library.  A vocabulary with other rules encodes whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        rules = json.loads(self.tokenizer.to_str())
        steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        splits = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = steps == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in splits] == ["Split", "ByteLevel"] and splits[0]["invert"]
        if self.by_word:
            pattern = splits[0]["pattern"]["Regex"]
            self.by_word = "(" not in pattern  # words are split together, so a match must not look around
            self.split = regex.compile(f"{pattern}|\n").findall
            self.letters = dict(enumerate(byte_letters()))
            self.words, self.pieces = KnownIds(self._of_words), KnownIds(self._of_pieces)

    def _encoded(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        spelled = "\n".join(pieces.to_pylist()).encode().decode("latin-1").translate(self.letters)
        found = [[token.id for token in tokens] for tokens in map(self.model.tokenize, spelled.split(self.letters[10]))]
        return _joined(found)

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.match_substring_regex(words, PLAIN)
        others, other_sizes = _joined([self._encoded(word) for word in words.filter(pc.invert(plain)).to_pylist()])
        parts = pa.array(self.split("\n".join(words.filter(plain).to_pylist()).lower()), pa.string())
        is_border = pc.equal(parts, "\n").to_numpy(zero_copy_only=False)
        pieces = parts.filter(pa.array(~is_border)).dictionary_encode()
        ids, starts, sizes = self.pieces(pieces.dictionary)
        codes = pieces.indices.to_numpy(zero_copy_only=False)
        plain = plain.to_numpy(zero_copy_only=False)
        word = np.cumsum(is_border)[~is_border]
        plain_sizes = np.bincount(word, sizes[codes], np.count_nonzero(plain)).astype(np.int64)
        found = np.concatenate([_taken(ids, starts[codes], sizes[codes]), others])
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        sizes = np.concatenate([plain_sizes, other_sizes])
        in_order = np.argsort(order)
        return _taken(found, (np.cumsum(sizes) - sizes)[in_order], sizes[in_order]), sizes[in_order]

    def __call__(self, text: str) -> bytes:
        return self.of_all(pa.array([text], pa.string()))[0].tobytes()

    def of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has; a null text has none."""
        return next(self.of_parts([texts]))

    def of_parts(self, parts: list[pa.Array]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What ``of_all`` gives for each part of the texts.

        Each distinct word of all parts is looked up once; ids are laid out part by part, as they are asked for.
        """
        if not self.by_word:
            yield from (_joined([self._encoded(text or "") for text in part.to_pylist()]) for part in parts)
            return
        texts = []
        for part in parts:
            lists = pc.ascii_split_whitespace(part.fill_null(""))
            words = lists.flatten().dictionary_encode()
            texts.append((words.dictionary, words.indices.to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)))
        distinct = pa.concat_arrays([words for words, _, _ in texts]).dictionary_encode()
        ids, starts, sizes = self.words(distinct.dictionary)
        places, low = distinct.indices.to_numpy(zero_copy_only=False), 0
        for words, codes, lengths in texts:
            own = places[low:low + len(words)][codes]
            low += len(words)
            counts = sizes[own]
            ends = np.concatenate([[0], np.cumsum(counts)])
            borders = ends[np.concatenate([[0], np.cumsum(lengths)])]
            yield _taken(ids, starts[own], counts), np.diff(borders)


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All lists one after another, and their lengths."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, sizes.sum()), sizes


def text_ids(name: str) -> TextIds:
    return hold(("ids", name), lambda: TextIds(resolve(name)))
