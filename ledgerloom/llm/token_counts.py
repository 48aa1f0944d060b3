"""Token counts from a compiled finite-state tokenizer.

Two deterministic transducers replace the tokenizer:

* ``SPLITTER`` reads classes of characters and says where the byte-level pattern starts a new piece.
  A piece can depend on up to two characters that follow, so a transition may also put a start
  before the character just passed.
* ``PieceCounter`` reads the bytes of a piece.  Each transition carries the change in the number of
  tokens that the bytes read so far are encoded as.  Its states are compiled when first reached.

All texts of a batch form one line of characters, which is cut into chunks without regard to texts or
pieces.  Each chunk's map from entry state to exit state is worked out for all states at once;
a parallel prefix scan composes the maps, which gives every chunk its true entry state, and a second
sweep over all chunks emits the starts.  Equal pieces are counted once per worker (``Memo``).

Edge cases: null is the empty text with no tokens; texts are whole, whatever their length; strings of
special tokens are single tokens, as the library reads them; rows, ties and columns pass unchanged.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerloom.llm.shared import without
from ledgerloom.llm.text_maps import ROWS

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Characters in a chunk, and in a line of texts worked on at once (a longer text is one line).
CHUNK = 128
LINE = 2_000_000
#: Compiled transitions a worker keeps before it starts anew.
MOST_EDGES = 3_000_000

# Classes of characters.  The letters stand for themselves because of the endings 's 't 'm 'd 're 've 'll.
LETTER, NUMBER, OTHER, BLANK, SPACE, QUOTE, SHORT, R, V, L, E, BORDER = range(12)
# States: what the last character belongs to.  FRESH: a piece begins next.  RUN_BLANK / RUN_SPACE: a run
# of white space that ends in a blank / in another space.  AFTER_*: a quote that opens a piece, and what followed.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, RUN_BLANK, RUN_SPACE, AFTER_QUOTE, AFTER_R, AFTER_V, AFTER_L = range(10)
HERE, BACK = 1, 2


def _compiled_splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next states and starts (HERE: before this character, BACK: before the one before) by state * 12 + class."""
    follow, starts = np.zeros((10, 12), np.uint8), np.zeros((10, 12), np.uint8)
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, BLANK: RUN_BLANK, SPACE: RUN_SPACE, QUOTE: AFTER_QUOTE, BORDER: FRESH}
    kind = {c: LETTER if c in (SHORT, R, V, L, E) else c for c in range(12)}
    awaited = {AFTER_R: E, AFTER_V: E, AFTER_L: L}
    for state in range(10):
        for c in range(12):
            to, out, k = run[kind[c]], HERE, kind[c]
            if (state, k) in ((IN_LETTERS, LETTER), (IN_NUMBERS, NUMBER)):
                out = 0
            elif state == IN_OTHERS and k in (OTHER, QUOTE):
                to, out = IN_OTHERS, 0
            elif state in (RUN_BLANK, RUN_SPACE) and k in (BLANK, SPACE):
                out = 0
            elif state == RUN_BLANK and k != BORDER:  # the last blank of a run goes with what follows
                to, out = (IN_OTHERS if k == QUOTE else to), BACK
            elif state == RUN_SPACE and k != BORDER:  # the last space of a run is a piece of its own
                out = BACK | HERE
            elif state == AFTER_QUOTE:
                if k in (OTHER, QUOTE):
                    to, out = IN_OTHERS, 0
                elif c == SHORT:
                    to, out = FRESH, 0
                elif c in (R, V, L):
                    to, out = {R: AFTER_R, V: AFTER_V, L: AFTER_L}[c], 0
            elif state in awaited:
                if c == awaited[state]:
                    to, out = FRESH, 0
                else:  # no ending after all: the letter after the quote begins a run of letters
                    out = BACK if k == LETTER else BACK | HERE
            follow[state, c], starts[state, c] = to, out
    return follow.ravel(), starts.ravel()


def scanned(maps: np.ndarray) -> np.ndarray:
    """All prefixes of composed state maps: row ``i`` of the result applies rows 0 to ``i`` in turn."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
        step *= 2
    return maps


class PieceCounter:
    """The compiled transducer from the bytes of a piece to its number of tokens.

    Adjacent tokens are independent of all others: a row of tokens is the encoding of its bytes just
    if each two neighbours are the encoding of theirs.  So the encoding of a prefix ends in the one
    token that fits the encoding of the rest.  A state holds the longest suffix read that begins a
    token, and for every place in that suffix the last token up to there and the count relative to
    the end; that is all the future depends on.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ids = vocabulary
        self.rank, self.parts = {}, {}
        for rank, (left, right) in enumerate(merges):
            self.rank[left, right] = rank
            self.parts.setdefault(left + right, (rank, left, right))
        self.openings = {token[:n] for token in vocabulary for n in range(1, len(token) + 1)}
        self.openings.add(b"")
        self._spines: dict[tuple[bytes, bool], list[tuple[bytes, int]]] = {}
        self._fits: dict[tuple[bytes, bytes], bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = (b"", (None,), (0,))
        self.states, self.numbers, self.edges = [start], {start: 0}, {}

    def spine(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """The parts of a token at its right or left edge, each with the rank of the merge that takes it."""
        found = self._spines.get((token, right))
        if found is None:
            found, taken = [], len(self.rank)
            part = token
            while True:
                found.append((part, taken))
                if part not in self.parts:
                    break
                taken, *both = self.parts[part]
                part = both[right]
            self._spines[token, right] = found
        return found

    def fits(self, left: bytes | None, right: bytes) -> bool:
        """Whether two tokens stay apart: no merge over their border comes before both are whole.

        Of equal merges the left one is made first, so a merge inside ``right`` of the same rank is
        too late to prevent the one over the border.
        """
        if left is None:
            return True
        known = self._fits.get((left, right))
        if known is None:
            never = len(self.rank)
            known = all(
                (rank := self.rank.get((a, b), never)) == never or rank >= gone_a or rank > gone_b
                for a, gone_a in self.spine(left, True) for b, gone_b in self.spine(right, False)
            )
            self._fits[left, right] = known
        return known

    def _compile(self, number: int, byte: int) -> int:
        suffix, lasts, counts = self.states[number]
        read = suffix + bytes((byte,))
        kept = read
        while kept not in self.openings:
            kept = kept[1:]
        for size in range(len(kept), 0, -1):
            token, at = kept[len(kept) - size:], len(read) - size
            if token in self.ids and self.fits(lasts[at], token):
                break
        else:
            raise ValueError("the vocabulary has no token for a byte")
        change, dropped = counts[at] + 1, len(read) - len(kept)
        state = (kept, (*lasts[dropped:], token), (*(c - change for c in counts[dropped:]), 0))
        to = self.numbers.setdefault(state, len(self.states))
        if to == len(self.states):
            self.states.append(state)
        edge = self.edges[number << 8 | byte] = to << 9 | change + 256
        return edge

    def __call__(self, piece: str) -> int:
        if len(self.edges) > MOST_EDGES:
            self._reset()
        if len(self._fits) > MOST_EDGES:
            self._fits.clear()
        state, tokens, edges = 0, 0, self.edges
        for byte in piece.encode():
            edge = edges.get(state << 8 | byte)
            if edge is None:
                edge = self._compile(state, byte)
            state, tokens = edge >> 9, tokens + (edge & 511) - 256
        return tokens


class TextCounter:
    """Token counts of texts for a byte-level BPE vocabulary with the standard pattern."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        from ledgerloom.llm.vocabularies import Memo, byte_letters

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        splitting, model = rules["pre_tokenizer"] or {}, rules["model"]
        if model["type"] != "BPE" or rules["normalizer"] or splitting.get("type") != "ByteLevel" or not splitting["use_regex"] or splitting["add_prefix_space"]:
            raise ValueError("only plain byte-level BPE vocabularies are compiled")
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        spelled = lambda token: bytes(byte_of[c] for c in token)
        self.special = [token["content"] for token in rules["added_tokens"]]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = {spelled(token): number for token, number in model["vocab"].items() if token not in self.special}
        self.counts = Memo(PieceCounter(ids, [(spelled(a), spelled(b)) for a, b in pairs]))
        self.classes = character_classes(Tokenizer.from_file(path).pre_tokenizer)
        self.follow, self.starts = _compiled_splitter()

    def piece_starts(self, classes: np.ndarray) -> np.ndarray:
        """Places at which pieces, and borders, begin in a line of classes."""
        n = len(classes)
        width = -(-n // CHUNK)
        line = np.full(width * CHUNK, BORDER, np.uint8)
        line[:n] = classes
        columns = np.ascontiguousarray(line.reshape(width, CHUNK).T)
        maps = np.repeat(np.arange(10, dtype=np.uint8)[:, None], width, axis=1)
        for column in columns:
            maps = self.follow[maps * np.uint8(12) + column]
        entry = np.concatenate([np.array([FRESH], np.uint8), scanned(np.ascontiguousarray(maps.T))[:-1, FRESH]])
        out = np.empty_like(columns)
        for k, column in enumerate(columns):
            key = entry * np.uint8(12) + column
            out[k] = self.starts[key]
            entry = self.follow[key]
        marks = np.ascontiguousarray(out.T).ravel()
        begins = (marks & HERE).astype(bool)
        begins[:-1] |= (marks[1:] & BACK).astype(bool)
        return np.flatnonzero(begins[:n])

    def line(self, texts: list[str]) -> np.ndarray:
        """Token counts of a few texts that are free of special strings."""
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        joined = "\n".join(texts) + "\n"
        classes = self.classes[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        classes[ends] = BORDER
        starts = self.piece_starts(classes)
        borders = np.append(starts, len(joined)).tolist()
        counts = np.fromiter((self.counts[joined[a:b]] for a, b in zip(borders, borders[1:])), np.int64, len(starts))
        counts[np.searchsorted(starts, ends)] = 0  # the border characters
        sums = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(sums[np.searchsorted(starts, ends)], prepend=0)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        result = np.zeros(len(texts), np.int64)
        owners, parts, size = [], [], 0

        def flush() -> None:
            if parts:
                np.add.at(result, owners, self.line(parts))
            owners.clear()
            parts.clear()

        for row, text in enumerate(texts):
            pieces = [text or ""]
            for string in self.special:
                if string in pieces[0] or len(pieces) > 1:
                    pieces = [x for p in pieces for x in p.split(string)]
            result[row] += len(pieces) - 1
            for piece in filter(None, pieces):
                owners.append(row)
                parts.append(piece)
                size += len(piece)
            if size > LINE:
                flush()
                size = 0
        flush()
        return result


def character_classes(splitter) -> np.ndarray:
    """The class of every code point, asked of the library's own splitter.

    In a line of all code points a piece holds characters of one class (past the blank and the quote),
    so only the first character of each piece is asked for: which of ``a``, ``1`` and ``!`` it can
    follow in one piece.
    """
    table = np.full(0x110000, OTHER, np.uint8)
    edges = [range(0xD800), range(0xE000, 0x110000)]
    for low, high in [(n, min(n + 50_000, edge.stop)) for edge in edges for n in range(edge.start, edge.stop, 50_000)]:
        line = "".join(map(chr, range(max(low, 0x80), high)))
        runs = [(high - len(line) + a, high - len(line) + b) for _, (a, b) in splitter.pre_tokenize_str(line)]
        runs += [(p, p + 1) for p in range(low, 0x80)]
        for first, after in runs:
            table[first:after] = next((kind for kind, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(splitter.pre_tokenize_str(before + chr(first))) == 1), SPACE)
    for characters, kind in ((" ", BLANK), ("'", QUOTE), ("stmd", SHORT), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(c) for c in characters]] = kind
    return table


def text_counter(name: str) -> TextCounter:
    from ledgerloom.llm.vocabularies import hold, resolve

    return hold(("counter", name), lambda: TextCounter(resolve(name)))


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """The rows with ``n_bytes``, ``n_tokens`` and ``over_limit`` instead of the text.

    A map over the partitions: no shuffle, and a long text is one row of its batch.
    """
    others = [c for c in without(docs, text, "n_bytes", "n_tokens", "over_limit").columns]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = text_counter(vocabulary)
        for batch in (whole.slice(low, ROWS) for whole in batches for low in range(0, whole.num_rows, ROWS)):
            texts = batch.column(0).to_pylist()
            yield pa.record_batch([*batch.columns[1:], pa.array(counter(texts), pa.int64())], names=[*batch.schema.names[1:], "n_tokens"])

    kept = [F.col(c).alias(f"__{k}") for k, c in enumerate(others)]
    rows = docs.select(F.col(text).alias("__text"), *kept, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("__bytes"))
    fields = [StructField(f"__{k}", docs.schema[c].dataType) for k, c in enumerate(others)]
    schema = StructType([*fields, StructField("__bytes", LongType()), StructField("n_tokens", LongType())])
    return rows.mapInArrow(counted, schema).select(
        *[F.col(f"__{k}").alias(c) for k, c in enumerate(others)],
        F.col("__bytes").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
    )
