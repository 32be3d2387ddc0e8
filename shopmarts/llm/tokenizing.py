"""Token ids of whole texts, with each distinct word encoded once per worker.

Both public vocabularies cut a text into words before they merge anything. A single space between
two non-space characters always begins a new word, and so does the change between a Latin letter and
an ASCII mark other than the apostrophe. A text may be cut at all these places, and the ids of the
pieces, one after the other, are the ids of the text. Words repeat, so the library sees each piece
once and a dictionary serves the rest. The places are found in the bytes of a block of texts; Arrow
numbers its distinct pieces, looks these up among the known ones, and gathers the ids of all. Known
pieces are a column too: as Python's strings and numbers they would take five times the memory.
"""

from __future__ import annotations

import gc
import itertools
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs a task per core

from tokenizers import Tokenizer  # noqa: E402

KEPT_PIECES = 800_000  # of a worker's dictionary, about 30 MB
KEPT_LENGTH = 48  # longer pieces are encoded each time
TEXT_BYTES = 4_000_000  # of a list of texts to encode, unless one text is longer
# A word of Latin letters. U+0130 is left out, as its lower case is two characters.
PLAIN = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")
PROBES = [" a", "B", " The", " naïve", "Straße", " ÇA", "ɏ", " unbelievably", "word", " wordwordword"]
# Byte-level vocabularies write a byte as a visible character: itself, or the next from U+0100 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
LETTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
SHOWN = np.array([LETTERS.get(b, b) for b in range(256)], "<u2")
BREAK = chr(LETTERS[0x0A])
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\n", b"abcdefghijklmnopqrstuvwxyz ")
MARK = "\x01"
NONE = pa.array([], pa.large_string())
# Kinds of ASCII bytes. White space is what Python's \s holds, which is all that either vocabulary
# takes for it; its longer characters are listed by their first byte. Apostrophes are no marks here, as
# both vocabularies treat some of them with the letters after them.
WHITE, LETTER, PUNCTUATION = 1, 2, 4
_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_KINDS = bytearray(256)
for _c in map(chr, range(128)):
    if _c.isspace():
        _KINDS[ord(_c)] = WHITE
    elif _c.isalpha():
        _KINDS[ord(_c)] = LETTER
    elif _c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~":
        _KINDS[ord(_c)] = PUNCTUATION
KINDS = bytes(_KINDS)
LONG_SPACES: dict[int, list[bytes]] = {}
for _c in _SPACES:
    if not _c.isascii():
        LONG_SPACES.setdefault(_c.encode()[0], []).append(_c.encode())


def _bytes_as_letters(words: list[str]) -> list[str]:
    joint = np.frombuffer("\n".join(words).encode(), np.uint8)
    return SHOWN[joint].tobytes().decode("utf-16-le").split(BREAK)


def _bare_bytes_as_letters(words: list[str]) -> list[str]:
    return _bytes_as_letters("\n".join(words).replace(" ", "").lower().split("\n"))


def _kinds(text: bytes) -> np.ndarray:
    """The kind of each byte: WHITE, LETTER (of ASCII or U+00C0 to U+00FF), PUNCTUATION or none."""
    raw = np.frombuffer(text, np.uint8)
    kinds = np.frombuffer(bytearray(text.translate(KINDS)), np.uint8)
    at = np.flatnonzero(raw[:-1] == 0xC3)
    then = raw[at + 1]
    at = at[np.flatnonzero((then != 0x97) & (then != 0xB7))]
    kinds[at] = kinds[at + 1] = LETTER
    for lead, spaces in LONG_SPACES.items():
        at = np.flatnonzero(raw == lead)
        for space in spaces if len(at) else ():
            own = at[at + len(space) <= len(raw)]
            for i, byte in enumerate(space[1:], 1):
                own = own[raw[own + i] == byte]
            for i in range(len(space)):
                kinds[own + i] = WHITE
    return kinds


def _cuts(text: bytes, bounds: np.ndarray, words: bool) -> np.ndarray:
    """Where the pieces of texts begin: each text, its lone spaces, and, with ``words``, each change
    between letters and punctuation."""
    kinds = _kinds(text)
    cut = np.zeros(len(text), bool)
    dark = kinds != WHITE
    cut[1:-1] = (np.frombuffer(text, np.uint8)[1:-1] == 0x20) & dark[:-2] & dark[2:]
    cut[bounds[1:][bounds[1:] > 0] - 1] = False  # the last of a text, with none after it
    if words:
        cut[1:] |= kinds[:-1] + kinds[1:] == LETTER + PUNCTUATION
    cut[bounds[:-1][bounds[:-1] < len(text)]] = True
    return np.flatnonzero(cut)


def _binary(bounds: np.ndarray, data: bytes | np.ndarray, kind: pa.DataType) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data)]
    return pa.Array.from_buffers(kind, len(bounds) - 1, buffers)


def _taken(bounds: np.ndarray, stored: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of values that lie one after the other, those with the given numbers in the same form."""
    found = _binary(bounds, stored, pa.large_binary()).take(pa.array(number))
    _, ends, data = found.buffers()
    ends = np.frombuffer(ends, np.int64)[: len(number) + 1]
    return ends, np.frombuffer(data or b"", np.uint8)[: ends[-1]]


class Encoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, kept: int = KEPT_PIECES) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kept = kept
        # Every known piece at its number; its ids are the bytes of ``stored`` between two bounds.
        self.pieces = NONE
        self.bounds = np.zeros(1, np.int64)
        self.stored = np.zeros(0, np.uint8)
        # A vocabulary of lower case that drops white space reads these texts alike; then fewer
        # different pieces are left.
        self.folds = self._ids("A b\nC") == self._ids("a b c")
        self.model_input = self._input()
        self.mark = self.library.encode(f" {MARK}", add_special_tokens=False).ids

    @property
    def known(self) -> list[str]:
        """All known pieces, in the order of their numbers."""
        return self.pieces.to_pylist()

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of every whole text; a null text has none.

        Nothing here refers to itself, so the search for cycles, which the many short-lived objects would
        set off again and again, waits until the end.
        """
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(texts)
        finally:
            if collects:
                gc.enable()

    def _encoded(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = memoryview(data or b"")[bounds[0] : bounds[-1]].tobytes()
        bounds = bounds - bounds[0]
        if self.folds:
            raw = raw.translate(FOLD)
        begins = _cuts(raw, bounds, self.model_input is not None)
        coded = _binary(np.append(begins, len(raw)), raw, pa.large_string()).dictionary_encode()
        number, stays = self._looked_up(coded.dictionary)
        ends, ids = _taken(self.bounds, self.stored, number[coded.indices.to_numpy()])
        self._forget(stays)
        at = ends[np.searchsorted(begins, bounds)].tolist()
        return [ids[start:stop].tobytes() for start, stop in itertools.pairwise(at)]

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, int]:
        """The numbers of the pieces, and how many pieces are to stay known. The others are last."""
        number = np.full(len(words), -1, np.int64)
        place = pc.index_in(self.pieces, value_set=words)
        number[place.drop_null().to_numpy()] = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
        missing = np.flatnonzero(number < 0)
        if len(self.pieces) + len(missing) > self.kept:
            self._keep(words, number)
        new = words.take(pa.array(missing)).to_pylist()
        long = np.fromiter(map(len, new), np.int64, len(new)) > KEPT_LENGTH
        if long.any():
            order = np.argsort(long, kind="stable")
            missing, new = missing[order], [new[i] for i in order.tolist()]
        first = len(self.pieces)
        stays = first + len(new) - int(long.sum())
        number[missing] = np.arange(first, first + len(new))
        self.pieces = pa.concat_arrays([self.pieces, words.take(pa.array(missing[: stays - first]))])
        lengths, stored = self._learned(new)
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths)])
        self.stored = np.concatenate([self.stored, stored])
        return number, stays

    def _keep(self, words: pa.Array, number: np.ndarray) -> None:
        """Forget all pieces but those of this list, and number these anew."""
        found = np.flatnonzero(number >= 0)
        self.bounds, self.stored = _taken(self.bounds, self.stored, number[found])
        number[found] = np.arange(len(found))
        self.pieces = words.take(pa.array(found))

    def _forget(self, stays: int) -> None:
        """Forget the pieces from a number on, or all if they are too many."""
        if len(self.pieces) > self.kept:
            self.pieces, stays = NONE, 0
        if stays < len(self.bounds) - 1:
            self.bounds = self.bounds[: stays + 1].copy()
            self.stored = self.stored[: self.bounds[-1]].copy()

    def _learned(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many bytes of ids each piece has, and all of them. A word without marks takes the merges
        alone, as there is nothing to cut."""
        plain = [self.model_input is not None and PLAIN.fullmatch(x) is not None for x in new]
        words = iter(self.model_input(list(itertools.compress(new, plain))) if any(plain) else ())
        others = iter(self._together([x for x, alone in zip(new, plain, strict=True) if not alone]))
        lengths, stored = array("q"), array("I")
        tokenize = self.library.model.tokenize
        for alone in plain:
            ids = [x.id for x in tokenize(next(words))] if alone else next(others)
            lengths.append(4 * len(ids))
            stored.extend(ids)
        return np.array(lengths, np.int64), np.frombuffer(stored.tobytes(), np.uint8)

    def _whole(self, text: str) -> bytes:
        return array("I", self._ids(text)).tobytes()

    def _word(self, word: str) -> bytes:
        """One word without what the library does around its merges."""
        merged = self.library.model.tokenize(*self.model_input([word]))
        return array("I", [token.id for token in merged]).tobytes()

    def _input(self) -> Callable[[list[str]], list[str]] | None:
        """How the vocabulary hands a word to its merges, if in one of the two known ways."""
        for prepared in (_bytes_as_letters, _bare_bytes_as_letters):
            self.model_input = prepared
            if all(self._word(word) == self._whole(word) for word in PROBES):
                return prepared
        return None

    def _together(self, new: list[str], step: int = 1_000) -> list[array]:
        """Encode the pieces, many in one call. Between two of them stands a mark that both
        vocabularies keep apart from what begins with a space and from any end of a word."""
        found: dict[str, array] = {}
        joint = [p for p in new if p[:1] == " " and MARK not in p and not p[-1].isspace()]
        for at in range(0, len(joint), step):
            batch = joint[at : at + step]
            ids = array("I", self._ids(f" {MARK}".join(batch)))
            ends = [i for i, x in enumerate(ids) if x == self.mark[-1]]
            starts = [0, *(end + 1 for end in ends)]
            stops = [*(end + 1 - len(self.mark) for end in ends), len(ids)]
            for piece, start, stop in zip(batch, starts, stops, strict=True):
                found[piece] = ids[start:stop]
        return [found[p] if p in found else array("I", self._ids(p)) for p in new]

    def _ids(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for one vocabulary file."""
    return Encoder(path)
