"""Whole-text encoding with a public tokenizer, word by word.

The tokenizer drops white space before it looks for tokens, and neither its
normalizer nor its merges look across ASCII white space. So the ids of a
text are the ids of its pieces, one after another, and each distinct piece
needs the library only once while it stays in a bounded two-generation cache. ``tests/llm/test_tokens.py`` holds this against the
library's own whole-text encoding.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 23  # of texts whose pieces are looked up together
CACHE_WORDS = 600_000  # per generation and worker process


class _TwoGenerations(dict):
    """A dict that fills itself with ``make(key)`` and forgets old keys.

    When the young generation is full it becomes the old one; a key found
    there moves back. So at most ``2 * limit`` entries are held.
    """

    __slots__ = ("make", "limit", "old")

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.hold(key, value)
        return value

    def hold(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def many(self, keys: list, make_all) -> list:
        """The values of different keys; ``make_all`` makes those that neither generation has."""
        found = list(map(self.get, keys))
        missing = [k for k, value in enumerate(found) if value is None]
        for k in missing:
            found[k] = self.old.get(keys[k])
        new = [k for k in missing if found[k] is None]
        for k, value in zip(new, make_all([keys[k] for k in new])):
            found[k] = value
        for k in missing:
            self.hold(keys[k], found[k])
        return found


# what a byte of a lower-cased plain text is part of
SPACE, LETTER, DIGIT, OTHER = range(4)
WHITE = b"\t\n\v\f\r "
CLASS = bytes(SPACE if c in WHITE else DIGIT if c in b"0123456789"
              else LETTER if c >= 128 or c in b"abcdefghijklmnopqrstuvwxyz" else OTHER
              for c in range(256))


def _piece_starts(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the split pattern's pieces of lower-cased plain bytes, and the runs of white
    space between them, begin; ``kind`` is the class of each byte."""
    begins = np.empty(len(data), bool)
    begins[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    begins[kind == DIGIT] = True  # digits are pieces of their own
    # an apostrophe that begins a piece takes the letters of a contraction
    at = np.flatnonzero(data[:-1] == ord("'"))
    at = at[begins[at]]
    one, two = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b)) & (at + 2 < len(data))
    begins[at[short | long] + 1] = False
    ends = np.concatenate([at[short] + 2, at[long] + 3])
    begins[ends[ends < len(data)]] = True
    return np.flatnonzero(begins)


class WordEncoder:
    """Encode texts to little-endian unsigned 32-bit ids.

    Made for tokenizers that lower-case, split at and drop white space and
    have no added token with white space in it. Texts of plain letters (ASCII
    and precomposed Latin) are cut into pieces by one substitution; a text
    with any other character goes word by word through the library's own
    normalizer and splitter.
    """

    # characters whose lower case, normal form and class need no look-up
    PLAIN = re.compile("[\x00-\x1b\x20-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f"
                       "\u0132-\u0148\u014a-\u017e]*")
    # the tokenizer's split pattern without its runs of letters
    BETWEEN = re.compile("'(?:[stmd]|re|ve|ll)|[0-9]|"
                         "[^\\sa-z0-9\u00df-\u00f6\u00f8-\u017e]+")

    # a line without this has only letters and single stops before white space
    NOT_PROSE = re.compile("[^\\sa-z.,\u00df-\u00f6\u00f8-\u017e]|[.,]\\S")

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.normalize = self.tokenizer.normalizer.normalize_str
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the letter that stands for each byte of plain characters
        self.letters = {}
        for c in map(chr, range(0x180)):
            (mapped, _), = self.byte_level.pre_tokenize_str(c)
            self.letters.update(zip(c.encode("utf-8"), mapped))
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = _TwoGenerations(self._piece, limit)
        self.words = _TwoGenerations(self._word, limit // 4)

    def _mapped(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _byte_letters(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece
        return piece.encode("utf-8").decode("latin-1").translate(self.letters)

    def _piece(self, piece: str) -> bytes:
        return self._mapped(self._byte_letters(piece))

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        ids, ends = [], [0]
        for piece in pieces:
            ids += [t.id for t in self.model.tokenize(self._byte_letters(piece))]
            ends.append(4 * len(ids))
        ids = np.array(ids, "<u4").tobytes()
        return [ids[a:b] for a, b in pairwise(ends)]

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if any(a in text for a in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(self._mapped(p) for p, _ in self.split(self.normalize(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text (None: no ids) as bytes, four per id."""
        if not text:
            return b""
        if not self.PLAIN.fullmatch(text) or any(a in text for a in self.added):
            return b"".join(map(self.words.__getitem__, text.encode("utf-8").split()))
        cut: list[str] = []
        for line in text.lower().split("\n"):
            if self.NOT_PROSE.search(line):
                cut += self.BETWEEN.sub(r" \g<0> ", line).split()
            else:
                cut += line.replace(".", " .").replace(",", " ,").split()
        return b"".join(map(self.pieces.__getitem__, cut))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts, one after another, and the number of each text's, some texts at a
        time and in their order.

        The pieces of plain texts are found by the classes of their bytes and looked up
        once for every ``CHUNK_BYTES`` they come in; other texts go through ``encode``."""
        kind, some, size = True, [], 0
        for text in texts:
            text = text or ""
            plain = bool(self.PLAIN.fullmatch(text)) and not any(a in text for a in self.added)
            if some and (plain != kind or size >= CHUNK_BYTES):
                yield self._plain_ids(some) if kind else self._other_ids(some)
                some, size = [], 0
            kind = plain
            some.append(text)
            size += len(text)
        if some:
            yield self._plain_ids(some) if kind else self._other_ids(some)

    def _other_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [self.encode(text) for text in texts]
        return np.frombuffer(b"".join(coded), "<u4"), np.array([len(c) // 4 for c in coded], np.int64)

    def _plain_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lines = [text.lower().encode("utf-8") for text in texts]
        joined = b"\n".join(lines)
        if not joined:
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        kind = np.frombuffer(joined.translate(CLASS), np.uint8)
        starts = _piece_starts(np.frombuffer(joined, np.uint8), kind)
        pieces_only = kind.take(starts) != SPACE
        sizes = np.diff(starts, append=len(joined))[pieces_only]
        starts = starts[pieces_only]
        offsets = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        letters = joined.translate(None, WHITE)
        pieces = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        # ids of the distinct pieces in one array
        distinct = self.pieces.many(pieces.dictionary.to_numpy(zero_copy_only=False).tolist(),
                                    self._pieces)
        ids = np.frombuffer(b"".join(distinct), "<u4")
        sizes = np.fromiter(map(len, distinct), np.int32, len(distinct)) >> 2
        of_piece = pieces.indices.to_numpy()
        n = sizes.take(of_piece)
        until = np.cumsum(n, dtype=np.int32)
        # an id's place: its piece's first in ``ids``, and how far it is into the piece
        first = (np.cumsum(sizes, dtype=np.int32) - sizes).take(of_piece)
        places = np.repeat(first - (until - n), n)
        places += np.arange(len(places), dtype=np.int32)
        ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1) - 1
        ends = np.append(0, until)[np.searchsorted(starts, ends)].astype(np.int64)
        return ids.take(places), np.diff(ends, prepend=0)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker process; its caches outlive a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def public_path(name: str) -> str:
    """Default place of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
