"""Operator 10: token counts by a finite-state form of the tokenizer.

The merge tokenizer is compiled, on demand, into a deterministic transducer
over characters whose transitions carry the number of tokens they emit.

A sequence of tokens is what the merges give for a word exactly if every two
neighbours are (re-merging two adjacent tokens gives the same two). So after
any prefix of a word, all that matters for what follows is: for each cut
whose rest is still the beginning of some token, the last token before the
cut, and how many tokens it took relative to the others. That finite set is
the state. Reading a character moves every open cut on, drops those whose
rest begins no token, and may add one cut; the transition emits the number
of tokens that all remaining cuts have in common. White space, and the other
borders of the split pattern, emit the rest and return to the start.

Long texts are cut into chunks. A chunk's state map is kept in closed form:
white space sends every state to the start, so a chunk is (head before its
first white space, tokens between, tail after its last one), and two maps
compose by running the transducer over ``tail + head``. Composition is
associative; a text's chunk maps are combined pairwise, level by level (a
prefix scan's up-sweep), so no state is guessed and no chunk waits.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; special
strings inside a text count as one token each (the library's default);
repeated rows are counted once each; an empty table gives an empty result; other
columns are ignored. One text's chunks are mapped one after another in its row's
task: chunks bound what is held, rows are what runs in parallel.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator
from itertools import accumulate
from operator import attrgetter, getitem

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
CHUNK = 1 << 16
MAX_STATES = 400_000  # per worker; beyond it the lazily built states are dropped

SPACE, LETTER, DIGIT, OTHER = range(4)
_EMIT = attrgetter("emit")


class State(dict):
    """A state and its known transitions, character -> state.

    ``emit`` is the number of tokens emitted on the way in, so that a run is
    ``sum(emit)`` over the visited states. ``kind``: what the open piece
    consists of; ``text`` the characters from the first open cut on; ``cuts``
    pairs (cut position in ``text``, last token before it, tokens so far less
    the minimum).
    """

    __slots__ = ("cuts", "emit", "kind", "machine", "text")

    def __init__(self, machine, kind, text, cuts, emit):
        super().__init__()
        self.machine, self.kind, self.text, self.cuts, self.emit = machine, kind, text, cuts, emit

    def __missing__(self, char):
        to = self[char] = self.machine.step(self, char)
        return to


class Transducer:
    """The counting transducer of a byte-level merge tokenizer with word ends."""

    def __init__(self, path: str, max_states: int = MAX_STATES):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {m: k for k, m in enumerate(merges)}
        self.vocab = set(model["vocab"])
        ends = {t[:-len(self.end)] for t in self.vocab if self.end and t.endswith(self.end)}
        self.begins = {t[:k] for t in self.vocab | ends for k in range(len(t) + 1)}
        self.tokenizer = Tokenizer.from_file(path)
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.normalize = self.tokenizer.normalizer.normalize_str
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = added
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))))
        self.max_states, self.pairs, self.chars = max_states, {}, {}
        self.reset()

    def reset(self) -> None:
        for state in getattr(self, "states", {}).values():
            state.clear()  # states point at each other: free them without the collector
        self.states: dict[tuple, State] = {}
        self.start = self.state(None, "", ((0, "", 0),), 0)

    def state(self, kind, text, cuts, emit) -> State:
        key = (kind, text, cuts, emit)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(self, kind, text, cuts, emit)
        return found

    def char(self, c: str) -> tuple[int, str]:
        """Class and byte-level form of a character, asked of the library."""
        if c not in self.chars:
            parts = len(self.split("a" + c + "a"))
            kind = (SPACE if parts == 2 else LETTER if parts == 1
                    else DIGIT if len(self.split(c + c)) == 2 else OTHER)
            form = "" if kind == SPACE else "".join(p for p, _ in self.byte_level.pre_tokenize_str(c))
            self.chars[c] = kind, form
        return self.chars[c]

    def merge(self, parts: list[str]) -> list[str]:
        """The merge procedure itself, for words of two tokens."""
        while len(parts) > 1:
            best = min(range(len(parts) - 1),
                       key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            pair = parts[best], parts[best + 1]
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def neighbours(self, a: str, b: str) -> bool:
        """Can ``b`` follow ``a``; ``a`` is empty at the start of a word."""
        key = a, b
        if key not in self.pairs:
            units = list(a) + list(b)
            if self.end and b.endswith(self.end) and len(b) > len(self.end):
                bare = b[:-len(self.end)]
                units = list(a) + [*bare[:-1], bare[-1] + self.end]
            self.pairs[key] = self.merge(units) == ([a, b] if a else [b])
        return self.pairs[key]

    def read(self, text: str, cuts: tuple, form: str) -> tuple[str, tuple, int]:
        """Append the byte-level characters of ``form`` to an open word."""
        emitted = 0
        for unit in form:
            text += unit
            new = next(((len(text), text[p:], n + 1) for p, last, n in cuts
                        if text[p:] in self.vocab and self.neighbours(last, text[p:])), None)
            # a cut at the end of the text stays open: its rest is empty
            kept = [c for c in cuts if text[c[0]:] in self.begins] + ([new] if new else [])
            low = min(n for _, _, n in kept)
            first = min(p for p, _, _ in kept)
            text, emitted = text[first:], emitted + low
            cuts = tuple((p - first, last, n - low) for p, last, n in kept)
        return text, cuts, emitted

    def close(self, text: str, cuts: tuple) -> int:
        """Tokens still to emit when the word ends here."""
        return next(n + 1 for p, last, n in cuts
                    if p < len(text) and text[p:] + self.end in self.vocab
                    and self.neighbours(last, text[p:] + self.end))

    def whole(self, form: str) -> int:
        text, cuts, n = self.read("", ((0, "", 0),), form)
        return n + self.close(text, cuts)

    def step(self, at: State, c: str) -> State:
        if len(self.states) > self.max_states:
            self.reset()
        kind, form = self.char(c)
        if isinstance(at.kind, str):  # an apostrophe that may begin 's 'll ...
            tail = at.kind + c
            if tail in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"):
                return self.state(None, "", ((0, "", 0),), self.whole(tail))
            if tail in ("'r", "'v", "'l"):
                return self.state(tail, "", ((0, "", 0),), 0)
            if len(at.kind) > 1:  # 'r and no e: the apostrophe alone, then letters
                open_one = self.run_on(LETTER, at.kind[1:])
                again = self.after(open_one, c, open_one.emit)
                return self.state(again.kind, again.text, again.cuts, again.emit + self.whole("'"))
            open_one = self.run_on(OTHER, "'")
            return self.after(open_one, c, open_one.emit)
        return self.after(at, c)

    def run_on(self, kind: int, form: str) -> State:
        return State(self, kind, *self.read("", ((0, "", 0),), form))

    def after(self, at: State, c: str, given: int = 0) -> State:
        """Step from an open piece of letters or other signs, or from none.

        ``given`` tokens are added: those of a state made by ``run_on``, which
        is not part of a run itself. ``at.emit`` of a state of a run is counted
        on the way in, whether or not a reset has dropped the state since.
        """
        kind, form = self.char(c)
        if at.kind == kind and kind in (LETTER, OTHER):
            text, cuts, n = self.read(at.text, at.cuts, form)
            return self.state(kind, text, cuts, n + given)
        n = given + (self.close(at.text, at.cuts) if at.kind is not None else 0)
        if kind == SPACE:
            return self.state(None, "", ((0, "", 0),), n)
        if kind == DIGIT:
            return self.state(None, "", ((0, "", 0),), n + self.whole(form))
        if c == "'":
            return self.state("'", "", ((0, "", 0),), n)
        text, cuts, more = self.read("", ((0, "", 0),), form)
        return self.state(kind, text, cuts, n + more)

    def run(self, text: str) -> int:
        """Tokens of a text of normalized characters that starts at a border."""
        return sum(map(_EMIT, accumulate(text + " ", getitem, initial=self.start))) if text else 0

    # --- chunk maps -----------------------------------------------------
    def chunk_map(self, chunk: str) -> tuple[bool, str, int, str]:
        """(has white space, head, tokens between, tail) of a normalized chunk."""
        first = chunk.find(" ")
        if first < 0:
            return False, chunk, 0, ""
        last = chunk.rfind(" ")
        return True, chunk[:first], self.run(chunk[first:last]), chunk[last + 1:]

    def compose(self, a: tuple, b: tuple) -> tuple[bool, str, int, str]:
        if not a[0]:
            return b[0], a[1] + b[1], b[2], b[3]
        if not b[0]:
            return True, a[1], a[2], a[3] + b[1]
        return True, a[1], a[2] + self.run(a[3] + b[1]) + b[2], b[3]

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text, as the library gives them."""
        total = 0
        parts = self.special.split(text) if any(a in text for a in self.added) else [text]
        for part in parts:
            if part.isascii() and part.isprintable():
                part = part.lower()
            else:
                part = self.normalized(part)
            maps = [self.chunk_map(part[i:i + chunk]) for i in range(0, len(part), chunk)]
            while len(maps) > 1:
                maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i]
                        for i in range(0, len(maps), 2)]
            for _, head, between, tail in maps:
                total += self.run(head) + between + self.run(tail)
        return total + len(parts) - 1

    # characters whose normal form is their lower case, beside white space
    PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-į"
                       "Ĳ-ňŊ-ž]*")

    def normalized(self, text: str) -> str:
        if self.PLAIN.fullmatch(text):
            return text.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return self.normalize(text)


_MACHINES: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The transducer of this worker process; its states outlive a task."""
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(path)
    return _MACHINES[path]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            texts = batch.column(1)
            sizes, counts = [], []
            gc.disable()  # its passes over all live states cost more than the counting
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                sizes.append(len(text.encode("utf-8")))
                counts.append(machine.count(text))
            gc.enable()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > F.lit(limit))
