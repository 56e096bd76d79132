"""Operator 1: secret scans.

Three base kinds are found by pattern; the entropy scan adds spans. Candidate
strings are maximal runs of a character class (hex; base64 with its URL
signs). A window of ``window`` characters slides over each candidate: the
counts of its characters are kept, one goes up and one goes down per step,
and with them the sum of ``c * log2(c)``, from which the Shannon entropy
follows. Windows at or above the class's threshold are merged to spans.
Candidates that are on the allow list as a whole (words, digits, identifiers) are
not scanned; a well-known filler inside a candidate only suppresses the windows
that touch it, so a secret beside one is found. Spans inside a base span are not
repeated.

``c * log2(c)`` is tabled as whole millionths, so results do not depend on
the order of additions. Everything happens inside a row, with no shuffle, in one
pass over its matches and characters.

Positions are code points: the text is split at the matches, and the lengths
of gaps and matches add up to the starts.

Defined results: NULL and empty texts have no spans; matches of one kind do
not overlap, those of different kinds may; ties in start are ordered as the
kinds are listed; repeated rows get equal results; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running

# fixed values: the base patterns; their letters in either case where (?i)
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
MIN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]


@dataclass(frozen=True)
class EntropyClass:
    """A character class with its window and threshold (bits a character)."""

    kind: str
    alphabet: str
    pattern: str
    window: int
    bits: float

    @property
    def most(self) -> int:
        """Largest sum of c * log2(c), in millionths, with that entropy."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * 1e6)


ENTROPY = (
    EntropyClass("entropy_hex", "0123456789abcdefABCDEF", "[0-9a-fA-F]{24,}", 24, 3.2),
    EntropyClass("entropy_base64",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
                 "[A-Za-z0-9+/_=-]{24,}", 24, 4.0),
)
# candidates that are no secrets as a whole: digits; words, also joined by signs; UUIDs
ALLOW = [
    r"^[0-9+/_=-]+$",
    r"^[A-Za-z]?[a-z]*([+/_=-]+[A-Za-z]?[a-z]*)*$",
    r"^[A-Z]*([+/_=-]+[A-Z]*)*$",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
]
# words and runs that stand in manuals, in either case
FILLERS = ["example", "sample", "dummy", "placeholder", "changeme", "redacted", "xxxx", "0000000",
           "1234567", "abcdefg"]
MASK = "\x01"


_FOUND, _SPAN = "struct<a:int,b:int,m:string>", "struct<a:int,b:int>"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<a, b, m>>: start, end and string of all matches."""
    def step(at: Column, x: Column) -> Column:
        a = at + x["gap"]
        b = a + F.length(x["m"])
        return F.struct(b.alias("state"), F.array(F.struct(
            a.alias("a"), b.alias("b"), x["m"].alias("m"))).alias("add"))

    def place(found: Column) -> Column:
        pairs = F.transform(found["ms"], lambda m, i: F.struct(
            F.length(F.get(found["gaps"], i)).alias("gap"), m.alias("m")))
        return running(pairs, F.lit(0), step, _FOUND)

    return F.when(text.rlike(pattern), let(F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("ms"),
        F.split(text, pattern, -1).alias("gaps")), place)).otherwise(
        F.expr(f"cast(array() as array<{_FOUND}>)"))


def masked(candidate: Column, fillers: list[str] = FILLERS) -> Column:
    """The candidate with every filler's characters replaced by ``MASK``."""
    out = candidate
    for word in fillers:
        out = F.regexp_replace(out, f"(?i){word}", MASK * len(word))
    return F.when(candidate.rlike("(?i)" + "|".join(fillers)), out).otherwise(candidate) if fillers \
        else candidate


def entropy_spans(text: Column, cls: EntropyClass, allow: list[str] = ALLOW,
                  fillers: list[str] = FILLERS) -> Column:
    """array<struct<a, b>> of high-entropy spans over all candidates."""
    size, mask = cls.window, len(cls.alphabet) + 1
    table = F.array(*[F.lit(0 if c < 2 else round(c * math.log2(c) * 1e6)).cast("long")
                      for c in range(size + 2)])
    no_spans = F.expr(f"cast(array() as array<{_SPAN}>)")

    def scan(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            leaves = F.when(i > size, F.element_at(codes, i - size)).otherwise(F.lit(0))

            def moved(p: Column) -> Column:
                def cost(c: Column) -> Column:
                    return F.get(table, c)
                up, down = F.get(state["n"], p["c"]), F.get(state["n"], p["o"])
                total = F.when(p["c"] == p["o"], state["s"]).otherwise(
                    state["s"] + cost(up + 1) - cost(up)
                    + F.when(p["o"] > 0, cost(down - 1) - cost(down)).otherwise(F.lit(0)))
                clear = F.when(p["c"] == mask, F.lit(0)).otherwise(state["clear"] + 1)

                def ended(x: Column) -> Column:
                    last, first = state["last"], i - size
                    hot = (x["clear"] >= size) & (x["s"] <= cls.most)
                    joins = last.isNotNull() & (last["b"] >= first)
                    new = F.struct(F.when(joins, last["a"]).otherwise(first).alias("a"), i.alias("b"))
                    return F.struct(
                        F.struct(F.transform(state["n"], lambda v, k: v + (k == p["c"]).cast("int")
                                             - (k == p["o"]).cast("int")).alias("n"),
                                 x["s"].alias("s"), x["clear"].alias("clear"),
                                 F.when(hot, new).otherwise(last).alias("last")).alias("state"),
                        F.when(hot & last.isNotNull() & ~joins, F.array(last)).otherwise(no_spans)
                        .alias("add"))
                return let(F.struct(total.alias("s"), clear.alias("clear")), ended)
            return let(F.struct(F.element_at(codes, i).alias("c"), leaves.alias("o")), moved)

        start = F.struct(F.array_repeat(F.lit(0), mask + 1).alias("n"),
                         F.lit(0).cast("long").alias("s"), F.lit(0).alias("clear"),
                         F.expr(f"cast(null as {_SPAN})").alias("last"))
        return running(F.sequence(F.lit(1), F.size(codes)), start, step, _SPAN,
                       lambda state: F.when(state["last"].isNotNull(), F.array(state["last"]))
                       .otherwise(no_spans), chunk=1024)

    def of(candidate: Column) -> Column:
        codes = F.transform(F.split(masked(candidate["m"], fillers), ""),
                            lambda c: F.instr(F.lit(cls.alphabet + MASK), c))
        return F.transform(let(codes, scan), lambda s: F.struct(
            (s["a"] + candidate["a"]).alias("a"), (s["b"] + candidate["a"]).alias("b")))

    open_ones = F.filter(matches(text, cls.pattern), lambda m: ~_any_of(m["m"], allow))
    return F.flatten(F.transform(open_ones, of))


def _any_of(value: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | value.rlike(p)
    return out


_KIND_SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def uncovered(base: Column, added: Column) -> Column:
    """The ``added`` spans that no ``base`` span holds, by start and rank: both are
    swept once by start, with the furthest end of a base span so far."""
    def marked(spans: Column, is_added: int) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(is_added).alias("added"), s["rank"].alias("rank"),
            s["end"].alias("end"), s["kind"].alias("kind")))

    def step(furthest: Column, s: Column) -> Column:
        span = F.struct(*[s[c].alias(c) for c in ("start", "rank", "end", "kind")])
        return F.struct(
            F.when(s["added"] == 0, F.greatest(furthest, s["end"])).otherwise(furthest).alias("state"),
            F.when((s["added"] == 1) & (s["end"] > furthest), F.array(span)).otherwise(
                F.expr(f"cast(array() as array<{_KIND_SPAN}>)")).alias("add"))

    return running(F.sort_array(F.concat(marked(base, 0), marked(added, 1))), F.lit(-1), step,
                   _KIND_SPAN)


def scan(docs: DataFrame, allow: list[str] = ALLOW, fillers: list[str] = FILLERS) -> DataFrame:
    """doc_id, base (array of spans) and added (array of entropy spans).

    A span is (start, rank, end, kind); both arrays are sorted by start, then
    by the kinds' order."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def spans(found: Column, kind: str) -> Column:
        return F.transform(found, lambda m: F.struct(
            m["a"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
            m["b"].alias("end"), F.lit(kind).alias("kind")))

    # a failing assignment still uses up its characters, so it is dropped after
    assign = F.filter(matches(text, ASSIGN), lambda m: F.length(
        F.regexp_extract(m["m"], ASSIGN, 2)) >= MIN_VALUE)
    base = F.sort_array(F.concat(spans(assign, "assign"), spans(matches(text, ACCESS), "access"),
                                 spans(matches(text, HEX), "hex")))
    added = F.concat(*[spans(entropy_spans(text, c, allow, fillers), c.kind) for c in ENTROPY])
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.struct(base.alias("base"), added.alias("added")).alias("f"))
    return found.select("doc_id", let(F.col("f"), lambda f: F.struct(
        f["base"].alias("base"), uncovered(f["base"], f["added"]).alias("added"))).alias("f"),
    ).select("doc_id", "f.base", "f.added")


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from ``scan``."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.sort_array(F.concat("base", "added"))).alias("spans"))
