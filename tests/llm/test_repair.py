"""Conversation repair against all edits of short conversations."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

from tripmart.llm import queries, role_repair as rr

SCHEMA = "conv_id long, turn long, role string, text string, key string, kind string, audit string"


@lru_cache(None)
def inserted(n):
    return [i for k in range(n + 1) for i in itertools.product("ua", repeat=k)]


def cheapest(rows):
    """Least (cost, audit, lines) over all edits; ``rows``: (role, text, must_go, truncated)."""
    name = {"u": "user", "a": "assistant"}
    choices = []
    for role, text, must_go, truncated in rows:
        own = [(3, "D", "", [])]
        if not must_go:
            own.append((truncated, "K", role[:1] or "?", [f"{role}:{text}"]))
            own += [(2 + truncated, "R", x, [f"{name[x]}:{text}"]) for x in "ua"]
        choices.append([(c + 2 * len(i), "I" * len(i) + e, "".join(i) + r,
                         [f"{name[x]}:" for x in i] + lines)
                        for i in inserted(2) for c, e, r, lines in own])
    choices.append([(2 * len(i), "I" * len(i), "".join(i), [f"{name[x]}:" for x in i])
                    for i in inserted(2)])
    best = None
    for path in itertools.product(*choices):
        if re.fullmatch("(s?(ua)+)?", "".join(p[2] for p in path)):
            new = (sum(p[0] for p in path), "".join(p[1] for p in path), sum((p[3] for p in path), []))
            best = min(best or new, new)
    return best


def brute(rows, conv):
    """The contract's columns of one conversation, from its undamaged rows."""
    after = []
    for _, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        after += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, counts, marked = set(), [0, 0, 0], []
    for _, role, text in after:
        said = re.sub("^[ \t-\r]+|[ \t-\r]+$", "", text)
        fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        marked.append((role, text, fault in (0, 1), int(fault == 2)))
    turns = {t for t, _, _ in after if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
    cost, audit, lines = cheapest(marked)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations():
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(120)]:
        n = rng.choice([1, 1, 2, 2, 3])
        for k in range(n):
            turn = rng.choice([k, k, k, k + 3, None, rng.randrange(-2, 4)])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((conv, turn, role, rng.choice(
                ["Yes.", "Yes.", "no", " \t", "", None, "é ü! ", "a\nb?", "Why\x0b"])))
    return rows


def test_equals_brute_force(spark):
    rows = conversations()
    docs = spark.createDataFrame([r + ("x",) * 3 for r in rows], SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in rr.repair(rr.damaged(docs)).collect()}
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    assert set(got) == set(by_conv)
    for conv, own in by_conv.items():
        assert got[conv] == brute(own, conv), (conv, own)


def test_edits_give_legal_conversations(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = rr.damaged(docs)
    got = {r.conv_id: r for r in queries.op11_role_repair(spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == {r[0] for r in docs.select("conv_id").distinct().collect()}
    assert any(r.cost for r in got.values()) and any(not r.cost for r in got.values())
    repaired = {}
    for r in rr.repaired_rows(rows).collect():
        repaired.setdefault(r.conv_id, []).append(r)
    for conv, r in got.items():
        own = sorted(repaired.get(conv, []), key=lambda x: x.place)
        assert [x.place for x in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in own))
        assert "".join(x.edit for x in own) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in own).encode()
                              ).hexdigest() == r.repaired_sha256


def test_long_conversation_and_empty_table(spark):
    rows = [(1, k, "user" if k % 3 else "assistant", "same." if k % 5 else f"text {k}", "", "", "")
            for k in range(3000)]
    got = rr.repair(rr.damaged(spark.createDataFrame(rows, SCHEMA))).first()
    assert got.audit and got.duplicate > 1000 and len(got.audit.replace("I", "")) > 2500
    empty = spark.createDataFrame([], SCHEMA)
    assert rr.repair(rr.damaged(empty)).count() == rr.repaired_rows(rr.damaged(empty)).count() == 0


def test_parser_merges_equal_tops():
    parser = rr.Parser()
    assert len(parser.tops) == 8  # all stacks of the grammar, however long the input
    assert [t for t in range(8) if parser.accepts(t)] != []
    assert parser.accepts(parser.first[0])
