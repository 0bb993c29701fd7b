"""The trie of conversations against its definition."""

import hashlib
import random
import re
import zlib

import pytest

from tripflow.llm import conversation_trie
from tripflow.llm.common import WORD


def plain(rows, rebuild=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    convs = {}
    for c, ts in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        convs[c] = own.get(base, [])[:h] + ts[h:] if rebuild else ts
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) or 1
        saved[p] = (len(nodes[p]) - 1) * (len(re.findall(WORD, p[-1][1])) if p else 0) + sum(saved[k] for k in kids)
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    turns = spark.createDataFrame([(*r, 3, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, k1 string").repartition(3)
    return sorted((tuple(r) for r in conversation_trie.trie(spark, *conversation_trie.rebuilt(spark, turns), **options).collect()), key=str)


def cases():
    rnd = random.Random(3)
    lines = ["hello there", "hello  there", "", None, "a b\tc\n", "übung 日本", "word " * 3000]
    rows = []
    for c in [*range(-45, 90, 3), *range(100, 125), 2 ** 40]:
        same = rnd.choice([None, 5, 9])
        own = random.Random(same) if same else rnd
        for turn in range(own.randrange(0, 9)):
            rows.append((c, turn, own.choice(["user", "assistant", None]), own.choice(lines[:4] if own.random() < 0.7 else lines)))
    rows += [(7, None, "system", "first"), (7, None, "system", "first"), (7, 2, "user", "tie"), (7, 2, "user", "another"), (None, 0, "user", "lost")]
    # Long conversations that agree for most of their length, and one that is far longer than a run of turns.
    for c in (200, 220, 240):
        rows += [(c, t, "user", f"turn {t} {c if t == 70 + c // 20 else ''}") for t in range(90)]
    return rows


@pytest.mark.parametrize("band", [5, 32])
def test_equals_the_definition(spark, band):
    rows = cases()
    assert found(spark, rows, band=band) == plain(rows)


def test_runs_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "_RUN", 16)
    monkeypatch.setattr(conversation_trie, "_PIECE", 8)
    rows = cases()
    assert found(spark, rows, band=16) == plain(rows)


def test_conversations_left_without_turns_end_at_the_root(spark):
    lost = next(c for c in range(1001, 1020) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(lost, 0, "user", "x"), (lost + 40, 0, "user", "y")]
    got = found(spark, rows)
    assert got == plain(rows) and any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_a_band_has_depths(spark):
    with pytest.raises(ValueError):
        found(spark, [(1, 0, "user", "x")], band=0)
