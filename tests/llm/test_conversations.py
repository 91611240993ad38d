"""The radix tree beside a dictionary of prefixes, and the trie beside brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from textloom.llm import radix_tree as rt
from textloom.llm.conversation_trie import prefix_trie

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, node STRING, block INT, depth STRING, ends INT"


def brute(rows, family=20, most=4):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            digest = hashlib.sha256(f"{len(said[0].encode())}:{said[0]}{said[1]}".encode()).digest()[:16]
            own.setdefault(conv, []).append(((turn is not None, turn or 0), digest, said))
    own = {c: [s for *_, s in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path, m in members.items():
        below = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(path))
        out.append(
            (min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(children.get(path, ())),
             sum(p not in children for p in below), saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=lambda r: (r[1], r[0]))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", 1, "d", 2) for r in rows], SCHEMA)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def test_tree_beside_prefixes():
    rng = random.Random(5)
    for width, letters, n in ((1, 256, 600), (2, 3, 200), (3, 2, 100), (16, 2, 50)):
        ids = [bytes(rng.randrange(letters) for _ in range(width)) for _ in range(300 if letters == 256 else 6)]
        keys = [b"".join(rng.choice(ids) for _ in range(rng.randrange(5))) for _ in range(n)]
        tree, members = rt.RadixTree(width), {}
        for i, key in enumerate(keys):
            tree.insert(key, i)
            for d in range(0, len(key) + 1, width):
                members.setdefault(key[:d], []).append(i)
        paths, got = [], {}
        for v in tree.walk():
            paths.append(paths[v.parent] + v.last if v.depth else b"")
            assert v.depth * width == len(paths[-1]) and paths[-1] not in got
            got[paths[-1]] = (v.count, v.low, v.ends or [])
        assert got == {p: (len(m), min(m), [i for i in m if keys[i] == p]) for p, m in members.items()}
        assert paths == sorted(paths)  # big-endian ids in their order, parents first


def test_layouts_grow():
    tree = rt.RadixTree(1)
    seen = []
    for i in range(256):
        tree.insert(bytes([(i * 37) % 256]), i)
        seen.append((type(tree.root.layout).__name__, getattr(tree.root.layout, "capacity", None)))
    assert seen[3] == ("SortedKeys", 4) and seen[4] == ("SortedKeys", 16) and seen[15] == ("SortedKeys", 16)
    assert seen[16][0] == "Indexed" and seen[47][0] == "Indexed" and seen[48][0] == "Full" and seen[255][0] == "Full"
    with pytest.raises(ValueError):
        rt.RadixTree(4).insert(b"abc", 1)


def test_one_path_is_compressed():
    tree = rt.RadixTree(4)
    tree.insert(b"aaaabbbbcccc", 1)
    assert [v.depth for v in tree.walk()] == [0, 1, 2, 3] and tree.root.child(97).layout is None
    tree.insert(b"aaaabbbd", 2)  # parts within an id: no node there
    assert sorted((v.depth, v.count) for v in tree.walk()) == [(0, 2), (1, 2), (2, 1), (2, 1), (3, 1)]


@pytest.mark.parametrize("block_turns", [7, 50_000])
def test_trie_beside_brute_force(spark, block_turns):
    rng = random.Random(8)
    rows = []
    for c in [*range(90), -3, -20, 1000, 10**12]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", None, ""]), rng.choice(["hi", "hi", "two words", "", None, "ein wort x"])))
    rows += [(7, 1, "user", "same"), (7, 1, "user", "same"), (7, 1, "a", "tie"), (None, 1, "user", "lost")]
    rows += [(500, t, "user", f"turn {t % 9}") for t in range(300)]
    assert plain(prefix_trie(frame(spark, rows), block_turns=block_turns)) == brute(rows)


def test_empty_tables(spark):
    assert prefix_trie(frame(spark, [])).collect() == []
    assert prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"t {t}") for c in range(400) for t in range(5)]
    got = plain(prefix_trie(frame(spark, rows), block_turns=100))
    assert [(r[0], r[1], r[3], r[4], r[5]) for r in got] == [(0, d, 400, int(d < 5), 1) for d in range(6)]
    assert got[0][6] == 399 * 2 * 5 and got[5][7] == hashlib.sha256(",".join(map(str, range(400))).encode()).hexdigest()
