"""Radix tree layouts and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib

from strata.llm.conversation_trie import conversation_trie
from strata.llm.radix_tree import Direct, Indexed, Node, RadixTree, Sorted

SCHEMA = ("conv_id long, turn long, role string, text string, digest binary, depth long, seq string, id int, "
          "words int, tie int, n long, parent string")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_node_layouts_grow():
    node, kinds = Node(b""), []
    for b in range(256):
        node.put(b * 37 % 256, Node(b"", b))
        kinds.append((type(node.layout), getattr(node.layout, "limit", None)))
        assert [k for k, _ in node.children()] == sorted((i * 37) % 256 for i in range(b + 1))
    assert kinds[3] == (Sorted, 4) and kinds[4] == kinds[15] == (Sorted, 16)
    assert kinds[16][0] is kinds[47][0] is Indexed and kinds[48][0] is kinds[255][0] is Direct
    assert node.layout.get(37).value == 1


def test_radix_tree_keeps_every_key():
    rng = random.Random(2)
    keys = {bytes(rng.choice((0, 1, 7, 200, 255)) for _ in range(rng.randrange(0, 40))) for _ in range(800)} | {b""}
    keys |= {bytes([b]) + b"same tail" for b in range(256)}
    order = list(keys)
    rng.shuffle(order)
    tree = RadixTree()
    for k in order:
        tree.insert(k, k.hex())
    assert all(tree.get(k) == k.hex() for k in keys)
    assert tree.get(b"not there") is None
    seen, stack = [], [(b"", tree.root)]
    while stack:                                     # children in byte order: keys come out sorted
        lead, node = stack.pop()
        here = lead + node.path
        if node.value is not None:
            seen.append(here)
        stack += [(here + bytes([b]), kid) for b, kid in reversed(list(node.children()))]
    assert seen == sorted(keys)


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = {}, {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + ts[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        leaves, saved = 0 if p in kids else 1, (len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        for k in kids.get(p, []):
            a, b = below(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for p, m in members.items():
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), *below(p),
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def turns(seed=1):
    rng = random.Random(seed)
    rows = []
    first = ["hello there", "good day", "", "äöü 日本 😀", "a b\tc\nd"]
    for c in range(160):
        if c in (40, 41):
            continue
        for t in range(rng.randrange(1, 8)):
            text = first[rng.randrange(2)] if t < 3 and rng.random() < 0.8 else rng.choice(first) + str(rng.randrange(9))
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    rows += [(200 + i, t, "user", f"same {t}") for i in range(30) for t in range(6)]          # copies
    rows += [(300, t, "user", "long " * (t % 5)) for t in range(120)]                         # a long one
    rows += [(301, t, "user", "long " * (t % 5)) for t in range(90)]
    rows += [(43, 0, "user", "short")]                                                        # fewer turns than its head
    rows += [(-7, 0, None, None), (-20, 0, "user", "below zero"), (5, None, "user", "no number"),
             (5, None, "system", "no number"), (6, 1, "user", "same turn"), (6, 1, "assistant", "same turn"),
             (6, 1, "user", "same turn"), (None, 1, "user", "nobody's"), (7, 2, None, ""), (8, 2, "", None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, b"", 1, "x", 2, 3, 4, 5, "y") for r in rows], SCHEMA)


def test_trie_equals_brute_force_at_any_run_size(spark):
    rows = turns()
    want = brute(rows)
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    for runs in ({}, {"run_keys": 7}, {"run_keys": 1}, {"run_bytes": 100}):
        out = conversation_trie(frame(spark, rows), **runs)
        assert out.columns == cols
        assert sorted((tuple(r) for r in out.collect()), key=str) == want


def test_empty_table_has_no_nodes(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    only_null = frame(spark, [(None, 1, "user", "x")])
    assert conversation_trie(only_null).count() == 0
