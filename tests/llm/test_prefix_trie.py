"""The conversation trie by radix trees over ranges, held against all prefixes."""

import hashlib
import random

import pytest

from ledgerlens.llm import prefix_trie as pt

from . import brute

SCHEMA = "conv_id long, turn long, role string, text string, head int, d string, n long, part int, sha long"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:pt.WIDTH]


def random_convs(seed, n, depth=6, choices=3):
    r = random.Random(seed)
    texts = [" ".join("word" for _ in range(k)) + f" {k}" for k in range(choices)]
    return {c * 3 - 20: [(r.choice(("user", "assistant")), r.choice(texts)) for _ in range(r.randint(0, depth))] for c in range(n)}


def folded(convs):
    """Distinct sequences as the trees take them, sorted by key."""
    by_key = {}
    for c, ts in convs.items():
        key = b"".join(turn_id(*t) for t in ts)
        words = b"".join(len(brute.WORD.findall(t[1])).to_bytes(pt.COUNT, "big") for t in ts)
        by_key.setdefault(key, (words, []))[1].append(c)
    return [(k, w, len(cs), min(cs), hashlib.sha256(",".join(map(str, sorted(cs))).encode()).hexdigest()) for k, (w, cs) in sorted(by_key.items())]


@pytest.mark.parametrize("block", [1, 2, 7, 40, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_merge_to_the_whole_trie(block, seed):
    convs = random_convs(seed, 300)
    seqs = folded(convs)
    rows = []
    for part, a in enumerate(range(0, len(seqs), block)):
        rows += pt._trie_rows(seqs[a:a + block], part)
    done, paths = [r for r in rows if r[0] is None], [r for r in rows if r[0] is not None]
    while paths:
        groups = {}
        for r in paths:
            groups.setdefault(r[0] // 3, []).append(r)
        merged = [x for g, rs in groups.items() for x in pt._merge_paths(rs, g, len(groups) == 1)]
        done += [r for r in merged if r[0] is None]
        paths = [r for r in merged if r[0] is not None]
    conv_of = {r[pt._NAMES.index("d")]: r[pt._CONV] for r in done}
    got = sorted(((r[pt._CONV], r[pt._DEPTH], conv_of[r[pt._PARENT]] if r[pt._PARENT] else r[pt._PARENT_CONV], r[pt._N], r[pt._CHILDREN],
                   r[pt._LEAVES], r[pt._SAVED], r[pt._SHA] or pt.NO_IDS) for r in done), key=repr)
    assert got == brute.prefix_trie(convs)


def test_layouts_grow_and_find():
    for n in (4, 5, 16, 17, 48, 49, 256):
        tree = pt.Tree()
        keys = [bytes([b]) + bytes(3) for b in random.Random(n).sample(range(256), n)]
        for i, k in enumerate(keys):
            tree.insert(k, i)
        assert tree.root.size == next(s for s in (4, 16, 48, 256) if s >= n)
        assert [tree.root.find(k[0]).end for k in keys] == list(range(n)) and len(tree.root.children()) == n
        assert n == 256 or tree.root.find(next(b for b in range(256) if bytes([b]) + bytes(3) not in keys)) is None
    tree = pt.Tree()
    for i, k in enumerate((b"abcdef", b"abcxyz", b"abc", b"", b"abcdez")):
        tree.insert(k, i)
    a = tree.root.find(ord("a"))
    assert (tree.root.end, a.prefix, a.end, a.find(ord("d")).prefix, a.find(ord("x")).end) == (3, b"bc", 2, b"e", 1)


def found(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.sha) for r in df.collect()), key=repr)


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA).repartition(parts)


def test_conversations(spark):
    r = random.Random(8)
    rows = [(c, i, *t) for c, ts in random_convs(5, 260).items() for i, t in enumerate(ts)]
    common = [("user", "hello  there"), ("assistant", "yes\n\nyes yes"), ("user", "bye")]
    rows += [(2000 + c, i, *t) for c in range(400) for i, t in enumerate(common[:r.choice((1, 3, 3, 3))])]
    rows += [(5000, None, None, None), (5000, 0, "user", "x"), (5000, 0, "user", "x"), (5000, 0, "system", None), (5000, None, "user", ""),
             (None, 1, "user", "lost"), (-45, 0, "user", "hello  there"), (-40, 1, "user", "y" * 70_000), (5003, 0, "a", "b:c"), (5004, 0, "a:", "bc")]
    rows += [(7000, i, "user", f"turn {i % 7}") for i in range(1500)]
    assert found(pt.nodes(pt.sequences(frame(spark, rows)))) == brute.prefix_trie(brute.rebuilt(rows))
    assert found(pt.nodes(pt.sequences(frame(spark, rows), group=None))) == brute.prefix_trie(brute.rebuilt(rows, group=None))


def test_common_conversation_in_blocks(spark):
    """More holders than a block has, in several tasks: their hash is that of all ids in order."""
    n = 3 * pt.BLOCK_IDS
    ids = spark.range(n).selectExpr("id * 2 as conv_id", "0 as turn", "'user' as role", "'hi there' as text")
    got = {r.depth: r for r in pt.nodes(pt.sequences(ids, group=None)).collect()}
    assert got[1].n_convs == n and got[1].saved_tokens == 2 * (n - 1)
    assert got[1].sha == hashlib.sha256(",".join(str(2 * i) for i in range(n)).encode()).hexdigest()


def test_empty(spark):
    assert pt.nodes(pt.sequences(frame(spark, []))).collect() == []
    only_root = found(pt.nodes(pt.sequences(frame(spark, [(7, 0, "user", "a b")], 1))))
    assert only_root[0][:2] == (7, 0)
