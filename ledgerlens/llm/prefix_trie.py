"""Conversation prefix trie: adaptive radix trees over turn ids, one for each range of conversations.

A turn's id is 16 big-endian bytes of the SHA-256 of ``{length of role}:{role}{text}``; a conversation's key is its turns'
ids in a row, so texts do not pass a shuffle. ``sequences`` makes the keys, ``nodes`` the trie of all of them.

1. Equal keys are folded: a range sort by (key digest, conversation) spreads a common conversation over tasks; each packs its runs
   of ids into blocks, and only the blocks of digests that cross a task's edge are brought together, to be hashed in a stream.
2. The distinct keys are range partitioned and sorted, and each task puts runs of them into an adaptive radix tree
   (``Tree``): nodes of 4, 16, 48 or 256 children that grow, compressed paths, an end mark where a key stops. Where the
   byte depth is a multiple of 16 a trie node is emitted, several of them along a compressed path.
3. A range of sorted keys holds all conversations of a trie node unless the node lies on the path of the range's first or
   last key. The nodes of these two paths leave their task as partial rows; ``FAN`` neighbouring ranges
   at a time are merged, which completes all nodes but those on two paths again, until one range is left. No group of conversations
   with a common prefix is ever brought together for its size: a task holds its block, or ``2 * FAN`` paths.
4. Rows whose parent was such a path node look up its conversation in the (few) path nodes.

A conversation (its turns' ids, 20 bytes a turn) has to fit a task's memory.

Defined results. Null role or text: empty. Rows are ordered by turn, null turns first, and ties by turn id; repeated
rows are repeated turns. Rows with a null conversation id belong to no conversation and are left out. Empty and very long texts
are turns like others, only their digest and count of words go on. A conversation that is rebuilt without turns is a member of
the root. Empty table: no rows, not even a root. Only the four named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, discard, partitions, written

#: Bytes of a turn id.
WIDTH = 16
#: Bytes of a turn's count of words.
COUNT = 4
#: Key bytes of one tree, and of one range of keys (a task builds its trees one after the other).
TREE_BYTES, RANGE_BYTES = 4 << 20, 64 << 20
#: Ids in a block of a conversation's holders.
BLOCK_IDS = 8192
#: Ranges merged in one task.
FAN = 64
ROOT = bytes(WIDTH)
NO_IDS = hashlib.sha256(b"").hexdigest()


def _next_digest(before: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(before + turn, digest_size=WIDTH).digest()


def key_digest(key: bytes) -> bytes:
    """The digest of a sequence: each prefix's digest is made of that of the prefix one turn shorter."""
    d = ROOT
    for a in range(0, len(key), WIDTH):
        d = _next_digest(d, key[a:a + WIDTH])
    return d


# ------------------------------------------------------------ sequences ----

def sequences(conversations: DataFrame, group: int | None = 20, heads: int = 4) -> DataFrame:
    """(conv_id, key, words, d): the key of each conversation, its turns' counts of words and its digest.

    With ``group`` each conversation c is rebuilt: the first h = crc32(c) % heads turns of conversation c - c % group, then its own after
    the first h. All of a group's turns go to one task, sorted by conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    c = F.col("conv_id").cast("long")
    size = group or 1
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        (c - c % size).alias("head"), c.alias("conv_id"), "turn",
        F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH)).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("int").alias("n"))
    by_group = turns.repartition("head").sortWithinPartitions(
        "head", F.col("conv_id") != F.col("head"), "conv_id", F.asc_nulls_first("turn"), "id")
    return by_group.drop("turn").mapInArrow(_rebuild(heads if group else 1), "conv_id long, key binary, words binary, d binary")


def _rebuild(heads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        of, own, counts = None, [], []
        head_of, head, head_counts = None, b"", b""

        def finished():
            nonlocal head_of, head, head_counts
            first, c = of
            key, words = b"".join(own), b"".join(counts)
            if first != head_of:
                head_of, head, head_counts = first, b"", b""
            if c == first:
                head, head_counts = key[:(heads - 1) * WIDTH], words[:(heads - 1) * COUNT]
            h = zlib.crc32(str(c).encode()) % heads
            key = head[:h * WIDTH] + key[h * WIDTH:]
            return c, key, head_counts[:h * COUNT] + words[h * COUNT:], key_digest(key)

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                                              ["conv_id", "key", "words", "d"])
        for batch in batches:
            for first, c, turn, n in zip(*(batch.column(x).to_pylist() for x in ("head", "conv_id", "id", "n")), strict=True):
                if of != (first, c):
                    if of is not None:
                        out.append(finished())
                        size += len(out[-1][1]) + 64
                        if size > TREE_BYTES:
                            yield batch_of(out)
                            out, size = [], 0
                    of, own, counts = (first, c), [], []
                own.append(turn)
                counts.append(n.to_bytes(COUNT, "big"))
        if of is not None:
            out.append(finished())
            yield batch_of(out)
    return run


# ----------------------------------------------------------- equal keys ----

_HOLDERS = "d binary, n long, least long, ids binary, sha string"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (d, conv_id) rows the holders of each digest: their hash where all are here, else blocks of ids."""
    rows, of, ids, whole = [], None, [], False

    def add(last: bool):
        # a run that began in this task and ends in it is whole
        text = ",".join(map(str, ids)).encode()
        if last and whole:
            rows.append((of, len(ids), ids[0], None, hashlib.sha256(text).hexdigest()))
        else:
            rows.append((of, len(ids), ids[0], text, None))
    for batch in batches:
        for d, c in zip(batch.column("d").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if d != of:
                if ids:
                    add(True)
                of, ids, whole = d, [], of is not None
            elif len(ids) == BLOCK_IDS:
                whole = False
                add(False)
                ids = []
            ids.append(c)
        if len(rows) > 4096:
            yield _holders(rows)
            rows = []
    if ids:
        add(False)
    if rows:
        yield _holders(rows)


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of blocks sorted by digest and first id the hash of all ids, a block at a time."""
    rows, of, n, least, sha = [], None, 0, None, None
    for batch in batches:
        for d, k, first, ids in zip(*(batch.column(x).to_pylist() for x in ("d", "n", "least", "ids")), strict=True):
            if d != of:
                if of is not None:
                    rows.append((of, n, least, None, sha.hexdigest()))
                of, n, least, sha = d, 0, first, hashlib.sha256()
            elif n:
                sha.update(b",")
            sha.update(ids)
            n += k
        if len(rows) > 4096:
            yield _holders(rows)
            rows = []
    if of is not None:
        rows.append((of, n, least, None, sha.hexdigest()))
        yield _holders(rows)


def _holders(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      ["d", "n", "least", "ids", "sha"])


def holders(seqs: DataFrame) -> DataFrame:
    """(d, n, least, sha) of each distinct sequence: how many conversations are it, the least, and the hash of all their ids."""
    packed = written(seqs.select("d", "conv_id").repartitionByRange("d", "conv_id").sortWithinPartitions("d", "conv_id")
                     .mapInArrow(_pack, _HOLDERS), "holders")
    blocks = packed.where(F.col("sha").isNull()).repartition("d").sortWithinPartitions("d", "least")
    return packed.where(F.col("sha").isNotNull()).unionByName(blocks.mapInArrow(_join_blocks, _HOLDERS)).drop("ids")


# ---------------------------------------------------------- radix trees ----

class _Node:
    """A node of up to 4, 16, 48 or 256 children. ``keys`` are the child bytes to search, for 48 an index of places, for 256 nothing."""

    __slots__ = ("prefix", "rep", "end", "size", "keys", "kids")

    def __init__(self, prefix: bytes, rep: int, end: int = -1):
        self.prefix, self.rep, self.end = prefix, rep, end
        self.size, self.keys, self.kids = 4, bytearray(), []

    def _place(self, byte: int) -> int:
        if self.size <= 16:
            return self.keys.find(byte)
        return self.keys[byte] - 1 if self.size == 48 else byte

    def find(self, byte: int) -> _Node | None:
        at = self._place(byte)
        return None if at < 0 else self.kids[at]

    def replace(self, byte: int, child: _Node) -> None:
        self.kids[self._place(byte)] = child

    def add(self, byte: int, child: _Node) -> None:
        if self.size < 256 and len(self.kids) == self.size:
            self._grow()
        if self.size == 256:
            self.kids[byte] = child
            return
        self.kids.append(child)
        if self.size == 48:
            self.keys[byte] = len(self.kids)
        else:
            self.keys.append(byte)

    def _grow(self) -> None:
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            index = bytearray(256)
            for at, byte in enumerate(self.keys):
                index[byte] = at + 1
            self.size, self.keys = 48, index
        else:
            kids = [None] * 256
            for byte in range(256):
                if self.keys[byte]:
                    kids[byte] = self.kids[self.keys[byte] - 1]
            self.size, self.keys, self.kids = 256, bytearray(), kids

    def children(self) -> list[_Node]:
        return self.kids if self.size < 256 else [k for k in self.kids if k is not None]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class Tree:
    """An adaptive radix tree over byte keys, each with the number under which it was put in."""

    def __init__(self):
        self.root = _Node(b"", 0)

    def insert(self, key: bytes, number: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.find(key[at])
            if child is None:
                node.add(key[at], _Node(key[at + 1:], number, number))
                return
            rest = key[at + 1:at + 1 + len(child.prefix)]
            m = _common(child.prefix, rest)
            if m < len(child.prefix):
                upper = _Node(child.prefix[:m], child.rep)
                upper.add(child.prefix[m], child)
                child.prefix = child.prefix[m + 1:]
                node.replace(key[at], upper)
                child = upper
            node, at = child, at + 1 + m
        node.end = number


#: Rows of the trie. A partial row (``part`` not null) lies on the path of its range's first or last key: its counts are those
#: of its complete children only. ``parent`` is the digest of a parent whose conversation is not known yet.
_ROWS = ("part int, first boolean, last boolean, d binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, n_words long, sha string")
_PARENT, _DEPTH, _CONV, _PARENT_CONV, _N, _CHILDREN, _LEAVES, _SAVED, _WORDS, _SHA = range(4, 14)
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]
_TYPES = [{"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in _ROWS.split(", ")]


def _trie_rows(seqs: list[tuple], part: int) -> list[list]:
    """Rows of the trie nodes of sorted sequences (key, words, n, least, sha), those on the first and last path partial."""
    tree = Tree()
    for i, s in enumerate(seqs):
        tree.insert(s[0], i)
    rows: list[list] = []
    final = len(seqs) - 1
    # a frame: node, byte depth of its end, (depth, digest) of the turn-aligned depths from the last one above its edge down,
    # children left, what is below it: [conversations, least one, children, leaves, saved tokens, rows that wait for their
    # parent, least and greatest sequence]
    stack = [_frame(tree.root, 0, [(0, ROOT)], seqs)]
    while stack:
        node, end, marks, kids, below = stack[-1]
        if kids:
            child = kids.pop()
            stack.append(_frame(child, end + 1 + len(child.prefix), marks[-1:], seqs))
            continue
        stack.pop()
        n, least, children, leaves, saved, waiting, lo, hi = below
        words = seqs[node.rep][1]
        for at in range(len(marks) - 1, 0 if stack else -1, -1):
            depth, d = marks[at]
            count = int.from_bytes(words[(depth - 1) * COUNT:depth * COUNT], "big") if depth else 0
            sha = seqs[node.end][4] if node.end >= 0 and depth * WIDTH == end else None
            if lo == 0 or hi == final:
                for r in waiting:
                    rows[r][_PARENT] = d
                rows.append([part, lo == 0, hi == final, d, marks[at - 1][1] if depth else None, depth, least, None,
                             n, children, leaves, saved, count, sha])
                children = leaves = saved = 0
                waiting = []
            else:
                for r in waiting:
                    rows[r][_PARENT_CONV] = least
                leaves = leaves or 1
                saved += (n - 1) * count
                waiting = [len(rows)]
                rows.append([None, None, None, None, None, depth, least, None, n, children, leaves, saved, count, sha])
                children = 1
        if stack:
            into = stack[-1][4]
            into[0] += n
            into[1] = least if into[1] is None else min(into[1], least)
            for k, x in ((2, children), (3, leaves), (4, saved)):
                into[k] += x
            into[5] += waiting
            into[6], into[7] = min(into[6], lo), max(into[7], hi)
    return rows


def _frame(node: _Node, end: int, marks: list[tuple[int, bytes]], seqs: list[tuple]) -> tuple:
    key = seqs[node.rep][0]
    marks = list(marks)
    for depth in range(marks[0][0] + 1, end // WIDTH + 1):
        marks.append((depth, _next_digest(marks[-1][1], key[(depth - 1) * WIDTH:depth * WIDTH])))
    below = [0, None, 0, 0, 0, [], len(seqs), -1]
    if node.end >= 0:
        below = [seqs[node.end][2], seqs[node.end][3], 0, 0, 0, [], node.end, node.end]
    return node, end, marks, list(node.children()), below


# ---------------------------------------------------------------- merge ----

def _merge_paths(rows: list[list], part: int, last_round: bool) -> list[list]:
    """Partial rows of neighbouring ranges, merged: complete but for those on the first path of the first and the last of the last."""
    first_part, last_part = min(r[0] for r in rows), max(r[0] for r in rows)
    nodes: dict[bytes, list] = {}
    for r in rows:
        first, last = bool(r[1]) and r[0] == first_part, bool(r[2]) and r[0] == last_part
        got = nodes.get(r[3])
        if got is None:
            nodes[r[3]] = [part, first, last, *r[3:]]
            continue
        got[1], got[2] = got[1] or first, got[2] or last
        got[_CONV] = min(got[_CONV], r[_CONV])
        for k in range(_N, _WORDS):
            got[k] += r[k]
        got[_SHA] = got[_SHA] if r[_SHA] is None else r[_SHA]
    for r in sorted(nodes.values(), key=lambda r: -r[_DEPTH]):
        if (r[1] or r[2]) and not last_round:
            continue
        r[0] = r[1] = r[2] = None
        r[_LEAVES] = r[_LEAVES] or 1
        r[_SAVED] += (r[_N] - 1) * r[_WORDS]
        up = nodes.get(r[_PARENT])
        if up is not None:
            up[_CHILDREN] += 1
            up[_LEAVES] += r[_LEAVES]
            up[_SAVED] += r[_SAVED]
    return list(nodes.values())


def _merge(last_round: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        merged = _merge_paths(rows[_NAMES].astype(object).where(rows[_NAMES].notna(), None).values.tolist(), int(key[0]), last_round)
        return pd.DataFrame(merged, columns=_NAMES, dtype=object)
    return run


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trie rows of a range of sorted sequences, a tree of some megabytes at a time; one set of partial rows for the range."""
    part = TaskContext.get().partitionId()
    paths: list[list] = []

    def tree(seqs):
        nonlocal paths
        rows = _trie_rows(seqs, 1)
        merged = _merge_paths(paths + [r for r in rows if r[0] is not None], 0, False)
        paths = [r for r in merged if r[0] is not None]
        return [r for r in rows if r[0] is None] + [r for r in merged if r[0] is None]
    seqs, size = [], 0
    for batch in batches:
        for s in zip(*(batch.column(x).to_pylist() for x in ("key", "words", "n", "least", "sha")), strict=True):
            if size > TREE_BYTES:
                if rows := tree(seqs):
                    yield _batch(rows)
                seqs, size = [], 0
            seqs.append(s)
            size += len(s[0]) + 4 * WIDTH
    if seqs:
        rows = tree(seqs)
        yield _batch(rows + [[part, *r[1:]] for r in paths])


def nodes(seqs: DataFrame) -> DataFrame:
    """The trie of ``sequences``: a row of each distinct sequence of first turns. ``conv_id`` is the least of its members,
    ``parent_conv_id`` that of its parent, ``sha`` the hash of the ids of those that end there."""
    seqs = written(seqs, "sequences", release=True)
    distinct = holders(seqs).withColumnRenamed("d", "of").join(seqs, F.col("conv_id") == F.col("least")).select("key", "words", "n", "least", "sha")
    distinct = written(distinct, "distinct-sequences", release=True)
    size = distinct.agg(F.sum(F.length("key") + 4 * WIDTH)).first()[0] or 0
    ranges = max(partitions(seqs.sparkSession), -(-size // RANGE_BYTES))
    rows = written(distinct.repartitionByRange(ranges, "key").sortWithinPartitions("key").mapInArrow(_trees, _ROWS), "trie-rows", release=True)
    discard(seqs, distinct)
    done, paths = [rows.where("part is null")], rows.where("part is not null")
    top = paths.agg(F.max("part")).first()[0]
    while top is not None:
        one = top < FAN
        merged = written(paths.groupBy((F.col("part") / FAN).cast("int").alias("of")).applyInPandas(_merge(one), _ROWS), "trie-paths")
        done.append(merged.where("part is null"))
        paths, top = merged.where("part is not null"), None if one else top // FAN
    everything = done[0]
    for more in done[1:]:
        everything = everything.unionByName(more)
    ways = everything.where(F.col("d").isNotNull()).select(F.col("d").alias("parent"), F.col("conv_id").alias("its_conv"))
    found = (everything.where(F.col("parent").isNotNull()).join(ways, "parent")
             .withColumn("parent_conv_id", F.col("its_conv")).select(everything.columns))
    return everything.where(F.col("parent").isNull()).unionByName(found).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(NO_IDS)).alias("sha"))
