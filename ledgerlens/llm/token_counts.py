"""Token counts that follow edits.

A document's tree keeps its pre-tokens in leaves of about ``LEAF`` pieces, with sums
of characters and tokens in a binary tree above them. An edit descends the character sums to the
last piece boundary that it cannot influence, splits the new text from there until a
boundary falls on an old one behind the edit, encodes only those pieces, and
updates the sums above the leaves it touched. The pre-split pattern looks at no
text before a match and at most two characters behind it (``LOOK``), so what lies
outside that region splits as before.

The tree is a column of plain arrays: build it once, write it with the table,
and apply batches of edits to it. Everything is local to a row, no shuffle.

Defined results: a null text is an empty text with an empty tree. Null or empty
edit lists change nothing; null replacements insert nothing; a null start is the text's beginning, and a null end or a position beyond the text its
end. Rows are answered one for one, repeated ones alike, so ties cannot arise; an empty table gives no rows. A very long text takes
about a hundred bytes of lists a piece. Further columns pass; those named ``tree`` or ``edited`` are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 64
#: Characters behind a piece that its match can depend on.
LOOK = 3
#: Bytes of counted pieces kept in a worker, with what an entry of a dictionary takes besides its text.
CACHE_BYTES = 16 << 20
ENTRY_BYTES = 160

TREE = "struct<chars:binary,tokens:binary,leaves:array<int>,sum_chars:array<int>,sum_tokens:array<int>>"
EDITS = "array<struct<start:int,end:int,text:string>>"


class Counter(dict):
    """Tokens of each pre-token, by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.held = 0

    def __missing__(self, piece: str) -> int:
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) <= 64:
            if self.held >= CACHE_BYTES:
                self.clear()
                self.held = 0
            self[piece] = n
            self.held += ENTRY_BYTES + len(piece)
        return n


class TokenTree:
    """Pieces of a text in leaves, and sums of characters and tokens above them (heap order, root at 1)."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray, leaves: list[int] | None = None,
                 sum_chars: list[int] | None = None, sum_tokens: list[int] | None = None):
        if leaves is None:
            leaves = [min(LEAF, len(chars) - a) for a in range(0, len(chars), LEAF)] or [0]
        ends = np.cumsum(leaves).tolist()
        self.leaf_chars = [chars[e - n : e].tolist() for e, n in zip(ends, leaves, strict=True)]
        self.leaf_tokens = [tokens[e - n : e].tolist() for e, n in zip(ends, leaves, strict=True)]
        self.width = 1 << max(len(leaves) - 1, 0).bit_length()
        if sum_chars is None:
            self.sum_chars, self.sum_tokens = [0] * (2 * self.width), [0] * (2 * self.width)
            for k in range(len(leaves)):
                self.sum_chars[self.width + k] = sum(self.leaf_chars[k])
                self.sum_tokens[self.width + k] = sum(self.leaf_tokens[k])
            for k in range(self.width - 1, 0, -1):
                self._sum(k)
        else:
            self.sum_chars, self.sum_tokens = list(sum_chars), list(sum_tokens)

    def _sum(self, k: int) -> None:
        self.sum_chars[k] = self.sum_chars[2 * k] + self.sum_chars[2 * k + 1]
        self.sum_tokens[k] = self.sum_tokens[2 * k] + self.sum_tokens[2 * k + 1]

    @property
    def n_tokens(self) -> int:
        return self.sum_tokens[1]

    @property
    def n_pieces(self) -> int:
        return sum(map(len, self.leaf_chars))

    def find(self, place: int) -> tuple[int, int, int]:
        """(leaf, piece in it, where the piece starts) of the piece that holds character ``place`` (or the end)."""
        k, start = 1, 0
        while k < self.width:
            k *= 2
            if place >= start + self.sum_chars[k] and k + 1 < 2 * self.width and self._holds(k + 1):
                start += self.sum_chars[k]
                k += 1
        leaf = k - self.width
        for i, n in enumerate(self.leaf_chars[leaf]):
            if place < start + n:
                return leaf, i, start
            start += n
        return leaf, len(self.leaf_chars[leaf]), start

    def _holds(self, k: int) -> bool:
        """Whether node k has a leaf below it that exists."""
        while k < self.width:
            k *= 2
        return k - self.width < len(self.leaf_chars)

    def edit(self, text: str, start: int, end: int, new: str, counter: Counter) -> tuple[str, int]:
        """The text after an edit and the number of pieces encoded for it; the tree follows."""
        start = max(0, min(start, len(text)))
        end = max(start, min(end, len(text)))
        after = text[:start] + new + text[end:]
        moved = len(new) - (end - start)
        leaf, piece, at = self.find(max(0, start - LOOK))
        first_leaf, first_piece = leaf, piece
        old = at  # old boundary that (leaf, piece) begins at
        chars, tokens, behind = [], [], start + len(new)
        pos = at
        while True:
            while old < pos - moved and leaf < len(self.leaf_chars):
                if piece < len(self.leaf_chars[leaf]):
                    old += self.leaf_chars[leaf][piece]
                    piece += 1
                else:
                    leaf, piece = leaf + 1, 0
            if pos >= behind and old == pos - moved and old >= end:
                break
            if pos >= len(after):
                leaf, piece = len(self.leaf_chars), 0
                break
            m = counter.pattern.match(after, pos)
            chars.append(m.end() - pos)
            tokens.append(counter[m[0]])
            pos = m.end()
        self._replace(first_leaf, first_piece, leaf, piece, chars, tokens)
        return after, len(chars)

    def _replace(self, leaf: int, piece: int, to_leaf: int, to_piece: int, chars: list[int], tokens: list[int]) -> None:
        last = min(to_leaf, len(self.leaf_chars) - 1)
        kept = to_piece if to_leaf == last else len(self.leaf_chars[last])
        for lists, fresh in ((self.leaf_chars, chars), (self.leaf_tokens, tokens)):
            tail = lists[last][kept:]
            head = lists[leaf][:piece]
            for k in range(leaf + 1, last + 1):
                lists[k] = []
            lists[leaf] = head + fresh + tail
        if len(self.leaf_chars[leaf]) > 8 * LEAF:
            self.__init__(np.array([c for x in self.leaf_chars for c in x]), np.array([c for x in self.leaf_tokens for c in x]))
            return
        touched = set(range(self.width + leaf, self.width + last + 1))
        for k in touched:
            self.sum_chars[k] = sum(self.leaf_chars[k - self.width])
            self.sum_tokens[k] = sum(self.leaf_tokens[k - self.width])
        while touched != {1}:
            touched = {k // 2 for k in touched if k > 1}
            for k in touched:
                if k:
                    self._sum(k)
            touched.discard(0)
            if not touched:
                break

    def packed(self) -> dict:
        flat = lambda x: np.array([c for y in x for c in y], "<u4").tobytes()
        return {"chars": flat(self.leaf_chars), "tokens": flat(self.leaf_tokens), "leaves": list(map(len, self.leaf_chars)),
                "sum_chars": self.sum_chars, "sum_tokens": self.sum_tokens}

    @classmethod
    def unpacked(cls, x: dict) -> TokenTree:
        return cls(np.frombuffer(x["chars"], "<u4"), np.frombuffer(x["tokens"], "<u4"), list(x["leaves"]),
                   list(x["sum_chars"]), list(x["sum_tokens"]))


def tree_of(text: str | None, counter: Counter) -> TokenTree:
    pieces = counter.pattern.findall(text or "")
    n = len(pieces)
    return TokenTree(np.fromiter(map(len, pieces), np.int64, n), np.fromiter(map(counter.__getitem__, pieces), np.int64, n))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _counter(shared) -> Counter:
    return Counter(*shared.value)


def build(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``tree``, its token tree."""
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))

    @F.pandas_udf(TREE)
    def trees(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = _counter(shared)
        for texts in batches:
            yield pd.DataFrame([tree_of(t, counter).packed() for t in texts],
                               columns=["chars", "tokens", "leaves", "sum_chars", "sum_tokens"])

    return docs.withColumn("tree", trees.asNondeterministic()(F.col(f"`{text_col}`")))


def _place(x: float | None, missing: int) -> int:
    """A position as pandas hands it over: beside a null one, integers come as floats and the null as NaN."""
    return missing if x is None or x != x else int(x)


def _edited(tree: TokenTree, text: str | None, edits, counter: Counter) -> tuple[str, int]:
    """The text after the edits, and the pieces that were encoded for them; the tree follows."""
    text, n = text or "", 0
    for e in (() if edits is None else edits):
        text, k = tree.edit(text, _place(e["start"], 0), _place(e["end"], len(text)), e["text"] or "", counter)
        n += k
    return text, n


_COUNTS = ["n_before", "n_tokens", "n_pieces", "n_encoded"]


def build_and_edit(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", edits_col: str = "edits",
                   with_tree: bool = True) -> DataFrame:
    """``docs`` with ``edited``, as ``apply_edits`` of ``build`` gives it, in one pass with one counter a worker.

    Each tree is built, edited and, without ``with_tree``, dropped in its task: only the counts leave it.
    """
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))
    kept = ["text", "tree"] if with_tree else []

    @F.pandas_udf((f"text string, tree {TREE}, " if with_tree else "") + ", ".join(f"{c} long" for c in _COUNTS))
    def edited(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = _counter(shared)
        for texts, edits in batches:
            out = []
            for text, todo in zip(texts, edits, strict=True):
                tree = tree_of(text, counter)
                before = tree.n_tokens
                text, n = _edited(tree, text, todo, counter)
                out.append((*((text, tree.packed()) if with_tree else ()), before, tree.n_tokens, tree.n_pieces, n))
            yield pd.DataFrame(out, columns=kept + _COUNTS)

    return docs.withColumn("edited", edited.asNondeterministic()(F.col(f"`{text_col}`"), F.col(f"`{edits_col}`")))


def apply_edits(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", tree_col: str = "tree",
                edits_col: str = "edits") -> DataFrame:
    """``docs`` with ``edited``: the text after the edits, its tree, and how many pieces were encoded anew.

    Edits are (start, end, text) in code points, each in the coordinates of the
    text that the edits before it left.
    """
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))

    @F.pandas_udf(f"text string, tree {TREE}, n_before long, n_tokens long, n_pieces long, n_encoded long")
    def edited(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = _counter(shared)
        for texts, trees, edits in batches:
            out = []
            for text, packed, todo in zip(texts, trees.to_dict("records"), edits, strict=True):
                tree = TokenTree.unpacked(packed)
                before = tree.n_tokens
                text, n = _edited(tree, text, todo, counter)
                out.append((text, tree.packed(), before, tree.n_tokens, tree.n_pieces, n))
            yield pd.DataFrame(out, columns=["text", "tree", *_COUNTS])

    return docs.withColumn("edited", edited.asNondeterministic()(F.col(f"`{text_col}`"), F.col(tree_col), F.col(edits_col)))
