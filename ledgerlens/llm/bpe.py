"""BPE encoding and decoding by a tokenization automaton.

``compile_automaton`` starts from the automaton over symbols (every byte symbol
loops on the start state, every word-end symbol leads to the final state) and
applies one merge gadget per merge, in rank order. The gadget of (u, v) acts
where an arc u is followed by an arc v: the state that u leads to loses its arc
v (a copy of it does, if other arcs lead there too), and every state with an arc
u gets an arc uv to where v led. After the last merge the automaton accepts
exactly the token sequences that BPE produces, so a word is encoded by the one
path whose labels spell it. The path is found from left to right by the
transition table: every prefix of the word has one path too, so each position
holds at most one state, and a word of n symbols takes O(n * longest label)
steps, however long it is. Decoding emits the labels.

The table has a bit for each (token, state). The driver builds it from the
vocabulary file and broadcasts it, about 75 MB for 49 thousand tokens; its size
depends on the vocabulary alone, never on the data.

Defined results: a null text is an empty text: no ids, empty decoded text.
Special-token strings in a text are encoded as their ids, as the tokenizers
library does by default. Rows are answered one for one, in place: no shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from ledgerlens.llm.textarrays import runs

#: White space as the vocabulary's pattern language defines \s.
_WS = r"\t-\r \x85\xa0  -     　"
#: Fixed value: the pre-split pattern of the vocabulary.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _WS + r"\p{L}\p{N}]+")
#: The same for texts whose numeric characters are all decimal digits, by the faster module: there
#: a word character is a letter, a decimal digit or the underscore.
_PLAIN_SPLIT = re.compile(r"[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d|\d|(?:[^\w" + _WS + r"]|_)+")

#: Characters that str.split() takes as white space and the vocabulary doesn't.
_CONTROLS = re.compile("[\x1c-\x1f]")

#: Encoded words kept in a worker, in each of two generations.
CACHE_WORDS = 120_000


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class Automaton:
    """Transition table and labels for one vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]], end: str, specials: dict[str, int]):
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols]
        self.specials = specials
        size = max([*vocab.values(), *specials.values()]) + 1
        self.labels = [""] * size
        for s, i in [*vocab.items(), *specials.items()]:
            self.labels[i] = s
        self._compile(vocab, merges, size)
        self.symbols = {b: symbols[b] for b in range(256)}
        self.ids = {s: i for s, i in vocab.items() if self.target[i] >= 0}
        self.end, self.longest = end, max(map(len, self.ids))

    def _compile(self, vocab: dict[str, int], merges: list[list[str]], size: int) -> None:
        start, final = 0, 1
        width = 64
        arcs = np.zeros((size, width), np.uint8)  # bit s of row t: state s has an arc labelled t
        target = [-1] * size  # where arcs labelled t lead
        shared = [0, 0]  # how many labels lead to a state
        for t in self.inner:
            target[t] = start
        for t in self.last:
            target[t] = final
        shared[start], shared[final] = len(self.inner), len(self.last)
        arcs[self.inner + self.last, 0] = 1
        for left, right in merges:
            u, v, uv = vocab[left], vocab[right], vocab[left + right]
            q = target[u]
            if q < 0 or not arcs[v, q >> 3] >> (q & 7) & 1:
                continue  # no arc v follows an arc u any more
            r = target[v]
            if shared[q] > 1 or r == q:
                copy = len(shared)
                if copy >= 8 * width:
                    arcs = np.concatenate([arcs, np.zeros((size, width), np.uint8)], axis=1)
                    width *= 2
                made = arcs[:uv]  # ids are given in the order of the merges: later labels have no arcs yet
                made[:, copy >> 3] |= ((made[:, q >> 3] >> np.uint8(q & 7)) & np.uint8(1)) << np.uint8(copy & 7)
                shared[q] -= 1
                shared.append(1)
                target[u] = copy
            else:
                copy = q
            arcs[v, copy >> 3] &= np.uint8(255 ^ (1 << (copy & 7)))
            arcs[uv] = arcs[u]
            target[uv] = r
            shared[r] += 1
        self.target, self.states = target, len(shared)
        used = (self.states + 7) // 8
        self.rows = [arcs[t, :used].tobytes() for t in range(size)]

    def encode_word(self, word: str) -> list[int]:
        """Labels of the path that spells the word: the longest allowed label first, going back from
        positions without a way on. Each position has one possible state, so it is given up once at most."""
        spelled = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.symbols)
        n, get, rows, target, longest = len(spelled), self.ids.get, self.rows, self.target, self.longest
        ended = spelled + self.end
        dead: set[int] = set()  # positions without a way on
        path: list[int] = []
        begins: list[int] = []
        at, state = 0, 0
        while at < n:
            byte, bit = state >> 3, state & 7
            for k in range(min(n, at + longest), at, -1):
                t = get(spelled[at:k] if k < n else ended[at:])
                if t is not None and rows[t][byte] >> bit & 1 and k not in dead:
                    path.append(t)
                    begins.append(at)
                    at, state = k, target[t]
                    break
            else:
                dead.add(at)
                at = begins.pop()
                path.pop()
                state = target[path[-1]] if path else 0
        return path


def _lower(text: str) -> str:
    """Lower case a character at a time, so without the final form of sigma."""
    return text.replace("Σ", "σ").lower()


class _Ids(dict):
    """Ids of what stands between white space, in two generations: the older goes when the younger is full."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.older = automaton, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            words = SPLIT.findall(chunk)
            if words == [chunk]:
                ids = np.array(self.automaton.encode_word(chunk), "<u4").tobytes()
            else:
                ids = b"".join(map(self.__getitem__, words))
        if len(chunk) <= 64:
            if len(self) >= CACHE_WORDS:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """Whole texts to ids and back."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.ids = _Ids(automaton)
        self.special = regex.compile("(" + "|".join(map(regex.escape, automaton.specials)) + ")") if automaton.specials else None

    def _plain(self, text: str) -> bytes:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = _lower(text)
        chunks = SPLIT.findall(text) if _CONTROLS.search(text) else text.split()
        return b"".join(map(self.ids.__getitem__, chunks))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.special is None or not any(s in text for s in self.automaton.specials):
            return self._plain(text)
        ids = self.automaton.specials
        return b"".join(np.array([ids[p]], "<u4").tobytes() if p in ids else self._plain(p)
                        for p in self.special.split(text) if p)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, joined as the vocabulary's decoder (none) joins them."""
        return " ".join(map(self.automaton.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load_merges(path: str) -> dict:
    """What the automaton needs of a vocabulary file: vocabulary, merges, word end, special tokens."""
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    model = t["model"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges, "end": model["end_of_word_suffix"],
            "specials": {a["content"]: a["id"] for a in t["added_tokens"]}}


@functools.lru_cache(maxsize=2)
def compiled(path: str) -> Automaton:
    """The automaton of a vocabulary file, built once in this process."""
    return Automaton(**load_merges(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True, with_decoded: bool = True) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 and, where asked for, the ids and the decoded text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(compiled(path))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_decoded

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = Encoder(shared.value)
        names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + ["decoded"] * with_decoded
        for pdf in batches:
            texts = pdf[text_col].tolist()
            for first, last in runs(texts):  # ids and decoded texts of a few megabytes at a time
                rows = []
                for text in texts[first:last]:
                    ids = enc.encode(text)
                    decoded = enc.decode(ids)
                    row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                    rows.append(row + (np.frombuffer(ids, "<i4"),) * with_ids + (decoded,) * with_decoded)
                out = pd.DataFrame(rows, columns=names)
                out.insert(0, id_col, pdf[id_col].iloc[first:last].reset_index(drop=True))
                yield out

    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInPandas(work, schema)
