"""PII replacement by keyed, type-consistent surrogates.

Entities: email addresses, phone numbers, IPv4 addresses, card numbers (13 to 19 digits with a
valid check digit; other numbers are left alone), social security numbers and personal names (a given
name of the lexicon before a capitalised surname, or a surname after a title). A surrogate is the
image of the entity's canonical form under a keyed permutation of its format: digits stay
digits, vowels vowels, consonants consonants, in the same script and letter case; check digits
are made valid where they were; a given name becomes another of its gender and script. So equal entities get equal
surrogates in the whole corpus, and different entities of a format differ, with nothing to look up.

Names are read from whole runs of capitalised words ('Mr. John Michael Smith': the lexicon's names but the
last word are given names, the others surnames; titles and initials stay). Each word so found is then
replaced wherever the same text has it as a capitalised word of its own, so later mentions of parts of a name
keep referring to it.

Collisions are checked over the corpus: the distinct entities (combined on the map side) are
written with their surrogates, and a surrogate that equals a real entity or another one's surrogate sends
its entity to the next attempt of the permutation until none is left. An entity without a character to
permute, and one that finds no free image in ``ATTEMPTS`` rounds, gets a longer format: keyed characters are
appended, more with each attempt, under the same check. As these get longer each time, an entity meets a taken
one only finitely often and the rounds end. Only documents that hold such an entity get
its attempt by a join; every other text is rewritten where it is read.

Defined results: null texts stay null, empty ones empty. Rows are answered one for one, repeated rows
alike. An empty table gives an empty result. Columns other than the text are passed through.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import split_by_filter, written

# Given names by gender and script.
NAMES = {
    ("f", "latin"): """Anna Maria Emma Sofia Laura Julia Sarah Elena Clara Alice Lucia Carmen Camille Chloe Ingrid Helga
Monika Petra Susanne Isabelle Margaret Elizabeth Jennifer Patricia Linda Barbara""".split(),
    ("m", "latin"): """John James Robert Michael William David Thomas Daniel Peter Paul Martin Stefan Klaus Juergen Pierre
Michel Antoine Carlos Pedro Miguel Javier Antonio Francisco Henri Louis George""".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("m", "cyrillic"): "Иван Сергей Дмитрий Алексей Андрей Михаил Николай Владимир Павел Борис".split(),
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Σοφία Ιωάννα Βασιλική".split(),
    ("m", "greek"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παναγιώτης".split(),
}
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora".split()
#: Alphabets of the permutations: a character maps within its own.
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αειουηω", "βγδζθκλμνξπρστφχψ",
           "áéíóú", "äöü", "àèìòù")
_PLACE = {c: (a, i) for a, letters in enumerate(CLASSES) for i, c in enumerate(letters)}
_GIVEN = {n.lower(): g for g, names in NAMES.items() for n in names}

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)", re.ASCII)
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\w)", re.ASCII)
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII)
_CARD = re.compile(r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-])", re.ASCII)
_CAPITAL = "[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]"
_NAMES = re.compile(rf"(?<!\w){_CAPITAL}\w*(?:(?:\.?[ ]|-){_CAPITAL}\w*)+")
_TOKEN = re.compile(r"(\w+)(\.?)")
_WORD = re.compile(rf"(?<!\w){_CAPITAL}\w+")

KINDS = ("email", "ip", "phone", "ssn", "card", "given", "surname")
#: Rounds within the entity's own format.
ATTEMPTS = 32

Span = tuple[int, int, str, str]


def _luhn(digits: str) -> int:
    """Sum of the check-digit rule modulo 10: 0 if valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def detect(text: str | None) -> list[Span]:
    """Non-overlapping (start, end, kind, canonical form), in order."""
    if not text:
        return []
    found: list[Span] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    if any(c in text for c in "0123456789"):
        found += [(m.start(), m.end(), "ip", m[0]) for m in _IP.finditer(text)]
        found += [(m.start(), m.end(), "phone", _digits(m[0])) for m in _PHONE.finditer(text)]
        found += [(m.start(), m.end(), "ssn", _digits(m[0])) for m in _SSN.finditer(text)]
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if _luhn(d) == 0:
                found.append((m.start(), m.end(), "card", d))
    found += _names(text)
    found.sort(key=lambda x: (x[0], -x[1]))
    out: list[Span] = []
    for x in found:
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return _with_mentions(text, out)


def _names(text: str) -> list[Span]:
    """Given names and surnames in the runs of capitalised words that hold a title or a given name before a word."""
    found: list[Span] = []
    for run in _NAMES.finditer(text):
        named, titled, words = False, False, list(_TOKEN.finditer(run[0]))
        for k, m in enumerate(words):
            word, dot = m[1], m[2]
            if word in TITLES:
                titled = True
                continue
            if len(word) == 1:
                continue  # an initial
            # the run goes on to a further word of the name
            more = not dot and any(len(x[1]) > 1 and x[1] not in TITLES for x in words[k + 1 : k + 2 + (
                k + 1 < len(words) and len(words[k + 1][1]) == 1)])
            given = more and word.lower() in _GIVEN
            if given or named or titled:
                at = run.start() + m.start(1)
                found.append((at, at + len(word), "given" if given else "surname", word.lower()))
                named = True
            if dot:  # the end of a sentence
                named = titled = False
    return found


def _with_mentions(text: str, spans: list[Span]) -> list[Span]:
    """``spans`` and the other mentions of the names among them, in order."""
    known = {x[3]: x[2] for x in spans if x[2] == "surname"} | {x[3]: x[2] for x in spans if x[2] == "given"}
    if not known:
        return spans
    out, k = [], 0
    for m in _WORD.finditer(text):
        kind = known.get(m[0].lower())
        if kind is None:
            continue
        while k < len(spans) and spans[k][1] <= m.start():
            out.append(spans[k])
            k += 1
        if k == len(spans) or spans[k][0] >= m.end():
            out.append((m.start(), m.end(), kind, m[0].lower()))
    return out + spans[k:]


def _permuted(values: list[int], bases: list[int], key: bytes, tweak: str) -> list[int]:
    """A keyed bijection of mixed-radix strings: an alternating Feistel network over the two halves."""
    half = len(values) // 2
    left, right = values[:half], values[half:]
    left_b, right_b = bases[:half], bases[half:]
    for turn in range(8):
        if turn % 2:
            side, side_b, other = left, left_b, right
        else:
            side, side_b, other = right, right_b, left
        for i, b in enumerate(side_b):
            seed = f"{tweak}|{bases}|{turn}|{i}|{other}".encode()
            side[i] = (side[i] + int.from_bytes(hashlib.blake2b(seed, key=key, digest_size=8).digest(), "little")) % b
    return left + right


def _longer(kind: str, image: str, canon: str, key: bytes, turn: int) -> str:
    """``image`` with keyed characters appended, more of them with each turn."""
    n = 6 + turn
    seed = b"".join(hashlib.blake2b(f"{kind}|{canon}|{turn}|{i}".encode(), key=key).digest() for i in range(n // 64 + 1))[:n]
    if kind == "ip":
        return ".".join([image, *map(str, seed)])
    if kind == "card":
        body = image + "".join(str(x % 10) for x in seed)
        return body + str((10 - _luhn(body + "0")) % 10)
    if kind in ("phone", "ssn"):
        return image + "".join(str(x % 10) for x in seed)
    script = next((a for a in (3, 5) for c in canon if c in CLASSES[a] + CLASSES[a + 1]), 1) if kind == "surname" else 1
    letters = "".join((a := CLASSES[script + (i + 1) % 2])[x % len(a)] for i, x in enumerate(seed))
    if kind != "email":
        return image + letters
    local, _, domain = image.rpartition("@")
    dot = domain.rindex(".")
    # a part without a character to permute would be the real one
    fixed = not any(c in _PLACE for c in domain[:dot])
    return f"{local}{letters}@{domain[:dot]}{letters if fixed else ''}{domain[dot:]}"


def surrogate(kind: str, canon: str, key: bytes, attempt: int = 0) -> str:
    """The canonical form of the replacement; for each kind, format and attempt below ATTEMPTS a bijection, where
    the format has a character to permute."""
    if attempt >= ATTEMPTS and kind != "given":
        return _longer(kind, surrogate(kind, canon, key), canon, key, attempt - ATTEMPTS)
    tweak = f"{kind}|{attempt}"
    if kind == "ip":
        octets = [int(x) for x in canon.split(".")]
        return ".".join(map(str, _permuted(octets, [256] * 4, key, tweak)))
    if kind == "given":
        names = [n.lower() for n in NAMES[_GIVEN[canon]]]
        order = sorted(names, key=lambda n: hashlib.blake2b(n.encode(), key=key).digest())
        # a rotation by less than the whole: never the name itself
        return order[(order.index(canon) + 1 + attempt % (len(order) - 1)) % len(order)]
    head, tail = "", ""
    body = canon
    if kind == "email":
        body, tail = canon[: canon.rindex(".")], canon[canon.rindex(".") :]
    elif kind == "phone" and len(canon) > 10:
        head, body = canon[:-10], canon[-10:]
    valid = kind == "card" and _luhn(canon) == 0
    if valid:
        body = canon[:-1]
    at = [i for i, c in enumerate(body) if c in _PLACE]
    if not at:
        return _longer(kind, canon, canon, key, attempt)
    bases = [len(CLASSES[_PLACE[body[i]][0]]) for i in at]
    shape = "".join(str(_PLACE[c][0]) if c in _PLACE else c for c in body)
    new = _permuted([_PLACE[body[i]][1] for i in at], bases, key, f"{tweak}|{shape}|{head}|{tail}")
    out = list(body)
    for i, v in zip(at, new, strict=True):
        out[i] = CLASSES[_PLACE[body[i]][0]][v]
    body = "".join(out)
    if valid:
        body += str((10 - _luhn(body + "0")) % 10)
    return head + body + tail


def _formatted(original: str, kind: str, canon: str) -> str:
    """The surrogate written as the original was."""
    if kind in ("phone", "ssn", "card"):
        digits = iter(canon)
        return "".join(next(digits) if "0" <= c <= "9" else c for c in original) + "".join(digits)
    if original.isupper():
        return canon.upper()
    if len(canon) == len(original):
        return "".join(c.upper() if o.isupper() else c for c, o in zip(canon, original, strict=True))
    return canon.capitalize() if original[:1].isupper() else canon


def _rewriter(key: bytes):
    known: dict[tuple[str, str, int], str] = {}

    def rewrite(text: str | None, spans: list[Span], attempts: dict[tuple[str, str], int]) -> str | None:
        if not spans:
            return text
        out, at = [], 0
        for s, e, kind, canon in spans:
            k = (kind, canon, attempts.get((kind, canon), 0))
            if k not in known:
                if len(known) > 200_000:
                    known.clear()
                known[k] = surrogate(kind, canon, key, k[2])
            out += [text[at:s], _formatted(text[s:e], kind, known[k])]
            at = e
        return "".join([*out, text[at:]])

    return rewrite


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, kind, canon): the entities of each text, by the text's 64-bit hash."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r, k, c) for r, t in zip(pdf["row"], pdf["text"], strict=True) for k, c in {(x[2], x[3]) for x in detect(t)}]
            yield pd.DataFrame(rows, columns=["row", "kind", "canon"])

    text = F.col(f"`{text_col}`")
    return docs.select(F.xxhash64(text).alias("row"), text.alias("text")).where(F.col("text").isNotNull()).mapInPandas(
        work, "row long, kind string, canon string")


def mapping(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, attempt, sur): a surrogate for every distinct entity, no two alike and none a real entity."""
    real = written(found.select("kind", "canon").distinct(), "pii-entities")

    @F.pandas_udf("string")
    def made(kind: pd.Series, canon: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, c, key, int(a)) for k, c, a in zip(kind, canon, attempt, strict=True)], dtype=object)

    # given names map within a closed list, so their images are real names and only have to differ from each other
    taken, todo, done = real.where(F.col("kind") != "given").select("kind", F.col("canon").alias("sur")), real, None
    for attempt in itertools.count():
        new = written(todo.withColumn("attempt", F.lit(attempt)).withColumn("sur", made("kind", "canon", "attempt")), "pii-tried")
        busy = taken if done is None else taken.unionByName(done.select("kind", "sur"))
        # of those taken, the ones that this round met
        met = busy.join(new.select("kind", "sur").distinct(), ["kind", "sur"], "left_semi").distinct()
        firsts = new.groupBy("kind", "sur").agg(F.min("canon").alias("first"))
        good = written(new.join(firsts, ["kind", "sur"]).where(F.col("canon") == F.col("first")).drop("first")
                       .join(met, ["kind", "sur"], "left_anti").select("kind", "canon", "attempt", "sur"), "pii-mapping")
        done = good if done is None else done.unionByName(good)
        todo = written(new.select("kind", "canon").join(good.select("kind", "canon"), ["kind", "canon"], "left_anti"), "pii-open")
        if not todo.limit(1).count():
            return done


def replace(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and n_<kind> (long), the number of entities of each kind."""
    found = written(entities(docs, text_col), "pii-found")
    later = written(mapping(found, key).where(F.col("attempt") > 0).select("kind", "canon", "attempt"), "pii-later")
    special = written(found.join(later, ["kind", "canon"]).groupBy("row").agg(F.collect_set(
        F.struct("kind", "canon", "attempt")).alias("__tries")), "pii-special")
    names = docs.columns
    kind_of = "struct<text:string," + ",".join(f"{k}:bigint" for k in KINDS) + ">"

    @F.pandas_udf(kind_of)
    def rewritten(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        rewrite = _rewriter(key)
        for texts, tries in batches:
            rows = []
            for text, t in zip(texts, tries, strict=True):
                spans = detect(text)
                attempts = {(x["kind"], x["canon"]): x["attempt"] for x in t} if t is not None else {}
                n = dict.fromkeys(KINDS, 0)
                for x in spans:
                    n[x[2]] += 1
                rows.append((rewrite(text, spans, attempts), *n.values()))
            yield pd.DataFrame(rows, columns=["text", *KINDS])

    marked = docs.withColumn("__row", F.xxhash64(F.col(f"`{text_col}`")))
    some, rest = split_by_filter(marked, "__row", special, "row")
    some = some.join(special.withColumnRenamed("row", "__row"), "__row", "left")
    rest = rest.withColumn("__tries", F.lit(None).cast(special.schema["__tries"].dataType))
    cols = [*names, "__tries"]
    both = some.select(*[f"`{c}`" for c in cols]).unionByName(rest.select(*[f"`{c}`" for c in cols]))
    out = both.withColumn("__new", rewritten.asNondeterministic()(F.col(f"`{text_col}`"), F.col("__tries")))
    return out.select(*[F.col("__new.text").alias(text_col) if c == text_col else F.col(f"`{c}`") for c in names],
                      *[F.col(f"__new.{k}").alias(f"n_{k}") for k in KINDS])
