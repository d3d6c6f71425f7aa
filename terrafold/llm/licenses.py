"""Licence notices and identifier tags by Aho-Corasick, expressions by shunting-yard.

A chunk of texts becomes words that stand one blank apart, a line feed before each document,
in a few NumPy passes. One automaton of all phrases and tags reads the chunk once; places
that do not start and end with a word are dropped. After a tag the document's own bytes are
read as a licence expression: a shunting-yard parser orders ``and``, ``or`` and ``with`` and
evaluates as it goes, to the licences named and to how much they ask.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrafold.llm.common import as_bytes, chunks, small_batches

# The phrases of the contract and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further notices that name a licence, in words as they stand in texts.
NOTICES = {
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "isc license": "isc",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu gpl": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "reserved",
}

#: Tags that an expression follows; whether any identifier may stand in it or known ones only.
TAGS = {"spdx license identifier": True, "licensed under": False, "released under": False, "license expression": False}

# Families of identifiers: an identifier belongs to the longest that begins it, up to a hyphen.
FAMILIES = {
    "mit": "mit",
    "apache": "apache",
    "gpl": "gpl",
    "lgpl": "lgpl",
    "agpl": "agpl",
    "bsd": "bsd",
    "0bsd": "bsd",
    "isc": "isc",
    "mpl": "mpl",
    "epl": "epl",
    "bsl": "boost",
    "cc0": "cc0",
    "cc-by": "cc-by",
    "cc-by-sa": "cc-by-sa",
    "cc-by-nc": "cc-by-nc",
    "cc-by-nd": "cc-by-nd",
    "unlicense": "public-domain",
}

#: How much a licence asks, from 0 to 1; an unknown one counts as asking everything.
ASKS = {
    "public-domain": 0.05,
    "cc0": 0.05,
    "mit": 0.2,
    "isc": 0.2,
    "bsd": 0.2,
    "boost": 0.2,
    "apache": 0.3,
    "cc-by": 0.3,
    "mpl": 0.5,
    "epl": 0.5,
    "lgpl": 0.6,
    "cc-by-sa": 0.7,
    "gpl": 0.8,
    "agpl": 0.9,
    "cc-by-nd": 0.9,
    "cc-by-nc": 0.9,
    "reserved": 1.0,
}

#: Operators and how tightly they bind.
BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+\-]*)")
BEFORE = re.compile(rb"[ \t:=\"'<>*]*")

#: Every byte as words see it: A-Z small, other ASCII outside words a blank.
SEEN = np.arange(256, dtype=np.uint8)
SEEN[ord("A") : ord("Z") + 1] += 32
SEEN[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32

ADDED = "n_words long, findings array<struct<word:long,kind:string,label:string,expression:string,asks:double>>"


def family(identifier: str) -> str | None:
    """The licence that an identifier means, if it is a known one."""
    name = identifier.lower().rstrip("+")
    while name not in FAMILIES:
        name, hyphen, _ = name.rpartition("-")
        if not hyphen:
            return None
    return FAMILIES[name]


def tokens(data: bytes, at: int, end: int):
    """Tokens of an expression from a place on, as text; ends where something else stands."""
    while m := TOKEN.match(data, at, end):
        at = m.end()
        yield m.group(1).decode("ascii")


def evaluate(found, free: bool) -> tuple[list[str], float, str] | None:
    """Licences, how much they ask, and the text of the longest expression that tokens begin with.

    ``or`` asks the lesser of its sides, ``and`` the greater, an exception after ``with``
    halves. ``free``: identifiers of no known family are licences of their own name; else
    they end the expression. An expression with an open bracket asks everything.
    """
    values: list[float] = []
    waiting: list[str] = []
    names: list[str] = []
    text: list[str] = []

    def apply(operator: str) -> None:
        right, left = values.pop(), values.pop()
        values.append(min(left, right) if operator == "or" else max(left, right) if operator == "and" else left / 2)

    operand = True
    for token in found:
        word = token.lower().rstrip(".")
        if operand and word == "(":
            waiting.append("(")
        elif operand and word not in BINDS and word != ")":
            if waiting and waiting[-1] == "with":
                values.append(0.0)
            else:
                label = family(word) or (word if free else None)
                if label is None:
                    break
                names.append(label)
                values.append(ASKS.get(label, 1.0))
            operand = False
        elif not operand and word in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[word]:
                apply(waiting.pop())
            waiting.append(word)
            operand = True
        elif not operand and word == ")" and "(" in waiting:
            while waiting[-1] != "(":
                apply(waiting.pop())
            waiting.pop()
        else:
            break
        text.append(token.rstrip(".") or token)
        if token.endswith("."):
            break
    while operand and text and (waiting and waiting[-1] in BINDS or text[-1] == "("):
        text.pop()  # an operator or bracket that nothing follows
        operand = waiting.pop() == "("
    if not names:
        return None
    asks = 1.0
    if "(" not in waiting:
        while waiting:
            apply(waiting.pop())
        asks = values[-1]
    return sorted(set(names)), asks, " ".join(text)


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """All phrases, notices and tags; one per worker process."""
    made: dict[str, list[tuple]] = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", TAGS)):
        for phrase, value in phrases.items():
            made.setdefault(phrase, []).append((kind, value))
    out = ahocorasick.Automaton()
    for phrase, meanings in made.items():
        out.add_word(phrase, (phrase, meanings))
    out.make_automaton()
    return out


def chunk_findings(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, list[tuple]]]:
    """Words of every document of a chunk, and the findings of those that have any."""
    rows = len(offsets) - 1
    seen = np.insert(SEEN[raw], offsets, np.uint8(10))
    word = seen > 32
    after = np.concatenate([[False], word[:-1]])
    start = np.flatnonzero(word & ~after)
    bounds = offsets + np.arange(rows + 1)  # where each document's line feed went
    first = np.searchsorted(start, bounds)
    line = seen[word | (seen == 10) | after].tobytes()
    hits = [(end + 1 - len(phrase), end + 1, phrase, meanings) for end, (phrase, meanings) in automaton().iter(line.decode("latin-1"))]
    hits = [h for h in hits if line[h[0] - 1] in b" \n" and line[h[1]] in b" \n"]
    out: dict[int, list[tuple]] = {}
    if not hits:
        return np.diff(first), out
    packed = np.frombuffer(line, np.uint8) > 32
    begins = np.flatnonzero(packed & ~np.concatenate([[False], packed[:-1]]))
    data = raw.tobytes()
    for at, _, phrase, meanings in hits:
        k = int(np.searchsorted(begins, at))
        row = int(np.searchsorted(first, k, "right")) - 1
        place = k - int(first[row])
        for kind, value in meanings:
            if kind != "tag":
                out.setdefault(row, []).append((place, kind, value, None, ASKS.get(value, 1.0)))
                continue
            last = k + phrase.count(" ")
            end = int(start[last]) - row - 1 + len(phrase.rpartition(" ")[2])
            stop = int(offsets[row + 1])
            found = evaluate(tokens(data, BEFORE.match(data, end, stop).end(), stop), value)
            if found:
                names, asks, text = found
                out.setdefault(row, []).extend((place, "expression", name, text, asks) for name in names)
    return np.diff(first), out


def with_findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words`` and ``findings`` to the rows.

    A finding has its first word's number, its kind (``base``, ``notice`` or ``expression``),
    a licence, the expression and how much that asks. Null text is empty, whole texts are
    read, repeated rows are alike, an empty table stays empty; columns of these two names are
    replaced.
    """
    rest = [c for c in docs.columns if c not in ("n_words", "findings")]
    fields = [("word", pa.int64()), ("kind", pa.string()), ("label", pa.string()), ("expression", pa.string()), ("asks", pa.float64())]
    kind = pa.list_(pa.struct(fields))

    def run(batches):
        for batch in batches:
            raw, offsets = as_bytes(batch.column(text))
            for lo, hi in chunks(offsets):
                own = offsets[lo : hi + 1]
                n, found = chunk_findings(raw[own[0] : own[-1]], own - own[0])
                rows = [[dict(zip([f[0] for f in fields], x, strict=True)) for x in found.get(i, ())] for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in rest), pa.array(n, pa.int64()), pa.array(rows, kind)],
                    [*rest, "n_words", "findings"],
                )

    schema = StructType([docs.schema[c] for c in rest] + StructType.fromDDL(ADDED).fields)
    small_batches(docs)
    return docs.select(*(f"`{c}`" for c in rest)).mapInArrow(run, schema)


def labelled(docs: DataFrame) -> DataFrame:
    """Licences of every document; the score is the most that any of its findings asks.

    Takes ``doc_id`` and ``text``; other columns are left out. A row in gives a row out.
    Without a finding labels are empty, places null and the score 0.
    """
    found = with_findings(docs.select("doc_id", "text")).drop("text")
    base = F.filter("findings", lambda f: f["kind"] == "base")
    words = F.transform(base, lambda f: f["word"])

    def names(findings):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(findings, lambda f: f["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("findings")).alias("labels"),
        F.coalesce(F.array_max(F.transform("findings", lambda f: f["asks"])), F.lit(0.0)).alias("score"),
        F.array_distinct(F.filter(F.transform("findings", lambda f: f["expression"]), lambda e: e.isNotNull())).alias("expressions"),
    )
