"""Small tables and plain Python versions of the operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i * 7 % 101} and{i}" for i in range(120))

#: Nulls, blanks, long runs, copies, repeated rows and ids, and columns with busy names.
EDGE_ROWS = [
    (1, None, "en", 1.0, "x", 0),
    (2, "", "en", 2.0, None, 0),
    (3, " \n\t ", None, None, "x", 4),
    (4, "a", "en", 4.0, "x", 1),
    (5, "x" * 5000, "en", 5.0, "x", 5000),
    (6, LONG, "en", 6.0, "x", len(LONG)),
    (7, LONG, "en", 7.0, "x", len(LONG)),
    (8, LONG + " tail é€😀", "fr", 8.0, "x", len(LONG) + 9),
    (8, LONG + " tail é€😀", "fr", 8.0, "x", len(LONG) + 9),
    (8, "another text of the same id, mail anna.b@mail.example.com", None, 9.0, "x", 57),
    (None, "no id but +1 (743) 555-3824 and 4111 1111 1111 1111", "en", 10.0, "x", 52),
    (9, "12345 !!! ... 2020-02-29", None, 11.0, "x", 24),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, score double, source string, n_chars long"


def edge(spark, extra=True):
    df = spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA).repartition(3)
    if extra:
        for name in ("_hits", "_new", "_digest", "_md5", "_sha", "_spans", "_word", "_bits", "_id", "_wordless", "rejected", "row_id", "key", "b", "seq"):
            df = df.selectExpr("*", f"doc_id AS {name}")
    return df


def nothing(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


def texts(spark, path=SF):
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def shingles(text: str | None) -> set:
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_components(rows: list[tuple]) -> list:
    """Least id reachable of each (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return [min(least[find(i)]) if least[find(i)] else None for i in range(len(rows))]


def removed(values: list[bytes]) -> list[tuple]:
    """Bytes, removed bytes, spans and digest of what stays, by all 400-byte windows."""
    seen = Counter(v[i : i + 400] for v in values for i in range(len(v) - 399))
    out = []
    for v in values:
        gone = bytearray(len(v))
        for i in range(len(v) - 399):
            if seen[v[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(v, gone, strict=True) if not g)
        out.append((len(v), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def without_passages(texts: list[str], length: int, words: int, always: int, across: bool = False) -> list[str]:
    """What stays when runs that repeat over ``length`` bytes and have so many whole words go."""
    values = [t.encode() for t in texts]
    seen = Counter(v[i : i + length] for v in values for i in range(len(v) - length + 1))
    if across:
        seen = Counter(w for v in values for w in {v[i : i + length] for i in range(len(v) - length + 1)})
    out = []
    for v in values:
        gone = bytearray(len(v))
        for i in range(len(v) - length + 1):
            if seen[v[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept, at = b"", 0
        for m in re.finditer(b"\1+", bytes(gone)):
            inside = [w for w in re.finditer(rb"[^\x20\x09-\x0D]+", v) if m.start() <= w.start() and w.end() <= m.end()]
            if m.end() - m.start() >= always or len(inside) >= words:
                kept, at = kept + v[at : m.start()], m.end()
        out.append((kept + v[at:]).decode("utf-8", "ignore"))
    return out
