"""Token counts under a unigram vocabulary by dynamic programming over a shared trie.

A pre-token is a word with the mark that stands for the white space before it. Its tokens are
the segmentation of the greatest sum of piece scores, then of the fewest tokens. The distinct
pre-tokens of a batch go into a trie in sorted order; the best score and count of a prefix are
worked out once, at its node, however many words share it. A word's count is its terminal's.

Pieces come from a public vocabulary. That file orders its pieces by rank; a piece of rank r
gets the Zipf score -log(r + 1), in millionths, so sums are exact and ties are defined. A
character that no piece covers costs one token for each of its UTF-8 bytes.
"""

from __future__ import annotations

import functools
import gc
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from terrafold.llm.common import as_bytes, chunks

VOCABULARY = "piece_bpe_32k.model"
#: Stands for white space before a word.
MARK = "▁"
MILLION = 1_000_000
#: A byte of a character without a piece, below every piece.
BYTE_SCORE = -20 * MILLION
#: Pre-tokens whose counts a worker remembers.
REMEMBERED = 400_000


@functools.cache
def pieces(path: str) -> dict[str, int]:
    """Score of every piece, in millionths."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ordinary.sort(key=lambda i: (-model.get_score(i), i))
    return {model.id_to_piece(i): -round(MILLION * math.log(r + 1)) for r, i in enumerate(ordinary, 1)}


class Counter:
    """Counts tokens of pre-tokens; shares the work of common prefixes."""

    def __init__(self, scores: dict[str, int]):
        # A trie of the reversed pieces: from a place back, it gives every piece that ends there.
        self.root: dict = {}
        for piece, score in scores.items():
            node = self.root
            for char in reversed(piece):
                node = node.setdefault(char, {})
            node[None] = score
        self.known: dict[str, int] = {}

    def extend(self, word: str, best: list[tuple[int, int]]) -> None:
        """Append the best (score, -tokens) of the next longer prefix of ``word``."""
        end = len(best)
        char = word[end - 1]
        size = len(char.encode("utf-8", "replace"))
        score, tokens = best[end - 1]
        top = (score + size * BYTE_SCORE, tokens - size)
        node, start = self.root.get(char), end - 1
        while node is not None:
            own = node.get(None)
            if own is not None:
                score, tokens = best[start]
                found = (score + own, tokens - 1)
                if found > top:
                    top = found
            if not start:
                break
            start -= 1
            node = node.get(word[start])
        best.append(top)

    def count_sorted(self, words: list[str]) -> list[int]:
        """Token counts of sorted distinct words; the stack is the trie's current branch."""
        out, best, last = [], [(0, 0)], ""
        for word in words:
            shared = 0
            for a, b in zip(word, last, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :]
            for _ in range(shared, len(word)):
                self.extend(word, best)
            out.append(-best[-1][1])
            last = word
        return out

    def counts(self, words: list[str]) -> dict[str, int]:
        """Counts of distinct words; remembered ones are not counted again."""
        known = self.known
        new = sorted(w for w in words if w not in known)
        found = dict(zip(new, self.count_sorted(new), strict=True))
        fresh = {w: known[w] if w in known else found[w] for w in words}
        if len(known) + len(found) > REMEMBERED:
            known.clear()
        known.update((w, n) for w, n in found.items() if len(w) <= 64)
        return fresh


@functools.cache
def counter(path: str) -> Counter:
    """One per worker process."""
    made = Counter(pieces(path))
    gc.freeze()
    return made


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Tokens and pre-tokens of every row of ``docs`` (``doc_id``, ``text``).

    A text is split at white space (blank and characters 9 to 13); each word counts with the
    mark before it. Null, empty and blank texts have none. Whole texts are read, repeated
    rows are counted each, other columns are left out, an empty table gives none.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        count = counter(path)
        for batch in batches:
            raw, offsets = as_bytes(batch.column(1))
            tokens, words = [], []
            for lo, hi in chunks(offsets):
                split = [raw[offsets[i] : offsets[i + 1]].tobytes().split() for i in range(lo, hi)]
                distinct = {w: MARK + w.decode("utf-8") for own in split for w in own}
                known = count.counts(list(distinct.values()))
                of = {w: known[word] for w, word in distinct.items()}
                tokens += [sum(map(of.__getitem__, own)) for own in split]
                words += map(len, split)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(tokens, np.int64)), pa.array(np.array(words, np.int64))], ["doc_id", "n_tokens", "n_words"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_tokens long, n_words long")
