"""Benchmark decontamination of documents.

Method: pigeonhole edit matching. An item of n words may differ from a passage by e = floor(rate * n)
word edits. Cut into e + 1 pieces, one piece must occur unchanged in such a passage. So every exact piece
hit opens a window, and Myers' bit-parallel algorithm gives the least edit distance within it.

Words: ASCII letters lower-cased, ASCII punctuation dropped, split at white space; in scripts written without
spaces every character is a word, and their punctuation is dropped. Items are the stated
query set: they are dealt into blocks of bounded size, and each block is held against all documents.

Rows: one per document row and item that match, with the best window. Null and empty texts match nothing,
nor do items without any word. Items of fewer than `min_words` words must occur unchanged. Items without an
id are told apart by their text, and count as the item of the same text that has one. Repeated documents are each reported; repeated items once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.common import U64, mix, per_text
from lendframe.session import materialise

RATE = 0.2
MIN_WORDS = 5
BLOCK_BYTES = 4_000_000  # of item text per block, on average

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


# Han, kana, bopomofo, Thai, Lao, Tibetan, Burmese, Khmer: written without spaces between words.
_UNSPACED = re.compile(
    "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u3035\u3038-\u303c"
    "\u3040-\u30fa\u30fc-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f"
    "\U00020000-\U0003ffff]"
)
_UNSPACED_STOPS = re.compile(
    "[\u3000-\u3004\u3008-\u3020\u3030\u303d-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]+"
)


def folded_words(text: str | None) -> list[bytes]:
    if not text:
        return []
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", _UNSPACED_STOPS.sub(" ", text))
    return text.encode().translate(_FOLD).split()


def myers(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """(least edit distance of `pattern` to any part of `text` that ends there, that end)."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[int, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(zero | plus) & full, plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1, down << 1
        plus, minus = (down | ~(zero | up)) & full, up & zero & full
        if score < best:
            best, end = score, j + 1
    return best, end


def pieces(n: int, errors: int) -> list[tuple[int, int]]:
    """`errors` + 1 spans of nearly equal length that cover n words."""
    cuts = [n * k // (errors + 1) for k in range(errors + 2)]
    return list(zip(cuts, cuts[1:]))


class Matcher:
    """The items of one block, indexed by the hashes of their pieces."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, min_words: int):
        self.word_id: dict[bytes, int] = {}
        self.items: list[tuple[int | None, list[int], int]] = []
        spans: dict[int, list[tuple[tuple[int, ...], int, int]]] = {}
        for item_id, text in items:
            words = [self.word_id.setdefault(w, len(self.word_id) + 1) for w in folded_words(text)]
            if not words:
                continue
            errors = math.floor(rate * len(words)) if len(words) >= min_words else 0
            for a, b in pieces(len(words), errors):
                spans.setdefault(b - a, []).append((tuple(words[a:b]), len(self.items), a))
            self.items.append((item_id, words, errors))
        self.value = mix(np.arange(len(self.word_id) + 1, dtype=U64) + U64(1))
        self.value[0] = 0
        self.index = []
        for length, group in sorted(spans.items()):
            ids = np.array([g[0] for g in group], np.int64)
            keys = self._keys(self.value[ids.reshape(-1)].reshape(ids.shape).T, length)
            order = np.argsort(keys, kind="stable")
            self.index.append((length, keys[order], [group[i][1:] for i in order]))

    @staticmethod
    def _keys(columns, length: int) -> np.ndarray:
        total = columns[0] * U64(3)
        for k in range(1, length):
            total = total + columns[k] * (mix(np.array([k], U64)) | U64(1))
        return total

    def matches(self, text: str | None) -> list[tuple[int | None, int, int, int, int]]:
        """(item_id, distance, item_words, start_word, end_word) by item_id."""
        words = folded_words(text)
        get = self.word_id.get
        ids = [get(w, 0) for w in words]
        values = self.value[np.array(ids, np.int64)] if ids else np.zeros(0, U64)
        windows: set[tuple[int, int]] = set()
        for length, keys, refs in self.index:
            n = len(ids) - length + 1
            if n <= 0:
                continue
            found = self._keys([values[k : k + n] for k in range(length)], length)
            first = np.searchsorted(keys, found)
            hit = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == found)
            for position in hit.tolist():
                k = int(first[position])
                while k < len(keys) and keys[k] == found[position]:
                    item, offset = refs[k]
                    windows.add((item, position - offset))
                    k += 1
        best: dict[int, tuple[int, int, int]] = {}
        for item, start in sorted(windows):
            _, pattern, errors = self.items[item]
            a, b = max(0, start - errors), min(len(ids), start + len(pattern) + errors)
            if item in best and best[item][0] == 0:
                continue
            distance, end = myers(pattern, ids[a:b])
            if distance <= errors and (item not in best or distance < best[item][0]):
                _, back = myers(pattern[::-1], ids[a : a + end][::-1])
                best[item] = distance, a + end - back, a + end
        out = [(self.items[i][0], d, len(self.items[i][1]), s, e) for i, (d, s, e) in best.items()]
        return sorted(out, key=lambda m: (m[0] is not None, m[0] or 0, m[1:]))


def matches(
    docs: DataFrame, items: DataFrame, rate: float = RATE, min_words: int = MIN_WORDS
) -> DataFrame:
    """doc_id, item_id, distance, item_words, start_word, end_word of every document row that holds an item."""
    spark = docs.sparkSession
    texts = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    named = texts.where("item_id IS NOT NULL")
    # An item without an id is reported under the id of an item of the same text, if there is one.
    known = named.unionByName(texts.where("item_id IS NULL").join(named.select("text"), "text", "left_anti"))
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    kind = "matches array<struct<item_id:long,distance:int,item_words:int,start_word:int,end_word:int>>"
    parts = []
    for block in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        sent = spark.sparkContext.broadcast([(r.item_id, r.text) for r in rows])

        def start(sent=sent) -> Callable[[str | None], tuple]:
            matcher = Matcher(sent.value, rate, min_words)
            return lambda t: (matcher.matches(t),)

        found = per_text(docs, "text", ("doc_id",), kind, start).select("doc_id", F.explode("matches").alias("m"))
        part = found.select("doc_id", "m.*")
        parts.append(part if blocks == 1 else materialise(part, "matches"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents without a match, all columns. Rows without a doc_id are checked by their text as well.

    The columns of `docs` travel as one struct, so that none of them can clash with the key.
    """
    keyed = docs.select(F.struct(*docs.columns).alias("_document"), F.xxhash64("doc_id", "text").alias("_row"))
    asked = keyed.select(F.col("_row").alias("doc_id"), F.col("_document.text").alias("text"))
    bad = matches(asked, items, rate, min_words).select(F.col("doc_id").alias("_row")).distinct()
    return keyed.join(bad, "_row", "left_anti").select("_document.*")
