"""Byte-pair encoding and decoding of whole texts under a given vocabulary.

Method: contiguous rank array. A short word keeps its parts, one between every two boundaries, and the rank of
every adjacent pair in two flat arrays; the minimum rank is found by scanning, its boundary is deleted, and only
the two neighbouring ranks are looked up again. Parts are ids, so a pair is looked up by one number. Words
repeat, so a task remembers what it encoded. Words of more than `FLAT_PARTS` bytes, which are rare, are merged by the same
rule from a heap of pairs, so that a text without any break costs n log n.

Rows: one per input row. A null text counts as empty: no ids, empty decoded text. Repeated rows, ties
and extra columns need no care, since every row is encoded by itself.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Callable

import regex
from pyspark.sql import DataFrame

from lendframe.llm.common import per_text

# Pre-tokens in each of the two generations a task remembers; a memory bound, not a limit on input.
REMEMBERED = 150_000

# The longest word whose ranks are scanned anew for every merge; time grows with the square of its parts.
FLAT_PARTS = 200

# The pre-tokeniser pattern that belongs to the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NO_RANK = 1 << 62
_SHIFT = 32  # a pair of ids is the number first << _SHIFT | second


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, as byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks, token bytes and special tokens of a byte-level BPE file (`.json` or `.tiktoken`)."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            alphabet = _byte_alphabet()
            as_bytes = lambda s: bytes(alphabet[c] for c in s)
            self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            self.bytes_of = {i: as_bytes(s) for s, i in spec["model"]["vocab"].items() if s not in self.special}
            merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
            pairs = [(as_bytes(a), as_bytes(b)) for a, b in merges]
        else:
            with open(path, "rb") as f:
                ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.special = {}
            self.bytes_of = {i: b for b, i in ids.items()}
            pairs = None
        self.ids = {b: i for i, b in self.bytes_of.items()}
        if pairs is None:
            self.ranks, self.merged = _PairRanks(self), range(max(self.bytes_of) + 1)
        else:
            self.ranks = {self.ids[a] << _SHIFT | self.ids[b]: r for r, (a, b) in enumerate(pairs)}
            self.merged = [self.ids[a + b] for a, b in pairs]
        self.byte_ids = [self.ids.get(bytes([b])) for b in range(256)]
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.pattern = regex.compile(PATTERN)
        self.split_special = (
            regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special
            else None
        )

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one pre-token."""
        if len(word) > FLAT_PARTS:
            return self._merge_long(word)
        parts = [self.byte_ids[b] for b in word]
        rank, merged = self.ranks.get, self.merged
        ranks = [rank(a << _SHIFT | b, _NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == _NO_RANK:
                break
            at = ranks.index(low)
            parts[at] = merged[low]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank(parts[at] << _SHIFT | parts[at + 1], _NO_RANK)
            if at:
                ranks[at - 1] = rank(parts[at - 1] << _SHIFT | parts[at], _NO_RANK)
        return parts


    def _merge_long(self, word: bytes) -> list[int]:
        """As `merge` for words too long to scan again after every merge: a heap of pairs over linked parts."""
        parts: list[int] = [self.byte_ids[b] for b in word]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, merged = self.ranks.get, self.merged
        pairs = [(rank(a << _SHIFT | b, _NO_RANK), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        waiting = [p for p in pairs if p[0] != _NO_RANK]
        heapq.heapify(waiting)
        while waiting:
            low, at = heapq.heappop(waiting)
            right = after[at]
            # A pair that has changed since it was filed, or whose left part is gone, is passed over.
            if parts[at] < 0 or right == n or rank(parts[at] << _SHIFT | parts[right], _NO_RANK) != low:
                continue
            parts[at], parts[right] = merged[low], -1
            after[at] = end = after[right]
            if end < n:
                before[end] = at
                self._file(waiting, parts, at, end)
            if before[at] >= 0:
                self._file(waiting, parts, before[at], at)
        return [p for p in parts if p >= 0]

    def _file(self, waiting: list[tuple[int, int]], parts: list[int], left: int, right: int) -> None:
        low = self.ranks.get(parts[left] << _SHIFT | parts[right], _NO_RANK)
        if low != _NO_RANK:
            heapq.heappush(waiting, (low, left))


class _PairRanks:
    """Ranks of pairs in a file that ranks the merged bytes: there a rank is the id of the merged part."""

    def __init__(self, vocabulary: Vocabulary):
        self._of, self._ids = vocabulary.bytes_of, vocabulary.ids

    def get(self, pair: int, default: int) -> int:
        return self._ids.get(self._of[pair >> _SHIFT] + self._of[pair & (1 << _SHIFT) - 1], default)


class Encoder(dict):
    """Pre-token -> its ids as decimal texts; the memory of one task.

    A full memory becomes the older generation, from which words that are met again are taken over.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, word: str) -> str:
        value = self.older.get(word)
        if value is None:
            value = ",".join(map(str, self.vocabulary.merge(word.encode())))
        # A very long pre-token is encoded by the same rule; only its result is not remembered.
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value

    def encode(self, text: str | None) -> str:
        """Decimal ids of the whole text, joined by commas."""
        if not text:
            return ""
        v = self.vocabulary
        if v.split_special is None or not v.split_special.search(text):
            return ",".join(map(self.__getitem__, v.pattern.findall(text)))
        parts = []
        for piece in v.split_special.split(text):
            if piece in v.special:
                parts.append(str(v.special[piece]))
            elif piece:
                parts.extend(map(self.__getitem__, v.pattern.findall(piece)))
        return ",".join(parts)


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """Text of `ids`; byte sequences that are not UTF-8 become replacement characters."""
    return b"".join([vocabulary.bytes_of[i] for i in ids]).decode("utf-8", "replace")


def encode_documents(
    docs: DataFrame, vocabulary_file: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = True
) -> DataFrame:
    """`keep` columns, n_tokens, ids_sha256, decoded_sha256 and, if wanted, token_ids per row."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids

    def start() -> Callable[[str | None], tuple]:
        vocabulary = Vocabulary(vocabulary_file)
        encoder = Encoder(vocabulary)
        token = {str(i): b for i, b in vocabulary.bytes_of.items()}

        def row(text: str | None) -> tuple:
            joined = encoder.encode(text)
            parts = joined.split(",") if joined else []
            back = b"".join(map(token.__getitem__, parts)).decode("utf-8", "replace")
            digests = hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()
            return (len(parts), *digests, list(map(int, parts))) if ids else (len(parts), *digests)

        return row

    return per_text(docs, text, keep, schema, start)


def decode_documents(
    encoded: DataFrame, vocabulary_file: str, ids: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """`keep` columns and the decoded `text` of each row; null ids give an empty text."""

    def start() -> Callable[[object], tuple]:
        vocabulary = Vocabulary(vocabulary_file)
        return lambda x: (decode(vocabulary, [] if x is None else list(x)),)

    return per_text(encoded, ids, keep, "text string", start)
