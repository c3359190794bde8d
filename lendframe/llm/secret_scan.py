"""Secret scans over whole texts.

Method: token-efficiency test. Ordinary words cost few tokens per character under a public vocabulary,
random strings many. A run of key characters whose characters-per-token ratio is low is reported as kind
`random`, unless it is a known digest, an identifier or a plain number. In a run of a higher ratio, as where
a key ends a path or a name, the parts between separators are held to the ratio: parts next to each other
that save less than `RATIO` characters a token together are reported without the words around them. Base patterns (`assign`,
`access`, `hex`) are always reported. Offsets are code points, ends exclusive.

Rows: one per input row; a null or empty text has no spans. Repeated rows are scanned each.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.bpe import PATTERN
from lendframe.llm.common import arrow_batches, per_text

# The base patterns and their smallest lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16
KINDS = ("assign", "access", "hex", "random")

RANDOM_LENGTH = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RANDOM_LENGTH)
RATIO = 2.0  # characters per token below which a run looks random
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_NUMBERS = re.compile(r"[0-9+/_=-]+")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PART = re.compile(rf"(?<![A-Za-z0-9]){_UUID.pattern}(?![A-Za-z0-9])|[A-Za-z0-9]+")
# Words, numbers and words with a trailing number, joined as in names, paths and keys.
_IDENTIFIER = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)?[0-9]*(?:[+/_=-]+(?:[A-Z]?[a-z]+|[A-Z]+)?[0-9]*)*")
_CAMEL = re.compile(r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,})+[0-9]{0,4}")
PLACEHOLDER = "<secret>"


def tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def known(run: str) -> bool:
    """Digests of fixed lengths and UUIDs."""
    return bool(len(run) in DIGEST_LENGTHS and _DIGEST.fullmatch(run) or _UUID.fullmatch(run))


def excluded(run: str, encoding: tiktoken.Encoding) -> bool:
    """Known digests, plain numbers, and identifiers whose words reach the ratio, whatever their case."""
    if known(run) or _NUMBERS.fullmatch(run):
        return True
    if not (_IDENTIFIER.fullmatch(run) or _CAMEL.fullmatch(run)):
        return False
    words = [w.lower() for w in _WORD.findall(run)]
    return sum(map(len, words)) >= RATIO * sum(len(encoding.encode_ordinary(w)) for w in words)


def looks_random(run: str, encoding: tiktoken.Encoding) -> bool:
    return not excluded(run, encoding) and len(run) <= RATIO * len(encoding.encode_ordinary(run))


def random_spans(run: str, encoding: tiktoken.Encoding) -> list[tuple[int, int]]:
    """(start, end) within `run` of what looks random: all of it, or stretches of its parts."""
    if known(run):
        return []
    if looks_random(run, encoding):
        return [(0, len(run))]
    # All maximal scoring stretches of parts (Ruzzo and Tompa), each as (score before, score after, start, end,
    # the nearest earlier stretch that begins at a lower score), in time linear in the parts.
    done: list[tuple[int, int]] = []
    stretches: list[tuple[float, float, int, int, int]] = []
    total = 0.0
    for m in _PART.finditer(run):
        part = m[0]
        if known(part):
            done += [x[2:4] for x in stretches]
            stretches = []
            continue
        low, total = total, total + RATIO * len(encoding.encode_ordinary(part)) - len(part)
        if total <= low:
            continue
        start, j = m.start(), len(stretches) - 1
        while j >= 0:
            last = stretches[j]
            if last[0] < low:
                if last[1] >= total:
                    break
                low, start = last[0], last[2]
                del stretches[j:]
            j = last[4]
        stretches.append((low, total, start, m.end(), j))
    done += [x[2:4] for x in stretches]
    return [(a, b) for a, b in done if b - a >= RANDOM_LENGTH and looks_random(run[a:b], encoding)]


def spans_of(text: str | None, encoding: tiktoken.Encoding) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as in `KINDS`."""
    if not text:
        return []
    found = [
        ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH
    ]
    if "AKIA" in text:
        found += [
            ("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH
        ]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        found += [("random", m.start() + a, m.start() + b) for a, b in random_spans(m[0], encoding)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def text_of(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """`text` with every span, overlapping ones as one, replaced by `PLACEHOLDER`."""
    if not spans:
        return text
    out, at, end = [], 0, -1
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if a >= end:
            out += [text[at:a], PLACEHOLDER] if a >= at else []
            at = max(at, b)
        at = max(at, b)
        end = max(end, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, vocabulary_file: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, counts per kind, all `spans` (kind:start:end) and the digest of the base ones."""
    schema = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"

    def start() -> Callable[[str | None], tuple]:
        encoding = tokenizer(vocabulary_file)

        def row(text: str | None) -> tuple:
            spans = spans_of(text, encoding)
            count = [sum(s[0] == k for s in spans) for k in KINDS]
            base = text_of([s for s in spans if s[0] != "random"])
            return (*count, hashlib.sha256(base.encode()).hexdigest(), text_of(spans))

        return row

    return per_text(docs, text, keep, schema, start)


def redact(docs: DataFrame, vocabulary_file: str, text: str = "text") -> DataFrame:
    """All columns of `docs`, with the secrets of `text` replaced by a placeholder; a null text stays null."""
    arrow_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = tokenizer(vocabulary_file)
        for batch in batches:
            yield pd.Series([redacted(t, spans_of(t, encoding)) for t in batch], dtype=object)

    return docs.withColumn(text, run(docs[text]))
