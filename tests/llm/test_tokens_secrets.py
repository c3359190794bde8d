import hashlib
import random
import re

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lendframe.llm import bpe, secret_scan
from lendframe.llm.common import read_table, vocabulary_path
from lendframe.llm.queries import ENCODER, RANKS, op2_bpe, op5_secret_scan

TEXTS = [
    None, "", " ", "plain words, here's one", "a" * 3000, "tabs\t\tand\n\n lines  ", "émile ßtraße 東京 🙂🙂",
    "x<|endoftext|>y <|endoftext|>", "\x00\x01 control", "1234567890 12,5", "  leading and trailing  ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path(ENCODER))


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(vocabulary_path(ENCODER)))


def ids_of(encoder, text):
    joined = encoder.encode(text)
    return [int(x) for x in joined.split(",")] if joined else []


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_library(encoder, library, text):
    want = library.encode(text or "", add_special_tokens=False).ids
    assert ids_of(encoder, text) == want
    assert bpe.decode(encoder.vocabulary, want) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(text):
    vocabulary = _vocabulary()
    ids = ids_of(bpe.Encoder(vocabulary), text)
    assert bpe.decode(vocabulary, ids) == text


_known = []


def _vocabulary():
    if not _known:
        _known.append(bpe.Vocabulary(vocabulary_path(ENCODER)))
    return _known[0]


def test_a_very_long_pre_token(encoder, library):
    source = random.Random(4)
    for n, letters in ((bpe.FLAT_PARTS + 1, "ab"), (5_000, "aeé"), (300_000, "abcdefghijklmnopqrstuvwxyz")):
        text = "".join(source.choice(letters) for _ in range(n))
        assert encoder.vocabulary.merge(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_rank_files_equal_tiktoken():
    import base64

    encoder = bpe.Encoder(bpe.Vocabulary(vocabulary_path(RANKS)))
    with open(vocabulary_path(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("t", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in TEXTS:
        assert ids_of(encoder, text) == other.encode_ordinary(text or "")


def test_a_truncated_sequence_decodes_to_replacement(encoder, library):
    ids = library.encode("🙂", add_special_tokens=False).ids[:1]
    assert bpe.decode(encoder.vocabulary, ids) == library.decode(ids, skip_special_tokens=False)


def test_documents_query(spark, sf_dir, library):
    rows = op2_bpe(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in read_table(spark, sf_dir, "documents").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        e = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(e)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, e)).encode()).hexdigest()
        back = library.decode(e, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_nulls_repeats_and_clashing_names(spark):
    docs = spark.createDataFrame(
        [(1, "hi", "a"), (1, "hi", "a"), (None, None, None)], "doc_id long, text string, _result string"
    )
    rows = bpe.encode_documents(docs, vocabulary_path(ENCODER)).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 1, 1]
    back = bpe.decode_documents(bpe.encode_documents(docs, vocabulary_path(ENCODER)), vocabulary_path(ENCODER))
    assert sorted(r.text for r in back.collect()) == ["", "hi", "hi"]
    assert bpe.encode_documents(docs.limit(0), vocabulary_path(ENCODER)).count() == 0
    assert secret_scan.scan(docs, vocabulary_path(RANKS)).where("spans = ''").count() == 3
    assert secret_scan.scan(docs.limit(0), vocabulary_path(RANKS)).count() == 0
    kept = secret_scan.redact(docs, vocabulary_path(RANKS))
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 1


def base_spans(text):
    """The base patterns, said once more and plainly."""
    text = text or ""
    assign = r'(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)'
    found = [("assign", m.start(), m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ["assign", "access", "hex"]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda x: (x[1], order.index(x[0]))))


def test_base_spans_of_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in read_table(spark, sf_dir, "documents").collect()}
    for r in op5_secret_scan(spark, sf_dir).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        kept = [s for s in r.spans.split(",") if s and not s.startswith("random")]
        assert ",".join(kept) == want


@pytest.fixture(scope="module")
def ranks():
    return secret_scan.tokenizer(vocabulary_path(RANKS))


def kinds(text, ranks):
    return [k for k, _, _ in secret_scan.spans_of(text, ranks)]


def test_patterns_and_limits(ranks):
    assert kinds("API_KEY = 'abcdefgh'", ranks) == ["assign"]
    assert kinds("token: short", ranks) == []
    assert kinds("paſſword: abcdefghij", ranks) == []
    assert kinds("é AKIAABCDEFGHIJKL ", ranks) == ["access"]
    assert kinds("0" * 32, ranks) == ["hex"]
    assert kinds("", ranks) == kinds(None, ranks) == []


def test_random_strings_but_no_digests_or_names(ranks):
    assert kinds("key kJ8fQz2LxV9wTn4BvR7yHc3D end", ranks) == ["random"]
    assert kinds("A" + hashlib.sha256(b"x").hexdigest().upper()[1:], ranks) == []
    assert kinds("see 123e4567-e89b-12d3-a456-426614174000 there", ranks) == []
    assert kinds("the_very_long_function_name and someCamelCaseIdentifierName", ranks) == []
    assert kinds("12345678901234567890123", ranks) == []


def test_random_parts_of_paths_and_names(ranks):
    key = "kJ8fQz2LxV9wTn4BvR7yHc3D"
    for before, after in (
        ("com/company/project/settings/production/deploy/keys/", ""),
        ("production_storage_account_access_key=", ""),
        ("com/company/project/settings/", "/production/default/settings"),
    ):
        text = f"see {before}{key}{after} end"
        at = text.index(key)
        assert any(a <= at and b >= at + len(key) for _, a, b in secret_scan.spans_of(text, ranks))
        assert key not in secret_scan.redacted(text, secret_scan.spans_of(text, ranks))
    # A run whose ratio as a whole is high: the key alone is reported.
    words = "com/company/project/settings/production/deploy/keys/" * 2
    assert secret_scan.spans_of(words + key, ranks) == [("random", len(words), len(words) + len(key))]
    # Separators within the key itself.
    split = "kJ8fQz2LxV/9wTn4Bv+R7yHc3DpW"
    assert secret_scan.spans_of(words + split + "/settings", ranks) == [("random", len(words), len(words) + len(split))]
    assert kinds("src/main/java/org/apache/spark/sql/catalyst/expressions/part-00001", ranks) == []
    assert kinds("projects/settings/users/123e4567-e89b-12d3-a456-426614174000/profile/index", ranks) == []
    assert kinds("com/project/kJ8f/settings/Qz2L/production/" * 20_000, ranks) == []


def test_single_case_random_strings(ranks):
    for key in (
        "qzvkxjwpfhgtbncmrlydqkzxvjwphgft",
        "QZVKXJWPFHGTBNCMRLYDQKZXVJWPHGFT",
        "qzvkx-jwpfh-gtbnc-mrlyd-qkzxv",
        "QZVKX-JWPFH-GTBNC-MRLYD-QKZXV",
    ):
        assert kinds(f"key {key} end", ranks) == ["random"]
    path = "com/company/project/settings/production/deploy/keys/" * 2
    assert secret_scan.spans_of(path + "qzvkxjwpfhgtbncmrlyd", ranks) == [("random", len(path), len(path) + 20)]
    for name in ("MAX_CONNECTION_TIMEOUT_SECONDS", "HTTPSConnectionPoolManager", "user_id_v2_created_at", "2024-01-15-12-30-45-000"):
        assert kinds(f"see {name} there", ranks) == []


def test_redaction_replaces_overlaps_once(ranks):
    text = "a token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff b"
    spans = secret_scan.spans_of(text, ranks)
    assert len(spans) == 2
    assert secret_scan.redacted(text, spans) == f"a {secret_scan.PLACEHOLDER} b"
    assert secret_scan.redacted("clean text", []) == "clean text"
    nested = [("assign", 0, 10), ("hex", 2, 5), ("random", 8, 12)]
    assert secret_scan.redacted("0123456789ABCD", nested) == f"{secret_scan.PLACEHOLDER}CD"
