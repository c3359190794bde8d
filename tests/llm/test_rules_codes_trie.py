"""Rule forest, vector codes and conversation trie against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.llm import conversation_trie, rule_forest, vector_codes
from lendframe.llm.common import held_out, read_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Rule forest


def counts_of(text):
    """The base counts by their definitions."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(lines[i] in lines[:i] for i in range(len(lines))),
        len(covered),
    )


ODD_TEXTS = [
    None, "", " \t\n\r\x0b\x0c", "one", "a b c d e f g h", "a " * 9, "x\nx\n\nx \nx", "#*$ %&|<>", "\x1c one\x85two three éß \U0001f600",
    "w " * 40, " ".join(f"w{i % 8}" for i in range(16)), " ".join(f"w{i % 9}" for i in range(17)), "a\r\nb\r\na\r\n",
]


def test_counts_equal_their_definitions():
    source = random.Random(3)
    made = [" ".join(source.choice("abc") for _ in range(source.randint(0, 60))) for _ in range(200)]
    made += ["\n".join(source.choice(["a b", "c", "", " "]) for _ in range(source.randint(0, 9))) for _ in range(60)]
    for text in ODD_TEXTS + made:
        assert rule_forest.measure(text)[:5] == counts_of(text), repr(text)


def test_verdicts_on_the_given_documents(spark, sf_dir):
    where = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = read_table(spark, where, "documents"), read_table(spark, where, "labels")
    got = rule_forest.judge(docs, labels.where(~held_out(F.col("doc_id")))).cache()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, _, _, _, repeats = want = counts_of(texts[r.doc_id])
        assert tuple(r[c] for c in rule_forest.COUNTS) == want
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert not (r.base_failed and r.kept)
    # Labels that calibrated nothing: poor documents go, good ones that pass the base rules stay.
    known = labels.where(held_out(F.col("doc_id"))).join(got, "doc_id").collect()
    poor = [r.kept for r in known if r.quality == 0]
    good = [r.kept for r in known if r.quality == 1 and not r.base_failed]
    assert sum(poor) <= 0.05 * len(poor) and sum(good) >= 0.97 * len(good)


def test_the_tree_splits_every_point_by_its_statistics():
    points = np.random.default_rng(1).normal(size=(256, 3))
    nodes = rule_forest.grow(points, 7)

    def depth(x, at=0, d=0):
        j = int(nodes[at, 0])
        if j < 0:
            return nodes[at, 4]
        return depth(x, int(nodes[at, 2 if x[j] <= nodes[at, 1] else 3]), d + 1)

    forest = rule_forest.RuleForest((nodes,), rule_forest.expected_path(256))
    odd = np.array([[9.0, 9.0, 9.0]])
    want = [2 ** (-depth(x) / rule_forest.expected_path(256)) for x in [*points, odd[0]]]
    assert np.allclose(forest.anomaly(np.vstack([points, odd])), want)
    many = rule_forest.RuleForest(tuple(rule_forest.grow(points, s) for s in range(50)), rule_forest.expected_path(256))
    assert many.anomaly(odd)[0] > np.quantile(many.anomaly(points), 0.98)
    assert rule_forest.expected_path(2) == pytest.approx(1.0) and rule_forest.expected_path(1) == 0
    # Points that are all alike cannot be split.
    assert rule_forest.grow(np.ones((5, 3)), 1).tolist() == [[-1, 0, 0, 0, rule_forest.expected_path(5)]]


def test_rule_forest_takes_odd_rows(spark):
    names = ["n_words", "base_failed", "kept", "anomaly", "_tree", "_place", "_statistics", "_n"]
    rows = [(i, t, *["x"] * len(names)) for i, t in enumerate(ODD_TEXTS)] * 2 + [(None, "word " * 30, *["x"] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    labels = spark.createDataFrame([(9, 1), (9, 0), (10, None), (None, 1)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0)):
        got = rule_forest.judge(docs, marks).collect()
        assert len(got) == len(rows)
        assert sorted(str(tuple(r[c] for c in rule_forest.COUNTS)) for r in got) == sorted(str(counts_of(r[1])) for r in rows)
        assert all(r.kept == (not r.base_failed) for r in got)
    assert rule_forest.judge(docs.limit(0), labels).count() == 0


def test_a_very_long_text_is_measured_whole(spark):
    text = " ".join(map(str, range(400_000)))
    docs = spark.createDataFrame([(1, text + " " + text)], "doc_id long, text string")
    got = rule_forest.judge(docs, spark.createDataFrame([], "doc_id long, quality int")).first()
    assert (got.n_words, got.n_repeat_words, got.base_failed) == (800_000, 800_000, True)


# Vector codes


def codes_of(rows, parts=8, entries=16, rounds=6):
    """The same rounds with Python integers only: {row: (code, error)} and the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return {}, []
    own = -(-max(len(r[1]) for r in kept) // parts)
    ints = [[max(-(1 << 48), min(1 << 48, math.floor(4096 * x))) for x in r[1]] + [0] * (own * parts - len(r[1])) for r in kept]
    first = {}
    for r, v in sorted(zip(kept, ints), key=lambda p: (p[0][0] is None, p[0][0] or 0, p[0][1])):
        first.setdefault(r[0], v)
    cut = lambda v, p: v[p * own : (p + 1) * own]
    books = [[cut(v, p) for v in list(first.values())[:entries]] for p in range(parts)]

    def near(v, p):
        away = [sum((a - b) ** 2 for a, b in zip(cut(v, p), c)) for c in books[p]]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        at = [[near(v, p)[0] for p in range(parts)] for v in ints]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(v, p) for v, a in zip(ints, at) if a[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for r, v in zip(kept, ints):
        found = [near(v, p) for p in range(parts)]
        out.append((r[0], "".join(f"{i:02x}" for i, _ in found), min((1 << 63) - 1, sum(d for _, d in found)), r[2]))
    sums = Counter()
    for _, _, d, label in out:
        sums[label] += d
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(*o[:3], min((1 << 63) - 1, sums[o[3]]), sha) for o in out]


def vectors(spark, rows, extra=()):
    layout = "vec_id long, embedding array<double>, label int" + "".join(f", {c} string" for c in extra)
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], layout)


def matches(spark, rows):
    got = vector_codes.compress(vectors(spark, rows, ("code", "error", "_key", "_id", "_label", "_vector", "label_error")))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, codes_of(rows)))


@pytest.mark.parametrize("size", [1.0, 300.0, 1e5, 1e9])
def test_codes_equal_integer_arithmetic_at_any_magnitude(spark, size):
    source = random.Random(int(size))
    rows = [(i, [source.gauss(0, size) for _ in range(24)], source.choice([0, 1, None])) for i in range(60)]
    matches(spark, rows)


def test_codes_take_odd_rows(spark):
    source = random.Random(5)
    vec = lambda n: [source.uniform(-1, 1) for _ in range(n)]
    same = vec(16)
    rows = [(i % 20, same if i % 3 else vec(16), i % 2) for i in range(50)]
    rows += [(None, vec(16), 1), (None, None, 1), (3, [1.0, None], 0), (4, [math.nan] * 16, 0), (5, [math.inf] + vec(15), 0)]
    rows += [(70, vec(3), 0), (71, [], None), (72, vec(17), None), (73, [1e300] * 16, 2)]
    matches(spark, rows)
    matches(spark, rows[:3])
    assert vector_codes.compress(vectors(spark, [(1, None, 0)])).count() == 0
    assert vector_codes.compress(vectors(spark, [(1, None, 0)]).limit(0)).count() == 0


@pytest.mark.parametrize("top", [5, 1 << 20, 1 << 27, 1 << 40])
def test_dot_products_are_exact(top):
    source = np.random.default_rng(top)
    x, c = source.integers(-top, top + 1, (40, 96)), source.integers(-top, top + 1, (16, 96))
    x[0], c[0] = top, -top
    want = x.astype(object) @ c.T.astype(object)
    wide = 96 * top * top * 4 >= 1 << 63
    assert (vector_codes.dots(x, c, wide) == want).all()


# Conversation trie


def nodes_of(rows):
    """Every distinct prefix by its definition."""
    by = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            by.setdefault(c, []).append(((t is not None, t or 0), hashlib.md5(f"{len(r)}:{r}:{x}".encode()).digest(), r, x))
    by = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}
    members, ends, children = {}, {}, {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = by.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    totals = {}
    for k in sorted(members, key=len, reverse=True):
        own = (len(members[k]) - 1) * len(WORD.findall(k[-1][1])) if k else 0
        below = [totals[c] for c in children.get(k, ())]
        totals[k] = sum(n for n, _ in below) or 1, own + sum(s for _, s in below)
    return [
        (
            min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, ())), *totals[k],
            hashlib.sha256(",".join(map(str, sorted(ends.get(k, ())))).encode()).hexdigest(),
        )
        for k, m in members.items()
    ]


def same_trie(spark, rows, *bounds, extra=()):
    layout = "conv_id long, turn long, role string, text string" + "".join(f", {c} string" for c in extra)
    df = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], layout)
    got = conversation_trie.trie(df, *bounds).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, nodes_of(rows)))


@pytest.mark.parametrize("bounds", [(), (12, 3), (1, 1)])
def test_trie_equals_its_definition(spark, bounds):
    """With bounds so small that there are many shards, many nodes above them, and spilled runs."""
    source = random.Random(8)
    rows = []
    for c in range(90):
        rows += [(c, t, source.choice(["user", "assistant"]), source.choice(["a", "b b", "c c c"])) for t in range(source.randint(1, 7))]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 240) for t in range(4)]
    same_trie(spark, rows, *bounds)


def test_trie_takes_odd_rows(spark):
    rows = [
        (None, 1, "user", "gone"), (1, None, None, None), (1, None, "user", None), (1, 2, "", "x"), (1, 2, "", "x"),
        (-7, 1, "user", "below zero"), (-7, 5, "a", "b"), (20, 1, "a", ""), (23, 9, "u", "  \x1c"), (23, 3, "u", "lone"),
        (41, 1, "ab", "c"), (42, 1, "a", "bc"), (10**15, 0, "user", "w " * 5_000), (60, 1, "x", "y"), (60, 1, "x", "z"),
    ]
    clash = ("depth", "k1", "place", "digest", "length", "_node", "n_convs", "words")
    same_trie(spark, rows, extra=clash)
    same_trie(spark, rows[:1] + rows[5:6], extra=clash)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie.trie(empty).count() == 0
    assert conversation_trie.trie(spark.createDataFrame(rows[:1], empty.schema)).count() == 0


def test_a_long_conversation_and_a_busy_end(spark):
    rows = [(100, t, "user", f"turn {t % 3}") for t in range(2_500)] + [(c, 0, "user", "hello") for c in range(1_000, 15_000)]
    same_trie(spark, rows, 300, 50)


def test_the_queue_gives_what_was_put_in():
    source = random.Random(2)
    queue = conversation_trie.SpillingQueue(most=5)
    put = [(source.randint(-4, 0), source.randint(0, 5), i) for i in range(300)]
    for m in put:
        queue.push(m)
    assert queue.spills > 10
    out = [m for key in sorted({m[:2] for m in put}) for m in queue.pop_for(key)]
    assert out == sorted(put) and not list(queue.pop_for((0, 0)))
