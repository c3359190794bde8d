import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lendframe.llm import decontaminate, minhash, suffix_dedup
from lendframe.llm.common import words_of
from lendframe.llm.queries import op1_suffix_dedup, op6_decontamination, op9_minhash


def shingle_set(text, width):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) or frozenset([tuple(words)])


def brute_components(docs, width, percent):
    sets = {i: shingle_set(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            common = len(a & b)
            if common and 100 * common >= percent * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, sf_dir, width, percent):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width, percent).collect()}
    assert got == brute_components([tuple(r) for r in docs.collect()], width, percent)


def test_large_group_of_near_copies(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    first = [r.choice(words) for _ in range(120)]
    docs = []
    for i in range(300):
        copy = list(first)
        for _ in range(r.randrange(0, 5)):
            copy[r.randrange(len(copy))] = r.choice(words)
        docs.append((i, " ".join(copy)))
    docs += [(1000 + i, docs[7][1]) for i in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in minhash.near_duplicates(frame, 3, 85).collect()}
    assert got == brute_components(docs, 3, 85)


def test_odd_rows_of_near_duplicates(spark):
    docs = [
        (5, "A b"), (3, "a  B"), (9, None), (8, ""), (7, " \t\n"), (None, "a b"), (6, "one two three four"),
        (6, "one two three four"), (4, "x " * 20_000),
    ]
    frame = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, n_shingles int")
    rows = minhash.near_duplicates(frame, 3, 85).collect()
    assert len(rows) == len(docs)
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert by_id == {
        5: (1, 3, False), 3: (1, 3, True), 9: (0, 9, True), 8: (0, 8, True), 7: (0, 7, True), 6: (2, 6, True),
        4: (1, 4, True),
    }
    assert [r.kept for r in rows if r.doc_id is None] == [True]
    assert minhash.near_duplicates(frame.limit(0), 3, 85).count() == 0


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(minhash.components(links).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_band_rows_and_bounds():
    for t in (0.8, 0.85, 0.95):
        assert (1 - t ** minhash.band_rows(t)) ** minhash.BANDS <= minhash.BAND_MISS
    least = minhash.least_matches(0.85)
    assert least == sorted(least) and 0 < least[-1] < minhash.COMPARED * 0.85


def test_kept_column_of_the_query(spark, sf_dir):
    rows = op9_minhash(spark, sf_dir).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def brute_passages(docs, length):
    seen, keys = defaultdict(set), {}
    for i, text in docs:
        words = words_of(text)
        keys[i] = [tuple(words[j : j + length]) for j in range(len(words) - length + 1)]
        for k in keys[i]:
            seen[k].add(i)
    out = set()
    for i, own in keys.items():
        spans = []
        for j, k in enumerate(own):
            if len(seen[k]) > 1:
                if spans and j <= spans[-1][1]:
                    spans[-1][1] = j + length
                else:
                    spans.append([j, j + length])
        out |= {(i, a, b) for a, b in spans}
    return out


def test_passages_equal_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = op1_suffix_dedup(spark, sf_dir).collect()
    assert {(r.doc_id, r.start_word, r.end_word) for r in rows} == brute_passages(docs, suffix_dedup.LENGTH)
    assert all(r.n_words == r.end_word - r.start_word and r.first_doc_id <= r.doc_id for r in rows)


@pytest.mark.parametrize("length", [8, 50])
def test_passages_in_shuffled_blocks(spark, length):
    r = random.Random(length)
    blocks = [[r.choice("abcdefg") for _ in range(r.randrange(length // 2, 3 * length))] for _ in range(12)]
    docs = [(i, " ".join(w for _ in range(4) for w in r.choice(blocks))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(x.doc_id, x.start_word, x.end_word) for x in suffix_dedup.passages(frame, length).collect()}
    assert got == brute_passages(docs, length)


def test_parts_name_a_copy_to_keep_of_every_stretch(spark):
    """First documents change within a passage: every shared window is left in one document at least."""
    length = 8
    r = random.Random(3)
    blocks = [[f"{k}.{j}" for j in range(r.randint(length, 30))] for k in range(9)]
    docs = [(i, " ".join(w for _ in range(3) for w in r.choice(blocks))) for i in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    first = {}
    for i, text in docs:
        words = words_of(text)
        for j in range(len(words) - length + 1):
            first.setdefault(tuple(words[j : j + length]), i)
    rows = suffix_dedup.passages(frame, length).collect()
    texts = {i: words_of(t) for i, t in docs}
    cut = False
    for x in rows:
        assert (x.parts[0].start_word, x.parts[-1].end_word) == (x.start_word, x.end_word)
        assert all(a.end_word == b.start_word for a, b in zip(x.parts, x.parts[1:]))
        assert min(p.first_doc_id for p in x.parts) == x.first_doc_id
        cut = cut or len(x.parts) > 1
        for p in x.parts:
            around = range(max(0, p.start_word - length + 1), min(p.end_word, len(texts[x.doc_id]) - length + 1))
            holders = {first[tuple(texts[x.doc_id][j : j + length])] for j in around}
            assert p.first_doc_id in holders
    assert cut


@pytest.mark.parametrize("rows_a_batch", [1, 2, 7, 1000])
def test_neighbours_in_batches_and_across_borders(rows_a_batch):
    import pandas as pd

    r = random.Random(rows_a_batch)
    rows = []
    for prefix in range(40):
        for stretch in range(r.choice([1, 1, 2, 5, 20])):
            lo = r.choice([prefix, prefix, r.randrange(50)])
            rows.append((prefix, stretch, lo, r.choice([lo, lo, lo + 1]), 0))
    frame = pd.DataFrame(rows, columns=["prefix", "stretch", "lo", "hi", "at"])
    cuts = sorted({0, len(rows), *(r.randrange(len(rows)) for _ in range(6))})
    out = []
    for a, b in zip(cuts, cuts[1:]):
        part = frame.iloc[a:b]
        batches = (part.iloc[i : i + rows_a_batch] for i in range(0, len(part), rows_a_batch))
        out += list(suffix_dedup._neighbours(batches))
    found = pd.concat(out)
    edges = found[found.kind == suffix_dedup.BORDER].groupby("prefix").agg({"lo": "min", "hi": "max", "n": "sum"})
    assert len(found[found.kind == suffix_dedup.BORDER]) <= 2 * (len(cuts) - 1)
    got = {}
    for x in found.itertuples():
        edge = edges.loc[x.prefix] if x.prefix in edges.index else None
        if x.kind == suffix_dedup.ALIKE:
            got[x.prefix, x.stretch] = x.n > 1
        elif x.kind == suffix_dedup.UNSURE and edge.lo != edge.hi:
            got[x.prefix, x.stretch] = edge.n > 1
    runs = frame.groupby("prefix").agg({"lo": "min", "hi": "max", "stretch": "size"})
    want = {(p, q): bool(runs.loc[p].stretch > 1) for p, q, *_ in rows if runs.loc[p].lo != runs.loc[p].hi}
    assert got == want


def test_odd_rows_of_passages(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(1, long), (1, long), (2, None), (3, ""), (None, long), (4, "short text"), (5, "same " * 200)]
    frame = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, prefix int")
    assert suffix_dedup.passages(frame).count() == 0
    again = frame.unionByName(spark.createDataFrame([(8, "intro " + long, 0)], frame.schema))
    rows = {(r.doc_id, r.start_word, r.end_word, r.first_doc_id) for r in suffix_dedup.passages(again).collect()}
    assert rows == {(1, 0, 60, 1), (8, 1, 61, 1)}
    assert suffix_dedup.passages(frame.limit(0)).count() == 0


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        after = [i + 1]
        for j, d in enumerate(text):
            after.append(min(after[-1] + 1, row[j + 1] + 1, row[j] + (c != d)))
        row = after
    return min(row)


def test_myers_equals_the_plain_table():
    r = random.Random(1)
    for _ in range(500):
        p = [r.randrange(4) for _ in range(r.randint(1, 70))]
        t = [r.randrange(4) for _ in range(r.randint(0, 90))]
        assert decontaminate.myers(p, t)[0] == plain_distance(p, t)


def test_matches_equal_brute_force_on_edited_passages():
    r = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    items = [(k, " ".join(r.choice(words) for _ in range(r.randint(5, 40)))) for k in range(12)]
    matcher = decontaminate.Matcher(items, 0.2, 5)
    for _ in range(60):
        text = [r.choice(words) for _ in range(30)]
        for _ in range(2):
            passage = r.choice(items)[1].split()
            for _ in range(r.randint(0, len(passage) // 4)):
                at = r.randrange(len(passage))
                passage[at : at + 1] = r.choice([[], ["new"], [passage[at], "new"]])
            text[r.randrange(30) : 0] = passage
        got = {(i, d) for i, d, _, _, _ in matcher.matches(" ".join(text))}
        want = set()
        for k, t in items:
            p = t.split()
            d = plain_distance(p, text)
            if d <= int(0.2 * len(p)):
                want.add((k, d))
        assert got == want


def test_verbatim_items_are_found(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in op6_decontamination(spark, sf_dir).collect()}
    inside = {(d, i) for d, t in docs.items() for i, x in items.items() if t and x and x in t}
    assert inside and inside <= {k for k, d in got.items() if d == 0}


def test_odd_rows_and_blocks_of_items(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame(
        [(1, "x " + item.upper() + "!", 1), (1, "x " + item.upper() + "!", 1), (2, None, 1), (3, "", 1), (None, item, 1)],
        "doc_id long, text string, item_id int",
    )
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (None, item), (9, "few words")], "item_id long, text string")
    rows = decontaminate.matches(docs, items).collect()
    assert Counter((r.doc_id, r.item_id, r.start_word, r.end_word) for r in rows) == Counter(
        {(1, 7, 1, 21): 2, (None, 7, 0, 20): 1}
    )
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {2, 3}
    assert decontaminate.matches(docs, items.limit(0)).count() == 0
    assert decontaminate.matches(docs.limit(0), items).count() == 0
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)
    assert decontaminate.matches(docs, items).count() == len(rows)


def test_signature_matches_estimate_similarity():
    sketcher = minhash.Sketcher(3, 0.85)
    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join(f"w{i}" if i % 100 else f"v{i}" for i in range(400))
    x, y = (np.frombuffer(sketcher.sketch(t)[3], np.uint16) for t in (a, b))
    p, q = shingle_set(a, 3), shingle_set(b, 3)
    assert abs((x == y).mean() - len(p & q) / len(p | q)) < 0.12


def test_short_items_unspaced_scripts_and_items_without_id(spark):
    chinese = "".join(chr(0x4E00 + 37 * i) for i in range(60))
    items = spark.createDataFrame(
        [(1, "Capital of France?"), (2, chinese), (None, "an item that has no id of its own"), (None, "?!"), (3, "x")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [
            (1, "The capital, of France is"), (2, "capital of a France"), (3, "前文。" + chinese[:20] + "，" + chinese[20:40] + "错" + chinese[41:] + "后文"),
            (4, chinese[:30]), (5, "here an item that has no id of its own stands"), (6, "xy ?!"),
        ],
        "doc_id long, text string",
    )
    found = {(r.doc_id, r.item_id, r.distance, r.item_words) for r in decontaminate.matches(docs, items).collect()}
    assert found == {(1, 1, 0, 3), (3, 2, 1, 60), (5, None, 0, 9)}
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {2, 4, 6}
