import gzip
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.llm import html_template, topk, url_rules, warc
from lendframe.llm.queries import HOST_RULES, op4_html_template, op8_url_rules, op10_warc


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_plain_article():
    html = page(
        "<nav><ul><li><a href='/x'>Menu</a></li></ul></nav><div class=\"ad\">Buy</div>"
        "<article><h1>T &amp; U</h1><p>One\n two<br>three</p><p><b>Four</b> &lt;five&gt;</article><footer>&copy; me</footer>"
    )
    assert html_template.text_of(html, None) == "T & U\n\nOne two three\n\nFour <five>"


def test_pages_without_article_and_with_clutter():
    html = page(
        "<header><h2>Site</h2></header><div id='cookie-notice'>We use cookies</div>"
        "<div class='wrap'><div class='sidebar'>Links</div><div class='post-body'><h1>Title</h1>"
        "<p>A long paragraph of the real text, with <a href='#'>a link</a> inside.</p>"
        "<div class='advert'>Buy now</div><ul><li>first</li><li>second</li></ul>"
        "<form><input name=q><button>Go</button></form></div>"
        "<section id='comments'><p>Reader: nice!</p></section></div><script>var t = '</p>';</script>"
    )
    want = "Title\n\nA long paragraph of the real text, with a link inside.\n\nfirst\n\nsecond"
    assert html_template.text_of(html, None) == want


@pytest.mark.parametrize(
    "name", ["layout has-sidebar", "with-comments", "no-footer", "page-widget", "social", "related", "hidden", "search"]
)
@pytest.mark.parametrize("inner", ["article", "main", "div class='inner'"])
def test_wrappers_of_the_main_text_are_no_boilerplate(name, inner):
    clutter = "<div class='sidebar'>Links</div><div class='ad'>Buy</div>"
    html = page(f"<div class='{name}'>{clutter}<{inner}><p>The real text of the page, in full.</p></{inner.split()[0]}></div>")
    assert html_template.text_of(html, None) == "The real text of the page, in full."


def test_long_comments_and_notices_stay_boilerplate():
    long = "<p>" + "words of others " * 50 + "</p>"
    comments = f"<div class='comments'><div class='text'>{long}</div></div><div class='site-footer'>{long}</div>"
    for inner in ("article", "div class='content'"):
        html = page(f"<{inner}><p>Short.</p></{inner.split()[0]}>{comments}")
        assert html_template.text_of(html, None) == "Short."
        html = page(f"<div class='has-comments'><{inner}><p>Short.</p>{comments}</{inner.split()[0]}></div>")
        assert html_template.text_of(html, None) == "Short."
    assert html_template.text_of(page("<p>Short.</p><div class='cookie-notice'>" + long + "</div>"), None) == "Short."


def test_a_wrapper_of_the_host_slot_is_no_boilerplate(spark):
    def of(n):
        text = "<p>" + "words here " * n + "</p>"
        return page(f"<div class='social'><div class='b'>{text}</div></div><div class='a'><p>fifteen letters</p></div>")

    pages = spark.createDataFrame([(n, "http://h.example/", of(n)) for n in (1, 20, 30, 40)], "page_id long, url string, html string")
    text = {r.page_id: r.text for r in html_template.extract(pages).collect()}
    assert text == {n: " ".join(["words here"] * n) for n in (1, 20, 30, 40)}


@pytest.mark.parametrize("html", [None, "", "<", "<html><body></body></html>", "<!-- <p>x</p> -->", "<script>x"])
def test_pages_without_text(html):
    assert html_template.text_of(html, None) in ("", "<")


def test_broken_markup_keeps_text():
    assert html_template.text_of("<p>one <b>two<p>three </i></div>", None) == "one two\n\nthree"
    assert html_template.text_of("just text &eacute; a < b", None) == "just text é a < b"


def test_slot_comes_from_the_host(spark):
    def of(n):
        return page(f"<div class='a'><p>{'short ' * (n % 3)}</p></div><div class='b'><p>{'words here ' * (20 + n)}</p></div>")

    rows = [(i, f"http://h.example/{i}", of(i)) for i in range(9)]
    rows.append((9, "http://h.example/9", page("<div class='a'><p>" + "other " * 90 + "</p></div><div class='b'><p>tiny</p></div>")))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    slot = html_template.templates(pages).collect()
    assert [r.host for r in slot] == ["h.example"] and slot[0].slot.endswith("div.b")
    text = {r.page_id: r.text for r in html_template.extract(pages).collect()}
    assert text[9] == "tiny" and text[3].startswith("words here")


def site_pages(n, notice, spot="<p>{}</p>", host="h.example", extra=lambda i: ""):
    """Pages of one host: articles of their own, with `notice` inside the main container where it is not None."""
    out = []
    for i in range(n):
        paragraphs = [f"<p>Text {i} {j} of its own, told in some more words than the notice has.</p>" for j in range(2 + i % 4)]
        said = spot.format(notice(i)) if notice(i) else ""
        body = f"<div class='x'><h1>Head {i}</h1>{said}{''.join(paragraphs)}{extra(i)}</div>"
        out.append((i, f"http://{host}/{i}", page(f"<div class='top'>Site name</div>{body}<div class='low'>End words</div>")))
    return out


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in html_template.extract(pages).collect()}


def written(i, *more):
    return "\n\n".join(
        [f"Head {i}", *(f"Text {i} {j} of its own, told in some more words than the notice has." for j in range(2 + i % 4)), *more]
    )


@pytest.mark.parametrize("spot", ["<p>{}</p>", "<div class='q'><p>{}</p></div>", "<ul><li>{}</li></ul>"])
def test_a_notice_repeated_inside_the_main_slot_goes(spark, spot):
    got = extracted(spark, site_pages(30, lambda i: "Prices may change at any time.", spot))
    assert got == {i: written(i) for i in range(30)}


def test_a_notice_in_an_element_of_its_own_on_most_pages_goes(spark):
    got = extracted(spark, site_pages(30, lambda i: "Prices may change." if i % 5 else None, "<section><p>{}</p></section>"))
    assert got == {i: written(i) for i in range(30)}


def test_text_that_repeats_on_a_few_pages_or_without_order_stays(spark):
    shared = "A passage that some articles of the host quote."
    rows = site_pages(30, lambda i: None, extra=lambda i: f"<p>{shared}</p>" if i in (4, 9) else "")
    assert extracted(spark, rows) == {i: written(i, *[shared] * (i in (4, 9))) for i in range(30)}
    # On nine pages in all there is too little to tell a template from chance.
    rows = site_pages(9, lambda i: "Prices may change.")
    assert all("Prices may change." in t for t in extracted(spark, rows).values())


def test_families_of_copies_stay_whole(spark):
    """Pages that differ only in a date share all of their article: it is no template."""
    article = "".join(f"<p>Sentence {j} of the article that all copies hold.</p>" for j in range(5))
    rows = [(i, f"http://h.example/{i}", page(f"<div class='x'><h1>Day {i}</h1>{article}</div>")) for i in range(20)]
    for i, text in extracted(spark, rows).items():
        assert text.split("\n\n") == [f"Day {i}", *(f"Sentence {j} of the article that all copies hold." for j in range(5))]
    rows = [(i, "http://h.example/", rows[0][2]) for i in range(40)]
    assert all(len(t.split("\n\n")) == 6 for t in extracted(spark, rows).values())


def brute_template(htmls):
    """Text tokens of the template of one host, from all occurrence vectors, orders and gaps in plain Python."""
    distinct = sorted(set(htmls))
    found = [html_template.tokens_of(h) for h in distinct]
    vectors = {}
    for t in {t for f in found for t in f}:
        vectors[t] = tuple(f[t].n if t in f else 0 for f in found)
    support = {t: sum(map(bool, v)) for t, v in vectors.items()}
    alike = {}
    for t, v in vectors.items():
        if support[t] >= html_template.SUPPORT and 2 * support[t] > len(distinct):
            alike.setdefault(v, set()).add(t)
    is_tag = {t: x.tag for f in found for t, x in f.items()}
    alike = {v: c for v, c in alike.items() if len(c) > 1 and any(is_tag[t] for t in c)}
    known = set().union(*alike.values()) if alike else set()
    kept = set()
    for members in alike.values():
        before, gaps = {}, set()
        for f in found:
            if not members <= set(f):
                continue
            ordered = sorted(members, key=lambda t: f[t].first)
            for a, b in zip([None, *ordered], ordered):
                in_order = a is None or f[b].last > f[a].last
                before.setdefault(b, set()).add(a if in_order else "not in order")
            for t in members:
                higher = [u for u in known if u in f and f[u].first < f[t].first and support[u] > support[t]]
                gaps.add(max(higher, key=lambda u: f[u].first, default=None))
        if len(gaps) == 1:
            kept |= {t for t in members if not is_tag[t] and len(before[t]) == 1 and before[t] != {"not in order"}}
    return kept


def test_template_equals_brute_force(spark):
    rng = np.random.default_rng(5)

    def body(i):
        parts = [f"<h1>Head {i}</h1>", *(f"<p>Own words {i} {j}, long enough to be the most of the page.</p>" for j in range(rng.integers(2, 6)))]
        for k in range(6):
            if rng.random() < (1.0, 0.9, 0.7, 0.4, 1.0, 0.8)[k]:
                parts.insert(rng.integers(1, len(parts)) if k > 3 else min(k + 1, len(parts)), f"<div class='k{'abcdef'[k]}'><p>Told by all {k}</p></div>")
        return page(f"<div class='x'>{''.join(parts)}</div><div class='low'><span>End</span></div>")

    rows = [(i, f"http://{host}/", body(i)) for host, n in (("a", 25), ("b", 12), ("c", 5)) for i in range(n)]
    rows += rows[:7]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.host: set(r.texts or ()) for r in html_template.templates(pages).collect()}
    want = {h: brute_template([x for _, u, x in rows if u == f"http://{h}/"]) for h in "abc"}
    assert got == want and want["a"] and not want["c"]


def test_deep_and_long_pages_take_linear_time():
    import time

    start = time.time()
    deep = page("<div>" * 20_000 + "<p>Deep text.</p>" + "</div>" * 20_000)
    assert html_template.text_of(deep, None) == "Deep text."
    named = page("<div class='social'>x" * 10_000 + "<p>Deep text.</p>" + "</div>" * 10_000)
    assert html_template.text_of(named, None) == ""  # below names of the lexicon only
    assert html_template.text_of(page("<article>" + "<p>word</p>" * 50_000 + "</article>"), None).count("word") == 50_000
    assert time.time() - start < 30


def test_pages_query_against_the_written_articles(spark, sf_dir):
    import html as entities
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in op4_html_template(spark, sf_dir).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", article)
        plain = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in plain if b)
        assert r.n_chars == len(r.text)


def test_odd_page_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, None, 1), (1, None, None, 1), (None, "x", page("<p>text</p>"), 1), (2, "http://h/", "", 1)],
        "page_id long, url string, html string, slot int",
    )
    rows = sorted((r.text, r.n_chars) for r in html_template.extract(pages).collect())
    assert rows == [("", 0), ("", 0), ("", 0), ("text", 4)]
    assert html_template.extract(pages.limit(0)).count() == 0


def brute_top(rows, queries, k):
    v = {i: [int(np.floor(256 * float(np.float32(x)))) for x in e] for i, e in rows}
    out = set()
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q and len(v[c]) == len(v[q]))
        out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])}
    return out


def test_search_equals_brute_force_with_ties_and_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "FIRST_SHARD", 10)
    r = np.random.default_rng(3)
    rows = [(int(i), r.normal(0, 0.2, 8).astype("float32").tolist()) for i in range(400)]
    rows = [(i, rows[7][1] if 20 <= i < 90 else e) for i, e in rows] + [(1000, [0.5, 0.5]), (1001, [1.0, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = topk.top_k(frame, frame.where("vec_id % 50 = 0"), 5).collect()
    assert {tuple(x) for x in got} == brute_top(rows, [i for i, _ in rows if i % 50 == 0], 5)


def test_huge_components_are_exact(spark):
    rows = [(i, [float(2**40 + i * 4096), float(i)]) for i in range(6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    first = [r.vec_id for r in topk.top_k(frame, frame.where("vec_id = 0"), 2).orderBy("rank").collect()]
    assert len(first) == 2


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 0.0], 1), (4, [float("inf"), 0.0], 1),
        (None, [1.0, 1.0], 1), (5, [], 1), (6, [0.5, 0.5], 1), (6, [0.5, 0.5], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = topk.top_k(frame, frame.where("vec_id % 50 = 0"), 5).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 6, 256 * 128 + 512 * 128)] * 2
    assert topk.top_k(frame.limit(0), frame.limit(0), 5).count() == 0


def test_hosts_and_paths(spark):
    urls = [
        None, "no scheme", "http://A.Example.ORG/es/1?x#y", "https://x.com", "://h?q://z/", "http://É.com/de/", "a://b://c/d",
    ]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = frame.select("page_id", url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url"))).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("", ""), ("", ""), ("a.example.org", "/es/1"), ("x.com", ""), ("h", ""), ("É.com", "/de/"), ("b:", "//c/d"),
    ]


def test_longest_host_rule_wins(spark):
    urls = {
        "http://x.org/": ("org/", "allow"),
        "http://example.org/es/a": ("example.org/es/", "block"),
        "http://a.example.org/en/12": ("example.org/en/1", "block"),
        "http://myexample.org/es/a": ("org/", "allow"),
        "http://q.com/fr/": ("com/fr/", "allow"),
        "http://q.com/de/1": ("com/de/", "block"),
        "http://q.com/en": (None, "allow"),
        "http://x.org": (None, "allow"),
    }
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    none = url_rules.mine(frame.limit(0).select("url", F.lit(True).alias("bad")))
    rows = url_rules.judge(frame, HOST_RULES, none).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in rows] == list(urls.values())


def test_mined_rules_equal_brute_force(spark):
    urls = [(f"http://{'spam' if i % 4 == 0 else 'good'}.example.net/{'win' if i % 3 else 'read'}/{i}", i % 4 == 0 and i % 3 > 0) for i in range(400)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    mined = url_rules.mine(labelled, 0.01, 5, 0.8)
    baskets = [(set(r.t), r.bad) for r in labelled.select(url_rules.tokens_of(F.col("url")).alias("t"), "bad").collect()]
    for r in mined.collect():
        hold = [bad for t, bad in baskets if set(r.tokens) <= t]
        assert sum(hold) / len(hold) == pytest.approx(r.confidence) and r.confidence >= 0.8
        assert sum(hold) / len(baskets) == pytest.approx(r.support)
    rules = [set(r.tokens) for r in mined.collect()]
    assert {"host=spam", "path=win"} in rules
    asked = spark.createDataFrame([(u,) for u, _ in urls], "url string")
    hit = {r.url for r in url_rules.matched(asked, mined).collect()}
    of = {r.url: set(r.t) for r in asked.select("url", url_rules.tokens_of(F.col("url")).alias("t")).collect()}
    assert hit == {u for u, t in of.items() if any(x <= t for x in rules)}
    verdicts = url_rules.judge(asked.withColumn("page_id", F.lit(1)), (), mined).where("verdict = 'block'").count()
    assert verdicts == len([u for u, _ in urls if u in hit])


def test_url_query_plan_has_no_python(spark, sf_dir):
    rows = op8_url_rules(spark, sf_dir)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert rows.count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()


def test_arc_versions_by_declared_length():
    one = b"filedesc://a 0.0.0.0 20240101000000 text/plain 9\n1 0 x\nURL\n\nhttp://a b 1.2.3.4 20200102030405 text/html 5\n\n\nabc\n"
    two = b"filedesc://a 0.0.0.0 20240101000000 text/plain 200 - - 0 f 9\n2 0 x\nURL\n\nhttp://a 1.2.3.4 20200102030405 text/html 200 - - 0 f 3\nxyz\n"
    assert [(f[0], f[2], b) for f, b in warc.arc_records(one)] == [("http://a b", "20200102030405", b"\n\nabc")]
    assert [(f[0], len(f), b) for f, b in warc.arc_records(two)] == [("http://a", 10, b"xyz")]
    with pytest.raises(ValueError, match="broken"):
        list(warc.arc_records(one[:-4]))


def test_gzip_members():
    assert warc.inflate(gzip.compress(b"a") + gzip.compress(b"b")) == b"ab"
    assert warc.inflate(b"plain") == b"plain"


def test_archives_round_trip_odd_rows(spark):
    big = "WARC/1.1\r\n\r\n\n" + "é" * 800
    rows = [
        (1, "http://a/x y\n", big, 0), (2, None, big, 0), (3, "http://b/", big, 0), (4, "", None, 0), (5, "http://c", "", 0),
        (6, "http://d", "small", 0), (7, "http://e", "small", 0), (None, "http://f", big, 0), (8, "http://g", "lone" * 300, 0),
        (8, "http://g", "lone" * 300, 0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, head int").repartition(3)
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.archive(pages).collect()}

    def row(i, kind, target, html):
        raw = (html or "").encode()
        return i, kind, target, len(raw), hashlib.sha1(raw).hexdigest()

    assert got == {
        row(1, "revisit", 3, big), row(2, "revisit", 3, big), row(3, "response", None, big), row(4, "response", None, None),
        row(5, "response", None, ""), row(6, "response", None, "small"), row(7, "response", None, "small"),
        row(None, "revisit", 3, big), row(8, "response", None, "lone" * 300),
    }
    assert warc.archive(pages.limit(0)).count() == 0


def test_archive_query_counts(spark, sf_dir):
    rows = op10_warc(spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
