"""Each operator of the subpackage against brute force or a defined case:
nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.llm import (dart_minhash, decontam, html_text, license_scan, line_dedup, mixing, repetition, toxicity,
                          url_filter, warc)
from tramline.llm.components import components
from tramline.llm.shingles import WordHashes, shingles, weighted_jaccard

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, id int, h string"


def docs_frame(spark, rows):
    """Documents with extra columns that are named like working columns."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "r", 1, "h") for i, t, s in rows], DOCS)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


# --- line dedup -----------------------------------------------------------

def removed_by_hand(rows):
    seen, gone = set(), {}
    order = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        lines = t.split("\n")
        cover = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if not "".join(w).strip(" "):
                continue
            if w in seen:
                cover |= {p, p + 1, p + 2}
            seen.add(w)
        gone[i, t] = "\n".join(x for p, x in enumerate(lines) if p not in cover) if cover else t
    return gone


def test_line_windows(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("abcd ") for _ in range(rng.randint(0, 12)))) for i in range(40)]
    rows += [(None, "a\nb\nc\nd"), (100, None), (101, ""), (102, "\n\n\n\n"), (103, "x\n" * 5000 + "end"), rows[5]]
    got = line_dedup.dedup_lines(docs_frame(spark, [(*r, "s") for r in rows]))
    assert got.columns == [c.split()[0] for c in DOCS.split(", ")]
    want = removed_by_hand(rows)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        ((i, want.get((i, t), t)) for i, t in rows), key=str)
    assert line_dedup.dedup_lines(got.limit(0)).count() == 0


# --- near duplicates --------------------------------------------------------

def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        e = np.unique(rng.integers(0, 2 ** 62, int(rng.integers(5, 400))).astype(np.uint64))
        w = rng.integers(1, 6, len(e))
        v = np.maximum(1, w - (rng.random(len(e)) < 0.3) * rng.integers(0, 4, len(e)))
        a, b = dart_minhash.dart_signatures([(e, w), (e, v)])
        errors.append((a == b).mean() - weighted_jaccard((e, w), (e, v)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def classes_by_hand(texts):
    words = WordHashes()
    sets = [shingles(t, words) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i][0]) and weighted_jaccard(sets[i], sets[j]) >= 0.8:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_near_duplicate_classes(spark, monkeypatch):
    monkeypatch.setattr(dart_minhash, "CELL", 10)       # the large group is dealt to several tasks
    monkeypatch.setattr(dart_minhash, "BLOCK", 6)
    rng = random.Random(5)
    texts = [prose(rng, 60) for _ in range(15)]
    base = prose(rng, 150).split()
    for _ in range(40):
        near = list(base)
        for p in rng.sample(range(150), rng.choice((1, 2, 3, 12))):
            near[p] = "zz" + near[p]
        texts.append(" ".join(near))
    texts += [texts[0], texts[0].upper(), "one two", "one two", "a b c d e", "w " * 3000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(500, None, "s"), (501, "", "s"), (502, " \n", "s")]
    frame = docs_frame(spark, rows)
    got = {r.id: r.rep.id for r in dart_minhash.near_duplicates(frame).collect()}
    assert got == dict(enumerate(classes_by_hand(texts)))
    again = frame.unionByName(docs_frame(spark, [(500, None, "s"), (2, texts[2], "s"), (None, texts[3], "s")]))
    kept = dart_minhash.drop_near_duplicates(again)
    assert kept.columns == frame.columns
    want = sorted((set(got.values()) - {3}) | {None}, key=str) + [500, 500, 501, 502]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    assert dart_minhash.drop_near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [400, 10])
def test_links_near_the_threshold(spark, monkeypatch, cell):
    monkeypatch.setattr(dart_minhash, "CELL", cell)
    monkeypatch.setattr(dart_minhash, "BLOCK", cell // 2)
    rng = random.Random(11)
    texts = []
    for _ in range(6):                                  # most pairs lie just under 0.8, few above
        base = prose(rng, 400).split()
        for _ in range(25):
            near = list(base)
            for p in rng.sample(range(400), rng.choice((4, 5, 5, 6))):
                near[p] = "zz" + near[p]
            texts.append(" ".join(near))
    got = {r.id: r.rep.id for r in dart_minhash.near_duplicates(docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    want = classes_by_hand(texts)
    assert len(set(want)) > 12 and got == dict(enumerate(want))


def test_texts_of_any_white_space_stay_alone(spark, tmp_path):
    blank = ["\u00a0", "\u3000 \u2003", "\u0085\n", "\x1c\x1d\x1e\x1f", " \t", "", None]
    rows = [(i, t, "s") for i, t in enumerate(blank)] + [(50, "one two", "s"), (51, "\u00a0one\u3000two", "s"), (52, "\x00", "s")]
    docs_frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.class_id, r.class_size, r.kept) for r in dart_minhash.op3_dart_minhash(spark, str(tmp_path)).collect()}
    assert got == {(i, i, 1, True) for i in (*range(len(blank)), 52)} | {(50, 50, 2, True), (51, 50, 2, False)}


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (20, 20)] + [(100 + i, 101 + i) for i in range(30)]
    label = {r.node: r.label for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert label[1] == label[4] != label[10] == label[12] and len({label[i] for i in range(100, 131)}) == 1


# --- decontamination --------------------------------------------------------

def edit_distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_leaks_against_edit_distance(spark):
    rng = random.Random(9)
    items = [prose(rng, 25) for _ in range(6)] + ["tiny", "", None]
    rows = []
    for n in range(40):
        item = items[n % 6]
        worn = "".join(c if rng.random() > rng.choice((0, 0.03, 0.06, 0.25)) else rng.choice("xyz") for c in item)
        rows.append((n, prose(rng, 40) + ".  " + worn.upper() + "\n" + prose(rng, 10), "s"))
    rows += [(100, None, "s"), (101, "", "s"), (102, items[0] + " " + items[1], "s"), (102, items[0], "s"), (None, items[2], "s"),
             (103, "so tiny a thing", "s"), (104, "x " * 30000 + items[3], "s")]
    bench = spark.createDataFrame([(k, t, 1) for k, t in enumerate(items)], "item_id int, text string, id int")
    frame = docs_frame(spark, rows)
    got = sorted(((r.id, r.item) for r in decontam.find_leaks(frame, bench, block_chars=300).collect()), key=str)
    letters = decontam._word_characters()
    plain = lambda t: "".join(map(chr, decontam.normalised(t, letters)))
    index = decontam.ItemIndex(items)
    want = sorted(((i, k) for i, t, _ in rows if i != 104 for k, item in enumerate(items) if plain(item)
                   and edit_distance_inside(plain(item), plain(t)) <= index.budget[k]), key=str)
    assert [x for x in got if x[0] != 104] == want and (104, 3) in got
    clean = decontam.drop_leaks(frame, bench)
    assert clean.columns == frame.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _, _ in rows if (i, ) not in {(a,) for a, _ in got})
    assert decontam.find_leaks(frame, bench.limit(0)).count() == 0 and decontam.drop_leaks(frame, bench.limit(0)).count() == len(rows)


# --- mixing -------------------------------------------------------------------

def test_raking_meets_the_targets(spark):
    rng = random.Random(2)
    cells = [(s, g, t, float(rng.randint(50, 900))) for s in "abcde" for g in ("en", "de") for t in ("x", "y", "z")]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens double")
    got = mixing.rake(frame, source_targets={"a": 3, "b": 1, "c": 1, "d": 1, "e": 2, "none": 9}, lang_targets={"en": 1, "de": 1})
    f = {r.source: r.f for r in got.sources.collect()}
    weight = {c[:3]: f[c[0]] * got.langs[c[1]] * got.topics[c[2]] * c[3] for c in cells}
    m = np.array([c[3] for c in cells])
    w, want = np.ones(len(cells)), {"a": 3 / 8, "b": 1 / 8, "c": 1 / 8, "d": 1 / 8, "e": 2 / 8}
    topics = {t: sum(c[3] for c in cells if c[2] == t) ** 0.5 for t in "xyz"}
    axes = [(0, want), (1, {"en": 0.5, "de": 0.5}), (2, {t: v / sum(topics.values()) for t, v in topics.items()})]
    for _ in range(300):
        for axis, target in axes:
            for k, share in target.items():
                on = np.array([c[axis] == k for c in cells])
                w[on] *= share / (w * m)[on].sum()
    assert np.allclose([weight[c[:3]] for c in cells], w * m, atol=1e-6)
    drawn = sum(min(1.0, got.scale * weight[c[:3]] / c[3]) * c[3] for c in cells)
    assert abs(drawn / (0.5 * m.sum()) - 1) < 0.01


def test_drawn_margins_meet_the_targets(spark):
    rng = random.Random(6)
    cells = [(s, g, t, float(rng.randint(20, 900)) * (6 if g == "en" else 1)) for s in "abcdef" for g in ("en", "de", "fr")
             for t in ("x", "y", "z")]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens double")
    given = {"lang_targets": {"en": 3, "de": 1, "fr": 1}, "topic_targets": {"x": 1, "y": 1, "z": 1}}
    got = mixing.rake(frame, **given)
    drawn = (frame.join(got.sources, "source").withColumn("weight", got.weight()).withColumn("p", got.probability())
             .select("lang", "topic", "source", "tokens", "p", (F.col("weight") * got.scale > 1).alias("cut")).collect())
    total, budget = sum(c[3] for c in cells), 0.5 * sum(c[3] for c in cells)
    assert any(r.cut for r in drawn) and all(0 <= r.p <= 1 for r in drawn)
    share = lambda axis, k: sum(r.p * r.tokens for r in drawn if r[axis] == k) / budget
    raw = {k: sum(c[3] for c in cells if c[0] == k) ** 0.5 for k in "abcdef"}
    # a group with fewer tokens than its target is drawn whole
    for axis, want in ((0, {"en": 0.6, "de": 0.2, "fr": 0.2}), (1, dict.fromkeys("xyz", 1 / 3)),
                       (2, {k: v / sum(raw.values()) for k, v in raw.items()})):
        most = np.array([sum(c[3] for c in cells if k in c[:3]) for k in want]) / budget
        goal = mixing._filled(np.array(list(want.values())), most, 1.0)
        assert np.allclose([share(axis, k) for k in want], goal, atol=2e-3)
    assert got.draw_error < 1e-3 and total > 0


def test_mixing_odd_rows(spark):
    rows = [(i, "w " * (i % 7), "s" if i % 3 else None) for i in range(60)] + [(None, None, "s"), (3, "", None)]
    frame = docs_frame(spark, rows)
    got = mixing.mix_documents(frame, keep_share=1.0)
    assert got.columns == frame.columns and 0 < got.count() <= len(rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix_documents(frame, keep_share=1.0).collect()))
    assert mixing.mix_documents(frame.limit(0)).count() == 0
    assert mixing.mix_documents(docs_frame(spark, [(1, "", "s"), (2, None, None)])).count() == 0


# --- WARC -----------------------------------------------------------------------

def test_archive_round_trip(spark, tmp_path):
    rec = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Type: application/http\r\n"
           "Content-Length: 5\r\n\r\nhello")
    rows = [(1, "http://a/x", "plain"), (2, "http://b", f"pre\r\n\r\n{rec}\r\n\r\n{rec}\r\n\r\ntail"), (3, None, None),
            (4, "u\r\nWARC/1.1", ""), (5, "z", "é" * 3000 + "\r\nWARC/1.0\r\n" * 50), (6, "q", "plain"), (None, "n", "nul"),
            (7, "r", "\r\nWARC/1.1\r\n"), (8, "s", rec + "\r\n\r\n"), (8, "s", rec + "\r\n\r\n")]
    rows += [(100 + i, f"http://h/{i}", f"{i}" + f"\r\n\r\n{rec}\r\n\r\n" * (i % 2) + "x" * (i * 7 % 500)) for i in range(40)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, page int").coalesce(2)
    path = warc.write_archives(frame, str(tmp_path / "w"))
    want = sorted(((p, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode())
                   for p, _, h in rows), key=str)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
        got = warc.read_archives(spark, path, payload=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest) for r in got), key=str) == want
    assert all(r.digest_ok for r in got)
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {4: 3, 6: 1}
    assert sorted(bytes(r.payload) for r in got if r.record_type == "response") == sorted(
        (h or "").encode() for p, _, h in rows if p not in (4, 6))
    empty = warc.write_archives(frame.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(spark, empty).count() == 0


# --- page text --------------------------------------------------------------------

def test_page_text(spark):
    shell = ("<html><body><div class=c1><a href=/>Home</a> <a>About us</a></div><div class=c2><h2>Title {0}</h2>"
             "<p>Body of page {0}, caf&eacute;&nbsp;x &amp;lt;.<div>Share this</div></div><div class='cookie-notice'>Cookies"
             "</div><div id=comments><p>me {0}</p></div><p>All rights reserved</p></body></html>")
    rows = [(i, f"http://h.x/{i}", shell.format(i)) for i in range(6)]
    rows += [(10, None, None), (11, "http://z", "<p>solo<br>x"), (12, "http://q", "<script>a<p>b"), (13, "http://y", ""),
             (14, "u", "<nav>m</nav><article><header><h1>T</h1></header><p>a <b>b</b>c\n d<form>f</form><aside>s</aside>"
                       "<p>e</article><footer>g</footer>"), (14, "u", "<article>" + "<p>long " * 20000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.extract_text(frame).collect()]
    want = [(i, f"Title {i}\nBody of page {i}, café x &lt;.") for i in range(6)]
    want += [(10, ""), (11, "solo x"), (12, ""), (13, ""), (14, "T\na bc d\ne"), (14, "\n".join(["long"] * 20000))]
    assert sorted(got) == sorted((i, t, len(t)) for i, t in want)
    assert html_text.extract_text(frame.limit(0)).count() == 0


def test_page_text_template_inside_articles(spark):
    page = ("<body><main><div class=xa><a href=/>One</a> <a href=/>Two {0}</a></div><div class=xb><p>Sentence of every page.</p>"
            "<p>Body text of page {0}.</p></div></main><article class=card><p>Card {0}</p></article></body>")
    beside = "<body><div class=a><p>" + "The long main text of the page. " * 9 + "</p></div><article><p>Short card {0}</p></article></body>"
    rows = [(i, f"http://h.x/{i}", page.format(i)) for i in range(4)] + [(9, "http://z.x/", beside.format(9))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(frame).collect()}
    want = {i: f"Body text of page {i}.\nCard {i}" for i in range(4)}
    assert got == want | {9: " ".join(["The long main text of the page."] * 9) + "\nShort card 9"}


def test_page_text_classes(spark):
    # sections and a language with a template of their own, each on under half of the host's pages
    page = "<html lang={1}><body><div class=s{2}><p>{3}</p></div><div class=text><p>Body text {0}.</p></div></body></html>"
    heads = [("en", "sport", "News of sport"), ("en", "arts", "News of the arts"), ("en", "town", "News of the town"),
             ("de", "plain", "Nachrichten")]
    rows = [(10 * k + i, f"http://h.x/{k}/{i}", page.format(f"{k} {i}", *head)) for k, head in enumerate(heads) for i in range(4)]
    rows += [(60 + i, f"http://h.x/f/{i}", page.format(f"f {i}", "fr", "plain", "Nouvelles")) for i in range(4)]
    # copies are no support: half of a host's pages are one page
    rows += [(100 + i, f"http://c.x/{i}", "<body><div class=a><p>Copied words.</p></div></body>") for i in range(6)]
    rows += [(110 + i, f"http://c.x/o/{i}", f"<body><div class=a><p>Other words {i}.</p></div></body>") for i in range(6)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(frame).collect()}
    want = {10 * k + i: f"Body text {k} {i}." for k in range(4) for i in range(4)}
    want |= {60 + i: f"Body text f {i}." for i in range(4)} | {100 + i: "Copied words." for i in range(6)}
    assert got == want | {110 + i: f"Other words {i}." for i in range(6)}


@pytest.mark.parametrize("page, want", [
    ('<body class="has-sidebar"><article><p>Text.</p></article></body>', "Text."),
    ('<article class="post hentry comments-open"><p>Text.</p></article>', "Text."),
    ("<body><form id=f><div><article><p>Text.</p></article></div></form></body>", "Text."),
    ("<body><form><h1>Title</h1><p>Text.</p></form></body>", "Title\nText."),
    ("<body><p>Text.</p><form>Name <input></form></body>", "Text."),
    ('<div id="research-share"><p>Text.</p></div>', "Text."),
    ("<body class=sidebar><div class=cookie-notice>c</div><p>Text.</p></body>", "Text."),
    ('<body style="display:none"><article><p>Text.</p></article></body>', "Text."),
    ("<article><p>Text.</p></article><div id=comments><article class=comment-body><p>me</p></article></div>", "Text."),
    ("<div class=site-header>h</div><div class=main-nav>n</div><div class=sidebar-left>s</div><article><header>T</header><p>x</p></article>", "T\nx"),
    ("<body><a name=top><p>Text.</p><p>More.</p></body>", "Text.\nMore."),
    ('<p title="a>Hello world</p>', "Hello world"),
    ('<p title="a>Hello <b class="x">bold</b></p><p>next</p>', "Hello bold\nnext"),
    ('<div data-x="<p>no</p>">yes</div>', "yes"),
])
def test_page_frames_and_broken_markup(page, want):
    assert html_text.main_text(page) == want


def test_unclosed_anchors_are_no_link_slots(spark):
    rows = [(i, f"http://h.x/{i}", f"<body><a name=top><div class=a><p>Text {i} of the page.</p></div><div class=b><p>More {i}.</p></div></body>")
            for i in range(6)]
    rows += [(10 + i, f"http://k.x/{i}", f"<body><div class=a><p><a href=/x>open {i}</p><p>Text {i}.</p></div></body>") for i in range(6)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(frame).collect()}
    assert got == {i: f"Text {i} of the page.\nMore {i}." for i in range(6)} | {10 + i: f"open {i}\nText {i}." for i in range(6)}


def test_no_page_with_an_article_is_empty(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = html_text.extract_text(frame).join(frame.select("page_id", "html"), "page_id").collect()
    assert len(got) == frame.count() and all(r.text for r in got if "<article" in (r.html or ""))


def template_by_hand(pages):
    """Classes of equal occurrence vectors over the different contents of one
    host: (containers of valid classes, texts that stand wherever their container does)."""
    seen = {}
    for page in pages:
        blocks, roles, language = html_text.page_blocks(page)
        seen.setdefault(tuple(b[0] for b in blocks if not b[2].barred), (blocks, roles, language))
    vectors, parents = {}, {}
    for no, (blocks, roles, language) in enumerate(seen.values()):
        for role, n in roles.items():
            vectors.setdefault(role, {})[no] = n
        for text, _, node, _ in blocks:
            if not node.barred:
                token = html_text._text_token(node.role, text)
                vectors.setdefault(token, {}).setdefault(no, 0)
                vectors[token][no] += 1
                parents[token] = (node.role, 0 if node.inside else language)
    classes = {}
    for token, vector in vectors.items():
        if len(vector) >= html_text.MIN_PAGES:
            classes.setdefault(frozenset(vector.items()), []).append(token)
    template = {t for c in classes.values() if len(c) >= html_text.MIN_CLASS for t in c if t not in parents}
    texts = {t for t, ps in parents.items() if len(vectors[t]) >= html_text.MIN_PAGES
             and any(set(vectors.get(p, ())) == set(vectors[t]) for p in ps if p not in parents)}
    return template, texts


def test_templates_equal_brute_force(spark):
    rng = random.Random(12)
    part = lambda k: f"<div class=d{k}><p>{rng.choice(['Shared words', 'Other words', str(rng.random())])} {k}</p></div>"
    hosts = {f"h{h}": ["<html lang=en><body>" + "".join(part(rng.randint(0, 4)) for _ in range(rng.randint(1, 6))) + "</body></html>"
                       for _ in range(rng.randint(2, 12))] for h in range(12)}
    frame = spark.createDataFrame([(h, p) for h, ps in hosts.items() for p in ps + ps[:1]], "host string, html string")
    got = {r.host: (set(r.template), set(r.texts)) for r in html_text.deduce_templates(frame).collect()}
    for host, pages in hosts.items():
        assert got.get(host, (set(), set())) == template_by_hand(pages), host


# --- URLs ---------------------------------------------------------------------------

@pytest.mark.parametrize("most", [4 << 20, 1000])
def test_cascade_is_exact(spark, most):
    keys = spark.range(30000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 17 == 0).alias("listed"))
    cascade = url_filter.build_cascade(keys, most)
    assert cascade.listed(keys, F.col("key"), "got").where("got <> listed").count() == 0


def test_url_verdicts(spark):
    # (id, url, html, verdict, rule): thin pages of net hosts are blocked by the cascade, rules decide first
    long, short = "x" * 100, "x" * 10
    rows = [(1, None, long, "allow", None), (2, "casino.com/de/", short, "allow", None),
            (3, "http://A.Example.ORG/es/x?y", long, "block", "example.org/es/"), (4, "http://xexample.org/es/", short, "allow", "org/"),
            (None, "x://org", None, "allow", None), (5, "a://b.com/de/#q", long, "block", "com/de/"),
            (6, "http://m.net/a", short, "block", None), (6, "http://m.net/a", short, "block", None), (7, "http://M.NET/b?1", long, "allow", None),
            (8, "http://m.net/b?2", short, "allow", None), (9, "http://m.net/c", None, "block", None), (10, "http://m.net/d", long, "allow", None),
            (11, "http://best.com/fr/x", short, "allow", "com/fr/"), (12, "http://n.net/", short, "allow", None), (13, "http:///p", long, "allow", None)]
    frame = spark.createDataFrame([(i, u, h, "x", "y", "k") for i, u, h, _, _ in rows],
                                  "page_id int, url string, html string, host string, listed string, key string")
    got = [(r.page_id, r.verdict, r.rule) for r in url_filter.judge_urls(frame).collect()]
    assert sorted(got, key=str) == sorted(((i, v, r) for i, _, _, v, r in rows), key=str)
    joined = [(r.page_id, r.verdict, r.rule) for r in url_filter.judge_urls(frame, max_bytes=1).collect()]
    assert sorted(joined, key=str) == sorted(got, key=str)
    assert url_filter.judge_urls(frame.limit(0)).count() == 0


def test_address_list_has_several_levels(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    host, path = url_filter.url_parts(F.col("url"))
    rows = pages.select(host.alias("host"), F.concat(host, path).alias("key"), F.octet_length("html").cast("long").alias("bytes"))
    universe = url_filter.thin_addresses(rows)
    pdf = rows.toPandas()
    mean = pdf.groupby("host")["bytes"].mean()
    most = pdf.groupby(["host", "key"])["bytes"].max().reset_index()
    thin = {k for h, k, b in most.itertuples(index=False) if 2 * b < mean[h]}
    assert {r.key for r in universe.where("listed").collect()} == thin and 50 < len(thin) < len(most) / 2
    cascade = url_filter.build_cascade(universe)
    assert len(cascade.levels) > 2
    assert cascade.listed(universe, F.col("key"), "got").where("got <> listed").count() == 0


# --- repetition ---------------------------------------------------------------------

def repeats_by_hand(words, least):
    n, covered, longest, maximal, places = len(words), set(), 0, 0, {}
    for i in range(n):
        for j in range(i + least, n + 1):
            places.setdefault(tuple(words[i:j]), []).append(i)
    for s, at in places.items():
        if len(at) > 1:
            longest = max(longest, len(s))
            covered |= {p for i in at for p in range(i, i + len(s))}
            maximal += (len({words[i - 1] if i else None for i in at}) > 1 or 0 in at) and (
                len({words[i + len(s)] if i + len(s) < n else None for i in at}) > 1)
    return covered, longest, maximal


def test_maximal_repeats():
    rng = random.Random(1)
    for _ in range(150):
        words = [rng.randint(0, rng.choice((1, 3, 8))) for _ in range(rng.randint(1, 50))]
        least = rng.choice((2, 3, 5))
        got = repetition.maximal_repeats(np.array(words), least)
        assert (set(np.flatnonzero(got.covered)), got.longest, got.n_maximal) == repeats_by_hand(words, least)


def test_lcp_in_text_order_equals_that_of_the_ranks():
    rng = random.Random(8)
    for _ in range(80):
        words = np.array([rng.randint(0, rng.choice((0, 1, 4))) for _ in range(rng.randint(6, 120))])
        order, lcp = repetition.suffix_array(words)
        again, same = repetition.suffix_array(words, kept=0)
        assert np.array_equal(order, again) and np.array_equal(lcp, same)
    order, lcp = repetition.suffix_array(np.zeros(200_000, np.int64))           # linear in memory
    assert lcp.max() == 199_999


def base_columns_by_hand(text):
    import re
    words = re.findall(r"[^ \t-\r]+", text or "")
    windows, again, lines, dup = {}, set(), set(), 0
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    for at in windows.values():
        if len(at) > 1:
            again |= {p for i in at for p in range(i, i + 5)}
    for line in (text or "").split("\n"):
        if re.search(r"[^ \t-\r]", line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again), n < 10 or 100 * len(again) > 20 * n)


def test_base_columns_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rng = random.Random(9)
    odd = ["".join(rng.choice(["a", "b ", "c\n", " ", "#", "x y\n", "\u00a0", "\t", "\x1c"]) for _ in range(rng.randint(0, 200))) for _ in range(150)]
    frame = docs_frame(spark, [(r.doc_id, r.text, "s") for r in docs.collect()] + [(10 ** 6 + i, t, "s") for i, t in enumerate(odd)] + [(5, None, "s")])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = repetition.judge_repetition(frame).select("id", "row.text", *names).collect()
    assert len(got) == docs.count() + 151
    for r in got:
        assert tuple(r[n] for n in names) == base_columns_by_hand(r.text), r.id


def test_repetition_rows(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "a b c d e f g h i j k", "s"), (4, "one two three four five\n" * 4, "s"),
            (5, "x " * 50000, "s"), (None, "a\u00a0b c#|", "s"), (4, "one two three four five\n" * 4, "s")]
    frame = docs_frame(spark, rows)
    got = {(r.id, r.n_words): r for r in repetition.judge_repetition(frame).collect()}
    assert got[1, 0].base_failed and got[2, 0].word_chars == 0
    assert got[3, 11].kept and got[3, 11].n_repeat_words == 0
    assert (got[4, 20].n_dup_lines, got[4, 20].n_repeat_words, got[4, 20].kept) == (3, 20, False)
    assert got[5, 50000].longest_repeat == 49999
    assert got[None, 2].n_symbols == 2 and got[None, 2].word_chars == 6
    kept = repetition.drop_repetitive(frame)
    assert kept.columns == frame.columns and [r.doc_id for r in kept.collect()] == [3]
    assert repetition.judge_repetition(frame.limit(0)).count() == 0


# --- licences ---------------------------------------------------------------------

def test_licenses(spark):
    rng = random.Random(4)
    rows = [(1, prose(rng, 50) + "\nReleased under the MIT License.\n" + prose(rng, 30), "s"), (2, "the license was lost", "s"),
            (3, "Licensed under CC BY-NC 4.0.", "s"), (4, None, "s"), (5, "", "s"), (6, prose(rng, 4000), "s"),
            (7, "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License.", "s"),
            (None, "Licensed under the Apache License, Version 2.0.", "s"), (3, "Licensed under CC BY-NC 4.0.", "s")]
    frame = docs_frame(spark, rows)
    got = sorted(((r.id, r.licenses) for r in license_scan.scan_licenses(frame).collect()), key=str)
    want = {1: ["MIT"], 3: ["CC-BY-NC"], 7: ["GPL", "MIT"], None: ["Apache-2.0"]}
    assert got == sorted(((i, want.get(i, [])) for i, _, _ in rows), key=str)


def test_license_sample_of_different_whole_texts(spark):
    first = spark.range(200).select(F.concat(F.lit("text "), "id").alias("t")).orderBy(F.xxhash64("t")).first().t
    long = "word " * 1000 + "end"
    texts = [first] * 50 + [f"text {i}" for i in range(200)] + [long]
    got = license_scan.corpus_paragraphs(docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), most=30)
    assert len(got) == len(set(got)) == 30 and first in got
    assert license_scan.corpus_paragraphs(docs_frame(spark, [(1, long, "s")])) == [long]


#: Notices as they stand in real files, none of them made by the generator.
REAL_NOTICES = [
    ("/*\n * This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU General Public\n"
     " * License as published by the Free Software Foundation; either\n * version 2 of the License, or (at your option) any later version.\n */", ["GPL"]),
    ("# Licensed to the Foundation under one or more contributor license agreements.\n# The ASF licenses this file to You under the Apache License,\n"
     "# Version 2.0 (the \"License\"); you may not use this file except in compliance\n# with the License.", ["Apache-2.0"]),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are\nmet:\n\n"
     "    * Redistributions of source code must retain the above copyright\nnotice, this list of conditions and the following disclaimer.", ["BSD"]),
    ("Copyright (c) 2019 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
     "files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights", ["MIT"]),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
     "copyright notice and this permission notice appear in all copies.", ["ISC"]),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the "
     "Free Software Foundation; either\nversion 2.1 of the License", ["LGPL"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile", ["MPL"]),
    ("The text of this page is\nlicensed under the Creative Commons Attribution-ShareAlike\n4.0 International License", ["CC-BY-SA"]),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\n"
     "distribute this software", ["Unlicense"]),
    ("a notice of the court\nthat the general public was told about\nin version 2 of the paper", []),
    ("We ask for permission to use the hall.\nThe above terms apply to the software of the contest.", []),
    ("Distribution of bread and use of the oven, with or without yeast, are permitted.", []),
    ("The public may copy the poster for any purpose.\nThe license of the pub was lost.", []),
]


def test_licenses_in_real_notices(spark):
    model = license_scan.train(spark, [prose(random.Random(k), 40) for k in range(200)])
    for text, want in REAL_NOTICES:
        got = sorted({h[0] for lines in license_scan.paragraphs_of(text) for h in license_scan.judge_paragraph(model, lines)})
        assert got == want, text
    wrapped = "one two three\nfour released under the\nMIT\nLicense five\n\nsix"
    got = [license_scan.judge_paragraph(model, p) for p in license_scan.paragraphs_of(wrapped)]
    assert [[h[0] for h in hs] for hs in got] == [["MIT"], []]
    assert license_scan.paragraphs_of("\n \na\nb\n\n\nc") == [["a", "b"], ["c"]] and license_scan.paragraphs_of("") == []


def test_held_back_templates_are_not_fitted():
    known, held = license_scan.templates(), license_scan.held_back(5)
    text = lambda i: f" {' '.join(known[i][1])} "
    assert 0.05 * len(known) < len(held) < 0.5 * len(known)
    for i in held:
        for j in set(range(len(known))) - held:
            assert known[i][0] != known[j][0] or text(i) not in text(j) and text(j) not in text(i)
    assert {known[j][0] for j in set(range(len(known))) - held} == set(license_scan.NAMES)


def test_license_held_out_accuracy(spark):
    model = license_scan.train(spark, [prose(random.Random(k), 40) for k in range(200)])
    held = [(c, g) for c, g, h in license_scan.training_rows([prose(random.Random(k), 40) for k in range(200, 400)], seed=77) if h]
    right = [model.classes[int(model.probabilities(g).argmax())] == c for c, g in held]
    assert len(held) > 300 and np.mean(right) > 0.95


# --- toxicity -----------------------------------------------------------------------

def test_toxicity_held_out(spark):
    rng = random.Random(8)
    bad = ["idiot", "moron", "scum", "worthless"]
    rows, labels = [], []
    for i in range(700):
        words = prose(rng, 40).split()
        toxic = i % 5 == 0
        for p in rng.sample(range(40), 4 if toxic else 0):
            words[p] = rng.choice(bad)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    rows += [(9000, None, "s"), (9001, "", "s"), (None, "you idiot scum moron", "s"), (1, rows[1][1], "s")]
    labels += [(1, 0), (None, 1), (9999, 1), (2, None)]
    frame = docs_frame(spark, rows)
    table = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, toxic int, h int")
    got = {r.id: r for r in toxicity.score_documents(frame, table).collect()}
    held = [i for i, _ in labels[:700] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([got[i].predicted == (i % 5 == 0) for i in held]) > 0.95
    assert got[9000].predicted == got[9001].predicted == 0 and got[9000].score == got[9001].score
    kept = toxicity.drop_toxic(frame, table)
    assert kept.columns == frame.columns
    one_class = toxicity.score_documents(frame.limit(5), table.where("toxic = 0")).collect()
    assert len(one_class) == 5 and len({r.score for r in one_class}) == 1
    assert toxicity.score_documents(frame.limit(0), table.limit(0)).count() == 0


def test_toxicity_sample_of_different_texts(spark):
    first = spark.range(200).select(F.concat(F.lit("text "), "id").alias("t")).orderBy(F.xxhash64("t")).first().t
    texts = [f"text {i}" for i in range(200)] + [first] * 300
    frame = docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)]).select(
        F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("h"))
    labels = spark.createDataFrame([(i, int(i == 499)) for i in range(500)], "doc_id long, toxic int")
    fit = toxicity.fit_rows(frame, labels, 40).collect()
    assert len(fit) == len({r.text for r in fit}) == 40
    caps = toxicity.FEATURES.index("capital_words")
    assert toxicity.text_features("quiet words " * 200 + "YOU ARE LOUD", {}, {})[caps] == 3 / 403


# --- self-similar texts, learned topics ---------------------------------------------

def test_leaks_in_self_similar_texts():
    import time
    for item, doc in (("a" * 1200, "a" * 100_000), ("ab" * 600, "ab" * 50_000), ("lorem ipsum " * 100, "lorem ipsum " * 8000)):
        began = time.time()
        (match,), = decontam.ItemIndex([item]).matches([doc])
        assert match[0] == 0 and match[3] == 0 and time.time() - began < 30
    got = decontam.ItemIndex(["a" * 60]).matches(["a" * 60] * 5 + ["a" * 300, "b" * 60, "a" * 59, "a" * 40])
    assert [bool(m) for m in got] == [True] * 6 + [False, True, False]           # each text by itself
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))
    for _ in range(30):
        item = " ".join(word() for _ in range(40))
        text = " ".join(word() for _ in range(300))
        index = decontam.ItemIndex([item])
        chars = decontam.normalised(text, index.letters)
        edits, _ = decontam.banded_edits(index.chars[0], chars, int(index.budget[0]))
        got = index.matches([text])[0]
        assert [m[3] for m in got] == ([edits] if edits <= index.budget[0] else [])


def test_topics_are_learned(spark):
    from tramline.llm import topics
    rng = random.Random(7)
    words = {"sport": "ball goal team match coach league".split(), "food": "salt bread oven spice dish soup".split(),
             "law": "court judge appeal clause tort verdict".split()}
    rows = [(i, " ".join(rng.choice(words[t]) for _ in range(30)), t) for i, t in enumerate(list(words) * 40)]
    frame = spark.createDataFrame([*rows, (900, None, "-"), (901, "", "-"), (902, " \n", "-")], "id long, text string, own string").repartition(3)
    got = topics.learn_topics(frame, k=3).assign(frame).collect()
    assert {r.topic for r in got if r.own == "-"} == {topics.NO_TOPIC}
    per = {}
    for r in got:
        per.setdefault(r.own, set()).add(r.topic)
    assert all(len(per[t]) == 1 for t in words) and len({min(per[t]) for t in words}) == 3
    again = topics.learn_topics(frame.repartition(7), k=3).assign(frame).collect()
    assert {r.id: r.topic for r in got} == {r.id: r.topic for r in again}
    assert topics.learn_topics(frame.limit(0)).assign(frame.where("id = 1")).first().topic == "t0"


def topic_groups(long_words=30, spread=40):
    rng = random.Random(7)
    words = {"sport": "ball goal team match coach league".split(), "food": "salt bread oven spice dish soup".split(),
             "law": "court judge appeal clause tort verdict".split()}
    return [(f"{t}{i}", " ".join(rng.choice(words[t]) for _ in range(long_words if t == "law" else 30)), t)
            for t in words for i in range(spread)]


def topics_by_group(rows):
    per = {}
    for r in rows:
        per.setdefault(r.own, set()).add(r.topic)
    return per


def test_topics_are_learned_from_whole_long_texts(spark):
    from tramline.llm import topics
    frame = spark.createDataFrame(topic_groups(long_words=4000), "id string, text string, own string")   # over 20,000 characters
    per = topics_by_group(topics.learn_topics(frame, k=3).assign(frame).collect())
    assert all(len(v) == 1 for v in per.values()) and len(set.union(*per.values())) == 3


def test_topics_are_learned_from_all_texts(spark):
    from tramline.llm import topics
    made = spark.createDataFrame(topic_groups(spread=1500), "id string, text string, own string").withColumn("h", F.xxhash64("text"))
    bound = sorted(r.h for r in made.where("own <> 'law'").collect())[2400]
    frame = made.where((F.col("own") != "law") | (F.col("h") > bound)).drop("h")     # the first 2,400 by hash: two groups
    per = topics_by_group(topics.learn_topics(frame, k=3).assign(frame).collect())
    assert all(len(v) == 1 for v in per.values()) and len(set.union(*per.values())) == 3


def test_topics_of_few_vectors_and_counted_words(spark):
    from tramline.llm import topics
    odd = ["a b", "b a", "A B a b", "c", "", None, " \u00a0 x\x1cy \u0130 ", "d d d"]
    frame = spark.createDataFrame(list(enumerate(odd)), "id long, text string")
    counted = topics.count_words(frame).select("id", "_words.n", mixing.n_tokens(F.col("text")).alias("want")).collect()
    assert all(r.n == r.want for r in counted)
    got = {r.id: r.topic for r in topics.learn_topics(frame).assign(frame).collect()}
    assert got[0] == got[1] == got[2] and got[4] == got[5] == topics.NO_TOPIC
    assert len({got[i] for i in (0, 3, 6, 7)}) == 4
    same = frame.where("id < 3")
    assert {r.topic for r in topics.learn_topics(same).assign(same).collect()} == {"t0"}


def test_topics_count_words_of_odd_texts(spark):
    from collections import Counter

    from tramline.llm import topics
    rng = random.Random(11)
    piece = lambda: rng.choice(["a", "bb", "\u00e9", "q" * rng.choice([31, 32, 33, 300]), " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\u00a0"])
    texts = ["".join(piece() for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(200)]
    texts += ["x " * 300, "x " * 70_000 + "y", " ", "x " * 300]
    for run in (texts, texts[::-1]):                 # a text's counts don't depend on its neighbours
        frame = spark.createDataFrame(list(enumerate(run)), "id long, text string").repartition(2)
        for r in topics.count_words(frame).collect():
            words = run[r.id].encode().split()
            want = Counter(zlib.crc32(w) % topics.FEATURES for w in words)
            kind = f"<u{1 if max(want.values(), default=0) < 256 else 2 if max(want.values()) < 65536 else 4}"
            assert r._words.n == len(words) and np.frombuffer(r._words.at, "<u2").tolist() == sorted(want)
            assert np.frombuffer(r._words.times, kind).tolist() == [want[b] for b in sorted(want)]
    same = frame.where("id in (0, 2, 3)")            # words with counts of two widths, read together
    got = topics.learn_topics(frame).assign(frame)
    assert same.count() == 3 and got.where("text in (' ', '')").select("topic").distinct().collect() == [(topics.NO_TOPIC,)]
    assert got.where(F.col("text") == "x " * 300).select("topic").distinct().count() == 1


def test_topics_are_assigned_once_and_read_packed(spark, monkeypatch):
    from tramline.llm import topics
    docs = spark.createDataFrame([(i, t, "s", "en") for i, (_, t, _) in enumerate(topic_groups())], "doc_id long, text string, source string, lang string")
    written = {}
    monkeypatch.setattr(topics, "materialize", lambda df, name: written.setdefault(name, mixing.materialize(df, name)))
    drawn = mixing.mix(docs, kept=["doc_id"])
    assert "PythonUDF" not in drawn._jdf.queryExecution().analyzed().toString() and drawn.count() > 0
    assert written["topics-texts"].count() < docs.select("text").distinct().count() / 5


def test_topics_count_words_within_bounded_memory():
    import tracemalloc

    import pyarrow as pa
    from tramline.llm import topics
    rng = random.Random(5)
    texts = pa.array([" ".join(f"w{rng.randrange(200)}" for _ in range(8000)).encode() for _ in range(600)], pa.binary())
    tracemalloc.start()
    got = topics._counted(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts.nbytes > 20 << 20 and len(got) == 600 and got.field("n").to_pylist() == [8000] * 600
    assert peak < texts.nbytes                       # a slab's arrays, no copy of the batch's texts


def test_pipeline_mixing_learns_from_whole_texts(spark):
    import corpus_pipeline
    rows = [(i, t, own) for i, (_, t, own) in enumerate(topic_groups(long_words=4000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own string").withColumn("source", F.lit("s")).withColumn("lang", F.lit("en"))
    per = topics_by_group(corpus_pipeline.mixing(spark, docs, "").collect())
    assert set(per) == {"sport", "food", "law"}
    assert all(a == b or not per[a] & per[b] for a in per for b in per)


def test_many_cells_are_raked(spark):
    cells = [(f"s{i % 7}", f"l{i % 180}", f"t{i % 77}", float(1 + i % 50)) for i in range(20_000)]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens double").groupBy("source", "lang", "topic").agg(
        F.sum("tokens").alias("tokens"))
    got = mixing.rake(frame)                         # 13,860 languages x topics
    assert len(got.langs) * len(got.topics) > 10_000 and got.error < 1e-3
