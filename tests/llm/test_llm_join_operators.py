"""Decontamination, suffix dedup, n-gram join, HTML extraction, personal data."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from corpus_brute import (ODD_DOCS, docs_frame, groups, leaking_items, low_words, repeated_bytes, shingle_set)

from corate.llm import decontaminate, jaccard_join, pii, site_tree, suffix_dedup
from corate.llm.components import components
from corate.llm.textscan import shingle_sets, windows_hash, word_hashes


def test_word_hashes_agree_with_words():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aAbB \t\n\x0bé") for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    column = pa.array([*texts, None, ""])
    seen = {}
    for first, data, offsets in __import__("corate.llm.textscan", fromlist=["chunks"]).chunks(column):
        h, at = word_hashes(data, offsets)
        for i in range(len(offsets) - 1):
            w = low_words((texts + [None, ""])[first + i])
            assert len(w) == at[i + 1] - at[i]
            for x, y in zip(w, h[at[i]:at[i + 1]].tolist(), strict=True):
                assert seen.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen)
    assert len(windows_hash(np.arange(7, dtype=np.uint64), 5)) == 3


def test_masks_find_every_choice_of_two_replaced_words():
    masks = [{i for i, c in enumerate(m) if c == "1"} for m in decontaminate.MASKS]
    for bad in itertools.combinations(range(decontaminate.WINDOW), decontaminate.MAX_SUBSTITUTIONS):
        assert any(not {p + s for p in m} & set(bad)
                   for m in masks for s in range(decontaminate.WINDOW - max(m)))


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([3, 9, 13, 20, 40])))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "one two"), (None, "no id")]
    rows = list(ODD_DOCS)
    for i in range(150):
        body = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        part = rng.choice(items[:25])[1].split()
        for _ in range(rng.randrange(0, 5)):
            part[rng.randrange(len(part))] = "changed"
        at = rng.randrange(len(body) + 1)
        body[at:at] = part[:rng.randrange(1, len(part) + 1)] if rng.random() < .3 else part
        rows.append((100 + i, " ".join(body).upper() if i % 5 == 0 else " ".join(body)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = docs_frame(spark, rows)
    got = {}
    for r in decontaminate.leaks(frame, bench).collect():
        got.setdefault(r.doc_id, set()).add(r.item_id)
    named = [x for x in items if x[0] is not None]
    small = [r for r in rows if len(r[1] or "") < 5000]
    exp = {i: s for i, t in small if (s := leaking_items(t, named))}
    assert {k: v for k, v in got.items() if k not in (5, 6)} == exp and len(exp) > 40
    out = decontaminate.clean(frame, bench)
    assert out.columns == frame.columns and out.count() == len(rows) - sum(i in got for i, _ in rows)
    assert decontaminate.leaks(frame, bench.limit(0)).count() == 0
    assert decontaminate.leaks(frame.limit(0), bench).count() == 0


def test_short_items_are_found_with_one_replaced_word(spark):
    masks = [{i for i, c in enumerate(m) if c == "1"} for m in decontaminate.MASKS]
    items, rows, exp = [], [], set()
    for n in (9, 10, 11, 12):
        w = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(w)))
        for k in range(n):
            assert n < 10 or any(k - s not in m for m in masks for s in range(n - max(m)))
            rows.append((100 * n + k, " ".join(["before", *w[:k], w[k] + "?", *w[k + 1:], "after"])))
            exp |= {(100 * n + k, n)} if n > 9 else set()
        rows.append((100 * n + 50, " ".join([*w[:2], "x", *w[3:5], "x", *w[6:]])))  # two words replaced
        rows.append((100 * n + 60, " ".join(w)))
        exp.add((100 * n + 60, n))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == exp


def test_items_without_an_id_are_searched(spark, tmp_path):
    words = [f"q{k}" for k in range(20)]
    items = [(None, " ".join(words)), (None, "one more without id"), (7, " ".join(words[5:])), (7, "another of seven")]
    rows = [(1, "so " + " ".join(words[:14])), (2, "ANOTHER of seven, one more without id"), (3, "another of seven"),
            (4, "one more without id " + " ".join(words)), (5, "clean")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, str(r.item_id)) for r in decontaminate.leaks(frame, bench).collect())
    assert got == [(1, "None"), (2, "None"), (3, "7"), (4, "7"), (4, "None")]
    assert [r.doc_id for r in decontaminate.clean(frame, bench).collect()] == [5]
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_items, r.item_ids) for r in decontaminate.query(spark, str(tmp_path)).collect()}
    assert got == {1: (1, "null"), 2: (1, "null"), 3: (1, "7"), 4: (2, "7,null"), 5: (0, "")}


def random_texts(rng, n):
    parts = ["".join(rng.choice("ab é") for _ in range(rng.randrange(40, 260))) for _ in range(6)]
    out = []
    for _ in range(n):
        t = "".join(rng.choice(parts)[rng.randrange(0, 60):] if rng.random() < .7 else
                    "".join(rng.choice("xyz ") for _ in range(rng.randrange(0, 80))) for _ in range(rng.randrange(0, 6)))
        if t and rng.random() < .5:
            k = rng.randrange(len(t))
            t = t[:k] + "#" + t[k + 1:]
        out.append(t)
    return out


@pytest.mark.parametrize("case", ["random", "hot", "odd_ids"])
def test_suffix_dedup_matches_brute_force(spark, case, monkeypatch):
    rng = random.Random({"random": 7, "hot": 8, "odd_ids": 9}[case])
    if case == "hot":
        monkeypatch.setattr(suffix_dedup, "HOT_NAME", 3)
    rows = [(i, t) for i, t in enumerate(random_texts(rng, 120))]
    rows += [(200, "a" * 400), (201, "ab" * 300), (202, None), (203, ""), (204, "x" * 99), (205, "x" * 100)]
    rows += [(300, rows[7][1]), (301, rows[7][1]), (-5, rows[9][1])]
    if case == "odd_ids":
        rows += [(None, rows[3][1] + "tail"), (None, "q" * 150), (12, rows[4][1][::-1]), rows[11], rows[11]]
    frame = docs_frame(spark, rows)
    got = suffix_dedup.dedup_bytes(frame).collect()
    assert len(got) == len(rows)
    import hashlib
    texts = [(i, (t or "").encode()) for i, t in rows]
    h = lambda b: [int.from_bytes(hashlib.sha256(b).digest()[k:k + 8], "little", signed=True) for k in (0, 8)]
    texts.sort(key=lambda x: (x[0] is None, x[0] or 0, *h(x[1])))
    exp = sorted(str((i, len(b), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
                 for (i, b), gone in zip(texts, repeated_bytes([b for _, b in texts]), strict=True))
    raw = {hashlib.sha256(b).hexdigest(): b for _, b in texts}
    assert sorted(str((r.doc_id, r.n_bytes, bytes(r.kept) if r.kept is not None else raw[r.sha256])) for r in got) == exp
    for r in got:
        spans = [(s.start, s.end) for s in r.spans]
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in itertools.pairwise(spans))


def test_suffix_dedup_of_an_empty_table(spark):
    assert suffix_dedup.dedup_bytes(docs_frame(spark, [])).count() == 0


def test_difference_cover():
    c = suffix_dedup.COVER
    assert {(a - b) % suffix_dedup.PERIOD for a in c for b in c} == set(range(suffix_dedup.PERIOD))


def near_copies(rng, n):
    vocab = [f"v{i}" for i in range(400)]
    rows, base = [], []
    for i in range(n):
        if base and rng.random() < .6:
            w = list(rng.choice(base))
            for _ in range(rng.randrange(0, max(2, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 6, 9, 20, 40, 90, 200]))]
        base.append(w)
        rows.append((rng.randrange(10**6) if i % 9 else i, " ".join(w)))
    return rows


@pytest.mark.parametrize("segments, hot", [(jaccard_join.SEGMENTS, 64), (((None, 0.02),), 64),
                                           (jaccard_join.SEGMENTS, 1)])
def test_jaccard_components_match_brute_force(spark, segments, hot, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_KEY", hot)
    monkeypatch.setattr(jaccard_join, "BLOCK", 512 if hot > 1 else 4)
    rows = near_copies(random.Random(11), 260) + ODD_DOCS
    frame = docs_frame(spark, rows)
    got = jaccard_join._row_components(frame, "doc_id", "text", segments).collect()
    sets = [shingle_set(t) for _, t in rows]
    comp, least = groups(sets), {}
    for (i, _), c in zip(rows, comp, strict=True):
        least[c] = min(x for x in (least.get(c), i, 10**9) if x is not None)
    exp = sorted(str((i, len(s), None if not s or least[c] == 10**9 else least[c]))
                 for (i, _), s, c in zip(rows, sets, comp, strict=True))
    assert sorted(str((r.doc_id, r.n, r.component_id)) for r in got) == exp
    assert sum(least[c] != i for (i, _), c in zip(rows, comp, strict=True)) > 60


@pytest.mark.parametrize("bits, segments", [(2, jaccard_join.SEGMENTS), (8, ((None, 0.02),))])
def test_sets_with_the_same_first_name_stay_apart(spark, bits, segments):
    """Names of few bits, which most or some sets share: the same result."""
    rows = near_copies(random.Random(12), 150) + ODD_DOCS
    got = jaccard_join.jaccard_components(docs_frame(spark, rows), segments=segments, name_bits=bits).collect()
    sets = [shingle_set(t) for _, t in rows]
    comp, least = groups(sets), {}
    for (i, _), c in zip(rows, comp, strict=True):
        least[c] = min(x for x in (least.get(c), i, 10**9) if x is not None)
    exp = sorted(str((i, len(s), i if not s else None if least[c] == 10**9 else least[c]))
                 for (i, _), s, c in zip(rows, sets, comp, strict=True))
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == exp
    assert len({r.class_id for r in got if r.class_id is not None}) == len({frozenset(s) for s in sets if s})


def passages(rng, n, words, changed, vocab=5000):
    """Texts of one passage with so many words replaced at random."""
    base = [f"p{rng.randrange(vocab)}" for _ in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        for j in rng.sample(range(words), rng.choice(changed)):
            w[j] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("changed, some", [([0, 1, 2, 3], True), ([2, 3, 4, 5], True), ([4, 5, 6], False)])
def test_hot_groups_match_brute_force_with_few_comparisons(spark, changed, some, monkeypatch):
    """A passage that makes up most of its texts, around the threshold, and
    several passages joined by texts that hold two of them."""
    monkeypatch.setattr(jaccard_join, "HOT_KEY", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rng = random.Random(sum(changed))
    rows = passages(rng, 150, 60, changed) + [(1000 + i, t) for i, t in passages(rng, 60, 50, changed)]
    rows += [(2000 + i, rows[i][1] + " " + rows[150 + i][1]) for i in range(20)]
    seen = []
    real = jaccard_join._forest
    monkeypatch.setattr(jaccard_join, "_forest", lambda a, b: seen.append(len(a)) or real(a, b))
    got = jaccard_join.jaccard_components(docs_frame(spark, rows)).collect()
    sets = [shingle_set(t) for _, t in rows]
    comp, least = groups(sets), {}
    for (i, _), c in zip(rows, comp, strict=True):
        least[c] = min(least.get(c, i), i)
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, least[c]) for (i, _), c in zip(rows, comp, strict=True))
    assert some == any(least[c] != i for (i, _), c in zip(rows, comp, strict=True))


def test_sets_that_share_too_little_are_not_compared(spark, monkeypatch):
    """120 words with 4 replaced at random: most sets have 20 shingles of
    their own, too many to link with another, and are left out."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    rows = passages(random.Random(5), 200, 120, [4])
    left = []
    real = jaccard_join._possible

    def possible(*a):
        out = real(*a)
        left.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "_possible", possible)
    got = jaccard_join.jaccard_components(docs_frame(spark, rows)).collect()
    sets = [shingle_set(t) for _, t in rows]
    assert len({r.component_id for r in got}) == len(set(groups(sets)))
    assert left and max(left) < 60  # of 200


def test_forests_connect_what_the_pairs_do():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 80), rng.integers(0, 60, 80)
    keep = jaccard_join._forest(a, b)

    def parts(pairs):
        name = {}
        for x, y in pairs:
            x, y = name.setdefault(x, x), name.setdefault(y, y)
            name = {k: min(x, y) if v in (x, y) else v for k, v in name.items()}
        return name

    whole, kept = parts(zip(a.tolist(), b.tolist(), strict=True)), parts((int(a[i]), int(b[i])) for i in keep)
    assert {k: v for k, v in whole.items() if k in kept} == kept and len(keep) < 60


def test_parities_bound_the_differences():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 100, 3000):
        base = np.unique(rng.integers(0, 2**62, n).astype(np.uint64))
        for cut in (0, 1, 7, n // 10):
            other = np.unique(np.r_[base[cut:], rng.integers(0, 2**62, cut).astype(np.uint64)])
            a, b = jaccard_join.parities(base), jaccard_join.parities(other)
            assert len(a) == 16
            bits = sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))
            assert bits <= len(np.setxor1d(base, other)) and (bits > 0 or cut == 0 or n < 10)


def test_links_between_two_lists():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**62, 40).astype(np.uint64)
    one = [np.unique(np.r_[base[:rng.integers(20, 41)], rng.integers(0, 2**62, rng.integers(0, 6)).astype(np.uint64)]) for _ in range(30)]
    two = one[10:20] + [np.unique(rng.integers(0, 2**62, 9).astype(np.uint64))]
    x, y = jaccard_join._links_between(one, two)
    want = {(i, j) for i, s in enumerate(one) for j, t in enumerate(two)
            if 4 * len(np.intersect1d(s, t)) >= 3 * len(np.union1d(s, t))}
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == want and want


def test_jaccard_keeps_one_of_each_component(spark):
    rows = near_copies(random.Random(12), 80) + ODD_DOCS
    frame = docs_frame(spark, rows)
    out = jaccard_join.keep_one(frame)
    assert out.columns == frame.columns
    sets = [shingle_set(t) for _, t in rows]
    comp = groups(sets)
    best = {}
    for (i, t), s, c in zip(rows, sets, comp, strict=True):
        if s:
            best[c] = min(best.get(c, (True, 0)), (i is None, i or 0))
    exp = sorted([str(r) for r, s in zip(rows, sets, strict=True) if not s][:0] + [str(x) for x in best.values()])
    got = out.collect()
    assert sorted(str((r.doc_id is None, r.doc_id or 0)) for r in got if shingle_set(r.text)) == exp
    assert sum(not shingle_set(r.text) for r in got) == sum(not s for s in sets)
    assert jaccard_join.keep_one(frame.limit(0)).count() == 0


def test_shared_keys_and_sets_of_values():
    column = pa.array(["a b c d e f", "a b", "", None, "A B C D E F"])
    sets = dict(shingle_sets(column, 5))
    assert [len(sets[i]) for i in range(5)] == [2, 1, 0, 0, 2] and (sets[0] == sets[4]).all()
    for n in (1, 2, 7, 40, 500):
        s = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
        assert jaccard_join.set_keys(s)[1] == jaccard_join.set_value(s)
        assert jaccard_join.set_value(s) > jaccard_join.most_different(n)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}


def page(title, paragraphs, extra=""):
    body = "".join(f"<p>{p}" + ("</p>" if i % 2 else "") for i, p in enumerate(paragraphs))
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{a:b}}</style></head><body>"
            f'<header class="site">Site name</header><nav><ul><li>One<li>Two</ul></nav><!-- <p>no</p> -->'
            f'<div class="cookie-notice">We use cookies</div>{extra}<h1>{title}</h1>{body}'
            f'<script>var x = "</p><p>no";</script><form>Name <input></form><aside>More</aside>'
            f'<div id="comments"><p>First!</p></div><footer>&copy; all</footer></body>')


def test_html_main_text_without_an_article_element(spark):
    rng = random.Random(3)
    words = lambda: " ".join(f"t{rng.randrange(9999)}" for _ in range(8))
    promo = '<div class="box7"><p>Always the same words here</p></div>'  # only entropy can tell
    rows, exp = [], {}
    for i in range(20):
        title, ps = words(), [words() + " &amp; \n\t x<br>y &eacute;" for _ in range(3)]
        rows.append((i, f"https://Site.example/{i}", page(title, ps, promo)))
        exp[i] = "\n".join([title, *[re.sub(r"\s+", " ", p.replace("<br>", " ").replace("&amp;", "&")
                                            .replace("&eacute;", "é")) for p in ps]])
    for i in range(30, 45):  # copies of one page: nothing may be lost
        rows.append((i, f"http://copies.example/{i}", page("Same title", ["same text"])))
        exp[i] = "Same title\nsame text"
    rows += [(50, None, None), (51, "odd url", ""), (52, "http://x/", "no markup & at <all"), (53, "http://x/", "<p"),
             (54, "http://x/", "<main><p>in</p></main><p>out</p>"), (54, "http://x/", "<b>a</b>b<div>c</div></p>"),
             (55, "http://y/", "<article><header><h1>T</h1></header><p>q</p></article><div>z</div>")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = site_tree.main_text(frame.repartition(4)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert {i: by[i] for i in exp} == exp
    assert by[50] == by[51] == "" and by[52] == "no markup & at <all" and by[55] == "T\nq"
    assert {r.text for r in got if r.page_id == 54} == {"in", "ab\nc"}
    assert site_tree.main_text(frame.limit(0)).count() == 0


def test_html_main_text_is_not_lost_to_names_or_teasers(spark):
    rng = random.Random(5)
    words = lambda n=12: " ".join(f"t{rng.randrange(9999)}" for _ in range(n))
    side = '<div class="sidebar"><p>Side</p></div>'
    rows, exp = [], {}
    for i, body in enumerate([
            '<div class="content-sidebar-wrap"><nav>' + words(90) + '</nav><main><p>{}</p></main>' + side + '</div>',
            '<div class="layout has-sidebar"><div><p>{}</p></div>' + side + '</div>',
            '<form id="aspnetForm"><article><p>{}</p></article>' + side + '</form>',
            '<div><p>{}</p></div><div class="more"><article>Teaser</article><article>Two</article></div>']):
        exp[i] = words()
        rows.append((i, f"http://few{i}.example/", "<body>" + body.format(exp[i]) + "<footer>end</footer></body>"))
    exp[3] += "\nTeaser\nTwo"  # few pages: nothing tells that unlisted teasers are noise
    for i in range(100, 120):  # the tree keeps a listed name whose texts differ, and cuts one whose texts don't
        own, notice = words(16), words(11)
        rows.append((i, f"http://many.example/{i}", f'<div class="notice"><p>{notice}</p></div><article><p>{own}</p>'
                                                    f'</article><div class="related"><p>Read on</p></div>'
                                                    f'<nav><p>{words(1)}</p></nav>'))
        exp[i] = notice + "\n" + own
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in site_tree.main_text(frame).collect()} == exp


def test_html_nodes_with_names_of_their_own_are_merged(spark):
    rng = random.Random(6)
    words = lambda: " ".join(f"t{rng.randrange(9999)}" for _ in range(12))
    rows, exp = [], {}
    for i in range(20):
        exp[i] = words()
        slug = "slug-" + "abcdefghijklmnopqrst"[i]  # on one page only
        rows.append((i, f"http://blog.example/{i}", f'<html class="{slug}"><body class="post-{i} {slug}">'
                        f'<div id="post-{i}" class="post-{i} post {slug}"><div class="box"><p>The same on all</p></div>'
                        f'<div class="text" id="x{slug}"><p>{exp[i]}</p></div></div></body></html>'))
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in site_tree.main_text(frame).collect()} == exp


def luhn(d):
    s = [int(c) for c in d[::-1]]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(s)) % 10 == 0


def plain_base(t):
    num = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
               if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
                 if 16 <= len(num(m[0])) <= 19 and luhn(num(m[0]))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(num(m[0])) <= 15]}


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(6)
    for _ in range(4000):
        t = "".join(rng.choice(["@", ".", "a", "b-", "%", "1", "22", "255", "300", "+", " ", "(", ")", "é", "-",
                                "4111111111111111", "a@b.c", "1.2.3.4"]) for _ in range(rng.randrange(0, 25)))
        assert pii.base_spans(t)[0] == plain_base(t), t


def test_spelled_out_emails_are_candidates_in_any_case():
    for t in ("john at example dot com", "JOHN AT EXAMPLE DOT COM", "john [AT] example [DOT] com",
              "John (At) Example (Dot) Com"):
        assert pii.candidates("write: " + t + ", now") == [("email", 7, 7 + len(t), False)], t


def test_scanning_is_linear_on_hostile_texts():
    for t in ("a" * 300_000, "1" * 200_000, "@" * 100_000, "a@" * 100_000, "1." * 100_000, "+1 " * 60_000,
              "(" * 100_000, "token=" * 50_000):
        pii.candidates(t)


def test_reliabilities_are_recovered_and_held_out_spans_classified():
    rng = np.random.default_rng(1)
    right = np.array([.97, .8, .7, .9, .75])
    y = rng.random(20_000) < .4
    kind = rng.integers(0, 4, len(y))
    vote = np.where(rng.random((len(y), 5)) < right, 1, -1) * np.where(y, 1, -1)[:, None]
    vote[rng.random(vote.shape) < .2] = 0
    counts = {}
    for k, v in zip(kind.tolist(), map(tuple, vote.tolist()), strict=True):
        counts[k, v] = counts.get((k, v), 0) + 1
    patterns = sorted((k, v, n) for (k, v), n in counts.items())
    table, share, post = pii.estimate(patterns)
    got = table[1][:, 2] / (table[1][:, 2] + table[1][:, 0])
    assert np.abs(got - right).max() < .03 and np.abs(share[:4] - .4).max() < .05
    target = {(k, v): p for (k, v, _), p in zip(patterns, post, strict=True)}
    x = np.array([pii.features(pii.KINDS[k], tuple(v), 10, 5) for k, v in zip(kind.tolist(), vote.tolist(), strict=True)])
    soft = np.array([target[k, tuple(v)] for k, v in zip(kind.tolist(), vote.tolist(), strict=True)])
    w = pii.fit(x[:10_000], soft[:10_000])
    assert ((x[10_000:] @ w > 0) == y[10_000:]).mean() > .95


def test_long_runs_of_zeros_are_numbers(spark):
    zeros = "0" * 5000
    texts = [zeros + ".1.1.1", f"1.{zeros}7.{zeros}.2", "1.2.3." + "9" * 5000, "1.2.3." + zeros + "256"]
    got = pii.find(docs_frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [r.n_ip for r in got] == [1, 1, 0, 0]


def test_training_rows_are_bounded_whatever_the_corpus(spark):
    rng = random.Random(9)
    words = lambda: "".join(rng.choice("abcdef0123456789_/+-") for _ in range(rng.randrange(12, 70)))
    rows = [(i, f"secret = {words()} and token: {words()}") for i in range(3000)]
    scanned = docs_frame(spark, rows).selectExpr("doc_id", "text").mapInArrow(
        pii._scan, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
                   "candidates array<struct<kind:int,start:bigint,end:bigint,base:boolean,votes:array<int>,x:array<double>>>")
    sizes = []
    real = pii.fit
    for bound in (50, 10**6):
        pii.fit = lambda x, *a: sizes.append(len(x)) or real(x, *a)
        try:
            few = pii.train(scanned, bound)
        finally:
            pii.fit = real
        assert few is not None
    assert 20 < sizes[0] < 100 < sizes[1]


def test_personal_data_of_documents(spark):
    rng = random.Random(8)
    plain = lambda: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "12", "7.5"]) for _ in range(12))
    rows, secrets = list(ODD_DOCS), {}
    for i in range(300):
        t = plain()
        if i % 3 == 0:
            t += f" mail x{i}@mail.example.com call +1 (407) 555-{1000 + i} from 10.20.{i % 250}.9 now"
        if i % 4 == 0:
            key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            t += f' token = "{key}" '
            secrets[100 + i] = (t.index(key), t.index(key) + 40)
        if i % 5 == 0:
            t += f" order {rng.randrange(10**15, 10**16)} " + plain()
        rows.append((100 + i, t))
    got = pii.find(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t in rows}
    for r in got:
        if r.doc_id is None or r.doc_id < 100:
            continue
        base = plain_base(texts[r.doc_id])
        mine = [(pii.KINDS[f.kind], f.start, f.end) for f in r.found]
        assert [x for x in mine if x[0] in base and x[1:] in base[x[0]]] == [(k, *s) for k in pii.BASE_KINDS for s in base[k]]
        assert [x[1:] for x in mine if x[0] == "secret"] == ([secrets[r.doc_id]] if r.doc_id in secrets else [])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base[k]) for k in pii.BASE_KINDS)
    assert pii.find(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("html, texts", [
    ("<p>Par one <script>x()</script>goes on</p>", ["Par one goes on"]),
    ("<p>a <button>b</button>c <picture><source src=x><img></picture>d<svg><path/>q</svg> e</p>", ["a c d e"]),
    ("<p>a<select><option>x<option>y</select>b</p>c", ["ab", "c"]),
    ("<p>a <button>x</p>b", ["a", "b"]),
    ("<p>a <textarea>x</textarea><input type=text>b<p>c", ["a b", "c"]),
    ("<a title='x > y'>b</a> c <a title=\"<p>\">d</a>", ["b c d"]),
    ("1 < 2 and <3 <a href=\"x>y", ["1 < 2 and <3 <a href=\"x>y"]),
    ("a<!-- <p> -->b<!doctype html>c<?x y?>d<!--", ["abcd"]),
    ("<button>a<div>b</div></button>c", ["c"]),
])
def test_blocks_of_a_page(html, texts):
    assert [t for _, t, _ in site_tree.parse(html)[0]] == texts


@pytest.mark.parametrize("part, times, tail", [
    ('<a href="', 222_222, ""), ('<a href="', 222_222, '">'), ("<a ", 666_666, ""), ("<a b='", 300_000, '"'),
    ("<a b='<a c=\"", 150_000, ">"), ("<", 2_000_000, ""), ("<!--", 500_000, ""), ("</p", 500_000, ""),
    ("<div>", 100_000, "x"), ("<nav>", 100_000, "x"), ("<div>", 100_000, "</b2>" * 100_000 + "x"),
    ("<div>", 20_000, "<article>t</article>" * 20_000)])
def test_odd_pages_take_linear_time_and_memory(part, times, tail):
    import time
    import tracemalloc

    begin = time.process_time()
    site_tree.parse(part * times + tail)
    assert time.process_time() - begin < 12
    tracemalloc.start()
    site_tree.parse(part * (times // 20) + tail[:50_000])
    assert tracemalloc.get_traced_memory()[1] < 60_000_000
    tracemalloc.stop()


def test_texts_below_the_deepest_node_stay():
    deep = "<div>" * 3000 + "<p>one</p><p>two</p>" + "</div>" * 2999 + "three"
    blocks, styles = site_tree.parse(deep)
    assert [t for _, t, _ in blocks] == ["one", "two", "three"]
    assert max(p.count(">") for p, _, _ in blocks) == site_tree.MAX_DEPTH - 1 and len(styles) <= site_tree.MAX_DEPTH
