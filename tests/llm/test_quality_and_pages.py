"""Classifier, perplexity rules, decontamination and page extraction."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm.latent import drop_leaks, find_leaks, lcs_length
from pluvio.llm.ordinal import GRADES, exceed, fit, grade_documents
from pluvio.llm.perplexity import CLASSES, classes, count_trigrams, fit as fit_grams, keep_good, quality_rules, score_table
from pluvio.llm.wrappers import align, content_mark, extract, fold, infer, main_text, skeleton

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot int, nll double, kept int, grade int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 1, 2.0, 3, 4) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(8)
    common = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 6))) for _ in range(200)]
    bad = ["scoundrel", "rotter", "knave", "blighter"]
    rows, labels = [], []
    for k in range(600):
        words = [r.choice(common) for _ in range(r.randint(60, 120))]
        kind = k % 6
        if kind == 0:
            for _ in range(6):
                words.insert(r.randrange(len(words)), r.choice(bad))
        elif kind == 1:
            words = [w + "%%%" for w in words]
        rows.append((k, " ".join(words), "en" if k % 2 else "de"))
        labels.append((k, int(kind != 1), int(kind == 0)))
    return rows, labels


EDGES = [(9000, None, None), (None, "", "en"), (9001, " \n ", "xx"), (None, None, "en"), (9002, "One", None), (9002, "One", None)]


def test_classifier_finds_held_out_grades(spark, corpus):
    rows, labels = corpus
    lab = spark.createDataFrame([x for x in labels if x[0] % 5] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = grade_documents(_docs(spark, rows + EDGES), lab).collect()
    assert len(got) == len(rows) + len(EDGES)
    held = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id % 5 == 0 and r.doc_id < 600}
    good = [held[k].kept for k, q, t in labels if k % 5 == 0 and q and not t]
    poor = [held[k].kept for k, q, t in labels if k % 5 == 0 and (t or not q)]
    assert np.mean(good) > 0.95 and np.mean(poor) <= 0.1
    assert all(0 <= r.expected_grade <= GRADES - 1 for r in got)
    assert all(not r.kept for r in got if r.n_features == 0)


def test_classifier_without_labels_keeps_texts(spark, corpus):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = grade_documents(_docs(spark, corpus[0][:3] + EDGES[:2]), none).collect()
    assert [r.kept for r in got] == [True] * 3 + [False] * 2 and all(r.expected_grade is None for r in got)


def test_thresholds_are_ordered():
    r = np.random.default_rng(0)
    rows = [r.integers(0, 1000, 20) for _ in range(300)]
    _, t = fit(rows, r.integers(0, 3, 300), epochs=3)
    assert (np.diff(t) > 0).all()
    up = exceed(np.linspace(-3, 3, 7), t)
    assert (np.diff(up, axis=1) < 0).all()


def _brute_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    twice = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(twice), failed


def test_base_rules_match_brute_force(spark, corpus):
    rows = corpus[0][:60] + EDGES + [(9100, "a b c a b c\nx\n\nx\n \n \nx é#|", "fr"), (9101, "Ho ho ho\n" * 30, "fr")]
    got = quality_rules(_docs(spark, rows)).collect()
    key = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted(map(key, got)) == sorted(_brute_base(t) for _, t, _ in rows)
    assert all(not r.kept for r in got if r.base_failed)


def test_bands_reject_both_tails_and_keep_the_rest(spark, corpus):
    rows = [x for x in corpus[0] if x[0] % 6 > 1]
    r = random.Random(6)
    rare = " ".join("".join(r.choice("qxzjvkwbdfgmpuyc§ÿ") for _ in range(r.randint(3, 8))) for _ in range(80))
    odd = [(9200, rare, "en"), (9201, " ".join("e" * r.randint(4, 40) for _ in range(90)), "en")]
    got = {r.doc_id: r for r in quality_rules(_docs(spark, rows + odd)).collect()}
    assert got[9200].perplexity > got[9200].high and not got[9200].kept
    assert got[9201].perplexity < got[9201].low and not got[9201].kept
    assert np.mean([got[i].kept for i, _, _ in rows]) > 0.97
    kept = keep_good(_docs(spark, rows + odd))
    assert kept.columns == _docs(spark, rows[:1]).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_every_language_has_its_own_model_and_band(spark):
    """One model per language whatever their number, and a band however few the documents."""
    r = random.Random(8)
    text = lambda letters, n=80: " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(n))
    langs = {"aa": "abcdef", "bb": "ghijkl", None: "mnopqr", "dd": "stuvwx", "small": "aeiouy"}
    rows = [(100 * k + j, text(x), lang) for k, (lang, x) in enumerate(langs.items()) for j in range(8 if lang == "small" else 60)]
    rows.append((999, "z#9 " + " ".join("%d#%d" % (j, 7 * j) for j in range(90)), "small"))
    got = {x.doc_id: x for x in quality_rules(_docs(spark, rows), block=2).collect()}
    one = {x.doc_id: x for x in quality_rules(_docs(spark, rows)).collect()}
    assert len(got) == len(rows) and got == one
    assert all(x.low < x.high for x in got.values())
    assert not got[999].kept and all(got[400 + j].kept for j in range(8))
    assert len({x.low for x in got.values()}) == len(langs)


def test_trigram_counts_and_probabilities(spark):
    texts = ["abc abd", "Ab, 12é", "", None]
    docs = _docs(spark, [(k, t, "en") for k, t in enumerate(texts)])
    counts = np.zeros(CLASSES**3, np.int64)
    for r in count_trigrams(docs, {"en": 0}).collect():
        counts[r.gram] = r.n
    want = np.zeros_like(counts)
    for t in texts:
        k = [0, 0, *classes(np.array([ord(c) for c in t or ""], np.int64)).tolist()]
        for a, b, c in zip(k, k[1:], k[2:], strict=False):
            want[a * CLASSES**2 + b * CLASSES + c] += 1
    assert (counts == want).all()
    table = score_table({o: (k, p, b) for o, k, p, b in fit_grams(counts)})
    totals = np.exp(table.astype(float)).reshape(-1, CLASSES).sum(1)
    assert np.allclose(totals, 1, atol=1e-3)  # each context is a distribution
    assert np.isfinite(table).all()


def test_characters_of_one_class_are_told_apart(spark):
    """Letters that share a class score by their own counts; perplexities as by brute force."""
    r = random.Random(11)
    text = lambda letters, n=70: " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(n))
    cyrillic = [chr(c) for c in range(0x430, 0x440)]
    rows = [(k, text(cyrillic), "ru") for k in range(60)] + [(100 + k, text("aeinrst"), "en") for k in range(60)]
    shifted = "".join(c if c == " " else chr(ord(c) + 48) for c in rows[0][1])  # the same classes throughout
    rows.append((99, shifted, "ru"))
    assert [*classes(np.array([*map(ord, shifted)]))] == [*classes(np.array([*map(ord, rows[0][1])]))]
    got = {x.doc_id: x for x in quality_rules(_docs(spark, rows)).collect()}
    assert got[99].perplexity > 2 * got[0].perplexity and not got[99].kept and got[1].kept
    for lang in ("ru", "en"):
        counts, chars, of_class = np.zeros(CLASSES**3, np.int64), collections.Counter(), collections.Counter()
        grams = {}
        for i, t, x in rows:
            if x == lang:
                k = [0, 0, *classes(np.array([*map(ord, t)], np.int64)).tolist()]
                grams[i] = [a * CLASSES**2 + b * CLASSES + c for a, b, c in zip(k, k[1:], k[2:], strict=False)]
                np.add.at(counts, grams[i], 1)
                chars.update(t)
                of_class.update(k[2:])
        table = score_table({o: (k, p, b) for o, k, p, b in fit_grams(counts)})
        for i, t, _ in (x for x in rows if x[0] in grams):
            member = [math.log(chars[c] / of_class[int(classes(np.array([ord(c)]))[0])]) for c in t]
            assert math.isclose(got[i].perplexity, math.exp(-table[grams[i]].mean(dtype=float) - np.mean(member)), rel_tol=1e-4)


def test_leaks_exact_and_paraphrased(spark, corpus):
    r = random.Random(3)
    vocabulary = ["".join(r.choice("bcdfglmpuvy") for _ in range(6)) for _ in range(3000)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(15, 70)))) for k in range(30)]
    rows, want = [x for x in corpus[0][:300]], set()
    for k, text in items:
        words = text.split()
        if k % 3 == 1:  # a paraphrase: some words changed, some added
            for at in range(2, len(words) - 6, 9):
                words[at] = "other"
            words.insert(len(words) // 2, "added")
        if k % 3 < 2:
            fill = corpus[0][k][1].split()
            rows.append((5000 + k, " ".join([*fill[:40], *words, *fill[40:]]).upper() if k % 2 else " ".join([*fill, *words]), "en"))
            want.add((5000 + k, k))
    bench = spark.createDataFrame([*items, (99, None), (98, ""), (None, "x y z")], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in find_leaks(_docs(spark, rows + EDGES), bench).collect()}
    assert got == want
    left = drop_leaks(_docs(spark, rows + EDGES), bench)
    assert left.columns == _docs(spark, rows[:1]).columns
    assert left.count() == len(rows) + len(EDGES) - len(want)


def test_leaks_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(_docs(spark, EDGES), none).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_leaks(_docs(spark, []), some).count() == 0


def test_lcs_length():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.choice("abc") for _ in range(r.randint(0, 9))] for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        assert lcs_length(a, b) == d[-1][-1]


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul>{menu}</ul></nav><!-- x --><div class='ad'>Buy</div><{root}><h1>Head &amp; more</h1>{body}</{root_end}>"
    "<div class='comments'><p>Nice post</p></div><form>Mail</form><footer>&copy; x</footer>{end}"
)


def _page(root, paragraphs, menu=3, end="</body></html>"):
    body = "".join(f"<p>{p}" + ("</p>" if k % 2 else "") for k, p in enumerate(paragraphs))
    page = PAGE.replace("{menu}", "<li><a href='/'>m</a></li>" * menu).replace("{body}", body).replace("{end}", end)
    return page.replace("{root_end}", root.split()[0]).replace("{root}", root)


def test_wrapper_has_optional_and_repeated_parts():
    a, b = skeleton(_page("article", ["one", "two", "three"])), skeleton(_page("article", ["one"], end=""))
    wrapper = infer([(2, [[n, False] for n in a]), (1, [[n, False] for n in b])])
    assert [["+", ["<p", "#"]], False] in wrapper and ["/body", True] in wrapper
    assert content_mark(wrapper) == "article"
    assert fold(["x", "x", "y", "z", "y", "z"]) == [["+", ["x"]], ["+", ["y", "z"]]]
    assert align([["a", False], ["b", False]], [["a", False]]) == [["a", False], ["b", True]]


@pytest.mark.parametrize("root", ["article", "main", "div class='post-content'", "section"])
def test_main_text_without_boilerplate(spark, root):
    texts = [["A <b>bold</b> &lt;x&gt;", "b\n  c"], ["only &eacute;"], ["1", "2", "3"]]
    rows = [(k, f"http://h.example/{k}", _page(root, t), "x") for k, t in enumerate(texts)]
    rows += [(10, None, None, "x"), (None, "bad url", "", "x"), (0, *rows[0][1:])]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    want = ["Head & more\n\nA bold <x>\n\nb c", "Head & more\n\nonly é", "Head & more\n\n1\n\n2\n\n3"]
    assert sorted(r.text for r in got) == sorted([*want, want[0], "", ""])
    assert all(r.n_chars == len(r.text) for r in got)
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_extract_survives_broken_markup():
    for page in ("<", "<p", "<a href='x", "</", "<!-- open", "<p a=\"1>x</p>", "<script>never", "&#0;&bogus;", "<div><p>a<div>b"):
        extract(page, "article")
    assert extract("<div><p>a<div>b</div></div>", "") == "a\n\nb"


def test_string_columns_of_other_types(spark):
    docs = _docs(spark, [(1, "a b", "en")]).withColumn("n_chars", F.lit(None).cast("long"))
    assert quality_rules(docs).count() == 1
