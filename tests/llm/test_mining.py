"""Phrases, spelling variants and benchmark windows against brute force, with odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tillflow.llm import decontaminate as dc
from tillflow.llm import phrases, spelling

# Extra columns are named like the operators' own.
DOCS = "doc_id long, text string, lang string, word string, n long, phrase string, address string, `a.b` string, term string, pos int"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "w", 1, "p", "a", "b", "t", 2) for i, t, lang in rows], DOCS)


ODD = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n.,;:!?\x0b\x0c\r ", None),
    (None, "no id here, no id here", "en"),
    (4, "É é ÉÉ日本 😀x\ty", "und"),
    (4, "É é ÉÉ日本 😀x\ty", None),
    (5, "y" * 30000, "fr"),
]


# ---- phrases


def brute_phrases(rows, least, per_lang):
    count, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(SMALL)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                count[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    found = []
    for lang, f in count.items():
        candidates = {phrase: a for phrase, a in f.items() if len(phrase) > 1 and a >= least}
        inside = {
            phrase[i : i + n]
            for phrase, a in candidates.items() for n in range(2, len(phrase)) for i in range(len(phrase) - n + 1)
            if 100 * a >= 80 * f[phrase[i : i + n]]
        }
        rated = []
        for phrase, a in candidates.items():
            if phrase not in inside:
                score, k = min((2_000_000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, len(phrase)))
                rated.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:per_lang], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(found)


def phrase_rows(rng):
    words = ["of", "the", "in", "spite", "éa", "É", "x", "new", "york", "日本"]
    chance = np.array([30, 25, 15, 5, 5, 5, 5, 4, 4, 2]) / 100
    rows = list(ODD)
    for i in range(60):
        text = "".join(str(w) + str(rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\r\n"])) for w in rng.choice(words, 40, p=chance))
        rows.append((10 + i, text + "New York in spite of the", str(rng.choice(["en", "fr"]))))
    return rows + [(10, rows[-1][1], "en")] * 5


@pytest.mark.parametrize("slice_bytes", [1 << 20, 37])
def test_phrases_match_brute_force(spark, monkeypatch, slice_bytes):
    rows = phrase_rows(np.random.default_rng(3))
    for per_lang in (2000, 7):
        monkeypatch.setattr(phrases, "SLICE_BYTES", slice_bytes)
        got = phrases.collocations(documents(spark, rows), least=12, per_lang=per_lang).drop("first_doc")
        assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 12, per_lang)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_slices_end_at_breakers():
    """Runs of words are the same however the texts are cut."""
    texts = pa.array(["one two.three four five, six", "seven", "", "eight nine ten eleven twelve", None])
    whole = [run.grams(2)[1] for run in phrases.runs(texts, np.zeros(5, np.uint64))]
    before, phrases.SLICE_BYTES = phrases.SLICE_BYTES, 4
    try:
        cut = [run.grams(2)[1] for run in phrases.runs(texts, np.zeros(5, np.uint64))]
    finally:
        phrases.SLICE_BYTES = before
    assert len(cut) > 1 and len(np.concatenate(whole)) == 7
    assert np.array_equal(np.sort(np.concatenate(whole)), np.sort(np.concatenate(cut)))


def test_colliding_fingerprints_are_told_apart_by_text():
    run = next(phrases.runs(pa.array(["aa bb aa cc aa bb"]), np.zeros(1, np.uint64)))
    texts, counts, at = phrases._materialised(run, 1, np.arange(6), np.array([7, 7, 7, 7, 7, 9], np.uint64))
    found = Counter()
    for text, n in zip(texts.to_pylist(), counts):
        found[text] += int(n)
    assert found == {"aa": 3, "bb": 2, "cc": 1}


def test_a_full_table_loses_no_phrase(spark, monkeypatch):
    rows = phrase_rows(np.random.default_rng(5))
    full = np.full(1 << phrases.TABLE_BITS, np.iinfo(np.uint64).max, np.uint64)
    monkeypatch.setattr(phrases, "frequent_table", lambda *a: full)
    got = phrases.collocations(documents(spark, rows), least=12).drop("first_doc")
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 12, 2000)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, ODD)).count() == 0


# ---- spelling


def brute_variants(rows, losses=199):
    count = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % losses == 0 else run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}

    def one_edit(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: x for w, x in form.items() if words[x] >= 5 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def spelling_rows(rng):
    rows = list(ODD)
    stems = ["abcabc", "aaaaaa", "aaaaaaa", "émigré", "colour", "writing"]
    for i in range(300):
        word = list(str(rng.choice(stems, p=[0.1, 0.3, 0.3, 0.1, 0.1, 0.1])))
        for _ in range(int(rng.choice([0, 1, 2], p=[0.6, 0.3, 0.1]))):
            at = int(rng.integers(0, len(word)))
            word[at : at + int(rng.integers(0, 2))] = str(rng.choice(list("abé")))
        rows.append((i, " ".join(["".join(word).capitalize(), "".join(word)] * int(rng.choice([1, 3, 12]))), None))
    return rows


@pytest.mark.parametrize("most", [512, 3])
def test_variants_match_brute_force(spark, most):
    rows = spelling_rows(np.random.default_rng(7))
    want = brute_variants(rows)
    got = spelling.variants(documents(spark, rows), most=most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert len({r for _, _, r, *_ in want}) < len(want) and max(w[4] for w in want) > 5


def test_chains_of_forms_end_at_one_root(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb"]
    rows = [(n, f"{word} " * 5**n * 5, None) for n, word in enumerate(chain)]
    got = {r.word: (r.form, r.root) for r in spelling.variants(documents(spark, rows)).collect()}
    assert got == {"aaaaaa": ("aaaaab", "aaabbb"), "aaaaab": ("aaaabb", "aaabbb"), "aaaabb": ("aaabbb", "aaabbb"), "aaabbb": (None, "aaabbb")}


def test_a_block_of_words_that_share_a_head_is_split(spark):
    """All words begin alike, so the first keys hold all of them."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"prefix{a}{b}{c}" for a in letters[:9] for b in letters[:9] for c in letters[:9]]
    rows = spelling.blocks(spark.createDataFrame([(w, 9) for w in words], "word string, n long"), most=50)
    assert max(r["count"] for r in rows.groupBy("key").count().collect()) <= 50
    near = spelling.near_words(spark.createDataFrame([(w, 9) for w in words], "word string, n long"), most=50)
    assert near.count() == near.distinct().count() == len(words) * 24


def test_long_words(spark):
    word = "y" * 3000 + "x" * 3000
    rows = [(1, f"{word} " * 30 + f"{word}y {word[1:]} " * 5, None)]
    got = {len(r.word): (r.form and len(r.form), r.n_near) for r in spelling.variants(documents(spark, rows)).collect()}
    assert got == {6000: (None, 2), 6001: (6000, 1), 5999: (6000, 1)}


def test_variants_of_nothing(spark):
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, ODD)).count() == 0


# ---- benchmark windows

ITEMS = "item_id long, text string, phrase string, id long, lists string"


def items(spark, rows):
    return spark.createDataFrame([(i, t, "p", 1, "l") for i, t in rows], ITEMS)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def brute_windows(rows, bench):
    windows = defaultdict(set)
    for i, text in bench:
        w = words_of(text)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[k : k + 10])].add("" if i is None else str(i))
    found = []
    for i, text, _ in rows:
        w, hit, met = words_of(text), set(), set()
        for n in {len(window) for window in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    met |= windows[tuple(w[k : k + n])]
        found.append((i, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=str)


LONG = "Which of these birds can not fly although it has wings and feathers like the others do in the wild north"
BENCH = [(7, LONG), (10, "the the the"), (11, LONG[:70]), (12, "q1 Éa 日本 x"), (12, "a b c d e f g h i j k"), (None, "no id but words"), (13, None), (14, "..."), (15, "words nobody wrote")]


def window_rows():
    rows = list(ODD)
    rows += [(20, f"Start, {LONG.upper()}! End of it", "en"), (21, LONG[:55], "en"), (22, "the the the the; THE the", "en")]
    rows += [(23, LONG, "en"), (23, LONG, "en"), (24, f"{LONG} {LONG} the the", None), (25, "a b c d e f g h i j k a b c d e f g h i j", "en")]
    rows += [(26, "no id, but words. q1-Éa_日本(x)", "en"), (27, "the words " * 3000 + LONG, "en"), (28, "a b c d e f g h i x j k", "en")]
    return rows


@pytest.mark.parametrize("most", [dc.BROADCAST_BYTES, 0])
def test_windows_match_brute_force(spark, most):
    rows = window_rows()
    got = dc.decontaminate(documents(spark, rows), items(spark, BENCH), most=most)
    found = [tuple(r)[:6] for r in got.collect()]
    assert sorted(found, key=str) == brute_windows(rows, BENCH)
    assert sum(r[5] for r in found) >= 8


def test_proximity(spark):
    """A word too many breaks the phrase, and stays within two places."""
    rows = [(1, "a b c d e f g h i x j k", "en"), (2, "a b c d e f g h i x y z j k", "en"), (3, "a b c d e f g h i j k", "en"), (4, "k j i h g f e d c b a", "en")]
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in dc.decontaminate(documents(spark, rows), items(spark, BENCH)).collect()}
    assert got == {1: (0, 1), 2: (0, 0), 3: (1, 1), 4: (0, 0)}


def test_windows_of_nothing(spark):
    assert dc.decontaminate(documents(spark, []), items(spark, BENCH)).count() == 0
    got = dc.decontaminate(documents(spark, ODD), items(spark, [])).collect()
    assert len(got) == len(ODD) and not any(r.contaminated for r in got)


def test_no_python_touches_the_windows(spark):
    docs, bench = documents(spark, window_rows()), items(spark, BENCH)
    held = dc.windows(bench)
    terms = held.selectExpr("explode(terms) as term").distinct()
    plans = [held, dc.term_counts(docs, terms, True), dc.index(docs, terms, terms, True, 11), dc.index(docs, terms, terms, False, 11)]
    for frame in plans:
        assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().executedPlan().toString())
