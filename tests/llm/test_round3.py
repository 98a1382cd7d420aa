"""URL filters, vector codes and phrases against plain versions of them, on the test data and on rows made to be awkward."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import pairwise
from urllib.parse import unquote

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidewell.llm import phrases, queries, url_filter, vector_codes


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


# URL filters

URLS = [
    None, "", "no scheme", "http://", "https://Example.NET", "https://example.net/en/x", "https://a.EXAMPLE.net/fr/", "https://notexample.net/en/", "http://net/",
    "http://net", "ftp://x.org/fr/a?b#c", "http://x.org?/fr/", "http://x.org#/fr/", "x://y://z.net/", "http://example.com/de/casino", "http://a.b/casino", "http://a.b/casinos",
    "http://a.b/xcasino", "http://a.b/CASINO-win", "http://cheap.a.b/", "http://cheap-cheap.a.b/cheap", "http://cheap-pills.a.b/", "http://a.b/c%61sino", "http://a.b/?q=free_money",
    "http://a.b/" + "x/" * 50_000 + "porn", "http://a.b/écasino", "http://a.b/%zz%", "http://user@net:80/", "://", "http://a.b/win?win=farm#bonus", "http://a.b/\ncasino",
]


def plain_verdict(url, rules, strict, soft):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    rule = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
    text = lower(unquote(url or ""))
    has = lambda t: any(
        text[m.start() : m.end()] == t and not text[m.start() - 1 : m.start()].isalnum() and not text[m.end() : m.end() + 1].isalnum()
        for m in re.finditer(f"(?={t})" + t, text)
    )
    bad = any(map(has, strict)) or sum(map(has, soft)) >= 2
    return host, path, rule and rule[1] + rule[2], rule[0] if rule else "block" if bad else "allow"


def test_urls(spark):
    r = random.Random(3)
    pieces = ["casino", "cheap", "pills", "win", "a", "-", "/", ".", "net", "org", "example", "?", "#", "de/", "fr/", "en/", "%20", "x", "X", "Casino", "_"]
    urls = URLS + ["http://" + "".join(r.choices(pieces, k=r.randint(1, 9))) for _ in range(3000)]
    pages = spark.createDataFrame([(i if i % 50 else None, u, 1, "x") for i, u in enumerate(urls)], "page_id long, url string, host int, verdict string")
    got = url_filter.judge(pages.repartition(3), queries.RULES).collect()
    key = lambda x: tuple(map(repr, x))
    expect = [(i if i % 50 else None, *plain_verdict(u, queries.RULES, url_filter.STRICT, url_filter.SOFT)) for i, u in enumerate(urls)]
    assert sorted(((x.page_id, x.host, x.path, x.rule, x.verdict) for x in got), key=key) == sorted(expect, key=key)
    by = {x.page_id: x for x in got}
    assert by[URLS.index("http://a.b/win?win=farm#bonus")].soft == ["bonus", "farm", "win"]
    assert [by[URLS.index(f"http://a.b/{x}")].verdict for x in ("casino", "casinos", "xcasino", "écasino")] == ["block", "allow", "allow", "allow"]
    assert url_filter.judge(pages.limit(0), queries.RULES).collect() == []


def test_url_rules_of_equal_length():
    f = url_filter.Filter([("allow", "b.c", "/x"), ("block", "c", "/xyz"), ("allow", "d.e", "/"), ("block", "d.e", "/")], (), ())
    assert f.rule("a.b.c", "/xyz")[0] == "allow" and f.rule("d.e", "/")[0] == "block" and f.rule("", "") is None


# Vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """By the contract alone: {row: (code, error)} of the rows that stay, label sums and the entries' hash."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    kept.sort(key=lambda x: (x[0] is None, x[0], x[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, w: min((far(w, e), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(near(p, cut(v)[p])[1], []).append(cut(v)[p])
            for e, points in own.items():
                new[p][e] = tuple(sum(c) // len(points) for c in zip(*points, strict=True))
        books = new
    found = [(i, label, [near(p, w) for p, w in enumerate(cut(v))]) for i, v, label in kept]
    sums = Counter()
    for _, label, n in found:
        sums[label] += sum(d for d, _ in n)
    out = [(i, bytes(e for _, e in n), sum(d for d, _ in n), sums[label]) for i, label, n in found]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def _codes(spark, rows, label="int"):
    df = spark.createDataFrame([(*r, 1.0, "c") for r in rows], f"vec_id long, embedding array<float>, label {label}, error double, code string")
    found, books = vector_codes.compress(df.repartition(3))
    key = lambda x: tuple(map(repr, x))
    return sorted(((x.vec_id, bytes(x.code), x.error, x.label_error) for x in found.collect()), key=key), vector_codes.fingerprint(books)


@pytest.mark.parametrize("kind", ["normal", "ties", "few", "one", "none"])
def test_vector_codes(spark, kind):
    r = np.random.default_rng(5)
    n = {"normal": 300, "ties": 200, "few": 5, "one": 1, "none": 0}[kind]
    v = np.round(r.normal(size=(n, 16)), 0 if kind == "ties" else 4) / (1 if kind != "ties" else 4)
    rows = [(int(i) if kind != "ties" else int(i) // 3, [float(np.float32(x)) for x in v[i]], int(i) % 3 or None) for i in range(n)]
    rows += [(-1, None, 1), (-2, [None] * 16, 1), (-3, [float("nan")] * 16, 2), (-4, [1.0] * 15 + [float("-inf")], 2)]
    rows += rows[:20] + ([(None, rows[0][1], 4)] if n else [])
    expect, digest = plain_codes(rows)
    key = lambda x: tuple(map(repr, x))
    assert _codes(spark, rows) == (sorted(expect, key=key), digest)


def test_vectors_of_other_lengths_and_too_large(spark):
    ok = [(i, [float(i % 7), *[0.5] * 7], 1) for i in range(30)]
    found, _ = _codes(spark, [*ok, (40, [1.0] * 16, 1), (41, [], 1)])
    assert [x[0] for x in found] == sorted(range(30), key=repr)
    with pytest.raises(Exception, match="64 bits"):
        _codes(spark, [*ok, (50, [1e30] * 8, 1)])
    with pytest.raises(ValueError, match="equal parts"):
        _codes(spark, [(1, [1.0] * 7, 1)])


def test_tree_finds_the_nearest_entry():
    r = np.random.default_rng(2)
    for n, low, high in ((16, -3, 3), (256, -50, 50), (16, -(1 << 27), 1 << 27), (3, 0, 1), (40, 0, 2)):
        entries, points = r.integers(low, high, (n, 4)), r.integers(low, high, (2000, 4))
        points[:n] = entries
        d = ((points[:, None] - entries) ** 2).sum(2)
        which, best = vector_codes.Tree(entries).nearest(points)
        assert (which == d.argmin(1)).all() and (best == d.min(1)).all()


def test_roots_are_rounded_outward():
    d = np.array([0, 1, 2, 3, 4, (1 << 60) - 1, 1 << 60, (1 << 60) + 1, (1 << 30) ** 2 - 1], np.int64)
    low, high = vector_codes.roots(d)
    for x, a, b in zip(d.tolist(), low.tolist(), high.tolist(), strict=True):
        assert a == math.isqrt(x) and b == a + (a * a < x)


def test_codes_decode(spark):
    r = np.random.default_rng(5)
    v = r.normal(size=(50, 8))
    found, books = vector_codes.compress(spark.createDataFrame([(i, v[i].tolist(), 1) for i in range(50)], "vec_id long, embedding array<double>, label int"))
    for x in found.collect():
        assert sum((np.floor(v[x.vec_id] * 4096) - vector_codes.decode(x.code, books) * 4096) ** 2) == x.error


# Phrases


def plain_phrases(rows, longest=3, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und" if lang is None else lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang if lang is not None else "und", *w[i : i + m]) for i in range(len(w) - m + 1))
    found = {}
    for (lang, *w), a in f.items():
        if len(w) > 1 and a >= least:
            cuts = [(1_000_000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found[lang, *w] = (score, a, f[lang, *w[:k]], f[lang, *w[k:]])
    gone = set()
    for lang, *w in found:
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * f[lang, *w] >= share * f[lang, *w[i:j]]:
                    gone.add((lang, *w[i:j]))
    out = []
    for lang in n:
        own = sorted(((-s, -a, " ".join(w).encode(), l_, r) for (x, *w), (s, a, l_, r) in found.items() if x == lang and (x, *w) not in gone))
        out += [(lang, i + 1, p.decode(), -a, l_, r, n[lang], -s) for i, (s, a, p, l_, r) in enumerate(own[:top])]
    return sorted(out)


def _phrases(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "text string, lang string, a int, phrase string").repartition(3)
    found = phrases.collocations(df, **how).collect()
    return sorted((x.lang, x.rank, x.phrase, x.a, x.l, x.r, x.n, x.score) for x in found)


@pytest.fixture(scope="module")
def prose():
    r = random.Random(11)
    words = ["the", "The", "of", "new", "york", "City", "é", "漢字", "a-b", "x", "\u00a0", "ÀB", "\x01"]
    rows = [("".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ", ", "\n", ". "]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None, "und"])) for _ in range(400)]
    rows += [(None, "en"), ("", None), (" .,;", "de"), ("same words here again " * 30, "fr"), (" ".join(f"w{i % 300}" for i in range(60_000)), "fr"), ("the of " * 20_000, "en"), ("lone", "xx")]
    return rows + rows[:20]


def test_phrases(spark, prose):
    expect = plain_phrases(prose)
    assert len({x[0] for x in expect}) == 4 and any(len(x[2].split(" ")) == 3 for x in expect)
    assert _phrases(spark, prose) == expect


@pytest.mark.parametrize("how", [{"longest": 2}, {"longest": 5, "least": 4, "share": 90, "top": 40}, {"least": 1, "top": 3}])
def test_phrases_of_other_lengths(spark, prose, how):
    assert _phrases(spark, prose[:150], **how) == plain_phrases(prose[:150], **how)


def test_phrases_of_spread_prefixes(spark, prose, monkeypatch):
    """With small cells most prefixes are spread over several; nothing changes."""
    monkeypatch.setattr(phrases, "CELL", 500)
    monkeypatch.setattr(phrases, "MOST_SPREAD", 9)
    assert _phrases(spark, prose) == plain_phrases(prose)


def test_phrases_of_nothing(spark):
    assert _phrases(spark, []) == [] and _phrases(spark, [(None, None), ("a b", "en")]) == []


def test_phrase_scores_past_64_bits(spark):
    single = spark.createDataFrame([("x", "a", 4 * 10**12), ("x", "b", 3 * 10**12)], "lang string, phrase string, f long")
    pair = spark.createDataFrame([("x", "a b", 2 * 10**12 + 1)], "lang string, phrase string, f long")
    found = phrases.scored(single, pair).collect()[0]
    assert found.score == 1_000_000 * (2 * 10**12 + 1) ** 2 // (12 * 10**24)


def test_windows_compress_their_keys():
    r = np.random.default_rng(1)
    codes, piece = r.integers(0, 9, 500), np.sort(r.integers(0, 40, 500))
    for n_words in (9, 1 << 31, 1 << 60):
        matrix, counts = phrases._windows(codes, piece, n_words, 4)
        expect = Counter(tuple(int(codes[i + k]) if i + k < 500 and piece[i + k] == piece[i] else -1 for k in range(4)) for i in range(500))
        assert dict(zip(map(tuple, matrix.T.tolist()), counts.tolist(), strict=True)) == expect


def test_growth_never_extends_what_is_rare():
    matrix = np.array([[0, 0, 0, 1], [1, 1, 2, 0], [2, 3, -1, 1]])
    found = list(phrases.grow(matrix, np.array([5, 6, 1, 3]), 4, np.ones(4, bool)))
    assert [(x.T.tolist(), f.tolist()) for x, f in found] == [([[0]], [12]), ([[0, 1]], [11]), ([[0, 1, 2], [0, 1, 3]], [5, 6])]
    assert all(len(a[0]) + 1 == len(b[0]) for a, b in pairwise(found))


def test_queries_read_whole_tables(spark, data):
    counts = {t: spark.read.parquet(f"{data}/{t}.parquet").count() for t in ("pages", "embeddings")}
    assert queries.QUERIES["op11_url_filter"](spark, data).count() == counts["pages"]
    coded = queries.QUERIES["op12_vector_codes"](spark, data)
    assert coded.count() == counts["embeddings"] and coded.agg(F.count_distinct("codebooks_sha256")).first()[0] == 1
