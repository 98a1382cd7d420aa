"""Plain versions of the operators, for small inputs."""

import re
import zlib

from xxhash import xxh64_intdigest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ids(text):
    """By the library as it comes, with no setting changed."""
    import public_tokenizers
    from tokenizers import Tokenizer

    t = ids.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def crc(values):
    return zlib.crc32(b"".join(v.to_bytes(4, "little") for v in values))


def simhash(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def base_measures(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)} if len(grams) != len(set(grams)) else set()
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def secrets(text):
    text = text or ""
    found = [("assign", m) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 12]
    found += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def repeated(docs, n=50):
    """{doc: word numbers} that lie in a run of n words which another document has too."""
    seen = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - n + 1):
            seen.setdefault(tuple(w[i : i + n]), set()).add((d, i))
    out = {}
    for places in seen.values():
        if len({d for d, _ in places}) > 1:
            for d, i in places:
                out.setdefault(d, set()).update(range(i, i + n))
    return out


KEY = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SENSITIVE = re.compile("passw|passphrase|secret|token|api.?key|credential|private.?key|access.?key|bearer|authorization", re.I | re.A)


def novelty(text, start, end, dictionary):
    """Of ASCII text: bytes that text[start:end] adds to 512 bytes on each side, without its other occurrences there."""
    import zstandard

    def size(s):
        d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=9, dict_data=d, write_content_size=False, write_checksum=False).compress(s.encode()))

    s = text[start:end]
    sides = []
    for side in (text[max(0, start - 512 - len(s)) : start], text[end : end + 512 + len(s)]):
        for part in sorted({s} | {p for p in re.split("[^A-Za-z0-9+/_-]+", s) if len(p) >= 16}, key=len, reverse=True):
            side = side.replace(part, "\0" * len(part))
        sides.append(side)
    around = (sides[0][-512:] + sides[1][:512]).replace("\0", "")
    forms = {s, s.lower()} if not any(c.islower() for c in s) else {s}
    return (min(map(size, forms)) - size(around)) / len(s)


def novel(text, dictionary, least=0.8, letters=0.7, reach=80):
    """Spans of ASCII text, beside those of ``secrets``."""
    words = [m.span() for m in SENSITIVE.finditer(text)]
    inside = {i for a, b in words for i in range(a, b)}
    out, i = [], 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] in KEY and j not in inside:
            j += 1
        s = text[i:j]
        limit = letters if set(s) <= set("abcdefghijklmnopqrstuvwxyz") or set(s) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ") else least
        near = any(0 <= i - b < reach or 0 < a - j < reach for a, b in words)
        if len(s) >= 16 and near and not any(a < j and i < b for _, a, b in secrets(text)) and novelty(text, i, j, dictionary) >= limit:
            out.append((i, j))
        i = max(j, i + 1)
    return out


def judged(rows, min_docs, min_share, depleted=0.3):
    """Per row (doc_id, host, text): words in frequent lines, and whether the document is kept. Distinct texts of a host that
    hold a line are counted, nothing else."""
    line_of = lambda x: re.sub("[1-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(words(x))))
    frequent = {}
    for host in {h for _, h, _ in rows}:
        texts = {t or "" for _, h, t in rows if h == host}
        counts = {}
        for t in texts:
            for x in {line_of(x) for x in t.split("\n") if words(x)}:
                counts[x] = counts.get(x, 0) + 1
        frequent[host] = {x for x, n in counts.items() if n >= min_docs and n >= min_share * len(texts)}
    out = []
    for d, host, t in rows:
        lines = [x for x in (t or "").split("\n") if words(x)]
        gone = sum(len(words(x)) for x in lines if line_of(x) in frequent[host])
        n, _, _, _, repeated_ = base_measures(t)
        out.append((d, gone, not (n < 50 or 2 * repeated_ > n) and n - gone >= depleted * n))
    return out


def mixed(rows, targets, budget, seed=17):
    """Copies taken of each row (doc_id, text, source), as a list in the order of ``rows``: one queue for each source, one stream."""
    import struct

    signed = lambda x: x - 2**64 if x >> 63 else x

    def key(row):
        h = xxh64_intdigest(struct.pack("<i", seed), 42)
        for part in (None if row[0] is None else struct.pack("<q", row[0]), *(None if x is None else x.encode() for x in row[1:])):
            h = h if part is None else xxh64_intdigest(part, h)
        return signed(h)

    sizes = [len(words(t)) for _, t, _ in rows]
    totals = {s: sum(n for n, r in zip(sizes, rows, strict=True) if r[2] == s) for s in {r[2] for r in rows}}
    queues, stream = dict.fromkeys(totals, 0), []
    for i in sorted(range(len(rows)), key=lambda i: (key(rows[i]), rows[i][0] is not None, rows[i][0] or 0)):
        s = rows[i][2]
        queues[s] += sizes[i]
        for copy in (0, 1):
            stream.append(((queues[s] + copy * totals[s]) / targets[s] if targets[s] > 0 else 0.0, key(rows[i]), copy, i))
    out, used = [0] * len(rows), 0
    for _, _, _, i in sorted(stream):
        used += sizes[i]
        if used > budget:
            break
        out[i] += 1
    return out


def languages(training, per_lang=400, dict_bytes=112 * 1024):
    """Dictionary content of each language of (text, lang), the commonest language first."""
    signed = lambda x: x - 2**64 if x >> 63 else x
    counts, found = {}, {}
    for _, lang in training:
        if lang is not None:
            counts[lang] = counts.get(lang, 0) + 1
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        texts = sorted({t for t, k in training if k == lang and t}, key=lambda t: signed(xxh64_intdigest(t.encode(), 42)))[:per_lang]
        if texts:
            share = -(-dict_bytes // len(texts))
            parts = [t[max(0, int((len(t) - share) / 2)) :][:share].lower() for t in texts]
            found[lang] = " ".join(parts).encode()[-dict_bytes:]
    return found


def language(text, dictionaries):
    import zstandard

    text = (text or "").lower()
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    raw, sizes = text.encode(), []
    for lang, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        size = lambda part, d=d: len(zstandard.ZstdCompressor(level=6, dict_data=d, write_content_size=False, write_checksum=False).compress(part))
        sizes.append((sum(size(raw[i : i + 1024]) for i in range(0, len(raw), 1024)), lang))
    best, second = sorted(sizes, key=lambda x: x[0])[:2]
    return best[1], 1 - best[0] / second[0]
