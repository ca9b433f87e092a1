"""Plain Python versions of the contracts, written from their text, and a table maker."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict
from html.entities import name2codepoint

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


def words(text, pattern=WORD):
    return pattern.findall((text or "").translate(ASCII))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def make_tables(folder, **tables):
    os.makedirs(folder, exist_ok=True)
    for name, table in tables.items():
        pq.write_table(table, f"{folder}/{name}.parquet")
    return folder


def documents(rows):
    """rows: (doc_id, text, lang); further columns have names that operators use inside."""
    n = len(rows)
    return pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
        "lang": pa.array([r[2] if len(r) > 2 else None for r in rows], pa.string()), "source": pa.array([None] * n, pa.string()),
        "n_chars": pa.array([None if r[1] is None else len(r[1]) for r in rows], pa.int64()),
        **{c: pa.array([i if i % 2 else None for i in range(n)], pa.int64()) for c in
           ("row", "node", "key", "digest", "component", "hits", "n", "score", "lang_pred", "slot", "shard", "size", "rank", "id", "spans")},
    })


def licenses(text):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    w, found = words(text), []
    for p, label in phrases.items():
        p = p.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    lengths, out = {len(x) for x in windows}, []
    for doc_id, text in docs:
        w, hit, held = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    held |= windows[g]
        held = sorted(str(x) for x in held if x is not None)
        out.append((doc_id, len(w), len(hit), len(held), sha(",".join(held)), bool(hit)))
    return out


def resolved(text):
    """Character references of HTML resolved, as the WARC operator defines them."""
    def one(m):
        x = m[1]
        if x[0] != "#":
            return {"nbsp": " ", "apos": "'"}.get(x) or (chr(name2codepoint[x]) if x in name2codepoint else m[0])
        n = int(x[2:], 16) if x[1] in "xX" else int(x[1:])
        if n == 160:
            return " "
        if n == 0 or n > 0x10FFFF or 0xD800 <= n < 0xE000:
            return "\ufffd"
        return (bytes([n]).decode("cp1252", "ignore") if 128 <= n < 160 else "") or chr(n)

    return re.sub("&(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);", one, text)


def near(w, phrase, span):
    """(start, end) of every stretch of ``w``, ends at most ``span`` apart, that holds all words of ``phrase`` and no smaller such stretch."""
    wanted = set(phrase)
    holds = {(s, e) for s in range(len(w)) for e in range(s, min(s + span, len(w) - 1) + 1) if wanted <= set(w[s : e + 1])}
    return {(s, e + 1) for s, e in holds if (s + 1, e) not in holds and (s, e - 1) not in holds}


def proximity(docs, items, span):
    """Per document: words in a stretch near any window, number and digest of the items with one."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, held = words(text), set(), set()
        there = set(w)
        for g, holders in windows.items():
            if there >= set(g) and (found := near(w, g, span)):
                hit.update(*(range(s, e) for s, e in found))
                held |= holders
        held = sorted(str(x) for x in held if x is not None)
        out.append((doc_id, len(hit), len(held), sha(",".join(held))))
    return out


def shingles(text, size=3):
    w = words(text, SPACED)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def similar(docs, num=90, den=100, size=3):
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(docs)
    for i in range(len(sets)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if small and den * small >= num * large:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    parent[top(i)] = top(j)
                    links[i] += 1
                    links[j] += 1
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        least[top(i)].append(doc_id)
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(doc_id, len(sets[i]), smallest[top(i)], links[i]) for i, (doc_id, _) in enumerate(docs)]


def secrets(text):
    text, found = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
    for k, (kind, pattern, least, group) in enumerate(
        (("assign", assign, 12, 2), ("access", re.compile("AKIA[A-Z0-9]+"), 18, 0), ("hex", re.compile("[0-9a-f]+"), 16, 0))
    ):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}", kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    found.sort()
    kinds = [x[3] for x in found]
    return kinds.count("assign"), kinds.count("access"), kinds.count("hex"), sha(",".join(x[2] for x in found))


def top_k(rows, k=20, every=20):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(vectors):
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), c) for o, (c, b) in enumerate(vectors) if o != at)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


def size_crc(text):
    data = (text or "").encode()
    return len(data) + 8, zlib.crc32(data)


def judge(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:end].translate(ASCII), rest[end:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, None))
    return host, path, best[1], best[2]


def runs(words, least=12):
    """(start, length, period) of all runs, period by period."""
    numbers = {}
    w, n, out = np.array([numbers.setdefault(x, len(numbers)) for x in words], dtype=np.int64), len(words), []
    for q in range(1, n // 2 + 1):
        same = np.concatenate(([0], (w[:-q] == w[q:]).astype(np.int8), [0]))
        begin, end = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            length = b - a + q
            if length >= max(least, 2 * q) and not any(q % p == 0 and s <= a and s + x >= a + length for s, x, p in out):
                out.append((a, length, q))
    return sorted((s, x, p) for s, x, p in out)


def periodic(doc_id, text):
    """The row of op11 for one document."""
    words = SPACED.findall(text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = runs(words)
    best = min(((-x, s, p) for s, x, p in found), default=None)
    longest = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + x for s, x, p in found)]
    return (doc_id, len(found), *longest, sha("".join(f"{s},{x},{p}\n" for s, x, p in found)), sha(" ".join(kept)))


def collocations(docs, least=30, top=2000, longest=4):
    """The rows of op13: every phrase counted, every longer one looked into."""
    n, f = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    f = {k: v for k, v in f.items() if v >= least}
    inside, left, right = Counter(), Counter(), Counter()
    for (lang, w), v in f.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inside[lang, w[i : i + m]] = max(v, inside[lang, w[i : i + m]])
        left[lang, w[1:]] += 1
        right[lang, w[:-1]] += 1
    rows = defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) > 1 and 100 * inside[lang, w] < 80 * a:
            score, _, x, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            rows[lang].append((-score, -a, " ".join(w).encode(), x, r, left[lang, w], right[lang, w]))
    return [(lang, i + 1, g.decode(), -a, x, r, n[lang], -s, nl, nr) for lang, own in rows.items() for i, (s, a, g, x, r, nl, nr) in enumerate(sorted(own)[:top])]


def statistics(text):
    """The statistics of op12 by plain Python."""
    text = text or ""
    w = [x for x in re.split("[ \t\n\x0b\f\r]+", text) if x]
    lines = [x for x in text.split("\n") if x.strip(" ")]
    letters, visible = sum(c.isalpha() for c in text), sum(map(len, w))

    def share(a, b):
        return a / max(b, 1)

    return {
        "chars": len(text), "words": len(w), "word_length": share(visible, len(w)), "longest_word": max(map(len, w), default=0),
        "short_words": share(sum(len(x) <= 3 for x in w), len(w)), "capitals": share(sum(c.isupper() for c in text), letters), "letters": share(letters, visible),
        "digits": share(sum(c.isnumeric() for c in text), visible), "distinct_words": share(len(set(w)), len(w)),
        "repeated_words": share(sum(a == b for a, b in zip(w[:-1], w[1:], strict=True)), len(w)), "ends": share(sum(c in ".!?" for c in text), len(w)),
        "distinct_lines": share(len(set(lines)), len(lines)), "line_words": share(len(w), len(lines)),
    }
