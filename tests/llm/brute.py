"""Plain-Python versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


def contamination(docs, items, t=10):
    windows = {}
    for i, text in items:
        w = ALNUM.findall(fold(text))
        n = min(t, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p:p + n]), set()).add("null" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for d, text in docs:
        w = ALNUM.findall(fold(text))
        hit, found = set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                ids = windows.get(tuple(w[p:p + n]))
                if ids:
                    found |= ids
                    hit.update(range(p, p + n))
        out.append((d, len(w), len(hit), sorted(found), bool(hit)))
    return out


def repeats(texts, length, keep_first=False):
    """(n_bytes, n_removed, n_spans, kept) of every text; with ``keep_first`` a string's first place in the list stays."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for i, b in enumerate(raw):
        for p in range(len(b) - length + 1):
            seen.setdefault(b[p:p + length], []).append((i, p))
    marks = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places[keep_first:]:
                marks[i][p:p + length] = b"\1" * length
    return [(len(b), sum(m), sum(1 for j in range(len(m)) if m[j] and (j == 0 or not m[j - 1])),
             bytes(x for x, y in zip(b, m, strict=True) if not y)) for b, m in zip(raw, marks, strict=True)]


def near_duplicates(docs, k, threshold):
    """(id, n_shingles, component_id) of every (id, text)."""
    sets = []
    for _, text in docs:
        w = SPACED.findall(fold(text))
        sets.append({tuple(w[p:p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    label = list(range(len(docs)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for x in range(len(docs)):
        for y in range(x):
            c = len(sets[x] & sets[y])
            if c and 100 * c >= threshold * (len(sets[x]) + len(sets[y]) - c):
                label[find(x)] = find(y)
    best = {}
    for x, (d, _) in enumerate(docs):
        r = find(x)
        if d is not None and (best.get(r) is None or d < best[r]):
            best[r] = d
    return [(d, len(s), best.get(find(x))) for x, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def sentence_split(text):
    """(words, begin, end) of every sentence."""
    cuts = [m.end() for m in re.finditer(r"[.!?](?=[\x20\x09-\x0d])|\n|[。！？]", text)]
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True):
        w = ALNUM.findall(fold(text[a:b]))
        if w:
            out.append([w, a, b])
    if out:
        out[0][1] = 0
        for x, y in zip(out, out[1:], strict=False):
            x[2] = y[1]
        out[-1][2] = len(text)
    return out


def sentence_dedup(docs, run, min_words, alone=50):
    """(id, n_sentences, removed, text) of every (id, text); ids distinct and not null."""
    split = {d: sentence_split(t or "") for d, t in docs}
    places = {}
    for d, _ in sorted(docs):
        s = split[d]
        for i in range(len(s)):
            n = run
            while i + n <= len(s) and sum(len(x[0]) for x in s[i:i + n]) < min_words:
                n += 1
            lengths = {n} if i + n <= len(s) else set()
            if len(s[i][0]) >= max(alone, min_words):
                lengths.add(1)
            if i == 0 and len(s) < run and sum(len(x[0]) for x in s) >= min_words:
                lengths.add(len(s))
            for n in lengths:
                places.setdefault(tuple(w for x in s[i:i + n] for w in x[0]), []).append((d, i, n))
    gone = {d: set() for d, _ in docs}
    for found in places.values():
        for d, i, n in found[1:]:
            gone[d].update(range(i, i + n))
    return [(d, len(split[d]), sorted(gone[d]), None if t is None else
             ("".join(t[a:b] for i, (_, a, b) in enumerate(split[d]) if i not in gone[d]) if split[d] else t)) for d, t in docs]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def chat_turns(rows):
    """Turns of every conversation in order, (role, text), from (conv, turn, role, text)."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def turn_faults(rows):
    """blank / duplicate / truncated / None of every (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        said = re.findall("[^\x20\x09-\x0d]", text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else None if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def repair_turns(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines) of one conversation, by searching all edit sequences."""
    faults = turn_faults(rows)
    known = sorted({t for t, _, _ in rows if t is not None})
    gaps = known[-1] - known[0] + 1 - len(known) if known else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    legal = re.compile("(s?(ua)+)?")
    most = 3 * len(rows) + 1

    def search(budget):
        """All (cost, audit, lines) within a budget, least audit first among the cheapest."""
        found = []

        def step(i, cost, audit, roles, lines):
            if cost > budget or not any(legal.fullmatch(roles + more) for more in ("", "a", "ua")):
                return
            if i == len(rows) and legal.fullmatch(roles):
                found.append((cost, audit, lines))
            for new, name in (("u", "user"), ("a", "assistant")):
                step(i, cost + 2, audit + "I", roles + new, [*lines, name + ":"])
            if i < len(rows):
                _, role, text = rows[i]
                step(i + 1, cost + 3, audit + "D", roles, lines)
                if faults[i] not in ("blank", "duplicate"):
                    extra = faults[i] == "truncated"
                    step(i + 1, cost + extra, audit + "K", roles + (role[:1] or "?"), [*lines, role + ":" + text])
                    for new, name in (("u", "user"), ("a", "assistant")):
                        step(i + 1, cost + 2 + extra, audit + "R", roles + new, [*lines, name + ":" + text])
        step(0, 0, "", "", [])
        return min(found, default=None)
    best = next(b for b in map(search, range(most + 1)) if b)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, best[0], best[1], best[2])


def hard_negatives(rows, every=100, n_pos=5, n_neg=10, low=30, high=90):
    """(anchor, positive, rank, negative, positive score, negative score) from (id, label, whole numbers)."""
    out = []
    for a, label, v in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, k) for i, k, w in rows if len(w) == len(v))
        for p, i, _ in [s for s in scored if s[2] == label and s[1] != a][:n_pos]:
            inside = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:n_neg]
            out += [(a, i, r, j, -p, -s) for r, (s, j, _) in enumerate(inside, 1)]
    return out


M64 = (1 << 64) - 1


def mixed(x):
    """A 64-bit finaliser, in whole numbers."""
    for _ in range(2):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & M64
    return x ^ x >> 32


BYTES = [mixed((b + 1) * 0x9E3779B97F4A7C15 & M64) for b in range(256)]


def bytes_hash(data):
    base, power, total = 0xB5297A4D3F84D5B5 | 1, 1, 0
    for b in data:
        total += BYTES[b] * power
        power = power * base & M64
    return mixed(total & M64)


def toxicity_features(text, bits, prefixes):
    """The features of a text: hashed words, and their hashed beginnings, as a set."""
    out = set()
    for w in re.findall(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", fold(text).encode()):
        out.add(bytes_hash(w) >> (64 - bits))
        for k in prefixes:
            out.add(mixed((bytes_hash(w[:k]) + (k + 1) * 0x9E3779B97F4A7C15) & M64) >> (64 - bits))
    return out


def language_grams(text, orders=(1, 2, 3), bits=16):
    """Counts of the hashed n-grams of letters, with one space behind every run of them that is followed by something else."""
    letters = []
    for c in text or "":
        if c.isalpha():
            letters.append(c.lower() if len(c.lower()) == 1 else c)
        elif letters and letters[-1] != " ":
            letters.append(" ")
    out = {}
    for k in orders:
        for i in range(len(letters) - k + 1):
            h = k
            for c in letters[i:i + k]:
                h = (h + ord(c)) * 0x9E3779B97F4A7C15 & M64
                h ^= h >> 31
            b = mixed(h) >> (64 - bits)
            out[b] = out.get(b, 0) + 1
    return out, sum(c != " " for c in letters)


def languages(train, texts, smoothing=0.5, buckets=1 << 16):
    """(language, probability) of every text by multinomial naive Bayes, from (text, language) rows."""
    import math
    counts, rows = {}, {}
    for text, lang in train:
        if lang is not None:
            rows[lang] = rows.get(lang, 0) + 1
            mine = counts.setdefault(lang, {})
            for b, n in language_grams(text)[0].items():
                mine[b] = mine.get(b, 0) + n
    out = []
    for text in texts:
        found, letters = language_grams(text)
        if not letters or not rows:
            out.append(("und", 0.0))
            continue
        logs = {}
        for lang in sorted(rows):
            total = sum(counts[lang].values()) + smoothing * buckets
            logs[lang] = math.log(rows[lang] / sum(rows.values())) + sum(
                n * math.log((counts[lang].get(b, 0) + smoothing) / total) for b, n in found.items())
        best = max(sorted(logs), key=lambda x: logs[x])
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out
