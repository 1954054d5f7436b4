"""Plain versions of the operators, one document after another."""

import hashlib
import re
from collections import Counter
from math import comb

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANKED = re.compile(r"[^\x20\x09-\x0D]+")


def place(row):
    """Order of documents: null ids last."""
    return row[0] is None, row[0] or 0


# Lines


def line_set(line):
    return frozenset(BLANKED.findall(line.lower()))


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def removed_lines(rows):
    """Removed line numbers of each (doc_id, text), by comparing every line with all lines before it."""
    lines = []
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            if tokens := line_set(line):
                lines.append(((doc_id is not None, doc_id or 0, n), tokens, (doc_id, text, n)))
    first = {}
    for spot, tokens, _ in lines:
        first[tokens] = min(first.get(tokens, spot), spot)
    gone = {t for t in first if any(t != u and first[u] < first[t] and similar(t, u) for u in first)}
    out = {(doc_id, text): [] for doc_id, text in rows}
    for spot, tokens, (doc_id, text, n) in lines:
        if (tokens in gone or spot != first[tokens]) and n not in out[doc_id, text]:
            out[doc_id, text].append(n)
    return out


# Fingerprints


def fingerprint(text, width=4):
    words = BLANKED.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def groups(prints, distance=4):
    """Group number of each fingerprint."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    listed = sorted(set(prints))
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in listed}


# Phrases


def contamination(rows, items, size=10):
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[w]
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


# Quality


def counts(text):
    text = text or ""
    words = BLANKED.findall(text)
    lines = [x for x in text.split("\n") if BLANKED.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
    }


def base_failed(c):
    return c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]


def tail(n, k, share):
    return sum(comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k + 1))


def rejects(rule, c, cutoff):
    if cutoff is None or c[rule.bottom] <= 0:
        return False
    return c[rule.top] < cutoff * c[rule.bottom] if rule.low else c[rule.top] > cutoff * c[rule.bottom]


def cutoffs(good, rules, alpha, delta):
    """Per stratum the strictest certified cutoff of each rule; ``good`` maps strata to counts."""
    share = alpha / len(rules)
    tests = len(good) * sum(len(r.cutoffs) for r in rules)
    out = {}
    for stratum, docs in good.items():
        out[stratum] = {}
        for rule in rules:
            passed = [c for c in rule.cutoffs if tail(len(docs), sum(rejects(rule, d, c) for d in docs), share) <= delta / tests]
            out[stratum][rule.name] = passed[0] if passed else None
    return out


def keeps(rows, labels, rules, alpha, delta):
    """Whether each (doc_id, text, stratum) is kept."""
    quality = {}
    for doc_id, value in labels:
        if value is not None:
            quality[doc_id] = min(value, quality.get(doc_id, value))
    once = {}
    for doc_id, text, stratum in rows:
        if doc_id is not None:
            once.setdefault(doc_id, []).append((stratum or "", *counts(text).values(), stratum, text))
    good = {}
    for doc_id, found in once.items():
        if quality.get(doc_id) == 1:
            *_, stratum, text = min(found, key=lambda x: x[:-2])
            good.setdefault(stratum, []).append(counts(text))
    limits = cutoffs(good, rules, alpha, delta)
    out = []
    for _, text, stratum in rows:
        c = counts(text)
        out.append(not base_failed(c) and not any(rejects(r, c, limits.get(stratum, {}).get(r.name)) for r in rules))
    return out
