"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall(text or "")


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    if len(w) >= size:
        return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def near_components(docs, size, per_cent):
    """[(doc_id, text)] -> {row number: (set size, smallest id reachable)}."""
    sets = [shingles(t, size) for _, t in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by_id, holders = {}, defaultdict(list)
    for k, (i, _) in enumerate(docs):
        if i is not None:
            up[root(k)] = root(by_id.setdefault(i, k))
        for s in sets[k]:
            holders[s].append(k)
    for k in range(len(docs)):
        met = Counter(j for s in sets[k] for j in holders[s] if j < k)
        for j, common in met.items():
            if 100 * common >= per_cent * (len(sets[k]) + len(sets[j]) - common):
                up[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(len(sets[k]), least.get(root(k)) if sets[k] else docs[k][0]) for k in range(len(docs))]


def covered(texts, length, keep="none"):
    """Byte masks of what is to be removed; ``texts`` in document order."""
    data = [(t or "").encode() for t in texts]
    seen = defaultdict(list)
    for d, b in enumerate(data):
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]].append((d, s))
    masks = [bytearray(len(b)) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for d, s in places if keep == "none" else places[1:]:
                masks[d][s : s + length] = b"\x01" * length
    return data, masks


def repeated_lines(docs, min_words):
    """[(doc_id, text)] with distinct ids -> {doc_id: [(start, length)]}."""
    first = {}
    for i, t in sorted(docs):
        for line in (t or "").split("\n"):
            key = " ".join(line.lower().split())
            if key:
                first.setdefault(key, i)
    out = {}
    for i, t in docs:
        seen, at, runs, run = set(), 0, [], []
        for line in (t or "").split("\n"):
            key = " ".join(line.lower().split())
            if key:
                if first[key] != i or key in seen:
                    run.append((at, len(line), len(key.split())))
                else:
                    runs.append(run)
                    run = []
                seen.add(key)
            at += len(line) + 1
        runs.append(run)
        spans = [(s, n) for r in runs if sum(w for _, _, w in r) >= min_words for s, n, _ in r]
        if spans:
            out[i] = spans
    return out


def cut(text, spans):
    for start, length in sorted(spans, reverse=True):
        end = start + length
        whole = start == 0 or text[start - 1] == "\n"
        text = text[:start] + text[end + (whole and text[end : end + 1] == "\n") :]
    return text


def leaks(docs, items, size=5, threshold=0.8):
    """{(doc_id, item_id): best weighted Jaccard} over all item-sized windows."""
    def grams(w):
        n = min(size, len(w))
        return [tuple(w[k : k + n]) for k in range(len(w) - n + 1)] if w else []

    bags = [(i, (t or "").encode().lower().split()) for i, t in items]
    bags = [(i, w, Counter(grams(w))) for i, w in bags if w]
    held = Counter(s for _, _, b in bags for s in b)
    weight = {s: 1 + math.log(len(bags) / n) for s, n in held.items()}
    top = 1 + math.log(max(1, len(bags)))
    out = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        for i, own, bag in bags:
            n = min(size, len(own))
            all_grams = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
            if not any(g in bag for g in all_grams):
                continue
            wide = min(len(own) - n + 1, len(all_grams))
            for a in range(len(all_grams) - wide + 1):
                win = Counter(all_grams[a : a + wide])
                common = sum(min(c, bag[g]) * weight[g] for g, c in win.items() if g in bag)
                total = sum(c * weight.get(g, top) for g, c in win.items()) + sum(c * weight[g] for g, c in bag.items())
                s = common / (total - common)
                if s >= threshold - 1e-9 and s > out.get((d, i), 0):
                    out[d, i] = s
    return out


def quality_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = defaultdict(list)
    for k in range(len(w) - 7):
        windows[tuple(w[k : k + 8])].append(k)
    repeated = {p + j for places in windows.values() if len(places) > 1 for p in places for j in range(8)}
    counts = {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated)}
    counts["base_failed"] = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    return counts


def check_pieces(docs, pieces, tokenizer, end_id=1, top=2048, segments=256):
    """Assert that the pieces tile every document's ids and every sequence."""
    import numpy as np

    expected = Counter()
    ids_of = {}
    for i, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id]
        ids_of.setdefault(i, []).append(ids)
        expected[i] += len(ids)
    sequences = defaultdict(list)
    for p in pieces:
        options = [np.array(ids[p.start : p.start + p.length], "<u4") for ids in ids_of[p.doc_id] if len(ids) == p.doc_tokens]
        assert any(zlib.crc32(o.tobytes()) == p.ids_crc32 for o in options)
        expected[p.doc_id] -= p.length
        sequences[p.sequence_id].append(p)
    assert not any(expected.values())
    for i, all_ids in ids_of.items():
        if len(all_ids) == 1:
            at = 0
            for p in sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start):
                assert p.start == at and p.length > 0
                at += p.length
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= top and len(parts) <= segments
        assert at == top or at & (at - 1) == 0  # nothing to pad


def passage_units(text):
    """Words, their places and units [(start, stop)]: clauses of 4 words or more, else whole lines of as many."""
    words, places, units, lines, line_start = [], [], [], [], 0
    for line in (text or "").split("\n"):
        first = len(words)
        for m in re.finditer(r"\S+", line):
            words.append(m[0])
            places.append((line_start + m.start(), line_start + m.end()))
        line_start += len(line) + 1
        lines.append((first, len(words)))

    def clauses(first, last):
        out, at = [], first
        for k in range(first, last):
            if words[k][-1] in ".!?,;:" or k == last - 1:
                long, s = k + 1 - at > 24, at
                for j in range(at, k + 1):
                    if j == k or (long and len(words[j]) % 8 == 0):
                        if j + 1 - s >= 4:
                            out.append((s, j + 1))
                        s = j + 1
                at = k + 1
        return out

    for first, last in lines:
        units += clauses(first, last) or [(first, last)] * (last - first >= 4)
    units += [(s, e) for s, e in clauses(0, len(words)) if any(s < stop < e for _, stop in lines)]
    return [w.lower() for w in words], places, units


def passages(docs, min_words):
    """[(doc_id, text)] with distinct ids -> {doc_id: [(start, length, words, source)]}, by stretches on diagonals."""
    known = {i: passage_units(t) for i, t in docs}
    order = sorted(known, key=lambda i: (i is None, i or 0))
    first = {}
    for i in order:
        words, _, units = known[i]
        for s, e in sorted(units):
            first.setdefault(tuple(words[s:e]), (i, s))
    out = {}
    for i in order:
        words, places, units = known[i]
        runs = set()
        for s, e in units:
            source, at = first[tuple(words[s:e])]
            if (source, at) != (i, s):
                other, off = known[source][0], at - s
                while s > 0 and s + off > 0 and words[s - 1] == other[s - 1 + off]:
                    s -= 1
                while e < len(words) and e + off < len(other) and words[e] == other[e + off]:
                    e += 1
                if e - s >= min_words:
                    runs.add((s, -e, source))
        at = 0
        for s, e, source in sorted(runs):
            s, e = max(s, at), -e
            if s < e:
                out.setdefault(i, []).append((places[s][0], places[e - 1][1] - places[s][0], e - s, source))
                at = e
    return {i: sorted(s) for i, s in out.items()}
