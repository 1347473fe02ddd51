"""What the operators must give, in plain Python on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def kept_spans(rows, span=50):
    """{place in rows: (n_words, n_removed, digest, kept words)} for (doc_id, text) rows."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for p in range(len(w) - span + 1 if doc is not None else 0):
            key = tuple(w[p:p + span])
            first[key] = min(doc, first.get(key, doc))
    out = {}
    for i, (doc, text) in enumerate(rows):
        w = words(text)
        gone = [False] * len(w)
        for p in range(len(w) - span + 1 if doc is not None else 0):
            if first[tuple(w[p:p + span])] < doc:
                gone[p:p + span] = [True] * span
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept)
    return out


def shingles(text, width=3):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)])


def near_components(rows, percent=85, width=3):
    """[(n_shingles, component_id)] for (doc_id, text) rows."""
    sets = [shingles(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    low = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        if doc is not None:
            low[r] = min(doc, low.get(r, doc))
    return [(len(s), low.get(root(i))) for i, s in enumerate(sets)]


def statistics(text):
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def fold(text):
    """Terms: letters and characters beyond ASCII, A-Z in lower case."""
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def divergence(rows, least=10, top=10):
    """Sorted (lang, source, part, item, value, rank) for (lang, source, text) rows."""
    docs, counts, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", fold(text)
        groups.add((lang, source))
        docs.update((lang, t) for t in set(terms))
        for t in terms:
            counts[lang, source, t] += 1
            counts[lang, None, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        v = len(kept)
        sources = sorted(s for x, s in groups if x == lang)

        def p(source):
            total = sum(counts[lang, source, t] for t in kept)
            return {t: 1 + 10**9 * (counts[lang, source, t] + 2) // (total + 2 * v) for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        own, whole = {s: p(s) for s in sources}, p(None)
        for s in sources:
            lists = {"pair": [(-sum(f(own[s][t], own[o][t]) for t in kept), o.encode()) for o in sources if o != s],
                     "term": [(-f(own[s][t], whole[t]), t.encode()) for t in kept
                              if counts[lang, s, t] and own[s][t] > whole[t]]}
            for part, found in lists.items():
                for rank, (value, item) in enumerate(sorted(found), 1):
                    if part == "pair" or rank <= top:
                        out.append((lang, s, part, item.decode(), -value, rank))
    return sorted(out)


def paragraphs(text):
    return re.findall(r"[^\n]*\n+|[^\n]+", text or "")


def root(text):
    """Merkle root over paragraphs and sections."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    leaves = [sha(x) for x in paragraphs(text)]
    sections, now = [], []
    for i, leaf in enumerate(leaves):
        now.append(leaf)
        if leaf[0] in "0123" or i == len(leaves) - 1:
            sections.append(sha("".join(now)))
            now = []
    return sha("".join(sections))


def likeness(a, b):
    if root(a) == root(b):
        return 1.0
    a, b = ({tuple(x) for x in phrases(t)} for t in (a, b))
    return 2.0 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def phrases(text):
    """Up to six words of one line with the space between them, fewer where a sentence ends."""
    out = []
    for line in (text or "").split("\n"):
        now = []
        for word, space in re.findall(r"([^\x20\x09-\x0D]+)([\x20\x09\x0B-\x0D]*)", line):
            now += [word, space]
            if len(now) == 12 or word[-1] in ".!?":
                out.append(now[:-1])
                now = []
        if now:
            out.append(now[:-1])
    return out


def hard_negatives(rows, every=100, positives=5, negatives=10):
    """Sorted result rows for (vec_id, vector, label) rows."""
    import math

    usable = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if i is not None
              and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor, a, label in usable:
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, other) for i, v, other in usable
                        if i != anchor and len(v) == len(a))
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(n, i) for n, i, other in scored if other != label and 30 * -score <= 100 * -n <= 90 * -score]
            out += [(anchor, positive, r, i, -score, -n) for r, (n, i) in enumerate(fit[:negatives], 1)]
    return sorted(out)
