"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

UPPER = {i: i + 32 for i in range(65, 91)}
WORD, SPACED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text, pattern=WORD):
    return pattern.findall((text or "").translate(UPPER))


def contamination(docs, items, window=13):
    """[(n_words, n_hit, sorted item ids)] of texts, for (id, text) items."""
    owners = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if w else ():
            owners.setdefault(tuple(w[k:k + n]), set()).add(str(i) if i is not None else "null")
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in owners}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in owners:
                    hit.update(range(k, k + n))
                    found |= owners[tuple(w[k:k + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


def shingle_set(text, size=3):
    w = SPACED.findall((text or "").translate(UPPER))
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def components(rows, size=3, percent=90):
    """[(n_shingles, smallest id reachable)] of (id, text) rows."""
    sets, up = [shingle_set(t, size) for _, t in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                up[root(i)] = root(j)
    least = {}
    for i, (n, _) in enumerate(rows):
        if n is not None:
            least[root(i)] = min(n, least.get(root(i), n))
    return [(len(s), least.get(root(i))) for i, s in enumerate(sets)]


def kept_lines(texts, min_words):
    """Texts, in order, without lines in any earlier seen run of ``min_words`` words or more."""
    seqs = [[(n, x) for n, x in enumerate(t.split("\n")) if SPACED.search(x)] for t in texts]
    seen, out = {}, []
    for d, lines in enumerate(seqs):
        for s in range(len(lines)):
            for e in range(s, len(lines)):
                seen.setdefault(tuple(x for _, x in lines[s:e + 1]), (d, s))
    for d, (t, lines) in enumerate(zip(texts, seqs)):
        gone = set()
        for s in range(len(lines)):
            for e in range(s, len(lines)):
                run = tuple(x for _, x in lines[s:e + 1])
                if sum(len(x.split(" ")) for x in run) >= min_words and seen[run] < (d, s):
                    gone.update(range(lines[s][0], lines[e][0] + 1))
        out.append("\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone))
    return out


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def quality(text):
    text = text or ""
    w, lines = SPACED.findall(text), [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times, again = collections.Counter(windows), set()
    for k, x in enumerate(windows):
        if times[x] > 1:
            again |= {k, k + 1, k + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)


def phrases(text, known):
    w = words(text)
    return sorted((label, k) for phrase, label in known for p in [phrase.split()] for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p)


def pieces(word, initial, further):
    n = i = 0
    while i < len(word):
        for j in range(len(word), i, -1):
            if word[i:j] in (further if i else initial):
                break
        else:
            return -1
        n, i = n + 1, j
    return n
