"""Plain versions of the operators over a few rows, by other means than the operators use."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def near(docs):
    """{doc_id: (n_shingles, component)} of (doc_id, text) rows: every pair that shares a shingle is compared."""
    sets, by = {}, defaultdict(list)
    for i, text in docs:
        w = words((text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in by[s]:
                shared[j] += 1
            by[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def substrings(docs, width=13):
    """{doc_id: (n_words, n_removed, sha)}."""
    least = {}
    for i, text in docs:
        w = words(text)
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            least[key] = min(least.get(key, i), i)
    out = {}
    for i, text in docs:
        w = words(text)
        gone = set()
        for k in range(len(w) - width + 1):
            if least[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def packed(docs, pieces, tokenizer, length=2048):
    """Checks the pieces of a packing against the documents' ids; returns the share of padding."""
    from collections import Counter

    import numpy as np

    want, got = Counter(), defaultdict(list)
    for p in pieces:
        got[p["doc_id"]].append(p)
    total = 0
    for i, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(got[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids), p
            assert zlib.crc32(ids[at : at + p["length"]].tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(ids), i
        total += at
        want[i] += 1
    assert set(got) == set(want)
    rows = defaultdict(list)
    for p in pieces:
        rows[p["sequence_id"]].append((p["offset"], p["length"]))
    size = 0
    for parts in rows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert 0 < at <= length
        size += at if at & (at - 1) == 0 else length
    return 1 - total / size if size else 0.0


def repeated_words(text, width=8):
    w = words(text)
    seen = defaultdict(list)
    for k in range(len(w) - width + 1):
        seen[tuple(w[k : k + width])].append(k)
    gone = set()
    for at in seen.values():
        if len(at) > 1:
            for k in at:
                gone.update(range(k, k + width))
    return len(gone)


def notices(text, templates, coverage=0.8, gap=6):
    """Names of the templates that a run of the text's words covers, by the longest common subsequence from every start."""
    plain = lambda t: [x for x in (w.strip(".,;:!?()[]{}<>\"'`*#|/\\-_=+~") for w in (t or "").lower().split()) if x]
    w, out = plain(text), set()
    for name, template in templates:
        t = plain(template)
        for i in [i for i, x in enumerate(w) if x in t[: len(t) // 5 + 1]]:
            row, last = [0] * (len(t) + 1), i
            for j in range(i, len(w)):
                if w[j] in t:
                    if j - last > max(gap, len(t)) + 1:
                        break
                    last, new = j, [0]
                    for k, y in enumerate(t):
                        new.append(row[k] + 1 if w[j] == y else max(row[k + 1], new[k]))
                    row = new
                if j - i > 2 * len(t):
                    break
            if row[-1] >= coverage * len(t):
                out.add(name)
    return out


def quality(rows):
    """{doc_id: (distance, kept)} of rows with the base statistics, base_failed, lang, source and r."""
    floors, wide = np.diag(np.square([0.5, 0.15, 0.7, 0.3, 0.3])), np.diag(np.square([1.5, 0.3, 1.5, 1.0, 1.0]))
    cut = 15.08627246938899  # chi-square with five degrees of freedom at 0.99; at 0.75 it is 6.625679763829255
    consistency = 0.75 / 0.531134743246967  # chi-square with seven degrees of freedom up to that, by numerical integration
    log = lambda a, b: np.log(max(a, 1) / max(b, 1))
    x = {
        r["doc_id"]: np.array([
            log(r["n_words"], 1), log(r["word_chars"], r["n_words"]), np.log1p(1000 * r["n_symbols"] / max(r["word_chars"], 1)),
            np.log1p(100 * r["n_dup_lines"] / max(r["n_words"], 1)), np.log1p(100 * r["n_repeat_words"] / max(r["n_words"], 1)),
        ]) for r in rows
    }
    moments = lambda v: (v.mean(0), np.atleast_2d(np.cov(v.T, bias=True)))

    def squares(v, estimate):
        off = v - estimate[0]
        return np.einsum("ij,ij->i", off, np.linalg.solve(estimate[1] + floors, off.T).T)

    def step(v, estimate):
        cell = np.floor(64 * np.log2(squares(v, estimate) + 1e-4))
        order = np.sort(cell)
        return moments(v[cell <= order[int(np.ceil(0.75 * len(v))) - 1]])

    def innermost(group):
        v, r = np.array([x[g["doc_id"]] for g in group]), np.array([g["r"] for g in group])
        tries = [v] + [v[(r >= s / 4) & (r < s / 4 + min(0.25, 60 / len(v)))] for s in range(4)]
        estimates = [moments(t) for t in tries if len(t)]
        for _ in range(2):
            estimates = [step(v, e) for e in estimates]
        best = min(estimates, key=lambda e: np.linalg.slogdet(e[1] + floors)[1])
        for _ in range(3):
            best = step(v, best)
        return best, len(v)

    def mixed(own, n, wider):
        a, off = n / (n + 50), own[0] - wider[0]
        return a * own[0] + (1 - a) * wider[0], a * own[1] + (1 - a) * wider[1] + a * (1 - a) * np.outer(off, off)

    good = [r for r in rows if not r["base_failed"]]
    by = defaultdict(list)
    for r in good:
        for key in ((), (r["lang"],), (r["lang"], r["source"])):
            by[key].append(r)
    found = {key: innermost(group) for key, group in by.items()}
    every = mixed(*found[()], (found[()][0][0], wide))
    language = {key: mixed(*found[key], every) for key in found if len(key) == 1}
    out = {}
    for r in rows:
        key = (r["lang"], r["source"])
        if key not in found:
            out[r["doc_id"]] = None, not r["base_failed"]
            continue
        distance = squares(x[r["doc_id"]][None], mixed(*found[key], language[key[:1]]))[0] / consistency
        out[r["doc_id"]] = distance, not r["base_failed"] and distance <= cut
    return out
