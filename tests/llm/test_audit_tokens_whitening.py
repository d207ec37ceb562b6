"""Token counts against the library, filter audits against a simulation, whitening against exact arithmetic."""

import json
import random
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest

from cohortframe.llm import QUERIES, filter_audit, packing, token_counts, whitening
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


# --- token counts -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    with open(packing.public_tokenizer()) as f:
        told = json.load(f)
    splitter = json.dumps({"version": "1.0", "pre_tokenizer": told["pre_tokenizer"], "model": {"type": "BPE", "vocab": {}, "merges": []}})
    return token_counts.Counter(token_counts.Merges(told), token_counts.odd_characters(splitter), splitter)


def test_token_counts_of_all_documents(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_token_counts"](spark, FOLDER).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows}
    want = {i: (len((t or "").encode()), library(t), library(t) > 512) for i, t in texts.items()}
    assert got == want and len(rows) == len(texts)


def test_token_counts_of_odd_texts(counter, library):
    draw = random.Random(5)
    letters = "ab \n\t'sStreE1!é日語\u0085\x1c\x0b 😀~|<>" + "".join(sorted(counter.odd))[:4]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(80))) for _ in range(3000)]
    texts += ["", " ", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "<|endoftext", "aaaaaaa" * 5, "\n\n\n x", "don't WE'LL 's"]
    assert counter.count(texts) == [library(t) for t in texts]


def test_long_pre_tokens(counter, library):
    draw = random.Random(6)
    texts = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9000)), "a" * 20_001, "ab" * 9_000, "é" * 5_001, "=-" * 4_000]
    assert all(len(t.encode()) > token_counts.LONG for t in texts)
    assert counter.count(texts) == [library(t) for t in texts]
    for text in texts[:2]:
        symbols = counter.merges.of_byte[np.frombuffer(text[:1500].encode(), np.uint8)]
        assert counter.merges.count_long(symbols) == counter.merges.count([text[:1500].encode()])[0]


def test_texts_longer_than_a_stretch(counter, library, monkeypatch):
    monkeypatch.setattr(token_counts, "STRETCH", 100)
    text = "One two  three, <|endoftext|>four\n five six " * 40 + "x" * 300 + " y" * 200
    assert counter.count([text, "short one", text]) == [library(text), library("short one"), library(text)]


def test_token_counts_edges(spark, documents, odd_rows, clash, library):
    docs = documents(odd_rows)
    path = packing.public_tokenizer()
    want = Counter((r[0], len((r[1] or "").encode()), library(r[1]), library(r[1]) > 512) for r in odd_rows)
    assert Counter(map(tuple, token_counts.count_tokens(docs, path).collect())) == want
    assert Counter(map(tuple, token_counts.count_tokens(clash(docs), path).collect())) == want
    assert token_counts.count_tokens(documents([]), path).collect() == []


def test_unsupported_vocabulary_is_refused():
    with open(packing.public_tokenizer().replace("byte_bpe_50k", "word_bpe_49k")) as f:
        told = json.load(f)
    with pytest.raises(ValueError):
        token_counts.Merges(told)


# --- filter audit -------------------------------------------------------------------------------------------------


def failing(docs, labels):
    """(part, failed filters, good, toxic) of each (doc_id, text, part), by plain means."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, part in docs:
        text = text or ""
        w = brute.words(text)
        failed = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and least[text] < i,
        }
        mine = [x for x in labels if i is not None and x[0] == i]
        out.append((part or "", {k for k, v in failed.items() if v}, any(q == 1 for _, q, _ in mine), any(t == 1 for _, _, t in mine)))
    return out


def simulated(docs, labels):
    """Each order applied filter by filter to what is left."""
    rows, out = failing(docs, labels), {}
    for part in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in here) - len(gone), sum(r[1] == {f} for r in here),
                    sum(r[2] for r in gone), sum(r[3] for r in gone), f,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[6] = total[row[6]]
    return out


LABELS = "doc_id bigint, quality int, toxic int"


def test_audit_equals_simulation(documents, odd_rows, clash, frame):
    plain = "alpha beta gamma delta " * 15 + " ".join(f"w{i}" for i in range(120))
    more = [(20 + i, plain, "en", "a") for i in range(3)] + [(30, plain + " $", "en", ""), (31, "UP " * 60, "en", None), (31, "UP " * 60, "en", None)]
    docs = documents(odd_rows + more)
    given = [(1, 1, 0), (1, 0, 1), (3, 1, None), (None, 1, 1), (21, 1, 1), (22, None, None), (31, 0, 1)]
    labels = frame(LABELS, given)
    rows = [(r[0], r[1], r[3]) for r in odd_rows + more]
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = simulated(rows, given)
    for some in (docs, clash(docs)):
        got = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in filter_audit.audit(some, labels).collect()}
        assert got == want
    assert filter_audit.audit(documents([]), labels).collect() == []
    assert len(filter_audit.audit(docs, frame(LABELS, [])).collect()) == len(want)


def test_potential_is_the_shapley_value():
    counts = np.random.default_rng(3).integers(0, 90, (4, 32))
    game = filter_audit.Game(counts)
    total = np.zeros((4, 5), int)
    for order in permutations(range(5)):
        s = 0
        for i in order:
            total[:, i] += game.removed[:, s | 1 << i] - game.removed[:, s]
            s |= 1 << i
    assert (game.shapley() == total).all() and (game.shapley().sum(1) == 120 * game.removed[:, 31]).all()


# --- whitening ----------------------------------------------------------------------------------------------------


def residual(a, values, x):
    """Largest error of ``a x = value x`` and of orthonormality, in exact arithmetic."""
    f = np.vectorize(Fraction, otypes=[object])
    a, x = f(a), f(x)
    off = a @ x - x * f(values)
    return max(abs(float(v)) for v in off.ravel()), max(abs(float(v)) for v in (x.T @ x - f(np.eye(len(a)))).ravel())


@pytest.mark.parametrize(
    "spectrum",
    [
        np.linspace(9, 1, 12), [5, 5 - 1e-6, 5 - 2e-6, 3, 1, 1 - 1e-9], [4, 4, 4, 2, 2, 1], [7, 7 * (1 - 1e-12), 7 * (1 - 2e-12), 1, 1e-6, 1e-9],
        [1.0], [3, 3, 3], [2, 0, 0, 0],
    ],
)
def test_refined_eigenvectors(spectrum):
    spectrum = np.array(spectrum, float)
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(len(spectrum),) * 2))
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    values, x = whitening.eigen(a)
    off, skew = residual(a, values, x)
    assert off <= 1e-15 * spectrum.max() and skew <= 1e-15
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-13 * spectrum.max()) and (np.diff(values) <= 0).all()


def test_refinement_beats_its_start():
    a = np.cov(np.random.default_rng(2).normal(size=(40, 300)))
    _, start = np.linalg.eigh(a.astype(np.float32))
    rough = np.abs(a @ start - start * np.diagonal(start.T @ a @ start)).max()
    values, x = whitening.eigen(a)
    assert rough > 1e-8 and residual(a, values, x)[0] < 1e-15


def plain_whitening(vectors):
    """Deviations, whitened rows and shares of variance from exact sums and a covariance centred before multiplying."""
    x = [[int(np.floor(1024 * np.float64(c))) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(v[d] for v in x) for d in range(dims)]
    off = np.array([[n * v[d] - s[d] for d in range(dims)] for v in x], object)
    cov = ((off.T @ off) / Fraction(n**3)).astype(np.float64)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (off / n).astype(np.float64) @ vectors[:, :8] / np.sqrt(values[:8])
    return [int(sum(d * d for d in row)) for row in off], white, values / values.sum()


def test_whitening_of_the_table(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    deviations, white, shares = plain_whitening([v for _, v in data])
    rows = QUERIES["op13_whitening"](spark, FOLDER).collect()
    assert len(rows) == 8 * len(data) and {r["n"] for r in rows} == {len(data)}
    got = {(r["vec_id"], r["component"]): r for r in rows}
    mine = np.array([[got[i, k + 1]["whitened"] for k in range(8)] for i, _ in data])
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine - white * sign).max() < 1e-9
    assert [got[i, 1]["deviation"] for i, _ in data] == deviations
    assert np.allclose([got[data[0][0], k + 1]["explained"] for k in range(8)], shares[:8], rtol=1e-9)
    error = {r["identity_error"] for r in rows}
    assert len(error) == 1 and error.pop() < 1e-10


VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_whitening_edges(spark, frame):
    draw = np.random.default_rng(4)
    good = [(i if i % 5 else None, draw.normal(size=3).astype(np.float32).tolist(), 0) for i in range(40)]
    good += [good[1], good[1]]
    bad = [(50, None, 0), (51, [1.0, None, 2.0], 0), (52, [1.0, float("nan"), 2.0], 0), (53, [float("inf"), 0.0, 0.0], 0), (54, [], 0), (55, [1.0], 0), (56, [1e30, 0.0, 0.0], 0)]
    df = frame(VECTORS, good + bad)
    clashing = df.withColumnRenamed("label", "n").selectExpr("*", "'x' AS id", "'x' AS v", "'x' AS component")
    rows = whitening.whiten(df).collect()
    assert Counter(r["vec_id"] for r in rows) == Counter({k: 3 * n for k, n in Counter(g[0] for g in good).items()})
    assert {r["n"] for r in rows} == {len(good)} and rows[0]["identity_error"] < 1e-12
    assert sum(r["explained"] for r in rows if r["vec_id"] == 2) == pytest.approx(1)
    assert sorted(map(str, whitening.whiten(clashing).collect())) == sorted(map(str, rows))
    assert whitening.whiten(frame(VECTORS, [])).collect() == [] == whitening.whiten(frame(VECTORS, bad[:5])).collect()


def test_whitening_without_variance(frame):
    same = whitening.whiten(frame(VECTORS, [(i, [0.5, 0.25], 0) for i in range(4)])).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in same} == {(None, None, None, 0)} and len(same) == 8
    line = whitening.whiten(frame(VECTORS, [(i, [float(i), 2.0 * i], 0) for i in range(6)])).collect()
    assert {r["component"]: r["whitened"] is None for r in line} == {1: False, 2: True} and line[0]["identity_error"] < 1e-12


def test_large_entries_stay_exact(frame):
    draw = random.Random(8)
    vectors = [[draw.uniform(-9e8, 9e8) for _ in range(3)] for _ in range(30)]
    rows = whitening.whiten(frame("vec_id bigint, embedding array<double>", [(i, v) for i, v in enumerate(vectors)])).collect()
    deviations, white, _ = plain_whitening(vectors)
    got = {r["vec_id"]: r["deviation"] for r in rows}
    assert [got[i] for i in range(30)] == [d if d < 1 << 63 else None for d in deviations] and None in got.values()
    mine = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in rows}
    assert all(abs(mine[i, k + 1] - abs(white[i, k])) < 1e-9 for i in range(30) for k in range(3))
