"""The methods inside the operators."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from cohortframe.llm import chat_format, components, exact_dedup, language_id, license_scan, line_dedup, near_dedup, packing, quality, substring_dedup
from tests.llm import brute


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 256, (5000, 32), dtype=np.uint8)
    table = exact_dedup.PerfectHash(keys)
    assert sorted(table.slots(keys)) == list(range(5000))
    strangers = np.random.default_rng(2).integers(0, 256, (500, 32), dtype=np.uint8)
    assert ((table.slots(strangers) >= -1) & (table.slots(strangers) < 5000)).all()


def test_perfect_hash_with_equal_bits():
    keys = np.zeros((4, 32), np.uint8)
    keys[:, 0] = range(4)  # the bytes that the 64 bits do not see
    assert sorted(exact_dedup.PerfectHash(keys).slots(keys)) == [0, 1, 2, 3]


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    for n in (6, 40, 300, 5000):
        errors = []
        for _ in range(40):
            union = rng.integers(0, 2**64, n, dtype=np.uint64)
            cut = n // 8
            a, b = np.unique(union[cut:]), np.unique(union[: n - cut])
            true = (n - 2 * cut) / n
            sa, sb = (near_dedup.registers(x).view(np.uint16)[None] for x in (a, b))
            errors.append(near_dedup.estimate(sa, sb, np.array([len(a)]), np.array([len(b)]))[0] - true)
        assert abs(np.mean(errors)) < 0.03, n


def test_components(frame):
    random.seed(4)
    chain = [(i, i + 1) for i in range(50)]
    star = [(100, 100 + i) for i in range(1, 300)]
    random.shuffle(chain)
    got = {(r["id"], r["component"]) for r in components.components(frame("a bigint, b bigint", chain + star + [(7, 3), (500, 500)])).collect()}
    assert got == {(i, 0) for i in range(51)} | {(100 + i, 100) for i in range(300)}


def test_near_copies_in_a_chain(frame):
    """Neighbours are similar, ends are not; all are one component, though no leader is similar to all."""
    base = [f"w{i}" for i in range(140)]
    docs = [(i, " ".join([f"x{k}" for k in range(i)] + base[i:])) for i in range(0, 60, 2)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(frame("doc_id bigint, text string", docs)).collect()}
    assert got == {i: c for i, (_, c) in brute.near(docs).items()}


@pytest.mark.parametrize("pairs", [0, 4])
def test_near_copies_round_a_hub(frame, monkeypatch, pairs):
    """Copies are similar to one text but seldom to each other, so one leader is not enough."""
    monkeypatch.setattr(near_dedup, "PAIRS_PER_MEMBER", pairs)
    random.seed(5)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(40):
        words = base[:]
        for k in random.sample(range(0, 200, 7), 3 if i else 0):
            words[k] = f"d{i}"
        docs.append((i + 1000 if i == 0 else i, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(frame("doc_id bigint, text string", docs)).collect()}
    assert got == {i: c for i, (_, c) in brute.near(docs).items()}


@pytest.mark.parametrize("buckets, chunk", [(1, 200), (7, 300), (3, 10**7)])
def test_windows_over_chunks(frame, buckets, chunk):
    random.seed(6)
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for i in range(60):
        w = [random.choice("abcdefg") + str(random.randrange(30)) for _ in range(random.randrange(0, 60))]
        at = random.randrange(len(w) + 1)
        cut = random.randrange(0, 20)
        docs.append((i, random.choice([" ", "\n", "  "]).join(w[:at] + passage[cut : cut + random.randrange(10, 25)] + w[at:])))
    got = substring_dedup.substring_dedup(frame("doc_id bigint, text string", docs).repartition(4), buckets=buckets, chunk_bytes=chunk)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], __import__("hashlib").sha256(r["kept_text"].encode()).hexdigest()) for r in got.collect()}
    assert got == brute.substrings(docs)


def test_many_buckets_in_few_partitions(spark, frame):
    """The partitions are the session's, however many buckets there are; a partition judges its buckets one by one."""
    random.seed(16)
    passage = [f"p{i}" for i in range(60)]
    docs = [(i, " ".join([f"w{random.randrange(400)}" for _ in range(50)] + passage[i % 30 : i % 30 + 25])) for i in range(50)]
    table = frame("doc_id bigint, text string", docs).repartition(3)
    out = substring_dedup.substring_dedup(table, buckets=500, chunk_bytes=2000, most_partitions=1)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], __import__("hashlib").sha256(r["kept_text"].encode()).hexdigest()) for r in out.collect()}
    assert got == brute.substrings(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bucket#" in plan and f", {spark.conf.get('spark.sql.shuffle.partitions')}), REPARTITION_BY_NUM" in plan


def test_equal_bits_of_different_windows():
    raw = b"a b c a b d a  b c"
    begin, end, _ = substring_dedup._words(np.frombuffer(raw, np.uint8))
    order, group = substring_dedup._groups(raw, begin[[0, 3, 6]], end[[2, 5, 8]], np.zeros(3, np.uint64))
    by = dict(zip(order.tolist(), group.tolist()))
    assert by[0] == by[2] != by[1]


TEXT = st.text(alphabet=st.sampled_from(list("ab.,'1 \n\t!é日\u00a0\u2003ſ")), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT, st.text(max_size=20), st.just("x<|endoftext|> y")), max_size=6))
def test_encoder_equals_tokenizer(texts):
    tokenizer, encoder = _tokenizers()
    texts = [t.encode("utf-8", "ignore").decode() if t is not None else None for t in texts]
    flat, bounds = encoder.encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert flat[a:b].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


_made = []


def _tokenizers():
    if not _made:
        from tokenizers import Tokenizer

        path = packing.public_tokenizer()
        _made.extend([Tokenizer.from_file(path), packing.Encoder(open(path, encoding="utf-8").read(), keep=300)])
    return _made


def test_packer_fills_and_merges():
    random.seed(7)
    packer = packing.Packer(0, 0, 64, 4, 2)
    total = 0
    for i in range(500):
        n = random.randrange(1, 150)
        total += n
        packer.add(i, 0, np.full(n, i, "<u4").tobytes(), n)
    assert len(packer.open) <= 4
    packer.merge()
    rows = packer.rows
    assert sum(rows["length"]) == total
    used = {}
    for s, n in zip(rows["sequence_id"], rows["length"]):
        used[s] = used.get(s, 0) + n
    assert max(used.values()) <= 64 and sum(n < 64 - 1 for n in used.values()) <= 1


def test_merge_rounds(documents):
    """Leftovers of many partitions meet over several rounds."""
    from tokenizers import Tokenizer

    path = packing.public_tokenizer()
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(120)]
    pieces = packing.pack(documents(rows).repartition(20), path, fan_in=3).collect()
    assert brute.packed(rows, [p.asDict() for p in pieces], Tokenizer.from_file(path)) < 0.6
    used = {}
    for p in pieces:
        used[p["sequence_id"]] = used.get(p["sequence_id"], 0) + p["length"]
    assert sum(n < 2040 for n in used.values()) <= 1


def test_chats_come_back(frame):
    hostile = ["", "\\", "\\\\h", "###", "#####", "</turn>", "\\t</turn>", "### user\nx</turn>\n### assistant\n", "\\### Assistant: </turn> ok", "\n", "a\\"]
    rows = []
    for c in range(12):
        for t, text in enumerate(hostile[c:] + hostile[:c]):
            rows.append((c, t, ["user", "assistant", "assistant", "a\nb\\n###"][(c + t) % 4], text))
    rows += [(50, None, None, None), (None, 1, "assistant", "null id"), (51, 2, "user", "b"), (51, 2, "user", "a"), (51, 2, "user", "a")]
    chats = chat_format.format_chats(frame("conv_id bigint, turn bigint, role string, text string", rows))
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss"]) for r in chat_format.read_back(chats).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        assert got[conv] == ([t[2:] for t in turns], "".join(t[3] for t in turns if t[2] == "assistant"))
    merged = chat_format.format_chats(frame("conv_id bigint, turn bigint, role string, text string", [(1, 1, "user", "a"), (1, 2, "user", "b")]))
    assert merged.first()["formatted"] == "### user\na</turn>b</turn>"


def test_mixture_of_two_languages(frame):
    en, de = "the quick brown fox and the lazy dog went home with them ", "der schnelle braune fuchs und die faule katze gingen nach hause "
    model = language_id.learn(frame("text string, lang string", [(en * 20, "en"), (de * 20, "de"), ("je ne sais pas quoi dire " * 20, "fr")]))
    half = language_id.infer(model, [en * 5 + de * 5, en * 9, de, "", "123"])
    at = {n: i for i, n in enumerate(model.names)}
    assert half[0, at["en"]] == pytest.approx(0.5, abs=0.12) and half[0, at["fr"]] == 0
    assert half[1, at["en"]] == 1 and half[2].argmax() == at["de"] and not half[3:].any()


def test_language_likelihood_steps_match_one_by_one(frame):
    rows = [("ab ba aab", "x"), ("cd dc ccd", "y")]
    model = language_id.learn(frame("text string, lang string", rows))
    texts = ["ab ab cd", "ba", "dc dc ab cd", "zz", ""]
    together = language_id.infer(model, texts)
    for t, row in zip(texts, together):
        assert language_id.infer(model, [t])[0] == pytest.approx(row, abs=1e-5)


def test_chi_square():
    assert quality._quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality._quantile(0.99, 7) == pytest.approx(18.4753, abs=1e-3)


def test_outliers_against_a_third_of_junk(documents):
    """A third of a group is junk of one kind; the estimate follows the bulk."""
    random.seed(8)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randrange(3, 8)))
    rows = []
    for i in range(300):
        w = [word() for _ in range(random.randrange(60, 300))]
        rows.append((i, " ".join(x + "***" if i % 4 == 0 else x for x in w)))
    got = {r["doc_id"]: r["kept"] for r in quality.quality(documents(rows)).collect()}
    assert all(got[i] == (i % 4 != 0) for i in got)


def test_few_documents_are_judged_by_wide_deviations(documents):
    """Different but ordinary documents stay in a table of ten; one that is far from any text goes."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60 + 40 * i))) for i in range(9)]
    got = quality.quality(documents([*rows, (9, " ".join(f"{k}" + "#" * 300 for k in range(30)))])).collect()
    assert all(r["distance"] is not None for r in got) and [r["doc_id"] for r in got if not r["kept"]] == [9]


def test_verdict_is_smooth_in_the_group_size(documents):
    """A group of 49, 50 or 51 documents beside a larger one: distances of the same document hardly move."""
    random.seed(17)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randrange(3, 8)))
    texts = [" ".join(word() + "*" * (k % 5 == 0) for _ in range(random.randrange(60, 300))) for k in range(52)]
    big = [(10_000 + i, " ".join(word() for _ in range(random.randrange(60, 300))), "en", "big") for i in range(120)]
    sizes = (49, 50, 51)
    rows = [(100 * n + i, texts[i], "en", f"small {n}") for n in sizes for i in range(n)]
    got = {r["doc_id"]: r["distance"] for r in quality.quality(documents([*big, *rows])).collect()}
    for i in range(49):
        same = [got[100 * n + i] for n in sizes]
        assert max(same) <= 1.25 * min(same) + 0.5


def test_lines_near_the_threshold_are_exact(documents):
    rows, n = [], 0
    for spread in range(1, 25):
        for s in range(spread):
            for _ in range(2):
                rows.append((n, f"own {n}\n  line of {spread} sites\n\n line of {spread} sites", "en", f"s{s}"))
                n += 1
    got = line_dedup.line_dedup(documents(rows), min_sites=10).collect()
    seen = set()
    for (i, text, _, _), r in zip(rows, sorted(got, key=lambda r: r["doc_id"])):
        line = text.split("\n")[1].strip()
        spread = int(line.split()[2])
        want = 0 if spread < 10 else 1 if line not in seen else 2
        seen.add(line)
        assert (r["doc_id"], r["n_lines"], r["n_removed"]) == (i, 3, want)
        assert r["text"] == "\n".join(text.split("\n")[: 4 - want] if want < 2 else text.split("\n")[:1] + [""])


def _longest(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i + 1][j + 1] = n[i][j] + 1 if x == y else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


def test_alignment_is_increasing_and_near_the_longest(monkeypatch):
    monkeypatch.setattr(license_scan, "EXACT_CELLS", 16)
    random.seed(9)
    for _ in range(40):
        b = [f"w{random.randrange(60)}" for _ in range(50)]
        a = [w if random.random() < 0.9 else "other" for w in b if random.random() < 0.95]
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) >= 0.8 * _longest(a, b)


def test_licenses_in_long_texts():
    scanner = license_scan.Scanner()
    noise = " ".join(f"the w{i} of" for i in range(4000))
    gpl = license_scan.TEMPLATES[5][1]
    text = f"{noise}\n{gpl}\n{noise} Licensed under the Apache License, Version 2.0. {noise}\n{gpl.replace('free', 'gratis')}"
    found = scanner.scan(text)
    assert [f[0] for f in found] == ["GPL-3.0", "Apache-2.0", "GPL-3.0"] or sorted(f[0] for f in found) == ["Apache-2.0", "GPL-3.0", "GPL-3.0"]
    assert not scanner.scan(noise)


def test_notices_are_aligned_by_anchors(monkeypatch):
    """At the values the query runs with, unique words come first and the exact table sees small gaps only."""
    anchors, cells = [], []
    increasing, exact = license_scan._increasing, license_scan._exact
    monkeypatch.setattr(license_scan, "_increasing", lambda pairs: anchors.append(increasing(pairs)) or anchors[-1])
    monkeypatch.setattr(license_scan, "_exact", lambda a, b: cells.append(len(a) * len(b)) or exact(a, b))
    scanner = license_scan.Scanner()
    for name, notice in license_scan.TEMPLATES[:16]:
        anchors.clear(), cells.clear()
        assert scanner.scan(f"some words\n{notice}\nother words")[0][:2] == (name, 1.0)
        assert max(map(len, anchors)) > 2 and max(cells, default=0) <= 100


def test_exact_alignment_by_bits():
    random.seed(10)
    for n in (0, 1, 7, 90):
        a, b = ([random.choice("abcd") for _ in range(random.randrange(n + 1))] for _ in range(2))
        pairs = license_scan._exact_by_bits(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) == _longest(a, b)


def test_whole_license_texts():
    random.seed(11)
    scanner = license_scan.Scanner()
    noise = " ".join(f"the w{i} of" for i in range(300))
    for name, text in license_scan.TEMPLATES[16:]:
        changed = [w for w in text.split() if random.random() < 0.95]
        for copy in (text.split(), changed):
            found = scanner.scan(f"{noise}\n{' '.join(copy)}\n{noise}")
            assert found[0][0] == name and found[0][3] - found[0][2] > 0.9 * len(copy)
    twice = license_scan.TEMPLATES[21][1]
    assert [f[0] for f in scanner.scan(f"{twice} {noise} {twice}")] == ["BSD", "BSD"]


def test_interrupted_licenses():
    """Foreign words in the middle, at several places, and many words of the license's own vocabulary do not hide it."""
    random.seed(15)
    scanner = license_scan.Scanner()
    name, text = license_scan.TEMPLATES[16]
    w = text.split()
    noise = [f"x{i}" for i in range(400)]
    for foreign in (0, 6, 7, 40, 150):
        found = scanner.scan(" ".join([*noise, *w[:80], *noise[:foreign], *w[80:], *noise]))
        assert found[0][:2] == (name, 1.0) and found[0][3] - found[0][2] >= len(w) - 5 + foreign
    several = " ".join([*noise, *w[:40], *noise[:40], *w[40:90], *noise[:25], *w[90:], *noise])
    assert scanner.scan(several)[0][:2] == (name, 1.0)
    own = [w[random.randrange(len(w))] for _ in range(len(w) // 3)]
    assert scanner.scan(" ".join([*noise, *w[:80], *own, *w[80:], *noise]))[0][0] == name
    twice = " ".join([*w[:80], *noise[:30], *w[80:], *noise, *w[:30], *noise[:30], *w[30:]])
    assert [f[:2] for f in scanner.scan(twice)] == [(name, 1.0)] * 2
    random.shuffle(w)
    assert not [f for f in scanner.scan(" ".join(w * 5)) if f[1] > 0.99]


def test_small_groups_are_judged_by_wider_ones(documents):
    """A source too small for an estimate of its own is judged by its language, a small language by all documents."""
    random.seed(12)
    rows = []
    for i in range(120):
        w = ["".join(random.choice("abcdefgh") for _ in range(random.randrange(3, 8))) for _ in range(random.randrange(60, 300))]
        bad = i % 20 == 7
        lang, source = ("en", f"s{i // 60}") if i < 100 else ("en", f"tail{i}") if i < 110 else ("fr", "few") if i < 118 else (None, None)
        rows.append((i, " ".join(x + "***" if bad else x for x in w), lang, source))
    got = {r["doc_id"]: r for r in quality.quality(documents(rows)).collect()}
    assert all(r["distance"] is not None and r["kept"] == (i % 20 != 7) for i, r in got.items())


def test_duplicate_lines_alone_and_repeated_words_alone(documents):
    """Where the bulk has none of them, either is enough; all other statistics are those of the bulk."""
    random.seed(13)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randrange(3, 8)))
    rows = [(i, "\n".join(" ".join(word() for _ in range(7)) for _ in range(random.randrange(20, 40)))) for i in range(100)]
    pool = [" ".join(word() for _ in range(7)) for _ in range(12)]
    order = [(k + d * n) % 12 for d, k in ((1, 0), (5, 0), (7, 1)) for n in range(10)]  # no two lines follow each other twice
    rows.append((100, "\n".join(pool[k] for k in order)))
    passage = [word() for _ in range(25)]
    rows.append((101, " ".join([*passage, *(word() for _ in range(120)), *passage, *(word() for _ in range(30))])))
    got = {r["doc_id"]: r for r in quality.quality(documents(rows)).collect()}
    lines, words = got[100], got[101]
    assert lines["n_dup_lines"] > 10 and lines["n_repeat_words"] == 0
    assert words["n_dup_lines"] == 0 and words["n_repeat_words"] == 50
    assert not lines["base_failed"] and not lines["kept"] and not words["base_failed"] and not words["kept"]
    assert sum(got[i]["kept"] for i in range(100)) >= 97


def test_hot_minimisers_are_split(frame):
    """Different windows with one frequent word pair are dealt to many buckets; equal ones still meet."""
    random.seed(14)
    docs = []
    for i in range(40):
        w = [x for k in range(30) for x in ("der", "der", f"w{random.randrange(10**6)}")]
        docs.append((i, " ".join(w + [f"p{k}" for k in range(20)] * (i % 2))))
    got = substring_dedup.substring_dedup(frame("doc_id bigint, text string", docs).repartition(4), buckets=7, chunk_bytes=3000, hot_windows=5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], __import__("hashlib").sha256(r["kept_text"].encode()).hexdigest()) for r in got.collect()}
    assert got == brute.substrings(docs)
    texts, ids = pa.array([t for _, t in docs]), np.arange(40)
    least, n = substring_dedup._count(texts, 13, 2)
    hot = tuple(least[n > 300].view(np.int64).tolist())
    used = lambda hot: max(np.concatenate([substring_dedup._unpack_info(__import__("zstandard").decompress(d))[:, 3].sum(keepdims=True) for b in substring_dedup.Sender(1000, 13, 2, hot).send(ids, ids, texts) for k, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if k >= 0]))
    assert hot and used(()) > 300 and used(hot) < 300
