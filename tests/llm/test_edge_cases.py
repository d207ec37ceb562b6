"""Each operator and stage on nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortframe.llm import chat_format, exact_dedup, language_id, license_scan, line_dedup, mixing, near_dedup, packing, quality, substring_dedup
from tests.llm.brute import words

RUN = {
    "line_dedup": lambda d: line_dedup.line_dedup(d, min_sites=2),
    "mixing": mixing.mix,
    "quality": quality.quality,
    "language_id": lambda d: language_id.language_id(d, language_id.learn(d)),
    "near_dedup": near_dedup.near_dedup,
    "exact_dedup": lambda d: exact_dedup.exact_dedup(d, F.col("doc_id") < 3),
    "license_scan": license_scan.license_scan,
    "substring_dedup": substring_dedup.substring_dedup,
}


@pytest.mark.parametrize("name", RUN)
def test_one_row_each(spark, documents, odd_rows, clash, name):
    docs = documents(odd_rows)
    plain = RUN[name](docs).collect()
    assert Counter(r["doc_id"] for r in plain) == Counter(r[0] for r in odd_rows)
    clashing = RUN[name](clash(docs)).collect()
    assert Counter(map(str, clashing)) == Counter(map(str, plain))


@pytest.mark.parametrize("name", [*RUN, "packing"])
def test_empty_table(documents, name):
    run = RUN.get(name) or (lambda d: packing.pack(d, packing.public_tokenizer()))
    assert run(documents([])).collect() == []


def test_empty_conversations(frame):
    assert chat_format.digests(chat_format.format_chats(frame("conv_id bigint, turn bigint, role string, text string", []))).collect() == []


def test_exact_values(documents, odd_rows):
    rows = exact_dedup.exact_dedup(documents(odd_rows), F.col("doc_id") < 3).collect()
    same = [r for r in rows if r["group_size"] == 4 and r["keep_id"] == 1]
    # Rows 1, 1, 2 and the one without id: the smallest id stays, and one row of it only.
    assert Counter((r["doc_id"], r["keep_id"], r["kept"]) for r in same) == Counter({(1, 1, True): 1, (1, 1, False): 1, (2, 1, False): 1, (None, 1, False): 1})
    empty = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert {r["doc_id"] for r in empty} == {4, 5, 6, None} and {r["keep_id"] for r in empty} == {6}


def test_near_values(documents, odd_rows):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(documents(odd_rows)).collect()}
    assert {(1, 11, 1, True), (2, 11, 1, False), (3, 11, 1, False), (None, 11, 1, False), (4, 0, 4, True), (5, 0, 5, True), (9, 1, 9, True)} <= got
    assert {(8, 29997, 7, False), (7, 29996, 7, True), (None, 0, None, True)} <= got


def test_substring_values(documents, odd_rows):
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(documents(odd_rows)).collect())
    want = {(1, 15, 0): 2, (2, 15, 15): 1, (3, 15, 0): 1, (None, 15, 15): 1, (7, 30000, 0): 1, (8, 30001, 30000): 1, (4, 0, 0): 1, (None, 0, 0): 1}
    assert all(got[k] == n for k, n in want.items())


def test_language_values(documents, odd_rows):
    docs = documents(odd_rows)
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.language_id(docs, language_id.learn(docs)).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (11, "und"), (None, "und"), (9, "en"), (7, "fr")} <= got
    nothing = documents([(1, "words here", None, "s")])
    assert [(r["lang_pred"], r["score"]) for r in language_id.language_id(nothing, language_id.learn(nothing)).collect()] == [("und", 0.0)]


def test_mixing_values(documents, odd_rows):
    rows = mixing.mix(documents(odd_rows)).collect()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert {(r["doc_id"], r["size"]) for r in rows} == {(r[0], len(words(r[1]))) for r in odd_rows}
    by = {r["source"]: (r["source_size"], r["target"]) for r in rows}
    assert sum(t for _, t in by.values()) == pytest.approx(1.5 * sum(s for s, _ in by.values()))


def test_packing_values(documents, odd_rows):
    from tokenizers import Tokenizer

    path = packing.public_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.pack(documents(odd_rows), path).collect()
    want = sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows)
    assert sum(p["length"] for p in pieces) == want
    used = Counter()
    for p in pieces:
        used[p["sequence_id"]] += p["length"]
    assert sum(n < 2048 - packing.LEAST_CUT for n in used.values()) <= 1 and max(used.values()) <= 2048


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages(spark, documents, odd_rows, clash, rows):
    docs = clash(documents(odd_rows if rows == "odd" else []))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.collect()
    assert (len(corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()) > 0) == (rows == "odd")


def test_stage_decisions(spark, documents, odd_rows):
    docs = documents(odd_rows)
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: Counter(r["doc_id"] for r in df.collect())
    assert ids(stages["language"](spark, docs, "")) == Counter({1: 2, 2: 1, 3: 1, None: 1, 7: 1, 8: 1, 9: 1, 10: 1})
    assert ids(stages["near-dedup"](spark, docs, "")) == Counter({1: 1, 4: 1, 5: 1, 6: 1, 7: 1, 9: 1, 10: 1, 11: 1, None: 1})
    mixed = ids(stages["mixing"](spark, docs, ""))
    assert mixed == Counter({k: v for k, v in sum((Counter({r["doc_id"]: r["passes"]}) for r in mixing.mix(docs).collect()), Counter()).items() if v})


@pytest.mark.parametrize("ids", [(1, 2, 5), (None, None, 5), (1, 1, 5), (None, None, None), (7, 7, 7)])
def test_links_do_not_depend_on_ids(spark, documents, ids):
    a, b = (" ".join(f"{x}{i}" for i in range(100)) for x in "ab")
    docs = documents([(ids[0], a), (ids[1], b), (ids[2], b + " more"), (ids[2], b + " more")])
    rows = near_dedup.near_dedup(docs).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["component"], []).append(r["n_shingles"])
    assert sorted(map(sorted, groups.values())) == [[96], [96, 97, 97]]
    least = min((i for i in ids[1:] if i is not None), default=None)
    assert {r["component_id"] for r in rows if r["component"] == max(groups, key=lambda g: len(groups[g]))} == {least}
    left = dict(corpus_pipeline.STAGES)["near-dedup"](spark, docs, "").collect()
    assert len(left) == 2 and {a} < {r["text"] for r in left}


def test_languages_without_labels(spark, documents):
    stage = dict(corpus_pipeline.STAGES)["language"]
    rows = [(1, "some words here", None, "s"), (2, "12 34", None, "s"), (3, None, None, "s"), (4, "x", None, "s")]
    assert sorted(r["doc_id"] for r in stage(spark, documents(rows), "").collect()) == [1, 4]


def test_languages_reject_noise(spark, documents):
    import random

    draw = random.Random(2)
    text = lambda seed: " ".join(random.Random(seed).choices("the of and to in that house water people small great never under over again where".split(), k=60))
    noise = " ".join("".join(draw.choice("qxzjkvwpbgфшщ") for _ in range(7)) for _ in range(80))
    docs = documents([*[(i, text(i), "en", "s") for i in range(40)], (90, noise, None, "s"), (91, text(99), None, "s"), (92, "zq", None, "s")])
    left = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["language"](spark, docs, "").collect()}
    assert left == {*range(40), 91, 92}
