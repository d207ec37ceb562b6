"""The registered queries against their SQL, or against plain versions, on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from cohortframe.llm import ORACLES, QUERIES, license_scan, packing
from tests.llm import brute
from tests.oracle import database, spark_result, sql_result

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.fixture(scope="module")
def texts(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert spark_result(QUERIES[name](spark, FOLDER)) == sql_result(con, ORACLES[name])


def test_near_dedup(spark, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op5_near_dedup"](spark, FOLDER).collect()}
    assert got == brute.near(texts)


def test_substring_dedup(spark, texts):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in QUERIES["op9_substring_dedup"](spark, FOLDER).collect()}
    assert got == brute.substrings(texts)


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    pieces = [r.asDict() for r in QUERIES["op10_packing"](spark, FOLDER).collect()]
    assert brute.packed(texts, pieces, Tokenizer.from_file(packing.public_tokenizer())) < 0.02


def test_language_id(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op4_language_id"](spark, FOLDER).join(truth, "doc_id").where("held_out").collect()
    assert rows and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_quality_statistics(spark, texts):
    symbols = set("#*$%&|<>")
    got = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, FOLDER).collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        w = brute.words(text)
        lines = [x for x in (text or "").split("\n") if brute.words(x)]
        repeated = brute.repeated_words(text)
        want = (len(w), sum(map(len, w)), sum(c in symbols for c in text or ""), len(lines) - len(set(lines)), repeated)
        assert tuple(got[i][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        failed = len(w) < 20 or 100 * repeated > 30 * len(w)
        assert got[i]["base_failed"] == failed and not (failed and got[i]["kept"])


def test_quality_verdict(spark):
    """Distances and verdicts against numpy: same starts and histogram cells, solved and determined by linear algebra."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "source")
    rows = QUERIES["op3_quality"](spark, FOLDER).join(docs, "doc_id")
    rows = rows.withColumn("r", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(1 << 30)) / (1 << 30)).collect()
    want = brute.quality([r.asDict() for r in rows])
    assert any(not w[1] for w in want.values())
    for r in rows:
        distance, kept = want[r["doc_id"]]
        assert r["kept"] == kept
        assert r["distance"] is None if distance is None else r["distance"] == pytest.approx(distance, rel=1e-5, abs=1e-5)


def test_license_scan(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op8_license_scan"](spark, FOLDER).collect()}
    known = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    }
    found = 0
    for i, text in texts:
        held = {name for line, name in known.items() if line in (text or "").split("\n")}
        found += len(held)
        assert {p["license"] for p in got[i]["places"]} >= held
        if "icen" not in (text or ""):
            assert got[i]["license"] is None
        # Each notice that a part of the text aligns with by dynamic programming is found, and no other.
        assert {p["license"] for p in got[i]["places"]} == brute.notices(text, license_scan.TEMPLATES[:16])
    assert found


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    whole = {}
    for r in rows:
        whole.setdefault(r["doc_id"], [r["doc_tokens"], 0])[1] += r["length"]
    assert all(n % total == 0 and n // total in (1, 2) for total, n in whole.values())


def test_entry_registers(spark):
    import __spark_entry__ as contract

    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
