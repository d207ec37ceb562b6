"""Language identification as a mixture: expectation-maximisation of each document's language proportions.

Training counts hashed letter trigrams per language over all labelled rows that are handed in. A document's trigrams are
taken as drawn from a mixture of the languages; its proportions come from EM over the trigram likelihoods. The set of
languages is chosen by penalised likelihood: starting from the best single language, the next one by proportion joins
only if the likelihood gains more than the penalty for one more proportion.

The prediction is the language with the largest proportion, the score that proportion. Null text and text without letters
give ``und`` with score 0, as does any text when nothing could be learned. Ties go to the language that is first by code
point. Case and everything but letters are left out. Every row is predicted, repeated ones too.

``fit`` tells how far the chosen mixture explains a text better than a background in which every trigram is equally likely:
the gain in log-likelihood, with the penalty of one proportion to its credit, so that few trigrams decide nothing. Below 0
the text is in none of the languages. It is 0 for a text with letters when nothing could be learned, and null for a text
without letters.

A model holds 2**BITS trigram buckets for each language, about 260 KB, on the driver and in each task: hundreds of languages,
whatever the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.llm.base import query, read

BITS = 15
CHUNK_CHARS = 1_000_000
STEPS = 8
#: Trigrams overlap and are no independent draws, so the usual half log of their number is multiplied.
PENALTY = 3.0
SMOOTH = 0.5
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each trigram of letters, with one space around and between runs of letters."""
    joined = "\x00".join(["", *(t.lower().replace("\x00", " ") for t in texts), ""])
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    end = c == 0
    owner = np.cumsum(end) - 1
    letter = _is_letter()[c]
    # Of a run without letters one place stays, and the ends of the texts.
    keep = letter.copy()
    keep[1:] |= letter[:-1] | end[:-1]
    keep |= end
    c, owner, letter = np.where(letter, c, 32)[keep].astype(np.uint64), owner[keep], letter[keep]
    if len(c) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    x = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0xD6E8FEB86659FD93))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    ok = letter[1:-1]  # a trigram has a letter in the middle
    return owner[1:-1][ok], (x >> np.uint64(64 - bits)).astype(np.int64)[ok]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    begin, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1])
        if size >= CHUNK_CHARS:
            yield begin, held
            begin, held, size = i + 1, [], 0
    if held:
        yield begin, held


class Model:
    """Trigram probabilities: ``names`` in order, ``p`` of shape buckets x languages."""

    def __init__(self, names: list[str], counts: np.ndarray, bits: int):
        self.names, self.bits = names, bits
        p = (counts + SMOOTH) / (counts.sum(0, keepdims=True) + SMOOTH * len(counts))
        self.p, self.log_p = p.astype(np.float32), np.log(p).astype(np.float32)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Counts over all rows of ``labelled`` that have a text and a language."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not names:
        return None
    bits = BITS
    number = {n: i for i, n in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), 1 << bits), np.int64)
        for batch in batches:
            langs = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            texts = batch.column(1).to_pylist()
            for begin, part in _chunks(texts):
                owner, bucket = trigrams(part, bits)
                total += np.bincount((langs[begin : begin + len(part)][owner] << bits) + bucket, minlength=total.size).reshape(total.shape)
        for i, row in enumerate(total):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(row[at])], names=["lang", "bucket", "n"]
            )

    sums = rows.mapInArrow(count, "lang int, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    counts = np.zeros((1 << bits, len(names)))
    counts[table["bucket"].to_numpy(), table["lang"].to_numpy()] = table["n"].to_numpy()
    return Model(names, counts, bits)


def _mixture(p: np.ndarray, n: np.ndarray, starts: np.ndarray, owner: np.ndarray, pi: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions per text after ``steps`` of EM from ``pi``, and the log-likelihood there."""
    total = np.add.reduceat(n, starts)[:, None]
    for _ in range(steps):
        part = p * pi[owner]
        part *= (n / part.sum(1))[:, None]
        pi = np.add.reduceat(part, starts, axis=0) / total
    like = np.add.reduceat(n * np.log((p * pi[owner]).sum(1)), starts)
    return pi, like


def infer(model: Model, texts: list[str], steps: int = STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Language proportions of each text (rows of zeros for texts without letters)."""
    return infer_with_fit(model, texts, steps, penalty)[0]


def infer_with_fit(model: Model, texts: list[str], steps: int = STEPS, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Language proportions of each text, and its ``fit`` (NaN for texts without letters)."""
    out, fit = np.zeros((len(texts), len(model.names)), np.float32), np.full(len(texts), np.nan)
    owner, bucket = trigrams(texts, model.bits)
    if not len(owner):
        return out, fit
    key, n = np.unique((owner << model.bits) + bucket, return_counts=True)
    n, owner, bucket = n.astype(np.float32), key >> model.bits, key & ((1 << model.bits) - 1)
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    doc = owner[starts]
    owner = np.cumsum(np.concatenate([[False], owner[1:] != owner[:-1]]))
    p = model.p[bucket]
    single = np.add.reduceat(n[:, None] * model.log_p[bucket], starts, axis=0)
    best = single.argmax(1)
    size = np.add.reduceat(n, starts)
    cost = penalty * 0.5 * np.log(np.maximum(size, 2))
    chosen = np.zeros((len(starts), p.shape[1]), np.float32)
    chosen[np.arange(len(best)), best] = 1
    value = single[np.arange(len(best)), best]
    if p.shape[1] > 1:
        pi, like = _mixture(p, n, starts, owner, np.full(chosen.shape, 1 / p.shape[1], np.float32), steps)
        open_ = like - value > cost
        order = np.argsort(-pi, axis=1, kind="stable")
        for k in range(2, p.shape[1] + 1):
            at = np.flatnonzero(open_)
            if not len(at):
                break
            rows = np.flatnonzero(open_[owner])
            allowed = np.zeros((len(at), p.shape[1]), np.float32)
            np.put_along_axis(allowed, order[at, :k], 1 / k, axis=1)
            sub = owner[rows]
            cuts = np.flatnonzero(np.concatenate([[True], sub[1:] != sub[:-1]]))
            pi_k, like_k = _mixture(p[rows], n[rows], cuts, np.cumsum(np.concatenate([[False], sub[1:] != sub[:-1]])), allowed, steps)
            gain = like_k - value[at] > cost[at]
            chosen[at[gain]], value[at[gain]] = pi_k[gain], like_k[gain]
            open_[at[~gain]] = False
    out[doc] = chosen
    fit[doc] = value + size * model.bits * np.log(2) + cost
    return out, fit


def _nothing_learned(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    fit = np.full(len(texts), np.nan)
    fit[trigrams(texts, BITS)[0]] = 0.0
    return np.zeros((len(texts), 1)), fit


def language_id(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text, lang_pred, score, languages (the chosen set), their proportions, fit."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, sets, shares, fits = [], [], [], [], []
            for _, part in _chunks(batch.column(1).to_pylist()):
                found, fit = infer_with_fit(model, part) if model else _nothing_learned(part)
                fits.append(fit)
                for row in found:
                    at = int(row.argmax())
                    known = row[at] > 0
                    held = [i for i in np.argsort(-row, kind="stable") if row[i] > 0]
                    names.append(model.names[at] if known else "und")
                    scores.append(min(1.0, float(row[at])))
                    sets.append([model.names[i] for i in held])
                    shares.append([float(row[i]) for i in held])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())),
                    pa.array(shares, pa.list_(pa.float64())), pa.array(np.concatenate([*fits, []]), pa.float64(), from_pandas=True),
                ],
                names=[*batch.schema.names, "lang_pred", "score", "languages", "proportions", "fit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        predict, f"`{id_col}` {kind}, `{text_col}` string, lang_pred string, score double, languages array<string>, proportions array<double>, fit double"
    )


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    """All documents; learned on three quarters of them by id."""
    docs = read(spark, sf_dir, "documents")
    found = language_id(docs, learn(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages", "proportions", "fit")
