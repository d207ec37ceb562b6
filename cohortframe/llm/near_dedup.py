"""Near-dedup by HyperMinHash.

The distinct shingles of a document are hashed and dealt to buckets by their first bits. A bucket keeps the smallest hash
in a compressed register of 16 bits: the count of leading zeros and ten mantissa bits. Empty buckets take the register of
the first filled bucket in a fixed random order of their own. Four registers are a band. Documents that share a band are
candidates; the share of equal registers, corrected for chance collisions, estimates their similarity; pairs that may
reach the threshold are verified on the full shingle sets.

Documents with equal sets form a class first, and only the class goes on. Pairs of a bucket are not all formed.
A shingle that no other candidate document holds is shared with none, so a document with too many of them is linked with
nothing. The member with the smallest share of them leads the bucket, and the others are compared with it. Members that
this joins into one component need no further pairs. For two members of different components the overlap with the leader
bounds their own: what they share lies within the leader, or among the shingles of both that the leader lacks and that
occur elsewhere. Only pairs that this bound leaves open are tested, if need be after further leaders have been tried. So
no candidate is dropped by the bounds. Candidates themselves come from the bands: a pair at the threshold misses all of them,
or has an estimate below the slack, with a chance of some millionths.

A document without words has no set and is linked with nothing. With fewer words than a shingle the whole sequence is one
shingle. Every row is a document of its own, told apart by id and text: rows without id and rows with one id and different
texts are linked each by its own set. A null id is larger than any other and reported as null. Equal sets are known by a
128-bit digest, texts of one id by 64 bits. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.base import SHINGLE, SIMILAR, query, read, text_mark
from cohortframe.llm.components import components
from cohortframe.session import barrier

BUCKETS, ROWS = 128, 4
ZERO_BITS, MANTISSA_BITS = 6, 10
#: Standard errors below the threshold at which an estimate still leads to verification.
SLACK = 5.0
#: Open pairs for each member of a bucket that are tested one by one rather than after one more leader; the most leaders.
PAIRS_PER_MEMBER, MAX_LEADERS = 64, 3
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: For each bucket, the rank of every bucket in its order.
_RANK = np.random.default_rng(17).permuted(np.tile(np.arange(BUCKETS), (BUCKETS, 1)), axis=1)
_EDGES = (np.arange(BUCKETS, dtype=np.uint64)) << np.uint64(64 - 7)


class WordHashes(dict):
    """64 bits of each word; kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; equal texts after lower-casing A-Z give equal sets."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    out = np.full(n, len(h) if len(h) < size else size, np.uint64)
    for i in range(min(size, len(h))):
        out = (out ^ h[i : i + n]) * _ODD
        out ^= out >> np.uint64(32)
    return np.unique(_mix(out))


def registers(sets: np.ndarray) -> np.ndarray:
    """The 16-bit registers of a sorted, non-empty set, packed four to an int64 (a band)."""
    at = np.searchsorted(sets, _EDGES)
    low = sets[np.minimum(at, len(sets) - 1)]
    filled = (at < len(sets)) & ((low >> np.uint64(57)) == np.arange(BUCKETS, dtype=np.uint64))
    rest = low & np.uint64((1 << 57) - 1)
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)  # bits of the number; rounding up at 2**53 only adds one
    length = np.where((length > 0) & ((rest >> np.maximum(length - 1, 0).astype(np.uint64)) == 0), length - 1, length)
    zeros = np.minimum(57 - length, (1 << ZERO_BITS) - 1)
    shift = length - 1 - MANTISSA_BITS
    mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64))
    mantissa &= np.uint64((1 << MANTISSA_BITS) - 1)
    reg = (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa
    if not filled.all():
        full = np.flatnonzero(filled)
        reg = np.where(filled, reg, reg[full[np.argmin(_RANK[:, full], axis=1)]])
    return reg.astype(np.uint16).view(np.int64)


def _chance(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The probability that two different minima give one register: equal zero counts, equal mantissas."""
    k = np.arange(40)[:, None]

    def of(n):
        lam = np.maximum(n, 1)[None, :] / BUCKETS
        return np.exp(-lam * 2.0 ** -(k + 1)) - np.exp(-lam * 2.0**-k)

    return (of(na) * of(nb)).sum(0) / (1 << MANTISSA_BITS)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Similarity from registers (rows of 16-bit values) with the chance collisions taken out."""
    c = _chance(na, nb)
    return np.maximum(0, ((a == b).mean(1) - c) / (1 - c))


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        hashes = WordHashes()
        for batch in batches:
            n, digest, sig = [], [], []  # columns: id, text, mark
            for text in batch.column(1):
                s = shingles(text.as_py(), hashes, size)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                names=["id", "mark", "n", "digest", "sig"],
            )

    return run


def _may_reach(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t = {k: batch.column(i) for i, k in enumerate(batch.schema.names)}
            sig = [np.frombuffer(b"".join(t[k].to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in ("sa", "sb")]
            na, nb = t["na"].to_numpy(zero_copy_only=False), t["nb"].to_numpy(zero_copy_only=False)
            # A size ratio below the threshold rules a pair out for certain.
            ok = (estimate(*sig, na, nb) >= least) & (np.minimum(na, nb) * 100 >= SIMILAR * np.maximum(na, nb))
            yield pa.RecordBatch.from_arrays([t["a"], t["b"]], names=["a", "b"]).filter(pa.array(ok))

    return run


def _overlap(size: int):
    """The number of shingles that two texts share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last_id, last = WordHashes(), None, None
        for batch in batches:
            both = []
            for _, b, ta, tb in zip(*(c for c in batch.columns)):
                if b.as_py() != last_id:
                    last_id, last = b.as_py(), shingles(tb.as_py(), hashes, size)
                both.append(len(np.intersect1d(shingles(ta.as_py(), hashes, size), last, assume_unique=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64())], names=["a", "b", "o"])

    return run


def _single(size: int):
    """All shingles of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t.as_py(), hashes, size) for t in part.column(1)]
                ids = np.repeat(part.column(0).to_numpy(), [len(s) for s in sets])
                h = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(h)], names=["id", "h"])

    return run


NO_ID = 2**63 - 1


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, and mark and component.

    ``mark`` tells rows with one id and different texts apart. ``component`` is the same for all rows of a group, whatever
    their ids, and null for rows without words.
    """
    texts = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), text_mark(text_col).alias("mark"), F.col(text_col).alias("text"))
    rows = barrier(
        texts.select("id", "text", "mark").mapInArrow(_describe(size), "id bigint, mark bigint, n bigint, digest binary, sig binary"), "signatures"
    )
    full = rows.where("n > 0")
    # Equal sets are one class. Within a class all else is equal too. Its number is fixed by being written.
    classes = full.groupBy("digest").agg(F.min(F.struct("id", "mark")).alias("head"), F.min("n").alias("n"), F.min("sig").alias("sig"))
    classes = barrier(classes.select("digest", "head", F.monotonically_increasing_id().alias("id"), "n", "sig"), "classes")
    groups = _groups(texts, classes, size, similar).select(F.col("id").alias("rep"), "component")
    grouped = classes.select("digest", F.col("head.id").alias("least"), F.col("id").alias("rep")).join(groups, "rep", "left")
    # Written because the smallest id of each group goes back to all of its classes.
    grouped = barrier(grouped.select(F.col("digest").alias("d"), "least", F.coalesce("component", "rep").alias("component")), "groups")
    least = grouped.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("least"))
    final = grouped.drop("least").join(least, F.col("component") == F.col("c")).select("d", "component", "least")
    out = rows.join(final, F.col("digest") == F.col("d"), "left")
    component = F.coalesce("least", "id")
    shown = lambda c: F.when(c != NO_ID, c)
    return out.select(
        shown(F.col("id")).alias(id_col), F.col("n").alias("n_shingles"), shown(component).alias("component_id"),
        (F.col("id") == component).alias("kept"), "mark", "component",
    )


def _groups(texts: DataFrame, classes: DataFrame, size: int, similar: int) -> DataFrame:
    """``id, component`` of the classes that are linked with any other."""
    bits = F.hex("sig")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS // ROWS - 1)), lambda i: F.xxhash64(i, F.substr(bits, i * 4 * ROWS + 1, F.lit(4 * ROWS))))
    rows = classes.select("id", F.explode(bands).alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("c")).where("c > 1").select(F.col("band").alias("k"))
    members = barrier(rows.join(shared, F.col("band") == F.col("k")).select("band", "id"), "members")
    involved = members.select(F.col("id").alias("c")).distinct()
    heads = classes.select("id", F.col("head.id").alias("i"), F.col("head.mark").alias("m")).join(involved, F.col("id") == F.col("c")).select(F.col("id").alias("rep"), "i", "m")
    # Rows with one id and mark have one text.
    few = texts.join(heads, (F.col("id") == F.col("i")) & (F.col("mark") == F.col("m")))
    few = barrier(few.groupBy(F.col("rep").alias("id")).agg(F.min("text").alias("text")), "texts")
    # u: shingles of a candidate that no other candidate holds.
    alone = few.mapInArrow(_single(size), "id bigint, h bigint").groupBy("h").agg(F.count("*").alias("c"), F.min("id").alias("i"))
    alone = alone.where("c = 1").groupBy("i").agg(F.count("*").alias("u"))
    sizes = classes.select("id", "n").join(alone, F.col("id") == F.col("i")).select("id", "n", "u")
    sizes = sizes.unionByName(classes.join(alone, F.col("id") == F.col("i"), "left_anti").select("id", "n", F.lit(0).cast("bigint").alias("u")))
    possible = barrier(sizes.where(100 * (F.col("n") - F.col("u")) >= similar * F.col("n")).withColumnRenamed("id", "i"), "sizes")
    open_ = members.join(possible, F.col("id") == F.col("i")).select("band", "id", "n", "u")

    j = similar / 100
    least = j - SLACK * (j * (1 - j) / BUCKETS) ** 0.5

    def overlaps(pairs: DataFrame) -> DataFrame:
        """a, b, o and whether they are linked, for the pairs whose registers agree enough."""
        side = lambda x: classes.select(F.col("id").alias(f"i{x}"), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
        close = (
            pairs.join(side("a"), F.col("a") == F.col("ia")).join(side("b"), F.col("b") == F.col("ib"))
            .select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_may_reach(least), "a bigint, b bigint")
        )
        close = barrier(close, "close")
        text = lambda x: few.select(F.col("id").alias(f"i{x}"), F.col("text").alias(f"t{x}"))
        both = close.join(text("a"), F.col("a") == F.col("ia")).join(text("b"), F.col("b") == F.col("ib"))
        found = both.select("a", "b", "ta", "tb").mapInArrow(_overlap(size), "a bigint, b bigint, o bigint")
        n = lambda x: classes.select(F.col("id").alias(f"i{x}"), F.col("n").alias(f"n{x}"))
        found = found.join(n("a"), F.col("a") == F.col("ia")).join(n("b"), F.col("b") == F.col("ib"))
        linked = 100 * F.col("o") >= similar * (F.col("na") + F.col("nb") - F.col("o"))
        return barrier(found.select("a", "b", "o", linked.alias("linked")), "overlaps")

    def joined(known: DataFrame | None, new: DataFrame) -> DataFrame:
        """Components so far with new links; what is known stands as one edge for each member."""
        edges = new if known is None else new.unionAll(known.select(F.col("id").alias("a"), F.col("component").alias("b")))
        return components(edges)

    known, turn = None, 0
    while True:
        turn += 1
        lead = F.min(F.struct(F.col("u") / F.col("n"), F.col("id").alias("leader")))
        leaders = open_.groupBy("band").agg(lead.alias("l"), F.count("*").alias("c")).where("c > 1").select(F.col("band").alias("k"), "l.leader")
        led = barrier(open_.join(leaders, F.col("band") == F.col("k")).where("id <> leader").select("band", "id", "n", "u", "leader"), "led")
        met = overlaps(led.select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct())
        known = joined(known, met.where("linked").select("a", "b"))
        # o: overlap with the leader; r: what the leader lacks and others hold. Both at their most where not measured.
        rest = F.col("n") - F.col("u")
        left = led.join(met, (F.col("id") == F.col("a")) & (F.col("leader") == F.col("b")), "left")
        left = left.select("band", "id", "n", "u", F.coalesce("o", rest).alias("o"), F.coalesce(rest - F.col("o"), rest).alias("r"))
        left = left.join(known.withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left").select("band", "id", "n", "u", "o", "r", F.coalesce("component", "id").alias("comp"))
        left = barrier(left, "left")
        # The best that a member may reach with any other of its bucket.
        most = left.groupBy("band").agg(F.min("n").alias("n0"), F.max("o").alias("o0"), F.max("r").alias("r0")).withColumnRenamed("band", "k")
        best = F.least(rest, F.least("o", "o0") + F.least("r", "r0"))
        left = left.join(most, F.col("band") == F.col("k")).where(100 * best >= similar * (F.col("n") + F.greatest(F.col("n0"), best) - best)).drop("k", "n0", "o0", "r0")
        counts = left.groupBy("band", "comp").agg(F.count("*").alias("c")).groupBy("band").agg(
            F.count("*").alias("comps"), F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("squares"))
        mixed = counts.where("comps > 1").select(F.col("band").alias("k"), ((F.col("all") * F.col("all") - F.col("squares")) / 2 / F.col("all")).alias("work"))
        left = barrier(left.join(mixed, F.col("band") == F.col("k")).drop("k"), "left")
        work, n = left.select(F.sum("work"), F.count("*")).first()
        if not n:
            return known
        if work <= PAIRS_PER_MEMBER * n or turn >= MAX_LEADERS:
            break
        open_ = left.select("band", "id", "n", "u")
    # Every pair across components that the bounds leave open, in the first bucket that both are in.
    buckets = left.groupBy("id").agg(F.collect_set("band").alias("bands")).withColumnRenamed("id", "i")
    left = left.join(buckets, F.col("id") == F.col("i")).drop("i")
    left = left.join(classes.select(F.col("id").alias("i"), "sig"), F.col("id") == F.col("i"))
    names = ["band", "id", "n", "u", "o", "r", "comp", "bands", "sig"]
    one, two = (left.select(*[F.col(c).alias(f"{c}{x}") for c in names]) for x in (1, 2))
    c = lambda name, f: f(F.col(f"{name}1"), F.col(f"{name}2"))
    bound = F.least(F.least(F.col("n1") - F.col("u1"), F.col("n2") - F.col("u2")), c("o", F.least) + c("r", F.least))
    may = (F.col("comp1") < F.col("comp2")) & (100 * bound >= similar * (F.col("n1") + F.col("n2") - bound))
    first = F.array_min(c("bands", F.array_intersect)) == F.col("band1")
    # The estimate without its correction is never below the one with it.
    place = F.sequence(F.lit(0), F.lit(BUCKETS - 1))
    alike = F.filter(place, lambda i: c("sig", lambda a, b: F.substr(a, 2 * i + 1, F.lit(2)) == F.substr(b, 2 * i + 1, F.lit(2))))
    rest = one.join(two, (F.col("band1") == F.col("band2")) & may & first & (F.size(alike) >= least * BUCKETS))
    rest = rest.select(c("id", F.greatest).alias("a"), c("id", F.least).alias("b"))
    return joined(known, overlaps(rest).where("linked").select("a", "b"))


@query(
    "op5_near_dedup",
    r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    i AS (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS j FROM w WHERE len(ws) > 0),
    s AS (SELECT DISTINCT doc_id, array_to_string(ws[j:j + 4], ' ') AS shingle FROM i),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id WHERE r.c < e.b),
    g AS (SELECT id, min(c) AS c FROM r GROUP BY 1)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN g ON g.id = d.doc_id""",
)
def op5_near_dedup(spark, sf_dir):
    """All documents; shingles of five words, similarity of 0.75 or more."""
    return near_dedup(read(spark, sf_dir, "documents")).drop("mark", "component")
