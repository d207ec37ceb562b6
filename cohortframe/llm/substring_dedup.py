"""Removal of passages that repeat across documents, by super-k-mers.

A window is ``width`` consecutive words of one document; its minimiser is the pair of neighbouring words in it with the
smallest hash. Consecutive windows with one minimiser form a super-k-mer, whose words travel once, as one string, to the
minimiser's bucket. There the windows are cut out again, sorted and counted: each window that a document with a smaller
id holds as well is sent back as a flag, and each document drops the words that flagged windows cover.

Hot passages: a task first counts the windows of its own chunk of documents. Only those of the smallest document of the
chunk travel; the others are flagged at once. So a passage costs a bucket at most one window for each chunk, however many
documents hold it. The strings of a chunk for one bucket are compressed together.

Hot minimisers: a sample of the documents tells which minimisers stand for more windows than a task should hold. Their
windows are dealt by the bits of the whole window instead, so equal windows still meet and different ones do not. The
sample decides the dealing only, never a result. It grows with the texts (``SAMPLE_SHARE`` of them at least), and so does,
beyond ``MOST_HOT`` times ``HOT_WINDOWS`` windows, what counts as hot: the list of hot minimisers stays below ``MOST_HOT``.

Buckets follow from the size of the texts, shuffle partitions do not beyond ``MOST_PARTITIONS`` (or the session's number, if
that is larger): a partition takes the packs of many buckets, sorted, and judges them one after another.

Windows are sorted by 64 bits, and equal bits count only if the words themselves are equal.

Null and short texts have no windows and lose nothing. Rows with one id do not count as each other's copies; rows equal
in id and text are treated alike. A null id counts as larger than any other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.base import query, read, rows_per_group, text_mark

WIDTH, CORE = 13, 2
#: Text that a task holds at once, and text that one bucket stands for.
CHUNK_BYTES, BUCKET_BYTES = 8_000_000, 4_000_000
#: Windows of one minimiser beyond which they are dealt one by one, and text of the sample that tells.
HOT_WINDOWS, SAMPLE_BYTES, SAMPLE_SHARE = 1_000_000, 32_000_000, 0.002
#: Hot minimisers that the driver and the tasks hold at most, and shuffle partitions where the session does not ask for more.
MOST_HOT, MOST_PARTITIONS = 1 << 20, 1 << 13
NO_ID = 2**63 - 1
BLOCK_WORDS = 100_000
#: Parts strings in a pack; no byte of a text has this value.
PART = 0xFF
_BASE = 0x9E3779B97F4A7C15

SENT = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("words", pa.binary())])
FLAGS = pa.schema([("key", pa.int64()), ("mark", pa.int64()), ("runs", pa.binary())])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _words(raw: np.ndarray, bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64 bits of each word of a run of bytes; ``bounds`` are places where texts begin."""
    solid = (raw != 32) & ((raw < 9) | (raw > 13)) & (raw != PART)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    if bounds is not None:
        begins[bounds] |= solid[bounds]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    # A word ends before white space, or where the next text begins.
    span = np.diff(starts, append=len(raw))
    size = np.add.reduceat(solid, starts, dtype=np.int64)
    factor = _mix(np.arange(1, int(span.max()) + 1, dtype=np.uint64)) | np.uint64(1)
    hashes = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), BLOCK_WORDS):  # by blocks, since this takes many bytes for each byte of text
        b = min(a + BLOCK_WORDS, len(starts))
        low, high = starts[a], starts[b - 1] + span[b - 1]
        value = raw[low:high].astype(np.uint64)
        value += np.uint64(1)
        value *= factor[np.arange(high - low) - np.repeat(starts[a:b] - low, span[a:b])]
        value *= solid[low:high]
        hashes[a:b] = np.add.reduceat(value, starts[a:b] - low)
    return starts, starts + size, _mix(hashes)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and those of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(n, np.uint64(base))
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """64 bits of each run of ``width`` words (also of those that cross texts, which are left out later)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(len(h))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)])
    return _mix((total[width:] - total[:-width]) * down[:n])


def _groups(raw: bytes, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the windows (bytes from begin to end), and in that order the number of the group of equal windows."""
    order = np.argsort(hashes)
    in_order = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = in_order[1:] != in_order[:-1]
    same = np.flatnonzero(~new)
    if len(same):
        view = memoryview(raw)
        a0, a1 = begin[order[same]].tolist(), end[order[same]].tolist()
        b0, b1 = begin[order[same - 1]].tolist(), end[order[same - 1]].tolist()
        # White space inside may differ where the bytes do.
        differ = [
            k for k, (p, q, r, s) in enumerate(zip(a0, a1, b0, b1))
            if view[p:q] != view[r:s] and raw[p:q].split() != raw[r:s].split()
        ]
        if differ:  # equal bits of different windows: sort those by their words
            mixed = np.unique(in_order[same[differ]])
            at = np.flatnonzero(np.isin(in_order, mixed))
            text = {int(i): (int(hashes[i]), raw[begin[i] : end[i]].split()) for i in order[at]}
            order[at] = sorted(order[at].tolist(), key=text.__getitem__)
            new[at] = [k == 0 or order[k - 1] not in text or text[int(order[k - 1])] != text[int(order[k])] for k in at.tolist()]
    return order, np.cumsum(new) - 1


def _later(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Marks the windows (in group order) of a group that has a smaller key."""
    if not len(group):
        return np.zeros(0, bool)
    least = np.minimum.reduceat(key, np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])))
    return key > least[group]


def _runs(key: np.ndarray, mark: np.ndarray, where: np.ndarray) -> tuple[list, list, list]:
    """Flags of each document as runs (first window, number of windows); sorted by document and place."""
    by = np.lexsort((where, mark, key))
    key, mark, where = key[by], mark[by], where[by]
    other = np.concatenate([[True], (np.diff(key) != 0) | (np.diff(mark) != 0)])
    fresh = np.flatnonzero(other | np.concatenate([[True], np.diff(where) != 1]))
    runs = np.stack([where[fresh], np.diff(fresh, append=len(where))], 1).astype(np.int32)
    cuts = np.append(np.flatnonzero(other[fresh]), len(fresh))
    first = fresh[cuts[:-1]]
    return key[first].tolist(), mark[first].tolist(), [runs[a:b].tobytes() for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def _pack_info(info: np.ndarray) -> bytes:
    """Columns one after another; ids as differences, which are small."""
    out = info.copy()
    out[1:, 0] = np.diff(info[:, 0])
    return np.ascontiguousarray(out.T).view(np.uint8).reshape(4, -1, 8).transpose(0, 2, 1).tobytes()


def _unpack_info(data: bytes) -> np.ndarray:
    out = np.frombuffer(data, np.uint8).reshape(4, 8, -1).transpose(0, 2, 1)
    out = np.ascontiguousarray(out).view(np.int64).reshape(4, -1).T.copy()
    out[:, 0] = np.cumsum(out[:, 0])
    return out


def _minimisers(h: np.ndarray, width: int, core: int) -> np.ndarray:
    """The smallest 64 bits of ``core`` neighbouring words of each window, by doubling steps."""
    least = _window_hashes(h, core)
    have, want = 1, width - core + 1
    while have < want:
        step = min(have, want - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return least


def _cut_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and where each begins (and the last ends)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if offsets[0] == offsets[-1]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _count(column: pa.Array, width: int, core: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimisers of the texts and the number of windows of each."""
    raw, offsets = _cut_out(column)
    begin, _, h = _words(raw, offsets[:-1][np.diff(offsets) > 0]) if len(raw) else (raw, raw, raw)
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    owner = np.searchsorted(offsets, begin, "right") - 1
    return np.unique(_minimisers(h, width, core)[owner[:n] == owner[width - 1 :]], return_counts=True)


class Sender:
    """Super-k-mers of chunks of documents by bucket, and the flags that a chunk settles itself (negative buckets)."""

    def __init__(self, buckets: int, width: int, core: int, hot: tuple[int, ...] = ()):
        import zstandard

        self.buckets, self.width, self.core = buckets, width, core
        self.hot = np.array(hot, np.int64).view(np.uint64)
        self.press = zstandard.ZstdCompressor(level=7).compress

    def send(self, key: np.ndarray, mark: np.ndarray, column: pa.Array) -> Iterator[pa.RecordBatch]:
        width, buckets = self.width, self.buckets
        raw, offsets = _cut_out(column)
        if not len(raw):
            return
        begin, end, h = _words(raw, offsets[:-1][np.diff(offsets) > 0])
        n = len(h) - width + 1
        if n <= 0:
            return
        owner = np.searchsorted(offsets, begin, "right") - 1
        first = np.searchsorted(begin, offsets[:-1])
        starts = np.flatnonzero(owner[:n] == owner[width - 1 :])
        if not len(starts):
            return
        data = raw.tobytes()
        hashes = _window_hashes(h, width)[starts]
        order, group = _groups(data, begin[starts], end[starts + width - 1], hashes)
        later = np.zeros(len(starts), bool)
        later[order] = _later(group, key[owner[starts[order]]])
        gone = starts[later]
        if len(gone):
            docs = owner[gone]
            keys, marks, runs = _runs(key[docs], mark[docs], gone - first[docs])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([-1 - (k + m) % buckets for k, m in zip(keys, marks)], pa.int32()),
                    pa.array([np.array(x, np.int64).tobytes() for x in zip(keys, marks)], pa.binary()), pa.array(runs, pa.binary()),
                ],
                schema=SENT,
            )
        stay = starts[~later]
        if not len(stay):
            return
        least = _minimisers(h, width, self.core)[stay]
        if len(self.hot):
            least = np.where(np.isin(least, self.hot), hashes[~later], least)
        # A super-k-mer: neighbouring windows of one document with the same minimiser.
        cuts = np.flatnonzero(np.concatenate([[True], (np.diff(stay) != 1) | (least[1:] != least[:-1]) | (np.diff(owner[stay]) != 0), [True]]))
        word, count = stay[cuts[:-1]], np.diff(cuts)
        bucket = (least[cuts[:-1]] % np.uint64(buckets)).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        bucket, word, count = bucket[by], word[by], count[by]
        info = np.stack([key[owner[word]], mark[owner[word]], word - first[owner[word]], count], 1)
        text = [data[a:b] for a, b in zip(begin[word].tolist(), end[word + count + width - 2].tolist())]
        ends = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0, [True]])).tolist()
        press, part = self.press, bytes([PART])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[ends[:-1]], pa.int32()),
                pa.array([press(_pack_info(info[a:b])) for a, b in zip(ends, ends[1:])], pa.binary()),
                pa.array([press(part.join(text[a:b])) for a, b in zip(ends, ends[1:])], pa.binary()),
            ],
            schema=SENT,
        )


def _judge(parts: list[tuple[bytes, bytes]], width: int) -> pa.RecordBatch | None:
    """The flags of one bucket. A chunk sends all it has for a bucket at once and has settled its own windows."""
    import zstandard

    if len(parts) < 2:
        return None
    unpress = zstandard.ZstdDecompressor().decompress
    info = np.concatenate([_unpack_info(unpress(a)) for a, _ in parts])
    data = bytes([PART]).join(unpress(b) for _, b in parts)
    begin, end, h = _words(np.frombuffer(data, np.uint8))
    counts = info[:, 3]
    sizes = counts + width - 1
    first = np.cumsum(sizes) - sizes
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    source = np.repeat(np.arange(len(info)), counts)
    starts = first[source] + nth
    order, group = _groups(data, begin[starts], end[starts + width - 1], _window_hashes(h, width)[starts])
    later = _later(group, info[source[order], 0])
    gone = order[later]
    if not len(gone):
        return None
    who = source[gone]
    keys, marks, runs = _runs(info[who, 0], info[who, 1], info[who, 2] + nth[gone])
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(marks, pa.int64()), pa.array(runs, pa.binary())], schema=FLAGS)


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text (column 2), one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most)))
        yield batch.slice(at, end - at)
        at = end


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, core: int = CORE,
    buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES, hot_windows: int = HOT_WINDOWS, most_partitions: int = MOST_PARTITIONS,
) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_text.

    ``buckets`` follows from the size of the texts where it is not given.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("key"), text_mark(text_col).alias("mark"),
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
    )
    size = docs.agg(F.sum(F.octet_length(F.coalesce(text_col, F.lit(""))))).first()[0] or 0
    if buckets is None:
        buckets = rows_per_group(size, BUCKET_BYTES)
    partitions = min(buckets, max(most_partitions, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, chunk_bytes):
                least, n = _count(part.column(2), width, core)
                yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64), pa.int64()), pa.array(n, pa.int64())], names=["least", "n"])

    every = rows_per_group(size, max(SAMPLE_BYTES, int(size * SAMPLE_SHARE)))
    sample = rows.select("key", "mark", "text").where(F.pmod("mark", F.lit(every)) == 0).mapInArrow(count, "least bigint, n bigint")
    # A window takes two bytes of text at least, so fewer than MOST_HOT minimisers can pass the second bound.
    bound = max(hot_windows, size // 2 // MOST_HOT)
    hot = tuple(r["least"] for r in sample.groupBy("least").agg(F.sum("n").alias("n")).where(F.col("n") * every > bound).collect())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets, width, core, hot)
        for batch in batches:
            for part in _slices(batch, chunk_bytes):
                yield from sender.send(*(part.column(i).to_numpy() for i in range(2)), part.column(2))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for bucket, a, b in zip(*(x.to_pylist() for x in batch.columns)):
                if bucket < 0:  # settled before
                    key, mark = np.frombuffer(a, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([mark], pa.int64()), pa.array([b], pa.binary())], schema=FLAGS)
                    continue
                if bucket != now and parts:
                    flags = _judge(parts, width)
                    if flags is not None:
                        yield flags
                    parts = []
                now = bucket
                parts.append((a, b))
        if parts:
            flags = _judge(parts, width)
            if flags is not None:
                yield flags

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_gone, kept = [], [], []
            for text, flags in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                if flags:
                    runs = np.frombuffer(b"".join(flags), np.int32).reshape(-1, 2)
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, runs[:, 0], 1)
                    np.add.at(edge, runs[:, 0] + runs[:, 1] + width - 1, -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                n_gone.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, pa.string())],
                names=[id_col, "n_words", "n_removed", "kept_text"],
            )

    sent = rows.select("key", "mark", "text").mapInArrow(send, "bucket int, docs binary, words binary")
    dealt = sent.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    flags = dealt.mapInArrow(judge, "key bigint, mark bigint, runs binary")
    flags = flags.groupBy("key", "mark").agg(F.collect_list("runs").alias("flags"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return (
        rows.join(flags, ["key", "mark"], "left")
        .select("id", "text", "flags")
        .mapInArrow(cut, f"`{id_col}` {id_type}, n_words bigint, n_removed bigint, kept_text string")
    )


@query(
    "op9_substring_dedup",
    r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    i AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS j FROM w WHERE len(ws) >= 13),
    v AS (SELECT doc_id, j, array_to_string(ws[j:j + 12], ' ') AS k FROM i),
    f AS (SELECT k, min(doc_id) AS first FROM v GROUP BY 1),
    b AS (SELECT DISTINCT doc_id, unnest(range(j, j + 13)) AS pos FROM v JOIN f USING (k) WHERE first < doc_id),
    x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
    t AS (SELECT x.doc_id, count(b.pos) AS gone, string_agg(word, ' ' ORDER BY x.pos) FILTER (b.pos IS NULL) AS kept
        FROM x LEFT JOIN b ON b.doc_id = x.doc_id AND b.pos = x.pos GROUP BY 1)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN t ON t.doc_id = w.doc_id""",
)
def op9_substring_dedup(spark, sf_dir):
    """All documents; windows of 13 words."""
    out = substring_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
