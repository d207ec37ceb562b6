"""Bounded-space online packing of documents into training sequences.

A task tokenises the documents of its partition and keeps at most ``windows`` open sequences. A document longer than a
sequence gives whole sequences and a rest. A rest goes into the open sequence that it fills best. Where none has room and
no more may be opened, the head of the rest tops up the fullest one, which is emitted, and the tail goes on. What is open
at the end of a partition is merged with that of other partitions, a bounded number of them in a task, round by round.
Only the sequence that is last of all keeps padding, besides gaps of fewer than ``least_cut`` ids.

Null text is empty: a document of its end id alone. Every row is a document of its own, repeated ones too. Texts of any
length are processed whole. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.base import query, read
from cohortframe.session import barrier

LENGTH, END_ID = 2048, 1
#: Open sequences of a task; partitions whose leftovers meet in one task of a merge round.
WINDOWS, FAN_IN = 16, 32
LEAST_CUT = 8
#: Text that is encoded at a time.
SLICE_BYTES = 4_000_000

OUT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "ids binary, part bigint"
)
_KINDS = {
    "doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(), "offset": pa.int64(), "ids": pa.binary(), "part": pa.int64(),
}


# Classes of bytes; within a text of these classes a token never crosses from one class to another.
_OTHER, _LETTER, _DIGIT, _MARK, _SPACE, _LINE, _EDGE, _QUOTE = range(8)
_CLASS = np.full(256, _OTHER, np.uint8)
for _b in range(33, 127):
    _CLASS[_b] = _LETTER if chr(_b).isalpha() else _DIGIT if chr(_b).isdigit() else _QUOTE if chr(_b) == "'" else _MARK
_CLASS[32], _CLASS[10] = _SPACE, _LINE
#: What may stand beside a space or a line feed that is a bound.
_SOLID = np.isin(np.arange(8), [_LETTER, _DIGIT, _MARK, _QUOTE])


def _classes(raw: np.ndarray) -> np.ndarray:
    """The class of each byte; two-byte Latin letters (U+00C0 to U+023F without the two signs) are letters."""
    cls = _CLASS[raw]
    lead = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC8))
    lead = lead[lead + 1 < len(raw)]
    sign = (raw[lead] == 0xC3) & ((raw[lead + 1] == 0x97) | (raw[lead + 1] == 0xB7))
    lead = lead[~sign]
    cls[lead] = cls[lead + 1] = _LETTER
    return cls


class PieceRanks:
    """Ids of single regular pieces (a run of one class behind at most one space, or a line feed) by merge ranks."""

    def __init__(self, told: dict):
        import tiktoken

        # Byte-level files write each byte as a printable character.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte_of[c] for c in w): i for w, i in told["model"]["vocab"].items() if all(c in byte_of for c in w)}
        self.encoding = tiktoken.Encoding("pieces", pat_str="[^\\x00]+", mergeable_ranks=ranks, special_tokens={})
        self.bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.bytes[list(ranks.values())] = [len(w) for w in ranks]

    @staticmethod
    def fit(told: dict) -> bool:
        """Whether the file is a plain byte-level one whose numbers follow its merges, so that ranks give the same ids."""
        model, first = told["model"], told.get("pre_tokenizer") or {}
        join = lambda m: "".join(m if isinstance(m, list) else m.split(" "))
        odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        return (
            model.get("type") == "BPE" and not told.get("normalizer") and first.get("type") == "ByteLevel" and not odd
            and not first.get("add_prefix_space") and first.get("use_regex", True)
            and all(model["vocab"].get(join(m)) == 256 + i for i, m in enumerate(model.get("merges") or []))
        )

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each piece has."""
        ids = np.array(self.encoding.encode_ordinary(b"\0".join(pieces).decode()), np.uint32)
        ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum([len(p) for p in pieces])) + 1
        return ids, np.diff(ends, prepend=0)


class Encoder:
    """Ids of whole texts. Texts are cut where no token can cross: at single spaces and line feeds between solid
    characters, and between letters, digits and marks. The distinct pieces of a chunk are looked up by 64 bits among those
    seen before (a bounded number); new regular ones are encoded by rank, all others by the tokenizer itself. A text with a
    control token goes to the tokenizer as a whole."""

    def __init__(self, tokenizer: str, keep: int = 1_500_000):
        from tokenizers import Tokenizer

        told = json.loads(tokenizer)
        self.tokenizer, self.keep = Tokenizer.from_str(tokenizer), keep
        self.control = [t["content"] for t in told.get("added_tokens") or []]
        self.ranks = PieceRanks(told) if PieceRanks.fit(told) else None
        self._forget()

    def _forget(self) -> None:
        self.keys, self.start, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[bytes], regular: np.ndarray) -> None:
        """Adds pieces that are not known."""
        if len(self.keys) + len(keys) > self.keep:
            self._forget()
        order = np.argsort(~regular, kind="stable")
        n = int(regular.sum()) if self.ranks else 0
        parts, sizes = [self.ids], []
        if n:
            ids, size = self.ranks.encode([pieces[i] for i in order[:n].tolist()])
            parts.append(ids)
            sizes.append(size)
        for at in range(n, len(order), 20_000):
            texts = [pieces[i].decode() for i in order[at : at + 20_000].tolist()]
            got = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            parts += [np.array(x, np.uint32) for x in got]
            sizes.append(np.array([len(x) for x in got], np.int64))
        size = np.concatenate(sizes).astype(np.int64)
        keys = np.concatenate([self.keys, keys[order]])
        start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        size = np.concatenate([self.size, size])
        by = np.argsort(keys)
        self.keys, self.start, self.size, self.ids = keys[by], start[by], size[by], np.concatenate(parts)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where those of each text begin (one more than texts)."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        rows = len(column)
        bounds = np.zeros(rows + 1, np.int64)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + rows + 1]
        if not rows or offsets[0] == offsets[-1]:
            return np.empty(0, np.uint32), bounds
        raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        first = offsets[:-1][np.diff(offsets) > 0]
        cls = _classes(raw)
        if self.control:
            held = pc.match_substring(column, self.control[0])
            for token in self.control[1:]:
                held = pc.or_(held, pc.match_substring(column, token))
            for i in np.flatnonzero(held.to_numpy(zero_copy_only=False)):
                cls[offsets[i] : offsets[i + 1]] = _OTHER
        before, after = np.empty_like(cls), np.empty_like(cls)
        before[1:], after[:-1] = cls[:-1], cls[1:]
        before[first], after[np.append(first[1:], len(raw)) - 1] = _EDGE, _EDGE
        between = _SOLID[before] & _SOLID[after]
        line = (cls == _LINE) & between
        cut = ((cls == _SPACE) & between) | line
        cut[1:] |= line[:-1]
        cut |= (cls != before) & (cls >= _LETTER) & (cls <= _MARK) & (before >= _LETTER) & (before <= _MARK)
        cut[first] = True
        starts = np.flatnonzero(cut)
        length = np.diff(starts, append=len(raw))
        bad = (cls == _OTHER) | (cls == _QUOTE) | (((cls == _SPACE) | (cls == _LINE)) & ~cut)
        head = cls[starts]
        regular = (np.add.reduceat(bad, starts, dtype=np.int64) == 0) & ~((head == _SPACE) & (length == 1)) & ~((head == _LINE) & (length > 1))
        # 64 bits of each piece: bytes times odd numbers by place.
        place = np.arange(len(raw), dtype=np.int64) - np.repeat(starts, length)
        factor = _mix(np.arange(1, int(length.max()) + 1, dtype=np.uint64)) | np.uint64(1)
        keys = _mix(np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * factor[place], starts))
        coded = pa.array(keys).dictionary_encode()
        code, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy()
        example = np.empty(len(distinct), np.int64)
        example[code[::-1]] = np.arange(len(code))[::-1]

        def unknown() -> np.ndarray:
            if not len(self.keys):
                return np.ones(len(distinct), bool)
            return self.keys[np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)] != distinct

        new = unknown()
        if len(self.keys) + new.sum() > self.keep:
            self._forget()
            new[:] = True
        if new.any():
            at, data = example[new], raw.tobytes()
            pieces = [data[a : a + n] for a, n in zip(starts[at].tolist(), length[at].tolist())]
            self._learn(distinct[new], pieces, regular[at])
        row = np.searchsorted(self.keys, distinct)[code]
        n = self.size[row]
        ends = np.cumsum(n)
        take = np.repeat(self.start[row] - (ends - n), n) + np.arange(ends[-1])
        # Texts end where their last piece ends; empty texts have no piece.
        bounds[1:] = np.concatenate([[0], ends])[np.searchsorted(starts, offsets[1:])]
        return self.ids[take], bounds


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Packer:
    """The open sequences of one task. Pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, part: int, level: int, length: int, windows: int, least_cut: int):
        self.next, self.length, self.windows, self.least_cut, self.part = (level << 56) | (part << 32), length, windows, least_cut, part
        self.open: list[list] = []  # [ids used, pieces]
        self.rows: dict[str, list] = {k: [] for k in _KINDS}

    def emit(self, pieces: list[tuple], keep_ids: bool = False) -> None:
        offset, r = 0, self.rows
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            for name, value in zip(_KINDS, (doc, start, n, zlib.crc32(ids), total, self.next, offset, ids if keep_ids else None, self.part)):
                r[name].append(value)
            offset += n
        self.next += 1

    def add(self, doc: int | None, start: int, ids: bytes, total: int) -> None:
        full, n = self.length * 4, len(ids)
        at = 0
        while n - at >= full:
            self.emit([(doc, start + at // 4, ids[at : at + full], total)])
            at += full
        while at < n:
            need = (n - at) // 4
            fit = max((w for w in self.open if w[0] + need <= self.length), key=lambda w: w[0], default=None)
            if fit is None and len(self.open) < self.windows:
                fit = [0, []]
                self.open.append(fit)
            if fit is None:
                fullest = max(self.open, key=lambda w: w[0])
                self.open.remove(fullest)
                gap = self.length - fullest[0]
                if gap >= self.least_cut and need - gap >= self.least_cut:
                    fullest[1].append((doc, start + at // 4, ids[at : at + gap * 4], total))
                    at += gap * 4
                self.emit(fullest[1])
                continue
            fit[1].append((doc, start + at // 4, ids[at:], total))
            fit[0] += need
            if fit[0] == self.length:
                self.open.remove(fit)
                self.emit(fit[1])
            return

    def merge(self) -> None:
        """Close all: fill the fullest from the emptiest, cutting freely, so that one sequence at most is not full."""
        rest = sorted(self.open, key=lambda w: -w[0])
        self.open = []
        while rest:
            most = rest.pop(0)
            while most[0] < self.length and rest:
                doc, start, ids, total = rest[-1][1].pop()
                take = min(self.length - most[0], len(ids) // 4)
                # The head goes over, so that the tail stays one piece.
                most[1].append((doc, start, ids[: take * 4], total))
                most[0] += take
                rest[-1][0] -= take
                if take * 4 < len(ids):
                    rest[-1][1].append((doc, start + take, ids[take * 4 :], total))
                if not rest[-1][1]:
                    rest.pop()
            self.emit(most[1])

    def leave(self) -> None:
        for _, pieces in self.open:
            self.emit(pieces, keep_ids=True)
        self.open = []

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, {k: [] for k in _KINDS}
        return pa.RecordBatch.from_arrays([pa.array(rows[k], t) for k, t in _KINDS.items()], names=list(_KINDS))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE_BYTES`` of text, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES)))
        yield batch.slice(at, end - at)
        at = end


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    end_id: int = END_ID, windows: int = WINDOWS, least_cut: int = LEAST_CUT, fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file; the driver reads it and ships the content.
    """
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    end = np.array([end_id], "<u4").tobytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(content)
        packer = Packer(TaskContext.get().partitionId(), 0, length, windows, least_cut)
        for batch in batches:
            for some in _slices(batch):
                flat, bounds = encoder.encode(some.column(1))
                for doc, a, b in zip(some.column(0).to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                    packer.add(doc, 0, flat[a:b].tobytes() + end, b - a + 1)
                yield packer.batch()
        packer.leave()
        yield packer.batch()

    def again(level: int, last: bool):
        def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            packer = Packer(key[0].as_py(), level, length, windows, least_cut)
            table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
            pieces = zip(*(table[k].to_pylist() for k in ("doc_id", "start", "ids", "doc_tokens")))
            for piece in sorted(pieces, key=lambda p: -len(p[2])):
                packer.add(*piece)
            packer.merge() if last else packer.leave()
            return pa.Table.from_batches([packer.batch()])

        return merge

    step = barrier(docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(first, OUT), "packed")
    # Partitions are numbered, so their count is an upper bound for the rounds that are needed.
    parts = (step.agg(F.max("part")).first()[0] or 0) + 1
    done, level = [step.where("ids IS NULL")], 0
    left = step.where("ids IS NOT NULL")
    while True:
        level, parts = level + 1, -(-parts // fan_in)
        key = F.floor(F.col("part") / fan_in).cast("bigint")
        step = left.groupBy(key.alias("g")).applyInArrow(again(level, parts == 1), OUT)
        if parts == 1:
            done.append(step)
            break
        step = barrier(step, "packed")
        done.append(step.where("ids IS NULL"))
        left = step.where("ids IS NOT NULL")
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(F.col("doc_id").alias(id_col), *names)


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_packing")
def op10_packing(spark, sf_dir):
    """All documents in sequences of 2048."""
    return pack(read(spark, sf_dir, "documents"), public_tokenizer())
