"""Token counts of whole texts by rank-synchronous merging on ragged arrays.

A task cuts the texts of its partition into pre-tokens. Those it has not met yet become one ragged numpy array: the
symbols of all of them one after another, with the place where each begins. In every round each sequence applies its own
lowest-rank pair, at all places where it stands and in all sequences at once; sequences without a pair that can merge
leave the array. What survives are the tokens, and a text has the sum over its pre-tokens.

A single pre-token of more than ``LONG`` bytes (a text without any break) would keep the rounds going over its whole
length. Its pairs wait in lists by rank instead, and a round touches only the places of the rank at hand: the same merges
in the same order.

Null text is empty: no tokens, no bytes. Texts of any length are counted whole, in stretches of bounded size cut where no
pre-token can cross. Every row is counted for itself, so ids may be null or repeat. An empty table gives an empty result.
Strings of added tokens inside a text count as that one token, which is the library's default. Nothing is shuffled: a
lost executor costs its tasks only.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.base import query, read
from cohortframe.llm.packing import public_tokenizer

LIMIT = 512
#: Characters of text that are cut into pre-tokens at a time.
STRETCH = 2_000_000
#: Bytes of a pre-token from which its pairs wait by rank.
LONG = 2_048
#: Pre-tokens whose count a task remembers; beyond, it starts to remember anew. Longer ones are counted each time.
REMEMBERED, REMEMBERED_CHARS = 400_000, 64

#: Fixed value: the pattern by which byte-level vocabularies cut texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Between two of these characters a single space always begins a pre-token.
SAFE_CUT = r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])"
NONE = np.iinfo(np.int64).max


class Merges:
    """The merges of a byte-level vocabulary: the rank of a pair of symbols and the symbol that it becomes."""

    def __init__(self, told: dict):
        model, first = told["model"], told.get("pre_tokenizer") or {}
        odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "unk_token", "byte_fallback", "ignore_merges")
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in odd) and not told.get("normalizer")
        if not plain or first.get("type") != "ByteLevel" or first.get("add_prefix_space") or not first.get("use_regex", True):
            raise ValueError("only plain byte-level vocabularies are counted")
        self.added = [t["content"] for t in told.get("added_tokens") or []]
        if any(t.get(k) for t in told.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in their surroundings are not counted")
        # Such files write each byte as a printable character.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        vocab = model["vocab"]
        self.of_byte = np.array([vocab[char[b]] for b in range(256)], np.int64)
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        a, b, to = (np.array([vocab[s] for s in part], np.int64) for part in ([p[0] for p in pairs], [p[1] for p in pairs], [p[0] + p[1] for p in pairs]))
        self.width = max(vocab.values()) + 1
        made = np.full(self.width, -1, np.int64)
        made[to[::-1]] = np.arange(len(to))[::-1]
        if (np.maximum(made[a], made[b]) >= np.arange(len(to))).any():
            raise ValueError("a merge uses a symbol that only a later one makes")
        order = np.argsort(a * self.width + b, kind="stable")
        self.keys, self.rank, self.to = (a * self.width + b)[order], order, to

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where it does not merge."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that survive in each of the pieces."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = np.zeros(len(pieces), np.int64)
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = self.count_long(self.of_byte[np.frombuffer(pieces[i], np.uint8)])
        own = np.flatnonzero((size > 0) & (size <= LONG))
        size = size[own]
        symbols = self.of_byte[np.frombuffer(b"".join([pieces[i] for i in own.tolist()]), np.uint8)]
        while len(own):
            ends = np.cumsum(size)
            starts = ends - size
            rank = np.full(len(symbols), NONE)
            rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
            rank[ends - 1] = NONE
            low = np.minimum.reduceat(rank, starts)
            going = low < NONE
            out[own[~going]] = size[~going]
            lowest = np.repeat(low, size)
            hit = every_other((rank == lowest) & (rank < NONE))
            symbols[hit] = self.to[rank[hit]]
            stays = np.repeat(going, size)
            stays[1:] &= ~hit[:-1]
            size = np.add.reduceat(stays, starts, dtype=np.int64)[going]
            symbols, own = symbols[stays], own[going]
        return out

    def count_long(self, symbols: np.ndarray) -> int:
        """Symbols that survive in one long sequence, rank after rank over the places that wait for it."""
        n = len(symbols)
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        waiting: dict[int, list] = {}
        queue: list[int] = []

        def wait(at: np.ndarray) -> None:
            rank = self.ranks(symbols[at], symbols[after[at]])
            at, rank = at[rank < NONE], rank[rank < NONE]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            bounds = np.flatnonzero(np.diff(rank, prepend=-1))
            for r, places in zip(rank[bounds].tolist(), np.split(at, bounds[1:])):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(places)

        wait(np.arange(n - 1))
        pair = np.empty(len(self.keys), np.int64)
        pair[self.rank] = self.keys
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[alive[at] & (after[at] < n)]
            at = at[symbols[at] * self.width + symbols[after[at]] == pair[r]]
            # Places in a row share a symbol: every other one merges, from the left.
            chained = np.zeros(len(at), bool)
            chained[1:] = after[at[:-1]] == at[1:]
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
            at = at[run % 2 == 0]
            gone = after[at]
            symbols[at], alive[gone], after[at] = self.to[r], False, after[gone]
            beyond = after[at]
            before[beyond[beyond < n]] = at[beyond < n]
            left = before[at]
            wait(np.unique(np.concatenate([left[left >= 0], at[beyond < n]])))
        return int(alive.sum())


def every_other(hit: np.ndarray) -> np.ndarray:
    """Of each run of marked places the first, third and so on: pairs that share a symbol merge from the left."""
    place = np.arange(len(hit))
    last_off = np.maximum.accumulate(np.where(hit, -1, place))
    return hit & ((place - last_off) % 2 == 1)


@lru_cache
def odd_characters(splitter: str) -> str:
    """Characters that the pattern and the tokenizer library do not put in the same class (letter, number, space, other).

    Their Unicode versions may differ. Asked are all characters that either could call a letter, number or space.
    """
    import unicodedata

    import regex
    from tokenizers import Tokenizer

    cut = Tokenizer.from_str(splitter).pre_tokenizer
    kinds = regex.compile(r"[\p{L}\p{N}\s]")
    chars = [c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if kinds.match(c) or unicodedata.category(c)[0] in "LNZ"]
    pattern, odd = regex.compile(PATTERN), []
    for at in range(0, len(chars), 20_000):
        some = chars[at : at + 20_000]
        # Behind a letter, a number and a mark each class is cut in its own way.
        text = "".join(f"a{c}1{c}!{c}." for c in some)
        width = len(text) // len(some)
        mine = {m.start() for m in pattern.finditer(text)}
        theirs = {a for _, (a, _) in cut.pre_tokenize_str(text)}
        odd += {some[p // width] for p in mine ^ theirs}
    return "".join(sorted(set(odd)))


class Counter:
    """Counts tokens of texts; remembers the counts of pre-tokens it has met."""

    def __init__(self, merges: Merges, odd: str, splitter: str):
        self.merges, self.odd, self.splitter = merges, frozenset(odd), splitter
        self.known: dict[str, int] = {}

    @cached_property
    def pattern(self):
        import regex

        return regex.compile(PATTERN)

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.splitter).pre_tokenizer

    @cached_property
    def added_pattern(self):
        import regex

        # The longest of those that begin at one place.
        return regex.compile("|".join(map(regex.escape, sorted(self.merges.added, key=len, reverse=True))))

    @cached_property
    def cut_pattern(self):
        import regex

        return regex.compile(SAFE_CUT)

    def pre_tokens(self, text: str) -> list[str]:
        if not (text.isascii() or self.odd.isdisjoint(text)):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def stretches(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > STRETCH and (found := self.cut_pattern.search(text, at + STRETCH)):
            yield text[at : found.start()]
            at = found.start()
        yield text[at:] if at else text

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        parts: list[list[list[str]]] = []
        out, held = [], 0

        def settle() -> None:
            nonlocal held
            out.extend(self._sums(parts))
            parts.clear()
            held = 0

        for text in texts:
            special = 0
            if self.merges.added and self.added_pattern.search(text):
                pieces = self.added_pattern.split(text)
                special = len(pieces) - 1
            else:
                pieces = [text]
            if len(text) > STRETCH:
                settle()
                total = sum(self._sums([[self.pre_tokens(s)]])[0] for piece in pieces for s in self.stretches(piece))
                out.append(total + special)
                continue
            if held + len(text) > STRETCH:
                settle()
            held += len(text)
            # A special string is one token: the empty pre-token stands for it.
            parts.append([self.pre_tokens(p) for p in pieces] + [[""]] * special)
        settle()
        return out

    def _sums(self, parts: list[list[list[str]]]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        known[""] = 1
        new = {t for lists in parts for tokens in lists for t in tokens if t not in known}
        once = {}
        if new:
            new = list(new)
            for token, n in zip(new, self.merges.count([t.encode() for t in new]).tolist()):
                (known if len(token) <= REMEMBERED_CHARS else once)[token] = n
        get = known.__getitem__ if not once else lambda t: known[t] if t in known else once[t]
        return [sum(sum(map(get, tokens)) for tokens in lists) for lists in parts]


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``tokenizer`` is the path of a byte-level vocabulary file; the driver reads it and ships the merges.
    """
    with open(tokenizer, encoding="utf-8") as f:
        told = json.load(f)
    splitter = json.dumps({"version": "1.0", "pre_tokenizer": told["pre_tokenizer"], "model": {"type": "BPE", "vocab": {}, "merges": []}})
    merges, odd = Merges(told), odd_characters(splitter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges, odd, splitter)
        for batch in batches:
            # The texts of a batch are taken up a bounded number at a time.
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                n = counter.count(pc.fill_null(some.column(1), "").to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("bigint")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), size.alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op11_token_counts")
def op11_token_counts(spark, sf_dir):
    """All documents; more than 512 tokens are over the limit."""
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizer())
