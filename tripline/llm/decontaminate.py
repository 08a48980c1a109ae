"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the benchmark's windows: 13 consecutive words of an item, or the whole item if
it has fewer. For each window length a shift table says, for the last three words before a
position, how far the next window's end can be at the nearest; most positions are skipped in
strides without being looked at. Where the shift is zero, the hash of those three words picks
a bucket of windows, hashes of the whole window pick the strings to test, and comparing the
words themselves confirms an occurrence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import LOWER, released, staged, utf8, without

WINDOW_WORDS = 13
BLOCK_WORDS = 3
TABLE_BITS = 18
#: Bytes of window text searched for in one pass over the documents; more windows, more passes.
GROUP_BYTES = 16 << 20
#: Bytes of text turned into arrays at a time.
PIECE = 1 << 20

_LOWER = np.frombuffer(LOWER, np.uint8)
_IS_WORD = np.array(
    [48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)]
)  # after lower-casing
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_ROLL = np.uint64(0xD1342543DE82EF95)


class _Powers:
    """Powers of the hash base and of its inverse, as far as they have been needed."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            steps = [np.full(size, x, np.uint64) for x in (_BASE, inverse)]
            for step in steps:
                step[0] = 1
            self.up, self.down = (np.multiply.accumulate(step) for step in steps)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def words_of(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words in lower-cased bytes, piece by piece."""
    found, at = [], 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and _IS_WORD[text[end]] and _IS_WORD[text[end - 1]]:
            gap = np.flatnonzero(~_IS_WORD[text[end : end + PIECE]])
            end = end + int(gap[0]) if len(gap) else min(end + PIECE, len(text))
        piece = text[at:end]
        inside = np.zeros(len(piece) + 2, np.int8)
        inside[1:-1] = _IS_WORD[piece]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        up, down = _POWERS.to(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * down[starts]
        hashes ^= hashes >> np.uint64(29)
        found.append((hashes * _ROLL, starts + at, ends + at))
        at = end
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _block_hash(words: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(ends), np.uint64)
    for k in range(size):
        out += words[ends - k] * _BLOCK[k]
    return out


def _window_hash(words: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(ends), np.uint64)
    for k in range(size - 1, -1, -1):
        out = out * _ROLL + words[ends - k]
    return out


@dataclass
class Table:
    """Shift table and buckets of the windows of one length, numbered as given."""

    length: int
    block: int
    shift: np.ndarray
    suffixes: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    numbers: np.ndarray

    @classmethod
    def of(cls, windows: np.ndarray, numbers: np.ndarray) -> Table:
        """``windows``: a row of word hashes for each window."""
        length = windows.shape[1]
        block = min(BLOCK_WORDS, length)
        shift = np.full(1 << TABLE_BITS, length - block + 1, np.uint8)
        flat = windows.ravel()
        last = np.arange(len(windows)) * length + length - 1
        for back in range(length - block, -1, -1):
            at = _block_hash(flat, last - back, block) >> np.uint64(64 - TABLE_BITS)
            shift[at] = np.minimum(shift[at], back)
        suffix = _block_hash(flat, last, block)
        order = np.argsort(suffix, kind="stable")
        suffixes, first = np.unique(suffix[order], return_index=True)
        return cls(
            length,
            block,
            shift,
            suffixes,
            np.append(first, len(order)),
            _window_hash(flat, last, length)[order],
            numbers[order],
        )

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends and window numbers of the strings to test, from shifts and buckets.

        Positions ``stride`` apart start the scan side by side; each follows its shifts
        until it comes to where the next one started.
        """
        stride = self.length - self.block + 1
        at = np.arange(self.length - 1, len(words), stride)
        stop = np.minimum(at + stride, len(words))
        zero = []
        while len(at):
            blocks = _block_hash(words, at, self.block) >> np.uint64(64 - TABLE_BITS)
            shift = self.shift[blocks]
            zero.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        ends = np.concatenate(zero) if zero else np.empty(0, np.int64)
        suffix = _block_hash(words, ends, self.block)
        bucket = np.searchsorted(self.suffixes, suffix)
        known = bucket < len(self.suffixes)
        known[known] = self.suffixes[bucket[known]] == suffix[known]
        ends, bucket = ends[known], bucket[known]
        whole = _window_hash(words, ends, self.length)
        found = []
        place, stop = self.first[bucket], self.first[bucket + 1]
        while len(ends):
            same = self.hashes[place] == whole
            found.append((ends[same], self.numbers[place[same]]))
            place = place + 1
            on = place < stop
            ends, whole, place, stop = ends[on], whole[on], place[on], stop[on]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Searcher:
    """All windows of one pass, by length."""

    def __init__(self, windows: list[bytes]):
        self.windows = windows
        by_length: dict[int, list[int]] = {}
        for number, window in enumerate(windows):
            by_length.setdefault(window.count(b" ") + 1, []).append(number)
        self.tables = [
            Table.of(
                words_of(np.frombuffer(b" ".join(windows[i] for i in numbers), np.uint8))[0].reshape(
                    len(numbers), length
                ),
                np.array(numbers),
            )
            for length, numbers in sorted(by_length.items())
        ]

    def search(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int]], set[int]]]:
        """For each text its number of words, merged hit spans and numbers of its windows."""
        joined = b" ".join(texts).translate(LOWER)
        hashes, starts, ends = words_of(np.frombuffer(joined, np.uint8))
        limits = np.cumsum([0, *(len(t) + 1 for t in texts)])
        first = np.searchsorted(starts, limits)
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        hits: dict[int, list[tuple[int, int]]] = {}
        seen: dict[int, set[int]] = {}
        for table in self.tables:
            at, number = table.candidates(hashes)
            inside = owner[at] == owner[at - table.length + 1]
            for end, window in zip(at[inside].tolist(), number[inside].tolist(), strict=True):
                begin = end - table.length + 1
                spans = zip(starts[begin : end + 1].tolist(), ends[begin : end + 1].tolist(), strict=True)
                if b" ".join(joined[a:b] for a, b in spans) == self.windows[window]:
                    text = int(owner[end])
                    low = int(first[text])
                    hits.setdefault(text, []).append((begin - low, end + 1 - low))
                    seen.setdefault(text, set()).add(window)
        for text in range(len(texts)):
            n_words = int(first[text + 1] - first[text])
            yield n_words, merged(hits.get(text, [])), seen.get(text, set())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, overlapping and touching ones joined, in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def windows_of(benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """Distinct windows with the items they come from: ``(window binary, items)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, windows = [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lower = (value.as_py() or b"").translate(LOWER)
                _, starts, ends = words_of(np.frombuffer(lower, np.uint8))
                words = [lower[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                for at in range(max(len(words) - WINDOW_WORDS, 0) + 1 if words else 0):
                    items.append(name)
                    windows.append(b" ".join(words[at : at + WINDOW_WORDS]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(windows, pa.binary())],
                names=["item", "window"],
            )

    narrow = benchmark.select(F.col(item).cast("string").alias("item"), utf8(text).alias("text"))
    cut_up = narrow.mapInArrow(cut, "item string, window binary")
    return cut_up.groupBy("window").agg(F.collect_set("item").alias("items"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``(key, n_words, n_hit, spans, items)`` for every row of ``docs``.

    ``spans`` are the half-open word ranges inside any occurrence of a window, merged;
    ``items`` the ids, as sorted strings, of the items with an occurring window. Documents are
    never shuffled. The windows of a pass are a broadcast of at most about ``group_bytes``;
    a larger benchmark is searched group by group, each pass adding to the spans found.

    Null and empty texts have no words and no hits; null or wordless items never match. An
    item without id marks words as hit but is not listed. Repeated document rows are each
    answered, repeated items count once. An empty benchmark leaves all counts of hits at 0.
    """
    spark = docs.sparkSession
    windows = staged(windows_of(benchmark), "windows")
    total = windows.agg(F.sum(F.length("window") + 32)).first()[0] or 0
    groups = max(1, math.ceil(total / group_bytes))
    kind = docs.schema[key].dataType.simpleString()
    state = docs.select(
        F.col(key).alias("key"),
        utf8(text).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<array<long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    number = F.pmod(F.xxhash64("window"), F.lit(groups))
    for group in range(groups):
        rows = windows.where(number == group).orderBy("window").collect()
        sent = spark.sparkContext.broadcast([(bytes(r.window), r["items"]) for r in rows])
        last = group == groups - 1
        columns = "key {}, {}n_words long, spans array<array<long>>, items array<string>".format(
            kind, "" if last else "text binary, "
        )
        state = state.mapInArrow(released(_pass(sent, last)), columns)
        if not last:
            state = staged(state, "decontaminate")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return state.select(
        F.col("key").alias(key),
        "n_words",
        hit.alias("n_hit"),
        "spans",
        F.array_sort("items").alias("items"),
    )


def _pass(sent, last: bool):
    """A scan of batches ``(key, text, n_words, spans, items)`` for one group of windows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher([window for window, _ in sent.value])
        items_of = [items for _, items in sent.value]
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column(1)]
            found, at = [], 0
            while at < len(texts):  # about PIECE bytes at a time
                to, size = at, 0
                while to < len(texts) and (size == 0 or size + len(texts[to]) <= PIECE):
                    size += len(texts[to]) + 1
                    to += 1
                found += searcher.search(texts[at:to])
                at = to
            spans, items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for i, (_, hits, windows) in enumerate(found):
                if windows:
                    spans[i] = merged([*map(tuple, spans[i]), *hits])
                    items[i] = sorted({*items[i], *(x for w in windows for x in items_of[w])})
            out = {"key": batch.column(0)} | ({} if last else {"text": batch.column(1)})
            out |= {
                "n_words": pa.array([n for n, _, _ in found], pa.int64()),
                "spans": pa.array([[list(s) for s in x] for x in spans], pa.list_(pa.list_(pa.int64()))),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return scan


def contaminated():
    """The rule: a hit at all, and hits are at least a twentieth of the words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Contaminated keys, few and distinct, are removed by an anti join. Rows with a null key
    are kept.
    """
    return without(docs, contamination(docs, benchmark, text, key).where(contaminated()), key)
