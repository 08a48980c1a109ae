"""De-duplication of repeated passages by winnowing over word hashes.

A run of at least ``RUN_WORDS`` words that also stands, word for word, at an earlier place is a
repeat and is deleted, wherever in a line it begins or ends. Winnowing picks fingerprints: of the
hashes of the short pieces in every window of that many words, the smallest. Two places
that share a window pick the same piece, so only windows whose pick occurs twice can be repeats.
Those are looked up by the hash of their content: a window is a repeat if the first of its kind
stands in an earlier document, or in its own and ends before it begins. A longer repeated run is the
union of such windows: the match goes on word by word both ways, over line ends, whichever earlier
documents it repeats.

Neighbouring windows with one pick are one row, a stretch. Stretches are compared as wholes before
any window of them is, and words are hashed for all texts of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import LOWER, released, staged, utf8

RUN_WORDS = 50
#: Words of the pieces whose hashes are winnowed.
PIECE_WORDS = 12
#: Windows that can hold one piece: a stretch has no more.
STRETCH = RUN_WORDS - PIECE_WORDS + 1

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_LOWER = np.frombuffer(LOWER, np.uint8)
#: Random summands by a byte's place in its word; longer words are hashed one by one.
_SUMMANDS = np.random.default_rng(10).integers(0, 2**64, (32, 256), np.uint64)


def word_bounds(data: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word and the byte after its last; no word goes on over a break."""
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    begins, stops = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    if breaks is not None:
        at = breaks[(breaks > 0) & (breaks < len(data))]
        at = at[inside[at] & inside[at + 1]]
        begins[at] = True
        stops[at] = True
    return np.flatnonzero(begins), np.flatnonzero(stops)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words; a step adds the next byte of all words that have one."""
    sizes = ends - starts
    hashes = sizes.astype(np.uint64) * _MIX
    order = np.argsort(-np.minimum(sizes, len(_SUMMANDS) + 1), kind="stable")
    left = np.searchsorted(-np.minimum(sizes, len(_SUMMANDS) + 1)[order], -np.arange(len(_SUMMANDS)), "left")
    sums, at = hashes[order], starts[order]
    for place, summands in enumerate(_SUMMANDS):
        n = left[place]
        if not n:
            break
        sums[:n] += summands[data[at[:n] + place]]
    sums = (sums ^ (sums >> np.uint64(31))) * _MIX
    hashes[order] = sums ^ (sums >> np.uint64(29))
    for i in np.flatnonzero(sizes > len(_SUMMANDS)).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return hashes


class Words:
    """Words of all texts of an Arrow column: hashes, and where each text's begin."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.empty(0, np.uint8)
        data = _LOWER[data] if lower else data
        starts, ends = word_bounds(data, offsets - offsets[0])
        self.hashes = word_hashes(data, starts, ends)
        self.bounds = np.searchsorted(starts, offsets - offsets[0])

    def texts(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(29))) * _MIX + right
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    return mixed ^ (mixed >> np.uint64(31))


def pieces(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words, by its first word; runs double in length."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power, size = None, 0, hashes, 1
    while done < length:
        if length & size:
            part = power[done : done + n]
            out = part if out is None else _joined(out, part)
            done += size
        if done < length:
            power, size = _joined(power[:-size], power[size:]), 2 * size
    return out


def picks(hashes: np.ndarray) -> np.ndarray:
    """Winnowing's pick for every window, by its first word: the least hash of its pieces."""
    least, size = pieces(hashes, PIECE_WORDS), 1
    n = len(hashes) - RUN_WORDS + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    while 2 * size <= STRETCH:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    return np.minimum(least[:n], least[STRETCH - size : STRETCH - size + n])


def stretches(words: Words) -> tuple[np.ndarray, ...]:
    """``(text, pick, content, first, n)`` of every stretch of windows with one pick.

    ``content`` is a hash of all words of the stretch: its first and last window overlap.
    """
    least, run = picks(words.hashes), pieces(words.hashes, RUN_WORDS)
    if not len(least):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    of = words.texts()[: len(least)]
    begins = words.bounds[of]
    valid = np.arange(len(least)) + RUN_WORDS <= words.bounds[of + 1]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | ~valid[:-1] | (of[1:] != of[:-1])
    since = np.arange(len(least)) - np.maximum.accumulate(np.where(new, np.arange(len(least)), 0))
    new |= since % STRETCH == 0  # periodic texts pick one value for long
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(least))
    starts, ends = starts[valid[starts]], ends[valid[starts]]
    # a text's windows end where its last words begin, within a stretch or at its end
    last_window = words.bounds[of[starts] + 1] - RUN_WORDS
    n = np.minimum(ends, last_window + 1) - starts
    content = _joined(run[starts], run[starts + n - 1] + n.astype(np.uint64))
    return of[starts], least[starts].view(np.int64), content.view(np.int64), starts - begins[starts], n


def _stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, pick, content, first, n = stretches(Words(batch.column(2)))
        rows = pa.array(text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(pick),
                pa.array(content),
                pa.array(first.astype(np.int32)),
                pa.array(n.astype(np.int32)),
            ],
            names=["key", "hash", "pick", "content", "first", "n"],
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with stretches to these one by one: ``run`` of every window and its place."""
    for batch in batches:
        words = Words(batch.column(2))
        run = pieces(words.hashes, RUN_WORDS)
        wanted = batch.column(3)
        flat = wanted.flatten()
        first, n = (flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("first", "n"))
        text = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        text = np.repeat(text, n)
        rows = pa.array(text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(run[words.bounds[text] + at].view(np.int64)),
                pa.array(at.astype(np.int32)),
            ],
            names=["key", "hash", "run", "first"],
        )


def _place() -> Column:
    """Where a row stands, to tell earlier from later."""
    return F.struct(F.col("key").isNull().alias("last"), "key", "hash", "first")


def _before(original: str) -> Column:
    """A row whose ``original`` stands in an earlier document, or in its own and ends before."""
    own = F.col("key").eqNullSafe(F.col(f"{original}.key")) & (F.col("hash") == F.col(f"{original}.hash"))
    return ~own | (F.col("first") >= F.col(f"{original}.first") + RUN_WORDS)


def repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, hash, spans)``: later repeated windows, ``n`` from word ``first`` on.

    Stretches of windows with one pick are compared as wholes first: what repeats the first of its
    content needs no more. Windows are compared one by one only where stretches with one pick differ,
    as at the ends of matches: those of the firsts, and of stretches that overlap their first.
    """
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"), utf8(text).alias("text"))
    # Rows alike in key and text are one document: they share their stretches.
    schema = f"key {kind}, hash long, pick long, content long, first int, n int"
    every = staged(narrow.mapInArrow(released(_stretched), schema), "passages")
    twice = every.groupBy("pick").agg(F.count("*").alias("m")).where("m > 1").select("pick")
    hits = staged(every.join(twice.hint("shuffle_hash"), "pick"), "passage_hits")
    same = ["pick", "content"]
    kinds = hits.groupBy(*same).agg(F.min(_place()).alias("original"), F.max("n").alias("n"), F.count("*").alias("m"))
    kinds = staged(kinds, "passage_kinds")
    copied = kinds.where("m > 1").select(*same, "original").hint("shuffle_hash")
    judged = hits.join(copied, same).select("key", "hash", "first", "n", "pick", "original")
    whole = judged.where(_before("original")).select("key", "hash", "first", "n")
    mixed = kinds.groupBy("pick").agg(F.count("*").alias("kinds")).where("kinds > 1").select("pick")
    firsts = kinds.select("pick", "original.key", "original.hash", "original.first", "n")
    overlaps = judged.where(~_before("original") & (F.col("first") > F.col("original.first")))
    single = firsts.union(overlaps.select("pick", "key", "hash", "first", "n"))
    single = single.join(mixed.hint("shuffle_hash"), "pick")
    single = single.groupBy(F.col("key").alias("k"), F.col("hash").alias("h"))
    single = single.agg(F.collect_set(F.struct("first", "n")).alias("wanted"))
    here = F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h"))
    wanted = narrow.join(single.hint("shuffle_hash"), here).select("key", "hash", "text", "wanted")
    runs = wanted.mapInArrow(released(_windows), f"key {kind}, hash long, run long, first int")
    runs = staged(runs, "passage_windows")
    # Windows of one content: the first place stays. The least place needs one row per run and task.
    least = runs.groupBy("run").agg(F.min(_place()).alias("original"), F.count("*").alias("m"))
    least = least.where("m > 1").select("run", "original").hint("shuffle_hash")
    later = runs.join(least, "run").where(_before("original"))
    later = later.select("key", "hash", "first", F.lit(1).alias("n"))
    return whole.union(later).groupBy("key", "hash").agg(F.collect_list(F.struct("first", "n")).alias("spans"))


def without_words(text: bytes, first: np.ndarray, n: np.ndarray) -> tuple[bytes, list[int], int]:
    """A text without ``n`` windows from word ``first`` on, lines it lost whole, words it lost.

    A line loses the words and the white space between them and the next word kept in it; a line
    that loses all its words goes with its end.
    """
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_bounds(data)
    steps = np.zeros(len(starts) + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + n + RUN_WORDS - 1, -1)
    gone = np.cumsum(steps)[:-1] > 0
    breaks = np.flatnonzero(data == 10)
    n_lines = len(breaks) + 1
    line = np.searchsorted(breaks, starts)
    lost = np.bincount(line[gone], minlength=n_lines)
    whole = (lost > 0) & (lost == np.bincount(line, minlength=n_lines))
    cuts = np.zeros(len(data) + 1, np.int64)
    drop = np.flatnonzero(whole)
    after = np.append(breaks + 1, len(data))
    np.add.at(cuts, np.concatenate(([0], after[:-1]))[drop], 1)
    np.add.at(cuts, after[drop], -1)
    # words of other lines, by runs within a line
    part = gone & ~whole[line]
    edge = np.ones(len(part) + 1, bool)
    edge[1:-1] = (part[1:] != part[:-1]) | (line[1:] != line[:-1])
    edges = np.flatnonzero(edge)
    a, b = edges[:-1], edges[1:]
    a, b = a[part[a]], b[part[a]]
    goes_on = np.append(line, -1)[b] == line[a]  # a word of the line follows
    np.add.at(cuts, np.where(goes_on, starts[a], ends[np.maximum(a - 1, 0)]), 1)
    np.add.at(cuts, np.where(goes_on, np.append(starts, 0)[b], ends[b - 1]), -1)
    kept = data[np.cumsum(cuts)[:-1] == 0].tobytes()
    if whole[-1] and not whole.all():  # the last line went: the one now last has no end
        kept = kept[:-1]
    return kept, drop.tolist(), int(gone.sum())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, n_lines, gone, n_words = [], [], [], []
        for content, spans in zip(batch.column(1), batch.column(2), strict=True):
            text, drop, words = content.as_py(), [], 0
            n_lines.append((text or b"").count(b"\n") + 1)
            if spans.is_valid:
                first, n = (spans.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "n"))
                text, drop, words = without_words(text, first, n)
            texts.append(text)
            gone.append(drop)
            n_words.append(words)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(texts, pa.binary()),
                pa.array(n_lines, pa.int64()),
                pa.array(gone, pa.list_(pa.int64())),
                pa.array(n_words, pa.int64()),
            ],
            names=["key", "text", "n_lines", "removed", "n_words_removed"],
        )


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, text, n_lines, removed, n_words_removed)`` for every row of ``docs``.

    ``text`` lacks the words of later repeated runs, in whole lines or in parts of lines;
    ``removed`` are the numbers, from 0, of the lines that lost all their words and are gone.
    Earlier means a smaller key, then a smaller text hash, then a smaller place; null keys come
    last. Lines without words are passed over and stay. A document may repeat itself, and a run that
    overlaps its like ("w w w ...") is no repeat of it: of a period's runs those after the first go.
    Rows alike in key and text are one document: they are cut alike and do not repeat each other.

    Null texts stay null with one empty line; empty texts stay. Other columns are not read; an
    empty table gives no rows.
    """
    found = repeats(docs, text, key).select(F.col("key").alias("k"), F.col("hash").alias("h"), "spans")
    kind = docs.schema[key].dataType.simpleString()
    whole = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"), utf8(text).alias("text"))
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h"))
    joined = whole.join(found.hint("shuffle_hash"), same, "left").select("key", "text", "spans")
    cut = joined.mapInArrow(
        released(_cut), f"key {kind}, text binary, n_lines long, removed array<long>, n_words_removed long"
    )
    return cut.select(
        F.col("key").alias(key), F.col("text").cast("string").alias("text"), "n_lines", "removed", "n_words_removed"
    )
