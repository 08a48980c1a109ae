"""Quality classifier: perplexity under an interpolated modified Kneser-Ney bigram model.

The model is trained on trusted documents (labelled good and not toxic), all of them but a
held-out tenth. Tokens are split at ASCII white space, and every one of them counts. A word is
known by a 64-bit hash, but for at most ``cached`` most frequent ones, which have short ids and
whose statistics are broadcast: that saves shuffling and changes no score. All other
statistics, of words, of histories and of bigrams, stay distributed rows.

The log-probability of a document is a sum: what cached words say by themselves, added up where
the document lies, and one entry for each rarer word, each rarer history and each bigram that
training has seen. Documents send their keys, packed by shard, to the shard's entries and get
back one sum from each shard: texts are not shuffled. There are as many shards as the entries
need, so a shard's entries stay of one size however much is trained on.

Perplexity is a mean and does not see a few insults in ordinary prose. So the worst stretch of
a document counts as well: words that documents labelled toxic hold more often than others,
weighted by the lower confidence bound of their log odds, summed over ``STRETCH`` words. These
weights are fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tripline.llm.common import LOWER, drop_shuffles, drop_staged, released, staged, utf8, without
from tripline.llm.mixing import bounded

#: Id 0 begins a document. Ids below ``1 << ID_BITS`` are cached words, keys from 2^63 hashes.
BEGIN, FIRST_WORD, ID_BITS = 0, 1, 17
CACHED = (1 << ID_BITS) - FIRST_WORD
#: Longer tokens are never cached, which bounds the size of what is broadcast.
TOKEN_BYTES = 64
#: Entries of a shard; there are at least as many shards as shuffle partitions.
SHARD_ENTRIES = 1 << 20
#: One trusted document of so many is held out to place the thresholds.
HOLD_OUT = 10
#: Share of held-out trusted documents of a language that the thresholds keep.
QUANTILE = 0.995
#: Added to the thresholds: nats per token, and nats of a stretch's log odds.
SLACK, STRETCH_SLACK = 0.1, 0.5
#: A document is judged as if it had so many more tokens of its language's median quality.
PRIOR_TOKENS = 20
#: Resolution of scores, in nats per token, for the quantiles.
STEP = 0.001
#: Documents are looked up in so many rounds, drawn by a hash of their key, so that only the keys of
#: one round are on disk at a time and every text is split once.
ROUNDS = 2
#: Entries a task gathers before it hands them on.
GATHERED = 1 << 18
#: About so many toxic and other labelled documents, drawn by a hash, fit the word weights ...
TOXIC_SAMPLE, OTHER_SAMPLE = 20_000, 200_000
#: ... of which the largest are kept, lower by so many standard errors than estimated.
TELLING, ERRORS = 1 << 16, 3.0
#: Words of a stretch.
STRETCH = 16

_MIX = np.uint64(0x9E3779B97F4A7C15)
_HASHED = np.uint64(1 << 63)
_AS_HISTORY = np.uint64(1 << 62)
#: Bytes of a key sent to a shard: a false match has a chance of 1 in 2^27 at a full shard.
_SENT = 6
#: Lower-cases A-Z and turns other ASCII signs than letters and digits into spaces.
_PLAIN = bytes(LOWER[b] if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def pack(values: np.ndarray, width: int = 4) -> bytes:
    """Integers below 256 ** ``width`` as byte planes, zstd-compressed: high bytes of small
    numbers cost little."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]
    return struct.pack("<I", len(values)) + pa.compress(
        np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True
    )


def unpack(packed: bytes, width: int = 4) -> np.ndarray:
    (n,) = struct.unpack_from("<I", packed)
    planes = np.zeros((8, n), np.uint8)
    planes[:width] = np.frombuffer(
        pa.decompress(packed[4:], width * n, codec="zstd", asbytes=True), np.uint8
    ).reshape(width, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    mixed = (keys.astype(np.uint64) + np.uint64(1)) * _MIX
    return ((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def sent(keys: np.ndarray) -> np.ndarray:
    """Keys as shards know them: hashes lose their high bits, which chose the shard with others."""
    top = np.uint64(1 << (8 * _SENT - 1))
    return np.where(keys >= _HASHED, (keys & (top - np.uint64(1))) | top, keys)


def pack_columns(columns: list[np.ndarray]) -> bytes:
    """Columns of counts, each as narrow as its largest: small counts cost next to nothing."""
    widths = [max(1, (int(c.max(initial=0)).bit_length() + 7) // 8) for c in columns]
    packed = [pack(c, w) for c, w in zip(columns, widths, strict=True)]
    heads = [struct.pack("<BI", w, len(p)) for w, p in zip(widths, packed, strict=True)]
    return b"".join(x for pair in zip(heads, packed, strict=True) for x in pair)


def unpack_columns(packed: bytes) -> list[np.ndarray]:
    columns, at = [], 0
    while at < len(packed):
        width, size = struct.unpack_from("<BI", packed, at)
        at += 5 + size
        columns.append(unpack(packed[at - size : at], width).astype(np.int64))
    return columns


def word_keys(text: bytes, ids: dict[bytes, int]) -> np.ndarray:
    """Ids or hashes of a text's tokens, ``BEGIN`` first."""
    tokens = text.split()
    found = np.zeros(len(tokens) + 1, np.uint64)
    found[1:] = np.fromiter(map(ids.get, tokens, repeat(BEGIN)), np.int64, len(tokens)).view(np.uint64)
    rare = np.flatnonzero(found[1:] == BEGIN)
    hashed = b"".join(map(xxhash.xxh3_64_digest, map(tokens.__getitem__, rare.tolist())))
    found[1 + rare] = np.frombuffer(hashed, ">u8").astype(np.uint64) | _HASHED
    return found


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Keys of bigrams: both ids side by side, or a hash where one of the words is one."""
    mixed = (v ^ (v >> np.uint64(31))) * _MIX + w
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    mixed ^= mixed >> np.uint64(29)
    return np.where((v < _AS_HISTORY) & (w < _AS_HISTORY), (v << np.uint64(ID_BITS)) | w, mixed | _HASHED)


def history_keys(v: np.ndarray) -> np.ndarray:
    """Keys of hashed words as histories."""
    return pair_keys(v, np.full(len(v), _AS_HISTORY))


@dataclass
class Model:
    """What training keeps per cached word, and a few numbers."""

    words: list[bytes]
    #: log of the back-off weight of a history, log of the lower-order probability
    back_off: np.ndarray
    unigram: np.ndarray
    #: occurrences of a history
    total: np.ndarray
    #: discounts of bigrams and of words, bigram types, log-probability of an unknown word
    high: np.ndarray
    low: np.ndarray
    seen: int
    unknown: float
    #: weights of telling words
    telling: dict[bytes, float] = field(default_factory=dict)

    def ids(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words, FIRST_WORD)}

    def log_back_off(self, total, once, twice, more) -> np.ndarray:
        mass = self.high[1] * once + self.high[2] * twice + self.high[3] * more
        return np.log(np.where(total > 0, mass / np.maximum(total, 1), 1.0))

    def log_unigram(self, histories: np.ndarray) -> np.ndarray:
        kept = np.maximum(histories - self.low[np.minimum(histories, 3).astype(int)], 0.0)
        return np.log(kept / max(self.seen, 1) + np.exp(self.unknown))

    def base(self, keys: np.ndarray) -> float:
        """Back-off weights and lower-order probabilities of cached words, others as unknown."""
        known = (keys < _AS_HISTORY).nonzero()[0]
        ids = keys[known].astype(np.int64)
        words = known > 0
        total = self.unigram[ids[words]].sum() + self.unknown * (len(keys) - 1 - words.sum())
        return float(total + self.back_off[ids[known < len(keys) - 1]].sum())


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more.

    ``counts_of_counts`` has n1 to n4. Where a count is missing, the discount is the plain half.
    """
    n1, n2, n3, n4 = (float(x) for x in counts_of_counts)
    if min(n1, n2, n3) <= 0:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.01), k - 0.01) for k, d in enumerate(found, 1))])


def with_roles(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, lang, role, told, text)``: role 1 trains, 2 is held out, 0 is neither.

    ``told`` is 1 for toxic and 0 for other documents of the sample that fits word weights, else
    null; held-out documents are not in it. Labels of a document that disagree do not make it
    trusted, and make it toxic.
    """
    each = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("label_key"))
    each = each.agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    hashed = F.xxhash64(F.col("label_key").cast("string"))
    fold = F.pmod(hashed, F.lit(HOLD_OUT)) == 0
    trusted = F.coalesce((F.col("q") == 1) & (F.col("t") == 0), F.lit(False))
    n = each.agg(F.count(F.when(F.col("t") == 1, 1)), F.count(F.when(F.col("t") == 0, 1))).first()
    draw = F.shiftrightunsigned(hashed, 33) / float(1 << 31)
    share = F.when(F.col("t") == 1, TOXIC_SAMPLE / max(n[0], 1)).when(F.col("t") == 0, OTHER_SAMPLE / max(n[1], 1))
    roles = each.select(
        "label_key",
        F.when(trusted & fold, 2).when(trusted, 1).otherwise(0).alias("role"),
        F.when((draw < share) & ~(trusted & fold), F.col("t").cast("int")).alias("told"),
    ).where("role > 0 or told is not null")
    narrow = docs.select(F.col(key).alias("key"), "lang", utf8("text").alias("text"))
    joined = narrow.join(bounded(roles), F.col("key") == F.col("label_key"), "left")
    return joined.select("key", "lang", F.coalesce("role", F.lit(0)).alias("role"), "told", "text")


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    for batch in batches:
        for text in batch.column(0):
            counts.update((text.as_py() or b"").split())
        if len(counts) > GATHERED:
            yield out()
            counts.clear()
    if counts:
        yield out()


def _bigram_counts(words_sent):
    """``(v, w, n)`` of texts, summed within the task; keys as signed integers."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = {w: i for i, w in enumerate(words_sent.value, FIRST_WORD)}
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            v = np.concatenate([h[:-1] for h in held])
            w = np.concatenate([h[1:] for h in held])
            order = np.lexsort((w, v))
            v, w = v[order], w[order]
            first = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (w[1:] != w[:-1]))))
            n = np.diff(first, append=len(v))
            return pa.RecordBatch.from_arrays(
                [pa.array(v[first].view(np.int64)), pa.array(w[first].view(np.int64)), pa.array(n)],
                names=["v", "w", "n"],
            )

        size = 0
        for batch in batches:
            for text in batch.column(0):
                held.append(word_keys(text.as_py() or b"", ids))
                size += len(held[-1]) - 1
            if size > 4 * GATHERED:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return gather


def _columns(df: DataFrame) -> list[np.ndarray]:
    return [c.to_numpy() for c in df.toArrow().columns]


def _entries(shards: int, keys_of: Callable, kept: list[int]):
    """Rows to packed ``(shard, keys, counts)``: sorted keys and the ``kept`` columns of each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            columns = [c.fill_null(0).to_numpy() for c in table.columns]
            keys = keys_of(*columns)
            shard, keys = shard_of(keys, shards), sent(keys)
            order = np.lexsort((keys, shard))
            shard, keys = shard[order], keys[order]
            columns = [columns[k][order] for k in kept]
            which, first = np.unique(shard, return_index=True)
            limits = np.append(first, len(shard))
            spans = list(zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(which, pa.int32()),
                    pa.array([pack(keys[a:b], _SENT) for a, b in spans], pa.binary()),
                    pa.array([pack_columns([c[a:b] for c in columns]) for a, b in spans], pa.binary()),
                ],
                names=["shard", "keys", "counts"],
            )

        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size > 4 * GATHERED:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return scan


def _bigram_values(model: Model, v, w, n, total, once, twice, more, histories) -> np.ndarray:
    """log p(w|v) of seen bigrams, less the backed-off value that words give by themselves."""
    of_v, of_w = np.maximum(v, 0), np.maximum(w, 0)
    back_off = np.where(v < 0, model.log_back_off(total, once, twice, more), model.back_off[of_v])
    total = np.where(v < 0, total, model.total[of_v])
    unigram = np.where(w < 0, model.log_unigram(histories), model.unigram[of_w])
    own = np.maximum(n - model.high[np.minimum(n, 3)], 0.0) / total
    backed = back_off + unigram
    return np.log(own + np.exp(backed)) - backed


def _pair_of(v, w, *_counts) -> np.ndarray:
    return pair_keys(v.view(np.uint64), w.view(np.uint64))


def _valued(model: Model, form: int, keys: np.ndarray, counts: list[np.ndarray]) -> np.ndarray:
    """Values of packed entries of a form. A rare word of a bigram is -1, which tells that it is one."""
    rare, none = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
    match form:
        case 0:  # keys of two cached words are their ids
            v, w = (keys >> np.uint64(ID_BITS)).astype(np.int64), (keys & np.uint64(CACHED)).astype(np.int64)
            return _bigram_values(model, v, w, *counts, none, none, none, none, none)
        case 1:
            w, n, total, once, twice, more = counts
            return _bigram_values(model, rare, w, n, total, once, twice, more, none)
        case 2:
            v, n, histories = counts
            return _bigram_values(model, v, rare, n, none, none, none, none, histories)
        case 3:
            return _bigram_values(model, rare, rare, *counts)
        case 4:
            return model.log_unigram(*counts) - model.unknown
        case _:
            return model.log_back_off(*counts)


@dataclass
class Trained:
    """A model, and its entries ``(shard, form, keys, counts)``, staged.

    A value takes eight bytes that nothing shrinks; what it is computed from are small numbers.
    """

    model: Model
    entries: DataFrame
    shards: int


def frequent_words(text: DataFrame, cached: int) -> list[bytes]:
    """The most frequent words, at most ``cached``; of words that are equally frequent all or none.

    A count from which on words fit is found from the number of words of each count, of which there
    are at most as many as the square root of twice the tokens: no task sends more words than are kept.
    """
    counted = text.mapInArrow(released(_token_counts), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = staged(counted.where(F.length("word") <= TOKEN_BYTES), "quality_counts")
    n, words = _columns(counted.groupBy("n").agg(F.count("*")))
    order = np.argsort(n)[::-1]
    fits = n[order][np.cumsum(words[order]) <= cached]
    found = counted.where(F.col("n") >= int(fits[-1])).toArrow() if len(fits) else None
    drop_staged(counted)
    if found is None:
        return []
    return found.sort_by([("n", "descending"), ("word", "ascending")]).column("word").to_pylist()


def train(roles: DataFrame, cached: int = CACHED, shards: int | None = None) -> Trained:
    """The model of the trusted documents among ``roles``."""
    spark = roles.sparkSession
    text = roles.where("role = 1").select("text")
    words = frequent_words(text, cached)
    words_sent = spark.sparkContext.broadcast(words)
    pairs = text.mapInArrow(released(_bigram_counts(words_sent)), "v long, w long, n long")
    pairs = staged(pairs.groupBy("v", "w").agg(F.sum("n").alias("n")), "quality_bigrams")
    drop_shuffles(spark)

    def of_count(column: str, k: int) -> Column:
        return F.count(F.when(F.col(column) == k, 1))

    followers = [of_count("n", 1).alias("once"), of_count("n", 2).alias("twice")]
    followers.append(F.count(F.when(F.col("n") > 2, 1)).alias("more"))
    histories = pairs.groupBy("v").agg(F.sum("n").alias("total"), *followers)
    histories = staged(histories, "quality_histories")
    befores = staged(pairs.groupBy("w").agg(F.count("*").alias("histories")), "quality_words")
    seen, *of_pairs = pairs.agg(F.count("*"), *(of_count("n", k) for k in (1, 2, 3, 4))).first()
    types, *of_words = befores.agg(F.count("*"), *(of_count("histories", k) for k in (1, 2, 3, 4))).first()
    low = discounts(of_words)
    freed = low[1] * of_words[0] + low[2] * of_words[1] + low[3] * (types - of_words[0] - of_words[1])
    unknown = float(np.log((freed / seen if seen else 1.0) / (types + 1)))
    size = FIRST_WORD + len(words)
    blank = np.zeros(size)
    model = Model(words, blank, blank, blank, discounts(of_pairs), low, seen, unknown)
    table = np.zeros((4, size), np.int64)
    at, *found = _columns(histories.where("v >= 0"))
    table[:, at] = found
    before = np.zeros(size, np.int64)
    at, found = _columns(befores.where("w >= 0"))
    before[at] = found
    model.total = np.maximum(table[0], 1).astype(float)
    model.back_off, model.unigram = model.log_back_off(*table), model.log_unigram(before)

    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seen // SHARD_ENTRIES), 1)
    rare_v, rare_w = histories.where("v < 0"), befores.where("w < 0")
    names = ["total", "once", "twice", "more", "histories"]

    def joined(pairs: DataFrame, *sides: tuple[DataFrame, str]) -> DataFrame:
        """Statistics of the rare words alone, as cached ones have nothing to find."""
        for side, key in sides:
            pairs = pairs.join(side, key, "left")
        none = {c: F.lit(None).cast("long") for c in names if c not in pairs.columns}
        return pairs.withColumns(none).select("v", "w", "n", *names)

    makers = [  # by form: rows, their keys and the columns that make their values
        (lambda: joined(pairs.where("v >= 0 and w >= 0")), _pair_of, [2]),
        (lambda: joined(pairs.where("v < 0 and w >= 0"), (rare_v, "v")), _pair_of, [1, 2, 3, 4, 5, 6]),
        (lambda: joined(pairs.where("v >= 0 and w < 0"), (rare_w, "w")), _pair_of, [0, 2, 7]),
        (lambda: joined(pairs.where("v < 0 and w < 0"), (rare_v, "v"), (rare_w, "w")), _pair_of, [2, 3, 4, 5, 6, 7]),
        (lambda: rare_w.select("w", "histories"), lambda w, *_: w.view(np.uint64), [1]),
        (lambda: rare_v.select("v", *names[:4]), lambda v, *_: history_keys(v.view(np.uint64)), [1, 2, 3, 4]),
    ]
    schema = "shard int, keys binary, counts binary"

    def made(form: int, rows: Callable[[], DataFrame], keys_of: Callable, kept: list[int]) -> DataFrame:
        packed = rows().mapInArrow(released(_entries(shards, keys_of, kept)), schema)
        return staged(packed.withColumn("form", F.lit(form)), "quality_entries")

    entries = None
    for form, maker in enumerate(makers):  # one after the other, so that only one join is on disk at a time
        part = made(form, *maker)
        entries = part if entries is None else entries.union(part)
        drop_shuffles(spark)
    for copy in (pairs, histories, befores):
        drop_staged(copy)
    return Trained(model, entries, shards)


def plain_words(text: bytes) -> list[bytes]:
    """Words as the odds see them: A-Z lower-cased, split at ASCII signs and white space."""
    return text.translate(_PLAIN).split()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of a text's five-word shingles, by which near copies are known."""
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        least = []
        for text in batch.column(2):
            words = plain_words(text.as_py() or b"")
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            shingles = zip([0, *ends], ends[4:]) if len(words) > 4 else [(0, len(joined) + 1)]
            least.append(min(digest(joined[a : b - 1]) for a, b in shingles) >> 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(least, pa.int64())], names=["key", "told", "sketch"]
        )


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, toxic, other)``: documents of either kind that hold a word, within the task."""
    counts: dict[int, Counter[bytes]] = {0: Counter(), 1: Counter()}

    def out() -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array([counts[k][w] for w in words], pa.int64()) for k in (1, 0)]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *columns], names=["word", "toxic", "other"])

    for batch in batches:
        for told, text in zip(*(batch.column(i) for i in range(2)), strict=True):
            words = set(plain_words(text.as_py() or b""))
            counts[told.as_py()].update(w for w in words if len(w) <= TOKEN_BYTES)
        if len(counts[0]) + len(counts[1]) > GATHERED:
            yield out()
            counts = {0: Counter(), 1: Counter()}
    if counts[0] or counts[1]:
        yield out()


def telling_words(roles: DataFrame) -> dict[bytes, float]:
    """Weights above zero of words that toxic documents of the sample hold more often.

    A weight is the log odds between both kinds of documents, with a half added to each count,
    less ``ERRORS`` standard errors. Near copies (one least shingle hash) of a kind count once.
    """
    told = roles.where("told is not null")
    kind = roles.schema["key"].dataType.simpleString()
    each = told.select("key", "told", "text").mapInArrow(released(_sketch), f"key {kind}, told int, sketch long")
    firsts = each.groupBy("told", "sketch").agg(F.min("key").alias("first_key"))
    firsts = staged(firsts.select("told", "first_key").distinct(), "quality_told")
    n = dict(firsts.groupBy("told").count().collect())
    chosen = told.join(bounded(firsts.select("first_key")), F.col("key") == F.col("first_key"), "left_semi")
    held = chosen.select("told", "text").mapInArrow(released(_holders), "word binary, toxic long, other long")
    held = held.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where("toxic > 0")
    toxic, other = F.col("toxic") + 0.5, F.col("other") + 0.5
    odds = F.log(toxic / (n.get(1, 0) + 1.0)) - F.log(other / (n.get(0, 0) + 1.0))
    weight = odds - ERRORS * F.sqrt(1 / toxic + 1 / other)
    top = held.select("word", weight.alias("weight")).where("weight > 0").orderBy(F.desc("weight"), "word")
    found = {bytes(r.word): r.weight for r in top.limit(TELLING).collect()}
    drop_staged(firsts)
    return found


def worst_stretch(text: bytes, telling: dict[bytes, float]) -> float:
    """The largest sum of weights over ``STRETCH`` words that follow one another."""
    words = plain_words(text)
    weights = np.fromiter(map(telling.get, words, repeat(0.0)), float, len(words))
    if not weights.any():
        return 0.0
    upto = np.cumsum(weights)
    upto[STRETCH:] -= upto[:-STRETCH].copy()
    return float(upto.max())


_ROWS = (
    "shard int, kind int, batch binary, keys binary, counts binary, "
    "docs array<struct<key:{key},lang:string,role:int,n:long,base:double,worst:double>>"
)


def _scattered(model_sent, shards: int, key_type: pa.DataType):
    """Documents to a row of keys for each shard, and one row with what words alone say."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = model_sent.value
        ids = model.ids()
        kinds = [("lang", pa.string()), ("role", pa.int32()), ("n", pa.int64())]
        doc = pa.struct([("key", key_type), *kinds, ("base", pa.float64()), ("worst", pa.float64())])
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column(3)]
            if not texts:
                continue
            name = xxhash.xxh128()
            keys, times, owners, docs = [], [], [], []
            whose = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for at, (text, (key, lang, role)) in enumerate(zip(texts, whose, strict=True)):
                name.update(repr((key, lang, role, len(text))).encode())
                name.update(text)
                found = word_keys(text, ids)
                v, w = found[:-1], found[1:]
                base, worst = model.base(found), worst_stretch(text, model.telling)
                docs.append({"key": key, "lang": lang, "role": role, "n": len(w), "base": base, "worst": worst})
                own = np.concatenate((pair_keys(v, w), w[w >= _HASHED], history_keys(v[v >= _HASHED])))
                own, n = np.unique(own, return_counts=True)
                keys.append(own)
                times.append(n)
                owners.append(np.full(len(own), at))
            digest = name.digest()
            keys, times, owners = np.concatenate(keys), np.concatenate(times), np.concatenate(owners)
            shard = shard_of(keys, shards)
            order = np.argsort(shard, kind="stable")
            keys, times, owners, shard = sent(keys)[order], times[order], owners[order], shard[order]
            which, first = np.unique(shard, return_index=True)
            limits = np.append(first, len(shard)).tolist()
            rows = [
                (s, pack(keys[a:b], _SENT), pack(np.stack((owners[a:b], times[a:b])).ravel()))
                for s, a, b in zip(which.tolist(), limits[:-1], limits[1:], strict=True)
            ]
            n, place = len(rows), int.from_bytes(digest[:4], "little") % shards
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _, _ in rows] + [place], pa.int32()),
                    pa.array([1] * n + [2], pa.int32()),
                    pa.array([digest] * (n + 1), pa.binary()),
                    pa.array([k for _, k, _ in rows] + [None], pa.binary()),
                    pa.array([c for _, _, c in rows] + [None], pa.binary()),
                    pa.array([None] * n + [docs], pa.list_(doc)),
                ],
                names=["shard", "kind", "batch", "keys", "counts", "docs"],
            )

    return scan


def _looked_up(model_sent, doc_type: pa.DataType):
    """Rows sorted by shard, the shard's entries first (kind 0 less their form), to sums of values
    by document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = model_sent.value
        here, parts = None, []
        known, value = np.empty(0, np.uint64), np.empty(0)
        for rows in batches:
            out = []
            for i in range(rows.num_rows):
                shard, kind, batch = (rows.column(c)[i].as_py() for c in range(3))
                if shard != here:
                    here, parts = shard, []
                    known, value = np.empty(0, np.uint64), np.empty(0)
                if kind == 2:
                    out.append((batch, None, None, rows.column(5).slice(i, 1)))
                    continue
                keys, counts = unpack(rows.column(3)[i].as_py(), _SENT), rows.column(4)[i].as_py()
                if kind <= 0:
                    parts.append((keys, _valued(model, -kind, keys, unpack_columns(counts))))
                    continue
                if parts:
                    known, value = (np.concatenate(x) for x in zip(*parts, strict=True))
                    order, parts = np.argsort(known, kind="stable"), []
                    known, value = known[order], value[order]
                if not len(known):
                    continue
                owners, times = unpack(counts).reshape(2, -1)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                gains = np.where(known[at] == keys, value[at], 0.0) * times
                sums = np.bincount(owners.astype(np.int64), gains)
                if sums.any():
                    out.append((batch, shard, pa.compress(sums.tobytes(), codec="zstd", asbytes=True), None, len(sums)))
            if out:
                empty = pa.array([None], doc_type)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x in out], pa.binary()),
                        pa.array([x[1] for x in out], pa.int32()),
                        pa.array([x[2] for x in out], pa.binary()),
                        pa.array([x[4] if len(x) > 4 else None for x in out], pa.int32()),
                        pa.concat_arrays([x[3] if x[3] is not None else empty for x in out]),
                    ],
                    names=["batch", "shard", "sums", "n_sums", "docs"],
                )

    return scan


def _gathered(key_type: pa.DataType):
    """Rows sorted by batch to documents with their log-probability."""
    kinds = [("lang", pa.string()), ("role", pa.int32()), ("n", pa.int64())]
    schema = pa.schema([("key", key_type), *kinds, ("log_p", pa.float64()), ("worst", pa.float64())])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        metas = [docs for _, _, _, docs in rows if docs is not None]
        parts = sorted(((s, sums, n) for s, sums, n, docs in rows if docs is None), key=lambda x: x[0])
        docs = metas[0]
        logs = np.array([d["base"] for d in docs])
        for _, sums, n in parts:  # the same batch read twice came twice from every shard
            found = np.frombuffer(pa.decompress(sums, 8 * n, codec="zstd", asbytes=True))
            logs[:n] += found / len(metas)
        many = docs * len(metas)
        return pa.RecordBatch.from_pylist(
            [
                {k: d[k] for k in ("key", "lang", "role", "n", "worst")} | {"log_p": float(x)}
                for d, x in zip(many, np.tile(logs, len(metas)).tolist(), strict=True)
            ],
            schema,
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for rows in batches:
            for batch, *rest in zip(*(rows.column(i) for i in range(5)), strict=True):
                if now is not None and batch.as_py() != now:
                    yield out(held)
                    held = []
                now = batch.as_py()
                held.append(tuple(x.as_py() for x in rest))
        if held:
            yield out(held)

    return scan


def log_probabilities(roles: DataFrame, trained: Trained) -> DataFrame:
    """``(key, lang, role, n, log_p, worst)`` for every row.

    n tokens, log_p their natural log sum, worst the text's ``worst_stretch``.
    """
    spark = roles.sparkSession
    model_sent = spark.sparkContext.broadcast(trained.model)
    kind = roles.schema["key"].dataType
    schema = _ROWS.format(key=kind.simpleString())
    narrow = roles.select("key", "lang", "role", "text")
    rounds = []
    for turn in range(ROUNDS):
        part = narrow.where(F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(ROUNDS)) == turn)
        rows = part.mapInArrow(released(_scattered(model_sent, trained.shards, to_arrow_type(kind))), schema)
        docs_type = rows.schema["docs"].dataType
        model_rows = trained.entries.select(
            "shard",
            (-F.col("form")).alias("kind"),
            F.lit(None).cast("binary").alias("batch"),
            "keys",
            "counts",
            F.lit(None).cast(docs_type).alias("docs"),
        )
        placed = model_rows.union(rows).repartition(trained.shards, "shard")
        placed = placed.sortWithinPartitions("shard", "kind")
        summed = placed.mapInArrow(
            released(_looked_up(model_sent, to_arrow_type(docs_type))),
            f"batch binary, shard int, sums binary, n_sums int, docs {docs_type.simpleString()}",
        )
        rounds.append(staged(summed, "quality_sums"))
        del part, rows, model_rows, placed, summed
        drop_shuffles(spark)
    summed = rounds[0]
    for other in rounds[1:]:
        summed = summed.union(other)
    gathered = summed.repartition("batch").sortWithinPartitions("batch")
    return gathered.mapInArrow(
        released(_gathered(to_arrow_type(kind))),
        f"key {kind.simpleString()}, lang string, role int, n long, log_p double, worst double",
    )


def _with_quantile(df: DataFrame, held: DataFrame, step: Column, share: float, name: str) -> DataFrame:
    """``df`` with the quantile ``name`` of ``step`` among the ``held`` rows of its language.

    Counted per step, of which there are few, so a language of any size is one short window.
    Languages without held rows get the quantile of all.
    """
    counts = held.groupBy("lang", step.alias("step")).agg(F.count("*").alias("n"))
    every = counts.groupBy("step").agg(F.sum("n").alias("n"))
    both = counts.select(F.lit(False).alias("whole"), F.col("lang").alias("of_lang"), "step", "n").union(
        every.select(F.lit(True), F.lit(None).cast("string"), "step", "n")
    )
    group = W.partitionBy("whole", "of_lang")
    both = both.withColumn("upto", F.sum("n").over(group.orderBy("step"))).withColumn("all", F.sum("n").over(group))
    least = F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("step"))) * STEP
    table = staged(both.groupBy("whole", "of_lang").agg(least.alias(name)), "quality_quantiles")
    whole = table.where("whole").select(name).first()
    side = bounded(table.where("not whole").drop("whole"))
    joined = df.join(side, F.col("lang").eqNullSafe(F.col("of_lang")), "left").drop("of_lang")
    return joined.withColumn(name, F.coalesce(name, F.lit(whole[0] if whole else None).cast("double")))


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, lang, n_tokens, perplexity, score, threshold, toxic_score, toxic_threshold, kept)``
    for every row of ``docs``.

    ``perplexity`` is exp of the mean negative log-probability per token (null without
    tokens). ``score`` is that mean, drawn towards the median of the language's held-out
    trusted documents by ``PRIOR_TOKENS`` tokens of that value, so that a few odd words do not
    condemn a short text. ``threshold`` is the ``QUANTILE`` of the scores of the language's
    held-out trusted documents, plus ``SLACK``. ``toxic_score`` is the ``worst_stretch`` and
    ``toxic_threshold`` the same quantile of it, plus ``STRETCH_SLACK``. A language without
    held-out documents uses the quantiles of all. Documents above either are not kept.

    Null or empty texts have no tokens and are kept: there is nothing to judge. Null
    languages form a language. Without trusted documents every document is kept. Repeated
    rows are each answered. Columns other than key, text and lang are not read.
    """
    roles = with_roles(docs, labels, key)
    trained = train(roles)
    trained.model.telling = telling_words(roles)
    drop_shuffles(docs.sparkSession)
    summed = log_probabilities(roles, trained)
    scored = summed.withColumn("mean", -F.col("log_p") / F.greatest("n", F.lit(1)))
    scored = staged(scored, "quality_scores")
    for copy in (summed, trained.entries):
        drop_staged(copy)
    del summed
    drop_shuffles(docs.sparkSession)
    held = "role = 2 and n > 0"
    near = F.round(F.col("mean") / STEP).cast("long")
    scored = _with_quantile(scored, scored.where(held), near, 0.5, "centre")
    n, mean = F.col("n"), F.col("mean")
    score = (mean * n + F.col("centre") * PRIOR_TOKENS) / (n + PRIOR_TOKENS)
    scored = scored.withColumn("score", F.coalesce(score, mean))
    above = F.ceil(F.col("score") / STEP).cast("long")
    out = _with_quantile(scored, scored.where(held), above, QUANTILE, "threshold")
    above = F.ceil(F.col("worst") / STEP).cast("long")
    out = _with_quantile(out, scored.where(held), above, QUANTILE, "toxic_threshold")
    limit, toxic_limit = F.col("threshold") + SLACK, F.col("toxic_threshold") + STRETCH_SLACK
    fine = (F.col("score") <= limit) & (F.col("worst") <= toxic_limit)
    return out.select(
        F.col("key").alias(key),
        "lang",
        F.col("n").alias("n_tokens"),
        F.when(F.col("n") > 0, F.exp("mean")).alias("perplexity"),
        "score",
        limit.alias("threshold"),
        F.col("worst").alias("toxic_score"),
        toxic_limit.alias("toxic_threshold"),
        F.coalesce((F.col("n") == 0) | fine, F.lit(True)).alias("kept"),
    )


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns.

    Rejected keys are removed by an anti join; rows with a null key are kept.
    """
    return without(docs, judged(docs, labels, key).where("not kept"), key)
