"""The operators against brute force on small inputs, and their edge cases."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripline.llm import (
    decontaminate,
    embeddings,
    licenses,
    linededup,
    mixing,
    packing,
    pages,
    quality,
    simhash,
    warc,
)
from tripline.llm.common import components, popcount, small_batches

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an th er in re on at en nd st es ng of te ed or ti hi as to".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def lookup(parent: dict, x):
    while parent[x] != x:
        x = parent[x]
    return x


def reachable(nodes, edges) -> dict:
    parent = {n: n for n in nodes}
    for a, b in edges:
        a, b = lookup(parent, a), lookup(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: lookup(parent, n) for n in nodes}


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with copies, nulls, empty and long texts, repeated rows and clashing names."""
    small_batches(spark, 7)
    rng = random.Random(3)
    rows = []
    for i in range(60):
        text = "\n".join(sentence(rng, rng.randint(1, 60)) for _ in range(rng.randint(1, 6)))
        rows.append((i, text, rng.choice(["en", "de"]), f"s{rng.randint(0, 3)}", len(text)))
    rows += [(100 + i, rows[i][1], "en", "s0", 1) for i in range(0, 20, 2)]  # copies
    rows += [(120 + i, rows[i][1] + " tail", "en", "s1", 1) for i in range(0, 20, 3)]
    rows += [(200, None, "en", "s0", None), (201, "", None, None, 0), (202, " \n\n ", "fr", "s9", 3)]
    rows += [(203, sentence(rng, 40_000), "en", "s2", 1), (204, "x" * 300_000, "en", "s2", 1)]
    rows += [(205, "a b", "en", None, 3), (205, "a b", "en", None, 3), (None, "c d e f", "en", "s0", 7)]
    frame = spark.createDataFrame(rows, DOC)
    clash = {n: F.lit(1) for n in ("key", "fp", "hash", "mix", "row", "size", "id", "gone", "plan", "own", "role")}
    return frame.withColumns(clash).repartition(5)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1, int(i % 9 == 8)) for i in range(0, 60, 1)] + [(3, 0, 0), (None, 1, 0), (7, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def bits_apart(a: int, b: int) -> int:
    return bin(a ^ b).count("1")


def plain_fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(["aB", "c", "dé", "e\t", "f\n", "\x0b"]), max_size=9))
def test_fingerprint(parts):
    text = " ".join(parts)
    assert simhash.fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 63), min_size=0, max_size=3, unique=True), st.integers(0, 2**64 - 1))
def test_balls_of_linked_fingerprints_meet(flips, value):
    other = value
    for bit in flips:
        other ^= 1 << bit

    def ball(x):
        out = set()
        for number, (low, high) in enumerate(simhash.BLOCKS):
            block = ((1 << high) - 1) ^ ((1 << low) - 1)
            rest = x & ~block
            out.add((number, rest))
            out.update((number, rest ^ 1 << b) for b in range(64) if not block >> b & 1)
        return out

    assert ball(value) & ball(other)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1))
def test_bits_are_counted_with_the_sign(a, b):
    values = np.array([a, b], np.uint64).view(np.int64)
    assert popcount(values[:1] ^ values[1:]).tolist() == [bits_apart(a, b)]


@pytest.mark.parametrize("bit", [0, 21, 22, 42, 43, 62, 63])
def test_links_at_every_bit(spark, bit):
    other = 0x123456789ABCDEF0 ^ 1 << bit ^ 1 << (bit + 7) % 64
    signed = [x - 2**64 if x >> 63 else x for x in (0x123456789ABCDEF0, other, 0x0FEDCBA987654321)]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    assert [(r.src, r.dst) for r in found] == [(min(signed[:2]), max(signed[:2]))]


def test_forest_connects_what_links_connect():
    rng = random.Random(1)
    for _ in range(20):
        base = [rng.getrandbits(64) for _ in range(3)]
        values = {b ^ sum(1 << rng.randrange(12) for _ in range(2)) for b in base for _ in range(40)}
        values = sorted(v - 2**64 if v >= 2**63 else v for v in values)
        edges = simhash.forest(np.array(values, np.int64))
        every = [(a, b) for a in values for b in values if a < b and bits_apart(a % 2**64, b % 2**64) <= 3]
        assert reachable(values, edges) == reachable(values, every)
        assert all(bits_apart(a % 2**64, b % 2**64) <= 3 for a, b in edges)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(None, 3), (2000, 2000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert found == reachable({x for e in real for x in e}, real)


def test_simhash_groups(spark, docs):
    rows = docs.collect()
    fps = {(r.doc_id, r.text): plain_fingerprint(r.text) for r in rows}
    distinct = sorted(set(fps.values()))
    close = [(a, b) for a in distinct for b in distinct if a < b and bits_apart(a, b) <= 3]
    root = reachable(distinct, close)
    least: dict = {}
    for (key, _), fp in fps.items():
        if key is not None:
            least[root[fp]] = min(key, least.get(root[fp], key))
    want = Counter((r.doc_id, fps[r.doc_id, r.text], least.get(root[fps[r.doc_id, r.text]])) for r in rows)
    got = Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k for k, _, c in got.elements() if k is None or k == c)


@pytest.mark.parametrize("group_bytes", [1 << 20, 400])
def test_decontamination(spark, docs, group_bytes):
    texts = [r.text for r in docs.where("doc_id < 60").orderBy("doc_id").collect()]
    items = [(i, " ".join(texts[i].split()[:20]).upper() + "!") for i in range(0, 60, 6)]
    items += [(90, "A b"), (91, ""), (92, None), (93, "c-D"), (90, "A b"), (94, "nowhere"), (95, "x" * 300_000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def words(text):
        lower = (text or "").encode().lower()
        return bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in lower).split()

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[i : i + 13])].add(str(item))
    want = Counter()
    for r in docs.collect():
        w, hit, seen = words(r.text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    seen |= windows[key]
        want[r.doc_id, len(w), len(hit), tuple(sorted(seen))] += 1
    found = decontaminate.contamination(docs, benchmark, group_bytes=group_bytes)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect()) == want
    kept = decontaminate.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    dropped = {k for k, n, hit, _ in want if k is not None and hit and 20 * hit >= n}
    assert dropped and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - dropped


def test_words_cut_into_pieces(monkeypatch):
    text = (b"ab " * 50 + b"longword" * 9 + b" \xc3\xa9t\xc3\xa9 x") * 3
    whole = decontaminate.words_of(np.frombuffer(text, np.uint8))
    monkeypatch.setattr(decontaminate, "PIECE", 17)
    parts = decontaminate.words_of(np.frombuffer(text, np.uint8))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def water(sizes: dict, budget: float) -> dict:
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = budget - sum(2 * sizes[n] for n in capped)
        total = sum(weight[n] for n in names if n not in capped)
        for n in names:
            target[n] = 2 * sizes[n] if n in capped else left * weight[n] / total
        over = {n for n in names if n not in capped and target[n] > 2 * sizes[n]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("range_rows", [50_000, 3])
def test_mixing(spark, docs, labels, range_rows):
    weighted = mixing.quality_weights(docs, labels)
    assert weighted.count() == docs.count()
    found = mixing.mix(weighted, F.col("mix_weight"), range_rows=range_rows)
    rows = [(r.row.doc_id, r.row.source, r.mix) for r in found.collect()]
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").split(None)) if r.text else 0
    target = water(sizes, 1.5 * sum(sizes.values()))
    taken, largest = Counter(), Counter()
    for _, source, mix in rows:
        assert mix.source_size == sizes[source] and mix.taken == mix.size * mix.copies <= 2 * mix.size
        assert math.isclose(mix.target, target[source], rel_tol=1e-9, abs_tol=1e-9)
        taken[source] += mix.taken
        largest[source] = max(largest[source], mix.size)
    assert len(rows) == docs.count()
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    again = mixing.mix(weighted.repartition(3), F.col("mix_weight"), range_rows=range_rows)
    assert Counter(map(repr, rows)) == Counter(repr((r.row.doc_id, r.row.source, r.mix)) for r in again.collect())
    whole = mixing.mixed(weighted, F.col("mix_weight"), range_rows=range_rows)
    assert whole.columns == docs.columns
    want = Counter()
    for key, _, mix in rows:
        want[key] += mix.copies
    assert Counter(r.doc_id for r in whole.collect()) == +want


def test_mixing_prefers_good_documents(spark):
    rows = [(i, "w " * 10, "a") for i in range(400)] + [(1000 + i, "w " * 10, "b") for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weight = F.when(F.col("doc_id") % 2 == 0, 2.0).otherwise(0.5)
    found = mixing.mix(frame, weight).where("row.source = 'b'").select("row.doc_id", "mix.*").collect()
    extra = Counter(r.doc_id % 2 for r in found if r.copies > min(x.copies for x in found))
    assert extra[0] > 1.5 * extra[1]


def kneser_ney(trained: list[list[bytes]]):
    """log p of a document under the model of all trained words, straight from its definition."""
    types = len({t for doc in trained for t in doc})
    pairs = Counter(p for doc in trained for p in zip(["<s>", *doc], doc))
    high = quality.discounts([sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])
    before = Counter(w for _, w in pairs)
    low = quality.discounts([sum(c == k for c in before.values()) for k in (1, 2, 3, 4)])
    all_before = sum(before.values())
    freed = sum(low[min(c, 3)] for c in before.values()) / all_before

    def unigram(w):
        return max(before[w] - low[min(before[w], 3)], 0) / all_before + freed / (types + 1)

    def p(v, w):
        follow = [c for (a, _), c in pairs.items() if a == v]
        if not follow:
            return unigram(w)
        mass = sum(high[min(c, 3)] for c in follow) / sum(follow)
        return max(pairs[v, w] - high[min(pairs[v, w], 3)], 0) / sum(follow) + mass * unigram(w)

    return lambda doc: sum(math.log(p(v, w)) for v, w in zip(["<s>", *doc], doc))


@pytest.mark.parametrize("cached, shards", [(120, 3), (0, 7), (100_000, 1)])
def test_language_model(spark, docs, labels, cached, shards):
    roles = quality.with_roles(docs, labels)
    rows = roles.collect()
    trained = [bytes(r.text).split() for r in rows if r.role == 1]
    model = quality.train(roles, cached=cached, shards=shards)
    got = quality.log_probabilities(roles, model).collect()
    log_p = kneser_ney(trained)
    want = Counter((r.key, r.role, len(bytes(r.text or b"").split())) for r in rows)
    assert Counter((r.key, r.role, r.n) for r in got) == want
    texts = {r.key: bytes(r.text or b"").split() for r in rows}
    for r in got:
        if r.n < 500:
            assert math.isclose(r.log_p, log_p(texts[r.key]), rel_tol=1e-9, abs_tol=1e-9)


def odds(toxic: list[str], other: list[str]) -> dict[bytes, float]:
    """Weights of telling words, straight from their definition."""

    def holders(texts):
        firsts = {}
        for text in texts:
            words = re.split("[^0-9a-z\x80-\U0010ffff]+", text.lower())
            words = [w for w in words if w]
            least = min(
                xxhash.xxh3_64_intdigest(" ".join(words[i : i + 5]).encode()) >> 1 for i in range(max(len(words) - 4, 1))
            )
            firsts.setdefault(least, set(words))
        return len(firsts), Counter(w for words in firsts.values() for w in words)

    (n1, of_toxic), (n0, of_other) = holders(toxic), holders(other)
    found = {}
    for w, c in of_toxic.items():
        a, b = c + 0.5, of_other[w] + 0.5
        found[w.encode()] = math.log(a / (n1 + 1)) - math.log(b / (n0 + 1)) - 3 * math.sqrt(1 / a + 1 / b)
    return {w: x for w, x in found.items() if x > 0}


def test_quality_rejects_toxic_documents(spark):
    rng = random.Random(5)
    words = [sentence(rng, 1) for _ in range(80)]
    bad = ["gonk", "Blarg", "zwif"]
    rows, told = [], []
    for i in range(600):
        text = rng.choices(words, k=rng.randint(30, 300))
        toxic = i % 6 == 0
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "!", ","]))
        rows.append((i, " ".join(text), "en"))
        if i % 2 == 0 or i % 9 == 0:
            told.append((i, 1, int(toxic)))
    rows += [(1000 + i, "scaffold of mistakes " + rows[0][1], "en") for i in range(30)]  # near copies: count once
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(told + [(1000 + i, 1, 1) for i in range(30)], "doc_id long, quality int, toxic int")
    roles = quality.with_roles(frame, labels)
    fit = {r.key: (r.told, bytes(r.text).decode()) for r in roles.where("told is not null").collect()}
    weights = quality.telling_words(roles)
    want = odds([t for _, (k, t) in sorted(fit.items()) if k], [t for _, (k, t) in sorted(fit.items()) if not k])
    assert weights.keys() == want.keys() and all(math.isclose(weights[w], want[w]) for w in want)
    assert {b"gonk", b"blarg", b"zwif"} <= weights.keys() and b"scaffold" not in weights
    text = b"gonk " + b"x " * 15 + b"BLARG, zwif"
    plain = [weights.get(w, 0.0) for w in quality.plain_words(text)]
    most = max(sum(plain[i : i + quality.STRETCH]) for i in range(len(plain)))
    assert math.isclose(quality.worst_stretch(text, weights), most) and quality.worst_stretch(b"", weights) == 0
    found = quality.judged(frame, labels).collect()
    assert {r.doc_id for r in found if not r.kept} == {*range(0, 600, 6), *range(1000, 1030)}


def test_quality_rejects_junk(spark, labels):
    rng = random.Random(9)
    words = [sentence(rng, 1) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=80)), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(f"{w}###" for w in rng.choices(words, k=80)), "en") for i in range(20)]
    rows += [(2000, None, "en"), (2001, "", "en"), (None, "#a #b " * 50, "en"), (2002, rows[0][1], None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    found = quality.judged(frame, told).collect()
    assert len(found) == len(rows)
    assert {r.doc_id for r in found if not r.kept} == {*range(1000, 1020), None}
    kept = quality.accepted(frame, told)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {*range(300), 2000, 2001, 2002, None}


def test_quality_edge_cases(spark, docs, labels):
    found = quality.judged(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(r.kept for r in found if not r.n_tokens)
    untrusted = quality.judged(docs, labels.limit(0)).collect()
    assert len(untrusted) == docs.count() and all(r.kept for r in untrusted)


def test_packing_loses_nothing(spark, docs):
    rows = packing.packed(docs, row_tokens=64, shard_bytes=20_000).collect()
    parts = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert (ids[r.n_tokens :] == packing.END_OF_TEXT).all()
        where = packing.position_ids(r.cu_seqlens, 64)
        assert [i for i in range(64) if where[i] == 0] == list(r.position_resets)
        spans = zip(r.cu_seqlens, r.cu_seqlens[1:])
        for doc, part, (a, b) in zip(r.doc_ids, r.parts, spans, strict=True):
            parts[doc].append((part, ids[a:b].tolist()))
    encode = packing.encoding()
    for key, want in {r.doc_id: r.text for r in docs.collect()}.items():
        got = sorted(parts.pop(key, []))
        if key == 205:  # twice the same row
            assert got[::2] == got[1::2]
            got = got[::2]
        ids = [i for _, own in got for i in own]
        assert (encode.decode(ids[:-1]) if ids else "") == (want or "")
    assert not parts
    assert len({r.shard for r in rows}) > 1
    again = packing.packed(docs.repartition(2), row_tokens=64, shard_bytes=20_000).collect()
    assert Counter(map(repr, rows)) == Counter(map(repr, again))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    rows: list[list[int]] = []
    for n in lengths:  # the definition: the fullest row that still has room
        open_rows = [r for r in rows if sum(r) + n <= 32]
        best = max(open_rows, key=sum, default=None)
        rows.append([n]) if best is None else best.append(n)
    got = [[lengths[i] for i in r] for r in packing.best_fit(lengths, 32)]
    assert sorted(map(sum, got)) == sorted(map(sum, rows))
    assert sorted(x for r in got for x in r) == sorted(lengths) and all(sum(r) <= 32 for r in got)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    found = pages.common(a, b)
    rest = iter(b)
    assert len(found) == table[-1][-1] and all(a[i] in rest for i in found) and found == sorted(set(found))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head>
<body class="sidebar-left"><header>Site</header><nav><ul><li>Home</li></ul></nav><div class="cookie-notice">We <b>use</b> cookies</div>
{main}<aside>Also read</aside><form><label>Mail</label><input><button>Go</button></form><div id="comments"><p>First!</p></div>
<!-- <p>hidden</p> --><footer>&copy; Site</footer></body></html>"""


def test_main_text(spark):
    article = "<article><h1>A&amp;B</h1><p>One  <i>t</i>wo<br>three<p>x &lt; y</p><div class='ad'>Buy</div></article>"
    plain = "<div><p>Welcome to our site</p><p>Page {n} says {n}</p><p>All rights are ours</p></div>"
    rows = [(i, f"http://a.org/x/{i}", PAGE.format(main=article)) for i in range(4)]
    rows += [(10 + i, f"http://b.org/y/{i}?q=1", PAGE.format(main=plain.format(n=i))) for i in range(9)]
    rows += [(20, None, None), (21, "no url", ""), (22, "http://c.org/", "<p>alone &am"), (22, "http://c.org/", "<p>alone &am")]
    rows += [(None, "http://d.org/z", "<main>cut <b"), (23, "http://e.org", "x" * 200_000 + "<p>y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = frame.withColumns({n: F.lit(1) for n in ("key", "host", "path", "part", "text")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    answers = []
    try:
        for n in ("1", "4", "11"):  # wherever ranges end, results are the same
            spark.conf.set("spark.sql.shuffle.partitions", n)
            answers.append(Counter(map(tuple, pages.extract(frame).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert answers[0] == answers[1] == answers[2]
    got = {r[0]: r[2] for r in answers[0]}
    assert sum(answers[0].values()) == len(rows)
    assert all(got[i] == "A&B One two three x < y" for i in range(4))
    assert all(got[10 + i] == f"Page {i} says {i}" for i in range(9))
    assert got[20] == got[21] == "" and got[22] == "alone &am" and got[None] == "cut"
    assert got[23] == "x" * 200_000 + " y"
    assert all(r[3] == len(r[2]) for r in answers[0])


def test_licenses(spark, docs):
    lines = [
        "Released under the MIT License.",
        "Licensed under the Apache\tLicense, Version 2.0!",
        "x\nApache License\nVersion 2",
        "this work is LICENSED under the GNU General Public License, version 3.",
        "CC BY-NC and cc by nc",
        "under the mit licenses",
        "Permission granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in it without restriction hereby",
        "license the under mit",
        None,
        "",
        "Kelvin under the ſ mit license",
    ]
    rows = [(i, t) for i, t in enumerate(lines)] + [(0, lines[0]), (None, lines[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1))
    got = defaultdict(list)
    for r in licenses.scan(frame).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)

    def words(text):
        lower = (text or "").encode().lower()
        return bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in lower).decode().split()

    for i, text in [*enumerate(lines), (None, lines[0])]:
        w = words(text)
        places = sorted(
            (j, label)
            for phrase, label in licenses.PHRASES.items()
            for j in range(len(w))
            if w[j : j + len(phrase.split())] == phrase.split()
        )
        more, most = set(), 0.0
        for line in (text or "").split("\n"):
            own = set(words(line))
            scored = [(len(own & set(words(n))) / len(set(words(n))), label) for label, n in licenses.NOTICES]
            best = max(s for s, _ in scored)
            if best >= licenses.CONTAINMENT:
                more |= {label for s, label in scored if s == best}
                most = max(most, best)
        for r in got[i]:
            assert r.n_words == len(w) and sorted(map(tuple, r.places)) == places
            assert set(r.labels) == more | {label for _, label in places}
            assert math.isclose(r.score, 1.0 if places else most)
    assert got[3][0].labels == ["gpl-3"] and got[6][0].labels == ["mit"] and not got[5][0].places


def test_licenses_several_in_a_line(spark):
    """A block's second notice stays unless a fuller one holds all of its words."""
    two = "Released under the MIT License; parts licensed under the GNU General Public License 3"
    one = "Licensed under the GNU General Public License, version 3"
    frame = spark.createDataFrame([(1, two), (2, one)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(frame).collect()}
    assert got == {1: ["gpl-3", "mit"], 2: ["gpl-3"]}


def test_licenses_wrapped(spark):
    """Notices broken over lines, behind comment marks, within long lines; not over paragraphs."""
    apache = "# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at"
    gpl = (
        "This program is free software: you can redistribute it and/or\n * modify it under the terms of the GNU"
        "\n * General Public License as published\n * by the Free Software Foundation"
    )
    short = "licensed under the BSD\n3-Clause License"
    inside = f"{'lorem ' * 200}{short}{' ipsum' * 200}"
    rows = [(1, apache), (2, gpl), (3, inside), (4, short.replace("\n", "\n\n")), (5, "\n".join(gpl.replace(" * ", "").split())), (6, "a\nb")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(frame).collect()}
    assert got == {1: ["apache-2"], 2: ["gpl"], 3: ["bsd"], 4: [], 5: ["gpl"], 6: []}


def test_warc_round_trip(spark):
    big, other = "<p>é\r\n\r\n" + "x" * 2000, "<p>" + "y" * 1500
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, "http://a/3\r\nX: y", other), (4, None, "small")]
    rows += [(5, "http://a/5", "small"), (6, "http://a/6", None), (7, "", ""), (9, "u", big), (9, "u", big)]
    rows += [(None, "http://a/8", big)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1))
    want = Counter()
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if k is not None and (h or "").encode() == data]
        refers = max(same) if len(data) >= 1000 and key is not None and key < max(same) else None
        want[key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers] += 1
    assert Counter(map(tuple, warc.round_trip(frame).collect())) == want


def test_normalised_archives(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"http://a/{i}", "z" * i) for i in range(30)], "page_id long, url string, html string")
    raw, normal = f"{tmp_path}/raw", f"{tmp_path}/normal"
    warc.write_archives(frame.coalesce(1), raw)
    warc.normalise(spark, raw, normal)
    (source,) = (p for p in (tmp_path / "raw").glob("part-*"))
    (archive,) = (tmp_path / "normal/archives").glob("*/part-*")
    assert gzip.decompress(source.read_bytes()) == gzip.decompress(archive.read_bytes())
    index = spark.read.parquet(f"{normal}/index").orderBy("number").collect()
    content = archive.read_bytes()
    assert len(index) == 30
    for row in index:
        one = gzip.decompress(content[row.offset : row.offset + row.length])
        assert one.startswith(b"WARC/1.1\r\n") and row.record_id.encode() in one
    pieces = [b"".join(warc.split_records(warc.inflated(source.read_bytes(), size))) for size in (1, 7, 1 << 20)]
    assert pieces[0] == pieces[1] == pieces[2] == gzip.decompress(source.read_bytes())


def cosine_links(rows) -> tuple[Counter, list]:
    count, edges = Counter(), []
    for i, (a, x, lx) in enumerate(rows):
        for j, (b, y, ly) in enumerate(rows):
            if i < j and lx is not None and lx == ly and len(x) == len(y):
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    count[i] += 1
                    count[j] += 1
                    edges.append((a, b))
    return count, edges


@pytest.mark.parametrize("block", [2048, 16])
def test_embeddings(spark, block):
    rng = np.random.default_rng(4)
    rows, key = [], 0
    for label in (0, 1):
        for size in (40, 12, *[1] * 60):
            centre = rng.standard_normal(16)
            for _ in range(size):
                rows.append((key, centre + rng.standard_normal(16) * 0.12 * np.linalg.norm(centre) / 4, label))
                key += 1
    rows += [(key + i, rows[0][1], 0) for i in range(5)]  # copies
    rows += [(key + 10, rows[0][1] * 1e-200, 0), (key + 11, rows[1][1], None)]
    good = [(k, x, lab) for k, x, lab in rows]
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [1.0, None], 0)]
    odd += [(905, [float("inf")] + [1.0] * 15, 1), (906, rows[0][1][:8].tolist(), 0)]
    table = [(k, None if x is None else [None if v is None else float(v) for v in x], lab) for k, x, lab in good + odd]
    frame = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    scaled = [(k, x / np.abs(x).max(), lab) for k, x, lab in good]
    count, edges = cosine_links(scaled)
    root = reachable([k for k, _, _ in good], edges)
    found = {r.vec_id: r for r in embeddings.near_duplicates(frame.withColumn("class", F.lit(1)), block=block).collect()}
    assert len(found) == len(table)
    for i, (k, _, _) in enumerate(good):
        assert (found[k].n_links, found[k].component_id) == (count[i], root[k])
    assert all((found[k].n_links, found[k].component_id) == (0, k) for k, _, _ in odd)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(7)
    centre = embeddings.units(rng.standard_normal((1, 64)))
    near = embeddings.units(centre + rng.standard_normal((3000, 64)) * 0.04)
    turned = near @ embeddings.rotation(64, 0).T
    signs, factor = embeddings.codes(turned)
    estimate, spread = embeddings.estimates(turned[:50], signs[50:], factor[50:])
    error = estimate - near[:50] @ near[50:].T
    assert abs(error.mean()) < 0.02
    assert (np.abs(error) <= embeddings.BOUND * spread).all()


def without_later_runs(rows) -> dict:
    """``{(key, text): (text without later repeated runs, lines gone, words gone)}``, window by window."""
    told = []
    for key, text in set(rows):
        digest = xxhash.xxh64_intdigest((text or "").encode(), 42)
        told.append((key is None, key or 0, digest - 2**64 if digest >= 2**63 else digest, key, text))
    first, out = {}, {}
    for number, (*_, key, text) in enumerate(sorted(told, key=lambda x: x[:3])):
        lines = [line.encode().split() for line in (text or "").split("\n")]
        words = [w for line in lines for w in line]
        gone = [False] * len(words)
        for i in range(len(words) - 49):
            doc, at = first.setdefault(tuple(words[i : i + 50]), (number, i))
            if doc != number or at + 50 <= i:
                gone[i : i + 50] = [True] * 50
        kept, drop, at = [], [], 0
        for n, own in enumerate(lines):
            lost = gone[at : at + len(own)]
            at += len(own)
            if own and all(lost):
                drop.append(n)
            else:
                kept.append([w for w, g in zip(own, lost) if not g])
        out[key, text] = kept, drop, sum(gone)
    return out


def test_line_dedup(spark):
    small_batches(spark, 9)
    rng = random.Random(8)
    pool = [sentence(rng, n) for n in (60, 30, 25, 3, 1, 45, 5, 55, 2, 51, 20)]
    rows = []
    for i in range(80):
        lines = [rng.choice(pool) if rng.random() < 0.7 else sentence(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 12))]
        rows.append((i, rng.choice(["\n", "\n\n", " \n"]).join(lines)))
    periods = ["a b", "a", "q " + pool[0], " ".join(pool[1].split()[:7]), pool[10]]
    rows += [(100 + i, f"{' '.join([p] * 40)} x{i} {pool[0]}\n{' '.join([p] * 9)} end") for i, p in enumerate(periods)]
    text = pool[0] + " " + sentence(rng, 300)
    rows += [(120 + i, " ".join(w if j % 90 != 7 * i else f"changed{i}" for j, w in enumerate(text.split()))) for i in range(8)]
    rows += [(200, None), (201, ""), (202, "\n \n"), (None, pool[0]), (None, text), (203, "w " * 100_000), (204, "é" * 90_000)]
    rows += [(203, "w " * 100_000), (0, rows[0][1]), (205, "\t" + pool[7] + "\r\n" + pool[0] + "\x0b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({n: F.lit(1) for n in ("key", "hash", "first", "n", "pick", "run", "spans")})
    want = without_later_runs(rows)
    found = linededup.without_repeats(frame.repartition(5)).collect()
    assert len(found) == len(rows) and sum(n for *_, n in want.values()) > 5000
    by_size = {(r.doc_id, r.n_words_removed, tuple(r.removed)): r for r in found}
    for key, text in rows:
        kept, drop, n_words = want[key, text]
        r = by_size[key, n_words, tuple(drop)]
        assert r.n_lines == (text or "").count("\n") + 1
        if n_words == 0:
            assert r.text == text
        else:
            assert [line.encode().split() for line in r.text.split("\n")] == (kept or [[]])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aé \n\t", max_size=12), max_size=9), st.integers(0, 3))
def test_words_of_a_batch(texts, offset):
    data = [t.encode() for t in texts]
    words = linededup.Words(pa.array(data, pa.binary()).slice(offset))
    split = [t.split() for t in data[offset:]]
    assert np.diff(words.bounds).tolist() == list(map(len, split))
    flat = [w for s in split for w in s]
    assert len(set(words.hashes.tolist())) == len(set(flat)) and len(words.hashes) == len(flat)
    assert len(set(zip(flat, words.hashes.tolist()))) == len(set(flat))


def test_passages_within_lines(spark):
    """Passages that begin or end within a line, lie inside a longer one or come twice in one."""
    rng = random.Random(21)
    new = lambda n: sentence(rng, n).upper()
    passage, split, twice = (sentence(rng, n) for n in (70, 60, 55))
    halves = split.split()
    rows = [
        (1, f"{new(9)} Q {passage} Q {new(20)}\n{new(5)} J {split} J"),
        (2, f"{new(30)} V1 {passage} V2 {new(400)}"),
        (3, f"{new(7)} X1 {' '.join(halves[:28])}\n{' '.join(halves[28:])} X2 {new(6)}"),
        (4, f"{new(3)} Y1 {twice} Y2 {new(4)} Y3 {twice} Y4"),
        (5, " ".join(passage.split()[:49])),
        (6, "\n".join(passage.split()[10:65])),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.without_repeats(frame).collect()}
    texts = dict(rows)
    assert got[1].text == texts[1] and got[5].text == texts[5]
    assert got[2].text == texts[2].replace(passage + " ", "") and got[2].n_words_removed == 70
    want = texts[3].replace(" " + " ".join(halves[:28]), "").replace(" ".join(halves[28:]) + " ", "")
    assert got[3].text == want and got[3].n_words_removed == 60 and not got[3].removed
    head, _, tail = texts[4].rpartition(twice + " ")
    assert got[4].text == head + tail and got[4].n_words_removed == 55
    assert got[6].text == "" and len(got[6].removed) == 55


def test_empty_tables(spark, docs, labels):
    none = docs.limit(0)
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    page = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for frame in (
        simhash.near_duplicates(none),
        simhash.representatives(none),
        decontaminate.contamination(none, benchmark),
        decontaminate.decontaminated(none, benchmark),
        mixing.mix(none),
        mixing.mixed(none),
        quality.judged(none, labels),
        quality.accepted(none, labels),
        packing.packed(none),
        licenses.scan(none),
        linededup.without_repeats(none),
        pages.extract(page),
        warc.round_trip(page),
        embeddings.near_duplicates(vectors),
    ):
        assert frame.count() == 0
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_frequent_words_fit_without_ties(spark):
    """Words of one count are cached all or none, so that no task sends more of them than are kept."""
    texts = spark.createDataFrame([(bytearray(b"a a a b b c c d"),), (bytearray(b"a " + b"x" * 65),), (None,)], "text binary")
    assert [quality.frequent_words(texts, n) for n in (0, 1, 2, 3, 9)] == [[], [b"a"], [b"a"], [b"a", b"b", b"c"], [b"a", b"b", b"c", b"d"]]


def test_model_entries_hold_counts_and_texts_are_split_once(spark, docs, labels, monkeypatch):
    """What a value is computed from is small; the value itself took eight bytes."""
    columns = [np.array([1, 1, 2, 300]), np.array([0, 7, 1 << 40, 3]), np.array([], np.int64)]
    back = quality.unpack_columns(quality.pack_columns(columns))
    assert [c.tolist() for c in back] == [c.tolist() for c in columns]
    assert len(quality.pack_columns([np.ones(10_000, np.int64)])) < 100
    roles = quality.with_roles(docs, labels)
    model = quality.train(roles, cached=120, shards=3)
    assert {r.form for r in model.entries.select("form").distinct().collect()} == set(range(6))
    packed = model.entries.where("form = 3").select(F.sum(F.length("counts")), F.count("*")).first()
    pairs = sum(len(quality.unpack(bytes(r["keys"]), 6)) for r in model.entries.where("form = 3").collect())
    assert packed[0] < 8 * pairs
    found = quality.log_probabilities(roles, model)
    assert found.count() == roles.count()
