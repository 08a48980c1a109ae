"""Token-id output: best-fit-decreasing packing into rows of fixed length.

Documents are tokenised, ended with the end-of-text id and cut, without loss, into segments of
at most a row's length. Segments are dealt by hash to shards of bounded size; in each shard the
longest goes first, into the open row with the least room that still holds it. Open rows are
found in a segment tree over the room left: its leaves are room values, so it has the size of a
row however many rows are open.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tripline.llm.common import released, utf8

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's splitting pattern (a fixed value of the public tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_OF_TEXT = 50256
ROW_TOKENS = 2048
#: Bytes of text whose segments are packed together.
SHARD_BYTES = 8 << 20

_LOADED: dict[str, tiktoken.Encoding] = {}


def encoding(path: str = VOCABULARY) -> tiktoken.Encoding:
    """The tokenizer of a rank file, loaded once per worker.

    A name that is no local path is looked up among the files Spark distributed (``addFile``).
    """
    if path not in _LOADED:
        file = path if Path(path).exists() else SparkFiles.get(Path(path).name)
        with open(file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        _LOADED[path] = tiktoken.Encoding(
            Path(path).stem, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _LOADED[path]


class RoomTree:
    """Open rows by the room they have left: finds the least room that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, needed: int) -> tuple[int, int] | None:
        """Remove and give (room, row) with the least room of at least ``needed``."""
        count, at = self.count, needed + self.size
        while not count[at]:  # up until a subtree to the right has open rows
            while at & 1:
                at >>= 1
                if not at:
                    return None
            at += 1
        while at < self.size:
            at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], row_tokens: int) -> list[list[int]]:
    """Rows of positions in ``lengths``, which falls, each row at most ``row_tokens`` long."""
    tree, rows = RoomTree(row_tokens), []
    for position, length in enumerate(lengths):
        found = tree.take(length)
        if found is None:
            room, row = row_tokens, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(position)
        if room > length:
            tree.put(room - length, row)
    return rows


def segments(
    docs: DataFrame,
    shards: int,
    text: str = "text",
    key: str = "doc_id",
    row_tokens: int = ROW_TOKENS,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """``(shard, key, part, ids)``: a document's tokens in parts of at most ``row_tokens``.

    ``ids`` are little-endian 16-bit ids. The parts of a document, in order, are its tokens and
    the end-of-text id; nothing is dropped.
    """
    kind = docs.schema[key].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            shard, at, part, ids = [], [], [], []
            for i, value in enumerate(batch.column(1)):
                if not (content := value.as_py()):
                    continue
                tokens = np.array([*encode(content.decode("utf-8", "replace")), END_OF_TEXT], "<u2")
                own = xxhash.xxh64_intdigest(f"{batch.column(0)[i].as_py()}|".encode() + content)
                for number, start in enumerate(range(0, len(tokens), row_tokens)):
                    shard.append((own + number * 0x9E3779B97F4A7C15 & (1 << 64) - 1) % shards)
                    at.append(i)
                    part.append(number)
                    ids.append(tokens[start : start + row_tokens].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard, pa.int32()),
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(part, pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                names=["shard", "key", "part", "ids"],
            )

    narrow = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
    return narrow.mapInArrow(released(cut), f"shard int, key {kind.simpleString()}, part int, ids binary")


def packed(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    row_tokens: int = ROW_TOKENS,
    shard_bytes: int = SHARD_BYTES,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Packed rows ``(shard, row, input_ids, n_tokens, cu_seqlens, position_resets, doc_ids, parts)``.

    ``input_ids`` is a row of the id matrix: ``row_tokens`` little-endian 16-bit ids, filled up
    with the end-of-text id. ``cu_seqlens`` are the cumulative lengths of the segments from 0;
    ``position_resets`` the places where positions start from 0 again, the fill included.
    ``doc_ids`` and ``parts`` name each segment. Stacking the rows of a shard gives its matrix.

    Rows do not depend on partitioning. Null and empty texts have no tokens and appear in no
    row. Repeated rows are packed as often as they come, ties in length go by key and part. Ids
    must fit 16 bits. Other columns are not read; an empty table gives no rows.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    kind = docs.schema[key].dataType

    def pack(table: pa.Table) -> pa.Table:
        keys, parts = table.column("key").to_pylist(), table.column("part").to_pylist()
        ids = [x.as_py() for x in table.column("ids")]
        order = sorted(range(len(ids)), key=lambda i: (-len(ids[i]), str(keys[i]), parts[i], ids[i]))
        rows = best_fit([len(ids[i]) // 2 for i in order], row_tokens)
        fill = np.array([END_OF_TEXT], "<u2").tobytes()
        out = []
        for number, row in enumerate(rows):
            members = [order[i] for i in row]
            ends = np.cumsum([0] + [len(ids[i]) // 2 for i in members]).tolist()
            out.append(
                {
                    "shard": table.column("shard")[0].as_py(),
                    "row": number,
                    "input_ids": b"".join(ids[i] for i in members) + fill * (row_tokens - ends[-1]),
                    "n_tokens": ends[-1],
                    "cu_seqlens": ends,
                    "position_resets": [e for e in ends if e < row_tokens],
                    "doc_ids": [keys[i] for i in members],
                    "parts": [parts[i] for i in members],
                }
            )
        return pa.Table.from_pylist(out, schema=arrow)

    ints = pa.list_(pa.int32())
    arrow = pa.schema(
        [
            ("shard", pa.int32()),
            ("row", pa.int32()),
            ("input_ids", pa.binary()),
            ("n_tokens", pa.int32()),
            ("cu_seqlens", ints),
            ("position_resets", ints),
            ("doc_ids", pa.list_(to_arrow_type(kind))),
            ("parts", ints),
        ]
    )
    cut = segments(docs, shards, text, key, row_tokens, vocabulary)
    return cut.groupBy("shard").applyInArrow(
        pack,
        "shard int, row int, input_ids binary, n_tokens int, cu_seqlens array<int>, "
        f"position_resets array<int>, doc_ids array<{kind.simpleString()}>, parts array<int>",
    )


def position_ids(cu_seqlens: list[int], row_tokens: int = ROW_TOKENS) -> np.ndarray:
    """The position of every id of a row, counted from its segment's start."""
    starts = np.array([e for e in cu_seqlens if e < row_tokens])
    sizes = np.diff(np.append(starts, row_tokens))
    return np.arange(row_tokens) - np.repeat(starts, sizes)
