"""Packing token sequences: best-fit decreasing with a segment tree over remaining capacity.

Documents longer than a window are first cut into full windows; what is left of each document,
always shorter than a window, is packed by best-fit decreasing. The pieces are dealt into groups of
bounded size and each group is packed by one task, so no task sees more than a group however many
pieces there are; a group of thousands of pieces packs about as tightly as all of them would.
"""

from __future__ import annotations

import base64
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import sliced
from windrow.session import durable

WINDOW = 2048
END = 1
GROUP = 8192           # pieces packed together
_LONG_BLANK = re.compile(r"\s{1000}")
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of the tokenizer file ``path``, equal to those of its library.

    Texts are encoded whole, by the faster library of the same vocabulary when its ranks lie beside
    the file. Texts that hold one of the file's special tokens go through the file's own library, and
    so do those with a long run of white space, on which the faster one's pattern runs out of stack.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.encode = self._slowly
        try:
            import public_tokenizers
            import tiktoken
            with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.encode = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                special_tokens={}).encode_ordinary
        except (ImportError, FileNotFoundError):
            pass

    def _slowly(self, text: str) -> list[int]:
        return self.full.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        return self.encoded(text).tolist()

    def encoded(self, text: str) -> np.ndarray:
        """The ids, as little-endian unsigned 32-bit numbers."""
        slowly = any(s in text for s in self.special) or _LONG_BLANK.search(text)
        return np.array((self._slowly if slowly else self.encode)(text), "<u4")


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of how many there are."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.by_capacity: list[list[int]] = [[] for _ in range(size + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, window: int, capacity: int) -> None:
        if capacity:
            self.by_capacity[capacity].append(window)
            self._change(capacity, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity that holds ``length``."""
        count, node = self.count, self.leaves + length
        while not count[node]:
            while node & 1:          # a right child: nothing to the right below this parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1                # the sibling on the right
        while node < self.leaves:
            node <<= 1
            if not count[node]:
                node += 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return self.by_capacity[capacity].pop(), capacity


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; ties go by the order given."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened, n = OpenWindows(size), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = opened.tightest(length)
        if found is None:
            found, n = (n, size), n + 1
        window[i], capacity = found
        offset[i] = size - capacity
        opened.add(found[0], capacity - length)
    return window, offset


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           size: int = WINDOW, end: int = END, with_ids: bool = True) -> DataFrame:
    """Encode whole texts, add ``end``, and cut into full windows and a rest.

    Null texts are empty ones: the single id ``end``. ``ids_crc32`` is the checksum of a piece's
    ids as little-endian unsigned 32-bit numbers; the ids themselves come as ``ids`` on demand.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start bigint, "
              "length bigint, ids_crc32 bigint, doc_tokens bigint"
              + (", ids array<int>" if with_ids else ""))

    def run(batches):
        encode = encoder(path).encoded
        for batch in sliced(batches):
            at, start, length, crc, total, held = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.array([end], "<u4"))
                for s in range(0, len(ids), size):
                    part = ids[s:s + size]
                    at.append(i)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
                    if with_ids:
                        held.append(part.astype(np.int32))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = [batch.column(0).take(pa.array(at, pa.int64())),
                       *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            if with_ids:
                names.append("ids")
                columns.append(pa.array(held, pa.list_(pa.int32())))
            if at:
                yield pa.RecordBatch.from_arrays(columns, names)
    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = WINDOW, end: int = END, group: int = GROUP, with_ids: bool = True
         ) -> DataFrame:
    """One row per piece with its place: ``sequence_id`` and ``offset`` in that sequence.

    Sequences are unique over the table and filled gaplessly from offset 0. Repeated rows and rows
    with a null id are packed like any other, each for itself; an empty table gives an empty one.
    The encoded pieces are checkpointed, so that their count is known and a lost executor cannot
    deal them differently.
    """
    made = durable(pieces(docs, path, id_col, text_col, size, end, with_ids))
    groups = max(1, math.ceil(made.count() / group))
    dealt = made.withColumn(
        "_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema.fields)

    def packed(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "start", "ids_crc32"], kind="stable",
                                na_position="last", ignore_index=True)
        window, offset = best_fit(part["length"].to_numpy(), size)
        part["sequence_id"] = window + (int(key[0]) << 32)
        part["offset"] = offset
        return part.drop(columns="_group")
    return dealt.groupBy("_group").applyInPandas(
        packed, schema + ", sequence_id bigint, offset bigint")
