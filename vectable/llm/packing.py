"""10. Best-fit packing: bin completion branch-and-bound over document pieces.

Documents are tokenized whole; only one of more than ``capacity`` tokens is
cut, its first piece taking what does not fill a sequence. Pieces are dealt by
hash into shards of about ``SHARD`` pieces, and every shard is packed on its
own by bin completion:

* best-fit decreasing gives the first incumbent, and the total size (and the
  pieces of over half a sequence) a lower bound;
* a branch takes the largest piece left and enumerates undominated fillings
  around it, of any number of pieces, the largest pieces first: what leaves room
  for a piece left out is none, and a piece is swapped for a larger one that
  the waste has room for; the fillings of least waste are tried;
* a branch is cut when its waste so far leaves no room to beat the incumbent;
  a shard ends at its lower bound or after ``NODES`` nodes.

A shard gives away less than about one sequence, so the whole stays within
1 / SHARD of what one search could reach, and no task grows with the corpus.

Tokens: ids of the byte-level BPE in the tokenizer file, then one end id. The
file's own library encodes 1.2 MB/s; its vocabulary as merge ranks in the
other installed BPE library gives the same ids (tested) at 7 MB/s, so that one
is used, but for texts that name a special token, which the first one encodes.

Cases: a null or empty text is the end id alone, one piece of length 1; null
ids and repeated rows are packed like any other, each row its own document;
an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.blocks import give_back, slices, stored, tidy

CAPACITY, SHARD, NODES, LEAVES, BLANKS = 2048, 6144, 12000, 12, 4096
#: Fixed value: the pre-tokenizing pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: What the pattern's ``\\s`` stands for (Unicode's white space).
BLANK = "\\t\\n\\v\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LONG_BLANK = re.compile(rf"(?<![{BLANK}])[{BLANK}]{{{BLANKS},}}+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        # Byte-level BPE writes each byte as a printable character: these bytes as themselves, the others from 256 up.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in self.special}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def exact(self):
        """The file's own library, loaded for the first text that needs it: most tasks have none."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array([*self._exactly(text), 0], dtype="<u4")
        parts, at = [], 0
        for m in LONG_BLANK.finditer(text):
            stop = m.end() if m.end() == len(text) else m.end() - 1
            parts += [self.fast.encode_ordinary(text[at : m.start()]), self._exactly(text[m.start() : stop])]
            at = stop
        parts += [self.fast.encode_ordinary(text[at:]), [0]]
        return np.concatenate([np.array(x, dtype="<u4") for x in parts])

    def _exactly(self, text: str) -> list[int]:
        return self.exact.encode(text, add_special_tokens=False).ids


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """A row for each piece: ``id_col, piece, start, length, ids_crc32``."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer or default_tokenizer())
        for batch in slices(batches):
            ids: list[tuple] = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                t = encode(text.as_py())
                ids += [(i, k, at, m, zlib.crc32(t[at : at + m])) for k, (at, m) in enumerate(cuts(len(t), capacity))]
            cols = list(zip(*ids, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    return rows.mapInArrow(tidy(fn), "id long, piece int, start long, length long, ids_crc32 long").withColumnRenamed("id", id_col)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: every size goes where least room stays."""
    rooms: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for s in sorted(sizes, reverse=True):
        k = bisect_left(rooms, (s, -1))
        if k < len(rooms):
            room, b = rooms.pop(k)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(s)
        if room > s:
            insort(rooms, (room - s, b))
    return bins


def fillings(counts: np.ndarray, room: int, most: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from a multiset (``counts[size]``), least
    waste first, at most ``most``, of the first ``LEAVES * most`` in falling
    order of their pieces. A filling is dominated when its pieces fit into the
    places of another's."""
    have = np.flatnonzero(counts[: room + 1])
    if not len(have):
        return [()]
    below = np.zeros(room + 1, np.int64)  # the largest size on hand up to x
    below[have] = have
    largest = np.maximum.accumulate(below).tolist()
    held = counts[: room + 1].tolist()

    def fit(x: int) -> int:
        """The largest size left of at most ``x``."""
        b = largest[x]
        while b and not held[b]:
            b = largest[b - 1]
        return b

    found: dict[tuple[int, ...], int] = {}
    chosen: list[int] = []
    space = top = room
    leaves, full = LEAVES * most, 0
    while True:
        while b := fit(min(space, top)):
            chosen.append(b)
            held[b] -= 1
            space -= b
            top = b
        leaves -= 1
        if not fit(space):
            pieces, waste = list(chosen), space
            for i, b in enumerate(pieces):
                if waste and (c := fit(min(room, b + waste))) > b:
                    held[b] += 1
                    held[c] -= 1
                    pieces[i], waste = c, waste - (c - b)
            for b, c in zip(chosen, pieces, strict=True):
                held[b] -= b != c
                held[c] += b != c
            found.setdefault(tuple(sorted(pieces, reverse=True)), waste)
            full += waste == 0
        if not leaves or full >= most or not chosen:
            break
        b = chosen.pop()
        held[b] += 1
        space += b
        top = b - 1
    return sorted(found, key=lambda f: (found[f], len(f)))[:most]


def bin_completion(sizes: list[int], capacity: int = CAPACITY, nodes: int = NODES, width: int = 4) -> list[list[int]]:
    """Bins of at most ``capacity``, as few as the search finds."""
    incumbent = best_fit(sizes, capacity)
    total = sum(sizes)
    bound = max(-(-total // capacity), sum(2 * s > capacity for s in sizes))
    counts = np.bincount(np.asarray(sizes, dtype=np.int64), minlength=capacity + 1)
    largest = capacity
    path: list[tuple[tuple[int, ...], list, int]] = []  # the bin, fillings not yet tried, waste before it
    waste, left = 0, len(sizes)
    while len(incumbent) > bound and nodes > 0:
        nodes -= 1
        room_for = (len(incumbent) - 1) * capacity - total  # waste that still beats the incumbent
        if left:
            while not counts[largest]:
                largest -= 1
            counts[largest] -= 1
            options = [(largest, *f) for f in fillings(counts, capacity - largest, width)]
            counts[largest] += 1
        else:
            incumbent = [list(p[0]) for p in path]
            options = []
        while True:
            options = [o for o in options if waste + capacity - sum(o) <= room_for]
            if options:
                break
            if not path:
                return incumbent
            last, options, waste = path.pop()
            for s in last:
                counts[s] += 1
            left += len(last)
            largest = max(largest, last[0])
        chosen, *others = options
        for s in chosen:
            counts[s] -= 1
        left -= len(chosen)
        path.append((chosen, others, waste))
        waste += capacity - sum(chosen)
    return incumbent


def pack(rows: DataFrame, order_by: list[str], capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces with a
    ``length``. ``order_by`` are the columns that tell pieces apart."""
    n = rows.count()
    shards = max(-(-n // shard), min(32, -(-n // 1024)), 1)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(*order_by, F.monotonically_increasing_id()), F.lit(shards)))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        give_back()
        pdf = pdf.sort_values(["length", *order_by], kind="stable").reset_index(drop=True)
        length = pdf["length"].to_numpy()
        whole = np.flatnonzero(length >= capacity)
        bins = [[capacity]] * len(whole) + bin_completion(length[length < capacity].tolist(), capacity)
        at = {int(s): [*np.flatnonzero(length == s)[::-1]] for s in np.unique(length)}
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for k, b in enumerate(bins):
            place = 0
            for s in b:
                i = at[s].pop()
                sequence[i], offset[i] = k, place
                place += s
        pdf["sequence_id"], pdf["offset"] = (pdf.pop("shard").to_numpy() << 32) + sequence, offset
        return pdf

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("shard").applyInPandas(fn, schema)


def best_fit_packing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """A row for each piece of each document, with its place: ``id_col, piece,
    start, length, ids_crc32, sequence_id, offset``."""
    cut = stored(pieces(docs, id_col, text_col, capacity, tokenizer), "pieces")
    return pack(cut, [id_col, "piece", "start", "length", "ids_crc32"], capacity)
