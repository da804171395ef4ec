"""Byte-level BPE: ranked merges over the bytes of distinct words, many words a step, and decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.vectors import slices, small_batches

#: Words whose merges a task remembers, and the length up to which it does.
REMEMBERED = 100_000
REMEMBERED_BYTES = 64
_LONG = 128
#: Bytes of words that are folded at once.
_AT_ONCE = 1 << 18
_NO_RANK = (1 << 31) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank a line.  Read on the driver; a vocabulary has a fixed size."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of ``word``: the adjacent pair of least rank, the leftmost of equals, is merged until none has a rank."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > _LONG:
        return _fold_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    order = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
    while order:
        least = min(order)
        if least == _NONE:
            break
        at = order.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del order[at]
        if at < len(order):
            order[at] = ranks.get(parts[at] + parts[at + 1], _NONE)
        if at:
            order[at - 1] = ranks.get(parts[at - 1] + parts[at], _NONE)
    return [ranks[part] for part in parts]


_NONE = 1 << 62


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, so that a word of n bytes takes n log n steps."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] < n:
            rank = ranks.get(word[at : end[after[at]]])
            if rank is not None:
                heapq.heappush(heap, (rank, at, end[at], end[after[at]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, at, middle, stop = heapq.heappop(heap)
        if end[at] != middle or after[at] >= n or end[after[at]] != stop:
            continue  # a merge has changed one of the two since
        gone = after[at]
        end[at], after[at], end[gone] = stop, after[gone], -1
        if after[at] < n:
            before[after[at]] = at
        offer(at)
        offer(before[at])
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : end[at]]])
        at = after[at]
    return out


class Merges:
    """``fold`` for many words at once: words of one length are rows of a matrix, and every step merges one pair a row."""

    def __init__(self, ranks: dict[bytes, int]):
        self.top = max(ranks.values(), default=-1)
        bytes_only = {bytes([i]): self.top + 1 + i for i in range(256)}  # a byte without a rank may still be part of a merge
        known = {**bytes_only, **ranks}
        found = [
            (known[token[:i]] << 32 | known[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in known and token[i:] in known
        ]
        self.pairs, self.ids = np.array(sorted(found) or [(_NO_RANK << 32, 0)], dtype=np.int64).T.copy()
        self.byte = np.array([known[bytes([i])] for i in range(256)], dtype=np.int64)
        self.first = self._rank(self.byte[:, None], self.byte[None, :])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ids[at], _NO_RANK)

    def fold(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word; words are not empty."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, places in by_length.items():
            rows = max(1, _AT_ONCE // length)
            for start in range(0, len(places), rows):
                some = places[start : start + rows]
                self._fold(np.frombuffer(b"".join([words[i] for i in some]), np.uint8).reshape(len(some), length), some, out)
        return out

    def _fold(self, line: np.ndarray, places: list[int], out: list[np.ndarray]) -> None:
        ids, order, place = self.byte[line], self.first[line[:, :-1], line[:, 1:]], np.array(places)
        while len(ids):
            if order.shape[1]:
                at = order.argmin(axis=1)
                least = order[np.arange(len(order)), at]
                ended = least == _NO_RANK
            else:
                ended = np.ones(len(ids), dtype=bool)
            if ended.any():
                whole = ids[ended]
                if whole.max() > self.top:
                    raise KeyError("a byte that has no rank is in no merge")
                for i, row in zip(place[ended].tolist(), whole.astype(np.int32)):
                    out[i] = row
                if ended.all():
                    return
                ids, order, place, at, least = ids[~ended], order[~ended], place[~ended], at[~ended], least[~ended]
            rows, column = np.arange(len(ids)), np.arange(ids.shape[1])
            ids[rows, at] = least
            ids = ids[column != at[:, None] + 1].reshape(len(ids), -1)
            order = order[column[:-1] != at[:, None]].reshape(len(ids), -1)
            some = np.flatnonzero(at > 0)
            order[some, at[some] - 1] = self._rank(ids[some, at[some] - 1], ids[some, at[some]])
            some = np.flatnonzero(at < order.shape[1])
            order[some, at[some]] = self._rank(ids[some, at[some]], ids[some, at[some] + 1])


def _encoding(ranks: dict[bytes, int]):
    """Adds each row's ids, from its words: a slice's distinct words are folded, then taken by row."""
    merges = Merges(ranks)
    held: dict[bytes, np.ndarray] = {}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = batch.column(batch.num_columns - 1)
            coded = words.flatten().cast(pa.large_binary()).dictionary_encode()
            if isinstance(coded, pa.ChunkedArray):
                coded = coded.combine_chunks()
            distinct = coded.dictionary.to_pylist()
            found = [held.get(word) for word in distinct]
            new = [i for i, ids in enumerate(found) if ids is None]
            short = [i for i in new if 1 < len(distinct[i]) <= _LONG and distinct[i] not in ranks]
            for i, ids in zip(short, merges.fold([distinct[i] for i in short])):
                found[i] = ids
            for i in new:
                if found[i] is None:
                    found[i] = np.array(fold(distinct[i], ranks), dtype=np.int32)
                if len(distinct[i]) <= REMEMBERED_BYTES:
                    if len(held) >= REMEMBERED:
                        held.clear()
                    held[distinct[i]] = found[i]
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            pool = np.concatenate(found or [np.empty(0, np.int32)])
            place = np.cumsum(sizes) - sizes
            index = coded.indices.to_numpy()
            times = sizes[index]
            ends = np.cumsum(times)
            ids = pool[np.repeat(place[index] - ends + times, times) + np.arange(ends[-1] if len(ends) else 0)]
            per_row = words.value_lengths().fill_null(0).to_numpy()
            stops = np.concatenate(([0], np.cumsum(per_row)))
            offsets = np.concatenate(([0], ends))[stops]
            column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*batch.schema.names[:-1], "ids"])

    return encode


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text_column: str = "text") -> DataFrame:
    """``df`` without the text, with ``ids``: the tokens of every match of ``pattern`` in the whole text, in order.

    Null and empty texts have no ids; a column ``ids`` of the input is replaced.  The JVM splits the texts (with Unicode classes); a task folds
    the distinct words of each slice of a batch and remembers a bounded number of them.  No row is shuffled.
    """
    split, schema = _split(df, pattern, text_column)
    return split.mapInArrow(_encoding(ranks), schema)


def _split(df: DataFrame, pattern: str, text_column: str) -> tuple[DataFrame, str]:
    """``df`` with the words in place of the text, and the schema that encoding gives it."""
    small_batches(df.sparkSession)
    others = [c for c in df.columns if c not in (text_column, "ids")]
    words = "words"
    while words in others:
        words = f"_{words}"
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    split = df.select(*others, F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0)).alias(words))
    return split, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in split.select(*others).schema), "ids array<int>"])


def _pieces(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def _rows(column: pa.ListArray) -> Iterator[list[int]]:
    """The lists of a column, one at a time."""
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    for start, stop in zip(offsets[:-1], offsets[1:]):
        yield values[start:stop].tolist()


def _decoding(ranks: dict[bytes, int]):
    pieces = _pieces(ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [b"".join([pieces[i] for i in ids]) for ids in _rows(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

    return decode


def decode(df: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``df``, whose last column is ``ids``, with ``decoded``: the concatenated bytes of the ids' pieces."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "decoded binary"])
    return df.mapInArrow(_decoding(ranks), schema)


def _digesting(ranks: dict[bytes, int]):
    """Per row: the number of ids, and the digests of the ids as text and of the decoded bytes."""
    pieces = _pieces(ranks)
    names = [str(i) for i in range(len(pieces))]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts, decoded = [], [], []
            for ids in _rows(batch.column(batch.num_columns - 1)):
                counts.append(len(ids))
                texts.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([pieces[i] for i in ids])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(texts), pa.array(decoded)],
                [*batch.schema.names, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest


def encode_and_check(df: DataFrame, ranks: dict[bytes, int], pattern: str, text_column: str = "text") -> DataFrame:
    """``encode`` with ``n_tokens, ids_sha256, decoded_sha256`` after the ids: digests of the decimal ids
    joined by a blank and of the decoded bytes.  Encoding and decoding share one pass of one task."""
    first, second = _encoding(ranks), _digesting(ranks)
    split, schema = _split(df, pattern, text_column)
    return split.mapInArrow(lambda batches: second(first(batches)), f"{schema}, n_tokens long, ids_sha256 string, decoded_sha256 string")
