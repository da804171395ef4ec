"""Cross-tokenizer alignment: token intervals of two tokenizers, coalesced into groups, and linked id pairs.

Both token sequences of a text cover the same bytes.  All tokens of a chunk of documents are sorted by
their start; where a start reaches the running maximum of the ends, nothing crosses, and a new group
begins.  Every A token of a group is linked with every B token of it.

How many documents hold an id pair linked is counted over all documents.  Tasks send the distinct pairs
of a chunk, not those of each document, so a pair that all documents share crosses the network once a
chunk; the counts come back by chunk and meet the documents' own pairs there.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch

#: Characters of text, and rows, after which a chunk is full; a longer text is a chunk of its own.
CHUNK_CHARS = 1_000_000
CHUNK_ROWS = 16_384
#: Link pairs laid out at once, and the pairs of a group above which its ids are made distinct first.
LAID_OUT = 2_000_000
WIDE = 1_024
_PART_CHARS = 200_000
#: Runs of white space from this length on are left to the slower library, which needs no stack for them.
_LONG_GAP = re.compile(r"\s{1000}")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Tokenizers:
    """Tokenizer A, the text of a byte-level BPE file, and B, the bytes of a piece model; tasks carry both."""

    a_file: str
    b_file: bytes
    pattern: str

    @classmethod
    def read(cls, a_path: str, b_path: str, pattern: str) -> Tokenizers:
        """Reads both files on the driver; a vocabulary has a fixed size.  ``pattern`` splits texts for A."""
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read(), pattern)

    def __getstate__(self):
        return {name: getattr(self, name) for name in ("a_file", "b_file", "pattern")}

    @cached_property
    def a_pieces(self) -> list[bytes]:
        """The bytes of every id of A; added tokens never occur, their strings are plain text here."""
        letters, words = _byte_letters(), json.loads(self.a_file)["model"]["vocab"]
        out = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            out[i] = bytes(letters[x] for x in word)
        return out

    @cached_property
    def _b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.b_file)

    @cached_property
    def b_pieces(self) -> list[bytes]:
        """The bytes of every id of B; control pieces have none of the text."""
        out = []
        for i in range(self._b.vocab_size()):
            piece = self._b.id_to_piece(i)
            byte = _BYTE.fullmatch(piece) if self._b.is_byte(i) else None
            plain = b"" if self._b.is_control(i) or self._b.is_unknown(i) else piece.replace("▁", " ").encode()
            out.append(bytes([int(byte[1], 16)]) if byte else plain)
        return out

    @cached_property
    def _a(self):
        """A as its file says, by the library that the file is for."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.a_file)
        made.encode_special_tokens = True
        return made

    @cached_property
    def _a_fast(self):
        """The same by ranks, where the file's merges are in the order of its ids, else None."""
        import tiktoken

        model = json.loads(self.a_file)["model"]
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        first = len(self.a_pieces) - len(merges)
        if any(model["vocab"].get(one + two) != first + i for i, (one, two) in enumerate(merges)):
            return None
        ranks = {piece: i for i, piece in enumerate(self.a_pieces)}
        return tiktoken.Encoding("a", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            if self._a_fast is None or _LONG_GAP.search(text):
                out.append(self._a.encode(text, add_special_tokens=False).ids)
            else:
                out.append(self._a_fast.encode_ordinary(text))
        return out

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self._b.encode(texts, num_threads=1)


def coalesce(starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The group of each interval: sorted by start, a group breaks where a start reaches the running maximum of the ends."""
    if not len(starts):
        return np.empty(0, np.int64)
    order = np.lexsort((kinds, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.concatenate(([False], starts[order][1:] >= reach[:-1]))
    out = np.empty(len(starts), np.int64)
    out[order] = np.cumsum(fresh)
    return out


@dataclass
class Aligned:
    """The tokens of some texts and their groups: ids, group and text of every token of A and of B."""

    texts: int
    a_ids: np.ndarray
    b_ids: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray
    a_start: np.ndarray
    a_end: np.ndarray

    @cached_property
    def groups(self) -> int:
        return int(self.a_group[-1]) + 1 if len(self.a_group) else 0

    @cached_property
    def a_in(self) -> np.ndarray:
        return np.bincount(self.a_group, minlength=self.groups)

    @cached_property
    def b_in(self) -> np.ndarray:
        return np.bincount(self.b_group, minlength=self.groups)

    @cached_property
    def group_text(self) -> np.ndarray:
        return self.a_text[np.cumsum(self.a_in) - self.a_in]

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens of A, of B, groups, links."""
        links = np.zeros(self.texts, np.int64)
        np.add.at(links, self.group_text, self.a_in * self.b_in)
        per = lambda x: np.bincount(x, minlength=self.texts)
        return per(self.a_text), per(self.b_text), per(self.group_text), links


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    ids = np.fromiter((i for row in rows for i in row), np.int64, int(sizes.sum()))
    return ids, np.repeat(np.arange(len(rows)), sizes)


def align(texts: list[str | None], tokenizers: Tokenizers) -> Aligned:
    """Encodes whole texts; a text whose tokens of either kind do not join to its bytes, null or empty, has none."""
    a_rows: list[list[int]] = [[]] * len(texts)
    b_rows: list[list[int]] = [[]] * len(texts)
    lengths = np.zeros(len(texts), np.int64)
    a_pieces, b_pieces = tokenizers.a_pieces, tokenizers.b_pieces
    some = [i for i, text in enumerate(texts) if text]
    at = 0
    while at < len(some):
        stop, size = at, 0
        while stop < len(some) and (stop == at or size < _PART_CHARS):
            size += len(texts[some[stop]])
            stop += 1
        part = [texts[i] for i in some[at:stop]]
        spaced = [f" {text}" for text in part]
        for i, text, a, b in zip(some[at:stop], spaced, tokenizers.encode_a(spaced), tokenizers.encode_b(part)):
            whole = text.encode()
            if b"".join(map(a_pieces.__getitem__, a)) == whole == b"".join(map(b_pieces.__getitem__, b)):
                a_rows[i], b_rows[i], lengths[i] = a, b, len(whole)
        at = stop
    a_ids, a_text = _flat(a_rows)
    b_ids, b_text = _flat(b_rows)
    base = np.cumsum(lengths) - lengths
    a_size = np.fromiter(map(len, a_pieces), np.int64, len(a_pieces))[a_ids]
    b_size = np.fromiter(map(len, b_pieces), np.int64, len(b_pieces))[b_ids]
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)  # texts follow each other without a gap
    group = coalesce(
        np.concatenate((a_end - a_size, b_end - b_size)), np.concatenate((a_end, b_end)),
        np.repeat(np.array([0, 1], np.int8), (len(a_ids), len(b_ids))),
    )
    start = a_end - a_size - base[a_text]
    return Aligned(len(texts), a_ids, b_ids, group[: len(a_ids)], group[len(a_ids) :], a_text, b_text, start, start + a_size)


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their times."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(times[order], first)


def _products(na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For groups with so many A and B members: group, A place and B place of every pair."""
    sizes = na * nb
    group = np.repeat(np.arange(len(na)), sizes)
    at = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return group, at // nb[group], at % nb[group]


def linked_pairs(found: Aligned, b_vocabulary: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``text * width + a_id * b_vocabulary + b_id`` of linked tokens, in order, and how many links each stands for."""
    keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    na, nb = found.a_in, found.b_in
    a_first, b_first = np.cumsum(na) - na, np.cumsum(nb) - nb
    small = np.flatnonzero(na * nb <= WIDE)
    laid = np.cumsum(na[small] * nb[small])
    at = 0
    while at < len(small):
        stop = max(at + 1, int(np.searchsorted(laid, (laid[at - 1] if at else 0) + LAID_OUT, side="right")))
        some = small[at:stop]
        group, one, two = _products(na[some], nb[some])
        group = some[group]
        a, b = found.a_ids[a_first[group] + one], found.b_ids[b_first[group] + two]
        key, n = _summed(found.group_text[group] * width + a * b_vocabulary + b, np.ones(len(a), np.int64))
        keys.append(key)
        times.append(n)
        at = stop
    for group in np.flatnonzero(na * nb > WIDE):
        a, a_times = np.unique(found.a_ids[a_first[group] : a_first[group] + na[group]], return_counts=True)
        b, b_times = np.unique(found.b_ids[b_first[group] : b_first[group] + nb[group]], return_counts=True)
        wide = max(1, LAID_OUT // len(b))
        for start in range(0, len(a), wide):
            some = slice(start, start + wide)
            keys.append((found.group_text[group] * width + a[some, None] * b_vocabulary + b[None, :]).ravel())
            times.append((a_times[some, None] * b_times[None, :]).ravel())
    return _summed(np.concatenate(keys), np.concatenate(times))


class Writer:
    """Texts of groups: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, a_vocabulary: int, b_vocabulary: int):
        a, b = [str(i) for i in range(a_vocabulary)], [str(i) for i in range(b_vocabulary)]
        self.names = [f"{x},"  for x in a] + [f"{x}|" for x in a] + [f"{x}," for x in b] + [f"{x};" for x in b]
        self.a_last, self.b_first, self.b_last = len(a), 2 * len(a), 2 * len(a) + len(b)

    def digests(self, found: Aligned) -> list[str]:
        """The SHA-256 of each text's groups, empty for texts without tokens."""
        na, nb = found.a_in, found.b_in
        a_until, b_until = np.cumsum(na), np.cumsum(nb)
        a_name, b_name = found.a_ids.copy(), found.b_ids + self.b_first
        a_name[a_until - 1] += self.a_last
        b_name[b_until - 1] += self.b_last - self.b_first
        line = np.empty(len(a_name) + len(b_name), np.int64)
        line[np.arange(len(a_name)) + (b_until - nb)[found.a_group]] = a_name
        line[np.arange(len(b_name)) + a_until[found.b_group]] = b_name
        sizes = np.bincount(found.a_text, minlength=found.texts) + np.bincount(found.b_text, minlength=found.texts)
        out, start = [], 0
        for size in sizes.tolist():
            text = "".join(map(self.names.__getitem__, line[start : start + size].tolist()))
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if size else "")
            start += size
        return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts, a chunk at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            texts.append(text)
            size += len(text or "")
            if size >= CHUNK_CHARS or len(ids) >= CHUNK_ROWS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values, kind))


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_ALIGNED = (
    "chunk long, doc_id {id}, " + ", ".join(f"{c} long" for c in _COUNTS)
    + ", groups_sha256 string, at array<int>, times array<long>, pairs array<long>, holders array<int>"
)


def _aligning(tokenizers: Tokenizers, id_type: pa.DataType):
    """Rows of documents, whose ``at`` points into the pairs of their chunk, and a row of ``pairs`` for each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_size, b_size = len(tokenizers.a_pieces), len(tokenizers.b_pieces)
        writer, width = Writer(a_size, b_size), a_size * b_size
        chunk = TaskContext.get().partitionId() << 32
        for ids, texts in _chunks(batches):
            found = align(texts, tokenizers)
            keys, times = linked_pairs(found, b_size, width)
            owner = keys // width
            pairs, at, holders = np.unique(keys - owner * width, return_inverse=True, return_counts=True)
            n = len(ids)
            columns = [pa.array([chunk] * n, pa.int64()), pa.array(ids, id_type)]
            columns += [pa.array(x, pa.int64()) for x in found.counts()]
            sizes = np.bincount(owner, minlength=n)
            columns += [pa.array(writer.digests(found), pa.string()), _lists(at, sizes, pa.int32()), _lists(times, sizes, pa.int64())]
            columns += [pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))]
            names = ["chunk", "doc_id", *_COUNTS, "groups_sha256", "at", "times", "pairs", "holders"]
            rows = pa.RecordBatch.from_arrays(columns, names)
            yield rows
            own = {"chunk": pa.array([chunk]), "pairs": pa.array([pairs], pa.list_(pa.int64())), "holders": pa.array([holders], pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(1, f.type)) for f in rows.schema], names)
            chunk += 1

    return run


def _told(rows: pa.Table, told: pa.Table) -> pa.Table:
    """A chunk's documents with the sums of the counts of their links, and how many of these are the best of their A id."""
    place = told.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = told.column("count").to_numpy(), told.column("best").to_numpy()
    at, times = rows.column("at").combine_chunks(), rows.column("times").combine_chunks()
    index, weight = at.flatten().to_numpy(), times.flatten().to_numpy()
    owner = np.repeat(np.arange(rows.num_rows), at.value_lengths().to_numpy(zero_copy_only=False))
    total, top = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
    np.add.at(total, owner, count[index] * weight)
    np.add.at(top, owner, best[index] * weight)
    out = rows.select(["doc_id", *_COUNTS])
    for name, column in (("n_best", pa.array(top)), ("count_sum", pa.array(total)), ("groups_sha256", rows.column("groups_sha256"))):
        out = out.append_column(name, column)
    return out


def alignment(docs: DataFrame, tokenizers: Tokenizers, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    A is encoded from a blank and the whole text, B from the text.  A row is a document, also where ids are
    null or repeat.  Null and empty texts, and those that a tokenizer does not give back byte for byte, have
    no tokens: zeros, and an empty digest.  Other columns of ``docs`` are not read.  ``n_best`` counts the
    links whose pair is held by as many documents as any pair of its A id, ``count_sum`` adds up the
    numbers of documents over all links.  An empty table gives an empty table.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = _ALIGNED.format(id=id_type.simpleString())
    aligned = scratch.keep(rows.mapInArrow(_aligning(tokenizers, to_arrow_type(id_type)), schema), "aligned")
    each = aligned.where(F.col("pairs").isNotNull()).select("chunk", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "x"))
    each = each.select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.holders").alias("holders"))
    counts = scratch.keep(each.groupBy("pair").agg(F.sum("holders").alias("count")), "counts")
    a_id = F.col("pair") - F.col("pair") % F.lit(len(tokenizers.b_pieces))
    # one row for an id of A, so its size is bounded by the vocabulary
    best = F.broadcast(counts.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("most")))
    ranked = counts.join(best, a_id == F.col("a_id")).select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    told = each.select("chunk", "place", "pair").join(ranked, "pair").select(F.col("chunk").alias("asker"), "place", "count", "best")
    out = ", ".join([f"doc_id {id_type.simpleString()}", *(f"{c} long" for c in [*_COUNTS, "n_best", "count_sum"]), "groups_sha256 string"])
    own = aligned.where(F.col("pairs").isNull()).select("chunk", "doc_id", *_COUNTS, "groups_sha256", "at", "times")
    return own.groupBy("chunk").cogroup(told.groupBy("asker")).applyInArrow(_told, out)


def _spanning(tokenizers: Tokenizers, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            found = align(texts, tokenizers)
            if not found.groups:
                continue
            a_until = np.cumsum(found.a_in)
            a_first = a_until - found.a_in
            text = found.group_text
            first = np.searchsorted(text, text)  # the first group of the same text
            columns = [
                pa.array([ids[i] for i in text.tolist()], id_type), pa.array(np.arange(found.groups) - first, pa.int64()),
                pa.array(found.a_start[a_first], pa.int64()), pa.array(found.a_end[a_until - 1], pa.int64()),
                _lists(found.a_ids, found.a_in, pa.int32()), _lists(found.b_ids, found.b_in, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "group", "start", "end", "a_ids", "b_ids"])

    return run


def spans(docs: DataFrame, tokenizers: Tokenizers, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, group, start, end, a_ids, b_ids``: every group of every text, by its bytes in a blank and the text.

    Texts without tokens (see ``alignment``) have no row.  Nothing is shuffled.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, group long, start long, end long, a_ids array<int>, b_ids array<int>"
    return rows.mapInArrow(_spanning(tokenizers, to_arrow_type(kind)), schema)
