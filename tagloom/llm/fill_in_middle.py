"""Fill-in-the-middle: texts cut twice at unit boundaries and put in another order, and back.

A unit is a run of visible characters with the white space before it; white space at the end of a text is a
unit of its own.  White space is the six ASCII characters.  A unit thus ends where a visible character
stands before white space or the end, or white space before the end: a question to the classes of
two neighbours.  A wavelet matrix over these pairs of classes counts boundaries by ranks and finds both cuts
by bisection.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Characters of a slice of texts, at least: what a task works on at once; a longer text is a slice of its own.
SLICE_CHARS = 2_000_000

#: Classes of characters: blanks, other white space, ASCII letters and digits, all others.
BLANK, BREAK, WORD, OTHER = range(4)
_END = BLANK  # what follows the last character is white space
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[0x20], _CLASS[0x09:0x0E] = BLANK, BREAK
for _first, _last in ("09", "az", "AZ"):
    _CLASS[ord(_first) : ord(_last) + 1] = WORD
#: Pairs of classes, the second one's after the first, between which a unit ends.
ENDS = tuple(4 * one + two for one in (WORD, OTHER) for two in (BLANK, BREAK))


def pair_classes(points: np.ndarray, last: np.ndarray) -> np.ndarray:
    """4 x class + next class of each character; ``last`` are the places of the last characters of texts."""
    own = _CLASS[np.minimum(points, 255)]
    after = np.concatenate((own[1:], [_END])).astype(np.uint8)
    after[last] = _END
    return 4 * own + after


@dataclass
class Cuts:
    """Per text: units, the two cuts as numbers of units, and as numbers of characters."""

    units: np.ndarray
    first_units: np.ndarray
    last_units: np.ndarray
    first: np.ndarray
    last: np.ndarray


def cut(texts: list[str], one: np.ndarray, two: np.ndarray) -> Cuts:
    """Cuts each text after ``one % (n + 1)`` and ``two % (n + 1)`` of its n units, the smaller first."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    stops = np.cumsum(sizes)
    starts = stops - sizes
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    matrix = WaveletMatrix(pair_classes(points, stops[sizes > 0] - 1), 4)
    before = matrix.count(ENDS, starts)
    whole = matrix.count(ENDS, stops) - before  # units that end in a visible character
    some = sizes > 0
    trailing = np.zeros(len(texts), np.int64)
    trailing[some] = _CLASS[np.minimum(points[stops[some] - 1], 255)] <= BREAK
    units = whole + trailing
    a, b = (one % (units + 1).astype(np.uint64)).astype(np.int64), (two % (units + 1).astype(np.uint64)).astype(np.int64)
    low, high = np.minimum(a, b), np.maximum(a, b)
    place = [np.where(k > whole, stops, matrix.select(ENDS, before + k, starts, stops)) - starts for k in (low, high)]
    return Cuts(units, low, high, *place)


def draws(row_id, seed: int) -> list[int]:
    """Four 32-bit numbers of a row: the first digits of the digest of ``seed:id``; a null id is empty."""
    text = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    return [int(text[i : i + 8], 16) for i in range(0, 32, 8)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            texts.append(text or "")
            size += len(texts[-1])
            if size >= SLICE_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def _transforming(seed: int, percent: int, suffix_first: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            drawn = np.array([draws(i, seed) for i in ids], dtype=np.uint64).reshape(-1, 4)
            found = cut(texts, drawn[:, 0], drawn[:, 1])
            forms, prefixes, middles, out = [], [], [], []
            for text, (_, _, three, four), first, last in zip(texts, drawn.tolist(), found.first.tolist(), found.last.tolist()):
                if not text or three % 100 >= percent or PREFIX in text or SUFFIX in text or MIDDLE in text:
                    forms.append(PLAIN)
                    prefixes.append(None)
                    middles.append(None)
                    out.append(text)
                    continue
                prefix, middle, suffix = text[:first], text[first:last], text[last:]
                spm = four % 100 < suffix_first
                forms.append(SPM if spm else PSM)
                prefixes.append(first)
                middles.append(last - first)
                out.append("".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle) if spm else (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(found.units, pa.int64()), pa.array(forms), pa.array(prefixes, pa.int64()),
                 pa.array(middles, pa.int64()), pa.array(out, pa.string())], _COLUMNS,
            )

    return run


def transform(
    docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``, without a shuffle.

    ``percent`` of the rows are cut, ``suffix_first`` in a hundred of these in the form ``spm``; draws depend
    on ``seed`` and the id alone, so repeated ids draw alike and a null id as an empty one.  Null texts count as
    empty; these, and texts that hold a marker, stay plain, with null lengths.  Lengths are in code points.
    Other columns of ``docs`` are not read.  A task holds about 10 bytes a character of a slice.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(_transforming(seed, percent, suffix_first, to_arrow_type(kind)), schema)


def restored(output: Column, form: Column) -> Column:
    """The text behind an output.  A cut text holds no marker and markers cannot overlap, so three parts lie between them."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
