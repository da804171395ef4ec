"""Fill-in-the-middle against a regular expression, and the wavelet matrix against plain counts."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F
from test_texts import ODD_TEXTS

from tagloom.llm import fill_in_middle
from tagloom.llm.wavelet import WaveletMatrix
from tagloom.small import small_table

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MORE = ["a <P> b", "x<S>y", "<M>", "<P", "S> <", "< P>", "a b c", "  x ", "\x1c \x85", "a \n", "\t\x0b\x0c\r\n", "🙂 🙂🙂 漢 字", "퟿ z"]


def brute(i, text, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return i, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return i, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_the_pattern(spark, monkeypatch):
    rng = random.Random(12)
    texts = [*ODD_TEXTS, *MORE, *MORE] + ["".join(rng.choice("ab \n\té漢🙂<P>") for _ in range(rng.randrange(40))) for _ in range(400)]
    rows = [(None if i % 50 == 9 else i // 2, text) for i, text in enumerate(texts)]  # null and repeated ids
    frame = small_table(spark, rows, "doc_id long, text string").withColumn("form", F.lit("clash")).withColumn("output", F.lit(1)).withColumn("n", F.lit(2))
    want = sorted((brute(*r) for r in rows), key=repr)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    for size in (2_000_000, 50):
        monkeypatch.setattr(fill_in_middle, "SLICE_CHARS", size)
        assert rows_of(fill_in_middle.transform(frame.repartition(2))) == want
    back = fill_in_middle.transform(frame, seed=7, percent=100, suffix_first=30)
    again = back.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert rows_of(again) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_nothing_and_much(spark):
    none = small_table(spark, [], "doc_id long, text string")
    assert fill_in_middle.transform(none).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fill_in_middle.transform(none).count() == 0
    long = [(i, text) for i in range(20) for text in ("ab c" * 200_000, " " * 300_000, "x" * 300_000)]
    got = fill_in_middle.transform(small_table(spark, long, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute(*r) for r in long), key=repr)


def test_strings_as_ids(spark):
    frame = small_table(spark, [("a", "one two three"), (None, "x y")], "key string, body string")
    got = rows_of(fill_in_middle.transform(frame, id_column="key", text_column="body"))
    assert got == sorted([brute("a", "one two three"), brute(None, "x y")], key=repr)


def test_wavelet_matrix_counts():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1_000):
        symbols = rng.integers(0, 16, size).astype(np.uint8)
        matrix = WaveletMatrix(symbols, 4)
        stops = np.arange(size + 1)
        for s in range(16):
            assert (matrix.rank(s, stops) == [int((symbols[:p] == s).sum()) for p in stops]).all()
        some = (2, 3, 11)
        held = np.cumsum(np.concatenate(([0], np.isin(symbols, some))))
        wanted = np.arange(held[-1] + 2)
        found = matrix.select(some, wanted, np.zeros_like(wanted), np.full_like(wanted, size))
        assert found.tolist() == [int(np.argmax(held >= k)) if (held >= k).any() else size for k in wanted]
