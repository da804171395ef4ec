"""Near-duplicates, vector joins and top-k search against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import links, near_text, near_vectors, shingles, top_inner
from tagloom.llm.scratch import Scratch
from tagloom.small import small_table


def closure(ids, linked):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x09\x0a\x0b\x0c\x0d":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def shingled(text, size):
    words = words_of(text)
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def texts(seed, originals, copies):
    rng = random.Random(seed)
    made = []
    for _ in range(originals):
        words = [rng.choice("alpha beta Gamma delta épsilon zeta eta theta iota kappa".split()) + str(rng.randrange(90)) for _ in range(rng.randrange(3, 90))]
        made.append(" ".join(words))
        for _ in range(rng.randrange(copies)):
            other = list(words)
            for _ in range(rng.randrange(3)):
                other[rng.randrange(len(other))] = "changed" + str(rng.randrange(5))
            made.append(rng.choice([" ", "\n", "\t "]).join(other))
    made += ["", None, " \n", "one", "ONE", "one two", "one  two", "  ", "a b c d", "a b c d e"]
    return made


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    pairs += [(1_000, i) for i in range(1_001, 1_300)]
    frame = small_table(spark, pairs, "a long, b long").repartition(7)
    want = closure({x for p in pairs for x in p}, pairs)
    for finish in (0, 10**6):
        got = dict(map(tuple, links.components(frame, Scratch(spark, "t"), f"c{finish}", finish).collect()))
        assert got == {i: low for i, low in want.items() if i != low}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(spark, size):
    made = texts(size, 60, 6)
    frame = small_table(spark, list(enumerate(made)), "doc_id long, text string").withColumn("digest", F.lit(1)).withColumn("component", F.lit("x"))
    got = {r.doc_id: r for r in near_text.near_duplicates(frame, Scratch(spark, "t"), size=size).collect()}
    sets = [shingled(t, size) for t in made]
    linked = [(i, j) for i in range(len(made)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    low = closure(range(len(made)), linked)
    assert {i: r.component_id for i, r in got.items()} == low
    assert all(r.n_shingles == len(sets[i]) and r.kept == (low[i] == i) for i, r in got.items())


def test_dense_groups_settle_in_blocks(spark, monkeypatch):
    """Many near copies around the threshold; tiny blocks, and every block with a pair counts as dense."""
    monkeypatch.setattr(near_text, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(near_text, "HANDED_ON", 0)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    made = []
    for _ in range(50):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        made.append(" ".join(words))
    frame = small_table(spark, list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_text.near_duplicates(frame, Scratch(spark, "t"), size=4).collect()}
    sets = [shingled(t, 4) for t in made]
    linked = [(i, j) for i in range(50) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert got == closure(range(50), linked)


def test_near_duplicates_of_odd_rows(spark):
    empty = small_table(spark, [], "doc_id long, text string")
    assert near_text.near_duplicates(empty, Scratch(spark, "t")).count() == 0
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, long), (4, long + " end"), (5, None)]
    got = near_text.near_duplicates(small_table(spark, rows, "doc_id long, text string"), Scratch(spark, "t")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 3, False), (5, 5, True)]


def test_sketches_estimate_resemblance():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        found = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
            cut = int(400 * share)
            rest = (400 - cut) // 2
            a, b = pool[: cut + rest], np.concatenate((pool[:cut], pool[cut + rest :]))
            found.append((shingles.sketch(a, 128) == shingles.sketch(b, 128)).mean())
        assert abs(np.mean(found) - share) < 0.03
    assert len(shingles.sketch(np.array([5], dtype=np.uint64), 128)) == 128


def vectors(seed, n, dims):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    near = base[rng.integers(0, n, n)] + rng.normal(scale=0.18, size=(n, dims))
    same = base[rng.integers(0, 5, n // 4)] * 1.0
    return np.concatenate((base, near, same)).astype(np.float32)


def vector_frame(spark, made, extra=()):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(made)] + list(extra)
    return small_table(spark, rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("tag", F.lit("clash"))


ODD = [(9_000, None), (9_001, [0.0] * 8), (9_002, [float("nan")] + [1.0] * 7), (9_003, [float("inf")] + [1.0] * 7), (9_004, [None] + [1.0] * 7), (9_005, []), (None, [1.0] * 8)]


@pytest.mark.parametrize("block", [16, 4_096])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    monkeypatch.setattr(near_vectors, "VECTORS_A_PIVOT", 20)
    made = vectors(3, 150, 8)
    got = {r.vec_id: r for r in near_vectors.near_vectors(vector_frame(spark, made, ODD), Scratch(spark, "t")).collect()}
    units = made.astype(float) / np.linalg.norm(made.astype(float), axis=1)[:, None]
    link = units @ units.T >= 0.9
    np.fill_diagonal(link, False)
    low = closure(range(len(made)), list(zip(*np.nonzero(link))))
    for i in range(len(made)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[i].sum(), low[i], low[i] == i)
    for i in range(9_000, 9_006):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].component_id is None and got[None].kept


@pytest.mark.parametrize("twin", [0.0, near_vectors._TWIN])
def test_near_vectors_of_one_direction(spark, monkeypatch, twin):
    """A third of the rows are multiples of one vector, so pivots share its direction; also if none is dropped."""
    monkeypatch.setattr(near_vectors, "_TWIN", twin)
    monkeypatch.setattr(near_vectors, "VECTORS_A_PIVOT", 20)
    rng = np.random.default_rng(3)
    one = rng.normal(size=8)
    close = one + rng.normal(scale=0.3, size=(400, 8))
    made = np.concatenate((one * rng.uniform(0.1, 9, size=(400, 1)), close, rng.normal(size=(400, 8)))).astype(np.float32)
    got = {r.vec_id: r for r in near_vectors.near_vectors(vector_frame(spark, made), Scratch(spark, "t")).collect()}
    units = made.astype(float) / np.linalg.norm(made.astype(float), axis=1)[:, None]
    link = units @ units.T >= 0.9
    np.fill_diagonal(link, False)
    low = closure(range(len(made)), list(zip(*np.nonzero(link))))
    assert [(got[i].n_links, got[i].component_id) for i in range(len(made))] == [(link[i].sum(), low[i]) for i in range(len(made))]


def test_vectors_of_odd_tables(spark):
    empty = small_table(spark, [], "vec_id long, embedding array<float>")
    assert near_vectors.near_vectors(empty, Scratch(spark, "t")).count() == 0
    assert top_inner.top_inner(empty, Scratch(spark, "t"), lambda i: i % 20 == 0).count() == 0
    two = small_table(spark, [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_inner.top_inner(two, Scratch(spark, "t"), lambda i: i == 0).collect()] == [(0, 1, 1, 64 * 128)]
    same = {(r.vec_id, r.n_links, r.component_id) for r in near_vectors.near_vectors(two, Scratch(spark, "t")).collect()}
    assert same == {(0, 1, 0), (1, 0, 1)}


@pytest.mark.parametrize("scale", [64.0, 3.0, 2.0**36])
def test_top_inner(spark, monkeypatch, scale):
    monkeypatch.setattr(top_inner, "BLOCK", 32)
    monkeypatch.setattr(top_inner, "VECTORS_A_PIVOT", 40)
    monkeypatch.setattr(top_inner, "QUERIES", 7)
    made = vectors(5, 160, 8) / (300 if scale > 64 else 1)
    got = sorted(map(tuple, top_inner.top_inner(vector_frame(spark, made, ODD[:1] + ODD[2:5] + ODD[6:]), Scratch(spark, "t"), lambda i: i % 20 == 0, k=6, scale=scale).collect()))
    whole = [[int(np.floor(scale * float(x))) for x in v] for v in made]
    want = []
    for q in range(0, len(made), 20):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in enumerate(whole) if i != q)[:6]
        want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    assert got == want


def test_copies_are_written_in_bounded_batches():
    """2,048 pivots and 8,192 annuli of several blocks, all of them open: no output batch outgrows its bound."""
    rng = np.random.default_rng(9)
    dims, n = 64, 300
    pivots = near_vectors._unit(rng.normal(size=(2_048, dims)))
    rows = rng.normal(size=(n, dims))
    plain = pa.RecordBatch.from_arrays([pa.array(list(rows)), pa.array(range(n)), pa.array(range(n)), pa.array([1] * n)], ["v", "id", "tag", "weight"])
    homes = list(near_vectors._homing(pivots, dims)([plain]))
    assert sum(b.num_rows for b in homes) == n
    copies = 0
    for batch in near_vectors._replicating(pivots, np.full(2_048, 2.0), 2.0, dims)(homes):
        assert batch.nbytes < 64 << 20
        copies += batch.num_rows
    assert copies > 100 * n

    annuli = top_inner._Annuli([(i // 8, i % 8, 1 + i % 40, 4_096, 0.1 * (i % 8), 0.1 * (i % 8 + 1)) for i in range(8_192)], rng.normal(size=(1_024, dims)), 500.0)
    queries = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array([v.tobytes() for v in rows], pa.binary()), pa.nulls(n, pa.float64())], ["query_id", "vector", "floor"]
    )
    sent = 0
    for batch in top_inner._routing(annuli, dims, 0, 8_192)([queries.slice(0, 40)]):
        assert batch.nbytes < 64 << 20
        sent += batch.num_rows
    assert sent == 40 * int(annuli.parts.sum())


def test_annuli_expand_in_order_and_stop_at_the_floor():
    rng = np.random.default_rng(2)
    annuli = top_inner._Annuli([(i // 8, i % 8, 1, 10, 0.5 * (i % 8), 0.5 * (i % 8) + 0.5) for i in range(64)], rng.normal(size=(8, 4)), 30.0)
    rows = rng.normal(size=(5, 4))
    ceilings = annuli.ceilings(rows)
    floor = np.sort(ceilings, axis=1)[:, 40]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([v.tobytes() for v in rows], pa.binary()), pa.array(floor)], ["query_id", "vector", "floor"])
    seen = {i: [] for i in range(5)}
    for start, stop in ((0, 1), (1, 9), (9, 73)):
        for out in top_inner._routing(annuli, 4, start, stop)([batch]):
            for r in out.to_pylist():
                seen[r["query_id"]].append(ceilings[r["query_id"], r["cell"] * 8 + r["ring"]])
    for i, found in seen.items():
        assert found == sorted(ceilings[i][ceilings[i] >= floor[i]], reverse=True)


def test_vectors_of_extreme_length(spark):
    """Norms and scores beyond doubles and 64 bits."""
    rows = [(0, [1e200, 2e200]), (1, [1e-200, 2e-200]), (2, [1.0, 2.0]), (3, [-1e300, 1e300]), (4, [3.0, 0.0])]
    frame = small_table(spark, rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(frame, Scratch(spark, "t")).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (0, 3), 4: (0, 4)}
    found = sorted(map(tuple, top_inner.top_inner(frame, Scratch(spark, "t"), lambda i: i < 9, k=4).collect()))
    clip = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    whole = {i: [int(np.floor(64 * x)) if abs(x) < 1e10 else int(64 * x) for x in v] for i, v in rows}
    want = []
    for q in whole:
        best = sorted((-clip(sum(a * b for a, b in zip(whole[q], whole[i]))), i) for i in whole if i != q)
        want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    assert found == want
