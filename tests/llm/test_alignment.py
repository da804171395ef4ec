"""Cross-tokenizer alignment against the libraries and a brute force over bytes."""

import hashlib
import json
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_texts import ODD_TEXTS
from tokenizers import Tokenizer

from tagloom.llm import alignment
from tagloom.llm.scratch import Scratch
from tagloom.small import small_table

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MORE = ["<|endoftext|> a <s>b</s>", "a▁b", " " * 5_000 + "x" + "\t" * 2_000, "漢字" * 300 + "🙂", "the same words", "the same words", "é" * 40, "x" * 3_000]
NONE = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "n_best": 0, "count_sum": 0, "groups_sha256": ""}


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers.read(A_PATH, B_PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    return a, b


def byte_lengths_of_a():
    words = json.load(open(A_PATH, encoding="utf-8"))["model"]["vocab"]
    return {i: len(word) for word, i in words.items()}


def brute(texts, libraries):
    """Per text: its groups as lists of ids, by the offsets where tokens of both kinds end."""
    a_lib, b_lib = libraries
    size = byte_lengths_of_a()
    out = []
    for text in texts:
        if not text:
            out.append([])
            continue
        a, b = a_lib.encode(f" {text}", add_special_tokens=False).ids, b_lib.encode(text)
        b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_lib.id_to_piece(i)]]
        if b"".join(b_bytes) != f" {text}".encode():
            out.append([])
            continue
        a_ends, b_ends = np.cumsum([size[i] for i in a]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        groups, at = [], 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            groups.append(([i for i, e in zip(a, a_ends) if at < e <= cut], [i for i, e in zip(b, b_ends) if at < e <= cut]))
            at = cut
        out.append(groups)
    return out


def expected(texts, libraries):
    held = brute(texts, libraries)
    links = [defaultdict(int) for _ in held]
    holders = defaultdict(int)
    for groups, own in zip(held, links):
        for a, b in groups:
            for x in a:
                for y in b:
                    own[x, y] += 1
        for pair in own:
            holders[pair] += 1
    most = defaultdict(int)
    for (a, _), n in holders.items():
        most[a] = max(most[a], n)
    out = []
    for groups, own in zip(held, links):
        line = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append({
            "n_a": sum(len(a) for a, _ in groups), "n_b": sum(len(b) for _, b in groups), "n_groups": len(groups),
            "n_links": sum(own.values()), "n_best": sum(n for p, n in own.items() if holders[p] == most[p[0]]),
            "count_sum": sum(n * holders[p] for p, n in own.items()),
            "groups_sha256": hashlib.sha256(line.encode()).hexdigest() if groups else "",
        })
    return out


def made_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(["the ", "ab", "eri", " ", "\n", "é", "漢", "'s", "12", "tion", "🙂", " "]) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_against_brute_force(spark, both, libraries, monkeypatch):
    texts = ODD_TEXTS + MORE + made_texts(3, 60)
    texts = [t for t in texts if t is None or len(t) < 20_000]
    ids = [None if i % 17 == 3 else i // 2 for i in range(len(texts))]  # null and repeated ids
    want = expected(texts, libraries)
    frame = small_table(spark, list(zip(ids, texts)), "doc_id long, text string")
    for name in ("chunk", "at", "times", "pairs", "n_a", "count", "pair"):
        frame = frame.withColumn(name, F.lit("clash"))
    for chunk, laid, wide in ((2_000_000, 2_000_000, 1_024), (500, 7, 3)):
        monkeypatch.setattr(alignment, "CHUNK_CHARS", chunk)
        monkeypatch.setattr(alignment, "LAID_OUT", laid)
        monkeypatch.setattr(alignment, "WIDE", wide)
        got = alignment.alignment(frame.repartition(3), both, Scratch(spark, "t")).collect()
        key = lambda x: (x[0] is not None, x[0] or 0, sorted(x[1].items(), key=str))
        told = [(r.doc_id, {k: r[k] for k in NONE}) for r in got]
        assert sorted(told, key=key) == sorted(zip(ids, want), key=key)


def test_texts_without_tokens(spark, both):
    frame = small_table(spark, [(1, None), (2, ""), (3, "a▁b"), (None, None)], "doc_id long, text string")
    got = alignment.alignment(frame, both, Scratch(spark, "t")).collect()
    assert len(got) == 4 and all({k: r[k] for k in NONE} == NONE for r in got)
    assert alignment.alignment(frame.limit(0), both, Scratch(spark, "t")).count() == 0
    assert alignment.spans(frame, both).count() == 0


def test_spans_cover_every_text(spark, both, libraries):
    texts = [t for t in MORE + made_texts(4, 20) if t]
    frame = small_table(spark, [(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("group", F.lit("clash"))
    held = brute(texts, libraries)
    got = defaultdict(list)
    for r in alignment.spans(frame, both).collect():
        got[r.doc_id].append(r)
    for i, text in enumerate(texts):
        rows = sorted(got[i], key=lambda r: r.group)
        assert [(list(r.a_ids), list(r.b_ids)) for r in rows] == held[i]
        if rows:
            assert [r.start for r in rows] == [0, *(r.end for r in rows[:-1])] and rows[-1].end == len(f" {text}".encode())


def test_long_texts_and_wide_groups(both):
    """A million characters each: one word, one gap, and no common boundary for long."""
    for text in ("x" * 1_000_000, " " * 1_000_000, "ab" * 500_000):
        found = alignment.align([text, None, "the end"], both)
        n_a, n_b, n_groups, n_links = found.counts()
        assert n_a[0] and n_a[1] == 0 and n_a[2] == 2
        keys, times = alignment.linked_pairs(found, len(both.b_pieces), len(both.a_pieces) * len(both.b_pieces))
        assert times.sum() == n_links.sum() and len(np.unique(keys)) == len(keys)


def test_fast_and_slow_library_agree(both):
    texts = [f" {t}" for t in ODD_TEXTS + MORE + made_texts(5, 100) if t]
    assert both._a_fast is not None
    assert both.encode_a(texts) == [both._a.encode(t, add_special_tokens=False).ids for t in texts]
    swapped = json.loads(both.a_file)
    swapped["model"]["merges"][:3] = swapped["model"]["merges"][2::-1]
    odd = alignment.Tokenizers(json.dumps(swapped), both.b_file, both.pattern)
    assert odd._a_fast is None and odd.encode_a([" the"]) == [odd._a.encode(" the", add_special_tokens=False).ids]
