"""Tokens, language, toxicity, licences, chat, mixing and fixity: round trips, brute force and odd input."""

import base64
import hashlib
import os
import random
import re
import subprocess
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tagloom.llm import byte_pairs, chat, fixity, language, licences, mixing, toxicity
from tagloom.llm.queries import RANKS
from tagloom.llm.scratch import Scratch
from tagloom.small import small_table

ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "'s 'S don't we'll", "x" * 5_000, "ab" * 70_000, "  two  spaces \t tab nbsp line ", "Ünïcödé 漢字 かな 🙂👍🏽 é",
    "1234567890 ٣٤٥ ½", "!?$%&/()=", "</s>[INST]", " trailing ", "\u0000\u0001", "İstanbul KELVIN K", "word " * 3_000,
]


def text_frame(spark, made):
    return small_table(spark, list(enumerate(made)), "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("words", F.lit(1))


@pytest.fixture(scope="module")
def ranks():
    return byte_pairs.read_ranks(public_tokenizers.path(RANKS))


def test_byte_pairs_as_the_library(spark, ranks):
    rng = random.Random(2)
    made = ODD_TEXTS + ["".join(rng.choice("ab cé漢 \n'st1!") for _ in range(rng.randrange(200))) for _ in range(60)]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = byte_pairs.encode(text_frame(spark, made), ranks, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "words", "ids"]
    back = {r.doc_id: r for r in byte_pairs.decode(coded, ranks).collect()}
    for i, text in enumerate(made):
        assert back[i].ids == library.encode_ordinary(text or "")
        assert bytes(back[i].decoded) == (text or "").encode()
    told = {r.doc_id: r for r in byte_pairs.encode_and_check(text_frame(spark, made), ranks, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(made):
        ids = library.encode_ordinary(text or "")
        assert told[i].n_tokens == len(ids) and told[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert told[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_pairs.encode(text_frame(spark, made).limit(0).select("doc_id", "text"), ranks, public_tokenizers.PATTERN).count() == 0


def test_folds_agree(ranks):
    rng = random.Random(5)
    for _ in range(200):
        word = bytes(rng.choice(b"abetionth \xc3\xa9") for _ in range(rng.randrange(1, 60)))
        if word not in ranks:
            assert byte_pairs._fold_long(word, ranks) == byte_pairs.fold(word, ranks)


def language_rows(seed, n):
    rng = random.Random(seed)
    kinds = {"xx": "the of and tion ing".split(), "yy": "der und schön keit ung".split(), "zz": "ción los que ñas para".split()}
    return [(i, " ".join("".join(rng.choices(kinds[lang], k=2)) for _ in range(rng.randrange(8, 40))), lang) for i, lang in enumerate(rng.choices(list(kinds), k=n))]


def test_language_of_held_out_rows(spark):
    rows = language_rows(1, 400) + [(9_001, None, "xx"), (9_002, "", None), (9_003, " 12 !!", "yy"), (None, "der und schön keit", "yy"), (9_004, "und der ung " * 20_000, None)]
    frame = small_table(spark, rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit(1))
    got = language.languages_of(frame, Scratch(spark, "t")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    import zlib

    held = [(i, lang) for i, _, lang in rows[:400] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(by_id[i].held_out and by_id[i].lang_pred == lang for i, lang in held)
    assert all(0 <= r.score <= 1 for r in got)
    assert [by_id[i].lang_pred for i in (9_001, 9_002, 9_003, 9_004, None)] == ["und", "und", "und", "yy", "yy"]


def test_language_without_labels(spark):
    frame = small_table(spark, [(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language.languages_of(frame, Scratch(spark, "t")).collect()] == [("und", 0.0)]
    assert language.languages_of(frame.limit(0), Scratch(spark, "t")).count() == 0


def test_presence_kernel_by_hand():
    symbols, last = language.Symbols("abc"), language._space()
    assert len(language.grams("ab, ab!", symbols, last)) == len({"a", "b", " a", "ab", "b ", " ab", "ab ", "b a"})
    assert len(language.grams("12", symbols, last)) == 0 and len(language.grams(None, symbols, last)) == 0


def test_many_words_fold_as_one_by_one(ranks, monkeypatch):
    """The words of a slice are folded together, to the ids of ``fold``; only those that need no step or are long go one by one."""
    rng = random.Random(5)
    made = ["".join(rng.choice("abcdeinorst é漢\n'1!") for _ in range(rng.randrange(2, 60))) for _ in range(400)] + ["a", "", "the", "ab" * 64, "aaaa" * 9]
    words = [word.encode() for word in made]
    want = [byte_pairs.fold(word, ranks) if word else [] for word in words]
    few = {b"a": 3, b"b": 1, b"ab": 0, b"ba": 5, b"abab": 2, b"xy": 4}  # the bytes of a merge need no rank
    short = [b"ababab", b"xyab", b"baab", b"abxyba", b"bb"]
    assert [x.tolist() for x in byte_pairs.Merges(few).fold(short)] == [byte_pairs.fold(word, few) for word in short]
    with pytest.raises(KeyError):
        byte_pairs.Merges(few).fold([b"xab"])
    one, alone = byte_pairs.fold, []
    monkeypatch.setattr(byte_pairs, "fold", lambda word, ranks: alone.append(word) or one(word, ranks))
    batch = pa.RecordBatch.from_arrays([pa.array([[word] for word in made])], ["words"])
    got = [row for out in byte_pairs._encoding(ranks)(iter([batch])) for row in out.column(0).to_pylist()]
    assert got == want
    assert all(word in ranks or len(word) < 2 or len(word) > 128 for word in alone)


def toxic_rows(seed, n):
    rng = random.Random(seed)
    calm = ["".join(rng.choices("the re on in an er to is at or".split(), k=2)) for _ in range(150)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(calm, k=rng.randrange(5, 40))
        bad = i % 5 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_behind_disguise(spark):
    rows, labels = toxic_rows(3, 600)
    disguised = ["theon 1d10t reto", "theon m0r0n!!", "theon i d i o t reto", "theon moooron", "theon M.O.R.O.N reto"]
    calm = ["theon reto", "", None, "theon!! reto$$$ 1234", "reto " * 20_000, "a a a a a a"]
    more = [(10_000 + i, t) for i, t in enumerate(disguised + calm)]
    frame = small_table(spark, rows + more, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("toxic", F.lit(9))
    marks = small_table(spark, labels + [(20_000, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_of(frame, marks, Scratch(spark, "t")).collect()}
    assert len(got) == len(rows) + len(more) and all(0 <= r.score <= 1 for r in got.values())
    for i, _, toxic in labels:
        assert got[i].predicted == toxic
    assert [got[10_000 + i].predicted for i in range(len(more))] == [1] * len(disguised) + [0] * len(calm)


def test_toxicity_of_joined_runs_and_doubled_letters(spark):
    """Spaced-out words beside one-letter words and each other, and letters written twice."""
    rows, labels = toxic_rows(4, 600)
    rows = [(i, f"{text} {'a' if i % 2 else 'you'}") for i, text in rows]
    disguised = ["theon a i d i o t reto", "y o u i d i o t", "theon i d i o t m o r o n reto", "y-o-u-m-o-r-o-n", "theon iidiot", "theon idiiot reto",
                 "theon idioot!", "mmoorroonn", "theon 1diiot", "a i d i i o t"]
    calm = ["theon a y o u reto", "y o u a y o u", "theon idoot", "rretto", "a m o r e", "theonn aa"]
    more = [(10_000 + i, t) for i, t in enumerate(disguised + calm)]
    frame = small_table(spark, rows + more, "doc_id long, text string")
    marks = small_table(spark, labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_of(frame, marks, Scratch(spark, "t")).collect()}
    assert [got[10_000 + i].predicted for i in range(len(more))] == [1] * len(disguised) + [0] * len(calm)


def test_runs_split_into_seen_words():
    splitter = toxicity.Splitter({"a": 3.0, "you": 4.0, "idiot": 7.0, "ass": 8.0, "cl": 9.0, "boot": 9.0}, {"idiot", "bot", "stupi*"})
    assert splitter.parts("aidiot") == ["a", "idiot"] and splitter.parts("youidiotyou") == ["you", "idiot", "you"]
    assert splitter.parts("classy") == ["classy"] and splitter.parts("") == [] and splitter.parts("xqzv") == ["xqzv"]
    assert splitter.shortened("iddioott") == {"idiot"} and splitter.shortened("stuupiddity") == {"stupi*"}
    assert splitter.shortened("boot") == splitter.shortened("idiot") == splitter.shortened("stuupi") == set()


def test_every_labelled_row_is_learned_from(spark):
    """Telling words that show in three of 45,000 labelled rows only are all found; copies and held-out rows add nothing."""
    letters = lambda n: "".join(chr(97 + int(x)) for x in str(n))
    n, rare = 45_000, 15
    known = F.crc32(F.col("id").cast("string")) % 4 != 2
    kept = [r.id for r in spark.range(n).where(known).orderBy(F.xxhash64("id")).limit(3 * rare).collect()]
    marks = {i: f"zz{letters(k // 3)}" for k, i in enumerate(kept)}
    held = [r.id for r in spark.range(n).where(~known).limit(3).collect()]
    rows = [(i, f"reto {letters(i)} {marks.get(i, 'hidden' if i in held else 'calm')}") for i in range(n)]
    frame = small_table(spark, rows, "doc_id long, text string")
    labels = small_table(spark, [(i, int(i in marks or i in held)) for i in range(n)], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels, Scratch(spark, "t"))
    assert set(marks.values()) <= set(model.weights) and "hidden" not in model.weights
    assert model.seen["reto"] < model.seen["calm"] and min(model.weights[x] for x in marks.values()) > 0 > model.bias


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_labelled_texts_are_shuffled_once(spark, monkeypatch, threshold):
    """Few labels or many: the same texts, equal ones once a label, through one exchange that carries texts."""
    monkeypatch.setattr(toxicity, "_feature_rows", lambda channel: lambda batches: (
        pa.RecordBatch.from_arrays([b.column(0), pa.array([[x] for x in b.column(1).to_pylist()], pa.list_(pa.string()))], ["toxic", "features"]) for b in batches
    ))
    kept = [r.id for r in spark.range(100).where(F.crc32(F.col("id").cast("string")) % 4 != 2).limit(8).collect()]
    held = spark.range(100).where(F.crc32(F.col("id").cast("string")) % 4 == 2).first().id
    texts = ["a", "a", "b", "c", None, None, "", "d"]
    rows = [*zip(kept, texts), (kept[0], "a"), (kept[0], "e"), (held, "f"), (None, "g"), (1_000, "h")]
    marks = [(kept[0], 1), (kept[0], 0), (kept[1], 1), (kept[2], 0), (kept[3], None), (kept[4], 0), (kept[5], 0), (kept[6], 1), (held, 1), (None, 1), (kept[7], 0)]
    frame, labels = small_table(spark, rows, "doc_id long, text string"), small_table(spark, marks, "doc_id long, toxic int")
    plans, found = {}, {}

    class Watched(Scratch):
        def keep(self, df, name):
            plans[name] = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
            found[name] = super().keep(df, name)
            return found[name]

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        toxicity.fit(frame, labels, Watched(spark, "t"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(((r.toxic, r.features[0]) for r in found["labelled"].collect()), key=repr) == sorted(
        [(1, "a"), (1, "e"), (0, "b"), (0, None), (1, ""), (0, "d")], key=repr)
    exchanges = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput[^\n]*", plans["labelled"])
    assert sum("text#" in x for x in exchanges) == 1 and any("digest" in x for x in exchanges)


def test_plain_words_need_no_lattice(monkeypatch):
    """A word by itself or between marks is its own word; doubled letters, signs and separators are still looked into."""
    channel, asked = toxicity.Channel("abdiotlu", np.ones((toxicity._BASE, toxicity._BASE))), []
    monkeypatch.setattr(toxicity.Channel, "words_of", lambda self, tokens, one=toxicity.Channel.words_of: asked.extend(tokens) or one(self, tokens))
    text = "Idiot, (lull) 'stupidity'... boot add-on --doll id1ot b.a.d abbba 12 !bad ..."
    reader = toxicity.Reader(channel)
    first, again = reader.features([text, "idiot doll"]), reader.features(["idiot stupidity doll", "add-on"])
    assert sorted(asked) == sorted(["(lull)", "add-on", "id1ot", "b.a.d", "abbba", "12", "!bad", "..."])
    assert {"idiot", "lull", "stupidity", "stupi*", "boot", "add", "on", "doll", "bad"} <= first[0]
    assert first[1] == {"idiot", "doll"} and again == [{"idiot", "stupidity", "stupi*", "doll"}, {"add", "on"} | channel_words(channel, "add-on")]
    asked.clear()
    wanted = toxicity.Reader(channel, {"idiot", "stupi*", "doll", "lul"}, {"boot": 1.0, "doll": 1.0})
    assert wanted.features([text, "nothing"]) == [{"idiot", "stupi*", "doll", "lul"}, set()]
    assert set(asked) >= {"(lull)", "boot", "--doll"} and not set(asked) & {"idiot,", "'stupidity'...", "nothing"}


def channel_words(channel, token):
    return toxicity.features(set(channel.words_of([token])[token]))


def test_toxicity_without_labels(spark):
    frame = small_table(spark, [(1, "text"), (2, None)], "doc_id long, text string")
    marks = small_table(spark, [], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in toxicity.toxicity_of(frame, marks, Scratch(spark, "t")).collect()] == [0, 0]
    assert toxicity.toxicity_of(frame.limit(0), marks, Scratch(spark, "t")).count() == 0


def test_viterbi_finds_the_best_path():
    """Against all paths of the lattice."""
    rng = np.random.default_rng(0)
    channel = toxicity.Channel("abeilost", rng.random((toxicity._BASE, toxicity._BASE)) * 4)
    for text in ["1d10t", "l0$t", "a.b.c", "saaa5", "!b!", "0", "t00"]:
        best = None
        def walk(at, state, cost, out):
            nonlocal best
            if at == len(text):
                total = cost + channel.costs[state, 0]
                best = min(best, (total, out)) if best else (total, out)
                return
            choices, nothing = channel._lattice(text)[at]
            if nothing < toxicity._NEVER:
                walk(at + 1, state, cost + nothing, out)
            for symbol, letter, price in choices:
                walk(at + 1, symbol, cost + channel.costs[state, symbol] + price, out + letter)
        walk(0, 0, 0.0, "")
        assert channel.restore([text]) == [best[1]]


def odd_text(rng):
    return "".join(rng.choice("abeilost0134.$!ab") for _ in range(rng.randrange(1, 30))) + "0" * rng.randrange(20)


def test_windows_and_single_stretches_agree(monkeypatch):
    """Any window, any batch, and the way for one long stretch give the same letters."""
    rng = random.Random(11)
    channel = toxicity.Channel("abeilost", np.random.default_rng(4).random((toxicity._BASE, toxicity._BASE)) * 4)
    texts = [odd_text(rng) for _ in range(120)] + ["a" + "0$1" * 100 + "b", "5" * 300]
    want = channel.restore(texts)
    for window, at_once, base in ((3, 1 << 17, 64), (7, 50, 64), (512, 1, 64), (5, 1, 0)):
        monkeypatch.setattr(toxicity, "WINDOW", window)
        monkeypatch.setattr(toxicity, "AT_ONCE", at_once)
        if not base:
            monkeypatch.setattr(toxicity.Channel, "_forward", lambda self, best, line, tables, trace: self._forward_one(best[0], line[0], trace))
        assert channel.restore(texts) == want


def test_long_odd_tokens_stay_small():
    """A token of a million characters, and 512 of three thousand: below 300 MB."""
    code = """
import random, resource, sys
import numpy as np
from tagloom.llm import toxicity as t
channel = t.Channel("etaoinshrdlucmfw", np.random.default_rng(0).random((t._BASE, t._BASE)) * 4)
start, rng, signs = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, random.Random(1), "abcdefghijklmnopqrstuvwxyz0123456789+/"
reader = t.Reader(channel, {"idiot"}, {"idiot": 3.0, "a": 1.0})
some = lambda n: "".join(rng.choices(signs, k=n))
reader.features([some(1_000_000), " ".join(some(3_000) for _ in range(512)), "z" + "0" * 100_000])
assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start) >> 10 < 300
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def test_splitter_against_all_splits():
    rng = random.Random(7)
    costs = {"a": 3.0, "ab": 4.0, "bab": 6.5, "cc": 5.0, "abc": 7.0}
    splitter = toxicity.Splitter(costs, ())

    def price(words):
        return sum(costs.get(w, splitter.unseen + toxicity.UNSEEN_LETTER * len(w)) for w in words)

    def splits(run):
        return [[]] if not run else [[run[:i], *rest] for i in range(1, len(run) + 1) for rest in splits(run[i:])]

    for _ in range(60):
        run = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 10)))
        found = splitter.parts(run)
        assert "".join(found) == run and abs(price(found) - min(map(price, splits(run)))) < 1e-9


def test_score_is_the_logistic_sum():
    channel = toxicity.Channel("abdiot", np.ones((toxicity._BASE, toxicity._BASE)))
    model = toxicity.Model(channel, {"idiot": 2.5, "bad": 1.0, "idiot*": 9.0}, -1.5, {"bad": 1.0})
    got = model.scores(["BAD idiot bad", "good", None, "bad"], toxicity.Reader(channel, set(model.weights), model.seen))
    assert np.allclose(got, [1 / (1 + np.exp(-x)) for x in (2.0, -1.5, -1.5, -0.5)])


def dice(one, other):
    a, b = set(licences._pairs(licences._words(one))), set(licences._pairs(licences._words(other)))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licences_by_brute_force(spark):
    rng = random.Random(8)
    made = list(ODD_TEXTS)
    for _ in range(80):
        words = rng.choice(list(licences.TEMPLATES.values())).split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(["license", "the", "x", "version"])
        made.append(rng.choice(["", "text before\n", "para\n\n"]) + " ".join(words) + rng.choice(["", "\nafter", "\n\nmore\nlines"]))
    want = {}
    for i, text in enumerate(made):
        units = set((text or "").split("\n")) | set((text or "").split("\n\n")) | {text or ""}
        for name, body in licences.TEMPLATES.items():
            found = [d for d in (dice(u, body) for u in units) if d >= 0.8]
            if found:
                want[i, name] = (max(found), len(found))
    frame = text_frame(spark, made).withColumn("unit", F.lit(0)).withColumn("normal", F.lit(0))
    got = {(r.doc_id, r.licence): (r.dice, r.n_units) for r in licences.licences(frame).collect()}
    assert got == want
    assert licences.licences(frame.limit(0)).count() == 0


CLASHES = ["</s>", "[INST] x [/INST]", " [/INST]", "[\\INST]", "<\\\\s>", "[/ROLE] </s><s>[ROLE] a\nb [/ROLE]", "<s", "[", "\\", "", None, "a\nb", "[INST", "<<s>>", "x" * 50_000, "</s> </s>"]


def test_chat_round_trip(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "to ol\n[/ROLE]", "", None]), "".join(x or "" for x in rng.choices(CLASHES, k=2)) if rng.random() < 0.8 else rng.choice(CLASHES)))
    rows += [(None, 1, "user", "no conversation"), (61, None, "assistant", "x"), (61, None, "assistant", "x")]
    frame = small_table(spark, rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("turns", F.lit(2))
    got = chat.format_conversations(frame).collect()
    for r in got:
        own = sorted(((t, role or "", text or "") for conv, t, role, text in rows if conv == r.conv_id), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        assert r.same and [tuple(x) for x in r.turns] == [x[1:] for x in own]
    assert len(got) == 62
    for r in chat.digests(chat.format_conversations(frame)).collect():
        source = next(x for x in got if x.conv_id == r.conv_id)
        loss = "".join(x.text for x in source.turns if x.role == "assistant")
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(source.formatted))
    assert chat.format_conversations(frame.limit(0)).count() == 0


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 50, **{f"s{i}": 1 for i in range(50)}}, {"a": 7, "b": 11, "c": 13, "d": 90}])
def test_schedule_keeps_every_window(spark, weights):
    total = sum(weights.values())
    slots = sorted((r.place, r.pool, r.turn) for r in mixing.schedule(spark, weights).collect())
    assert [(p, t, place) for place, p, t in slots] == mixing.windows_in_sql(weights)
    given = dict.fromkeys(weights, 0)
    for n, (_, pool, _) in enumerate(slots, 1):
        given[pool] += 1
        assert all(abs(given[p] - n * w / total) < 1 for p, w in weights.items())


def test_mixing_keeps_all_rows(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "t") for i in range(900)] + [(None, None, None), (5, "hot", "t"), (5, "hot", "t"), (7, "", "")]
    frame = small_table(spark, rows, "doc_id long, source string, text string").withColumn("pool", F.lit("clash")).withColumn("rank", F.lit(0)).withColumn("block", F.lit(0))
    weights = {"hot": 4, "s0": 2, "s3": 2}
    mix = mixing.mixed(frame, weights, 2, 4)
    got = mix.select("row.doc_id", "row.source", "pool", "block", "slot", "position").collect()
    assert len(got) == len(rows) and len({r.position for r in got}) == len(rows)
    blocks = {}
    for r in got:
        assert r.position // 4 == r.slot and r.pool == (r.source if r.source in weights else "*")
        assert blocks.setdefault(r.slot, (r.pool, r.block)) == (r.pool, r.block)
    ordered = mixing.in_mixed_order(mix)
    assert ordered.columns == frame.columns
    assert [r.doc_id for r in ordered.collect()] == [r.doc_id for r in sorted(got, key=lambda r: r.position)]
    assert mixing.mixed(frame.limit(0), weights, 2, 4).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(frame, {"a": 0}, 1, 4)


def page_rows(n):
    return [(i, f"http://x/{i}", "<p>" + "body é " * (i % 40) + "</p>") for i in range(n)] + [(None, "u", "v"), (3, None, None), (3, "http://x/3", "again")]


def test_fixity_finds_the_planted_damage(spark, monkeypatch):
    monkeypatch.setattr(fixity, "RANGE_BYTES", 512)
    monkeypatch.setattr(fixity, "FAN", 4)
    pages = small_table(spark, page_rows(700), "page_id long, url string, html string").withColumn("record", F.lit("clash"))
    records = fixity.warc_records(pages)
    whole = fixity.leaves(records)
    assert fixity.audit(whole, fixity.leaves(records), Scratch(spark, "t")).count() == 0
    got = {(r.record_id, r.fault) for r in fixity.audit(whole, fixity.leaves(fixity.damaged(records)), Scratch(spark, "t")).collect()}
    want = {(i, "missing") for i in range(700) if i % 211 == 5} | {(i, "changed") for i in range(700) if i % 97 == 3 and i % 211 != 5}
    assert got == want | {(i, "extra") for i in range(700) if i % 307 == 7 and i % 211 != 5}
    one = records.collect()
    sizes = {}
    for r in sorted(one, key=lambda r: (r.file_id, r.record_id, hashlib.sha256(r.record).hexdigest())):
        at = sizes.get(r.file_id, 0)
        sizes[r.file_id] = at + len(r.record)
    placed = fixity.index(whole).groupBy("file_id").agg(F.max(F.col("offset") + F.col("length"))).collect()
    assert {r[0]: r[1] for r in placed} == sizes


def test_fixity_of_empty_tables(spark):
    none = fixity.leaves(fixity.warc_records(small_table(spark, [], "page_id long, url string, html string")))
    some = fixity.leaves(fixity.warc_records(small_table(spark, page_rows(3), "page_id long, url string, html string")))
    assert fixity.audit(none, none, Scratch(spark, "t")).count() == 0
    assert {r.fault for r in fixity.audit(some, none, Scratch(spark, "t")).collect()} == {"missing"}
    assert {r.fault for r in fixity.audit(none, some, Scratch(spark, "t")).collect()} == {"extra"}


def test_rank_file_is_read_whole(ranks):
    lines = open(public_tokenizers.path(RANKS), "rb").read().splitlines()
    assert len(ranks) == len(lines) == 50_256 and ranks[base64.b64decode(lines[-1].split()[0])] == 50_255
