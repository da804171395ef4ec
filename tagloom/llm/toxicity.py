"""Toxicity behind a noisy channel: Viterbi restoration of disguised words, then a linear score of the words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.language import held_out
from tagloom.llm.scratch import Scratch
from tagloom.llm.vectors import slices, small_batches

#: Words and word beginnings that may carry weight, and what a candidate must show.
LEXICON = 2_000
LEAST_TOXIC = 3
LEAST_PRECISION = 0.8
#: Words that count as seen, at most, and the labelled rows that show one.
VOCABULARY = 50_000
LEAST_SEEN = 3
#: Cost in nats of a letter of a word that was not seen.
UNSEEN_LETTER = 3.3
#: Letters of the character model; all others share one symbol.
LETTERS = 62
#: Share of the character model that any symbol may follow any other: disguised words need not be usual ones.
EVEN = 0.2
RIDGE = 0.01
#: A toxic row counts as so many others when fitting: a miss costs more than a false alarm.
TOXIC_WEIGHT = 3.0
THRESHOLD = 0.3

#: The letters that a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
#: Costs in nats of the channel, for a sign that stands between, before or after a token's letters: the
#: sign is a letter, or it is only a sign.
SIGN_COSTS = {"between": (0.5, 6.0), "before": (0.5, 6.0), "after": (3.0, 0.5)}
#: A third or later repetition is left out; a separator between single characters is left out, or kept.
REPEAT_COST, JOIN_COST, PART_COST = 0.0, 0.0, 8.0
_SIGNS = "".join(STANDS_FOR)
_BEGINNING = 5
_BASE = LETTERS + 2  # 0 is the edge of a word, the last symbol any other letter
_NEVER = 1e9
#: Characters of disguised tokens that are decoded at once, those of a window, and the kinds of characters remembered.
AT_ONCE = 1 << 17
WINDOW = 512
_KINDS = 20_000

_SPACED = re.compile(r"(?<!\S)\S(?:[ ._*-]\S){2,}(?!\S)")
_TOKEN = re.compile(r"\S+")
_ODD = re.compile(r"(?:[^\W\d_][" + re.escape(_SIGNS) + r"]|[" + re.escape(_SIGNS) + r"][^\W\d_])|([^\W\d_])\1\1|[^\W\d_][ ._*-][^\W\d_][ ._*-][^\W\d_]")
_WORDS = re.compile(r"[^\W\d_]+")
_SPREAD = re.compile(r"\S[ ._*-]\S[ ._*-]\S")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_TRIPLED = re.compile(r"([^\W\d_])\1\1")
#: Around one word these change nothing: no letter and no sign that stands for one is among them.
_AROUND = ".,;:?\"'`)]}[{/\\-_*#~%&=>"


class Channel:
    """The lattice decoder: ``letters`` of the character model and its costs of one symbol after another.

    A letter that is no repetition can only be itself, so all paths meet there: the lattice of a text falls
    into stretches between such letters, which are decoded on their own, equal ones once.  A long stretch keeps
    only the costs at every ``WINDOW``-th character and takes its windows again, backwards, for the path.
    """

    def __init__(self, letters: str, costs: np.ndarray):
        self.letters, self.costs = letters, costs
        self.number = {letter: i + 1 for i, letter in enumerate(letters)}
        self._forget()

    def __getstate__(self):
        return self.letters, self.costs

    def __setstate__(self, state):
        self.__init__(*state)

    def _forget(self) -> None:
        """The kinds of characters met so far: what one may have been, (symbol, text, cost) each, and the cost of it being nothing."""
        self.kinds: list[tuple[list[tuple[int, str, float]], float]] = []
        self.known: dict[tuple[str, object], int] = {}

    def _kind(self, char: str, place) -> int:
        found = self.known.get((char, place))
        if found is None:
            if char.isalpha():
                made = [(self.number.get(char, _BASE - 1), char, 0.0)], REPEAT_COST if place else _NEVER
            elif char in STANDS_FOR:
                meant, alone = SIGN_COSTS[place]
                made = [*((self.number.get(x, _BASE - 1), x, meant) for x in STANDS_FOR[char]), (0, " ", alone)], alone
            else:
                made = [(0, " ", PART_COST if place == "between" else 0.0)], JOIN_COST
            found = self.known[char, place] = len(self.kinds)
            self.kinds.append(made)
        return found

    def _read(self, text: str) -> list[int]:
        """The kind of every character: letters by whether they may be left out as a repetition, others by where they stand."""
        letters = [i for i, char in enumerate(text) if char.isalpha()]
        first, last = (letters[0], letters[-1]) if letters else (len(text), -1)
        run, out = 0, []
        for at, char in enumerate(text):
            run = run + 1 if at and text[at - 1] == char else 1
            if char.isalpha():
                place = run > 1 and (run > 2 or text[at + 1 : at + 2] == char)
            else:
                place = "before" if at < first else "after" if at > last else "between"
            out.append(self._kind(char, place))
        return out

    def _lattice(self, text: str) -> list[tuple[list[tuple[int, str, float]], float]]:
        return [self.kinds[kind] for kind in self._read(text)]

    def restore(self, texts: list[str]) -> list[str]:
        """The likeliest letters behind each text."""
        out: list[str] = []
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= AT_ONCE or i + 1 == len(texts):
                out += self._restore(texts[start : i + 1])
                start, size = i + 1, 0
        return out

    def _restore(self, texts: list[str]) -> list[str]:
        if len(self.kinds) > _KINDS:
            self._forget()
        stretches: dict[tuple, int] = {}
        plans = []
        for text in texts:
            kinds, plan, state, start = self._read(text), [], 0, 0
            for at, kind in enumerate(kinds):
                choices, nothing = self.kinds[kind]
                if at + 1 == len(kinds) or (nothing >= _NEVER and len(choices) == 1):
                    ends = at + 1 == len(kinds)
                    plan.append(stretches.setdefault((state, ends, *kinds[start : at + 1]), len(stretches)))
                    state, start = choices[0][0], at + 1
            plans.append(plan)
        keys = list(stretches)
        found = [""] * len(keys)
        order = sorted(range(len(keys)), key=lambda i: len(keys[i]))
        while order:  # the longest ones first: a batch is as wide as its first
            wide = len(keys[order[-1]]) - 2
            rows = max(1, AT_ONCE // (4 * min(wide, WINDOW) + wide))
            some, order = order[-rows:], order[:-rows]
            for i, text in zip(some, self._decode([keys[i] for i in some])):
                found[i] = text
        return ["".join([found[i] for i in plan]) for plan in plans]

    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbol and cost of every choice of every kind, and the cost of nothing; the last row stands for the end of a shorter text."""
        wide = max(len(choices) for choices, _ in self.kinds)
        symbol, cost = np.zeros((len(self.kinds) + 1, wide), np.int64), np.full((len(self.kinds) + 1, wide), _NEVER)
        nothing = np.zeros(len(self.kinds) + 1)
        for i, (choices, price) in enumerate(self.kinds):
            nothing[i] = price
            for j, (number, _, own) in enumerate(choices):
                symbol[i, j], cost[i, j] = number, own
        return symbol, cost, nothing

    def _decode(self, keys: list[tuple]) -> list[str]:
        """The letters of stretches: (state before, whether the text ends with it, kinds of its characters)."""
        n, longest = len(keys), max(map(len, keys)) - 2
        tables = self._tables()
        line = np.full((n, longest), len(self.kinds), np.int32)
        for i, key in enumerate(keys):
            line[i, : len(key) - 2] = key[2:]
        best = np.full((n, _BASE), _NEVER)
        best[np.arange(n), [key[0] for key in keys]] = 0.0
        held = []
        for start in range(0, longest, WINDOW):
            held.append(best)
            best, steps = self._forward(best, line[:, start : start + WINDOW], tables, start + WINDOW >= longest)
        ends = np.array([key[1] for key in keys])
        state = (best + np.where(ends[:, None], self.costs[:, 0][None, :], 0.0)).argmin(axis=1)
        rows, picks = np.arange(n), np.empty((n, longest), np.int8)
        for window in range(len(held) - 1, -1, -1):
            start = window * WINDOW
            if window + 1 < len(held):
                _, steps = self._forward(held[window], line[:, start : start + WINDOW], tables, True)
            for at in range(len(steps) - 1, -1, -1):
                came, chosen = steps[at]
                picks[:, start + at] = chosen[rows, state]
                state = came[rows, state].astype(np.int64)
        kinds = self.kinds
        return [
            "".join([kinds[kind][0][pick][1] for kind, pick in zip(key[2:], row) if pick >= 0]) for key, row in zip(keys, picks.tolist())
        ]

    def _forward(self, best: np.ndarray, line: np.ndarray, tables, trace: bool) -> tuple[np.ndarray, list]:
        """The costs of all states after the characters of ``line``, and where each came from if ``trace``."""
        if len(best) == 1 and line.shape[1] > _BASE:
            return self._forward_one(best[0], line[0], trace)
        symbols, prices, nothings = tables
        rows, steps = np.arange(len(best)), []
        same = np.broadcast_to(np.arange(_BASE, dtype=np.int8), best.shape)
        for at in range(line.shape[1]):
            kind = line[:, at]
            symbol, cost = symbols[kind], prices[kind]
            new = best + nothings[kind][:, None]
            came, chosen = same.copy(), np.full(best.shape, -1, dtype=np.int8)
            for j in range(symbol.shape[1]):
                able = cost[:, j] < _NEVER
                if not able.any():
                    continue
                reach = best + self.costs[:, symbol[:, j]].T
                source = reach.argmin(axis=1)
                total = reach[rows, source] + cost[:, j]
                better = able & (total < new[rows, symbol[:, j]])
                hit = rows[better]
                new[hit, symbol[better, j]] = total[better]
                came[hit, symbol[better, j]], chosen[hit, symbol[better, j]] = source[better], j
            best = np.minimum(new, _NEVER)
            if trace:
                steps.append((came, chosen))
        return best, steps

    def _forward_one(self, best: np.ndarray, line: np.ndarray, trace: bool) -> tuple[np.ndarray, list]:
        """The same for one long stretch, where the work on a matrix of one row would cost more than the numbers."""
        steps, ways = [], {}
        same = np.arange(_BASE, dtype=np.int8)[None, :]
        for kind in line.tolist():
            if kind not in ways:
                choices, price = self.kinds[kind]
                symbols = [number for number, _, _ in choices]
                ways[kind] = symbols, self.costs[:, symbols].T + np.array([[cost] for _, _, cost in choices]), price
            symbols, costs, price = ways[kind]
            reach = costs + best
            source = reach.argmin(axis=1).tolist()
            new = best + price
            if trace:
                came, chosen = same.copy(), np.full((1, _BASE), -1, dtype=np.int8)
            for j, (symbol, at) in enumerate(zip(symbols, source)):
                if reach[j, at] < new[symbol]:
                    new[symbol] = reach[j, at]
                    if trace:
                        came[0, symbol], chosen[0, symbol] = at, j
            best = np.minimum(new, _NEVER, out=new)
            if trace:
                steps.append((came, chosen))
        return best[None, :], steps

    def words_of(self, tokens: list[str]) -> dict[str, tuple[str, ...]]:
        """The words of each token, with those of its restoration if it is odd."""
        out, odd = {}, []
        for token in tokens:
            out[token] = (token,) if token.isalpha() else tuple(_WORDS.findall(token))
            if " " in token or _ODD.search(token):
                odd.append(token)
        for token, text in zip(odd, self.restore(odd)):
            out[token] += tuple(text.split())
        return out


def _runs(word: str) -> tuple[str, list[int]]:
    """A word with each run of equal letters as one letter, and the lengths of the runs."""
    letters, lengths = [], []
    for letter in word:
        if letters and letters[-1] == letter:
            lengths[-1] += 1
        else:
            letters.append(letter)
            lengths.append(1)
    return "".join(letters), lengths


class Splitter:
    """Words seen in fitting, with their costs: where a fused run of letters falls into words, and which
    of the ``wanted`` features a word has once letters written twice are left out."""

    def __init__(self, costs: dict[str, float], wanted):
        self.costs, self.lengths = costs, sorted(set(map(len, costs)), reverse=True)
        self.unseen = max(costs.values(), default=0.0)
        self.squeezed: dict[str, list[tuple[str, list[int]]]] = {}
        for feature in wanted:
            letters, lengths = _runs(feature.removesuffix("*"))
            self.squeezed.setdefault(letters + feature[len(feature.removesuffix("*")) :], []).append((feature, lengths))

    def parts(self, run: str) -> list[str]:
        """The cheapest words that make up ``run``; an unseen one costs as much as the rarest, and its letters."""
        best, came = [0.0], [0]
        unseen, start = float("inf"), 0  # the cheapest way that ends inside an unseen word, and its start
        for end in range(1, len(run) + 1):
            fresh = best[end - 1] + self.unseen
            if fresh < unseen:
                unseen, start = fresh, end - 1
            unseen += UNSEEN_LETTER
            cost, begin = unseen, start
            for size in self.lengths:
                i = end - size
                known = self.costs.get(run[i:end]) if i >= 0 else None
                if known is not None and best[i] + known < cost:
                    cost, begin = best[i] + known, i
            best.append(cost)
            came.append(begin)
        out, end = [], len(run)
        while end:
            out.append(run[came[end] : end])
            end = came[end]
        return out[::-1]

    def shortened(self, word: str) -> set[str]:
        """Features of ``word`` without some letters that repeat the one before; none for a word that was seen."""
        if word in self.costs or not _DOUBLED.search(word):
            return set()
        letters, lengths = _runs(word)
        keys = [letters, *(f"{letters[:i]}*" for i in range(1, min(_BEGINNING + 1, len(letters))))]
        return {
            feature for key in keys for feature, least in self.squeezed.get(key, ()) if all(map(int.__ge__, lengths, least))
        }


_SEEN = 100_000


class Reader:
    """The words of texts, token by token; a bounded number of tokens is remembered.

    With ``wanted``, only features among these are reported, and most tokens need no look at all.  With
    ``seen``, costs of words, runs of spaced-out characters are also split into words, and letters written
    twice are also read as one.
    """

    def __init__(self, channel: Channel, wanted=None, seen: dict[str, float] | None = None):
        self.channel, self.wanted = channel, wanted
        self.splitter = None if seen is None else Splitter(seen, wanted or ())
        self.odd = (_TRIPLED if seen is None else _DOUBLED).search
        self.begun = {feature.removesuffix("*") for feature in wanted or () if feature.endswith("*")}
        self.seen: set[str] = set()
        #: Features by token; without ``wanted``, tokens that are plain words and not here are their own.
        self.told: dict[str, tuple[str, ...]] = {}

    def features(self, texts: list[str | None]) -> list[set[str]]:
        """Per whole text: the features of its tokens and of its runs of spaced-out characters, restored."""
        rows = []
        for text in texts:
            low = (text or "").lower()
            tokens = set(low.split())
            tokens.update(_SPACED.findall(low))
            rows.append(tokens)
        if len(self.seen) > _SEEN:
            self.seen, self.told = set(), {}
        new = set().union(*rows) - self.seen
        self.seen |= new
        rest, odd, wanted, told = [], self.odd, self.wanted, self.told
        for token in new:
            bare = token.isalpha()
            word = token if bare else token.strip(_AROUND)
            if not word.isalpha() or odd(word):
                rest.append(token)
            elif wanted is not None:
                if word in wanted or word[:_BEGINNING] in self.begun:
                    told[token] = tuple(features({word}) & wanted)
            elif not bare:
                told[token] = tuple(features({word}))
        for token, words in self.channel.words_of(rest).items():
            found = self._found(token, set(words))
            if found or wanted is None:
                told[token] = tuple(found)
        if wanted is not None:
            return [set().union(*[told[t] for t in tokens & told.keys()]) for tokens in rows]
        return [features(tokens.difference(told)).union(*[told[t] for t in tokens & told.keys()]) for tokens in rows]

    def _found(self, token: str, words: set[str]) -> set[str]:
        """The features of a token that is no plain word; ``words`` are its own and those of its restoration."""
        shorter = set()
        if self.splitter is not None:
            if _SPREAD.search(token):
                fused = words.difference(_WORDS.findall(token))
                words.update(*[self.splitter.parts(form) for word in fused for form in {word, _runs(word)[0]}])
            shorter = set().union(*[self.splitter.shortened(word) for word in words])
        found = features(words) | shorter
        return found if self.wanted is None else found & self.wanted


def features(words: set[str]) -> set[str]:
    """The words, and the beginnings of the longer ones."""
    return words | {f"{w[:_BEGINNING]}*" for w in words if len(w) > _BEGINNING}


def _letter_table(letters: str) -> np.ndarray:
    table = np.array([_BASE - 1 if chr(i).isalpha() else 0 for i in range(0x10000)], dtype=np.int64)
    for i, letter in enumerate(letters):
        table[ord(letter)] = i + 1
    return table


def _points(text: str | None) -> np.ndarray:
    return np.minimum(np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[str]:
    """The texts, a blank between them, about a million characters at a time."""
    held, size = [], 0
    for batch in slices(batches):
        for text in batch.column(0).to_pylist():
            held.append(text or "")
            size += len(held[-1])
            if size > 1 << 20:
                yield " ".join(held)
                held, size = [], 0
    yield " ".join(held)


def _counted(counts: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], ["code", "times"])


def _single_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0x10000, dtype=np.int64)
    for text in _joined(batches):
        counts += np.bincount(_points(text), minlength=0x10000)
    yield _counted(counts)


def _pair_counts(letters: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = _letter_table(letters), np.zeros(_BASE * _BASE, dtype=np.int64)
        for text in _joined(batches):
            line = table[np.concatenate(([32], _points(text), [32]))]
            counts += np.bincount(line[:-1] * _BASE + line[1:], minlength=_BASE * _BASE)
        yield _counted(counts)

    return count


def _summed(counted: DataFrame) -> DataFrame:
    return counted.groupBy("code").agg(F.sum("times").alias("times"))


def character_model(texts: DataFrame) -> Channel:
    """Counts of letter after letter over all texts (one column); what reaches the driver is bounded by the alphabet."""
    singles = _summed(texts.mapInArrow(_single_counts, "code long, times long")).orderBy(F.desc("times"), "code").limit(8 * LETTERS).collect()
    letters = "".join([chr(r.code) for r in singles if chr(r.code).isalpha() and r.code < 0xFFFF][:LETTERS])
    counts = np.zeros(_BASE * _BASE)
    for r in _summed(texts.mapInArrow(_pair_counts(letters), "code long, times long")).collect():
        counts[r.code] = r.times
    counts = counts.reshape(_BASE, _BASE)
    counts[0, 0] = 0.0
    usual = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    return Channel(letters, -np.log((1 - EVEN) * usual + EVEN / _BASE))


def _feature_rows(channel: Channel):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(channel)
        for batch in slices(batches):
            found = [sorted(x) for x in reader.features(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["toxic", "features"])

    return build


class Model:
    """Weights of words; a score is the logistic function of their sum.  ``seen`` has the costs of words seen in fitting."""

    def __init__(self, channel: Channel, weights: dict[str, float], bias: float, seen: dict[str, float] | None = None):
        self.channel, self.weights, self.bias, self.seen = channel, weights, bias, seen

    def scores(self, texts: list[str | None], reader: Reader) -> np.ndarray:
        sums = [sum(self.weights[f] for f in sorted(found)) for found in reader.features(texts)]
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + np.array(sums, dtype=np.float64), -30, 30)))


def _regress(rows: DataFrame, lexicon: list[str]) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge over rows ``toxic, features, times``; the driver hears sums of the lexicon's size."""
    toxic = F.col("toxic") >= 1
    weighted = rows.select(
        F.when(toxic, 1.0).otherwise(0.0).alias("label"), "features",
        (F.col("times") * F.when(toxic, TOXIC_WEIGHT).otherwise(1.0)).alias("importance"),
    )
    marked = CountVectorizerModel.from_vocabulary(lexicon, "features", "at", binary=True).transform(weighted)
    total = weighted.agg(F.sum("importance")).first()[0]  # the library's ridge is on the mean over the weights
    model = LogisticRegression(
        featuresCol="at", weightCol="importance", regParam=RIDGE / total, standardization=False, maxIter=200, tol=1e-8, family="binomial",
    ).fit(marked)
    return model.coefficients.toArray(), float(np.clip(model.intercept, -30, 30))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic, text`` of rows (``doc_id, text``) that are labelled and not held out; equal texts with equal labels once.

    Which rows these are is found by digests.  Texts are shuffled once, whatever the size of the labels, so what
    is shuffled grows as the texts do.
    """
    usable = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = usable.withColumn("digest", F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")))
    marks = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = rows.select("doc_id", "digest").join(marks, "doc_id").groupBy("toxic", "digest").agg(F.min("doc_id").alias("doc_id"))
    found = rows.join(chosen.hint("merge"), ["doc_id", "digest"])
    return found.groupBy("doc_id", "digest").agg(F.first("toxic").alias("toxic"), F.first("text").alias("text")).select("toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """The character model from all of ``docs``, the words and their weights from all labelled rows.

    Rows that are held out, and labels that are null, are not learned from.  Equal texts with equal labels count
    once; rows with the same words of the lexicon and the same label are one weighted row of the regression.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(text_column).cast("string").alias("text"))
    channel = character_model(texts)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    labelled = scratch.keep(_labelled(rows, labels).mapInArrow(_feature_rows(channel), "toxic int, features array<string>"), "labelled")
    each = scratch.keep(
        labelled.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all"))
        .where(F.col("all") >= min(LEAST_TOXIC, LEAST_SEEN)),
        "features",
    )
    telling = each.where((F.col("bad") >= LEAST_TOXIC) & (F.col("bad") >= LEAST_PRECISION * F.col("all")))
    strength = F.col("bad") * F.col("bad") / F.col("all")
    lexicon = [r.feature for r in telling.orderBy(F.desc(strength), "feature").limit(LEXICON).collect()]
    if not lexicon:
        return Model(channel, {}, -5.0)
    plain = each.where((F.col("all") >= LEAST_SEEN) & ~F.col("feature").endswith("*"))
    common = {r.feature: r["all"] for r in plain.orderBy(F.desc("all"), "feature").limit(VOCABULARY).collect()}
    total = sum(common.values())
    seen = {word: float(np.log(total / times)) for word, times in common.items()}
    known = F.array_sort(F.filter("features", lambda x: x.isin(lexicon))).alias("features")
    alike = labelled.select("toxic", known).groupBy("toxic", "features").agg(F.count(F.lit(1)).alias("times"))
    weights, bias = _regress(scratch.keep(alike, "alike"), lexicon)
    return Model(channel, dict(zip(lexicon, weights.tolist())), bias, seen)


def _scoring(model: Model, at: int, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.channel, set(model.weights), model.seen)
        for batch in slices(batches):
            found = model.scores(batch.column(at).to_pylist(), reader)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names)

    return score


def score(docs: DataFrame, model: Model, text_column: str = "text", score_name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of the whole text alone; null and empty texts have the score of no words."""
    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([*docs.schema.fields]).add(score_name, DoubleType())
    return docs.mapInArrow(_scoring(model, docs.columns.index(text_column), schema.names), schema)


def toxicity_of(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row."""
    model = fit(docs, labels, scratch, id_column, text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return score(rows, model).drop("text").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
