"""Toxicity of texts whose words may be written to slip past a word list.

Noisy channel: a word as written is one reading of a word as meant, with letters replaced by look-alikes, spread
out by spaces or marks, or repeated. For each token the possible readings form a lattice of characters; Viterbi
decoding finds the one that is cheapest under the costs of the channel and a character language model, whose trigram
counts are taken over all documents. A token with one reading, letters only and none doubled, is its own.

The restored words are scored by how much more often toxic than other labelled documents have them. Features
are whole words and their beginnings; a feature's weight is the lower end of an interval around its log odds,
so rare ones count little. They are learned from at most ``SAMPLE`` labelled documents of each label,
chosen by hash, of which copies and near copies (sharing one of ``MARKS`` smallest shingle hashes) count once.
A document's score is a logistic regression on how strong and how many its telling words are for its length,
fitted on the same sample. Everything else covers all rows and whole texts.

Defined cases: a null or empty text, and any text without a telling word, has the lowest score. A document labelled
several times counts as toxic if one label says so; labels of other documents or without id or value count for nothing.
Without labelled documents of both kinds no word tells anything and every score is the share of toxic labels.
Repeated rows are each reported. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopwright.llm import grams
from shopwright.shared import stored

SAMPLE = 20_000
MARKS = 4
SHINGLE = 3
CUT = 0.3
PREFIXES = (4, 5, 6, 7)
LEAST_TOXIC = 4
CAUTION = 1.0
LEAST_WEIGHT = 1.5
CHANCE = 0.1
SYMBOLS = 64
OTHER_LETTERS = 36
CACHED_TOKENS = 200_000

# What look-alikes may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
# Costs of the channel, as negative logarithms.
REPLACED, REPEATED, REPEATED_ON, DROPPED, BROKEN, JOINED, BLANK = 0.5, 1.5, 0.2, 0.7, 5.0, 0.2, 1.5
STATES = 24

_DOUBLED = re.compile(r"(.)\1")
# A mark at the end that stands there twice or more is no letter.
_NOISE = re.compile(r"([^\w\s])\1+$")
_EDGE = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum() and chr(c) not in "@$|+(€£")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def symbol(char: str) -> int:
    """0 for what is no letter, 1 to 26 for a to z, above for other letters."""
    code = ord(char)
    if 97 <= code <= 122:
        return code - 96
    return 27 + code % OTHER_LETTERS if code >= 128 and char.isalpha() else 0


_ASCII = np.array([symbol(chr(c)) for c in range(128)], np.int64)


def _symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    out = 27 + codes % OTHER_LETTERS
    plain = codes < 128
    out[plain] = _ASCII[codes[plain]]
    rare = np.unique(codes[~plain])
    no_letters = rare[[not chr(c).isalpha() for c in rare.tolist()]] if len(rare) else rare
    if len(no_letters):
        out[np.isin(codes, no_letters)] = 0
    return out


def trigram_counts(docs: DataFrame) -> DataFrame:
    """code, n: counts of (letter, letter, letter), 0 standing before and after words; at most SYMBOLS^3 rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for lo, hi, _, _ in grams.slices(batch.column(0)):
                texts = batch.column(0).slice(lo, hi - lo).to_pylist()
                s = np.concatenate(([0, 0], _symbols("\n".join(texts).lower()), [0]))
                before, last, now = s[:-2], s[1:-1], s[2:]
                ok = (last > 0) | (now > 0)
                code = np.where(last == 0, 0, before) * SYMBOLS**2 + last * SYMBOLS + now
                total += np.bincount(code[ok], minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["code", "n"])
        grams.give_back()

    return docs.select("text").filter("text is not null").mapInArrow(counted, "code long, n long").groupBy("code").agg(
        F.sum("n").alias("n")
    )


def character_model(counts: list[tuple[int, int]]) -> np.ndarray:
    """Cost of a symbol after two others, at ((before * SYMBOLS) + last) * SYMBOLS + symbol."""
    three = np.zeros(SYMBOLS**3)
    for code, n in counts:
        three[code] = n
    three = three.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3).ravel().astype(np.float32)


class Decoder:
    """Viterbi decoding of single tokens, or of letters with spaces between."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = array("f", costs.tobytes())
        self.numbers: dict[str, int] = {"": -1, " ": 0}

    def readings(self, char: str, before: str, earlier: str) -> list[tuple[int, str, float]]:
        """What a character may have been: (symbol, letter, cost); 0 is a blank and -1 nothing."""
        if char == " ":
            return [(-1, "", JOINED), (0, " ", BLANK)]
        number = self.number(char)
        out = [(number, char, 0.0)] if number else [(0, " ", BROKEN)]
        out += [(symbol(letter), letter, REPLACED) for letter in LOOK_ALIKES.get(char, "")]
        if char == before:
            out.append((-1, "", REPEATED_ON if char == earlier else REPEATED))
        elif not number and not char.isalnum():
            out.append((-1, "", DROPPED))
        return out

    def number(self, char: str) -> int:
        known = self.numbers.get(char)
        if known is None:
            known = symbol(char)
            if len(self.numbers) < SYMBOLS**2:
                self.numbers[char] = known
        return known

    def restored(self, token: str) -> list[str]:
        """The words of the cheapest reading; equally cheap ones go to the one found first."""
        costs, numbers = self.costs, self.numbers
        # The two letters before: cost, and the path as linked pairs. Most of the time there is one.
        alive: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        before = earlier = ""
        for char in token:
            number = numbers.get(char)
            if number is None:
                number = self.number(char)
            reached: dict[int, tuple[float, tuple | None]] = {}
            if number and char != before:
                if len(alive) == 1:
                    [(context, (cost, path))] = alive.items()
                    reached[context % SYMBOLS * SYMBOLS + number] = cost + costs[context * SYMBOLS + number], (path, char)
                    alive, earlier, before = reached, before, char
                    continue
                for context, (cost, path) in alive.items():
                    to = context % SYMBOLS * SYMBOLS + number
                    cost += costs[context * SYMBOLS + number]
                    if to not in reached or cost < reached[to][0]:
                        reached[to] = (cost, (path, char))
            else:
                for number, out, price in self.readings(char, before, earlier):
                    for context, (cost, path) in alive.items():
                        cost += price
                        to = context
                        if number == 0:
                            to, cost = 0, cost + (costs[context * SYMBOLS] if context else 0.0)
                        elif number > 0:
                            to = context % SYMBOLS * SYMBOLS + number
                            cost += costs[context * SYMBOLS + number]
                        if to not in reached or cost < reached[to][0]:
                            reached[to] = (cost, (path, out) if out else path)
                if len(reached) > STATES:
                    reached = dict(sorted(reached.items(), key=lambda item: item[1][0])[:STATES])
            alive, earlier, before = reached, before, char
        final = min(alive, key=lambda c: alive[c][0] + (costs[c * SYMBOLS] if c else 0.0))
        path, letters = alive[final][1], []
        while path is not None:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters)).split()


def tokens(text: str) -> Counter:
    """Tokens in lower case and how often each stands there; three or more single
    characters in a row are one token with blanks."""
    words = text.lower().split()
    found = Counter(words)
    single = [i for i, word in enumerate(words) if len(word) == 1]
    begin = 0
    for place in range(1, len(single) + 1):
        if place == len(single) or single[place] != single[place - 1] + 1:
            if place - begin >= 3:
                found[" ".join(words[single[begin] : single[place - 1] + 1])] += 1
            begin = place
    return found


class Words(dict):
    """token: its words as meant. Known tokens are kept, up to a number that has no influence on results."""

    def __init__(self, costs: np.ndarray) -> None:
        super().__init__()
        self.decoder = Decoder(costs)

    def __missing__(self, token: str) -> list[str]:
        words = self.meant(token)
        if len(self) >= CACHED_TOKENS:
            self.clear()
        self[token] = words
        return words

    def meant(self, token: str) -> list[str]:
        """The words of a token, which is not kept."""
        # Letters only have no edges to cut.
        bare = token if token.isalpha() or " " in token else _NOISE.sub("", token.strip(_EDGE)).strip(_EDGE)
        letters = bare.isalpha()
        if letters and not _DOUBLED.search(bare):
            return [bare]
        if not letters and not any(map(str.isalpha, bare)):
            return []
        words = [word for word in self.decoder.restored(bare) if len(word) > 1]
        # As written, too, where it is letters only.
        if letters and bare not in words:
            words.append(bare)
        return words


def features(word: str) -> list[str]:
    return [f"{word}$", *(word[:k] for k in PREFIXES if len(word) >= k)]


def _marks(text: str) -> list[int]:
    """The smallest hash of any shingle, for several hash functions."""
    words = text.lower().split()
    shingles = {" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
    hashes = np.fromiter((xxhash.xxh64_intdigest(s) for s in shingles), np.uint64, len(shingles))
    return [int(grams.mixed(hashes + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)).min() >> np.uint64(1)) for k in range(1, MARKS + 1)]


def _label_sample(labels: DataFrame, sample: int) -> tuple[DataFrame, int, int]:
    """(doc_id, toxic) of about ``sample`` documents of each label at most, and the numbers of clean and toxic ones."""
    known = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    known = stored(known, "labels")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    clean, toxic = counts.get(False, 0), counts.get(True, 0)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic"), sample / max(1, toxic)).otherwise(sample / max(1, clean))
    return known.filter(spread < share), clean, toxic


@dataclass
class Model:
    """Costs of characters, weights of telling features, and the weights of a document's signs."""

    costs: np.ndarray
    weights: dict[str, float]
    beta: np.ndarray


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The character model from all documents; weights from at most about ``sample`` documents of each label."""
    costs = character_model([(r["code"], r["n"]) for r in trigram_counts(docs).collect()])
    chosen, clean, toxic = _label_sample(labels, sample)
    odds = math.log((toxic + 0.5) / (clean + 0.5))
    flat = Model(costs, {}, np.array([odds, 0, 0, 0, 0, 0.0]))
    if not clean or not toxic:
        return flat
    rows = _different_texts(docs, chosen)
    weights = _weights(rows, costs)
    if not weights:
        return flat
    known = docs.sparkSession.sparkContext.broadcast((costs, weights))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighed = Weighed(*known.value)
        for batch in batches:
            x = [signs(text, weighed) for text in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(1), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "signs"])

    # A few numbers for each document of the sample.
    found = rows.select("text", "toxic").mapInArrow(described, "toxic boolean, signs array<double>").collect()
    if len({r["toxic"] for r in found}) < 2:
        return flat
    found.sort(key=lambda r: (r["signs"], r["toxic"]))
    beta = fitted(np.array([r["signs"] for r in found]), np.array([r["toxic"] for r in found]), odds)
    return Model(costs, weights, beta)


def _different_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the chosen documents, one of each group of copies and near copies."""
    # At most about 2 * sample ids.
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = stored(rows.dropDuplicates(["toxic", "text"]), "labelled-texts")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [m for text in batch.column(1).to_pylist() for m in _marks(text)]
            repeat = np.repeat(np.arange(batch.num_rows), MARKS)
            k = np.tile(np.arange(MARKS, dtype=np.int32), batch.num_rows)
            yield pa.record_batch(
                [batch.column(0).take(repeat), batch.column(2).take(repeat), pa.array(k), pa.array(marks, pa.int64())],
                names=["doc_id", "toxic", "k", "mark"],
            )

    doc_id = rows.schema["doc_id"].dataType.simpleString()
    own = rows.select("doc_id", "text", "toxic").mapInArrow(marked, f"doc_id {doc_id}, toxic boolean, k int, mark long")
    own = stored(own, "marks")
    firsts = own.groupBy("toxic", "k", "mark").agg(F.min("doc_id").alias("first"))
    alone = (
        own.join(firsts, ["toxic", "k", "mark"])
        .groupBy("doc_id", "toxic")
        .agg(F.bool_and(F.col("doc_id") == F.col("first")).alias("alone"))
        .filter("alone")
    )
    return rows.join(alone, ["doc_id", "toxic"], "left_semi")


def _weights(rows: DataFrame, costs: np.ndarray) -> dict[str, float]:
    """Weights of features that toxic rows have more often than by chance."""
    model = rows.sparkSession.sparkContext.broadcast(costs)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model.value)
        for batch in batches:
            found: dict[bool, Counter] = {False: Counter(), True: Counter()}
            size = Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[label].update({f for token in tokens(text) for word in words[token] for f in features(word)})
                size[label] += 1
            for label, counter in found.items():
                counter[""] = size[label]
                yield pa.record_batch(
                    [
                        pa.array(counter.keys(), pa.string()),
                        pa.array([label] * len(counter)),
                        pa.array(counter.values(), pa.int64()),
                    ],
                    names=["feature", "toxic", "n"],
                )
        grams.give_back()

    counts = (
        rows.select("text", "toxic")
        .mapInArrow(counted, "feature string, toxic boolean, n long")
        .groupBy("feature")
        .agg(
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("t"),
            F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("c"),
        )
    )
    counts = stored(counts.filter((F.col("t") >= LEAST_TOXIC) | (F.col("feature") == "")), "features")
    total = counts.filter("feature = ''").first()
    if total is None or not total["t"] or not total["c"]:
        return {}
    tested = max(1, counts.count() - 1)
    t, c, share = F.col("t"), F.col("c"), total["t"] / (total["t"] + total["c"])
    # Logarithm of how much likelier the counts are than by chance; of all tested, CHANCE features may pass by it.
    gain = t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
    t, c = t + 0.5, c + 0.5
    weight = F.log(t / (total["t"] + 1)) - F.log(c / (total["c"] + 1)) - CAUTION * F.sqrt(1 / t + 1 / c)
    telling = counts.filter("feature <> ''").select("feature", weight.alias("weight"), gain.alias("gain"))
    telling = telling.filter((F.col("weight") >= LEAST_WEIGHT) & (F.col("gain") >= math.log(tested / CHANCE)))
    # As many as the sample has telling features.
    return {r["feature"]: r["weight"] for r in telling.collect()}


class Weighed(dict):
    """token: its telling words, each with the greatest weight of its features. ``dull`` are known tokens without any;
    both are kept up to a number that has no influence on results."""

    def __init__(self, costs: np.ndarray, weights: dict[str, float]) -> None:
        super().__init__()
        self.words, self.weights = Words(costs), weights
        self.dull: set[str] = set()
        # How telling features begin: a word of four letters or more that begins otherwise has none.
        self.heads = {feature[: PREFIXES[0]] for feature in weights}

    def __missing__(self, token: str) -> list[tuple[str, float]]:
        found = []
        for word in self.words.meant(token):
            if len(word) >= PREFIXES[0] and word[: PREFIXES[0]] not in self.heads:
                continue
            weight = max((self.weights[f] for f in features(word) if f in self.weights), default=0.0)
            if weight > 0:
                found.append((word, weight))
        if len(self) + len(self.dull) >= 2 * CACHED_TOKENS:
            self.clear()
            self.dull.clear()
        if found:
            self[token] = found
        else:
            self.dull.add(token)
        return found


def signs(text: str, weighed: Weighed) -> list[float]:
    """What the score is made of: a constant, whether there are telling words, how telling the strongest three
    are, how many different ones and how many places there are, and, with telling words, the length."""
    counts = tokens(text)
    telling, places = {}, 0
    for token in set(counts).difference(weighed.dull):
        found = weighed[token]
        if found:
            places += counts[token] * len(found)
            telling.update(found)
    if not telling:
        return [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    strongest = sorted(telling.values(), reverse=True)[:3]
    strength = sum(w * part for w, part in zip(strongest, (1.0, 0.5, 0.25)))
    return [1.0, 1.0, strength, math.log1p(len(telling)), math.log1p(places), math.log1p(sum(counts.values()))]


def fitted(x: np.ndarray, toxic: np.ndarray, odds: float, rounds: int = 30, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression by Newton steps, as if toxic ones stood at ``odds`` to others."""
    share = 1 / (1 + math.exp(-odds))
    part = np.where(toxic, share / max(1e-9, toxic.mean()), (1 - share) / max(1e-9, 1 - toxic.mean()))
    beta = np.zeros(x.shape[1])
    beta[0] = odds
    pull = np.full(x.shape[1], ridge)
    pull[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (part * (toxic - p)) - pull * beta
        bend = (x * (part * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        beta = beta + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return beta


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        weighed = Weighed(own.costs, own.weights)
        for batch in batches:
            x = np.array([signs(text.as_py() or "", weighed) for text in batch.column(1)]).reshape(-1, 6)
            scores = 1 / (1 + np.exp(-np.clip(x @ own.beta, -30, 30)))
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
        grams.give_back()

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judged, f"doc_id {doc_id}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from ``cut`` on)."""
    return scored(docs, learn(docs, labels, sample)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )
