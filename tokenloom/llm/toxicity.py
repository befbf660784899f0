"""Toxicity of texts: disguised words are restored by a noisy-channel decoder, then scored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import crc32_bucket, stored

SAMPLE = 6000  # labelled documents of each class, about, that the model is fitted on
FOLDS, HELD_OUT = 5, 0  # Fixed values: rows whose crc32(doc_id) mod 5 is 0 are never learned from
FEATURES = 4096  # most words and word starts the model keeps
STARTS = (4, 5, 6)  # lengths of word starts that count besides the whole word
CAUTION = (2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0)  # standard errors that may be taken off a log-odds weight
CALIBRATION = 3  # tenths of the sample that choose the caution and the scale of scores, and give no weights
STRONGEST = 3  # words of a text that add to its score
SLICE = 500  # rows whose texts a task holds as strings at a time
COUNT_TOKENS = 50_000  # different tokens whose counts a task gathers before it turns them to trigrams

# Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "ß": "s",
}
GAPS = " .-_*~'’·,/\\#^`\"&%=:;)[]{}<>?"  # signs that may be put between letters
SIGN_COST, GAP_COST, REPEAT_COST, ODD_COST = 1.0, 0.7, 0.5, 8.0
_EDGE = ".,;:!?\"'()[]{}<>&%#*|~^=`/\\-_"
_MARKS = tuple("".join(c for c in _EDGE if c not in kept) for kept in ("", "!|", "!|("))  # marks, less those that are signs too
_SPACED = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")
_RUN = re.compile(r"(.)\1\1")
_TAIL = re.compile(r"([$+@!])\1+$")


class Trigrams:
    """How often letter trigrams stand in all documents: sorted codes of 21 bits a letter, and counts."""

    def __init__(self, codes: Iterable[int] = (), counts: Iterable[int] = ()) -> None:
        self.codes, self.counts = np.array(codes, dtype=np.int64), np.array(counts, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.codes)

    def get(self, gram: str) -> int:
        code = ord(gram[0]) << 42 | ord(gram[1]) << 21 | ord(gram[2])
        at = int(np.searchsorted(self.codes, code))
        return int(self.counts[at]) if at < len(self.codes) and self.codes[at] == code else 0

    def sums(self, name: Callable[[np.ndarray], np.ndarray]) -> Counter:
        """Counts by ``name`` of the codes."""
        names, inverse = np.unique(name(self.codes), return_inverse=True)
        sums = np.zeros(len(names), dtype=np.int64)
        np.add.at(sums, inverse, self.counts)
        return Counter(dict(zip(names.tolist(), sums.tolist(), strict=True)))


_LETTER = (1 << 21) - 1


class LetterModel:
    """Letter trigrams with add-one back-off to bigrams; costs are negative logarithms, some of them kept."""

    ROOM = 100_000

    def __init__(self, trigrams: Trigrams) -> None:
        self.three = trigrams
        self.two = trigrams.sums(lambda c: c >> 21)
        self.one = trigrams.sums(lambda c: c & _LETTER)
        self.pairs = trigrams.sums(lambda c: c & ((1 << 42) - 1))
        self.middle = trigrams.sums(lambda c: (c >> 21) & _LETTER)
        self.total = int(trigrams.counts.sum())
        self.known: dict[str, float] = {}

    def cost(self, gram: str) -> float:
        """Cost of the third letter after the two before it."""
        found = self.known.get(gram)
        if found is None:
            a, b, c = map(ord, gram)
            lone = (self.one[c] + 0.1) / (self.total + 10)
            pair = (self.pairs[b << 21 | c] + 2 * lone) / (self.middle[b] + 2)
            found = -math.log((self.three.get(gram) + 2 * pair) / (self.two[a << 21 | b] + 2))
            if len(self.known) < self.ROOM:
                self.known[gram] = found
        return found


def restore(token: str, model: LetterModel) -> str:
    """The most likely word behind a disguised token.

    Each character opens the edges of a lattice: it stands for itself if it is a letter, for the
    letters its shape suggests, for nothing if it is a separator, and for nothing if it repeats
    the letter before it. Viterbi keeps the cheapest way to every pair of last letters.
    """
    ways: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
    for at, char in enumerate(token):
        nexts: dict[str, tuple[float, str]] = {}

        def offer(state: str, cost: float, text: str, nexts: dict = nexts) -> None:
            if state not in nexts or cost < nexts[state][0]:
                nexts[state] = (cost, text)

        edges = [(char, 0.0)] if char.isalpha() else []
        edges += [(letter, SIGN_COST) for letter in SIGNS.get(char, "")]
        for state, (cost, text) in ways.items():
            for letter, extra in edges:
                offer(state[1] + letter, cost + extra + model.cost(state + letter), text + letter)
            if char in GAPS:
                offer(state, cost + GAP_COST, text)
            elif at and char == token[at - 1]:
                offer(state, cost + REPEAT_COST, text)
            elif not edges:
                offer(state, cost + ODD_COST, text)
        ways = nexts
    return min((cost + model.cost(state + "$"), text) for state, (cost, text) in ways.items())[1]


def plain(token: str) -> tuple[str, bool]:
    """A lower-case token without marks around it, and whether it may be disguised."""
    word = token.strip(_EDGE)
    signed = token.lstrip(_MARKS[2])[:1] in ("!", "|") and word != ""
    if not word.isalpha():
        word = _TAIL.sub("", word)
    if word.isalpha():
        return word, signed or _RUN.search(word) is not None
    return word, _hides(word)


def _hides(word: str) -> bool:
    """Whether a token that is no word may stand for one: it has a letter, or is of signs and gaps alone."""
    if len(word) < 3:
        return False
    return any(map(str.isalpha, word)) or (any(c in SIGNS for c in word) and all(c in SIGNS or c in GAPS for c in word))


def disguises(token: str) -> list[str]:
    """What to decode of a lower-case token: with and without the marks at its ends that may be signs."""
    if token.isalpha():
        return [token] if _RUN.search(token) else []
    found: dict[str, None] = {}
    # Most tokens are the same word whichever marks go.
    for word in dict.fromkeys(token.lstrip(left).rstrip(right) for left in _MARKS for right in _MARKS):
        for part in (word, _TAIL.sub("", word)):
            if _RUN.search(part) if part.isalpha() else _hides(part):
                found[part] = None
    return list(found)


def features(word: str) -> list[str]:
    """The word and its starts, marked by a dash."""
    return [word, *(word[:n] + "-" for n in STARTS if len(word) > n)]


@dataclass
class Toxicity:
    """A fitted model. ``weights`` are by feature; ``slope`` and ``offset`` turn sums to log-odds."""

    weights: dict[str, float] = field(default_factory=dict)
    trigrams: Trigrams = field(default_factory=Trigrams)
    slope: float = 1.0
    offset: float = math.log(0.05)

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts in one task; keeps the weights of tokens seen before, about 150 bytes each."""

    ROOM = 150_000
    NOTHING = (0.0, "")  # one value for all tokens without a weight

    def __init__(self, model: Toxicity, letters: LetterModel | None = None) -> None:
        self.model, self.letters, self.seen = model, letters or LetterModel(model.trigrams), {}
        self.longest = max((len(f.rstrip("-")) for f in model.weights), default=0)

    def weigh(self, token: str) -> tuple[float, str]:
        found = self.seen.get(token)
        if found is None:
            words = [plain(token)[0]]
            if len(self.model.trigrams):
                words += [restore(d, self.letters) for d in disguises(token)]
            found = max((self.model.weights.get(f, 0.0), w) for w in words for f in features(w))
            if found[0] <= 0:
                found = self.NOTHING
            if len(self.seen) < self.ROOM:
                self.seen[token] = found
        return found

    def spelled(self, run: str) -> list[tuple[float, str]]:
        """The telling words in letters with white space between them, wherever they begin and end.

        Every letter begins a reading as long as the longest telling word, each of its letters written
        twice. The heaviest word goes first, and no other one is taken from its letters.
        """
        pieces: list[str] = []
        for piece in run.split():
            if (piece not in GAPS or piece in SIGNS) and pieces[-2:] != [piece, piece]:
                pieces.append(piece)
        hits = []
        for at in range(len(pieces) - 2) if len(self.model.trigrams) else ():
            word = restore("".join(pieces[at : at + 2 * self.longest]), self.letters)
            ways = {word[:n] for n in range(3, min(len(word), self.longest) + 1)}
            weight, best = max(((self.model.weights.get(f, 0.0), f) for w in ways for f in features(w)), default=(0.0, ""))
            if weight > 0:
                hits.append((weight, at, at + len(best.rstrip("-")), best))
        taken: list[tuple[float, int, int, str]] = []
        for hit in sorted(hits, key=lambda h: (-h[0], h[1])):
            if all(hit[2] <= a or b <= hit[1] for _, a, b, _ in taken):
                taken.append(hit)
        return [(weight, best) for weight, _, _, best in taken]

    def raw(self, text: str | None) -> float:
        """Sum of the strongest weights of the text's different words."""
        if not text:
            return 0.0
        low = text.lower()
        found = []
        for token in set(low.split()):
            hit = self.seen.get(token) or self.weigh(token)
            if hit is not self.NOTHING:
                found.append(hit)
        for run in {m[0] for m in _SPACED.finditer(low)}:
            found += self.spelled(run)
        best: dict[str, float] = {}
        for weight, word in found:
            if weight > 0:
                best[word] = max(weight, best.get(word, 0.0))
        return sum(sorted(best.values())[-STRONGEST:])

    def score(self, text: str | None) -> float:
        x = self.model.slope * self.raw(text) + self.model.offset
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, at most ``SLICE`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _counts(docs: DataFrame) -> DataFrame:
    """``item, pos, neg``: in how many toxic and other texts a feature stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [Counter(), Counter()]
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set()
                for token in (text or "").lower().split():
                    word, disguised = plain(token)
                    if not disguised and word:
                        words.add(word)
                sums[int(toxic == 1)].update({f for w in words for f in features(w)})
            items = sorted(sums[0].keys() | sums[1].keys())
            numbers = [pa.array([side[f] for f in items], pa.int64()) for side in (sums[1], sums[0])]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), *numbers], names=["item", "pos", "neg"])

    each = docs.select("text", "toxic").mapInArrow(run, "item string, pos bigint, neg bigint")
    return each.groupBy("item").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _word_trigrams(words: dict[str, int]) -> Trigrams:
    """Trigrams of marked words that stand in so many texts each."""
    marked = "".join(f"^^{w}$" for w in words)
    letters = np.frombuffer(marked.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    lengths = np.array([len(w) + 3 for w in words])
    inside = np.ones(len(letters), dtype=bool)  # all but the last two places of a word begin a trigram
    ends = np.cumsum(lengths)
    inside[ends - 1] = inside[ends - 2] = False
    at = np.flatnonzero(inside)
    codes, inverse = np.unique(letters[at] << 42 | letters[at + 1] << 21 | letters[at + 2], return_inverse=True)
    counts = np.zeros(len(codes), dtype=np.int64)
    np.add.at(counts, inverse, np.repeat(np.array(list(words.values())), lengths)[at])
    return Trigrams(codes, counts)


def letter_counts(docs: DataFrame) -> Trigrams:
    """The trigrams of the plain words of every text, once for each text a word stands in.

    Tasks sum first; what comes to the driver and goes to the tasks is 16 bytes for each different trigram.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: Counter = Counter()

        def summed() -> pa.RecordBatch:
            words: Counter = Counter()
            for token, n in tokens.items():
                word, disguised = plain(token)
                if not disguised and word.isalpha():
                    words[word] += n
            tokens.clear()
            grams = _word_trigrams(words) if words else Trigrams()
            return pa.RecordBatch.from_arrays([pa.array(grams.codes), pa.array(grams.counts)], names=["code", "n"])

        for part in _slices(batches):
            for text in part.column(0).to_pylist():
                tokens.update(set((text or "").lower().split()))
                if len(tokens) > COUNT_TOKENS:
                    yield summed()
        yield summed()

    each = docs.select("text").mapInArrow(run, "code bigint, n bigint")
    rows = each.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    codes, counts = rows["code"].to_numpy(), rows["n"].to_numpy()
    order = np.argsort(codes)
    return Trigrams(codes[order], counts[order])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset by Newton's method with a small ridge."""
    theta = np.array([1.0, -2.0])
    features_ = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features_ @ theta, -30, 30)))
        grad = features_.T @ (weight * (p - y)) + 1e-3 * theta
        hess = (features_ * (weight * p * (1 - p))[:, None]).T @ features_ + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 0.0), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Toxicity:
    """Fit on about ``sample`` labelled documents of each class outside the held-out fold.

    A word's weight is its log-odds between toxic and other texts, less some standard errors
    and never below 0. Words of groups of copies look telling in the texts they come from, so the number of
    standard errors, and slope and offset, come from texts that gave no weights: the ones that fit those best.
    Letter trigrams are counted in all of ``docs``, labelled or not. Only the ``FEATURES`` heaviest words and the
    trigrams come to the driver. Without labels of both classes every text gets the base rate, or 0.05 if there is none.
    """
    known = labels.filter("toxic IN (0, 1)").filter(crc32_bucket("doc_id", FOLDS) != HELD_OUT)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    have = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(have) < 2:
        share = (have.get(1, 0) + 1) / (sum(have.values()) + 20)
        return Toxicity(offset=math.log(share / (1 - share)))
    rate = {y: min(1.0, sample / n) for y, n in have.items()}  # the drawn share of each class
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    picked = known.filter(drawn < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0]))
    # At most about two times ``sample`` ids of 16 bytes: a broadcast of a fixed size.
    tenth = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(10))
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    chosen = stored(chosen.select("text", "toxic", (tenth < CALIBRATION).alias("apart")), "toxicity-sample")
    weighing, apart = chosen.filter("NOT apart"), chosen.filter("apart")
    sizes = {r["toxic"]: r["n"] for r in weighing.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    counts = _counts(weighing)
    pos, neg = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(pos / (sizes.get(1, 0) + 1)) - F.log(neg / (sizes.get(0, 0) + 1))
    heavy = counts.select("item", "pos", odds.alias("odds"), F.sqrt(1 / pos + 1 / neg).alias("error"))
    heavy = heavy.withColumn("w", F.col("odds") - min(CAUTION) * F.col("error")).filter("w > 0")
    rows = heavy.orderBy(F.desc("w"), "item").limit(FEATURES).collect()
    trigrams = letter_counts(docs)

    def cautious(errors: float) -> Toxicity:
        weights = {r["item"]: r["odds"] - errors * r["error"] for r in rows}
        return Toxicity({k: w for k, w in weights.items() if w > 0}, trigrams)

    models = [cautious(c) for c in CAUTION]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = LetterModel(trigrams)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for number, m in enumerate(models):
                scorer = Scorer(m, letters)  # one at a time keeps tokens
                raw = pa.array([scorer.raw(t) for t in texts], pa.float64())
                which = pa.array([number] * len(texts), pa.int32())
                yield pa.RecordBatch.from_arrays([which, raw, batch.column(1).cast(pa.int64())], names=["model", "raw", "toxic"])

    points = apart.select("text", "toxic").mapInArrow(sums, "model int, raw double, toxic bigint")
    points = points.groupBy("model", "raw", "toxic").agg(F.count("*").alias("n")).collect()
    best: tuple[float, int] = (math.inf, 0)
    for number, model in enumerate(models):
        own = [r for r in points if r["model"] == number]
        x, y = np.array([r["raw"] for r in own]), np.array([r["toxic"] for r in own], dtype=float)
        n = np.array([r["n"] / rate[r["toxic"]] for r in own])
        model.slope, model.offset = _logistic(x, y, n)
        p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -30, 30)))
        loss = -float((n * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())
        best = min(best, (loss, number))
    return models[best[1]]


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``doc_id, score, predicted`` for every row; the score looks at ``text`` only.

    Null and empty texts get the score of a text without telling words; repeated rows give a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for part in _slices(batches):
            values = [scorer.score(t) for t in part.column(1).to_pylist()]
            columns = [part.column(0), pa.array(values, pa.float64()), pa.array([int(v >= 0.5) for v in values], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double, predicted int")


def accepted(docs: DataFrame, model: Toxicity) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, unchanged."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for part in _slices(batches):
            keep = pa.array([scorer.score(t) < 0.5 for t in part.column(at).to_pylist()], pa.bool_())
            yield part.filter(keep)

    return docs.mapInArrow(run, docs.schema)
