"""Secret scan: fixed patterns, and values next to credential words that are costly to guess.

A guesser knows some fixed words and all words of the corpus, most frequent first. Only a value that these words
could make cheap looks them up, so the dictionary stays a table and meets few rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.common import stored

# The base patterns, their kinds in order, and their least lengths.
ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex", "guess")

# Credential context: a word that ends in a credential word, a sign or "is", and a value; the value isn't used up, as
# it may hold the next credential word.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|api[_ -]?key|credentials?|login|auth)\b[\"']?"
    r"\s*(?:is\b|[:=]|->)\s*[\"'`]?(?=([^\s\"'`,;]+))",
    re.ASCII | re.IGNORECASE,
)
MIN_GUESSES = 8.0  # log10 of the guesses from which a value counts as a secret
WORD_LETTERS = (3, 24)  # letters of a word of the corpus; longer ones are spelled from shorter ones
LEAST_USES = 2  # times that a word must stand outside of values and patterns; a stray secret is no word
RANK_STEPS = 8  # steps of frequency per doubling; words of one step share their rank

# Common parts of passwords, most common first.
COMMON = (
    "password pass admin user login welcome letmein qwerty abc monkey dragon master secret love hello test guest "
    "root default change temp access token key summer winter spring autumn football baseball shadow sunshine "
    "princess iloveyou trustno computer internet server demo example sample changeme none null true false string "
    "value here your my the this that incorrect required invalid expired unknown empty wrong missing"
).split()
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")  # Fixed value.
_NEXT = {a + b for row in KEY_ROWS for a, b in zip(row, row[1:], strict=False)}
_WALK = _NEXT | {p[::-1] for p in _NEXT}
_RANK = {w: i + 1 for i, w in enumerate(COMMON)}
_LONGEST = max(map(len, COMMON))
_ADDRESS = re.compile(r"\w[\w+.-]*://")
_ADDRESS_SIGNS = re.compile(r"[/?&=#:@.]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?[01]\d(?:[-/.]?[0-3]\d)?)?|[0-3]?\d[-/.][01]?\d[-/.](?:19|20)?\d\d")


def _letter_cost(value: str) -> float:
    """log10 of the alphabet a guesser must try for one character of this value."""
    size = 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value)
    size += 10 * any(c.isdigit() for c in value) + 33 * any(not c.isalnum() for c in value)
    return math.log10(max(size, 10))


def guess_cost(
    value: str,
    rank: Callable[[str], int | None] = _RANK.get,
    longest: int = _LONGEST,
    limit: float = math.inf,
) -> float:
    """log10 of the guesses that the cheapest way to spell ``value`` takes; ``limit`` stands for all costs from there on.

    ``cost[i]`` is the least for the first ``i`` characters. A span is a word of at most ``longest`` characters (its
    rank, doubled if in mixed case), a date, a repeated character, a walk over neighbouring keys, or
    one character by brute force; each span but a single character adds the choice of its kind.
    """
    n, low, single = len(value), value.lower(), _letter_cost(value)
    cost = [0.0] + [math.inf] * n
    reach = 0  # the last place with a cost below the limit

    def reached(end: int, price: float) -> None:
        nonlocal reach
        if price < cost[end]:
            cost[end] = price
            if price < limit:
                reach = max(reach, end)

    for i in range(n):
        if i > reach:
            return limit
        here = cost[i]
        reached(i + 1, here + single)
        for end in range(i + 3, min(n, i + longest) + 1):
            if place := rank(low[i:end]):
                cased = value[i:end] != low[i:end]
                reached(end, here + math.log10(place * (1 + cased)) + 0.7)
        if dated := _DATE.match(value, i):
            reached(dated.end(), here + math.log10(40_000) + 0.7)
        # A run or walk is worth its start and its length; every shorter end is one too.
        for follows in (lambda k: value[k] == value[k - 1], lambda k: low[k - 1 : k + 1] in _WALK):
            if i and follows(i):
                continue  # started earlier
            end = i + 1
            while end < n and follows(end):
                end += 1
                if end - i >= 3:
                    reached(end, here + single + math.log10(end - i) + 0.7)
    return min(cost[n], limit)


def _is_word(text: str) -> bool:
    return WORD_LETTERS[0] <= len(text) <= WORD_LETTERS[1] and text.isalpha()


def _parts(value: str) -> list[str]:
    """What must be guessed: an address part by part, as its signs tell nobody anything, any other value whole."""
    return [p for p in _ADDRESS_SIGNS.split(value) if p] if _ADDRESS.match(value) else [value]


def is_secret(value: str, ranks: dict[str, int]) -> bool:
    """Whether some part of ``value`` costs 10^8 guesses or more, if words of the corpus have these ranks (from 1).

    The corpus' words come after the fixed ones.
    """

    def rank(text: str) -> int | None:
        place = ranks.get(text)
        return _RANK.get(text) or (place and place + len(COMMON))

    return any(guess_cost(p, rank, WORD_LETTERS[1], MIN_GUESSES) >= MIN_GUESSES for p in _parts(value))


def known_verdict(value: str) -> bool | None:
    """:func:`is_secret` where it holds whatever words the corpus has; None where its words decide.

    It holds if the fixed words alone make the value cheap, or if it is costly though every run of letters be the first word.
    """
    hard = [p for p in _parts(value) if guess_cost(p, limit=MIN_GUESSES) >= MIN_GUESSES]
    if not hard:
        return False

    def any_word(text: str) -> int | None:
        return 1 if _is_word(text) else _RANK.get(text)

    if any(guess_cost(p, any_word, WORD_LETTERS[1], MIN_GUESSES) >= MIN_GUESSES for p in hard):
        return True
    return None


def looked_up(value: str) -> set[str]:
    """All strings of ``value`` in lower case that a word of the corpus may spell."""
    found = set()
    for part in _parts(value.lower()):
        for run in _LETTERS.finditer(part):
            text = run[0]
            for i in range(len(text) - WORD_LETTERS[0] + 1):
                for end in range(i + WORD_LETTERS[0], min(len(text), i + WORD_LETTERS[1]) + 1):
                    if _is_word(text[i:end]):
                        found.add(text[i:end])
    return found


def _patterns_and_values(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str]]]:
    """``(start, kind, end)`` of the base patterns and ``(start, end, value)`` next to credential words, by start.

    Matches of one kind never overlap; a value that a base match holds whole is left out.
    """
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    values = []
    for m in CONTEXT.finditer(text):
        value, start = m[1].rstrip(".!?)>"), m.start(1)
        end = start + len(value)
        if not any(a <= start and end <= b for a, _, b in found):
            values.append((start, end, value))
    return found, values


def find_secrets(text: str | None, ranks: dict[str, int] | None = None) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of all secrets in code points, by start and then kind, given ranks of words."""
    if not text:
        return []
    found, values = _patterns_and_values(text)
    found += [(a, 3, b) for a, b, value in values if is_secret(value, ranks or {})]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def hidden_words(text: str, spans: list[tuple[int, int]]) -> list[str]:
    """The runs of letters inside the spans, which may overlap, in lower case."""
    words, at = [], 0
    for start, end in sorted(spans):
        words += _LETTERS.findall(text[max(at, start) : end].lower())
        at = max(at, end)
    return [w for w in words if _is_word(w)]


_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _first_look(rows: DataFrame) -> DataFrame:
    """``row, id, spans, open, hidden`` for rows ``row`` (a struct) and ``text``, stored.

    ``spans`` holds whatever is sure, ``open`` the values that the corpus' words decide, ``hidden`` the words of
    patterns and values, which don't count as the corpus' own.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    unsure = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, opened, hidden = [], [], []
            for text in batch.column(2).to_pylist():
                sure, values = _patterns_and_values(text or "")
                hidden.append(hidden_words(text or "", [(a, b) for a, _, b in sure] + [(a, b) for a, b, _ in values]))
                verdicts = [known_verdict(v) for _, _, v in values]
                sure += [(a, 3, b) for (a, b, _), v in zip(values, verdicts, strict=True) if v]
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in sorted(sure)])
                opened.append(
                    [
                        {"start": a, "end": b, "value": value}
                        for (a, b, value), v in zip(values, verdicts, strict=True)
                        if v is None
                    ]
                )
            columns = [pa.array(spans, span), pa.array(opened, unsure), pa.array(hidden, pa.list_(pa.string()))]
            names = ["row", "id", "spans", "open", "hidden"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    numbered = rows.select("row", F.monotonically_increasing_id().alias("id"), "text")
    rest = f"id bigint, spans {_SPANS}, open array<struct<start:bigint,end:bigint,value:string>>, hidden array<string>"
    shape = T.StructType([rows.schema["row"], *T.StructType.fromDDL(rest)])
    return stored(numbered.mapInArrow(run, shape), "secret-rows")


def word_ranks(texts: DataFrame, hidden: DataFrame) -> DataFrame:
    """``word, rank`` of the corpus: all words of ``text``, less one use for every row of ``hidden`` (``word``).

    The rank of a word is the number of words that are as frequent or more so, frequencies told apart in ``RANK_STEPS`` steps per
    doubling; so there are at most 64 * RANK_STEPS steps, and no task sorts the words.
    """
    runs = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{%d,}" % WORD_LETTERS[0]), F.lit(0))
    uses = texts.select(F.explode(runs).alias("word"), F.lit(1).alias("n"))
    uses = uses.unionByName(hidden.select("word", F.lit(-1).alias("n"))).filter(F.length("word") <= WORD_LETTERS[1])
    counts = uses.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_USES)
    step = F.floor(F.log2("n") * RANK_STEPS).cast("int")
    counts = stored(counts.select("word", step.alias("step")), "secret-words")
    sums = F.sum("words").over(Window.orderBy(F.desc("step")))
    steps = counts.groupBy("step").agg(F.count("*").alias("words")).select("step", sums.alias("rank"))
    return counts.join(F.broadcast(steps), "step").select("word", "rank")


def _verdicts(texts: DataFrame, looked: DataFrame) -> DataFrame:
    """``value, secret`` of all open values, each once."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                words = sorted(looked_up(value))
                columns = [pa.array([value] * len(words), pa.string()), pa.array(words, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["value", "word"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_pylist()
            known = [{w["word"]: w["rank"] for w in words} for words in batch.column(1).to_pylist()]
            secret = pa.array([is_secret(v, k) for v, k in zip(values, known, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), secret], names=["value", "secret"])

    values = stored(looked.select(F.explode("open.value").alias("value")).distinct(), "secret-values")
    ranks = word_ranks(texts, looked.select(F.explode("hidden").alias("word")))
    # A stored side leaves the join free to split a word that many values hold.
    asked = stored(values.mapInArrow(strings, "value string, word string"), "secret-strings")
    found = asked.join(ranks, "word").select("value", "word", "rank")
    none = values.select("value", F.lit(None).cast("string").alias("word"), F.lit(None).cast("bigint").alias("rank"))
    held = F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "rank"))).alias("words")
    lists = found.unionByName(none).groupBy("value").agg(held)
    return stored(lists.mapInArrow(judge, "value string, secret boolean"), "secret-verdicts")


def _settled(docs: DataFrame, row: Column) -> DataFrame:
    """``row, spans`` for every row of ``docs``: all spans ``(start, kind, end)``, sorted."""
    looked = _first_look(docs.select(row.alias("row"), "text"))
    is_open = F.size("open") > 0
    verdicts = _verdicts(docs.select("text"), looked).filter("secret").select("value")
    opened = looked.filter(is_open).select("id", F.explode("open").alias("o")).select("id", "o.*")
    span = F.struct("start", F.lit(3).alias("kind"), "end")
    more = opened.join(verdicts, "value").groupBy("id").agg(F.collect_list(span).alias("more"))
    late = looked.filter(is_open).select("row", "id", "spans").join(more, "id", "left")
    joined = F.array_sort(F.concat("spans", F.coalesce("more", F.array().cast(_SPANS))))
    return looked.filter(~is_open).select("row", "spans").unionByName(late.select("row", joined.alias("spans")))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``(kind, start, end)``, for every row.

    Null texts count as empty and have no spans; repeated rows give a row each; extra columns are ignored; an empty table
    gives none. A value of any length is judged whole.
    """
    found = _settled(docs, F.struct("doc_id"))
    named = F.transform(
        "spans",
        lambda s: F.struct(
            F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
        ),
    )
    return found.select("row.doc_id", named.alias("spans"))


def masked(text: str | None, spans: list[tuple[int, int]], mark: str = "[secret]") -> str | None:
    """The text with every span, in order of start, replaced by ``mark``; overlapping ones become one mark."""
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text without its secrets, as far as they are known without a corpus."""
    return masked(text, [(a, b) for a, _, b in find_secrets(text)], mark)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` without secrets in ``text``; ``n_chars``, if there, is counted anew where it changed.

    Every row stays, repeated ones too, with all its columns; a null text stays null, an empty one empty, and of an empty table
    none is left. Overlapping secrets become one mark.
    """
    names = docs.columns
    chars = "n_chars" in names
    counted = docs.schema["n_chars"].dataType.simpleString() if chars else "bigint"
    shape = T.StructType([T.StructField("row", docs.schema), *T.StructType.fromDDL("text string, chars bigint")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = pc.struct_field(batch.column(0), "text").to_pylist()
            spans = [[(s["start"], s["end"]) for s in r] for r in batch.column(1).to_pylist()]
            new = [masked(t, s) for t, s in zip(old, spans, strict=True)]
            sizes = [None if a == b else len(b) for a, b in zip(old, new, strict=True)]
            columns = [batch.column(0), pa.array(new, pa.string()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "chars"])

    done = _settled(docs, F.struct("*")).mapInArrow(run, shape)
    fresh = {"text": F.col("text")}
    if chars:
        fresh["n_chars"] = F.when(F.col("chars").isNull(), F.col("row.n_chars")).otherwise(F.col("chars").cast(counted))
    return done.select(*(fresh.get(c, F.col("row").getField(c)).alias(c) for c in names))


def digest(spans: DataFrame) -> DataFrame:
    """Counts per base kind, ``base_sha256`` and ``spans`` as text, from :func:`scan`'s rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            texts = [[f"{s['kind']}:{s['start']}:{s['end']}" for s in r] for r in rows]
            base = [",".join(x for x in r if not x.startswith("guess:")) for r in texts]
            counts = [pa.array([sum(s["kind"] == k for s in r) for r in rows], pa.int64()) for k in KINDS[:3]]
            sums = pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string())
            joined = pa.array([",".join(r) for r in texts], pa.string())
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, sums, joined], names=names)

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return spans.mapInArrow(run, schema)
