"""Fill-in-the-middle: token cuts found from the counts of content-defined chunks."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks, the tokens, and the shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED, SUFFIX_FIRST = 90, 20
SEED = "1:"

LEAST, MASK_BITS, MOST = 128, 8, 2048  # bytes of a chunk: at least, 2**bits more on average, at most
CACHE_BYTES = 16 << 20  # chunk bytes of each of a task's two generations of summaries
_GEAR = np.random.default_rng(13).integers(0, 2**32, 256, dtype=np.uint32)
_MASK = np.uint32(((1 << MASK_BITS) - 1) << (32 - MASK_BITS))

# In UTF-8 a code point has one byte that doesn't continue another, so counts need no decoding
# and chunks may end inside a code point.
_CONTINUES = bytes(range(0x80, 0xC0))
_TOKEN = re.compile(rb"[A-Za-z]+|[^A-Za-z\x80-\xbf]")
_LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


class Summary(NamedTuple):
    """What a chunk adds to its text, whatever stands around it."""

    tokens: int  # tokens of the chunk alone
    chars: int  # code points that begin in it
    opens: bool  # its first byte is a letter
    closes: bool  # its last byte is a letter


def summarize(chunk: bytes) -> Summary:
    return Summary(
        len(_TOKEN.findall(chunk)), len(chunk.translate(None, _CONTINUES)), chunk[0] in _LETTERS, chunk[-1] in _LETTERS
    )


class ChunkCache:
    """Summaries of chunks seen before.

    A chunk is looked up by its bytes: a dict goes by their hash and then compares them, so chunks with
    one hash are never mixed up. Two generations of at most ``room`` bytes each hold them; one that is full
    takes the place of the older one, so chunks in use stay.
    """

    def __init__(self, room: int = CACHE_BYTES) -> None:
        self.room, self.held = room, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}

    def __getitem__(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is None:
            found = self.old.get(chunk) or summarize(chunk)
            if self.held + len(chunk) > self.room:
                self.old, self.young, self.held = self.young, {}, 0
            self.young[chunk] = found
            self.held += len(chunk)
        return found


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks: where the top bits of a gear hash of the last 32 bytes are 0, at least ``LEAST``
    and at most ``MOST`` bytes apart.

    The hash is summed for all positions at once by doubling the span five times.
    """
    gear = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for step in (1, 2, 4, 8, 16):
        shifted = gear[:-step] << np.uint32(step)
        gear[step:] += shifted
    ends, last = [], 0
    for at in (np.flatnonzero((gear & _MASK) == 0) + 1).tolist():
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST:
            last = at
            ends.append(at)
    while len(data) - last > MOST:
        last += MOST
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


class TokenIndex:
    """Tokens of one text: counts after each chunk, from the chunks' summaries alone.

    Two chunks share a token if the first ends and the second begins with a letter; their
    counts add up less that one.
    """

    def __init__(self, data: bytes, cache: ChunkCache) -> None:
        self.data, self.ends = data, chunk_ends(data)
        self.tokens, self.chars, self.joined = [0], [0], []
        begin, closes = 0, False
        for end in self.ends:
            part = cache[data[begin:end]]
            joined = closes and part.opens
            self.joined.append(joined)
            self.tokens.append(self.tokens[-1] + part.tokens - joined)
            self.chars.append(self.chars[-1] + part.chars)
            begin, closes = end, part.closes

    @property
    def total(self) -> int:
        return self.tokens[-1]

    def cut(self, tokens: int) -> tuple[int, int]:
        """Byte and code point at which the first ``tokens`` tokens end.

        That is where the next token begins: the counts name its chunk, and only this chunk is read.
        """
        if tokens >= self.total:
            return len(self.data), self.chars[-1]
        at = bisect_right(self.tokens, tokens) - 1
        begin, end = self.ends[at - 1] if at else 0, self.ends[at]
        chunk = self.data[begin:end]
        nth = tokens - self.tokens[at] + self.joined[at]
        inside = next(islice(_TOKEN.finditer(chunk), nth, None)).start()
        return begin + inside, self.chars[at] + len(chunk[:inside].translate(None, _CONTINUES))


def draws(doc_id: int | None) -> list[int]:
    """The four numbers that decide the cuts and the form; a null id counts as the empty text."""
    digits = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]


def rearrange(doc_id: int | None, data: bytes, cache: ChunkCache) -> tuple[int, str, int | None, int | None, bytes]:
    """Number of tokens, form, code points of prefix and middle (None for a plain text), and the output."""
    index = TokenIndex(data, cache)
    first, second, keep, order = draws(doc_id)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not data or keep % 100 >= CHANGED or any(m in data for m in marks):
        return index.total, "plain", None, None, data
    low, high = sorted((first % (index.total + 1), second % (index.total + 1)))
    (a, a_chars), (b, b_chars) = index.cut(low), index.cut(high)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if order % 100 < SUFFIX_FIRST:
        form, output = "spm", marks[1] + suffix + marks[0] + prefix + marks[2] + middle
    else:
        form, output = "psm", marks[0] + prefix + marks[1] + suffix + marks[2] + middle
    return index.total, form, a_chars, b_chars - a_chars, output


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    A token is a run of ASCII letters or any other single code point. Each task keeps the token counts of the
    chunks it has met, so what texts share is counted once; no row leaves its task.

    A null text counts as empty: no token, form ``plain``, empty output. Repeated rows give equal rows,
    rows with the same text but another id other cuts. A null id draws as the empty text. Texts of any length
    are cut whole; extra columns are ignored; no documents give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = [
                    rearrange(doc, text or b"", cache)
                    for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                ]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"
    made = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(run, schema)
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: str | Column, form: str | Column) -> Column:
    """The text behind an output of a form. The marks stand in no changed text, so they part it exactly."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    psm, spm = F.split(body, f"{SUFFIX}|{MIDDLE}", -1), F.split(body, f"{PREFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )


def digest(made: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts restored from them."""
    hashes = [
        F.sha2(c.cast("binary"), 256).alias(name)
        for name, c in (("output_sha256", F.col("output")), ("restored_sha256", restored("output", "form")))
    ]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


SQL = r"""WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (
  SELECT *, len(w)::BIGINT AS n, ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2,
    ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM t),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (
  SELECT doc_id, n, form, text, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m,
    array_to_string(w[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM c"""
