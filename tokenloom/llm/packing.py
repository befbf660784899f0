"""Packing token pieces into sequences: first-fit decreasing with a tournament tree of bins."""

from __future__ import annotations

import os
import re
import weakref
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.common import stored

LENGTH = 1024  # Fixed value: tokens of a sequence.
END_ID = 0  # Fixed value: the id after each document.
GROUP_PIECES = 8192  # mean pieces of a random group
CACHE_WORDS = 600_000  # words whose ids a task keeps

# A blank or line end that is not followed by a plain character: such texts are encoded whole.
_IRREGULAR = re.compile(r"[ \n](?![\w!-~])")


def _byte_letters() -> dict[int, str]:
    """Letters that stand for the bytes 128 to 255 in a byte-level vocabulary.

    The rule of such vocabularies: visible Latin-1 characters stand for themselves, the others
    get the letters from 256 on, in order.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b if b in visible else 256 + hidden.index(b)) for b in range(256)}


class _Words(dict):
    """Ids of words, with what stands before each; works out the missing ones and keeps so many."""

    def __init__(self, encoder: WordEncoder, before: str, room: int) -> None:
        # Not a cycle: the words of a task go with its encoder, and don't wait for the collector in a reused worker.
        self.encoder, self.before, self.room = weakref.proxy(encoder), before, room
        self.start = "".join(encoder.letters[b] for b in before.encode())

    def __missing__(self, word: str) -> bytes:
        encoder = self.encoder
        stem, mark = word, encoder.marks.get(word[-1:])
        if mark is not None and word[:-1].isalpha():
            stem = word[:-1]
            known = self.get(stem)
            ids = (self.plain(stem) if known is None else known) + mark
        elif word.isalpha():
            ids = self.plain(word)
        else:
            ids = encoder.whole(self.before + word)
        if len(self) < self.room:
            self[word] = ids
        return ids

    def plain(self, word: str) -> bytes:
        """Ids of a word of letters only: one piece to the tokenizer's pattern."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.encoder.letters)
        return array("I", [t.id for t in self.encoder.model.tokenize(self.start + word)]).tobytes()


class WordEncoder:
    """Ids of whole texts, word by word.

    The tokenizer always starts a new piece at a blank that is followed by a visible
    character, and around a single line end between visible characters, so ids of the pieces
    between can be worked out once and joined. Texts with other white space go to the tokenizer whole.
    """

    def __init__(self, path: str, room: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.line_end = self.whole("\n")
        self.marks = {mark: self.whole(mark) for mark in ".,;:!?"}
        self.words, self.firsts = _Words(self, " ", room), _Words(self, "", room // 8)
        self.firsts[""] = b""

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if not text:
            return b""
        if _IRREGULAR.search(text):
            return self.whole(text)
        firsts, words, rows = self.firsts, self.words, []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            rows.append(firsts[first] + b"".join([words[w] for w in rest]))
        return self.line_end.join(rows)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, with_ids: bool = True, cache_words: int = CACHE_WORDS
) -> DataFrame:
    """Cut each document's ids, with ``END_ID`` at the end, into pieces of at most ``LENGTH``.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens`` and, if asked for, ``ids``
    (array of int). ``tokenizer_path`` must be readable on every executor. Null texts count as
    empty and give one piece with the end id only.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path, cache_words)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows: dict[str, list] = {n: [] for n in ("doc_id", "start", "length", "crc", "tokens", "ids")}
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encoder.encode(text) + end
                    for begin in range(0, len(ids), 4 * LENGTH):
                        piece = ids[begin : begin + 4 * LENGTH]
                        rows["doc_id"].append(doc)
                        rows["start"].append(begin // 4)
                        rows["length"].append(len(piece) // 4)
                        rows["crc"].append(zlib.crc32(piece))
                        rows["tokens"].append(len(ids) // 4)
                        rows["ids"].append(piece)
                columns = [pa.array(rows[n], pa.int64()) for n in ("doc_id", "start", "length", "crc", "tokens")]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, dtype="<i4") for x in rows["ids"]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return docs.select("doc_id", "text").mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


class BinTree:
    """Open bins by number, with the largest room of every subtree: finds the first that fits."""

    def __init__(self, bins: int, room: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def take(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room; returns its number and what it held before."""
        at, best = 1, self.best
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        room = best[at]
        best[at] = room - size
        found = at - self.leaves
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return found, room


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size; sizes are placed largest first, ties in the given order."""
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    tree = BinTree(len(sizes), room)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        bins[i], before = tree.take(size)
        offsets[i] = room - before
    return bins, offsets


def pack(pieces: DataFrame, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``LENGTH`` tokens.

    Pieces are stored with a number each and go to random groups by a hash of it; the number of groups follows the
    number of pieces, so a group stays small whatever repeats, and each is packed on its own, without the ``ids``: they meet
    their place afterwards, in a join by number. A sequence lies in one group: its id is the group's number and the bin's number in it.
    """
    columns = pieces.columns
    kept = stored(pieces.withColumn("_piece", F.monotonically_increasing_id()), "token-pieces")
    rest = kept.filter(F.col("length") < LENGTH)
    groups = max(1, -(-rest.count() // group_pieces))
    light = rest.drop("ids")
    placed_fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*light.schema.fields, *placed_fields])

    def place(group: pa.Table) -> pa.Table:
        # The order of rows in a group may differ between attempts; this one does not.
        group = group.sort_by("_piece")
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), LENGTH)
        number = group["_group"].to_numpy().astype(np.int64)
        out = group.drop_columns(["_group"])
        ids = ((number << 32) | bins) << 1
        return out.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    number = F.pmod(F.xxhash64("_piece"), F.lit(groups))
    placed = light.withColumn("_group", number.cast("int")).groupBy("_group").applyInArrow(place, schema)
    if "ids" in columns:
        placed = placed.join(rest.select("_piece", "ids"), "_piece")
    # A full piece is a sequence of its own; odd numbers never meet those of the groups.
    own = F.shiftleft("_piece", 1) + 1
    alone = kept.filter(F.col("length") >= LENGTH).select("*", own.alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return placed.unionByName(alone).select(*columns, "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, with_ids: bool = True, cache_words: int = CACHE_WORDS
) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and ``ids`` if asked for.

    Null texts count as empty; repeated rows are packed each; extra columns are ignored; no documents give no rows.
    Each task keeps the ids of at most ``cache_words`` words, about 200 bytes each; the others are worked out anew.
    """
    return pack(token_pieces(docs, tokenizer_path, with_ids, cache_words))
