"""Array expressions over ordered IDs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.text import ColumnOrName, col


def in_order(*fields: ColumnOrName) -> Column:
    """Aggregate: the last field of all rows as an array, sorted by the fields before it.

    Use it only where the group has a fixed bound (one text, one chunk, one batch).
    """
    names = [f"_{i}" for i in range(len(fields))]
    packed = F.struct(*[col(f).alias(n) for f, n in zip(fields, names)])
    return F.sort_array(F.collect_list(packed))[names[-1]]


def pad_left(ids: ColumnOrName, size: int, fill: int = 0) -> Column:
    """The last ``size`` IDs, filled up on the left."""
    zeros = F.array_repeat(F.lit(fill).cast("bigint"), size)
    return F.slice(F.concat(zeros, col(ids)), -size, size)


def trailing_context(context: ColumnOrName, token_id: ColumnOrName, size: int) -> Column:
    """``context`` moved on by one ID; shorter contexts stay whole."""
    grown = F.concat(col(context), F.array(col(token_id).cast("bigint")))
    return F.slice(grown, -F.least(F.size(grown), F.lit(size)), F.lit(size))


def as_text(ids: ColumnOrName) -> Column:
    return F.array_join(col(ids).cast("array<string>"), " ")


def word_ngrams(words: ColumnOrName, low: int = 1, high: int = 3) -> Column:
    """All word n-grams of one text, with repeats.

    Longer grams zip shorter ones with the words after them, so each array is built once; a
    slice per position would evaluate ``words`` anew for every gram.
    """
    w = col(words)
    grams, level = [], w
    for n in range(1, high + 1):
        if n > 1:
            count = F.greatest(F.size(w) - (n - 1), F.lit(0))
            heads = F.slice(level, F.lit(1), count)
            level = F.zip_with(heads, F.slice(w, F.lit(n), count), lambda a, b: F.concat(a, F.lit(" "), b))
        if n >= low:
            grams.append(level)
    return F.concat(*grams)


def window_structs(ids: ColumnOrName, size: int, keep: int | None = None) -> Column:
    """Sliding examples of one array: ``(at, context, target)`` with stride 1.

    ``at`` is the index of the target. ``keep`` shortens the context to its last IDs, for
    callers that need only those; the set of examples stays that of ``size``.
    """
    a = col(ids)
    width = size if keep is None else keep
    steps = F.when(
        F.size(a) > size, F.sequence(F.lit(size), F.size(a) - 1)
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(
        steps,
        lambda i: F.struct(
            i.alias("at"),
            F.slice(a, i - (width - 1), width).alias("context"),
            F.element_at(a, i + 1).alias("target"),
        ),
    )
