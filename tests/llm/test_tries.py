"""Prefix trie: blocks of ROLLUPs equal a dict of prefixes and the SQL."""

import hashlib
import random
import zlib

import duckdb
import pyarrow as pa
import pytest
from llm_data import FOLDER
from pyspark.sql import types as T

from tokenloom.llm import tries

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
    + [T.StructField(n, T.LongType()) for n in ("pos", "id", "prev", "level", "t1", "name", "n")]
)


def spoken(rows):
    return [(*r, *range(7)) for r in rows]


def plain(rows):
    """The contract with a dict of prefixes."""

    def key(turn, role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, key(turn, role, text), (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(whole[c]) + 1):
            members.setdefault(whole[c][:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves = sum(sums[b][0] for b in below) if below else 1
        own_part = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = (leaves, own_part + sum(sums[b][1] for b in below))
    out = []
    for node, convs in members.items():
        ended = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), *sums[node], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(spark, rows, widths=tries.WIDTHS):
    return sorted((tuple(r) for r in tries.prefix_trie(spark.createDataFrame(spoken(rows), SCHEMA), widths).collect()), key=repr)


def sql(rows):
    con = duckdb.connect()
    table = pa.Table.from_pylist([dict(zip(("conv_id", "turn", "role", "text"), r, strict=True)) for r in rows])
    con.register("conversations", table)
    return sorted(con.execute(tries.SQL).fetchall(), key=repr)


def conversations(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        script = rng.randrange(4)
        for t in range(rng.randrange(1, most)):
            text = f"line {script if rng.random() < 0.97 else rng.randrange(9)} {t} é"
            rows.append((c, t if rng.random() < 0.98 else None, ("user", "assistant")[t % 2], text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("widths", [(8, 16, 32), (1, 2), (3,)])
def test_equals_a_dict_of_prefixes(spark, widths):
    rows = conversations(1, [*range(-12, 40), 1003, 1004, 2**40 + 3], 24)
    assert made(spark, rows, widths) == plain(rows)


def test_sql_equals_a_dict_of_prefixes():
    rows = conversations(2, range(-7, 60), 12)
    assert sql(rows) == plain(rows)


def test_copies_of_one_long_conversation_and_one_alone(spark):
    long = [(c, t, "user", f"turn {t}") for c in (5, 10, 15) for t in range(70)]
    alone = [(20, t, "user", f"other {t}") for t in range(9000)]
    got = made(spark, long + alone)
    assert got == plain(long + alone)
    assert max(r[1] for r in got) > 8900


def test_one_script_in_many_conversations(spark):
    rows = [(c, t, "user", "hello") for c in range(9000) for t in range(c % 3 + 1)]
    assert made(spark, rows) == plain(rows)


def test_query_equals_sql_on_a_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    got = tries.prefix_trie(spark.read.parquet(f"{FOLDER}/conversations.parquet")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(tries.SQL).fetchall()))


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, None, None, None), (1, 3, "user", ""), (1, 3, "user", ""), (1, 3, "", "user"),
        (2, 0, "user", "x" * 200_000), (3, -5, "user", "tie"), (3, -5, "a", "tie"), (3, -(2**62), "first", None),
        (None, 1, "user", "lost"), (None, None, None, None), (4, 7, None, "é日😀"), (14, 0, "user", "no base"),
        *[(0, t, "user", f"base {t}") for t in range(10)],
    ]
    assert made(spark, rows) == plain(rows) == sql(rows)
    assert tries.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert made(spark, [(None, 1, "user", "lost")]) == []


def test_a_conversation_without_turns_left(spark):
    lone = next(c for c in range(10**6, 10**6 + 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(lone, 0, "user", "dropped"), (lone, 1, "user", "dropped too")]
    want = plain(rows)
    assert made(spark, rows) == want and want[0][:6] == (lone, 0, None, 1, 0, 1)
