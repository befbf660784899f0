"""Fill-in-the-middle: cuts from chunk counts equal cuts of the plain token list."""

import hashlib
import random
import re

import duckdb
import pytest
from llm_data import FOLDER, duck_of

from tokenloom.llm import middle

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    """The contract, word for word."""
    text = text or ""
    tokens = TOKEN.findall(text)
    hexes = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexes[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    alphabet = "ab Cé\n日😀1<>PSM"
    made = ["".join(rng.choices(alphabet, k=rng.choice([0, 1, 7, 300, 5000]))) for _ in range(120)]
    shared = "".join(rng.choices("abcdef ghi", k=3000))
    made += [shared[i:] + shared for i in range(40)]
    return made + ["", "x", "x" * 20_000, "é" * 9000, "ab<P>cd", "a<S>b", "<M>", "<P", "a<S", "a<<", "M>", "word " * 60_000, None]


def test_every_cut_equals_the_token_list():
    cache = middle.ChunkCache(room=4000)
    for text in texts():
        data = (text or "").encode()
        tokens = [t.encode() for t in TOKEN.findall(text or "")]
        index = middle.TokenIndex(data, cache)
        assert index.total == len(tokens)
        step = max(1, len(tokens) // 300)
        for k in [*range(0, len(tokens), step), len(tokens)]:
            head = b"".join(tokens[:k])
            assert index.cut(k) == (len(head), len(head.decode()))


def test_cache_keeps_chunks_in_use_and_its_size():
    cache = middle.ChunkCache(room=1000)
    for i in range(500):
        assert cache[b"always"] == middle.summarize(b"always")
        assert cache[b"chunk %d" % i].tokens == len(TOKEN.findall(f"chunk {i}"))
        assert cache.held <= 1000 and sum(map(len, cache.old)) <= 1000
        assert b"always" in cache.young or b"always" in cache.old


def test_an_insertion_moves_only_the_chunks_near_it():
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefgh ijkl", k=40_000)).encode()
    pieces = lambda data: {data[a:b] for a, b in zip([0, *middle.chunk_ends(data)], middle.chunk_ends(data), strict=False)}
    assert len(pieces(text) & pieces(b"inserted" + text)) > 0.9 * len(pieces(text))


def test_rows_equal_the_plain_version_and_the_sql(spark):
    rows = list(enumerate(texts())) + [(None, "null id text"), (7, "again"), (7, "again"), (-12, "minus one, two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = middle.fill_in_middle(docs).cache()
    back = made.withColumn("back", middle.restored("output", "form")).collect()
    want = sorted(((d, *plain(d, t), t or "") for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in back), key=repr) == want
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    sql = duck_of(docs, "documents").execute(middle.SQL).fetchall()
    assert sorted(sql, key=repr) == sorted((tuple(r) for r in middle.digest(made).collect()), key=repr)


def test_query_equals_sql_on_a_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    got = middle.digest(middle.fill_in_middle(spark.read.parquet(f"{FOLDER}/documents.parquet"))).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(middle.SQL).fetchall())


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_marks_beside_half_marks_part_exactly(spark, form):
    for p, m, s in [("<", "<S", ">"), ("", "", ""), ("<P", "<M", "<S"), ("a<", ">", "P>"), ("", "S>", "M>")]:
        output = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
        row = spark.createDataFrame([(output, form)], "output string, form string")
        assert row.select(middle.restored("output", "form")).first()[0] == p + m + s


def test_odd_rows(odd, nothing):
    got = middle.digest(middle.fill_in_middle(odd)).collect()
    want = [plain(r.doc_id, r.text) for r in odd.collect()]
    hashes = sorted(hashlib.sha256(w[4].encode()).hexdigest() for w in want)
    assert sorted(r.output_sha256 for r in got) == hashes
    assert sorted(r.n for r in got) == sorted(w[0] for w in want)
    assert middle.digest(middle.fill_in_middle(nothing)).collect() == []
