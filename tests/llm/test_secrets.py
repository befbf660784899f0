"""Secrets: the fixed patterns case by case, and the cost of guesses."""

import hashlib
import math
import random

import pytest

from tokenloom.llm import secrets

KEY = "AKIAABCDEFGHIJKLMN"


@pytest.mark.parametrize(
    "text,want",
    [
        ("token = abcdefghijkl", [(0, "assign", 20)]),
        ("token = abcdefghijk", []),
        ("API_KEY:'abc/def+ghi=jk'", [(0, "assign", 23)]),
        ("x apikey\"=\"0123456789ab\"", [(2, "assign", 23)]),
        ("token: secret: abcdefghijklmnop", []),
        (f"é {KEY}", [(2, "access", 20)]),
        (KEY[:-1], []),
        ("0123456789abcdef", [(0, "hex", 16)]),
        ("0123456789abcdeF", []),
        ("ſecret=abcdefghijkl", []),
    ],
)
def test_base_patterns(text, want):
    assert [s for s in secrets.find_secrets(text) if s[1] != "guess"] == want


def test_costs():
    assert secrets.guess_cost("password") < 2
    assert secrets.guess_cost("qwertyuiop") < 5
    assert secrets.guess_cost("aaaaaaaaaaaa") < 5
    assert secrets.guess_cost("2019-12-31") < 6
    assert secrets.guess_cost("password1999") < 8
    assert secrets.guess_cost("x7#Kq9!pL2") > 15
    for value in ("a", "zq", "Tr0ub4dor&3"):
        assert secrets.guess_cost(value) <= len(value) * math.log10(95) + 1e-9


def test_costly_values_in_credential_context():
    text = "The password is x7#Kq9!pL2. The password is welcome. passwd: qwerty12"
    assert [text[a:b] for a, k, b in secrets.find_secrets(text) if k == "guess"] == ["x7#Kq9!pL2"]
    assert secrets.redact(text).startswith("The password is [secret].")


@pytest.mark.parametrize(
    "text,value",
    [
        ("pwd: QzXvBhTmWlKdRtYp", "QzXvBhTmWlKdRtYp"),
        ("DB_PASSWORD=hunter2!xQ", "hunter2!xQ"),
        ("client_secret: a9$kQ!x2", "a9$kQ!x2"),
        ("pin: a9$Q!x", "a9$Q!x"),
        ("pwd: a$Q9z", "a$Q9z"),
        ("pwd: pin: a$Q9z", "a$Q9z"),
        ("password = \"Abcdefghijk1!9xQ#z\"", "Abcdefghijk1!9xQ#z"),
    ],
)
def test_cost_alone_decides(text, value):
    assert [text[a:b] for a, k, b in secrets.find_secrets(text) if k == "guess"] == [value]
    assert value[-4:] not in secrets.redact(text)


def test_guess_spans_inside_base_spans_stay_out():
    assert [k for _, k, _ in secrets.find_secrets("token = abcdefghijkl9Zq7")] == ["assign"]


def test_digest_columns(spark):
    docs = [(1, f"token = abcdefghijkl {KEY}"), (2, None), (2, None)]
    rows = secrets.digest(secrets.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    one = next(r for r in rows if r.doc_id == 1)
    joined = "assign:0:20,access:21:39"
    assert (one.n_assign, one.n_access, one.n_hex, one.spans) == (1, 1, 0, joined)
    assert one.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert [r.base_sha256 for r in rows if r.doc_id == 2] == [hashlib.sha256(b"").hexdigest()] * 2


def test_odd_rows(odd, nothing):
    assert secrets.scan(odd).count() == odd.count()
    assert secrets.redacted(odd).columns == odd.columns and secrets.redacted(odd).count() == odd.count()
    assert secrets.scan(nothing).count() == 0 and secrets.redacted(nothing).count() == 0


SENTENCES = [
    "the secret is perseverance",
    "The token is essential",
    "the api key is documented",
    "password: butterfly",
    "login: mustermann",
    "login: https://www.example.org/butterfly?page=documented",
]
PROSE = "Perseverance is essential and documented, says mustermann of the butterfly on https://www.example.org/page. " * 3


def doubled_ranks(texts):
    """Ranks by plain counting, as :func:`secrets.word_ranks` promises them."""
    uses = {}
    for text in texts:
        shown = list(text)
        base, values = secrets._patterns_and_values(text)
        for a, b in [(a, b) for a, _, b in base] + [(a, b) for a, b, _ in values]:
            shown[a:b] = "0" * (b - a)
        for word in "".join(c if c.isalpha() else " " for c in "".join(shown).lower()).split():
            if 3 <= len(word) <= 24:
                uses[word] = uses.get(word, 0) + 1
    steps = {w: math.floor(math.log2(n) * 8) for w, n in uses.items() if n >= 2}
    return {w: sum(other >= s for other in steps.values()) for w, s in steps.items()}


def test_words_of_the_corpus_are_no_secrets(spark):
    odd_ones = ["password: gzkwpqvbnhx", "pwd: QzXvBhTmWlKdRtYp", "token is https://hooks.example.org/x7Kq9pL2dW"]
    texts = [*SENTENCES, *odd_ones, PROSE, None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans] for r in secrets.scan(docs).collect()}
    want = {i: [] for i in range(len(texts))}
    want |= {6: ["gzkwpqvbnhx"], 7: ["QzXvBhTmWlKdRtYp"], 8: ["https://hooks.example.org/x7Kq9pL2dW"]}
    assert got == want
    shown = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert shown == {i: texts[i] for i in range(len(texts))} | {
        6: "password: [secret]", 7: "pwd: [secret]", 8: "token is [secret]"
    }


def test_values_are_judged_as_one_text_at_a_time_would(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(3, 9))) for _ in range(60)]
    texts = []
    for _ in range(120):
        value = rng.choice(words) + rng.choice(["", "7", "-"]) + rng.choice([*words, "Xq9", "1999", "qwert", "zzzz"])
        lead = " ".join(rng.choices(words, weights=range(60, 0, -1), k=12))
        texts.append(f"{lead} {rng.choice(['password is', 'PIN:', 'db_token =', 'so'])} {value}. {lead}")
    texts += [texts[0], "pwd: " + "ab" * 5000, "pwd: " + "perseverance" * 3000, "pin: " + "a" * 20000 + "xqzkvw"]
    ranks = doubled_ranks(texts)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in secrets.scan(docs).collect()}
    assert got == {i: secrets.find_secrets(t, ranks) for i, t in enumerate(texts)}
    assert 10 < sum(map(bool, got.values())) < len(texts)


def test_a_known_verdict_holds_for_any_words():
    rng = random.Random(9)
    seen = set()
    for _ in range(300):
        value = "".join(rng.choice("abcdefXYZ019-$") for _ in range(rng.randint(1, 14)))
        verdict = secrets.known_verdict(value)
        seen.add(verdict)
        for ranks in ({}, dict.fromkeys(secrets.looked_up(value), 1)):
            assert verdict is None or secrets.is_secret(value, ranks) == verdict
    assert seen == {True, False, None}


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(1, "pwd: a$Q9z", "r", 7, 7, 10), (1, "pwd: a$Q9z", "r", 7, 7, 10), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, `row` string, `a b.c` int, spans int, n_chars int"
    )
    got = sorted(map(tuple, secrets.redacted(docs).collect()), key=str)
    assert got == sorted([(1, "pwd: [secret]", "r", 7, 7, 13)] * 2 + [rows[2]], key=str)
    assert secrets.redacted(docs).schema == docs.schema
