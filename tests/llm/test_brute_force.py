"""Plain doubles of what op3, op6 and op7 rest on: all segmentations, all ways through a lattice, one position after the other."""

import math
import random
from itertools import groupby

import numpy as np
import pytest
from llm_data import FOLDER

from tokenloom.llm import langid, secrets, toxicity


def span_cost(value, i, j, single):
    """Cheapest way to spell ``value[i:j]`` as one span; infinite if it is none."""
    low, costs = value.lower(), []
    if j == i + 1:
        return single
    if low[i:j] in secrets.COMMON:
        rank = secrets.COMMON.index(low[i:j]) + 1
        costs.append(math.log10(rank * (1 if value[i:j] == low[i:j] else 2)) + 0.7)
    dated = secrets._DATE.match(value, i)
    if dated and dated.end() == j:
        costs.append(math.log10(40_000) + 0.7)
    pairs = {a + b for row in secrets.KEY_ROWS for line in (row, row[::-1]) for a, b in zip(line, line[1:])}
    for follows in (lambda k: value[k] == value[k - 1], lambda k: low[k - 1 : k + 1] in pairs):
        if j - i >= 3 and all(follows(k) for k in range(i + 1, j)) and not (i and follows(i)):
            costs.append(single + math.log10(j - i) + 0.7)
    return min(costs, default=math.inf)


def all_segmentations(value):
    """The least cost over every way to cut ``value``, each one listed."""
    size = 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value)
    size += 10 * any(c.isdigit() for c in value) + 33 * any(not c.isalnum() for c in value)
    single, best = math.log10(max(size, 10)), math.inf
    for cuts in range(1 << (len(value) - 1)):
        ends = [i + 1 for i in range(len(value) - 1) if cuts >> i & 1] + [len(value)]
        best = min(best, sum(span_cost(value, a, b, single) for a, b in zip([0, *ends], ends, strict=False)))
    return best


def test_guess_cost_is_the_least_of_all_segmentations():
    rng = random.Random(7)
    parts = ["pass", "Key", "abc", "hello", "1999", "2001-12", "3/4/99", "aaa", "111", "qwe", "fdsa", "x", "Z", "9", "!", "é", "-"]
    values = {"".join(rng.choices(parts, k=rng.randrange(1, 5)))[:12] for _ in range(150)} | {"a", "aa", "passpass", "qwertyui"}
    for value in values:
        assert abs(secrets.guess_cost(value) - all_segmentations(value)) < 1e-9, value


def runs(text, good):
    """``(start, end)`` of the maximal runs of characters that are ``good``."""
    at = 0
    for kind, group in groupby(text, good):
        size = sum(1 for _ in group)
        if kind:
            yield at, at + size
        at += size


def plain_base(text):
    """The base patterns without regular expressions."""
    found = [(a, 2, b) for a, b in runs(text, lambda c: c in "0123456789abcdef") if b - a >= 16]
    upper = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    at = text.find("AKIA")
    while at >= 0:
        end = at + 4
        while end < len(text) and text[end] in upper:
            end += 1
        if end == at + 4:  # nothing after it
            at = text.find("AKIA", at + 1)
            continue
        if end - at >= 18:
            found.append((at, 1, end))
        at = text.find("AKIA", end)
    body = upper | set("abcdefghijklmnopqrstuvwxyz+/_.=-")
    ascii_low = "".join(c.lower() if c.isascii() else c for c in text)
    at = 0
    while at < len(text):
        best = None
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if not ascii_low.startswith(word, at):
                continue
            ways = [at + len(word)]
            ways = [w + 1 for w in ways if text[w : w + 1] in ("\"", "'") and text[w : w + 1]] + ways
            for way in ways:
                k = way
                while text[k : k + 1] == " ":
                    k += 1
                if text[k : k + 1] not in (":", "=") or not text[k : k + 1]:
                    continue
                k += 1
                while text[k : k + 1] == " ":
                    k += 1
                if text[k : k + 1] in ("\"", "'") and text[k + 1 : k + 2] and text[k + 1] in body:
                    k += 1
                end = k
                while end < len(text) and text[end] in body:
                    end += 1
                if end > k:
                    best = (k, end)
                    break
            if best:
                break
        if best is None:
            at += 1
            continue
        if best[1] - best[0] >= 12:
            found.append((at, 0, best[1]))
        at = best[1]
    return [(a, secrets.KINDS[k], b) for a, k, b in sorted(found)]


def test_base_spans_of_a_table_equal_a_plain_scan(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans if s.kind != "guess"] for r in secrets.scan(docs).collect()}
    assert got == {d: plain_base(t) for d, t in texts.items()} and any(got.values())


def plain_ways(token, model):
    """Every way through the lattice of a token, with its cost and text."""
    ways = [("^^", 0.0, "")]
    for at, char in enumerate(token):
        letters = ([(char, 0.0)] if char.isalpha() else []) + [(x, toxicity.SIGN_COST) for x in toxicity.SIGNS.get(char, "")]
        nexts = []
        for last, cost, text in ways:
            nexts += [(last[1] + x, cost + extra + model.cost(last + x), text + x) for x, extra in letters]
            if char in toxicity.GAPS:
                nexts.append((last, cost + toxicity.GAP_COST, text))
            elif at and char == token[at - 1]:
                nexts.append((last, cost + toxicity.REPEAT_COST, text))
            elif not letters:
                nexts.append((last, cost + toxicity.ODD_COST, text))
        ways = nexts
    return [(cost + model.cost(last + "$"), text) for last, cost, text in ways]


def test_viterbi_finds_the_cheapest_of_all_ways():
    words = ["idiot", "moron", "stupid", "loser", "the", "list", "tidy", "odd"]
    counts = {}
    for n, word in enumerate(words):
        letters = f"^^{word}$"
        for i in range(len(letters) - 2):
            a, b, c = map(ord, letters[i : i + 3])
            counts[a << 42 | b << 21 | c] = counts.get(a << 42 | b << 21 | c, 0) + n + 3
    model = toxicity.LetterModel(toxicity.Trigrams(sorted(counts), [counts[c] for c in sorted(counts)]))
    rng = random.Random(9)
    tokens = ["1d10t", "i.d.i.o.t", "iidiott", "m0r0n", "st*pid", "!d!0t", "???", "ll", "o-d-d-"]
    tokens += ["".join(rng.choices("idot10!.-$ s", k=rng.randrange(1, 8))) for _ in range(60)]
    for token in tokens:
        cost, _ = min(plain_ways(token, model))
        restored = [c for c, text in plain_ways(token, model) if text == toxicity.restore(token, model)]
        assert restored and abs(min(restored) - cost) < 1e-9, token


def plain_states(data, p, side):
    """One direction of the gated network, a byte at a time with scalars."""
    h = langid.HIDDEN
    order = range(len(data)) if side == "f" else range(len(data) - 1, -1, -1)
    state, states = [0.0] * h, {}
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    for t in order:
        x = [float(v) for v in p["x" + side][data[t]]]
        back = [sum(state[j] * float(p["u" + side][j][k]) for j in range(h)) for k in range(3 * h)]
        z = [sigmoid(x[k] + back[k]) for k in range(h)]
        r = [sigmoid(x[h + k] + back[h + k]) for k in range(h)]
        new = [math.tanh(x[2 * h + k] + r[k] * back[2 * h + k]) for k in range(h)]
        state = [(1 - z[k]) * new[k] + z[k] * state[k] for k in range(h)]
        states[t] = state
    return states


@pytest.mark.parametrize("seed", [1, 2])
def test_every_position_of_the_network_equals_scalars(seed):
    rng = random.Random(seed)
    net = langid.new_network(["a", "b", "c"], seed)
    rows = [[rng.randrange(256) for _ in range(rng.randrange(1, 9))] for _ in range(5)]
    width = max(map(len, rows))
    windows = np.array([r + [0] * (width - len(r)) for r in rows])
    got = langid.probabilities(windows, np.array([len(r) for r in rows]), net)
    for row, sums in zip(rows, got, strict=True):
        want = np.zeros(3)
        f, b = plain_states(row, net.params, "f"), plain_states(row, net.params, "b")
        for t in range(len(row)):
            logits = [sum(f[t][j] * float(net.params["of"][j][k]) + b[t][j] * float(net.params["ob"][j][k]) for j in range(langid.HIDDEN)) + float(net.params["bias"][k]) for k in range(3)]
            e = np.exp(np.array(logits) - max(logits))
            want += e / e.sum()
        assert np.abs(want - sums).max() < 1e-4
