"""Language of texts by a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import crc32_bucket

FOLDS, HELD_OUT = 4, 2  # Fixed values: rows whose crc32(doc_id) mod 4 is 2 are never learned from
SAMPLE = 600  # labelled documents of each language, about, that the network is trained on
WINDOWS = 6  # windows taken from each of them, at most
WIDTH = 96  # bytes of a window: the network reads it both ways, from a blank state
HIDDEN = 12  # units of each direction
STEPS, BATCH, RATE = 360, 128, 0.01  # updates, windows of each, first learning rate
UNKNOWN = "und"  # Fixed value: texts without a letter.
_SCORE_BATCH = 4096


@dataclass
class Network:
    """Parameters; per direction a table ``x`` of what each byte adds to the gates and a matrix ``u`` for the state."""

    languages: list[str]
    params: dict[str, np.ndarray]


def new_network(languages: list[str], seed: int = 1) -> Network:
    rng, h = np.random.default_rng(seed), HIDDEN
    params = {}
    for side in "fb":
        params["x" + side] = rng.normal(0, 0.3, (256, 3 * h))
        params["u" + side] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h))
        params["o" + side] = rng.normal(0, 0.3, (h, len(languages)))
    params["bias"] = np.zeros(len(languages))
    return Network(languages, {k: v.astype(np.float32) for k, v in params.items()})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _steps(width: int, side: str) -> range:
    return range(width) if side == "f" else range(width - 1, -1, -1)


def _run(windows: np.ndarray, mask: np.ndarray, p: dict[str, np.ndarray], side: str, keep: bool) -> tuple[np.ndarray, list]:
    """States of one direction, by position, and for training what each step used."""
    n, width = windows.shape
    h = HIDDEN
    states, trace = np.empty((width, n, h), dtype=np.float32), []
    state = np.zeros((n, h), dtype=np.float32)
    table, u = p["x" + side], p["u" + side]
    for t in _steps(width, side):
        x, r_in = table[windows[:, t]], state @ u
        gates = _sigmoid(x[:, : 2 * h] + r_in[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(x[:, 2 * h :] + r * r_in[:, 2 * h :])
        after = (new + z * (state - new)) * mask[:, t : t + 1]
        if keep:
            trace.append((t, state, z, r, new, r_in[:, 2 * h :]))
        states[t] = state = after
    return states, trace


def probabilities(windows: np.ndarray, lengths: np.ndarray, net: Network) -> np.ndarray:
    """Sum over the positions of each window of the label probabilities there."""
    mask = (np.arange(windows.shape[1])[None, :] < lengths[:, None]).astype(np.float32)
    p = net.params
    logits = sum(_run(windows, mask, p, s, False)[0] @ p["o" + s] for s in "fb") + p["bias"]
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return np.einsum("tnk,nt->nk", logits, mask)


def gradients(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, p: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions and its gradient, by backpropagation through time."""
    h, n = HIDDEN, len(windows)
    mask = (np.arange(windows.shape[1])[None, :] < lengths[:, None]).astype(np.float32)
    runs = {s: _run(windows, mask, p, s, True) for s in "fb"}
    logits = sum(runs[s][0] @ p["o" + s] for s in "fb") + p["bias"]
    logits -= logits.max(axis=-1, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(axis=-1, keepdims=True)
    weight = (mask / mask.sum()).T[:, :, None]
    loss = -float((np.log(prob[:, np.arange(n), labels] + 1e-12) * weight[:, :, 0]).sum())
    prob[:, np.arange(n), labels] -= 1
    d_logits = prob * weight
    grads = {"bias": d_logits.sum(axis=(0, 1))}
    for s in "fb":
        states, trace = runs[s]
        grads["o" + s] = np.einsum("tnh,tnk->hk", states, d_logits)
        d_out = d_logits @ p["o" + s].T
        d_table, d_u = np.zeros_like(p["x" + s]), np.zeros_like(p["u" + s])
        carry = np.zeros((n, h), dtype=np.float32)
        for t, state, z, r, new, r_new in reversed(trace):
            d_after = (carry + d_out[t]) * mask[:, t : t + 1]
            d_new = d_after * (1 - z) * (1 - new * new)
            d_z = d_after * (state - new) * z * (1 - z)
            d_r = d_new * r_new * r * (1 - r)
            d_x = np.concatenate((d_z, d_r, d_new), axis=1)
            d_in = np.concatenate((d_z, d_r, d_new * r), axis=1)
            np.add.at(d_table, windows[:, t], d_x)
            d_u += state.T @ d_in
            carry = d_after * z + d_in @ p["u" + s].T
        grads["x" + s], grads["u" + s] = d_table, d_u
    return loss, grads


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, net: Network, seed: int = 2) -> Network:
    """Adam over ``STEPS`` shuffled batches, the rate falling to a tenth; gradients are cut at norm 1."""
    rng, p = np.random.default_rng(seed), net.params
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    order = np.zeros(0, dtype=np.int64)
    for step in range(1, STEPS + 1):
        while len(order) < BATCH:
            order = np.concatenate((order, rng.permutation(len(windows))))
        rows, order = order[:BATCH], order[BATCH:]
        _, grads = gradients(windows[rows], lengths[rows], labels[rows], p)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * (1 - 0.9 * step / STEPS)
        for k, g in grads.items():
            g = g * min(1.0, 1 / (norm + 1e-12))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            update = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            p[k] = (p[k] - rate * update).astype(np.float32)
    return net


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network:
    """Train on windows of about ``sample`` documents of each language, outside the held-out fold.

    Only the windows come to the driver: at most ``WINDOWS`` times ``WIDTH`` bytes of each. The draw is by a hash
    of ``doc_id``, so reruns agree. Without labelled texts the network knows no language.
    """
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(crc32_bucket("doc_id", FOLDS) != HELD_OUT)
    have = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(have)
    if not languages:
        return Network([], {})
    rates = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample / have[k]))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / (1 << 20)
    chosen = labelled.filter(drawn < F.element_at(rates, F.col("lang"))).select("doc_id", "lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for doc, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                rng = np.random.default_rng(abs(doc or 0))
                for i in range(min(WINDOWS, len(data))):
                    # Every third window is short, as short texts come too.
                    size = int(rng.integers(6, WIDTH)) if i % 3 == 2 else WIDTH
                    start = int(rng.integers(0, max(1, len(data) - size + 1))) if i else 0
                    langs.append(lang)
                    parts.append(data[start : start + size])
                    if len(data) <= size and i:
                        break
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], names=["lang", "part"])

    rows = sorted((r["lang"], bytes(r["part"])) for r in chosen.mapInArrow(cut, "lang string, part binary").collect())
    rows = [r for r in rows if r[1]]
    if not rows:
        return Network([], {})
    lengths = np.array([len(p) for _, p in rows])
    windows = np.zeros((len(rows), WIDTH), dtype=np.uint8)
    for i, (_, part) in enumerate(rows):
        windows[i, : len(part)] = np.frombuffer(part, dtype=np.uint8)
    labels = np.array([languages.index(lang) for lang, _ in rows])
    return train(windows, lengths, labels, new_network(languages))


def label_texts(texts: list[str | None], net: Network) -> tuple[list[str], np.ndarray]:
    """Language and pooled probability of each text, over all its bytes."""
    known = [i for i, t in enumerate(texts) if t and net.languages and any(map(str.isalpha, t))]
    pooled = np.zeros((len(texts), max(1, len(net.languages))))
    owners, sizes, parts = [], [], []
    for i in known:
        data = np.frombuffer(texts[i].encode(), dtype=np.uint8)
        count = -(-len(data) // WIDTH)
        block = np.zeros(count * WIDTH, dtype=np.uint8)
        block[: len(data)] = data
        parts.append(block)
        owners.append(np.full(count, i))
        size = np.full(count, WIDTH)
        size[-1] = len(data) - (count - 1) * WIDTH
        sizes.append(size)
    if known:
        windows, owner, size = np.concatenate(parts).reshape(-1, WIDTH), np.concatenate(owners), np.concatenate(sizes)
        for begin in range(0, len(windows), _SCORE_BATCH):
            cut = slice(begin, begin + _SCORE_BATCH)
            np.add.at(pooled, owner[cut], probabilities(windows[cut], size[cut], net))
    total = pooled.sum(axis=1)
    best = pooled.argmax(axis=1)
    score = np.clip(np.divide(pooled.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0), 0, 1)
    found = set(known)
    return [net.languages[b] if i in found else UNKNOWN for i, b in enumerate(best.tolist())], score


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from ``text`` alone.

    Null texts and texts without a letter are ``und`` with score 0, as are all if no language is known; repeated
    rows give a row each; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                langs, score = label_texts(part.column(1).to_pylist(), net)
                columns = [part.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
