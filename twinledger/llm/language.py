"""Language of texts that may switch language, by a linear-chain conditional random field.

Words are labelled with languages.  A word's features are its affixes, its character trigrams and
the learned lexicons it stands in; transitions between languages are learned as well, from
sequences put together of labelled texts of several languages.  Marginals come from
forward-backward, computed for all words of a batch at once: chains are cut into blocks whose
transfer matrices are multiplied first, so that a long text takes few steps.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import small
from .common import limit_batches, stored

LETTERS = re.compile(r"[^\W\d_]+")
SLOTS = 1 << 16
BLOCK = 64
CACHE = 300_000
UNKNOWN = "und"
# Parts in which the sample of a label is picked first.
SAMPLE_PARTS = 256


def _features(word: str) -> list[int]:
    w = f"^{word}$"
    found = [f"p{word[:n]}" for n in (1, 2, 3)] + [f"s{word[-n:]}" for n in (1, 2, 3)]
    found += [f"g{w[i:i + 3]}" for i in range(len(w) - 2)] + [f"w{word}"]
    return [zlib.crc32(f.encode()) % SLOTS for f in found]


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicons: list[frozenset[str]]
    known: dict[str, int] = field(default_factory=dict)
    rows: list[np.ndarray] = field(default_factory=list)

    def __getstate__(self):
        return {**self.__dict__, "known": {}, "rows": []}

    def ids(self, word: str) -> list[int]:
        return _features(word) + [SLOTS + i for i, lexicon in enumerate(self.lexicons) if word in lexicon]

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores of the words; those of known words are kept for the worker's life."""
        if len(self.known) > CACHE:
            self.known, self.rows = {}, []
        at = np.empty(len(words), dtype=np.int64)
        known, rows = self.known, self.rows
        for i, w in enumerate(words):
            k = known.get(w)
            if k is None:
                k = known[w] = len(rows)
                rows.append(self.weights[self.ids(w)].sum(axis=0))
            at[i] = k
        used, back = np.unique(at, return_inverse=True)
        return np.array([rows[u] for u in used.tolist()], dtype=np.float64).reshape(len(used), len(self.labels))[back]


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.max(axis=tuple(range(1, x.ndim)), keepdims=True)


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of the labels of all words of several chains laid end to end, and the forward and
    backward messages (scaled), each of the shape of ``scores``."""
    size = scores.shape[1]
    step = np.exp(moves - moves.max())
    blocks = -(-lengths // BLOCK)
    first_word, first_block = np.cumsum(lengths) - lengths, np.cumsum(blocks) - blocks
    chain = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(scores)) - first_word[chain]
    block, place = first_block[chain] + within // BLOCK, within % BLOCK
    total = int(blocks.sum())
    emit = np.ones((total, BLOCK, size))
    emit[block, place] = np.exp(scores - scores.max(axis=1, keepdims=True))
    used = np.zeros((total, BLOCK), dtype=bool)
    used[block, place] = True

    transfer = np.broadcast_to(np.eye(size), (total, size, size)).copy()
    for t in range(BLOCK):
        on = used[:, t]
        transfer[on] = _scaled((transfer[on] @ step) * emit[on, t][:, None, :])
    ahead = np.ones((total, size))
    behind = np.ones((total, size))
    for b in range(1, int(blocks.max(initial=0))):
        on = np.flatnonzero(blocks > b)
        at = first_block[on] + b
        ahead[at] = _scaled(np.einsum("ni,nij->nj", ahead[at - 1], transfer[at - 1]))
        at = first_block[on] + blocks[on] - 1 - b
        behind[at] = _scaled(np.einsum("nij,nj->ni", transfer[at + 1], behind[at + 1]))
    forward, backward = np.ones((total, BLOCK, size)), np.ones((total, BLOCK, size))
    for t in range(BLOCK):
        on = used[:, t]
        ahead[on] = _scaled((ahead[on] @ step) * emit[on, t])
        forward[:, t] = ahead
    for t in range(BLOCK - 1, -1, -1):
        backward[:, t] = behind
        on = used[:, t]
        behind[on] = _scaled((behind[on] * emit[on, t]) @ step.T)
    f, b = forward[block, place], backward[block, place]
    out = f * b
    return out / out.sum(axis=1, keepdims=True), f, b


def train(samples: list[tuple[str, str]], sequences: int = 2400, epochs: int = 6, rate: float = 0.3, seed: int = 7) -> Model:
    """Fit the field on (text, label) pairs.  Chains of 64 words are put together from one to three texts,
    so that transitions see switches; weights by AdaGrad on the log-likelihood."""
    labels = sorted({label for _, label in samples})
    words: dict[str, list[list[str]]] = {label: [] for label in labels}
    for text, label in samples:
        found = LETTERS.findall(text.lower())
        if found:
            words[label].append(found)
    labels = [label for label in labels if words[label]]
    size = len(labels)
    lexicons = []
    for label in labels:
        seen, counts = np.unique([w for t in words[label] for w in t], return_counts=True)
        lexicons.append(frozenset(seen[counts >= 3].tolist()))
    model = Model(labels, np.zeros((SLOTS + size, size)), np.zeros((size, size)), lexicons)
    if size < 2:
        return model
    rng = np.random.default_rng(seed)
    chains = []
    for _ in range(sequences):
        tokens, tags = [], []
        parts = int(rng.integers(1, 4))
        while len(tokens) < BLOCK:
            label = int(rng.integers(size))
            text = words[labels[label]][int(rng.integers(len(words[labels[label]])))]
            at = int(rng.integers(max(1, len(text) - BLOCK // parts)))
            piece = text[at:at + BLOCK // parts + 1]
            tokens += piece
            tags += [label] * len(piece)
        chains.append((tokens[:BLOCK], tags[:BLOCK]))
    ids = {w: np.array(model.ids(w)) for w in {w for c, _ in chains for w in c}}
    tags = np.array([t for _, t in chains])
    past_w, past_m = np.full(model.weights.shape, 1e-6), np.full(model.moves.shape, 1e-6)
    batch = 200
    for _ in range(epochs):
        order = rng.permutation(len(chains))
        for low in range(0, len(chains), batch):
            pick = order[low:low + batch]
            parts = [ids[w] for c in pick for w in chains[c][0]]
            flat, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            scores = np.stack([np.bincount(owner, weights=model.weights[flat, i], minlength=len(parts)) for i in range(size)], axis=1)
            truth = tags[pick].reshape(-1)
            p, f, b = marginals(scores, np.full(len(pick), BLOCK), model.moves)
            wrong = p.copy()
            wrong[np.arange(len(truth)), truth] -= 1
            grad = np.stack([np.bincount(flat, weights=wrong[owner, i], minlength=len(model.weights)) for i in range(size)], axis=1) / len(pick)
            # Pairs of neighbouring labels: expected less seen.
            emit = np.exp(scores - scores.max(axis=1, keepdims=True)) * b
            joint = (f.reshape(-1, BLOCK, size)[:, :-1, :, None] * np.exp(model.moves)[None, None]
                     * emit.reshape(-1, BLOCK, size)[:, 1:, None, :])
            expected = (joint / joint.sum(axis=(2, 3), keepdims=True)).sum(axis=(0, 1))
            seen = np.zeros((size, size))
            np.add.at(seen, (tags[pick][:, :-1].reshape(-1), tags[pick][:, 1:].reshape(-1)), 1)
            step = (expected - seen) / len(pick) + 1e-3 * model.moves
            grad += 1e-5 * model.weights
            past_w += grad ** 2
            past_m += step ** 2
            model.weights -= rate * grad / np.sqrt(past_w)
            model.moves -= rate * step / np.sqrt(past_m)
    model.weights = model.weights.astype(np.float32)
    return model


def labelled_sample(docs: DataFrame, text: str, label: str, key: str, per_label: int, chars: int) -> list[tuple[str, str]]:
    """At most ``per_label`` learnable rows of each label, picked by a hash of the id (then of the text), of each text
    ``chars`` characters: the bound of what the fit sees."""
    order = [F.xxhash64(F.lit(11), F.col(key)).alias("_o"), F.xxhash64(text).alias("_t")]
    learnable = docs.filter(F.col(text).isNotNull() & F.col(label).isNotNull() & ~_held_out(F.col(key)))
    learnable = learnable.select(F.col(label).alias("label"), *order, F.substring(F.col(text), 1, chars).alias("text"))

    def first(rows: DataFrame, *group) -> DataFrame:
        by = Window.partitionBy("label", *group).orderBy("_o", "_t")
        return rows.withColumn("_r", F.row_number().over(by)).filter(F.col("_r") <= per_label).drop("_r")
    # The last hashes picked are found without the texts, in parts of a label first.
    narrow = learnable.select("label", "_o", "_t").withColumn("_part", F.pmod(F.xxhash64("_o", "_t"), F.lit(SAMPLE_PARTS)))
    last = first(first(narrow, "_part").drop("_part")).groupBy("label").agg(F.max(F.struct("_o", "_t")).alias("_last"))
    last = small(stored(last, "sample-bounds"))
    picked = first(learnable.join(last, "label").filter(F.struct("_o", "_t") <= F.col("_last")).drop("_last"))
    return [(r["text"], r["label"]) for r in picked.orderBy("label", "_o", "_t").collect()]


def _held_out(key):
    """Rows that are never learned from: a fifth by the checksum of the id, and rows without an id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", per_label: int = 400,
             chars: int = 3000, carry: bool = False) -> DataFrame:
    """``key, held_out, lang_pred, score, shares`` per input row (with ``carry`` the row itself in ``row``).

    The field is fitted on a bounded sample (``per_label`` texts of each label, ``chars`` characters) of
    rows that have a text, a label and an id whose CRC-32 (as text) is no multiple of 5; only texts are
    inputs of a prediction, and whole ones.  ``lang_pred`` is the label with the largest sum of
    marginals over the words, ``score`` its share, ``shares`` all of them.  Null texts and texts without a letter,
    and all texts if nothing was labelled, are ``und`` with score 0.
    """
    limit_batches(docs.sparkSession)
    model = train(labelled_sample(docs, text, label, key, per_label, chars))
    front = [F.struct("*").alias("row")] if carry else []
    rows = docs.select(*front, F.col(key).alias(key), _held_out(F.col(key)).alias("held_out"), F.col(text).alias("_text"))
    names = [c for c in rows.columns if c != "_text"]
    shares = pa.map_(pa.string(), pa.float64())

    def predict(texts: list[str | None]):
        labels, size = model.labels, len(model.labels)
        words = [LETTERS.findall(t.lower()) if t and size else [] for t in texts]
        lengths = np.array([len(w) for w in words])
        out = [(UNKNOWN, 0.0, [])] * len(texts)
        busy = np.flatnonzero(lengths)
        if len(busy):
            p = marginals(model.scores([w for i in busy for w in words[i]]), lengths[busy], model.moves)[0]
            sums = np.add.reduceat(p, np.cumsum(lengths[busy]) - lengths[busy], axis=0) / lengths[busy][:, None]
            for i, s in zip(busy.tolist(), sums):
                best = int(s.argmax())
                out[i] = (labels[best], float(min(1.0, s[best])), list(zip(labels, s.tolist())))
        return out

    def scan(batches):
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            done, low = [], 0
            while low < len(texts):  # some texts at a time, about a million characters
                high, chars_in = low, 0
                while high < len(texts) and (high == low or chars_in < 1 << 20):
                    chars_in += len(texts[high] or "")
                    high += 1
                done += predict(texts[low:high])
                low = high
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.float64()),
                 pa.array([d[2] for d in done], shares)], names=[*names, "lang_pred", "score", "shares"])
    schema = T.StructType([*(rows.schema[c] for c in names), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("shares", T.MapType(T.StringType(), T.DoubleType()))])
    return rows.mapInArrow(scan, schema)


def keep_identified(docs: DataFrame, least: float = 0.5, **settings) -> DataFrame:
    """The rows of ``docs`` with a language: not ``und``, and at least ``least`` of the words' marginals in one."""
    return identify(docs, carry=True, **settings).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
