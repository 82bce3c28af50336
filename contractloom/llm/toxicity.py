"""Toxicity: a linear-chain conditional random field over words.

Token labels come from labelled documents: a word of a toxic document is toxic if its
form or one of its beginnings occurs in toxic documents far more often than chance
allows over all forms looked at. On these tokens the field learns weights of hashed
features (form, beginnings, signs attached) and of transitions between clean and toxic.
Marginals by forward-backward over whole texts give offending spans and, by two
calibrated figures (the surest token and the expected number of toxic tokens), the
score of a document.

Fitting takes place on the driver on a bounded sample of labelled rows (``MAX_TOXIC`` and
``MAX_CLEAN`` documents, chosen by a hash of the id); scoring runs in tasks over all rows,
without a shuffle, and no text is cut.

Defined results: a null or empty text has no token and the score that a document
without any toxic token has. Labels that are null, of unknown documents or of the held-out
third are not learned from; of several labels of one document the highest counts. Without
labels of both kinds every score is the share of toxic labels, 0 without any. Repeated
rows get the same score.
"""

from __future__ import annotations

from array import array
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, read

MAX_TOXIC, MAX_CLEAN = 600, 900
WINDOW = 64  # tokens to a training sequence
FEATURES = 1 << 20
STEPS = 60
RATE = 0.3
RIDGE = 1e-5
CUT = 0.7
SPAN_CUT = 0.5
BLOCK = 32
SLICE_BYTES = 2 << 20
CACHE = 400_000


class Model(NamedTuple):
    weights: np.ndarray  # of the features, for toxic against clean
    bias: float
    start: float  # log odds of toxic at the first token
    moves: np.ndarray  # 2 x 2: log potential from a label to the next
    score: tuple[float, float, float]  # of 1, of the surest token's log odds, of log(1 + expected toxic tokens)
    prior: float | None = None  # the score of all documents, where nothing could be learned


def forms(word: bytes) -> list[str]:
    """The form of a word and its beginnings, by which labels are carried to tokens."""
    core = word.decode("utf-8", "replace").lower().strip("\"'.,;:!?()[]{}<>#*$%&|-_=+/\\~`")
    return ["w" + core] + [f"p{core[:k]}" for k in (4, 5, 6) if len(core) > k]


def features(word: bytes) -> list[int]:
    import zlib

    text = word.decode("utf-8", "replace")
    core = forms(word)
    more = [f"x{text[-1:] if not text[-1:].isalnum() else ''}"]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % FEATURES for f in core + more]


def chain_products(m: np.ndarray) -> np.ndarray:
    """Running products of 2 x 2 matrices, each scaled to a largest entry of 1.

    Runs are split into blocks; all blocks advance in step, and the products of whole
    blocks are run through the same way, so there is no loop over tokens.
    """
    n = len(m)
    if n <= BLOCK:
        out = m.copy()
        for i in range(1, n):
            out[i] = out[i - 1] @ m[i]
            out[i] /= out[i].max()
        return out
    blocks = -(-n // BLOCK)
    padded = np.broadcast_to(np.eye(2), (blocks * BLOCK, 2, 2)).copy()
    padded[:n] = m
    runs = padded.reshape(blocks, BLOCK, 4).transpose(1, 2, 0).copy()  # place, entry, block
    for i in range(1, BLOCK):
        a, b = runs[i - 1], runs[i]
        c = np.stack([a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]])
        runs[i] = c / c.max(0)
    whole = chain_products(runs[-1].T.reshape(blocks, 2, 2))
    before = np.concatenate([np.eye(2)[None], whole[:-1]]).reshape(blocks, 4).T
    a0, a1, a2, a3 = before
    b0, b1, b2, b3 = runs[:, 0], runs[:, 1], runs[:, 2], runs[:, 3]
    c = np.stack([a0 * b0 + a1 * b2, a0 * b1 + a1 * b3, a2 * b0 + a3 * b2, a2 * b1 + a3 * b3])
    c /= c.max(0)
    return c.transpose(2, 1, 0).reshape(blocks * BLOCK, 2, 2)[:n]


def marginals(emission: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """The probability of toxic for each token of texts that follow one another."""
    n = len(emission)
    if not n:
        return np.zeros(0)
    odds = np.clip(emission, -30, 30)
    toxic = 1 / (1 + np.exp(-odds))
    e = np.stack([1 - toxic, toxic], 1)
    begin = np.zeros(n, bool)
    begin[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    start = np.array([1.0, np.exp(model.start)])
    moves = np.exp(model.moves)
    step = moves[None] * e[:, None, :]  # from the label before to this one
    step[begin] = (start * e[begin])[:, None, :]  # a text begins whatever came before
    step /= step.max((1, 2), keepdims=True)
    alpha = chain_products(step)[:, 0, :]
    # Backward: the messages run from the end, through the step of the next token.
    nxt = np.empty_like(step)
    nxt[:-1] = moves[None] * e[1:, None, :]
    last = np.concatenate([begin[1:], [True]])
    nxt[last] = 1.0  # nothing follows
    nxt /= nxt.max((1, 2), keepdims=True)
    beta = chain_products(nxt[::-1].transpose(0, 2, 1))[:, 0, :][::-1] if n else nxt
    both = alpha * beta
    return both[:, 1] / both.sum(1)


def fit(texts: list[str], labels: list[int], steps: int = STEPS) -> Model:
    """The field and the calibration from labelled documents."""
    y_doc = np.array(labels, np.int64)
    nothing = Model(np.zeros(FEATURES), 0.0, 0.0, np.zeros((2, 2)), (0.0, 0.0, 0.0), float(y_doc.mean()) if len(y_doc) else 0.0)
    if len(set(labels)) < 2:
        return nothing
    number: dict[bytes, int] = {}
    tokens = [np.array([number.setdefault(w, len(number)) for w in (t or "").encode("utf-8", "surrogatepass").split()], np.int64) for t in texts]
    words = list(number)
    if not words:
        return nothing
    # Forms by the documents they occur in.
    form_no: dict[str, int] = {}
    of_word, ends = array("i"), array("i", [0])  # the forms of all words, one after another
    for w in words:
        of_word.extend([form_no.setdefault(f, len(form_no)) for f in forms(w)])
        ends.append(len(of_word))
    of_word, ends = np.array(of_word), np.array(ends)
    counts = np.zeros((2, len(form_no)))
    for ids, y in zip(tokens, y_doc):
        if len(ids):
            counts[y, np.unique(np.concatenate([of_word[ends[i] : ends[i + 1]] for i in np.unique(ids)]))] += 1
    a, b = counts[1], counts[0]
    big_a, big_b = y_doc.sum(), (1 - y_doc).sum()
    share = (a + b) / (big_a + big_b)
    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * (np.where(a > 0, a * np.log(a / (big_a * share)), 0) + np.where(b > 0, b * np.log(b / (big_b * share)), 0))
    odds = np.log((a + 0.5) / (big_a + 1)) - np.log((b + 0.5) / (big_b + 1))
    marked = (g2 >= 2 * np.log(len(g2)) + 2) & (odds >= 2.5)
    toxic_word = np.logical_or.reduceat(marked[of_word], ends[:-1])
    del form_no
    # Sequences of WINDOW tokens, the rest of a document padded.
    seqs, gold = [], []
    for ids, y in zip(tokens, y_doc):
        for i in range(0, len(ids), WINDOW):
            part = ids[i : i + WINDOW]
            seqs.append(np.concatenate([part, np.full(WINDOW - len(part), -1)]))
            gold.append(np.concatenate([toxic_word[part] * y, np.zeros(WINDOW - len(part), np.int64)]))
    x, z = np.array(seqs, np.int32), np.array(gold, np.float32)
    del seqs, gold
    there = x >= 0
    flat = np.where(there, x, 0)
    feat, width = array("i"), array("i")
    for w in words:
        found = features(w)
        feat.extend(found)
        width.append(len(found))
    feat, word_of = np.array(feat), np.repeat(np.arange(len(words)), np.array(width))
    weights, bias, moves, start = np.zeros(FEATURES), -3.0, np.zeros((2, 2)), -2.0
    squares = [np.full(FEATURES, 1e-8), 1e-8, np.full((2, 2), 1e-8), 1e-8]
    total = there.sum()
    zz = z.astype(int)
    pairs = there[:, 1:]
    seen = np.array([[((zz[:, :-1] == i) & (zz[:, 1:] == j) & pairs).sum() for j in (0, 1)] for i in (0, 1)])
    for _ in range(steps):
        score = (np.bincount(word_of, weights[feat], len(words)) + bias).astype(np.float32)
        ex = np.exp(np.where(there, np.clip(score[flat], -30, 30), np.float32(0)))
        m, s = np.exp(moves), np.exp(start)
        alpha = np.empty((WINDOW, 2, len(x)), np.float32)
        alpha[0] = np.stack([np.ones(len(x)), s * ex[:, 0]])
        alpha[0] /= alpha[0].sum(0)
        for t in range(1, WINDOW):
            a0, a1 = alpha[t - 1]
            alpha[t] = (a0 * m[0, 0] + a1 * m[1, 0]), (a0 * m[0, 1] + a1 * m[1, 1]) * ex[:, t]
            alpha[t] = np.where(there[:, t], alpha[t], alpha[t - 1])
            alpha[t] /= alpha[t].sum(0)
        beta = np.ones((WINDOW, 2, len(x)), np.float32)
        expected = np.zeros((2, 2))
        for t in range(WINDOW - 2, -1, -1):
            b0, b1 = beta[t + 1][0], beta[t + 1][1] * ex[:, t + 1]
            new = np.stack([m[0, 0] * b0 + m[0, 1] * b1, m[1, 0] * b0 + m[1, 1] * b1])
            joint = np.stack([alpha[t][i] * m[i, j] * (b1 if j else b0) for i in (0, 1) for j in (0, 1)])
            joint = np.where(there[:, t + 1], joint / joint.sum(0), 0.0)
            expected += joint.sum(1).reshape(2, 2)
            beta[t] = np.where(there[:, t + 1], new / new.sum(0), beta[t + 1])
        p = alpha[:, 1] * beta[:, 1] / (alpha * beta).sum(1)
        diff = np.where(there, p.T - z, 0.0)
        g_word = np.bincount(flat[there], diff[there], len(words))
        g = [
            np.bincount(feat, g_word[word_of], FEATURES) / total * 1e3 + RIDGE * weights * 1e3,
            diff.sum() / total * 1e3, (expected - seen) / total * 1e3, diff[:, 0].sum() / total * 1e3,
        ]
        for k, d in enumerate(g):
            squares[k] = squares[k] + d * d
        weights = weights - RATE * g[0] / np.sqrt(squares[0])
        bias -= RATE * g[1] / np.sqrt(squares[1])
        moves = moves - RATE * g[2] / np.sqrt(squares[2])
        start -= RATE * g[3] / np.sqrt(squares[3])
    model = Model(weights.astype(np.float32), float(bias), float(start), moves, (0.0, 0.0, 0.0))
    em = np.bincount(word_of, weights[feat], len(words)) + bias
    surest, number_of = figures([em[ids] for ids in tokens], model)[:2]
    xs = np.stack([np.ones(len(y_doc)), surest, number_of], 1)
    return model._replace(score=tuple(_logistic(xs, y_doc.astype(float)).tolist()))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; both classes weigh the same, so that a score of 0.5 is even between them."""
    w = np.zeros(x.shape[1])
    c = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (c * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (c * (y - p)) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def figures(emissions: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For each text the surest token's log odds, log(1 + expected toxic tokens), and all marginals."""
    lengths = np.array([len(e) for e in emissions], np.int64)
    p = np.clip(marginals(np.concatenate(emissions) if len(emissions) else np.zeros(0), lengths, model), 1e-9, 1 - 1e-9)
    cuts = np.cumsum(lengths) - lengths
    each = [p[a : a + n] for a, n in zip(cuts, lengths)]
    surest = np.array([np.log(q.max() / (1 - q.max())) if len(q) else -20.0 for q in each])
    count = np.array([np.log1p(q[q >= SPAN_CUT].sum()) for q in each])
    return np.maximum(surest, -20.0), count, each


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: tuple[int, int], learn: Column | None) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``most`` (toxic, clean) documents."""
    known = labels.select(column(labels, key).alias("id"), column(labels, label).alias("y")).filter("id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    if learn is not None:
        known = known.filter(learn)
    order = F.md5(F.col("id").cast("string"))
    pick = lambda y, n: known.filter(F.col("y") == y).orderBy(order, "id").limit(n)
    chosen = pick(1, most[0]).union(pick(0, most[1]))
    texts = docs.select(column(docs, key).alias("id"), column(docs, text).alias("text")).filter("text IS NOT NULL")
    found = texts.join(F.broadcast(chosen), "id").dropDuplicates(["id"]).orderBy("id").collect()  # as many as ``most`` says
    return [r["text"] for r in found], [int(r["y"]) for r in found]


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, n_toxic, spans`` for every row; spans in code points of the text."""

    def run(batches):
        import re

        import pyarrow.compute as pc

        known: dict[bytes, float] = {}
        parts = re.compile(r"[^\x20\x09-\x0D]+")
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            begin, held = 0, 0
            for i, size in enumerate([*sizes, None]):
                if size is not None and not (held and held + size > SLICE_BYTES):
                    held += size
                    continue
                if i > begin:
                    yield one(batch.slice(begin, i - begin), known, parts)
                begin, held = i, size or 0

    def one(part, known, parts):
        texts = [t or "" for t in part.column(1).to_pylist()]
        words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        if len(known) > CACHE:
            known.clear()
        for w in {w for ws in words for w in ws}.difference(known):
            known[w] = float(model.weights[features(w)].sum() + model.bias)
        flat = np.fromiter((known[w] for ws in words for w in ws), float, sum(map(len, words)))
        cuts = np.cumsum([len(w) for w in words])
        surest, count, each = figures(np.split(flat, cuts[:-1]) if len(words) else [], model)
        a, b, c = model.score
        scores = 1 / (1 + np.exp(-np.clip(a + b * surest + c * count, -40, 40)))
        if model.prior is not None:
            scores = np.full(len(texts), model.prior)
        spans = []
        for t, p in zip(texts, each):
            hits = np.flatnonzero(p >= SPAN_CUT)
            if len(hits) and model.prior is None:
                at = [m.span() for m in parts.finditer(t)]
                spans.append([{"start": at[i][0], "end": at[i][1]} for i in hits])
            else:
                spans.append([])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(scores, pa.float64()), pa.array([len(s) for s in spans], pa.int32()), pa.array(spans, kind)],
            names=["key", "score", "n_toxic", "spans"],
        )

    plain = docs.select(column(docs, key).alias("key"), column(docs, text).alias("text"))
    return plain.mapInArrow(run, f"key {plain.schema[0].dataType.simpleString()}, score double, n_toxic int, spans array<struct<start:int,end:int>>")


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def op8_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = fit(*sample(docs, labels, "doc_id", "text", "toxic", (MAX_TOXIC, MAX_CLEAN), ~held_out(F.col("id"))))
    return score(docs, model).select(
        F.col("key").alias("doc_id"), F.coalesce(held_out(F.col("key")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"), "n_toxic",
    )
