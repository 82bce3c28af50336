"""Quality rules: compression bands.

A text is compressed whole and in fixed chunks with zstandard, of which the last is whatever
is left. A ratio (bytes before to bytes after) above the band of its length marks
repetition, one below it noise that does not compress, such as keys or encoded
binaries. The limits depend on the length, because short texts hardly compress. A text
is rejected by itself, or where more than ``CHUNK_SHARE`` of its bytes lie in chunks
outside their bands. Counts of words, symbols, repeated lines and
repeated five-word windows come with it; the base rule on them comes first.

Defined results: a null text has no word and fails the base rule; so does an empty one.
Repeated rows are judged each for themselves. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read

# (lengths in bytes below this, lowest ratio, highest ratio); the last row holds for all longer texts.
WHOLE_BANDS = (
    (64, 0.45, 2.5),
    (128, 0.70, 2.8),
    (256, 0.90, 3.0),
    (512, 1.10, 3.2),
    (1024, 1.25, 3.6),
    (4096, 1.35, 4.2),
    (16384, 1.40, 5.0),
    (float("inf"), 1.42, 6.0),
)
CHUNK_BYTES = 4096
CHUNK_SHARE = 0.25  # more than this share of a text's bytes in chunks outside their bands rejects
LEVEL = 3

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SLICE_BYTES = 4 << 20  # texts handled together in a task, so that memory doesn't follow the batch

METRICS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
    ("kept", pa.bool_()), ("ratio", pa.float64()), ("bad_chunks", pa.int64()), ("n_chunks", pa.int64()),
]
METRICS_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, ratio double, bad_chunks long, n_chunks long"
)


def repeated_words(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words of each text in five-word windows that occur twice or more in that text.

    ``ids``: the word numbers of the texts, one after another; ``lengths``: words a text.
    A hash finds the windows that may repeat; those are then compared exactly.
    """
    n_docs = len(lengths)
    covered = np.zeros(n_docs, np.int64)
    n = len(ids)
    if n < WINDOW:
        return covered
    doc = np.repeat(np.arange(n_docs), lengths)
    ends = np.cumsum(lengths)
    starts = np.arange(n - WINDOW + 1)
    starts = starts[starts + WINDOW <= ends[doc[: n - WINDOW + 1]]]
    if not len(starts):
        return covered
    mix = np.uint64(0x9E3779B97F4A7C15)
    w = ids.astype(np.uint64)
    h = doc[starts].astype(np.uint64)
    for k in range(WINDOW):
        h = (h ^ w[starts + k]) * mix
        h ^= h >> np.uint64(29)
    s = np.sort(h)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return covered
    at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    starts = starts[twice[at] == h]
    keys = [ids[starts + k] for k in range(WINDOW)] + [doc[starts]]
    order = np.lexsort(keys)
    same = np.ones(len(order) - 1, bool)
    for key in keys:
        same &= key[order][1:] == key[order][:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    hit = starts[order[again]]
    mark = np.zeros(n, bool)
    for k in range(WINDOW):
        mark[hit + k] = True
    np.add.at(covered, doc[mark], 1)
    return covered


def band(size: int) -> tuple[float, float]:
    """The lowest and highest ratio for a length in bytes."""
    return next((low, high) for below, low, high in WHOLE_BANDS if size < below)


def judge(texts: list[str | None], compressor) -> dict[str, list]:
    """The metrics of some texts."""
    out: dict[str, list] = {name: [] for name, _ in METRICS}
    numbers: dict[bytes, int] = {}
    ids, lengths = [], []
    for text in texts:
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.split()
        lengths.append(len(words))
        ids.extend([numbers.setdefault(w, len(numbers)) for w in words])
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text) - sum(map(text.count, " \t\n\v\f\r")))
        out["n_symbols"].append(sum(map(text.count, "#*$%&|<>")))
        lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        size = len(raw)
        low, high = band(size)
        ratio = size / len(compressor.compress(raw)) if size else 0.0
        whole = low <= ratio <= high
        bad = outside = 0
        chunks = [raw[i : i + CHUNK_BYTES] for i in range(0, size, CHUNK_BYTES)] if size > CHUNK_BYTES else []
        for chunk in chunks:
            least, most = band(min(len(chunk), CHUNK_BYTES - 1))
            if not least <= len(chunk) / len(compressor.compress(chunk)) <= most:
                bad += 1
                outside += len(chunk)
        out["ratio"].append(ratio)
        out["n_chunks"].append(len(chunks))
        out["bad_chunks"].append(bad)
        out["kept"].append(whole and outside <= CHUNK_SHARE * size)
    repeats = repeated_words(np.array(ids, np.int64), np.array(lengths, np.int64))
    out["n_repeat_words"] = repeats.tolist()
    out["base_failed"] = [
        n < MIN_WORDS or 100 * r > REPEAT_PERCENT * n for n, r in zip(out["n_words"], out["n_repeat_words"])
    ]
    out["kept"] = [k and not f for k, f in zip(out["kept"], out["base_failed"])]
    return out


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Cuts a batch into ranges of about ``SLICE_BYTES``, one text at least."""
    begin, held = 0, 0
    sizes = pa.compute.binary_length(texts).fill_null(0).to_pylist()
    for i, size in enumerate(sizes):
        if held and held + size > SLICE_BYTES:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def score(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of every row and its metrics. No shuffle; a row at a time leaves no trace."""
    plain = docs.select(*carry, text)
    names = [n for n, _ in METRICS]

    def run(batches):
        import pyarrow.compute  # noqa: F401
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for lo, hi in slices(batch.column(len(carry))):
                part = batch.slice(lo, hi - lo)
                found = judge(part.column(len(carry)).to_pylist(), compressor)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(carry))] + [pa.array(found[n], t) for n, t in METRICS],
                    names=[*carry, *names],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != text or f.name in carry)
    return plain.mapInArrow(run, f"{fields}, {METRICS_DDL}")


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; no other column is added."""
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow.compute  # noqa: F401
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for lo, hi in slices(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(judge(part.column(at).to_pylist(), compressor)["kept"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"))
