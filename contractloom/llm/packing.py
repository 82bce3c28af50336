"""Packing: vector bin packing by the dot-product heuristic.

Examples become pieces that share sequences under three limits at once: tokens,
segments and loss-bearing tokens. Pieces of whole sequences are cut first. What remains
of the examples waits in a window; for the open sequence, the remainder with the
largest dot product of its (scaled) demand and the room left goes in next, until none
fits; then one is cut to fill the rest. The last open sequence of a task is cut into
sequences of a power-of-two length, which need no padding.

Tasks pack the rows of their own input split, so nothing is shuffled, and a task that
runs again makes the same sequences. ``sequence_id`` is the task's number times 2^33
plus a count.

Defined results: a null or empty text has the end token alone. Repeated rows are packed
each. Null keys stay null. An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read

MAX_TOKENS = 4096
MAX_SEGMENTS = 128
WINDOW = 256  # remainders that wait together in a task
END_ID = 2
CACHE = 400_000  # words whose ids a task holds; it starts anew beyond

PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space, word by word.

    Such a tokenizer never looks across white space, so the ids of a text are those of
    its words in order; each distinct word of some texts is looked up once. A word of Latin
    letters with signs behind it is one piece of letters and one of signs to the tokenizer, so
    the letters, in small ones, are encoded once for all such words by its model alone.
    Words are cut into the two as Arrow columns; only letters not met before are a step of Python.
    """

    SIGNS = ".,;:!?|#$%&*-"
    # Latin letters whose small ones are among them; those of some capitals are not.
    LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and max(c.lower()) < "\u0250" and len(c.lower()) == 1)

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}  # signs, and words that are not Latin letters with signs behind them
        self.letters: dict[str, bytes] = {}
        self.as_bytes = {}
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        for c in map(chr, range(0x80, 0x250)):
            self.as_bytes[ord(c)] = alphabet.pre_tokenize_str(c)[0][0]

    def _whole(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _of_letters(self, cores: list[str]) -> list[bytes]:
        """The ids of words of small Latin letters."""
        found = list(map(self.letters.get, cores))
        if None in found:
            if len(self.letters) > CACHE:
                self.letters = {}
            letters, tokenize = self.letters, self.tokenizer.model.tokenize
            for i, ids in enumerate(found):
                if ids is None:
                    core = cores[i]
                    mapped = core if core.isascii() else core.translate(self.as_bytes)
                    found[i] = letters[core] = array("I", [t.id for t in tokenize(mapped)]).tobytes()
        return found

    def _of_words(self, words: list[str]) -> list[bytes]:
        """The ids of any words."""
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > CACHE:
                self.known = {}
            new = [w for w, ids in zip(words, found) if ids is None]
            ids = dict(zip(new, self._whole(new)))
            self.known.update(ids)
            found = [ids[w] if x is None else x for w, x in zip(words, found)]
        return found

    def _by_word(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts in order, the number of ids of each word, and where each text's words begin."""
        import pyarrow.compute as pc

        plain = pc.replace_substring(pc.fill_null(pa.array(texts, pa.large_string()), ""), "\n", " ")
        split = pc.split_pattern(plain, " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        core, tail = pc.ascii_rtrim(words, self.SIGNS), pc.utf8_ltrim(words, self.LETTERS)
        # Nothing but letters and signs: the two ends are the whole word.
        simple = pc.and_(
            pc.equal(pc.add(pc.binary_length(core), pc.binary_length(tail)), pc.binary_length(words)), pc.greater(pc.binary_length(core), 0)
        )
        cores, tails = pc.utf8_lower(core.filter(simple)).dictionary_encode(), tail.filter(simple).dictionary_encode()
        pieces = [b"", *self._of_letters(cores.dictionary.to_numpy(zero_copy_only=False).tolist())]
        first_tail = len(pieces)
        pieces += self._of_words(tails.dictionary.to_pylist())
        first_other = len(pieces)
        pieces += self._of_words(words.filter(pc.invert(simple)).to_pylist())
        # A word is two pieces: its letters and its signs, or the whole of it and nothing.
        simple = simple.to_numpy(zero_copy_only=False)
        of = np.zeros((len(words), 2), np.int64)
        of[simple, 0] = 1 + cores.indices.to_numpy()
        of[simple, 1] = first_tail + tails.indices.to_numpy()
        of[~simple, 0] = np.arange(first_other, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        begins = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(pieces), np.uint32)
        placed = of[coded.indices.to_numpy()].ravel()
        n = sizes[placed]
        ids = flat[np.repeat(begins[placed] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return ids, n[0::2] + n[1::2], split.offsets.to_numpy()

    def sizes(self, text: str) -> list[int]:
        """The number of ids of each word of a text."""
        return self._by_word([text])[1].tolist()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, n, begins = self._by_word(texts)
        ends = np.concatenate([[0], np.cumsum(n)])[begins]
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


class Packer:
    """Packs the examples of one task; gives pieces as it goes."""

    def __init__(self, first: int, limits=(MAX_TOKENS, MAX_SEGMENTS, MAX_TOKENS), window: int = WINDOW):
        self.limits = np.array(limits, float)
        self.window = window
        self.next = first
        self.key: list = []  # of each waiting remainder: (key, start, ids, loss, tokens of its example)
        self.need = np.zeros((0, 3))

    def add(self, examples: list[tuple]) -> Iterator[tuple]:
        """``examples``: (key, ids, loss mask or None); pieces of full sequences come out."""
        tokens, _, most_loss = (int(x) for x in self.limits)
        rows, need = [], []
        for key, ids, loss in examples:
            start, n = 0, len(ids)
            while n - start >= tokens:
                end = start + tokens if loss is None else self._reach(loss, start, tokens, most_loss)
                if end < start + tokens and end < n:  # the loss limit is met first
                    yield self._piece(key, start, ids, loss, n, start, end, self.next, 0)
                    self.next += 1
                    start = end
                    continue
                yield self._piece(key, start, ids, loss, n, start, end, self.next, 0)
                self.next += 1
                start = end
            if start < n:
                while loss is not None and loss[start:].sum() > most_loss:
                    end = self._reach(loss, start, tokens, most_loss)
                    yield self._piece(key, start, ids, loss, n, start, end, self.next, 0)
                    self.next += 1
                    start = end
                rows.append((key, start, ids, loss, n))
                need.append((n - start, 1, n - start if loss is None else int(loss[start:].sum())))
        self.key += rows
        self.need = np.concatenate([self.need, np.array(need, float).reshape(-1, 3)])
        while len(self.key) > self.window:
            yield from self._fill()

    def finish(self) -> Iterator[tuple]:
        while len(self.key):
            yield from self._fill(last=True)

    @staticmethod
    def _reach(loss, start: int, tokens: int, most: int) -> int:
        """The furthest end from ``start`` under the limits on tokens and loss."""
        part = np.cumsum(loss[start : start + tokens])
        return start + max(1, int(np.searchsorted(part, most, "right")))

    @staticmethod
    def _piece(key, at, ids, loss, n, start, end, sequence, offset):
        cut = np.ascontiguousarray(ids[start:end], "<u4")
        bearing = end - start if loss is None else int(loss[start:end].sum())
        return key, start, end - start, zlib.crc32(cut), n, sequence, offset, bearing

    def _fill(self, last: bool = False) -> Iterator[tuple]:
        """One sequence from the waiting remainders."""
        room, placed = self.limits.copy(), []
        scale = 1 / self.limits
        alive = np.ones(len(self.key), bool)
        demand = self.need * scale
        while alive.any() and (room > 0).all():
            fits = alive & (self.need <= room).all(1)
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, demand @ (room * scale), -1.0)))
            placed.append((best, None))
            room -= self.need[best]
            alive[best] = False
        if alive.any() and (room >= 1).all():  # cut one to fill the rest
            best = int(np.argmax(np.where(alive, demand @ (room * scale), -1.0)))
            key, start, ids, loss, n = self.key[best]
            end = min(n, start + int(room[0]))
            if loss is not None:
                end = min(end, self._reach(loss, start, int(room[0]), int(room[2])))
            if end > start and (loss is None or loss[start:end].sum() <= room[2]):
                placed.append((best, end))
        total = sum((end or self.key[i][4]) - self.key[i][1] for i, end in placed)
        spans = [total] if not last or len(self.key) > len(placed) or total == self.limits[0] else _powers(total)
        yield from self._emit(placed, spans)
        gone = np.ones(len(self.key), bool)
        for i, end in placed:
            if end is None or end == self.key[i][4]:
                gone[i] = False
            else:
                key, _, ids, loss, n = self.key[i]
                self.key[i] = (key, end, ids, loss, n)
                self.need[i] = (n - end, 1, n - end if loss is None else int(loss[end:].sum()))
        self.key = [k for k, g in zip(self.key, gone) if g]
        self.need = self.need[gone]

    def _emit(self, placed, spans) -> Iterator[tuple]:
        """The placed remainders one after another over sequences of the lengths ``spans``."""
        spans = list(spans)
        offset = 0
        for i, until in placed:
            key, start, ids, loss, n = self.key[i]
            end = n if until is None else until
            while start < end:
                cut = min(end, start + spans[0] - offset)
                yield self._piece(key, start, ids, loss, n, start, cut, self.next, offset)
                offset += cut - start
                start = cut
                if offset == spans[0]:
                    spans.pop(0)
                    self.next += 1
                    offset = 0


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", loss_spans: str | None = None,
         limits=(MAX_TOKENS, MAX_SEGMENTS, MAX_TOKENS), end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Pieces of the texts of ``docs``. Every id bears loss.

    ``tokenizer`` is the path of a vocabulary file on every executor. ``loss_spans`` may
    name a column ``array<struct<start:long, end:long>>`` of code points that bear loss;
    ids of the words that begin in one count, and the end id does.
    """
    columns = [key, text] + ([loss_spans] if loss_spans else [])

    def run(batches):
        from pyspark import TaskContext

        encoder = WordEncoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 33, limits, window)
        end = np.array([end_id], np.uint32)

        def out(pieces):
            rows = list(pieces)
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], kind)] + [pa.array(c, pa.int64()) for c in cols[1:]],
                    names=[key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"],
                )

        kind = pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                texts = part.column(1).to_pylist()
                ids = [np.concatenate([x, end]) for x in encoder.encode(texts)]
                masks = [None] * len(ids)
                if loss_spans:
                    masks = [loss_mask(encoder, t or "", s or []) for t, s in zip(texts, part.column(2).to_pylist())]
                yield from out(packer.add(list(zip(part.column(0).to_pylist(), ids, masks))))
        yield from out(packer.finish())

    plain = docs.select(*columns)
    return plain.mapInArrow(run, f"`{key}` {plain.schema[0].dataType.simpleString()}, {PIECE}")


def loss_mask(encoder: WordEncoder, text: str, spans: list[dict]) -> np.ndarray:
    """True for the ids of words that begin in a span, and for the end id."""
    inside = np.zeros(len(text) + 1, bool)
    for s in spans:
        inside[s["start"] : s["end"]] = True
    mask, at = [], 0
    for word, n in zip(text.replace("\n", " ").split(" "), encoder.sizes(text)):
        mask += [bool(inside[at])] * n
        at += len(word) + 1
    return np.array([*mask, True])


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
