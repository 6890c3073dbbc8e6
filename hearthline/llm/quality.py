"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

Every word, known by the 64-bit hash of its lower-cased letters, has a context vector: the
sum, over all its occurrences in the corpus, of the fixed random signs of the words
around it. Common words' vectors are few and go to every task; all others meet their
documents in a shuffle. Beside them every word has a coarse key made of its shape and
hashed letters, with a context vector of its own kind. A document is the mean of both
kinds of vectors, normalised, over its words. A network with one hidden layer, trained
with Adam in numpy, scores it; one temperature, fitted on rows the network has not
seen, makes the scores probabilities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.arrow import map_batches
from hearthline.llm.tokens import LOWER, Piece, mix, pieces, span_hashes, words
from hearthline.scratch import materialize

SHAPES, LETTERS = 64, 256
KEYS = SHAPES * LETTERS
SIZE, NONZERO, AROUND = 32, 4, 2
WORD_SIZE, UNIT = 16, 127  # numbers of a word's own vector, each of one byte
COMMON, WINDOW, LEAST = 1 << 21, 1 << 21, 4  # common: once in so many words; counted by windows
FULL = 256  # vectors whose sum two bytes can hold
OCCURRENCES = 1 << 20  # that a task gathers before it sends them
MEET = 1 << 17  # occurrences of a part whose words get their vectors at a time
PART_BYTES = 64 << 20  # of text for each part of the rare words
TEXT_KEY = "_text_key"
HIDDEN, STEPS, RATE, DECAY = 16, 800, 0.02, 1e-4
MAX_SAMPLE = 8000
CALIBRATION = 5  # one sampled row in so many sets the temperature

_UPPER, _LETTER, _DIGIT = np.zeros((3, 256), bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_LETTER[128:] = True
_DIGIT[ord("0") : ord("9") + 1] = True


def _index_vectors() -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(5))
    vectors = np.zeros((KEYS, SIZE), np.int64)
    for row in vectors:
        row[random.choice(SIZE, NONZERO, replace=False)] = random.choice([-1, 1], NONZERO)
    return vectors


class QualityModel(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        layer = np.tanh((pooled - self.mean) / self.scale @ self.hidden + self.hidden_bias)
        return layer @ self.out + self.out_bias

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        # Rounded: the last digits depend on which texts share a batch.
        return np.round(1 / (1 + np.exp(-self.logits(pooled) / self.temperature)), 9)


def word_keys(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Each word's key, and where each text's words begin.

    The shape says: all capitals, several marks, one mark, no letter, a digit, the same as
    the word before.
    """
    found = words(piece)

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[piece.data], dtype=np.int32)])
        return sums[found.end] - sums[found.begin]

    letters, upper, digits = count(_LETTER), count(_UPPER), count(_DIGIT)
    marks = found.end - found.begin - letters - digits
    hashes = span_hashes(LOWER[piece.data], found.begin, found.end)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    first = found.offsets[:-1]
    again[first[first < len(hashes)]] = False
    flags = (upper > 1) & (2 * upper > letters), marks > 1, marks == 1, letters == 0, digits > 0, again
    shape = sum(flag.astype(np.int64) << i for i, flag in enumerate(flags))
    return shape * LETTERS + (hashes >> np.uint64(40)).astype(np.int64) % LETTERS, found.offsets


def context_sums(keys: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Sum of the index vectors around every occurrence, by key: KEYS x SIZE."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pairs = []
    for k in range(1, AROUND + 1):
        near = owner[k:] == owner[:-k]
        a, b = keys[:-k][near], keys[k:][near]
        pairs += [a * KEYS + b, b * KEYS + a]
    pair, n = np.unique(np.concatenate(pairs), return_counts=True) if pairs else (np.zeros(0, np.int64),) * 2
    sums = np.zeros((KEYS, SIZE))
    for d in range(SIZE):
        value = index[pair % KEYS, d]
        on = value != 0
        sums[:, d] = np.bincount(pair[on] // KEYS, n[on] * value[on], minlength=KEYS)
    return sums.astype(np.int64)


def learn_vectors(docs: DataFrame) -> np.ndarray:
    """Context vectors from every document; KEYS rows reach the driver."""
    index = _index_vectors()
    names = [f"v{d}" for d in range(SIZE)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((KEYS, SIZE), np.int64)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                sums += context_sums(*word_keys(piece), index)
        seen = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_pydict({"key": seen} | {c: sums[seen, d].copy() for d, c in enumerate(names)})

    rows = docs.select("text").mapInArrow(count, "key long, " + ", ".join(f"{c} long" for c in names))
    vectors = np.zeros((KEYS, SIZE))
    for row in rows.groupBy("key").agg(*(F.sum(c) for c in names)).collect():
        vectors[row[0]] = row[1:]
    # Words that were never seen keep their own index vector.
    unseen = ~vectors.any(1)
    vectors[unseen] = index[unseen]
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def pooled(piece: Piece, vectors: np.ndarray) -> np.ndarray:
    """The mean word vector of every text, zeros for one without words."""
    keys, offsets = word_keys(piece)
    out = np.zeros((piece.rows, SIZE), np.float32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(vectors[keys], offsets[full], axis=0)
        out[full] /= np.diff(offsets)[full][:, None]
    return out


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def word_hashes(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each lower-cased word, as a signed number, and where each text's words begin."""
    found = words(piece)
    return span_hashes(LOWER[piece.data], found.begin, found.end).view(np.int64), found.offsets


def signs(hashes: np.ndarray) -> np.ndarray:
    """The fixed random vector of each word, of ones and minus ones."""
    bits = mix(hashes.view(np.uint64))[:, None] >> np.arange(WORD_SIZE, dtype=np.uint64) & np.uint64(1)
    return (1 - 2 * bits.astype(np.int8)).astype(np.int8)


def contexts(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the vectors around every single occurrence."""
    own, sums = signs(hashes), np.zeros((len(hashes), WORD_SIZE), np.int8)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for k in range(1, AROUND + 1):
        near = (owner[k:] == owner[:-k])[:, None]
        sums[:-k] += own[k:] * near
        sums[k:] += own[:-k] * near
    return sums


def unit(sums: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Context vectors of length UNIT in whole numbers; a word that stands nowhere near another has its own."""
    sums = np.where(sums.any(1, keepdims=True), sums, signs(hashes)).astype(float)
    return np.rint(sums * (UNIT / np.linalg.norm(sums, axis=1, keepdims=True))).astype(np.int8)


def place(common: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each word is among the sorted common ones, -1 where it is not."""
    if not len(common):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    return np.where(common[at] == hashes, at, -1)


def common_words(docs: DataFrame, share: int = COMMON) -> np.ndarray:
    """Sorted hashes of words that are one in ``share`` of all or more: ``share`` at most.

    Which words these are decides where a vector is looked up, not what it is.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def tell() -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LEAST
            everything = np.array([size])
            return pa.RecordBatch.from_pydict(
                {"word": pa.array([None, *word[often].tolist()], pa.int64()), "n": np.concatenate([everything, n[often]])}
            )

        for batch in batches:
            for piece in pieces(batch.column(0)):
                held.append(word_hashes(piece)[0])
                size += len(held[-1])
                if size >= WINDOW:
                    yield tell()
                    held, size = [], 0
        if size:
            yield tell()

    counted = materialize(
        docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts"
    )
    total = counted.filter("word IS NULL").first()
    if total is None:
        return np.zeros(0, np.int64)
    often = counted.filter(F.col("word").isNotNull() & (F.col("n") * share >= total["n"])).select("word").toArrow()
    return np.sort(often.column(0).to_numpy())


def learn_common(docs: DataFrame, common: np.ndarray) -> np.ndarray:
    """The vectors of the common words, from all their occurrences."""
    names = [f"v{d}" for d in range(WORD_SIZE)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(common), WORD_SIZE), np.int64)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                hashes, offsets = word_hashes(piece)
                at = place(common, hashes)
                on = np.flatnonzero(at >= 0)
                on = on[np.argsort(at[on], kind="stable")]
                if len(on):
                    first = np.flatnonzero(np.diff(at[on], prepend=-1))
                    sums[at[on[first]]] += np.add.reduceat(contexts(hashes, offsets)[on], first, axis=0, dtype=np.int64)
        seen = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_pydict({"at": seen} | {c: sums[seen, d].copy() for d, c in enumerate(names)})

    def pack(batch: pa.RecordBatch) -> Iterator[dict]:
        at = batch.column(0).to_numpy()
        sums = np.column_stack([c.to_numpy() for c in batch.columns[1:]])
        yield {"at": at, "v": pa.array([v.tobytes() for v in unit(sums, common[at])], pa.binary())}

    rows = docs.select("text").mapInArrow(count, "at long, " + ", ".join(f"{c} long" for c in names))
    summed = rows.groupBy("at").agg(*(F.sum(c) for c in names))
    found = map_batches(summed, pack, "at long, v binary").toArrow()
    vectors = unit(np.zeros((len(common), WORD_SIZE), np.int64), common)
    if found.num_rows:
        packed = b"".join(found.column("v").to_pylist())
        vectors[found.column("at").to_numpy()] = np.frombuffer(packed, np.int8).reshape(-1, WORD_SIZE)
    return vectors


def packed_contexts(around: np.ndarray) -> np.ndarray:
    """The context of one occurrence, WORD_SIZE numbers from -2 * AROUND to 2 * AROUND, as one number."""
    base = 4 * AROUND + 1
    return (around.astype(np.int64) + 2 * AROUND) @ base ** np.arange(WORD_SIZE, dtype=np.int64)


def unpacked_contexts(packed: np.ndarray) -> np.ndarray:
    base = 4 * AROUND + 1
    out = np.empty((len(packed), WORD_SIZE), np.int8)
    for d in range(WORD_SIZE):
        packed, out[:, d] = np.divmod(packed, base)
    return out - np.int8(2 * AROUND)


def _planes(numbers: np.ndarray) -> bytes:
    """Whole numbers byte by byte, so that high bytes, which are alike, compress."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(planes: np.ndarray, kind: type) -> np.ndarray:
    """What ``_planes`` took apart, one row of bytes for each byte of a number."""
    return np.ascontiguousarray(planes.T).view(kind)


def starts_of_runs(numbers: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))


def numbers_of(batches: list[pa.RecordBatch], name: str, kind: type) -> list[np.ndarray]:
    """The numbers in each row's bytes, read in place."""
    return [np.frombuffer(x.as_buffer(), kind) for batch in batches for x in batch.column(name)]


def occurrence_vectors(words: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
    """The vector of each occurrence's word, from all its contexts here.

    Words go through in slices of their hashes, so what a word costs on the way is held for
    some MEET occurrences, not for all.
    """
    starts = np.cumsum([0, *map(len, words)])
    out = np.empty((starts[-1], WORD_SIZE), np.int8)
    slices, half = np.uint64(max(1, -(-int(starts[-1]) // MEET))), np.uint64(32)
    for s in range(int(slices)):
        on = [np.flatnonzero((w.view(np.uint64) >> half) * slices >> half == s) for w in words]
        word = np.concatenate([w[i] for w, i in zip(words, on, strict=True)])
        if not len(word):
            continue
        around = np.concatenate(
            [_unplaned(x.reshape(8, -1)[:, i], np.int64).ravel() for x, i in zip(contexts, on, strict=True)]
        )
        to = np.concatenate([i + start for i, start in zip(on, starts, strict=False)])
        order = np.argsort(word, kind="stable")
        begin = starts_of_runs(word[order])
        sums = np.add.reduceat(unpacked_contexts(around[order]), begin, axis=0, dtype=np.int64)
        vectors = unit(sums, word[order[begin]])
        out[to[order]] = np.repeat(vectors, np.diff(begin, append=len(word)), axis=0)
    return out


def text_sums(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For one part of ``rare_occurrences``: keys of texts, how many words each has there, and the sum of their vectors.

    No word here is common, so a part is no larger than its share of the text. A text of more
    than FULL words comes several times: sums of so few vectors fit two bytes.
    """
    keys, sizes, words, contexts = (
        numbers_of(batches, *c)
        for c in (("keys", np.int64), ("sizes", np.int32), ("words", np.int64), ("contexts", np.uint8))
    )
    vectors = occurrence_vectors(words, contexts)
    size = sum(int((-(-n // FULL)).sum()) for n in sizes)
    key, n, summed = np.empty(size, np.int64), np.empty(size, np.int16), np.empty((size, WORD_SIZE), np.int16)
    done = begin = 0
    for row_keys, row_sizes in zip(keys, sizes, strict=True):
        ends = np.cumsum(row_sizes, dtype=np.int64)
        owner = np.repeat(np.arange(len(ends)), row_sizes)
        first = np.flatnonzero((np.arange(len(owner)) - (ends - row_sizes)[owner]) % FULL == 0)
        to = slice(done, done + len(first))
        key[to], n[to] = row_keys[owner[first]], np.diff(first, append=len(owner))
        summed[to] = np.add.reduceat(vectors[begin : begin + len(owner)], first, axis=0, dtype=np.int16)
        done, begin = to.stop, begin + len(owner)
    return key, n, summed


def rare_occurrences(docs: DataFrame, common: np.ndarray, parts: int) -> DataFrame:
    """Words that are not common, with the context of each occurrence, dealt to parts by their hash.

    A row holds many texts' words of one part: their keys, how many words each has, words and contexts.
    """

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, word, around = (np.concatenate(c) for c in zip(*held, strict=True))
        part = (word.view(np.uint64) % np.uint64(parts)).astype(np.int64)
        for p in np.unique(part):
            on = np.flatnonzero(part == p)  # in the order of texts
            begin = starts_of_runs(key[on])
            yield pa.RecordBatch.from_pydict(
                {
                    "part": [int(p)],
                    "keys": [key[on[begin]].tobytes()],
                    "sizes": [np.diff(begin, append=len(on)).astype(np.int32).tobytes()],
                    "words": [word[on].tobytes()],
                    "contexts": [_planes(around[on])],
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for piece in pieces(batch.column(1)):
                hashes, offsets = word_hashes(piece)
                on = np.flatnonzero(place(common, hashes) < 0)
                if not len(on):
                    continue
                owner = np.repeat(np.arange(piece.rows), np.diff(offsets))[on]
                held.append((keys[piece.first + owner], hashes[on], packed_contexts(contexts(hashes, offsets)[on])))
                n += len(on)
                if n >= OCCURRENCES:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    found = docs.select(text_key(), "text")
    return found.mapInArrow(run, "part long, keys binary, sizes binary, words binary, contexts binary")


def other_words(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Of every text the vectors of its words that are not common, summed: key, words, s0 and up.

    Equal texts have one row; words and sums count each of them. A word's occurrences meet in the
    part of its hash, some PART_BYTES of text for each part. What goes back to a text is one sum of
    vectors from each part, many texts' sums in a row; texts are dealt to as many buckets as there are parts.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_BYTES))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, summed = text_sums(list(batches))
        bucket = (key.view(np.uint64) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        begin = starts_of_runs(bucket[order])
        for b, group in zip(bucket[order[begin]], np.split(order, begin[1:]), strict=True):
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": [int(b)],
                    "keys": [key[group].tobytes()],
                    "n": [n[group].tobytes()],
                    "sums": [np.ascontiguousarray(summed[group].view(np.uint8).T).tobytes()],
                }
            )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        keys, counts, planes = (numbers_of(held, *c) for c in (("keys", np.int64), ("n", np.int16), ("sums", np.uint8)))
        key = np.unique(np.concatenate(keys))
        words, total = np.zeros(len(key), np.int64), np.zeros((len(key), WORD_SIZE), np.int64)
        for row_keys, n, sums in zip(keys, counts, planes, strict=True):
            at = np.searchsorted(key, row_keys)
            order = np.argsort(at, kind="stable")
            begin = starts_of_runs(at[order])
            to, sums = at[order[begin]], _unplaned(sums.reshape(2 * WORD_SIZE, -1), np.int16)
            words[to] += np.add.reduceat(n[order], begin, dtype=np.int64)
            total[to] += np.add.reduceat(sums[order], begin, axis=0, dtype=np.int64)
        columns = {"key": key, "words": words}
        yield pa.RecordBatch.from_pydict(columns | {f"s{d}": total[:, d].copy() for d in range(WORD_SIZE)})

    found = rare_occurrences(docs, common, parts)
    met = found.groupBy("part").applyInArrow(meet, "bucket long, keys binary, n binary, sums binary")
    names = ", ".join(f"s{d} long" for d in range(WORD_SIZE))
    return met.groupBy("bucket").applyInArrow(add_up, f"key long, words long, {names}")


def features(docs: DataFrame, share: int = COMMON) -> DataFrame:
    """One row for each row of docs: doc_id, the key of its text, and x, the mean of the vectors of its words."""
    shapes = learn_vectors(docs)
    common = common_words(docs, share)
    vectors = learn_common(docs, common)

    def own(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch.column(2)):
            hashes, offsets = word_hashes(piece)
            at = place(common, hashes)
            sums = np.zeros((piece.rows, WORD_SIZE), np.int64)
            full, here = np.flatnonzero(np.diff(offsets)), np.flatnonzero(at >= 0)
            if len(here):
                owner = np.repeat(np.arange(piece.rows), np.diff(offsets))[here]
                begin = np.flatnonzero(np.diff(owner, prepend=-1))
                sums[owner[begin]] = np.add.reduceat(vectors[at[here]], begin, axis=0, dtype=np.int64)
            others = np.zeros(piece.rows, np.int64)
            if len(full):
                others[full] = np.add.reduceat(at < 0, offsets[full], dtype=np.int64)
            part = batch.slice(piece.first, piece.rows)
            yield {
                "doc_id": part.column(0),
                "key": part.column(1),
                "n": np.diff(offsets).astype(np.int64),
                "others": others,
                "shape": pa.array([x.tobytes() for x in pooled(piece, shapes)], pa.binary()),
                "sums": pa.array([x.tobytes() for x in sums], pa.binary()),
            }

    def join(batch: pa.RecordBatch) -> Iterator[dict]:
        if not batch.num_rows:
            return
        ids, keys, n, others, shape, sums, counted = batch.columns[:7]
        n, others = n.to_numpy(), others.to_numpy()
        shape = np.frombuffer(b"".join(shape.to_pylist()), np.float32).reshape(-1, SIZE)
        sums = np.frombuffer(b"".join(sums.to_pylist()), np.int64).reshape(-1, WORD_SIZE)
        rest = np.column_stack([c.fill_null(0).to_numpy() for c in batch.columns[7:]])
        copies = np.maximum(counted.fill_null(0).to_numpy() // np.maximum(others, 1), 1)
        mean = (sums + rest // copies[:, None]) / (UNIT * np.maximum(n, 1)[:, None])
        x = np.column_stack([shape, mean.astype(np.float32)])
        yield {"doc_id": ids, TEXT_KEY: keys, "x": pa.array([r.tobytes() for r in x], pa.binary())}

    kind = dict(docs.dtypes)["doc_id"]
    rows = map_batches(
        docs.select("doc_id", text_key(), "text"),
        own,
        f"doc_id {kind}, key long, n long, others long, shape binary, sums binary",
    )
    rest = other_words(docs, common)
    joined = rows.join(rest, "key", "left").select(*rows.columns, *rest.columns[1:])
    return materialize(map_batches(joined, join, f"doc_id {kind}, {TEXT_KEY} long, x binary"), "quality-features")


def unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, SIZE + WORD_SIZE)


def train(x: np.ndarray, good: np.ndarray) -> QualityModel:
    """Fit the network on four rows in five, the temperature on the fifth."""
    held = np.arange(len(x)) % CALIBRATION == CALIBRATION - 1
    if len(set(good[~held])) < 2:  # too few rows to hold any out
        held[:] = False
    a, y = x[~held], good[~held].astype(float)
    mean, scale = a.mean(0), a.std(0) + 1e-3
    a = (a - mean) / scale
    random = np.random.Generator(np.random.PCG64(55))
    params = [random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, 0.25, HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for t in range(1, STEPS + 1):
        hidden, bias, out, out_bias = params
        layer = np.tanh(a @ hidden + bias)
        error = (1 / (1 + np.exp(-(layer @ out + out_bias))) - y) / len(y)
        back = np.outer(error, out) * (1 - layer**2)
        steps = [a.T @ back + DECAY * hidden, back.sum(0), layer.T @ error + DECAY * out, error.sum(keepdims=True)]
        for i, step in enumerate(steps):
            m, v = moments[i]
            moments[i] = m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step**2
            params[i] = params[i] - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model = QualityModel(mean, scale, *params[:3], float(params[3][0]), 1.0)
    if not held.any():
        return model
    logits, truth = model.logits(x[held]), good[held].astype(float)
    temperatures = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
    loss = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in temperatures]
    return model._replace(temperature=float(temperatures[int(np.argmin(loss))]))


def learn_quality(made: DataFrame, labels: DataFrame, learn: Column, max_sample: int) -> QualityModel | None:
    """The model of labelled rows of ``features``."""
    known = (
        labels.filter(learn & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_sample)
    )
    # max_sample labels are broadcast, and as many rows of some 50 numbers come back.
    # A row that repeats an id and its text counts once, and so many are taken whatever repeats.
    marked = made.join(F.broadcast(known), "doc_id").select("doc_id", TEXT_KEY, "quality", "x")
    once = marked.dropDuplicates(["doc_id", TEXT_KEY])
    rows = once.orderBy(F.xxhash64("doc_id"), F.xxhash64("doc_id", TEXT_KEY), "doc_id").limit(max_sample).collect()
    if len({r["quality"] for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: (hash_order(r["doc_id"]), bytes(r["x"])))  # sums depend on the order
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.float32).reshape(-1, SIZE + WORD_SIZE).astype(float)
    return train(x, np.array([r["quality"] == 1 for r in rows]))


def hash_order(doc_id) -> int:
    number = doc_id if isinstance(doc_id, int) else zlib.crc32(str(doc_id).encode())
    return int(mix(np.array([number], np.int64).astype(np.uint64))[0])


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """Quality of every row: doc_id, score, predicted.

    ``labels`` has doc_id and quality. The word vectors come from all texts; the network from
    the ``max_sample`` labelled rows that come first by a hash of those where ``learn`` (on
    doc_id) holds. A null, empty or blank text scores as the zero vector. If the labels seen
    are not of both kinds every score is 1, so that a filter rejects nothing. Repeated rows
    each get their row; an empty table gives none. Other columns are not read.
    """
    made = features(docs)
    model = learn_quality(made, labels, learn, max_sample)

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        score = np.ones(batch.num_rows)
        if model is not None and len(score):
            score = model.probability(unpacked(batch.column(1)))
        yield {"doc_id": batch.column(0), "score": score.astype(float), "predicted": (score >= 0.5).astype(np.int32)}

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(made.select("doc_id", "x"), judge, f"doc_id {kind}, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, learn: Column, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, that ``score_quality`` predicts to be good: those whose
    text is none of the rejected ones."""
    made = features(docs)
    model = learn_quality(made, labels, learn, max_sample)
    if model is None:
        return docs

    def reject(batch: pa.RecordBatch) -> Iterator[dict]:
        if batch.num_rows:
            yield {TEXT_KEY: batch.column(0).filter(pa.array(model.probability(unpacked(batch.column(1))) < 0.5))}

    rejected = map_batches(made.select(TEXT_KEY, "x"), reject, f"{TEXT_KEY} long").distinct()
    return docs.withColumn(TEXT_KEY, text_key()).join(rejected, TEXT_KEY, "left_anti").select(*docs.columns)
