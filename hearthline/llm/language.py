"""Language identification by string kernels.

A text is the set of its byte n-grams of one to four bytes (a blended spectrum,
presence only), hashed into a fixed number of places; bytes that are no letters count
as one separator. The kernel of two texts is the size of the common set over the
geometric mean of both sizes. Landmark texts give Nyström features, ridge regression
of one language against the rest the weights. A batch is scored by one product of its
presence matrix with ``landmarks' @ weights``, multiplied out beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.arrow import map_batches
from hearthline.llm.tokens import LOWER, Piece, pieces

PLACES = 1 << 15
LONGEST = 4
LANDMARKS = 128  # of all languages together, two of each at least
MAX_SAMPLE = 3000  # labelled texts that are learned from, all languages together
MIN_SAMPLE = 20  # of a language, however many there are
RIDGE = 1e-3
UNKNOWN = "und"
ROWS = 128  # of a presence matrix

_LETTERS = LOWER.copy()
_LETTERS[:128][[not chr(c).isalpha() for c in range(128)]] = 32


class LanguageModel(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # PLACES x languages
    bias: np.ndarray


def presence(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Presence matrices of a few texts each, with the number of their first row."""
    for piece in pieces(pc.utf8_lower(texts)):
        for low in range(0, piece.rows, ROWS):
            starts = piece.starts[low : low + ROWS + 1]
            yield piece.first + low, _present(Piece(0, piece.data[starts[0] : starts[-1]], starts - starts[0]))


def _present(piece: Piece) -> np.ndarray:
    found = np.zeros((piece.rows, PLACES), bool)
    data = _LETTERS[piece.data].astype(np.uint32)
    owner = np.repeat(np.arange(piece.rows), np.diff(piece.starts))
    code = np.zeros(len(data), np.uint32)
    for n in range(1, LONGEST + 1):
        size = len(data) - n + 1
        if size < 1:
            break
        code = (code[:size] << np.uint32(8)) | data[n - 1 :]
        place = ((code + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(17)
        whole = owner[:size] == owner[n - 1 :]
        found[owner[:size][whole], place[whole]] = True
    return found


def _unit(bits: np.ndarray) -> np.ndarray:
    """Presence rows of length one."""
    x = np.unpackbits(bits, axis=1)[:, :PLACES].astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def train(languages: list[str], bits: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Fit on packed presence rows; the first rows of each language are its landmarks."""
    names = sorted(set(languages))
    label = np.array([names.index(x) for x in languages])
    each = max(2, landmarks // len(names))
    base = _unit(bits[np.concatenate([np.flatnonzero(label == i)[:each] for i in range(len(names))])])
    value, vector = np.linalg.eigh(base @ base.T)
    value = np.maximum(value, 1e-6)
    whiten = (vector / np.sqrt(value)) @ vector.T
    # A few rows are unpacked at a time: all of them would fill the driver.
    kernel = np.concatenate([_unit(bits[i : i + ROWS]) @ base.T for i in range(0, len(bits), ROWS)])
    features = np.column_stack([kernel @ whiten, np.ones(len(kernel), np.float32)])
    wanted = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Every language weighs the same, however many of its texts were learned from.
    weight = (1 / np.bincount(label)[label])[:, None] / len(names)
    penalty = ridge * np.eye(features.shape[1])
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(features.T @ (features * weight) + penalty, features.T @ (wanted * weight))
    return LanguageModel(names, (base.T @ whiten @ solved[:-1]).astype(np.float32), solved[-1])


def sample_rows(docs: DataFrame, learn: Column, max_sample: int, min_sample: int) -> DataFrame:
    """Labelled rows to learn from, about equally many of every language, chosen by a hash.

    Of id and text, and equal rows once: neither an id that repeats nor copies of a row add to the bound.
    """
    rows = docs.filter(learn & F.col("lang").isNotNull())
    counts = dict(rows.groupBy("lang").count().collect())  # a row for each language
    share = max(min_sample, max_sample // max(1, len(counts)))
    spread = F.pmod(F.xxhash64("doc_id", "text", F.lit(8)), F.lit(1 << 30))
    limit = F.lit(0)
    for lang, n in counts.items():
        part = min(1.0, (share + 4 * share**0.5) / n)
        limit = F.when(F.col("lang") == lang, int(part * (1 << 30))).otherwise(limit)
    drawn = rows.filter(spread < limit).select("doc_id", "lang", "text", spread.alias("spread"))
    return drawn.dropDuplicates(["doc_id", "lang", "text"])


def learn_languages(docs: DataFrame, learn: Column, max_sample: int, min_sample: int) -> LanguageModel | None:
    def pack(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, found in presence(batch.column(2)):
            part = batch.slice(first, len(found))
            bits = np.packbits(found, axis=1)
            yield {"lang": part.column(1), "spread": part.column(3), "bits": pa.array([r.tobytes() for r in bits])}

    rows = map_batches(
        sample_rows(docs, learn, max_sample, min_sample), pack, "lang string, spread long, bits binary"
    )
    found = sorted(rows.collect(), key=lambda r: (r["spread"], r["lang"], r["bits"]))
    if not found:
        return None
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in found), np.uint8).reshape(len(found), -1)
    return train([r["lang"] for r in found], bits)


def identify_languages(
    docs: DataFrame, learn: Column, max_sample: int = MAX_SAMPLE, min_sample: int = MIN_SAMPLE
) -> DataFrame:
    """Predicted language of every row: doc_id, lang_pred, score.

    ``docs`` has doc_id, text and lang; only rows where ``learn`` holds and lang is not null
    are learned from, about ``max_sample`` of them but ``min_sample`` of each language, chosen
    by a hash of id and text. Score is the decision value of the predicted language, from [-1, 1]
    to [0, 1]. A null text, one without a letter, and every text if there is nothing to learn
    from is ``und`` with score 0. Of equal scores the first language by name wins. Repeated
    rows each get their row; an empty table gives none. Other columns are not read.
    """
    model = learn_languages(docs, learn, max_sample, min_sample)

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, texts = batch.columns
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if model is None:
            yield {"doc_id": ids, "lang_pred": pa.array([UNKNOWN] * len(ids)), "score": np.zeros(len(ids))}
            return
        names = np.array(model.languages, object)
        for first, found in presence(texts):
            x = found.astype(np.float32)
            value = x @ model.weights / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1)) + model.bias
            best = value.argmax(1)
            known = lettered[first : first + len(found)]
            score = np.round(np.clip((value[np.arange(len(best)), best] + 1) / 2, 0, 1), 6)
            yield {
                "doc_id": ids.slice(first, len(found)),
                "lang_pred": pa.array(np.where(known, names[best], UNKNOWN), pa.string()),
                "score": np.where(known, score, 0.0),
            }

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(docs.select("doc_id", "text"), judge, f"doc_id {kind}, lang_pred string, score double")
