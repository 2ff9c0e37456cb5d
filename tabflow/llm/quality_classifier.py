"""Quality classifier by supervised subword embeddings.

A word's vector is the mean of the learned vectors of its hashed features (the
word and its character n-grams); a document's is the mean over its words; a
softmax over the document vector gives the classes. Vectors and softmax are
trained together by stochastic gradient descent in numpy.

Besides the words as written, a marker word stands after each word that
repeats the one before it and after each line that repeats an earlier line:
repetition is a word feature that no single invented word could carry.

Training reads at most ``per_class`` labelled texts of each class, chosen by a
hash of doc_id, on the driver; all of a text's features, none of its other
columns. As the classes of the sample are cut apart, each text weighs as many
labelled rows as it stands for. Scoring runs over every whole text: with two
classes a document's score depends on one number per word, kept per worker.

Edge cases: a null, empty or blank text has no words and gets the score of the
bias alone; null labels and labels without a document are not learned from;
without labels of both classes every score is the share of class 1 (0.5
without any); repeated rows are scored one by one; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import documents

PER_CLASS = 2000
BUCKETS = 1 << 16
DIMENSIONS = 10
GRAMS = (3, 4)
STEPS = 800
RATE = 20.0
BATCH = 32
_WORDS_CACHED = 400_000
_SAME_WORD, _SAME_LINE = b"\0same word", b"\0same line"


def features(word: bytes) -> list[int]:
    """The buckets of a word and its character n-grams."""
    from xxhash import xxh3_64_intdigest

    if word in (_SAME_WORD, _SAME_LINE):
        return [xxh3_64_intdigest(word) % BUCKETS]
    own = b"<" + word + b">"
    grams = [own[i : i + n] for n in GRAMS for i in range(len(own) - n + 1)]
    return [xxh3_64_intdigest(g) % BUCKETS for g in [word, *grams]]


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, with a marker after each repetition."""
    out: list[bytes] = []
    seen: set[bytes] = set()
    for line in (text or "").encode().split(b"\n"):
        words = line.split()
        if not words:
            continue
        if any(map(eq, words, islice(words, 1, None))):
            words = [w for k, word in enumerate(words) for w in ((word, _SAME_WORD) if k and word == words[k - 1] else (word,))]
        out += words
        if line in seen:
            out.append(_SAME_LINE)
        seen.add(line)
    return out


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights, which add up to 1."""
    counts = Counter(words_of(text))
    total = counts.total()
    weights: dict[int, float] = {}
    for word, n in counts.items():
        own = features(word)
        for f in own:
            weights[f] = weights.get(f, 0.0) + n / (total * len(own))
    return (
        np.fromiter(weights, dtype=np.uint16, count=len(weights)),
        np.fromiter(weights.values(), dtype=np.float32, count=len(weights)),
    )


@dataclass(frozen=True)
class Model:
    """vectors (BUCKETS x DIMENSIONS), output (DIMENSIONS x 2) and bias (2)."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def margins(self) -> tuple[np.ndarray, float]:
        """Each bucket's share in the log odds of class 1, and the bias."""
        return self.vectors @ (self.output[:, 1] - self.output[:, 0]), float(self.bias[1] - self.bias[0])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[int, float, np.ndarray, np.ndarray]], seed: int = 1) -> Model:
    """``rows``: class, weight, buckets and their weights of each text."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    total = sum(r[1] for r in rows)
    if not rows:
        return Model(vectors, output, bias)
    share = sum(r[1] for r in rows if r[0] == 1) / total
    if not 0 < share < 1:
        odds = np.log(np.clip([1 - share, share], 1e-6, None))
        return Model(vectors, output, odds.astype(np.float32))
    mean = total / len(rows)
    done = 0
    while done < STEPS:  # as many for a small sample, which then has more rounds
        order = rng.permutation(len(rows))
        for i in range(0, len(rows), BATCH):
            batch = [rows[k] for k in order[i : i + BATCH]]
            sizes = [len(r[2]) for r in batch]
            owner = np.repeat(np.arange(len(batch)), sizes)
            buckets = np.concatenate([r[2] for r in batch]).astype(np.int64)
            weights = np.concatenate([r[3] for r in batch])
            hidden = np.stack(
                [np.bincount(owner, weights * vectors[buckets, d], len(batch)) for d in range(DIMENSIONS)], axis=1
            )
            wanted = np.eye(2)[[r[0] for r in batch]]
            error = (_softmax(hidden @ output + bias) - wanted) * np.array([[r[1] / mean] for r in batch]) / len(batch)
            rate = RATE * max(0.0, 1 - done / STEPS)
            back = error @ output.T
            output -= (0.05 * rate * hidden.T @ error).astype(np.float32)
            bias -= (0.05 * rate * error.sum(axis=0)).astype(np.float32)
            for d in range(DIMENSIONS):
                change = np.bincount(buckets, weights * back[owner, d], BUCKETS)
                vectors[:, d] -= (rate * change).astype(np.float32)
            done += 1
    return Model(vectors, output, bias)


def training_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, per_class: int = PER_CLASS
) -> list[tuple[int, float, np.ndarray, np.ndarray]]:
    """Features of at most ``per_class`` texts of each class. ``labels``: doc_id
    and ``label_col`` (0 or 1); ``usable``: a condition on its rows."""
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col(label_col).cast("int").alias("class"))
        .where(usable & F.col("doc_id").isNotNull() & F.col("class").isin(0, 1))
        .distinct()
    )
    totals = {r["class"]: r["count"] for r in known.groupBy("class").count().collect()}
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = known.where("class = 0").orderBy(*order).limit(per_class)
    chosen = chosen.unionByName(known.where("class = 1").orderBy(*order).limit(per_class))

    def featurize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [document_features(t.as_py()) for t in batch["text"]]
            packed = [pa.array([x[k].tobytes() for x in made], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["class"], *packed], names=["doc_id", "class", "buckets", "weights"]
            )

    # The chosen ids are at most 2 * per_class rows.
    texts = documents(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "class", "text")
    found = texts.mapInArrow(featurize, "doc_id long, class int, buckets binary, weights binary").collect()
    found = sorted(found, key=lambda r: (r["doc_id"], r["class"], r["buckets"]))
    share = {c: n / max(1, sum(r["class"] == c for r in found)) for c, n in totals.items()}
    return [
        (r["class"], share[r["class"]], np.frombuffer(r["buckets"], np.uint16), np.frombuffer(r["weights"], np.float32))
        for r in found
    ]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the probability of class 1 of every whole text."""
    margins, bias = model.margins()
    packed = margins.astype("<f4").tobytes()  # one fixed-size table, whatever the corpus
    model_id = hashlib.sha256(packed).hexdigest()

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _word_margins(model_id, packed)
        for batch in batches:
            out = []
            for text in batch[1]:
                if len(known) > _WORDS_CACHED:
                    known.clear()
                words = words_of(text.as_py())
                mean = sum(map(known.__getitem__, words)) / len(words) if words else 0.0
                out.append(1 / (1 + np.exp(-np.clip(mean + bias, -500, 500))))
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(out, pa.float64())], names=["doc_id", "score"])

    return documents(docs).mapInArrow(scored, "doc_id long, score double")


class _WordMargins(dict):
    """The mean margin of each word's features."""

    def __init__(self, margins: list[float]):
        super().__init__()
        self._margins = margins

    def __missing__(self, word: bytes) -> float:
        own = features(word)
        value = self[word] = sum([self._margins[f] for f in own]) / len(own)
        return value


@lru_cache(maxsize=1)
def _word_margins(model_id: str, packed: bytes) -> _WordMargins:
    """The words of one model that a worker has met, kept over its tasks."""
    return _WordMargins(np.frombuffer(packed, "<f4").astype(float).tolist())
