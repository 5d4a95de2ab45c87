"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence has a logistic score over its words; noisy-or combines the scores,
P(document) = 1 - prod(1 - p(sentence)). The weights are learned from document labels alone, by
gradient ascent on the documents' likelihood. The sentence scores then tell where the offence is.

The model is fitted on a bounded sample of labelled documents (``sample_rows`` different ones with the
smallest hash of id and text, and of these the first ``sample_bytes`` of whole texts), of which only word and
sentence numbers reach the driver. A row that occurs several times is one with so much weight, so no
document, however often it is repeated, fills the sample. Scoring is one pass over the texts, without a shuffle.

Defined results: a NULL or empty text is one empty sentence, whose score is that of the bias.
Rows are scored one by one, so repeated rows score alike. Several labels of one document: the
highest counts; NULL labels and labels without a document count for nothing. With no toxic or no
clean document in the sample, every document has the sample's smoothed share of toxic ones as its
score (0.5 of 0 labels is 1 of 2, counted as clean: 0.25). All other columns, whatever their
names, are passed on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histload.llm.tables import checkpointed, small_arrow_batches
from histload.llm.words import find_words, small_batches, text_bytes
from histload.names import quoted

SAMPLE_ROWS, SAMPLE_BYTES = 10_000, 64 << 20
BATCH_BYTES = 1 << 20  # of text at once: a worker keeps what numpy took for its largest batch
FOLDS = 5
BUCKETS = 1 << 20  # words are told apart by so many hash values
MIN_DOCUMENTS = 3  # a word in fewer documents of the sample has no weight
STEPS, RATE, PENALTY = 150, 0.1, 0.5  # the penalty, in documents, on each weight's size
OFFENSIVE = 0.5  # a sentence with this score or more is reported

# A sentence ends at one of these bytes.
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True

SCORE_COLUMNS = "score double, n_sentences long, n_offensive long, worst_start long, worst_end long"


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: the CRC-32 of its id is divisible by FOLDS."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Word weights, sorted by the word's hash value, and the bias of every sentence."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    constant: float | None = None  # the score of every document, where nothing could be learned


class Sentences:
    """Sentences of a text column and the words in them, as numbers.

    ``starts``: first byte of each sentence; ``first``: sentences of text i are first[i] to
    first[i + 1], at least one; ``features`` and ``sentence``: hash value and sentence of each word.
    """

    def __init__(self, column: pa.Array):
        self.raw, self.offsets = text_bytes(column)
        offsets, texts = self.offsets, len(self.offsets) - 1
        words = find_words(self.raw, offsets)
        marks = np.flatnonzero(np.take(_ENDS, self.raw)) + 1
        marks = marks[offsets[np.searchsorted(offsets, marks)] != marks]
        owner = np.searchsorted(offsets, marks, "right") - 1
        place = np.concatenate((np.arange(texts), owner))
        order = np.argsort(place, kind="stable")
        self.starts = np.concatenate((offsets[:-1], marks))[order]
        self.first = np.searchsorted(place[order], np.arange(texts + 1))
        of_text = np.repeat(np.arange(texts), np.diff(words.bounds))
        self.sentence = of_text + np.searchsorted(marks, words.starts, "right")
        self.features = (words.hashes % np.uint64(BUCKETS)).astype(np.int64)


def _sample_features(batches):
    """A row for each text: its different (sentence, word) pairs, and its number of sentences."""
    for batch in small_batches(batches, "text", BATCH_BYTES):
        found = Sentences(batch.column("text"))
        pairs = np.unique(found.sentence * BUCKETS + found.features)
        cuts = np.searchsorted(pairs, found.first * BUCKETS)
        bounds = pa.array(cuts, pa.int32())
        inside = pairs // BUCKETS - np.repeat(found.first[:-1], np.diff(cuts))
        yield pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(bounds, pa.array(pairs % BUCKETS, pa.int32())),
                pa.ListArray.from_arrays(bounds, pa.array(inside, pa.int32())),
                pa.array(np.diff(found.first), pa.int32()),
                batch.column("toxic"),
                batch.column("repeats"),
            ],
            names=["features", "places", "sentences", "toxic", "repeats"],
        )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    keep_out: bool = True,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """Learn from ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text).

    ``keep_out``: documents that ``held_out`` names are not learned from.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if keep_out:
        known = known.where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    size = F.coalesce(F.max(F.octet_length("text")), F.lit(0))
    each = texts.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("repeats"), size.alias("size"))
    order = (F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash")
    sample = each.join(known, "doc_id").orderBy(*order).limit(sample_rows)
    # sample_rows narrow rows at most, so one task may add up their sizes.
    along = Window.orderBy(*order)
    sample = sample.withColumns(
        {"place": F.row_number().over(along), "end": F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, 0))}
    )
    sample = checkpointed(sample.select("doc_id", "text_hash", "toxic", "repeats", "place", "end"))
    chosen = sample.where((F.col("end") <= sample_bytes) | (F.col("place") == 1)).drop("place", "end")
    found = texts.join(F.broadcast(chosen), ["doc_id", "text_hash"])
    if not sample.where("repeats > 1").isEmpty():
        found = found.dropDuplicates(["doc_id", "text_hash"])
    found = found.select("text", "toxic", "repeats").mapInArrow(
        _sample_features, "features array<int>, places array<int>, sentences int, toxic int, repeats long"
    )
    return _learn(found.toArrow())


def _batch_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document in the batch, hash value, sentence in the document) of each word of a batch."""
    features, places = batch.column("features"), batch.column("places")
    sizes = features.value_lengths().to_numpy(zero_copy_only=False)
    document = np.repeat(np.arange(batch.num_rows), sizes)
    return document, features.flatten().to_numpy(), places.flatten().to_numpy()


def _learn(rows: pa.Table) -> Model:
    toxic = rows.column("toxic").to_numpy().astype(float)
    times = rows.column("repeats").to_numpy().astype(float)
    total, toxic_total = times.sum(), times @ toxic
    none = Model(np.zeros(0, np.int64), np.zeros(0), 0.0, (toxic_total + 0.5) / (total + 2))
    if not 0 < toxic.sum() < len(toxic):
        return none
    sentences = rows.column("sentences").to_numpy()
    first = np.concatenate(([0], np.cumsum(sentences)))

    # Words that enough documents have, numbered; batch by batch, to spare the driver's memory.
    support, hits, begin = np.zeros(BUCKETS), np.zeros(BUCKETS), 0
    for batch in rows.to_batches():
        document, feature, _ = _batch_words(batch)
        pairs = np.unique(document * BUCKETS + feature)
        own = begin + pairs // BUCKETS
        support += np.bincount(pairs % BUCKETS, times[own], minlength=BUCKETS)
        hits += np.bincount(pairs % BUCKETS, (times * toxic)[own], minlength=BUCKETS)
        begin += batch.num_rows
    kept = np.flatnonzero(support >= MIN_DOCUMENTS)
    if not len(kept):
        return none
    number = np.full(BUCKETS, -1, np.int32)
    number[kept] = np.arange(len(kept))
    parts, begin = [], 0
    for batch in rows.to_batches():
        document, feature, place = _batch_words(batch)
        own = number[feature]
        known = own >= 0
        parts.append((own[known], (first[begin + document] + place)[known].astype(np.int32)))
        begin += batch.num_rows
    feature, sentence = (np.concatenate(column) for column in zip(*parts))

    # A start by each word's log-odds among documents, only where toxic documents prefer it.
    hits = hits[kept]
    rest = support[kept] - hits
    odds = np.log((hits + 0.5) / (toxic_total + 1)) - np.log((rest + 0.5) / (total - toxic_total + 1))
    weights = np.where((odds > 0) & (hits >= 2), odds, 0.0)
    bias = -6.0
    owner = np.repeat(np.arange(len(toxic)), sentences)
    moment, spread = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, STEPS + 1):
        margin = bias + np.bincount(sentence, weights[feature], minlength=len(owner))
        score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        log_clean = np.add.reduceat(np.log1p(-np.minimum(score, 1 - 1e-12)), first[:-1])
        clean = np.exp(log_clean)
        # d log P(label) / d margin: for clean documents -p, for toxic ones p * clean / (1 - clean).
        pull = np.where(toxic > 0, clean / np.maximum(1 - clean, 1e-9), -1.0) * times
        push = score * pull[owner]
        slope = np.bincount(feature, push[sentence], minlength=len(kept))
        slope = np.append(slope - PENALTY * np.sign(weights), push.sum()) / total
        moment = 0.9 * moment + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        change = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-6)
        weights, bias = weights + change[:-1], bias + change[-1]
    strong = np.abs(weights) > 0.05
    return Model(kept[strong], weights[strong], float(bias))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text and any other columns) with SCORE_COLUMNS: the document's score, its number
    of sentences and of offensive ones, and the worst sentence as a range of code points."""
    small_arrow_batches(docs.sparkSession)
    others = [name for name in docs.columns if name != "text"]
    taken = {part.split()[0] for part in SCORE_COLUMNS.split(", ")} & {n.lower() for n in docs.columns}
    if taken:
        raise ValueError(f"columns clash with those of the score: {sorted(taken)}")
    out = docs.select("text", *map(quoted, others))
    return out.mapInArrow(_Scorer(model), ", ".join([_ddl(out), SCORE_COLUMNS]))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)


class _Scorer:
    def __init__(self, model: Model):
        self.model = model

    def __call__(self, batches):
        weights = np.zeros(BUCKETS)
        weights[self.model.features] = self.model.weights
        for batch in small_batches(batches, "text", BATCH_BYTES):
            columns = self._scores(batch.column(0), weights)
            names = [*batch.schema.names, *(c.split()[0] for c in SCORE_COLUMNS.split(", "))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    def _scores(self, column: pa.Array, weights: np.ndarray) -> list[pa.Array]:
        found = Sentences(column)
        value = np.take(weights, found.features)
        weighty = np.flatnonzero(value)
        pairs = np.unique(found.sentence[weighty] * BUCKETS + found.features[weighty])
        margin = np.bincount(
            pairs // BUCKETS, weights[pairs % BUCKETS], minlength=len(found.starts)
        )
        margin = np.clip(margin + self.model.bias, -30, 30)
        scores = 1 / (1 + np.exp(-margin))
        first = found.first[:-1]
        total = -np.expm1(np.add.reduceat(np.log1p(-np.minimum(scores, 1 - 1e-12)), first))
        if self.model.constant is not None:
            total = np.full(len(first), self.model.constant)
        offensive = np.add.reduceat(scores >= OFFENSIVE, first, dtype=np.int64)
        worst_start = np.full(len(first), -1)
        worst_end = np.full(len(first), -1)
        ends = np.append(found.starts[1:], found.offsets[-1])
        for i in np.flatnonzero(offensive):
            own = slice(found.first[i], found.first[i + 1])
            worst = found.first[i] + int(np.argmax(scores[own]))
            begin = found.offsets[i]
            worst_start[i] = _code_points(found.raw[begin : found.starts[worst]])
            worst_end[i] = worst_start[i] + _code_points(found.raw[found.starts[worst] : ends[worst]])
        located = [
            pa.array(np.where(place < 0, 0, place), pa.int64(), mask=place < 0)
            for place in (worst_start, worst_end)
        ]
        sizes = pa.array(np.diff(found.first), pa.int64())
        return [pa.array(total), sizes, pa.array(offensive), *located]


def _code_points(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def toxic_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fit on the labels that may be learned from, and score every document."""
    return score(docs, fit(docs, labels, sample_rows))
