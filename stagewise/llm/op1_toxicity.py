"""Toxicity by a factorization machine over hashed terms.

A document's terms are its distinct lower-cased words and word beginnings, hashed into
a fixed number of features. Besides a weight each feature has a short vector, and every
pair of features present adds the product of their vectors, so that pairs (an insult and
a group that is mentioned) count for more or less than the sum of their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import WORD_MEMORY, let_go, map_batches, saved, small_batches, with_fields

#: Features (a power of two), length of their vectors, letters of a word's beginning.
FEATURES, FACTORS, BEGINNING = 1 << 18, 8, 5
#: Longer words are not remembered.
LONGEST = 64
#: The classifier is fitted on so many labelled documents at most: those whose id hashes lowest.
SAMPLE = 20_000
#: Bytes of features that the sample may have; the task that fits holds them.
SAMPLE_BYTES = 256 << 20
EPOCHS, BATCH, RATE, RATE_PAIRS, DECAY = 40, 128, 0.1, 0.02, 1e-5
#: Documents whose features are counted at a time before the fit.
COUNTED = 512
#: Standard deviations from chance that a feature's share of toxic documents must differ.
CHANCE = 4.5
#: Words: ASCII letters (lower-cased), apostrophes dropped, and everything non-ASCII.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class Terms(dict):
    """A word's two features in one number, remembered within a task for ``WORD_MEMORY`` words of
    ``LONGEST`` bytes at most."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_MEMORY:
            self.clear()
        whole = xxhash.xxh3_64_intdigest(word, 1) % FEATURES
        begin = xxhash.xxh3_64_intdigest(word[:BEGINNING], 2) % FEATURES if len(word) > BEGINNING else whole
        value = whole << 32 | begin
        if len(word) <= LONGEST:
            self[word] = value
        return value

    def features(self, text: bytes) -> np.ndarray:
        """Distinct features of a text."""
        words = set(text.translate(_LETTERS).split())
        codes = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.unique(np.concatenate([codes >> 32, codes & 0xFFFFFFFF]))


def _scores(weights: np.ndarray, vectors: np.ndarray, bias: float, items: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores of documents whose features begin at ``starts``, and their vector sums."""
    sizes = np.diff(np.append(starts, len(items)))
    some = sizes > 0
    raw, sums = np.full(len(starts), bias), np.zeros((len(starts), vectors.shape[1]))
    if some.any():
        at = starts[some]
        v = vectors[items].astype(np.float64)
        sums[some] = np.add.reduceat(v, at)
        squares = np.add.reduceat((v * v).sum(1), at)
        raw[some] += np.add.reduceat(weights[items].astype(np.float64), at) + ((sums[some] ** 2).sum(1) - squares) / 2
    return raw, sums


def fit(features: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and vectors by AdaGrad on the logistic loss, in a fixed order."""
    random = np.random.default_rng(seed)
    weights, vectors = np.zeros(FEATURES, np.float32), (random.standard_normal((FEATURES, FACTORS)) * 0.01).astype(np.float32)
    share = min(max(labels.mean() if len(labels) else 0.5, 1e-3), 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    if not 0 < labels.sum() < len(labels):
        return bias, weights, np.zeros_like(vectors)
    # Features whose share among toxic documents is no more than chance stay out of the model.
    seen, toxic = np.zeros(FEATURES, np.int64), np.zeros(FEATURES)
    for a in range(0, len(features), COUNTED):
        part = features[a:a + COUNTED]
        every = np.concatenate(part)
        seen += np.bincount(every, minlength=FEATURES)
        toxic += np.bincount(every, np.repeat(labels[a:a + COUNTED], [len(x) for x in part]), minlength=FEATURES)
    spread = np.sqrt(np.maximum(seen * share * (1 - share) * (1 - seen / len(labels)), 1e-9))
    often = (seen >= 3) & (np.abs(toxic - seen * share) >= CHANCE * spread)
    features = [x[often[x]] for x in features]
    past_w, past_v, past_b = np.full(FEATURES, 1e-2, np.float32), np.full((FEATURES, FACTORS), 1e-2, np.float32), 1e-2
    for _ in range(EPOCHS):
        order = random.permutation(len(features))
        for k in range(0, len(order), BATCH):
            rows = order[k:k + BATCH]
            sizes = np.array([len(features[i]) for i in rows])
            items = np.concatenate([features[i] for i in rows])
            if not len(items):
                continue
            raw, sums = _scores(weights, vectors, bias, items, np.cumsum(sizes) - sizes)
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[rows]
            slope = np.repeat(error, sizes)
            pull = slope[:, None] * (np.repeat(sums, sizes, axis=0) - vectors[items])
            sort = np.argsort(items, kind="stable")
            used = items[sort]
            first = np.concatenate([[0], np.flatnonzero(np.diff(used)) + 1])
            used = used[first]
            step_w = np.add.reduceat(slope[sort], first) + DECAY * weights[used]
            step_v = np.add.reduceat(pull[sort], first) + DECAY * vectors[used]
            past_w[used] += step_w**2
            past_v[used] += step_v**2
            weights[used] -= RATE * step_w / np.sqrt(past_w[used])
            vectors[used] -= RATE_PAIRS * step_v / np.sqrt(past_v[used])
            past_b += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(past_b)
    vectors[~often] = 0
    return float(bias), weights, vectors


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a document never serves for learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[float, np.ndarray, np.ndarray]:
    """Fit on at most ``sample`` labelled documents that are not held out.

    These are the ones whose ids hash lowest, as far as their features fit into
    ``SAMPLE_BYTES`` together. Documents are turned into features where they are read, one
    row for each id is kept, and these rows meet in one task, where the model is fitted;
    the driver gets the ids and sizes of the sample and the model (9 MB). Null labels,
    ids and texts are left out; of several labels of an id the largest counts, and of
    several texts the one whose features come first.
    """
    named = docs.where("text is not null").select("doc_id", "text")
    chosen = (labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .join(named.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toArrow())
    ids, toxic = (chosen.column(c).to_numpy() for c in ("doc_id", "toxic"))
    order = np.argsort(ids)

    def start():
        terms, wanted = Terms(), ids[order]

        def work(batch: pa.RecordBatch):
            if not len(wanted):
                return
            own = batch.column("doc_id").fill_null(0).to_numpy()
            mine = wanted[np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)] == own
            batch = batch.filter(pa.array(mine & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)))
            found = [terms.features(t.as_py()).astype(np.int32).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "features"])
        return work
    texts = named.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = saved(map_batches(texts, start, "doc_id long, features binary").groupBy("doc_id").agg(F.min("features").alias("features")), "toxicity-sample")
    sizes = dict(zip(*(counted.select("doc_id", F.octet_length("features").alias("n")).toArrow().column(c).to_pylist() for c in ("doc_id", "n"))))
    fits = np.cumsum([sizes.get(i, 0) for i in ids.tolist()]) <= SAMPLE_BYTES
    label_of = dict(zip(ids[fits].tolist(), toxic[fits].tolist()))

    def learn(table: pa.Table) -> pa.Table:
        let_go()
        own, found = table.column("doc_id").to_numpy(), table.column("features")
        # The features stay where Arrow has them: no second copy of the sample in its one task.
        kept = [(label_of[i], np.frombuffer(found[k].as_buffer(), np.int32)) for k, i in sorted(enumerate(own.tolist()), key=lambda x: x[1]) if i in label_of]
        bias, weights, vectors = fit([x for _, x in kept], np.array([y for y, _ in kept], np.float64))
        return pa.table({"bias": [bias], "weights": pa.array([weights.tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary())})
    row = counted.withColumn("every", F.lit(0)).groupBy("every").applyInArrow(learn, "bias double, weights binary, vectors binary").first() if label_of else None
    if row is None:
        return fit([], np.zeros(0))
    return row.bias, np.frombuffer(row.weights, np.float32), np.frombuffer(row.vectors, np.float32).reshape(FEATURES, FACTORS)


def score_documents(docs: DataFrame, model: tuple[float, np.ndarray, np.ndarray]) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to every row of ``docs``.

    Whole texts are scored; null and empty texts get the model's bias. Columns of these
    names are replaced. The model, of fixed size, is broadcast.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = with_fields(docs, "score double, predicted int")

    def start():
        terms, (bias, weights, vectors) = Terms(), shared.value

        def work(batch: pa.RecordBatch):
            found = [terms.features(t.encode()) if t else np.zeros(0, np.int64) for t in batch.column("text").to_pylist()]
            scores = np.zeros(len(found))
            for a in range(0, len(found), 64):
                part = found[a:a + 64]
                sizes = np.array([len(x) for x in part])
                raw, _ = _scores(weights, vectors, bias, np.concatenate(part), np.cumsum(sizes) - sizes)
                scores[a:a + 64] = 1 / (1 + np.exp(-np.clip(raw, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             names=[*batch.schema.names, "score", "predicted"])
        return work
    return map_batches(docs, start, schema)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    small_batches(spark)
    model = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
