"""Vector code compression with norm-of-sum bounds.

A vector is cut into parts, each of which is coded by the nearest entry of its part
position's codebook, and the codebooks are fitted in rounds. Every part keeps two bounds
from the round in which they were computed, its stamp: the distance to its own entry, and
the distance to the nearest other one. As all codebooks of earlier rounds are kept, a
bound is carried to the present one by the true net displacement of the entries since its
stamp, the norm of the sum of their moves, which is never more than the sum of the norms
by which bounds drift otherwise. Where the upper bound stays below the lower one the entry
is unchanged; else the distance to the own entry is computed, and only if that does not
decide either is the part compared with all entries. Distances that decide are integers,
and bounds are rounded outwards, so codes are those of a full scan.

A round is a pass that writes vectors and their bounds (11 bytes a part) to the shared
folder and one that sends the sums of each entry from each task; the tables of earlier
rounds are deleted. The driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import saved, shared_folder, small_batches, split_join
from stagewise.llm.integers import SUMS, as_array, digit_rows, finite_rows, long_or_null, matched, scaled, total_sums

#: Parts of a vector, entries of a codebook, rounds, integer steps of one.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: What a part remembers: its entry, an upper bound to it, a lower bound to all others, and
#: the rounds in which these were computed.
STATE = np.dtype([("code", "u1"), ("upper", "<f4"), ("upper_round", "u1"), ("lower", "<f4"), ("lower_round", "u1")])
#: Share by which bounds must differ, far above the rounding of their sums.
_MARGIN = 1e-6
_ROWS = 1024


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """Net displacement of every entry from each round's codebooks to the last: round, part, entry."""
    last = history[-1]
    return np.stack([_norm(last - old) for old in history])


def _norm(difference: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        squares = (difference * difference).sum(-1)
        if squares.dtype == object:
            squares = np.array([float(x) if x < 10**300 else np.inf for x in squares.ravel()]).reshape(squares.shape)
        return np.sqrt(squares.astype(float))


def scan(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each row (the lower among equals), its squared distance and that of
    the nearest other entry (the same where there is none)."""
    apart = part[:, None] - entries[None]
    far = (apart * apart).sum(-1)
    code = far.argmin(1)
    rows = np.arange(len(far))
    nearest = far[rows, code]
    if far.shape[1] > 1:
        far[rows, code] = far.max(1)
        return code, nearest, far.min(1)
    return code, nearest, nearest


def _up(squares: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(np.sqrt(squares.astype(float)).astype(np.float32), np.float32(np.inf))


def _down(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squares.astype(float)).astype(np.float32), np.float32(-np.inf))


def recode(vectors: np.ndarray, state: np.ndarray | None, history: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """The state of each vector's parts under the last codebooks of ``history``, and how many
    parts were compared with all entries. ``vectors`` are rows, parts, components."""
    now, books = len(history) - 1, history[-1]
    if state is None:
        state = np.zeros(vectors.shape[:2], STATE)
        state["upper"] = np.inf
    else:
        state = state.copy()
    if vectors.dtype == object:  # beyond what bounds are kept for
        state["upper"], state["lower"], moved = np.inf, 0, None
    else:
        moved = displacements(history)
    scans = 0
    for p in range(vectors.shape[1]):
        part, own = vectors[:, p], state[:, p]
        rows = np.arange(len(part))
        if moved is not None:
            upper = own["upper"] + moved[own["upper_round"], p, own["code"]]
            lower = own["lower"] - _greatest_other(moved[:, p], own)
            rows = np.flatnonzero(~(upper * (1 + _MARGIN) < lower * (1 - _MARGIN)))
            known = rows[np.isfinite(own["upper"][rows])]
            apart = part[known] - books[p][own["code"][known]]
            exact = _up((apart * apart).sum(-1))
            own["upper"][known], own["upper_round"][known] = exact, now
            rows = np.setdiff1d(rows, known[exact * (1 + _MARGIN) < lower[known] * (1 - _MARGIN)], assume_unique=True)
        for i in range(0, len(rows), _ROWS):
            some = rows[i:i + _ROWS]
            code, nearest, other = scan(part[some], books[p])
            own["code"][some] = code
            if moved is not None:
                own["upper"][some], own["lower"][some] = _up(nearest), _down(other) if len(books[p]) > 1 else np.float32(np.inf)
                own["upper_round"][some] = own["lower_round"][some] = now
        scans += len(rows)
    return state, scans


def _greatest_other(moved: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For each part the largest displacement since its lower bound of any entry but its own."""
    if moved.shape[1] < 2:
        return np.zeros(len(own))
    order = np.argsort(moved, axis=1)
    first, second = order[:, -1], order[:, -2]
    stamps = own["lower_round"]
    which = np.where(first[stamps] == own["code"], second[stamps], first[stamps])
    return moved[stamps, which]


def errors(vectors: np.ndarray, codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Squared distances to the coded entries, summed over parts."""
    apart = vectors - books[np.arange(books.shape[0])[None], codes]
    return (apart * apart).sum((1, 2))


class _Saved:
    """Tables in the shared folder of which one at a time is kept."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, None

    def write(self, df: DataFrame) -> DataFrame:
        folder = shared_folder(self.spark, "codes")
        df.write.parquet(folder)
        self.drop()
        self.folder = folder
        return self.spark.read.schema(df.schema).parquet(folder)

    def drop(self) -> None:
        if self.folder is not None:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.folder = None


def _books(rows: list[list[int]], parts: int, width: int) -> np.ndarray:
    """Codebooks (part, entry, component) of flat integers by part and entry."""
    return as_array(rows, width).reshape(parts, -1, width)


def code_vectors(vectors: DataFrame, vector: str = "embedding", number: str = "vec_id", label: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Product-quantised vectors: the id column, code, error, label_error and codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are dropped; others
    take part as ``floor(scale * x)``, cut into ``parts`` equal parts. Codebooks start as the
    parts of the vectors of the ``entries`` smallest ids (equal ids ordered by their vectors,
    null ids last; fewer vectors, fewer entries). Vectors not as long as the first of these,
    and all if that can't be cut, have a null code and error. label_error sums the errors
    of equal labels, nulls together. Means are rounded down, unused entries stay. Repeated and
    null ids are kept, other columns ignored; sums beyond a long are null. An empty table
    gives no rows.
    """
    if not 0 < entries <= 256 or not 0 <= rounds < 256:
        raise ValueError("up to 256 entries and 255 rounds")
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.col(number).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label"))
    fields = {name: dict(rows.dtypes)[name] for name in ("id", "label")}

    def finite(batches):
        for batch in batches:
            yield batch.filter(pa.array(finite_rows(batch.column("v"))))
    rows = rows.mapInArrow(finite, f"id {fields['id']}, v array<double>, label {fields['label']}")
    ordered = [F.col("id").asc_nulls_last(), F.col("v").asc()]
    first = rows.where(F.size("v") > 0).select("id", "v").orderBy(*ordered).limit(1).collect()
    dims = len(first[0].v) if first and len(first[0].v) % parts == 0 else 0
    start = rows.where(F.size("v") == dims).select("id", "v").orderBy(*ordered).limit(entries).select("v").toArrow().column("v").combine_chunks() if dims else None
    out = f"id {fields['id']}, label {fields['label']}, code string, error long"
    if not dims:
        coded = rows.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        history = []
    else:
        width = dims // parts
        flat = scaled(start.chunk(0) if isinstance(start, pa.ChunkedArray) else start, dims, scale)
        history = [flat.reshape(len(flat), parts, width).transpose(1, 0, 2)]
        held, state = _Saved(spark), None
        for _ in range(rounds):
            state = held.write(_recoded(rows if state is None else state, history, dims, scale, fields))
            history.append(_moved(state, history[-1], dims, scale))
        coded = saved(_final(rows if state is None else state, history, dims, scale, fields, out), "codes-final")
        held.drop()
    digest = hashlib.sha256(",".join(str(int(x)) for x in history[-1].ravel()).encode()).hexdigest() if dims else None
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("_label")
    coded = coded.withColumn("_label", key)
    total = F.when(F.count("error") == F.count(F.when(F.col("code").isNotNull(), 1)), F.sum(F.col("error").cast("decimal(38,0)"))).try_cast("long")
    sums = coded.groupBy("_label").agg(total.alias("label_error"))
    return split_join(coded, sums, ["_label"]).select(F.col("id").alias(number), "code", "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))


def _pieces(batch: pa.RecordBatch, dims: int, parts: int, scale: int) -> np.ndarray:
    return scaled(batch.column("v"), dims, scale).reshape(batch.num_rows, parts, dims // parts)


def _long_enough(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False) == dims


def _state_of(batch: pa.RecordBatch, parts: int) -> np.ndarray | None:
    if "state" not in batch.schema.names:
        return None
    return np.frombuffer(b"".join(batch.column("state").to_pylist()), STATE).reshape(batch.num_rows, parts)


def _recoded(rows: DataFrame, history: list[np.ndarray], dims: int, scale: int, fields: dict[str, str]) -> DataFrame:
    """The rows with their parts' state under the last codebooks; of vectors of other lengths none."""
    parts = history[0].shape[0]

    def run(batches):
        for batch in batches:
            fit = _long_enough(batch, dims)
            states = np.full(batch.num_rows, None, object)
            if fit.any():
                some = batch.filter(pa.array(fit))
                vectors, *books = matched(_pieces(some, dims, parts, scale), *history)
                state, _ = recode(vectors, _state_of(some, parts), books)
                states[fit] = [row.tobytes() for row in state]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "v", "label")), pa.array(states, pa.binary())], names=["id", "v", "label", "state"])
    return rows.mapInArrow(run, f"id {fields['id']}, v array<double>, label {fields['label']}, state binary")


def _moved(state: DataFrame, books: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """The codebooks after the means of their parts; parts * entries * (width + 1) sums."""
    parts, n_entries, width = books.shape

    def run(batches):
        sums = np.zeros((parts, n_entries, width + 1), object)
        for batch in batches:
            if batch.num_rows:
                vectors, codes = _pieces(batch, dims, parts, scale), _state_of(batch, parts)["code"]
                counted = np.concatenate([vectors, np.ones_like(vectors[:, :, :1])], axis=2)
                here = np.zeros(sums.shape, counted.dtype)
                np.add.at(here, (np.arange(parts)[None], codes), counted)
                sums += here
        yield from digit_rows({i: int(x) for i, x in enumerate(sums.ravel()) if x})
    total = total_sums(state.where("state is not null").select("v", "state").mapInArrow(run, SUMS))
    out = []
    for slot, old in enumerate(books.reshape(-1, width).tolist()):
        at = slot * (width + 1)
        n = total.get(at + width, 0)
        out.append([total.get(at + i, 0) // n for i in range(width)] if n else old)
    return _books(out, parts, width)


def _final(rows: DataFrame, history: list[np.ndarray], dims: int, scale: int, fields: dict[str, str], schema: str) -> DataFrame:
    parts = history[0].shape[0]

    def run(batches):
        for batch in batches:
            fit = _long_enough(batch, dims)
            codes, error = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            if fit.any():
                some = batch.filter(pa.array(fit))
                vectors, *books = matched(_pieces(some, dims, parts, scale), *history)
                state, _ = recode(vectors, _state_of(some, parts), books)
                codes[fit] = [row.tobytes().hex() for row in state["code"]]
                error[fit] = long_or_null(errors(vectors, state["code"], books[-1])).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                                             names=["id", "label", "code", "error"])
    return rows.mapInArrow(run, schema)


def op13_norm_of_sum_codes(spark: SparkSession, folder: str) -> DataFrame:
    return code_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


def _sql() -> str:
    """Full scans in every round. A part is a list of integers, an entry too."""
    text = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, p, e[p * (len(e) // {PARTS}) + 1:(p + 1) * (len(e) // {PARTS})] AS x FROM v, (SELECT unnest(range(0, {PARTS})) AS p)),
c0 AS MATERIALIZED (SELECT p, c, x FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, e) - 1 AS c FROM v ORDER BY vec_id, e LIMIT {ENTRIES}) USING (r)),"""
    for i in range(ROUNDS + 1):
        text += f"""
a{i} AS MATERIALIZED (SELECT r, p, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT r, p.p, c,
  list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN c{i} c ON c.p = p.p) GROUP BY r, p),"""
        if i < ROUNDS:
            text += f"""
c{i + 1} AS MATERIALIZED (SELECT o.p, o.c, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN (SELECT p, c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x
  FROM (SELECT p, c, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT p, c, x, unnest(range(1, len(x) + 1)) AS i FROM p JOIN a{i} USING (r, p)) GROUP BY p, c, i)
  GROUP BY p, c) m ON m.p = o.p AND m.c = o.c),"""
    return text.rstrip(",") + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, c)) FROM c{ROUNDS}) AS codebooks_sha256
FROM v JOIN (SELECT r, string_agg(lower(printf('%02x', c)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r) USING (r)"""


SQL = _sql()
