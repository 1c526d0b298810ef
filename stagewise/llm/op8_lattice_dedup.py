"""Embedding near-dedup by lattice hashing.

Each of several tables turns the unit vectors by a random projection and decodes blocks
of eight coordinates to the nearest point of the E8 lattice; the points of all blocks
name a cell. A vector is also entered into the neighbouring cells across its nearest
walls (a block's second-nearest point). Vectors that share a cell are compared exactly.
Equal vectors form one class; cells with many classes are compared in blocks, and a
pair's link is counted only in the first cell that both share, so counts leave a block
instead of pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import mixed, saved, small_batches, sorted_tiles, split_join
from stagewise.llm.components import components

#: Tables, E8 blocks of a cell, lattice scale, neighbouring cells entered per table.
TABLES, BLOCKS, SCALE, PROBES = 8, 3, 3.0, 3
#: Classes of a cell that one block holds from either side.
BLOCK = 512


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8: rounded, with the worst coordinate moved where the sum is odd."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(-1)[..., None]
    step = np.where(np.take_along_axis(off, worst, -1) >= 0, 1.0, -1.0)
    step[near.sum(-1) % 2 == 0] = 0
    np.put_along_axis(near, worst, np.take_along_axis(near, worst, -1) + step, -1)
    return near


def e8_points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest E8 point of each row, the best of the other coset, how much farther it is."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    far_whole, far_half = ((x - whole) ** 2).sum(-1), ((x - half) ** 2).sum(-1)
    swap = (far_half < far_whole)[..., None]
    return np.where(swap, half, whole), np.where(swap, whole, half), np.abs(far_whole - far_half)


def projections(dims: int, tables: int, blocks: int, seed: int = 20) -> np.ndarray:
    """One projection to 8 * blocks dimensions per table, orthonormal where dims allow it."""
    random = np.random.default_rng(seed)
    out = random.standard_normal((tables, dims, 8 * blocks))
    return np.linalg.qr(out)[0] if dims >= 8 * blocks else out / np.sqrt(dims)


def cells(unit: np.ndarray, turn: np.ndarray, blocks: int, scale: float, probes: int) -> np.ndarray:
    """Cell hashes of unit vectors: one column for each table's home, then the neighbours."""
    homes, others = [], []
    n = len(unit)
    for table, projection in enumerate(turn):
        point, other, gap = e8_points((unit @ projection).reshape(n, blocks, 8) * scale)
        weights = mixed(np.arange(1, 8 * blocks + 1, dtype=np.uint64) + np.uint64(1000 * table)).reshape(blocks, 8)
        part = lambda p: ((p * 2).astype(np.int64).view(np.uint64) * weights).sum(-1, dtype=np.uint64)
        home, away = part(point), part(other)
        total = home.sum(-1, dtype=np.uint64)
        homes.append(mixed(total + np.uint64(table)))
        for block in np.argsort(gap, axis=1)[:, :probes].T:
            rows = np.arange(n)
            others.append(mixed(total - home[rows, block] + away[rows, block] + np.uint64(table)))
    return np.stack(homes + others, axis=1)


def _compare(node: np.ndarray, unit: np.ndarray, keys: np.ndarray, counts: np.ndarray, cell: int, side: np.ndarray | None,
             least: float, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows' counts of links that belong to this cell, and each row's least linked row."""
    close = unit @ unit.T >= least
    np.fill_diagonal(close, False)
    close &= node[:, None] != node[None]
    if side is not None:
        close &= side[:, None] != side[None]
    x, y = np.nonzero(np.triu(close))
    n_links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    if len(x):
        same = keys[x, :tables] == keys[y, :tables]
        first = same.argmax(1)
        own = np.where(same.any(1), keys[x, first], np.uint64(0))
        for i in np.flatnonzero(~same.any(1)):
            own[i] = np.intersect1d(keys[x[i]], keys[y[i]])[0]
        here = own == np.uint64(cell)
        np.add.at(n_links, x[here], counts[y[here]])
        np.add.at(n_links, y[here], counts[x[here]])
        while True:
            before = root.copy()
            np.minimum.at(root, x, before[y])
            np.minimum.at(root, y, root[x])
            root = root[root]
            if (root == before).all():
                break
    return n_links, root


def lattice_links(vectors: DataFrame, vector: str = "embedding", number: str = "vec_id", least: float = 0.95, tables: int = TABLES,
                  blocks: int = BLOCKS, scale: float = SCALE, probes: int = PROBES) -> DataFrame:
    """Links of near-equal vectors: the id column, n_links, component_id and kept, per row.

    n_links counts other rows whose cosine is ``least`` or more and that share a cell;
    component_id is the least id reachable by links; kept marks that row. Null, empty,
    zero and non-finite vectors (null components too) link with nothing, nor do vectors
    of different lengths. Equal vectors link whatever their number. Repeated and null
    ids are kept as they are. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    raw = vectors.select(F.col(number).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    valid = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    raw = raw.withColumn("v", F.when(valid, F.col("v")))

    def coded(batches):
        turns = {}
        for batch in batches:
            lists = batch.column("v").to_pylist()
            nodes, packed, keys = ([None] * len(lists) for _ in range(3))
            for dims in {len(v) for v in lists if v is not None}:
                rows = [i for i, v in enumerate(lists) if v is not None and len(v) == dims]
                values = np.array([lists[i] for i in rows]) + 0.0  # -0.0 becomes 0.0
                unit = values / np.abs(values).max(axis=1)[:, None]
                unit /= np.linalg.norm(unit, axis=1)[:, None]
                if dims not in turns:
                    turns[dims] = projections(dims, tables, blocks)
                found = mixed(cells(unit, turns[dims], blocks, scale, probes) + np.uint64(dims))
                for i, value, u, k in zip(rows, values, unit, found):
                    nodes[i] = xxhash.xxh3_64_intdigest(value.tobytes()) - (1 << 63)
                    packed[i], keys[i] = u.tobytes(), k.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nodes, pa.int64()), pa.array(packed, pa.binary()), pa.array(keys, pa.binary())],
                                             names=["id", "node", "unit", "keys"])
    id_type = dict(raw.dtypes)["id"]
    rows = saved(raw.mapInArrow(coded, f"id {id_type}, node long, unit binary, keys binary"), "lattice-vectors")
    classes = saved(rows.where("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("id").alias("least"), F.first("unit").alias("unit"), F.first("keys").alias("keys")), "lattice-classes")

    def entries(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.int64).reshape(batch.num_rows, -1)
            keys = np.sort(keys, axis=1)
            new = np.concatenate([np.ones((len(keys), 1), bool), keys[:, 1:] != keys[:, :-1]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(np.repeat(batch.column("node").to_numpy(), new.sum(1)))], names=["cell", "node"])
    entered = classes.select("node", "keys").mapInArrow(entries, "cell long, node long")
    crowded = entered.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    placed = split_join(entered, crowded, ["cell"]).withColumn("s", F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int"))
    tiles = placed.select("cell", "node", "s", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")).select(
        "cell", F.least("s", "o").alias("i"), F.greatest("s", "o").alias("j"), F.col("s"), "node")
    full = split_join(tiles, classes.select("node", "copies", "unit", "keys"), ["node"])
    width = tables * (1 + probes)

    def linked(tile: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, copies, s = (tile.column(c).to_numpy() for c in ("node", "copies", "s"))
        unit = np.frombuffer(b"".join(tile.column("unit").to_pylist())).reshape(len(node), -1)
        keys = np.frombuffer(b"".join(tile.column("keys").to_pylist()), np.uint64).reshape(len(node), width)
        cell, i, j = (tile.column(c)[0].as_py() for c in ("cell", "i", "j"))
        n_links, root = _compare(node, unit, keys, copies, cell % (1 << 64), s if i != j else None, least, tables)
        some = (n_links > 0) | (root != np.arange(len(node)))
        return node[some], n_links[some], node[root[some]]
    found = saved(sorted_tiles(full, ["cell", "i", "j"], linked, "node long, n long, root long"), "lattice-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "lattice-components")
    about = (classes.select("node", "copies", "least").join(counts, "node", "left").join(roots, "node", "left")
             .select("node", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")))
    least_of = about.groupBy("root").agg(F.min("least").alias("component_id"))
    about = split_join(about, least_of, ["root"]).select("node", "n_links", "component_id")
    done = split_join(rows.select("id", "node"), about, ["node"], "left")
    component = F.coalesce("component_id", "id")
    return done.select(F.col("id").alias(number), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op8_lattice_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_links(spark.read.parquet(f"{folder}/embeddings.parquet"))


# Brute force over all pairs: equal where no pair of 0.95 or more is missed.
SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e,
  len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
link AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r AND a.ok AND b.ok AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, v.vec_id = c AS kept
FROM v LEFT JOIN (SELECT a AS r, count(*) AS n FROM link GROUP BY a) USING (r)
JOIN (SELECT a AS r, min(o.vec_id) AS c FROM reach JOIN v o ON o.r = b GROUP BY a) USING (r)
"""
