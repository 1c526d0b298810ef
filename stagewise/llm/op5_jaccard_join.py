"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections.

Documents with equal shingle sets form one class. Classes are laid into tiles by size:
a tile holds one size band and the next, and every linkable pair lies in one. Within a
tile the shingles are dealt into more hash classes than a linked pair can have
differences, so a linked pair agrees in one class at least, and the classes' hashes are
the keys under which sets meet. Hashed bitmaps of the sets bound each intersection from
above by bit counts, and only pairs that pass are intersected exactly.

A group of near copies meets under the same keys many times over. It is not expanded
into pairs: its members are compared with the first member of each key, and after the
components of those links are known, only members of a group that are still in different
components are compared, in blocks of bounded size. First by bitmaps alone: each member has
one place under each of its keys, and a place finds the likeliest pairs that would join the
components of its members. A pair is sent by the first place alone that both of its sets
have, so that once however many keys they share. Then, of what is still apart, all pairs of
a key are compared, by the sets of those whose bitmaps leave them a partner, and a block
sends the links that join its components. Either way a block sends
fewer pairs than it has members. The one pair of a key that two sets have is tested by
itself. No link between two components is lost, and pairs within one need no test.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import (
    Rolling, Words, doc_id_of, identified, map_batches, mixed, saved, signed, small_batches, sorted_tiles, split_join,
)
from stagewise.llm.components import components

#: Members of an undecided group that one block compares: those outside its main component, and all.
FEW, MANY = 256, 2048
#: Members of an undecided group that one place compares by their bitmaps.
PLACE = 1024
#: Bytes of sets that either side of a block holds where sets are compared.
BLOCK_BYTES = 16 << 20
#: Bits of a bitmap for each item: at eight, pairs that pass without a link are few.
BITS = 8
#: One document in so many shows which keys are hot; the tasks over which a hot key is spread.
SAMPLED, HOT_PARTS = 64, 64
_PAIRS = "a long, b long"


class Shingles:
    """Sorted distinct hashes of the k-word shingles of texts (A-Z lower-cased); a shorter
    text is one shingle, one without words has none."""

    def __init__(self, k: int) -> None:
        self.k, self.words, self.rolling = k, Words(lower=True), Rolling()

    def of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for _, bounds, hashes in self.words.blocks(texts):
            prefix = self.rolling.prefix(hashes)
            at = np.arange(max(0, len(hashes) - self.k + 1))
            every = self.rolling.spans(prefix, at, at + self.k)
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                if b - a >= self.k:
                    yield np.unique(every[a:b - self.k + 1])
                else:
                    yield self.rolling.spans(prefix, np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64)


def class_of(items: np.ndarray) -> int:
    """A hash that names the set."""
    return xxhash.xxh3_64_intdigest(items.tobytes(), len(items))


class Bands:
    """Size bands for links at ``percent``: sets link only within a band or with the next."""

    def __init__(self, percent: int) -> None:
        self.percent, self.low, self.tiles = percent, [1], []

    def band(self, n: int) -> int:
        while self.low[-1] <= n:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.low, n, "right")) - 1

    def tile(self, band: int) -> tuple[int, int]:
        """Number of hash classes of the tile of ``band`` and the next, and how many of a
        set's classes may be empty before its empty ones must be keys as well."""
        while len(self.tiles) <= band:
            b = len(self.tiles)
            self.band(self.low[b])
            high = self.low[b] * 100 // self.percent
            differences = (high + high * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)
            empty = (differences + 1) * math.exp(-self.low[b] / (differences + 1))
            spare = math.ceil(empty + 4 * math.sqrt(empty)) if differences else 0
            self.tiles.append((differences + 1 + spare, spare))
        return self.tiles[band]


def tile_keys(items: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys of a set in its two tiles.

    Of a tile's classes at most ``classes - 1 - spare`` differ between linked sets, so
    more than ``spare`` agree. A set with no more than ``spare`` empty classes therefore
    agrees in one that is not empty; others add keys for their empty classes.
    """
    out, weights = [], mixed(items ^ np.uint64(0xD6E8FEB86659FD93))
    band = bands.band(len(items))
    for tile in (band, band - 1):
        if tile < 0:
            continue
        classes, spare = bands.tile(tile)
        which = (mixed(items + np.uint64(tile)) >> np.uint64(32)) * np.uint64(classes) >> np.uint64(32)
        order = np.argsort(which, kind="stable")
        which = which[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1])
        sums, used = np.add.reduceat(weights[order], first), which[first]
        if classes - len(used) > spare:
            used = np.concatenate([used, np.setdiff1d(np.arange(classes, dtype=np.uint64), used)])
            sums = np.concatenate([sums, np.zeros(len(used) - len(sums), np.uint64)])
        out.append(mixed(mixed(sums + used) + np.uint64(tile)))
    return np.concatenate(out)


def bitmap(items: np.ndarray) -> bytes:
    """The set's hashed bitmap: a power of two of bits, at least 64 and ``BITS`` times the items."""
    width = max(64, 1 << (BITS * len(items) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(mixed(items) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) narrowed to ``words`` words."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def most_shared(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The largest intersection the bit counts allow; bitmaps and sizes broadcast against each other."""
    only_a = np.bitwise_count(a & ~b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(-1, dtype=np.int64)
    return np.minimum(na - only_a, nb - only_b)


def may_link(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether the bit counts allow a link."""
    return most_shared(a, na, b, nb) * (100 + percent) >= (na + nb) * percent


def _words(bits: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)


def _hot_keys(docs: DataFrame, k: int, percent: int) -> np.ndarray:
    """Keys that many sets of a sample have: more than a tenth of a task's mean rows. They
    are ten for each task at most, and serve to spread rows over tasks, nothing else."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = _key_rows(docs.where(f"pmod(th, {SAMPLED}) = 0"), k, percent).groupBy("key").agg(F.count("*").alias("n"))
    keys = sample.groupBy().agg(F.sum("n")).first()[0] or 0
    often = sample.where(F.col("n") >= max(8, keys / (10 * parts)))
    return np.sort(often.select("key").toArrow().column("key").to_numpy())


def _key_rows(docs: DataFrame, k: int, percent: int, hot: np.ndarray = np.zeros(0, np.int64)) -> DataFrame:
    """``key, node, part`` of every set; a task gives each set once however often it meets
    it. Part is 0 but for hot keys, whose sets are dealt into ``HOT_PARTS``."""
    def start():
        shingles, bands, seen = Shingles(k), Bands(percent), set()

        def work(batch: pa.RecordBatch):
            keys, nodes = [], []
            for items in shingles.of(batch.column("text")):
                node = class_of(items)
                if len(items) and node not in seen:
                    seen.add(node)
                    keys.append(tile_keys(items, bands))
                    nodes.append(np.full(len(keys[-1]), node, np.uint64))
            if keys:
                keys, nodes = np.concatenate(keys).view(np.int64), np.concatenate(nodes)
                parts = np.zeros(len(keys), np.int32)
                if len(hot):
                    often = hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] == keys
                    parts[often] = (mixed(nodes[often]) % np.uint64(HOT_PARTS)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys), signed(nodes), pa.array(parts)], names=["key", "node", "part"])
        return work
    return map_batches(docs, start, "key long, node long, part int")


def _meetings(keys: DataFrame) -> DataFrame:
    """``key, node, hub`` of the keys that several sets have; hub is the first met.

    A hot key is spread over tasks, where it has a hub in each. Tasks stream over their
    sorted rows.
    """
    def run(batches):
        key, node, part, hub = (np.zeros(0, np.int64) for _ in range(4))  # rows of a key that may go on
        for batch in batches:
            new = [batch.column(c).to_numpy() for c in ("key", "node", "part")]
            key, node, part = (np.concatenate([x, y]) for x, y in zip((key, node, part), new))
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
            key, node, part = key[fresh], node[fresh], part[fresh]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            starts = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
            hubs = node[starts]
            if len(hub) and key[0] == hub[0]:
                hubs[starts == 0] = hub[1]
            # The last row waits for the next batch. A hot key's rows count even where it is alone in a task.
            several = ~first | np.concatenate([~first[1:], [False]]) | (part > 0) | (hubs != node)
            out = several[:-1]
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[:-1][out]) for x in (key, node, hubs)], names=["key", "node", "hub"])
            if len(key) > 1 and key[-2] == key[-1] or hubs[-1] != node[-1]:
                hub = np.array([key[-1], hubs[-1]])
            else:
                hub = np.array([key[-1], node[-1]])
            key, node, part = key[-1:], node[-1:], part[-1:]
        if len(key):
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(hub[1:])], names=["key", "node", "hub"])
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartition(n, "key", "part").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(run, "key long, node long, hub long")


def _signatures(docs: DataFrame, k: int) -> DataFrame:
    """``node, n, bits, items`` of the given documents' sets."""
    def start():
        shingles = Shingles(k)

        def work(batch: pa.RecordBatch):
            sets = list(shingles.of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array([bitmap(s) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "n", "bits", "items"])
        return work
    return map_batches(docs, start, "node long, n long, bits binary, items binary")


def _both(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Pairs with ``column`` (and n) of both of their sets."""
    for side in "ab":
        pairs = split_join(pairs, sets.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col(column).alias(f"{column}_{side}")), [side])
    return pairs


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose bit counts allow a link."""
    def start():
        def work(batch: pa.RecordBatch):
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            bits = [batch.column(c).to_pylist() for c in ("bits_a", "bits_b")]
            width = np.array([[len(x) for x in side] for side in bits])
            passed = np.zeros(len(na), bool)
            for wa, wb in set(map(tuple, width.T.tolist())):
                rows = np.flatnonzero((width[0] == wa) & (width[1] == wb))
                a, b = (_folded(_words([side[i] for i in rows]), min(wa, wb) // 8) for side in bits)
                passed[rows] = may_link(a, na[rows], b, nb[rows], percent)
            yield batch.select(["a", "b"]).filter(pa.array(passed))
        return work
    return map_batches(_both(pairs, sets, "bits").select("a", "b", "na", "nb", "bits_a", "bits_b"), start, _PAIRS)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that link, by intersecting their sorted sets."""
    def start():
        def work(batch: pa.RecordBatch):
            passed = []
            for a, b in zip(batch.column("items_a"), batch.column("items_b")):
                a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (a, b))
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                same = int((b[at] == a).sum())
                passed.append(100 * same >= percent * (len(a) + len(b) - same))
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))
        return work
    return map_batches(_both(pairs, sets, "items").select("a", "b", "items_a", "items_b"), start, _PAIRS)


def spanning(left: np.ndarray, right: np.ndarray, score: np.ndarray, accept: Callable[[int], bool] | None = None) -> list[int]:
    """The edges, best first, that join components not joined yet; ``accept`` tests an edge."""
    names, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b, label = flat[:len(left)], flat[len(left):], np.arange(len(names))
    chosen, rest = [], np.argsort(-score, kind="stable")
    while len(rest):
        rest = rest[label[a[rest]] != label[b[rest]]]
        some, rest = rest[:256], rest[256:]
        for i in some.tolist():
            x, y = label[a[i]], label[b[i]]
            if x != y and (accept is None or accept(i)):
                label[label == max(x, y)] = min(x, y)
                chosen.append(i)
    return chosen


def candidates(table: pa.Table, percent: int, place: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's pairs of rows of different components that bit counts allow to link, and how likely.
    In a ``place`` each member has one row, so that the few are compared with each other too."""
    few, root, n = (table.column(c).to_numpy() for c in ("few", "root", "n"))
    bits = table.column("bits").to_pylist()
    words, found = np.array([len(x) for x in bits]), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for wa in np.unique(words):
        for wb in (wa // 2, wa, wa * 2):
            rows, columns = np.flatnonzero(few & (words == wa)), np.flatnonzero((place | ~few) & (words == wb))
            if not len(rows) or not len(columns):
                continue
            a, b = (_folded(_words([bits[i] for i in at]), min(wa, wb) // 8) for at in (rows, columns))
            step = max(1, (1 << 20) // (len(columns) * a.shape[1]))
            for s in range(0, len(rows), step):
                part = rows[s:s + step]
                total = n[part][:, None] + n[columns][None]
                most = most_shared(a[s:s + step, None], n[part][:, None], b[None], n[columns][None])
                apart = (root[part][:, None] != root[columns][None]) & (~few[columns][None] | (part[:, None] < columns[None]))
                x, y = np.nonzero((most * (100 + percent) >= total * percent) & apart)
                found.append((part[x], columns[y], most[x, y] / total[x, y]))
    return tuple(np.concatenate(part) for part in zip(*found))


def block_edges(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's ``candidates`` those that would join components, the likeliest first; where
    the block has ``items``, only true links."""
    node, root = (table.column(c).to_numpy() for c in ("node", "root"))
    items = table.column("items").to_pylist() if "items" in table.schema.names else None
    x, y, score = candidates(table, percent)

    def linked(i: int) -> bool:
        one, other = (np.frombuffer(items[side[i]], np.uint64) for side in (x, y))
        same = int((other[np.minimum(np.searchsorted(other, one), len(other) - 1)] == one).sum())
        return 100 * same >= percent * (len(one) + len(other) - same)
    chosen = np.array(spanning(root[x], root[y], score, None if items is None else linked), np.int64)
    return node[x[chosen]], node[y[chosen]]


def place_edges(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a place's ``candidates`` those that would join components, the likeliest first, without
    the pairs whose sets meet in an earlier place too (``before``).

    Of equally likely pairs the order is that of their nodes, the same everywhere. So a pair that
    an earlier place does not choose is joined there by pairs before it in that order, and what
    all places send joins the same components as without leaving out any."""
    node, root = (table.column(c).to_numpy() for c in ("node", "root"))
    x, y, score = candidates(table, percent, place=True)
    least_first = np.lexsort((np.maximum(node[x], node[y]), np.minimum(node[x], node[y])))
    x, y, score = x[least_first], y[least_first], score[least_first]
    chosen = np.array(spanning(root[x], root[y], score), np.int64)
    x, y = x[chosen], y[chosen]
    before = table.column("before").combine_chunks()
    ends, places = before.offsets.to_numpy().astype(np.int64), before.values.to_numpy().astype(np.int64) & 0xFFFFFFFF
    both = []
    for side in (x, y):
        length = ends[side + 1] - ends[side]
        at = np.arange(length.sum()) + np.repeat(ends[side] - np.cumsum(length) + length, length)
        both.append(np.repeat(np.arange(len(side)), length) << 32 | places[at])
    both = np.sort(np.concatenate(both))
    first = np.ones(len(x), bool)
    first[both[1:][both[1:] == both[:-1]] >> 32] = False
    return node[x[first]], node[y[first]]


def involved(table: pa.Table, percent: int) -> tuple[np.ndarray, ...]:
    """The rows of a block that are in one of its ``candidates``."""
    x, y, _ = candidates(table, percent)
    rows = np.unique(np.concatenate([x, y]))
    return tuple(table.column(c).to_numpy()[rows] for c in ("key", "i", "j", "few", "node", "root"))


def _members(met: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, root`` of the members of every key."""
    return split_join(met.select("key", "node"), roots, ["node"], "left").select(
        "key", "node", F.coalesce("root", "node").alias("root"))


def _open_groups(members: DataFrame) -> DataFrame:
    """The keys with members of several components, one for equal sets of members."""
    parts = members.groupBy("key", "root").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(node))").alias("members"), F.min("node").alias("least"))
    groups = parts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"),
                                      F.sum("n").alias("all"), F.count("*").alias("parts"), F.expr("bit_xor(members)").alias("members"),
                                      F.min("least").alias("a"), F.max("least").alias("b")).where("parts > 1")
    return saved(groups.dropDuplicates(["members", "all"]).drop("members", "parts"), "jaccard-groups")


def _placed(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """``place, few, before, node, root, n, bits``: one row for each key of each member. A key
    of many members has several places, into which it deals them in an order of its own, so that
    others meet under another key. ``before`` has half of each hash of the set's lesser places;
    halves equal by chance leave a pair to the comparison by sets."""
    slot = F.pmod(F.xxhash64("node", "key"), F.ceil(F.col("all") / F.lit(PLACE)))
    at = open_.select("node", "root", F.xxhash64("key", slot).alias("place"), F.expr("root <> main").alias("few"))
    own = (at.groupBy("node", "root").agg(F.array_sort(F.collect_list(F.struct("place", "few"))).alias("at"))
           .withColumn("half", F.transform("at.place", lambda place: F.shiftright(place, 32).cast("int"))))
    each = F.transform("at", lambda x, i: F.struct(x["place"].alias("place"), x["few"].alias("few"), F.slice("half", F.lit(1), i).alias("before")))
    return own.join(sets.select("node", "n", "bits"), "node").select(F.inline(each), "node", "root", "n", "bits")


def _undecided(members: DataFrame, groups: DataFrame, sets: DataFrame, percent: int, tested: DataFrame | None) -> DataFrame:
    """Pairs that join members of a key in different components: with ``tested`` the likeliest
    ones by their bitmaps, which need a test, and the pairs of keys with two members that are
    not among the tested ones; without it links. (Once the former have been tested, every key
    with two members has had its pair tested.)"""
    exact = tested is None
    if not exact:
        two = groups.where("all = 2").select("a", "b").join(tested, ["a", "b"], "left_anti")
    open_ = split_join(members, groups.where("all > 2").select("key", "main", "most", "all"), ["key"])
    least_first = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if not exact:
        found = sorted_tiles(_placed(open_, sets), ["place"], lambda table: place_edges(table, percent), _PAIRS)
        return found.select(*least_first).union(_bounded(two, sets, percent)).distinct()
    # Sets of a tile are about as large as one another, so their greatest size tells how many fit.
    open_ = saved(split_join(open_, sets.select("node", "n"), ["node"]), "jaccard-open")
    open_ = split_join(open_, open_.groupBy("key").agg(F.max("n").alias("largest")), ["key"]).drop("n")
    fit = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (F.col("largest") * 8)))
    few_of, many_of = F.least(F.lit(FEW), fit), F.least(F.lit(MANY), fit)
    open_ = open_.withColumn("rows", F.ceil((F.col("all") - F.col("most")) / few_of).cast("int")).withColumn("columns", F.ceil(F.col("all") / many_of).cast("int"))
    slot = lambda n: F.pmod(F.xxhash64("node", F.lit(1)), F.col(n)).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda few, i, j: F.struct(F.lit(few).alias("few"), i.alias("i"), j.alias("j"))
    few = F.transform(each("columns"), lambda j: place(True, slot("rows"), j))
    many = F.transform(each("rows"), lambda i: place(False, i, slot("columns")))
    dealt = open_.select("key", "node", "root", F.inline(F.when(F.expr("root <> main"), F.concat(few, many)).otherwise(many)))
    blocks = split_join(dealt, sets.select("node", "n", "bits"), ["node"]).select("key", "i", "j", "few", "node", "root", "n", "bits")
    # Sets are sent for rows alone that bit counts leave a partner.
    rows = saved(sorted_tiles(blocks, ["key", "i", "j"], lambda table: involved(table, percent),
                              "key long, i int, j int, few boolean, node long, root long"), "jaccard-involved")
    full = split_join(rows, sets.select("node", "n", "bits", "items"), ["node"])
    return sorted_tiles(full, ["key", "i", "j"], lambda table: block_edges(table, percent), _PAIRS).select(*least_first).distinct()


def jaccard_components(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    """Components of documents whose shingle sets' Jaccard index is ``percent`` or more.

    Returns per row: did, th (see ``identified``), n_shingles and component_id, the
    least doc_id reachable by links. Null and empty texts have no shingles and link with
    nothing; equal sets link; repeated ids and rows are kept; null ids come into a
    component's id only if it has no other. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = identified(docs)

    def start():
        shingles = Shingles(shingle)

        def work(batch: pa.RecordBatch):
            sets = list(shingles.of(batch.column("text")))
            nodes = np.array([class_of(s) for s in sets], np.uint64).view(np.int64)
            sizes = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("did"), batch.column("th"), pa.array(sizes), pa.array(nodes, mask=sizes == 0)],
                                             names=["did", "th", "n_shingles", "node"])
        return work
    rows = saved(map_batches(docs, start, "did long, th long, n_shingles long, node long"), "jaccard-sets")
    met = saved(_meetings(_key_rows(docs, shingle, percent, _hot_keys(docs, shingle, percent))), "jaccard-meetings")
    by_node = met.where("node <> hub")
    pairs = (by_node.groupBy("node").agg(F.min("hub").alias("lo"), F.max("hub").alias("hi"))
             .select("node", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("hub"))
             .union(met.groupBy("key").agg(F.min("hub").alias("node"), F.max("hub").alias("hub")).where("node <> hub").select("node", "hub"))
             .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    pairs = saved(pairs, "jaccard-pairs")
    # A task also gives its last row and those of hot keys, which may be alone; alone they need no set.
    shared = met.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("key")
    at = rows.where("node is not null").groupBy("node").agg(F.min(F.struct("did", "th")).alias("at"))
    wanted = at.join(split_join(met, shared, ["key"]).select("node").distinct(), "node").select("node", "at.did", "at.th")
    sets = saved(_signatures(docs.join(wanted, ["did", "th"]).dropDuplicates(["node"]), shingle), "jaccard-signatures")
    links = saved(_linked(_bounded(pairs, sets, percent), sets, percent), "jaccard-links")
    roots = components(links, "jaccard-components")
    # The likeliest pairs mostly join components; what is left apart is then compared by its
    # sets, so that no link is missed.
    members = _members(met, roots)
    groups = _open_groups(members)
    for tested in (pairs, None):
        if groups.isEmpty():
            break
        # Saved between its steps: the driver plans anew after each shuffle of a plan, and keeps the
        # figures of each time, so that its memory grows with the square of a plan's shuffles.
        more = saved(_undecided(members, groups, sets, percent, tested), "jaccard-likely")
        if tested is not None and not more.isEmpty():
            more = saved(_linked(more, sets, percent), "jaccard-links")
        if not more.isEmpty():
            links = links.union(more)
            roots = components(links, "jaccard-components")
            members = _members(met, roots)
            groups = _open_groups(members) if tested is not None else groups
    rooted = split_join(rows.where("node is not null"), roots, ["node"], "left").select(
        "did", "th", "n_shingles", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min(doc_id_of("did")).alias("component_id"))
    return (split_join(rooted, least, ["root"]).select("did", "th", "n_shingles", "component_id")
            .union(rows.where("node is null").select("did", "th", "n_shingles", doc_id_of("did"))))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    done = jaccard_components(spark.read.parquet(f"{folder}/documents.parquet"))
    return done.select(doc_id_of("did").alias("doc_id"), "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, md5(array_to_string(w[i:i + 2], ' ')) AS x FROM (
  SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
link AS MATERIALIZED (SELECT a, b FROM (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.r <> b.r GROUP BY ALL) p
  JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (r) JOIN (SELECT a AS r, min(e.doc_id) AS component_id FROM reach JOIN d e ON e.r = b GROUP BY a) c USING (r)
"""
