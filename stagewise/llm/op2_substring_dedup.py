"""Substring dedup in the manner of a relative Lempel-Ziv parse.

Every document is factored against an index of the whole corpus. The factors begin at
content-defined places: of each 35-word window the least hash of its 12-word grams (the
anchor) names the phrase that the window lies in, so equal windows always lie in phrases
with equal anchors and meet in one block of the index (a hash partition). A phrase that
recurs as a whole is one long factor. Where phrases share their anchor but differ, a
factor ends inside them, and such boundary phrases are compared window by window.
Adjoining factors make up the duplicate spans.

The greedy parse against every block in turn, as usually written, would read each
document once per block, which is quadratic in the corpus; routing by anchors lets each
phrase meet only the blocks that can hold its windows. The spans found are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import (
    Rolling, Words, doc_id_of, identified, map_batches, saved, signed, small_batches, split_join,
)

#: Words of a window, and of the grams whose least hash is its anchor. A phrase has at
#: most WINDOW - GRAM + 1 windows, so that a long holds one bit for each.
WINDOW, GRAM = 35, 12
_PHRASES = "did long, th long, start int, n_windows int, anchor long, phrase long"
_WINDOWS = "anchor long, phrase long, at int, window long"
_PARSED = "did long, th long, n_words long, kept string, spans array<struct<start:int,end:int>>"


def phrase_runs(grams: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each phrase and the position of its anchor."""
    width = window - gram + 1
    places = sliding_window_view(grams, width).argmin(axis=1) + np.arange(len(grams) - width + 1)
    first = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1])
    last = np.concatenate([first[1:] - 1, [len(places) - 1]])
    return first, last, places[first]


def phrases(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The phrases of every ``identified`` document of at least ``window`` words."""
    def start():
        words, rolling = Words(), Rolling()

        def work(batch: pa.RecordBatch):
            rows, firsts, counts, anchors, bodies = [], [], [], [], []
            for begin, bounds, hashes in words.blocks(batch.column("text")):
                prefix = rolling.prefix(hashes)
                at = np.arange(max(0, len(hashes) - gram + 1))
                every = rolling.spans(prefix, at, at + gram)
                for i in np.flatnonzero(np.diff(bounds) >= window).tolist():
                    a, b = int(bounds[i]), int(bounds[i + 1])
                    grams = every[a:b - gram + 1]
                    first, last, place = phrase_runs(grams, window, gram)
                    rows.append(np.full(len(first), begin + i))
                    firsts.append(first)
                    counts.append(last - first + 1)
                    anchors.append(grams[place])
                    bodies.append(rolling.spans(prefix, a + first, a + last + window) + (place - first).astype(np.uint64))
            if rows:
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("did").take(row), batch.column("th").take(row),
                     pa.array(np.concatenate(firsts).astype(np.int32)), pa.array(np.concatenate(counts).astype(np.int32)),
                     signed(np.concatenate(anchors)), signed(np.concatenate(bodies))],
                    names=["did", "th", "start", "n_windows", "anchor", "phrase"])
        return work
    return map_batches(docs, start, _PHRASES)


def phrase_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hashes of the windows of the listed phrases; ``docs`` has ``text`` and ``listed``."""
    def start():
        words, rolling = Words(), Rolling()

        def work(batch: pa.RecordBatch):
            out = [[], [], [], []]
            listed = batch.column("listed")
            flat, bounds = listed.flatten(), listed.offsets.to_numpy()
            bounds = bounds - bounds[0]
            first, count = (flat.field(k).to_numpy().astype(np.int64) for k in ("start", "n_windows"))
            anchor, phrase = (flat.field(k).to_numpy() for k in ("anchor", "phrase"))
            for row, places, hashes in words.blocks(batch.column("text")):
                prefix = rolling.prefix(hashes)
                a, b = bounds[row], bounds[row + len(places) - 1]
                which = np.repeat(np.arange(a, b), count[a:b])
                at = np.arange(len(which)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b])
                offset = np.repeat(places[:-1], np.diff(bounds[row:row + len(places)]))
                begin = first[which] + at + offset[which - a]
                for column, values in zip(out, (anchor[which], phrase[which], at, rolling.spans(prefix, begin, begin + window))):
                    column.append(values)
            anchor, phrase, at, hashed = (np.concatenate(x) for x in out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(phrase), pa.array(at.astype(np.int32)), signed(hashed)],
                names=["anchor", "phrase", "at", "window"])
        return work
    return map_batches(docs, start, _WINDOWS)


def factors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``did, th, factors``: the recurring windows of each document that has any.

    A factor holds the phrase's first window, its number of windows and a mask with a
    bit for each window that starts anywhere else too.
    """
    found = phrases(docs, window, gram)
    shared = (found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("phrase").alias("lo"), F.max("phrase").alias("hi"))
              .where("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("differ")))
    met = saved(split_join(found, shared, ["anchor"]), "substring-phrases")
    distinct = met.groupBy("anchor", "phrase").agg(
        F.count("*").alias("n"), F.first("differ").alias("differ"),
        F.min(F.struct("did", "th", "start", "n_windows")).alias("at"))
    whole = distinct.where("n > 1").select("anchor", "phrase", F.lit(-1).cast("long").alias("mask"))
    listed = (distinct.where("differ").groupBy("at.did", "at.th")
              .agg(F.collect_list(F.struct("at.start", "at.n_windows", "anchor", "phrase")).alias("listed")))
    windows = saved(phrase_windows(docs.join(listed, ["did", "th"]), window), "substring-windows")
    again = windows.groupBy("anchor", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    partly = (split_join(windows, again, ["anchor", "window"]).groupBy("anchor", "phrase")
              .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask")))
    masks = whole.union(partly).groupBy("anchor", "phrase").agg(F.bit_or("mask").alias("mask"))
    return (split_join(met, masks, ["anchor", "phrase"]).groupBy("did", "th")
            .agg(F.collect_set(F.struct("start", "n_windows", "mask")).alias("factors")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Remove every word covered by a window of words that also starts anywhere else.

    Returns per row of ``docs``: did (the id), th, n_words, kept (the words left, joined
    by one space) and spans (of removed words). Windows are judged on the input. Null
    and empty texts have no words; texts shorter than a window lose nothing; exact
    copies lose all their windows; repeated rows are copies. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = identified(docs)
    joined = docs.join(factors(docs, window, gram), ["did", "th"], "left")

    def start():
        def work(batch: pa.RecordBatch):
            listed = batch.column("factors")
            flat, bounds = listed.flatten(), listed.offsets.to_numpy()
            bounds = bounds - bounds[0]
            first, count, mask = (flat.field(k).to_numpy().astype(np.int64) for k in ("start", "n_windows", "mask"))
            n_words, kept, spans = [], [], []
            for text, a, b in zip(batch.column("text"), bounds, bounds[1:]):
                words = text.as_py().split()
                n_words.append(len(words))
                ranges = []
                if b > a:
                    which = np.repeat(np.arange(a, b), count[a:b])
                    at = np.arange(len(which)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b])
                    begins = (first[which] + at)[(mask[which] >> at) & 1 == 1]
                    steps = np.bincount(begins, minlength=len(words) + 1) - np.bincount(begins + window, minlength=len(words) + 1)
                    covered = np.concatenate([[False], np.cumsum(steps[:len(words)]) > 0, [False]])
                    edges = np.flatnonzero(np.diff(covered)).tolist()
                    ranges = list(zip(edges[::2], edges[1::2]))
                    left = list(zip([0, *edges[1::2]], [*edges[::2], len(words)]))
                    words = [w for x, y in left for w in words[x:y]]
                kept.append(b" ".join(words).decode())
                spans.append([{"start": x, "end": y} for x, y in ranges])
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("did"), batch.column("th"), pa.array(n_words, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, span)],
                names=["did", "th", "n_words", "kept", "spans"])
        return work
    empty = F.expr("cast(array() as array<struct<start:int,n_windows:int,mask:bigint>>)")
    return map_batches(joined.withColumn("factors", F.coalesce("factors", empty)), start, _PARSED)


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return done.select(
        doc_id_of("did").alias("doc_id"), "n_words",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
win AS (SELECT r, i, sha256(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM win SEMI JOIN again USING (s)),
lost AS (SELECT r, count(*) AS n, list(p) AS ps FROM gone GROUP BY r),
word AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""
