"""Benchmark decontamination with one Aho-Corasick automaton over item windows."""

from __future__ import annotations

import re
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import doc_id_of, identified, map_batches, saved, small_batches

WINDOW = 13
#: Windows held by one automaton, about; more are matched in several scans.
AUTOMATON_WINDOWS = 200_000
#: Windows of an item in one batch of rows.
CUT_ROWS = 10_000
#: Bytes of words: digits, letters (lower-cased) and all of the non-ASCII; the rest separates.
_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
FOUND = ("did long, th long, n_words long, n_hit long, items array<string>, "
         "word_spans array<struct<start:int,end:int>>, byte_spans array<struct<start:int,end:int>>")


def words_of(text: bytes) -> list[bytes]:
    """The normalised words of a text."""
    return text.translate(_WORDS).split()


def item_windows(items: list[tuple[str, bytes]], window: int = WINDOW) -> dict[str, list[str]]:
    """Item ids by window text; a shorter item is one window, one without words none."""
    out: dict[str, list[str]] = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            ids = out.setdefault(b" ".join(words[i:i + window]).decode("utf-8", "replace"), [])
            if item not in ids:
                ids.append(item)
    return out


def automaton(windows: dict[str, list[str]]) -> ahocorasick.Automaton:
    """The automaton over the windows, each between spaces, so that words match whole."""
    machine = ahocorasick.Automaton()
    for text, ids in windows.items():
        machine.add_word(f" {text} ", (len(text) + 2, text.count(" ") + 1, ids))
    machine.make_automaton()
    return machine


def scan(text: bytes, machine: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged spans of hit words, ids of the items that occur."""
    words = words_of(text)
    if not words:
        return 0, [], set()
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    spans, ids, at, counted = [], set(), 0, 0
    for end, (length, n, own) in machine.iter(line) if len(machine) else ():
        start = end - length + 1
        counted += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
        at = start
        spans.append((counted, counted + n))
        ids.update(own)
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return len(words), merged, ids


def found_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hits of each document: counts, item ids, and spans by word and by original byte.

    ``docs`` is ``identified``. Windows are cut in tasks and dealt into groups of about
    ``AUTOMATON_WINDOWS`` by their hash, whatever item they come from; the driver holds one
    group at a time, which is broadcast, and documents are scanned once for each.
    """
    spark = docs.sparkSession
    small_batches(spark)
    listed = items.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))

    def cut():
        def work(batch: pa.RecordBatch):
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                windows = list(item_windows([(item, text)], window))
                for at in range(0, len(windows), CUT_ROWS):
                    some = windows[at:at + CUT_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([item] * len(some), pa.string())], names=["window", "item"])
        return work
    windows = map_batches(listed, cut, "window string, item string").distinct()
    parts = max(1, -(-windows.count() // AUTOMATON_WINDOWS))
    if parts > 1:
        windows = saved(windows, "item-windows")

    def group(part: int) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        own = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(parts)) == part).toArrow()
        for text, item in zip(own.column("window").to_pylist(), own.column("item").to_pylist()):
            found.setdefault(text, []).append(item)
        return found

    def make(shared):
        def start():
            machine = automaton(shared.value)

            def work(batch: pa.RecordBatch):
                n_words, n_hit, ids, spans, places = [], [], [], [], []
                for text in batch.column("text").to_pylist():
                    n, hit, own = scan(text, machine)
                    n_words.append(n)
                    n_hit.append(sum(b - a for a, b in hit))
                    ids.append(sorted(own))
                    spans.append([{"start": a, "end": b} for a, b in hit])
                    original = [m.span() for m in _WORD.finditer(text)] if hit else []
                    places.append([{"start": original[a][0], "end": original[b - 1][1]} for a, b in hit])
                span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("did"), batch.column("th"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array(ids, pa.list_(pa.string())), pa.array(spans, span), pa.array(places, span)],
                    names=["did", "th", "n_words", "n_hit", "items", "word_spans", "byte_spans"])
            return work
        return start

    send = lambda part: make(spark.sparkContext.broadcast(group(part)))
    if parts == 1:
        return map_batches(docs, send(0), FOUND)
    # Several automata: the spans of a document are merged again; equal documents have equal ones.
    scans = [saved(map_batches(docs, send(part), FOUND).dropDuplicates(["did", "th"]), "item-hits") for part in range(parts)]
    every = reduce(DataFrame.union, scans)
    merge = """aggregate(array_sort(flatten(collect_list({0}))), cast(array() as array<struct<start:int,end:int>>), (m, s) ->
      if(size(m) > 0 and s.start <= element_at(m, -1).end + {1}, concat(slice(m, 1, size(m) - 1),
        array(named_struct('start', element_at(m, -1).start, 'end', greatest(s.end, element_at(m, -1).end)))), concat(m, array(s))))"""
    merged = every.groupBy("did", "th").agg(
        F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.expr(merge.format("word_spans", 0)).alias("word_spans"), F.expr(merge.format("byte_spans", 0)).alias("byte_spans"))
    merged = merged.withColumn("n_hit", F.expr("aggregate(word_spans, 0L, (n, s) -> n + s.end - s.start)"))
    return docs.select("did", "th").join(merged, ["did", "th"]).select("did", "th", "n_words", "n_hit", "items", "word_spans", "byte_spans")


def decontamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and are clean; a document is contaminated when
    one word in twenty or more lies in an item's window. Items that are null or have no
    words match nothing; repeated items count once per id. Rows are kept one for one.
    """
    found = found_windows(identified(docs), items)
    ids = F.array_sort("items")
    return found.select(
        doc_id_of("did").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return decontamination(read("documents"), read("benchmark"))


_SPLIT = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SPLIT} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_SPLIT} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
iw AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS k, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
m AS (SELECT r, i, dw.k, item FROM dw JOIN iw ON dw.s = iw.s AND dw.k = iw.k),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
