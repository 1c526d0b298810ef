"""Quality rules by distribution divergence.

Two histograms of a document, of its character classes and of the common words of a
language, are compared with those of each language's reference by Jensen-Shannon
distance (base 2, so 0 to 1). References come from the corpus itself: a language is a
value of ``lang`` with a hundredth of all words at least (so there are 100 at most), a
common word one that makes up a thousandth of its language's words (1,000 at most), both
counted over all rows; the frequencies are counted over distinct texts, so that groups of
copies have no say. A document is kept if some language fits in both histograms; a
histogram of too few characters or words is not judged, and shorter ones may stray farther.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import Rolling, Words, doc_id_of, map_batches, saved, signed, small_batches

#: A language has one word in so many of all, a common word one in so many of its language.
LANGUAGE_SHARE, WORD_SHARE = 100, 1000
#: Characters and words below which a histogram is not judged.
MIN_CHARS, MIN_WORDS = 500, 80
#: Greatest distances from a reference, of character classes and of common words, for long texts.
MAX_CLASSES, MAX_WORDS = 0.15, 0.3
#: What n characters or words are allowed besides, over sqrt(n): samples stray that much by chance.
CLASS_SLACK, WORD_SLACK = 2.5, 1.5
#: Base rules: fewest words, and per cent of words in repeated three-word windows.
FEWEST, REPEATED = 50, 50

# Classes: lower, upper, digit, other punctuation, symbol, blank, control, then characters of
# two, three and four UTF-8 bytes, counted by their first byte; last the bytes that follow it.
CLASSES = 10
SYMBOLS = b"#*$%&|<>"
_CLASS = np.full(256, CLASSES, np.uint8)
_CLASS[:128], _CLASS[192:224], _CLASS[224:240], _CLASS[240:] = 3, 7, 8, 9
_CLASS[[*range(32), 127]], _CLASS[[32, *range(9, 14)]] = 6, 5
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[list(SYMBOLS)] = 0, 1, 2, 4
_CHUNK = 1 << 20
_BLANKS = b" \t\n\x0b\x0c\r"


def class_counts(data: np.ndarray) -> np.ndarray:
    """Characters of each class in UTF-8 bytes."""
    return sum((np.bincount(_CLASS[data[i:i + _CHUNK]], minlength=CLASSES + 1)[:CLASSES] for i in range(0, len(data), _CHUNK)),
               np.zeros(CLASSES, np.int64))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def words_in_repeats(windows: np.ndarray, width: int) -> int:
    """Words covered by windows (one hash for each start) that occur more than once."""
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(windows) + width - 1, bool)
    for i in range(width):
        covered[i:i + len(windows)] |= again
    return int(covered.sum())


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` to the distribution ``q``."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / middle), 0) + np.where(q > 0, q * np.log2(q / middle), 0)
    return np.round(np.sqrt(np.maximum(parts.sum(-1) / 2, 0)), 9)


def _common_words(docs: DataFrame) -> DataFrame:
    """``lang, word`` (its hash) of each language's common words."""
    def start():
        words = Words()

        def work(batch: pa.RecordBatch):
            langs = batch.column("lang").to_pylist()
            counted = {}
            for first, bounds, hashes in words.blocks(batch.column("text")):
                for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                    if langs[first + i] is not None and b > a:
                        counted.setdefault(langs[first + i], []).append(hashes[a:b])
                for lang, parts in counted.items():
                    word, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(word)), signed(word), pa.array(n)], names=["lang", "word", "n"])
                counted.clear()
        return work
    counts = saved(map_batches(docs.select("lang", "text"), start, "lang string, word long, n long").groupBy("lang", "word")
                   .agg(F.sum("n").alias("n")), "quality-words")
    every = counts.agg(F.sum("n")).first()[0] or 0
    large = counts.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") * LANGUAGE_SHARE >= every)
    # At most LANGUAGE_SHARE rows.
    return counts.join(F.broadcast(large.select("lang", "total")), "lang").where(F.col("n") * WORD_SHARE >= F.col("total")).select("lang", "word")


def _measures(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Base measures and both histograms of each document, the words' as ``at, n`` of those
    of the sorted ``vocabulary`` that it has."""
    def start():
        words, rolling = Words(), Rolling()

        def work(batch: pa.RecordBatch):
            texts = batch.column("text")
            ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            classes = np.array([class_counts(data[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())])
            lines = [repeated_lines(data[a:b].tobytes()) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            n_words, repeats, at, counts = [], [], [], []
            for _, bounds, hashes in words.blocks(texts):
                prefix = rolling.prefix(hashes)
                start = np.arange(max(0, len(hashes) - 2))
                windows = rolling.spans(prefix, start, start + 3)
                place = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
                known = vocabulary[place] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                    n_words.append(b - a)
                    repeats.append(words_in_repeats(windows[a:b - 2], 3) if b - a > 2 else 0)
                    found, n = np.unique(place[a:b][known[a:b]], return_counts=True)
                    at.append(found.astype(np.int32))
                    counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("did"), batch.column("lang"), batch.column("th"), pa.array(n_words, pa.int64()),
                 pa.array(classes[:, [i for i in range(CLASSES) if i != 5]].sum(1)), pa.array(classes[:, 4]), pa.array(lines, pa.int64()),
                 pa.array(repeats, pa.int64()), pa.array(list(classes), pa.list_(pa.int64())),
                 pa.array(at, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["did", "lang", "th", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "at", "n"])
        return work
    return map_batches(docs, start, "did long, lang string, th long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                    "n_repeat_words long, classes array<long>, at array<int>, n array<long>")


def _references(measured: DataFrame, common: dict[str, np.ndarray]) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each language: name, class shares, places of its common words, their shares and then
    that of all other words, over its distinct texts. At most LANGUAGE_SHARE * WORD_SHARE rows
    reach the driver."""
    one = measured.where(F.col("lang").isin(list(common))).groupBy("lang", "th").agg(
        F.first("n_words").alias("n_words"), F.first("classes").alias("classes"), F.first(F.struct("at", "n")).alias("words"))
    # Bins: places of words, then below zero the classes (-1 - class) and all words (-1 - CLASSES).
    bins = F.concat(F.col("words.at"), F.array(*[F.lit(-1 - c) for c in range(CLASSES + 1)]))
    sizes = F.concat(F.col("words.n"), F.col("classes"), F.array("n_words"))
    sums = one.select("lang", F.explode(F.arrays_zip(bins.alias("bin"), sizes.alias("n"))).alias("x")).groupBy("lang", "x.bin").agg(F.sum("x.n").alias("n"))
    mine = [F.when(F.col("lang") == lang, F.col("bin").isin(places.tolist())) for lang, places in common.items()]
    found = {lang: {} for lang in common}
    for row in sums.where((F.col("bin") < 0) | F.coalesce(*mine)).collect() if common else []:
        found[row.lang][row.bin] = row.n
    out = []
    for lang, sums_of in sorted(found.items()):
        classes = np.array([sums_of.get(-1 - c, 0) for c in range(CLASSES)], float)
        words = np.array([sums_of.get(p, 0) for p in common[lang].tolist()], float)
        total = sums_of.get(-1 - CLASSES, 0)
        if total:
            out.append((lang, classes / classes.sum(), common[lang], np.append(words, total - words.sum()) / total))
    return out


def judge_quality(docs: DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, max_classes: float = MAX_CLASSES,
                  max_words: float = MAX_WORDS) -> DataFrame:
    """Measures and verdict of each document.

    Returns per row: did, th (see ``base.identified``), n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, nearest (the language that fits best by the larger of its
    two distances), class_distance and word_distance to it (null where not judged),
    base_failed and kept. A null text has no words and fails; a null ``lang`` or a rare one
    adds to no reference, but its documents are judged by all of them; without any
    reference the base rules decide. Repeated rows and ids are kept; other columns are
    ignored. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("did"), F.col("lang").cast("string").alias("lang"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    words = _common_words(docs).toArrow()
    langs, hashes = np.array(words.column("lang").to_pylist(), object), words.column("word").to_numpy().view(np.uint64)
    vocabulary = np.unique(hashes)
    common = {lang: np.searchsorted(vocabulary, np.sort(hashes[langs == lang])) for lang in set(langs)}
    measured = saved(_measures(docs, vocabulary), "quality-measures")
    references = _references(measured, common)

    def start():
        def work(batch: pa.RecordBatch):
            n_words = batch.column("n_words").to_numpy()
            classes = np.array(batch.column("classes").to_pylist(), float)
            n_chars = classes.sum(1)
            counts = np.zeros((batch.num_rows, len(vocabulary) + 1))
            ends = np.diff(batch.column("at").offsets.to_numpy())
            counts[np.repeat(np.arange(batch.num_rows), ends), batch.column("at").flatten().to_numpy()] = batch.column("n").flatten().to_numpy()
            far = np.full((len(references), 2, batch.num_rows), np.nan)
            enough = n_chars >= max(1, min_chars), n_words >= max(1, min_words)
            for i, (_, by_class, places, by_word) in enumerate(references):
                of = counts[enough[1]][:, places]
                of = np.column_stack([of, n_words[enough[1]] - of.sum(1)]) / n_words[enough[1], None]
                far[i, 0, enough[0]] = divergence(classes[enough[0]] / n_chars[enough[0], None], by_class)
                far[i, 1, enough[1]] = divergence(of, by_word)
            most = [limit + slack / np.sqrt(np.maximum(n, 1)) for limit, slack, n in ((max_classes, CLASS_SLACK, n_chars), (max_words, WORD_SLACK, n_words))]
            fits = ~((far[:, 0] > most[0]) | (far[:, 1] > most[1]))
            base = (n_words < FEWEST) | (100 * batch.column("n_repeat_words").to_numpy() > REPEATED * n_words)
            kept = ~base & (fits.any(0) | (not references))
            best, rows = np.zeros(batch.num_rows, int), np.arange(batch.num_rows)
            if references:
                best = np.nan_to_num(far, nan=0.0).max(1).argmin(0)
            measure = lambda k: pa.array(far[best, k, rows] if references else np.full(len(rows), np.nan), from_pandas=True)
            names = [references[b][0] if references else None for b in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(columns).columns, pa.array(names, pa.string()), measure(0), measure(1), pa.array(base), pa.array(kept)],
                names=[*columns, "nearest", "class_distance", "word_distance", "base_failed", "kept"])
        return work
    columns = ["did", "th", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return map_batches(measured, start, ", ".join(f"{c} long" for c in columns)
                       + ", nearest string, class_distance double, word_distance double, base_failed boolean, kept boolean")


def op11_quality_divergence(spark: SparkSession, folder: str) -> DataFrame:
    done = judge_quality(spark.read.parquet(f"{folder}/documents.parquet"))
    return done.select(doc_id_of("did").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_COUNT = "length(regexp_replace(t, '{}', '', 'g'))::BIGINT"
_PATTERNS = (r"[^a-z]", r"[^A-Z]", r"[^0-9]", r"[^!-~]|[a-zA-Z0-9#*$%&|<>]", r"[^#*$%&|<>]", r"[^\x20\x09-\x0D]", r"[^\x00-\x08\x0E-\x1F\x7F]",
             r"[^\x{80}-\x{7FF}]", r"[^\x{800}-\x{FFFF}]", r"[^\x{10000}-\x{10FFFF}]")
_JS = ("round(sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + "
       "CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)), 9)")
SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT r, doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  [{", ".join(_COUNT.format(p) for p in _PATTERNS)}] AS c FROM d),
every AS MATERIALIZED (SELECT r, i, w[i] AS x, CASE WHEN i + 2 <= len(w) THEN md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END AS g
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM every WHERE g IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r),
line AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
counted AS MATERIALIZED (SELECT r, x, count(*) AS n FROM every GROUP BY r, x),
total AS (SELECT lang, sum(n) AS total FROM counted JOIN d USING (r) WHERE lang IS NOT NULL GROUP BY lang),
langs AS (SELECT lang, total FROM total WHERE total * {LANGUAGE_SHARE} >= (SELECT sum(total) FROM total)),
common AS MATERIALIZED (SELECT lang, x FROM (SELECT lang, x, sum(n) AS n FROM counted JOIN d USING (r) GROUP BY lang, x) JOIN langs USING (lang) WHERE n * {WORD_SHARE} >= total),
one AS MATERIALIZED (SELECT min(r) AS r, lang FROM d JOIN langs USING (lang) GROUP BY lang, t),
wordref AS (SELECT lang, x, sum(counted.n) / any_value(s) AS q FROM one JOIN counted USING (r) JOIN common USING (lang, x)
  JOIN (SELECT lang, sum(len(w)) AS s FROM one JOIN w USING (r, lang) GROUP BY lang) USING (lang) GROUP BY lang, x),
classref AS (SELECT lang, k, sum(c[k]) / sum(list_sum(c)) AS q FROM one JOIN w USING (r, lang), (SELECT unnest(range(1, {CLASSES + 1})) AS k) GROUP BY lang, k),
classfar AS (SELECT r, lang, {_JS} AS far FROM (SELECT w.r, f.lang, c[k] / list_sum(c) AS p, q FROM w, classref f WHERE list_sum(c) >= {MIN_CHARS}) GROUP BY r, lang),
shares AS MATERIALIZED (SELECT w.r, f.lang, f.x, coalesce(counted.n, 0) / len(w) AS p, q FROM w CROSS JOIN wordref f LEFT JOIN counted ON counted.r = w.r AND counted.x = f.x WHERE len(w) >= {MIN_WORDS}),
wordfar AS (SELECT r, lang, {_JS} AS far FROM (SELECT r, lang, p, q FROM shares UNION ALL SELECT r, lang, greatest(0, 1 - sum(p)), 1 - sum(q) FROM shares GROUP BY r, lang) GROUP BY r, lang),
fits AS (SELECT w.r, bool_or(coalesce(a.far <= {MAX_CLASSES} + {CLASS_SLACK} / sqrt(list_sum(c)), true) AND coalesce(b.far <= {MAX_WORDS} + {WORD_SLACK} / sqrt(len(w)), true)) AS ok FROM w CROSS JOIN (SELECT DISTINCT lang FROM classref) l
  LEFT JOIN classfar a ON a.r = w.r AND a.lang = l.lang LEFT JOIN wordfar b ON b.r = w.r AND b.lang = l.lang GROUP BY w.r),
base AS (SELECT r, doc_id, len(w)::BIGINT AS n_words, (list_sum(c) - c[6])::BIGINT AS word_chars, c[5]::BIGINT AS n_symbols,
  coalesce(line.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN line USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {FEWEST} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed,
  NOT (n_words < {FEWEST} OR 100 * n_repeat_words > {REPEATED} * n_words) AND coalesce(ok, true) AS kept FROM base LEFT JOIN fits USING (r)
"""
