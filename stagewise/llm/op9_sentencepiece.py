"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are cut where no piece can reach across, and those parts that are
new to the task are concatenated and indexed by a suffix array (sorted suffixes, cut at
the longest piece). Every piece of the vocabulary is binary-searched for its range of
occurrences; the occurrences are edges from their first to their last position. Sorted
by position they are relaxed from left to right: of the edges that end at a position,
the one is kept whose piece may follow the last piece of the prefix before it. For a
merge-based model two pieces may follow each other when merging their joined text
gives just them again, and a sequence all of whose neighbours may follow each other is
the merge result itself, so the ids are those of the merge rules.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import kept_in_process, map_batches, small_batches, with_fields

#: Words whose ids a task remembers, and characters indexed by one suffix array.
MEMORY, INDEXED = 400_000, 250_000
#: Slots of the table of pairs that may follow each other, as a power of two.
SLOT_BITS = 21
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def model_path() -> str:
    """The public model's place; any other path may be given to the operators instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = message[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, message[i:i + size]
        i += size


class Pieces:
    """A merge model with byte fallback: its pieces, encoder and decoder."""

    def __init__(self, model: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        prefix, spec = True, {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
            elif field == 2:
                kind = dict(_fields(value)).get(3, 1)
            elif field == 3:
                spec = dict(_fields(value))
        if kind != 2 or spec.get(1) != b"identity" or spec.get(2) or spec.get(4, 1):
            raise ValueError("only merge models without normalisation are supported")
        self.prefix = bool(spec.get(3, prefix))
        self.ids = {p: i for i, (p, _, t) in enumerate(self.pieces) if t == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        self.scores = [s for _, s, _ in self.pieces]
        self.raw = [b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(SPACE, " ").encode()
                    for p, _, t in self.pieces]
        self.longest = max(map(len, self.ids))
        self.sought = np.array(list(self.ids), dtype=f"U{self.longest}")
        self.beyond = np.array([p[:-1] + chr(ord(p[-1]) + 1) for p in self.ids], dtype=f"U{self.longest}")
        self.sought_ids = np.array(list(self.ids.values()), np.int64)
        self.lengths = np.array([len(p) for p in self.ids], np.int64)
        inner = any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids)
        after = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalpha()}
        ends = "".join(re.escape(c) for c in ",.;:!?()" if c not in after)
        words = f"{SPACE}*[^\\W\\d_]+(?=[{ends}])|" if ends else ""
        self.part = re.compile("(?s).+" if inner else f"{words}{SPACE}*[^{SPACE}\\n]+|{SPACE}+|\\n")
        self.by_words = self.prefix and not inner
        self.follows: dict[int, bool] = {}
        self.pairs, self.allowed = np.full(1 << SLOT_BITS, -1), np.zeros(1 << SLOT_BITS, bool)
        self.known_parts: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The merge rules applied as such: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best = max(((self.scores[i], -k) for k in range(len(parts) - 1)
                        if (i := self.ids.get(parts[k] + parts[k + 1])) is not None), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def may_follow(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may stand after ``before`` (-1: at the start)."""
        key = before << 20 | piece
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > MEMORY:
                self.follows.clear()
            pair = [self.pieces[i][0] for i in (before, piece) if i >= 0]
            # Pieces that are their own merge result stay apart unless something merges across.
            apart = before >= 0 and self.may_follow(-1, before) and self.may_follow(-1, piece) and not any(
                pair[0][i:] + pair[1][:j] in self.ids for i in range(len(pair[0])) for j in range(1, len(pair[1]) + 1))
            known = self.follows[key] = apart or self.merged("".join(pair)) == pair
        return known

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and id of every piece's occurrence in ``text``."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        present = np.unique(points[points > 0])
        if len(present) < 254:  # one byte per character
            points, sought, beyond, lengths, codes = self._narrowed(points, present)
        else:
            sought, beyond, lengths, codes = self.sought, self.beyond, self.lengths, self.sought_ids
        padded = np.concatenate([points, np.zeros(self.longest, points.dtype)])
        tails = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[:len(points)]
        tails = np.ascontiguousarray(tails).view(f"{'S' if points.itemsize == 1 else 'U'}{self.longest}").ravel()
        suffixes = np.argsort(tails, kind="stable")
        tails = tails[suffixes]
        low, high = np.searchsorted(tails, sought), np.searchsorted(tails, beyond)
        count = high - low
        which = np.repeat(np.arange(len(low)), count)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        start = suffixes[low[which] + nth]
        end = start + lengths[which]
        return start, end, codes[which]

    def _narrowed(self, points: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, ...]:
        """The text and the pieces that it may hold with its characters numbered from 1."""
        table = self.sought.view(np.uint32).reshape(len(self.sought), -1)
        at = np.minimum(np.searchsorted(present, table), len(present) - 1)
        known = (present[at] == table) | (table == 0)
        some = np.flatnonzero(known.all(axis=1))
        narrow = np.where(table[some] == 0, 0, at[some] + 1).astype(np.uint8)
        lengths = self.lengths[some]
        beyond = narrow.copy()
        beyond[np.arange(len(some)), lengths - 1] += 1
        text = np.where(points == 0, 0, np.searchsorted(present, points) + 1).astype(np.uint8)
        kind = f"S{self.longest}"
        return text, np.ascontiguousarray(narrow).view(kind).ravel(), np.ascontiguousarray(beyond).view(kind).ravel(), lengths, self.sought_ids[some]

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, as the bytes of an int32 array."""
        out = []
        i = 0
        while i < len(parts):
            j, size = i, 0
            while j < len(parts) and (j == i or size + len(parts[j]) < INDEXED):
                size += len(parts[j]) + 1
                j += 1
            out += self._relaxed(parts[i:j])
            i = j
        return out

    def _may_follow(self, keys: np.ndarray) -> np.ndarray:
        """``may_follow`` for many pairs, by a table with one slot for several pairs; only
        pairs that their slot doesn't hold are looked up or worked out one by one."""
        slots = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        allowed, missing = self.allowed[slots], np.flatnonzero(self.pairs[slots] != keys)
        if len(missing):
            new, at = np.unique(keys[missing], return_inverse=True)
            found = np.array([self.may_follow((k >> 20) - 1, k & 0xFFFFF) for k in new.tolist()])
            allowed[missing] = found[at]
            self.pairs[slots[missing]] = keys[missing]
            # Of pairs with one slot any may be held: the flag is written from the pair that is.
            held = np.searchsorted(new, self.pairs[slots[missing]])
            self.allowed[slots[missing]] = found[held]
        return allowed

    def _relaxed(self, parts: list[str]) -> list[bytes]:
        """Relax the edges of all parts together, in order of their ends within the parts."""
        text = "\0".join(parts)
        sizes = np.array([len(p) for p in parts])
        begins = np.cumsum(sizes + 1) - sizes - 1
        start, end, piece = self.edges(text)
        rank = end - begins[np.searchsorted(begins, start, "right") - 1]
        order = np.argsort(rank, kind="stable")
        start, end, piece, rank = start[order], end[order], piece[order], rank[order]
        # The last piece of each prefix: -1 at the start of a part or after a character that is no piece.
        last, back = np.full(len(text) + 2, -1), np.arange(-1, len(text) + 1)
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(rank)) + 1, [len(rank)]])
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            allowed = self._may_follow((last[start[a:b]] + 1) << 20 | piece[a:b])
            ends = end[a:b][allowed]
            last[ends], back[ends] = piece[a:b][allowed], start[a:b][allowed]
        # Walk back from the ends of all parts at once; a character that is no piece is ~position.
        at, which = begins + sizes, np.arange(len(parts))
        owners, codes = [], []
        while len(which):
            owners.append(which)
            codes.append(np.where(last[at] >= 0, last[at], -at))
            at = back[at]
            on = at > begins[which]
            at, which = at[on], which[on]
        step = np.repeat(np.arange(len(owners)), [len(x) for x in owners])
        owners, codes = np.concatenate(owners), np.concatenate(codes)
        order = np.lexsort((-step, owners))
        owners, codes = owners[order], codes[order]
        raw, cuts = codes.astype(np.int32).tobytes(), (np.searchsorted(owners, np.arange(len(parts) + 1)) * 4).tolist()
        out = [raw[x:y] for x, y in zip(cuts, cuts[1:])]
        for i in set(owners[codes < 0].tolist()):
            mixed = []
            for code in np.frombuffer(out[i], np.int32).tolist():
                mixed += [code] if code >= 0 else [self.bytes[b] for b in text[-code - 1].encode()]
            out[i] = np.array(mixed, np.int32).tobytes()
        return out

    def parts_of(self, text: str) -> list[str]:
        """The parts of a text in which spaces are already the space symbol."""
        return self.part.findall(text)

    def encode(self, texts: list[str], known: dict[str, bytes] | None = None) -> list[np.ndarray]:
        """The ids of each text; ``known`` remembers words across calls.

        Texts with single spaces are looked up word by word, others as one word each.
        """
        known = {} if known is None else known
        if len(known) > MEMORY:  # the short ones are those that come again
            short = {word: ids for word, ids in known.items() if len(word) <= 7}
            known.clear()
            if len(short) < MEMORY // 2:
                known.update(short)
        cut = [[] if not text else text.split(" ") if self.by_words and "  " not in text and SPACE not in text
               and text[0] != " " and text[-1] != " " else [text] for text in texts]
        new = list(set().union(*cut).difference(known))
        first = SPACE if self.prefix else ""
        parts = [self.parts_of(first + word.replace(" ", SPACE)) for word in new]
        coded = self.known_parts
        if len(coded) > MEMORY // 2:
            coded.clear()
        distinct = list(set().union(*parts).difference(coded))
        coded.update(zip(distinct, self.encode_parts(distinct)))
        known.update((word, b"".join([coded[p] for p in own])) for word, own in zip(new, parts))
        out = [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in cut]
        for word in [w for w in new if len(w) > 100]:
            del known[word]
        for part in [p for p in distinct if len(p) > 100]:
            del coded[part]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; broken bytes become replacement characters."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _model(path: str | None) -> bytes:
    return Path(path or model_path()).read_bytes()  # a vocabulary file beside the driver, below 1 MB


def encode_texts(df: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """Add ``ids`` and ``round_trip`` (decoding them gives the text again) to ``df``.

    Null texts have null ids and a null round trip, empty texts no ids. A text that
    holds the space symbol itself decodes to a space there, so it does not return.
    Columns of these names are replaced; other columns and all rows are kept.
    """
    small_batches(df.sparkSession)
    model = _model(path)
    df = df.drop("ids", "round_trip")
    schema = with_fields(df, "ids array<int>, round_trip boolean")

    def start():
        pieces, known = kept_in_process(model, lambda: (Pieces(model), {}))

        def work(batch: pa.RecordBatch):
            texts = batch.column(text).to_pylist()
            coded = pieces.encode([t or "" for t in texts], known)
            same = pa.array([None if t is None else pieces.decode(c) == t for t, c in zip(texts, coded)], pa.bool_())
            bounds = np.zeros(len(texts) + 1, np.int32)
            np.cumsum([len(c) for c in coded], out=bounds[1:])
            flat = pa.array(np.concatenate(coded) if coded else np.zeros(0, np.int32))
            gaps = pa.array(bounds, mask=np.array([t is None for t in texts] + [False])) if None in texts else pa.array(bounds)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(gaps, flat), same], names=[*batch.schema.names, "ids", "round_trip"])
        return work
    return map_batches(df, start, schema, keeps=True)


def decode_ids(df: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of ``ids`` (null for null), to ``df``."""
    small_batches(df.sparkSession)
    model = _model(path)
    df = df.drop("decoded")

    def start():
        pieces, _ = kept_in_process(model, lambda: (Pieces(model), {}))

        def work(batch: pa.RecordBatch):
            texts = [None if x is None else pieces.decode(np.array(x, np.int32)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])
        return work
    return map_batches(df, start, with_fields(df, "decoded string"), keeps=True)


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, their number, and whether decoding them gives the text."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return encode_texts(docs).select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "round_trip")
