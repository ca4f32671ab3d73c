"""Best-fit packing of token sequences by a configuration linear program.

**Tokens.** Texts are cut where pre-tokens of a byte-level tokenizer surely end (:func:`part_starts`); each
distinct part of a few megabytes of text is tokenised once by the given tokenizer, and its ids are put in
place of all its copies. Other tokenizers get whole texts.

**Program.** A configuration is a multiset of lengths that fits one sequence. The linear program covers the
histogram of lengths with as few configurations as possible; it has ``capacity`` rows, whatever the size of
the corpus, and is solved by multiplicative weights: every length has a price that falls as its pieces get
covered, a knapsack dynamic program prices configurations (the best for every length that must be part of
it), and all that come within ``slack`` of the best are raised together, by a share of the length's pieces.

**Rounding.** Fractional amounts are rounded along their running sum, never above the pieces that are
left; what remains of the histogram is packed by best fit, longest first, many equal sequences at a time.

**Placing.** Pieces are numbered within their length (a range shuffle by length and row, which splits a
hot length over many tasks, and one row of counts per file and length), and the number says which sequence
of which configuration holds the piece, at which place. The plan that travels with the tasks has at most
``rounds * capacity`` configurations.
"""

from __future__ import annotations

import itertools
import math
import os
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import clean_strings, col, fresh, text_slices, utf8_parts, with_row_id, written

_CACHED = 1 << 19


# -- tokens ----------------------------------------------------------------------------------------

def _kinds() -> np.ndarray:
    """0 letter, 1 digit, 2 sign, 3 apostrophe, 4 white space, 5 not ASCII."""
    kind = np.full(256, 2, np.uint8)
    kind[0x80:] = 5
    for a, b, k in (("0", "9", 1), ("A", "Z", 0), ("a", "z", 0), ("\t", "\r", 4), (" ", " ", 4), ("'", "'", 3)):
        kind[ord(a):ord(b) + 1] = k
    return kind


def part_starts(data: np.ndarray, offsets: np.ndarray, whole: list = ()) -> np.ndarray:
    """Where the parts of texts begin (UTF-8 bytes; every text's first byte, too): where a byte-level tokenizer's
    pre-tokens surely end. Those are runs of letters, of digits or of signs, with at most one space before, or
    runs of white space; an apostrophe may draw letters to it. Nothing else is cut next to characters that
    aren't ASCII, and the strings ``whole`` are not cut."""
    n = len(data)
    # Cuts between kinds: after letters, digits and signs if another kind follows, but white space keeps what follows it.
    cuts = np.zeros((7, 7), bool)
    cuts[:3, :5] = True
    cuts[[0, 1, 2], [0, 1, 2]] = False
    cuts[2, 3] = False  # signs and apostrophes are one run
    cuts[[3, 5], 4] = True
    kind = _kinds()[data]
    kind[white_ends(data)] = 6
    cut = np.zeros(n + 1, bool)
    if n > 1:
        cut[1:n] = cuts[kind[:-1], kind[1:]]
    text = data.tobytes() if whole else b""
    for w in whole:
        at = text.find(w)
        while at >= 0:
            cut[at + 1:at + len(w)] = False
            at = text.find(w, at + 1)
    cut[offsets] = True
    cut[n] = False
    return np.flatnonzero(cut)


def white_ends(data: np.ndarray) -> np.ndarray:
    """Bytes that end a white-space character of more than one byte."""
    end = np.zeros(len(data), bool)
    if len(data) > 1:
        end[1:] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
    if len(data) > 2:
        x, y, z = data[:-2], data[1:-1], data[2:]
        end[2:] |= ((x == 0xE1) & (y == 0x9A) & (z == 0x80) | (x == 0xE3) & (y == 0x80) & (z == 0x80)
                    | (x == 0xE2) & ((y == 0x80) & ((z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF)) | (y == 0x81) & (z == 0x9F)))
    return end


def worker_state(name: str, make):
    """``make()``, kept for later tasks of the same worker process (functions are sent to workers by value, so
    their module's globals are new in every task)."""
    state = sys.modules.setdefault("_tablemover_worker", types.ModuleType("_tablemover_worker")).__dict__
    if name not in state:
        state[name] = make()
    return state[name]


class Encoder:
    """Token ids of texts by a tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        pre, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder()
        self.cut = (self.tokenizer.normalizer is None and type(pre).__name__ == "ByteLevel" and pre.use_regex
                    and not pre.add_prefix_space and not any(t.lstrip or t.rstrip or t.single_word for t in added.values()))
        self.added_text = [t.content for t in added.values()]
        self.whole = [t.encode() for t in self.added_text]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # of each id; a byte is a character
        for token, i in vocabulary.items():
            self.bytes[i] = len(token.encode()) if i in added else len(token)

    def _new(self, parts: list) -> list:
        """Ids, as bytes, of parts that aren't known. Parts that begin with one space and end with another character can
        stand in a row as they could in a text, so they are tokenised together, and the sizes of the tokens say
        where each ends."""
        plain = [self.cut and len(p) > 1 and p[0] == " " and not p[1].isspace() and not p[-1].isspace()
                 and not any(w in p for w in self.added_text) for p in parts]
        out = [b""] * len(parts)
        rows = [k for k, x in enumerate(plain) if x]
        if rows:
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(parts[k] for k in rows)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(parts[k].encode()) for k in rows])
            at = np.searchsorted(np.cumsum(self.bytes[ids]), ends) + 1
            flat, a = ids.tobytes(), 0
            for k, b in zip(rows, (4 * at).tolist()):
                out[k], a = flat[a:b], b
        rows = [k for k, x in enumerate(plain) if not x]
        for k, e in zip(rows, self.tokenizer.encode_batch_fast([parts[k] for k in rows], add_special_tokens=False)):
            out[k] = np.array(e.ids, "<u4").tobytes()
        return out

    def _ids(self, parts: list) -> list:
        out = list(map(self.known.get, parts))
        rows = [k for k, x in enumerate(out) if x is None]
        new = self._new([parts[k] for k in rows])
        keep = max(0, _CACHED - len(self.known))  # the first are the frequent ones: they stay
        self.known.update(zip((parts[k] for k in rows[:keep]), new))
        for k, x in zip(rows, new):
            out[k] = x
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin, and the end)."""
        data, off = utf8_parts(clean_strings(texts))
        starts = part_starts(data, off, self.whole) if self.cut else np.unique(off[:-1][off[:-1] < len(data)])
        ends = np.concatenate([starts, [len(data)]]) if len(starts) else np.zeros(1, np.int64)
        parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data))
        coded = parts.dictionary_encode()
        which = coded.indices.to_numpy()
        cells = self._ids(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, cells), np.int64, len(cells)) // 4
        flat = np.frombuffer(b"".join(cells), "<u4")
        begin = np.cumsum(sizes) - sizes
        n = sizes[which]
        at = np.cumsum(n) - n
        ids = flat[np.repeat(begin[which] - at, n) + np.arange(n.sum())]
        total = np.concatenate([at, [n.sum()]])
        return ids, total[np.searchsorted(starts, off)]


def token_pieces(docs: DataFrame, id_cols: list[str], text_col: str, tokenizer: str, capacity: int = 2048,
                 end_id: int = 0) -> DataFrame:
    """The pieces of every row's text: ``id_cols``, ``piece`` (from 0), ``start`` (ids before it), ``length``
    and ``ids`` (unsigned little-endian 32-bit ids). A text's ids, ``end_id`` last, are one piece if they fit;
    longer ones are cut into pieces of ``capacity`` ids, of which the first may be shorter.

    A null text is an empty one, and has a piece of ``end_id`` alone. Null and repeated ids are carried,
    repeated rows each give their pieces, an empty table gives none; extra columns don't matter, and result
    names that clash with ``id_cols`` get a trailing underscore.
    """
    names = [fresh(id_cols, x) for x in ("piece", "start", "length", "ids")]
    src = docs.select(*[col(c) for c in id_cols], col(text_col).alias(fresh(id_cols, "text")))
    schema = docs.select(*[col(c) for c in id_cols]).schema
    for name, kind in zip(names, (IntegerType(), LongType(), LongType(), BinaryType())):
        schema = schema.add(name, kind)

    def run(batches):
        encoder = worker_state(tokenizer, lambda: Encoder(tokenizer))
        for batch in batches:
            for a, b in text_slices(batch.column(batch.num_columns - 1)):
                ids, off = encoder.encode(batch.column(batch.num_columns - 1).slice(a, b - a))
                whole = np.insert(ids, off[1:], np.uint32(end_id))
                size = np.diff(off) + 1
                pieces = -(-size // capacity)
                of = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = size - capacity * (pieces - 1)
                length = np.where(piece == 0, first[of], capacity)
                start = np.where(piece == 0, 0, first[of] + capacity * (piece - 1))
                ends = np.concatenate([[0], np.cumsum(length)]) * 4
                cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(of), [
                    None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(whole.astype("<u4")))])
                rows = batch.slice(a, b - a).select(list(range(batch.num_columns - 1))).take(pa.array(of))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), cells.cast(pa.binary())],
                    names=schema.names)

    return src.mapInArrow(run, schema)


# -- configurations --------------------------------------------------------------------------------

def knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each capacity from 0, and the length that it takes first (0: none). ``price[l]`` is the
    price of length l; lengths without pieces have a price below 0."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        v = best[c - 1::-1] + price[1:c + 1]  # v[l - 1]: length l and the best of what it leaves
        l = int(np.argmax(v))
        if v[l] > best[c - 1]:
            best[c], take[c] = v[l], l + 1
        else:
            best[c] = best[c - 1]
    return best, take


def _contents(take: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """For each of ``lengths``, the best configuration with it: a row of lengths, padded with 0."""
    last = np.maximum.accumulate(np.where(take > 0, np.arange(capacity + 1), 0))  # less room, same value
    out, left = [lengths], last[capacity - lengths]
    while (left > 0).any():
        out.append(take[left])
        left = last[left - take[left]]
    return np.sort(np.stack(out, axis=1), axis=1)[:, ::-1]


def solve(counts: np.ndarray, capacity: int, rounds: int = 64, slack: float = 0.02, rate: float = 1.0) -> dict:
    """Fractional amounts of configurations (tuples of lengths, longest first) that cover ``counts`` (pieces of
    each length, index 0 unused), by multiplicative weights."""
    lengths = np.flatnonzero(counts[:capacity])
    amounts: dict = {}
    if not len(lengths):
        return amounts
    demand = counts[lengths].astype(float)
    covered = np.zeros(len(lengths))
    place = np.full(capacity + 1, -1)
    place[lengths] = np.arange(len(lengths))
    for _ in range(rounds):
        price = np.full(capacity + 1, -1.0)
        price[lengths] = lengths * np.exp(-rate * (covered / demand - (covered / demand).min()))
        best, take = knapsack(price, capacity)
        value = price[lengths] + best[capacity - lengths]
        near = np.flatnonzero(value >= (1 - slack) * best[capacity])
        rows = _contents(take, lengths[near], capacity)
        kinds, first, many = np.unique(rows, axis=0, return_index=True, return_counts=True)
        for row, f, times in zip(kinds, first, many):
            row = row[row > 0]
            l, n = np.unique(row, return_counts=True)
            at = place[l]
            # A share of the pieces of the length that asked for it, at most a share of any length in it
            step = min(demand[place[lengths[near[f]]]] * times, (demand[at] / n).min()) / rounds
            covered[at] += step * n
            key = tuple(row.tolist())
            amounts[key] = amounts.get(key, 0.0) + step
    # Scaled so that the pieces that are covered the most are covered once.
    return {k: v / max((covered / demand).max(), 1e-300) for k, v in amounts.items()}


def best_fit(counts: np.ndarray, capacity: int) -> list:
    """(configuration, times): longest pieces first, each into the fullest sequence that has room."""
    room: dict = {}
    free = np.zeros(capacity + 1, bool)

    def put(left, config, times):
        room.setdefault(left, []).append((config, times))
        free[left] = True

    for l in np.flatnonzero(counts)[::-1].tolist():
        k = int(counts[l])
        while k:
            fits = np.flatnonzero(free[l:])
            if len(fits):
                left = int(fits[0]) + l
                config, times = room[left].pop()
                used = min(k, times)
                if times > used:
                    room[left].append((config, times - used))
                free[left] = bool(room[left])
                put(left - l, config + (l,), used)
                k -= used
            else:
                each = capacity // l
                full, k = divmod(k, each)
                if full:
                    put(capacity - l * each, (l,) * each, full)
                if k:
                    put(capacity - l * k, (l,) * k, 1)
                k = 0
    return [x for group in room.values() for x in group]


def plan(counts: np.ndarray, capacity: int, rounds: int = 64) -> list:
    """(configuration, times) whose lengths are exactly ``counts``."""
    left = counts.astype(np.int64).copy()
    out = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    total = 0.0
    for config, amount in sorted(solve(left, capacity, rounds).items(), key=lambda x: (-sum(x[0]), -x[1], x[0])):
        total, before = total + amount, math.floor(total)
        l, n = np.unique(config, return_counts=True)
        times = min(math.floor(total) - before, int((left[l] // n).min()))
        if times:
            left[l] -= times * n
            out.append((config, times))
    return out + best_fit(left, capacity)


# -- placing ---------------------------------------------------------------------------------------

class Places:
    """Where the pieces of a plan go: sequences are numbered configuration by configuration; the pieces of a
    length, numbered from 0, fill its slots in that order."""

    def __init__(self, configs: list, capacity: int):
        slots: list = []
        base = 0
        for config, times in configs:
            offset = 0
            for l, group in itertools.groupby(config):
                n = len(list(group))
                slots.append((l, times * n, n, base, offset))
                offset += l * n
            base += times
        slots.sort(key=lambda x: x[0])
        cells = np.array(slots, np.int64).reshape(-1, 5)
        self.length, self.n, self.base, self.offset = cells[:, 0], cells[:, 2], cells[:, 3], cells[:, 4]
        ends = np.cumsum(cells[:, 1])
        self.begin = ends - cells[:, 1]  # over all lengths
        self.first = np.searchsorted(self.length, np.arange(capacity + 2))
        self.total = np.concatenate([self.begin, ends[-1:]])[self.first]  # pieces of shorter lengths

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and numbers within the length."""
        at = self.total[length] + number
        k = np.searchsorted(self.begin, at, "right") - 1
        j = at - self.begin[k]
        return self.base[k] + j // self.n[k], self.offset[k] + j % self.n[k] * length


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = 2048, rounds: int = 64) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences of at most ``capacity`` tokens as the rounded
    program needs; the pieces of a sequence lie in it without gaps from 0.

    Lengths are from 1 to ``capacity``; others, or a null length, are an error. Repeated rows are pieces of
    their own, other columns travel with their row (nulls too), an empty frame gives an empty one, and result
    names that clash get a trailing underscore. ``pieces`` is read twice: write it first if it is dear.
    """
    spark = pieces.sparkSession
    sequence, offset = fresh(pieces.columns, "sequence_id"), fresh(pieces.columns, "offset")
    histogram = pieces.groupBy(col(length_col).cast("long").alias("l")).agg(F.count(F.lit(1)).alias("n"))
    odd = histogram.where("l is null or l < 1 or l > " + str(int(capacity))).first()
    if odd:
        raise ValueError(f"{odd['n']} pieces of length {odd['l']}; lengths must be from 1 to {capacity}")
    counts = np.zeros(capacity + 1, np.int64)
    for r in histogram.collect():  # at most ``capacity`` rows
        counts[r["l"]] = r["n"]
    places = spark.sparkContext.broadcast(Places(plan(counts, capacity, rounds), capacity)) if counts.any() else None

    named, row = with_row_id(pieces, "pack-rows")
    ordered = written(named.repartitionByRange(col(length_col), *[col(c) for c in row])
                      .sortWithinPartitions(col(length_col), *[col(c) for c in row]).select(*[col(c) for c in pieces.columns]), "pack-ordered")
    numbered, (file, place) = with_row_id(ordered, "pack-ordered")
    l, begin, first = (fresh(numbered.columns, c) for c in ("l", "begin", "first"))
    runs = numbered.groupBy(file, col(length_col).alias(l)).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias(first))
    before = Window.partitionBy(l).orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col(file), F.col(l), F.col(first), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(begin))
    # A file holds a range of lengths: one row per file and one per length at most.
    found = numbered.join(F.broadcast(runs.withColumnRenamed(file, file + "_")),
                          (F.col(file) == F.col(file + "_")) & (col(length_col) == F.col(l)))
    number = fresh(numbered.columns, "number")
    found = found.select(*[col(c) for c in pieces.columns], (F.col(place) - F.col(first) + F.col(begin)).alias(number))
    at = pieces.columns.index(length_col)
    schema = StructType([*pieces.schema.fields, StructField(sequence, LongType()), StructField(offset, LongType())])

    def run(batches):
        for b in batches:
            ids, offsets = places.value.of(b.column(at).to_numpy().astype(np.int64), b.column(b.num_columns - 1).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids), pa.array(offsets)], names=schema.names)

    return found.mapInArrow(run, schema)


def sequences(packed: DataFrame, ids_col: str = "ids", sequence_col: str = "sequence_id", offset_col: str = "offset") -> DataFrame:
    """(sequence_id, n_tokens, ids): the token ids of every sequence, its pieces in order. A sequence is bounded by its
    capacity, so gathering it is."""
    parts = F.array_sort(F.collect_list(F.struct(col(offset_col).alias("o"), col(ids_col).alias("i"))))
    whole = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["i"]))
    return (packed.groupBy(col(sequence_col).alias("sequence_id")).agg(whole.alias("ids"))
            .select("sequence_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids"))
