"""Benchmark decontamination: CGK embeddings of windows, bit-sampling LSH, exact edit verification.

**Embedding.** The CGK random walk copies a sequence into a longer one: at step j it writes the current
symbol and moves on by a random bit that depends on j and the symbol alone. Two sequences with few edits
fall back into step after each edit, so a small edit distance becomes a small Hamming distance. Symbols
are characters of the lower-cased words (runs of letters, digits and non-ASCII characters) joined by spaces,
so a typo costs the walk what it costs the verification.

**Windows.** Every second character of every text starts a window; so does every character of every benchmark item as
long as the walk stays inside the item. The walk's steps come from the item's size (:func:`steps_of`), and items are
covered window by window to their full size: an edited copy is found through any of its windows.

**LSH.** A repetition samples some of the walk's steps, some three steps apart, and hashes their symbols to a key;
equal keys meet. All repetitions sample the same walk. How many an item's size class needs comes from
``max_edits``: copies of the class's items with so many edits, spread evenly (replaced characters, mixed edits, one
in each word) and at random places, are made, and repetitions are added until ``recall`` of each kind meet at their place
(:func:`repetitions_for`). Unedited copies always meet.

**Verification.** Whatever meets names an item and the place where its copy should start, and every such
place is verified: the exact edit distance between the item and the best-fitting stretch of that place
must be at most ``max_edits`` of the item's length in characters. Equal stretches are seen at once. Otherwise
the least edits of the item's pieces, one after the other, add up to a lower bound, and a place is left
as soon as that passes the allowance; only what is left is compared as a whole (Sellers' recurrence on bit
vectors, many places at a time, or one by one on long integers where items are long and places few).

**Scale.** Texts stay in their partition: there is no shuffle of texts at all. The items' keys travel to
the tasks in blocks of at most ``block_words`` benchmark words; a larger benchmark costs more passes, each
written before the next, and not more memory.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import clean_strings, col, fresh, mix, text_slices, utf8_parts, word_hashes, written

STEPS = (30, 24, 16, 8, 4, 2, 1)
SAMPLES = (10, 7, 5, 3, 2, 1, 1)
#: Most repetitions; short items, whose few windows may all be hit, can need them.
MOST_REPETITIONS = 16
_FILTER_BITS = 21
_PLACES = 1024
_STRETCH = 1 << 14
#: Every so many characters of a text start a window; of an item, every one.
_STRIDE = 2
_PIECE = 64
_SIMULATED = 48


def steps_of(chars: int) -> int:
    """Steps of the walk for an item of so many characters: two thirds of them at most."""
    return next(s for s in STEPS if s <= max(1, 2 * chars // 3))


def samples(steps: int) -> int:
    return SAMPLES[STEPS.index(steps)]


def repetitions(steps: int, recall: float, agreement: float) -> int:
    """Repetitions that find one of two clean windows with probability ``recall`` where ``agreement`` of the
    walk's positions are equal: the least that is taken."""
    return max(1, math.ceil(math.log(1 - recall) / (2 * math.log(1 - agreement ** samples(steps)))))


def _chosen(steps: int, rep: int) -> list[int]:
    """The sampled steps of a repetition: one of each of the walk's equal parts, evenly spaced in the first
    repetitions (a walk often writes a symbol twice), drawn in later ones."""
    part = steps / samples(steps)
    if rep < math.floor(part):
        return [int(part * k) + rep for k in range(samples(steps))]
    rng = np.random.default_rng([steps, rep])
    return [min(steps - 1, int(part * k + rng.integers(math.ceil(part)))) for k in range(samples(steps))]


def walks(h: np.ndarray, steps: int, reps: int, stride: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """(keys of each repetition, last place + 1) of the walk from every ``stride``-th symbol. Places past the last
    symbol read a zero symbol."""
    n = len(h)
    count = -(-n // stride)
    keys, last = [np.empty(count, np.uint64) for _ in range(reps)], np.empty(count, np.int64)
    chosen = [set(_chosen(steps, r)) for r in range(reps)]
    h = np.concatenate([h.astype(np.uint64), np.zeros(steps, np.uint64)])
    size = _STRETCH * stride
    for a in range(0, n, size):  # a stretch stays in the processor's cache through all steps
        m = min(size, n - a)
        symbols = mix(h[a:a + m + steps] + np.uint64(0x632BE59BD9B4E019))
        moves = (symbols >> np.uint64(32)).astype(np.uint32)
        pos = np.arange(0, m, stride)
        mine = [np.full(len(pos), steps * 64 + r, np.uint64) for r in range(reps)]
        for j in range(steps):
            sampled = [r for r in range(reps) if j in chosen[r]]
            if sampled:
                letter = symbols.take(pos, mode="clip")
                for r in sampled:
                    mine[r] *= np.uint64(0x9E3779B97F4A7C15)
                    mine[r] ^= letter
            if j < steps - 1:
                pos += ((moves >> np.uint32(j)) & np.uint32(1)).astype(np.int8).take(pos, mode="clip")
        out = slice(a // stride, a // stride + len(pos))
        for r in range(reps):
            keys[r][out] = mix(mine[r])
        last[out] = pos + (a + 1)
    return keys, last


def walk_keys(h: np.ndarray, steps: int, rep: int) -> tuple[np.ndarray, np.ndarray]:
    """(key of one repetition, last place + 1) of the walk from every symbol."""
    keys, last = walks(h, steps, rep + 1)
    return keys[rep], last


def _edited(text: np.ndarray, edits: int, kind: str, rng) -> tuple[np.ndarray, np.ndarray]:
    """A copy with ``edits`` edits, and where each of its characters stood."""
    n, letters = len(text), np.unique(text)
    places = np.arange(edits) * n // max(edits, 1) if kind != "random" else np.sort(rng.permutation(n)[:edits])
    if kind == "words":
        ends = np.append(np.flatnonzero(text == 32), n)
        places = ((np.append(0, ends[:-1] + 1) + ends) // 2)[:edits]
    out, at, todo = [], [], set(places.tolist())
    for i, c in enumerate(text.tolist()):
        how = 0 if kind in ("replaced", "words") else int(rng.integers(3))
        if i not in todo:
            out.append(c)
            at.append(i)
        elif how < 2:  # replaced, or doubled by another
            new = 0xFFFF if kind in ("replaced", "words") else int(rng.choice(letters))  # a letter that the item hasn't
            out += [new] if how == 0 else [c, new]
            at += [i] if how == 0 else [i, i]
    return np.array(out, np.uint32), np.array(at, np.int64)


def repetitions_for(items: list, steps: int, recall: float, max_edits: float) -> int:
    """Repetitions with which ``recall`` of the copies of these items (code points) with ``max_edits`` meet, for each
    kind of edits; ``MOST_REPETITIONS`` if none suffice."""
    rng = np.random.default_rng(steps)
    shown = [items[i] for i in np.linspace(0, len(items) - 1, min(_SIMULATED, len(items))).astype(int)]
    need = []
    for kind in ("replaced", "words", "mixed", "random"):
        first = []
        for x in shown:
            copy, at = _edited(x, math.floor(max_edits * len(x)), kind, rng)
            mine, end = walks(x, steps, MOST_REPETITIONS)
            theirs, their_end = walks(copy, steps, MOST_REPETITIONS, _STRIDE)
            rows, cols = np.flatnonzero(end <= len(x)), np.flatnonzero(their_end <= len(copy))
            near = np.abs(rows[:, None] - at[cols * _STRIDE]) <= 1  # a meeting at the place, not by chance elsewhere
            first.append(next((r + 1 for r in range(MOST_REPETITIONS)
                               if (near & (mine[r][rows][:, None] == theirs[r][cols])).any()), MOST_REPETITIONS + 1))
        # Few copies are made, so half of what may be missed is kept in reserve.
        need.append(int(np.sort(first)[math.ceil((1 + recall) / 2 * len(first)) - 1]))
    return min(max(need), MOST_REPETITIONS)


def _codes(chars: np.ndarray) -> np.ndarray:
    """Characters as numbers below 255. Some share one, which can only make strings more alike."""
    return ((chars ^ (chars >> np.uint32(7))) % np.uint32(251)).astype(np.uint8)


def piece_edits(pieces: np.ndarray, which: np.ndarray, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least edit distances of ``pieces[which]`` (rows of 64 codes) to ``codes[begins:ends]``, many places at a time."""
    one, top = np.uint64(1), np.uint64(63)
    masks = np.zeros((len(pieces), 256), np.uint64)
    for k in range(64):
        masks[np.arange(len(pieces)), pieces[:, k]] |= one << np.uint64(k)
    masks = masks.ravel()
    out = np.empty(len(which), np.int64)
    order = np.argsort(ends - begins, kind="stable")
    for a in range(0, len(order), _PLACES):
        part = order[a:a + _PLACES]
        n, row, end = len(part), which[part] * 256, ends[part]
        vp, vn = np.full(n, 2 ** 64 - 1, np.uint64), np.zeros(n, np.uint64)
        score = np.full(n, 64, np.int64)
        best = score.copy()
        at, shortest = begins[part], int((end - begins[part]).min())
        for j in range(int((end - begins[part]).max())):
            if j < shortest:
                eq = masks[row + codes[at + j]]
            else:  # past its end a place reads a code that matches nothing
                eq = masks[row + np.where(at + j < end, codes[np.minimum(at + j, len(codes) - 1)], 255)]
            xv = eq | vn
            xh = (((eq & vp) + vp) ^ vp) | eq
            hp, hn = vn | ~(xh | vp), vp & xh
            score += ((hp >> top) - (hn >> top)).view(np.int64)
            hp, hn = hp << one, hn << one
            vp, vn = hn | ~(xv | hp), hp & xv
            np.minimum(best, score, out=best)
        out[part] = best
    return out


def edit_distance(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to any stretch of ``text``, end of the first such stretch)."""
    m = len(pattern)
    if not m:
        return 0, 0
    full, top = (1 << m) - 1, 1 << (m - 1)
    masks: dict = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    vp, vn, score = full, 0, m
    best, end = m, 0
    for k, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | vn
        d0 = ((((x & vp) + vp) ^ vp) | x) & full
        hp, hn = (vn | ~(vp | d0)) & full, vp & d0
        score += (1 if hp & top else 0) - (1 if hn & top else 0)
        hp, hn = (hp << 1) & full, (hn << 1) & full
        vp, vn = (hn | ~(d0 | hp)) & full, hp & d0
        if score < best:
            best, end = score, k + 1
    return best, end


def plain_chars(low: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points of the words, a space after each; where each word starts, and the end)."""
    size = stops - starts
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(begin[-1], 32, np.uint8)
    of = np.repeat(np.arange(len(size)), size)
    inner = np.arange(len(of)) + of
    out[inner] = low[inner + (starts - begin[:-1])[of]]
    if not len(out) or out.max() < 0x80:
        return out.astype(np.uint32), begin
    place = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    return np.frombuffer(out.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), place[begin]


def least_edits(patterns: list, which: np.ndarray, chars: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """:func:`edit_distance` of ``patterns[which]`` to ``chars[begins:ends]``, for all places at a time."""
    out = np.zeros(len(which), np.int64)
    sizes = np.array([len(x) for x in patterns])
    order = np.lexsort((which, ends - begins, (sizes[which] + 63) // 64))
    one, a = np.uint64(1), 0
    while a < len(order):
        blocks = (int(sizes[which[order[a]]]) + 63) // 64
        part = order[a:a + _PLACES]
        part = part[(sizes[which[part]] + 63) // 64 == blocks]
        a += len(part)
        if len(part) < 3 * (blocks - 1):  # few places, long patterns: a column costs less on one long integer
            for x in part:
                out[x] = edit_distance("".join(map(chr, patterns[which[x]].tolist())), "".join(map(chr, chars[begins[x]:ends[x]].tolist())))[0]
            continue
        items, row = np.unique(which[part], return_inverse=True)
        alphabet = np.unique(np.concatenate([patterns[i] for i in items]))
        masks = np.zeros((blocks, len(items), len(alphabet) + 1), np.uint64)  # the last column matches nothing
        for r, i in enumerate(items):
            at = np.arange(len(patterns[i]))
            np.bitwise_or.at(masks, (at >> 6, r, np.searchsorted(alphabet, patterns[i])), one << (at & 63).astype(np.uint64))
        masks = masks.reshape(blocks, -1)
        width = int((ends - begins)[part].max())
        at = begins[part] + np.arange(width)[:, None]
        inside = at < ends[part]
        c = chars[np.where(inside, at, 0)]
        code = np.minimum(np.searchsorted(alphabet, c), len(alphabet) - 1)
        code = np.where(inside & (alphabet[code] == c), code, len(alphabet)) + row * (len(alphabet) + 1)
        n, top = len(part), ((sizes[which[part]] - 1) & 63).astype(np.uint64)
        vp, vn = [np.full(n, 2 ** 64 - 1, np.uint64) for _ in range(blocks)], [np.zeros(n, np.uint64) for _ in range(blocks)]
        score = sizes[which[part]].copy()
        best = score.copy()
        for j in range(width):
            up = down = np.zeros(n, np.uint64)
            for k in range(blocks):
                eq = masks[k][code[j]]
                xv = eq | vn[k]
                eq |= down
                xh = (((eq & vp[k]) + vp[k]) ^ vp[k]) | eq
                hp, hn = vn[k] | ~(xh | vp[k]), vp[k] & xh
                if k == blocks - 1:
                    score += ((hp >> top) & one).astype(np.int64) - ((hn >> top) & one).astype(np.int64)
                up2, down2 = hp >> np.uint64(63), hn >> np.uint64(63)
                hp, hn = (hp << one) | up, (hn << one) | down
                vp[k], vn[k] = hn | ~(xv | hp), hp & xv
                up, down = up2, down2
            np.minimum(best, score, out=best)
        out[part] = best
    return out


class Index:
    """Keys of a block of items, ready for lookups in a task."""

    def __init__(self, ids: list, texts: list, recall: float, agreement: float, max_edits: float = 0.2):
        arr = pa.array(texts, pa.large_string())
        h, off, starts, stops = word_hashes(arr)
        low, _ = utf8_parts(pc.utf8_lower(clean_strings(arr)))
        chars, begin = plain_chars(low, starts, stops)
        self.ids, self.max_edits = ids, max_edits
        self.plain = [chars[begin[off[i]]:max(begin[off[i]], begin[off[i + 1]] - 1)] for i in range(len(ids))]
        self.allowed = np.array([math.floor(max_edits * len(x)) for x in self.plain], np.int64)
        self.tables = []  # (steps, table of each repetition)
        classes: dict = {}
        for i, x in enumerate(self.plain):
            if len(x):
                # Without allowed edits a walk over the whole item meets equal ones only; one repetition does.
                classes.setdefault(steps_of(len(x)), []).append(i)
        for steps, mine in sorted(classes.items()):
            edited = [self.plain[i] for i in mine if self.allowed[i]]
            reps = max(repetitions(steps, recall, agreement), repetitions_for(edited, steps, recall, max_edits)) if edited else 1
            found: list = [[] for _ in range(min(reps, MOST_REPETITIONS))]
            for i in mine:
                keys, last = walks(self.plain[i], steps, len(found))
                ok = np.flatnonzero(last <= len(self.plain[i]))
                for r, k in enumerate(keys):
                    found[r].append((k[ok], i, ok))
            self.tables.append((steps, [self._table(f) for f in found]))

    @staticmethod
    def _table(found: list) -> tuple:
        """(keys in order, items, characters before the key's place, filter)."""
        k = np.concatenate([x[0] for x in found])
        item = np.concatenate([np.full(len(x[0]), x[1]) for x in found])
        place = np.concatenate([x[2] for x in found])
        order = np.argsort(k, kind="stable")
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[(k >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        return k[order], item[order], place[order], seen

    @staticmethod
    def _meet(k: np.ndarray, keys, item, place, seen):
        """(character of the meeting, character where the copy should start, item) of keys that meet."""
        maybe = np.flatnonzero(seen[(k >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        lo, hi = np.searchsorted(keys, k[maybe], "left"), np.searchsorted(keys, k[maybe], "right")
        n = hi - lo
        x = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        here = np.repeat(maybe, n) * _STRIDE
        return here, here - place[x], item[x]

    def candidates(self, chars: np.ndarray):
        """(a character of the copy, character where it should start, item) of all that meet."""
        for steps, tables in self.tables:
            for k, table in zip(walks(chars, steps, len(tables), _STRIDE)[0], tables):
                yield self._meet(k, *table)


def _places(index: Index, chars: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, item, least start, greatest start) of the places that meet; starts of one text and item that lie
    within the allowed edits of each other are one place."""
    got = [x for x in index.candidates(chars) if len(x[0])]
    if not got:
        return (np.zeros(0, np.int64),) * 4
    here, start, item = (np.concatenate(c).astype(np.int64) for c in zip(*got))
    t = np.searchsorted(first, here, "right") - 1
    order = np.lexsort((start, item, t))
    t, item, start = t[order], item[order], start[order]
    spot = start // np.maximum(index.allowed[item], 1)
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (item[1:] != item[:-1]) | (spot[1:] != spot[:-1])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(t)) - 1
    return t[a], item[a], start[a], start[b]


def _equal(index: Index, chars: np.ndarray, item: np.ndarray, start: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the item stands at ``start``, inside the text that has the characters from ``begin`` to ``end``."""
    sizes = np.array([len(x) for x in index.plain], np.int64)[item]
    flat, offset = np.concatenate(index.plain), np.cumsum([0] + [len(x) for x in index.plain])[item]
    ok = (start >= begin) & (start + sizes <= end)
    for part in np.linspace(0, 1, 9):  # a look at a few characters leaves few to compare
        rows = np.flatnonzero(ok)
        at = (part * (sizes[rows] - 1)).astype(np.int64)
        ok[rows] = chars[start[rows] + at] == flat[offset[rows] + at]
    for x in np.flatnonzero(ok):
        ok[x] = np.array_equal(chars[start[x]:start[x] + sizes[x]], index.plain[item[x]])
    return ok


def _edits(index: Index, chars: np.ndarray, item, low, high, begin, end) -> np.ndarray:
    """Least edits of each place, or more than its item allows: that the exact number is known only up to there."""
    allowed = index.allowed[item]
    sizes = np.array([len(x) for x in index.plain], np.int64)[item]
    out = np.full(len(item), 1 << 40, np.int64)
    lo, hi = np.maximum(low - allowed, begin), np.minimum(high + allowed + sizes, end)
    # A stretch shorter than the item by more than the allowed edits cannot hold a copy.
    open_, bound = np.flatnonzero((allowed > 0) & (hi - lo >= sizes - allowed)), np.zeros(len(item), np.int64)
    codes = _codes(chars)
    for k in range(8):  # pieces of 64 characters, an eighth of a longer item's
        rows = open_[sizes[open_] > (k + 1) * _PIECE]  # the rest is left to the whole comparison
        if not len(rows):
            break
        size = np.maximum(_PIECE, sizes[rows] // 8)
        a = np.maximum(lo[rows], low[rows] + k * size - allowed[rows])
        b = np.maximum(a, np.minimum(hi[rows], high[rows] + (k + 1) * size + allowed[rows]))
        for short in (True, False):
            some = np.flatnonzero((size == _PIECE) == short)
            if len(some):
                names, which = np.unique(item[rows[some]], return_inverse=True)
                step = [max(_PIECE, len(index.plain[i]) // 8) for i in names]
                pieces = [index.plain[i][k * p:(k + 1) * p] for i, p in zip(names, step)]
                bound[rows[some]] += (piece_edits(_codes(np.stack(pieces)), which, codes, a[some], b[some]) if short
                                      else least_edits(pieces, which, chars, a[some], b[some]))
        open_ = open_[bound[open_] <= allowed[open_]]
    out[open_] = least_edits(index.plain, item[open_], chars, lo[open_], hi[open_])
    return out


def find_items(texts: pa.Array, index: Index):
    """(text number, item number, edits) for each text and item whose copy it holds, least edits."""
    for a, b in text_slices(texts, 1 << 20):
        part = clean_strings(texts.slice(a, b - a))
        h, off, starts, stops = word_hashes(part)
        if not len(h) or not index.tables:
            continue
        low, _ = utf8_parts(pc.utf8_lower(part))
        chars, begin = plain_chars(low, starts, stops)
        first = begin[off]  # of each text, and the end
        t, item, least, most = _places(index, chars, first)
        edits = np.full(len(t), 1 << 40, np.int64)
        for start in (least, most):
            edits[_equal(index, chars, item, start, first[t], first[t + 1] - 1)] = 0
        # Too short for any edit: whole words must be equal.
        for x in np.flatnonzero((index.allowed[item] == 0) & (edits == 0)):
            s, e = int(least[x]), int(least[x]) + len(index.plain[item[x]])
            if not (chars[e] == 32 and (s == first[t[x]] or chars[s - 1] == 32)):
                edits[x] = 1 << 40
        rest = np.flatnonzero(edits > 0)
        edits[rest] = np.minimum(edits[rest], _edits(index, chars, item[rest], least[rest], most[rest], first[t[rest]], first[t[rest] + 1] - 1))
        best: dict = {}
        for x in np.flatnonzero(edits <= index.allowed[item]):
            key = (int(t[x]), int(item[x]))
            best[key] = min(best.get(key, 1 << 40), int(edits[x]))
        for (x, i), e in sorted(best.items()):
            yield a + x, i, e


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int, recall: float, agreement: float,
                max_edits: float):
    """Indexes over blocks of items of at most about ``block_words`` words, one in memory at a time."""
    ids, texts, size = [], [], 0
    items = benchmark.select(col(id_col).alias("i"), col(text_col).alias("t")).where("t is not null").orderBy("i", "t")
    for r in items.toLocalIterator():
        ids.append(r["i"])
        texts.append(r["t"])
        size += r["t"].count(" ") + 1
        if size >= block_words:
            yield Index(ids, texts, recall, agreement, max_edits)
            ids, texts, size = [], [], 0
    if ids:
        yield Index(ids, texts, recall, agreement, max_edits)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", max_edits: float = 0.2, recall: float = 0.9,
                 agreement: float = 0.92, block_words: int = 500_000) -> DataFrame:
    """(id, item id, item_chars, edits): one row per document row and benchmark item that it holds, edits
    being the least distance in characters after lower-casing and reducing both to words.

    Null or empty texts hold nothing, and null or wordless items match nothing. Null ids are carried;
    repeated rows each give their rows; an empty table or benchmark gives none. If both ids have one
    name, the item's gets a trailing underscore.
    """
    item_name = fresh([id_col], item_col)
    schema = (docs.select(col(id_col)).schema
              .add(item_name, benchmark.schema[item_col].dataType).add("item_chars", "long").add("edits", "long"))
    src = docs.select(col(id_col), col(text_col).alias(fresh([id_col], "text")))
    item_type = None
    out, last = None, None
    for index in item_blocks(benchmark, item_col, item_text, block_words, recall, agreement, max_edits):
        def run(batches, index=index):
            for batch in batches:
                t, i, e = [], [], []
                for a, b, c in find_items(batch.column(1), index):
                    t.append(a)
                    i.append(b)
                    e.append(c)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(t, pa.int64())), pa.array([index.ids[x] for x in i], item_type),
                     pa.array([len(index.plain[x]) for x in i], pa.int64()), pa.array(e, pa.int64())], names=schema.names)

        if last is not None:  # a block's matches are written before the next block's keys are made
            last = written(last, "decontaminate")
            out = last if out is None else out.unionByName(last)
        last = src.mapInArrow(run, schema)
    if last is None:
        return docs.sparkSession.createDataFrame([], schema)
    return last if out is None else out.unionByName(last)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text", max_edits: float = 0.2, recall: float = 0.9, agreement: float = 0.92,
                      block_words: int = 500_000) -> DataFrame:
    """The documents that hold no benchmark item, columns unchanged."""
    at, seen = docs.columns.index(text_col), False
    for index in item_blocks(benchmark, item_col, item_text, block_words, recall, agreement, max_edits):
        def run(batches, index=index):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for t, _, _ in find_items(batch.column(at), index):
                    keep[t] = False
                yield batch.filter(pa.array(keep))

        if seen:
            docs = written(docs, "decontaminate")
        docs, seen = docs.mapInArrow(run, docs.schema), True
    return docs
