"""The spans of many documents against many passages, all with all: bounds of whole arrays of spans, the matcher itself only where they are met.

A span's ratio with a passage is at most what its bounds allow: lengths, characters in
common, and the longest common subsequence, by words of bits for many spans at a time.
Of a text of 200 characters or more the matcher begins blocks at rare characters only, so
blocks are few, and runs of three in common bound it too.  No bound leaves a span out that
reaches the best ratio known.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: bins of characters, the last for all but a text's most frequent; bins of runs of three
LETTERS, RUNS = 64, 4096
#: the matcher takes frequent characters of texts of this length for noise
LONG = 200
#: spans whose counts are held at a time, and that are compared at a time; bits of a word, beside one for the carry
BLOCK, BATCH, BITS = 4096, 8192, 63
#: words of masks that are held at a time
MASKS = 1 << 22
_LOW, _BITS, _ONE = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _runs(ids: np.ndarray) -> np.ndarray:
    """A bin for every run of three characters."""
    x = ids.astype(np.uint32)
    mixed = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA6B) + x[2:] * np.uint32(0xC2B2AE35)) if len(x) > 2 else x[:0]
    return (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(20)


class Spans:
    """All spans of one to ``most`` sentences of some documents, given by their cleaned sentences, in order of their lengths."""

    def __init__(self, documents: Sequence[Sequence[str]], most: int = 4):
        pieces = [p for d in documents for p in d]
        filled = np.array([bool(p) for p in pieces], bool)
        self.text = " ".join(p for p in pieces if p)
        codes = _codes(self.text)
        counts = np.bincount(codes, minlength=1)
        known = np.flatnonzero(counts)
        known = known[np.argsort(-counts[known], kind="stable")]
        self.places = np.full(len(counts), len(known), np.int32)
        self.places[known] = np.arange(len(known))
        self.absent = len(known)
        # one more at the end, which nothing equals
        self.ids = np.append(self.places[codes], self.absent).astype(np.int32)
        self.runs = _runs(self.ids[:-1])
        # the rarer half of the text by itself: characters from ``cut`` on, and how many of them lie before each place
        held = np.cumsum(counts[known])
        self.cut = min(int(np.searchsorted(held, held[-1] / 2)) + 1 if len(held) else 0, LETTERS - 1)
        rare = self.ids >= self.cut
        self.rare_ids, self.before = self.ids[rare], np.concatenate(([0], np.cumsum(rare)))
        n = len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(sizes + filled) - filled
        begins = ends - sizes
        at = np.arange(n)
        # the first filled sentence at or behind each, and the last at or before
        ahead = np.minimum.accumulate(np.where(filled, at, n)[::-1])[::-1]
        back = np.maximum.accumulate(np.where(filled, at, -1)) if n else at
        owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
        stop = np.cumsum([len(d) for d in documents])[owner] if n else at
        base = stop - np.array([len(d) for d in documents], np.int64)[owner] if n else at
        first = np.concatenate([at[at + w <= stop] for w in range(1, most + 1)]).astype(np.int64)
        last = np.concatenate([at[at + w <= stop] + w - 1 for w in range(1, most + 1)]).astype(np.int64)
        a, b = ahead[first] if n else first, back[last] if n else last
        void = (a > last) | (b < first)
        begin = np.where(void, 0, begins[np.minimum(a, n - 1)]) if n else a
        size = np.where(void, 0, ends[b] - begin) if n else a
        order = np.argsort(size, kind="stable")
        self.begin, self.size = begin[order], size[order]
        self.owner = owner[first][order] if n else first
        self.first, self.stop = ((first - base[first])[order], (last - base[first] + 1)[order]) if n else (first, first)

    def span(self, k: int) -> str:
        return self.text[self.begin[k] : self.begin[k] + self.size[k]]

    def ids_of(self, text: str) -> np.ndarray:
        codes = _codes(text)
        return np.where(codes < len(self.places), self.places[np.minimum(codes, len(self.places) - 1)], self.absent)

    def counted(self, lo: int, hi: int, values: np.ndarray, bins: int, short: int = 0) -> np.ndarray:
        """(bins, spans): how often each value is in the spans, up to 255; spans end ``short`` places before their end."""
        out = np.empty((bins, hi - lo), np.uint8)
        step = max(1, (1 << 21) // bins)
        for k in range(lo, hi, step):
            begin, size = self.begin[k : min(k + step, hi)], np.maximum(self.size[k : min(k + step, hi)] - short, 0)
            n = len(size)
            which = np.repeat(np.arange(n), size)
            at = np.arange(len(which)) + np.repeat(begin - np.cumsum(size) + size, size)
            found = np.bincount(values[at].astype(np.int64) * n + which, minlength=bins * n)
            out[:, k - lo : k - lo + n] = np.minimum(found, 255).reshape(bins, n)
        return out


def common(asked: Sequence[np.ndarray], ids: np.ndarray, absent: int, which: np.ndarray, begins: np.ndarray, sizes: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Per pair of a wanted text (its place in ``asked``) and a span (begin, size in ids) their longest common subsequence, or -1 where that is surely below what it needs."""
    out = np.full(len(which), -1, np.int64)
    lengths = np.array([len(a) for a in asked], np.int64)
    words = np.maximum(-(-lengths // BITS), 1)
    order = np.lexsort((sizes, words[which]))
    # pairs of as many words together, and of so few texts that their masks stay small
    for n in np.unique(words[which]).tolist():
        texts = np.flatnonzero(words == n)
        for part in np.array_split(texts, -(-len(texts) * n * (absent + 1) // MASKS)):
            masks = np.zeros((n, len(part) * (absent + 1)), np.uint64)
            row = np.full(len(asked), -1, np.int64)
            row[part] = np.arange(len(part)) * (absent + 1)
            chars = np.concatenate([asked[t] for t in part])
            place = np.concatenate([np.arange(lengths[t]) for t in part])
            met = chars != absent
            at = chars[met] + np.repeat(row[part], lengths[part])[met]
            np.bitwise_or.at(masks, (place[met] // BITS, at), _ONE << (place[met] % BITS).astype(np.uint64))
            mine = order[row[which[order]] >= 0]
            for k in range(0, len(mine), BATCH):
                _measure(mine[k : k + BATCH], masks, row, lengths, ids, absent, which, begins, sizes, need, out)
    return np.where(out >= need, out, -1)


def _measure(ours, masks, row, lengths, ids, absent, which, begins, sizes, need, out) -> None:
    words = len(masks)
    begin, size, least, base, n = begins[ours], sizes[ours], need[ours], row[which[ours]], lengths[which[ours]]
    tail = (_ONE << (n - BITS * (words - 1)).astype(np.uint64)) - _ONE
    rest = np.full((words, len(ours)), _LOW, np.uint64)
    rest[-1] = tail
    for p in range(int(size.max())):
        if p and p % 12 == 0:
            alive = n - np.bitwise_count(rest).sum(0, dtype=np.int64) + np.maximum(size - p, 0) >= least
            if np.count_nonzero(alive) < 0.8 * len(ours):
                ours, begin, size, least, base, n, tail, rest = ours[alive], begin[alive], size[alive], least[alive], base[alive], n[alive], tail[alive], np.ascontiguousarray(rest[:, alive])
                if not len(ours):
                    return
        c = ids.take(begin + p, mode="clip")
        c = np.where(p < size, c, absent) + base
        carry = None
        for w in range(words):
            state = rest[w]
            hit = masks[w].take(c, mode="clip")
            hit &= state
            put = state + hit
            if carry is not None:
                put += carry
            state ^= hit
            state |= put
            if w < words - 1:
                carry = put >> _BITS
                state &= _LOW
            else:
                state &= tail
    out[ours] = n - np.bitwise_count(rest).sum(0, dtype=np.int64)


def candidates(spans: Spans, wanted: Sequence[str], floors: Sequence[float]):
    """(passage, span, bound of its ratio) of those whose bounds reach the passage's floor; a passage's come together for a block of spans."""
    asked = [spans.ids_of(w) for w in wanted]
    rare = [a[a >= spans.cut] for a in asked]
    own_letters = [np.bincount(np.minimum(a, LETTERS - 1), minlength=LETTERS) for a in asked]
    own_runs = [np.bincount(_runs(a), minlength=RUNS) for a in asked]
    split = int(np.searchsorted(spans.size, LONG))
    letters = np.minimum(spans.ids, LETTERS - 1)
    # no passage reaches spans that are shorter or longer
    reach = [(len(w) * f / (2 - f), len(w) * (2 - f) / f) for w, f in zip(wanted, floors, strict=True)]
    low = int(np.searchsorted(spans.size, min((x for x, _ in reach), default=0) - 1e-6))
    high = int(np.searchsorted(spans.size, max((y for _, y in reach), default=0) + 1e-6, side="right"))
    split = min(max(int(np.searchsorted(spans.size, LONG)), low), high)
    blocks = [(a, min(a + 4 * BLOCK, split)) for a in range(low, split, 4 * BLOCK)] + [(a, min(a + BLOCK, high)) for a in range(split, high, BLOCK)]
    for lo, hi in blocks:
        sizes = spans.size[lo:hi]
        table = spans.counted(lo, hi, letters, LETTERS)
        if lo >= split:
            # frequent characters by the matcher's own rule; all of the last bin count as rare
            often = table[:-1] > sizes // 100 + 1
            begins = np.where(often, 0, table[:-1]).sum(0, dtype=np.int64) + table[-1] + 1
            begins[table[-1] == 255] = 1 << 30
            grams = spans.counted(lo, hi, spans.runs, RUNS, 2)
        # of every passage the spans that have enough in common with it, and how many of that are frequent characters
        near: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 4]
        for t, (ids, floor) in enumerate(zip(asked, floors, strict=True)):
            n = len(ids)
            a = int(np.searchsorted(sizes, n * floor / (2 - floor) - 1e-6))
            b = int(np.searchsorted(sizes, n * (2 - floor) / floor + 1e-6, side="right"))
            if a >= b:
                continue
            need = np.ceil(floor * (sizes[a:b] + n) / 2 - 1e-6).astype(np.int64)

            def shared(counts: np.ndarray, own: np.ndarray) -> np.ndarray:
                rows = np.flatnonzero(own)
                few = rows[own[rows] < 255]
                # counts beyond 255 are not held: those of the passage count in full
                return np.minimum(counts[few, a:b], own[few].astype(np.uint8)[:, None]).sum(0, dtype=np.uint16).astype(np.int64) + int(own[rows].sum() - own[few].sum())

            frequent = own_letters[t].copy()
            frequent[spans.cut :] = 0
            plenty = shared(table, frequent)
            ok = np.flatnonzero(plenty + shared(table, own_letters[t] - frequent) >= need)
            if lo >= split and len(ok):
                ok = ok[(shared(grams, own_runs[t]) + 2 * begins[a:b] >= need)[ok]]
            near.append((np.full(len(ok), t), lo + a + ok, need[ok], plenty[ok]))
        which, at, need, plenty = (np.concatenate(x) for x in zip(*near, strict=True))
        if not len(which):
            continue
        # first by the rarer characters in order, as if all others were
        begin, end = spans.before[spans.begin[at]], spans.before[spans.begin[at] + spans.size[at]]
        left = need - plenty
        ok = np.flatnonzero(common(rare, spans.rare_ids, spans.absent, which, begin, end - begin, left) >= np.maximum(left, 0))
        which, at, need = which[ok], at[ok], need[ok]
        met = common(asked, spans.ids, spans.absent, which, spans.begin[at], spans.size[at], need)
        for k in np.flatnonzero(met >= 0).tolist():
            size = len(asked[which[k]]) + int(spans.size[at[k]])
            yield int(which[k]), int(at[k]), 2.0 * int(met[k]) / size if size else 1.0
