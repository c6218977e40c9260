"""Rings of a cell against each other, whole lots at a time; used inside tasks only.

Rings of one form (equal corners, told from the lower left of the box) that lie at the same offset from rings of another
form all meet those or none does. Where coordinates are whole multiples of a power of two, so that every difference and
product of the test is exact, a worker keeps what it has found for an offset of two forms and tests it once. All other
pairs are tested one by one, by the same test."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from . import rings

#: Pairs of boxes compared, pairs of rings tested, and rows given back at a time.
BOXES, TESTS, ROWS = 1 << 19, 1 << 13, 1 << 17
#: Lots with no more pairs of boxes are compared together.
SMALL = 1 << 13
#: Offsets that two forms may have to be kept, offsets and forms that a worker keeps.
OFFSETS, KEPT, FORMS = 1 << 20, 1 << 25, 1 << 12
#: Coordinates times 2 ** at most BITS are whole and below REACH: products of two differences are below 2 ** 53.
BITS, REACH = 20, 1 << 25


class Known:
    """Of pairs of forms, offset by offset: 0 not yet tested, 1 apart, 2 meeting."""

    def __init__(self) -> None:
        self.states, self.full = np.zeros(KEPT, np.uint8), False
        self.forget()

    def forget(self) -> None:
        if self.full:
            self.states[: self.used] = 0
        self.forms, self.count, self.tables, self.used, self.full = {}, 0, {}, 0, False

    def numbers(self, bits: int, corners: set[bytes]) -> dict[bytes, int]:
        """The number of each form whose corners are told in multiples of 2 ** -bits."""
        forms = self.forms.setdefault(bits, {})
        for c in corners - forms.keys():
            forms[c] = self.count
            self.count += 1
        return forms

    def table(self, pair: tuple[int, int], offsets: int) -> int:
        """Where the offsets of the pair begin; -1 where they are too many."""
        at = self.tables.get(pair)
        if at is None and offsets <= OFFSETS:
            if self.used + offsets > KEPT:
                self.full = True
                return -1
            at = self.tables[pair] = self.used
            self.used += offsets
        return -1 if at is None else at


_known: list[Known] = []


def known() -> Known:
    """The worker's own; what it holds depends on nothing but the forms."""
    if not _known:
        _known.append(Known())
    k = _known[0]
    k.full |= k.count > FORMS
    if k.full:
        k.forget()
    return k


def _bits(v: np.ndarray) -> int | None:
    """The least power of two that makes all coordinates whole; None if there is none or they reach too far."""
    whole = lambda k: bool((np.rint(v * 2.0**k) == v * 2.0**k).all())
    if not np.isfinite(v).all() or not whole(BITS):
        return None
    k = next(k for k in range(BITS + 1) if whole(k))
    return k if np.abs(v).max() * 2.0**k < REACH else None


class Rows:
    """Rows of both sides: rings with their boxes, and what is known of their forms."""

    def __init__(self, ring, left: np.ndarray, pairs: int) -> None:
        s = self.sides = rings.sides(ring)
        self.box = [f.reduceat(c, s.start) for f, c in ((np.fmin, s.ax), (np.fmax, s.ax), (np.fmin, s.ay), (np.fmax, s.ay))]
        self.known = None
        bits = _bits(np.concatenate([s.ax, s.ay]))
        if bits is not None:
            self._read_forms(known(), bits, left, pairs)

    def _read_forms(self, known: Known, bits: int, left: np.ndarray, pairs: int) -> None:
        s, (x0, x1, y0, y1) = self.sides, (np.rint(c * 2.0**bits).astype("int32") for c in self.box)
        own = np.empty((len(s.ax), 2), "int32")
        own[:, 0], own[:, 1] = np.rint(s.ax * 2.0**bits) - np.repeat(x0, s.n), np.rint(s.ay * 2.0**bits) - np.repeat(y0, s.n)
        data, ends = own.tobytes(), (8 * (s.start + s.n)).tolist()
        corners = [data[begin:end] for begin, end in zip([0, *ends], ends, strict=False)]
        form = np.fromiter(map(known.numbers(bits, set(corners)).__getitem__, corners), "int64", len(corners))
        (fa, first_a, code_a), (fb, first_b, code_b) = (np.unique(form[k], return_index=True, return_inverse=True) for k in (left, ~left))
        if len(fa) * len(fb) * 8 > pairs:
            return
        first_a, first_b = np.flatnonzero(left)[first_a], np.flatnonzero(~left)[first_b]
        w, h = (x1 - x0).astype("int64"), (y1 - y0).astype("int64")
        high = h[first_a][:, None] + h[first_b] + 1
        many = (w[first_a][:, None] + w[first_b] + 1) * high
        at = np.array([[known.table((a, b), n) for b, n in zip(fb.tolist(), row, strict=True)] for a, row in zip(fa.tolist(), many.tolist(), strict=True)])
        self.kept = (at >= 0).ravel()
        self.high = np.minimum(high, OFFSETS).astype("int32").ravel()
        self.at = (at + w[first_b] * high + h[first_b]).ravel()
        self.code = np.empty(len(form), "int64")
        self.code[left], self.code[~left] = code_a * len(fb), code_b
        self.x, self.y, self.known = x0, y0, known

    def tested(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), bool)
        for lo in range(0, len(i), TESTS):
            k = slice(lo, lo + TESTS)
            out[k] = rings.meet(rings.taken(self.sides, i[k]), rings.taken(self.sides, j[k]))
        return out

    def meet(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether rings i meet rings j; their boxes do."""
        if self.known is None:
            return self.tested(i, j)
        pair = self.code[i] + self.code[j]
        if not self.kept.all():
            kept, out = self.kept[pair], np.zeros(len(i), bool)
            out[kept], out[~kept] = self._told(i[kept], j[kept], pair[kept]), self.tested(i[~kept], j[~kept])
            return out
        return self._told(i, j, pair)

    def _told(self, i: np.ndarray, j: np.ndarray, pair: np.ndarray) -> np.ndarray:
        states = self.known.states
        at = self.at[pair] + ((self.x[j] - self.x[i]) * self.high[pair] + (self.y[j] - self.y[i]))
        state = states[at]
        new = np.flatnonzero(state == 0)
        if len(new):
            places, first = np.unique(at[new], return_index=True)
            k = new[first]
            states[places] = self.tested(i[k], j[k]) + np.uint8(1)
            state[new] = states[at[new]]
        return state > 1


def _near(start: np.ndarray, mid: np.ndarray, end: np.ndarray, box: list[np.ndarray], lowest: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of rows start to mid with those of mid to end, lot by lot, whose boxes meet and that are told in this cell:
    the lower left corner of what they share is there, so on each axis the box of one begins in it."""

    def keep(a, b):
        """a, b: the bounds of boxes and whether they begin here."""
        out = a[0] <= b[1]
        for low, high in ((b[0], a[1]), (a[2], b[3]), (b[2], a[3])):
            out &= low <= high
        for p, q in zip(a[4:], b[4:], strict=True):
            out &= p | q
        return out

    of = lambda k: [c[k] for c in (*box, *lowest)]

    nb = end - mid
    size = (mid - start) * nb
    small = np.flatnonzero((size > 0) & (size <= SMALL))
    for g in np.split(small, np.flatnonzero(np.diff(np.cumsum(size[small]) // BOXES)) + 1):
        p = np.repeat(np.arange(len(g)), size[g])
        local = np.arange(len(p)) - np.repeat(np.cumsum(size[g]) - size[g], size[g])
        i, j = start[g][p] + local // nb[g][p], mid[g][p] + local % nb[g][p]
        k = keep(of(i), of(j))
        yield i[k], j[k]
    for g in np.flatnonzero(size > SMALL):
        here = slice(start[g], end[g])
        lot = [*_ranks(box[0][here], box[1][here]), *_ranks(box[2][here], box[3][here]), *(c[here] for c in lowest)]
        a, b = ([c[k] for c in lot] for k in (slice(mid[g] - start[g]), slice(mid[g] - start[g], None)))
        step = max(1, BOXES // nb[g])
        for lo in range(0, mid[g] - start[g], step):
            k = np.flatnonzero(keep([c[lo : lo + step, None] for c in a], b))
            i = k // nb[g]
            yield i + (lo + start[g]), k - i * nb[g] + mid[g]


def _ranks(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Small whole numbers in the order of the bounds, which are quicker to compare; a bound that is no number is above
    or below all others, so that its box meets none."""
    values, ranks = np.unique(np.stack([low, high]), return_inverse=True)
    ranks = ranks.reshape(2, -1) + 1
    lost = np.isnan(low) | np.isnan(high)
    ranks[0, lost], ranks[1, lost] = len(values) + 1, 0
    return ranks.astype("uint16" if len(values) < 65_000 else "int64")


def _lots(batches, keys: list[str]) -> Iterator[tuple]:
    """(table, begins): rows of whole lots, which follow each other, and where each begins."""
    import pyarrow as pa

    def begins(table):
        k = [table.column(c).to_numpy() for c in keys]
        return np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in k], axis=0)])) if len(table) else np.zeros(0, int)

    held = []
    for batch in batches:
        new = pa.Table.from_batches([batch])
        table = pa.concat_tables([held[-1].slice(len(held[-1]) - 1), new]) if held else new
        if not held or len(begins(table)) > 1:
            table = pa.concat_tables([*held, new])
            at = begins(table)
            if len(at) > 1:
                yield table.slice(0, at[-1]), at[:-1]
                table = table.slice(at[-1])
            held = [table] if len(table) else []
        else:
            held.append(new)
    if held:
        table = pa.concat_tables(held)
        yield table, begins(table)


def meeting(batches, keys: list[str], exact: bool):
    """Arrow batches sorted by the keys of lots and then by `right`, with aid, bid, ring and whether a box begins in the
    cell (`low_x`, `low_y`) -> batches of (aid, bids), what one left row of a lot meets in a list: that is read much faster
    than pair by pair."""
    import pyarrow as pa

    for table, start in _lots(batches, keys):
        table = table.combine_chunks()
        column = lambda c: table.column(c).chunk(0)  # noqa: B023, E731
        left = ~column("right").to_numpy(zero_copy_only=False)
        end = np.append(start[1:], len(table))
        mid = start + np.add.reduceat(left.astype("int64"), start)
        pairs = int(((mid - start) * (end - mid)).sum())
        if not pairs:
            continue
        rows = Rows(column("ring"), left, pairs)
        lowest = [column(c).to_numpy(zero_copy_only=False) for c in ("low_x", "low_y")]
        for i, j in _near(start, mid, end, rows.box, lowest):
            if exact:
                k = rows.meet(i, j)
                i, j = i[k], j[k]
            for lo in range(0, len(i), ROWS):
                k = slice(lo, lo + ROWS)
                first = np.flatnonzero(np.concatenate([[True], np.diff(i[k]) != 0]))
                ids = pa.ListArray.from_arrays(pa.array(np.append(first, len(i[k])), pa.int32()), column("bid").take(pa.array(j[k])))
                yield pa.RecordBatch.from_arrays([column("aid").take(pa.array(i[k][first])), ids], ["aid", "bids"])
