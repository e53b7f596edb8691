"""Counts within a radius and the last days, for arrays of places.

The disc of an asked place is cut into strips of latitude. Within a strip the places between two longitudes lie surely
inside, those beyond two others surely outside. Places are kept by cell (strip, then longitude), so the sum over the
inside is a difference of running totals, and only places of the few cells between these bounds are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from hourgrid.functions.geo import EARTH_RADIUS_M

SLACK_M = 1e-3
#: Strips per radius: more of them where many places lie about a radius away, within these bounds.
STRIPS = (4, 128)
#: From how many asked and held places that is estimated.
TRIED = (32, 1 << 13)
#: The number by which rows are sorted has the group from this bit on, then the kind.
GROUP_FROM, KIND_BITS = 25, 2
#: Entries of the largest arrays that are made at once.
ENTRIES = 1 << 20


def _runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins."""
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for column in sorted_columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _numbers(starts: np.ndarray, length: int) -> np.ndarray:
    """The number of the run that each entry belongs to."""
    first = np.zeros(length, np.int64)
    first[starts[1:]] = 1
    return np.cumsum(first)


class _Strips:
    """Places of one chunk by cell, with a row of values each."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, values: np.ndarray, asked: tuple[np.ndarray, np.ndarray], radius_m: float):
        self.radius_m, self.centre = radius_m, asked[1][0]
        reach = min((radius_m + SLACK_M) / EARTH_RADIUS_M, np.pi)
        x = self.turned(lon)
        self.low, self.west = lat.min(), x.min()
        self.strips = int(np.clip(round(np.sqrt(2 * self._about_a_radius_away(lat, lon, *asked))), *STRIPS))
        step = np.degrees(reach)
        self.height = max(step, (lat.max() - self.low) / 16) / self.strips
        # cells about as wide as high, and not too many
        span = x.max() - self.west
        self.width = max(self.height / max(np.cos(np.radians(np.abs(lat).min())), 1e-9), span / (16 * self.strips), 1e-12)
        self.columns = int(span / self.width) + 1

        row = np.floor((lat - self.low) / self.height).astype(np.int64)
        self.rows = int(row.max()) + 1
        cell = row * self.columns + np.floor((x - self.west) / self.width).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        self.start = np.zeros(self.rows * self.columns + 1, np.int64)
        np.cumsum(np.bincount(cell, minlength=self.rows * self.columns), out=self.start[1:])
        self.values = values[order]
        self.total = np.zeros((len(order) + 1, values.shape[1]), values.dtype)
        np.cumsum(self.values, axis=0, out=self.total[1:])
        self.phi, self.lam = np.radians(lat[order]), np.radians(lon[order])
        self.cos = np.cos(self.phi)

        edges = self.low + np.arange(self.rows + 1) * self.height
        at_edge = np.where(np.abs(edges) < 90, np.cos(np.radians(edges)), 0.0)
        self.least = np.minimum(at_edge[:-1], at_edge[1:])
        self.most = np.where((edges[:-1] <= 0) & (edges[1:] >= 0), 1.0, np.maximum(at_edge[:-1], at_edge[1:]))

    def _about_a_radius_away(self, lat: np.ndarray, lon: np.ndarray, ask_lat: np.ndarray, ask_lon: np.ndarray) -> float:
        """Places in a square of the radius, there where discs of the asked places end; an estimate that decides about speed only."""
        some, held = (slice(None, None, -(-len(c) // most)) for c, most in zip((ask_lat, lat), TRIED))
        phi, at = np.radians(lat[held]), np.radians(ask_lat[some])[:, None]
        h = np.sin((phi - at) / 2) ** 2 + np.cos(at) * np.cos(phi) * np.sin(np.radians(lon[held] - ask_lon[some][:, None]) / 2) ** 2
        near = np.count_nonzero((h >= self._square(0.9 * self.radius_m)) & (h <= self._square(1.1 * self.radius_m)))
        return near / len(at) * len(lat) / len(phi) / (0.4 * np.pi)

    def turned(self, lon: np.ndarray) -> np.ndarray:
        """Degrees east of the centre, from -180 to 180."""
        return np.mod(lon - self.centre + 180.0, 360.0) - 180.0

    def _square(self, metres: float) -> float:
        return float(np.sin(np.clip(metres / EARTH_RADIUS_M, 0.0, np.pi) / 2) ** 2)

    def bounds(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per place and strip four places of the order: those before the first and from the last on are too far,
        those between the middle ones near enough."""
        x = self.turned(lon)[:, None]
        cosine = np.cos(np.radians(lat))[:, None]
        at = np.floor((lat - self.low) / self.height).astype(np.int64)[:, None] + np.arange(-self.strips - 1, self.strips + 2)
        row = np.clip(at, 0, self.rows - 1)
        below = (self.low + row * self.height) - lat[:, None]
        above = below + self.height
        outer = self._square(self.radius_m + SLACK_M) - np.sin(np.radians(np.maximum(np.maximum(below, -above), 0.0)) / 2) ** 2
        inner = self._square(self.radius_m - SLACK_M) - np.sin(np.radians(np.maximum(np.abs(below), np.abs(above))) / 2) ** 2
        met = (row == at) & (outer >= 0)
        scale = cosine * self.least[row]
        known = scale > 0
        half = 2 * np.degrees(np.arcsin(np.sqrt(np.where(
            known, np.minimum(np.maximum(outer, 0.0) / np.where(known, scale, 1.0), 1.0), 1.0))))
        round_ = np.abs(x) + half >= 180.0 - 1e-9
        sure = met & known & ~round_ & (inner > 0)
        half_in = 2 * np.degrees(np.arcsin(np.sqrt(np.minimum(
            np.where(sure, inner, 0.0) / np.where(sure, cosine * self.most[row], 1.0), 1.0))))

        def column(value: np.ndarray) -> np.ndarray:
            return np.clip(np.floor((value - self.west) / self.width), -2, self.columns + 1).astype(np.int64)

        first = np.where(round_, 0, np.clip(column(x - half), 0, self.columns))
        last = np.where(round_, self.columns, np.clip(column(x + half) + 1, 0, self.columns))
        first, last = np.where(met, first, 0), np.where(met, last, 0)
        left, right = np.clip(column(x - half_in) + 1, first, last), np.clip(column(x + half_in), first, last)
        sure &= right > left
        left, right = np.where(sure, left, last), np.where(sure, right, last)
        base = row * self.columns
        return tuple(self.start[base + c] for c in (first, left, right, last))

    def near(self, pair: np.ndarray, phi: np.ndarray, lam: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """Whether the places at ``pair`` lie within the radius of the others."""
        h = np.sin((self.phi[pair] - phi) / 2) ** 2 + cosine * self.cos[pair] * np.sin((self.lam[pair] - lam) / 2) ** 2
        limit = self._square(self.radius_m)
        inside = h <= limit
        close = np.flatnonzero(np.abs(h - limit) <= 1e-9 * limit)
        if len(close):
            metres = 2 * EARTH_RADIUS_M * np.arctan2(np.sqrt(h[close]), np.sqrt(np.maximum(1.0 - h[close], 0.0)))
            inside[close] = metres <= self.radius_m
        return inside

    def sums(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        """Sums of the values of the places within the radius of each place."""
        out = np.zeros((len(lat), self.values.shape[1]), np.int64)
        some = max(1, min(ENTRIES // 8, 4 * ENTRIES // self.values.shape[1]) // (2 * self.strips + 3))
        for begin in range(0, len(lat), some):
            here = slice(begin, begin + some)
            bounds = self.bounds(lat[here], lon[here])
            out[here] = self._inside(bounds[1], bounds[2])
            self._rim(out[here], lat[here], lon[here], bounds)
        return out

    def _inside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (self.total[right] - self.total[left]).sum(axis=1, dtype=np.int64)

    def _rim(self, out: np.ndarray, lat: np.ndarray, lon: np.ndarray, bounds: tuple[np.ndarray, ...]) -> None:
        """Add the values of the compared places."""
        begin = np.stack([bounds[0], bounds[2]], axis=2)
        length = np.stack([bounds[1], bounds[3]], axis=2) - begin
        begin, length = begin.reshape(len(lat), -1), length.reshape(len(lat), -1)
        phi, lam = np.radians(lat), np.radians(lon)
        cosine = np.cos(phi)
        upto = np.cumsum(length.sum(axis=1))
        first, most = 0, max(1, min(ENTRIES, 4 * ENTRIES // self.values.shape[1]))
        while first < len(lat):
            done = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, done + most, side="right")))
            pairs = int(upto[last - 1] - done)
            if pairs:
                lengths, of_ask = length[first:last], upto[first:last] - done
                held = lengths.ravel()
                pair = np.repeat(begin[first:last].ravel() - (np.cumsum(held) - held), held) + np.arange(pairs)
                ask = np.repeat(np.arange(first, last), np.diff(of_ask, prepend=0))
                inside = np.flatnonzero(self.near(pair, phi[ask], lam[ask], cosine[ask]))
                if len(inside):
                    ask = ask[inside]
                    starts = _runs(ask)
                    out[ask[starts]] += np.add.reduceat(self.values[pair[inside]], starts, axis=0, dtype=np.int64)
            first = last


def counts(asked: tuple[np.ndarray, ...], held: tuple[np.ndarray, ...], radius_m: float, days: int) -> np.ndarray:
    """For each asked (latitude, longitude, day) the sum over the held (latitude, longitude, day, number) within the
    radius on the last ``days`` days, that day included. Held rows are unique by place and day."""
    out = np.zeros(len(asked[0]), np.int64)
    if not len(out) or not len(held[0]):
        return out
    by_ask = np.lexsort((asked[1], asked[0]))
    ask_lat, ask_lon, ask_day = (c[by_ask] for c in asked)
    by_place = np.lexsort((held[1], held[0]))
    lat, lon, day, number = (c[by_place] for c in held)
    kind = np.int32 if number.sum() < 1 << 31 else np.int64
    first, last = int(ask_day.min()), int(ask_day.max())

    # All days at once where places recur, else a few.
    places = len(_runs(lat, lon))
    wide = last - first + 1
    if len(lat) * 8 < places * wide:
        wide = min(wide, 7)
    wide = max(1, min(wide, 4 * ENTRIES // places))
    for begin in range(first, last + 1, wide):
        width = min(wide, last + 1 - begin)
        ask = np.flatnonzero((ask_day >= begin) & (ask_day < begin + width))
        rows = np.flatnonzero((day > begin - days) & (day < begin + width))
        if not len(ask) or not len(rows):
            continue
        here_lat, here_lon = lat[rows], lon[rows]
        starts = _runs(here_lat, here_lon)
        daily = np.zeros((len(starts), width + days), kind)
        daily[_numbers(starts, len(rows)), day[rows] - (begin - days)] = number[rows]
        np.cumsum(daily, axis=1, out=daily)
        held_lat, held_lon = here_lat[starts], here_lon[starts]
        at_lat, at_lon = ask_lat[ask], ask_lon[ask]
        starts = _runs(at_lat, at_lon)
        places_asked = at_lat[starts], at_lon[starts]
        sums = _Strips(held_lat, held_lon, daily[:, days:] - daily[:, :-days], places_asked, radius_m).sums(*places_asked)
        out[by_ask[ask]] = sums[_numbers(starts, len(ask)), ask_day[ask] - begin]
    return out


class _Group:
    """What is known of one group while its rows arrive: what is asked, and held rows that are not counted yet."""

    def __init__(self, most: int, radius_m: float, days: int):
        self.most, self.limits = most, (radius_m, days)
        self.asked, self.held, self.rows, self.sums = [], [], 0, None

    def add(self, kind: np.ndarray, columns: list[np.ndarray]) -> None:
        if kind[0] >= 2:
            self.asked.append([c[kind == 2] for c in columns])
            self.held.append(columns)
            return
        if kind[0] == 0:
            self.asked.append([c[kind == 0] for c in columns])
        columns = [c[kind == 1] for c in columns]
        while len(columns[0]):
            part = [c[:self.most - self.rows] for c in columns]
            columns = [c[len(part[0]):] for c in columns]
            self.held.append(part)
            self.rows += len(part[0])
            if self.rows >= self.most:
                self.count()

    def count(self) -> None:
        if self.sums is None and self.asked:
            self.asked = [np.concatenate(c) for c in zip(*self.asked)]
            self.sums = np.zeros(len(self.asked[0]), np.int64)
        if self.held and self.asked:
            self.sums += counts(tuple(self.asked[:3]), tuple(np.concatenate(c) for c in zip(*self.held)), *self.limits)
        self.held, self.rows = [], 0

    def result(self) -> list[np.ndarray]:
        self.count()
        return [*self.asked, self.sums] if self.asked else []


def count_groups(most: int, radius_m: float, days: int):
    """A function for ``mapInArrow`` over rows sorted by ``_order``; the result has the asked rows with their sums.

    A group has rows of kind 2 (asked and held) and 3 (held), or first those of kind 0 (asked) and then those of 1 (held),
    of which ``most`` are counted at a time.
    """
    columns = ["_lat", "_lon", "_d", "_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, number = None, None

        def done() -> Iterator[pa.RecordBatch]:
            found = group.result() if group is not None else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=[*columns, "_sum"])

        for batch in batches:
            if not batch.num_rows:
                continue
            order = batch.column("_order").to_numpy()
            groups, kind = order >> GROUP_FROM, order >> (GROUP_FROM - KIND_BITS) & 3
            values = [batch.column(c).to_numpy() for c in columns]
            starts = [*_runs(groups).tolist(), batch.num_rows]
            for begin, end in zip(starts, starts[1:]):
                if groups[begin] != number:
                    yield from done()
                    group, number = _Group(most, radius_m, days), groups[begin]
                group.add(kind[begin:end], [v[begin:end] for v in values])
        yield from done()

    return run
