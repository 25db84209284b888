"""Hierarchical navigable small-world graphs as flat arrays, built and searched in batches.

A graph holds vectors of one inner-product space. Each level is an array of nodes
(level 0: all) and an array with a row of neighbours for each of them, -1 where a row
has fewer. A node's levels follow from its place in a fixed random order; the upper
levels are built first, and nodes of upper levels enter the lower ones first, so a
search can come down from the top at any time.

A batch of searches runs in lockstep: in each step every search expands its best open
candidates, and one array operation measures the neighbours that none of its earlier
steps has seen. For inner products of vectors of different lengths a coordinate is
added that makes all lengths equal, so that the nearest are the same.
"""

from __future__ import annotations

import numpy as np

LINKS = 16
BUILD = 100
WIDE = 4
BATCH = 256


def levelled(vectors: np.ndarray) -> np.ndarray:
    """The vectors as float32 with a coordinate that makes them equally long."""
    squares = (vectors.astype(np.float64) ** 2).sum(1)
    top = squares.max() if len(squares) else 1.0
    scale = 1 / np.sqrt(top)
    return np.concatenate([vectors * scale, np.sqrt(np.maximum(0, 1 - squares / top))[:, None]], 1).astype(np.float32)


def beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query up to width near places of the level and their products, not in order; starts is a row of distinct places for each query."""
    rows, n = len(queries), len(links)
    ids = np.full((rows, width), -1, np.int32)
    sims = np.full((rows, width), -np.inf, np.float32)
    open_ = np.zeros((rows, width), bool)
    seen = np.zeros((rows, n), bool)
    k = min(width, starts.shape[1])
    ids[:, :k] = starts[:, :k]
    sims[:, :k] = np.einsum("rkd,rd->rk", points[ids[:, :k]], queries)
    open_[:, :k] = True
    np.put_along_axis(seen, ids[:, :k].astype(np.int64), True, 1)
    active = np.arange(rows)
    while len(active):
        own = np.where(open_[active], sims[active], -np.inf)
        wide = min(WIDE, width)
        best = np.argpartition(-own, wide - 1, 1)[:, :wide] if wide < width else np.argsort(-own, 1)
        value = np.take_along_axis(own, best, 1)
        alive = value.max(1) > -np.inf
        active, best, value = active[alive], best[alive], value[alive]
        if not len(active):
            break
        at = ids[active[:, None], best]
        open_[active[:, None], best] = False
        near = np.where((value > -np.inf)[:, :, None], links[at], -1).reshape(len(active), -1)
        near.sort(1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        place = near[r, c]
        new = ~seen[active[r], place]
        r, place = r[new], place[new]
        seen[active[r], place] = True
        got = np.einsum("fd,fd->f", points[place], queries[active[r]])
        worth = got > sims[active[r]].min(1) if len(r) < 64 else got > sims.min(1)[active[r]]
        r, place, got = r[worth], place[worth], got[worth]
        if not len(r):
            continue
        many = np.bincount(r, minlength=len(active))
        column = np.arange(len(r)) - np.repeat(np.cumsum(many) - many, many)
        more = int(many.max())
        all_sims = np.full((len(active), width + more), -np.inf, np.float32)
        all_ids = np.full((len(active), width + more), -1, np.int32)
        all_open = np.zeros((len(active), width + more), bool)
        all_sims[:, :width], all_ids[:, :width], all_open[:, :width] = sims[active], ids[active], open_[active]
        all_sims[r, width + column], all_ids[r, width + column], all_open[r, width + column] = got, place, True
        keep = np.argpartition(-all_sims, width - 1, 1)[:, :width]
        sims[active], ids[active], open_[active] = (np.take_along_axis(x, keep, 1) for x in (all_sims, all_ids, all_open))
    return ids, sims


def chosen(points: np.ndarray, centres: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to most neighbours for each centre: the nearest first, each nearer to the centre than to those chosen before, then the nearest of the rest."""
    order = np.argsort(-sims, 1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    own = points[np.maximum(ids, 0)]
    among = own @ own.transpose(0, 2, 1)
    rows, c = ids.shape
    taken, n = np.zeros((rows, c), bool), np.zeros(rows, int)
    closest = np.full((rows, c), -np.inf, np.float32)  # to a chosen one
    for k in range(c):
        take = (ids[:, k] >= 0) & (n < most) & (sims[:, k] > closest[:, k])
        taken[:, k] = take
        n += take
        closest[take] = np.maximum(closest[take], among[take, k])
    rank = np.argsort(np.where(ids < 0, 2, ~taken), 1, kind="stable")[:, :most]
    return np.take_along_axis(ids, rank, 1)


class Graph:
    """points (levelled), nodes (for each level its nodes' places in points), links (for each level rows of places within the level)."""

    def __init__(self, points: np.ndarray, nodes: list[np.ndarray], links: list[np.ndarray]):
        self.points, self.nodes, self.links = points, nodes, links

    @classmethod
    def built(cls, vectors: np.ndarray, m: int = LINKS, width: int = BUILD) -> Graph:
        points = levelled(vectors)
        n = len(points)
        order = np.random.default_rng(n).permutation(n).astype(np.int32)  # places in the order of entry: those of upper levels first
        points = points[order]
        sizes = [n]
        while sizes[-1] // m > m:
            sizes.append(sizes[-1] // m)
        graph = cls(points, [np.arange(s, dtype=np.int32) for s in sizes], [np.zeros((0, 2 * m if k == 0 else m), np.int32) for k in range(len(sizes))])
        for level in range(len(sizes) - 1, -1, -1):
            graph._fill(level, sizes[level], width)
        graph.order = order
        return graph

    def _fill(self, level: int, size: int, width: int) -> None:
        most = self.links[level].shape[1]
        links = np.full((size, most), -1, np.int32)
        done = 0
        while done < size:
            b = min(size - done, max(2 * most, min(BATCH, done)))
            own = self.points[done : done + b]
            among = own @ own.T
            np.fill_diagonal(among, -np.inf)
            k = min(most, b - 1)
            parts = []
            if k:
                near = np.argpartition(-among, k - 1, 1)[:, :k]
                parts.append((near.astype(np.int32) + done, np.take_along_axis(among, near, 1)))
            if done:
                parts.append(beam(self.points, links[:done], own, self.entries(own, level, done), width))
            if parts:
                ids, sims = (np.concatenate(x, 1) for x in zip(*parts, strict=True))
                links[done : done + b] = _padded(chosen(self.points, own, ids, sims, most // 2 if level == 0 else most), most)
                _answer(self.points, links, np.arange(done, done + b), most)
            done += b
        self.links[level] = links

    def entries(self, queries: np.ndarray, level: int, below: int | None = None) -> np.ndarray:
        """Places to start from on the level, coming down from the top."""
        at = np.zeros((len(queries), 1), np.int32)
        for upper in range(len(self.nodes) - 1, level, -1):
            ids, sims = beam(self.points, self.links[upper], queries, at, 4)
            at = np.take_along_axis(ids, sims.argmax(1)[:, None], 1)
        return at if below is None else np.where(at < below, at, 0)

    def search(self, vectors: np.ndarray, width: int) -> np.ndarray:
        """Places of up to width near vectors for each query (in the order of entry, -1 where there are fewer)."""
        queries = np.concatenate([vectors, np.zeros((len(vectors), 1))], 1).astype(np.float32)
        out = [beam(self.points, self.links[0], q, self.entries(q, 0), width)[0] for q in (queries[k : k + BATCH] for k in range(0, len(queries), BATCH))]
        return np.concatenate(out) if out else np.zeros((0, width), np.int32)


def _padded(ids: np.ndarray, most: int) -> np.ndarray:
    out = np.full((len(ids), most), -1, np.int32)
    out[:, : ids.shape[1]] = ids
    return out


def _answer(points: np.ndarray, links: np.ndarray, new: np.ndarray, most: int) -> None:
    """Links back to the new nodes; a full row chooses anew."""
    to, back = links[new].reshape(-1), np.repeat(new, links.shape[1])
    ok = to >= 0
    to, back = to[ok], back[ok]
    known = (links[to] == back[:, None]).any(1)
    to, back = to[~known], back[~known]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    nodes, first, many = np.unique(to, return_index=True, return_counts=True)
    column = np.arange(len(to)) - np.repeat(first, many)
    for low in range(0, len(nodes), 2048):
        part = slice(low, low + 2048)
        own, n = nodes[part], many[part]
        pick = np.flatnonzero((to >= own[0]) & (to <= own[-1]))
        wide = np.full((len(own), most + int(n.max())), -1, np.int32)
        wide[:, :most] = links[own]
        wide[np.searchsorted(own, to[pick]), most + column[pick]] = back[pick]
        wide = np.take_along_axis(wide, np.argsort(wide < 0, 1, kind="stable"), 1)
        full = (wide >= 0).sum(1) > most
        links[own[~full]] = wide[~full, :most]
        if full.any():
            ids = wide[full]
            sims = np.where(ids >= 0, np.einsum("rkd,rd->rk", points[np.maximum(ids, 0)], points[own[full]]), -np.inf).astype(np.float32)
            links[own[full]] = _padded(chosen(points, points[own[full]], ids, sims, most), most)
