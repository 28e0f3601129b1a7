"""A hierarchical navigable small-world graph over unit vectors, built and searched in batches."""

from __future__ import annotations

import io

import numpy as np

from heatmart.llm.common import U64, noise

LINKS = 16  # chosen per new node; a node keeps at most twice as many
BUILD_BEAM = 48
FIRST_BEAM = 32
INSERTED = 256  # nodes that enter at a time
ASKED = 512  # queries that go through the graph at a time


class Graph:
    """Nodes are ordered by falling level, so each layer holds the first of them."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], ids: np.ndarray, beam: int = FIRST_BEAM) -> None:
        self.vectors, self.layers, self.ids, self.beam = vectors, layers, ids, beam

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray) -> "Graph":
        """Insert all vectors (rows of length 1) by batches, each linked to what is there and to its own batch."""
        n = len(vectors)
        chance = ((noise(n, 61) >> U64(11)).astype(np.float64) + 1) / 2 ** 53
        level = np.floor(-np.log(chance) / np.log(LINKS)).astype(int)
        order = np.lexsort((ids, -level))
        vectors, ids, level = np.ascontiguousarray(vectors[order], np.float32), ids[order], level[order]
        sizes = [int((level >= k).sum()) for k in range(int(level[0]) + 1)] if n else []
        graph = cls(vectors, [np.full((s, 2 * LINKS), -1, np.int32) for s in sizes], ids)
        at = 0
        while at < n:
            edges = [s for s in sizes if s > at]
            end = min(at + max(1, min(INSERTED, at // 2)), min(edges))
            graph._insert(at, end, int(level[at]))
            at = end
        return graph

    def _insert(self, at: int, end: int, level: int) -> None:
        q = self.vectors[at:end]
        if at == 0:
            return
        entry = np.zeros((end - at, 1), np.int64)
        near = q @ q.T
        for layer in range(len(self.layers) - 1, -1, -1):
            if layer > level:
                entry = self._walk(layer, q, entry, 4)[0]
                continue
            found, sim = self._walk(layer, q, entry, BUILD_BEAM)
            entry = found
            k = min(LINKS, end - at - 1)
            if k:
                own = near.copy()
                np.fill_diagonal(own, -np.inf)
                pick = np.argpartition(-own, k - 1, 1)[:, :k]
                found = np.concatenate([found, pick + at], 1)
                sim = np.concatenate([sim, np.take_along_axis(own, pick, 1)], 1)
            links = self._diverse(found, sim, LINKS)
            self.layers[layer][at:end, :LINKS] = links
            target, new = links.ravel(), np.repeat(np.arange(at, end), LINKS)
            self._back(layer, target[target >= 0], new[target >= 0])

    def _back(self, layer: int, target: np.ndarray, new: np.ndarray) -> None:
        """Link targets back to the new nodes; the full ones choose anew."""
        known = (self.layers[layer][target] == new[:, None]).any(1)
        target, new = target[~known], new[~known]
        if not len(target):
            return
        sim = np.einsum("nd,nd->n", self.vectors[target], self.vectors[new])
        order = np.lexsort((-sim, target))
        target, new = target[order], new[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        keep = place < 2 * LINKS
        more = np.full((len(nodes), min(int(count.max()), 2 * LINKS)), -1, np.int64)
        more[np.repeat(np.arange(len(nodes)), count)[keep], place[keep]] = new[keep]
        for i in range(0, len(nodes), 512):
            some = nodes[i:i + 512]
            every = np.concatenate([self.layers[layer][some], more[i:i + 512]], 1)
            sim = np.einsum("nd,nmd->nm", self.vectors[some], self.vectors[every])
            sim[every < 0] = -np.inf
            full = (every >= 0).sum(1) > 2 * LINKS
            out = np.full((len(some), 2 * LINKS), -1, np.int64)
            if full.any():
                out[full] = self._diverse(every[full], sim[full], 2 * LINKS)
            packed = np.argsort(-sim[~full], 1, kind="stable")[:, :2 * LINKS]
            out[~full] = np.take_along_axis(every[~full], packed, 1)
            self.layers[layer][some] = out

    def _diverse(self, found: np.ndarray, sim: np.ndarray, m: int) -> np.ndarray:
        """Of each row's candidates, those closer to the row's node than to any chosen before; then the closest others."""
        order = np.argsort(-sim, 1, kind="stable")
        found, sim = np.take_along_axis(found, order, 1), np.take_along_axis(sim, order, 1)
        v = self.vectors[found]
        valid = sim > -np.inf
        chosen = np.zeros(found.shape, bool)
        closest = np.full(found.shape, -np.inf, np.float32)
        for j in range(found.shape[1]):
            ok = valid[:, j] & (closest[:, j] < sim[:, j]) & (chosen.sum(1) < m)
            if ok.any():
                chosen[ok, j] = True
                closest[ok] = np.maximum(closest[ok], np.einsum("nd,nmd->nm", v[ok, j], v[ok]))
        rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), 1, kind="stable")[:, :m]
        out = np.where(np.take_along_axis(valid, rank, 1), np.take_along_axis(found, rank, 1), -1)
        return out if out.shape[1] == m else np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)

    def _walk(self, layer: int, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes met by beam search in one layer, and their similarity; -inf where there are fewer."""
        links, rows = self.layers[layer], np.arange(len(q))
        seen = np.zeros((len(q), len(links)), bool)
        width = max(beam, entry.shape[1])
        ids = np.zeros((len(q), width), np.int64)
        sim = np.full((len(q), width), -np.inf, np.float32)
        e = np.where(entry < len(links), entry, 0)
        ids[:, :e.shape[1]] = e
        sim[:, :e.shape[1]] = np.einsum("nd,nmd->nm", q, self.vectors[e])
        first = np.sort(e, 1)
        if e.shape[1] > 1:  # an entry that occurs twice counts once
            ids[:, :e.shape[1]] = first
            sim[:, :e.shape[1]] = np.einsum("nd,nmd->nm", q, self.vectors[first])
            sim[:, 1:e.shape[1]][first[:, 1:] == first[:, :-1]] = -np.inf
        seen[rows[:, None], e] = True
        fresh = sim > -np.inf
        while True:
            wait = np.where(fresh, sim, -np.inf)
            k = min(max(2, width // 16), width)
            pick = np.argpartition(-wait, k - 1, 1)[:, :k]
            ok = np.take_along_axis(wait, pick, 1) > -np.inf
            act = np.flatnonzero(ok.any(1))
            if not len(act):
                break
            pick, ok = pick[act], ok[act]
            fresh[act[:, None], pick] = False
            near = np.where(ok[:, :, None], links[ids[act[:, None], pick]], -1).reshape(len(act), -1)
            near.sort(1)
            new = near >= 0
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            near = np.where(near < 0, 0, near)
            new &= ~seen[act[:, None], near]
            r, c = np.nonzero(new)
            seen[act[r], near[r, c]] = True
            s = np.einsum("nd,nmd->nm", q[act], self.vectors[near])
            s[~new] = -np.inf
            every = np.concatenate([sim[act], s], 1)
            best = np.argpartition(-every, width - 1, 1)[:, :width]
            sim[act] = np.take_along_axis(every, best, 1)
            ids[act] = np.take_along_axis(np.concatenate([ids[act], near], 1), best, 1)
            fresh[act] = np.take_along_axis(np.concatenate([fresh[act], s > -np.inf], 1), best, 1)
        return ids, sim

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.zeros((len(q), 1), np.int64)
        for layer in range(len(self.layers) - 1, 0, -1):
            entry = self._walk(layer, q, entry, 4)[0]
        return self._walk(0, q, entry, beam)

    def within(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) with similarity >= least.

        A beam half full of such nodes is widened; one that would hold an
        eighth of the graph is as wide as the graph, that is, a comparison with
        all its nodes.
        """
        out: list[tuple[np.ndarray, np.ndarray]] = []
        n = len(self.vectors)
        for i in range(0, len(queries), ASKED):
            todo, beam = np.arange(i, min(i + ASKED, len(queries))), self.beam
            while len(todo):
                if beam >= n / 8:
                    rows, ids = np.nonzero(queries[todo] @ self.vectors.T >= least)
                    out.append((todo[rows], ids))
                    break
                ids, sim = self.search(queries[todo], beam)
                good = sim >= least
                more = good.sum(1) * 2 >= beam
                rows, cols = np.nonzero(good & ~more[:, None])
                out.append((todo[rows], ids[rows, cols]))
                todo, beam = todo[more], 4 * beam
        return tuple(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in (0, 1))

    def audit(self, least: float, asked: int = 64, top: int = 10, share: float = 0.98) -> "Graph":
        """Widen the beam until searches for some members find enough of what comparing all vectors finds."""
        n = len(self.vectors)
        some = np.unique(np.linspace(0, n - 1, min(asked, n)).astype(int))
        exact = self.vectors[some] @ self.vectors.T
        k = min(top, n)
        best = np.partition(exact, n - k, 1)[:, n - k]
        wanted = (exact >= np.minimum(best, least)[:, None]) & (exact >= best[:, None]) | (exact >= least)
        while self.beam < n:
            ids, sim = self.search(self.vectors[some], max(self.beam, k))
            got = np.zeros((len(some), n), bool)
            got[np.arange(len(some))[:, None], ids] = sim > -np.inf
            full = wanted.sum(1) > self.beam
            if (got & wanted)[~full].sum() >= share * wanted[~full].sum():
                break
            self.beam *= 2
        return self

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, v=self.vectors, i=self.ids, b=self.beam, **{f"l{k}": x for k, x in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def unpack(cls, blob: bytes) -> "Graph":
        with np.load(io.BytesIO(blob)) as z:
            return cls(z["v"], [z[f"l{k}"] for k in range(len(z.files) - 3)], z["i"], int(z["b"]))
