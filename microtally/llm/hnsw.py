"""Hierarchical navigable small-world graph over unit vectors, for many queries at a time.

The graph has layers: layer 0 holds all vectors, each further layer a sixteenth of the one below.
Searches and insertions work on whole batches with array operations: a step expands the best
open candidates of every query of the batch together.
"""

import numpy as np

NEIGHBOURS = 16
BUILD_BEAM = 48
STEP = 2
BATCH = 512


class Layer:
    """Adjacency of one layer; -1 fills the lists."""

    def __init__(self, size, degree):
        self.links = np.full((size, degree), -1, dtype=np.int32)

    def append(self, batch, chosen):
        self.links[batch, :chosen.shape[1]] = chosen


def _ranked(ids, sims, width):
    """The ``width`` best candidates of each row, best first; -1 comes last."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _first_of_each(ids, sims):
    """Blanks repeated ids of a row."""
    order = np.argsort(ids, axis=1, kind="stable")
    sorted_ids = np.take_along_axis(ids, order, 1)
    again = np.zeros_like(sorted_ids, dtype=bool)
    again[:, 1:] = sorted_ids[:, 1:] == sorted_ids[:, :-1]
    repeated = np.zeros_like(again)
    np.put_along_axis(repeated, order, again, 1)
    ids = np.where(repeated, -1, ids)
    return ids, np.where(ids < 0, -np.inf, sims)


class Graph:
    """Vectors (rows of length one, float32), the layers, and the entry point."""

    def __init__(self, vectors, neighbours=NEIGHBOURS):
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        self.neighbours = neighbours
        self.layers, self.members = [], []

    # -- building ---------------------------------------------------------

    @classmethod
    def build(cls, vectors, seed=0, neighbours=NEIGHBOURS):
        graph = cls(vectors, neighbours)
        size = len(graph.vectors)
        draw = np.random.default_rng(seed)
        levels = np.floor(-np.log(1 - draw.random(size)) / np.log(neighbours)).astype(int)
        order = np.lexsort((draw.random(size), -levels))  # those of high layers first
        top = int(levels.max()) if size else 0
        graph.layers = [Layer(size, 2 * neighbours) for _ in range(top + 1)]
        graph.members = [order[:int((levels >= level).sum())] for level in range(top + 1)]
        for level in range(top, -1, -1):
            graph._fill(level)
        return graph

    def _fill(self, level):
        """Inserts the members of a layer, batch by batch; each batch also sees itself."""
        members, done = self.members[level], 0
        while done < len(members):
            batch = members[done:done + min(BATCH, max(done, 32))]
            queries = self.vectors[batch]
            ids, sims = self._own(batch, queries)
            if done:
                entry = self._entries(queries, level)
                entry = np.where(np.isin(entry, members[:done]), entry, members[0])
                near, near_sims = self._beam(self.layers[level].links, queries, entry[:, None], BUILD_BEAM)
                ids, sims = np.concatenate([ids, near], 1), np.concatenate([sims, near_sims], 1)
            ids, sims = _ranked(*_first_of_each(ids, sims), BUILD_BEAM)
            chosen = self._diverse(ids, sims, self.neighbours)
            self.layers[level].append(batch, chosen)
            self._link_back(level, batch, chosen)
            done += len(batch)

    def _own(self, batch, queries):
        """Nearest vectors of the batch to each other."""
        sims = queries @ queries.T
        np.fill_diagonal(sims, -np.inf)
        width = min(self.neighbours, len(batch))
        best = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        found = np.take_along_axis(sims, best, 1)
        return np.where(np.isinf(found), -1, batch[best]).astype(np.int32), found

    def _diverse(self, ids, sims, keep):
        """Up to ``keep`` candidates, none of which is nearer to a kept one than to the vector itself.

        Free places are filled with the best of the others.
        """
        rows, width = ids.shape
        vectors = self.vectors[np.maximum(ids, 0)]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        taken = np.zeros((rows, width), dtype=bool)
        count = np.zeros(rows, dtype=int)
        for place in range(width):
            nearest = np.where(taken, between[:, place], -np.inf).max(axis=1)
            good = (ids[:, place] >= 0) & (sims[:, place] > nearest) & (count < keep)
            taken[:, place] = good
            count += good
        preference = np.where(ids < 0, -np.inf, sims + 4.0 * taken)
        picked, score = _ranked(ids, preference, keep)
        return np.where(np.isinf(score), -1, picked)

    def _link_back(self, level, batch, chosen):
        """Adds the reverse of new links; full lists are chosen anew."""
        links = self.layers[level].links
        source = np.repeat(batch, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        sims = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        order = np.lexsort((-sims, target))
        source, target, sims = source[order], target[order], sims[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, counts)
        degree = links.shape[1]
        inside = place < degree
        fresh = np.full((len(nodes), min(degree, counts.max())), -1, dtype=np.int32)
        row = np.repeat(np.arange(len(nodes)), counts)
        fresh[row[inside], place[inside]] = source[inside]
        for start in range(0, len(nodes), BATCH):
            some = nodes[start:start + BATCH]
            ids = np.concatenate([links[some], fresh[start:start + BATCH]], 1)
            ids, sims = _first_of_each(ids, self._similar(some, ids))
            roomy = (ids >= 0).sum(axis=1) <= degree
            links[some[roomy]] = _ranked(ids[roomy], sims[roomy], degree)[0]
            if not roomy.all():
                ids, sims = _ranked(ids[~roomy], sims[~roomy], 2 * degree)
                kept = self._diverse(ids, sims, degree)
                links[some[~roomy], :kept.shape[1]] = kept

    def _similar(self, nodes, ids):
        sims = np.matmul(self.vectors[np.maximum(ids, 0)], self.vectors[nodes][:, :, None])[:, :, 0]
        return np.where(ids < 0, -np.inf, sims)

    # -- searching --------------------------------------------------------

    def _entries(self, queries, above):
        """Nearest member found on the layers over ``above``, from the top down."""
        entry = np.full(len(queries), self.members[-1][0])
        for level in range(len(self.layers) - 1, above, -1):
            ids, _ = self._beam(self.layers[level].links, queries, entry[:, None], 4)
            entry = ids[:, 0]
        return entry

    def _beam(self, links, queries, entry, width):
        """The ``width`` nearest found from ``entry`` along ``links``, best first."""
        rows, size = len(queries), len(self.vectors)
        seen = np.zeros((rows, size), dtype=bool)
        ids = np.full((rows, width), -1, dtype=np.int32)
        sims = np.full((rows, width), -np.inf, dtype=np.float32)
        ids[:, :1], seen[np.arange(rows), entry[:, 0]] = entry, True
        sims[:, 0] = np.einsum("ij,ij->i", queries, self.vectors[entry[:, 0]])
        closed = ids < 0
        live = np.arange(rows)
        while len(live):
            waiting = np.where(closed[live], -np.inf, sims[live])
            step = min(STEP, width)
            best = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
            good = np.take_along_axis(waiting, best, 1) > -np.inf
            busy = good.any(axis=1)
            live, best, good = live[busy], best[busy], good[busy]
            if not len(live):
                break
            closed[live[:, None], best] = True
            around = links[np.maximum(ids[live[:, None], best], 0)]
            around = np.where(good[:, :, None], around, -1).reshape(len(live), -1)
            around = np.where(seen[live[:, None], np.maximum(around, 0)], -1, around)
            found = np.matmul(self.vectors[np.maximum(around, 0)], queries[live][:, :, None])[:, :, 0]
            around, found = _first_of_each(around, found)
            at_row, at_place = np.nonzero(around >= 0)
            seen[live[at_row], around[at_row, at_place]] = True
            all_ids = np.concatenate([ids[live], around], 1)
            all_sims = np.concatenate([sims[live], found], 1)
            all_closed = np.concatenate([closed[live], around < 0], 1)
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[live] = np.take_along_axis(all_ids, top, 1)
            sims[live] = np.take_along_axis(all_sims, top, 1)
            closed[live] = np.take_along_axis(all_closed, top, 1)
        return _ranked(ids, sims, width)

    def within(self, queries, least, beam, slack=0.05):
        """Pairs ``(query, vector)`` with a similarity of at least ``least`` that the graph leads to.

        A beam search finds the neighbourhood; from there the search spreads along the links as
        long as the vectors it meets are within ``slack`` of the bound, without any cap.
        """
        out = []
        for start in range(0, len(queries), BATCH):
            block = np.ascontiguousarray(queries[start:start + BATCH], dtype=np.float32)
            ids, sims = self._beam(self.layers[0].links, block, self._entries(block, 0)[:, None], beam)
            row, place = np.nonzero(sims >= least - slack)
            found = self._spread(block, row, ids[row, place], least, slack)
            out.append((found[0] + start, found[1]))
        if not out:
            return np.empty(0, int), np.empty(0, int)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def _spread(self, queries, row, node, least, slack, portion=20_000):
        size = len(self.vectors)
        seen = np.zeros((len(queries), size), dtype=bool)
        seen[row, node] = True
        sims = np.einsum("ij,ij->i", queries[row], self.vectors[node])
        rows, nodes = [row[sims >= least]], [node[sims >= least]]
        ahead = [(row, node)]
        while ahead:
            row, node = ahead.pop()
            if len(row) > portion:
                ahead.append((row[portion:], node[portion:]))
                row, node = row[:portion], node[:portion]
            around = self.layers[0].links[node]
            row = np.repeat(row, around.shape[1])
            around = around.ravel()
            fresh = around >= 0
            row, around = row[fresh], around[fresh]
            fresh = ~seen[row, around]
            row, around = row[fresh], around[fresh]
            if not len(row):
                continue
            row, around = np.divmod(np.unique(row.astype(np.int64) * size + around), size)
            seen[row, around] = True
            sims = np.einsum("ij,ij->i", queries[row], self.vectors[around])
            near = sims >= least - slack
            if near.any():
                ahead.append((row[near], around[near]))
                hit = sims >= least
                rows.append(row[hit])
                nodes.append(around[hit])
        return np.concatenate(rows), np.concatenate(nodes)

    # -- moving -----------------------------------------------------------

    def rows(self):
        """Per vector: its highest layer and its links of all layers, as bytes."""
        highest = np.zeros(len(self.vectors), dtype=int)
        for level, members in enumerate(self.members):
            highest[members] = level
        links = [b"".join(self.layers[level].links[node].tobytes() for level in range(highest[node] + 1))
                 for node in range(len(self.vectors))]
        return highest, links

    @classmethod
    def from_rows(cls, vectors, highest, links, neighbours=NEIGHBOURS):
        graph = cls(vectors, neighbours)
        degree, top = 2 * neighbours, int(highest.max())
        graph.layers = [Layer(len(vectors), degree) for _ in range(top + 1)]
        graph.members = [np.flatnonzero(highest >= level) for level in range(top + 1)]
        lists = [np.frombuffer(each, dtype=np.int32).reshape(-1, degree) for each in links]
        for level, members in enumerate(graph.members):
            graph.layers[level].links[members] = np.stack([lists[node][level] for node in members])
        return graph
