"""Operator 7: SentencePiece encoding by Gumbel top-k sampling, and decoding.

A text is a lattice of vocabulary pieces; a segmentation is a path, and its
weight the product of its pieces' weights.  ``k`` distinct segmentations are
drawn without replacement: every path has a Gumbel-perturbed log-probability,
and a perturbed A* search finds the largest ones.  A search node is the set of
paths that leave an already emitted path at one step; its bound is the
(truncated) Gumbel maximum of the set, drawn from the set's exact mass, which
the lattice's backward sums give.  The best set is opened, one of its pieces
is drawn, the path completed, and the rest of the set and the sets along the
new path join the queue.  The perturbed value of the first path not emitted
is the threshold of the inclusion scores.

No piece holds a space after another character or a line feed, so lattices
factor into words; word lattices are built in whole arrays and remembered.
All random numbers are counters hashed with the row key, so a row's samples
do not depend on its neighbours or the partitioning.

The vocabulary file names no weights for a lattice (its merges are ranked), so
a piece of rank r weighs 1 / (r + 2), a byte piece the least of all.

Defined cases: null and empty texts have one segmentation, the empty one; a
text with fewer than ``k`` segmentations gives all of them, each with
inclusion 1; a null key draws like key 0; repeated rows draw alike; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import U64, mix64, prepare, text_column

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES, SEED = 2, 7
MAX_EDGES = 2_000_000    # lattice edges a worker remembers; beyond it the rarer words are forgotten
WORDS_AT_ONCE = 100_000  # words of the texts that are sampled together
AHEAD = 48               # steps of a path whose open sets have bounds at once
WORDS_BUILT = 6_000     # new words whose lattices are built together
_UNIT = re.compile(rb" *+[^ \n]++|\n| ++")
_LATTICES: dict = {}


class Vocabulary:
    """Pieces as bytes (a space for the meta symbol), their log-weights, and a trie of them."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] | np.ndarray = []
        self.weight = np.full(sp.vocab_size(), -np.inf)
        self.byte_piece = np.full(256, -1, dtype=np.int64)
        by_size: dict[int, list[tuple[bytes, int]]] = {}
        rank = 0
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes.append(bytes([value]))
                self.byte_piece[value] = i
                self.weight[i] = -np.log(2.0 * sp.vocab_size())
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes.append(b"")
            else:
                raw = piece.replace("▁", " ").encode()
                if b"\n" in raw or b" " in raw.lstrip(b" "):
                    raise ValueError(f"piece {i} crosses a word border")
                self.bytes.append(raw)
                self.weight[i] = -np.log(rank + 2.0)
                rank += 1
                by_size.setdefault(len(raw), []).append((raw, i))
        self.bytes = np.array([*self.bytes, None], dtype=object)[:-1]
        self._trie([p for pieces in by_size.values() for p in pieces])

    def _trie(self, pieces: list[tuple[bytes, int]]):
        """Transitions (node, byte) -> node in a hash table, first bytes in a plain one, and the piece that ends at a node."""
        nodes: dict[bytes, int] = {b"": 0}
        for raw, _ in pieces:
            for n in range(1, len(raw) + 1):
                nodes.setdefault(raw[:n], len(nodes))
        self.ends = np.full(len(nodes), -1, dtype=np.int32)
        for raw, i in pieces:
            self.ends[nodes[raw]] = i
        keys = np.array([(nodes[k[:-1]] << 8) | k[-1] for k in nodes if k], dtype=np.int64)
        to = np.array([n for k, n in nodes.items() if k], dtype=np.int32)
        self.roots = np.full(256, -1, dtype=np.int64)
        first = keys < 256
        self.roots[keys[first]] = to[first]
        # transitions in a sparse hash table: nearly every look-up ends at its first slot
        self.shift = U64(64 - max(8, int(len(keys) * 8).bit_length()))
        self.slots = np.full((1 << (64 - int(self.shift))) + 64, -1, dtype=np.int64)
        self.nodes = np.full(len(self.slots), -1, dtype=np.int64)
        for key, node, slot in zip(keys.tolist(), to.tolist(), self._slot(keys).tolist()):
            while self.slots[slot] >= 0:
                slot += 1
            self.slots[slot], self.nodes[slot] = key, node
        self.longest = max((len(raw) for raw, _ in pieces), default=0)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(U64) * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _next(self, keys: np.ndarray) -> np.ndarray:
        """The nodes that (node, byte) keys lead to, -1 where none."""
        slot = self._slot(keys)
        held = self.slots[slot]
        other = np.flatnonzero((held != keys) & (held >= 0))
        while len(other):  # taken by another key: the next slot
            slot[other] += 1
            held = self.slots[slot[other]]
            other = other[(held != keys[other]) & (held >= 0)]
        return self.nodes[slot]

    def matches(self, data: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, positions, pieces) of all pieces in ``data``; ``left`` is how far each position may reach."""
        place = np.arange(len(data))
        node = self.roots[data]
        for size in range(1, self.longest + 1):
            live = node >= 0
            place, node = place[live], node[live]
            if not len(place):
                return
            piece = self.ends[node]
            whole = np.flatnonzero(piece >= 0)
            yield size, place[whole], piece[whole]
            more = left[place] > size
            place, node = place[more], node[more]
            node = self._next((node << 8) | data[place + size])

    def decode(self, ids) -> bytes:
        raw = b"".join(self.bytes[np.asarray(ids, dtype=np.int64)].tolist())
        return raw[1:] if raw.startswith(b" ") else raw


class Lattices:
    """Word lattices: for each byte position of each known word its edges, likeliest first."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self):
        self.words: dict[bytes, int] = {}
        self.seen = np.zeros(0, np.int32)           # word -> how often it was looked up
        self.row_of, self.size_of = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)          # row -> first edge
        self.edges = np.zeros(0, np.int32)          # edges of the row, as a count
        self.cum, self.logp = np.zeros(0), np.zeros(0)
        self.step, self.piece = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.n_words = self.n_rows = self.n_edges = 0  # the arrays are longer than what they hold

    def _store(self, name: str, at: int, values: np.ndarray):
        """Put values into an array from ``at`` on; it grows by half at least."""
        array = getattr(self, name)
        if at + len(values) > len(array):
            array = np.concatenate([array[:at], np.zeros(max(len(values), at // 2), array.dtype)])
            setattr(self, name, array)
        array[at:at + len(values)] = values

    def numbers(self, units: list[bytes]) -> np.ndarray:
        """Word numbers, with lattices built for new words; numbers hold until the next call."""
        if self.n_edges > MAX_EDGES:
            self._forget()
        find = self.words.get
        out = np.fromiter(map(find, units, repeat(-1)), dtype=np.int64, count=len(units))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            names = [units[k] for k in missing.tolist()]
            new = list(dict.fromkeys(names))
            for k in range(0, len(new), WORDS_BUILT):
                part = new[k:k + WORDS_BUILT]
                self.words.update(zip(part, range(len(self.words), len(self.words) + len(part))))
                self._add(part)
            out[missing] = np.fromiter(map(self.words.__getitem__, names), dtype=np.int64, count=len(names))
        self.seen[:self.n_words] += np.bincount(out, minlength=self.n_words).astype(np.int32)
        return out

    def _forget(self):
        """Keep the lattices of words met more than once, up to half the room; the others are built anew when needed."""
        rows_end = self.row_of[:self.n_words] + self.size_of[:self.n_words]
        row_edges = np.append(self.first[:self.n_rows], self.n_edges)
        size = row_edges[rows_end] - row_edges[self.row_of[:self.n_words]]
        seen = self.seen[:self.n_words]
        order = np.argsort(-seen, kind="stable")
        keep = np.sort(order[(np.cumsum(size[order]) <= MAX_EDGES // 2) & (seen[order] > 1)])
        if not len(keep):
            return self.clear()

        def spans(start, n):
            return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())

        names = list(self.words)
        rows = spans(self.row_of[keep], self.size_of[keep])
        edges = spans(self.first[rows], self.edges[rows].astype(np.int64))
        self.words = {names[k]: n for n, k in enumerate(keep.tolist())}
        count = self.edges[rows]
        size = self.size_of[keep]
        for name, values in (("size_of", size), ("row_of", np.cumsum(size) - size), ("seen", np.ones(len(keep), np.int32)),
                             ("edges", count), ("first", np.cumsum(count, dtype=np.int64) - count),
                             *[(x, getattr(self, x)[edges]) for x in ("cum", "logp", "step", "piece")]):
            getattr(self, name)[:len(values)] = values  # in place: the arrays keep their room
        self.n_words, self.n_rows, self.n_edges = len(keep), len(rows), len(edges)

    def _add(self, words: list[bytes]):
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        left = np.repeat(ends, sizes) - np.arange(len(data))
        lead = (data & 0xC0) != 0x80
        width = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
        covered = ~lead
        at, step, piece = [], [], []
        for size, place, found in self.v.matches(data, left):
            covered[place[width[place] == size]] = True
            at.append(place)
            step.append(np.full(len(place), size, dtype=np.int32))
            piece.append(found)
        bare = np.flatnonzero(~covered)  # characters that no piece has: byte by byte
        for k in range(4):
            place = bare[width[bare] > k] + k
            at.append(place)
            step.append(np.ones(len(place), dtype=np.int32))
            piece.append(self.v.byte_piece[data[place]])
        at, step, piece = np.concatenate(at), np.concatenate(step), np.concatenate(piece)
        order = np.argsort(at, kind="stable")  # ordered runs, one a size; the sorts below then find edges nearly in place
        at, step, piece = at[order], step[order], piece[order]
        weight = self.v.weight[piece]
        beta = self._backward(len(data), at, step, weight, left, ends)
        logp = weight + np.where(step == left[at], 0.0, beta[np.minimum(at + step, len(data) - 1)]) - beta[at]
        p = np.exp(logp)
        order = np.argsort(at - 0.9 * p, kind="stable")  # by position, likeliest first
        at, step, piece, logp, p = at[order], step[order], piece[order], logp[order], p[order]
        edges = np.bincount(at, minlength=len(data))
        first = np.cumsum(edges) - edges
        total = np.cumsum(p)
        cum = total - (total - p)[first[at]]
        cum[(first + edges - 1)[edges > 0]] = 2.0  # the last edge takes what rounding leaves
        for name, at0, values in (
                ("row_of", self.n_words, starts + self.n_rows), ("size_of", self.n_words, sizes),
                ("seen", self.n_words, np.zeros(len(words), np.int32)), ("first", self.n_rows, first + self.n_edges),
                ("edges", self.n_rows, edges), ("cum", self.n_edges, cum), ("logp", self.n_edges, np.minimum(logp, 0.0)),
                ("step", self.n_edges, step), ("piece", self.n_edges, piece)):
            self._store(name, at0, values)
        self.n_words, self.n_rows, self.n_edges = self.n_words + len(words), self.n_rows + len(data), self.n_edges + len(cum)

    @staticmethod
    def _backward(n, at, step, weight, left, ends) -> np.ndarray:
        """Log of the summed weight of all paths from each position to the end of its word; ``at`` ascends."""
        beta = np.full(n, -np.inf)
        reach = left[at]
        # sizes of two bytes are sorted by radix
        order = np.argsort(reach.astype(np.uint16) if n < 1 << 16 or reach.max(initial=0) < 1 << 16 else reach, kind="stable")
        a, s, w, d = at[order], step[order], weight[order], reach[order]
        cuts = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]])) if len(a) else np.zeros(0, np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            for x, y in zip(cuts, np.append(cuts[1:], len(a))):
                rows, steps = a[x:y], s[x:y]
                v = w[x:y] + np.where(steps == d[x], 0.0, beta[np.minimum(rows + steps, n - 1)])
                if y - x < 8:  # one long word: a few edges at a time
                    for r in set(rows.tolist()):
                        beta[r] = np.logaddexp.reduce(v[rows == r])
                    continue
                heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                top = np.maximum.reduceat(v, heads)
                shift = np.repeat(top, np.diff(np.append(heads, len(rows))))
                total = np.add.reduceat(np.where(np.isfinite(shift), np.exp(v - shift), 0.0), heads)
                beta[rows[heads]] = top + np.log(total)
        return beta

    def walk(self, row: np.ndarray, left: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw a path from each row over ``left`` bytes: edges, and the number of edges of each path."""
        who, what, when = [], [], []
        live, step = np.flatnonzero(left > 0), 0
        row, left = row.copy(), left.copy()
        while len(live) > 16:
            e = self._draw(row[live], uniforms(key[live], step))
            who.append(live)
            what.append(e)
            when.append(np.full(len(live), step, dtype=np.int32))
            row[live] += self.step[e]
            left[live] -= self.step[e]
            live = live[left[live] > 0]
            step += 1
        for k in live.tolist():  # a few long words: one by one, numbers drawn ahead
            r, l, s, path = int(row[k]), int(left[k]), step, []
            u = uniforms(np.full(l, key[k], dtype=U64), np.arange(s, s + l))
            while l > 0:
                e = int(self.first[r])
                while u[s - step] >= self.cum[e]:
                    e += 1
                path.append(e)
                r, l, s = r + int(self.step[e]), l - int(self.step[e]), s + 1
            who.append(np.full(len(path), k))
            what.append(np.array(path, dtype=np.int64))
            when.append(np.arange(step, s, dtype=np.int32))
        if not who:
            return np.zeros(0, np.int64), np.zeros(len(row), np.int64)
        who, what, when = np.concatenate(who), np.concatenate(what), np.concatenate(when)
        count = np.bincount(who, minlength=len(row))
        out = np.empty(len(what), dtype=np.int64)
        out[(np.cumsum(count) - count)[who] + when] = what
        return out, count

    def _draw(self, row: np.ndarray, u: np.ndarray) -> np.ndarray:
        e = self.first[row]
        miss = np.flatnonzero(u >= self.cum[e])
        while len(miss):
            e[miss] += 1
            miss = miss[u[miss] >= self.cum[e[miss]]]
        return e


def uniforms(key: np.ndarray, counter) -> np.ndarray:
    """Numbers in (0, 1) from keys and counters."""
    x = mix64(key + np.asarray(counter).astype(U64) * U64(0x9E3779B97F4A7C15))
    return ((x >> U64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def _truncated(mass, bound, u):
    """Gumbel values with log-masses ``mass``, given that they lie below ``bound``."""
    with np.errstate(divide="ignore", over="ignore"):
        return -np.logaddexp(-bound, np.log(-np.log(u)) - mass)


class Paths:
    """One path of each of many texts, end to end in flat arrays, with the bounds of the sets that leave it.

    A path's first ``AHEAD`` steps after ``since`` have bounds of their own; all
    later ones form one set until it is the best.
    """

    def __init__(self, n: int, keys: np.ndarray, lattices: Lattices, edges, rows, words, starts, since, values):
        self.l, self.edges, self.rows, self.words, self.starts, self.since = lattices, edges, rows, words, starts, since
        self.salt = mix64(keys + U64(977 * (n + 1)))
        self.logp = lattices.logp[edges]
        total = np.concatenate([[0.0], np.cumsum(self.logp)])
        self.size = np.diff(starts)
        self.before = total - np.repeat(total[starts[:-1]], np.append(self.size[:-1], self.size[-1] + 1)) if len(starts) > 1 else total
        self.total = total[starts[1:]] - total[starts[:-1]]
        self.values = values
        at = since[:, None] + np.arange(AHEAD)
        inside = at < self.size[:, None]
        place = np.where(inside, starts[:-1, None] + at, 0)
        near = np.minimum(self.size, since + AHEAD)
        tail_before = np.where(near < self.size, self.before[np.minimum(starts[:-1] + near, len(edges))], 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            mass = self.before[place] + np.log(-np.expm1(self.logp[place])) if len(edges) else np.zeros(at.shape)
            mass = np.where(inside, mass, -np.inf)
            tail = np.where(near < self.size, tail_before + np.log(-np.expm1(np.minimum(self.total - tail_before, 0.0))), -np.inf)
            mass = np.concatenate([mass, tail[:, None]], axis=1)
            u = uniforms(self.salt[:, None], np.arange(AHEAD + 1) + since[:, None])
            self.bounds = _truncated(mass, values[:, None], u)


class Search:
    """Emitted paths of one text (its places in :class:`Paths`) and the open sets beside them."""

    def __init__(self, lattices: Lattices):
        self.l = lattices
        self.paths: list[dict] = []
        self.closed: dict[tuple[int, int], list[int]] = {}

    def add(self, p: Paths, d: int):
        span = slice(p.starts[d], p.starts[d + 1])
        self.paths.append({"edges": p.edges[span], "rows": p.rows[span], "words": p.words[span], "before": p.before[span],
                           "since": int(p.since[d]), "logp": float(p.total[d]), "value": float(p.values[d]),
                           "salt": int(p.salt[d]), "bounds": p.bounds[d], "folded": True})

    def _unfold(self, p: dict):
        """Give the steps beyond the near ones bounds of their own: one of them has the bound of them all."""
        near, value = p["since"] + AHEAD, float(p["bounds"][-1])
        logp = self.l.logp[p["edges"][near:]]
        with np.errstate(divide="ignore"):
            mass = p["before"][near:] + np.log(-np.expm1(logp))
        u = uniforms(np.full(len(logp) + 1, p["salt"], dtype=U64), np.arange(near + 1, near + 2 + len(logp)))
        share = np.cumsum(np.exp(mass - mass.max()))
        top = min(int(np.searchsorted(share, u[0] * share[-1], side="right")), len(share) - 1)
        bounds = _truncated(mass, value, u[1:])
        bounds[top] = value
        p["bounds"], p["folded"] = np.concatenate([p["bounds"][:-1], bounds]), False

    def best(self) -> tuple[float, int, int]:
        """The largest bound of an open set: its value, path and place among the path's bounds."""
        top = (-np.inf, -1, -1)
        for n, p in enumerate(self.paths):
            k = int(p["bounds"].argmax())
            if p["bounds"][k] > top[0]:
                top = (float(p["bounds"][k]), n, k)
        return top

    def branch(self, u: np.ndarray) -> tuple | None:
        """Open the best set and draw (by two numbers) the piece by which the next path leaves it; close that piece in the set."""
        value, n, k = self.best()
        if n < 0:
            return None
        p = self.paths[n]
        if p["folded"] and k == AHEAD:
            self._unfold(p)
            value, n, k = self.best()
        t = p["since"] + k
        row = int(p["rows"][t])
        closed = self.closed.setdefault((n, t), [int(p["edges"][t])])
        lo, hi = int(self.l.first[row]), int(self.l.first[row] + self.l.edges[row])
        free = [e for e in range(lo, hi) if e not in closed]
        mass = np.exp(self.l.logp[free])
        e = free[min(int(np.searchsorted(np.cumsum(mass), u[0] * mass.sum(), side="right")), len(free) - 1)]
        closed.append(e)
        rest = [f for f in free if f != e]
        if p["bounds"].base is not None:
            p["bounds"] = p["bounds"].copy()
        p["bounds"][k] = _truncated(p["before"][t] + np.log(np.exp(self.l.logp[rest]).sum()), value, u[1]) if rest else -np.inf
        return value, n, t, e


def _units(text: str) -> list[bytes]:
    return _UNIT.findall(b" " + text.encode()) if text else []


def sample_texts(texts: list[str], keys: np.ndarray, lattices: Lattices, k: int) -> list[list[dict]]:
    """For each text its ``k`` sampled segmentations (fewer if it has fewer), largest perturbed value first.

    ``keys`` are hashed row keys.  Walks of all texts are drawn together.
    """
    units = [_units(t) for t in texts]
    flat = list(chain.from_iterable(units))
    numbers = lattices.numbers(flat)
    row, size = lattices.row_of[numbers], lattices.size_of[numbers]
    n_words = np.array([len(us) for us in units], dtype=np.int64)
    word0 = np.concatenate([[0], np.cumsum(n_words)])
    owner = np.repeat(np.arange(len(texts)), n_words)
    word_no = (np.arange(len(flat)) - word0[:-1][owner]).astype(U64)
    base = mix64(keys[owner] + word_no * U64(0xD6E8FEB86659FD93))
    edges, count = lattices.walk(row, size, base)
    step0 = np.concatenate([[0], np.cumsum(count)])
    ahead = np.cumsum(lattices.step[edges]) - lattices.step[edges] if len(edges) else np.zeros(0, np.int64)
    of_word = np.repeat(np.arange(len(flat)), count)
    rows = row[of_word] + ahead - ahead[np.minimum(step0[:-1], max(len(ahead) - 1, 0))][of_word] if len(edges) else ahead
    u = uniforms(keys, 1)
    paths = Paths(0, keys, lattices, edges, rows, of_word - np.repeat(word0[:-1], n_words)[of_word], step0[word0],
                  np.zeros(len(texts), np.int64), -np.log(-np.log(u)))
    searches = [Search(lattices) for _ in texts]
    for d, s in enumerate(searches):
        s.add(paths, d)
    for j in range(1, k):
        branches = [s.branch(x) for s, x in zip(searches, uniforms(keys[:, None], 10_007 + 2 * j + np.arange(2)))]
        r, left, key, sizes = [], [], [], []
        for d, br in enumerate(branches):
            if br is None:
                sizes.append(0)
                continue
            value, n, t, e = br
            p = searches[d].paths[n]
            cur = word0[d] + int(p["words"][t])
            done = int(p["rows"][t]) - int(row[cur]) + int(lattices.step[e])
            span = slice(cur + 1, word0[d + 1])
            r += [row[cur:cur + 1] + done, row[span]]
            left += [size[cur:cur + 1] - done, size[span]]
            key.append(base[cur:word0[d + 1]])
            sizes.append(word0[d + 1] - cur)
        if not r:
            break
        r, left = np.concatenate(r), np.concatenate(left)
        more, many = lattices.walk(r, left, mix64(np.concatenate(key) + U64(7919 * j)))
        ends = np.concatenate([[0], np.cumsum(many)])
        own = np.repeat(np.arange(len(r)), many)
        far = np.cumsum(lattices.step[more]) - lattices.step[more] if len(more) else np.zeros(0, np.int64)
        place = r[own] + far - far[np.minimum(ends[:-1], max(len(far) - 1, 0))][own] if len(more) else far
        at, new_edges, new_rows, new_words, starts, since, values, who = 0, [], [], [], [0], [], [], []
        for d, br in enumerate(branches):
            if br is None:
                continue
            value, n, t, e = br
            p, m = searches[d].paths[n], int(sizes[d])
            x, y = ends[at], ends[at + m]
            w = p["words"][t]
            new_edges += [p["edges"][:t], [e], more[x:y]]
            new_rows += [p["rows"][:t + 1], place[x:y]]
            new_words += [p["words"][:t + 1], own[x:y] + (w - at)]
            starts.append(starts[-1] + t + 1 + int(y - x))
            since.append(t + 1)
            values.append(value)
            who.append(d)
            at += m
        paths = Paths(j, keys[who], lattices, np.concatenate(new_edges).astype(np.int64), np.concatenate(new_rows),
                      np.concatenate(new_words), np.array(starts), np.array(since), np.array(values))
        for n, d in enumerate(who):
            searches[d].add(paths, n)
    out = []
    for s in searches:
        bound = s.best()[0]
        found = []
        for p in s.paths:
            gap = p["logp"] - bound
            inclusion = gap if gap < -18 else float(np.log(-np.expm1(-np.exp(min(gap, 700.0)))))
            found.append({"ids": lattices.piece[p["edges"]], "log_prob": p["logp"], "value": p["value"],
                          "log_inclusion": inclusion})
        out.append(found)
    return out


def lattices_of(model: str) -> Lattices:
    if model not in _LATTICES:
        _LATTICES[model] = Lattices(Vocabulary(model))
    return _LATTICES[model]


def _portions(b: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for i, t in zip(b.column(0).to_pylist(), b.column(1)):
        t = t.as_py()
        ids.append(i)
        texts.append(t)
        size += len(t) // 6 + 1
        if size > WORDS_AT_ONCE:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES,
           seed: int = SEED, model: str = DEFAULT_MODEL) -> DataFrame:
    """``samples`` distinct segmentations of every text.

    Columns: id, sample, ids, log_prob, perturbed, log_inclusion, and
    ``decoded_xxh64``, the XXH64 (seed 42) of the text the ids decode to.
    """
    prepare(docs.sparkSession)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = lattices_of(model)
        for b in batches:
            for ids, texts in _portions(b):
                keys = mix64(np.array([0 if i is None else i for i in ids], dtype=np.int64).view(U64) ^ mix64(np.array([seed], dtype=U64)))
                found = sample_texts(texts, keys, lattices, samples)
                rows = [(i, n, p) for i, ps in zip(ids, found) for n, p in enumerate(ps, 1)]
                sizes = np.cumsum([0] + [len(p["ids"]) for _, _, p in rows])
                flat = np.concatenate([p["ids"] for _, _, p in rows]) if rows else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _, _ in rows], type=pa.int64()), pa.array([n for _, n, _ in rows], type=pa.int32()),
                     pa.ListArray.from_arrays(pa.array(sizes, type=pa.int32()), pa.array(flat, type=pa.int32())),
                     *[pa.array([p[c] for _, _, p in rows], type=pa.float64()) for c in ("log_prob", "value", "log_inclusion")],
                     pa.array([xxhash.xxh64_intdigest(lattices.v.decode(p["ids"]), 42) for _, _, p in rows],
                              type=pa.uint64()).view(pa.int64())],
                    names=["_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", "decoded_xxh64"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_column(text_col).alias("_t"))
    return rows.mapInArrow(draw, "_id long, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, "
                           "decoded_xxh64 long") \
        .withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", model: str = DEFAULT_MODEL) -> DataFrame:
    """The text of every row's piece ids, in place of them as column ``text``."""
    keep = [c for c in encoded.columns if c != ids_col]
    schema = encoded.select(*keep).schema.add("text", "string")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = lattices_of(model).v
        for b in batches:
            texts = [v.decode(x.as_py() or ()).decode("utf-8", "replace") for x in b.column("_ids")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(texts, type=pa.string())],
                                             names=[*keep, "text"])

    return encoded.select(*keep, F.col(ids_col).alias("_ids")).mapInArrow(join, schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """:func:`encode` with the count and the hash of the ids beside them."""
    found = encode(docs, id_col, text_col, **options)
    return found.withColumn("n_pieces", F.size("ids")).withColumn("ids_xxh64", F.xxhash64("ids"))
