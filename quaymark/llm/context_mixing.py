"""Logistic mixing of hashed-context bit predictors: what language-model scoring is made of.

Symbols of a Huffman code are coded bit by bit. Each predictor has a table of counts by the hash of a context
and a code node. Their log-odds are summed with weights, of which a gate chooses the set; an adaptive map
refines the sum. All is learned online, in one pass over what a task reads: a block of bits is predicted from
the counts before it, the error moves weights and map, then the block is counted. Tasks' counts are added up,
their weights and maps averaged by the bits that each has seen.
"""

from __future__ import annotations

import heapq
from array import array

import numpy as np

#: Steps of the map in log-odds from -8 to 8, and gates: eight levels of confidence at each depth in the code.
MAP_STEPS, DEPTHS = 33, 16
GATES = DEPTHS * 8
#: Steps of mixed log-odds in which scoring looks up what a bit costs, and where they end: 32 to a log-odds of one.
COST_STEPS, COST_END = 769, 12
#: Steps that a log-odds of one is stored in.
ODDS_STEPS = 12
#: Levels of a code whose nodes share a line of a hashed table, of 8 slots.
LEVELS, _LINE_BITS = 3, 3
#: What a count begins with.
_PRIOR = 0.3
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of uint32 in which all bits depend on all."""
    x = (x ^ (x >> np.uint32(16))) * _MIX[1]
    x = (x ^ (x >> np.uint32(13))) * _MIX[2]
    return x ^ (x >> np.uint32(16))


def huffman(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, nodes, bits): symbol s is the path ``nodes[starts[s]:starts[s+1]]`` with the bits taken there."""
    n = len(counts)
    parent, bit = [0] * (2 * n), [0] * (2 * n)
    heap = [(max(c, 1), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x] = parent[y] = made
        bit[y] = 1
        heapq.heappush(heap, (a + b, made))
        made += 1
    starts, nodes, bits = array("q", [0]), array("I"), bytearray()  # long: as Python's numbers they are tens of MB of the driver
    for symbol in range(n):
        path, s = [], symbol
        while s != made - 1:
            path.append((parent[s] - n, bit[s]))
            s = parent[s]
        nodes.extend(p for p, _ in reversed(path))
        bits.extend(b for _, b in reversed(path))
        starts.append(len(nodes))
    return np.array(starts, dtype=np.int64), np.array(nodes, dtype=np.uint32), np.frombuffer(bytes(bits), dtype=np.uint8)


def _at(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``table[places]`` for places that are known to be inside."""
    return table.take(places, mode="clip")


class Code:
    """A Huffman code over ``counts`` and what expands symbols into bits."""

    def __init__(self, counts: list[int]):
        self.starts, self.nodes, self.bits = huffman(counts)
        self.lengths = np.diff(self.starts)
        self.width = int(self.nodes.max()) + 1 if len(self.nodes) else 1
        depth = np.arange(len(self.nodes)) - np.repeat(self.starts[:-1], self.lengths)
        # Gate and bit in one, as they are read together; these tables are read at random, so they are small.
        self.flags = (np.minimum(depth, DEPTHS - 1) * 8).astype(np.uint8) << 1 | self.bits
        # The node that a line begins with, and the slot in the line: 0, 1 + bit, 3 + both bits.
        step = depth % LEVELS
        place = np.arange(len(self.nodes))
        before = np.r_[np.uint8(0), self.bits[:-1]].astype(np.uint32), np.r_[np.zeros(2, np.uint8), self.bits[:-2]].astype(np.uint32)[: len(place)]
        self.slot = np.where(step == 0, 0, np.where(step == 1, 1 + before[0], 3 + 2 * before[1] + before[0])).astype(np.uint8)
        self.line = mixed(self.nodes[place - step] * _MIX[0] + np.uint32(1)) if len(place) else self.nodes

    def expand(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the paths of each bit, number of bits of each symbol)."""
        sizes = self.lengths.take(symbols)
        ends = np.cumsum(sizes)
        return np.repeat(self.starts.take(symbols) - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0), sizes


class Mixer:
    """Weights and map, and how many bits they have seen."""

    def __init__(self, tables: int):
        self.weights = np.tile(np.r_[np.full(tables, 1.2 / tables), 0.0].astype(np.float32)[:, None], (1, GATES))
        self.refine = np.tile(np.linspace(-8, 8, MAP_STEPS, dtype=np.float32), GATES)
        self.seen = 0

    def sums(self) -> np.ndarray:
        """What adds up over tasks: bits seen, and weights and map times that."""
        return np.r_[np.float64(self.seen), self.weights.ravel() * float(self.seen), self.refine * float(self.seen)]

    @classmethod
    def mean(cls, tables: int, sums: np.ndarray | None) -> Mixer:
        """Of all tasks' mixers from the total of their ``sums``; as at the beginning where nothing was seen."""
        out = cls(tables)
        if sums is not None and sums[0] > 0:
            both = (sums[1:] / sums[0]).astype(np.float32)
            out.seen, out.weights, out.refine = int(sums[0]), both[: out.weights.size].reshape(out.weights.shape), both[out.weights.size :]
        return out

    def refined(self, z: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Half of ``z``, half of what the map makes of it between two of its steps."""
        place = np.clip((z + np.float32(8)) * np.float32((MAP_STEPS - 1) / 16), np.float32(0), np.float32(MAP_STEPS - 1.001))
        low = place.astype(np.intp)
        cell = gate * MAP_STEPS + low
        left = _at(self.refine, cell)
        return np.float32(0.5) * (z + left + (_at(self.refine, cell + 1) - left) * (place - low.astype(np.float32)))

    def learn(self, x: list[np.ndarray], y: np.ndarray, gate: np.ndarray, rate: float) -> None:
        """Move weights and map by the errors of a block of bits, all predicted before it. ``x`` is used up."""
        z = _at(self.weights[-1], gate)
        for w, xi in zip(self.weights, x, strict=False):
            part = _at(w, gate)
            part *= xi
            z += part
        # Of the map the nearest step alone is moved, so that bits are told apart once.
        place = z * np.float32((MAP_STEPS - 1) / 16)
        place += np.float32((MAP_STEPS - 1) / 2 + 0.5)
        cell = np.clip(place, np.float32(0), np.float32(MAP_STEPS - 0.5), out=place).astype(np.intp)
        cell += gate * MAP_STEPS
        out = _at(self.refine, cell)
        out += z
        out *= np.float32(0.5)
        seen = np.bincount(cell, minlength=len(self.refine))
        step = rate / np.sqrt(seen.reshape(GATES, MAP_STEPS).sum(axis=1) + 1)
        miss = y - _chance(z)
        for w, xi in zip(self.weights, x, strict=False):
            xi *= miss
            w += (step * np.bincount(gate, xi, GATES)).astype(np.float32)
        self.weights[-1] += (step * np.bincount(gate, miss, GATES)).astype(np.float32)
        error = np.bincount(cell, y - _chance(out), len(self.refine))
        self.refine += (0.2 * error / np.sqrt(seen + 1)).astype(np.float32)
        self.seen += len(y)


def _chance(z: np.ndarray) -> np.ndarray:
    """Of a one, from log-odds in float32."""
    p = np.clip(z, np.float32(-30), np.float32(30))
    np.negative(p, out=p)
    np.exp(p, out=p)
    p += np.float32(1)
    return np.reciprocal(p, out=p)


class Predictors:
    """A code, count tables and the mixer over them.

    The first context is a number below ``classes`` and its table has a slot for each class and node; other
    contexts are uint32 hashes, mixed, and share ``1 << bits`` slots each. A task's counts are 32-bit: it sees
    fewer symbols than that.
    """

    def __init__(self, code: Code, classes: int, tables: int, bits: int):
        self.code, self.classes, self.bits, self.tables = code, classes, bits, tables
        self.sizes = [classes * code.width] + [1 << bits] * (tables - 1)
        self.mixer = Mixer(tables)
        self.counts: list[np.ndarray] = []
        self.places = self.cost = None  # made where they are used, so that they don't travel

    def _slots(self, contexts: list[np.ndarray], at: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """``contexts`` as ``_begins`` makes them."""
        first = np.repeat(contexts[0], sizes)
        first += _at(self.code.nodes, at)
        out, place, last = [first], _at(self.places, at), (1 << self.bits) - 1
        for c in contexts[1:]:
            h = np.repeat(c, sizes)
            h += place
            h &= last
            out.append(h)
        return out

    def _begins(self, contexts: list[np.ndarray]) -> list[np.ndarray]:
        """Where each context's slots begin; added to them is the place of a node, modulo the table's size."""
        shift = np.uint32(32 - self.bits + _LINE_BITS)
        if self.places is None:
            self.places = ((self.code.line >> shift).astype(np.int32) << _LINE_BITS) + self.code.slot
        return [contexts[0].astype(np.int64) * self.code.width, *((c >> shift).astype(np.int64) << _LINE_BITS for c in contexts[1:])]

    def learn(self, symbols: np.ndarray, contexts: list[np.ndarray], weight: np.ndarray | None = None, block: int = 1 << 10, rate: float = 0.01) -> None:
        """Predict, correct weights and map, count: block by block. ``weight``: how often each symbol counts."""
        if not self.counts:
            self.counts = [np.zeros(2 * n, dtype=np.uint32) for n in self.sizes]
        contexts = self._begins(contexts)
        for a in range(0, len(symbols), block):
            part = slice(a, a + block)
            at, sizes = self.code.expand(symbols[part])
            flag = _at(self.code.flags, at)
            y = flag & np.uint8(1)
            slots = self._slots([c[part] for c in contexts], at, sizes)
            x = []
            for count, s in zip(self.counts, slots, strict=True):
                pair = _at(count.view(np.uint64), s).view(np.uint32).reshape(-1, 2)
                both = pair.astype(np.float32)
                both += np.float32(_PRIOR)
                odds = both[:, 1] / both[:, 0]
                x.append(np.log(odds, out=odds))
            # The whole part of log2(n0 + n1 + 1) is the exponent of a float.
            sure = np.minimum(pair[:, 0] + pair[:, 1], np.uint32(127)).astype(np.float32)
            sure += np.float32(1)
            gate = (sure.view(np.int32) >> 23).astype(np.intp)
            gate += (flag >> np.uint8(1)).astype(np.int16) - 127
            self.mixer.learn(x, y, gate, rate)
            w = np.uint32(1) if weight is None else np.repeat(weight[part], sizes).astype(np.uint32)
            for count, s in zip(self.counts, slots, strict=True):
                s += s
                s += y
                np.add.at(count, s, w)

    @staticmethod
    def stored(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds (in steps of 1 / ODDS_STEPS) and confidence of slots from their counts, pairs of whole numbers."""
        n0, n1 = counts[::2].astype(np.float64), counts[1::2].astype(np.float64)
        odds = np.clip(np.rint(np.log((n1 + _PRIOR) / (n0 + _PRIOR)) * ODDS_STEPS), -127, 127).astype(np.int8)
        return odds, np.log2(np.minimum(n0 + n1, 127) + 1).astype(np.uint8)

    def frozen(self, odds: list[np.ndarray], sure: np.ndarray, mixer: Mixer) -> Predictors:
        """With the stored form of all counts and the mean mixer, as scoring needs it."""
        # The last table's log-odds and confidence side by side, as they are read together.
        last = np.column_stack([odds[-1].view(np.uint8), sure]).reshape(-1).view("<u2")
        self.odds, self.last, self.mixer, self.counts = odds[:-1], last, mixer, []
        self.scaled = mixer.weights / np.float32(ODDS_STEPS)
        self.cost = None
        return self

    def _costs(self) -> np.ndarray:
        """What a bit costs, in the code's natural unit, by gate, step of the mixed log-odds and bit: log(1 + exp(z)) of the refined z, negative for a one."""
        steps = np.linspace(-COST_END, COST_END, COST_STEPS, dtype=np.float32)
        z = np.concatenate([self.mixer.refined(steps, np.full(COST_STEPS, g)) for g in range(GATES)]).astype(np.float64)
        return np.column_stack([np.logaddexp(0, z), np.logaddexp(0, -z)]).astype(np.float32).ravel()

    def alone(self) -> Predictors:
        """Frozen with its own counts."""
        made = [self.stored(c) for c in self.counts] or [(np.zeros(n, np.int8), np.zeros(n, np.uint8)) for n in self.sizes]
        return self.frozen([o for o, _ in made], made[-1][1], self.mixer)

    def bits_of(self, symbols: np.ndarray, contexts: list[np.ndarray], step: int = 1 << 11) -> np.ndarray:
        """Bits that each symbol takes, once frozen."""
        out = np.zeros(len(symbols))
        code = self.code
        contexts = self._begins(contexts)
        if self.cost is None:
            self.cost = self._costs()
        per_one = (COST_STEPS - 1) / (2 * COST_END)
        for a in range(0, len(symbols), step):
            part = slice(a, a + step)
            at, sizes = code.expand(symbols[part])
            slots = self._slots([c[part] for c in contexts], at, sizes)
            last, flag = _at(self.last, slots[-1]), _at(code.flags, at)
            gate = ((flag >> np.uint8(1)) + (last >> np.uint16(8))).astype(np.intp)
            z = _at(self.mixer.weights[-1], gate)
            for w, odds, s in zip(self.scaled, self.odds, slots, strict=False):
                x = _at(w, gate)
                x *= _at(odds, s)
                z += x
            x = _at(self.scaled[self.tables - 1], gate)
            x *= last.astype(np.int8)
            z += x
            # To the nearest step of a table of costs, the same for both values of a bit.
            z *= np.float32(per_one)
            z += np.float32(COST_END * per_one + 0.5)
            cell = np.clip(z, np.float32(0), np.float32(COST_STEPS - 0.5), out=z).astype(np.intp)
            gate *= COST_STEPS
            cell += gate
            cell += cell
            cell += flag & np.uint8(1)
            out[part] = np.add.reduceat(_at(self.cost, cell), np.cumsum(sizes) - sizes)
        return out / np.log(2)


class Topics:
    """Classes of texts by their words; what a text has shown so far chooses the one that is likeliest.

    ``weight``: per frequent word and class a log-odds in steps of 1/64 (so that sums are exact wherever a text
    begins), and a row of zeros for all other symbols. The class before any symbol is ``n``.
    """

    def __init__(self, words: int, n: int, seed: int = 3):
        self.words, self.n = words, n
        self.weight = np.zeros((words + 1, n), dtype=np.int32)
        self.seed = seed

    def begin(self, counts: np.ndarray) -> Topics:
        """Classes to begin with, drawn for each word; ``counts`` of the words centre them."""
        drawn = np.random.default_rng(self.seed).normal(size=(self.words, self.n))
        drawn -= (drawn * counts[:, None]).sum(axis=0) / max(counts.sum(), 1)
        self.weight[:-1] = np.rint(drawn * 64)
        return self

    def moved(self, sums: np.ndarray) -> Topics:
        """Classes by how often each word (rows) is in texts of each class (columns); a class without texts stays as it is."""
        log_p = np.log((sums + 0.01) / (sums + 0.01).sum(axis=0))
        some = sums.sum(axis=0) > 0
        weight = np.rint((log_p - log_p[:, some].mean(axis=1, keepdims=True)) * 64) if some.any() else np.zeros_like(sums)
        self.weight[:-1] = np.where(some, weight, -64)
        return self

    def count(self, symbols: np.ndarray, times: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """(words, n) sums: each text's frequent words under the class that is likeliest for all of it.

        symbols: a text's frequent words, each once, for all texts that have any; times: how often; kinds: how many a text has.
        """
        if not len(kinds):
            return np.zeros((self.words, self.n), dtype=np.int64)
        times = times.astype(np.int64)
        score = np.add.reduceat(_rows(self.weight, symbols) * times[:, None], np.cumsum(kinds) - kinds, axis=0)
        at = symbols.astype(np.int64) * self.n + np.repeat(score.argmax(axis=1), kinds)
        return np.rint(np.bincount(at, times, self.words * self.n)).astype(np.int64).reshape(self.words, self.n)

    def before(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The class before each symbol of texts of these sizes, laid end to end.

        It is looked at anew at places 0, 1, 2, 4 and every eighth of a text.
        """
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(symbols), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
        cuts = np.flatnonzero((place & 7 == 0) | (place < 5) & (place != 3))
        # Sums over all frequent words before a place, of all texts; a text's are what they are more than at its start.
        frequent = symbols < self.words
        run = np.zeros((np.count_nonzero(frequent) + 1, self.n), dtype=np.int64)
        np.cumsum(_rows(self.weight, symbols[frequent]), axis=0, out=run[1:])
        before = np.cumsum(frequent) - frequent
        run = _rows(run, before[cuts])
        first = np.flatnonzero(place[cuts] == 0)
        run -= np.repeat(run[first], np.diff(np.r_[first, len(cuts)]), axis=0)
        found = run.argmax(axis=1)
        found[~run.any(axis=1)] = self.n
        return np.repeat(found, np.diff(np.r_[cuts, len(symbols)])).astype(np.uint32)


def _rows(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return table.take(places, axis=0, mode="clip")
