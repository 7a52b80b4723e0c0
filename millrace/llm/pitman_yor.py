"""A hierarchical Pitman-Yor language model of words, over a model of their spelling.

The token after two others comes from their restaurant, whose dishes come from the restaurant of the nearer one, whose dishes
come from a root restaurant that all share. A new word there comes from a spelling model: bytes whose restaurants, of contexts
of three, two and one bytes, share parents in the same way. Every word and every context of the training texts has its place;
what is kept grows with the corpus and is spread over parts by the nearer word, so a word's restaurants are one task's.

A customer is an occurrence; its table's first customer is one of the parent restaurant. Restaurants are kept by counts,
customers and tables of each dish, and table sizes are integrated out by generalised Stirling numbers. Seatings are sampled
by Gibbs: given an auxiliary gamma variable of its restaurant, a dish's tables do not depend on the other dishes', so all are
drawn at once, and every change is passed on to the parent's customers. Strengths are sampled, discounts estimated from how many
dishes have one customer and two. Predictive probabilities are averaged over samples. The parts' tables make the root's
customers between two rounds of sweeps.

A word of more tokens than a part holds has several restaurants: it is divided by the word before it and, where that is such a
word too, by a hash of the text, so that no pair of words is one task's.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T
from millrace.llm.bpe import distinct
from millrace.llm.scratch import Scratch, release

U = np.uint64
#: Symbols: 0 is the end of a text, 1 the end of a word, 2 an escape for rare bytes, the others the most frequent bytes.
END, WORD_END, ESCAPE = 0, 1, 2
#: Discounts and first strengths of spelling restaurants of contexts of 0, 1, 2 and 3 symbols.
DISCOUNT = (0.1, 0.3, 0.5, 0.6)
STRENGTH = (1.0, 1.0, 1.0, 1.0)
#: Hashes that stand for the start and the end of a text.
START_WORD, END_WORD = U(0x5354415254), U(0x454E44)
#: Largest count for which table counts are drawn by exact Stirling numbers; beyond, by their limit.
EXACT = 128
#: Restaurants of up to so many customers, or tables, draw the auxiliary variables of their strength together.
ALIKE = 128


@functools.cache
def stirling_table(discount: float) -> np.ndarray:
    """[c, t]: log of the generalised Stirling number, the weight of all seatings of c customers at t tables."""
    log_s = np.full((EXACT + 1, EXACT + 1), -np.inf)
    log_s[0, 0] = 0.0
    for c in range(1, EXACT + 1):
        weight = c - 1 - discount * np.arange(1, c + 1)
        old = log_s[c - 1, 1 : c + 1] + np.log(np.maximum(weight, 1e-300))
        old[weight <= 0] = -np.inf
        log_s[c, 1 : c + 1] = np.logaddexp(old, log_s[c - 1, :c])
    return log_s


@functools.cache
def leave_rates(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """log(customers per table) and the lone customers per table in units of discount, by the saddle point of the tables' series."""
    y = np.exp(-np.logspace(-5, 2.5, 2000))
    lone = (1 - y) / (1 - y**discount)
    return np.log(discount * lone) + (discount - 1) * np.log(y), lone


#: Places and weights of a Gauss sum from 0 to 1.
_NODES = [x / 2 + shift for x, shift in zip(np.polynomial.legendre.leggauss(5), (0.5, 0.0), strict=True)]


def discount_of(customers: np.ndarray) -> float:
    """Discount of restaurants by their dishes of one customer and of two, to two decimals, so that tables of it are few."""
    one, two = int((customers == 1).sum()), int((customers == 2).sum())
    return round(min(0.95, max(0.05, one / max(one + 2 * two, 1))), 2)


class Level:
    """Restaurants of one context length. Dishes are sorted by restaurant; `up` is each dish's place in the parent level.

    `many` are the dishes of several customers in the first seating. Only they ever choose: where a dish of the level below may come to have
    two tables it has two in that seating, so any other dish keeps its one customer, and its one table, in every sweep. What
    changes is kept for `many` and their restaurants, the `busy` ones.
    """

    def __init__(self, discount: float, theta: float, context: np.ndarray, symbol: np.ndarray, customers: np.ndarray):
        self.d, self.theta = discount, theta
        self.context, self.symbol = context, symbol
        customers = customers.astype(np.int64)
        head = _heads(context)
        self.first = np.flatnonzero(head)  # of each restaurant
        self.rest = (np.cumsum(head) - 1).astype(np.int32)  # restaurant of each dish
        self.n_rest = len(self.first)
        self.few = np.minimum(customers, 1).astype(np.int8)
        self.many = np.flatnonzero(customers > 1)
        self.guests = customers[self.many]
        self.seated = np.minimum(self.guests, np.ceil(self.guests**self.d).astype(np.int64))  # as a seating grows
        self.sent = self.seated.copy()  # tables that the parent has as customers
        self.up: np.ndarray | None = None
        self.least = np.add.reduceat(self.few, self.first, dtype=np.int64) if self.n_rest else np.zeros(0, np.int64)
        rest = self.rest[self.many]
        head = _heads(rest)
        self.heads, self.group = np.flatnonzero(head), np.cumsum(head) - 1
        self.busy = rest[self.heads]
        quiet = np.ones(self.n_rest, bool)
        quiet[self.busy] = False
        quiet = self.least[quiet]  # customers and tables of the other restaurants
        self.quiet, self.quiet_large = _histogram(quiet), quiet[quiet > ALIKE]

    def _full(self, of_many: np.ndarray) -> np.ndarray:
        out = self.few.astype(np.int64)
        out[self.many] = of_many
        return out

    @property
    def c(self) -> np.ndarray:
        """Customers of each dish."""
        return self._full(self.guests)

    @property
    def t(self) -> np.ndarray:
        """Tables of each dish."""
        return self._full(self.seated)

    def busy_totals(self, of_many: np.ndarray) -> np.ndarray:
        return self.least[self.busy] + (np.add.reduceat(of_many - 1, self.heads) if len(self.heads) else 0)

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        c, t = self.least.copy(), self.least.copy()
        c[self.busy], t[self.busy] = self.busy_totals(self.guests), self.busy_totals(self.seated)
        return c, t

    def predictive(self, parent: np.ndarray) -> np.ndarray:
        """Probability of each dish in its restaurant, given that of its symbol in the parent's."""
        c, t = self.totals()
        size, scale = np.diff(self.first, append=len(self.rest)), 1 / (self.theta + c)
        out = np.repeat((self.theta + self.d * t) * scale, size)
        out *= parent
        own = np.repeat((1 - self.d) * scale, size)
        own *= self.few
        out += own
        out[self.many] += (self.guests - 1 - self.d * (self.seated - 1)) * scale[self.rest[self.many]]
        return out

    def predictive_of_many(self, parent: np.ndarray) -> np.ndarray:
        """The same for `many` only, given the parent's for these."""
        c, t = self.busy_totals(self.guests), self.busy_totals(self.seated)
        scale = 1 / (self.theta + c)
        out = ((self.theta + self.d * t) * scale)[self.group] * parent
        out += (self.guests - self.d * self.seated) * scale[self.group]
        return out

    def move(self, parent: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Seat all customers of `many` again: draw a dish's tables given its customers. Returns the change in tables of each.

        Given a gamma variable g of the restaurant's tables, the weight of t tables is the Stirling number times (d g p) ** t. Of many
        customers it is near a Poisson law of t - 1, from which a proposal is drawn. parent: p of the symbols of `many`.
        """
        c, d = self.guests, self.d
        out = np.ones(len(c), np.int64)  # one customer has one table
        seated = np.clip(self.seated, 1, c)  # the customers may have changed
        g = rng.standard_gamma(self.theta / d + self.busy_totals(seated))
        gp = g[self.group]
        gp *= np.clip(parent, 1e-300, 1.0)
        np.maximum(gp, 1e-300, out=gp)
        two = np.flatnonzero(c == 2)
        weight = d * gp[two]
        out[two] += rng.random(len(two)) * (1 - d + weight) < weight
        wide, log_s, more = 4, stirling_table(d), np.flatnonzero(c > 2)
        size = c[more]
        most = size.max(initial=0)
        while wide <= EXACT and wide // 2 < most:
            few = more[(size > wide // 2) & (size <= wide)]
            for at in range(0, len(few), 1 << 14):
                i = few[at : at + (1 << 14)]
                weight = log_s[c[i], 1 : wide + 1] + np.log(d * gp[i])[:, None] * np.arange(1, wide + 1)
                weight -= weight.max(axis=1)[:, None]
                weight = np.cumsum(np.exp(weight, out=weight), axis=1, out=weight)
                t = (weight <= (rng.random(len(i)) * weight[:, -1])[:, None]).sum(axis=1)
                out[i] = np.minimum(1 + t, c[i])
            wide *= 2
        i = more[size > EXACT]
        if len(i):
            lone = lambda t: np.interp(np.log(c[i] / t), *leave_rates(d))
            t, few = seated[i], gp[i]
            mean = few / lone(t)
            new = np.minimum(1 + rng.poisson(np.minimum(mean, 1e15)), c[i])
            back = few / lone(new)
            # the law's leaving rate changes with t: the proposal is accepted by Metropolis and Hastings, with sums as integrals
            drift = sum(w * np.log(lone(t + 0.5 + (new - t) * x)) for x, w in zip(*_NODES, strict=True)) * (new - t)
            gain = (new - t) * np.log(few) - drift - ((new - 1) * np.log(mean) - mean) + ((t - 1) * np.log(back) - back)
            out[i] = np.where(np.log(rng.random(len(i))) < gain, new, t)
        change, self.seated, self.sent = out - self.sent, out, out.copy()
        return change

    def draw_strength(self, rng: np.random.Generator) -> None:
        """Strength given the seating, of a gamma prior of mean 1, by the usual auxiliary beta and Bernoulli variables.

        Of these only sums are asked for: the log of a beta variable of c customers is minus the sum of exponential ones of rates
        theta + 1 to theta + c - 1, so restaurants share a gamma variable for each rate, and a binomial one for each number of tables.
        """
        c, t = self.busy_totals(self.guests), self.busy_totals(self.seated)
        k = np.arange(1, ALIKE + 1)
        have = _at_least((self.quiet + _histogram(c))[: ALIKE + 1])[2:]  # of up to ALIKE customers, those that have k + 1
        logs = -(rng.standard_gamma(have) / (self.theta + k[:-1])).sum()
        large = np.append(self.quiet_large, c[c > ALIKE])
        logs += np.log(rng.beta(self.theta + 1, large - 1)).sum()
        ones = rng.binomial(_at_least(self.quiet + _histogram(t))[2:], self.theta / (self.theta + self.d * k)).sum()
        more = np.append(self.quiet_large, t[t > ALIKE]) - 1 - ALIKE
        place = T.ragged(np.full(len(more), ALIKE + 1), more)
        ones += (rng.random(len(place)) < self.theta / (self.theta + self.d * place)).sum()
        self.theta = max(1e-3, float(rng.gamma(1.0 + ones, 1.0 / (1.0 - logs))))


def _heads(ascending: np.ndarray) -> np.ndarray:
    """Whether each is the first of its value."""
    return np.append(True, ascending[1:] != ascending[:-1])[: len(ascending)]


def _histogram(totals: np.ndarray) -> np.ndarray:
    """How many restaurants have 0, 1, ... ALIKE, and more."""
    return np.bincount(np.minimum(totals, ALIKE + 1), minlength=ALIKE + 2)


def _at_least(histogram: np.ndarray) -> np.ndarray:
    return np.cumsum(histogram[::-1])[::-1]


def sub_levels(context: np.ndarray, symbol: np.ndarray, count: np.ndarray, base: int) -> list[Level]:
    """The levels of 1, 2 and 3 symbols for rows of full contexts; a context is a number in `base`, nearest symbol last.

    Only the longest contexts have customers of their own; those of the others are the tables below.
    """
    levels = [Level(DISCOUNT[3], STRENGTH[3], context, symbol, count)]
    for order in (2, 1):
        low = levels[0]
        short = low.context % base**order
        key, place = np.unique(short * base + low.symbol, return_inverse=True)
        low.up = place
        levels.insert(0, Level(DISCOUNT[order], STRENGTH[order], key // base, key % base, np.bincount(place, weights=low.t, minlength=len(key))))
    return levels


def sample(levels: list[Level], root: np.ndarray, sweeps: int, burn_in: int, seed: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(sweep, predictive probabilities of each level's dishes) after burn_in sweeps over one subtree, root's P by symbol.

    After each sweep a level's customers are the tables of the level below, dish by dish.
    """
    rng = np.random.default_rng(seed)
    top = root[levels[0].symbol]
    top_of_many, up_of_many = top[levels[0].many], [np.zeros(0, np.int64)]
    for up, level in zip(levels, levels[1:]):  # the parent of one of many is one of many
        place = np.full(len(up.few), -1, np.int32)
        place[up.many] = np.arange(len(up.many))
        up_of_many.append(place[level.up[level.many]])

    for sweep in range(sweeps):
        above = [top_of_many]
        for level, up in zip(levels, up_of_many[1:]):
            above.append(level.predictive_of_many(above[-1])[up])
        for i in range(len(levels) - 1, -1, -1):
            change = levels[i].move(above[i], rng)
            if i:
                up = levels[i - 1]
                up.guests = up.guests + np.bincount(up_of_many[i], weights=change, minlength=len(up.many)).astype(np.int64)
            levels[i].draw_strength(rng)
        if sweep >= burn_in:
            probs = [levels[0].predictive(top)]
            for level in levels[1:]:
                probs.append(level.predictive(probs[-1][level.up]))
            yield sweep, probs


def backoff(level: Level) -> np.ndarray:
    c, t = level.totals()
    return (level.theta + level.d * t) / (level.theta + c)


def dense_subtree(rows: pa.Table, root: np.ndarray, base: int, sweeps: int, burn_in: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Averaged P(symbol | context) for all contexts that end in one symbol, as [farthest, middle, symbol]; tables per symbol."""
    context, symbol, count = (rows[k].to_numpy() for k in ("context", "symbol", "n"))
    o = np.lexsort((symbol, context))
    context, symbol, count = context[o], symbol[o], count[o]
    levels = sub_levels(context, symbol, count, base)
    total, n = np.zeros((base, base, base)), 0
    for _, probs in sample(levels, root, sweeps, burn_in, seed):
        one = backoff(levels[0])[0] * root
        one[levels[0].symbol] = probs[0]
        two = np.tile(one, (base, 1))
        mid = levels[1].context // base
        two[mid] = 0  # filled below
        two[np.unique(mid)] = backoff(levels[1])[:, None] * one
        two[mid, levels[1].symbol] = probs[1]
        three = np.broadcast_to(two, (base, base, base)).copy()
        far, mid = levels[2].context // base**2, levels[2].context // base % base
        head = np.flatnonzero(np.append(True, levels[2].context[1:] != levels[2].context[:-1]))
        three[far[head], mid[head]] = backoff(levels[2])[:, None] * two[mid[head]]
        three[far, mid, levels[2].symbol] = probs[2]
        total += three
        n += 1
    return total / n, np.bincount(levels[0].symbol, weights=levels[0].t, minlength=base)


def spell(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, symbols, first symbol of each word): a word is its bytes and an end, and starts as after ends of text."""
    lens = ends - starts
    first = np.append(0, np.cumsum(lens + 1))
    sym = np.full(int(first[-1]), WORD_END, np.int32)
    inside = np.ones(len(sym), bool)
    inside[first[1:] - 1] = False
    sym[inside] = code[low[T.ragged(starts, lens)]]
    place = np.arange(len(sym)) - np.repeat(first[:-1], lens + 1)
    context = np.zeros(len(sym), np.int32)
    for k in (3, 2, 1):
        prev = np.zeros(len(sym), np.int32)
        prev[k:] = sym[:-k] if len(sym) > k else 0
        prev[place < k] = END
        context = context * base + prev
    return context, sym, first


ROWS_DDL = "part int, kind string, data binary"


def _batch(rows: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.binary())], names=["part", "kind", "data"])


def _batches(rows: list[tuple[int, str, bytes]]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 64):
        yield _batch(rows[i : i + 64])


def word_counts(parts: int):
    """Training texts to a task's counts of words, by hash, of bytes, and of words and texts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_byte, totals = np.zeros(256, np.int64), np.zeros(2, np.int64)
        hashes: list[np.ndarray] = []
        held = 0

        def words_out() -> Iterator[tuple[int, str, bytes]]:
            h, n = np.unique(np.concatenate(hashes), return_counts=True)
            cuts = np.searchsorted((h >> U(32)) * U(parts) >> U(32), np.arange(parts + 1, dtype=np.uint64))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                yield p, "word", T.pack(h[cuts[p] : cuts[p + 1]], n[cuts[p] : cuts[p + 1]])

        for batch in it:
            totals[1] += batch.num_rows
            for _, _, buf, offs in T.text_slices(batch.column(0)):
                starts, ends, _ = T.word_bounds(buf, offs, T.IS_WORD)
                low = T.LOWER[buf]
                of_byte += np.bincount(low, minlength=256)
                hashes.append(T.word_hashes(low, starts, ends))
                held += len(starts)
                if held > 2_000_000:
                    totals[0] += held
                    yield from _batches(list(words_out()))
                    hashes, held = [], 0
        totals[0] += held
        rows = list(words_out()) if held else []
        yield from _batches([*rows, (parts, "byte", T.pack(np.arange(256), of_byte)), (parts, "total", T.pack(np.arange(2), totals))])

    return run


def distinct_words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of training texts, each once a slice."""
    for batch in it:
        for _, _, buf, offs in T.text_slices(batch.column(0), 1 << 20):
            starts, ends, _ = T.word_bounds(buf, offs, T.IS_WORD)
            low = T.LOWER[buf]
            one, _ = distinct(low, starts, ends - starts)
            lens = (ends - starts)[one]
            offsets = np.append(0, np.cumsum(lens)).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(low[T.ragged(starts[one], lens)].tobytes())])
            yield pa.RecordBatch.from_arrays([words], names=["word"])


def spelling_counts(shared):
    """Distinct words to a task's counts of spelling (context, symbol) by nearest symbol."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, base = shared.value
        grams = np.zeros(base**4, np.int64)
        for batch in it:
            for _, _, buf, offs in T.text_slices(batch.column(0), 1 << 20):
                ctx, sym, _ = spell(buf, offs[:-1], offs[1:], code, base)
                grams += np.bincount(ctx.astype(np.int64) * base + sym, minlength=base**4)
        some = np.flatnonzero(grams)
        rows = []
        for s in range(base):
            own = some[some // base % base == s]
            if len(own):
                rows.append((s, "gram", T.pack(own, grams[own])))
        yield from _batches(rows)

    return run


def add_up(blobs: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Keys and sums of several lists of keys and counts."""
    key, n = (np.concatenate(x) for x in zip(*blobs, strict=True))
    o = np.argsort(key, kind="stable")
    head = np.flatnonzero(np.append(True, key[o[1:]] != key[o[:-1]]))
    return [key[o[head]], np.add.reduceat(n[o], head)]


def sum_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of tasks to counts of the corpus, part by part."""
    held: dict[tuple[int, str], list[list[np.ndarray]]] = {}
    for batch in it:
        for part, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            lists = held.setdefault((part, kind), [])
            lists.append(T.unpack(data))
            if len(lists) > 8 and sum(len(x[0]) for x in lists[1:]) > max(1_000_000, len(lists[0][0])):
                lists[:] = [add_up(lists)]
    for (part, kind), lists in held.items():
        yield _batch([(part, kind, T.pack(*add_up(lists)))])


def hot_words(least: int):
    """Packed counts to rows of the number of words and of those that occur over `least` times."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for data in batch.column(0).to_pylist():
                h, n = T.unpack(data)
                yield pa.RecordBatch.from_arrays([pa.array([len(h)]), pa.array([T.pack(h[n > least], n[n > least])], pa.binary())], names=["v", "data"])

    return run


def subtree_sampler(root: np.ndarray, base: int, sweeps: int, burn_in: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key, n = T.unpack(data)
                rows = pa.table({"context": key // base, "symbol": key % base, "n": n})
                probs, tables = dense_subtree(rows, root, base, sweeps, burn_in, part)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([T.pack(probs.astype(np.float32).ravel(), tables)], pa.binary())], names=["symbol", "data"])

    return run


def root_predictive(customers: np.ndarray, sweeps: int, burn_in: int) -> np.ndarray:
    """Averaged probabilities of a root restaurant of symbols over a uniform base."""
    base = len(customers)
    level = Level(DISCOUNT[0], STRENGTH[0], np.zeros(base, np.int64), np.arange(base), customers)
    uniform = np.full(base, 1 / base)
    rng, total = np.random.default_rng(0), np.zeros(base)
    for sweep in range(sweeps):
        level.move(uniform[level.many], rng)
        if sweep >= burn_in:
            total += level.predictive(uniform)
    return total / max(sweeps - burn_in, 1)


#: Bytes of text whose requests are sent together.
CHUNK = 12 << 20
#: Sums of log10 P are sent in units of 1 / FINE, so that they do not depend on the order in which they are added up.
FINE = 2.0**40


class Divider:
    """Which restaurant a pair of words before a token belongs to. Hot words are divided into several."""

    def __init__(self, hot: np.ndarray, count: np.ndarray, part_tokens: int):
        order = np.argsort(hot)
        self.hot, self.pieces = hot[order], -(-count[order] // part_tokens)

    def of(self, words: np.ndarray) -> np.ndarray:
        """Pieces of each word, 1 if it is not hot."""
        if not len(self.hot):
            return np.ones(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        return np.where(self.hot[at] == words, self.pieces[at], 1)

    def contexts(self, far: np.ndarray, near: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(near context, far one within it) as hashes; salt is a hash of the text."""
        pieces, far, near = self.of(near), far.copy(), near.copy()
        hot = np.flatnonzero(pieces > 1)
        own = pieces[hot].astype(np.uint64)
        both = np.minimum(own, self.of(far[hot]).astype(np.uint64))
        far[hot] += T.mix(salt[hot] % both)  # only pairs of two hot words have copies
        far = T.mix(far)
        near[hot] += T.mix(T.mix(far[hot]) % own) * U(3)
        return T.mix(near), far


def pack(*arrays: np.ndarray) -> bytes:
    """As textops.pack(), with the first bytes of an array's numbers by themselves, then the second bytes: those that are alike pack well."""
    press, heads, frames = zstandard.ZstdCompressor(level=1), [], []
    for a in arrays:
        own = [press.compress(x) for x in np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T)]
        heads.append(" ".join([a.dtype.str, *(str(len(x)) for x in own)]))
        frames += own
    return b"".join([";".join(heads).encode(), b"\n", *frames])


def unpack(data: bytes) -> list[np.ndarray]:
    press, at, out = zstandard.ZstdDecompressor(), data.index(b"\n") + 1, []
    for head in data[: at - 1].decode().split(";"):
        kind, *sizes = head.split()
        own = []
        for n in map(int, sizes):
            own.append(np.frombuffer(press.decompress(data[at : at + n]), np.uint8))
            at += n
        out.append(np.stack(own, axis=1).view(kind).ravel())
    return out


def steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def requests(shared):
    """Documents to packed rows: what the tokens of a chunk ask of each part, and the facts of its documents.

    A request holds words with log10 of their spelling; near contexts, the far ones of each, and the word and document of each token
    in those, all in order; and which documents are held out. Contexts have names of 32 bits, near ones
    within a part and far ones within a near one: two that share a name are one restaurant, which is rare and harmless.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, nth = shared.value, 0
        for batch in it:
            for lo, hi, buf, offs in T.text_slices(batch.column(2), CHUNK):
                name = (TaskContext.get().partitionId() << 32) + nth
                nth += 1
                ids, held = batch.column(0).slice(lo, hi - lo), np.asarray(batch.column(1).slice(lo, hi - lo)).astype(bool)
                n_tokens, sent = m.ask(name, buf, offs, held)
                rows = [(p, "ask", x) for p, x in sent]
                facts = T.pack(np.array([name]), T.longs(ids, 0), np.asarray(ids.is_null()), held, n_tokens)
                rows.append((int(T.mix(np.array([name], np.uint64))[0] % U(m.parts)), "facts", facts))
                yield from _batches(rows)

    return run


class Asker:
    """Spelling model and divider, which turn texts into requests."""

    def __init__(self, **parts):
        self.__dict__.update(parts)

    def spelling(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        ctx, sym, first = spell(low, starts, ends, self.code, self.base)
        return np.add.reduceat(self.log_spell[ctx.astype(np.int64) * self.base + sym] + self.log_escape * (sym == ESCAPE), first[:-1], dtype=np.float64) if len(starts) else np.zeros(0)

    def ask(self, name: int, buf: np.ndarray, offs: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, list[tuple[int, bytes]]]:
        rows = len(offs) - 1
        starts, ends, first = T.word_bounds(buf, offs, T.IS_WORD)
        low = T.LOWER[buf]
        words = T.word_hashes(low, starts, ends)
        size = np.diff(first)
        first_token = first + np.arange(rows + 1)
        token = np.full(len(words) + rows, END_WORD)
        token[np.arange(len(words)) + np.repeat(np.arange(rows), size)] = words
        doc = np.repeat(np.arange(rows, dtype=np.int32), size + 1)
        near, far = (np.full(len(token), START_WORD) for _ in range(2))
        near[1:], far[2:] = token[:-1], token[:-2]
        near[first_token[:-1]] = START_WORD
        far[first_token[:-1]] = START_WORD
        second = first_token[:-1][size > 0] + 1
        far[second] = START_WORD
        salt = T.mix(np.add.reduceat(T.mix(token + U(1)), first_token[:-1]))
        near, far = self.divider.contexts(far, near, salt[doc])
        part = ((near >> U(32)) * U(self.parts) >> U(32)).astype(np.int32)  # the leading bits of the near context name it
        pair = (near << U(32)) | (far & U(0xFFFFFFFF))
        del near, far, salt
        key, word = grouped(token)
        logs = np.full(len(key), self.log_end, np.float32)  # the end of a text is spelled by no byte
        at = np.empty(len(key), np.int64)
        at[word] = np.arange(len(token)) - doc  # a place of each word, if it is one
        spelled = np.ones(len(key), bool)
        spelled[word[first_token[1:] - 1]] = False
        logs[spelled] = self.spelling(low, starts[at[spelled]], ends[at[spelled]])
        # tokens by part and by context
        o = np.argsort(pair)
        o = o[np.argsort(part[o].astype(np.uint16 if self.parts < 65536 else np.uint32), kind="stable")]
        pair, word, doc, part = pair[o], word[o], doc[o], part[o]
        del o, token, words
        here, w_at = grouped(part.astype(np.int64) * len(key) + word)  # the words of each part
        who = np.packbits(held)
        sent = []
        cuts = np.searchsorted(part, np.arange(self.parts + 1))
        word_cuts = np.searchsorted(here, np.arange(self.parts + 1) * len(key))
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            i = slice(cuts[p], cuts[p + 1])
            w = here[word_cuts[p] : word_cuts[p + 1]] % len(key)
            own = pair[i]
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            far = own[heads]
            near = (far >> U(32)).astype(np.uint32)
            new = np.flatnonzero(np.append(True, near[1:] != near[:-1]))
            small = (np.diff(x, append=n) for x, n in ((new, len(near)), (heads, len(own))))
            small = [x.astype(np.uint32) for x in (*small, w_at[i] - word_cuts[p], doc[i])]
            sent.append((p, pack(np.array([name]), steps(key[w]), logs[w], steps(near[new]), far.astype(np.uint32), *small, who)))
        return size + 1, sent


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the place of each key among them, as np.unique has them, in half the memory."""
    o = np.argsort(key)
    own = key[o]
    head = np.append(True, own[1:] != own[:-1])[: len(own)]
    own, at = own[head], np.empty(len(key), np.int32)
    at[o] = np.cumsum(head, dtype=np.int32) - np.int32(1)
    return own, at


class Subtrees:
    """The restaurants of a part, from its requests: of near contexts, and of far ones within them."""

    def __init__(self, blobs: Iterable[bytes]):
        self.asked, trained = [], []
        words, logs, pairs, many, places = [], [], [], [], []
        for data in blobs:
            (name,), w, log, n, far, per_near, per_pair, w_at, doc, who = unpack(data)
            self.asked.append((int(name), doc))
            trained.append(np.unpackbits(who)[doc] == 0)
            words.append(np.cumsum(w))
            logs.append(log)
            pairs.append(np.repeat(np.cumsum(n, dtype=np.uint64) << U(32), per_near) | far)
            many.append(per_pair)
            places.append(w_at)
        self.ends = np.cumsum([0, *(len(x) for x in places)])
        self.words, at = np.unique(np.concatenate(words), return_index=True)
        self.logs = np.concatenate(logs)[at].astype(np.float64)
        wide = len(self.words)
        pair, key = grouped(np.concatenate(pairs))  # sorted by near first
        near = np.append(0, np.cumsum(np.diff(pair >> U(32)) > 0)).astype(np.int32)  # of each pair
        del pairs, pair, at
        key = np.repeat(key.astype(np.int64), np.concatenate(many)) * wide
        for i, (w, x) in enumerate(zip(words, places, strict=True)):
            key[self.ends[i] : self.ends[i + 1]] += np.searchsorted(self.words, w)[x]
        del words, logs, many, places
        leaf, self.leaf_of = grouped(key)  # every triple asked for, trained on or not
        del key
        total = np.bincount(self.leaf_of[np.concatenate(trained)], minlength=len(leaf))
        # of each triple asked for
        self.word, far_of = (leaf % wide).astype(np.int32), (leaf // wide).astype(np.int32)
        del leaf, trained
        near_of = near[far_of]
        mid, mid_of = grouped(near_of.astype(np.int64) * wide + self.word)
        some = np.flatnonzero(total)
        self.leaf = Level(discount_of(total[some]), 1.0, far_of[some], self.word[some], total[some])
        tables = np.bincount(mid_of[some], weights=self.leaf.t, minlength=len(mid)).astype(np.int64)
        kept = np.flatnonzero(tables)
        dish = np.full(len(mid), -1, np.int32)
        dish[kept] = np.arange(len(kept))
        self.mid = Level(discount_of(tables[kept]), 1.0, (mid[kept] // wide).astype(np.int32), (mid[kept] % wide).astype(np.int32), tables[kept])
        up = dish[mid_of]
        self.leaf.up, self.some = up[some], some
        # of the triples that were not trained on: their dish in the middle and their restaurants, or -1
        self.others = np.flatnonzero(total == 0)
        self.mid_dish = up[self.others]
        self.leaf_rest = self._restaurants(self.leaf, far_of[self.others])
        self.mid_rest = self._restaurants(self.mid, near_of[self.others])

    @staticmethod
    def _restaurants(level: Level, context: np.ndarray) -> np.ndarray:
        own = level.context[level.first]
        have = np.full(int(max(own.max(initial=-1), context.max(initial=-1))) + 1, -1, np.int32)
        have[own] = np.arange(level.n_rest)
        return have[context]

    def tables(self, root: np.ndarray, sweeps: int, seed: int) -> np.ndarray:
        """Tables of each word in the near contexts' restaurants, customers of the root, after some sweeps."""
        for _ in sample([self.mid, self.leaf], root, sweeps, sweeps, seed):
            pass
        return np.bincount(self.mid.symbol, weights=self.mid.t, minlength=len(self.words)).astype(np.int64)

    def log_probabilities(self, log_root: np.ndarray, sweeps: int, burn_in: int, seed: int) -> np.ndarray:
        """log10 of the averaged predictive probability of each triple asked for. log_root: log10 P of each word in the root."""
        root = np.power(10.0, np.maximum(log_root, -300.0))
        trained, seen, share = np.zeros(len(self.some)), np.zeros(len(self.others)), np.zeros(len(self.others))
        pad = lambda x: np.append(x, 1.0)
        for _, (mid, leaf) in sample([self.mid, self.leaf], root, sweeps, burn_in, seed):
            trained += leaf
            low, high = pad(backoff(self.leaf))[self.leaf_rest], pad(backoff(self.mid))[self.mid_rest]
            seen += low * np.where(self.mid_dish >= 0, pad(mid)[self.mid_dish], 0.0)
            share += np.where(self.mid_dish < 0, low * high, 0.0)  # of the root's probability
        n, out = max(sweeps - burn_in, 1), np.empty(len(self.word))
        with np.errstate(divide="ignore"):
            out[self.some] = np.log10(trained / n)
            out[self.others] = np.where(seen > 0, np.log10(seen / n), np.log10(share / n) + log_root[self.word[self.others]])
        return out


def part_rows(it: Iterator[pa.RecordBatch]) -> dict[int, dict[str, list[bytes]]]:
    """The packed rows of a Spark partition: by part, then by kind."""
    out: dict[int, dict[str, list[bytes]]] = {}
    for batch in it:
        for part, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            out.setdefault(part, {}).setdefault(kind, []).append(data)
    return out


def _table(rows: list[tuple[int, str, bytes]]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows)])


def _of_kind(rows: pa.Table, kind: str) -> Iterator[bytes]:
    """The packed rows of a kind, one at a time."""
    for k, x in zip(rows.column("kind"), rows.column("data"), strict=True):
        if k.as_py() == kind:
            yield x.as_py()


def first_tables(parts: int, sweeps: int):
    """Requests of a part to packed (words, spelling, tables) by the words' part, from sweeps under a root of spelling and counts."""

    def run(rows: pa.Table) -> pa.Table:
        (part, *_), kinds = rows.column("part").slice(0, 1).to_pylist(), rows.column("kind").unique().to_pylist()
        if "ask" not in kinds:
            return _table([])
        own = Subtrees(_of_kind(rows, "ask"))
        near = np.bincount(own.mid.symbol, minlength=len(own.words)) + np.power(10.0, np.maximum(own.logs, -300.0))
        tables = own.tables(near / near.sum(), sweeps, part)
        words, logs = own.words, own.logs.astype(np.float32)
        cuts = np.searchsorted((words >> U(32)) * U(parts) >> U(32), np.arange(parts + 1))
        out = []
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            i = slice(cuts[p], cuts[p + 1])
            out.append((p, "root", pack(np.array([part]), steps(words[i]), logs[i], tables[i].astype(np.uint32))))
        del own
        T.hand_back()
        return _table(out)

    return run


def root_words(parts: int):
    """Counts and tables of a part of the words to what each part needs: its share of them in order, as customers, tables, and
    occurrences; and of the whole share, to all, the discount, customers and tables."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, kinds in part_rows(it).items():
            if "root" not in kinds:
                continue
            blobs = [unpack(x) for x in sorted(kinds.pop("root"))]
            own = [np.cumsum(x[1]) for x in blobs]
            words, at = np.unique(np.concatenate(own), return_inverse=True)
            c = np.bincount(at, weights=np.concatenate([x[3] for x in blobs]), minlength=len(words)).astype(np.int64)
            logs = np.zeros(len(words))
            logs[at] = np.concatenate([x[2] for x in blobs])
            level = Level(discount_of(c), 1.0, np.zeros(len(words), np.int64), np.arange(len(words)), c)
            rng = np.random.default_rng(part)
            spelled = np.power(10.0, np.maximum(logs[level.many], -300.0))
            for _ in range(3):
                level.move(spelled, rng)
            t = level.t
            n = np.zeros(len(words), np.int64)
            if "word" in kinds:
                key, count = T.unpack_all(kinds.pop("word"))
                o = np.argsort(key)
                key, count = key[o], count[o]
                i = np.minimum(np.searchsorted(key, words), len(key) - 1)
                n = np.where(key[i] == words, count[i], 0)
            whole, none, place, answers = np.array([level.d, c.sum(), t.sum()], float), np.zeros(0, np.int64), 0, {}
            for x, w in zip(blobs, own, strict=True):
                answers[int(x[0][0])] = at[place : place + len(w)]
                place += len(w)
            for p in range(parts):
                i = answers.get(p, none)
                yield _batch([(p, "known", pack(np.array([part]), whole, c[i], t[i], n[i]))])

    return run


def answers(shared):
    """Requests of a part and what the root says of its words to sums (known tokens, base score, score), a packed row for each chunk; facts as they are."""

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        m = shared.value
        names, out = [], []
        for x in _of_kind(rows, "facts"):
            names.append(int(T.unpack(x)[0][0]))
            out.append(x)
        facts = len(out)
        if rows.num_rows > facts:
            (part,) = rows.column("part").slice(0, 1).to_pylist()
            own = Subtrees(_of_kind(rows, "ask"))
            # the parts of the words in order, and so the words themselves
            said = sorted((unpack(x) for x in _of_kind(known, "known")), key=lambda x: int(x[0][0]))
            rest, n = np.concatenate([c - whole[0] * t for _, whole, c, t, _ in said]), np.concatenate([x[4] for x in said])
            customers, tables = sum(x[1][1] for x in said), sum(x[1][0] * x[1][2] for x in said)
            at = np.searchsorted(own.words, END_WORD)
            if at < len(own.words) and own.words[at] == END_WORD:
                n[at] = m["ends"]
            spelled = np.log10(m["theta"] + tables) + own.logs
            with np.errstate(divide="ignore"):
                log_root = np.where(rest > 0, np.log10(rest + np.power(10.0, np.maximum(spelled, -300.0))), spelled) - np.log10(m["theta"] + customers)
            p = own.log_probabilities(log_root, m["sweeps"], m["burn_in"], part)
            base = np.log10(n + 0.1) - m["denominator"]
            for k, (name, doc) in enumerate(own.asked):
                leaf = own.leaf_of[own.ends[k] : own.ends[k + 1]]
                word = own.word[leaf]
                many = np.bincount(doc)
                some = np.flatnonzero(many)
                sums = [np.bincount(doc, weights=x)[some] for x in (n[word] > 0, base[word], p[leaf])]
                names.append(name)
                out.append(pack(steps(some.astype(np.uint32)), sums[0].astype(np.uint32), *(np.rint(x * FINE).astype(np.int64) for x in sums[1:])))
            del own
            T.hand_back()
        return pa.table({"batch": pa.array(names, pa.int64()), "data": pa.array(out, pa.binary()), "facts": pa.array(np.arange(len(out)) < facts)})

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def sum_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's facts and its sums from all parts to a row per document."""
    held: dict[int, list[bytes]] = {}
    facts: dict[int, bytes] = {}
    for batch in it:
        for name, data, is_facts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if is_facts:
                facts[name] = data
            else:
                held.setdefault(name, []).append(data)
    for name, data in facts.items():
        _, ids, null, held_out, n_tokens = T.unpack(data)
        known, base, score = (np.zeros(len(ids), np.int64) for _ in range(3))
        for doc, *values in map(unpack, held.pop(name)):  # every document has a token
            doc = np.cumsum(doc)
            for total, x in zip((known, base, score), values, strict=True):
                total[doc] += x
        columns = [pa.array(ids, pa.int64(), mask=null), pa.array(held_out), pa.array(n_tokens), pa.array(known), pa.array(base / FINE), pa.array(score / FINE)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score_texts(docs: DataFrame, held_out, part_bytes: int = 12 << 20, alphabet: int = 44, sweeps: int = 8, burn_in: int = 4) -> DataFrame:
    """Score each row of docs (doc_id, text) under a model that is learned from the rows for which held_out is not true.

    held_out is a Column over docs. A-Z are lower-cased; tokens are words (runs of anything but space and \\t to \\r), then one
    end. Returns doc_id, held_out, n_tokens, n_known (tokens that occur in training), train_tokens, base_score (add-0.1
    unigram log10 probability of the tokens, from counts of the whole training corpus), score (log10 probability under the
    hierarchical Pitman-Yor model) and perplexity (per token, of score).

    A null text is empty: one token, the end. The end is known if there is a training text. Rows are judged one by one; repeated
    rows count in training as often as they are there. A null doc_id is like any other. Other columns are ignored. An empty
    table gives no rows; with nothing to learn from, the model is that of spelling, uniform over its symbols.
    part_bytes: text whose tokens one task seats; a word of more tokens has several restaurants. alphabet: bytes that the spelling
    model tells apart, the most frequent ones, and ends; others share a symbol. Words and contexts are not limited.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pitman_yor")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = source.where("not held_out").select("text")
    base = alphabet
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    counted = scratch.save(training.mapInArrow(T.lean(word_counts(parts)), ROWS_DDL).repartitionById(parts + 1, F.col("part")).mapInArrow(T.lean(sum_counts), ROWS_DDL))
    small = {r.kind: T.unpack(r.data)[1] for r in counted.where("kind <> 'word'").select("kind", "data").collect()}  # one row each
    n_words, ends = (int(x) for x in small.get("total", (0, 0)))
    train_tokens = n_words + ends
    of_byte = small.get("byte", np.zeros(256, np.int64)).copy()
    of_byte[~T.IS_WORD] = -1
    code = np.full(256, ESCAPE, np.uint8)
    code[np.argsort(-of_byte, kind="stable")[: base - 3]] = np.arange(3, base)
    log_escape = -float(np.log10(max(1, int(((code == ESCAPE) & T.IS_WORD).sum()))))
    # a part's share of the tokens, or a millionth of all, so that the hot words are a bounded number
    part_tokens = max(1000, train_tokens // parts, train_tokens >> 20)
    stats = counted.where("kind = 'word'").select("data").mapInArrow(T.lean(hot_words(part_tokens // 2)), "v long, data binary")
    types, hot = 0, [(np.array([START_WORD]), np.array([ends]))]
    for r in stats.toLocalIterator():
        types += r.v
        hot.append(tuple(T.unpack(r.data)))
    divider = Divider(*(np.concatenate(x) for x in zip(*hot, strict=True)), part_tokens)

    shared = spark.sparkContext.broadcast((code, base))
    # each word of the corpus is spelled once, and the end of a text as a word of no bytes, however the texts are cut into tasks
    types_of = training.mapInArrow(T.lean(distinct_words), "word binary").distinct()
    types_of = types_of.unionByName(training.limit(1).select(F.lit(b"").alias("word")))
    sums = scratch.save(types_of.mapInArrow(T.lean(spelling_counts(shared)), ROWS_DDL).repartitionById(base, F.col("part")).mapInArrow(T.lean(sum_counts), ROWS_DDL))
    grams = sums.select("part", "data").repartitionById(base, F.col("part"))
    root, got = np.full(base, 1 / base), []
    for _ in range(2):  # the root's customers are the subtrees' tables
        got = grams.mapInArrow(T.lean(subtree_sampler(root, base, 24, 8)), "symbol int, data binary").collect()  # alphabet ** 4 numbers
        tables = sum((T.unpack(r.data)[1] for r in got), np.zeros(base))
        root = root_predictive(tables.astype(np.int64), 24, 8) if got else root
    probs = np.tile(root.astype(np.float32), (base, base, base, 1))  # farthest, middle, nearest, symbol
    for r in got:
        probs[:, :, r.symbol] = T.unpack(r.data)[0].reshape(base, base, base)
    log_spell = np.log10(np.maximum(probs, 1e-30)).ravel()
    asker = Asker(code=code, base=base, parts=parts, divider=divider, log_spell=log_spell, log_escape=log_escape, log_end=float(log_spell[WORD_END]))
    shared.destroy()

    shared = spark.sparkContext.broadcast(asker)
    release(spark)  # the shuffles of the counts and words
    # every token is sent once: the two rounds of sweeps read the same exchange
    asks = source.select("doc_id", "held_out", "text").mapInArrow(T.lean(requests(shared)), ROWS_DDL).repartition(2 * parts, "part")
    tables = asks.groupBy("part").applyInArrow(first_tables(parts, sweeps), ROWS_DDL)
    words = counted.where("kind = 'word'").unionByName(tables).repartitionById(parts, F.col("part"))
    known = words.mapInArrow(T.lean(root_words(parts)), ROWS_DDL).repartition(2 * parts, "part")
    denominator = float(np.log10(train_tokens + 0.1 * (types + (ends > 0) + 1)))
    model = {"ends": ends, "theta": 1.0, "sweeps": sweeps, "burn_in": burn_in, "denominator": denominator}
    both = asks.groupBy("part").cogroup(known.groupBy("part"))
    sums_of = both.applyInArrow(answers(spark.sparkContext.broadcast(model)), "batch long, data binary, facts boolean").repartition(F.col("batch"))
    out = sums_of.mapInArrow(T.lean(sum_batches), SCORED)
    return out.withColumns({"train_tokens": F.lit(train_tokens).cast("long"), "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))})


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return score_texts(docs, held).drop("perplexity")
