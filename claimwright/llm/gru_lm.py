"""Scores of a gated recurrent language model.

Tokens are runs of characters other than space and \\t-\\r of the text with A-Z
in lower case, then one end token (:data:`END`).  Training texts are those
that are not held out.

1. *Counts.*  One pass counts the tokens of all training texts; partial counts
   leave a task whenever its table is full, and an aggregate adds them up.
2. *Symbols.*  The most frequent tokens (the end among them) are the network's
   symbols, every other token is the symbol *other*.  Their number grows with the
   square root of the number of distinct tokens.  The most frequent
   tokens of up to :data:`SHORT` bytes (at most :data:`FREQUENT`) are broadcast
   with their counts, so the broadcast has a bound in bytes; the counts of a
   text's other tokens are joined.  A second pass writes each text's symbols.
3. *Network* (numpy).  A gated recurrent unit over symbols with a class-factored
   softmax: p(symbol) = p(class | state) * p(symbol | class, state), the symbols
   in order of frequency cut into as many classes as a class has symbols.  Biases
   start at the counts' logarithms, so it starts as the unigram model.
4. *Training.*  Truncated backpropagation through windows of :data:`WINDOW`
   tokens: the state is carried through a whole text, from window to window, the
   gradient is not.  Lanes read texts side by side (:class:`Lanes`); a lane that
   ends a text goes on with the next one, from a state of zero.  Each task learns
   from the training texts it reads, and the weights of all tasks are averaged
   (weighted by tokens) by an aggregate, ``rounds`` times; a task sends as many
   numbers as there are weights.  Every training text is learned from once: its
   own digest says in which round.
5. *Scores.*  Each text from its start to its end, the state carried all along,
   by the same lanes.  A token that is *other*
   counts p(other) * (c + 1) / (sum of (c + 1) over other tokens, and one for
   all unseen), so the model is a distribution over all tokens.

Defined cases: null and empty texts are the end token alone; null ids are held
out; repeated rows are counted and scored each; with no training text every
count is 0 and the network stays as it starts; an empty table gives an empty
result.  Only the id and the text column are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt, prod
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.common import map_texts, prepare, slices, stored

#: The end token: no word holds white space.
END = b"\n"
#: The network has max(LEAST_SYMBOLS, half the square root of the number of distinct tokens) symbols, at most MOST_SYMBOLS (16-bit numbers).
LEAST_SYMBOLS, MOST_SYMBOLS, HIDDEN = 1024, 32_000, 16
#: Tokens that are broadcast: their number and bytes.
FREQUENT, SHORT = 200_000, 64
WINDOW, LANES, SCORED_LANES, ROUNDS, RATE = 16, 512, 512, 2, 0.01
#: No output's exponent is larger.
CAP = 60
#: Probability in its class of a place without a symbol: nothing beside 1, and neither it nor the
#: square of its gradient is so small that arithmetic slows down (below 1.2e-38).
NO_SYMBOL = 1e-15
#: Symbols that a lane holds ready, and weights that a task sends in one row.
READY, SENT = 1024, 4096
#: Bytes of text that are looked up at once: the frequent tokens are put into a table each time.
LOOKED_UP = 8 << 20
#: Distinct tokens that a counting task holds, and tokens that are scored together.
COUNTED, SCORED = 200_000, 3_000_000


def held_out(key: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(True))


def words(texts: list[bytes], known: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The texts' tokens without ends: where each text's begin (and the last one's end), their numbers, and the distinct ones by number.

    ``known`` distinct tokens have the first numbers, whether they occur or not.
    """
    lower = pc.ascii_lower(pa.array(texts, type=pa.large_binary()).view(pa.large_string()))
    lists = pc.ascii_split_whitespace(lower)
    # White space at a text's ends gives an empty word.
    there = pc.binary_length(lists.values).to_numpy() > 0
    before = np.concatenate([[0], np.cumsum(there)])
    found = pa.concat_arrays([known.view(pa.large_string()), lists.values.filter(pa.array(there))]).dictionary_encode()
    return before[lists.offsets.to_numpy()], found.indices.to_numpy()[len(known):], found.dictionary.view(pa.large_binary())


# --- counts ------------------------------------------------------------------

def token_counts(docs: DataFrame, text: str) -> DataFrame:
    """(token, c) of all tokens of the texts."""
    prepare(docs.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(token: pa.Array, c: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([token.cast(pa.binary()), pa.array(c, type=pa.int64())], ["token", "c"])

        none = pa.array([], type=pa.large_binary())
        held, rows, ends = [], 0, 0
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                _, numbers, distinct = words(texts, none)
                held.append((distinct, np.bincount(numbers, minlength=len(distinct))))
                rows, ends = rows + len(distinct), ends + len(texts)
                if rows > 2 * COUNTED:
                    held = [_added_up(held)]
                    rows = len(held[0][0])
                    if rows > COUNTED:
                        yield flushed(*held[0])
                        held, rows = [], 0
        if held:
            yield flushed(*_added_up(held))
        if ends:
            yield flushed(pa.array([END], type=pa.large_binary()), np.array([ends]))

    parts = docs.select(text).mapInArrow(partial, "token binary, c long")
    return parts.groupBy("token").agg(F.sum("c").alias("c"))


def _added_up(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """Distinct tokens of all parts and their counts."""
    if len(parts) == 1:
        return parts[0]
    found = pa.concat_arrays([token for token, _ in parts]).view(pa.large_string()).dictionary_encode()
    total = np.zeros(len(found.dictionary), dtype=np.int64)
    np.add.at(total, found.indices.to_numpy(), np.concatenate([c for _, c in parts]))
    return found.dictionary.view(pa.large_binary()), total


def _least_frequent(counts: DataFrame) -> int:
    """The least count of a frequent token: at most ``FREQUENT`` tokens reach it.

    Steps of an eighth of a power of two, so the histogram has a few hundred rows.
    """
    step = F.floor(F.log2("c") * 8).cast("int")
    steps = counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect()
    least, n = 1 << 62, 0
    for s in sorted(steps, key=lambda s: -s.s):
        n += s.n
        if n > FREQUENT:
            break
        least = s.c
    return least


# --- network -----------------------------------------------------------------

class Room:
    """Arrays that every window uses again, by name: new ones for each window cost more than filling them."""

    def __init__(self, dtype: np.dtype):
        self.dtype, self.kept = dtype, {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        """An array of any content, which is that of the last call with the name."""
        size = prod(shape)
        if name not in self.kept or len(self.kept[name]) < size:
            self.kept[name] = np.empty(size, dtype=self.dtype)
        return self.kept[name][:size].reshape(shape)


class GRU:
    """Weights of the network; symbol ``n`` is *other*.  The last row of the output weights is the bias."""

    NAMES = ("x", "u", "class_w", "word_w")

    def __init__(self, counts: np.ndarray, hidden: int = HIDDEN, seed: int = 3):
        """``counts`` of the symbols, *other* last."""
        rng = np.random.default_rng(seed)
        self.n, self.hidden, self._room = len(counts), hidden, None
        self.size = max(1, isqrt(self.n - 1) + 1 if self.n else 1)
        self.classes = max(1, -(-self.n // self.size))
        p = np.full(self.classes * self.size, 1e-30)
        p[:self.n] = np.maximum(counts, 0.5)
        p = (p / p.sum()).reshape(self.classes, self.size)
        f = np.float32
        self.x = rng.normal(0, 0.3, (self.n + 1, 3 * hidden)).astype(f)  # row n: before the first token
        self.u = rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(f)
        self.class_w = np.zeros((hidden + 1, self.classes), dtype=f)
        self.class_w[-1] = np.log(p.sum(axis=1))
        self.word_w = np.zeros((self.classes, hidden + 1, self.size), dtype=f)
        bias = np.log(p / p.sum(axis=1, keepdims=True))
        bias.reshape(-1)[self.n:] = np.log(NO_SYMBOL)
        self.word_w[:, -1] = bias

    @property
    def room(self) -> Room:
        if self._room is None or self._room.dtype != self.x.dtype:
            self._room = Room(self.x.dtype)
        return self._room

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_room": None}

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def states(self, h: np.ndarray, last: np.ndarray, goes_on: np.ndarray, steps: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The last state, and all states with a 1 behind (time x lanes x hidden + 1; valid until the next call).

        ``goes_on`` is 0 where a text begins.  ``steps`` gets what the gradient needs.
        """
        k, (times, lanes) = self.hidden, last.shape
        room = self.room
        out = room("out", times, lanes, k + 1)
        out[..., k] = 1
        # Gate by gate (reset, update, candidate): each is one piece of memory.
        given = room("given", 3, times, lanes, k)
        np.take(self.x.reshape(-1, k), last * 3 + np.arange(3)[:, None, None], axis=0, out=given, mode="clip")
        u = self.gates()
        gates = room("gates", times if steps is not None else 1, 3, lanes, k)
        moves = room("moves", len(gates), lanes, k)
        before, some = room("before", times + 1, lanes, k), room("some", lanes, k)
        before[0] = h
        when, where = np.nonzero(goes_on == 0)
        begins = np.split(where, np.searchsorted(when, np.arange(1, times)))
        np.seterr(over="ignore")
        for t in range(times):
            own = t if steps is not None else 0
            h, gh, move = before[t], gates[own], moves[own]
            h[begins[t]] = 0
            np.matmul(h, u, out=gh)
            rz, c = given[:2, t], given[2, t]
            rz += gh[:2]
            np.negative(rz, out=rz)  # the logistic function; a large exponent gives 0
            np.exp(rz, out=rz)
            rz += 1
            np.reciprocal(rz, out=rz)
            r, z = rz
            c += np.multiply(r, gh[2], out=some)
            np.tanh(c, out=c)
            np.subtract(c, h, out=move)
            np.add(h, np.multiply(z, move, out=some), out=before[t + 1])
            out[t, :, :k] = before[t + 1]
        if steps is not None:
            steps.update(before=before[:times], given=given, moves=moves, candidates=gates[:, 2], begins=begins)
        return before[times].copy(), out

    def gates(self) -> np.ndarray:
        """The state's weights gate by gate."""
        k = self.hidden
        return np.ascontiguousarray(self.u.reshape(k, 3, k).swapaxes(0, 1))

    def output(self, h: np.ndarray, want: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """ln p of each wanted symbol (-1: none, 0); with ``grads``, also sets the loss's gradients and returns that of the states.

        Gradients are valid until the next call; ``grads["classes"]`` are those whose words have any.
        """
        k, room = self.hidden, self.room
        cls, word = np.divmod(want, self.size)
        full = grads is not None
        # Rows in order of their class, so one product for each class; -1 comes first and is left out.
        cls = cls.astype(np.int16)
        order = np.argsort(cls, kind="stable")[np.count_nonzero(want < 0):]
        n = len(order)
        cls, word = cls[order], word[order]
        h = np.take(h, order, axis=0, out=room("rows", n, k + 1), mode="clip") if h.dtype == self.x.dtype else h[order]
        rows = np.arange(n)
        its_class, its_word = rows * self.classes + cls, rows * self.size + word
        pc, logp = _softmax(np.matmul(h, self.class_w, out=room("pc", n, self.classes)), its_class, full, self.class_w)
        cuts = _runs(cls)
        z = room("pw", n, self.size)
        parts = [*zip(cls[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), n])]
        for c, a, b in parts:
            np.matmul(h[a:b], self.word_w[c], out=z[a:b])
        pw, lw = _softmax(z, its_word, full, self.word_w)
        out = np.zeros(len(want), dtype=np.float32)
        out[order] = logp + lw
        if not full:
            return out, None
        pc.reshape(-1)[its_class] -= 1
        pw.reshape(-1)[its_word] -= 1
        grads["class_w"] = h.T @ pc
        by_word = grads["word_w"] = room("word_w", *self.word_w.shape)
        by_word.fill(0)
        grads["classes"] = cls[cuts]
        d = np.matmul(pc, self.class_w[:-1].T, out=room("d", n, k))
        for c, a, b in parts:
            np.matmul(h[a:b].T, pw[a:b], out=by_word[c])
            d[a:b] += pw[a:b] @ self.word_w[c, :-1].T
        back = room("back", len(want), k)
        if n < len(want):
            back.fill(0)
        back[order] = d
        return out, back

    def window(self, h: np.ndarray, last: np.ndarray, want: np.ndarray, goes_on: np.ndarray, grads: dict) -> np.ndarray:
        """Truncated backpropagation over one window (time x lanes; -1: none). Returns the last state."""
        k, room, steps, shape = self.hidden, self.room, {}, want.shape
        h, out = self.states(h, last, goes_on, steps)
        _, d_out = self.output(out.reshape(-1, k + 1), want.ravel(), grads)
        d_out = d_out.reshape(*shape, k)
        (r, z, c), moves, candidates = steps["given"], steps["moves"], steps["candidates"]
        slope = np.multiply(c, c, out=room("slope", *shape, k))
        np.subtract(1, slope, out=slope)
        rest_r, rest_z = np.subtract(1, steps["given"][:2], out=room("rest", 2, *shape, k))
        # Gradients before the gates (reset, update, the state's part of the candidate, candidate): that part passes the reset gate, too.
        dg, sent, dhz = room("dg", 4, *shape, k), room("sent", 3, shape[1], k), room("dhz", shape[1], k)
        dh, back = np.zeros_like(h), np.ascontiguousarray(self.gates().swapaxes(1, 2))
        for t in reversed(range(len(want))):
            dh += d_out[t]
            np.multiply(dh, z[t], out=dhz)
            dr, dz, dgc, dc = dg[:, t]
            np.multiply(dhz, slope[t], out=dc)
            np.multiply(dhz, moves[t], out=dz)
            dz *= rest_z[t]
            np.multiply(dc, candidates[t], out=dr)
            dr *= r[t]
            dr *= rest_r[t]
            np.multiply(dc, r[t], out=dgc)
            np.matmul(dg[:3, t], back, out=sent)
            dh -= dhz
            dh += sent[0]
            dh += sent[1]
            dh += sent[2]
            dh[steps["begins"][t]] = 0
        states = steps["before"].reshape(-1, k).T
        grads["u"] = np.concatenate([states @ d.reshape(-1, k) for d in dg[:3]], axis=1)
        # Rows of x that occurred, and their sums: rows in order of their symbol, added up run by run.
        ids = last.ravel().astype(np.int16)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        cuts = _runs(ids)
        pieces = order[:, None] + np.array([0, 1, 3]) * len(order)
        by_row = np.take(dg.reshape(-1, k), pieces, axis=0, out=room("by_row", len(order), 3, k), mode="clip")
        grads["x"] = ids[cuts], np.add.reduceat(by_row.reshape(-1, 3 * k), cuts, axis=0)
        return h


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    begins = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
    return np.flatnonzero(begins)


def _softmax(z: np.ndarray, wanted: np.ndarray, full: bool, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's probabilities (in place of ``z``, if ``full``) and the logarithm of the wanted one's (by place in ``z``).

    Biases are logarithms of probabilities, so some entry is never far below 0;
    entries are not shifted by their maximum, but capped where the ``weights``
    (states lie between -1 and 1) could make them large.
    """
    if np.abs(weights[..., :-1, :]).sum(axis=-2).max(initial=0) > CAP:
        np.minimum(z, np.float32(CAP), out=z)
    own = z.reshape(-1).take(wanted)
    np.exp(z, out=z)
    total = z @ np.ones((z.shape[1], 1), dtype=z.dtype)
    if full:
        z /= total
    return z, own - np.log(total[:, 0])


class Lanes:
    """Texts read side by side, window by window; a lane goes on with the next text where one ends."""

    def __init__(self, lanes: int, start: int):
        """``start`` is the symbol before a text's first."""
        self.start = start
        self.symbols = np.zeros((lanes, READY + WINDOW), dtype=np.int32)
        self.owner = np.zeros_like(self.symbols)
        self.goes_on = np.ones(self.symbols.shape, dtype=np.float32)
        self.at, self.end = np.zeros((2, lanes), dtype=np.int64)
        self.before = np.full(lanes, start, dtype=np.int32)
        self.rest: list[tuple[int, np.ndarray] | None] = [None] * lanes

    def fill(self, texts: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
        """Give lanes that run short their next symbols; says which lanes have any."""
        for i in np.flatnonzero(self.end - self.at < WINDOW).tolist():
            a, n = int(self.at[i]), int(self.end[i] - self.at[i])
            for part in (self.symbols, self.owner, self.goes_on):
                part[i, :n] = part[i, a:a + n].copy()
            while n < READY:
                begins = self.rest[i] is None
                text = next(texts, None) if begins else self.rest[i]
                if text is None:
                    break
                who, symbols = text
                some = symbols[:READY - n]
                span = slice(n, n + len(some))
                self.symbols[i, span], self.owner[i, span], self.goes_on[i, span] = some, who, 1
                if begins:
                    self.goes_on[i, n] = 0
                self.rest[i] = (who, symbols[len(some):]) if len(some) < len(symbols) else None
                n += len(some)
            self.at[i], self.end[i] = 0, n
        return self.end > self.at

    def drop(self, live: np.ndarray) -> None:
        """Leave out lanes that have ended for good."""
        for name in ("symbols", "owner", "goes_on", "at", "end", "before"):
            setattr(self, name, getattr(self, name)[live])
        self.rest = [r for r, stays in zip(self.rest, live) if stays]

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Symbols before and wanted (-1: none), whether texts go on, and whose they are (time x lanes)."""
        places = self.at + np.arange(WINDOW)[:, None]
        there = places < self.end
        places += np.arange(len(self.at)) * self.symbols.shape[1]
        want, goes_on, owner = (part.reshape(-1).take(places) for part in (self.symbols, self.goes_on, self.owner))
        if not there.all():
            want[~there] = -1
            goes_on[~there] = 1
        last = np.concatenate([self.before[None], want[:-1]])
        last[(goes_on == 0) | (last < 0)] = self.start
        self.before = want[-1].copy()
        self.at = np.minimum(self.at + WINDOW, self.end)
        return last, want, goes_on, owner


def windows(texts: Iterator[tuple[int, np.ndarray]], net: GRU, lanes: int = LANES) -> Iterator[tuple[list, np.ndarray]]:
    """A state holder ``[h]`` and each window of the texts; the consumer puts the next state into it."""
    read, state = Lanes(lanes, net.n), [np.zeros((lanes, net.hidden), dtype=np.float32)]
    while (live := read.fill(texts)).any():
        if live.sum() < 0.8 * len(live):
            read.drop(live)
            state[0] = state[0][live]
        yield state, read.take()


class Learner:
    """Adagrad over windows of texts."""

    def __init__(self, net: GRU, rate: float = RATE):
        self.net, self.rate, self.tokens = net, rate, 0
        self.squares = {n: np.full_like(getattr(net, n), 1e-4) for n in GRU.NAMES}

    def learn(self, texts: Iterator[np.ndarray], lanes: int = LANES) -> None:
        net = self.net
        for state, (last, want, goes_on, _) in windows(((0, t) for t in texts), net, lanes):
            n = int((want >= 0).sum())
            grads: dict = {}
            state[0] = net.window(state[0], last, want, goes_on, grads)
            self.tokens += n
            for name in GRU.NAMES:
                weights, squares = getattr(net, name), self.squares[name]
                if name == "x":
                    rows, g = grads["x"]
                elif name == "word_w" and len(grads["classes"]) < net.classes:
                    rows, g = grads["classes"], grads["word_w"][grads["classes"]]  # all others are 0 and change nothing
                else:
                    rows, g = None, grads[name]
                g *= np.float32(n ** -0.5)
                np.clip(g, -1, 1, out=g)
                if rows is None:
                    squares += g * g
                    root = np.sqrt(squares)
                else:
                    root = squares.take(rows, axis=0)
                    root += g * g
                    squares[rows] = root
                    np.sqrt(root, out=root)
                g *= np.float32(self.rate)
                g /= root
                if rows is None:
                    weights -= g
                else:
                    weights[rows] -= g


def learned_in(text: bytes, rounds: int) -> int:
    """The round in which a text's symbols are learned from: the text itself says it, so row order does not matter."""
    return crc32(text) % rounds


def score_texts(net: GRU, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each text's symbols (each has one at least), the state carried through."""
    out = np.zeros(len(texts))
    longest = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for state, (last, want, goes_on, owner) in windows(((i, texts[i]) for i in longest), net, min(SCORED_LANES, max(1, len(texts)))):
        state[0], states = net.states(state[0], last, goes_on)
        logp, _ = net.output(states.reshape(-1, net.hidden + 1), want.ravel())
        out += np.bincount(owner.ravel(), weights=logp, minlength=len(texts))
    return out / np.log(10)


# --- Spark -------------------------------------------------------------------

def _encode(docs: DataFrame, key: str, text: str, folds: int, fold: int, n_symbols: int, shared) -> DataFrame:
    """Per row: symbols (int16 bytes), token counts by kind, and the rarer tokens by their bytes.

    ``shared`` holds the frequent tokens, most frequent first, and log10(c + 1)
    by number.
    """
    prepare(docs.sparkSession)

    def make():
        frequent, logs = shared.value
        logs = np.append(logs, 0.0)  # rarer tokens: their counts are joined
        end = frequent.index(pa.scalar(END, type=frequent.type)).as_py()
        known = frequent if end >= 0 else pa.concat_arrays([frequent, pa.array([END], type=frequent.type)])
        end = end % len(known)

        def fn(texts: list[bytes]) -> list[list | np.ndarray | pa.Array]:
            at, which, distinct = words(texts, known)
            which = np.insert(which, at[1:], end)  # the end behind each text
            at = at + np.arange(len(at))
            log, is_rare, others = logs[np.minimum(which, len(frequent))], which >= len(frequent), np.minimum(which, n_symbols)
            symbols, is_other = others.astype("<i2"), others == n_symbols
            rarer = np.concatenate([[0], np.cumsum(is_rare)])[at]
            rare = pa.LargeListArray.from_arrays(rarer, distinct.take(pa.array(which[is_rare])))
            spans, sizes = [*zip(at[:-1].tolist(), at[1:].tolist())], np.diff(at)
            return [[symbols[a:b].tobytes() for a, b in spans], sizes, sizes - np.diff(rarer),
                    [float(log[a:b].sum()) for a, b in spans], [float(log[a:b][is_other[a:b]].sum()) for a, b in spans], rare]
        return fn

    fields = [T.StructField("symbols", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
              T.StructField("seen", T.LongType()), T.StructField("known_log", T.DoubleType()),
              T.StructField("other_log", T.DoubleType()), T.StructField("rare", T.ArrayType(T.BinaryType()))]
    rows = docs.select(docs[key].alias(key), docs[text].alias("__body"),
                       held_out(docs[key], folds, fold).alias("held_out"))
    return map_texts(rows, "__body", [key, "held_out"], fields, make, slice_bytes=LOOKED_UP)


def _train_round(spark: SparkSession, rows: DataFrame, net: GRU, round_number: int, rounds: int) -> None:
    """One round of training on the rows' symbols, then the average of all tasks' weights."""
    start = spark.sparkContext.broadcast(net)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = start.value
        own = GRU(np.ones(model.n), model.hidden)
        own.load(model.flat())

        def turns() -> Iterator[np.ndarray]:
            for batch in batches:
                some = [v.as_py() for v in batch.column(0)]
                for text in sorted(some, key=len, reverse=True):  # long ones first: lanes end together
                    if learned_in(text, rounds) == round_number:
                        yield np.frombuffer(text, dtype="<i2")

        learner = Learner(own)
        learner.learn(turns())
        if learner.tokens:
            weights = own.flat().astype(np.float64) * learner.tokens
            cuts = range(0, len(weights), SENT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cuts, pa.int64()), pa.array([weights[a:a + SENT] for a in cuts], pa.list_(pa.float64())),
                 pa.array([learner.tokens] * len(cuts), pa.int64())], ["part", "w", "n"])

    sent = rows.filter(~F.col("held_out")).select("symbols").mapInArrow(learn, "part long, w array<double>, n long")
    # By number within a part: sums of a part's weights are one small group each.
    numbered = sent.select("part", "n", F.posexplode("w").alias("i", "w"))
    mean = numbered.groupBy((F.col("part") + F.col("i")).alias("i")).agg((F.sum("w") / F.sum("n")).alias("w")).toPandas().sort_values("i")
    if len(mean):
        net.load(mean["w"].to_numpy())


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2,
              rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``key``, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    counts = stored(token_counts(docs.filter(~held_out(docs[key], folds, fold)), text), "token-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    short = counts.filter(F.octet_length("token") <= SHORT)
    least = _least_frequent(short)
    top = sorted(short.filter(F.col("c") >= least).collect(), key=lambda r: (-r.c, bytes(r.token)))
    frequent = pa.array([bytes(r.token) for r in top], type=pa.large_binary())
    shared = spark.sparkContext.broadcast((frequent, np.log10(np.array([r.c for r in top], dtype=np.float64) + 1)))
    n_symbols = min(len(top), MOST_SYMBOLS, max(LEAST_SYMBOLS, isqrt(distinct) // 2))
    symbol_counts = np.array([r.c for r in top[:n_symbols]] + [total - sum(r.c for r in top[:n_symbols])], dtype=np.float64)

    rows = _encode(docs, key, text, folds, fold, n_symbols, shared).withColumn("__row", F.monotonically_increasing_id())
    rows = stored(rows, "lm-rows")
    net = GRU(symbol_counts)
    for r in range(rounds):
        _train_round(spark, rows, net, r, rounds)

    # Counts of the tokens that are not broadcast: unseen ones add log10(0 + 1) = 0.
    rare = rows.select("__row", F.explode("rare").alias("__t"))
    held = counts.filter((F.col("c") < least) | (F.octet_length("token") > SHORT))
    found = rare.join(held, rare["__t"] == held["token"], "inner").groupBy("__row").agg(
        F.count(F.lit(1)).alias("__found"), F.sum(F.log10(F.col("c") + 1)).alias("__log"))
    scored = _scored(rows, net)
    out = scored.join(found.withColumnRenamed("__row", "__r"), F.col("__row") == F.col("__r"), "left")
    rare_log = F.coalesce("__log", F.lit(0.0))
    n_known = F.col("seen") + F.coalesce("__found", F.lit(0))
    others = float(np.log10(max(1, (symbol_counts[-1] + distinct - n_symbols + 1))))
    return out.select(
        key, "held_out", "n_tokens", n_known.alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("known_log") + rare_log - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"),
        (F.col("__net") + F.col("other_log") + rare_log - F.col("__others") * others).alias("score"))


def _scored(rows: DataFrame, net: GRU) -> DataFrame:
    """``rows`` without symbols and rare tokens, with the network's log10 probability and the number of *other*."""
    shared = rows.sparkSession.sparkContext.broadcast(net)
    keep = [c for c in rows.columns if c not in ("symbols", "rare")]
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("__net", T.DoubleType()),
                           T.StructField("__others", T.LongType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value

        def done(held):
            texts = [np.frombuffer(v.as_py(), dtype="<i2") for b in held for v in b.column(len(keep))]
            scores = score_texts(model, texts)
            others = [int((t == model.n - 1).sum()) for t in texts]
            at = 0
            for b in held:
                part = slice(at, at + len(b))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores[part]), pa.array(others[part], type=pa.int64())],
                                                 [*keep, "__net", "__others"])
                at += len(b)

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(len(keep)).nbytes // 2
            if size >= SCORED:
                yield from done(held)
                held, size = [], 0
        yield from done(held)

    return rows.select(*keep, "symbols").mapInArrow(score, schema)
