"""Linear-chain conditional random field over the words of texts.

Words are runs of letters, found and hashed on whole arrays of UTF-8 bytes.
A word's features are its lower-cased self (lexicon) and its byte n-grams with
marked ends (so prefixes and suffixes are features of their own), hashed into
a fixed number of buckets.  A chain is a run of up to ``CHAIN`` words of one
text; forward-backward runs over all chains of a slice at once and gives
every word's label marginals.

Training is full-batch Adam on the conditional log-likelihood, in numpy, over
a bounded sample; scoring cost is one feature pass per distinct word of a
slice and one small matrix product per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: log2 of the feature buckets: the size of a model's weight table.
BITS = 18
#: Byte n-grams of a word with its end marks.
GRAMS = (2, 3, 4, 5)
#: Words in a chain.
CHAIN = 64
#: Bytes tokenised at once.
WINDOW = 4_000_000
#: Cells (places of chains times labels) that training holds at once.
CELLS = 8_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all of ``x``."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(29))
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


_CODE = mixed(np.arange(1, 259, dtype=np.uint64) * _BASE)  # of the 256 bytes and the two end marks

#: Bytes of ASCII letters and of all other characters beyond ASCII.
LETTERS = np.array([0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80 for c in range(256)])


def lowered(raw: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin-1 letters, byte by byte."""
    out = raw + ((raw >= 0x41) & (raw <= 0x5A)).astype(np.uint8) * np.uint8(32)
    if len(raw) > 1:
        second = raw[1:]
        up = (raw[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        out[1:] += up.astype(np.uint8) * np.uint8(32)
    return out


def word_bounds(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true in ``member``; a run ends where a text does."""
    n = len(member)
    before = np.zeros(n + 1, bool)
    before[1:] = member
    before[offsets] = False
    starts = np.flatnonzero(member & ~before[:n])
    after = np.zeros(n + 1, bool)
    after[:n] = member
    after[offsets] = False
    ends = np.flatnonzero(member & ~after[1:]) + 1
    return starts, ends


def hash_words(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, by differences of one running polynomial."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            a = int(starts[at])
            to = max(at + 1, int(np.searchsorted(ends, a + WINDOW, side="right")))
            part = lower[a:int(ends[to - 1])]
            power = np.full(len(part) + 1, _BASE, np.uint64)
            power[0] = 1
            np.cumprod(power, out=power)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_CODE[part] * power[:-1], out=total[1:])
            s, e = starts[at:to] - a, ends[at:to] - a
            inverse = np.full(len(part) + 1, _BASE_INVERSE, np.uint64)
            inverse[0] = 1
            np.cumprod(inverse, out=inverse)
            out[at:to] = mixed((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * _BASE)
            at = to
    return out


@dataclass
class Words:
    """The words of a slice of texts."""

    lower: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    w_start: np.ndarray  # a place of each distinct word
    w_end: np.ndarray
    which: np.ndarray  # number of each word's distinct word
    hashes: np.ndarray  # of the distinct words


def words_in(raw: np.ndarray, offsets: np.ndarray) -> Words:
    lower = lowered(raw)
    start, end = word_bounds(LETTERS[raw], offsets)
    doc = np.searchsorted(offsets, start, side="right") - 1
    hashes, first, which = np.unique(hash_words(lower, start, end), return_index=True, return_inverse=True)
    return Words(lower, start, end, doc, start[first], end[first], which, hashes)


def grams(lower: np.ndarray, start: np.ndarray, end: np.ndarray, sizes=GRAMS):
    """Yields, for each n, (number of the word, 64-bit hash) of the words' byte n-grams."""
    width = end - start + 2
    word = np.repeat(np.arange(len(start)), width)
    pos = np.arange(len(word)) - np.repeat(np.cumsum(width) - width, width)
    byte = np.full(len(word), 256)
    last = pos == width[word] - 1
    byte[last] = 257
    inner = (pos > 0) & ~last
    byte[inner] = lower[start[word[inner]] + pos[inner] - 1]
    code = _CODE[byte]
    left = width[word] - pos
    h = code.copy()
    with np.errstate(over="ignore"):
        for n in range(2, max(sizes) + 1):
            if len(code) < n:
                return
            h = h[:len(code) - n + 1] * _BASE + code[n - 1:]
            if n in sizes:
                ok = np.flatnonzero(left[:len(h)] >= n)
                yield word[ok], mixed(h[ok] + np.uint64(n))


def buckets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct word, bucket) of all features, and each word's scale."""
    start, end = words.w_start, words.w_end
    shift = np.uint64(64 - BITS)
    owner = [np.arange(len(start))]
    bucket = [(words.hashes >> shift).astype(np.int64)]
    for w, h in grams(words.lower, start, end):
        owner.append(w)
        bucket.append((h >> shift).astype(np.int64))
    # Words of any length get emissions of one order.
    scale = 1 / np.sqrt(np.maximum(end - start, 1) / 8 + 1)
    return np.concatenate(owner), np.concatenate(bucket), scale


def _emissions(owner, bucket, scale, weights) -> np.ndarray:
    return np.stack([np.bincount(owner, weights[:, k][bucket], len(scale)) * scale
                     for k in range(weights.shape[1])], axis=1)


@dataclass
class Chains:
    """Words laid out as rows of up to CHAIN words."""

    row: np.ndarray
    col: np.ndarray
    mask: np.ndarray


def chains_of(doc: np.ndarray) -> Chains:
    n = len(doc)
    new = np.ones(n, bool)
    new[1:] = doc[1:] != doc[:-1]
    place = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    col = place % CHAIN
    row = np.cumsum(col == 0) - 1
    mask = np.zeros((int(row[-1]) + 1 if n else 0, CHAIN), bool)
    mask[row, col] = True
    return Chains(row, col, mask)


def forward_backward(emission: np.ndarray, chains: Chains, transition: np.ndarray, pairs: bool = False):
    """Label marginals of every word; with ``pairs`` also the summed
    marginals of neighbouring labels and the log-partition."""
    k = emission.shape[1]
    rows = chains.mask.shape[0]
    top = emission.max(axis=1, keepdims=True) if len(emission) else emission[:, :1]
    dense = np.ones((CHAIN, rows, k))
    dense[chains.col, chains.row] = np.exp(emission - top)
    move = np.exp(transition)
    mask = chains.mask.T
    alpha = np.empty_like(dense)
    log_z = float(top.sum())
    now = dense[0] / k
    for t in range(CHAIN):
        if t:
            now = np.where(mask[t][:, None], (alpha[t - 1] @ move) * dense[t], alpha[t - 1])
        norm = now.sum(axis=1, keepdims=True)
        if pairs:
            log_z += float(np.log(norm[mask[t]]).sum())
        alpha[t] = now / norm
    marginal = np.empty_like(dense)
    beta = np.ones((rows, k))
    both = np.zeros((k, k))
    for t in range(CHAIN - 1, -1, -1):
        m = alpha[t] * beta
        marginal[t] = m / m.sum(axis=1, keepdims=True)
        if t:
            inner = dense[t] * beta
            if pairs:
                before, after = alpha[t - 1][mask[t]], inner[mask[t]]
                total = ((before @ move) * after).sum(axis=1, keepdims=True)
                both += move * ((before / total).T @ after)
            step = inner @ move.T
            beta = np.where(mask[t][:, None], step / step.sum(axis=1, keepdims=True), 1.0)
    out = marginal[chains.col, chains.row]
    return (out, both, log_z) if pairs else out


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # buckets x labels
    transition: np.ndarray
    extra: tuple = ()

    def state(self) -> tuple:
        """Plain values, which tasks read without this module installed."""
        return self.labels, self.weights, self.transition, self.extra

    @staticmethod
    def of(state: tuple | None) -> Model | None:
        return state and Model(*state)

    def marginals(self, words: Words) -> np.ndarray:
        if not len(words.start):
            return np.zeros((0, len(self.labels)))
        emission = _emissions(*buckets(words), self.weights)
        return forward_backward(emission[words.which], chains_of(words.doc), self.transition)


def fit(labels: list[str], words: Words, target: np.ndarray, steps: int = 30, rate: float = 0.15,
        decay: float = 1e-3, weight: np.ndarray | None = None) -> Model:
    """A CRF for the words' labels (numbers in ``target``).  Chains are taken
    some at a time, so that many labels need no more memory a step."""
    k = len(labels)
    owner, bucket, scale = buckets(words)
    used, bucket = np.unique(bucket, return_inverse=True)
    chains = chains_of(words.doc)
    distinct = len(scale)
    step_rows = max(1, CELLS // (CHAIN * k))
    parts = []  # the words of some chains, and the chains
    for lo in range(0, len(chains.mask), step_rows):
        a, z = np.searchsorted(chains.row, (lo, lo + step_rows))
        parts.append((slice(a, z), Chains(chains.row[a:z] - lo, chains.col[a:z], chains.mask[lo:lo + step_rows])))
    follows = chains.col[1:] > 0
    seen = np.zeros((k, k))
    np.add.at(seen, (target[:-1][follows], target[1:][follows]), 1)
    params = [np.zeros((len(used), k)), np.zeros((k, k))]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        emission = _emissions(owner, bucket, scale, params[0])
        per_word, both = np.zeros((distinct, k)), np.zeros((k, k))
        for at, some in parts:
            which, goal = words.which[at], target[at]
            miss, seen_both, _ = forward_backward(emission[which], some, params[1], pairs=True)
            miss[np.arange(len(goal)), goal] -= 1
            for j in range(k):
                per_word[:, j] += np.bincount(which, miss[:, j], distinct)
            both += seen_both
        per_word *= scale[:, None]
        grads = [np.stack([np.bincount(bucket, per_word[owner, j], len(used)) for j in range(k)], axis=1)
                 + decay * params[0], both - seen + decay * params[1]]
        for p, g, m, s in zip(params, grads, mean, square):
            m += 0.1 * (g - m)
            s += 0.05 * (g * g - s)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.95 ** step)) + 1e-3)
    weights = np.zeros((1 << BITS, k), np.float32)
    weights[used] = params[0]
    return Model(labels, weights, params[1])
