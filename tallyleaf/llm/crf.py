"""A linear-chain conditional random field over words, trained by gradient steps and read by forward-backward.

Words are handled as UTF-8 bytes, many at a time: a text is lower-cased words joined by single blanks.
"""

import numpy as np

BUCKETS = 1 << 15
#: Words of one chain.
LENGTH = 32
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mixed(x, seed):
    x = (x + np.uint64(seed + 1)) * np.uint64(MIX[seed % 3])
    return x ^ (x >> np.uint64(31))


def _bucket(x):
    return (x >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


class Words:
    """Hashed features of the words of a text.

    Per byte position the bigram and the trigram of bytes that begin there, a blank framing each word, so those at the edges
    are affixes of one and two bytes; per word prefix and suffix of three bytes and a hash of the whole word.
    Bucket BUCKETS stands for none.
    """

    def __init__(self, data):
        raw = np.frombuffer(b" " + data + b"    ", np.uint8)
        size = len(data) + 2
        wide = raw.astype(np.uint64)
        two = wide[:size] | (wide[1 : size + 1] << np.uint64(8))
        three = two | (wide[2 : size + 2] << np.uint64(16))
        blanks = np.flatnonzero(raw[:size] == 32)
        self.starts, ends = blanks[:-1], blanks[1:]
        used = size - 1
        cross = raw[1 : used + 1] == 32
        self.bigrams = _bucket(_mixed(two[:used], 0))
        hashed = _mixed(three[:used], 1)
        hashed[cross] = 0
        self.trigrams = np.where(cross, BUCKETS, _bucket(hashed))
        lengths = ends - self.starts - 1
        long = lengths >= 3
        first = three[self.starts] | (wide[self.starts + 3] << np.uint64(24))
        last = three[np.maximum(ends - 3, 0)] | np.uint64(1 << 32)
        self.prefixes = np.where(long, _bucket(_mixed(first, 2)), BUCKETS)
        self.suffixes = np.where(long, _bucket(_mixed(last, 3)), BUCKETS)
        self.whole = _mixed(np.add.reduceat(hashed, self.starts) + lengths.astype(np.uint64) + first, 4)
        letter = ((raw[:used] >= 97) & (raw[:used] <= 122)) | (raw[:used] >= 128)
        self.letters = np.add.reduceat(letter, self.starts, dtype=np.int64) > 0

    def __len__(self):
        return len(self.starts)

    def entries(self, lexicon):
        """The place of each word in a sorted lexicon of hashes, plus BUCKETS + 1; BUCKETS for words that are not in it."""
        if not len(lexicon):
            return np.full(len(self), BUCKETS)
        at = np.minimum(np.searchsorted(lexicon, self.whole), len(lexicon) - 1)
        return np.where(lexicon[at] == self.whole, BUCKETS + 1 + at, BUCKETS)

    def sums(self, weights, lexicon):
        """The sum of the weights of each word's features, [words, labels]."""
        by_byte = weights[self.bigrams] + weights[self.trigrams]
        total = np.add.reduceat(by_byte, self.starts, axis=0)
        total += weights[self.prefixes] + weights[self.suffixes] + weights[self.entries(lexicon)]
        return np.where(self.letters[:, None], total, 0)


def emissions(sums):
    """Exponentials of emission scores; only differences between labels count, a bounded range keeps products finite."""
    return np.exp(np.clip(sums - sums.max(axis=1, keepdims=True), -30, 0))


def forward_backward(scores, valid, moves):
    """Posterior probabilities of labels with the forward and backward tables, [chains, places, labels].

    ``scores`` are exponentials of emission scores, ``valid`` marks real places (they come first in each chain), ``moves``
    are exponentials of transition scores. Each step is scaled to sum to one.
    """
    forward, backward = np.empty_like(scores), np.empty_like(scores)
    forward[:, 0] = scores[:, 0] / scores[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, scores.shape[1]):
        step = (forward[:, t - 1] @ moves) * scores[:, t]
        forward[:, t] = step / step.sum(axis=1, keepdims=True)
    backward[:, -1] = 1.0
    for t in range(scores.shape[1] - 2, -1, -1):
        step = (scores[:, t + 1] * backward[:, t + 1]) @ moves.T
        step /= step.sum(axis=1, keepdims=True)
        backward[:, t] = np.where(valid[:, t + 1, None], step, 1.0)
    both = forward * backward
    return both / both.sum(axis=2, keepdims=True), forward, backward


def word_hashes(words):
    """The hashes by which a lexicon knows words (lower case, no blanks)."""
    return Words(" ".join(words).encode()).whole if words else np.zeros(0, np.uint64)


def train(chains, n_labels, lexicon, seed=42, epochs=6, rate=0.5, penalty=1e-5):
    """(weights, moves) from chains [(words, labels)] of at most LENGTH words, by AdaGrad on the log-likelihood."""
    table = {}
    for words, _ in chains:
        for w in words:
            table.setdefault(w, len(table))
    found = Words(" ".join(table).encode())
    n_words, n_weights = len(table), BUCKETS + 1 + len(lexicon)
    owner = np.repeat(np.arange(n_words), np.diff(np.append(found.starts, len(found.bigrams))))
    each = np.arange(n_words)
    feature = np.concatenate([found.bigrams, found.trigrams, found.prefixes, found.suffixes, found.entries(lexicon)])
    owner = np.concatenate([owner, owner, each, each, each])
    real = (feature != BUCKETS) & found.letters[owner]
    feature, owner = feature[real], owner[real]
    words = np.full((len(chains), LENGTH), n_words, np.int64)
    labels = np.zeros((len(chains), LENGTH), np.int64)
    for i, (ws, ls) in enumerate(chains):
        words[i, : len(ws)], labels[i, : len(ws)] = [table[w] for w in ws], ls
    valid, one = words < n_words, np.eye(n_labels)
    weights, moves = np.zeros((n_weights, n_labels)), np.zeros((n_labels, n_labels))
    seen_w, seen_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // 256)):
            ok, truth, used = valid[part], labels[part], words[part]
            sums = np.stack(
                [np.bincount(owner, weights[feature, k], minlength=n_words + 1) for k in range(n_labels)], axis=1
            )
            scores = emissions(sums)[used]
            likely, forward, backward = forward_backward(scores, ok, np.exp(moves))
            error = np.where(ok[:, :, None], one[truth] - likely, 0.0).reshape(-1, n_labels)
            slope = np.empty_like(weights)
            for k in range(n_labels):
                by_word = np.bincount(used.ravel(), error[:, k], minlength=n_words + 1)
                slope[:, k] = np.bincount(feature, by_word[owner], minlength=n_weights)
            slope = slope / len(part) - penalty * weights
            pairs = forward[:, :-1, :, None] * np.exp(moves) * (scores * backward)[:, 1:, None, :]
            pairs /= pairs.sum(axis=(2, 3), keepdims=True)
            true = one[truth][:, :-1, :, None] * one[truth][:, 1:, None, :]
            slope_m = np.where(ok[:, 1:, None, None], true - pairs, 0.0).sum(axis=(0, 1)) / len(part) - 1e-3 * moves
            seen_w += slope**2
            seen_m += slope_m**2
            weights += rate * slope / np.sqrt(seen_w)
            moves += rate * slope_m / np.sqrt(seen_m)
    return weights.astype(np.float32), moves.astype(np.float32)


def posteriors(pieces, weights, moves, lexicon):
    """[words, labels] and which words have letters, for texts one after the other; chains do not run from one to the next.

    ``pieces`` are texts as UTF-8, not empty. Returns the two arrays and the number of words of each text.
    """
    found = Words(b" ".join(pieces))
    counts = np.array([p.count(b" ") + 1 for p in pieces])
    chains = -(-counts // LENGTH)
    first_chain, first_word = np.cumsum(chains) - chains, np.cumsum(counts) - counts
    at = np.arange(len(found)) + np.repeat(first_chain * LENGTH - first_word, counts)
    scores = np.ones((chains.sum() * LENGTH, weights.shape[1]), np.float32)
    valid = np.zeros(len(scores), bool)
    scores[at], valid[at] = emissions(found.sums(weights, lexicon)), True
    shape = (-1, LENGTH, weights.shape[1])
    likely, _, _ = forward_backward(scores.reshape(shape), valid.reshape(shape[:2]), np.exp(moves))
    return likely.reshape(len(scores), -1)[at], found.letters, counts
