"""A two-state linear-chain conditional random field over the lines of a document.

Plain numpy, used on both sides of Spark: `fit` runs on the driver over a bounded sample of labelled documents,
`marginals` and `viterbi` run over Arrow batches on the executors. State 1 is good (content), state 0 is bad
(boilerplate). A line's unary score is linear in its own features and those of its two neighbours, the pairwise score
is a 2x2 table, so every line is judged in its context.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Classes of bytes that are counted in each line.
CLASSES = ("upper", "lower", "digit", "symbol", "bang", "pipe", "stop", "comma", "space", "quote", "high")
_TABLE = np.full(256, 255, dtype=np.uint8)
for _i, _members in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&<>@^~_=+{}[]\\/", b"!?", b"|", b".:;", b",", b" \t\r\x0b\x0c", b"\"'`")
):
    _TABLE[list(_members)] = _i
_TABLE[0xC0:] = 10  # the first byte of a character beyond ASCII
#: Features of a line by itself.
OWN = len(CLASSES) + 8
#: With both neighbours' features and the two ends.
WIDTH = 3 * OWN + 2


def split_lines(text: str | None) -> list[str]:
    """The lines of a text, without those that hold white space only. None has none."""
    return [x for x in (text or "").split("\n") if x and not x.isspace()]


def line_features(docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of a batch, the bounds of each document's lines, and the lines' lengths in characters."""
    bounds = np.zeros(len(docs) + 1, dtype=np.int64)
    np.cumsum([len(d) for d in docs], out=bounds[1:])
    n = int(bounds[-1])
    own = np.zeros((n, OWN), dtype=np.float32)
    chars = np.zeros(n, dtype=np.float64)
    if not n:
        return np.zeros((0, WIDTH), dtype=np.float32), bounds, chars
    raw = [line.encode("utf-8", "surrogatepass") for d in docs for line in d]
    starts = np.zeros(n, dtype=np.int64)
    np.cumsum([len(x) for x in raw[:-1]], out=starts[1:])
    codes = _TABLE[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    size = np.diff(np.append(starts, len(codes))).astype(np.float32)
    for k in range(len(CLASSES)):
        own[:, k] = np.add.reduceat(codes == k, starts) / size
    i = 0
    base = len(CLASSES)
    for lines in docs:
        seen: set[str] = set()
        for line in lines:
            words = line.split()
            distinct = len(set(words))
            pairs = len(set(zip(words, words[1:])))
            chars[i] = len(line)
            own[i, base] = np.log1p(len(line))
            own[i, base + 1] = np.log1p(len(words))
            own[i, base + 2] = len(line) / (len(words) + 1.0) / 10.0
            own[i, base + 3] = 1.0 - distinct / max(1, len(words))
            own[i, base + 4] = 1.0 - pairs / (len(words) - 1) if len(words) > 1 else 0.0
            own[i, base + 5] = line in seen
            own[i, base + 6] = line[-1] in ".!?"
            own[i, base + 7] = line[0].isupper()
            seen.add(line)
            i += 1
    first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    some = bounds[:-1] < bounds[1:]
    first[bounds[:-1][some]] = True
    last[bounds[1:][some] - 1] = True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    ends = np.stack([first, last], axis=1).astype(np.float32)
    return np.concatenate([own, before, after, ends], axis=1), bounds, chars


@dataclass
class Model:
    """Weights for state 1 against state 0, pairwise scores, and the map from a document's mean marginal to its score."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    pair: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    #: Added to every line's score for state 1 before the Viterbi decoding.
    shift: float = 0.0

    def unary(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weight + self.bias


def neutral() -> Model:
    """What is used when no labelled row exists: every line is more likely good than bad."""
    return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 1.0, np.zeros((2, 2)))


def _steps(bounds: np.ndarray):
    """Positions by time: documents in order of falling length, so those that still run are a prefix."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    lengths, begin = lengths[order], bounds[:-1][order]
    running = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
    return begin, lengths, running


def marginals(unary: np.ndarray, pair: np.ndarray, bounds: np.ndarray, pairs: bool = False):
    """P(state 1) of every line by forward-backward in log space; with pairs also the probabilities of the transitions
    behind each line that has a next one, and where these lines are, and the log of each document's partition sum."""
    begin, lengths, running = _steps(bounds)
    n = len(unary)
    u = np.zeros((n, 2))
    u[:, 1] = unary
    f, b = np.zeros((n, 2)), np.zeros((n, 2))
    for t, k in enumerate(running):
        at = begin[:k] + t
        f[at] = u[at] if t == 0 else u[at] + np.logaddexp(f[at - 1, :1] + pair[0], f[at - 1, 1:] + pair[1])
    for t in range(len(running) - 2, -1, -1):
        at = begin[: running[t + 1]] + t
        nxt = u[at + 1] + b[at + 1]
        b[at] = np.logaddexp(pair[:, 0] + nxt[:, :1], pair[:, 1] + nxt[:, 1:])
    total = f + b
    p = 1.0 / (1.0 + np.exp(np.clip(total[:, 0] - total[:, 1], -700, 700)))
    if not pairs:
        return p
    inner = np.ones(n, dtype=bool)
    inner[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False
    at = np.flatnonzero(inner)
    log_z = np.logaddexp(total[:, 0], total[:, 1])
    joint = f[at, :, None] + pair[None] + (u[at + 1] + b[at + 1])[:, None, :] - log_z[at][:, None, None]
    return p, np.exp(joint), at, log_z[bounds[:-1]]


def viterbi(unary: np.ndarray, pair: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The best state of every line; ties go to state 1."""
    begin, lengths, running = _steps(bounds)
    n = len(unary)
    best = np.zeros((n, 2))
    back = np.zeros((n, 2), dtype=np.int8)
    u = np.zeros((n, 2))
    u[:, 1] = unary
    for t, k in enumerate(running):
        at = begin[:k] + t
        if t == 0:
            best[at] = u[at]
            continue
        options = best[at - 1][:, :, None] + pair[None]
        back[at] = options[:, 1] >= options[:, 0]
        best[at] = u[at] + options.max(axis=1)
    out = np.zeros(n, dtype=np.int8)
    for t in range(len(running) - 1, -1, -1):
        k = running[t]
        at = begin[:k] + t
        ends = lengths[:k] == t + 1
        out[at[ends]] = best[at[ends], 1] >= best[at[ends], 0]
        go = at[~ends]
        out[go] = back[go + 1, out[go + 1]]
    return out


def objective(theta: np.ndarray, z: np.ndarray, y: np.ndarray, both: np.ndarray, bounds: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Penalised negative log-likelihood of soft line states, and its gradient.

    y: P(state 1) of each line; both: P of each pair of states behind each line that has a next one; weight: of each document.
    A document's log-likelihood counts by its weight over its number of lines, in all its terms.
    """
    w, bias, pair = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
    unary = z @ w + bias
    p, joint, at, log_z = marginals(unary, pair, bounds, pairs=True)
    lengths = np.diff(bounds)
    per_doc = weight / lengths
    per_line = np.repeat(per_doc, lengths)
    gold = (per_line * y * unary).sum() + (per_line[at, None, None] * both * pair).sum()
    value = (per_doc * log_z).sum() - gold + 0.5 * penalty * ((w**2).sum() + (pair**2).sum())
    g = (p - y) * per_line
    turns = (per_line[at, None, None] * (joint - both)).sum(axis=0)
    return float(value), np.concatenate([z.T @ g + penalty * w, [g.sum()], (turns + penalty * pair).ravel()])


def line_targets(unary: np.ndarray, pair: np.ndarray, y_doc: np.ndarray, bounds: np.ndarray, chars: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The expectation step: line states given the model, and given that on average at least the share `least` of a
    document's characters has the state of its label.

    Each document's lines get a common bonus towards its label, the least of a grid that reaches the share."""
    lengths = np.diff(bounds)
    sign = np.where(y_doc == 1, 1.0, -1.0)
    bonus = np.zeros(len(y_doc))
    for step in (0.0, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0):
        p = marginals(unary + np.repeat(bonus * sign, lengths), pair, bounds)
        share = document_means(np.where(np.repeat(y_doc, lengths) == 1, p, 1 - p), chars, bounds)
        bonus = np.where((share < least) & (bonus < step), step, bonus)
    p, joint, _, _ = marginals(unary + np.repeat(bonus * sign, lengths), pair, bounds, pairs=True)
    return p, joint


def fit(docs: list[list[str]], labels: np.ndarray, rounds: int = 120, penalty: float = 1e-3, rate: float = 0.06, again: int = 2, least: float = 0.6) -> Model:
    """Penalised maximum likelihood by Adam, with line states by expectation-maximisation.

    At first each line of a labelled document has its document's label, and only lines' own features are fitted, so that
    boilerplate in good documents, which bad ones have more of, comes out as bad. Then, `again` times, line states are
    estimated under the model, with at least the share `least` of each document's characters in the state of its label,
    and the whole model is fitted to them. Each document weighs the same whatever its length, and the two labels weigh the same in sum."""
    keep = [i for i, d in enumerate(docs) if d]
    docs, y_doc = [docs[i] for i in keep], np.asarray(labels, dtype=np.int64)[keep]
    if not docs or len(set(y_doc.tolist())) < 2:
        return neutral()
    x, bounds, chars = line_features(docs)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = ((x - mean) / scale).astype(np.float64)
    lengths = np.diff(bounds)
    share = np.where(y_doc == 1, 0.5 / (y_doc == 1).sum(), 0.5 / (y_doc == 0).sum())
    y = np.repeat(y_doc, lengths).astype(np.float64)
    both = np.zeros((int(np.maximum(0, lengths - 1).sum()), 2, 2))
    of_pair = np.repeat(y_doc, np.maximum(0, lengths - 1))
    both[np.arange(len(both)), of_pair, of_pair] = 1.0
    theta = np.zeros(z.shape[1] + 1 + 4)
    for turn in range(again + 1):
        if turn:
            y, both = line_targets(z @ theta[:-5] + theta[-5], theta[-4:].reshape(2, 2), y_doc, bounds, chars, least)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for k in range(1, (rounds if not turn else rounds // 2) + 1):
            _, grad = objective(theta, z, y, both, bounds, share, penalty)
            if not turn:
                grad[OWN:-5], grad[-4:] = 0, 0
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            theta = theta - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    model = Model(mean, scale, theta[:-5].copy(), float(theta[-5]), theta[-4:].reshape(2, 2).copy())
    raw = document_means(marginals(z @ model.weight + model.bias, model.pair, bounds), chars, bounds)
    model.slope, model.offset = _calibrate(_logit(raw), y_doc.astype(np.float64), share)
    model.shift = _shift(model, z, y_doc, chars, bounds)
    return model


def _shift(model: Model, z: np.ndarray, y: np.ndarray, chars: np.ndarray, bounds: np.ndarray, lost_costs: float = 5.0) -> float:
    """The smallest shift with the least cost over the sample: losing a good document costs five times keeping a bad one."""
    best = (np.inf, 0.0)
    for shift in np.arange(0.0, 8.5, 0.5):
        states = viterbi(z @ model.weight + model.bias + shift, model.pair, bounds).astype(np.float64)
        kept = document_means(states, chars, bounds, 0.0) >= 0.5
        cost = lost_costs * (~kept[y == 1]).mean() + kept[y == 0].mean()
        best = min(best, (cost, float(shift)))
    return best[1]


def document_means(p: np.ndarray, chars: np.ndarray, bounds: np.ndarray, empty: float = 0.5) -> np.ndarray:
    """Mean of the lines' values in each document, weighted by their lengths; `empty` where there are no lines."""
    out = np.full(len(bounds) - 1, empty)
    some = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(some):
        top = np.add.reduceat(p * chars, bounds[:-1][some])
        out[some] = top / np.add.reduceat(chars, bounds[:-1][some])
    return out


def _logit(p: np.ndarray) -> np.ndarray:
    q = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the mean marginal's logit, by Newton steps with a small penalty."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        g = np.array([(weight * (p - y) * x).sum() + 1e-3 * (a - 1), (weight * (p - y)).sum() + 1e-3 * b])
        h = weight * p * (1 - p)
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        a, b = np.array([a, b]) - np.linalg.solve(hess, g)
    return float(max(a, 1e-3)), float(b)


def scores(model: Model, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Quality of every document from 0 to 1, and its number of lines. A text without lines is as bad as can be."""
    x, bounds, chars = line_features(docs)
    p = marginals(model.unary(x), model.pair, bounds)
    s = 1 / (1 + np.exp(-np.clip(model.slope * _logit(document_means(p, chars, bounds)) + model.offset, -50, 50)))
    lengths = np.diff(bounds)
    return np.where(lengths == 0, 0.0, s), lengths


def content_shares(model: Model, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Share of each document's characters that lie in content lines, its number of lines, and the lines' states."""
    x, bounds, chars = line_features(docs)
    states = viterbi(model.unary(x) + model.shift, model.pair, bounds)
    return document_means(states.astype(np.float64), chars, bounds, 0.0), np.diff(bounds), [states[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
