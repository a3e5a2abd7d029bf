"""A linear-chain conditional random field in numpy, over many sequences at once.

Sequences lie one after the other in flat arrays.  Every recursion steps
through positions and handles, at a position, all sequences that reach it;
sequences are ordered by length for that, so short ones cost nothing at late
positions.  Fitting maximises the regularised likelihood by AdaGrad steps over
all sequences, starting from zero: the result is deterministic.
"""

from __future__ import annotations

import numpy as np

LONG = 4096  # positions of a sequence that are stepped through one by one


class Layout:
    """Places of flat positions when sequences run side by side."""

    def __init__(self, sizes: np.ndarray):
        sizes = np.asarray(sizes, np.int64)
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        self.order, self.sizes, self.starts = order, sizes[order], starts[order]
        longest = int(self.sizes[0]) if len(sizes) else 0
        # Sequences of at least t + 1 positions, for each t.
        self.reach = np.searchsorted(-self.sizes, -np.arange(1, longest + 1), side="right")

    def at(self, t: int) -> np.ndarray:
        """Flat position t of every sequence that has one."""
        return self.starts[:self.reach[t]] + t


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def viterbi(scores: np.ndarray, trans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The best tag of every position; ties go to the smaller tag."""
    plan = Layout(sizes)
    best, back = scores.copy(), np.zeros(scores.shape, np.int8)
    for t in range(1, len(plan.reach)):
        here = plan.at(t)
        step = best[here - 1][:, :, None] + trans
        back[here] = step.argmax(axis=1)
        best[here] += step.max(axis=1)
    tags = np.zeros(len(scores), np.int8)
    ends = plan.starts + plan.sizes - 1
    ends = ends[plan.sizes > 0]
    tags[ends] = best[ends].argmax(axis=1)
    for t in range(len(plan.reach) - 1, 0, -1):
        here = plan.at(t)
        tags[here - 1] = back[here, tags[here]]
    return tags


def _chain_marginals(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Tag marginals of one long sequence.  Blocks of positions advance side by
    side: their transfer matrices first, then the vectors between blocks, then
    the vectors inside all blocks at once."""
    n, k = scores.shape
    width = max(1, int(n ** 0.5))
    blocks = (n - 1) // width
    inner = scores[1:1 + blocks * width].reshape(blocks, width, k)
    carry = trans + inner[:, 0, None, :]
    for t in range(1, width):
        carry = _log_sum(carry[:, :, :, None] + (trans + inner[:, t, None, :])[:, None], 2)
    alpha, beta = np.empty((n, k)), np.zeros((n, k))
    alpha[0] = scores[0]
    ahead, enter, leave = alpha[0], np.empty((blocks, k)), np.zeros((blocks, k))
    for b in range(blocks):
        enter[b] = ahead
        ahead = _log_sum(ahead[:, None] + carry[b], 0)
    end = 1 + blocks * width
    here = enter
    for t in range(width):
        here = inner[:, t] + _log_sum(here[:, :, None] + trans, 1)
        alpha[1 + t:end:width] = here
    for t in range(end, n):
        alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, None] + trans, 0)
    for t in range(n - 1, end - 1, -1):
        beta[t - 1] = _log_sum(trans + scores[t] + beta[t], 1)
    behind = beta[end - 1]
    for b in range(blocks - 1, -1, -1):
        leave[b] = behind
        behind = _log_sum(carry[b] + behind, 1)
    here = leave
    for t in range(width - 1, -1, -1):
        beta[1 + t:end:width] = here
        here = _log_sum(trans + (inner[:, t] + here)[:, None, :], 2)
    beta[0] = behind
    total = alpha + beta
    return np.exp(total - _log_sum(total, 1)[:, None])


def marginals(scores: np.ndarray, trans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Tag marginals of every position; sequences over ``LONG`` positions by
    themselves, the others side by side."""
    sizes = np.asarray(sizes, np.int64)
    out = np.empty(scores.shape)
    starts = np.cumsum(sizes) - sizes
    short = np.repeat(sizes <= LONG, sizes)
    out[short] = forward_backward(scores[short], trans, sizes[sizes <= LONG])
    for i in np.flatnonzero(sizes > LONG):
        part = slice(starts[i], starts[i] + sizes[i])
        out[part] = _chain_marginals(scores[part], trans)
    return out


def forward_backward(scores: np.ndarray, trans: np.ndarray, sizes: np.ndarray, pairs: bool = False):
    """Tag marginals of every position; with ``pairs`` also the expected
    transition counts and the summed log normaliser."""
    plan = Layout(sizes)
    alpha, beta = scores.copy(), np.zeros(scores.shape)
    for t in range(1, len(plan.reach)):
        here = plan.at(t)
        alpha[here] += _log_sum(alpha[here - 1][:, :, None] + trans, 1)
    for t in range(len(plan.reach) - 1, 0, -1):
        here = plan.at(t)
        beta[here - 1] = _log_sum(trans + (scores[here] + beta[here])[:, None, :], 2)
    total = alpha + beta
    norm = _log_sum(total, 1) if len(total) else np.zeros(0)
    marginal = np.exp(total - norm[:, None])
    if not pairs:
        return marginal
    expected = np.zeros(trans.shape)
    for t in range(1, len(plan.reach)):
        here = plan.at(t)
        joint = alpha[here - 1][:, :, None] + trans + (scores[here] + beta[here])[:, None, :] - norm[here][:, None, None]
        expected += np.exp(joint).sum(axis=0)
    ends = (plan.starts + plan.sizes - 1)[plan.sizes > 0]
    return marginal, expected, norm[ends].sum()


def fit(features: np.ndarray, tags: np.ndarray, sizes: np.ndarray, n_tags: int, steps: int = 150, rate: float = 0.5, decay: float = 1e-3):
    """Weights (features x tags) and transitions that fit the tagged sequences.

    ``features`` is a dense matrix, one row per position.
    """
    weights, trans = np.zeros((features.shape[1], n_tags)), np.zeros((n_tags, n_tags))
    seen_w, seen_t = np.full(weights.shape, 1e-8), np.full(trans.shape, 1e-8)
    sizes = np.asarray(sizes, np.int64)
    gold = np.eye(n_tags)[tags]
    inner = np.ones(len(tags), bool)
    inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
    at = np.flatnonzero(inner)
    moves = np.zeros((n_tags, n_tags))
    np.add.at(moves, (tags[at - 1], tags[at]), 1)
    n = max(1, len(tags))
    for _ in range(steps if len(tags) else 0):
        marginal, expected, _ = forward_backward(features @ weights, trans, sizes, pairs=True)
        grad_w = features.T @ (gold - marginal) / n - decay * weights
        grad_t = (moves - expected) / n - decay * trans
        seen_w += grad_w ** 2
        seen_t += grad_t ** 2
        weights += rate * grad_w / np.sqrt(seen_w)
        trans += rate * grad_t / np.sqrt(seen_t)
    return weights, trans
