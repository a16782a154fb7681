"""Linear-chain conditional random fields in numpy: training on a small table, and batched decoding of many sequences."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Rows of a batch of sequences, counted with padding; bounds memory. A longer sequence is a batch of its own.
BATCH_ROWS = 1 << 15


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def batches(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Sequence numbers in groups of similar length."""
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * lengths[order[to]] <= BATCH_ROWS:
            to += 1
        yield order[at:to]
        at = to


@dataclass
class Chain:
    """Weights: (features + 1, labels) with the bias last, and (labels, labels) from one position to the next."""

    weights: np.ndarray
    moves: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Score of each label for each row of features."""
        return rows @ self.weights[:-1] + self.weights[-1]

    def _padded(self, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = starts[:, None] + np.arange(lengths.max())[None, :]
        inside = np.arange(lengths.max())[None, :] < lengths[:, None]
        return np.where(inside[..., None], scores[np.where(inside, at, 0)], 0.0), inside

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of each label at each row, by forward and backward sums; sequences follow one another."""
        out, starts = np.zeros_like(scores), np.cumsum(lengths) - lengths
        for group in batches(lengths):
            unary, inside = self._padded(scores, starts[group], lengths[group])
            node, _ = self._sums(unary, inside)
            out[(starts[group][:, None] + np.arange(inside.shape[1])[None, :])[inside]] = node[inside]
        return out

    def _sums(self, unary: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        forward, backward = np.zeros_like(unary), np.zeros_like(unary)
        forward[:, 0] = unary[:, 0]
        for t in range(1, unary.shape[1]):
            step = _log_sum(forward[:, t - 1, :, None] + self.moves[None], 1) + unary[:, t]
            forward[:, t] = np.where(inside[:, t, None], step, forward[:, t - 1])  # past its end a sequence stands still
        for t in range(unary.shape[1] - 2, -1, -1):
            step = _log_sum(self.moves[None] + (unary[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], step, 0.0)
        total = _log_sum(forward[:, -1], 1)
        return np.exp(forward + backward - total[:, None, None]), (forward, backward, total)

    def best(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Viterbi: the most likely label of each row."""
        out, starts = np.zeros(len(scores), dtype=np.int64), np.cumsum(lengths) - lengths
        for group in batches(lengths):
            unary, inside = self._padded(scores, starts[group], lengths[group])
            n, width, labels = unary.shape
            back = np.zeros((n, width, labels), dtype=np.int64)
            top = unary[:, 0]
            for t in range(1, width):
                reach = top[:, :, None] + self.moves[None]
                back[:, t] = np.where(inside[:, t, None], reach.argmax(axis=1), np.arange(labels)[None])
                top = np.where(inside[:, t, None], reach.max(axis=1) + unary[:, t], top)
            path = np.zeros((n, width), dtype=np.int64)
            path[:, -1] = top.argmax(axis=1)
            for t in range(width - 1, 0, -1):
                path[:, t - 1] = back[np.arange(n), t, path[:, t]]
            out[(starts[group][:, None] + np.arange(width)[None, :])[inside]] = path[inside]
        return out


def train(
    rows: np.ndarray, labels: np.ndarray, lengths: np.ndarray, n_labels: int, weights: np.ndarray | None = None,
    steps: int = 150, rate: float = 0.1, penalty: float = 1e-3,
) -> Chain:
    """Fit a chain to labelled sequences that follow one another, by gradient steps on the penalised likelihood.

    ``weights``: weight of each sequence, else 1. The steps are fixed and start at 0, so the same table gives the same chain.
    """
    weights = np.ones(len(lengths)) if weights is None else weights
    chain = Chain(np.zeros((rows.shape[1] + 1, n_labels)), np.zeros((n_labels, n_labels)))
    starts = np.cumsum(lengths) - lengths
    row_weight = np.repeat(weights, lengths)
    truth = np.eye(n_labels)[labels]
    inner = np.ones(len(rows), dtype=bool)
    inner[starts[lengths > 0]] = False
    at = np.flatnonzero(inner)
    seen_moves = np.zeros((n_labels, n_labels))
    np.add.at(seen_moves, (labels[at - 1], labels[at]), row_weight[at])
    total = max(row_weight.sum(), 1e-9)
    groups = list(batches(lengths))
    means = [np.zeros_like(chain.weights), np.zeros_like(chain.moves)]
    squares = [np.zeros_like(chain.weights), np.zeros_like(chain.moves)]
    for step in range(1, steps + 1):
        scores, expected, moves = chain.scores(rows), np.zeros((len(rows), n_labels)), np.zeros((n_labels, n_labels))
        for group in groups:
            unary, inside = chain._padded(scores, starts[group], lengths[group])
            node, (forward, backward, sums) = chain._sums(unary, inside)
            expected[(starts[group][:, None] + np.arange(inside.shape[1])[None, :])[inside]] = node[inside]
            for t in range(1, inside.shape[1]):
                pair = forward[:, t - 1, :, None] + chain.moves[None] + (unary[:, t] + backward[:, t])[:, None, :] - sums[:, None, None]
                moves += (np.exp(pair) * (inside[:, t] * weights[group])[:, None, None]).sum(axis=0)
        error = (truth - expected) * row_weight[:, None]
        slopes = [np.vstack([rows.T @ error, error.sum(axis=0)]) / total, (seen_moves - moves) / total]
        slopes[0] -= penalty * chain.weights
        slopes[1] -= penalty * chain.moves
        for k, x in enumerate((chain.weights, chain.moves)):
            means[k] = 0.9 * means[k] + 0.1 * slopes[k]
            squares[k] = 0.99 * squares[k] + 0.01 * slopes[k] ** 2
            x += rate * (means[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.99**step)) + 1e-8)
    return chain
