"""A linear-chain conditional random field in numpy, over hashed token features."""

import numpy as np


class ChainField:
    """Scores label sequences by feature weights and label-to-label weights."""

    def __init__(self, labels: int, features: int):
        self.emit = np.zeros((features, labels))
        self.step = np.zeros((labels, labels))

    def scores(self, features: np.ndarray) -> np.ndarray:
        """(sequences, places, labels) from (sequences, places, features per token)."""
        return self.emit[features].sum(axis=2)

    def decode(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best labels of every sequence by Viterbi, all sequences at once.

        Places from a sequence's size on get label 0. Of equal scores the lower label wins.
        """
        scores = self.scores(features)
        count, places, labels = scores.shape
        best, back = scores[:, 0], np.zeros((count, places, labels), np.int16)
        for t in range(1, places):
            ways = best[:, :, None] + self.step
            back[:, t] = ways.argmax(axis=1)
            ahead = ways.max(axis=1) + scores[:, t]
            best = np.where((t < sizes)[:, None], ahead, best)
        path = np.zeros((count, places), np.int64)
        now = best.argmax(axis=1)
        for t in range(places - 1, -1, -1):
            here = t < sizes
            path[here, t] = now[here]
            if t:
                now = np.where(here, back[np.arange(count), t, now], now)
        return path

    def fit(
        self,
        features: np.ndarray,
        truth: np.ndarray,
        sizes: np.ndarray,
        epochs: int = 12,
        batch: int = 64,
        rate: float = 0.05,
        decay: float = 1e-4,
        seed: int = 3,
    ) -> "ChainField":
        """Adam on the conditional log-likelihood, by forward and backward sums."""
        rng = np.random.default_rng(seed)
        held = [self.emit, self.step]
        means, squares, at = [x * 0 for x in held], [x * 0 for x in held], 0
        for _ in range(epochs):
            order = rng.permutation(len(sizes))
            for low in range(0, len(order), batch):
                rows, at = order[low : low + batch], at + 1
                grads = self._gradients(features[rows], truth[rows], sizes[rows])
                for x, grad, mean, square in zip(held, grads, means, squares):
                    grad = grad + decay * x
                    mean += 0.1 * (grad - mean)
                    square += 0.001 * (grad * grad - square)
                    x -= rate * (mean / (1 - 0.9**at)) / (np.sqrt(square / (1 - 0.999**at)) + 1e-8)
        return self

    def _gradients(self, features, truth, sizes):
        scores = self.scores(features)
        count, places, labels = scores.shape
        ahead = np.zeros((places, count, labels))
        behind = np.zeros((places, count, labels))
        ahead[0] = scores[:, 0]
        for t in range(1, places):
            total = _log_sum(ahead[t - 1][:, :, None] + self.step, 1) + scores[:, t]
            ahead[t] = np.where((t < sizes)[:, None], total, ahead[t - 1])
        for t in range(places - 2, -1, -1):
            onward = self.step + (scores[:, t + 1] + behind[t + 1])[:, None, :]
            behind[t] = np.where((t + 1 < sizes)[:, None], _log_sum(onward, 2), 0.0)
        whole = _log_sum(ahead[-1], 1)
        emit, step = np.zeros_like(self.emit), np.zeros_like(self.step)
        rows = np.arange(count)
        for t in range(places):
            here = t < sizes
            expected = np.exp(ahead[t] + behind[t] - whole[:, None])
            expected[rows, truth[:, t]] -= 1
            expected[~here] = 0
            np.add.at(emit, features[:, t].ravel(), np.repeat(expected, features.shape[2], axis=0))
            if t:
                pair = ahead[t - 1][:, :, None] + self.step
                pair = pair + (scores[:, t] + behind[t])[:, None, :] - whole[:, None, None]
                pair = np.exp(pair)
                pair[rows, truth[:, t - 1], truth[:, t]] -= 1
                step += pair[here].sum(axis=0)
        return emit / count, step / count


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))
