"""A byte-level convolutional network in numpy: multi-width filters, max pooling, softmax.

A filter of width w over byte embeddings is a sum of w table rows, one per byte: the table of the
j-th place is the embedding matrix times the filter's j-th slice. Scoring therefore looks bytes up
instead of multiplying matrices, and training sends gradients only to the bytes that won the
pooling.
"""

import numpy as np

CHUNK_BYTES = 1 << 16


class ConvNet:
    """Windows of ``length`` bytes (0 pads them) to class probabilities."""

    def __init__(
        self,
        classes: int,
        length: int,
        widths: tuple[int, ...] = (2, 3, 4),
        filters: int = 16,
        dim: int = 8,
        seed: int = 7,
    ):
        rng = np.random.default_rng(seed)
        places = sum(widths)
        self.length, self.widths, self.filters = length, widths, filters
        self.params = {
            "embed": rng.normal(0, 0.5, (256, dim)).astype(np.float32),
            "conv": rng.normal(0, 0.3, (places, dim, filters)).astype(np.float32),
            "bias": np.zeros(len(widths) * filters, np.float32),
            "dense": rng.normal(0, 0.1, (len(widths) * filters, classes)).astype(np.float32),
            "out": np.zeros(classes, np.float32),
        }
        self._tables: np.ndarray | None = None

    def _lookup(self) -> np.ndarray:
        if self._tables is None:
            self._tables = np.matmul(self.params["embed"], self.params["conv"])
        return self._tables

    def _responses(self, windows: np.ndarray) -> list[np.ndarray]:
        """For every width the filters' responses at every place."""
        tables, place, found = self._lookup(), 0, []
        for width in self.widths:
            last = self.length - width + 1
            total = tables[place][windows[:, :last]]
            for j in range(1, width):
                total += tables[place + j][windows[:, j : last + j]]
            place += width
            found.append(total)
        return found

    def _pooled(self, windows: np.ndarray) -> np.ndarray:
        pooled = np.concatenate([r.max(axis=1) for r in self._responses(windows)], axis=1)
        return np.maximum(pooled + self.params["bias"], 0)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        step = max(1, CHUNK_BYTES // self.length)
        parts = [
            self._pooled(windows[i : i + step]) @ self.params["dense"] + self.params["out"]
            for i in range(0, len(windows), step)
        ]
        classes = len(self.params["out"])
        return np.concatenate(parts) if parts else np.zeros((0, classes), np.float32)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(self.logits(windows))

    def fit(
        self,
        windows: np.ndarray,
        labels: np.ndarray,
        epochs: int = 8,
        batch: int = 64,
        rate: float = 3e-3,
        seed: int = 11,
    ) -> "ConvNet":
        """Adam on cross-entropy; the same windows and seed give the same network."""
        rng = np.random.default_rng(seed)
        means = {k: np.zeros_like(v) for k, v in self.params.items()}
        squares = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for low in range(0, len(order), batch):
                rows = order[low : low + batch]
                step += 1
                for name, grad in self._gradients(windows[rows], labels[rows]).items():
                    means[name] += 0.1 * (grad - means[name])
                    squares[name] += 0.001 * (grad * grad - squares[name])
                    mean = means[name] / (1 - 0.9**step)
                    square = squares[name] / (1 - 0.999**step)
                    self.params[name] -= rate * mean / (np.sqrt(square) + 1e-8)
                self._tables = None
        return self

    def step(self, grads: dict[str, np.ndarray], state: dict, rate: float = 3e-3) -> None:
        """One Adam step on gradients summed elsewhere; ``state`` holds the moments between steps."""
        state["step"] = state.get("step", 0) + 1
        for name, grad in grads.items():
            mean = state.setdefault(("mean", name), np.zeros_like(self.params[name]))
            square = state.setdefault(("square", name), np.zeros_like(self.params[name]))
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            self.params[name] -= (
                rate * (mean / (1 - 0.9 ** state["step"])) / (np.sqrt(square / (1 - 0.999 ** state["step"])) + 1e-8)
            ).astype(np.float32)
        self._tables = None

    def _gradients(
        self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None
    ) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy, or with ``weights`` of their weighted sum."""
        p, count = self.params, len(labels)
        responses = self._responses(windows)
        best = [r.argmax(axis=1) for r in responses]
        tops = [np.take_along_axis(r, b[:, None], 1)[:, 0] for r, b in zip(responses, best)]
        raw = np.concatenate(tops, axis=1) + p["bias"]
        hidden = np.maximum(raw, 0)
        error = softmax(hidden @ p["dense"] + p["out"])
        error[np.arange(count), labels] -= 1
        if weights is None:
            error /= count
        else:
            error *= weights[:, None].astype(np.float32)
        back = (error @ p["dense"].T) * (raw > 0)
        tables = np.zeros((len(p["conv"]), 256, self.filters), np.float32)
        rows, column, place = np.arange(count)[:, None], np.arange(self.filters), 0
        for i, width in enumerate(self.widths):
            grad = back[:, i * self.filters : (i + 1) * self.filters]
            for j in range(width):
                won = windows[rows, best[i] + j]
                np.add.at(tables[place + j], (won, column[None, :]), grad)
            place += width
        return {
            "embed": np.einsum("jbf,jdf->bd", tables, p["conv"]),
            "conv": np.einsum("bd,jbf->jdf", p["embed"], tables),
            "bias": back.sum(axis=0),
            "dense": hidden.T @ error,
            "out": error.sum(axis=0),
        }


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Windows of ``length`` bytes from every start, zero from the end on."""
    at = starts[:, None] + np.arange(length)
    inside = at < ends[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0).astype(np.uint8)
