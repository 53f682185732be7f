"""Main-text extraction with a linear-chain conditional random field over leaf blocks.

``train`` fits the field on labelled pages (``TRAIN_PAGES`` pages, a documented
bound) by gradient steps on the exact likelihood; ``decode`` finds the best
labelling of a page's blocks with the Viterbi algorithm.  Pages are independent
rows, so extraction needs no shuffle, and the model is a small table of weights.

Defined cases: a null or empty page, and one without article blocks, has the
empty text; broken markup is read as far as it goes; nothing is cut to length;
repeated rows are extracted alike; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow
from .html_blocks import blocks
from .html_training import labelled_pages

TRAIN_PAGES = 1_000
STEPS = 150


class Model:
    """Weights of block features for "article", and of neighbouring labels."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.weights, self.moves, self.first, self.last = weights, moves.tolist(), first.tolist(), last.tolist()

    def decode(self, page: list) -> list[int]:
        """Best labels of the blocks (Viterbi)."""
        get, paths = self.weights.get, {}
        (m00, m01), (m10, m11) = self.moves
        back, a, b = [], 0.0, 0.0
        for k, (_, path, own) in enumerate(page):
            score = paths.get(path)
            if score is None:
                score = paths[path] = sum(get(f, 0.0) for f in path)
            score += sum(get(f, 0.0) for f in own)
            if k == 0:
                a, b = self.first[0], self.first[1] + score
                continue
            to0, to1 = (0, a + m00) if a + m00 >= b + m10 else (1, b + m10), (0, a + m01) if a + m01 > b + m11 else (1, b + m11)
            back.append((to0[0], to1[0]))
            a, b = to0[1], to1[1] + score
        if not page:
            return []
        label = int(b + self.last[1] > a + self.last[0])
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def train(pages: list, *, steps: int = STEPS, l2: float = 0.002, rate: float = 0.2) -> Model:
    """Fit on ``(blocks, labels)`` pages: Adam steps on the whole sample's likelihood."""
    names: dict[str, int] = {}
    rows, cols, n_of = [], [], [len(y) for _, y in pages]
    width, count = max(n_of), len(pages)
    gold = np.zeros((count, width), np.int64)
    for i, (page, labels) in enumerate(pages):
        gold[i, :len(labels)] = labels
        for k, (_, path, own) in enumerate(page):
            for f in path + own:
                rows.append(i * width + k)
                cols.append(names.setdefault(f, len(names)))
    rows, cols = np.array(rows), np.array(cols)
    there = np.arange(width)[None, :] < np.array(n_of)[:, None]
    last = np.array(n_of) - 1
    theta = np.zeros(len(names) + 8)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    n_blocks = there.sum()
    pick = np.arange(count)

    for step in range(1, steps + 1):
        w, moves, first, end = theta[:-8], theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:]
        emit = np.zeros((count, width, 2))
        emit[..., 1] = np.bincount(rows, w[cols], count * width).reshape(count, width)
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[:, 0] = first + emit[:, 0]
        for k in range(1, width):
            alpha[:, k] = np.logaddexp(alpha[:, k - 1, :1] + moves[0], alpha[:, k - 1, 1:] + moves[1]) + emit[:, k]
        beta[pick, last] = end
        for k in range(width - 2, -1, -1):
            nxt = beta[:, k + 1] + emit[:, k + 1]
            b = np.logaddexp(nxt[:, :1] + moves[:, 0], nxt[:, 1:] + moves[:, 1])
            beta[:, k] = np.where((k < last)[:, None], b, beta[:, k])
        z = np.logaddexp(*(alpha[pick, last] + end).T)
        p = np.exp(alpha + beta - z[:, None, None]) * there[..., None]
        g = np.zeros_like(theta)
        g[:-8] = np.bincount(cols, (p[..., 1] - gold * there).ravel()[rows], len(names))
        for x in range(2):
            for y in range(2):
                both = there[:, 1:]
                e = np.exp(alpha[:, :-1, x] + moves[x, y] + emit[:, 1:, y] + beta[:, 1:, y] - z[:, None]) * both
                seen = ((gold[:, :-1] == x) & (gold[:, 1:] == y) & both).sum()
                g[len(names) + 2 * x + y] = e.sum() - seen
            g[len(names) + 4 + x] = p[:, 0, x].sum() - (gold[:, 0] == x).sum()
            g[len(names) + 6 + x] = p[pick, last, x].sum() - (gold[pick, last] == x).sum()
        g = g / n_blocks * 100 + l2 * theta
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        theta = theta - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return Model({f: float(theta[k]) for f, k in names.items()}, theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:])


@lru_cache(maxsize=2)
def default_model(n_pages: int = TRAIN_PAGES) -> Model:
    return train(labelled_pages(n_pages))


def main_text(page: str | None, model: Model) -> str:
    found = blocks(page or "")
    return "\n".join(t for (t, _, _), y in zip(found, model.decode(found)) if y)


def extract(pages: DataFrame, *, model: Model | None = None, column: str = "html") -> DataFrame:
    """``pages`` with the main text of ``column`` in a new column ``main_text`` (an old one is replaced)."""
    model = model or default_model()
    pages = pages.drop("main_text")
    names = pages.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields)
    at = names.index(column)

    def run(batches):
        for batch in batches:
            # a few pages at a time bound the memory of their texts
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([main_text(x.as_py(), model) for x in part.column(at)], pa.string())],
                    [*names, "main_text"])

    return map_arrow(pages, run, f"{schema}, main_text string")
