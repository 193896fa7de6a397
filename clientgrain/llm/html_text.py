"""The main text of web pages, by a linear-chain conditional random field.

A page is a chain of text blocks.  Each block has features of its ancestors and
of its text; neighbouring blocks mostly have the same label.  The field is
trained on ``TRAINING_PAGES`` labelled pages (the bound on the labelled rows)
and labels every page by Viterbi decoding.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .html_blocks import blocks
from .html_pages import labelled_page
from .texts import map_texts

TRAINING_PAGES = 500
EPOCHS = 8
RATE = 0.3
DECAY = 1e-4

TEXT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


class ChainField:
    """Two labels (0: rest, 1: article), binary features, label-to-label scores.

    Only score differences matter: ``weights[f]`` speaks for label 1, and
    ``moves[a][b]`` for going from a to b; the chain starts from label 0.
    """

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.moves = [[0.0, 0.0], [0.0, 0.0]]

    def scores(self, features: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in fs]) for fs in features]

    def marginals(self, scores: list[float]) -> tuple[list[float], list[list[float]]]:
        """P(label 1) of each block, and the expected number of each move (forward and backward sums)."""
        n = len(scores)
        move = [[math.exp(v) for v in row] for row in self.moves]
        ahead, before = [], (1.0, 0.0)
        for s in scores:
            one = (before[0] * move[0][1] + before[1] * move[1][1]) * math.exp(max(-30.0, min(30.0, s)))
            zero = before[0] * move[0][0] + before[1] * move[1][0]
            total = zero + one
            before = (zero / total, one / total)
            ahead.append(before)
        back = [(1.0, 1.0)] * n
        for t in range(n - 2, -1, -1):
            e = math.exp(max(-30.0, min(30.0, scores[t + 1])))
            b = back[t + 1]
            zero, one = move[0][0] * b[0] + move[0][1] * e * b[1], move[1][0] * b[0] + move[1][1] * e * b[1]
            total = zero + one
            back[t] = (zero / total, one / total)
        ones, moved = [], [[0.0, 0.0], [0.0, 0.0]]
        for t in range(n):
            z, o = ahead[t][0] * back[t][0], ahead[t][1] * back[t][1]
            ones.append(o / (z + o))
            e = math.exp(max(-30.0, min(30.0, scores[t])))
            start = ahead[t - 1] if t else (1.0, 0.0)
            joint = [[start[a] * move[a][b] * (e if b else 1.0) * back[t][b] for b in (0, 1)] for a in (0, 1)]
            total = sum(map(sum, joint))
            for a in (0, 1):
                for b in (0, 1):
                    moved[a][b] += joint[a][b] / total
        return ones, moved

    def train(self, pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = RATE) -> None:
        """Stochastic ascent of the likelihood with a step for each weight (AdaGrad)."""
        seen: dict[str, float] = {}
        seen_moves = [[1.0, 1.0], [1.0, 1.0]]
        for _ in range(epochs):
            for features, labels in pages:
                if not labels:
                    continue
                ones, moved = self.marginals(self.scores(features))
                slope: dict[str, float] = {}
                for fs, p, y in zip(features, ones, labels):
                    d = y - p
                    if abs(d) > 1e-4:
                        for f in fs:
                            slope[f] = slope.get(f, 0.0) + d
                for f, g in slope.items():
                    g -= DECAY * self.weights.get(f, 0.0)
                    seen[f] = seen.get(f, 1.0) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + rate * g / math.sqrt(seen[f])
                for a, b in zip([0, *labels[:-1]], labels):
                    moved[a][b] -= 1
                for a in (0, 1):
                    for b in (0, 1):
                        seen_moves[a][b] += moved[a][b] ** 2
                        self.moves[a][b] -= rate * moved[a][b] / math.sqrt(seen_moves[a][b])

    def labels(self, features: list[list[str]]) -> list[int]:
        """The most probable labels of all blocks together."""
        best, came = (0.0, -math.inf), []
        for s in self.scores(features):
            zero = [best[a] + self.moves[a][0] for a in (0, 1)]
            one = [best[a] + self.moves[a][1] + s for a in (0, 1)]
            came.append((int(zero[1] > zero[0]), int(one[1] > one[0])))
            best = (max(zero), max(one))
        label, out = int(best[1] > best[0]), []
        for step in reversed(came):
            out.append(label)
            label = step[label]
        return out[::-1]


def labelled(seed: int) -> tuple[list[list[str]], list[int]]:
    page, truth = labelled_page(seed)
    found = blocks(page)
    if [t for t, _ in found] != [t for t, _ in truth]:
        raise ValueError(f"the blocks of labelled page {seed} differ from its labels")
    return [fs for _, fs in found], [label for _, label in truth]


@functools.cache
def trained(pages: int = TRAINING_PAGES) -> ChainField:
    field = ChainField()
    field.train([labelled(seed) for seed in range(pages)])
    return field


def main_text(field: ChainField, page: str | None) -> str:
    found = blocks(page)
    return "\n".join(text for (text, _), label in zip(found, field.labels([fs for _, fs in found])) if label)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html", field: ChainField | None = None) -> DataFrame:
    """One row for each page: page_id, url, text, n_chars.

    The text is empty for a null or empty page and for one without an article.
    Pages of any length are read whole; repeated rows give equal rows; null ids
    and urls are kept; an empty table gives an empty result; what unclosed
    elements give is said in ``blocks``.  Other columns are ignored.
    """
    field = field or trained()

    def make():
        return lambda columns: ((t, len(t)) for t in (main_text(field, p) for p in columns[0]))

    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    return map_texts(slim, ["page_id", "url"], ["html"], TEXT, make)
