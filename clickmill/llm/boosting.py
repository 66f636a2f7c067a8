"""Gradient-boosted regression trees of depth two for two classes, small enough to send to every task."""

from __future__ import annotations

import numpy as np

ROUNDS = 60
RATE = 0.3
CUTS = 16
LEAST_LEAF = 8

Tree = tuple[int, float, tuple[int, float, float, float], tuple[int, float, float, float]]


def _best_split(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[int, float, float]:
    """feature, cut, gain of the best split ``x <= cut``; gain 0 if none helps."""
    best = (0, np.inf, 0.0)
    total_g, total_h = gradient.sum(), hessian.sum()
    for feature in range(x.shape[1]):
        column = x[:, feature]
        for cut in np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 1)[:-1], method="lower")):
            left = column <= cut
            if not LEAST_LEAF <= left.sum() <= len(column) - LEAST_LEAF:
                continue
            g, h = gradient[left].sum(), hessian[left].sum()
            gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
            if gain > best[2] + 1e-12:
                best = (feature, float(cut), float(gain))
    return best


def _leaf(gradient: np.ndarray, hessian: np.ndarray) -> float:
    return float(gradient.sum() / (hessian.sum() + 1) * RATE)


def fitted(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> list[Tree]:
    """Trees for the log-odds, by Newton steps on the logistic loss."""
    trees: list[Tree] = []
    score = np.zeros(len(y))
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-score))
        gradient, hessian = y - chance, chance * (1 - chance)
        feature, cut, gain = _best_split(x, gradient, hessian)
        if gain <= 0:
            break
        sides = []
        for side in (x[:, feature] <= cut, x[:, feature] > cut):
            inner, inner_cut, _ = _best_split(x[side], gradient[side], hessian[side])
            low = x[side, inner] <= inner_cut
            sides.append((inner, inner_cut, _leaf(gradient[side][low], hessian[side][low]), _leaf(gradient[side][~low], hessian[side][~low])))
        trees.append((feature, cut, *sides))
        score += predicted(trees[-1:], x)
    return trees


def predicted(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    """Log-odds of the rows."""
    score = np.zeros(len(x))
    for feature, cut, low, high in trees:
        sides = [np.where(x[:, inner] <= inner_cut, a, b) for inner, inner_cut, a, b in (low, high)]
        score += np.where(x[:, feature] <= cut, *sides)
    return score


def calibrated_threshold(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest score at which the rows at or above it reach the precision on held-out rows."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    # A cut between equal scores is no cut.
    last = np.append(np.diff(score[order]) != 0, True)
    good = np.flatnonzero((right >= precision) & last)
    return float(score[order][good[-1]]) if len(good) else float("inf")
