"""Update rules for flat weight arrays. Constants are the ones the papers propose."""

from __future__ import annotations

import math

import numpy as np


class Adam:
    """Kingma and Ba, "Adam: A Method for Stochastic Optimization", 2014."""

    def __init__(self, rate: float = 0.001, decay1: float = 0.9, decay2: float = 0.999, eps: float = 1e-8):
        self.rate, self.decay1, self.decay2, self.eps = rate, decay1, decay2, eps
        self.steps = 0

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        if self.steps == 0:
            self.mean, self.square = np.zeros_like(gradient), np.zeros_like(gradient)
        self.steps += 1
        self.mean += (1 - self.decay1) * (gradient - self.mean)
        self.square += (1 - self.decay2) * (gradient * gradient - self.square)
        # The paper's faster order: both bias corrections as one factor per step.
        root = math.sqrt(1 - self.decay2**self.steps)
        rate = self.rate * root / (1 - self.decay1**self.steps)
        scale = np.sqrt(self.square)
        scale += self.eps * root
        return (weights - rate * (self.mean / scale)).astype(weights.dtype, copy=False)


class Adadelta:
    """Zeiler, "ADADELTA: An Adaptive Learning Rate Method", 2012."""

    def __init__(self, decay: float = 0.95, eps: float = 1e-6):
        self.decay, self.eps = decay, eps
        self.square, self.square_step = 0.0, 0.0

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.square = self.decay * self.square + (1 - self.decay) * gradient**2
        change = -np.sqrt(self.square_step + self.eps) / np.sqrt(self.square + self.eps) * gradient
        self.square_step = self.decay * self.square_step + (1 - self.decay) * change**2
        return (weights + change).astype(weights.dtype)


class Plain:
    """Subtract the gradient, scaled."""

    def __init__(self, rate: float = 1.0):
        self.rate = rate

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        return (weights - self.rate * gradient).astype(weights.dtype)


OPTIMIZERS = {"adam": Adam, "adadelta": Adadelta, "plain": Plain}


def state(rule) -> dict[str, np.ndarray]:
    """What a rule remembers from step to step, settings included, as flat arrays by name."""
    return {name: np.atleast_1d(np.asarray(value, np.float64)) for name, value in vars(rule).items()}


def restore(kind: type, settings: dict, known: dict[str, np.ndarray]):
    """A rule of `kind` that goes on from a `state`."""
    rule = kind.__new__(kind)
    vars(rule).update(settings)
    for name, values in known.items():
        vars(rule)[name] = values.copy() if len(values) > 1 else values[0]
    return rule
