"""A small feed-forward network in NumPy: what one task does with one batch."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def weight_count(layers: Sequence[int]) -> int:
    return sum((a + 1) * b for a, b in zip(layers, layers[1:]))


def initial_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """All weights in one flat array: uniform within the Glorot bound, biases zero."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(layers, layers[1:]):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
    return np.concatenate(parts).astype(np.float32)


def split_weights(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of the flat array as one (matrix, bias) pair per layer."""
    pairs, at = [], 0
    for a, b in zip(layers, layers[1:]):
        pairs.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + (a + 1) * b]))
        at += (a + 1) * b
    return pairs


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(flat: np.ndarray, layers: Sequence[int], x: np.ndarray) -> np.ndarray:
    """Class probabilities: ReLU hidden layers, softmax output."""
    pairs = split_weights(flat, layers)
    for w, b in pairs[:-1]:
        x = np.maximum(x @ w + b, 0)
    w, b = pairs[-1]
    return _softmax(x @ w + b)


def loss_and_gradient(
    flat: np.ndarray,
    layers: Sequence[int],
    x: np.ndarray,
    y: np.ndarray,
    dropout: float,
    rng: np.random.Generator,
) -> tuple[float, np.ndarray]:
    """Mean cross-entropy of one batch and its gradient, dropping hidden units at rate `dropout`."""
    pairs = split_weights(flat, layers)
    inputs, masks = [x], []
    for w, b in pairs[:-1]:
        h = np.maximum(inputs[-1] @ w + b, 0)
        mask = (h > 0).astype(h.dtype)
        if dropout > 0:
            kept = (rng.random(h.shape, dtype=np.float32) >= dropout).astype(h.dtype) / (1 - dropout)
            h, mask = h * kept, mask * kept
        inputs.append(h)
        masks.append(mask)
    w, b = pairs[-1]
    p = _softmax(inputs[-1] @ w + b)
    rows = np.arange(len(y))
    loss = float(-np.log(np.maximum(p[rows, y], 1e-12)).mean())

    delta = p
    delta[rows, y] -= 1
    delta /= len(y)
    grads: list[np.ndarray] = []
    for i in reversed(range(len(pairs))):
        grads = [(inputs[i].T @ delta).ravel(), delta.sum(axis=0)] + grads
        if i > 0:
            delta = (delta @ pairs[i][0].T) * masks[i - 1]
    return loss, np.concatenate(grads)
