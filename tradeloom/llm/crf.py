"""Linear-chain conditional random fields with hashed or binned features, in numpy.

A position's feature numbers select rows of `weights`; their sum is the position's score per label.
`transitions` scores neighbouring labels. Marginals come from the scaled forward-backward recursion, run
over many chains at once. Chains are cut after `STEPS` positions, which bounds memory for texts of any
length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEPS = 64


@dataclass
class Model:
    weights: np.ndarray  # (features + 1, labels); the last row is zero and stands for "no feature"
    transitions: np.ndarray  # (labels, labels)

    def scores(self, features: np.ndarray, chunk: int = 16384) -> np.ndarray:
        """Score per label of each row of feature numbers."""
        out = np.empty((len(features), self.weights.shape[1]), np.float32)
        for begin in range(0, len(features), chunk):
            out[begin : begin + chunk] = self.weights[features[begin : begin + chunk]].sum(1)
        return out


def chains(lengths: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Positions 0, 1, ... of sequences of the given lengths as rows of `steps`, -1 where a row ends."""
    pieces = -(-lengths // steps)
    sequence = np.repeat(np.arange(len(lengths)), pieces)
    piece = np.arange(pieces.sum()) - (np.cumsum(pieces) - pieces)[sequence]
    begin = (np.cumsum(lengths) - lengths)[sequence] + piece * steps
    end = np.minimum(begin + steps, np.cumsum(lengths)[sequence])
    places = begin[:, None] + np.arange(steps)[None, :]
    return np.where(places < end[:, None], places, -1)


def marginals(scores: np.ndarray, rows: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Marginal probabilities (positions, labels) by forward-backward over the chains in `rows`.

    With `pairs` also the expected number of each label pair and the log normaliser, for training.
    """
    labels = transitions.shape[0]
    places = rows.T
    mask = places >= 0
    padded = np.vstack([scores, np.zeros((1, labels), scores.dtype)])
    emitted = padded[places]  # (steps, chains, labels); -1 takes the zero row
    top = emitted.max(2, keepdims=True)
    emitted = np.exp(emitted - top)
    moves = np.exp(transitions).astype(scores.dtype)
    steps, count = places.shape
    forward = np.empty_like(emitted)
    scale = np.ones((steps, count, 1), scores.dtype)
    state = emitted[0]
    for t in range(steps):
        if t:
            state = (forward[t - 1] @ moves) * emitted[t]
        scale[t] = state.sum(1, keepdims=True)
        forward[t] = state / scale[t]
    expected = np.zeros((labels, labels))
    backward = np.ones((count, labels), scores.dtype)
    for t in range(steps - 1, -1, -1):
        if t < steps - 1:
            carried = emitted[t + 1] * backward / scale[t + 1]
            if pairs:
                both = mask[t + 1][:, None]
                expected += (forward[t] * both).T @ carried * moves
            backward = np.where(mask[t + 1][:, None], carried @ moves.T, 1).astype(scores.dtype)
        emitted_t = forward[t] * backward
        # The forward value is needed no more once its step is done.
        forward[t] = emitted_t / emitted_t.sum(1, keepdims=True)
    out = np.empty_like(scores)
    out[places[mask]] = forward[mask]
    if not pairs:
        return out
    return out, expected, float(((np.log(scale) + top)[..., 0] * mask).sum())


def fit(
    features: np.ndarray,
    kinds: np.ndarray,
    rows: np.ndarray,
    truth: np.ndarray,
    labels: int,
    size: int,
    rounds: int = 50,
    rate: float = 0.2,
    decay: float = 1e-5,
) -> Model:
    """Maximum likelihood by gradient steps with adaptive rates over all chains.

    `features` has a row of feature numbers (up to `size`, which stands for none) per kind of position,
    `kinds` the kind of each position, `truth` its label, `rows` the chains of positions.
    """
    weights = np.zeros((size + 1, labels), np.float32)
    moves = np.zeros((labels, labels), np.float32)
    flat, width, total = features.ravel(), features.shape[1], len(kinds)
    known = np.zeros((len(features), labels))
    np.add.at(known, (kinds, truth), 1)
    seen = np.zeros((labels, labels))
    both = (rows[:, 1:] >= 0).ravel()
    np.add.at(seen, (truth[rows[:, :-1].ravel()[both]], truth[rows[:, 1:].ravel()[both]]), 1)
    momentum = [np.zeros_like(weights), np.zeros_like(moves)]
    energy = [np.zeros_like(weights), np.zeros_like(moves)]
    for turn in range(1, rounds + 1):
        model = Model(weights, moves)
        found, expected, _ = marginals(model.scores(features)[kinds], rows, moves, pairs=True)
        surplus = np.stack([np.bincount(kinds, found[:, k], len(features)) for k in range(labels)], 1) - known
        slope = np.stack(
            [np.bincount(flat, np.repeat(surplus[:, k], width), size + 1) for k in range(labels)], 1
        )
        slope[size] = 0
        for k, (value, g) in enumerate(((weights, slope), (moves, expected - seen))):
            g = g / total + (decay if k == 0 else 100 * decay) * value
            momentum[k] = 0.9 * momentum[k] + 0.1 * g
            energy[k] = 0.99 * energy[k] + 0.01 * g * g
            step = momentum[k] / (1 - 0.9**turn) / (np.sqrt(energy[k] / (1 - 0.99**turn)) + 1e-8)
            value -= (rate * step).astype(np.float32)
    weights[size] = 0
    return Model(weights, moves)
