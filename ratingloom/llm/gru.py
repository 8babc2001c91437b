"""A small gated recurrent language model in numpy, with a class-factored output.

A word's probability is that of its class, given the state, times that of the word within its class. Frequent words
share classes in which a second softmax, also given the state, picks the word. All other words fall into classes by
their endings, in which they follow their counts; that factor is left to the caller, who knows the counts.

Documents are laid end to end in parallel lanes. The state is carried from window to window through a whole
document and set to zero at its start; gradients go back through one window.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

STATE = 16
FREQUENT_CLASSES, PER_CLASS = 16, 32
RARE_CLASSES = 48
FREQUENT = FREQUENT_CLASSES * PER_CLASS  # words, the end of a document among them
CLASSES = FREQUENT_CLASSES + RARE_CLASSES
SYMBOLS = FREQUENT + RARE_CLASSES  # what the model reads: a frequent word, or the class of another
LANES, WINDOW = 256, 16
STEP_SYMBOLS = 2048  # read before a step, at least
RATE, KEEP_1, KEEP_2 = 0.02, 0.9, 0.99
SETTLED = 100  # steps after which the rate begins to fall

#: Parameters in the order in which they are laid out as one vector.
SHAPES = {
    "input": (SYMBOLS, 3 * STATE),
    "gates": (STATE, 2 * STATE),
    "candidate": (STATE, STATE),
    "class_weight": (STATE, CLASSES),
    "class_bias": (CLASSES,),
    "word_weight": (FREQUENT_CLASSES, STATE, PER_CLASS),
    "word_bias": (FREQUENT_CLASSES, PER_CLASS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def views(vector: np.ndarray) -> dict[str, np.ndarray]:
    parts, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        parts[name] = vector[at : at + size].reshape(shape)
        at += size
    return parts


def initial(symbol_counts: np.ndarray, seed: int = 5) -> np.ndarray:
    """Small random weights; the biases give every symbol its share of the counts whatever the state."""
    rng = np.random.default_rng(seed)
    vector = np.zeros(SIZE, np.float32)
    p = views(vector)
    p["input"][:] = rng.normal(0, 0.3, p["input"].shape)
    p["gates"][:] = rng.normal(0, 0.2, p["gates"].shape)
    p["candidate"][:] = rng.normal(0, 0.3, p["candidate"].shape)
    p["class_weight"][:] = rng.normal(0, 0.05, p["class_weight"].shape)
    p["word_weight"][:] = rng.normal(0, 0.05, p["word_weight"].shape)
    counts = symbol_counts + 0.5
    words = counts[:FREQUENT].reshape(FREQUENT_CLASSES, PER_CLASS)
    p["class_bias"][:] = np.log(np.concatenate([words.sum(axis=1), counts[FREQUENT:]]) / counts.sum())
    p["word_bias"][:] = np.log(words / words.sum(axis=1, keepdims=True))
    return vector


@dataclass
class Lanes:
    """Documents in lanes: `symbols`, `fresh` (first of its document) and `places` (in the input) by step and lane;
    places are -1 where a lane has ended. Longer lanes come first."""

    symbols: np.ndarray
    fresh: np.ndarray
    places: np.ndarray

    def windows(self, end: int):
        """(read, wanted, fresh, places) of one window after another, without the lanes that have ended."""
        read = np.vstack([np.full((1, self.symbols.shape[1]), end, np.int32), self.symbols[:-1]])
        read = np.where(self.fresh, end, read)
        for at in range(0, len(self.symbols), WINDOW):
            part = (slice(at, at + WINDOW), slice(0, int((self.places[at] >= 0).sum())))
            yield read[part], self.symbols[part], self.fresh[part], self.places[part]


def lay(symbols: np.ndarray, bounds: np.ndarray, lanes: int = LANES) -> Lanes:
    """Longest documents first, each to the lane that is free first."""
    sizes = np.diff(bounds)
    lanes = int(max(1, min(lanes, len(symbols) // 64, np.count_nonzero(sizes))))
    heap = [(0, lane) for lane in range(lanes)]
    lane_of, step_of = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for doc in np.argsort(-sizes, kind="stable").tolist():
        used, lane = heapq.heappop(heap)
        lane_of[doc], step_of[doc] = lane, used
        heapq.heappush(heap, (used + int(sizes[doc]), lane))
    heap.sort(key=lambda item: -item[0])
    steps = heap[0][0]
    rank = np.zeros(lanes, np.int64)
    rank[[lane for _, lane in heap]] = np.arange(lanes)
    lane_of = rank[lane_of]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(symbols))
    step, lane = step_of[doc] + place - bounds[:-1][doc], lane_of[doc]
    laid = Lanes(np.zeros((steps, lanes), np.int32), np.ones((steps, lanes), bool), np.full((steps, lanes), -1, np.int64))
    laid.symbols[step, lane] = symbols
    laid.fresh[step, lane] = place == bounds[:-1][doc]
    laid.places[step, lane] = place
    return laid


def _log_softmax(weight, bias, states, picked, with_slope: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of the picked outcome of each row, and the slope of its negative by outcome and row.

    Outcomes run along the first axis, which keeps sums over them fast. The logits stay small, since states lie
    within -1 and 1, so they are not shifted.
    """
    logits = weight.T @ states.T
    logits += bias[:, None]
    rows = np.arange(len(states))
    result = logits[picked, rows]
    np.exp(logits, out=logits)
    total = np.ones(len(logits), np.float32) @ logits
    result -= np.log(total)
    if not with_slope:
        return result, None
    logits *= 1 / total
    logits[picked, rows] -= 1
    return result, logits


@dataclass
class Model:
    vector: np.ndarray
    p: dict[str, np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        self.p = views(self.vector)

    def states(self, read: np.ndarray, fresh: np.ndarray, state: np.ndarray) -> tuple:
        """States that predict the symbols of a window; what the way back needs comes along."""
        steps, lanes = read.shape
        given = self.p["input"][read]
        before = np.empty((steps, lanes, STATE), np.float32)
        gates = np.empty((steps, lanes, 2 * STATE), np.float32)
        offers = np.empty((steps, lanes, STATE), np.float32)
        after = np.empty((steps, lanes, STATE), np.float32)
        for t in range(steps):
            old = before[t]
            np.multiply(state, ~fresh[t][:, None], out=old)
            gate = gates[t]
            np.matmul(old, self.p["gates"], out=gate)
            gate += given[t, :, : 2 * STATE]
            np.negative(gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            offer = offers[t]
            np.matmul(old * gate[:, STATE:], self.p["candidate"], out=offer)
            offer += given[t, :, 2 * STATE :]
            np.tanh(offer, out=offer)
            state = after[t]
            np.subtract(old, offer, out=state)
            state *= gate[:, :STATE]
            state += offer
        return after, before, gates, offers

    def outputs(self, states: np.ndarray, wanted: np.ndarray, slope: np.ndarray | None = None, grad: dict | None = None) -> np.ndarray:
        """Log probabilities of the wanted symbols. With `slope` and `grad`, also the slopes of their negative sum."""
        p = self.p
        kind = np.where(wanted < FREQUENT, wanted // PER_CLASS, wanted - (FREQUENT - FREQUENT_CLASSES))
        result, left = _log_softmax(p["class_weight"], p["class_bias"], states, kind, grad is not None)
        if grad is not None:
            grad["class_weight"] += states.T @ left.T
            grad["class_bias"] += left.sum(axis=1)
            slope += (p["class_weight"] @ left).T
        frequent = np.flatnonzero(wanted < FREQUENT)
        order = frequent[np.argsort(kind[frequent].astype(np.int8), kind="stable")]
        edges = np.searchsorted(kind[order], np.arange(FREQUENT_CLASSES + 1)).tolist()
        own, word = states[order], wanted[order] % PER_CLASS
        inner = np.empty(len(order), np.float32)
        back = np.empty_like(own) if grad is not None else None
        for c in range(FREQUENT_CLASSES):
            part = slice(edges[c], edges[c + 1])
            if part.start == part.stop:
                continue
            weight = p["word_weight"][c]
            inner[part], left = _log_softmax(weight, p["word_bias"][c], own[part], word[part], grad is not None)
            if grad is not None:
                grad["word_weight"][c] += own[part].T @ left.T
                grad["word_bias"][c] += left.sum(axis=1)
                back[part] = (weight @ left).T
        result[order] += inner
        if grad is not None:
            slope[order] += back
        return result

    def score(self, laid: Lanes, end: int, size: int) -> np.ndarray:
        """Log probability of each of the `size` symbols given all of its document before it."""
        result = np.zeros(size)
        state = np.zeros((laid.symbols.shape[1], STATE), np.float32)
        for read, wanted, fresh, places in laid.windows(end):
            after, *_ = self.states(read, fresh, state[: read.shape[1]])
            state = after[-1]
            used = places >= 0
            result[places[used]] = self.outputs(after[used], wanted[used])
        return result


class Trainer:
    """Adam over windows; the first moments and the step count live as long as the trainer."""

    def __init__(self, vector: np.ndarray):
        self.model = Model(vector.astype(np.float32).copy())
        self.first, self.second = np.zeros(SIZE, np.float32), np.zeros(SIZE, np.float32)
        self.slope, self.seen = np.zeros(SIZE, np.float32), 0  # gathered since the last step
        self.steps = 0

    def train(self, laid: Lanes, end: int) -> None:
        state = np.zeros((laid.symbols.shape[1], STATE), np.float32)
        for read, wanted, fresh, places in laid.windows(end):
            state = self.window(read, wanted, fresh, places >= 0, state[: read.shape[1]])
            if self.seen >= STEP_SYMBOLS:
                self.step()

    def window(self, read, wanted, fresh, used, state) -> np.ndarray:
        p = self.model.p
        after, before, gates, offers = self.model.states(read, fresh, state)
        grad = views(self.slope)
        slopes = np.zeros_like(after)
        if used.all():
            flat = slopes.reshape(-1, STATE)
            self.model.outputs(after.reshape(-1, STATE), wanted.ravel(), flat, grad)
        else:
            flat = np.zeros((int(used.sum()), STATE), np.float32)
            self.model.outputs(after[used], wanted[used], flat, grad)
            slopes[used] = flat
        given = np.empty((*read.shape, 3 * STATE), np.float32)
        keep, take = gates[:, :, :STATE], gates[:, :, STATE:]
        gate_slope = gates * (1 - gates)
        gate_slope[:, :, :STATE] *= before - offers
        gate_slope[:, :, STATE:] *= before
        offer_slope = (1 - offers * offers) * (1 - keep)
        carried = np.zeros(state.shape, np.float32)
        back_gates, back_offer = p["gates"].T.copy(), p["candidate"].T.copy()
        for t in range(len(read) - 1, -1, -1):
            carried += slopes[t]
            out = given[t]
            np.multiply(carried, offer_slope[t], out=out[:, 2 * STATE :])
            through = out[:, 2 * STATE :] @ back_offer
            np.multiply(carried, gate_slope[t, :, :STATE], out=out[:, :STATE])
            np.multiply(through, gate_slope[t, :, STATE:], out=out[:, STATE : 2 * STATE])
            carried *= keep[t]
            through *= take[t]
            carried += through
            carried += out[:, : 2 * STATE] @ back_gates
            carried *= ~fresh[t][:, None]
        flat_given, flat_before = given.reshape(-1, 3 * STATE), before.reshape(-1, STATE)
        grad["gates"] += flat_before.T @ flat_given[:, : 2 * STATE]
        grad["candidate"] += (before * take).reshape(-1, STATE).T @ flat_given[:, 2 * STATE :]
        ids = read.ravel()
        order = np.argsort(ids, kind="stable")
        at = np.flatnonzero(np.diff(ids[order], prepend=-1))
        grad["input"][ids[order][at]] += np.add.reduceat(flat_given[order], at, axis=0)
        self.seen += int(used.sum())
        return after[-1]

    def step(self) -> None:
        """One step along the mean slope of what was gathered."""
        grad = self.slope / self.seen
        self.slope[:] = 0
        self.seen = 0
        self.steps += 1
        norm = float(np.sqrt(grad @ grad))
        if norm > 1:
            grad /= norm
        self.first += (1 - KEEP_1) * (grad - self.first)
        self.second += (1 - KEEP_2) * (grad * grad - self.second)
        rate = RATE * min(1.0, np.sqrt(SETTLED / self.steps))
        rate *= np.sqrt(1 - KEEP_2**self.steps) / (1 - KEEP_1**self.steps)
        self.model.vector -= rate * self.first / (np.sqrt(self.second) + 1e-8)
