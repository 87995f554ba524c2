"""A gated recurrent language model in numpy, with a class-factored output layer.

Symbols are numbered by falling frequency and cut into classes of CLASS symbols. A symbol's
probability is that of its class times that of the symbol within the class. With all weights of
the output layers at zero the biases make the model the unigram model it starts from.
"""

from __future__ import annotations

import heapq

import numpy as np

SYMBOLS, CLASS = 2048, 64
CLASSES = SYMBOLS // CLASS
#: Symbol 0 stands for every word without a symbol of its own, symbol 1 for the end of a text.
OTHER, END = 0, 1
#: Words without a symbol are still told apart on input, by a hash of their last letters.
SUFFIXES = 256
INPUTS = SYMBOLS + SUFFIXES
HIDDEN, WINDOW, LANES = 16, 32, 192
RATE, CLIP = 6e-3, 1.0
#: Lanes of texts that are scored side by side, and rows whose outputs are worked out together: few
#: enough for the processor's cache.
SCORED, ROWS = 1024, 16384

Weights = dict[str, np.ndarray]


def initial(share: np.ndarray) -> Weights:
    """Weights that give each symbol its share; shares of symbols that are not used are 0."""
    random = np.random.default_rng(3)
    share = np.maximum(share, 1e-30)
    by_class = share.reshape(CLASSES, CLASS)
    mass = by_class.sum(axis=1)
    return {
        "inputs": random.normal(0, 0.3, (INPUTS, 3 * HIDDEN)).astype(np.float32),
        "gates": random.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)).astype(np.float32),
        "class_out": np.zeros((CLASSES, HIDDEN), dtype=np.float32),
        "class_bias": np.log(mass).astype(np.float32),
        "word_out": np.zeros((CLASSES, CLASS, HIDDEN), dtype=np.float32),
        "word_bias": np.log(by_class / mass[:, None]).astype(np.float32),
    }


def _gates(x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Both gates, in an array of their own: steps through parts of wider rows are slower."""
    gates = x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    return np.reciprocal(gates, out=gates)


def _step(weights: Weights, tokens: np.ndarray, state: np.ndarray):
    """The state after one symbol in each lane, and what the way back needs."""
    return _moved(weights, weights["inputs"][tokens], state)


def _moved(weights: Weights, x: np.ndarray, state: np.ndarray):
    """The same, given the symbols' rows of the input layer."""
    u = state @ weights["gates"]
    gates = _gates(x, u)
    reset, keep = gates[:, :HIDDEN], gates[:, HIDDEN:]
    new = reset * u[:, 2 * HIDDEN :]
    new += x[:, 2 * HIDDEN :]
    np.tanh(new, out=new)
    after = state - new
    after *= keep
    after += new
    return after, (reset, keep, new, u[:, 2 * HIDDEN :])


def _softmax(x: np.ndarray) -> np.ndarray:
    """Probabilities of each row. The largest entry is taken off only where needed."""
    with np.errstate(over="ignore"):
        made = np.exp(x)
        total = made @ np.ones(x.shape[1], dtype=x.dtype)
    if not (np.isfinite(total).all() and total.min() > 1e-30):
        made = np.exp(x - x.max(axis=1, keepdims=True))
        total = made.sum(axis=1)
    made *= (1.0 / total)[:, None]
    return made


def log_probabilities(weights: Weights, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithm of each target's probability given the state before it."""
    runs = range(0, len(targets), ROWS)
    return np.concatenate([_log_probabilities(weights, states[i : i + ROWS], targets[i : i + ROWS]) for i in runs])


def _log_chosen(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-softmax of one entry of each row. The largest entry is taken off only where needed."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        total = np.exp(logits) @ np.ones(logits.shape[1], dtype=logits.dtype)
    if not (np.isfinite(total).all() and total.min() > 1e-30):
        logits = logits - logits.max(axis=1, keepdims=True)
        total = np.exp(logits).sum(axis=1)
    return logits[np.arange(len(chosen)), chosen] - np.log(total)


def _log_probabilities(weights: Weights, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    kind, inner = np.divmod(targets.astype(np.int16), CLASS)
    out = _log_chosen(states @ weights["class_out"].T + weights["class_bias"], kind)
    order = np.argsort(kind, kind="stable")
    borders = np.searchsorted(kind[order], np.arange(CLASSES + 1))
    states, inner = states[order], inner[order]
    words = np.empty(len(targets), dtype=out.dtype)
    for c in np.flatnonzero(np.diff(borders)):
        own = slice(borders[c], borders[c + 1])
        words[own] = _log_chosen(states[own] @ weights["word_out"][c].T + weights["word_bias"][c], inner[own])
    out[order] += words
    return out


def document_scores(weights: Weights, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log-likelihood of whole texts, each given as its input and target symbols.

    Texts are laid end to end in lanes, the longest first into the shortest lane; a window's states
    are scored together and the state goes on into the next window, to the end of every text.
    """
    if not texts:
        return np.zeros(0)
    lanes: list[list[int]] = [[] for _ in range(min(SCORED, len(texts)))]
    waiting = [(0, i) for i in range(len(lanes))]
    for n in sorted(range(len(texts)), key=lambda n: -len(texts[n][1])):
        length, i = waiting[0]
        lanes[i].append(n)
        heapq.heapreplace(waiting, (length + len(texts[n][1]), i))
    lanes.sort(key=lambda lane: -sum(len(texts[n][1]) for n in lane))
    order = [n for lane in lanes for n in lane]
    lengths = np.array([len(texts[n][1]) for n in order])
    flat_in, flat_out = (np.concatenate([texts[n][k][: len(texts[n][1])] for n in order]) for k in (0, 1))
    owner = np.repeat(np.array(order), lengths)
    fresh = np.zeros(len(flat_out), dtype=bool)
    fresh[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    sizes = np.array([sum(len(texts[n][1]) for n in lane) for lane in lanes])
    starts = np.cumsum(sizes) - sizes
    total = np.zeros(len(texts))
    state = np.zeros((len(lanes), HIDDEN), dtype=np.float32)
    for begin in range(0, int(sizes[0]), WINDOW):
        states, places = [], []
        for t in range(begin, min(begin + WINDOW, int(sizes[0]))):
            live = int(np.searchsorted(-sizes, -t, "left"))
            at = starts[:live] + t
            state[:live][fresh[at]] = 0
            states.append(_advance(weights, flat_in[at], state, live))
            places.append(at)
        where = np.concatenate(places)
        found = log_probabilities(weights, np.concatenate(states), flat_out[where])
        total += np.bincount(owner[where], found, len(texts))
    return total


def _advance(weights: Weights, tokens: np.ndarray, state: np.ndarray, live: int) -> np.ndarray:
    """Move the live lanes one symbol on, in place; gives a copy of their states. The same as `_step`
    without what the way back needs."""
    x, own = weights["inputs"][tokens], state[:live]
    u = own @ weights["gates"]
    gates, new = _gates(x, u), x[:, 2 * HIDDEN :]
    u = u[:, 2 * HIDDEN :]
    u *= gates[:, :HIDDEN]
    new += u
    np.tanh(new, out=new)
    own -= new
    own *= gates[:, HIDDEN:]
    own += new
    return own.copy()


class Lane:
    """Texts laid end to end, waiting to be trained on."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.length = 0

    def add(self, text: tuple[np.ndarray, np.ndarray]) -> None:
        inputs, targets = text
        fresh = np.zeros(len(targets), dtype=np.int16)
        fresh[:1] = 1
        self.parts.append(np.stack([inputs[: len(targets)].astype(np.int16), targets.astype(np.int16), fresh]))
        self.length += len(targets)

    def taken(self, length: int) -> np.ndarray:
        """The first symbols: inputs, targets, and where a text begins."""
        whole = np.concatenate(self.parts, axis=1)
        self.parts, self.length = [whole[:, length:]], whole.shape[1] - length
        return whole[:, :length]


class Trainer:
    """Truncated backpropagation through windows of symbols, with Adam.

    Texts are laid end to end in LANES lanes that move on together, so a window is full whatever
    the lengths of the texts are. The state is carried from window to window through a text and starts
    anew where the next one begins; the gradient stops at both.
    """

    def __init__(self, weights: Weights):
        self.weights = {k: v.copy() for k, v in weights.items()}
        self.first = {k: np.zeros_like(v) for k, v in weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in weights.items()}
        self.steps = 0
        self.lanes = [Lane() for _ in range(LANES)]
        self.state = np.zeros((LANES, HIDDEN), dtype=weights["gates"].dtype)

    def train(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Put texts into the lanes, the longest first into the shortest lane, and train on the
        windows that all lanes can fill."""
        waiting = [(lane.length, i) for i, lane in enumerate(self.lanes)]
        heapq.heapify(waiting)
        for text in sorted((t for t in texts if len(t[1])), key=lambda t: -len(t[1])):
            i = waiting[0][1]
            self.lanes[i].add(text)
            heapq.heapreplace(waiting, (self.lanes[i].length, i))
        full = waiting[0][0] // WINDOW * WINDOW
        if full:
            self._windows(np.arange(LANES), full)

    def finish(self) -> None:
        """Train on what is left in the lanes. It is cut into equal parts, so that the last windows are
        full as well; a text that is cut there goes on from a fresh state."""
        left = np.concatenate([lane.taken(lane.length) for lane in self.lanes if lane.length] or [np.zeros((3, 0), np.int16)], axis=1)
        size = max(WINDOW, -(-left.shape[1] // LANES))
        self.state[:] = 0
        for i in range(0, left.shape[1], size):
            part = left[:, i : i + size]
            part[2, 0] = 1
            self.lanes[i // size].parts, self.lanes[i // size].length = [part], part.shape[1]
        while live := [i for i, lane in enumerate(self.lanes) if lane.length]:  # the last part may be shorter
            self._windows(np.array(live), min(self.lanes[i].length for i in live))

    def _windows(self, live: np.ndarray, length: int) -> None:
        stacked = np.stack([self.lanes[i].taken(length) for i in live], axis=2)
        inputs, targets, fresh = stacked.astype(np.int64)
        state = self.state[live]
        for begin in range(0, length, WINDOW):
            window = slice(begin, begin + WINDOW)
            state = self._window(inputs[window], targets[window], fresh[window] == 0, state)
        self.state[live] = state

    def _window(self, inputs: np.ndarray, targets: np.ndarray, goes_on: np.ndarray, state: np.ndarray) -> np.ndarray:
        w = self.weights
        going = goes_on[:, :, None].astype(state.dtype)
        broken = ~goes_on.all(axis=1)
        kept, before, after = [], [], []
        for t, x in enumerate(w["inputs"][inputs]):
            if broken[t]:
                state = state * going[t]
            before.append(state)
            state, more = _moved(w, x, state)
            kept.append(more)
            after.append(state)
        slopes = {k: np.zeros_like(v) for k, v in w.items()}
        back = self._output(np.concatenate(after), targets.reshape(-1), slopes).reshape(*inputs.shape, HIDDEN)
        carried = np.zeros_like(state)
        scale = 1.0 / targets.size
        inner = np.empty((*inputs.shape, 3 * HIDDEN), dtype=state.dtype)
        d_gates = np.empty_like(inner)
        # what does not depend on the step behind is worked out for the whole window at once
        resets, keeps, news, us = (np.stack(parts) for parts in zip(*kept, strict=True))
        from_new = 1 - news * news
        moved = np.stack(before) - news
        not_reset, not_kept = 1 - resets, 1 - keeps
        for t in range(len(inputs) - 1, -1, -1):
            total = back[t] + carried
            keep, reset = keeps[t], resets[t]
            d_new = total * not_kept[t]
            d_new *= from_new[t]
            d_keep = total * moved[t]
            d_keep *= keep
            d_keep *= not_kept[t]
            d_reset = d_new * us[t]
            d_reset *= reset
            d_reset *= not_reset[t]
            inner[t, :, :HIDDEN] = d_reset
            inner[t, :, HIDDEN : 2 * HIDDEN] = d_keep
            inner[t, :, 2 * HIDDEN :] = d_new
            d_gates[t, :, : 2 * HIDDEN] = inner[t, :, : 2 * HIDDEN]
            d_gates[t, :, 2 * HIDDEN :] = d_new * reset
            carried = total * keep + d_gates[t] @ w["gates"].T
            if broken[t]:
                carried *= going[t]
        slopes["gates"] += np.concatenate(before).T @ d_gates.reshape(-1, 3 * HIDDEN)
        flat, rows = inner.reshape(-1, 3 * HIDDEN), inputs.reshape(-1)
        order = np.argsort(rows.astype(np.int16), kind="stable")
        borders = np.flatnonzero(np.append(True, np.diff(rows[order]) > 0))
        touched = rows[order][borders]
        slopes["inputs"][touched] = np.add.reduceat(flat[order], borders)
        self._update(slopes, scale, touched)
        return state

    def _output(self, states: np.ndarray, targets: np.ndarray, slopes: Weights) -> np.ndarray:
        """Gradient of the output layers; gives the gradient of the states."""
        w = self.weights
        order = np.argsort(targets.astype(np.int16), kind="stable")
        states, targets = states[order], targets[order]
        kind, inner = np.divmod(targets, CLASS)
        error = _softmax(states @ w["class_out"].T + w["class_bias"])
        error[np.arange(len(targets)), kind] -= 1
        slopes["class_out"] += error.T @ states
        slopes["class_bias"] += error.sum(axis=0)
        back = error @ w["class_out"]
        borders = np.searchsorted(kind, np.arange(CLASSES + 1))
        for c in np.flatnonzero(np.diff(borders)):
            own = slice(borders[c], borders[c + 1])
            error = _softmax(states[own] @ w["word_out"][c].T + w["word_bias"][c])
            error[np.arange(len(error)), inner[own]] -= 1
            slopes["word_out"][c] += error.T @ states[own]
            slopes["word_bias"][c] += error.sum(axis=0)
            back[own] += error @ w["word_out"][c]
        out = np.empty_like(back)
        out[order] = back
        return out

    def _update(self, slopes: Weights, scale: float, touched: np.ndarray) -> None:
        """One step of Adam; of the input rows only those that occurred are moved."""
        self.steps += 1
        slopes = slopes | {"inputs": slopes["inputs"][touched]}
        norm = np.sqrt(sum(float((g * g).sum()) for g in slopes.values())) * scale
        scale *= min(1.0, CLIP / max(norm, 1e-9))
        rate = RATE * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for k, g in slopes.items():
            g *= scale
            m, v = self.first[k], self.second[k]
            if k == "inputs":
                own_m, own_v = m[touched], v[touched]
            else:
                own_m, own_v = m, v
            own_m += 0.1 * (g - own_m)
            own_v += 0.01 * (g * g - own_v)
            step = rate * own_m / (np.sqrt(own_v) + 1e-6)
            if k == "inputs":
                m[touched], v[touched] = own_m, own_v
                self.weights[k][touched] -= step
            else:
                self.weights[k] -= step


def packed(weights: Weights) -> np.ndarray:
    """All weights in one array."""
    return np.concatenate([v.reshape(-1) for v in weights.values()]).astype(np.float32)


def unpacked(values: np.ndarray, like: Weights) -> Weights:
    out, at = {}, 0
    for k, v in like.items():
        out[k] = values[at : at + v.size].reshape(v.shape).astype(np.float32)
        at += v.size
    return out
