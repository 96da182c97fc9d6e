"""A small gated recurrent language model in numpy: truncated backpropagation, class-factored softmax, carried state.

Slots (words) are numbered class * words + place; slot probabilities are P(class | state) * P(word | class, state).
Documents run side by side in lanes, one after another in each, without padding: memory follows the tokens. A document starts from a zero state and the end slot, and its state is carried across windows.
"""

import numpy as np

NAMES = ("E", "W", "U", "b", "Wc", "bc", "Wo", "bo")


def initial(frequency: np.ndarray, classes: int, hidden: int, inputs: int, seed: int = 3) -> dict[str, np.ndarray]:
    """Random weights, and output biases that give every slot its frequency (an array of classes * words counts)."""
    rng, words = np.random.default_rng(seed), len(frequency) // classes
    shape = {"E": (len(frequency), inputs), "W": (inputs, 3 * hidden), "U": (hidden, 3 * hidden), "Wc": (hidden, classes), "Wo": (classes, hidden, words)}
    out = {k: (rng.standard_normal(s) * (0.1 if k in ("E", "Wc", "Wo") else 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shape.items()}
    share = (frequency.reshape(classes, words) + 0.01) / (frequency.sum() + 0.01 * len(frequency))
    out["b"] = np.zeros(3 * hidden, np.float32)
    out["bc"] = np.log(share.sum(1)).astype(np.float32)
    out["bo"] = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    return out


class Lanes:
    """Documents dealt to lanes, one after another in each, without padding.

    Token arrays hold lane after lane; start and length tell where a lane lies, longest first. Lane i runs at step t
    while t < length[i], so the lanes running at a step are the first ones.
    """

    def __init__(self, docs: list[np.ndarray], most: int, first: np.ndarray):
        sizes = [len(d) for d in docs]
        held: list[list[int]] = [[] for _ in range(min(most, len(docs)))]
        filled = np.zeros(len(held), np.int64)
        for i in sorted(range(len(docs)), key=lambda i: -sizes[i]):
            lane = int(filled.argmin())
            held[lane].append(i)
            filled[lane] += sizes[i]
        rank = np.argsort(-filled, kind="stable")
        order = np.array([i for lane in rank for i in held[lane]])
        size = np.array(sizes)[order]
        self.length = filled[rank]
        self.start = np.cumsum(self.length) - self.length
        self.targets = np.concatenate([docs[i] for i in order])
        self.owner = np.repeat(order.astype(np.int32), size)
        begin = np.cumsum(size) - size
        self.inputs = np.roll(self.targets, 1)
        self.inputs[begin] = first[order]
        self.fresh = np.zeros(len(self.targets), bool)
        self.fresh[begin] = True
        self.steps = int(self.length[0])

    def rows(self, a: int, b: int) -> list[np.ndarray]:
        """Places of the tokens of steps a .. b - 1 in the token arrays, step by step."""
        running = np.searchsorted(-self.length, -np.arange(a, min(b, self.steps)), side="left")
        return [self.start[:n] + t for t, n in enumerate(running.tolist(), a)]


def by_gate(x: np.ndarray) -> np.ndarray:
    """Columns of the three gates (update, reset, new) as three contiguous arrays."""
    return np.ascontiguousarray(x.reshape(len(x), 3, -1).transpose(1, 0, 2))


def forward(p: dict, gates: np.ndarray, own: Lanes, rows: list[np.ndarray], state: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, tuple | None]:
    """States of a window (rows of all running lanes, step by step), the last state of each lane, and what backward needs.

    The gates lie apart, each contiguous: a step's arrays are small, and numpy is slow on rows of a few numbers.
    """
    at, h = np.concatenate(rows), len(p["U"])
    x, inner = np.take(by_gate(gates), own.inputs[at], axis=1), by_gate(p["U"])
    np.negative(x[:2], out=x[:2])  # logistic functions of y are 1 / (1 + exp(-y))
    np.negative(inner[:2], out=inner[:2])
    fresh, states = np.flatnonzero(own.fresh[at]), np.empty((len(at), h), state.dtype)
    befores, recurrent = (np.empty_like(states), np.empty_like(states)) if keep else (None, None)
    a, begun = 0, 0
    with np.errstate(over="ignore"):  # an overflow to infinity gives the right limit, 0
        for n in map(len, rows):
            b = a + n
            before, begins = state[:n], begun
            while begun < len(fresh) and fresh[begun] < b:
                begun += 1
            if begun > begins:
                before = before.copy()
                before[fresh[begins:begun] - a] = 0
            u = np.matmul(before, inner)
            zr, new, now = x[:2, a:b], x[2, a:b], states[a:b]
            zr += u[:2]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            if keep:
                befores[a:b] = before
                recurrent[a:b] = u[2]
            new += np.multiply(zr[1], u[2], out=u[2])
            np.tanh(new, out=new)
            np.subtract(before, new, out=now)
            now *= zr[0]
            now += new
            state = np.concatenate([now, state[n:]]) if n < len(state) else now
            a = b
    return states, state.copy(), (befores, *x, recurrent) if keep else None


def bounded(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Whether no state (of components between -1 and 1) gives a logit that exp or a sum of exps can't hold."""
    return np.abs(bias).max(-1) + np.abs(weights).sum(-2).max(-1) < 60


def softmax(logits: np.ndarray, target: np.ndarray, gradient: bool) -> np.ndarray:
    """Log probability of each row's target; with gradient, logits become the loss's gradients, else their exps."""
    flat, at = logits.reshape(-1), np.arange(0, logits.size, logits.shape[1]) + target
    own = flat[at]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    if gradient:
        logits *= (1 / total)[:, None]
        flat[at] -= 1
    return own - np.log(total)


def log_probabilities(p: dict, states: np.ndarray, slots: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each slot; with grads, adds the loss's gradients and returns that of the states.

    Rows lie by class, with a 1 beside the state, which the biases meet: one product a class, all else over all rows.
    """
    classes, words = p["bo"].shape
    n, h = states.shape
    group = slots // words
    order = np.argsort(group.astype(np.int16), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=classes)).tolist()
    held = [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]
    group, place = group[order], slots[order] % words
    own = np.ones((n, h + 1), states.dtype)
    own[:, :h] = states[order]

    logits = own @ np.concatenate([p["Wc"], p["bc"][None]])
    if not bounded(p["Wc"], p["bc"]):
        logits -= logits.max(1, keepdims=True)
    found = softmax(logits, group, grads is not None)
    d_own = None
    if grads is not None:
        both = own.T @ logits
        grads["Wc"] += both[:h]
        grads["bc"] += both[h]
        d_own = logits @ p["Wc"].T

    inner, small = np.concatenate([p["Wo"], p["bo"][:, None]], 1), bounded(p["Wo"], p["bo"])
    logits = np.empty((n, words), states.dtype)
    for c, a, b in held:
        np.matmul(own[a:b], inner[c], out=logits[a:b])
        if not small[c]:
            logits[a:b] -= logits[a:b].max(1, keepdims=True)
    found += softmax(logits, place, grads is not None)
    out, d_states = np.empty_like(found), None
    out[order] = found
    if grads is not None:
        both, d_words = np.zeros_like(inner), np.empty_like(d_own)
        for c, a, b in held:
            np.matmul(own[a:b].T, logits[a:b], out=both[c])
            np.matmul(logits[a:b], p["Wo"][c].T, out=d_words[a:b])
        grads["Wo"] += both[:, :h]
        grads["bo"] += both[:, h]
        d_own += d_words
        d_states = np.empty_like(d_own)
        d_states[order] = d_own
    return out, d_states


def backward(p: dict, grads: dict, own: Lanes, rows: list[np.ndarray], saved: tuple, d_states: np.ndarray) -> None:
    """Gradients through one window; what came before it counts as given."""
    h, at, (before, z, r, new, recurrent) = len(p["U"]), np.concatenate(rows), saved
    # What each state's gradient is to be multiplied with, for its gates' gradients.
    through = np.empty((3, *d_states.shape), d_states.dtype)
    rest, of_new = np.subtract(1, z), np.multiply(new, new)
    np.subtract(1, of_new, out=of_new)
    of_new *= rest
    np.subtract(before, new, out=through[0])
    through[0] *= z
    through[0] *= rest
    np.subtract(1, r, out=rest)
    rest *= recurrent
    np.multiply(of_new, r, out=through[2])
    np.multiply(through[2], rest, out=through[1])
    inner, fresh, b = np.ascontiguousarray(by_gate(p["U"]).transpose(0, 2, 1)), own.fresh[at], len(d_states)
    d, carry = d_states.copy(), np.zeros((len(rows[0]), h), d_states.dtype)
    for n in map(len, reversed(rows)):
        a = b - n
        now = d[a:b]
        now += carry[:n]
        step = through[:, a:b]
        step *= now
        back = np.matmul(step, inner)
        back[0] += back[1]
        back[0] += back[2]
        np.multiply(now, z[a:b], out=back[1])
        np.add(back[0], back[1], out=carry[:n])
        if fresh[a:b].any():
            carry[:n][fresh[a:b]] = 0
        b = a
    of_new *= d
    for k, g in enumerate(through):
        grads["U"][:, k * h : (k + 1) * h] += before.T @ g
    through[2] = of_new
    x = own.inputs[at]
    order = np.argsort(x, kind="stable")
    first = np.flatnonzero(np.diff(x[order].astype(np.int32), prepend=-1))
    words = x[order[first]]
    by_word = np.concatenate([np.add.reduceat(g[order], first) for g in through], 1)
    grads["W"] += p["E"][words].T @ by_word
    grads["b"] += by_word.sum(0)
    grads["E"][words] += by_word @ p["W"].T


def keep_freed() -> None:
    """Let the C library keep freed memory for the next window: it keeps twice the largest block that it gave back to the system."""
    np.empty(10 << 20, np.uint8)


def pieces(docs: list[np.ndarray], end: int, most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Documents cut after every `most` tokens, and what precedes each piece: the end token, or the word before."""
    out = [(d[a : a + most], d[a - 1] if a else end) for d in docs for a in range(0, len(d), most)]
    return [d for d, _ in out], np.array([f for _, f in out])


def train(p: dict, docs: list[np.ndarray], end: int, window: int = 10, most: int = 512, rate: float = 0.01, longest: int = 2000) -> dict:
    """The weights after one pass over documents (arrays of slots) by Adam on windows of `window` steps.

    Documents are learned whole, in pieces of at most `longest` tokens, so a long one doesn't run on alone; there are
    no more lanes than the longest piece leaves filled.
    """
    values = np.concatenate([p[k].ravel() for k in NAMES])
    slopes, mean, square, updates = np.zeros_like(values), np.zeros_like(values), np.zeros_like(values), 0
    cuts = np.cumsum([p[k].size for k in NAMES])[:-1]
    p, grads = ({k: x.reshape(p[k].shape) for k, x in zip(NAMES, np.split(flat, cuts))} for flat in (values, slopes))  # views
    docs, first = pieces(docs, end, longest)
    if not docs:
        return p
    keep_freed()
    own = Lanes(docs, min(most, -(-sum(map(len, docs)) // max(map(len, docs)))), first)
    state = np.zeros((len(own.length), len(p["U"])), np.float32)
    for a in range(0, own.steps, window):
        rows = own.rows(a, a + window)
        slopes.fill(0)
        states, state, saved = forward(p, p["E"] @ p["W"] + p["b"], own, rows, state, keep=True)
        slots = own.targets[np.concatenate(rows)]
        _, d_states = log_probabilities(p, states, slots, grads)
        backward(p, grads, own, rows, saved, d_states)
        updates += 1
        slopes /= len(slots)
        mean += 0.1 * (slopes - mean)
        square += 0.01 * (slopes * slopes - square)
        step = np.sqrt(square / (1 - 0.99**updates))
        step += 1e-6
        values -= (rate / (1 - 0.9**updates)) * mean / step
    return p


def score(p: dict, gates: np.ndarray, docs: list[np.ndarray], end: int, window: int = 48, most: int = 512) -> np.ndarray:
    """Natural log probability of each document (an array of slots), its state carried to its end. gates: E @ W + b."""
    out = np.zeros(len(docs))
    if not docs:
        return out
    keep_freed()
    own = Lanes(docs, most, np.full(len(docs), end))
    state = np.zeros((len(own.length), len(p["U"])), np.float32)
    for a in range(0, own.steps, window):
        rows = own.rows(a, a + window)
        states, state, _ = forward(p, gates, own, rows, state)
        at = np.concatenate(rows)
        out += np.bincount(own.owner[at], log_probabilities(p, states, own.targets[at])[0].astype(np.float64), len(docs))
    return out
