"""A small causal self-attention model over subword classes, in numpy.

A token's probability is that of its class given the classes before it, times its share of the class. Frequent
tokens are classes of their own. Classes come in groups of a fixed size: the model predicts the group, and then
the class within it, so that a target costs two small softmaxes. A text is cut into windows of ``CONTEXT`` inputs that overlap; of each window
the last ``STRIDE`` positions predict the token that follows, so every token is scored once, with at least
``CONTEXT - STRIDE`` tokens before it where there are that many.
"""

import numpy as np

from spindlewatch.llm.common import ship

ship(__name__)

CONTEXT = 32
STRIDE = 16
WIDTH = 16
GROUPS = 32
GROUP = 32
CLASSES = GROUPS * GROUP
BATCH = 256

# Bytes that a worker takes and gives back before it works on the model: from then on the C library's allocator keeps
# memory of this order for reuse, and every step's arrays need no new pages.
KEPT = 30 << 20

# Logits are held within these bounds, so that sums of their exponentials neither overflow nor vanish.
MOST = np.float32(60.0)
SCALE = np.float32(WIDTH**-0.5)


# One for the inputs that each scored position may look at, zero for those behind it.
SEEN = (np.arange(CONTEXT)[None, :] <= np.arange(CONTEXT - STRIDE, CONTEXT)[:, None]).astype(np.float32)


def _keep_memory():
    np.empty(KEPT, np.uint8)


def _flat(a):
    return a.reshape(-1, a.shape[-1])


def _times(a, matrix):
    """Every row of ``a`` times the matrix, as one product."""
    return (_flat(a) @ matrix).reshape(*a.shape[:-1], matrix.shape[1])


def _sums(a):
    """Sums along the last axis, which is short: a product is faster than a reduction."""
    return _flat(a) @ np.ones(a.shape[-1], a.dtype)


def _held(logits):
    """Logits within their bounds, in place; looking whether they are is faster than clipping."""
    if not (logits.max(initial=0.0) <= MOST and logits.min(initial=0.0) >= -MOST):
        np.clip(logits, -MOST, MOST, out=logits)


def _weights(q, turned, inputs):
    """Weights of each window's inputs for its scored positions, not divided by their sums, and these sums."""
    weights = q @ turned
    _held(weights)
    np.exp(weights, out=weights)
    weights *= SEEN
    # What is no input stands before the start of a text or behind its end.
    short = np.flatnonzero((inputs[:, 0] == Model.NONE) | (inputs[:, -1] == Model.NONE))
    weights[short] *= (inputs[short] != Model.NONE)[:, None, :]
    return weights, _sums(weights).reshape(-1, STRIDE, 1)


class Model:
    """Parameters by name. Codes beyond the classes stand for the start of a text and for no input."""

    START = CLASSES
    NONE = CLASSES + 1

    SHAPES = {
        "embed": (CLASSES + 2, WIDTH),
        "place": (CONTEXT, WIDTH),
        "query": (WIDTH, WIDTH),
        "key": (WIDTH, WIDTH),
        "value": (WIDTH, WIDTH),
        "mix": (WIDTH, WIDTH),
        "group": (WIDTH, GROUPS),
        "group_bias": (GROUPS,),
        "member": (GROUPS, WIDTH, GROUP),
        "member_bias": (GROUPS, GROUP),
    }

    def __init__(self, parameters):
        self.parameters = parameters

    @classmethod
    def new(cls, frequencies, seed=0):
        """Small weights, and biases by which classes are as likely as they are frequent."""
        rng = np.random.default_rng(seed)
        parameters = {}
        for name, shape in cls.SHAPES.items():
            scale = 0.3 if name in ("query", "key", "value", "mix") else 0.1
            parameters[name] = rng.normal(0.0, scale, shape).astype(np.float32)
        weights = np.asarray(frequencies, float).reshape(GROUPS, GROUP)
        parameters["group_bias"] = np.log(weights.sum(axis=1) / weights.sum()).astype(np.float32)
        parameters["member_bias"] = np.log(weights / weights.sum(axis=1, keepdims=True)).astype(np.float32)
        return cls(parameters)

    def flat(self):
        return np.concatenate([self.parameters[n].ravel() for n in self.SHAPES]).astype(np.float64)

    def with_flat(self, values):
        return Model(self._named(np.array(values, np.float32)))

    @classmethod
    def _named(cls, values):
        """The parameters by name, as parts of one row of values."""
        parameters, at = {}, 0
        for name, shape in cls.SHAPES.items():
            size = int(np.prod(shape))
            parameters[name] = values[at : at + size].reshape(shape)
            at += size
        return parameters

    def segments(self, codes):
        """Windows of a text's class codes: ``CONTEXT`` inputs and the token after the last one."""
        rest = -len(codes) % STRIDE
        padded = np.concatenate(
            [
                np.full(CONTEXT - STRIDE, self.NONE, np.uint16),
                np.array([self.START], np.uint16),
                codes,
                np.full(rest, self.NONE, np.uint16),
            ]
        )
        return np.lib.stride_tricks.sliding_window_view(padded, CONTEXT + 1)[::STRIDE]

    def windows(self, texts):
        """The :meth:`segments` of several texts in one array, and how many there are of each."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        counts = -(-sizes // STRIDE)
        lead = CONTEXT - STRIDE + 1
        spans = lead + STRIDE * counts
        begins = np.cumsum(spans) - spans
        padded = np.full(int(spans.sum()), self.NONE, np.uint16)
        padded[begins + lead - 1] = self.START
        if sizes.any():
            padded[np.arange(sizes.sum()) + np.repeat(begins + lead - np.cumsum(sizes) + sizes, sizes)] = np.concatenate(texts)
        if not counts.any():
            return np.zeros((0, CONTEXT + 1), np.uint16), counts
        starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = starts * STRIDE + np.repeat(begins, counts)
        return np.lib.stride_tricks.sliding_window_view(padded, CONTEXT + 1)[starts], counts

    def _pairing(self):
        """What takes a scored position to what its weights are products of the inputs with: query and key in one."""
        return (self.parameters["query"] * SCALE) @ self.parameters["key"].T

    def _moving(self):
        """What takes the weighted mean of inputs to what is added to a scored position: value and mix in one."""
        return self.parameters["value"] @ self.parameters["mix"]

    def _heads(self):
        """For each group, a matrix to the logits of the groups and of its members; biases are the last row."""
        p = self.parameters
        heads = np.empty((GROUPS, WIDTH + 1, GROUPS + GROUP), np.float32)
        heads[:, :WIDTH, :GROUPS], heads[:, WIDTH, :GROUPS] = p["group"], p["group_bias"]
        heads[:, :WIDTH, GROUPS:], heads[:, WIDTH, GROUPS:] = p["member"], p["member_bias"]
        return heads

    def _positions(self, inputs):
        """Embeddings with their places, of all inputs and of the scored positions."""
        x = np.take(self.parameters["embed"], inputs, axis=0)
        x += self.parameters["place"]
        return x, np.ascontiguousarray(x[:, CONTEXT - STRIDE :])

    @staticmethod
    def _read(inputs, x, last, pairing, moving):
        """What the gradients need, last the hidden rows. Weights are not divided by their sums, ``read`` is."""
        q = _times(last, pairing)
        turned = np.ascontiguousarray(x.transpose(0, 2, 1))
        weights, sums = _weights(q, turned, inputs)
        read = weights @ x
        read /= sums
        hidden = _times(read, moving)
        hidden += last
        return q, turned, weights, sums, read, hidden

    def _forward(self, segments):
        """The positions, what is in the middle of :meth:`_read`, and last the hidden rows."""
        inputs = segments[:, :CONTEXT]
        x, last = self._positions(inputs)
        return x, last, *self._read(inputs, x, last, self._pairing(), self._moving())

    def _reader(self):
        """The hidden rows of windows by their inputs, as :meth:`_forward` has them, for parameters that stay."""
        pairing, moving = self._pairing(), self._moving()

        def hidden(inputs):
            return self._read(inputs, *self._positions(inputs), pairing, moving)[-1]

        return hidden

    def _logits(self, hidden, targets, heads):
        """For the targets there are, in the order of their classes, and the others behind: their places; and of those
        there are the classes, hidden rows with a one behind, the rows of each group, and the logits."""
        targets = targets.ravel()
        order = np.argsort(targets, kind="stable")
        codes = targets[order]
        bounds = np.searchsorted(codes, np.arange(GROUPS + 1) * GROUP).tolist()
        n = bounds[-1]
        codes = codes[:n].astype(np.int64)
        rows = np.empty((n, WIDTH + 1), np.float32)
        rows[:, :WIDTH] = np.take(_flat(hidden), order[:n], axis=0)
        rows[:, WIDTH] = 1.0
        logits = np.empty((n, GROUPS + GROUP), np.float32)
        parts = [(g, a, b) for g, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
        for g, a, b in parts:
            np.matmul(rows[a:b], heads[g], out=logits[a:b])
        _held(logits)
        return order, codes, rows, parts, logits

    @staticmethod
    def _chosen(codes):
        """Where the logits of each target's group and of its member are, of all logits in a row."""
        at = np.arange(len(codes)) * (GROUPS + GROUP)
        return at + codes // GROUP, at + GROUPS + codes % GROUP

    def log10(self, segments):
        """Log probability of the classes that each window scores, as one sum per window."""
        _keep_memory()
        hidden_of, heads = self._reader(), self._heads()
        sums = np.zeros(len(segments))
        for at in range(0, len(segments), BATCH):
            part = segments[at : at + BATCH]
            hidden = hidden_of(part[:, :CONTEXT])
            order, codes, _, _, logits = self._logits(hidden, part[:, CONTEXT - STRIDE + 1 :], heads)
            groups, members = self._chosen(codes)
            chosen = logits.ravel()[groups] + logits.ravel()[members]
            np.exp(logits, out=logits)
            totals = np.log(_sums(logits.reshape(-1, GROUP))).reshape(-1, 2)
            logs = (chosen - totals[:, 0] - totals[:, 1]).astype(np.float64) / np.log(10.0)
            sums[at : at + BATCH] += np.bincount(order[: len(codes)] // STRIDE, np.maximum(logs, -30.0), len(part))
        return sums

    def gradients(self, segments):
        """Gradients of the mean negative log probability over the windows' targets."""
        p = self.parameters
        pairing, moving, heads = self._pairing(), self._moving(), self._heads()
        x, last, q, turned, weights, sums, read, hidden = self._forward(segments)
        order, codes, rows, parts, logits = self._logits(hidden, segments[:, CONTEXT - STRIDE + 1 :], heads)
        n = len(codes)
        scale = np.float32(1.0 / max(1, n))
        np.exp(logits, out=logits)
        halves = logits.reshape(-1, GROUP)
        halves *= (scale / _sums(halves))[:, None]
        for chosen in self._chosen(codes):
            logits.ravel()[chosen] -= scale
        found = np.zeros_like(heads)
        d_rows = np.empty((n, WIDTH), np.float32)
        back = np.ascontiguousarray(heads[:, :WIDTH].transpose(0, 2, 1))
        for g, a, b in parts:
            np.matmul(logits[a:b], back[g], out=d_rows[a:b])
            np.matmul(rows[a:b].T, logits[a:b], out=found[g])
        group = found[:, :, :GROUPS].sum(axis=0)
        out = {"group": group[:WIDTH], "group_bias": group[WIDTH]}
        out["member"], out["member_bias"] = found[:, :WIDTH, GROUPS:], found[:, WIDTH, GROUPS:]
        d_hidden = np.empty_like(hidden)
        _flat(d_hidden)[order[:n]] = d_rows
        _flat(d_hidden)[order[n:]] = 0.0
        d_moving = _flat(read).T @ _flat(d_hidden)
        out["value"], out["mix"] = d_moving @ p["mix"].T, p["value"].T @ d_moving
        d_read = _times(d_hidden, moving.T)
        d_read /= sums
        d_scores = d_read @ turned
        read *= d_read
        d_scores -= _sums(read).reshape(-1, STRIDE, 1)
        d_scores *= weights
        d_q = d_scores @ x
        d_pairing = _flat(last).T @ _flat(d_q)
        out["query"], out["key"] = d_pairing @ p["key"] * SCALE, d_pairing.T @ p["query"] * SCALE
        d_x = weights.transpose(0, 2, 1) @ d_read
        d_x += d_scores.transpose(0, 2, 1) @ q
        d_hidden += _times(d_q, pairing.T)
        d_x[:, CONTEXT - STRIDE :] += d_hidden
        out["place"] = d_x.sum(axis=0)
        found = segments[:, :CONTEXT].ravel()
        order = np.argsort(found, kind="stable")
        counts = np.bincount(found, minlength=CLASSES + 2)
        found = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[found]
        # Two numbers are added at a time, as one complex number.
        ordered = np.take(_flat(d_x).view(np.complex64), order, axis=0)
        out["embed"] = np.zeros_like(p["embed"])
        out["embed"].view(np.complex64)[found] = np.add.reduceat(ordered, starts, axis=0)
        return out

    def train(self, segments, rate, batch=64):
        """Parameters after one pass over the windows with Adam, from these ones."""
        _keep_memory()
        values = self.flat().astype(np.float32)
        model = Model(self._named(values))
        # The means of gradients and of their squares are kept 10 and 100 times as large as Adam has them.
        first, second, g = np.zeros_like(values), np.zeros_like(values), np.empty_like(values)
        for step, at in enumerate(range(0, len(segments), batch), 1):
            found = model.gradients(segments[at : at + batch])
            np.concatenate([found[name].ravel() for name in self.SHAPES], out=g)
            first *= np.float32(0.9)
            first += g
            second *= np.float32(0.99)
            g *= g
            second += g
            root = 0.1 / (1 - 0.99**step) ** 0.5
            np.sqrt(second, out=g)
            g += np.float32(1e-6 / root)
            np.divide(first, g, out=g)
            g *= np.float32(0.1 * rate / (1 - 0.9**step) / root)
            values -= g
        return model
