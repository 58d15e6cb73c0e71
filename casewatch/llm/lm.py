"""The language model of operator 2 in numpy: a gated recurrent network with
a class-factored softmax, trained by truncated backpropagation.

Documents run side by side in lanes; a window is a stretch of ``WINDOW`` steps
of all lanes. The state goes from window to window, and backpropagation stops
at the window's start. A lane's state is cleared where a document begins, so a
text's likelihood covers the complete text and depends on nothing else.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

WINDOW = 16
DIM = 16
CLIP = 1.0
#: Tokens whose likelihoods are taken at once: many, so that each class has many rows.
SCORED = 1 << 16
#: Parameters that a step of training goes through at once, so that they stay in the cache.
STRETCH = 1 << 13


def word_classes(counts: np.ndarray, n_classes: int) -> np.ndarray:
    """First word of each class (and the number of words at the end). Words
    are sorted by falling count; classes have near equal sums of the roots of the
    counts, which for a given number of classes makes the outputs that a token needs
    (its class, its words) near the fewest. Frequent words stand alone, rare ones share."""
    root = np.sqrt(counts)
    mass = np.cumsum(root, dtype=float) - root / 2
    of = np.minimum((mass / max(root.sum(), 1e-9) * n_classes).astype(int), n_classes - 1)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    return np.append(first, len(counts))


@np.errstate(over="ignore")  # 1 / (1 + inf) is the 0 that is meant
def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function; overwrites ``x``."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def _exps(s: np.ndarray, shifted: np.ndarray, most: np.ndarray | None) -> np.ndarray:
    """exp of the logits: rows of ``s`` by rows of ``shifted``, whose last column is the
    bias. With ``most`` each row is shifted by its own maximum, which goes there."""
    e = s @ shifted.T
    if most is not None:
        np.max(e, axis=1, out=most)
        e -= most[:, None]
    return np.exp(e, out=e)


def _tables(w: np.ndarray, bias: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights with the biases, less the greatest one of each softmax, as last column;
    weights with ones; the greatest bias of each softmax. ``first``: where each begins."""
    most = np.maximum.reduceat(bias, first)
    shifted, summed = np.empty((len(w), w.shape[1] + 1), w.dtype), np.empty((len(w), w.shape[1] + 1), w.dtype)
    shifted[:, :-1] = summed[:, :-1] = w
    shifted[:, -1] = bias - np.repeat(most, np.diff(first, append=len(w)))
    summed[:, -1] = 1
    return shifted, summed, most


#: Rows of a softmax over classes that are taken at once, so that they stay in the cache.
ROWS = 1024


class Net:
    """Parameters by name and the forward and backward passes."""

    def __init__(self, bounds: np.ndarray, params: dict[str, np.ndarray]):
        self.bounds = bounds
        self.all, self.p = self._packed(params)
        sizes = np.diff(bounds)
        self.class_of = np.repeat(np.arange(len(sizes)), sizes).astype(np.int16)  # 16 bits: argsort counts instead of merging

    @classmethod
    def fresh(cls, counts: np.ndarray, n_classes: int, dim: int = DIM, seed: int = 11) -> Net:
        """Starts as the unigram model of ``counts``: the biases are its log
        probabilities and the output weights are small."""
        rng = np.random.default_rng(seed)
        bounds = word_classes(counts, n_classes)
        c = counts + 1.0
        per_class = np.add.reduceat(c, bounds[:-1])
        normal = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype(np.float32)
        return cls(
            bounds,
            {
                "emb": normal(len(c), dim, scale=0.3),
                "wx": normal(dim, 3 * dim, scale=dim**-0.5),
                "wh": normal(dim, 3 * dim, scale=dim**-0.5),
                "bx": np.zeros(3 * dim, np.float32),
                "bh": np.zeros(3 * dim, np.float32),
                "wc": normal(len(per_class), dim, scale=0.02),
                "bc": np.log(per_class / per_class.sum()).astype(np.float32),
                "ww": normal(len(c), dim, scale=0.02),
                "bw": np.log(c / np.repeat(per_class, np.diff(bounds))).astype(np.float32),
            },
        )

    @staticmethod
    def _packed(params: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """One vector, and its parts by name as views of it."""
        whole = np.concatenate([params[k].ravel() for k in sorted(params)])
        out, at = {}, 0
        for k in sorted(params):
            out[k] = whole[at : at + params[k].size].reshape(params[k].shape)
            at += params[k].size
        return whole, out

    def flat(self) -> np.ndarray:
        return self.all.copy()

    def unflat(self, v: np.ndarray) -> Net:
        net = Net(self.bounds, self.p)
        net.all[:] = v
        return net

    def zeros(self) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """An empty gradient: one vector, and views of it."""
        return self._packed({k: np.zeros_like(v) for k, v in self.p.items()})

    def run(self, x: np.ndarray, begin: np.ndarray, h: np.ndarray, tape: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States (steps, lanes, dim) and the last state, for inputs (steps,
        lanes); ``begin`` marks document starts. Inside, lanes are the last axis, so
        that each gate is one stretch of memory."""
        p, d = self.p, h.shape[1]
        wh, bias = np.ascontiguousarray(p["wh"].T), p["bx"].copy()
        bias[: 2 * d] += p["bh"][: 2 * d]
        gx = np.matmul(p["wx"].T, p["emb"].take(x, axis=0).transpose(0, 2, 1))
        gx += bias[:, None]
        bn = p["bh"][2 * d :, None]
        keep = (~begin).astype(gx.dtype)
        kept = keep.all(axis=1)
        states = np.empty((len(x), d, x.shape[1]), gx.dtype)
        h = np.ascontiguousarray(h.T)
        for t in range(len(x)):
            if not kept[t]:
                h = h * keep[t]
            gh = wh @ h
            zr, hn = gx[t, : 2 * d], gh[2 * d :]
            zr += gh[: 2 * d]
            _sigmoid(zr)
            z, r = zr[:d], zr[d:]
            hn += bn
            n = r * hn
            n += gx[t, 2 * d :]
            np.tanh(n, out=n)
            new = np.subtract(h, n, out=states[t])
            new *= z
            new += n
            if tape is not None:
                tape.append((h, z, r, n, hn, None if kept[t] else keep[t]))
            h = new
        return states.transpose(0, 2, 1), h.T

    def tables(self) -> tuple:
        """What ``log_probs`` needs of the output weights; good until they change."""
        p = self.p
        return _tables(p["wc"], p["bc"], np.zeros(1, int)), _tables(p["ww"], p["bw"], self.bounds[:-1])

    @np.errstate(over="ignore", invalid="ignore")  # sums out of range are made again, shifted by row
    def log_probs(self, s: np.ndarray, y: np.ndarray, grad: dict | None = None, tables: tuple | None = None) -> np.ndarray:
        """Natural log P of each target given its state (rows). With ``grad``,
        adds the gradient of the mean negative log-likelihood to it and puts
        that of the states into grad["s"]."""
        p, n, d = self.p, len(y), s.shape[1]
        (c_shifted, c_summed, c_most), (w_shifted, w_summed, w_most) = tables or self.tables()
        order = np.argsort(y.astype(np.uint16) if self.bounds[-1] <= 1 << 16 else y, kind="stable")  # 16 bits: counted, not merged
        y = y.take(order)
        s1 = np.ones((n, d + 1), c_shifted.dtype)
        s1[:, :d] = s.take(order, axis=0)
        cls = self.class_of.take(y)
        cuts = np.searchsorted(cls, np.arange(len(self.bounds)))
        alone = (np.diff(self.bounds) < 2).take(cls)
        # Rows of s1, outputs of the softmax over classes or over the words of one.
        parts = [(a, min(n, a + ROWS), 0, len(c_shifted)) for a in range(0, n, ROWS)]
        n_head, many = len(parts), np.flatnonzero((np.diff(self.bounds) > 1) & (np.diff(cuts) > 0))
        parts += zip(cuts[many].tolist(), cuts[many + 1].tolist(), self.bounds[many].tolist(), self.bounds[many + 1].tolist(), strict=True)
        sums = np.ones((2, n, d + 1), s1.dtype)  # exp of the logits times weights and ones, by softmax
        most, held = np.zeros((2, n), s1.dtype), []
        for by_row in (False, True):  # rows are shifted by their own maximum only if some sum is out of range
            held.clear()
            for i, (a, b, first, last) in enumerate(parts):
                k = int(i >= n_head)
                shifted, summed = (w_shifted, w_summed) if k else (c_shifted, c_summed)
                e = _exps(s1[a:b], shifted[first:last], most[k, a:b] if by_row else None)
                np.matmul(e, summed[first:last], out=sums[k, a:b])
                if grad is not None:
                    held.append(e)
            if not n or 1e-30 < sums[:, :, d].min() and sums[:, :, d].max() < 1e30:
                break
        total = np.ascontiguousarray(sums[:, :, d])
        out = np.einsum("nd,nd->n", s1, c_shifted.take(cls, axis=0))
        out += np.where(alone, 0, np.einsum("nd,nd->n", s1, w_shifted.take(y, axis=0)))
        out -= (np.log(total) + most).sum(axis=0)
        if grad is not None:
            share, row = 1 / (total * n), np.arange(n)
            ds, rows = np.zeros((n, d), s1.dtype), [s1 * share[k][:, None] for k in (0, 1)]
            # Where each row has its target in the outputs of its part, taken as one stretch.
            at = (row % ROWS) * len(c_shifted) + cls, (row - cuts.take(cls)) * np.diff(self.bounds).take(cls) + y - self.bounds.take(cls)
            gc, gw = np.zeros_like(c_shifted), np.zeros_like(w_shifted)
            for i, ((a, b, first, last), e) in enumerate(zip(parts, held, strict=True)):
                k = int(i >= n_head)
                e.ravel()[at[k][a:b]] -= total[k, a:b]  # the share of an output, less one for the target
                if k:
                    np.matmul(e.T, rows[1][a:b], out=gw[first:last])
                else:
                    gc += e.T @ rows[0][a:b]
            for g, w, bias in ((gc, "wc", "bc"), (gw, "ww", "bw")):
                grad[w] += g[:, :d]
                grad[bias] += g[:, d]
            for k, w in ((0, p["wc"].take(cls, axis=0)), (1, p["ww"].take(y, axis=0))):
                part = sums[k, :, :d] * share[k][:, None]
                part -= w / s1.dtype.type(n)
                if k:
                    part[alone] = 0
                ds += part
            grad["s"] = np.empty_like(ds)
            grad["s"][order] = ds
        result = np.empty_like(out)
        result[order] = out
        return result

    def back(self, x: np.ndarray, tape: list, ds: np.ndarray, grad: dict) -> None:
        """Backpropagation through one window."""
        p, d = self.p, ds.shape[2]
        ds = np.ascontiguousarray(ds.transpose(0, 2, 1))
        gx, gh = np.empty((len(x), 3 * d, x.shape[1]), ds.dtype), np.empty((len(x), 3 * d, x.shape[1]), ds.dtype)
        hp = np.empty(ds.shape, ds.dtype)
        later = np.zeros(ds.shape[1:], ds.dtype)
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, hn, keep = tape[t]
            dh = ds[t]
            dh += later
            dz, dr, dn = gx[t, :d], gx[t, d : 2 * d], gx[t, 2 * d :]
            rest = (1 - z) * dh
            np.multiply(n, n, out=dn)
            np.subtract(1, dn, out=dn)
            dn *= rest
            np.subtract(h, n, out=dz)
            dz *= z
            dz *= rest
            np.subtract(1, r, out=dr)
            dr *= r
            dr *= hn
            dr *= dn
            gh[t, : 2 * d] = gx[t, : 2 * d]
            np.multiply(dn, r, out=gh[t, 2 * d :])
            later = p["wh"] @ gh[t]
            dh *= z
            later += dh
            if keep is not None:
                later *= keep
            hp[t] = h
        gx_t, tokens, ones = gx.transpose(0, 2, 1), x.ravel(), np.ones(x.shape[1], ds.dtype)
        grad["wh"] += np.matmul(hp, gh.transpose(0, 2, 1)).sum(axis=0)
        grad["bh"] += (gh @ ones).sum(axis=0)
        grad["bx"] += (gx @ ones).sum(axis=0)
        grad["wx"] += np.matmul(p["emb"].take(x, axis=0).transpose(0, 2, 1), gx_t).sum(axis=0)
        order = np.argsort(tokens.astype(np.uint16) if len(p["emb"]) <= 1 << 16 else tokens, kind="stable")
        sorted_tokens = tokens[order]
        first = np.flatnonzero(np.diff(sorted_tokens, prepend=-1))
        grad["emb"][sorted_tokens[first]] += np.add.reduceat(np.matmul(gx_t, p["wx"].T).reshape(-1, d).take(order, axis=0), first)


def lanes(docs: list[np.ndarray], end: int, n_lanes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows (inputs, targets, begins, document or -1), each (steps, lanes).

    Documents go to the lane that is shortest so far, longest documents
    first; lanes that have ended leave, so the number of lanes only falls and
    the first lanes of one window are the lanes of the next. A document of n
    tokens takes n + 1 steps: ``end`` is its first input and last target."""
    total, longest = sum(map(len, docs)) + len(docs), max(map(len, docs)) + 1
    n_lanes = max(1, min(n_lanes, len(docs), max(4, total // longest)))  # no wider than the longest document can fill
    heap = [(0, i) for i in range(n_lanes)]
    parts: list[list[int]] = [[] for _ in range(n_lanes)]
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        used, i = heapq.heappop(heap)
        parts[i].append(d)
        heapq.heappush(heap, (used + len(docs[d]) + 1, i))
    length = np.array([sum(len(docs[d]) + 1 for d in part) for part in parts])
    order = np.argsort(-length, kind="stable")
    length = length[order]
    steps = -(-int(length[0]) // WINDOW) * WINDOW
    x = np.full((steps + 1, n_lanes), end, np.int32)
    who = np.full((steps, n_lanes), -1, np.int32)
    for i, lane in enumerate(order):
        at = 0
        for d in parts[lane]:
            n = len(docs[d])
            x[at + 1 : at + 1 + n, i] = docs[d]  # the end before it is its first input, the end after it its last target
            who[at : at + n + 1, i] = d
            at += n + 1
    begin = np.diff(who, axis=0, prepend=-1) != 0
    for at in range(0, steps, WINDOW):
        k, stop = int((length > at).sum()), at + WINDOW
        yield x[at:stop, :k], x[at + 1 : stop + 1, :k], begin[at:stop, :k], who[at:stop, :k]


def _adam(p: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, step: np.ndarray, clip: float, scale: float) -> None:
    """One step of Adam; overwrites ``g`` and ``step``. ``m`` and ``v`` hold ten times the
    mean of the gradients and a hundred times that of their squares."""
    if clip < 1:
        g *= clip
    m *= 0.9
    m += g
    v *= 0.99
    g *= g
    v += g
    np.sqrt(v, out=step)
    step += 1e-7
    np.divide(m, step, out=step)
    step *= scale
    p -= step


def train(net: Net, docs: list[np.ndarray], end: int, n_lanes: int, rate: float, adam: dict) -> int:
    """One pass over ``docs``, changing ``net``; returns the tokens seen.
    ``adam`` carries the moments from call to call."""
    h, seen = None, 0
    whole, grad = net.zeros()
    if "m" not in adam:
        adam |= {"t": 0, "m": np.zeros_like(whole), "v": np.zeros_like(whole)}
    m, v, step = adam["m"], adam["v"], np.empty(STRETCH, whole.dtype)
    for x, y, begin, who in lanes(docs, end, n_lanes):
        if h is None:
            h = np.zeros((x.shape[1], DIM), np.float32)
        tape: list = []
        states, h = net.run(x, begin, h[: x.shape[1]], tape)
        valid = np.flatnonzero(who.ravel() >= 0)
        whole.fill(0)
        net.log_probs(states.reshape(-1, DIM).take(valid, axis=0), y.ravel().take(valid), grad)
        ds = np.zeros((who.size, DIM), np.float32)
        ds[valid] = grad.pop("s")
        net.back(x, tape, ds.reshape(*who.shape, DIM), grad)
        length = np.sqrt(float(np.vdot(whole, whole)))
        adam["t"] = t = adam["t"] + 1
        scale = np.float32(rate * np.sqrt(1 - 0.99**t) / (1 - 0.9**t))
        for at in range(0, len(whole), STRETCH):
            here = slice(at, at + STRETCH)
            _adam(net.all[here], whole[here], m[here], v[here], step[: len(whole) - at], CLIP / max(CLIP, length), scale)
        seen += len(valid)
    return seen


def score(net: Net, docs: list[np.ndarray], end: int, n_lanes: int = 256) -> np.ndarray:
    """Natural log-likelihood of each complete document, its end included."""
    total, h, tables = np.zeros(len(docs)), None, net.tables()
    if not docs:
        return total
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add() -> None:
        states, y, who = (np.concatenate(part) for part in zip(*held, strict=True))
        total[:] += np.bincount(who, weights=net.log_probs(states, y, tables=tables), minlength=len(docs))
        held.clear()

    for x, y, begin, who in lanes(docs, end, n_lanes):
        h = np.zeros((x.shape[1], DIM), np.float32) if h is None else h[: x.shape[1]]
        states, h = net.run(x, begin, h)
        flat = who.ravel()
        valid = np.flatnonzero(flat >= 0)
        held.append((states.reshape(-1, DIM).take(valid, axis=0), y.ravel().take(valid), flat.take(valid)))
        if sum(len(part[1]) for part in held) >= SCORED:
            add()
    if held:
        add()
    return total
