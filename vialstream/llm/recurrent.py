"""A gated recurrent language model in numpy, with a class-factored softmax.

P(token | state) = P(class | state) * P(word | class, state) for the ``WORDS`` most frequent tokens, and
P(class | state) * (c + 1) / Z(class) for the others: their classes are told by a token's last bytes, c is
its training count, and Z sums c + 1 over the class's training tokens, and 1 for all that training never saw.
"""

from __future__ import annotations

import numpy as np

from .common import sigmoid

WORDS = 4096
WORD_CLASSES = 64
RARE_CLASSES = 64
HIDDEN = 16
#: Rows of a softmax over classes that are worked on together.
BLOCK = 512
GROUP = 8
#: No sum of exponentials of such logits passes a float's range; in training they are cut off there.
MOST_LOGIT = 60.0


class Layout:
    """Classes of the frequent words: runs of about equal sums of the counts' square roots, by falling count."""

    def __init__(self, counts: np.ndarray, rare: np.ndarray) -> None:
        """counts: of the frequent words, falling; rare: tokens of each rare class."""
        root = np.sqrt(np.maximum(counts, 1).astype(np.float64))
        cut = np.minimum(WORD_CLASSES - 1, ((np.cumsum(root) - root) / root.sum() * WORD_CLASSES).astype(int))
        self.klass = np.concatenate([cut, WORD_CLASSES + np.arange(RARE_CLASSES)]).astype(np.int32)
        self.first = np.searchsorted(cut, np.arange(WORD_CLASSES + 1))
        self.words = len(counts)
        mass = np.bincount(cut, counts, WORD_CLASSES)
        both = np.concatenate([np.where(np.diff(self.first) > 0, mass + 0.5, 0), rare + 0.5])
        self.class_bias = np.log(np.maximum(both / both.sum(), 1e-20)).astype(np.float32)  # a class without words gets next to nothing
        #: Runs of classes whose softmaxes are trained as one: their words' numbers, padded, and which are real.
        self.groups = []
        for lo in range(0, WORD_CLASSES, GROUP):
            a, size = self.first[lo : lo + GROUP], np.diff(self.first[lo : lo + GROUP + 1])
            real = np.arange(max(1, int(size.max()))) < size[:, None]
            self.groups.append((lo, np.where(real, a[:, None] + np.arange(real.shape[1]), 0), real))
        self.word_bias = np.log((counts + 0.5) / np.maximum(mass[cut], 1)).astype(np.float32)


def start_weights(layout: Layout, seed: int = 3) -> dict[str, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(seed))
    n, h, c = layout.words + RARE_CLASSES, HIDDEN, WORD_CLASSES + RARE_CLASSES
    f = lambda *s, k=0.1: (r.standard_normal(s) * k).astype(np.float32)
    return {"x": f(n, 3 * h, k=0.3), "u": f(h, 3 * h, k=h**-0.5), "c": f(h, c, k=0.05), "cb": layout.class_bias.copy(), "w": f(layout.words, h, k=0.05), "wb": layout.word_bias.copy()}


def step(w: dict, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    n = HIDDEN
    g, p = w["x"][ids], h @ w["u"]
    zr = sigmoid(g[:, : 2 * n] + p[:, : 2 * n])
    new = np.tanh(g[:, 2 * n :] + zr[:, n:] * p[:, 2 * n :])
    return new + zr[:, :n] * (h - new)


def log_probs(w: dict, layout: Layout, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(class) * P(word | class); for rare ids, of P(class).

    Both softmaxes go by blocks of rows that stay in the processor's cache.
    """
    k = layout.klass[ids]
    out = np.empty(len(ids), h.dtype)
    # states lie between -1 and 1, so the weights bound the logits
    far = bool((np.abs(h).max(initial=0) > 1) or (np.abs(w["c"]).sum(0) + np.abs(w["cb"])).max(initial=0) > MOST_LOGIT or (np.abs(w["w"]).sum(1) + np.abs(w["wb"])).max(initial=0) > MOST_LOGIT)
    for lo in range(0, len(ids), BLOCK):
        logits = h[lo : lo + BLOCK] @ w["c"]
        logits += w["cb"]
        out[lo : lo + BLOCK] = _normalised(logits, k[lo : lo + BLOCK], far)
    order = np.argsort(k.astype(np.int16), kind="stable")
    bounds = np.searchsorted(k[order], np.arange(WORD_CLASSES + 1))
    for c in range(WORD_CLASSES):
        a, b = layout.first[c], layout.first[c + 1]
        if b - a < 2 or bounds[c] == bounds[c + 1]:
            continue
        words, bias = np.ascontiguousarray(w["w"][a:b].T), w["wb"][a:b]
        block = max(64, BLOCK * 128 // int(b - a))
        for lo in range(bounds[c], bounds[c + 1], block):
            rows = order[lo : min(lo + block, bounds[c + 1])]
            part = h[rows] @ words
            part += bias
            out[rows] += _normalised(part, ids[rows] - a, far)
    return out


def _normalised(logits: np.ndarray, at: np.ndarray, far: bool) -> np.ndarray:
    """The log softmax of each row at one place; the logits are spent.  ``far``: they may pass an exponential's range."""
    if far:
        logits -= logits.max(1)[:, None]
    mine = logits[np.arange(len(at)), at]
    np.exp(logits, out=logits)
    return mine - np.log(logits.sum(1))


def score(w: dict, layout: Layout, ids: np.ndarray, bounds: np.ndarray, window: int = 32) -> np.ndarray:
    """Log probability of each document's ids, the state carried from its first token to its last.

    Documents go side by side, longest first; those that have ended leave the batch.
    """
    n, size = HIDDEN, np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    at, size = bounds[:-1][order], size[order]
    total = np.zeros(len(order))
    h = np.zeros((len(order), n), np.float32)
    t, longest = 0, int(size[0]) if len(size) else 0
    while t < longest:
        most = int(np.searchsorted(-size, -t, "left"))  # so many documents have more than t tokens
        steps = min(longest - t, max(window, min(1024, 8192 // most)))
        live = np.searchsorted(-size[:most], -np.arange(t, t + steps), "left").tolist()
        now = [ids[at[:k] + t + j] for j, k in enumerate(live)]
        tokens = np.concatenate(now)
        given = w["x"][tokens]
        states, lo = np.empty((len(tokens), n), np.float32), 0
        for k in live:
            h = h[:k]
            states[lo : lo + k] = h
            p, g = h @ w["u"], given[lo : lo + k]
            zr = p[:, : 2 * n] + g[:, : 2 * n]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            new = zr[:, n:] * p[:, 2 * n :]
            new += g[:, 2 * n :]
            np.tanh(new, out=new)
            h = h - new
            h *= zr[:, :n]
            h += new
            lo += k
        found = log_probs(w, layout, states, tokens)
        cuts, lo = np.concatenate([[0], np.cumsum(live)]), 0
        if live[0] == live[-1]:
            total[: live[0]] += found.reshape(len(live), live[0]).sum(0, dtype=np.float64)
        else:
            for x, y, k in zip(cuts[:-1].tolist(), cuts[1:].tolist(), live, strict=True):
                total[:k] += found[x:y]
        t += steps
    out = np.zeros(len(total))
    out[order] = total
    return out


class Trainer:
    """Truncated backpropagation through time with Adagrad steps; rows of the large tables are updated sparsely."""

    def __init__(self, w: dict, layout: Layout, rate: float, streams: int = 128, window: int = 24) -> None:
        self.w, self.layout, self.rate, self.streams, self.window = w, layout, rate, streams, window
        self.square = {k: np.full_like(v, 1e-2) for k, v in w.items()}
        self.tokens = 0

    def _apply(self, key: str, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        s = self.square[key][rows] + grad * grad
        self.square[key][rows] = s
        self.w[key][rows] -= self.rate * grad / np.sqrt(s)

    def text(self, ids: np.ndarray, begins: np.ndarray) -> None:
        """One pass over documents laid end to end, in ``streams`` equal parts, the last one padded; begins marks first tokens."""
        each = -(-len(ids) // self.streams)
        if len(ids) < 2 * self.streams:
            if len(ids) < 2:
                return
            each = len(ids)
        streams = -(-len(ids) // each)
        pad = each * streams - len(ids)
        x = np.pad(ids, (0, pad)).reshape(streams, each)
        b = np.pad(begins, (0, pad)).reshape(streams, each)
        live = (np.arange(each * streams) < len(ids)).reshape(streams, each)
        h = np.zeros((streams, HIDDEN), np.float32)
        for t in range(0, each, self.window):
            h = self.update(h, *(v[:, t : t + self.window].T for v in (x, b, live)))

    def update(self, h: np.ndarray, x: np.ndarray, begins: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        """One window: (steps, streams) tokens; the state at a document's first token is zero; what is not live is padding."""
        w, lay, n = self.w, self.layout, HIDDEN
        steps, streams = x.shape
        m = steps * streams
        ids = x.reshape(-1)
        given = w["x"][x]
        hs, new = (np.empty((steps, streams, n), given.dtype) for _ in range(2))
        moved = np.empty_like(given)
        gates = np.empty((steps, streams, 2 * n), given.dtype)
        some, goes_on = begins.any(1), ~begins
        for k in range(steps):
            if some[k]:
                h = h * goes_on[k][:, None]
            hs[k] = h
            p, g, a = np.matmul(h, w["u"], out=moved[k]), gates[k], new[k]
            np.add(given[k, :, : 2 * n], p[:, : 2 * n], out=g)
            g *= 0.5
            np.tanh(g, out=g)
            g += 1
            g *= 0.5
            np.multiply(g[:, n:], p[:, 2 * n :], out=a)
            a += given[k, :, 2 * n :]
            np.tanh(a, out=a)
            h = h - a
            h *= g[:, :n]
            h += a
        flat = hs.reshape(m, n)
        # softmax over classes
        share = np.float32(1 / streams)
        e = flat @ w["c"]
        e += w["cb"]
        np.minimum(e, MOST_LOGIT, out=e)
        np.exp(e, out=e)
        e *= share / e.sum(1, keepdims=True)
        k = lay.klass[ids]
        e[np.arange(m), k] -= share
        if live is not None and not live.all():
            flat_live = live.reshape(-1)
            e[~flat_live] = 0
            k = np.where(flat_live, k, -1)
        dh = e @ w["c"].T
        gc, gcb = flat.T @ e, e.sum(0)
        # softmax over the words of each class: rows of one class lie together, several classes go as one padded batch
        order = np.argsort(k.astype(np.int16), kind="stable")
        bounds = np.searchsorted(k[order], np.arange(WORD_CLASSES + 1))
        rows, place = flat[order], ids[order]
        more, gw, gwb = np.zeros_like(rows), np.zeros_like(w["w"]), np.zeros_like(w["wb"])
        for lo, number, real in lay.groups:
            at = bounds[lo : lo + len(real) + 1]
            if at[-1] == at[0]:
                continue
            count = np.diff(at)
            there = np.arange(int(count.max())) < count[:, None]
            row = np.where(there, at[:-1, None] + np.arange(there.shape[1]), at[0])
            part, words = rows[row], w["w"][number]
            q = part @ words.transpose(0, 2, 1)
            q += np.where(real, w["wb"][number], np.float32(-1e30))[:, None, :]
            np.minimum(q, MOST_LOGIT, out=q)
            np.exp(q, out=q)
            q *= there[:, :, None] * share / np.maximum(q.sum(2, keepdims=True), 1e-30)
            g, j = np.nonzero(there)
            q[g, j, place[at[0] : at[-1]] - lay.first[lo + g]] -= share
            more[at[0] : at[-1]] = (q @ words)[there]
            a, b = lay.first[lo], lay.first[lo + len(real)]
            gw[a:b] = (q.transpose(0, 2, 1) @ part)[real]
            gwb[a:b] = q.sum(1)[real]
        dh[order] += more
        # back through the steps; ``back``: the gradient at the state after a step
        dh = dh.reshape(steps, streams, n)
        z, r = gates[:, :, :n], gates[:, :, n:]
        by_z, by_new, by_r = (hs - new) * z * (1 - z), (1 - z) * (1 - new * new), moved[:, :, 2 * n :] * r * (1 - r)
        gx = np.empty((steps, streams, 3 * n), given.dtype)
        dp = np.empty_like(gx)
        back, turned = np.zeros((streams, n), given.dtype), np.ascontiguousarray(w["u"].T)
        for s in range(steps - 1, -1, -1):
            g, d = gx[s], dp[s]
            np.multiply(back, by_z[s], out=g[:, :n])
            np.multiply(back, by_new[s], out=g[:, 2 * n :])
            np.multiply(g[:, 2 * n :], by_r[s], out=g[:, n : 2 * n])
            d[:, : 2 * n] = g[:, : 2 * n]
            np.multiply(g[:, 2 * n :], r[s], out=d[:, 2 * n :])
            back *= z[s]
            back += d @ turned
            back += dh[s]
            if some[s]:
                back *= goes_on[s][:, None]
            np.minimum(back, 1, out=back)
            np.maximum(back, -1, out=back)
        rows = np.argsort(ids, kind="stable")
        ordered = ids[rows]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        self._apply("x", np.add.reduceat(gx.reshape(m, 3 * n)[rows], starts), ordered[starts])
        self._apply("u", flat.T @ dp.reshape(m, 3 * n))
        self._apply("c", gc)
        self._apply("cb", gcb)
        self._apply("w", gw)
        self._apply("wb", gwb)
        self.tokens += m if live is None else int(live.sum())
        return h
