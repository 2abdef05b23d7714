"""A bidirectional gated recurrent network with attention pooling, in numpy.

Input of a step is one word: its own embedding (if the word is in the vocabulary)
next to the mean embedding of its known character runs. Two recurrences read a
window of words forwards and backwards; attention weighs their states; a logistic
unit scores the window.
"""

from __future__ import annotations

import numpy as np

WORD_DIM, CHAR_DIM, HIDDEN = 12, 16, 8
WINDOW, STRIDE = 32, 24
#: Share of known words that a training step takes as unseen, and decay of embeddings per step.
DROPPED, DECAY = 0.25, 0.0005
#: Lengths of the character runs; a word's edges count as one character each.
RUNS = (3, 5)
TABLE_BITS = 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_SPACE = 32
#: ASCII letters in lower case and all bytes of other characters stay, the rest parts words.
_LETTERS = np.full(256, _SPACE, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_EDGE = 8  # spaces around each text, more than the longest run


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], filled = 1, 1
    while filled < n:
        step = np.uint64(pow(int(base), filled, 1 << 64))
        more = min(filled, n - filled)
        out[filled:filled + more] = out[:more] * step
        filled += more
    return out


class Words:
    """The words of some texts, as 64-bit hashes; equal words share an entry.

    ``ids`` has the entry of each word in reading order, ``counts`` the number of
    words of each text, ``hashes`` an entry's hash, ``runs`` and ``run_counts`` the
    hashes of all character runs of the entries.
    """

    def __init__(self, texts: list[str]):
        gap = " " * _EDGE
        raw = np.frombuffer((gap + gap.join(t.lower() for t in texts) + gap).encode(), np.uint8)
        data = _LETTERS[raw]
        up, down = _powers(_MULTIPLIER, len(data) + 1), _powers(_INVERSE, len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashed = lambda a, b: self._mix((sums[b] - sums[a]) * down[a])
        inside = np.concatenate(([False], data != _SPACE, [False]))
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(~inside[1:] & inside[:-1])
        lengths = np.array([len(t.lower().encode()) for t in texts], np.int64)
        bounds = np.cumsum(lengths + _EDGE) + _EDGE // 2
        self.counts = np.diff(np.concatenate(([0], np.searchsorted(starts, bounds))))
        self.hashes, first, self.ids = np.unique(hashed(starts, ends), return_index=True, return_inverse=True)
        s, e = starts[first], ends[first]
        runs, owners = [], []
        for n in RUNS:
            # From the edge before the word to the edge after it; a short word is one run.
            each = np.maximum(e - s + 3 - n, 1)
            owner = np.repeat(np.arange(len(s)), each)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each) + (s[owner] - 1)
            runs.append(hashed(at, np.minimum(at + n, e[owner] + 1)))
            owners.append(owner)
        self.runs, self.owners = np.concatenate(runs), np.concatenate(owners)

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


class Vocabulary:
    """Finds 64-bit hashes: 1 and up for known ones in order, 0 for others.

    Hashes are looked up in a table of 2^20 cells; of those that share a cell the
    first one given is kept.
    """

    def __init__(self, hashes: np.ndarray):
        cells = self._cell(hashes)
        _, first = np.unique(cells, return_index=True)
        self.hashes = hashes[np.sort(first)]
        self.cells = np.zeros(1 << TABLE_BITS, np.int32)
        self.cells[self._cell(self.hashes)] = np.arange(1, len(self.hashes) + 1)
        self.checked = np.concatenate(([np.uint64(0)], self.hashes))

    @staticmethod
    def _cell(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = self.cells[self._cell(hashes)]
        return np.where(self.checked[at] == hashes, at, 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, words: Vocabulary, runs: Vocabulary, seed: int = 7):
        rng = np.random.default_rng(seed)
        make = lambda *shape, scale=0.3: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.words, self.runs = words, runs
        n = WORD_DIM + CHAR_DIM
        self.p = {
            "word": make(len(words.hashes) + 1, WORD_DIM, scale=0.1), "char": make(len(runs.hashes) + 1, CHAR_DIM, scale=0.1),
            "wf": make(n, 3 * HIDDEN), "wb": make(n, 3 * HIDDEN), "bf": make(3 * HIDDEN, scale=0), "bb": make(3 * HIDDEN, scale=0),
            "uf": make(HIDDEN, 3 * HIDDEN), "ub": make(HIDDEN, 3 * HIDDEN),
            "attend": make(2 * HIDDEN), "out": make(2 * HIDDEN), "bias": np.full(1, -1, np.float32),
        }
        self.p["word"][0] = self.p["char"][0] = 0

    def inputs(self, words: Words, drop: np.random.Generator | None = None):
        """Input of each entry, and what its gradient needs. In training, some words are
        taken as unseen (``drop``), so that their characters must do."""
        known = self.words.find(words.hashes)
        if drop is not None:
            known = np.where(drop.random(len(known)) < DROPPED, 0, known)
        run = self.runs.find(words.runs)
        hit = run > 0
        run, owner = run[hit], words.owners[hit]
        found = np.maximum(np.bincount(owner, minlength=len(known)), 1).astype(np.float32)
        order = np.argsort(owner, kind="stable")
        run, owner = run[order], owner[order]
        chars = np.zeros((len(known), CHAR_DIM), self.p["char"].dtype)
        if len(run):
            has, at = np.unique(owner, return_index=True)
            chars[has] = np.add.reduceat(self.p["char"][run], at, axis=0)
        chars /= found[:, None]
        return np.concatenate((self.p["word"][known], chars), axis=1), (known, run, owner, found)

    def _read(self, x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None):
        """States (T, B, H) of one recurrence over gate inputs x (T, B, 3H)."""
        steps, batch, _ = x.shape
        h, states = np.zeros((batch, HIDDEN), x.dtype), np.empty((steps, batch, HIDDEN), x.dtype)
        for t in range(steps):
            g = h @ u
            zr = _sigmoid(x[t, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            gn = g[:, 2 * HIDDEN:]
            n = np.tanh(x[t, :, 2 * HIDDEN:] + r * gn)
            new = h + (1 - z) * (n - h) * mask[t][:, None]
            if keep is not None:
                keep.append((h, z, r, gn, n))
            states[t] = h = new
        return states

    def windows(self, gates_f: np.ndarray, gates_b: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: dict | None = None):
        """Logits of windows; ids and mask are (T, B), ids index the gate inputs of entries."""
        kf, kb = ([], []) if keep is not None else (None, None)
        hf = self._read(gates_f[ids], mask, self.p["uf"], kf)
        hb = self._read(gates_b[ids[::-1]], mask[::-1], self.p["ub"], kb)[::-1]
        states = np.concatenate((hf, hb), axis=2)
        heed = np.where(mask > 0, states @ self.p["attend"], -1e9)
        heed = np.exp(heed - heed.max(axis=0)) * mask
        heed /= np.maximum(heed.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", heed, states)
        if keep is not None:
            keep.update(f=kf, b=kb, states=states, heed=heed, pooled=pooled)
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gates(self, x: np.ndarray):
        return x @ self.p["wf"] + self.p["bf"], x @ self.p["wb"] + self.p["bb"]

    @staticmethod
    def layout(counts: np.ndarray):
        """Overlapping windows of all texts: first word, number of words, text."""
        each = np.maximum(-(-(counts - WINDOW) // STRIDE) + 1, 1)
        owner = np.repeat(np.arange(len(counts)), each)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
        first = (np.cumsum(counts) - counts)[owner] + k * STRIDE
        return first, np.minimum(counts[owner] - k * STRIDE, WINDOW), owner

    def score(self, texts: list[str], at_once: int = 2048) -> np.ndarray:
        """For each text the highest score of its windows; a text without words has one, empty."""
        words = Words(texts)
        gf, gb = self.gates(self.inputs(words)[0]) if len(words.hashes) else (np.zeros((1, 3 * HIDDEN), np.float32),) * 2
        ids = words.ids if len(words.ids) else np.zeros(1, np.int64)
        first, length, owner = self.layout(words.counts)
        logits = np.empty(len(first), np.float32)
        steps = np.arange(WINDOW)[:, None]
        for a in range(0, len(first), at_once):
            f, n = first[a:a + at_once], length[a:a + at_once]
            mask = (steps < n).astype(np.float32)
            logits[a:a + at_once] = self.windows(gf, gb, ids[np.minimum(f + steps, len(ids) - 1)], mask)
        best = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(best, owner, logits)
        return _sigmoid(best.astype(np.float64))

    # ---- training -----------------------------------------------------------------

    def _back_read(self, keep: list, d_states: np.ndarray, mask: np.ndarray, u: np.ndarray):
        """Gradients of the gate inputs and of u."""
        d_x, d_u = np.empty((*mask.shape, 3 * HIDDEN), np.float32), np.zeros_like(u)
        d_h = np.zeros_like(d_states[0])
        for t in range(len(keep) - 1, -1, -1):
            h, z, r, gn, n = keep[t]
            d_new, m = d_h + d_states[t], mask[t][:, None]
            d_n = d_new * (1 - z) * m * (1 - n * n)
            d_z = -d_new * (n - h) * m * z * (1 - z)
            d_r = d_n * gn * r * (1 - r)
            d_x[t] = np.concatenate((d_z, d_r, d_n), axis=1)
            d_g = np.concatenate((d_z, d_r, d_n * r), axis=1)
            d_u += h.T @ d_g
            d_h = d_new * (1 - (1 - z) * m) + d_g @ u.T
        return d_x, d_u

    def step(self, texts: list[str], labels: np.ndarray, drop: np.random.Generator | None = None) -> tuple[dict, float]:
        """Gradients and mean loss of a batch; a text's highest window bears most of it."""
        words = Words(texts)
        x, (known, run, owner_run, found) = self.inputs(words, drop)
        gf, gb = self.gates(x)
        first, length, owner = self.layout(words.counts)
        steps = np.arange(WINDOW)[:, None]
        mask = (steps < length).astype(np.float32)
        ids = words.ids[np.minimum(first + steps, len(words.ids) - 1)]
        keep: dict = {}
        logits = self.windows(gf, gb, ids, mask, keep)
        best = np.full(len(texts), -np.inf, np.float32)
        np.maximum.at(best, owner, logits)
        share = np.exp(logits - best[owner])
        share /= np.bincount(owner, share, len(texts))[owner]
        p = _sigmoid(best)
        loss = float(-np.mean(np.log(np.where(labels > 0, p, 1 - p) + 1e-9)))
        d_logit = (((p - labels) / len(texts))[owner] * share).astype(np.float32)

        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        states, heed, pooled = keep["states"], keep["heed"], keep["pooled"]
        g["out"], g["bias"][0] = pooled.T @ d_logit, d_logit.sum()
        d_pooled = d_logit[:, None] * self.p["out"]
        d_heed = np.einsum("bh,tbh->tb", d_pooled, states)
        d_heed = heed * (d_heed - (heed * d_heed).sum(axis=0))
        g["attend"] = np.einsum("tb,tbh->h", d_heed, states)
        d_states = heed[:, :, None] * d_pooled + d_heed[:, :, None] * self.p["attend"]
        df, g["uf"] = self._back_read(keep["f"], d_states[:, :, :HIDDEN], mask, self.p["uf"])
        db, g["ub"] = self._back_read(keep["b"], d_states[::-1, :, HIDDEN:], mask[::-1], self.p["ub"])
        d_gf, d_gb = np.zeros_like(gf), np.zeros_like(gb)
        np.add.at(d_gf, ids, df)
        np.add.at(d_gb, ids[::-1], db)
        g["wf"], g["wb"], g["bf"], g["bb"] = x.T @ d_gf, x.T @ d_gb, d_gf.sum(axis=0), d_gb.sum(axis=0)
        d_x = d_gf @ self.p["wf"].T + d_gb @ self.p["wb"].T
        np.add.at(g["word"], known, d_x[:, :WORD_DIM])
        np.add.at(g["char"], run, (d_x[:, WORD_DIM:] / found[:, None])[owner_run])
        g["word"][0] = g["char"][0] = 0
        return g, loss


def known_hashes(texts: list[str], at_least: int, most: int) -> tuple[Vocabulary, Vocabulary]:
    """Words and character runs that are in ``at_least`` texts, the commonest ``most`` of each.

    Of equally common ones the lower hash goes first.
    """
    parts: list[list[np.ndarray]] = [[], []]
    for t in texts:
        w = Words([t])
        parts[0].append(w.hashes)
        parts[1].append(np.unique(w.runs))
    out = []
    for part in parts:
        values, counts = np.unique(np.concatenate(part), return_counts=True) if part else (np.zeros(0, np.uint64), np.zeros(0))
        values, counts = values[counts >= at_least], counts[counts >= at_least]
        out.append(Vocabulary(values[np.lexsort((values, -counts))[:most]]))
    return out[0], out[1]


def train(texts: list[str], labels: list[int], epochs: int, rate: float = 0.01, batch: int = 32,
          at_least: int = 2, most: int = 50_000, seed: int = 7, least_steps: int = 300) -> Network:
    """A network fitted by Adam in a fixed order of batches, over ``epochs`` passes or
    as many as give ``least_steps`` batches.

    Texts without a word teach nothing by their label; one to a batch is added as
    clean, so that an empty window scores low.
    """
    pairs = [(t, y) for t, y in zip(texts, labels, strict=True) if Words([t]).counts[0]]
    pairs += [("", 0)] * (len(pairs) // batch)
    net = Network(*known_hashes([t for t, _ in pairs], at_least, most), seed=seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    rng, turn = np.random.default_rng(seed), 0
    epochs = max(epochs, -(-least_steps * batch // max(len(pairs), 1))) if pairs else 0
    for epoch in range(epochs):
        order = rng.permutation(len(pairs))
        for a in range(0, len(order), batch):
            picked = [pairs[i] for i in order[a:a + batch]]
            if not any(t for t, _ in picked):
                continue
            g, _ = net.step([t for t, _ in picked], np.array([y for _, y in picked], np.float32), rng)
            turn += 1
            scale = rate * (0.3 if epoch == epochs - 1 else 1) * np.sqrt(1 - 0.999**turn) / (1 - 0.9**turn)
            for k in net.p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] * g[k] - v[k])
                net.p[k] -= (scale * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
                if k in ("word", "char"):
                    net.p[k] *= 1 - DECAY
    return net
