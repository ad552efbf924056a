"""A bidirectional LSTM in numpy that labels every element of a sequence."""

from __future__ import annotations

import numpy as np

HIDDEN, PROJECTED = 16, 24
EPOCHS, RATE, BATCH = 14, 0.01, 32


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _pad(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as (step, sequence, ...), and which steps are real."""
    longest = max(len(s) for s in sequences)
    out = np.zeros((longest, len(sequences), *sequences[0].shape[1:]), np.float32)
    real = np.zeros((longest, len(sequences)), np.float32)
    for i, s in enumerate(sequences):
        out[: len(s), i] = s
        real[: len(s), i] = 1
    return out, real


class BiLstm:
    """Input, projection, one LSTM each way, and a logistic output per step."""

    def __init__(self, size: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        gates = 4 * HIDDEN
        forget = np.zeros(gates)
        forget[HIDDEN: 2 * HIDDEN] = 1
        self.p: dict[str, np.ndarray] = {"in": rng.normal(0, size**-0.5, (size, PROJECTED)), "in0": np.zeros(PROJECTED)}
        for way in "fb":
            self.p |= {
                f"{way}x": rng.normal(0, PROJECTED**-0.5, (PROJECTED, gates)),
                f"{way}h": rng.normal(0, HIDDEN**-0.5, (HIDDEN, gates)), f"{way}0": forget.copy()}
        self.p |= {"out": rng.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, 1)), "out0": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _one_way(self, way: str, z: np.ndarray, real: np.ndarray, kept: list | None) -> np.ndarray:
        gates_x = z @ self.p[f"{way}x"] + self.p[f"{way}0"]
        h = c = np.zeros((z.shape[1], HIDDEN), np.float32)
        out = np.zeros((*z.shape[:2], HIDDEN), np.float32)
        for t in range(len(z)) if way == "f" else reversed(range(len(z))):
            gates = gates_x[t] + h @ self.p[f"{way}h"]
            sig = _sigmoid(gates[:, : 3 * HIDDEN])
            i, f, o = sig[:, :HIDDEN], sig[:, HIDDEN: 2 * HIDDEN], sig[:, 2 * HIDDEN:]
            g = np.tanh(gates[:, 3 * HIDDEN:])
            on = real[t][:, None]
            if kept is not None:
                kept.append((t, i, f, o, g, c, h))
            c = on * (f * c + i * g)
            h = on * (o * np.tanh(c))
            out[t] = h
        return out

    def margins(self, x: np.ndarray, real: np.ndarray) -> np.ndarray:
        return self._margins(x @ self.p["in"], real)

    def _margins(self, projected: np.ndarray, real: np.ndarray) -> np.ndarray:
        z = np.tanh(projected + self.p["in0"])
        h = np.concatenate([self._one_way(w, z, real, None) for w in "fb"], axis=2)
        return (h @ self.p["out"] + self.p["out0"])[..., 0]

    def label(self, sequences: list, batch: int = 256, steps: int = 60_000) -> list[np.ndarray]:
        """For every sequence, which of its elements belong to the class (empty ones too).

        A sequence is rows of numbers, or has ``times(weights)`` and a length. Sequences of like length are
        read together, at most ``steps`` steps with the padding; a longer one is read alone.
        """
        out = [np.zeros(0, bool)] * len(sequences)
        order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: len(sequences[i]))
        while order:
            own = [order.pop()]                 # the longest left
            while order and len(own) < batch and (len(own) + 1) * len(sequences[own[0]]) <= steps:
                own.append(order.pop())
            weights = self.p["in"]
            x, real = _pad([s.times(weights) if hasattr(s, "times") else s @ weights for s in (sequences[i] for i in own)])
            margin = self._margins(x, real)
            for k, i in enumerate(own):
                out[i] = margin[: len(sequences[i]), k] > 0
        return out

    def _gradients(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        z = np.tanh(x @ p["in"] + p["in0"])
        kept: dict[str, list] = {"f": [], "b": []}
        h = np.concatenate([self._one_way(w, z, real, kept[w]) for w in "fb"], axis=2)
        margin = (h @ p["out"] + p["out0"])[..., 0]
        d = ((_sigmoid(margin) - y) * real / real.sum())[..., None]
        grads = {"out": h.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, 1), "out0": d.sum((0, 1))}
        dh_all = d @ p["out"].T
        dz = np.zeros_like(z)
        for w, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            dh = dc = np.zeros((z.shape[1], HIDDEN), np.float32)
            gx = np.zeros((*z.shape[:2], 4 * HIDDEN), np.float32)
            gh = np.zeros_like(p[f"{w}h"])
            for t, i, f, o, g, c0, h0 in reversed(kept[w]):
                on = real[t][:, None]
                c = on * (f * c0 + i * g)
                tc = np.tanh(c)
                dh = (dh + dh_all[t][:, part]) * on
                dct = (dc + dh * o * (1 - tc * tc)) * on
                gates = np.concatenate(
                    [dct * g * i * (1 - i), dct * c0 * f * (1 - f), dh * tc * o * (1 - o), dct * i * (1 - g * g)], axis=1)
                gx[t] = gates
                gh += h0.T @ gates
                dh = gates @ p[f"{w}h"].T
                dc = dct * f
            flat = gx.reshape(-1, 4 * HIDDEN)
            grads |= {f"{w}x": z.reshape(-1, PROJECTED).T @ flat, f"{w}h": gh, f"{w}0": flat.sum(0)}
            dz += gx @ p[f"{w}x"].T
        dz *= 1 - z * z
        flat = dz.reshape(-1, PROJECTED)
        return grads | {"in": x.reshape(-1, x.shape[2]).T @ flat, "in0": flat.sum(0)}

    def train(self, sequences: list, labels: list[np.ndarray], seed: int = 0) -> None:
        """Adam on the mean logistic loss per element; without sequences nothing changes."""
        order = [i for i in range(len(sequences)) if len(sequences[i])]
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(EPOCHS if order else 0):
            mixed = sorted(rng.permutation(order), key=lambda i: len(sequences[i]) // 8)
            batches = [mixed[a: a + BATCH] for a in range(0, len(mixed), BATCH)]
            for k in rng.permutation(len(batches)):
                x, real = _pad([s.dense() if hasattr(s, "dense") else s for s in (sequences[i] for i in batches[k])])
                y, _ = _pad([labels[i].astype(np.float32) for i in batches[k]])
                step += 1
                for name, g in self._gradients(x, real, y).items():
                    g = np.clip(g, -1, 1)
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.001 * (g * g - second[name])
                    self.p[name] = (self.p[name] - RATE * (first[name] / (1 - 0.9**step)) / (
                        np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
