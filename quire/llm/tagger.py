"""A character-level bidirectional LSTM with a CRF on top, in numpy.

Trained from labelled spans: sentences of made-up words with made-up personal data
in several spellings, and look-alikes (numbers, versions, dates, hexadecimal keys)
without labels. The random generator is seeded, so every training gives the same model.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: 0 is outside; kind i begins with tag 2 i + 1 and goes on with 2 i + 2.
TAGS = 2 * len(KINDS) + 1
SYMBOLS = 100
EMBED, HIDDEN = 12, 20
WINDOW, STRIDE = 64, 32

_CODE = np.full(0x110000, 98, np.uint8)  # other characters
_CODE[0x20:0x7F] = np.arange(95)
_CODE[[0x0A, 0x0D]] = 95
_CODE[[0x09, 0xA0]] = 96
_CODE[0xC0:0x250] = 97  # letters with marks
PAD = 99


def codes(text: str) -> np.ndarray:
    return _CODE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def examples(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts with (kind, start, end) spans."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    num = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))

    def word() -> str:
        return "".join(pick("aaabcdeeefghiiijklmnooprstuuvwyz" + "éèäöüñçß") for _ in range(int(rng.integers(1, 11))))

    def email() -> str:
        at = pick(["@"] * 6 + [" @ ", " @", "@ ", "(@)", "[@]"])
        return f"{word()}{pick(['.', '_', '-', ''])}{pick([num(2), word(), ''])}{at}{word()}{pick(['', num(1)])}.{pick(['example.com', 'com', 'org', 'net', 'co.uk', 'de'])}"

    def ip() -> str:
        dot = pick(["."] * 7 + [" . ", "[.]", " ."])
        return dot.join(str(x) for x in rng.integers(0, 256, 4))

    def card() -> str:
        gap = pick(["", "", "", " ", "-", ".", "  "])
        return gap.join((pick("3456") + num(3), num(4), num(4), num(4)))

    def phone() -> str:
        s = pick([" ", "-", ".", " ", "\n"])
        return pick([
            f"+1 ({num(3)}) {num(3)}-{num(4)}", f"+1 ({num(3)}){s}{num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"+{num(2)}{s}{num(3)}{s}{num(3)}{s}{num(4)}",
            f"{num(3)}-{num(3)}-{num(4)}", f"+1{s}({num(3)}) {num(3)}{s}{num(4)}", f"00{num(2)} {num(3)} {num(7)}",
        ])

    def other() -> str:
        hexa = "".join(pick("0123456789abcdef") for _ in range(40))
        return pick([
            f'token = "{hexa}"', hexa, f"version {num(1)}.{num(1)}", f"{num(1)}.{num(2)}.{num(1)}", f"20{num(2)}-0{pick('123456789')}-1{num(1)}", num(int(rng.integers(1, 13))), f"{num(2)}%",
            f"${num(3)}.{num(2)}", f"CC BY-NC {num(1)}.0", f"@{word()}", f"{num(2)}:{num(2)}", f"{num(1)},{num(3)},{num(3)}", f"({num(1)})", num(21), f"- {num(1)}. {word()}",
        ])

    makers, out = (email, ip, card, phone), []
    for _ in range(n):
        text, spans = "", []
        while len(text) < WINDOW:
            what = rng.random()
            if what < 0.25:
                kind = int(rng.integers(len(makers)))
                s = makers[kind]()
                spans.append((kind, len(text), len(text) + len(s)))
                text += s
            elif what < 0.36:
                text += other()
            else:
                text += (word().upper() if what < 0.4 else word().capitalize() if what < 0.5 else word())
            text += pick([" "] * 8 + [". ", ", ", "\n", "!! ", " | ", "### "])
        at = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
        out.append((text[at : at + WINDOW], [(k, max(0, s - at), min(WINDOW, e - at)) for k, s, e in spans if s < at + WINDOW and e > at]))
    return out


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Tagger:
    """Weights and the passes over batches of windows, shape (windows, WINDOW) of character codes."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f = lambda *s, by: (rng.normal(size=s) * by).astype(np.float32)
        self.p = {
            "embed": f(SYMBOLS, EMBED, by=0.5),
            "w": f(2, EMBED, 4 * HIDDEN, by=EMBED**-0.5),
            "u": f(2, HIDDEN, 4 * HIDDEN, by=HIDDEN**-0.5),
            "b": np.zeros((2, 1, 4 * HIDDEN), np.float32),
            "out": f(2 * HIDDEN, TAGS, by=(2 * HIDDEN) ** -0.5),
            "bias": np.zeros(TAGS, np.float32),
            "move": f(TAGS, TAGS, by=0.1),
        }
        self.p["b"][:, :, HIDDEN : 2 * HIDDEN] = 1

    def _lstm(self, x: np.ndarray, keep: bool = False):
        """Hidden states (2, T, B, H): direction 1 reads from the end, and is stored in its own order."""
        p, (b, t) = self.p, x.shape
        table = p["embed"] @ p["w"] + p["b"]  # (2, symbols, 4 H)
        both = np.stack([x.T, x.T[::-1]])
        h, c = np.zeros((2, b, HIDDEN), np.float32), np.zeros((2, b, HIDDEN), np.float32)
        out, tape = np.empty((2, t, b, HIDDEN), np.float32), []
        for i in range(t):
            z = np.stack([table[0][both[0, i]], table[1][both[1, i]]]) + h @ p["u"]
            s = _sigmoid(z[..., : 3 * HIDDEN])
            g = np.tanh(z[..., 3 * HIDDEN :])
            old = c
            c = s[..., HIDDEN : 2 * HIDDEN] * c + s[..., :HIDDEN] * g
            tc = np.tanh(c)
            if keep:
                tape.append((h, old, s, g, tc))
            h = s[..., 2 * HIDDEN :] * tc
            out[:, i] = h
        return out, both, tape

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(windows, T, tags) scores."""
        h, _, _ = self._lstm(x)
        return self._emit(h)[0]

    def _emit(self, h):
        both = np.concatenate([h[0], h[1][::-1]], axis=2).transpose(1, 0, 2)
        return both @ self.p["out"] + self.p["bias"], both

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        p, (b, t) = self.p, x.shape
        h, read, tape = self._lstm(x, keep=True)
        e, both = self._emit(h)
        move = p["move"]
        # forward and backward sums of the CRF
        f, g = np.empty_like(e), np.zeros_like(e)
        f[:, 0] = e[:, 0]
        for i in range(1, t):
            f[:, i] = e[:, i] + _log_sum(f[:, i - 1, :, None] + move, 1)
        for i in range(t - 2, -1, -1):
            g[:, i] = _log_sum(move + (e[:, i + 1] + g[:, i + 1])[:, None, :], 2)
        total = _log_sum(f[:, -1], 1)
        rows, at = np.arange(b)[:, None], np.arange(t)[None, :]
        loss = float((total - e[rows, at, y].sum(1) - move[y[:, :-1], y[:, 1:]].sum(1)).mean())
        de = np.exp(f + g - total[:, None, None])
        de[rows, at, y] -= 1
        de /= b
        dmove = np.zeros_like(move)
        for i in range(1, t):
            dmove += np.exp(f[:, i - 1, :, None] + move + (e[:, i] + g[:, i])[:, None, :] - total[:, None, None]).sum(0)
        np.add.at(dmove, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        d = {"move": dmove / b, "out": both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS), "bias": de.sum((0, 1))}
        dboth = (de @ p["out"].T).transpose(1, 0, 2)
        dh_out = np.stack([dboth[..., :HIDDEN], dboth[::-1, :, HIDDEN:]])
        du, dtable = np.zeros_like(p["u"]), np.zeros((2, SYMBOLS, 4 * HIDDEN), np.float32)
        dh, dc = np.zeros((2, b, HIDDEN), np.float32), np.zeros((2, b, HIDDEN), np.float32)
        for i in range(t - 1, -1, -1):
            before, old, s, gate, tc = tape[i]
            dh = dh + dh_out[:, i]
            into, forget, show = s[..., :HIDDEN], s[..., HIDDEN : 2 * HIDDEN], s[..., 2 * HIDDEN :]
            dc = dc + dh * show * (1 - tc * tc)
            dz = np.concatenate([dc * gate * into * (1 - into), dc * old * forget * (1 - forget), dh * tc * show * (1 - show), dc * into * (1 - gate * gate)], 2)
            du += before.transpose(0, 2, 1) @ dz
            for k in (0, 1):
                np.add.at(dtable[k], read[k, i], dz[k])
            dh, dc = dz @ p["u"].transpose(0, 2, 1), dc * forget
        d |= {"u": du, "b": dtable.sum(1, keepdims=True), "w": p["embed"].T @ dtable, "embed": (dtable @ p["w"].transpose(0, 2, 1)).sum(0)}
        return loss, d

    def decode(self, e: np.ndarray) -> np.ndarray:
        """The best tags (windows, T) for emissions, by Viterbi."""
        b, t, n = e.shape
        back, best = np.empty((t, b, n), np.int8), e[:, 0]
        for i in range(1, t):
            s = best[:, :, None] + self.p["move"]
            back[i] = s.argmax(1)
            best = s.max(1) + e[:, i]
        out = np.empty((b, t), np.int8)
        out[:, -1] = best.argmax(1)
        for i in range(t - 1, 0, -1):
            out[:, i - 1] = back[i][np.arange(b), out[:, i]]
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def labelled(rows) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.full((len(rows), WINDOW), PAD, np.uint8), np.zeros((len(rows), WINDOW), np.int64)
    for i, (text, spans) in enumerate(rows):
        x[i, : len(text)] = codes(text)
        for kind, s, e in spans:
            y[i, s:e] = 2 * kind + 2
            y[i, s] = 2 * kind + 1
    return x, y


class _OfProcess(dict):
    """What each process trains for itself: pickled with a function, it arrives empty."""

    def __reduce__(self):
        return _OfProcess, ()


_trained = _OfProcess()


def train(n: int = 3000, rounds: int = 12, batch: int = 150, rate: float = 0.02, seed: int = 7) -> Tagger:
    """Adam on the CRF's log likelihood; kept for the rest of the process."""
    if (key := (n, rounds, batch, rate, seed)) in _trained:
        return _trained[key]
    x, y = labelled(examples(n, seed))
    t, rng = Tagger(seed), np.random.default_rng(seed)
    m1 = {k: np.zeros_like(v) for k, v in t.p.items()}
    m2 = {k: np.zeros_like(v) for k, v in t.p.items()}
    step, steps = 0, rounds * (n // batch)
    for _ in range(rounds):
        order = rng.permutation(n)
        for lo in range(0, n - batch + 1, batch):
            rows = order[lo : lo + batch]
            _, d = t.gradient(x[rows], y[rows])
            step += 1
            norm = np.sqrt(sum(float((g**2).sum()) for g in d.values()))
            now = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps)
            for k, g in d.items():
                g = g * min(1.0, 5 / (norm + 1e-9))
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.98 * m2[k] + 0.02 * g * g
                t.p[k] = (t.p[k] - now * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.98**step)) + 1e-8)).astype(np.float32)
    _trained[key] = t
    return t
