"""Personal data: rules, and a character BiLSTM with CRF transitions beside them.

The rules find well-formed addresses and numbers. The model reads characters in both
directions, scores tags (outside, or begin / inside of a kind) and a CRF decodes the best
allowed sequence; it adds spans that the rules' patterns do not cover. It is trained here
in numpy, from labelled spans.

Texts are read in cells of CELL characters; each cell lies in two overlapping windows, which
see it with context on different sides. Their scores are added, weighted by the distance to
the window's edge, and one Viterbi search runs over each whole stretch of cells, so windows
that disagree are reconciled over the stretch and no border cuts a span.

Every span that can be added holds a digit, an at sign or the word "at" between blanks
(``spans_of`` asks for it), so cells further than REACH characters from all of these are
outside of every span and are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base rules.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    # Matches only start where digits start, which keeps the search linear in long numbers.
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _holds(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in found.split("."))
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


_AT_OR_DIGIT = re.compile("[0-9@]")
_ADDRESS = re.compile(r"@")


def base_spans(text: str) -> list[Span]:
    """Spans of the rules by kind, then start."""
    out = []
    if not _AT_OR_DIGIT.search(text):
        return out
    for kind in KINDS:
        if kind == "email":
            out += _emails(text)
            continue
        for m in PATTERNS[kind].finditer(text):
            if _holds(kind, m.group()):
                out.append((kind, m.start(), m.end()))
    return out


def _emails(text: str) -> list[Span]:
    """The email pattern around each at sign, so that long runs without one cost nothing."""
    out, done = [], 0
    for m in _ADDRESS.finditer(text):
        at = m.start()
        if at < done:
            continue
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at and (found := PATTERNS["email"].match(text, start)):
            out.append(("email", found.start(), found.end()))
            done = found.end()
    return out


# --- the tagger -------------------------------------------------------------------------

CELL = 48  # characters
WINDOW = 2 * CELL
REACH = 64  # characters around a digit or at sign that are read
HIDDEN = 20
EMBED = 12
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
SURE = 0.9  # least mean tag probability of an added span
SEED = 7

_ALPHABET = "@.+-()_% :=,\"'/#"


def codes(text: str) -> np.ndarray:
    """A small number per character: one per ASCII letter, digit and listed sign."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _SYMBOL[np.minimum(c, 128)]


_SYMBOL = np.full(129, 1, np.uint8)  # other signs
_SYMBOL[128] = 2  # beyond ASCII
_SYMBOL[[9, 10, 13]] = 3
_SYMBOL[[ord(ch) for ch in _ALPHABET]] = 4 + np.arange(len(_ALPHABET))
_PLAIN = [*range(48, 58), *range(65, 91), *range(97, 123)]
_SYMBOL[_PLAIN] = 4 + len(_ALPHABET) + np.arange(len(_PLAIN))

SYMBOLS = 4 + len(_ALPHABET) + len(_PLAIN)  # 0 pads


def _allowed() -> np.ndarray:
    """Transitions a tag sequence may have: inside follows begin or inside of its kind."""
    ok = np.zeros((len(TAGS), len(TAGS)), bool)
    for i, a in enumerate(TAGS):
        for j, b in enumerate(TAGS):
            ok[i, j] = b[0] != "I" or a[1:] == b[1:]
    return ok


ALLOWED = _allowed()
START = np.array([t[0] != "I" for t in TAGS])
NEVER = -1e4


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """Parameters and passes of the network; everything is a batch of equal windows."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.w = {"emb": r.normal(0, 0.3, (SYMBOLS, EMBED))}
        for side in "fb":
            self.w[f"x{side}"] = r.normal(0, 1 / np.sqrt(EMBED), (EMBED, 4 * HIDDEN))
            self.w[f"h{side}"] = r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.w[f"b{side}"] = bias
        self.w["out"] = r.normal(0, 1 / np.sqrt(2 * HIDDEN), (2 * HIDDEN, len(TAGS)))
        self.w["bias"] = np.zeros(len(TAGS))
        self.w["move"] = np.zeros((len(TAGS), len(TAGS)))

    def _direction(self, side: str, e: np.ndarray, keep: bool):
        n, t, _ = e.shape
        x = e @ self.w[f"x{side}"] + self.w[f"b{side}"]
        h, c = np.zeros((2, n, HIDDEN), e.dtype)
        out, held = np.empty((n, t, HIDDEN), e.dtype), []
        for k in range(t) if side == "f" else range(t - 1, -1, -1):
            g = x[:, k] + h @ self.w[f"h{side}"]
            i, f, o = (sigmoid(g[:, s * HIDDEN : (s + 1) * HIDDEN]) for s in (0, 1, 2))
            u = np.tanh(g[:, 3 * HIDDEN :])
            before_c, before_h = c, h
            c = f * c + i * u
            tc = np.tanh(c)
            h = o * tc
            out[:, k] = h
            if keep:
                held.append((k, i, f, o, u, tc, before_c, before_h))
        return out, held

    def scores(self, s: np.ndarray, keep: bool = False):
        e = self.w["emb"][s]
        (hf, kf), (hb, kb) = self._direction("f", e, keep), self._direction("b", e, keep)
        h = np.concatenate([hf, hb], axis=2)
        return h @ self.w["out"] + self.w["bias"], (e, h, kf, kb)

    def read(self, s: np.ndarray) -> np.ndarray:
        """As ``scores`` without what training needs, in single precision."""
        n, t = s.shape
        s, sides, H = np.ascontiguousarray(s.T), [], HIDDEN
        # A logistic gate is a hyperbolic tangent of half its input. Rows are units, so that
        # every gate is one contiguous block.
        half = np.repeat([0.5, 0.5, 0.5, 1.0], H)
        for side in "fb":
            x = ((self.w["emb"] @ self.w[f"x{side}"] + self.w[f"b{side}"]) * half).T.astype(np.float32)
            back = np.ascontiguousarray((self.w[f"h{side}"] * half).T, np.float32)
            h, c = np.zeros((2, H, n), np.float32)
            out = np.empty((t, H, n), np.float32)
            for k in range(t) if side == "f" else range(t - 1, -1, -1):
                g = np.take(x, s[k], axis=1)
                g += back @ h
                np.tanh(g, out=g)
                gate = g[: 3 * H]
                gate *= 0.5
                gate += 0.5
                c *= gate[H : 2 * H]
                c += gate[:H] * g[3 * H :]
                h = np.tanh(c, out=out[k])
                h *= gate[2 * H :]
            sides.append(out)
        w = self.w["out"].T.astype(np.float32)
        score = w[:, :H] @ sides[0] + w[:, H:] @ sides[1]
        return score.transpose(2, 0, 1) + self.w["bias"].astype(np.float32)

    def chances(self, score: np.ndarray) -> np.ndarray:
        """Tag probabilities as of ``marginals``, by scaled sums of products."""
        n, t, m = score.shape
        move = np.exp(self.moves()).astype(np.float32)
        e = np.exp(score - score.max(2, keepdims=True)).transpose(1, 2, 0).astype(np.float32)
        a, b = np.empty_like(e), np.ones_like(e)
        a[0] = e[0] * START[:, None]
        for k in range(1, t):
            a[k] = (move.T @ a[k - 1]) * e[k]
            a[k] /= a[k].sum(0)
        for k in range(t - 2, -1, -1):
            b[k] = move @ (b[k + 1] * e[k + 1])
            b[k] /= b[k].sum(0)
        a *= b
        a /= a.sum(1, keepdims=True)
        return a.transpose(2, 0, 1)

    def moves(self) -> np.ndarray:
        return np.where(ALLOWED, self.w["move"], self.w["move"].dtype.type(NEVER))

    def marginals(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tag probabilities, expected transitions and log of the sum over all sequences."""
        n, t, _ = score.shape
        move = self.moves()
        a, b = np.empty_like(score), np.zeros_like(score)
        a[:, 0] = score[:, 0] + np.where(START, 0, NEVER)
        for k in range(1, t):
            a[:, k] = score[:, k] + _lse(a[:, k - 1, :, None] + move, 1)
        for k in range(t - 2, -1, -1):
            b[:, k] = _lse(move + (score[:, k + 1] + b[:, k + 1])[:, None, :], 2)
        z = _lse(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None])
        pairs = np.zeros_like(move)
        for k in range(1, t):
            pairs += np.exp(a[:, k - 1, :, None] + move + (score[:, k] + b[:, k])[:, None, :] - z[:, None, None]).sum(0)
        return p, pairs, z

    def decode(self, score: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window."""
        n, t, _ = score.shape
        move = self.moves()
        best, back = score[:, 0] + np.where(START, 0, NEVER), []
        for k in range(1, t):
            both = best[:, :, None] + move
            back.append(both.argmax(1))
            best = both.max(1) + score[:, k]
        path = np.empty((n, t), np.int64)
        path[:, -1] = best.argmax(1)
        for k in range(t - 2, -1, -1):
            path[:, k] = back[k][np.arange(n), path[:, k + 1]]
        return path

    def _cells(self, score: np.ndarray, keep: bool) -> tuple[np.ndarray, list[np.ndarray]]:
        """Best scores (tag before the cell, its last tag, cell), and the way back."""
        move = self.moves().astype(score.dtype)
        score = np.ascontiguousarray(score.transpose(1, 2, 0))  # one line of cells per tag
        best, ways = move[:, :, None] + score[0], []
        before = [np.flatnonzero(ALLOWED[:, j]) for j in range(len(TAGS))]
        for k in range(1, len(score)):
            now, way = np.empty_like(best), np.empty(best.shape, np.int8)
            for j, froms in enumerate(before):
                top = best[:, froms[0]] + move[froms[0], j]
                if keep:
                    way[:, j] = froms[0]
                for i in froms[1:]:
                    other = best[:, i] + move[i, j]
                    if keep:
                        way[:, j][other > top] = i
                    np.maximum(top, other, out=top)
                now[:, j] = top + score[k, j]
            best = now
            if keep:
                ways.append(way)
        return best, ways

    def decode_long(self, score: np.ndarray, block: int = 2048) -> np.ndarray:
        """The best tag sequence of one long stretch, given by cells (cells, CELL, tags).

        Cells are solved side by side for every tag before them, then chained: the result of
        ``decode`` on the stretch, without a step per character.
        """
        n, t, m = score.shape
        # Before the stretch stands a cell of tag O with free moves into the first tag.
        score = score.copy()
        score[0, 0] += np.where(START, 0, NEVER) - self.moves()[0]
        came = np.zeros((n, m), np.int8)
        v = np.where(np.arange(m) == 0, 0, NEVER).astype(np.float64)
        for lo in range(0, n, block):
            best = self._cells(score[lo : lo + block], keep=False)[0].transpose(2, 0, 1)
            for k, own in enumerate(best, start=lo):
                both = v[:, None] + own
                came[k], v = both.argmax(0), both.max(0)
        ends = np.zeros(n + 1, np.int8)  # ends[0] stands before the stretch
        ends[n] = v.argmax()
        for k in range(n, 0, -1):
            ends[k - 1] = came[k - 1, ends[k]]
        path = np.empty((n, t), np.int64)
        for lo in range(0, n, block):
            part = path[lo : lo + block]
            _, back = self._cells(score[lo : lo + block], keep=True)
            rows, before = np.arange(len(part)), ends[lo : lo + len(part)]
            part[:, -1] = ends[lo + 1 : lo + 1 + len(part)]
            for k in range(t - 2, -1, -1):
                part[:, k] = back[k][before, part[:, k + 1], rows]
        return path

    def gradients(self, s: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags ``y`` and its gradients."""
        n, t = s.shape
        score, (e, h, kf, kb) = self.scores(s, keep=True)
        p, pairs, z = self.marginals(score)
        rows, at = np.arange(n)[:, None], np.arange(t)
        gold = score[rows, at, y].sum(1) + self.moves()[y[:, :-1], y[:, 1:]].sum(1)
        d = p.copy()
        d[rows, at, y] -= 1
        d /= n
        seen = np.zeros_like(pairs)
        np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        g = {"move": np.where(ALLOWED, pairs - seen, 0) / n, "bias": d.sum((0, 1))}
        g["out"] = h.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, len(TAGS))
        dh = d @ self.w["out"].T
        de = np.zeros_like(e)
        for side, held, part in (("f", kf, dh[:, :, :HIDDEN]), ("b", kb, dh[:, :, HIDDEN:])):
            dx = np.empty((n, t, 4 * HIDDEN), e.dtype)
            dn, dc = np.zeros((2, n, HIDDEN), e.dtype)
            gh = np.zeros_like(self.w[f"h{side}"])
            for k, i, f, o, u, tc, c0, h0 in reversed(held):
                up = part[:, k] + dn
                dc = dc + up * o * (1 - tc**2)
                gates = np.concatenate([dc * u * i * (1 - i), dc * c0 * f * (1 - f), up * tc * o * (1 - o), dc * i * (1 - u**2)], axis=1)
                dx[:, k] = gates
                gh += h0.T @ gates
                dn, dc = gates @ self.w[f"h{side}"].T, dc * f
            g[f"h{side}"] = gh
            g[f"x{side}"] = e.reshape(-1, EMBED).T @ dx.reshape(-1, 4 * HIDDEN)
            g[f"b{side}"] = dx.sum((0, 1))
            de += dx @ self.w[f"x{side}"].T
        g["emb"] = np.zeros_like(self.w["emb"])
        np.add.at(g["emb"], s, de)
        return float((z - gold).mean()), g


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def fit(s: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.015, seed: int = SEED) -> Tagger:
    """A tagger fitted by Adam to windows ``s`` and their tags ``y``."""
    tagger, r = Tagger(seed), np.random.default_rng(seed)
    tagger.w = {k: v.astype(np.float32) for k, v in tagger.w.items()}
    m1 = {k: np.zeros_like(v) for k, v in tagger.w.items()}
    m2 = {k: np.zeros_like(v) for k, v in tagger.w.items()}
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(s))
        for at in range(0, len(s), batch):
            own = order[at : at + batch]
            _, g = tagger.gradients(s[own], y[own])
            step += 1
            norm = np.sqrt(sum((v**2).sum() for v in g.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            for k, v in g.items():
                v = v * scale
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.99 * m2[k] + 0.01 * v * v
                tagger.w[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)
    return tagger


# --- labelled spans ---------------------------------------------------------------------

EXAMPLES = 1200


def labelled(n: int = EXAMPLES, seed: int = SEED) -> list[tuple[str, list[Span]]]:
    """Sentences with marked spans: values of each kind in common spellings, in running text
    beside numbers that are none of them (dates, amounts, versions, hashes, keys)."""
    r = np.random.default_rng(seed)
    digits = lambda k: "".join(map(str, r.integers(0, 10, k)))
    word = lambda a=2, b=9: "".join(chr(97 + x) for x in r.integers(0, 26, r.integers(a, b)))
    pick = lambda *x: x[r.integers(len(x))]

    def email():
        return f"{word()}{pick('.', '_', '-', '')}{pick(word(), digits(2))}{pick('@', '@', '@', ' @ ', ' at ')}{word()}{pick('', digits(1))}.{pick('com', 'org', 'net', 'example.com', 'de', 'co.uk')}"

    def ip():
        return ".".join(str(x) for x in r.integers(0, 256, 4))

    def card():
        d = pick("4", "5") + digits(14)
        d += next(str(k) for k in range(10) if luhn(d + str(k)))
        return pick("", " ", "-", ".").join(d[i : i + 4] for i in range(0, 16, 4))

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        return pick(f"+1 ({a}) {b}-{c}", f"+{digits(2)} {a} {b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1.{a}.{b}.{c}", f"00{digits(2)} {a} {b} {c}")

    def other():
        return pick(
            f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(2)}:{digits(2)}", f"${digits(3)}.{digits(2)}", f"v{digits(1)}.{digits(1)}.{digits(1)}",
            digits(int(r.integers(1, 8))), f"password={''.join(pick(*'0123456789abcdef') for _ in range(18))}", f"@{word()}",
            f"AKIA{''.join(pick(*'ABCDEFGHJKLMNPQR234567') for _ in range(16))}", f"token = \"{''.join(pick(*'0123456789abcdef') for _ in range(32))}\"",
            f"p. {digits(3)}", f"{digits(2)}%", f"§ {digits(2)}", f"{digits(16)}", f"{word()}{digits(2)}", f"Version {digits(1)}.{digits(1)}", f"https://{word()}.com/{digits(4)}",
        )

    make = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(int(r.integers(3, 7))):
            for _ in range(int(r.integers(2, 6))):
                text += pick(word, lambda: word().capitalize(), lambda: word() + ",", lambda: word() + ".")() + pick(" ", " ", " ", "\n")
            kind = pick(*KINDS, None, None)
            value = make[kind]() if kind else other()
            if kind:
                spans.append((kind, len(text), len(text) + len(value)))
            text += value + pick(" ", ". ", ", ", "\n")
        out.append((text, spans))
    return out


def windows_of(examples: list[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    """Training windows and tags; texts are cut at WINDOW characters and padded."""
    s, y = [], []
    for text, spans in examples:
        tags = np.zeros(len(text), np.int64)
        for kind, a, b in spans:
            tags[a:b] = TAGS.index(f"I-{kind}")
            tags[a] = TAGS.index(f"B-{kind}")
        own = codes(text)
        for at in range(0, len(text), CELL):
            part, t = own[at : at + WINDOW], tags[at : at + WINDOW].copy()
            if t[0] and TAGS[t[0]][0] == "I":  # a span cut by the window's start
                t[0] -= 1
            s.append(np.pad(part, (0, WINDOW - len(part))))
            y.append(np.pad(t, (0, WINDOW - len(t))))
    return np.array(s), np.array(y)


@cache
def trained() -> Tagger:
    return fit(*windows_of(labelled()))


# --- reading whole texts ----------------------------------------------------------------

_AT = re.compile(" at ")
# Weights of a cell's characters in the window that ends with it and in the one that starts
# with it; they add up to 1.
_FALLING = (CELL - np.arange(CELL, dtype=np.float32)) / (CELL + 1)
_SHORT = 8  # cells; stretches up to here are decoded in batches of equal length


def cells_to_read(text: str, own: np.ndarray) -> np.ndarray:
    """Numbers of the cells within REACH of a digit, an at sign or the word "at"."""
    if not len(own):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(_TRIGGER[own])
    at = np.concatenate([at, np.array([m.start() for m in _AT.finditer(text)], np.int64)])
    last = (len(own) - 1) // CELL
    step = np.zeros(last + 2, np.int64)
    np.add.at(step, np.maximum(at - REACH, 0) // CELL, 1)
    np.add.at(step, np.minimum((at + REACH) // CELL, last) + 1, -1)
    return np.flatnonzero(np.cumsum(step)[:-1])


_TRIGGER = np.zeros(SYMBOLS, bool)
_TRIGGER[codes("0123456789@")] = True


def _of_windows(padded: np.ndarray, cells: np.ndarray, score, tags: int, batch: int = 512) -> np.ndarray:
    """Weighted sums per cell of what ``score`` gives for the two windows around it.

    ``padded`` are codes with a cell of padding before each text and two behind it, ``cells``
    are ascending cell numbers in it; window k holds cells k and k + 1.
    """
    out = np.zeros((len(cells), CELL, tags), np.float32)
    windows = np.union1d(cells - 1, cells)
    for lo in range(0, len(windows), batch):
        k = windows[lo : lo + batch]
        got = score(padded[(k * CELL)[:, None] + np.arange(WINDOW)])
        for shift, weight, half in ((0, 1 - _FALLING, got[:, :CELL]), (1, _FALLING, got[:, CELL:])):
            place = np.searchsorted(cells, k + shift)
            place[place == len(cells)] = 0
            there = cells[place] == k + shift
            out[place[there]] += half[there] * weight[:, None]
    return out


def tag_texts(texts: list[str], tagger: Tagger, characters: int = 1 << 18) -> list[list[Span]]:
    """Spans of the tagger in each text, decoded over the whole text; several texts of
    together ``characters`` are read at once."""
    out: list[list[Span]] = []
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= characters:
            out += _tag_some(held, tagger)
            held, size = [], 0
    return out + _tag_some(held, tagger)


def _tag_some(texts: list[str], tagger: Tagger) -> list[list[Span]]:
    own, starts, cells, at = [], [], [], 0
    for text in texts:
        c = codes(text)
        room = -(-len(c) // CELL) + 3  # one cell of padding before the text, two behind it
        own.append(np.pad(c, (CELL, room * CELL - CELL - len(c))))
        starts.append(at)
        cells.append(cells_to_read(text, c) + at + 1)
        at += room
    if not texts or not (n := sum(map(len, cells))):
        return [[] for _ in texts]
    flat, all_cells = np.concatenate(own), np.concatenate(cells)
    score = _of_windows(flat, all_cells, tagger.read, len(TAGS))
    score[flat.reshape(-1, CELL)[all_cells] == 0] = np.where(np.arange(len(TAGS)) == 0, 0, NEVER)
    tags = np.zeros((n, CELL), np.int64)
    edges = np.flatnonzero(np.r_[True, np.diff(all_cells) > 1, True])
    lengths = np.diff(edges)
    for k in np.unique(lengths):
        runs = edges[:-1][lengths == k]
        if k > _SHORT:
            for a in runs:
                tags[a : a + k] = tagger.decode_long(score[a : a + k])
        else:
            rows = runs[:, None] + np.arange(k)
            tags[rows] = tagger.decode(score[rows].reshape(len(runs), k * CELL, -1)).reshape(len(runs), k, CELL)
    # Probabilities are only needed where something was found.
    some = np.flatnonzero(tags.any(1))
    sure = np.ones((n, CELL), np.float32)
    if len(some):
        p = _of_windows(flat, all_cells[some], lambda s: tagger.chances(tagger.read(s)), len(TAGS))
        sure[some] = np.take_along_axis(p, tags[some][:, :, None], 2)[:, :, 0]
    out, lo = [], 0
    for text, start, mine in zip(texts, starts, cells):
        part = slice(lo, lo + len(mine))
        lo += len(mine)
        if not tags[part].any():
            out.append([])
            continue
        t, q = np.zeros((-(-len(text) // CELL), CELL), np.int8), np.ones((-(-len(text) // CELL), CELL), np.float32)
        t[mine - start - 1], q[mine - start - 1] = tags[part], sure[part]
        out.append(spans_of(text, t.ravel()[: len(text)], q.ravel()[: len(text)]))
    return out


def spans_of(text: str, tags: np.ndarray, sure: np.ndarray) -> list[Span]:
    """Spans of a text's reconciled tags: sure ones that the kind's own rules allow."""
    kind_at = (tags + 1) // 2
    begins = (tags[1:] % 2 == 1) | (kind_at[1:] != kind_at[:-1])
    edges = np.flatnonzero(np.r_[True, begins, True])
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        if kind_at[a] and sure[a:b].mean() >= SURE:
            kind, found = KINDS[kind_at[a] - 1], text[a:b]
            lead, tail = len(found) - len(found.lstrip()), len(found.rstrip())
            a, b, found = a + lead, a + tail, found.strip()
            digits = sum(c.isdecimal() and c.isascii() for c in found)
            fits = {
                "email": "." in found and ("@" in found or " at " in found) and len(found) > 5,
                "ip": found.count(".") == 3 and _holds("ip", found) if re.fullmatch("[0-9.]+", found) and ".." not in found and found[0] != "." and found[-1] != "." else False,
                "card": 16 <= digits <= 19 and _holds("card", found),
                "phone": 8 <= digits <= 15 and re.fullmatch(r"[+(]?[0-9][\x20().0-9-]*[0-9]", found) is not None and len(found) > digits,
            }[kind]
            if fits:
                out.append((kind, int(a), int(b)))
    return out


def merged(base: list[Span], more: list[Span]) -> list[Span]:
    """All base spans, and the added ones that overlap none of them."""
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken])
    # Base spans of different kinds may overlap each other: the furthest end so far counts.
    ends = np.maximum.accumulate(np.array([0, *(b for _, b in taken)]))
    out = list(base)
    for kind, a, b in more:
        if ends[np.searchsorted(starts, b)] <= a:
            out.append((kind, a, b))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``doc_id``, counts of base spans by kind, ``base_sha256`` and all ``spans`` per row of
    ``docs (doc_id, text)``.

    Spans are in code points, ends exclusive. Null texts are empty and have none. Texts of
    any length are read whole. Repeated rows get equal results; an empty table gives an
    empty table; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = tag_texts(texts, model)
            rows = [joined(b) for b in base]
            counts = [[sum(k == kind for k, _, _ in b) for b in base] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in rows], pa.string()),
                    pa.array([joined(merged(b, m)) for b, m in zip(base, more)], pa.string()),
                ],
                names=[x.strip().split(" ")[0] for x in _OUT.split(",")],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _OUT)


def op6_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(common.table(spark, sf_dir, "documents"), trained())
