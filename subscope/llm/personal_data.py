"""Personal data by a semi-Markov conditional random field.

Four patterns give the base spans. They miss what touches other numbers: a
phone number and a card after each other run into one match that no rule
accepts. The field segments such stretches jointly: every candidate segment is
scored by features of the whole span (digit groups, checksum, parts, edges,
words to its left), neighbouring segments by their kinds, and dynamic
programming over segments of at most LONGEST tokens picks boundaries and kinds
together. Segments it finds apart from base spans are added; base spans stay.

Only stretches around a digit or an at sign can hold an entity, and text between
them is outside for certain, so the chain is solved stretch by stretch; that is
the same as over the whole text. The field is fitted on a bounded sample of
stretches whose labels are the base spans, alone and set beside each other.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frame, shipped

# Kinds in the order in which spans are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Stretches that a fit may take.
SAMPLE = 600
#: Tokens of the longest segment.
LONGEST = 24

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns that pass their rules; linear in the text."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


_HOT = re.compile("[0-9@]")
_SPACE = re.compile(r"\s")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)


def stretches(text: str) -> list[tuple[int, int]]:
    """Runs of chunks with a digit or an at sign, one white space apart, with a sign before the first."""
    out: list[list[int]] = []
    m = _HOT.search(text)
    while m:
        low = out[-1][1] if out else 0
        start = m.start()
        while start > low and not text[start - 1].isspace():
            start -= 1
        stop = _SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        if out and start - out[-1][1] <= 1:
            out[-1][1] = end
        else:
            out.append([start, end])
        m = _HOT.search(text, end)
    return [(a, b) for a, b in out]


_EMAIL_LIKE = re.compile(r"[^\s@,;:<>()\"']+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_LIKE = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_CARD_LIKE = re.compile(r"[0-9](?:[ .-]?[0-9]){12,18}")
_PHONE_LIKE = re.compile(r"(?:\+|\(|[0-9])[ ().0-9/-]*[0-9]")
_LIKE = (_EMAIL_LIKE, _IP_LIKE, _CARD_LIKE, _PHONE_LIKE)
_CUES = (frozenset(("mail", "email")), frozenset(("ip", "host", "address")),
         frozenset(("card", "visa", "account")), frozenset(("tel", "phone", "call", "fax", "mobile")))
N_FEATURES = 22


def span_features(text: str, start: int, end: int, kind: int, left: str) -> list[float]:
    """Whole-span features of a candidate; ``left``: the word before the stretch."""
    span = text[start:end]
    digits = _digits(span)
    n = len(digits)
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    before = text[start - 1] if start else " "
    after = text[end] if end < len(text) else " "
    beyond = text[end + 1] if end + 1 < len(text) else " "
    return [
        1.0, float(n == 16), float(13 <= n <= 19), float(8 <= n <= 15), float(n >= 13 and luhn(digits)),
        float(span[0] == "+"), float("(" in span and ")" in span), float(groups[-2:] == [3, 4]),
        float(len(groups) == 1), float(len(set(groups)) == 1 and len(groups) > 1),
        float(span.count(".") == 3 and len(groups) == 4),
        float(len(groups) == 4 and all(int(g) <= 255 for g in re.findall("[0-9]+", span)) if n <= 12 else False),
        float("@" in span), float(" " in span), float(before.isalnum() or before in "+_@"),
        float(before in ".-"), float(after.isalnum() or after in "_@"),
        float(after in ".-" and beyond.isalnum()),
        float(left in _CUES[kind]), float(before == "(" or after == ")"),
        float(max(groups, default=0) > 8), float(len(groups) > 6)]


def candidates(text: str, start: int, end: int) -> tuple[int, list[tuple[int, int, int, list[float]]]]:
    """Number of tokens of a stretch, and its candidate segments: first token, token after the last, kind, features."""
    cut = [start + m.start() for m in _TOKEN.finditer(text[start:end])] + [end]
    head = text[max(0, start - 20):start].lower().split()
    left = head[-1].strip(":.,=") if head else ""
    out = []
    for i in range(len(cut) - 1):
        if not (text[cut[i]].isalnum() or text[cut[i]] in "+(._%-"):
            continue
        for j in range(i + 1, min(len(cut), i + 1 + LONGEST)):
            if not text[cut[j] - 1].isalnum():
                continue
            piece = text[cut[i]:cut[j]]
            for kind, like in enumerate(_LIKE):
                if like.fullmatch(piece) and (kind != 3 or 8 <= len(_digits(piece)) <= 15):
                    out.append((i, j, kind, span_features(text, cut[i], cut[j], kind, left)))
    return len(cut) - 1, out


class Field:
    """Weights of kinds by features, and between the kinds of neighbouring segments (the last is outside)."""

    def __init__(self):
        self.weight = np.zeros((4, N_FEATURES))
        self.weight[:, 0] = -4.0
        self.step = np.zeros((5, 5))

    def _scores(self, segments):
        return [float(self.weight[k] @ f) for _, _, k, f in segments]

    def best(self, n: int, segments) -> list[tuple[int, int, int]]:
        """The highest-scoring segmentation; ties go to what is outside, then to the first candidate."""
        ends: dict[int, list[tuple[int, int, int, float]]] = {}
        for (i, j, k, _), s in zip(segments, self._scores(segments)):
            ends.setdefault(j, []).append((i, j, k, s))
        step = self.step.tolist()
        lost = -math.inf
        table = [[lost] * 5 for _ in range(n + 1)]
        came: list[list] = [[None] * 5 for _ in range(n + 1)]
        table[0][4] = 0.0
        for t in range(1, n + 1):
            for i, k, s in [(t - 1, 4, 0.0)] + [(i, k, s) for i, _, k, s in ends.get(t, ())]:
                for before in range(5):
                    value = table[i][before] + step[before][k] + s
                    if value > table[t][k] and table[i][before] > lost:
                        table[t][k], came[t][k] = value, (i, before)
        t, k = n, max(range(5), key=lambda x: (table[n][x], x == 4))
        out = []
        while t:
            i, before = came[t][k]
            if k < 4:
                out.append((i, t, k))
            t, k = i, before
        return out[::-1]

    def learn(self, n: int, segments, gold: set[tuple[int, int, int]], rate, memory) -> None:
        """One stochastic step up the log-likelihood of a stretch (forward-backward over segments)."""
        scores = self._scores(segments)
        arcs = [(t, t + 1, 4, 0.0, None) for t in range(n)]
        arcs += [(i, j, k, s, f) for (i, j, k, f), s in zip(segments, scores)]
        arcs.sort(key=lambda a: a[1])
        alpha = np.full((n + 1, 5), -np.inf)
        beta = np.full((n + 1, 5), -np.inf)
        alpha[0, 4], beta[n] = 0.0, 0.0
        with np.errstate(divide="ignore"):
            for i, j, k, s, _ in arcs:
                alpha[j, k] = np.logaddexp(alpha[j, k], np.logaddexp.reduce(alpha[i] + self.step[:, k]) + s)
            for i, j, k, s, _ in sorted(arcs, key=lambda a: -a[0]):
                beta[i] = np.logaddexp(beta[i], self.step[:, k] + s + beta[j, k])
        total = np.logaddexp.reduce(alpha[n])
        grad = np.zeros_like(self.weight)
        turn = np.zeros_like(self.step)
        for i, j, k, s, f in arcs:
            p = np.exp(alpha[i] + self.step[:, k] + s + beta[j, k] - total)
            turn[:, k] -= p
            if f is not None:
                grad[k] += (((i, j, k) in gold) - p.sum()) * np.array(f)
        t, before = 0, 4
        starts = {i: (j, k) for i, j, k in gold}
        while t < n:
            j, k = starts.get(t, (t + 1, 4))
            turn[before, k] += 1
            t, before = j, k
        for theta, g, m in ((self.weight, grad, memory[0]), (self.step, turn, memory[1])):
            g = g - 1e-4 * theta
            m += g * g
            theta += rate * g / np.sqrt(m + 1e-6)


def gold_of(text: str, base: list[Span]) -> list[Span]:
    """Base spans without those that overlap an earlier listed one."""
    out: list[Span] = []
    for s in base:
        if all(s[2] <= o[1] or o[2] <= s[1] for o in out):
            out.append(s)
    return out


def _told(text: str, gold: list[Span]):
    """The lattice of a whole text as one stretch with its gold segments, or None if one has no candidate."""
    n, segments = candidates(text, 0, len(text))
    cut = [m.start() for m in _TOKEN.finditer(text)] + [len(text)]
    at = {c: k for k, c in enumerate(cut)}
    want = {(at.get(a), at.get(b), KINDS.index(kind)) for kind, a, b in gold}
    return (n, segments, want) if want <= {s[:3] for s in segments} else None


def fit(samples: list[str], epochs: int = 4) -> Field:
    """Fit on stretches whose base spans are the truth: alone, with the last digit changed, and two side by side."""
    field = Field()
    memory = (np.zeros_like(field.weight), np.zeros_like(field.step))
    texts = [(t, gold_of(t, base_spans(t))) for t in samples]
    # A changed last digit keeps a number's shape and breaks its checksum.
    turned = [m[:-1] + str((int(m[-1]) + 1) % 10) for m in samples if m[-1:].isdecimal() and m[-1] in "0123456789"]
    lattices = [_told(t, g) for t, g in texts + [(t, gold_of(t, base_spans(t))) for t in turned]]
    sure = [(t, g) for t, g in texts if g and sum(b - a for _, a, b in g) >= len(t) - 4]
    for (t, g), (u, h) in zip(sure, sure[1:] + sure[:1]):
        shift = len(t) + 1
        lattices.append(_told(f"{t} {u}", g + [(k, a + shift, b + shift) for k, a, b in h]))
    lattices = [x for x in lattices if x and x[0] <= 200]
    for epoch in range(epochs):
        for n, segments, want in lattices:
            field.learn(n, segments, want, 0.5 / (1 + epoch), memory)
    return field


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Segments of the field that do not touch a base span."""
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for start, end in stretches(text):
        if any(a <= start and end <= b for a, b in taken):
            continue
        n, segments = candidates(text, start, end)
        if not segments:
            continue
        cut = [start + m.start() for m in _TOKEN.finditer(text[start:end])] + [end]
        for i, j, k in field.best(n, segments):
            a, b = cut[i], cut[j]
            if all(b <= x or y <= a for x, y in taken):
                out.append((KINDS[k], a, b))
    return out


def _written(spans: list[Span]) -> str:
    order = sorted(set(spans), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


def found(text: str | None, field: Field) -> tuple[str, str]:
    """Base spans and all spans of a text, written kind:start:end."""
    if not text or not _HOT.search(text):
        return "", ""
    base = base_spans(text)
    return _written(base), _written(base + added_spans(text, base, field))


def masked(text: str | None, field: Field) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first's."""
    if not text or not _HOT.search(text):
        return text
    base = base_spans(text)
    spans = sorted(base + added_spans(text, base, field), key=lambda s: (s[1], -s[2]))
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Field:
    """Fit on at most ``sample`` different stretches of at most 120 characters: those with the least hash."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [t[a:b] for a, b in stretches(t) if b - a <= 120])

    some = F.col(text_col).rlike("[0-9@]")
    rows = shipped(docs).where(some).select(F.explode(cut(F.col(text_col))).alias("stretch")).distinct()
    # Stretches with a base span are rare beside other numbers: half of the sample is theirs.
    likely = F.col("stretch").rlike(r"@|\+[0-9]|[0-9]{13}|[0-9]\.[0-9]+\.[0-9]+\.[0-9]")
    order = (F.xxhash64("stretch"), F.col("stretch"))
    half = sample // 2
    got = [r[0] for part in (likely, ~likely) for r in rows.where(part).orderBy(*order).limit(half).collect()]
    return fit(got)


def spans(field: Field):
    """A column function from texts to (base, spans)."""

    @F.pandas_udf("base string, spans string")
    def of(texts: pd.Series) -> pd.DataFrame:
        return frame([found(t, field) for t in texts], ("base", "spans"))

    return of


def masker(field: Field):
    """A column function that masks texts."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: masked(t, field))

    return of


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, spans of every document.

    Null and empty texts have no spans, written as the empty string. Each row
    is searched on its own; other columns of the input are not read.
    """
    of = spans(train(docs, text_col))
    return docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("found")).select(
        "doc_id", "found.base", "found.spans")


def counted(spans_col: Column, kind: str) -> Column:
    return F.regexp_count(spans_col, F.lit(f"{kind}:")).cast("long")
