"""Personal data: fixed patterns, and a semi-Markov conditional random field.

Base spans come from patterns (email, ip, card with Luhn check, phone). The
field adds spans of those kinds, and of kind ``key`` (access keys, secrets), that
the patterns miss. Its units are tokens: runs of letters or digits of a text, and
single other characters. A candidate segment is up to ``MAX_TOKENS`` tokens of
one of the kinds; its features see the whole span (shape, digit and separator
counts, length, kind of neighbours). Segment scores are summed over a
segmentation, everything else being single "outside" tokens, and the dynamic
programme of bounded segments chooses boundaries and kinds jointly. Weights are
trained by the likelihood of whole segmentations (forward-backward over the
same programme).

Only a segment that holds a digit or "@" can be an entity, so outside of the
neighbourhoods of such tokens the best segmentation is known, and the programme
runs over these neighbourhoods, cut where ``MAX_TOKENS`` tokens in a row hold
neither. A neighbourhood reaches 160 characters to either side of such a token: the
optimum is that of the whole text but for spans or single tokens longer than that.
The features of a span are made when the programme reaches its end and kept no
longer, so that a text of digits alone takes memory for its tokens only.

Training: neighbourhoods of at most ``MAX_DOCS`` texts with a digit or "@"
(smallest xxhash64(doc_id, text)), labelled by the patterns, once as they are and
once with the "+" of their phones dropped while the label stays. In the texts' order,
neighbourhoods of 400 tokens or more are left out, and so are those beyond the first
3,000 (parameter ``most`` of ``train``): training is bounded, finding is not. Null texts
count as empty; repeated texts train once; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, with_id

KINDS = ("email", "ip", "card", "phone")
TYPES = (*KINDS, "key")
MAX_TOKENS, MAX_DOCS = 14, 1500

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_KEY = re.compile(r"\bAKIA[0-9A-Z]{16}\b|\b(?=[0-9a-z]*[0-9])(?=[0-9a-z]*[a-z])[0-9a-z]{24,64}\b")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each "@" with the longest local part before it and a domain after it:
    what a leftmost search of the whole pattern finds, in linear time."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and (c := text[start - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = at = m.end()
        else:
            at += 1
            done = at  # the next local part cannot hold this "@"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in KINDS, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


_TOKEN = re.compile(r"[A-Za-z0-9]+|[^\W_]+|\s+|[^\s]")
_LIVE = re.compile(r"[0-9@]")


def neighbourhoods(text: str, most: int = MAX_TOKENS) -> Iterator[list[tuple[int, int]]]:
    """Runs of tokens (start, end) that hold each digit or "@" token with
    ``most`` tokens on either side."""
    toks: list[tuple[int, int]] = []
    last_live, pos, live = None, 0, None
    for m in _LIVE.finditer(text):
        if m.start() < pos:
            continue
        # tokens from pos to this trigger; far ones are outside for sure
        left = max(pos, m.start() - 160)
        before = [(t.start(), t.end()) for t in _TOKEN.finditer(text, left, m.start())]
        if live is not None and left == pos and len(before) <= 2 * most:
            toks += before
        else:
            if live is not None:
                yield toks + _after(text, pos, most, m.start())
            toks = before[-most:]
        t = _TOKEN.match(text, m.start())
        toks.append((t.start(), t.end()))
        pos, live = t.end(), True
    if live is not None:
        yield toks + _after(text, pos, most, len(text))


def _after(text: str, pos: int, most: int, end: int) -> list[tuple[int, int]]:
    out = []
    for t in _TOKEN.finditer(text, pos, min(end, pos + 160)):
        out.append((t.start(), t.end()))
        if len(out) >= most:
            break
    return out


def span_features(text: str, start: int, end: int) -> tuple[str, ...]:
    """Names of what holds of a whole span."""
    s = text[start:end]
    digits = sum(c.isdigit() for c in s)
    letters = sum(c.isalpha() for c in s)
    out = [
        f"digits={min(digits, 20)}",
        f"letters={min(letters, 3)}",
        f"at={min(s.count('@'), 2)}",
        f"dots={min(s.count('.'), 4)}",
        f"first={_shape(s[0])}",
        f"last={_shape(s[-1])}",
        f"space={min(s.count(' '), 4)}",
        f"dash={min(s.count('-'), 4)}",
        f"paren={int('(' in s and ')' in s)}",
        f"before={_shape(text[start - 1]) if start else '^'}",
        f"after={_shape(text[end]) if end < len(text) else '$'}",
        f"mixed={int(digits > 3 and letters > 3 and s.isalnum())}:{min(len(s) // 8, 5)}",
    ]
    pattern = re.sub(r"[0-9]+", lambda m: "9" * min(len(m[0]), 4), re.sub(r"[^\W\d_]+", "a", s))
    out.append("shape=" + pattern[:24])
    return tuple(out)


def _shape(c: str) -> str:
    return "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


class SemiCRF:
    """Weights by (type, feature); "outside" tokens score 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def candidates(self, text: str, toks: list[tuple[int, int]]) -> list[list[tuple[int, tuple[str, ...]]]]:
        """All that ``ends`` gives, held at once."""
        return list(self.ends(text, toks))

    def ends(self, text: str, toks: list[tuple[int, int]]) -> Iterator[list[tuple[int, tuple[str, ...]]]]:
        """By end token j: (start token i, features) of the spans i..j that may
        be entities: with a digit or "@", no white space at either end."""
        live = np.concatenate([[0], np.cumsum([bool(_LIVE.search(text, a, b)) for a, b in toks])])
        blank = [text[a].isspace() for a, _ in toks]
        for j in range(len(toks)):
            own = []
            if not blank[j] and text[toks[j][0]] not in ".,;:":
                for i in range(j, max(-1, j - MAX_TOKENS), -1):
                    if "\n" in text[toks[i][0] : toks[i][1]]:
                        break
                    if not blank[i] and live[j + 1] > live[i]:
                        own.append((i, span_features(text, toks[i][0], toks[j][1])))
            yield own

    def _score(self, kind: str, feats: tuple[str, ...]) -> float:
        return sum(self.weights.get((kind, f), 0.0) for f in feats) + self.weights.get((kind, "bias"), -8.0)

    def decode(self, text: str, toks: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        best, back = [0.0], [None]
        for j, own in enumerate(self.ends(text, toks)):
            value, how = best[j], None
            for i, feats in own:
                for kind in TYPES:
                    s = best[i] + self._score(kind, feats)
                    if s > value:
                        value, how = s, (i, kind)
            best.append(value)
            back.append(how)
        out, j = [], len(toks)
        while j:
            how = back[j]
            if how:
                out.append((how[1], toks[how[0]][0], toks[j - 1][1]))
                j = how[0]
            else:
                j -= 1
        return out[::-1]

    def gradient(self, text: str, toks: list[tuple[int, int]], gold: set[tuple[str, int, int]]) -> dict[tuple[str, str], float]:
        """Observed minus expected features (forward-backward over segments)."""
        cands = self.candidates(text, toks)
        n = len(toks)
        scored = [[(i, feats, [self._score(k, feats) for k in TYPES]) for i, feats in own] for own in cands]
        ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        ahead[0] = behind[n] = 0.0
        for j in range(n):
            terms = [ahead[j]] + [ahead[i] + s for i, _, ss in scored[j] for s in ss]
            ahead[j + 1] = _logsum(terms)
        by_start: list[list[tuple[int, list[float]]]] = [[] for _ in range(n)]
        for j, own in enumerate(scored):
            for i, _, ss in own:
                by_start[i].append((j + 1, ss))
        for i in range(n - 1, -1, -1):
            behind[i] = _logsum([behind[i + 1]] + [behind[e] + s for e, ss in by_start[i] for s in ss])
        out: dict[tuple[str, str], float] = {}
        for j, own in enumerate(scored):
            for i, feats, ss in own:
                for kind, s in zip(TYPES, ss, strict=True):
                    p = float(np.exp(ahead[i] + s + behind[j + 1] - ahead[n]))
                    d = ((kind, toks[i][0], toks[j][1]) in gold) - p
                    if abs(d) > 1e-4:
                        for f in (*feats, "bias"):
                            out[kind, f] = out.get((kind, f), 0.0) + d
        return out


def _logsum(x: list[float]) -> float:
    m = max(x)
    return m + float(np.log(sum(np.exp(v - m) for v in x)))


def altered(text: str, spans: list[tuple[str, int, int]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its phones' "+" dropped (spans moved along)."""
    out, moved, at = [], [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        out.append(text[at:a])
        body = text[a + 1 : b] if kind == "phone" else text[a:b]
        start = sum(map(len, out))
        out.append(body)
        moved.append((kind, start, start + len(body)))
        at = b
    return "".join([*out, text[at:]]), moved


def train(texts: list[str], epochs: int = 3, rate: float = 0.3, most: int = 3000) -> SemiCRF:
    """AdaGrad over the neighbourhoods of the texts, at most ``most`` of them."""
    model, seen, examples = SemiCRF(), {}, []
    for text in texts:
        spans = base_spans(text)
        spans += [("key", m.start(), m.end()) for m in _KEY.finditer(text)]
        for t, marks in ((text, spans), altered(text, spans) if any(k == "phone" for k, _, _ in spans) else ("", [])):
            marks = [m for m in marks if not any(o != m and o[1] < m[2] and m[1] < o[2] and o[2] - o[1] > m[2] - m[1] for o in marks)]
            for toks in neighbourhoods(t):
                if len(examples) < most and len(toks) < 400:
                    examples.append((t, toks, set(marks)))
    for _ in range(epochs):
        for t, toks, marks in examples:
            for key, g in model.gradient(t, toks, marks).items():
                seen[key] = seen.get(key, 1e-6) + g * g
                model.weights[key] = model.weights.get(key, -8.0 if key[1] == "bias" else 0.0) + rate * g / seen[key] ** 0.5
    return model


def fit(docs: DataFrame, max_docs: int = MAX_DOCS) -> SemiCRF:
    """Trained on the documents with a digit or "@" among ``max_docs``."""
    some = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("doc_id", "text").alias("h"))
    chosen = some.select("h").orderBy("h").limit(max_docs)  # numbers only: the texts of these alone travel
    rows = some.join(F.broadcast(chosen.distinct()), "h").dropDuplicates(["h"]).collect()
    return train(sorted({r["text"] for r in rows}))


def all_spans(text: str, model: SemiCRF) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans; base and added spans by kind, then start. An added span
    meets no base span."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    every = list(base)
    for toks in neighbourhoods(text):
        for kind, a, b in model.decode(text, toks):
            if not any(a < y and x < b for x, y in taken):
                every.append((kind, a, b))
    return base, sorted(set(every), key=lambda s: (TYPES.index(s[0]), s[1], s[2]))


def find(docs: DataFrame, model: SemiCRF) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    def text_of(spans: list[tuple[str, int, int]]) -> str:
        return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = SemiCRF(shared.value)
        for pdf in batches:
            rows = []
            for text in pdf["text"].fillna(""):
                base, every = all_spans(text, own)
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append([*counts, hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(every), len(every)])
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])
            out.insert(0, "doc_id", pdf["doc_id"].array)
            yield out

    schema = "doc_id string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    return with_id(docs.select(id_text(), "text").mapInPandas(run, schema))
