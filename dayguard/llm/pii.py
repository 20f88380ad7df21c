"""Personal data: fixed rules plus a character-level BiLSTM with CRF transitions (numpy).

The rules find emails, IPv4 addresses, payment cards and phone numbers. The tagger is
trained on labelled spans (the rules' spans and named secrets in a bounded, hash-chosen
sample of texts, some rewritten: other separators, no leading plus, other lengths) and
adds spans the rules miss: other notations, and a fifth kind, ``secret`` (keys and tokens),
which only the tagger finds, whatever they are called.
Every whole text is cut into windows of ``WINDOW`` characters, half overlapping; windows
are decoded (Viterbi under tag constraints, CRF posterior as confidence) and reconciled
over the whole text: of overlapping spans the surest stays, spans at a window's inner
edge give way to the neighbour's, rule spans always stay. A personal-data span holds a
digit or '@' by definition, so windows without either decode to nothing and are passed over.

Defined cases: null or empty text has no spans; repeated rows are scanned each; extra
columns pass through; without any labelled span to learn from the rules stand alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayguard.llm.common import spool

KINDS = ("email", "ip", "card", "phone")  # kinds of the rules
LEARNT = (*KINDS, "secret")  # kinds of the tagger
# what training texts label as a secret: a long value that is named as one; the tagger learns
# its look and finds it under other names, or none
SECRET = re.compile(r"""(?i)\b(?:token|secret|passw(?:or)?d|api[_-]?key)\b["']?\s{0,2}[:=]\s{0,2}["']?([a-z0-9_+/-]{16,})""")
SECRET_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/-")
SECRET_SURE = 0.9  # least tag posterior of a secret, which is longer than the other kinds
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
TRIGGER = re.compile("[0-9@]")
WINDOW, STRIDE = 96, 48
TRAIN_WINDOW = 48  # training needs no longer windows: the tagger's state is local
SPAN = "struct<kind:string,start:int,end:int,base:boolean>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def valid(kind: str, s: str) -> bool:
    """Whether a string may stand as personal data of its kind."""
    d = _digits(s)
    if kind == "secret":
        return len(s) >= 16 and not set(s) - SECRET_CHARS and bool(d) and any(c.isalpha() for c in s)
    if kind == "email":
        return "@" in s[1:-1]
    if kind == "ip":
        p = s.split(".")
        return len(p) == 4 and all(x.isascii() and x.isdigit() and len(x) <= 4 and int(x) <= 255 for x in p)
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d) and not set(s) - set("0123456789 -.")
    return 10 <= len(d) <= 15 and not set(s) - set("0123456789 ().+-/")


def base_spans(text: str | None, checked: bool = True) -> list[tuple[str, int, int]]:
    """Spans of the rules in (start, kind) order; offsets are code points.

    ``checked=False`` leaves out the card checksum and the range of address parts: the
    tagger learns the shape, which it can see, and its finds are checked afterwards.
    """
    out: list[tuple[int, int, int]] = []
    if not text:
        return []
    at, free = text.find("@"), 0
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        s = at
        if m:
            while s > free and text[s - 1] in LOCAL:
                s -= 1
        if m and s < at:
            out.append((s, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if not checked or all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            d = _digits(m.group()) if m.end() - m.start() <= 64 else ""
            if 14 <= len(d) <= 19 and (not checked or luhn(d)):
                out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            d = sum("0" <= c <= "9" for c in m.group())
            if 10 <= d <= 15:
                out.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


def labelled_spans(text: str | None) -> list[tuple[str, int, int]]:
    """What the tagger learns from a text: shapes of the rules' spans, and named secrets."""
    secrets = [("secret", m.start(1), m.end(1)) for m in SECRET.finditer(text or "") if valid("secret", m[1])]
    rules = [x for x in base_spans(text, checked=False) if all(x[2] <= s or x[1] >= e for _, s, e in secrets)]
    return sorted(rules + secrets, key=lambda x: x[1])


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# --- the tagger ---------------------------------------------------------------
N_TAGS = 1 + 2 * len(LEARNT)  # O, then B and I of each kind
SIGNS = " \n.,@-+()_%/:;!?\"'#*$&"  # characters that are a class of their own
N_CLASS = len(SIGNS) + 6
_TABLE = np.full(128, 4, np.int64)
for _i, _c in enumerate(SIGNS):
    _TABLE[ord(_c)] = 6 + _i
for _c in range(128):
    if chr(_c).isdigit():
        _TABLE[_c] = 1
    elif chr(_c).islower():
        _TABLE[_c] = 2
    elif chr(_c).isupper():
        _TABLE[_c] = 3


def classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cp < 128, _TABLE[np.minimum(cp, 127)], 5)


ALLOWED = np.zeros((N_TAGS, N_TAGS), bool)  # from, to
for _a in range(N_TAGS):
    for _b in range(N_TAGS):
        ALLOWED[_a, _b] = _b == 0 or _b % 2 == 1 or _a in (_b, _b - 1)
START_OK = np.array([t == 0 or t % 2 == 1 for t in range(N_TAGS)])
NEVER = -1e4


@dataclass
class Tagger:
    p: dict[str, np.ndarray]


def _sig(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lstm(xw: np.ndarray, u: np.ndarray, keep: bool):
    """Input products xw (T, 2, B, 4H) -> h (T, 2, B, H), both directions in step."""
    hid = u.shape[1]
    h = np.zeros((*xw.shape[1:3], hid), xw.dtype)
    c = np.zeros_like(h)
    hs, tape = np.empty((len(xw), *h.shape), xw.dtype), []
    for t in range(len(xw)):
        z = xw[t] + h @ u
        s = _sig(z[..., :3 * hid])
        i, f, o = s[..., :hid], s[..., hid:2 * hid], s[..., 2 * hid:]
        g = np.tanh(z[..., 3 * hid:])
        old, c = c, f * c + i * g
        tc = np.tanh(c)
        if keep:
            tape.append((h, old, i, f, o, g, tc))
        h = o * tc
        hs[t] = h
    return hs, tape


def _lstm_back(dh_all, u, tape):
    """Gradients of the input products and of u."""
    dz_all = np.empty((*dh_all.shape[:3], u.shape[2]), dh_all.dtype)
    du, dh = np.zeros_like(u), np.zeros_like(dh_all[0])
    dc, ut = np.zeros_like(dh), u.transpose(0, 2, 1)
    for t in range(len(tape) - 1, -1, -1):
        h, old, i, f, o, g, tc = tape[t]
        dh = dh + dh_all[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate((dc * g * i * (1 - i), dc * old * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), 2)
        dz_all[t] = dz
        du += h.transpose(0, 2, 1) @ dz
        dh, dc = dz @ ut, dc * f
    return dz_all, du


def _emissions(p, ids, keep=False):
    x = p["emb"][ids.T]  # (T, B, D)
    both = np.stack((x, x[::-1]), 1)
    hs, tape = _lstm(both @ p["w"] + p["b"][:, None, :], p["u"], keep)
    h = np.concatenate((hs[:, 0], hs[::-1, 1]), 2)
    return h @ p["wo"] + p["bo"], (both, tape, h)


def _lse(x, axis):
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def _masked(p):
    return np.where(ALLOWED, p["tr"], NEVER), np.where(START_OK, 0, NEVER)


def _forward_backward(em, tr, st):
    steps = len(em)
    a, b = np.empty_like(em), np.zeros_like(em)
    a[0] = em[0] + st
    for t in range(1, steps):
        a[t] = em[t] + _lse(a[t - 1][:, :, None] + tr, 1)
    for t in range(steps - 2, -1, -1):
        b[t] = _lse(tr + (em[t + 1] + b[t + 1])[:, None, :], 2)
    return a, b, _lse(a[-1], 1)


def gradients(p: dict, ids: np.ndarray, tags: np.ndarray):
    """(mean negative log-likelihood, gradients) of whole windows."""
    em, (both, tape, h) = _emissions(p, ids, True)
    tr, st = _masked(p)
    a, b, z = _forward_backward(em, tr, st)
    steps, batch = len(em), len(ids)
    y, kind = tags.T, em.dtype
    at, row = np.arange(steps)[:, None], np.arange(batch)[None, :]
    dem = np.exp(a + b - z[:, None])
    dem[at, row, y] -= 1
    gold = em[at, row, y].sum(0) + tr[y[:-1], y[1:]].sum(0)
    dtr = np.exp(a[:-1, :, :, None] + tr + (em[1:] + b[1:])[:, :, None, :] - z[:, None, None]).sum((0, 1))
    np.add.at(dtr, (y[:-1].ravel(), y[1:].ravel()), -1)
    loss = float((z - gold).mean())
    dem = (dem / batch).astype(kind)
    dh = dem @ p["wo"].T
    hid = p["u"].shape[1]
    dz, du = _lstm_back(np.stack((dh[:, :, :hid], dh[::-1, :, hid:]), 1), p["u"], tape)
    dx = dz @ p["w"].transpose(0, 2, 1)
    g = {"tr": np.where(ALLOWED, dtr / batch, 0).astype(kind), "wo": np.einsum("tbh,tbk->hk", h, dem, optimize=True),
         "bo": dem.sum((0, 1)), "u": du, "b": dz.sum((0, 2)),
         "w": np.einsum("tcbd,tcbz->cdz", both, dz, optimize=True), "emb": np.zeros_like(p["emb"])}
    np.add.at(g["emb"], ids.T, dx[:, 0] + dx[::-1, 1])
    return loss, g


def new_params(seed: int, emb: int = 12, hid: int = 16) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    m = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
    p = {"emb": m(N_CLASS, emb), "w": m(2, emb, 4 * hid), "u": m(2, hid, 4 * hid), "b": np.zeros((2, 4 * hid), np.float32),
         "wo": m(2 * hid, N_TAGS), "bo": np.array([2.0] + [0.0] * (N_TAGS - 1), np.float32), "tr": np.zeros((N_TAGS, N_TAGS), np.float32)}
    p["b"][:, hid:2 * hid] = 1.0
    return p


def train(ids: np.ndarray, tags: np.ndarray, *, seed: int = 7, epochs: int = 16, batch: int = 32,
          rate: float = 0.02) -> Tagger:
    """Adam on shuffled windows."""
    p, r = new_params(seed), np.random.default_rng(seed)
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    step, steps = 0, max(1, epochs * -(-len(ids) // batch))
    for _ in range(epochs):
        order = r.permutation(len(ids))
        for lo in range(0, len(ids), batch):
            rows = order[lo:lo + batch]
            _, g = gradients(p, ids[rows], tags[rows])
            step += 1
            lr = rate * (1 - 0.9 * step / steps)
            for k in p:
                gk = np.clip(g[k], -1, 1)
                m1[k] = 0.9 * m1[k] + 0.1 * gk
                m2[k] = 0.99 * m2[k] + 0.01 * gk * gk
                p[k] = p[k] - (lr * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return Tagger(p)


def windows_of(text: str) -> list[int]:
    """Starts of the windows that hold a digit or '@'."""
    starts, last = [], max(0, len(text) - WINDOW + STRIDE - 1) // STRIDE
    hits = {m.start() // STRIDE for m in TRIGGER.finditer(text)}
    for b in sorted({w for h in hits for w in (h - 1, h) if 0 <= w <= last}):
        starts.append(b * STRIDE)
    return starts


def _window_ids(text: str, start: int, size: int = WINDOW) -> np.ndarray:
    c = classes(text[start:start + size])
    return np.concatenate((c, np.zeros(size - len(c), np.int64)))


def decode(model: Tagger, ids: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
    """For every window [(kind, start, end, confidence)], confidence the least tag posterior."""
    em, _ = _emissions(model.p, ids)
    tr, st = _masked(model.p)
    a, b, z = _forward_backward(em, tr, st)
    post = np.exp(a + b - z[:, None])
    steps, n = len(em), len(ids)
    best, back = em[0] + st, np.empty((steps, n, N_TAGS), np.int8)
    for t in range(1, steps):
        cand = best[:, :, None] + tr
        back[t] = cand.argmax(1)
        best = cand.max(1) + em[t]
    path = np.empty((steps, n), np.int64)
    path[-1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = back[t][np.arange(n), path[t]]
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in range(n)]
    for w in np.flatnonzero((path > 0).any(0)).tolist():
        t = 0
        while t < steps:
            tag = path[t, w]
            if tag == 0:
                t += 1
                continue
            s, k = t, (tag - 1) // 2
            t += 1
            while t < steps and path[t, w] == 2 * k + 2:
                t += 1
            out[w].append((int(k), s, t, float(post[np.arange(s, t), w, path[s:t, w]].min())))
    return out


def added_spans(texts: list[str], base: list[list], model: Tagger, confidence: float) -> list[list]:
    """Spans of the tagger that meet no rule span, reconciled over each whole text."""
    jobs = [(i, s) for i, t in enumerate(texts) for s in windows_of(t)]
    found: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]
    cut: list[list[tuple[int, int, float]]] = [[] for _ in texts]  # secrets that reach over a window's edge
    secret = LEARNT.index("secret")
    for lo in range(0, len(jobs), 256):
        part = jobs[lo:lo + 256]
        ids = np.stack([_window_ids(texts[i], s) for i, s in part])
        for (i, s), spans in zip(part, decode(model, ids)):
            size = len(texts[i])
            for k, a, b, sure in spans:
                edge = (a == 0 and s > 0) or (b >= WINDOW and s + WINDOW < size)
                if sure < (min(confidence, SECRET_SURE) if k == secret else confidence) or s + b > size:
                    continue
                if not edge:
                    found[i].append((-sure, s + a, s + b, k))
                elif k == secret:
                    cut[i].append((s + a, s + b, sure))
    for cand, parts in zip(found, cut):  # parts of neighbouring windows that meet are one secret
        whole: list[tuple[int, int, float]] = []
        for s, e, sure in sorted(parts):
            if whole and s <= whole[-1][1]:
                whole[-1] = (whole[-1][0], max(e, whole[-1][1]), min(sure, whole[-1][2]))
            else:
                whole.append((s, e, sure))
        cand += [(-sure, s, e, secret) for s, e, sure in whole]
    out = []
    for text, rules, cand in zip(texts, base, found):
        taken = [(s, e) for _, s, e in rules]
        mine = []
        for _, s, e, k in sorted(cand):
            while e > s and text[e - 1] in " .,-(\n":
                e -= 1
            while s < e and text[s] in " .,-)\n":
                s += 1
            if k == secret:  # a key is a whole run of its characters
                while s > 0 and text[s - 1] in SECRET_CHARS:
                    s -= 1
                while e < len(text) and text[e] in SECRET_CHARS:
                    e += 1
            if e > s and valid(LEARNT[k], text[s:e]) and all(e <= x or s >= y for x, y in taken):
                taken.append((s, e))
                mine.append((LEARNT[k], s, e))
        out.append(mine)
    return out


def _rewritten(text: str, spans, r) -> tuple[str, list]:
    """The text with each span possibly in another notation, and the spans moved along."""
    out, at, moved, size = [], 0, [], 0
    for kind, s, e in spans:
        if s < at:
            continue
        v = text[s:e]
        if r.random() < 0.4:
            if kind == "phone":
                v = v.replace("-", r.choice([" ", ".", "-"]))
                v = v[1:].strip() if r.random() < 0.6 else v
            elif kind == "secret":
                v = v[:int(r.integers(20, max(21, len(v) + 1)))]
                v = v.upper() if r.random() < 0.3 else v
            elif kind == "card" and v.isdigit():
                sep = str(r.choice([" ", "-", "."]))
                v = sep.join(v[i:i + 4] for i in range(0, len(v), 4))
        out.append(text[at:s])
        size += s - at
        moved.append((kind, size, size + len(v)))
        out.append(v)
        size += len(v)
        at = e
    out.append(text[at:])
    return "".join(out), moved


def training_windows(texts: list[str], most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    ids, tags = [], []
    for raw in texts:
        text, spans = _rewritten(raw, labelled_spans(raw), r)
        tag = np.zeros(len(text) + WINDOW, np.int64)
        for kind, s, e in spans:
            k = LEARNT.index(kind)
            tag[s], tag[s + 1:e] = 2 * k + 1, 2 * k + 2
        marks = sorted({m.start() // 24 for m in TRIGGER.finditer(text)})
        if len(marks) > 12:  # drawn from the whole text
            marks = sorted(r.choice(marks, 12, replace=False).tolist())
        for w in (max(0, 24 * m - int(r.integers(24))) for m in marks):
            y = tag[w:w + TRAIN_WINDOW].copy()
            if y[0] and y[0] % 2 == 0:  # the rest of a span cut by the window's start
                y[0] -= 1
            ids.append(_window_ids(text, w, TRAIN_WINDOW))
            tags.append(y)
    if not ids:
        return np.zeros((0, TRAIN_WINDOW), np.int64), np.zeros((0, TRAIN_WINDOW), np.int64)
    keep = r.permutation(len(ids))[:most]
    return np.stack(ids)[keep], np.stack(tags)[keep]


def _excerpt(text: str, h: int, most: int) -> str:
    """The text, or of a longer one ``most`` characters around a span (a mark if it has none) drawn by hash."""
    if len(text) <= most:
        return text
    places = [s for _, s, _ in labelled_spans(text)] or [m.start() for m in TRIGGER.finditer(text)] or [0]
    at = max(0, places[h % len(places)] - most // 2)
    cut = text[at:at + most]
    return cut[cut.find(" ") + 1:] if at and " " in cut[:most // 4] else cut  # not from inside a word


def fit(docs: DataFrame, text_col: str = "text", *, sample: int = 400, windows: int = 1_000,
        most_chars: int = 20_000, seed: int = 7) -> Tagger | None:
    """Train on the rules' spans in at most ``sample`` different texts that hold a digit or '@', chosen
    by hash, at least half of them with a span if the table has as many; of texts longer than
    ``most_chars`` an excerpt from any place is taken (documented bounds of the training set)."""
    @F.pandas_udf("boolean")
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(labelled_spans(x)) for x in texts], dtype=bool)

    @F.pandas_udf("string")
    def excerpt(texts: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([_excerpt(x, int(h), most_chars) for x, h in zip(texts, hashes)], dtype=object)

    t = F.col(text_col)
    fit_for = docs.where(t.rlike("[0-9@]")).select(t.alias("text"), F.xxhash64(t, F.lit(seed)).alias("h"))
    # the hashes alone first, each once, so that copies take one place and no task sends ``sample`` texts to the driver
    seen = spool(fit_for.select("h", spans("text").alias("spans")).groupBy("h").agg(F.max("spans").alias("spans")))
    half = [r["h"] for r in seen.where("spans").orderBy("h").limit(sample - sample // 2).collect()]
    rest = [r["h"] for r in seen.orderBy("h").limit(sample).collect() if r["h"] not in set(half)]
    chosen = half + rest[:sample - len(half)]
    rows = (fit_for.where(F.col("h").isin(chosen)).select("h", excerpt("text", "h").alias("text"))
            .groupBy("h").agg(F.min("text").alias("text")).orderBy("h").collect())
    ids, tags = training_windows([r["text"] for r in rows], windows, seed)
    return train(ids, tags, seed=seed) if (tags > 0).any() else None


def all_spans(texts: list[str], model: Tagger | None, confidence: float) -> list[list[dict]]:
    """Every text's spans in order, the rules' and those the tagger adds."""
    rules = [base_spans(t) for t in texts]
    more = added_spans(texts, rules, model, confidence) if model else [[] for _ in texts]
    return [[{"kind": k, "start": s, "end": e, "base": b} for s, _, k, e, b in sorted(
        [(s, LEARNT.index(k), k, e, True) for k, s, e in x] + [(s, LEARNT.index(k), k, e, False) for k, s, e in y])]
        for x, y in zip(rules, more)]


def spans_column(text: Column, model: Tagger | None, confidence: float = 0.98) -> Column:
    @F.pandas_udf(f"array<{SPAN}>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(all_spans([t if isinstance(t, str) else "" for t in batch], model, confidence))

    return find(text)


def find(docs: DataFrame, model: Tagger | None, text_col: str = "text", confidence: float = 0.98) -> DataFrame:
    """``docs`` with ``pii`` = array of (kind, start, end, base)."""
    return docs.withColumn("pii", spans_column(F.col(text_col), model, confidence))


def covered(text: str | None, spans) -> str | None:
    """The text with every span replaced by its kind in angle brackets."""
    if not isinstance(text, str) or spans is None or not len(spans):
        return text if isinstance(text, str) else None
    parts, at = [], 0
    for x in spans:
        if x["end"] <= at:
            continue
        parts += [text[at:max(at, x["start"])], f"<{x['kind'].upper()}>" if x["start"] >= at else ""]
        at = x["end"]
    return "".join(parts) + text[at:]


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span of the column ``spans`` covered."""
    @F.pandas_udf("string")
    def cover(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([covered(t, x) for t, x in zip(texts, found)], dtype=object)

    return cover(text, spans)


def redacted_column(text: Column, model: Tagger | None, confidence: float = 0.98) -> Column:
    """``redacted`` of a text and its ``spans_column``, by one Python worker of a task; two columns take two."""
    @F.pandas_udf("string")
    def cover(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = all_spans([t if isinstance(t, str) else "" for t in batch], model, confidence)
            yield pd.Series([covered(t, x) for t, x in zip(batch, found)], dtype=object)

    return cover(text)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
