"""Quality rules with suffix-array repetition.

Every whole text is a sequence of words. A suffix array over the words (prefix
doubling, vectorised over a batch of texts; equal only inside a text) and its
longest-common-prefix values give the maximal repeated substrings. The spans of
those with at least ``min_words`` words are merged; a text fails when the merged
spans cover more than ``max_cover`` of its words, or the longest repeat has more
than ``max_repeat`` words.

Defined cases: null or empty text has no words and fails the base rule (fewer than
20 words); repeated rows are judged each; very long texts are one suffix array each,
bounded by the text itself; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayguard.llm.common import runs_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8        # words of the base rule's windows
MIN_WORDS = 5     # words of a repeat that counts
MAX_COVER = 30    # per cent of words in repeats
MAX_REPEAT = 100  # words of the longest repeat
BATCH_WORDS = 300_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]
STATS = ",".join(f"{c}:bigint" for c in COUNTS) + ",spans:array<struct<start:int,end:int>>"


def repeats(keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Longest repeat that starts at each position, by suffix array and LCP values.

    ``keys``: equal numbers are equal words of one text; ``ends``: the end of the
    text of each position. Returns (suffix array of the positions whose word occurs
    again, longest repeat per position, {h: starts of windows of h words found again}).
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1]))) if n else np.zeros(0, int)
    sizes = np.diff(np.append(first, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, sizes)  # a group's rank is where it starts in sorted order
    active = order[np.repeat(sizes > 1, sizes)]
    suffixes, h, levels, again = active, 1, [rank.copy()], {1: active}
    while len(active):
        nxt = active + h
        inside = nxt < ends[active]
        second = np.where(inside, rank[np.where(inside, nxt, 0)] + 1, 0)
        old = rank[active]
        o = np.argsort(old * (n + 1) + second, kind="stable")
        active, old, second = active[o], old[o], second[o]
        new_old = np.concatenate(([True], old[1:] != old[:-1]))
        start = new_old | np.concatenate(([True], second[1:] != second[:-1]))
        at = np.arange(len(active))
        group = np.maximum.accumulate(np.where(start, at, 0))
        old_start = np.maximum.accumulate(np.where(new_old, at, 0))
        rank[active] = old + (group - old_start)
        sizes = np.diff(np.append(np.flatnonzero(start), len(active)))
        active = active[np.repeat(sizes > 1, sizes)]
        h *= 2
        levels.append(rank.copy())
        again[h] = active
    suffixes = suffixes[np.argsort(rank[suffixes], kind="stable")]
    longest = np.zeros(n, np.int64)
    if len(suffixes) > 1:
        a, b = suffixes[:-1].copy(), suffixes[1:].copy()
        lcp = np.zeros(len(a), np.int64)
        for i in range(len(levels) - 1, -1, -1):  # from the widest window to single words
            ok = (a < ends[suffixes[:-1]]) & (b < ends[suffixes[1:]])
            same = ok & (levels[i][np.where(ok, a, 0)] == levels[i][np.where(ok, b, 0)])
            same &= a != b
            lcp[same] += 1 << i
            a[same] += 1 << i
            b[same] += 1 << i
        np.maximum.at(longest, suffixes[:-1], lcp)
        np.maximum.at(longest, suffixes[1:], lcp)
    return suffixes, longest, again


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Positions inside any of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def analyse(texts: list[str | None], min_words: int = MIN_WORDS) -> list[tuple]:
    """The STATS of every whole text."""
    words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    out: list[tuple] = []
    for lo, hi in runs_of([len(w) for w in words], BATCH_WORDS):
        sizes = np.array([len(w) for w in words[lo:hi]], np.int64)
        stops = np.cumsum(sizes)
        n = int(sizes.sum())
        number = count()
        ids: dict[bytes, int] = {}
        wid = np.fromiter((ids[w] if w in ids else ids.setdefault(w, next(number))
                           for ws in words[lo:hi] for w in ws), np.int64, n)
        doc = np.repeat(np.arange(hi - lo), sizes)
        _, longest, again = repeats(doc * (len(ids) + 1) + wid, np.repeat(stops, sizes))
        eight = again.get(WINDOW, np.zeros(0, np.int64))
        base = _covered(eight, np.full(len(eight), WINDOW), n)
        long = np.flatnonzero(longest >= min_words)
        cover = _covered(long, longest[long], n)
        n_base = np.bincount(doc[base], minlength=hi - lo)
        n_cover = np.bincount(doc[cover], minlength=hi - lo)
        most = np.zeros(hi - lo, np.int64)
        np.maximum.at(most, doc, longest)
        for i, t in enumerate(texts[lo:hi]):
            begin = int(stops[i] - sizes[i])
            spans = []
            if n_cover[i]:
                c = np.concatenate(([False], cover[begin:int(stops[i])], [False]))
                flips = np.flatnonzero(c[1:] != c[:-1])
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(flips[::2], flips[1::2])]
            t = t or ""
            seen: set[str] = set()
            dup = 0
            for line in t.split("\n"):
                if line.strip(SPACES):
                    dup += line in seen
                    seen.add(line)
            out.append((int(sizes[i]), len(t) - sum(map(t.count, SPACES)), sum(map(t.count, SYMBOLS)),
                        dup, int(n_base[i]), int(n_cover[i]), int(most[i]), spans))
    return out


def stats_column(text: Column, min_words: int = MIN_WORDS) -> Column:
    @F.pandas_udf(f"struct<{STATS}>")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(analyse([t if isinstance(t, str) else None for t in batch], min_words), columns=[*COUNTS, "spans"])

    return column(text)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def keeps(s: Column, max_cover: int = MAX_COVER, max_repeat: int = MAX_REPEAT) -> Column:
    """The verdict on a struct of STATS: base rule, covered share and longest repeat."""
    bad = (100 * s["n_covered"] > max_cover * s["n_words"]) | (s["longest_repeat"] > max_repeat)
    return ~base_failed(s) & ~bad


def judge(docs: DataFrame, text_col: str = "text", *, min_words: int = MIN_WORDS,
          max_cover: int = MAX_COVER, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``docs`` with ``quality`` = struct(STATS..., base_failed, kept)."""
    q = docs.withColumn("quality", stats_column(F.col(text_col), min_words))
    s = F.col("quality")
    return q.withColumn("quality", F.struct("quality.*", base_failed(s).alias("base_failed"),
                                            keeps(s, max_cover, max_repeat).alias("kept")))
