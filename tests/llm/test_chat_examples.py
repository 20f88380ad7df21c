"""Prefix-target examples against a plain formatter."""

import hashlib

from dayguard.llm import chat_examples as C

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "a < b # \\ ### x: </turn>\n"), (1, 2, "assistant", "### user: hi</turn>\n\\"),
    (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "left over"),
    (2, None, "assistant", "first, as null"), (2, 0, "user", "q"), (2, 0, "user", "q"), (2, 0, None, "z"),
    (3, 0, "user", "nobody answers"), (None, 1, "a: b</turn>", "odd role"), (None, 2, "assistant", "é😀" * 5),
    (4, 0, "user", "u" * 200_000), (4, 1, "assistant", "<" * 100_000),
]


def plain(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        shown = ["### " + "".join("\\" + ch if ch in "\\#<:" else ch for ch in r) + ": "
                 + "".join("\\" + ch if ch in "\\#<" else ch for ch in x) + "</turn>\n" for _, _, r, x in turns]
        replies = [x for _, _, r, x in turns if r == "assistant"]
        examples = ["".join(shown[:i + 1]) for i, t in enumerate(turns) if t[2] == "assistant"]
        out[c] = (len(turns), "".join(f"{r}\n{x}\n" for _, _, r, x in turns), "".join(replies), sum(map(len, shown)), examples)
    return out


def test_digests_and_texts(spark):
    want = plain(ROWS)
    df = spark.createDataFrame([(*r, "extra", 1) for r in ROWS], SCHEMA + ", piece string, position int").repartition(5)
    placed = C.pieces(df)
    chosen = C.examples(placed)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["conv_id"]: r for r in C.read_back(placed, chosen).collect()}
    assert set(got) == set(want)
    for c, (n, turns, loss, chars, examples) in want.items():
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (n, sha(turns), len(loss), sha(loss))
        assert (r["formatted_chars"], r["n_examples"], r["example_chars"]) == (chars, len(examples), sum(map(len, examples)))
    texts = {}
    for r in C.render(chosen, placed).collect():
        texts.setdefault(r["conv_id"], []).append((r["target"], r["text"], r["text"][r["loss_start"]:r["loss_end"]]))
    for c, (_, _, loss, _, examples) in want.items():
        have = sorted(texts.get(c, []))
        assert [t for _, t, _ in have] == examples
        assert "".join(C.unescaped(x) for _, _, x in have) == loss


def test_only_the_reply_is_trainable(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2")]
    placed = C.pieces(spark.createDataFrame(rows, SCHEMA))
    shown = sorted((r["target"], r["text"], r["text"][r["loss_start"]:r["loss_end"]])
                   for r in C.render(C.examples(placed), placed).collect())
    assert shown == [(1, "### user: q1</turn>\n### assistant: a1</turn>\n", "a1"),
                     (3, "### user: q1</turn>\n### assistant: a1</turn>\n### user: q2</turn>\n### assistant: a2</turn>\n", "a2")]


def test_empty(spark):
    placed = C.pieces(spark.createDataFrame([], SCHEMA))
    assert C.read_back(placed, C.examples(placed)).count() == 0 and C.examples(placed).count() == 0
