"""A made corpus with planted cases."""


def _word(r):
    return "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randrange(2, 9)))


def corpus(r):
    words = [_word(r) for _ in range(3000)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs = {i: text(120) for i in range(300)}
    docs[7] += " write to some.one@mail.example.org or +1 (555) 123-4567"
    for i in range(500, 600):  # toxic
        w = text(120).split()
        for _ in range(4):
            w.insert(r.randrange(len(w)), r.choice(["wretchfool", "dunderhead"]))
        docs[i] = " ".join(w)
    docs[600], docs[601], docs[602] = text(9) + " ", (text(10) + "\n") * 30, None
    base = text(300).split()
    for i in range(700, 720):  # near and exact copies
        w = list(base)
        if i % 2:
            w[r.randrange(300)] = _word(r)
        docs[i] = " ".join(w)
    rows = [(i, t, "en", "src0", len(t) if t else 0) for i, t in docs.items()]
    labels = [(i, 1, 0) for i in range(0, 300, 2)] + [(i, 1, 1) for i in range(500, 560)]
    return [*rows, rows[3], (None, text(50), "en", "src1", 1)], labels
