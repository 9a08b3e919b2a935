"""Small tables with the awkward rows that every operator must take."""

import random

LONG = "palabra larga " * 4000

#: (doc_id, text): nulls, empties, blanks, copies, ties, repeated rows, a very long text, no doc_id.
AWKWARD = [
    (1, "One two three four five six.\nSeven eight nine."),
    (2, "One two three four five six.\nSeven eight nine."),
    (3, "  One two three four five six.\nSeven eight nine. "),
    (4, None),
    (5, ""),
    (6, " \t\n\r "),
    (7, LONG),
    (8, LONG),
    (9, "ÀÉÎ ŝtrànge 中文字 😀 mixed blank wide"),
    (9, "ÀÉÎ ŝtrànge 中文字 😀 mixed blank wide"),
    (None, "without an id"),
    (None, None),
    (10, "a"),
    (11, "One two three four five six.\nSeven eight nine,"),
    (-4, "negative id"),
]


def documents(spark, rows, clash=False):
    """A table of documents; ``clash`` adds columns named like those that operators make inside."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if clash:
        names = "keep_id group_size kept code digest body salt line line_no place first shard slot bucket score lang key level start stop row gone ids kind"
        for name in names.split():
            docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


def own_keys(rows):
    """The rows, with a number after all ids in place of an id that is shared or missing, and the rows' own ids."""
    ids = [d for d, _ in rows]
    top = max((d for d in ids if d is not None), default=0) + 1
    keyed = [(d if d is not None and ids.count(d) == 1 else top + k, t) for k, (d, t) in enumerate(rows)]
    return keyed, ids


#: Different texts under one id and under none, each with something said before and something of its own.
SAID = "This line of ten words is said by everyone here."
SHARED_IDS = [
    (1, SAID),
    (7, SAID + "\nThe first row of number seven has this line to itself."),
    (7, "UNIQUE unrepeated line of the other row, which has twelve words here.\nlast line"),
    (None, SAID),
    (None, "a text without an id that nobody else has written down so far"),
    (8, "the row under eight says what was never said before it"),
]


def prose(seed, documents, words=60, vocabulary=400):
    """Random sentences in lines, as ``(doc_id, text)``."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdefghijklmnoprstuvwyzé") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    out = []
    for k in range(documents):
        text = ""
        for _ in range(rng.randint(1, 5)):
            for _ in range(rng.randint(1, 3)):
                chosen = [rng.choice(stock) for _ in range(rng.randint(3, words // 3))]
                text += " ".join(chosen).capitalize() + ". "
            text = text.strip() + "\n"
        out.append((k, text.strip()))
    return out


def groups_of(pairs, nodes):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def tuples(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
