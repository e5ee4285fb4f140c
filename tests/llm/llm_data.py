"""Small tables with the awkward cases that every operator has to take."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, kept string, "
          "bucket string, a string, b string, v string, id string, known string, score string")
WORDS = ("the and of tion er on an re he in ed nd ha at en es or th ing ou ea hat whs ble ly stat onl thr ere "
         "was with from this that").split()


def prose(rnd, n, vocabulary=WORDS):
    out, line = [], 0
    for i in range(n):
        w = "".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 3)))
        line += 1
        if line > rnd.randint(4, 14):
            w, line = w + rnd.choice([".", "!", "?", ".\n"]), 0
        out.append(w)
    return " ".join(out)


def awkward(rnd):
    """(doc_id, text): nulls, empty and very long texts, ties, repeats."""
    base = prose(rnd, 120)
    w = base.split(" ")
    near = " ".join(w[:60] + ["changed"] + w[61:])
    passage = prose(rnd, 70)
    long = prose(rnd, 9000)
    rows = [(0, base), (1, base), (2, near), (3, None), (4, ""), (5, "   \n\n "), (6, "word"), (7, "123 456."),
            (8, long), (9, long + " end"), (10, f"{prose(rnd, 40)}. {passage}. {prose(rnd, 40)}"),
            (11, f"{prose(rnd, 30)}.\n{passage}. {prose(rnd, 50)}"), (12, "é" * 300), (13, "日本語。これは文です。" * 20),
            (14, "a" * 700), (15, "a" * 700), (16, "😀 ok\tfine — “quoted” ¿qué?"), (17, "\0\x01 nul"),
            (18, "A. B. C. D. E."), (19, base.upper())]
    rows += [(20 + i, prose(rnd, rnd.randint(1, 80))) for i in range(25)]
    return rows


def documents(spark, rows, extra=True):
    full = [(d, t, None if i % 7 == 3 else ("en", "de")[i % 2], None if i % 5 == 0 else f"s{i % 3}",
             None if t is None else len(t), *["x" if i % 2 else None] * 9) for i, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def repeated(rows):
    """The same rows, some twice, and some without an id."""
    return rows + rows[:3] + [(None, "no id here at all"), (None, None), (rows[8][0], "another text of the same id")]


def fresh(seed=7):
    return random.Random(seed)
