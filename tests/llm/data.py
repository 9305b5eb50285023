"""Small tables with the awkward cases every operator must take."""

import random

WORDS = "ba be bi bo da de di do fa fe fi fo ga ge gi go ha he hi ho ka ke ki ko la le li lo".split()
# Extra columns whose names operators use inside.
EXTRA = "chunk long, bucket int, th long, copy int, score double, label int, rank int, g long, n long, bumps int"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def words(rng, n):
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


def rows(seed=0, n=60):
    """Texts with copies, near copies, shared passages, runs, nulls, repeated
    rows, repeated ids and one long text; ids are not in row order."""
    rng = random.Random(seed)
    passage = words(rng, 40)
    base = words(rng, 120)
    texts = {}
    for i in range(n):
        kind = i % 10
        if kind == 0:
            t = list(base)
            for _ in range(i // 10):
                t[rng.randrange(len(t))] = "new" + str(rng.randrange(99))
        elif kind == 1:
            t = words(rng, 30) + passage[rng.randrange(10):] + words(rng, 20)
        elif kind == 2:
            t = ["run"] * rng.randrange(1, 60) + words(rng, 8) + ["run"] * 20
        elif kind == 3 and i > 10:
            t = texts[i - 10].split()
        else:
            t = words(rng, rng.randrange(0, 90))
        texts[i] = rng.choice([" ", "  ", "\n", "\t"]).join(t)
    texts[4], texts[5], texts[6], texts[7] = "", " \n\t ", "one two", "Été à l'école: naïve ÀÉ\x0b日本 😀 " * 5
    texts[8] = " ".join(words(rng, 4000))
    texts[9] = None
    texts[14] = "one two"
    out = [(i, t) for i, t in texts.items()]
    out += [(20, texts[20]), (20, texts[20]), (21, "another text under a used id " + texts[21])]
    out += [(None, texts[10]), (None, None)]
    rng.shuffle(out)
    full = []
    for i, t in out:
        src = None if i is not None and i % 7 == 0 else f"s{(i or 0) % 4}"
        full.append((i, t, "en", src, len(t or ""), 1, 2, 3, 4, 0.9, 5, 6, 7, 8, 9))
    return full


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
