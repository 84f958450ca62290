"""Small documents with all the awkward cases."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bin int, numbers string, row int"


def words(seed, n, size=40):
    r = random.Random(seed)
    vocabulary = ["w" + str(i) + "abcxyz"[i % 6] for i in range(size)]
    return [r.choice(vocabulary) for _ in range(n)]


def texts():
    base = " ".join(words(1, 60, 500))
    near = base.split()
    near[30] = "changed"
    out = [
        base, base, " ".join(near), base.upper(), "  " + base.replace(" ", "\n\t"),
        None, "", " ", "\n\n", "one", "one", "one two", "One TWO", "é É ß", "a\x1cb\x85c d",
        "x" * 5000, "y " * 3000, "z" * 400 + "@" * 400, "1." * 500, "+" + "1 " * 300,
        " ".join(words(2, 4000, 3000)), " ".join(words(3, 30) + words(1, 60, 500)),
        "shared line of enough length\nown line number one here\nshared",
        "Shared Line of enough length \nother line number two here",
        "\tshared line of enough length\nshared line of enough length\nthird",
        "shared line of enough length",
    ]
    return out + [" ".join(words(10 + i, 25)) for i in range(6)]


def rows(ids=None):
    out = []
    for i, t in enumerate(texts()):
        out.append((i * 3, t, [None, "en", "fr"][i % 3], None, None, i, "n", 1))
    out.append((None, texts()[0], "en", "s", 1, 0, None, None))
    out.append((None, None, None, None, None, None, None, None))
    out.append(out[0])
    out.append(out[2])
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def key(row):
    return tuple((x is not None, x if x is not None else 0) if not isinstance(x, str) else (True, x) for x in row)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: str(r))
