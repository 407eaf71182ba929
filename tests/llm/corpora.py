"""Small corpora with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that operators use inside or return; carried along as extra columns.
CLASH = ["id", "h", "fp", "sha", "kept", "size", "taken", "ids", "key", "n", "uid", "token", "score", "ledger", "block", "host", "path"]


def rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)] + ["Éa", "中文", "a|b", "#"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [say(rng.randint(1, 120)) for _ in range(40)]
    passage = ". ".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(7)) + "."
    line = "This very line is found in many of the documents here"
    out = []
    for i, t in enumerate(base):
        out.append((i, t, "en", f"src{i % 4}", len(t)))
    for i in range(40, 60):  # exact copies of one text, and near copies of another
        out.append((i, base[3], "en", "src0", 0))
        near = base[5].split() + say(60).split()[:0]
        near = (base[5] + " " + base[7]).split()
        near[rng.randrange(len(near))] = "changed"
        out.append((i + 100, " ".join(near), "de", None, 0))
    for i in range(60, 68):
        out.append((i, f"{say(8)}\n  {line.upper() if i % 2 else line}\t\n{say(5)} {passage} {say(6)}.\n{line}", "fr", "src9", 1))
    out += [(200, None, None, None, None), (201, "", "en", "", 0), (202, " \n\t ", "en", "src1", 3), (203, "one", "en", "src1", 3), (204, "A b a B a b a b a b a b", "en", "src1", 0)]
    out += [(205, say(20_000), "en", "src2", 0), (206, "x" * 50_000, "en", "src2", 0), (207, "\n" * 300, "en", "src2", 0)]
    out += [(None, "null id text with enough words to be kept by all the rules", "en", "src1", 0), (None, base[3], "en", "src1", 0)]
    out += [(3, base[3], "en", "src3", 0)] * 2 + [(5, base[9], "en", "src3", 0)]  # a repeated row, and one id with two texts
    return out


def frame(spark, data=None, clash=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)]) if clash else df


def empty(spark):
    return frame(spark, []).where("false")
