import random

import pytest

#: Columns of no use to the operators, named like those that they use inside.
CLASHES = ["chunk", "bucket", "rid", "size", "place", "node", "sha", "salt", "block", "length", "part", "lap", "fp", "rule", "u", "digest", "n", "score"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def doc_rows():
    rng = random.Random(7)
    syllables = {"en": ["the", "tion", "er", "ing", "wh", "ou"], "de": ["sch", "ein", "ung", "ä", "der"], "fr": ["eau", "è", "que", "ment", "ç"]}

    def prose(lang, n):
        return " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))

    passage = prose("en", 60)
    rows = []
    for i in range(60):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, prose(lang, rng.choice([3, 20, 80, 200])), lang, ["a", "b", "B", "é", None][i % 5]))
    rows += [(100 + i, f"{prose('en', 20)}\n{passage} {prose('en', 30)}", "en", "a") for i in range(4)]
    rows += [(200 + i, rows[4][1], "en", "b") for i in range(12)]  # copies
    rows += [(220 + i, rows[3][1].replace(" ", "  \t", 3), "en", "b") for i in range(3)]  # copies but for white space
    base = prose("de", 300).split()
    for i in range(10):  # near copies
        words = list(base)
        words[rng.randrange(300)] = f"neu{i}"
        rows.append((300 + i, " ".join(words), "de", "c"))
    rows += [(400, None, None, None), (401, "", "en", "a"), (402, " \n\t ", "en", "a"), (403, "12 34 | --", None, "a"), (404, "Ümlaut x y \x1c z", "de", "d")]
    rows += [(None, "no id at all", "en", "a"), (None, "no id at all", "en", "a"), (None, prose("fr", 40), "fr", None)]
    rows += [(500, prose("en", 50), "en", "e")] * 3 + [(500, prose("en", 50), "en", "e")]  # repeated rows and a repeated id
    rows += [(501, prose("de", 9000), "de", "a"), (502, "A" * 30000, "en", "f"), (503, "same " * 500, "en", "a"), (504, " two  spaces \n and\n\n lines ", "en", "a")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return doc_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * len(CLASHES)) for r in rows], DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
