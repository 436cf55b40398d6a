import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text, lang) as a table, in several partitions."""

    def made(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, schema).repartition(partitions)

    return made


WORDS = "the of and to in is that for it as was with be by on not he this are or his from at which but".split()


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, personal data, long and empty ones."""
    import random

    r = random.Random(5)

    def prose(n):
        return " ".join(r.choice(WORDS) + r.choice(["", "", "ly", "ing", "es"]) for _ in range(n))

    passage, line = prose(40), prose(9) + "\n"
    rows = [(i, prose(r.randrange(3, 120))) for i in range(40)]
    rows += [(100 + i, line + prose(30)) for i in range(12)]
    rows += [(200 + i, prose(20) + " " + passage + " " + prose(20)) for i in range(6)]
    base = prose(150).split()
    for i in range(12):
        words = list(base)
        for _ in range(i // 2):
            words[r.randrange(150)] = "changed"
        rows.append((300 + i, " ".join(words)))
    rows += [(400 + i, "copy " + " ".join(base[:30])) for i in range(9)]
    rows += [(500, None), (501, ""), (502, " \t\n\x0b\x0c\r "), (503, "one"), (504, "Üñï ça dé ÀB")]
    rows += [(510, prose(6000)), (511, "again and " * 3000), (512, "x" * 20000), (513, ("# % " * 300))]
    rows += [
        (520, "mail a.b+c@x-y.example.com, 10.0.0.255 and 10.0.0.256; 4111 1111 1111 1111 +1 (234) 555-0199."),
        (521, "a@b.co_m@x.yz é 1.2.3.4.5.6.7.8 +12 +1-2 4111-1111-1111-1112 00.1.2.003 +99999999999999999"),
        (522, "@@ a@b a@b. .@.. 1.2.3 1..2.3.4 +(1) 5 5 5 5 4 4 4 4 - 1@2.3"),
        (523, "9" * 5000 + "." + "1." * 2000 + "a@" + "b." * 3000 + "c"),
    ]
    return rows
