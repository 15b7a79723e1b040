"""Small document frames with everything that can go wrong in them, and plain-Python text rules."""

import random
import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WHITE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: ``documents`` plus columns whose names the operators use inside.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "name string, h int, key bigint, n int, band string, chunk int, kept boolean, `group` string"
)


def low(text):
    return (text or "").translate(LOWER)


def documents(spark, rows, partitions=3):
    """``(doc_id, text)`` pairs as a documents frame with clashing extra columns, some of them null."""
    full = [(i, t, "en", "src0" if n % 3 else None, len(t or ""), "x", 1, 2, 3, None, 4, False, "g") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def prose(seed, n_words, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(rnd.choice("abcdefghij") + rnd.choice(["na", "tor", "é", "sh"]) + str(rnd.randrange(vocabulary)) for _ in range(n_words))


def corpus(n=60):
    """Texts with exact and near copies, shared passages, nulls, empties, short and very long ones."""
    passage = prose(999, 30)
    rows = [(i, prose(i, 20 + i % 7 * 15)) for i in range(n)]
    rows += [(n + i, f"{prose(n + i, 12)} {passage} {prose(2 * n + i, 9)}") for i in range(8)]
    rows += [(n + 20 + i, rows[i][1].upper() if i % 2 else rows[i][1]) for i in range(10)]
    for i in range(10):  # near copies: one word in forty replaced
        words = rows[7 * 1 + i][1].split()
        words[len(words) // 2] = "changed"
        rows.append((n + 40 + i, " ".join(words)))
    rows += [(n + 60, None), (n + 61, ""), (n + 62, ""), (n + 63, "  \t\n "), (n + 64, "One two"), (n + 65, "one  TWO"), (n + 66, "İstanbul ΣΑΣ Straße")]
    rows += [(n + 70, prose(5, 30_000)), (n + 71, "the " * 5000)]
    return rows
