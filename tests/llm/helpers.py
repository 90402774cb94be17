"""Small inputs with the odd cases every operator must take: nulls, empties, repeats, ties, clashing columns."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = (
    "doc_id long, text string, source string, size long, n_words long, component_id string, taken string, d long, "
    "keep int, node long, pos string, kept string"
)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sentence(rng, n):
    syllables = "ka lo mi ren tu sol vat per dun eri fos gam".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def odd_texts():
    """(doc_id, text, source) with ids distinct but for the marked repeats."""
    rng = random.Random(3)
    out = []
    base = sentence(rng, 80)
    for i in range(12):  # near copies: one word changed
        w = base.split()
        w[i * 5] = f"new{i}"
        out.append((100 + i, " ".join(w), "a"))
    for i in range(14):  # one shared line, one private
        out.append((200 + i, f" Shared LINE of many\t\n{sentence(rng, 30)}\n", "b" if i % 2 else "a"))
    out += [(300 + i, base, "a") for i in range(4)]  # exact copies
    out += [
        (1, None, "a"), (2, "", None), (3, " \n\t \n", "b"), (4, "one two", "c"), (5, "ONE  two", "c"), (6, "\n\n", "c"),
        (7, "é É ü " * 30, "zz"), (8, "x" * 5000 + " " + sentence(rng, 6000), "a"), (9, "a b c d e f g h i j k l", None),
        (10, "same same " * 40, "d"),
    ]
    return out


def odd_docs(spark, repeats=True, null_id=True):
    rows = [(i, t, s, 7, 8, "clash", "clash", 9, 1, 2, "p", "k") for i, t, s in odd_texts()]
    if repeats:
        rows.append(rows[0])
    if null_id:
        rows.append((None, "a text without an id is here today", "a", *rows[0][3:]))
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
