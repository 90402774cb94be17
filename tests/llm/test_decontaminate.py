import random
import re

from telemsg.llm.decontaminate import contaminated, edit_budget, leaks

from .helpers import empty_docs, odd_docs, sentence

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", (t or "").translate(UP)).strip(" ")


def best(item, text):
    """Least edits of the whole item anywhere in the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    s = list(text)
    for _ in range(n):
        k, p = rng.randrange(3), rng.randrange(len(s))
        if k == 0:
            s[p] = rng.choice("qwzé")
        elif k == 1:
            del s[p]
        else:
            s.insert(p, rng.choice("qwzé"))
    return "".join(s)


def test_against_brute_force(spark):
    rng = random.Random(2)
    items = [(i, sentence(rng, rng.randint(3, 30)).capitalize() + " é") for i in range(8)]
    items += [(50, None), (51, ""), (52, "short"), (0, items[0][1])]
    docs = []
    for k in range(60):
        item = rng.choice(items[:8])[1]
        leak = edited(rng, item, rng.randint(0, max(1, len(item) // 6)))
        leak = leak.replace(" ", rng.choice([" ", "\n", " \t "]))
        docs.append((k, f"{sentence(rng, rng.randint(0, 30))} {leak} {sentence(rng, rng.randint(0, 30))}"))
    docs += [(100, None), (101, ""), (102, items[0][1].upper().replace("É", "é")), (103, sentence(rng, 400))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in leaks(d, b, block_chars=300).collect():
        key = (r.doc_id, r.item_id)
        got[key] = min(got.get(key, 99), r.edits)
        text = dict(docs)[r.doc_id]
        item = dict(items)[r.item_id]
        part = re.sub(r"[\x20\x09-\x0D]+", " ", text[r.start : r.end].translate(UP))
        assert best(norm(item), part) <= r.edits <= r.budget
    want = {}
    for i, t in docs:
        for j, item in dict(items).items():
            m = norm(item)
            if len(m) >= 8 and (e := best(m, norm(t))) <= edit_budget(len(m), 8, 0.1):
                want[i, j] = e
    assert got == want and len(want) > 20 and any(want.values())


def test_odd_inputs(spark):
    docs = odd_docs(spark)
    item = spark.createDataFrame([(1, "a text without an id is here"), (None, "one two three four five")], "item_id long, text string")
    assert [r.doc_id for r in contaminated(docs, item).collect()] == [None]
    assert leaks(empty_docs(spark), item).count() == 0
    assert leaks(docs, item.limit(0)).count() == 0
