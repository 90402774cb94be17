import re

from telemsg.llm.quality_rules import quality_rules

from .helpers import WORD, empty_docs, odd_docs, sentence


def repeated(ws, n=5):
    grams = [tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)]
    twice = {g for g in grams if grams.count(g) > 1}
    return len({i + j for i, g in enumerate(grams) if g in twice for j in range(n)})


def brute(text):
    t = text or ""
    ws = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    rep = repeated(ws) if len(ws) < 500 else 0
    return (
        len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep,
        len(ws) < 10 or 100 * rep > 20 * len(ws),
    )


def test_against_brute_force(spark):
    docs = odd_docs(spark)
    out = quality_rules(docs.select("doc_id", "text"))
    rows = out.select(
        "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    ).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert tuple(r)[1:7] == brute(r.text), r.text
        assert not (r.base_failed and r.kept)
    assert quality_rules(empty_docs(spark).select("doc_id", "text")).count() == 0


def test_repeats_overlap_and_verdicts(spark):
    import random

    body = "the of and to in " + sentence(random.Random(1), 60)
    texts = [
        "a b c d e f a b c d e f a b c d e", "x a b c d e y a b c d e z", "a a a a a a", "a b c d", body,
        body.upper(), " ### ".join(body.split()), "l1 of a\nl1 of a\nl2", " | ".join(f"item{i}" for i in range(60)),
    ]
    out = quality_rules(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    got = {r.text: r for r in out}
    for t in texts:
        assert got[t].n_repeat_words == repeated(WORD.findall(t)), t
    assert got[body].kept
    assert not got[body.upper()].kept and not got[" ### ".join(body.split())].kept and not got[texts[-1]].kept
    assert got[texts[7]].n_dup_lines == 1


def test_kept_rows_are_as_they_came_and_judged_once(spark):
    from telemsg.llm.quality_rules import kept_rows

    docs = odd_docs(spark)  # with columns named like metrics and verdicts
    out = kept_rows(docs)
    assert out.columns == docs.columns
    want = [r.text for r in quality_rules(docs.select("doc_id", "text")).where("kept").collect()]
    got = out.collect()
    assert sorted(r.text for r in got) == sorted(want)
    assert {repr(r) for r in got} <= {repr(r) for r in docs.collect()}
    splits = lambda df: df._jdf.queryExecution().executedPlan().toString().count("split(")
    assert splits(out) <= splits(quality_rules(docs.select("doc_id", "text")).select("kept"))
    assert kept_rows(empty_docs(spark)).count() == 0
