from collections import defaultdict

from .helpers import empty_docs, odd_docs

from telemsg.llm.line_dedup import keep_bitmaps, line_dedup

WS = " \t\n\x0b\x0c\r"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, first=False):
    where = defaultdict(set)
    for i, t in set(rows):
        for p, line in enumerate((t or "").split("\n")):
            key = line.strip(WS).translate(UP)
            if key:
                where[key].add((i, t))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(where.get(x.strip(WS).translate(UP), ())) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_against_brute_force(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = line_dedup(docs).select("doc_id", "__ld_lines", "__ld_dropped", "text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, 10), key=repr)
    assert sum(r["__ld_dropped"] for r in got) == 14


def test_extra_columns_stay_and_empty_table(spark):
    docs = odd_docs(spark)
    assert set(docs.columns) <= set(line_dedup(docs).columns)
    assert {r.component_id for r in line_dedup(docs).collect()} == {"clash"}
    assert line_dedup(empty_docs(spark)).count() == 0


def test_first_occurrence_and_long_bitmaps(spark):
    long = "\n".join(f"line {i}" for i in range(300))
    docs = spark.createDataFrame([(1, long), (2, long), (3, "line 7\nown")], "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup(docs, min_docs=2, keep_first=True).collect()}
    assert out[1]["__ld_dropped"] == 0 and out[1].text == long
    assert out[2]["__ld_dropped"] == 300 and out[2].text == ""
    assert out[3].text == "own"
    maps = {r.d: r for r in keep_bitmaps(docs, min_docs=2, keep_first=True).collect()}
    assert sorted(maps) == [2, 3] and len(maps[2].keep) == 5 and len(maps[3].keep) == 1
