import hashlib
import random
import string

from telemsg.llm.secret_scan import all_spans, base_spans, seeded_strings, secret_scan, train

from .helpers import empty_docs, odd_docs, sentence


def test_base_patterns():
    hex32 = "0123456789abcdef" * 2
    assert base_spans(f"x {hex32} y") == [("hex", 2, 34)]
    assert base_spans("Api_Key: 'abcdEFGH'") == [("assign", 0, 18)]
    assert base_spans("token=token:abcdefgh1") == []  # the short match has used up the second word
    assert base_spans("é password = short") == [] and base_spans("passwd=longenough")[0] == ("assign", 0, 17)
    assert base_spans("to\u212aen=abcdefgh12") == []  # only ASCII letters count in either case
    assert base_spans("AKIA" + "A" * 12) == [("access", 0, 16)] and base_spans("AKIA" + "A" * 11) == []
    assert [k for k, *_ in base_spans(f"token={hex32}")] == ["assign", "hex"]


def test_models_on_held_out_strings(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, sentence(rng, 300)) for i in range(20)], "doc_id long, text string")
    model = train(docs)
    fresh = [s for s in seeded_strings(400, seed=99) if any(c.isdigit() for c in s) and any(c.isalpha() for c in s)]
    caught = sum(any(k == "markov" for k, *_ in all_spans(f"see {s} here", model, 0.7)) or bool(base_spans(s)) for s in fresh)
    assert caught / len(fresh) > 0.97
    plain = [sentence(rng, 6).replace(" ", rng.choice(["_", "", "-"])) + "2024" for _ in range(400)]
    wrong = sum(any(k == "markov" for k, *_ in all_spans(p, model, 0.7)) for p in plain)
    assert wrong / len(plain) < 0.03


def test_rows(spark):
    docs = odd_docs(spark)
    rows = secret_scan(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].base_sha256 == hashlib.sha256(b"").hexdigest() and by[1].spans == ""
    assert secret_scan(empty_docs(spark)).count() == 0
    one = spark.createDataFrame([(1, "é token = 'abcdefgh' AKIA" + "Z" * 16)], "doc_id long, text string")
    r = secret_scan(one).first()
    assert r.spans == "assign:2:19,access:21:41" and (r.n_assign, r.n_access, r.n_hex) == (1, 1, 0)
    assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()


def test_every_uncovered_token_is_judged(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, sentence(rng, 300)) for i in range(20)], "doc_id long, text string")
    model = train(docs)

    def found(text):
        return [text[a:b] for k, a, b in all_spans(text, model, 0.7) if k == "markov"]

    fresh = seeded_strings(400, seed=98)  # all of them, and pieces of them too short for the old gate
    assert sum(bool(found(f"see {s} here")) or bool(base_spans(s)) for s in fresh) / len(fresh) > 0.97
    assert sum(bool(found(f"see {s[:12]} here")) for s in fresh) / len(fresh) > 0.93
    lower, upper = string.ascii_lowercase, string.ascii_letters
    for letters in (lower, upper):
        strings = ["".join(rng.choices(letters, k=24)) for _ in range(200)]
        assert sum(found(f"see {s} here") == [s] for s in strings) / 200 > 0.95
    hidden = ["".join(rng.choices(upper + string.digits, k=20)) for _ in range(200)]
    path = "/".join(sentence(rng, 30).split())
    assert sum(found(f"/{path}/{s}/{path}") == [s] for s in hidden) / 200 > 0.95
    assert sum(found(f"AKIA{'A' * 16}_{s}") == [s] for s in hidden) / 200 > 0.95
    assert sum(len(found(f"{s}/{path}/{s}==")) == 2 for s in hidden) / 200 > 0.95
    plain = [w for i in range(20) for w in sentence(rng, 300).split() if len(w) >= 8]
    assert sum(bool(found(w)) for w in plain) / len(plain) < 0.001 and found(f"/{path}") == []
