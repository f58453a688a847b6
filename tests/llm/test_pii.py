import hashlib
import random
import re

import pytest

from suturestar.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),  # noqa: B023
                "card": lambda: 16 <= len(digits) <= 19 and _luhn(digits),  # noqa: B023
                "phone": lambda: 8 <= len(digits) <= 15,  # noqa: B023
            }[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


PIECES = ["a", "b.c", "@", ".", "+", "-", " ", "1", "23", "4111 1111 1111 1111", "4111-1111-1111-1111", "256", "10.0.0.1", "é", "🤗", "%", "_", "(", ")", "x@y.z", "+49 30 1234567", "0", "..", "  ", "com"]


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return pii.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_base_spans_equal_the_plain_patterns(spark, model):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    texts += ["a@b.com_c@d.org", "a@b.com.x@y.com", "1.2.3.4.5.6.7.8", "00000000000001.2.3.4", "1 2  3", "4" * 19, "4" * 40, "+1 (826) 555-4081 197.1.2.3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.spans(df, model).collect():
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base) == _base(texts[r.doc_id]), texts[r.doc_id]


def test_long_runs_are_linear(spark, model):
    texts = ["1" * 100_000, "a" * 100_000, "1 " * 50_000, "+1" + "." * 100_000, "a." * 50_000, "1." * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert pii.spans(df, model).count() == 6 and len(pii.spans(df, model).collect()) == 6


def test_the_method_adds_secrets_and_spares_prose(spark, model):
    key = "0123456789abcdef0123456789abcdef01234567"
    df = spark.createDataFrame([(1, f'the token = "{key}" here'), (2, "nothing but words, 12 of them, 3.5 each")], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.spans(df, model).collect()}
    assert got == {1: [("secret", 13, 53)], 2: []}


def test_redaction(spark, model):
    df = spark.createDataFrame([(1, "é mail a@b.com, call +49 30 1234567!", "s"), (2, None, "s"), (3, "", "s"), (4, "clean", "s")], "doc_id long, text string, spans string")
    got = pii.redact(df, model)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "é mail [EMAIL], call [PHONE]!", 2: None, 3: "", 4: "clean"}


def test_em_finds_the_reliable_labeler():
    rng = random.Random(1)
    counts = {}
    for _ in range(4000):
        true = rng.random() < 0.6
        votes = [1 if (rng.random() < 0.95) == true else -1, 1 if (rng.random() < 0.7) == true else -1, 0, 1 if (rng.random() < 0.9) == true else -1, 0, 1 if rng.random() < 0.5 else -1]
        counts["email", tuple(votes)] = counts.get(("email", tuple(votes)), 0) + 1
    m = pii.estimate(counts)
    gain = [m.reliability["email", i, 1][0] - m.reliability["email", i, 1][1] for i in (0, 1, 3, 5)]
    assert gain[0] > gain[1] > gain[3] and gain[2] > gain[1] and abs(m.share["email"] - 0.6) < 0.1
    assert m.probability("email", (1, 1, 0, 1, 0, 1)) > 0.9 > 0.1 > m.probability("email", (-1, -1, 0, -1, 0, -1))


def test_odd_rows(spark, odd_documents, model):
    got = pii.spans(odd_documents, model)
    assert got.count() == odd_documents.count() and len(got.columns) == len(odd_documents.columns)
    assert {len(r.spans) for r in got.collect() if r.doc_id in (3, 4, 7)} == {0}
    assert pii.spans(odd_documents.limit(0), pii.fit(odd_documents.limit(0))).count() == 0


def test_plan_is_native(spark, sf_dir):
    plan = pii.op7_weak_supervision_pii(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_digest(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in pii.op7_weak_supervision_pii(spark, sf_dir).collect():
        assert r.base_sha256 == hashlib.sha256(_base(texts[r.doc_id]).encode()).hexdigest()
        assert set(filter(None, _base(texts[r.doc_id]).split(","))) <= set(r.spans.split(","))
