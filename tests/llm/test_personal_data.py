"""Personal data: checked expressions against plain ones, and a bootstrap that is known."""

import hashlib
import random
import re
import time

from tests.llm.cases import awkward
from tests.llm.test_native import no_python
from tidegrid.llm import personal_data

PLAIN = {k.name: k.plain for k in personal_data.KINDS}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain_base(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if good(k, m.group())]


def plain_digest(doc_id, text):
    base = plain_base(text)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
    return (doc_id, *[sum(b[0] == k for b in base) for k in PLAIN], hashlib.sha256(joined.encode()).hexdigest())


def nasty(rng):
    pieces = [
        "a@b.c", "a@b.c_d@e.f", "x.y%z@q-r.co.uk.", "a@b", "@b.c", "..@..", "a@b..c", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.3.4",
        "0000000255.0.0.0", "99999999999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "1 2 3 4 5 6 7 8 9 0 1 2 3", "79927398713",
        "+1 (310) 555-4510", "+49 30 1234567", "+1", "++12345678901", "+1234 567.89 (0", "+", "é", "日本", "\n", " ", "-", "...", "3141592653589793",
        "4242424242424242", "0", "12", "378282246310005",
    ]
    return "".join(rng.choice(pieces) + rng.choice(["", " ", ", "]) for _ in range(rng.randrange(1, 25)))


def test_base_equals_plain_expressions(spark):
    rng = random.Random(1)
    docs = awkward(spark, [nasty(rng) for _ in range(400)])
    got = personal_data.digest(personal_data.find_personal_data(docs))
    rows = sorted((tuple(r)[:6] for r in got.collect()), key=repr)
    assert rows == sorted((plain_digest(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert personal_data.find_personal_data(docs.limit(0)).count() == 0


def test_no_python_runs(spark):
    docs = awkward(spark, ["mail me a@b.cd"])
    assert no_python(personal_data.digest(personal_data.find_personal_data(docs)))


def test_unseen_identifiers_are_learned_from_context(spark):
    """Seeds teach "call me on" and, in a second round, a pattern that only learned numbers stand with."""
    seeds = [f"please call me on +1 (310) 555-{1000 + k} after lunch" for k in range(30)]
    unseen = ["you may call me on 310-555-7777 at night", "so call me on (212) 555 8888 or not"]
    # "dial now" stands with numbers that "call me on" has taught, and with one that it has not
    second = [f"call me on 44-55-66-{k} ok" for k in range(10, 14)] + [f"dial now 44-55-66-{k} ok" for k in range(10, 14)] + ["dial now 99-88-77-66 ok"]
    clean = ["in the year 2020 it was cold", "page 310-555 of 900", "the score was 3-2 and 310-555-7777 pages", "call of duty 4 is 10 years old"]
    texts = seeds + unseen + second + clean
    docs = awkward(spark, texts)
    spans = {
        r.doc_id: [(s.kind, s.base, texts[r.doc_id - 100][s.start : s.end]) for s in r.spans]
        for r in personal_data.find_personal_data(docs).collect()
        if r.doc_id and r.doc_id >= 100
    }
    at = 100 + len(seeds)
    assert all(spans[100 + k] == [("phone", True, f"+1 (310) 555-{1000 + k}")] for k in range(30))
    assert spans[at] == [("phone", False, "310-555-7777")] and spans[at + 1] == [("phone", False, "(212) 555 8888")]
    assert spans[at + 2 + 8] == [("phone", False, "99-88-77-66")]
    assert all(spans[at + 2 + 9 + k] == [] for k in range(len(clean)))


def test_patterns_of_mixed_company_are_not_accepted(spark):
    seeds = [f"number +1 (310) 555-{1000 + k} ok" for k in range(5)]
    others = [f"number {k} ok" for k in range(5)] + ["number 310-555-7777 ok"]
    found = personal_data.find_personal_data(awkward(spark, seeds + others))
    assert all(s.base for r in found.collect() for s in r.spans)


def test_repeated_texts_teach_nothing_twice(spark):
    texts = ["ring +1 (310) 555-1000 ok"] * 20 + ["ring 310-555-7777 ok"]
    found = personal_data.find_personal_data(awkward(spark, texts))
    assert all(s.base for r in found.collect() for s in r.spans)


def test_very_long_texts_take_linear_time(spark):
    texts = ["a" * 1_000_000, "1" * 1_000_000, "1." * 400_000, "a@" * 400_000, "+" * 500_000, "1 " * 300_000, "a@b.c " * 20_000]
    start = time.perf_counter()
    rows = {r.doc_id: r for r in personal_data.digest(personal_data.find_personal_data(awkward(spark, texts))).collect()}
    assert time.perf_counter() - start < 120
    assert [rows[100 + k].n_email for k in range(7)] == [0, 0, 0, 0, 0, 0, 20_000]
    assert rows[102].n_ip == 100_000
