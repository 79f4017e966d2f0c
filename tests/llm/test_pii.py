import hashlib
import random
import re

from helpers_llm import awkward, documents

from palimpsest.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(digits[::-1])) % 10 == 0


def holds(kind, span):
    digits = [c for c in span if c in "0123456789"]
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in span.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if holds(kind, m[0])]
    return sorted(found)


def base(text):
    return [s for s in pii.find(text) if s[1] < 4]


def test_random_texts_against_patterns():
    draw = random.Random(7)
    for _ in range(30_000):
        letters = draw.choice(["0123456789 -", "0123456789.", "ab.@%-1", "+0123 ().-", "0123456789  --..@@++()ab%:/é٣"])
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 45)))
        assert base(text) == brute(text), text


def test_query_rows(spark):
    docs = awkward(spark)
    texts = ["mail a@b.com, 10.0.0.256 10.0.0.1 4111 1111 1111 1111 +1 (017) 555-7713", "x@y", "0000000000000000000.1.1.1"]
    docs = docs.select("doc_id", "text").union(documents(spark, texts).select("doc_id", "text"))
    for row in pii.scan(docs, carry=True).collect():
        expected = brute(row.row.text or "")
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in expected) for k in range(4)]
        written = ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in expected)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert row.masked is None if row.row.text is None else not pii.find(row.masked)


def test_further_kinds():
    kinds = lambda text: [pii.KINDS[k] for _, k, _ in pii.find(text)]
    assert kinds("see ftp://me:pw@host/x and http://plain.org/") == ["url"]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 here") == ["iban"]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00 here") == []
    assert kinds('token = "0123456789abcdef0123"') == ["secret"]
    assert pii.mask("to a@b.com now", pii.find("to a@b.com now")) == "to <EMAIL> now"


def test_hostile_lengths_take_linear_time():
    for text in ("1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "a" * 400_000 + "@", "+1 " + "(" * 400_000):
        assert base(text) == brute(text) if len(text) < 10 else base(text) is not None


def test_empty_table(spark):
    assert pii.scan(documents(spark, [])).count() == 0


def test_schemes_of_any_length():
    scheme = "a" * 5000
    assert pii.find(f"({scheme}://me:pw@host") == [(1, pii.KINDS.index("url"), 1 + len(scheme) + len("://me:pw@host"))]
    many = "b://" * 100_000 + "me@h"  # Found in time proportional to the length.
    assert [s[1] for s in pii.find(many)] == [pii.KINDS.index("url")]
