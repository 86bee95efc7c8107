"""Base spans against the contract's patterns; added spans; redaction."""

import hashlib
import random
import re

from llm.pii import pii_digest, redact

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans(spark):
    r = random.Random(8)
    parts = ["4111111111111111", "4111-1111-1111-1111", "4111 1111 11111111", "+49 (30) 1234-567", "10.0.0.1", "x@y.zz", "1.1.1.1.1", "256.1.1.1"]
    rows = [(0, None), (0, None), (1, "")]
    for k in range(300):
        rows.append((10 + k, "".join(r.choice("ab@..--  ++()0123456789 4é_%😀") for _ in range(r.randint(0, 90)))))
        rows.append((1000 + k, r.choice([" ", "", ","]).join(r.choice(parts + ["3", "-", "é"]) for _ in range(8))))
    rows.append((9, "x@y.zz 1.2.3.4 " * 700))
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, pii int")
    found = sorted((r["doc_id"], r["base_sha256"]) for r in pii_digest(docs).collect())
    assert found == sorted((i, hashlib.sha256(base(t).encode()).hexdigest()) for i, t in rows)
    counts = {r["doc_id"]: r for r in pii_digest(docs.where("doc_id = 9")).collect()}[9]
    assert (counts["n_email"], counts["n_ip"], counts["n_card"], counts["n_phone"]) == (700, 700, 0, 0)


def test_checksums_and_context_decide_on_added_kinds(spark):
    texts = [
        ("IBAN DE89 3704 0044 0532 0130 00 ok", "iban:5:32"),
        ("IBAN DE88 3704 0044 0532 0130 00 ok", ""),
        ("xDE89370400440532013000", ""),
        ("my ssn is 123-45-6789.", "ssn:10:21"),
        ("part no 123-45-6789.", ""),
        ("ssn 000-45-6789", ""),
        ("amex card 378282246310005", "card_short:10:25"),
        ("number 378282246310005", ""),
    ]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii_digest(docs).collect()}
    assert [found[k] for k in range(len(texts))] == [s for _, s in texts]


def test_redaction(spark):
    rows = [(1, None), (2, ""), (3, "plain é"), (4, "é a@b.cc, +1.2.3.4 555-5555"), (5, "a@b.cc")]
    docs = spark.createDataFrame([(a, b, "k") for a, b in rows], "doc_id long, text string, pii string").drop("pii")
    found = {r["doc_id"]: r["text"] for r in redact(docs).collect()}
    assert found == {1: None, 2: "", 3: "plain é", 4: "é [EMAIL], [PHONE]", 5: "[EMAIL]"}
    assert redact(docs).columns == docs.columns


def test_secrets_are_drawn_at_random_and_named(spark):
    drawn = "9f3b7a1c5d2e8f0a4b6c1d3e5f7a9b0c2d4e6f8a"
    rows = [
        (1, f'note token = "{drawn}" end', True),
        (2, f"API_KEY={drawn.upper()}", True),
        (3, "Password: q7Zr9+kP2/xT4mB8vN1cW6yL==", True),
        (4, f"commit {drawn} was merged", False),  # nothing names it
        (5, "token = aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", False),
        (6, "the key is internationalizationandlocalization", False),
        (7, "key_of_a_very_long_identifier_name_without_any", False),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {r["doc_id"]: "secret" in r["spans"] for r in pii_digest(docs).collect()}
    assert found == {i: hit for i, _, hit in rows}
    assert redact(docs).where("doc_id = 1").first()["text"] == 'note token = "[SECRET]" end'


def test_clashing_columns_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd now", "kept", 5)], "doc_id long, text string, pii string, merged long")
    docs = docs.withColumn("_merged", docs.pii)
    assert tuple(redact(docs).first()) == (1, "mail [EMAIL] now", "kept", 5, "kept")
    none = docs.limit(0)
    assert redact(none).collect() == [] and pii_digest(none).collect() == [] and redact(none).columns == docs.columns
