"""Spans against the plain patterns, one character at a time where it matters."""

import hashlib
import re

from lotwise.llm import pii

SCHEMA = "doc_id long, text string, spans int"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "",
    None,
    "mail a.b+c@ex-ample.co.uk, x@y, x@y.z. and q@r.s_t@u.v@w.x",
    "@@a@b.c@d.e %a@b..c a@-.-",
    "ip 1.2.3.4.5.6.7.8 256.1.1.1 0255.000.0.1 1.2.3 999.1.2.3.4 10.0.0.255",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 378282246310005 30569309025904 1 1  22",
    "é😀 4012888888881881 ü +49 (30) 1234-5678. +1 2 +1234567890123456 +1 (743) 555-3824 x",
    "+1-2-3-4-5-6-7-8-9-0) tail",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, no DE88370400440532013000",
    "tel (030) 1234 5678 but 0301 234 5678 fine",
    "nothing here",
    "7" * 3000 + " " + "1 23-4" * 2000 + "a" * 5000 + "." * 500,
    "a@" + "b.c" * 3000 + " " + "mm@nn.oo " * 700 + "1.1.1." * 1500,
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_base(text):
    spans = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), place, m.end(), kind))
    return sorted(spans)


def test_base_equals_plain_patterns(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], 1), (4, TEXTS[4], 1)]
    got = pii.pii_digests(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, _ in rows:
        want = plain_base(text)
        row = by_id[i]
        for kind in PLAIN:
            assert row[f"n_{kind}"] == sum(s[3] == kind for s in want), (i, kind)
        written = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(row.spans.split(","))


def test_added_spans(spark):
    found = pii.find_pii(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    extra = {(r.doc_id, s.kind, s.value) for r in found for s in r.spans or [] if s.kind in ("iban", "local_phone")}
    assert extra == {
        (8, "iban", "DE89 3704 0044 0532 0130 00"),
        (8, "iban", "GB82WEST12345698765432"),
        (9, "local_phone", "(030) 1234 5678"),
    }  # the second number of row 9 has no context word between the first one and the end
    for r in found:
        for s in r.spans:
            assert TEXTS[r.doc_id][s.start : s.end] == s.value and s.score >= pii.KEEP_SCORE


def test_context_raises_the_score(spark):
    rows = [(1, "visa 4111111111111111"), (2, "blah 4111111111111111"), (3, "0301 234 5678 alone")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    near, far, alone = ([s.score for s in r.spans] for r in sorted(found, key=lambda r: r.doc_id))
    assert near[0] > far[0] and alone == []


def test_empty_table(spark):
    assert pii.pii_digests(spark.createDataFrame([], SCHEMA)).count() == 0
