import hashlib
import re

from chronoctx.llm import pii
from llm_cases import TEXTS, empty, hostile

NAMES = ("email", "ip", "card", "phone")
NASTY = [
    "a." * 5 + "@b.c.+x@y.z w@q. é😀 a@b.c.d.e_f@g.h", "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.1.1 " + "9" * 60 + ".1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 " + "1 " * 3000, "+1 (212) 555-0100) +49-30-1234567.. +1+1+12345678901",
    "x" * 3000 + "@", "1" * 5000, "a@b" + ".c" * 3000, "+1 212 555 0100, " * 500, "😀 10.0.0.1 😀 a@b.cd 10.0.0.256",
]


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate((
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 10 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    joined = ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in sorted(out))
    return tuple(sum(k == i for _, k, _ in out) for i in range(4)), hashlib.sha256(joined.encode()).hexdigest()


def test_base_spans_match_brute_force(spark):
    docs = hostile(spark, [*NASTY, *[t if t is None else t[:20_000] for t in TEXTS]])
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    rows = sorted(pii.digest(pii.find_personal_data(docs)).collect(), key=lambda r: repr((r.doc_id,)))
    assert len(rows) == len(texts)
    for row, (doc_id, text) in zip(rows, sorted(texts, key=lambda x: repr((x[0],)))):
        assert ((row.n_email, row.n_ip, row.n_card, row.n_phone), row.base_sha256) == brute(text), doc_id


def test_checksums_and_context(spark):
    docs = hostile(spark, [
        "IBAN DE89 3704 0044 0532 0130 00.", "IBAN DE89 3704 0044 0532 0130 01.", "ssn 123-45-6789", "part 123-45-6789",
        "write to mail a@b.cd", "a@b.cd"], extra=False)
    rows = {r.doc_id: (r.spans, r.scores) for r in pii.digest(pii.find_personal_data(docs)).collect()}
    assert rows[0] == ("iban:5:32", "1.0") and rows[1] == ("", "")
    assert rows[2] == ("ssn:4:15", "0.8") and rows[3] == ("", "")
    assert rows[4][1] == "1.0" and rows[5][1] == "0.9"


def test_masking_leaves_the_rest_alone(spark):
    docs = hostile(spark)
    out = pii.masked_documents(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[16] == "mail [EMAIL] or call [PHONE], card [CARD] at [IP]"
    assert all(texts[i] == (TEXTS[i] or "") for i in range(len(TEXTS)) if i != 16)
    assert pii.digest(pii.find_personal_data(empty(spark))).collect() == []


def test_no_python_on_the_way(spark):
    plan = pii.masked_documents(hostile(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_account_numbers_beside_other_words(spark):
    es, at, se, de = "ES9121000418450200051332", "AT611904300234573201", "SE45 5000 0000 0583 9825 7466", "DE89 3704 0044 0532 0130 00"
    other = next(f"ZZ{i:02d}12345678901234" for i in range(2, 99) if int(f"123456789012343535{i:02d}") % 97 == 1)
    cases = {
        f"IBAN {es} BIC CAIXESBB": [es], f"{at} EUR": [at], f"{se} BANK X": [se], f"{es} {at} {se}": [es, at, se],
        f"{de} 12 EUR": [de], f"AT12 {de}, {es}0": [de], f"😀 {other} BANK {other}": [other, other], f"{de[:-1]}1 {at}": [at],
        f"{other}, {other} EUROpe": [other, other], f"AB12 {es} and {es}": [es, es],
    }
    docs = hostile(spark, list(cases), extra=False).where("doc_id is not null").distinct()
    spans = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(docs)).collect()}
    texts = {r.doc_id: r.text for r in pii.masked_documents(docs).collect()}
    for i, (text, codes) in enumerate(cases.items()):
        want, masked, at_ = [], text, 0
        for code in codes:
            at_ = text.index(code, at_)
            want.append(f"iban:{at_}:{at_ + len(code)}")
            at_ += len(code)
            masked = masked.replace(code, "[IBAN]")
        assert [s for s in spans[i].split(",") if s.startswith("iban")] == want, text
        assert texts[i].count("[IBAN]") == len(codes), texts[i]
    assert texts[0] == "IBAN [IBAN] BIC CAIXESBB" and texts[3] == "[IBAN] [IBAN] [IBAN]"


def test_context_stands_on_either_side(spark):
    texts = ["123-45-6789 is my SSN", "123-45-6789, 234-56-7890 are tax id s", "123-45-6789 " + "x" * 40 + " ssn",
             "4111 1111 1111 1111 by visa", "123-45-6789 " + "x" * 36 + " ssn", "é" * 9 + "123-45-6789,\n234-56-7890 (social security)"]
    docs = hostile(spark, texts, extra=False).where("doc_id is not null").distinct()
    rows = {r.doc_id: (r.spans, r.scores) for r in pii.digest(pii.find_personal_data(docs)).collect()}
    assert rows[0] == ("ssn:0:11", "0.8") and rows[1] == ("ssn:0:11,ssn:13:24", "0.8,0.8")
    assert rows[2] == ("", "") and rows[3] == ("card:0:19", "1.0") and rows[4] == ("", "")
    assert rows[5] == ("ssn:9:20,ssn:22:33", "0.8,0.8")
    assert {r.doc_id: r.text for r in pii.masked_documents(docs).collect()}[0] == "[SSN] is my SSN"


def test_context_reaches_over_earlier_matches(spark):
    texts = ["SSN: 123-45-6789, 234-56-7890", "SSN: 123-45-6789, 234-56-7890, 345-67-8901, 456-78-9012",
             "ssn" + "x" * 40 + " 123-45-6789, 234-56-7890", "card 11 22 33, 44, 55, 66, 77, 4111 1111 1111 1111"]
    docs = hostile(spark, texts, extra=False).where("doc_id is not null").distinct()
    rows = {r.doc_id: (r.spans, r.scores) for r in pii.digest(pii.find_personal_data(docs)).collect()}
    assert rows[0] == ("ssn:5:16,ssn:18:29", "0.8,0.8")
    assert rows[1] == ("ssn:5:16,ssn:18:29,ssn:31:42", "0.8,0.8,0.8")  # 44 characters lie before the fourth
    assert rows[2] == ("", "") and rows[3] == ("card:31:50", "1.0")
    clean = {r.doc_id: r.text for r in pii.masked_documents(docs).collect()}
    assert clean[0] == "SSN: [SSN], [SSN]"
