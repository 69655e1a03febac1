import hashlib
import re

from strata.llm.pii import find_pii
from strata.llm.queries import op5_pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in twice) % 10 == 0


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in found.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    text = text or ""
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if valid(k, m[0])]


TRICKY = [
    None, "", "no data", "a@b@c.d x@y", "a@b.c..d@e.f", "a@b.c_x@y.z", "x@a.b.c.", "..@a-.b", "é.a@b.cö@d.ef", "a@b.c.d@e.f@g.h",
    "1.2.3.4.5.6.7.8 999.1.2.3.4.5.6.7 001.002.3.255 256.1.1.1 1.2.3", "0000000255.0.0.1 00256.0.0.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 4111  1111 1111 1111 4111111111111112",
    "44111111111111111 4111 1111 1111 1111 1 é 378282246310005, 6011000990139424--4111111111111111",
    "+1 (017) 555-7713 +49 30 123456 ++49.30.1234567- +1 2 +12345678901234567890 +1-2-3-4-5-6-7-8-9", "日本 🎉 +49 151 12345678 🎉 a@b.cd",
    "bank GB82 WEST 1234 5698 7654 32 and DE89370400440532013000 iban DE88370400440532013000",
    "my ssn is 123-45-6789, order 123-45-6789-0; call 555-123-4567 or +1 555-123-4567", "order 123-45-6789 lies far away",
    "a" * 50_000 + "@b.c", "1" * 30_000, "a@" + "b." * 20_000 + "c", "12 " * 5_000 + "4111111111111111", "+" * 5_000, "1.2.3.4 " * 3_000,
]


def test_tricky_and_random_texts_against_plain_patterns(spark, tmp_path):
    import random

    rnd = random.Random(8)
    texts = TRICKY + ["".join(rnd.choice(["a", "@", ".", "1", "25", "-", " ", "+", "(", ")", "é", "4111111111111111"]) for _ in range(rnd.randint(5, 60)))
                      for _ in range(1500)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    seen = 0
    for r in op5_pii(spark, str(tmp_path)).collect():
        want = brute(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in want) for k in BASE], texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), texts[r.doc_id]
        assert r.spans.startswith(listed)
        seen += len(want)
    assert seen > 1000


def test_given_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in op5_pii(spark, d).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in brute(texts[r.doc_id])).encode()).hexdigest()


def test_checksums_and_context_decide_what_is_added(spark):
    rows = [(i, t, "x") for i, t in enumerate(TRICKY)]
    got = {r.doc_id: [(s.kind, r.text[s.start:s.end]) for s in r.spans if s.kind not in BASE] for r in
           find_pii(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()}
    at = TRICKY.index
    assert got[at(next(t for t in TRICKY if t and "WEST" in t))] == [("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000")]
    assert got[at(next(t for t in TRICKY if t and "my ssn" in t))] == [("ssn", "123-45-6789"), ("local_phone", "555-123-4567")]
    assert got[at("order 123-45-6789 lies far away")] == []


def test_context_reaches_over_other_matches(spark):
    texts = ["Phones: 555-123-4567, 555-987-6543, 555-222-3333", "123-45-6789, 987-65-4321 and 111-22-3333 are social security numbers",
             "Phones: 555-123-4567, +49 151 12345678, 555-987-6543, " + "no words " * 6 + "555-222-3333", "日本 🎉 tel " + "555-123-4567 " * 9]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: [r.text[s.start:s.end] for s in r.spans if s.kind not in BASE] for r in rows}
    assert got == {0: ["555-123-4567", "555-987-6543", "555-222-3333"], 1: ["123-45-6789", "987-65-4321", "111-22-3333"],
                   2: ["555-123-4567", "555-987-6543"], 3: ["555-123-4567"] * 4}
    words = {"email": "mail|contact|write|kontakt|correo|courriel", "phone": "phone|tel|call|mobile|fax|handy"}
    dense = spark.createDataFrame([(1, "mail " + "a@b.c," * 300 + " mail " + "+1 234567890;" * 100 + " call")], "doc_id long, text string")
    for r in find_pii(dense).collect():
        assert len(r.spans) == 400
        for s in r.spans:
            near = r.text[max(0, s.start - 48):s.start] + " " + r.text[s.end:s.end + 48]
            base = {"email": 0.8, "phone": 0.6}[s.kind]
            assert s.score == round(base + (0.3 if re.search(f"(?<![a-z])(?:{words[s.kind]})", near.lower()) else 0), 3)


def iban(country, bban):
    turned = "".join(str(int(c, 36)) for c in bban + country)
    return f"{country}{98 - int(turned + '00') % 97:02d}{bban}"


def test_ibans_end_where_their_country_says(spark):
    grouped = lambda x: " ".join(x[i:i + 4] for i in range(0, len(x), 4))
    whole = ["BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "MT84MALT011000012345MTLCAST001S",
             "MU17BOMM0101101030300200000MUR", "SC18SSCB11010000000000001497USD", "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606"]
    whole += [grouped(x) for x in whole[3:6]] + [iban("IR", "0170000000100324200001"), iban("XX", "12345678901234AB"), iban("LC", "HEMM000100010012001200023015")]
    assert whole[4] == iban("MU", whole[4][4:])
    tails = ["", " 2024", " EUR now", " 12", " 50 EUR", " 1235 5678", ".", ", 12", " PAID"]
    cases = [(w, t) for w in whole for t in tails if not (w.startswith("XX") and re.match(" [A-Z0-9]", t))]
    texts = [w + t for w, t in cases]
    more = {"BE12 GB82 WEST 1234 5698 7654 32": ["GB82 WEST 1234 5698 7654 32"], "xBE68539007547034 BE6853900754703 BE685390075470340": [],
            "BE68539007547034 BE68 5390 0754 7034 1234 " + whole[3]: ["BE68539007547034", "BE68 5390 0754 7034", whole[3]], "DE88 3704 0044 0532 0130 00 2024": []}
    df = spark.createDataFrame(list(enumerate([*texts, *more])), "doc_id long, text string")
    got = {r.text: [r.text[s.start:s.end] for s in r.spans if s.kind == "iban"] for r in find_pii(df).collect()}
    assert got == {**{w + t: [w] for w, t in cases}, **more}


def test_empty_table_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c")], "doc_id long, text string")
    assert [len(r.spans) for r in find_pii(df).collect()] == [1, 1, 1]
    assert find_pii(df.limit(0)).collect() == []
