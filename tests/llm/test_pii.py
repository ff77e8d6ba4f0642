import datetime
import re

import pytest
from pyspark.sql import functions as F

from adlens.llm.pii import feistel, pseudonymise


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(re.sub(r"\D", "", s))):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def run(docs, texts):
    out = pseudonymise(docs(list(enumerate(texts)))).orderBy("doc_id").collect()
    return [(r.text, [x.kind for x in r.found]) for r in out]


KINDS = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "3782-822463-10005"],
    "email": ["jane.doe+x9@mail.example.com", "A@b.org"],
    "phone": ["+1 (212) 555-0187", "+44 20 7946 0958", "(212) 555-0187", "212-555-0187", "+4915112345678"],
    "ipv4": ["192.168.10.254", "8.8.8.8"],
    "ssn": ["078-05-1120", "899-99-9999"],
    "date": ["2024-02-29", "31.12.1999", "02/28/2023", "28/02/2023", "1900-01-01", "2099-12-31"],
    "iban": ["GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00"],
    "secret": ['token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', 'TOKEN = "04DBEBAB91AB85687D33EEAAF9AC699E1188F962"',
               "password: 'S3cret-pass_word'"],
}


@pytest.mark.parametrize("kind", KINDS)
def test_values_keep_format_and_stay_linked(spark, docs, kind):
    values = KINDS[kind]
    got = run(docs, [f"a {v}, then é{v} and\n{v}." if kind == "secret" else f"a {v}, then ({v}) and\n{v}." for v in values])
    for v, (text, kinds) in zip(values, got, strict=True):
        assert kinds == [kind] * 3 and v not in text, (v, text)
        if kind == "ipv4":
            found = re.findall(r"\d+\.\d+\.\d+\.\d+", text)
            assert all(int(o) < 256 for f in found for o in f.split("."))
        else:
            n = len(v)
            found = [text[2:2 + n], text[-1 - n:-1]]
            shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s)))
            if kind == "secret" and "password" not in v:
                assert re.fullmatch(r'(token|TOKEN) = "([0-9a-f]{40}|[0-9A-F]{40})"', found[0])
            else:
                assert shape(found[0]) == shape(v)
        assert len(set(found)) == 1
        f = found[0]
        if kind == "card":
            assert luhn(f)
        if kind == "iban":
            s = f.replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
        if kind == "phone" and v.startswith("+"):
            assert f[:2] == v[:2]
        if kind == "email":
            assert f.split(".")[-1] == v.split(".")[-1]


def test_dates_are_permuted_among_dates(spark, docs):
    days = [datetime.date(1900, 1, 1) + datetime.timedelta(n) for n in range(0, 73049, 97)]
    got = run(docs, [d.isoformat() for d in days])
    new = [datetime.date.fromisoformat(t) for t, _ in got]
    assert len(set(new)) == len(days) and all(1900 <= d.year <= 2099 for d in new)


def test_permutation_is_one_to_one(spark):
    rows = spark.range(17 * 13).select(F.array(F.floor(F.col("id") / 13), F.col("id") % 13).alias("v"))
    x = F.struct(F.col("v").alias("values"), F.array(F.lit(17).cast("long"), F.lit(13).cast("long")).alias("radices"),
                 F.lit("t").alias("kind"))
    new = {tuple(r[0]) for r in rows.select(feistel(x, "key")).collect()}
    assert len(new) == 17 * 13 and all(0 <= a < 17 and 0 <= b < 13 for a, b in new)


def test_what_is_no_value_stays(spark, docs):
    texts = [None, "", "no digits at all", "4111111111111112 fails its sum", "999.1.1.1 and 1.2.3.4.5 and 01.2.3.4",
             "2023-02-30 and 31.13.2000 and 99/99/2000 and 2100-01-01", "000-12-3456 666-12-3456 900-12-3456 123-00-1234",
             "GB82WEST12345698765433", "version 2.0 of 3, 12 pieces, 1,000,000 words", "user@host", "x" * 300_000 + "@",
             "1" * 100_000, "token = 5"]
    assert [t for t, _ in run(docs, texts)] == texts


def test_values_side_by_side(spark, docs):
    text = "+1 (826) 555-4081 190.137.223.204 4845168114407329 4111111111111111 2020-01-02"
    (new, kinds), = run(docs, [text])
    assert kinds[0] == "phone" and "ipv4" in kinds and "card" in kinds and "date" in kinds
    assert all(v not in new for v in ("555-4081", "190.137.223.204", "4111111111111111", "2020-01-02"))


def test_keys_differ_and_columns_stay(spark, docs):
    rows = docs([(1, "card 4111111111111111"), (1, "card 4111111111111111")])
    a, b = (pseudonymise(rows, key=k).collect() for k in ("k1", "k2"))
    assert a[0].text == a[1].text != b[0].text and a[0].token == 7
    assert pseudonymise(docs([])).collect() == []
