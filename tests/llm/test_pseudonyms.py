from collections import Counter

import pytest
from tables import SF_SMALL
import tables

from cartographer.llm import pseudonyms, queries

TEXT = ("card 4111 1111 1111 1111 and 4111111111111111, bad 4111111111111112; DE89 3704 0044 0532 0130 00 on 2024-02-29 or "
        "31.12.1999, 12/31/1999, 3/4/2001; 123-45-6789 not 666-11-1111; ip 192.168.1.10, version 1.2.3.4.5; +1 (017) 555-7713, "
        "(212) 555-1234; a.bé9@mail6.example.com; 7536784127813050 4845168114407329")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_feistel_permutes_any_range(n):
    net = pseudonyms.Feistel(b"key")
    image = [net.permute(x, n, b"t") for x in range(n)]
    assert sorted(image) == list(range(n))
    assert [net.permute(y, n, b"t", back=True) for y in image] == list(range(n))


def test_tweaks_and_keys_differ():
    a, b = pseudonyms.Feistel(b"a"), pseudonyms.Feistel(b"b")
    row = lambda net, t: [net.permute(x, 10**6, t) for x in range(50)]
    assert row(a, b"t") == row(a, b"t") != row(a, b"u") != row(b, b"t")


def test_round_trip_and_formats():
    new, kinds = pseudonyms.Pseudonyms(b"k").replace(TEXT)
    assert pseudonyms.Pseudonyms(b"k", restore=True).replace(new)[0] == TEXT
    assert Counter(kinds) == {"card": 4, "iban": 1, "date": 4, "ssn": 1, "ip": 1, "phone": 2, "email": 1}
    for kept in ("4111111111111112", "666-11-1111", "1.2.3.4.5", "+1 (", ".com"):
        assert kept in new
    first, second = new.split("card ")[1].split(" and ")[0], new.split(" and ")[1][:16]
    assert first.replace(" ", "") == second and pseudonyms.luhn(second)
    assert pseudonyms.Pseudonyms(b"other").replace(TEXT)[0] != new


def test_equal_values_stay_linked_across_documents():
    names = pseudonyms.Pseudonyms(b"k")
    a, b = names.replace("born 2001-05-06, mail x.1@y.org")[0], names.replace("x.1@y.org / 06.05.2001")[0]
    assert a.split("mail ")[1] == b.split(" /")[0]
    year, month, day = a[5:15].split("-")
    assert b.endswith(f"{day}.{month}.{year}")


@pytest.mark.parametrize("text", ["no data", "", None, "2024-13-01 99.99.2020", "12345678901234567890123", "1111111111111111", "300.1.1.1", "000-12-3456"])
def test_unvalidated_values_stay(text):
    assert pseudonyms.Pseudonyms(b"k").replace(text) == (text, [])


def test_query_restores_and_leaves_clean_texts(spark):
    docs = dict(tables.small_documents(spark, SF_SMALL))
    got = {r.doc_id: r for r in queries.op2_pseudonyms(spark, SF_SMALL).collect()}
    assert got.keys() == docs.keys()
    back = pseudonyms.Pseudonyms(queries.PSEUDONYM_KEY.encode(), restore=True)
    assert all(back.replace(got[i].text)[0] == t for i, t in docs.items())
    assert all((got[i].text == t) == (got[i].n_replaced == 0) for i, t in docs.items())
    assert any(r.n_replaced for r in got.values())


def test_awkward_rows(spark):
    rows = tables.awkward_rows()
    got = pseudonyms.pseudonymise(tables.frame(spark, rows), "k").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert pseudonyms.counted(pseudonyms.pseudonymise(tables.empty(spark), "k")).count() == 0


@pytest.mark.parametrize(("text", "number"), [
    ("4111 1111 1111 1111 12/27", "4111 1111 1111 1111"), ("4111 1111 1111 1111 123", "4111 1111 1111 1111"),
    ("3782 822463 10005 1234", "3782 822463 10005"), ("12 34 4111 1111 1111 1111", "4111 1111 1111 1111"),
    ("AT61 1904 3002 3457 3201 EUR", "AT61 1904 3002 3457 3201"), ("ES91 2100 0418 4502 0005 1332 BIC", "ES91 2100 0418 4502 0005 1332"),
    ("ES9121000418450200051332 2024", "ES9121000418450200051332"), ("+1 212 555 1234 2024", "+1 212 555 1234"),
    ("+49 30 1234 5678 9012 3456", "+49 30 1234 5678")])
def test_numbers_before_other_words(text, number):
    for key in range(40):
        names = pseudonyms.Pseudonyms(b"%d" % key)
        new, kinds = names.replace(text)
        assert len(kinds) == 1 and number not in new
        assert new.startswith(text[:text.index(number)]) and (number[0] == "+" or new.endswith(text[text.index(number) + len(number):]))
        assert pseudonyms.Pseudonyms(b"%d" % key, restore=True).replace(new) == (text, kinds)


def brute_permutation(key, n, tweak):
    """The keyed permutation as a table: cycle walking written out over every value of the covering square."""
    net = pseudonyms.Feistel(key)
    bits = max(1, ((n - 1).bit_length() + 1) // 2)
    step = {}
    for x in range(1 << 2 * bits):
        left, right = x >> bits, x & ((1 << bits) - 1)
        for i in range(pseudonyms.ROUNDS):
            left, right = right, left ^ net._round(i, right, bits, tweak)
        step[x] = left << bits | right
    assert sorted(step.values()) == sorted(step)
    out = []
    for x in range(n):
        y = step[x]
        while y >= n:
            y = step[y]
        out.append(y)
    return out


@pytest.mark.parametrize("n", [2, 5, 26, 100, 255])
def test_permutations_against_brute_force(n):
    net = pseudonyms.Feistel(b"key")
    assert [net.permute(x, n, b"t") for x in range(n)] == brute_permutation(b"key", n, b"t")


def test_query_against_brute_force(spark):
    """Every replacement of the table, recomputed value by value from plain patterns and the permutation's table-free form."""
    import datetime
    import re

    net, first = pseudonyms.Feistel(queries.PSEUDONYM_KEY.encode()), datetime.date(1900, 1, 1).toordinal()
    days = datetime.date(2100, 1, 1).toordinal() - first
    docs = dict(tables.small_documents(spark, "/root/testdata/sf0.01"))
    got = {r.doc_id: r for r in queries.op2_pseudonyms(spark, "/root/testdata/sf0.01").collect()}
    seen = Counter()
    for i, text in docs.items():
        new = got[i].text
        for m in re.finditer(r"(?<![\d./-])(\d{4})-(\d\d)-(\d\d)(?!\d|[-/.]\d)", text):
            day = datetime.date(*map(int, m.groups())).toordinal() - first
            want = datetime.date.fromordinal(first + net.permute(day, days, b"date")).isoformat()
            assert want in new
            seen["date"] += 1
        for m in re.finditer(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)", text):
            parts = list(map(int, m[0].split(".")))
            if max(parts) < 256 and m[0] == ".".join(map(str, parts)):
                want = ".".join(map(str, net.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, b"ip").to_bytes(4, "big")))
                assert want in new
                seen["ip"] += 1
        for m in re.finditer(r"[a-z]+@[a-z]+\.com\b", text):
            local = m[0].split("@")[0]
            x = 0
            for c in local:
                x = x * 26 + ord(c) - 97
            x, out = net.permute(x, 26 ** len(local), b"local|" + b"1*" * len(local)), ""
            for _ in local:
                x, d = divmod(x, 26)
                out = chr(97 + d) + out
            if not re.search(r"[\w.%+-]", text[m.start() - 1:m.start()]):
                assert out + "@" in new
                seen["email"] += 1
    assert sum(seen.values()) > 0


@pytest.mark.parametrize("text", ["иван.петров@example.com", "łukasz.żak@example.pl", "李小龍@example.org", "אברהם.x@example.com", "ΑΒΓ.άέή@example.gr"])
def test_letters_of_every_script_are_permuted(text):
    names = pseudonyms.Pseudonyms(b"k")
    new, kinds = names.replace(text)
    local, fresh = text.split("@")[0], new.split("@")[0]
    assert kinds == ["email"] and len(fresh) == len(local) and sum(a == b for a, b in zip(local, fresh, strict=True) if a.isalnum()) <= len(local) // 3
    assert [pseudonyms.class_of(a) and pseudonyms.class_of(a)[0] for a in local] == [pseudonyms.class_of(a) and pseudonyms.class_of(a)[0] for a in fresh]
    assert pseudonyms.Pseudonyms(b"k", restore=True).replace(new) == (text, kinds)


@pytest.mark.parametrize("text", [" ".join(f"u{i}@mail.example.com 10.{i % 256}.{i // 256}.9" for i in range(4000)), "z" * 100_000 + " a@b.org 1",
                                  "4111 1111 1111 1112 " * 5000, "DE89 3704 0044 0532 0130 01 " * 3000])
def test_long_texts_take_linear_time(text):
    import time

    at = time.perf_counter()
    pseudonyms.Pseudonyms(b"k").replace(text)
    assert time.perf_counter() - at < 15


def test_a_key_is_needed(spark):
    with pytest.raises(ValueError):
        pseudonyms.Pseudonyms(b"")
    spark.conf.set(queries.KEY_SETTING, "another")
    try:
        other = queries.op2_pseudonyms(spark, SF_SMALL).select("text").collect()
    finally:
        spark.conf.unset(queries.KEY_SETTING)
    assert other != queries.op2_pseudonyms(spark, SF_SMALL).select("text").collect()
