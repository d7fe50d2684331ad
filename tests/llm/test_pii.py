"""Pseudonyms: formats, round trip, links between documents, odd inputs."""

import ipaddress
import re
from datetime import date, datetime
from hashlib import sha256

import pytest

from tests.conftest import SF01
from tidewater.llm import pii
from tidewater.llm.catalog import QUERIES


def luhn(s):
    digits = [int(c) for c in reversed(s)]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


KEY = "a key of the tests"


def feistel(left, right, sizes, kind, key=KEY):
    """The network in plain Python."""
    values = [left, right]
    for i in range(1, pii.ROUNDS + 1):
        a, b = (0, 1) if i % 2 else (1, 0)
        hashed = int(sha256(f"{key}:{kind}:{i}:{values[b]}".encode()).hexdigest()[:14], 16)
        values[a] = (values[a] + hashed) % sizes[a]
    return values


@pytest.fixture(scope="module")
def one(spark):
    def run(texts, **options):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return [r.text for r in pii.pseudonymize(docs, options.pop("key", KEY), **options).orderBy("doc_id").collect()]

    return run


VALID = [
    "4465758382889437", "4465-7583-8288-9437", "4465 7583 8288 9437", "97.51.17.173", "0.0.0.0", "255.255.255.255",
    "+1 (017) 555-7713", "(212) 555-1234", "212-555-1234", "123-45-6789", "899-99-9999", "001-01-0001",
    "1980-02-29", "12/31/2000", "31.12.1999", "1900-01-01", "2099-12-31",
]
LEFT = ["4465758382889438", "0000000000000000", "256.1.1.1", "1.2.3", "666-12-3456", "000-12-3456", "2023-02-30", "02/30/1981", "2.0.", "3.14159265358979", "12345"]


def test_valid_items_change_and_come_back(one):
    texts = [f"see {v}, twice {v}!!" for v in VALID]
    hidden = one(texts)
    for given, value, out in zip(texts, VALID, hidden, strict=True):
        found = re.fullmatch(r"see (.*), twice (.*)!!", out)
        assert found[1] == found[2] != value
        assert re.sub(r"\d", "9", found[1]) == re.sub(r"\d", "9", value) or "." in value
        assert value not in out and given != out
    assert one(hidden, restore=True) == texts


def test_results_stay_valid(one):
    out = one(VALID)
    assert all(luhn(re.sub(r"\D", "", x)) for x in out[:3])
    assert len({re.sub(r"\D", "", x) for x in out[:3]}) == 1
    assert all(ipaddress.ip_address(x) for x in out[3:6])
    for x, layout in zip(out[12:], ("%Y-%m-%d", "%m/%d/%Y", "%d.%m.%Y", "%Y-%m-%d", "%Y-%m-%d"), strict=True):
        assert date(1900, 1, 1) <= datetime.strptime(x, layout).date() <= date(2099, 12, 31)


def test_like_the_plain_network(one):
    l, r = feistel(97 * 256 + 51, 17 * 256 + 173, (65536, 65536), "ipv4")  # noqa: E741
    assert one(["97.51.17.173"]) == [f"{l // 256}.{l % 256}.{r // 256}.{r % 256}"]
    l, r = feistel(4465758, 38288943, (10**7, 10**8), "card")  # noqa: E741
    assert one(["4465758382889437"])[0].startswith(f"{l:07d}{r:08d}")


def test_equal_values_are_linked_in_every_layout(one):
    layouts = {
        "phone": ["(212) 555-1234", "212-555-1234", "+12125551234", "1 212 555 1234", "+1 (212) 555-1234", "212.555.1234"],
        "day": ["2024-01-02", "01/02/2024", "02.01.2024"],
        "card": ["4465758382889437", "4465-7583-8288-9437", "4465 7583 8288 9437"],
    }
    for kind, values in layouts.items():
        out = one(values)
        assert one(out, restore=True) == values
        if kind == "day":
            days = {datetime.strptime(x, f).date() for x, f in zip(out, ("%Y-%m-%d", "%m/%d/%Y", "%d.%m.%Y"), strict=True)}
            assert len(days) == 1 and days != {date(2024, 1, 2)}
        else:
            digits = {re.sub(r"\D", "", x)[-10 if kind == "phone" else 0 :] for x in out}
            assert len(digits) == 1 and digits != {re.sub(r"\D", "", values[0])}
    low = ["(012) 555-1234", "(212) 155-1234", "(212) 055-0000", "(199) 100-0000"]
    assert one(one(low), restore=True) == low and len(set(one(low))) == 4
    assert one(["212-555-1234"], key="another") != one(["212-555-1234"])


def test_invalid_items_stay(one):
    assert one(LEFT) == LEFT


def test_different_values_stay_different(one):
    texts = [f"10.0.{i // 256}.{i % 256}" for i in range(600)]
    assert len(set(one(texts))) == 600
    assert one(texts[:3], key="another") != one(texts[:3])


def test_mail_and_secrets(one):
    text = 'a Und.34@mail7.example.com und.34@MAIL7.example.com token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" sha 04dbebab91ab85687d33eeaaf9ac699e1188f962'
    out = one([text])[0]
    mails = re.findall(r"\S+@\S+", out)
    assert mails[0] == mails[1] and "mail7" not in out.lower()
    assert re.search(r'token = "[0-9a-f]{40}" sha 04dbebab91ab85687d33eeaaf9ac699e1188f962', out) and '"04dbeb' not in out


def test_nulls_long_texts_repeats_clashes(spark):
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "97.51.17.173 " * 3000, None), (4, "x" * 500_000 + " 97.51.17.173", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    out = pii.pseudonymize(docs, KEY, found="found")
    assert out.columns == ["doc_id", "text", "found"] and sorted((r.doc_id or -1, r.found) for r in out.collect()) == [(-1, 3000), (1, 0), (2, 0), (2, 0), (4, 1)]
    assert pii.pseudonymize(docs.limit(0), KEY).count() == 0


def test_query_hides_all_and_nothing_else(spark):
    import duckdb

    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall()
    found = {r.doc_id: r for r in QUERIES["op9_pii"](spark, SF01).collect()}
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    for doc_id, text in rows:
        items = re.findall(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) \d{3}-\d{4}|(?i:(?<=token = \")[0-9a-f]{40})", text)
        items += re.findall(rf"(?<![\d.])(?:{octet}\.){{3}}{octet}(?!\d)", text)
        items += [x for x in re.findall(r"(?<!\d)\d{16}(?!\d)", text) if luhn(x)]
        out = found[doc_id].text
        assert not any(x in out for x in items), (doc_id, items)
        assert found[doc_id].n_found >= len(items)
        if not items:
            assert out == text or found[doc_id].n_found


BESIDE = [
    "4465 7583 8288 9437", "4465-7583-8288-9437", "4465758382889437", "3782 822463 10005", "3782-822463-10005", "3056 930902 5904",
    "+1 212 555 1234", "212 555 1234", "1-212-555-1234", "+12125551234", "212.555.1234", "1 (212) 555-1234",
    "+49 30 1234567", "+442079460958", "+44 20 7946 0958", "+49 (0)30 123456", "+33 1 42 68 53 00", "+353 1 234 5678",
]


def test_items_beside_following_numbers(one):
    """An expiry day, a security code, a day, or the same item once more stands just behind."""
    texts = [f"{v} {after}" for v in BESIDE for after in ("12/27", "1980-02-30", f"{v}", "x", ", 12", "- 12")]
    texts += [f"{v} 123" for v in BESIDE if v[0] in "43"]
    hidden = one(texts)
    for given, out in zip(texts, hidden, strict=True):
        value = next(v for v in sorted(BESIDE, key=len, reverse=True) if given.startswith(v + " ") or given.startswith(v + ","))
        after = given[len(value) :]
        assert value not in out and (value in after or out.endswith(after)), (given, out)
        assert re.sub(r"\d", "9", out) == re.sub(r"\d", "9", given)
        if value[0] in "43":
            assert luhn(re.sub(r"\D", "", out[: len(value)]))
    assert one(hidden, restore=True) == texts
    out = one(["+44 20 7946 0958 4465 7583 8288 9437", "+44 20 7946 0958", "4465 7583 8288 9437"])
    assert out[0] == f"{out[1]} {out[2]}"
    same = one(["+1 212 555 1234", "212 555 1234", "1-212-555-1234", "+12125551234", "+49 30 1234567", "+49301234567"])
    assert len({re.sub(r"\D", "", x)[-10:] for x in same[:4]}) == 1
    assert len({re.sub(r"\D", "", x) for x in same[4:]}) == 1


def test_grouped_cards_that_fail_their_check_digit_stay(one):
    texts = ["4465 7583 8288 9438 12/27", "3782 822463 10006", "3056-930902-5905", "112 555 1234", "+1 112 555 1234", "+2 12"]
    assert one(texts) == texts
